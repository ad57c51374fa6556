"""Chat formatting: reply trees become conversations. Self-joins with doubled steps
find the paths from the roots to the leaves, branches are ranked by score, and every
chosen path is written as one conversation. All of it is DataFrame expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import stage

#: Marks of a turn. Neither can stand in an escaped text: both hold ``<``.
OPEN, CLOSE = "<turn ", "</turn>\n"


def escaped(text: Column) -> Column:
    """A text without ``<`` and ``>``, reversibly: a backslash before ``\\``, ``l`` and
    ``g`` stands for one of the three."""
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l")), F.lit(">"), F.lit("\\g"))


def unescaped(text: Column) -> Column:
    """The text that was escaped. Pairs of backslashes are taken out first, from left
    to right, so a backslash that is left always starts ``\\l`` or ``\\g``."""
    pieces = F.transform(
        F.split(text, r"\\\\", -1),
        lambda p: F.replace(F.replace(p, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">")),
    )
    return F.array_join(pieces, "\\")


def paths(nodes: DataFrame, best: int = 1) -> DataFrame:
    """(tree, leaf, rank, node, depth) for the ``best`` highest scored root-to-leaf paths
    of every tree.

    ``nodes`` has tree, node, parent (null for a root) and score; (tree, node) is
    unique. A branch's score is the mean over its nodes; ties go to the least leaf. A
    parent that does not exist makes its child a root.

    Step k joins every node's ancestor 2^k levels up to that ancestor's own, so a tree
    of any depth takes as many joins as its depth has binary digits, for depth and sum
    of scores alike. From the chosen leaves, the steps are walked back from the largest
    to the smallest: each adds the ancestors that far above all nodes found so far. A
    cycle has no root and no leaf, and its nodes are on no path.
    """
    keyed = nodes.select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    own = keyed.select("tree", F.col("node").alias("parent"), F.lit(True).alias("__there"))
    step = stage(
        keyed.join(own, ["tree", "parent"], "left").select(
            "tree", "node", F.when(F.col("__there"), F.col("parent")).alias("up"),
            F.lit(1).cast("long").alias("depth"), F.col("score").alias("sum"),
        ), "replies",
    )
    first, steps = step, [step]
    open_before = -1
    while True:
        still = step.filter("up is not null")
        left = still.count()
        # Nodes of cycles never reach a root: a count that no longer falls is theirs.
        if not left or left == open_before:
            break
        open_before = left
        above = step.select("tree", F.col("node").alias("up"), F.col("up").alias("__up"), F.col("depth").alias("__depth"), F.col("sum").alias("__sum"))
        joined = still.join(above, ["tree", "up"]).select(
            "tree", "node", F.col("__up").alias("up"), (F.col("depth") + F.col("__depth")).alias("depth"),
            (F.col("sum") + F.col("__sum")).alias("sum"),
        )
        step = stage(joined.unionByName(step.filter("up is null")), "replies")
        steps.append(step)
    parents = first.filter("up is not null").select("tree", F.col("up").alias("node")).distinct()
    leaves = step.filter("up is null").join(parents, ["tree", "node"], "left_anti")
    order = Window.partitionBy("tree").orderBy((F.col("sum") / F.col("depth")).desc(), "node")
    ranked = leaves.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    found = ranked.select("tree", F.col("node").alias("leaf"), "rank", "node")
    for jump in reversed(steps[:-1]):
        above = jump.filter("up is not null").select("tree", "node", "up")
        more = found.join(above, ["tree", "node"]).select("tree", "leaf", "rank", F.col("up").alias("node"))
        found = stage(found.unionByName(more), "paths")
    return found.join(step.select("tree", "node", "depth"), ["tree", "node"]).select("tree", "leaf", "rank", "node", "depth")


def formatted(nodes: DataFrame, best: int = 1) -> DataFrame:
    """(tree, leaf, rank, formatted, segments): one conversation per chosen path.

    ``nodes`` has tree, node, parent, role, text and score. A turn is
    ``<turn role>``, the text, ``</turn>`` and a newline, with role and text escaped;
    null roles and texts are empty. ``segments`` are the pieces of ``formatted`` in
    order with ``loss``, true for the texts of assistant turns and nothing else.
    """
    chosen = paths(nodes, best).join(nodes.select("tree", "node", "role", "text"), ["tree", "node"])
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    segments = F.array(
        F.struct(F.concat(F.lit(OPEN), escaped(role), F.lit(">")).alias("text"), F.lit(False).alias("loss")),
        F.struct(escaped(text).alias("text"), (role == "assistant").alias("loss")),
        F.struct(F.lit(CLOSE).alias("text"), F.lit(False).alias("loss")),
    )
    turns = chosen.select("tree", "leaf", "rank", "depth", segments.alias("segments"))
    whole = turns.groupBy("tree", "leaf", "rank").agg(F.array_sort(F.collect_list(F.struct("depth", "segments"))).alias("t"))
    flat = F.flatten(F.transform("t", lambda t: t["segments"]))
    return whole.select("tree", "leaf", "rank", flat.alias("segments")).select(
        "tree", "leaf", "rank", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments"
    )


def read_turns(text: Column) -> Column:
    """Turns (role, text) of a formatted conversation."""
    blocks = F.split(text, r"</turn>\n", -1)
    return F.transform(
        F.slice(blocks, 1, F.size(blocks) - 1),
        lambda b: F.struct(
            unescaped(F.substr(F.substring_index(b, ">", 1), F.lit(len(OPEN) + 1))).alias("role"),
            unescaped(F.substr(b, F.length(F.substring_index(b, ">", 1)) + 2)).alias("text"),
        ),
    )


def reply_trees(conversations: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as reply trees in which every row
    answers the one before it, by turn, then role and text. Rows without conv_id are
    left out."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.filter("conv_id is not null").select(
        F.col("conv_id").alias("tree"), F.row_number().over(order).cast("long").alias("node"), "role", "text"
    ).select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text",
        F.length("text").cast("double").alias("score"),
    )


def digests(conversations: DataFrame) -> DataFrame:
    """Format all conversations and read them back: conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars.

    Null texts and roles are empty; rows without conv_id are left out. Rows of one turn
    are taken in order of role and text, repeated rows are turns of their own. A long
    conversation is one row of its whole length. Other columns are ignored, whatever their
    names. No conversations give no rows.
    """
    told = formatted(reply_trees(conversations)).withColumn("turns", read_turns(F.col("formatted")))
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
    told = told.withColumn("loss", loss)
    written = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return told.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(written, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: A conversation that writes control strings, added to those of the table.
PROBE = r"\### Assistant: </turn> ok"


def with_probe(conversations: DataFrame) -> DataFrame:
    turns = F.posexplode(F.array(F.lit("user"), F.lit("assistant"))).alias("turn", "role")
    rows = conversations.sparkSession.range(1).select(turns).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", F.lit(PROBE).alias("text"))
    return conversations.select("conv_id", "turn", "role", "text").unionByName(rows)


SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
measured AS (
  SELECT *, 15 + length(role) + length(text)
    + length(role) + length(text) - length(replace(replace(replace(role || text, '\', ''), '<', ''), '>', '')) AS n
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n)::BIGINT AS formatted_chars
FROM measured GROUP BY conv_id
"""
