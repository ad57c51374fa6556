"""Personal data: patterns find the base kinds; further spans are candidates on which
weak labelers vote, expectation-maximisation weighs the labelers, and a classifier
trained on the result decides. All of it is DataFrame expressions."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import let
from ..operators.joins import stage

# Every pattern starts where a match may start for the first time: at the beginning of
# a run of its characters or where the last match ended (\G). From any other place in
# the run it could only fail again, which on long runs would cost its square.
# Possessive repeats keep nothing to go back to: what follows is in none of them.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
#: Kind of the spans that the method adds.
SECRET = "secret"
#: A candidate: an optional name with = or :, an optional quote, and a token of eight
#: or more letters, digits and joining characters, a digit among them.
CANDIDATE = (
    r"(?:(?<![A-Za-z_])[A-Za-z_]{2,24}\x20?[=:]\x20?[\x22']?)?+"
    r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9][A-Za-z0-9+/_-]{7,}+[\x22']?"
)
_TOKEN = r"([A-Za-z0-9][A-Za-z0-9+/_-]{7,})[\x22']?$"
_NAME = r"^([A-Za-z_]{2,24})\x20?[=:]"
#: Words that name a secret (the gazetteer).
SECRET_NAMES = (
    "password", "passwd", "pwd", "passphrase", "secret", "token", "apikey", "api_key", "access_key",
    "secret_key", "auth", "auth_token", "bearer", "credential", "credentials", "private_key", "client_secret",
)
#: Labelers in order: each votes 1 (secret), -1 (not) or 0 (no opinion).
LABELERS = ("known_form", "named", "assigned", "mixed", "plain_word")
#: Weight of what is believed of the labelers at the start, as a share of the candidates.
BELIEF = 0.5
SPAN = "struct<kind: string, start: int, end: int>"


def _spans(text: Column, pattern: str, needs: Column) -> Column:
    """Matches of a pattern as structs (match, start, end) in code points; null where
    the cheap test ``needs`` already rules them out.

    ``split`` and ``regexp_extract_all`` walk through the same matches, so the lengths
    of the pieces between and of the matches give the places.
    """
    def steps(found: Column) -> Column:
        return F.zip_with(
            found, F.slice(F.split(text, pattern, -1), 1, F.size(found)),
            lambda m, gap: F.struct(m.alias("match"), F.length(gap).alias("gap"), F.length(m).alias("n")),
        )

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(needs, let(let(found, steps), _placed))


#: Matches added up at a time: growing one array by each of very many would cost the
#: square of their number.
_TOGETHER = 128


def _placed(steps: Column) -> Column:
    """Steps (match, gap, n) as spans (match, start, end): places within groups of
    steps, on top of where each group begins."""
    none = F.array().cast("array<struct<match: string, start: int, end: int>>")
    last = F.floor((F.size(steps) - 1) / _TOGETHER).cast("int")
    groups = F.transform(F.sequence(F.lit(0), last), lambda g: F.slice(steps, g * _TOGETHER + 1, _TOGETHER))

    def begin(acc: Column, group: Column) -> Column:
        width = F.aggregate(group, F.lit(0), lambda total, s: total + s["gap"] + s["n"])
        return F.struct((acc["at"] + width).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

    def add(acc: Column, step: Column) -> Column:
        start = acc["at"] + step["gap"]
        span = F.struct(step["match"].alias("match"), start.alias("start"), (start + step["n"]).alias("end"))
        return F.struct(span["end"].alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    def within(group: Column, at: Column) -> Column:
        return F.aggregate(group, F.struct(at.alias("at"), none.alias("out")), add, lambda acc: acc["out"])

    def all_groups(gs: Column) -> Column:
        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.flatten(F.zip_with(gs, F.aggregate(gs, first, begin, lambda acc: acc["out"]), within))

    return F.when(F.size(steps) > 0, let(groups, all_groups)).otherwise(none)


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a right check digit."""
    each = F.transform(
        F.filter(F.split(F.reverse(digits), ""), lambda d: d != ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).when(d.cast("int") > 4, 2 * d.cast("int") - 9).otherwise(2 * d.cast("int")),
    )
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0


def base_spans(text: Column) -> Column:
    """Base spans of a text as structs (kind, start, end): by kind, then start."""
    text = F.coalesce(text, F.lit(""))

    def card(m: Column) -> Column:
        digits = F.regexp_replace(m, r"[\x20-]", "")
        return F.length(digits).between(13, 19) & luhn(digits)

    def phone(m: Column) -> Column:
        return F.length(F.regexp_replace(m, "[^0-9]", "")).between(9, 15)

    def ip(m: Column) -> Column:
        return F.forall(F.split(m, r"\."), lambda p: p.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$"))

    def named(kind: str, spans: Column, valid: Callable[[Column], Column] | None = None) -> Column:
        good = spans if valid is None else F.filter(spans, lambda s: valid(s["match"]))
        told = F.transform(
            good, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
        return F.coalesce(told, F.array().cast(f"array<{SPAN}>"))

    return F.concat(
        named("email", _spans(text, EMAIL, text.contains("@"))),
        named("ip", _spans(text, IP, text.rlike(r"[0-9]\.[0-9]")), ip),
        named("card", _spans(text, CARD, text.rlike(r"[0-9][\x20-]?[0-9][\x20-]?[0-9]")), card),
        named("phone", _spans(text, PHONE, text.contains("+")), phone),
    )


def candidates(text: Column, base: Column) -> Column:
    """Candidate spans of a text that touch no base span, with the labelers' votes and
    the features of the classifier: structs (start, end, votes, features)."""
    text = F.coalesce(text, F.lit(""))
    spans = F.coalesce(
        _spans(text, CANDIDATE, text.rlike("[0-9]")), F.array().cast("array<struct<match: string, start: int, end: int>>"))
    # Bound first: what a lambda captures is evaluated for each candidate again.
    free = let(base, lambda taken: F.filter(
        spans, lambda s: ~F.exists(taken, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))))

    def describe(s: Column) -> Column:
        m = s["match"]
        token, name = F.regexp_extract(m, _TOKEN, 1), F.lower(F.regexp_extract(m, _NAME, 1))
        n = F.greatest(F.length(token), F.lit(1))
        digits = F.length(F.regexp_replace(token, "[^0-9]", ""))
        hexadecimal = token.rlike("^[0-9a-f]{16,}$") | token.rlike("^[0-9A-F]{16,}$")
        known = token.rlike("^(?:AKIA|ASIA)[0-9A-Z]{16}$") | (hexadecimal & (digits > 0)) | token.rlike("^(?:ghp_|sk-|xox[bp]-)")
        turns = F.regexp_count(token, F.lit("[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])"))
        plain = token.rlike("^[0-9/-]+$") | token.rlike("^[0-9]{4}-[0-9]{2}") | (token.rlike("^[A-Za-z]*[a-z]{3,}") & (turns <= 3))

        def vote(yes: Column, no: Column | None = None) -> Column:
            out = F.when(yes, F.lit(1))
            return (out if no is None else out.when(no, F.lit(-1))).otherwise(F.lit(0))

        votes = F.array(
            vote(known, token.rlike("^[a-z]+[0-9]{0,3}$")),
            vote(name.isin(*SECRET_NAMES), (name != "") & ~name.isin(*SECRET_NAMES)),
            vote(m.rlike("[=:]")),
            vote(turns >= 4, turns <= 1),
            vote(F.lit(False), plain),
        )
        features = F.array(
            F.concat(F.lit("length:"), F.least(F.floor(n / 4), F.lit(12)).cast("string")),
            F.concat(F.lit("digits:"), F.floor(digits * 5 / n).cast("string")),
            F.concat(F.lit("case:"), F.when(token.rlike("[a-z]"), "l").otherwise(""), F.when(token.rlike("[A-Z]"), "u").otherwise("")),
            F.concat(F.lit("name:"), F.when(name.isin(*SECRET_NAMES), "secret").when(name != "", "other").otherwise("none")),
            F.concat(F.lit("quote:"), m.rlike("[\\x22']").cast("string")),
            F.concat(F.lit("known:"), known.cast("string")),
            F.concat(F.lit("plain:"), plain.cast("string")),
            F.concat(F.lit("turns:"), F.least(turns, F.lit(6)).cast("string")),
        )
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), votes.alias("votes"), features.alias("features"))

    return F.transform(free, describe)


@dataclass
class SpanModel:
    """Log odds of a span from its features: the prior plus a value per feature."""

    prior: float
    odds: dict[str, float]

    def accepts(self, candidate: Column) -> Column:
        if not self.odds:
            return F.lit(False)
        table = F.create_map(*[F.lit(x) for pair in sorted(self.odds.items()) for x in pair])
        score = F.aggregate(
            candidate["features"], F.lit(self.prior),
            lambda total, f: total + F.coalesce(F.try_element_at(table, f), F.lit(0.0)),
        )
        return score > 0


def posterior(patterns: DataFrame, rounds: int = 12) -> Column:
    """Chance that a candidate is personal data given its votes, as an expression.

    Expectation-maximisation over the table (votes, n) of distinct vote patterns, at
    most 3 to the power of the labelers: each labeler has a chance of each vote for
    either class, and starts as right as not in four of five cases. Each round takes
    the expected counts under the last one, with the start values as ``BELIEF`` of all
    candidates on top: where nearly all candidates are of one class, the two classes
    would else drift to two forms of it. Each round is one aggregate of one row.
    """
    labelers = range(len(LABELERS))
    start = {(k, c, v): (0.5 if v == 0 else 0.4 if (v > 0) == c else 0.1) for k in labelers for c in (True, False) for v in (-1, 0, 1)}
    right, prior = dict(start), 0.5

    def chance() -> Column:
        odds = F.lit(math.log(prior / (1 - prior)))
        for k in labelers:
            vote = F.col("votes")[k]
            gain = {v: math.log(right[k, True, v] / right[k, False, v]) for v in (-1, 0, 1)}
            odds = odds + F.when(vote > 0, gain[1]).when(vote < 0, gain[-1]).otherwise(gain[0])
        return 1 / (1 + F.exp(-odds))

    for _ in range(rounds):
        scored = patterns.withColumn("__p", chance())
        sums = [F.sum("n").alias("all"), F.sum(F.col("n") * F.col("__p")).alias("yes")]
        for k in labelers:
            for v in (-1, 1):
                hit = F.when(F.col("votes")[k] == v, F.col("n")).otherwise(0)
                sums += [F.sum(hit).alias(f"n{k}{v}"), F.sum(hit * F.col("__p")).alias(f"y{k}{v}")]
        row = scored.agg(*sums).first()
        yes, no = row["yes"] or 0.0, (row["all"] or 0) - (row["yes"] or 0.0)
        prior = (yes + 1) / (yes + no + 2)
        belief = 1 + BELIEF * (yes + no)
        for k in labelers:
            for c, total, of in ((True, yes, lambda v: row[f"y{k}{v}"] or 0.0),
                                 (False, no, lambda v: (row[f"n{k}{v}"] or 0) - (row[f"y{k}{v}"] or 0.0))):
                counts = {v: of(v) for v in (-1, 1)}
                counts[0] = max(0.0, total - of(-1) - of(1))
                for v in (-1, 0, 1):
                    right[k, c, v] = (counts[v] + belief * start[k, c, v]) / (total + belief)
    return chance()


def train(found: DataFrame) -> SpanModel:
    """Fit the span classifier to a table with ``candidates``.

    Distinct (votes, features) are counted first; their number is bounded by the
    labelers and feature values, not by the documents. The posteriors of the votes are
    soft labels for a naive Bayes model of the features, smoothed by one. Without
    candidates the model accepts nothing.
    """
    each = found.select(F.explode("candidates").alias("c")).select("c.votes", "c.features")
    distinct = stage(each.groupBy("votes", "features").agg(F.count(F.lit(1)).alias("n")).coalesce(1), "votes")
    patterns = stage(distinct.groupBy("votes").agg(F.sum("n").alias("n")).coalesce(1), "patterns")
    if not patterns.limit(1).count():
        return SpanModel(0.0, {})
    soft = distinct.withColumn("p", posterior(patterns))
    yes = F.sum(F.col("n") * F.col("p"))
    total = soft.agg(yes.alias("yes"), F.sum("n").alias("n")).first()
    rows = soft.select(F.explode("features").alias("f"), "n", "p").groupBy("f").agg(
        yes.alias("yes"), F.sum("n").alias("n")
    ).collect()
    no_total = total.n - total.yes
    return SpanModel(
        math.log((total.yes + 1) / (no_total + 1)),
        {r.f: math.log((r.yes + 1) / (total.yes + 2)) - math.log((r.n - r.yes + 1) / (no_total + 2)) for r in rows},
    )


def extracted(docs: DataFrame) -> DataFrame:
    """The documents with ``base`` spans and ``candidates`` beside their columns."""
    return docs.withColumn("base", base_spans(F.col("text"))).withColumn(
        "candidates", candidates(F.col("text"), F.col("base"))
    )


def added_spans(model: SpanModel) -> Column:
    """Spans that the model accepts among ``candidates``."""
    good = F.filter("candidates", model.accepts)
    return F.transform(good, lambda c: F.struct(F.lit(SECRET).alias("kind"), c["start"].alias("start"), c["end"].alias("end")))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.concat_ws(",", F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    ))


def personal_data(docs: DataFrame) -> DataFrame:
    """Personal data of every document: doc_id, n_email, n_ip, n_card, n_phone,
    base_sha256, spans, n_secret; one row per input row.

    Base spans are those of the patterns, leftmost and not overlapping within a kind,
    that pass the checks of their kind; kinds may overlap each other. Spans of kind
    ``secret`` (keys, passwords, tokens) are added by the model and touch no base span.
    Places are code points, ends exclusive. Null and empty texts have no span, and the
    digest of the empty string. Repeated rows get the same answer. Long texts are read
    whole, in time in proportion to their matches. Where spans of one kind tie, the
    leftmost and longest match counts. Other columns, whatever their names, are ignored. No
    documents give no rows.
    """
    found = stage(extracted(docs.select("doc_id", "text")).drop("text"), "spans")
    model = train(found)
    every = found.withColumn("added", added_spans(model))

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return every.select(
        "doc_id", *map(number, KINDS), F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_secret"),
    )


def masked_text(text: Column, spans: Column) -> Column:
    """A text with every span replaced by its kind in brackets; overlapping spans are
    one, named after the first.

    Spans are taken in groups, each from its own piece of the text: a place in a long
    text is found by walking there, and an array is copied when it grows, so either one
    span after another would cost the square of their number.
    """
    def step(piece: Column, base: Column) -> Callable[[Column, Column], Column]:
        def add(acc: Column, s: Column) -> Column:
            begin = F.substring(piece, acc["at"] - base + 1, s["start"] - acc["at"])
            fresh = F.concat(acc["out"], F.array(begin, F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))
            return F.struct(
                F.greatest(acc["at"], s["end"]).alias("at"),
                F.when(s["start"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"),
            )
        return add

    def add_group(acc: Column, group: Column) -> Column:
        begin = F.struct(acc["at"].alias("at"), F.array().cast("array<string>").alias("out"))
        last = F.array_max(F.transform(group, lambda s: s["end"]))
        piece = F.substring(text, acc["at"] + 1, F.greatest(last - acc["at"], F.lit(0)))
        return let(piece, lambda t: F.aggregate(group, begin, step(t, acc["at"]), lambda done: F.struct(
            done["at"].alias("at"), F.concat(acc["out"], F.array(F.array_join(done["out"], ""))).alias("out"))))

    def replaced(ordered: Column) -> Column:
        last = F.floor((F.size(ordered) - 1) / _TOGETHER).cast("int")
        groups = F.transform(F.sequence(F.lit(0), last), lambda g: F.slice(ordered, g * _TOGETHER + 1, _TOGETHER))
        empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
        return let(groups, lambda gs: F.aggregate(gs, empty, add_group, lambda done: F.concat(
            F.array_join(done["out"], ""), F.substring(text, done["at"] + 1, F.length(text)))))

    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.when(F.size(spans) > 0, let(ordered, replaced)).otherwise(text)


def masked(docs: DataFrame) -> DataFrame:
    """The documents with their personal data masked in ``text``; texts without any
    stay as they are, null ones too. ``n_chars``, where there is one, follows the text."""
    shielded = docs.select(F.struct(*docs.columns).alias("__row"), "text")
    found = stage(extracted(shielded), "spans")
    model = train(found.select("candidates"))
    found = found.withColumn("__text", masked_text(F.col("text"), F.concat("base", added_spans(model))))

    def column(name: str) -> Column:
        own = F.col("__row")[name]
        if name == "text":
            return F.col("__text").alias(name)
        if name == "n_chars":
            return F.when(F.col("__text").eqNullSafe(F.col("text")), own).otherwise(F.length("__text").cast(docs.schema[name].dataType)).alias(name)
        return own.alias(name)

    return found.select(*map(column, docs.columns))
