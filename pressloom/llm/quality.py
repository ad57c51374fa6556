"""Quality rules: a linear-chain conditional random field labels each line of a text
as content or boilerplate, and the share of content decides whether it is kept."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import covered, hash_words, split_words, window_hashes

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
WINDOW = 5
FEATURES = (
    "bias", "length", "symbols", "bars", "upper", "digits", "marks", "ends_sentence",
    "distinct_words", "word_length", "repeated_line", "repeated_words",
)
VERDICT = pa.struct([
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
    ("kept", pa.bool_()), ("content_share", pa.float64()), ("n_content_lines", pa.int64()),
])
VERDICT_DDL = (
    "struct<n_words: long, word_chars: long, n_symbols: long, n_dup_lines: long, n_repeat_words: long,"
    " base_failed: boolean, kept: boolean, content_share: double, n_content_lines: long>"
)


@dataclass
class Chain:
    """A conditional random field of two states, 0 boilerplate and 1 content.

    ``weights`` scores a line as content (against boilerplate), ``moves[a, b]`` the
    step from a line of state a to one of state b.
    """

    weights: np.ndarray
    moves: np.ndarray

    def label(self, features: np.ndarray) -> np.ndarray:
        """The likeliest states of a sequence of lines (Viterbi). Ties are content."""
        scores = (features @ self.weights).tolist()
        (m00, m01), (m10, m11) = self.moves.tolist()
        low, high, back = 0.0, scores[0], []
        for s in scores[1:]:
            stay0, fall = low + m00, high + m10
            rise, stay1 = low + m01, high + m11
            back.append((fall >= stay0, stay1 >= rise))
            low, high = max(stay0, fall), max(rise, stay1) + s
        state = int(high >= low)
        states = [state]
        for came in reversed(back):
            state = int(came[state])
            states.append(state)
        return np.array(states[::-1], bool)


def _class_tables() -> dict[str, np.ndarray]:
    points = [chr(i) if not 0xD800 <= i < 0xE000 else " " for i in range(0x3000)]
    return {
        "upper": np.array([c.isupper() for c in points]),
        "digits": np.array([c.isdigit() for c in points]),
        "marks": np.array([not c.isalnum() and c not in BLANKS for c in points]),
        "symbols": np.array([c in SYMBOLS for c in points]),
        "bars": np.array([c == "|" for c in points]),
    }


_TABLES: dict[str, np.ndarray] = {}


@dataclass
class Page:
    """What the rules and the labelling need to know of one text."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    line_words: np.ndarray
    features: np.ndarray

    @property
    def base_failed(self) -> bool:
        return self.n_words < 10 or 100 * self.n_repeat_words > 20 * self.n_words


def read_page(text: str | None) -> Page:
    """Counts of a text and the features of its lines that have a word."""
    text = text or ""
    lines = text.split("\n")
    words: list[bytes] = []
    counts, kept, seen, repeated = [], [], set(), []
    for line in lines:
        own = split_words(line)
        if own:
            words += own
            counts.append(len(own))
            kept.append(line)
            repeated.append(line in seen)
            seen.add(line)
    n = len(words)
    word_chars = len(text) - sum(map(text.count, BLANKS))
    n_symbols = sum(map(text.count, SYMBOLS))
    if not n:
        return Page(0, word_chars, n_symbols, 0, 0, np.empty(0, np.int64), np.empty((0, len(FEATURES))))
    hashes = hash_words(words)
    windows = window_hashes(hashes, WINDOW)
    again = np.zeros(n, bool)
    if len(windows):
        _, place, times = np.unique(windows, return_inverse=True, return_counts=True)
        again = covered(np.flatnonzero(times[place] > 1), WINDOW, n)
    per_line = np.array(counts)
    starts = np.cumsum(per_line) - per_line
    line_of = np.repeat(np.arange(len(kept), dtype=np.uint64), per_line)
    # A word's first place among equal words of its line: sort by line, then hash.
    order = np.lexsort((hashes, line_of))
    fresh = np.ones(n, bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (line_of[order][1:] != line_of[order][:-1])
    distinct = np.add.reduceat(fresh, starts, dtype=np.int64)
    points = np.frombuffer("\n".join(kept).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, kept), np.int64, len(kept))
    offsets = np.cumsum(lengths + 1) - lengths - 1
    if not _TABLES:
        _TABLES.update(_class_tables())
    small = np.minimum(points, 0x2FFF)
    share = {k: np.add.reduceat(t[small], offsets, dtype=np.int64) / lengths for k, t in _TABLES.items()}
    ends = np.fromiter((line.rstrip(BLANKS)[-1] in ".!?:;…" for line in kept), float, len(kept))
    features = np.column_stack([
        np.ones(len(kept)), np.log1p(lengths) / 5, share["symbols"], share["bars"], share["upper"],
        share["digits"], share["marks"], ends, distinct / per_line, lengths / per_line / 10,
        np.array(repeated, float), np.add.reduceat(again, starts, dtype=np.int64) / per_line,
    ])
    return Page(n, word_chars, n_symbols, sum(repeated), int(again.sum()), per_line, features)


def _pack(
    features: list[np.ndarray], labels: list[np.ndarray], worth: list[float], span: int
) -> tuple[np.ndarray, ...]:
    """Sequences cut into pieces of at most ``span`` lines and padded to that length."""
    xs, ys, ws = [], [], []
    for x, y, w in zip(features, labels, worth):
        for at in range(0, len(x), span):
            xs.append(x[at:at + span])
            ys.append(y[at:at + span])
            ws.append(w)
    x = np.zeros((len(xs), span, len(FEATURES)))
    y = np.zeros((len(xs), span), np.int64)
    here = np.zeros((len(xs), span), bool)
    for i, (a, b) in enumerate(zip(xs, ys)):
        x[i, :len(a)], y[i, :len(a)], here[i, :len(a)] = a, b, True
    return x, y, here, np.array(ws)


def fit_chain(
    features: list[np.ndarray], labels: list[np.ndarray], worth: list[float] | None = None, rounds: int = 150, rate: float = 0.1,
    penalty: float = 1e-3, move_penalty: float = 0.5, span: int = 48,
) -> Chain:
    """Maximise the penalised conditional likelihood of labelled sequences of lines, each
    counted ``worth`` times:
    forward-backward sums give the gradient, taken in ``rounds`` Adam steps.

    Labels that come from whole documents hardly ever change between lines, so they
    say too much about the steps: ``move_penalty`` keeps those small, or one repeated
    line would draw a whole text to its side."""
    x, y, here, worth = _pack(features, labels, worth or [1.0] * len(features), span)
    shrink = np.repeat([penalty, move_penalty], [len(FEATURES), 4])
    n, pairs = (here.sum(1) * worth).sum(), here[:, 1:] & here[:, :-1]
    theta = np.zeros(len(FEATURES) + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    seen_moves = np.array([[((pairs & (y[:, :-1] == a) & (y[:, 1:] == b)).sum(1) * worth).sum() for b in (0, 1)] for a in (0, 1)])
    for step in range(1, rounds + 1):
        weights, moves = theta[:-4], theta[-4:].reshape(2, 2)
        emit = np.stack([np.zeros(x.shape[:2]), x @ weights], 2)
        ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
        ahead[:, 0] = emit[:, 0]
        for t in range(1, span):
            onward = np.logaddexp.reduce(ahead[:, t - 1, :, None] + moves, axis=1) + emit[:, t]
            ahead[:, t] = np.where(here[:, t, None], onward, ahead[:, t - 1])
        for t in range(span - 2, -1, -1):
            back = np.logaddexp.reduce(moves + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
            behind[:, t] = np.where(here[:, t + 1, None], back, 0)
        whole = np.logaddexp.reduce(ahead[:, -1], axis=1)
        chance = np.exp(np.minimum(0, ahead[..., 1] + behind[..., 1] - whole[:, None])) * here
        gap = (y * here - chance)[..., None] * x * worth[:, None, None]
        joint = np.exp(np.minimum(0, (
            ahead[:, :-1, :, None] + moves + (emit[:, 1:] + behind[:, 1:])[:, :, None, :]
            - whole[:, None, None, None]
        ))) * (pairs * worth[:, None])[..., None, None]
        slope = np.concatenate([gap.sum((0, 1)), (seen_moves - joint.sum((0, 1))).ravel()]) / n - shrink * theta
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope * slope
        theta = theta + rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return Chain(theta[:-4], theta[-4:].reshape(2, 2))


def train(
    docs: DataFrame, labels: DataFrame, per_class: int = 600, lines_per_doc: int = 400, seed: int = 4,
) -> Chain:
    """Fit the field to a bounded sample of labelled documents.

    The sample is the ``per_class`` documents of quality 1 and as many of quality 0
    with the least hash of their id; of each, at most ``lines_per_doc`` lines are used
    for fitting. Lines of documents of quality 0 and lines that repeat an earlier one
    count as boilerplate, all others as content. Where one of the two kinds is missing
    there is nothing to learn from and every line is content.
    """
    key = F.xxhash64(F.lit(seed), F.col("doc_id"))
    known = labels.filter(F.col("quality").isin(0, 1)).select(
        F.col("doc_id").alias("__id"), F.col("quality").alias("__quality"), key.alias("__key")
    )
    sample = known.filter("__quality = 0").orderBy("__key", "__id").limit(per_class).unionByName(
        known.filter("__quality = 1").orderBy("__key", "__id").limit(per_class)
    ).dropDuplicates(["__id"])
    chosen = docs.join(F.broadcast(sample), docs["doc_id"] == sample["__id"]).select("__id", "__quality", "text")

    def features(batches):
        for batch in batches:
            for i, quality, text in zip(*(c.to_pylist() for c in batch.columns)):
                page = read_page(text)
                if page.n_words:
                    lines = page.features[:lines_per_doc]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i], pa.int64()), pa.array([quality], pa.int32()),
                         pa.array([lines.tobytes()], pa.binary())], ["id", "quality", "features"])

    rows = chosen.mapInArrow(features, "id long, quality int, features binary").collect()
    rows = sorted(rows, key=lambda r: (r.id, r.quality, bytes(r.features)))[:2 * per_class]
    xs = [np.frombuffer(r.features).reshape(-1, len(FEATURES)) for r in rows]
    repeat = FEATURES.index("repeated_line")
    ys = [(x[:, repeat] == 0) & (r.quality == 1) for r, x in zip(rows, xs)]
    if len({r.quality for r in rows}) < 2:
        weights = np.zeros(len(FEATURES))
        weights[0] = 1.0
        return Chain(weights, np.zeros((2, 2)))
    # Both qualities count as much as all their lines would if there were as many.
    lines = {q: sum(len(x) for r, x in zip(rows, xs) if r.quality == q) for q in (0, 1)}
    return fit_chain(xs, ys, [sum(lines.values()) / 2 / lines[r.quality] for r in rows])


def judge(text: Column, chain: Chain, least_content: float = 0.5) -> Column:
    """Verdict on a text as a struct (see ``VERDICT``).

    A text fails the base rules with fewer than ten words, or with over 20 % of its
    words in five-word windows that occur twice. Of the others, those are kept whose
    words lie at least to the share ``least_content`` in lines labelled content. Null
    and empty texts have zero counts and fail. Each row is judged by itself, so
    repeated rows and extra columns change nothing.
    """
    def verdicts(texts: pa.Array) -> pa.Array:
        rows = []
        for item in texts:
            page = read_page(item.as_py())
            share, lines = 0.0, 0
            if page.n_words:
                content = chain.label(page.features)
                share, lines = float(page.line_words[content].sum() / page.n_words), int(content.sum())
            rows.append((
                page.n_words, page.word_chars, page.n_symbols, page.n_dup_lines, page.n_repeat_words,
                page.base_failed, not page.base_failed and share >= least_content, share, lines,
            ))
        columns = list(zip(*rows)) or [()] * len(VERDICT)
        return pa.StructArray.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, VERDICT)], fields=list(VERDICT))

    return F.arrow_udf(verdicts, VERDICT_DDL)(text)


def judged(docs: DataFrame, chain: Chain, into: str = "verdict") -> DataFrame:
    """The documents with their verdict in the column ``into``; a column of that name is
    replaced. One row per input row; no documents give no rows."""
    return docs.withColumn(into, judge(F.col("text"), chain))
