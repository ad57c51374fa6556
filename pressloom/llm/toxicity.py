"""Toxicity: a Levenshtein automaton intersected with a lexicon trie finds offensive
terms and their misspellings, and the words around each tell abuse from quotation."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .language import held_out
from .near import shingles

QUOTES = "\"“”„«»‹›‘’'"
EDGES = QUOTES + ".,;:!?…()[]{}<>*_#-|/\\&$%+=~`@^"
REPORTING = frozenset(
    "said says wrote writes called calls quote quoted quotes term word dijo dice escribió llamó palabra"
    " sagte sagt schrieb nannte zitat wort dit écrit écrivait appelait mot citation".split()
)
CONTEXT = 5
FEATURES = ("bias", "direct", "quoted", "strongest", "weight", "share", "exact", "misspelled")


def allowed(term: str) -> int:
    """Edits that still make a misspelling of a term: short terms are too close to
    other words."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Lexicon:
    """Trie of the terms, run together with a Levenshtein automaton.

    A state is the set of trie nodes that the letters read so far can stand for, each
    with the fewest edits. States are built when a word first needs them and kept, so
    most words cost a few look-ups and stop at the first letters no term can have.
    """

    #: States and words to keep; beyond that the memory starts anew.
    KEPT = 100_000

    def __init__(self, terms: list[str]) -> None:
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.budget = [0]
        self.ends: dict[int, str] = {}
        for term in terms:
            node = 0
            self.budget[0] = max(self.budget[0], allowed(term))
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.budget.append(0)
                node = self.children[node][letter]
                self.budget[node] = max(self.budget[node], allowed(term))
            self.ends[node] = term
        self._forget()

    def _forget(self) -> None:
        self.states = [self._closed({0: 0})]
        self.known = {tuple(sorted(self.states[0].items())): 0}
        self.moves: list[dict[str, int]] = [{}]
        self.words: dict[str, tuple[str, int] | None] = {}

    def _closed(self, nodes: dict[int, int]) -> dict[int, int]:
        """With the nodes reached by leaving letters of the term out."""
        waiting = list(nodes.items())
        while waiting:
            node, edits = waiting.pop()
            if nodes[node] < edits:
                continue
            for child in self.children[node].values():
                if edits + 1 <= self.budget[child] and edits + 1 < nodes.get(child, 99):
                    nodes[child] = edits + 1
                    waiting.append((child, edits + 1))
        return nodes

    def _step(self, state: int, letter: str) -> int:
        """The state after one more letter; -1 where no term is left."""
        after: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.budget[node] and edits < after.get(node, 99):
                after[node] = edits

        for node, edits in self.states[state].items():
            reach(node, edits + 1)
            for own, child in self.children[node].items():
                reach(child, edits + (own != letter))
        if not after:
            return -1
        after = self._closed(after)
        key = tuple(sorted(after.items()))
        if key not in self.known:
            self.known[key] = len(self.states)
            self.states.append(after)
            self.moves.append({})
        return self.known[key]

    def match(self, word: str) -> tuple[str, int] | None:
        """The term a word stands for and the edits between them, the fewest; of equals
        the first term by letters."""
        if word in self.words:
            return self.words[word]
        if len(self.states) > self.KEPT or len(self.words) > 4 * self.KEPT:
            self._forget()
        state, found = 0, None
        for letter in word:
            after = self.moves[state].get(letter)
            if after is None:
                after = self.moves[state][letter] = self._step(state, letter)
            state = after
            if state < 0:
                break
        if state >= 0:
            ends = [(e, self.ends[n]) for n, e in self.states[state].items() if n in self.ends and e <= allowed(self.ends[n])]
            if ends:
                edits, term = min(ends)
                found = (term, edits)
        self.words[word] = found
        return found

    def __getstate__(self) -> list[str]:
        return self.terms

    def __setstate__(self, terms: list[str]) -> None:
        self.__init__(terms)


def bare(token: str) -> str:
    return token.strip(EDGES)


def tokens(text: str | None) -> list[str]:
    return (text or "").lower().split()


def hits(words: list[str], lexicon: Lexicon) -> list[tuple[str, int, bool]]:
    """(form, edits, quoted) of every offensive form in a text.

    A form is quoted where, within five words to each side, a quotation mark opens
    before it and one closes after it, or a word of reporting goes before it.
    """
    offensive = {}
    for token in set(words):
        form = bare(token)
        if form:
            found = lexicon.match(form)
            if found:
                offensive[token] = (form, found[1])
    if not offensive:
        return []
    out = []
    for i, token in enumerate(words):
        if token in offensive:
            before, after = words[max(0, i - CONTEXT):i + 1], words[i:i + CONTEXT + 1]
            quoted = (any(w[0] in QUOTES for w in before) and any(w.rstrip(".,;:!?")[-1:] in tuple(QUOTES) for w in after)) or any(
                bare(w) in REPORTING for w in before[:-1])
            out.append((*offensive[token], quoted))
    return out


@dataclass
class Model:
    """Lexicon, weight of each form (by edits where a form was never seen) and weights
    of the features of a text."""

    lexicon: Lexicon
    forms: dict[str, float]
    unseen: dict[int, float]
    weights: np.ndarray

    def features(self, text: str | None) -> list[float]:
        words = tokens(text)
        found = [
            (self.forms.get(form, self.unseen.get(edits, 0.0)), edits, quoted)
            for form, edits, quoted in hits(words, self.lexicon)
        ]
        strong = [(w, e, q) for w, e, q in found if w > 0]
        direct = [w for w, _, q in strong if not q]
        return [
            1.0, math.log1p(len(direct)), math.log1p(len(strong) - len(direct)), max(direct, default=0.0),
            math.log1p(sum(w for w, _, _ in strong)), 10 * len(strong) / (len(words) + 10),
            float(any(e == 0 for _, e, _ in strong)), math.log1p(sum(e > 0 for _, e, _ in strong)),
        ]

    def score(self, text: str | None) -> float:
        z = float(np.dot(self.features(text), self.weights))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def fit_weights(x: np.ndarray, y: np.ndarray, worth: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    """Penalised logistic regression by Newton steps; ``worth`` weighs the rows."""
    w = np.zeros(x.shape[1])
    worth = worth / worth.sum()
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (worth * (p - y)) + penalty * w
        bend = (x * (worth * p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        w = w - np.linalg.solve(bend, slope)
    return w


def train(docs: DataFrame, labels: DataFrame, per_class: int = 6000, least_share: float = 0.004) -> Model:
    """Learn lexicon, forms and weights from a bounded sample of labelled documents.

    The sample holds at most ``per_class`` toxic and as many other documents, those
    with the least hash of their id, and none that is held out. A term belongs to the
    lexicon if it stands in at least 3 and ``least_share`` of the toxic documents and,
    smoothed, thirty times as often in them as in others; documents that share their
    least shingle count once, so a copied text does not make its words terms. Forms the
    lexicon finds are then weighed by their own log odds in the sample. The driver gets
    lexicon and features of the sample only. Without documents of both kinds, every
    score is the smoothed share of toxic ones.
    """
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select(
        F.col("doc_id").alias("__id"), F.col("toxic").alias("__toxic"), F.xxhash64(F.lit(8), "doc_id").alias("__key")
    )
    sizes = {r["__toxic"]: r["count"] for r in known.groupBy("__toxic").count().collect()}
    if len(sizes) < 2:
        rate = (sizes.get(1, 0) + 1) / (sum(sizes.values()) + 2)
        weights = np.zeros(len(FEATURES))
        weights[0] = math.log(rate / (1 - rate))
        return Model(Lexicon([]), {}, {}, weights)
    sample = known.filter("__toxic = 1").orderBy("__key", "__id").limit(per_class).unionByName(
        known.filter("__toxic = 0").orderBy("__key", "__id").limit(per_class)).dropDuplicates(["__id"])
    chosen = docs.join(F.broadcast(sample), F.col("doc_id") == F.col("__id")).select("__id", "__toxic", "text")

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, toxic, text in zip(*batch.columns):
                text = text.as_py()
                items, _ = shingles(text)
                forms = sorted({f for f in map(bare, set(tokens(text))) if len(f) > 2})
                key = int(items[0].astype(np.int64)) if len(items) else 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(forms, pa.string()), pa.array([toxic.as_py()] * len(forms), pa.int32()),
                     pa.array([key] * len(forms), pa.int64())], ["form", "toxic", "key"])

    seen = chosen.mapInArrow(words_of, "form string, toxic int, key long").distinct()
    counts = seen.groupBy("form").agg(
        F.count(F.when(F.col("toxic") == 1, 1)).alias("yes"), F.count(F.when(F.col("toxic") == 0, 1)).alias("no"))
    yes_all = min(per_class, sizes[1])
    no_all = min(per_class, sizes[0])
    odds = ((F.col("yes") + 0.5) / (yes_all + 1)) / ((F.col("no") + 0.5) / (no_all + 1))
    terms = counts.filter((F.col("yes") >= max(3, least_share * yes_all)) & (odds >= 30)).select("form")
    lexicon = Lexicon(sorted(r.form for r in terms.collect()))

    def hits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms, edits, kinds = [], [], []
            for _, toxic, text in zip(*batch.columns):
                for form, e in sorted({(f, e) for f, e, _ in hits(tokens(text.as_py()), lexicon)}):
                    forms.append(form)
                    edits.append(e)
                    kinds.append(toxic.as_py())
            yield pa.RecordBatch.from_arrays(
                [pa.array(forms, pa.string()), pa.array(edits, pa.int32()), pa.array(kinds, pa.int32())],
                ["form", "edits", "toxic"])

    rows = chosen.mapInArrow(hits_of, "form string, edits int, toxic int").groupBy("form", "edits").agg(
        F.sum("toxic").alias("yes"), F.count(F.lit(1)).alias("n")).collect()

    def weigh(yes: float, n: float) -> float:
        return math.log((yes + 0.5) / (yes_all + 1)) - math.log((n - yes + 0.5) / (no_all + 1))

    forms = {r.form: weigh(r.yes, r.n) for r in rows}
    # A form not seen so far weighs what forms seen once or twice weigh on average.
    unseen = {}
    for e in (0, 1, 2):
        rare = [r for r in rows if r.edits == e and r.n <= 2]
        unseen[e] = weigh(sum(r.yes for r in rare), sum(r.n for r in rare)) if rare else 0.0
    model = Model(lexicon, forms, unseen, np.zeros(len(FEATURES)))

    def features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [model.features(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(x, pa.list_(pa.float64()))], ["id", "toxic", "x"])

    told = sorted(chosen.mapInArrow(features_of, "id long, toxic int, x array<double>").collect())
    y = np.array([r.toxic for r in told], float)
    x = np.array([r.x for r in told]).reshape(len(told), len(FEATURES))
    if not len(told):
        return model
    worth = np.where(y == 1, sizes[1] / max(y.sum(), 1), sizes[0] / max((1 - y).sum(), 1))
    model.weights = fit_weights(x, y, worth)
    return model


def toxicity(text: Column, model: Model) -> Column:
    """Chance that a text is toxic. Null and empty texts have no hit and get the score
    of such texts; long ones are read whole; repeated rows get the same score."""
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(t.as_py()) for t in texts], pa.float64())

    return F.arrow_udf(run, "double")(text)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document, learned from labelled
    documents that are not held out.

    One row per input row. Null and empty texts and those without a word of the lexicon
    have the score of a text without signs. Long texts are read whole. Repeated rows get
    the same score; equal scores need no order. Other columns, whatever their names, are
    ignored. No documents give no rows.
    """
    model = train(docs, labels)
    told = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), toxicity(F.col("text"), model).alias("score"))
    return told.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
