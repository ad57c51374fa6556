"""Language identification: expectation-maximisation estimates the shares of the
languages of a text from n-gram likelihoods, and a penalised likelihood selects which
languages take part."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Trigrams are hashed to so many buckets; a model has one row of them per language.
BUCKETS = 1 << 16
#: Most languages of a model: bounds what is collected and sent to the tasks.
MOST_LANGUAGES = 256
SMOOTHING = 0.5
ROUNDS = 12
UNKNOWN = "und"
RESULT_DDL = "struct<lang_pred: string, score: double, languages: string, shares: array<double>>"

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's letter trigrams and their counts. Letters are lower-cased;
    anything between words is one blank, also before the first and after the last."""
    points = np.frombuffer((" " + (text or "").lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    keep = letter.copy()
    keep[:-1] |= letter[1:]
    keep[1:] |= letter[:-1]
    line = np.where(letter, points, 32)[keep].astype(np.uint64)
    line = line[np.append(True, (line[1:] != 32) | (line[:-1] != 32))]
    mixed = (line[:-2] * np.uint64(0x9E3779B1) + line[1:-1]) * np.uint64(0x85EBCA77) + line[2:]
    place = ((mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)
    if len(place) > 8192:
        counts = np.bincount(place, minlength=BUCKETS)
        used = np.flatnonzero(counts)
        return used, counts[used]
    return np.unique(place, return_counts=True)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass
class Languages:
    """Trigram chances of each language."""

    names: list[str]
    logs: np.ndarray

    def shares(self, places: np.ndarray, counts: np.ndarray) -> list[tuple[str, float]]:
        """Languages of a text with their shares, largest first; ties by name.

        Expectation-maximisation over all languages orders them by share. The set
        starts as the first of them and grows in that order while the log likelihood of
        the best shares of the larger set gains more than the penalty: half the log of
        the number of trigrams, and that for each trigram's three letters, of which
        neighbours share two.
        """
        logs = self.logs[:, places]
        top = logs.max(0)
        chance = np.exp(logs - top)
        n = counts.sum()
        every, _ = self._fit(chance, counts, ROUNDS)
        order = sorted(range(len(every)), key=lambda k: (-every[k], self.names[k]))
        # Most texts are of one language, whose own likelihood is checked first.
        alone = logs @ counts
        first = int(np.argmax(alone))
        if order[0] != first and every[order[0]] - every[first] < 0.5:
            order.remove(first)
            order.insert(0, first)
        chosen, share = order[:1], np.ones(1)
        reached = float(np.log(np.maximum(chance[chosen[0]], 1e-300)) @ counts)
        for k in order[1:]:
            if every[k] * n < 3:
                break
            wider, gain = self._fit(chance[[*chosen, k]], counts, ROUNDS)
            if gain - reached <= 1.5 * np.log(n + 1):
                break
            chosen, share, reached = [*chosen, k], wider, gain
        return sorted(((self.names[k], float(s)) for k, s in zip(chosen, share)), key=lambda x: (-x[1], x[0]))

    @staticmethod
    def _fit(chance: np.ndarray, counts: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
        share = np.full(len(chance), 1 / len(chance))
        n = counts.sum()
        for _ in range(rounds):
            mixed = share @ chance
            step = share * (chance @ (counts / mixed)) / n
            if np.abs(step - share).max() < 1e-4:
                share = step
                break
            share = step
        return share, float(np.log(share @ chance) @ counts)


def train(docs: DataFrame) -> Languages:
    """Trigram model of every language (column lang, not null) of ``docs``.

    Every task counts its own documents; the counts are summed by language and bucket.
    The driver gets at most ``MOST_LANGUAGES * BUCKETS`` rows; more languages are an
    error, since leaving some out would change every answer.
    """
    kinds = docs.filter("lang is not null").select("lang").distinct().limit(MOST_LANGUAGES + 1)
    names = sorted(r.lang for r in kinds.collect())
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    place = {name: k for k, name in enumerate(names)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(*batch.columns):
                own = sums.setdefault(place[lang.as_py()], np.zeros(BUCKETS, np.int64))
                where, times = grams(text.as_py())
                own[where] += times
        for k, own in sums.items():
            used = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), k, np.int32)), pa.array(used), pa.array(own[used])], ["lang", "bucket", "n"])

    rows = docs.filter("lang is not null").select("lang", "text").mapInArrow(count, "lang int, bucket long, n long")
    table = rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.full((len(names), BUCKETS), SMOOTHING)
    counts[table["lang"].to_numpy(), table["bucket"].to_numpy()] += table["n"].to_numpy()
    return Languages(names, np.log(counts / counts.sum(1, keepdims=True)) if names else counts)


def identify(text: Column, model: Languages) -> Column:
    """Language of a text as a struct: ``lang_pred``, ``score`` (its share of the text),
    ``languages`` and their ``shares``.

    ``und`` with score 0 stands for null texts, texts without a letter, and any text if
    nothing was learned. Very long texts are read whole. Repeated rows get the same
    answer.
    """
    def run(texts: pa.Array) -> pa.Array:
        names, scores, sets, shares = [], [], [], []
        for item in texts:
            where, times = grams(item.as_py())
            found = model.shares(where, times) if len(where) and model.names else [(UNKNOWN, 0.0)]
            names.append(found[0][0])
            scores.append(min(1.0, found[0][1]))
            sets.append(",".join(n for n, _ in found))
            shares.append([s for _, s in found])
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.string()),
             pa.array(shares, pa.list_(pa.float64()))], ["lang_pred", "score", "languages", "shares"])

    return F.arrow_udf(run, RESULT_DDL)(text)


def predicted(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages of every document, from a model of
    the documents that are not held out. A null doc_id is not held out."""
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    told = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), identify(F.col("text"), model).alias("told"))
    return told.select("doc_id", "held_out", "told.lang_pred", "told.score", "told.languages")
