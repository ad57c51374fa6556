"""Benchmark decontamination: passages and benchmark items meet in the space of a
randomised singular value decomposition of TF-IDF vectors; candidates are confirmed by
longest common subsequences of the item and of its answer."""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import hash_words

#: Terms are hashed to so many buckets; this bounds every table of terms.
BUCKETS = 1 << 18
_SHIFT = np.uint64(46)
#: Products of a term and an item's passage below this are left out of sums where most are.
TINY = 1e-5
PASSAGE, STRIDE = 32, 16
RANK, EXTRA = 384, 16
#: Words of the items searched for in one pass over the corpus.
BLOCK_WORDS = 100_000
LEAST_COSINE = 0.3
#: A passage is compared too where it holds this part of the squared weight of an item's
#: passage, whatever else it holds: words that no item has do not count against it.
LEAST_PART = 0.2
#: An item is found where this share of it, by inverse frequency, stands in order (near
#: verbatim) ...
VERBATIM = 0.6
#: ... or this share, if this share of its answer does too (paraphrase).
PARAPHRASE, ANSWER = 0.4, 0.5
_BLANKED = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))


def terms(text: str | None) -> list[bytes]:
    """Lower-case words without ASCII punctuation."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_BLANKED).split() if text else []


def buckets(words: list[bytes]) -> np.ndarray:
    return (hash_words(words) >> _SHIFT).astype(np.int64)


def passages(n: int) -> np.ndarray:
    """First words of the passages of a text of ``n`` words: every word is in one, and
    the last passage ends with the text."""
    last = max(0, n - PASSAGE)
    return np.unique(np.append(np.arange(0, last, STRIDE), last)) if n else np.empty(0, np.int64)


def inverse_frequency(docs: DataFrame) -> np.ndarray:
    """Smoothed inverse document frequency of each bucket, from all documents.

    Every task adds up its own counts, which are summed by bucket; the driver gets at
    most one row per bucket.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                n += 1
                # Repeated words are dropped before they are hashed.
                seen[np.unique(buckets(list(set(terms(text.as_py())))))] += 1
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(seen[used], n))], ["bucket", "n"])

    rows = docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    table = rows.toArrow()
    counts = np.zeros(BUCKETS + 1)
    counts[table["bucket"].to_numpy()] = table["n"].to_numpy()
    return np.log1p(counts[-1] / (1 + counts[:-1])).astype(np.float32)


def random_rows(rows: np.ndarray, width: int, seed: int = 2) -> np.ndarray:
    """The given rows of a fixed Gaussian matrix, each from its own number."""
    return np.stack([np.random.default_rng((seed, int(r))).standard_normal(width) for r in rows]) if len(rows) else np.empty((0, width))


def latent_space(items: DataFrame, idf: np.ndarray, rank: int = RANK) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors of the passages' TF-IDF matrix A: (buckets, vectors), one
    row for each bucket that occurs in an item.

    One pass: every task adds up its share of ``Z = A'A W`` with the random matrix W;
    the shares are summed by bucket. Then ``W'Z`` is the Gram matrix of ``A W``, whose
    Cholesky factor makes the basis Q orthonormal, and the vectors are those of
    ``Q'A``, from the small ``Z R^-1``. At most ``BUCKETS`` rows reach the driver.
    """
    width = rank + EXTRA

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for text in batch.column(0):
                own = buckets(terms(text.as_py()))
                for at in passages(len(own)):
                    ids, tf = np.unique(own[at:at + PASSAGE], return_counts=True)
                    row = tf * idf[ids]
                    row = row / max(np.linalg.norm(row), 1e-12)
                    seen = row @ random_rows(ids, width)
                    for b, w in zip(ids.tolist(), row):
                        sums[b] = sums.get(b, 0) + w * seen
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
            ["bucket", "z"])

    def add(table: pa.Table) -> pa.Table:
        ids, place = np.unique(table["bucket"].to_numpy(), return_inverse=True)
        total = np.zeros((len(ids), width))
        np.add.at(total, place, np.frombuffer(b"".join(table["z"].to_pylist())).reshape(-1, width))
        return pa.table({"bucket": pa.array(ids), "z": pa.array([v.tobytes() for v in total], pa.binary())})

    parts = items.select("text").mapInArrow(share, "bucket long, z binary")
    table = parts.groupBy((F.col("bucket") % 256).alias("g")).applyInArrow(add, "bucket long, z binary").toArrow()
    ids = table["bucket"].to_numpy()
    order = np.argsort(ids)
    if not len(ids):
        return ids, np.empty((0, 1), np.float32)
    z = np.frombuffer(b"".join(table["z"].to_pylist())).reshape(-1, width)[order]
    ids = ids[order]
    values, vectors = np.linalg.eigh(random_rows(ids, width).T @ z)
    good = values > max(values[-1], 0.0) * 1e-9
    if not good.any():
        return ids, np.zeros((len(ids), 1), np.float32)
    basis = z @ (vectors[:, good] / np.sqrt(values[good]))
    left, sizes, _ = np.linalg.svd(basis, full_matrices=False)
    return ids, left[:, :rank][:, sizes[:rank] > 1e-6 * sizes[0]].astype(np.float32)


@dataclass
class Items:
    """A block of benchmark items and where their passages lie in the latent space."""

    ids: list[int]
    words: list[list[bytes]]
    answers: list[list[bytes]]
    idf: np.ndarray
    place: np.ndarray
    vectors: np.ndarray
    owner: np.ndarray = field(init=False)
    points: np.ndarray = field(init=False)
    norms: np.ndarray = field(init=False)
    lightest: float = field(init=False, default=0.0)
    table: np.ndarray | None = field(init=False, default=None)
    postings: tuple[np.ndarray, np.ndarray, np.ndarray] | None = field(init=False, default=None)
    worth: list[np.ndarray] = field(init=False)

    def __post_init__(self) -> None:
        """``points`` are the items' unit passages b in the space, over the squared share
        of b that the space holds: their product with a passage estimates the cosine
        in the full space, and is it where the space is complete. ``norms`` are the
        weights of the passages; ``lightest`` is the least squared weight of one, each
        over the count of its most frequent term."""
        self.worth = [self.idf[buckets(words)] for words in self.words]
        owner, points, norms, least = [], [], [], [np.inf]
        for k, words in enumerate(self.words):
            own = buckets(words)
            for at in passages(len(own)):
                ids, tf = np.unique(own[at:at + PASSAGE], return_counts=True)
                row = tf * self.idf[ids]
                point = (row / max(np.linalg.norm(row), 1e-12)) @ self.vectors[self.place[ids]]
                owner.append(k)
                norms.append(np.linalg.norm(row))
                least.append(float(row @ row) / tf.max())
                points.append(point / max(float(point @ point), 1e-12))
        self.owner = np.array(owner, np.int64)
        self.norms, self.lightest = np.array(norms, np.float32), min(least)
        self.points = np.stack(points).astype(np.float32) if points else np.empty((0, self.vectors.shape[1]), np.float32)

    def _products(self, starts: np.ndarray, place: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Products of passages and the items' passages in the space.

        A passage is the sum of its words, so words are summed up once for each stride
        and a passage is the strides it consists of; the last one, which may begin
        between strides, is summed by itself. The products of single terms are kept for
        all terms while that is no larger than the vectors themselves may be.
        """
        if self.table is None and self.vectors.shape[0] * len(self.points) <= BUCKETS * RANK // 4:
            self.table = self.vectors @ self.points.T
            some = np.abs(self.table) > TINY
            if some.mean() < 1 / 8:
                first = np.append(0, np.cumsum(some.sum(1)))
                self.postings = first, np.nonzero(some)[1], self.table[some].astype(float)
        rows = self.vectors if self.table is None else self.table
        per = PASSAGE // STRIDE
        even = starts % STRIDE == 0
        pieces = np.unique((starts[even] // STRIDE)[:, None] + np.arange(per))
        begin = np.concatenate([pieces * STRIDE, starts[~even]])
        length = np.concatenate([np.full(len(pieces), STRIDE), np.full(int((~even).sum()), PASSAGE)])
        owner = np.repeat(np.arange(len(begin)), length)
        at = np.repeat(begin, length) + np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length)
        known = place[at] >= 0
        owner, at = owner[known], at[known]
        sums = np.zeros((len(begin), rows.shape[1]), np.float32)
        if len(at) and self.postings:
            first, point, value = self.postings
            term = place[at]
            n = first[term + 1] - first[term]
            of = np.repeat(first[term] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
            cell = np.repeat(owner * rows.shape[1], n) + point[of]
            sums = np.bincount(cell, np.repeat(weight[at], n) * value[of], sums.size).reshape(sums.shape).astype(np.float32)
        elif len(at):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            sums[owner[first]] = np.add.reduceat(rows[place[at]] * weight[at][:, None], first, axis=0)
        own = np.searchsorted(pieces, starts[even] // STRIDE)
        # Passages side by side, the most frequent case, need no copies of the strides.
        side = len(own) > 0 and own[-1] - own[0] == len(own) - 1
        parts = [sums[own[0] + k:own[0] + k + len(own)] if side else sums[own + k] for k in range(per)]
        out = np.empty((len(starts), rows.shape[1]), np.float32)
        # Starts ascend, and only the last one may lie between strides.
        np.add(parts[0], parts[1], out=out[:len(own)])
        for part in parts[2:]:
            out[:len(own)] += part
        out[len(own):] = sums[len(pieces):]
        return out @ self.points.T if self.table is None else out

    def near(self, own: np.ndarray) -> Iterator[tuple[int, int, float]]:
        """(passage, item, cosine) of a text's passages that come near an item, or hold
        ``LEAST_PART`` of one of its passages.

        A passage with less than ``LEAST_COSINE`` squared of its weight on terms of the
        items has a smaller cosine with each of them already in the full space. One
        whose squared weight on these terms is less than ``LEAST_PART`` of the lightest
        item passage's holds less of each.
        """
        starts = passages(len(own))
        weight = np.append(self.idf[own], np.zeros(PASSAGE, np.float32))
        place = np.append(self.place[own], np.full(PASSAGE, -1, np.int32))
        known = np.where(place >= 0, weight, 0)
        inside, whole = (
            (s := np.append(0, np.cumsum(x * x, dtype=np.float64)))[starts + PASSAGE] - s[starts] for x in (known, weight)
        )
        chosen = inside >= np.minimum(LEAST_COSINE ** 2 * whole, LEAST_PART * self.lightest)
        starts, whole = starts[chosen], np.sqrt(whole[chosen])
        for first in range(0, len(starts), 256):
            some = starts[first:first + 256]
            length = whole[first:first + 256]
            product = self._products(some, place, weight)
            # The least that any item's passage asks for leaves few to be compared with their own.
            angle = LEAST_COSINE * length.astype(np.float32)
            least = np.maximum(np.minimum(angle, LEAST_PART * self.norms.min()), 1e-6)
            i, k = np.divmod(np.flatnonzero(product >= least[:, None]), product.shape[1])
            value = product[i, k]
            enough = value >= np.maximum(np.minimum(angle[i], LEAST_PART * self.norms[k]), 1e-6)
            i, k, value = i[enough], k[enough], value[enough]
            yield from zip(some[i].tolist(), self.owner[k].tolist(), np.minimum(1.0, value / length[i]).tolist())


def answer_of(text: str) -> list[bytes]:
    """What an item asks for: its last sentence, or its last quarter if that is longer.
    Single words that end an item are no answer by themselves."""
    words = terms(text)
    sentences = [s for s in text.replace("?", ".").replace("!", ".").replace("\n", ".").split(".") if terms(s)]
    last = len(terms(sentences[-1])) if sentences else 0
    return words[len(words) - max(last, -(-len(words) // 4)):]


def common_subsequence(item: list[bytes], region: list[bytes]) -> int:
    """Length of the longest common subsequence, by bit vectors: one step per word of
    the region, whatever the length of the item."""
    where: dict[bytes, int] = {}
    for i, w in enumerate(item):
        where[w] = where.get(w, 0) | (1 << i)
    every = (1 << len(item)) - 1
    row = every
    for w in region:
        match = where.get(w)
        if match:
            hit = row & match
            row = ((row + hit) | (row - hit)) & every
    return len(item) - row.bit_count()


def may_reach(item: list[bytes], region: list[bytes], worth: np.ndarray, share: float) -> bool:
    """Whether a common subsequence may have a share of an item's worth, by two bounds on
    it: the worth of the words that the region has at all, and of the worthiest of these,
    as many as the longest common subsequence has words."""
    least, there = share * float(worth.sum()), set(region)
    found = [w for word, w in zip(item, worth.tolist(), strict=True) if word in there]
    if sum(found) < least:
        return False
    return sum(sorted(found, reverse=True)[:common_subsequence(item, region)]) >= least


def common_share(item: list[bytes], region: list[bytes], worth: np.ndarray) -> float:
    """Share of an item's worth in the worthiest common subsequence with a region. A few
    frequent words stand in order nearly everywhere, and weigh little."""
    where: dict[bytes, list[int]] = {}
    for i, w in enumerate(item):
        where.setdefault(w, []).append(i)
    best = np.zeros(len(item) + 1)
    for w in region:
        at = where.get(w)
        if at:
            reached = best[1:].copy()
            for i in at:
                reached[i] = max(reached[i], best[i] + worth[i])
            best[1:] = np.maximum.accumulate(reached)
    return float(best[-1] / worth.sum())


def findings(text: str | None, items: Items) -> Iterator[tuple[int, float, float, float]]:
    """(item, share in order, share of the answer, cosine) of each item a text holds."""
    words = terms(text)
    if not words or not len(items.points):
        return
    regions: dict[int, list[tuple[int, int, float]]] = {}
    for at, k, cosine in items.near(buckets(words)):
        reach = len(items.words[k])
        regions.setdefault(k, []).append((max(0, at - reach), at + PASSAGE + reach, cosine))
    for k, found in regions.items():
        best = (0.0, 0.0, 0.0)
        merged: list[list[float]] = []
        for start, end, cosine in sorted(found):
            # Passages of one place are read together, others apart: an item must
            # stand in one place, not scattered over a long text.
            if merged and start < merged[-1][1] and end - merged[-1][0] <= 4 * (PASSAGE + len(items.words[k])):
                merged[-1][1], merged[-1][2] = end, max(cosine, merged[-1][2])
            else:
                merged.append([start, end, cosine])
        for start, end, cosine in merged:
            region = words[int(start):int(end)]
            if may_reach(items.words[k], region, items.worth[k], PARAPHRASE):
                worth = items.worth[k]
                share = common_share(items.words[k], region, worth)
                answer = common_share(items.answers[k], region, worth[-len(items.answers[k]):])
                if share >= VERBATIM or (share >= PARAPHRASE and answer >= ANSWER):
                    best = max(best, (share, answer, cosine))
        if best[0]:
            yield items.ids[k], *best


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Which documents hold which benchmark items: (doc_id, item_id, share, answer_share,
    cosine), one row for each document id and item: the place with the largest share.

    ``benchmark`` has item_id and text. Inverse frequencies come from all documents.
    The latent space is that of the benchmark's passages, the texts searched for: a
    space of the corpus would spend its dimensions on the corpus. Every passage of every
    document is a candidate search. Items are taken in blocks of ``BLOCK_WORDS`` words,
    one pass over the documents for each, so what is sent to the tasks has a bound
    (an item longer than that is a block of its own).

    Null and empty texts hold nothing, items without a word or id are not searched for,
    repeated items are one. Rows that share an id are one document and the best of them
    counts; rows without an id are one as well. Ties in share go to the larger share of
    the answer, then the larger cosine. Long texts are searched whole, passage by passage.
    Other columns are ignored; empty tables give no rows.
    """
    idf = inverse_frequency(docs)
    sized = benchmark.filter("item_id is not null and text is not null").select(
        F.col("item_id").cast("long").alias("item_id"), "text"
    ).distinct()
    total = sized.agg(F.sum(F.length("text") / 4)).first()[0] or 0
    blocks = 1 + int(total // BLOCK_WORDS)
    schema = "doc_id long, item_id long, share double, answer_share double, cosine double"
    out = None
    for block in range(blocks):
        items = sized.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        ids, vectors = latent_space(items, idf)
        place = np.full(BUCKETS, -1, np.int32)
        place[ids] = np.arange(len(ids))
        rows = sorted((r.item_id, r.text) for r in items.collect() if terms(r.text))
        sent = Items(
            [i for i, _ in rows], [terms(t) for _, t in rows], [answer_of(t) for _, t in rows], idf, place, vectors,
        )

        def search(batches: Iterator[pa.RecordBatch], sent: Items = sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = []
                for i, text in zip(*batch.columns):
                    found += [(i.as_py(), *row) for row in findings(text.as_py(), sent)]
                columns = list(zip(*found)) or [()] * 5
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    ["doc_id", "item_id", "share", "answer_share", "cosine"])

        found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(search, schema)
        out = found if out is None else out.unionByName(found)
    best = F.max(F.struct("share", "answer_share", "cosine")).alias("best")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item; rows without doc_id stay."""
    bad = contaminated(docs, benchmark).filter("doc_id is not null").select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)
