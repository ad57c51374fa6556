"""Repeated passages across documents: a count-min sketch finds the windows that may
repeat, and only those are grouped exactly."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import covered, hash_words, scramble, split_words, window_hashes

WINDOW = 50
#: A window is counted under the least of the hashes of its runs of so many words.
#: Equal windows have equal runs, so a window's count is never more than its run's,
#: and neighbouring windows mostly share one: there are a tenth as many to count.
RUN = 25
ROWS = 3
#: Cells of one row: four per counted run, within these bounds. Beyond the upper bound
#: the sketch lets more windows through and still loses none.
LEAST_CELLS, MOST_CELLS = 1 << 20, 1 << 28
_BLOCK = 1 << 16
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """Least of each ``span`` consecutive values, by doubling."""
    n, width = len(values) - span + 1, 1
    while 2 * width <= span:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    return np.minimum(values[:n], values[span - width:span - width + n])


def counted_runs(hashes: np.ndarray) -> np.ndarray:
    """For each window of a text, the hash of the run it is counted under."""
    if len(hashes) < WINDOW:
        return np.empty(0, np.uint64)
    return _least(window_hashes(hashes, RUN), WINDOW - RUN + 1)


def cells(runs: np.ndarray, row: int, width: int) -> np.ndarray:
    shift = np.uint64((row + 1) * int(_STEP) % (1 << 64))
    return (scramble(runs + shift) & np.uint64(width - 1)).astype(np.int64)


def repeated_cells(docs: DataFrame, width: int) -> np.ndarray:
    """Per row of the sketch one bit for each cell that was counted twice or more.

    Every task sketches its own documents, a run once per document, and writes the used
    cells in blocks; the blocks of all tasks are added up, each in a task of its own.
    Only bits go to the driver: ``ROWS * width / 8`` bytes at most, width being bounded.
    """
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [np.empty(0, np.uint64)]
        for batch in batches:
            for text in batch.column(0):
                found.append(np.unique(counted_runs(hash_words(split_words(text.as_py())))))
        runs = np.concatenate(found)
        for row in range(ROWS):
            used, times = np.unique(cells(runs, row, width), return_counts=True)
            blocks, starts = np.unique(used // _BLOCK, return_index=True)
            once, more = [], []
            for a, b in zip(starts, [*starts[1:], len(used)]):
                offsets = (used[a:b] % _BLOCK).astype("<u2")
                once.append(offsets.tobytes())
                more.append(offsets[times[a:b] > 1].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([row] * len(blocks), pa.int32()), pa.array(blocks, pa.int64()),
                 pa.array(once, pa.binary()), pa.array(more, pa.binary())], ["row", "block", "once", "more"])

    def merge(table: pa.Table) -> pa.Table:
        counts = np.zeros(_BLOCK, np.int64)
        for column in ("once", "more"):
            counts += np.bincount(np.frombuffer(b"".join(table[column].to_pylist()), "<u2"), minlength=_BLOCK)
        return pa.table({"row": table["row"][:1], "block": table["block"][:1],
                         "bits": pa.array([np.packbits(counts > 1, bitorder="little").tobytes()], pa.binary())})

    parts = docs.select("text").mapInArrow(sketch, "row int, block long, once binary, more binary")
    table = parts.groupBy("row", "block").applyInArrow(merge, "row int, block long, bits binary").toArrow()
    bits = np.zeros((ROWS, width // _BLOCK, _BLOCK // 8), np.uint8)
    for row, block, packed in zip(*(table[c].to_pylist() for c in ("row", "block", "bits"))):
        bits[row, block] = np.frombuffer(packed, np.uint8)
    return bits.reshape(ROWS, -1)


def _maybe_repeated(runs: np.ndarray, bits: np.ndarray) -> np.ndarray:
    width = bits.shape[1] * 8
    out = np.ones(len(runs), bool)
    for row in range(ROWS):
        at = cells(runs, row, width)
        out &= (bits[row, at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
    return out


def suspected(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """Windows that the sketch estimates to stand in two documents or more: their hash
    (96 bits), document, version and first word. ``docs`` has doc_id, version, text."""
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions, starts, first, second = [], [], [], [], []
            for i, version, text in zip(*batch.columns):
                hashes = hash_words(split_words(text.as_py()))
                runs = counted_runs(hashes)
                at = np.flatnonzero(_maybe_repeated(runs, sent.value)) if len(runs) else runs
                if not len(at):
                    continue
                first.append(window_hashes(hashes, WINDOW)[at].view(np.int64))
                second.append(window_hashes(scramble(hashes + _STEP), WINDOW)[at].astype(np.uint32).view(np.int32))
                starts.append(at.astype(np.int32))
                ids.append(np.full(len(at), i.as_py(), np.int64))
                versions.append(np.full(len(at), version.as_py(), np.int32))
            if not ids:
                continue
            columns = [np.concatenate(c) for c in (first, second, ids, versions, starts)]
            for at in range(0, len(columns[0]), 1 << 18):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[at:at + (1 << 18)]) for c in columns], ["w1", "w2", "doc_id", "version", "start"])

    return docs.select("doc_id", "version", "text").mapInArrow(
        run, "w1 long, w2 int, doc_id long, version int, start int"
    )


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, version, starts): the windows of a document that also start in one with
    a smaller doc_id.

    The least document of each suspected window is a combined aggregate. Joined back, a
    window that stands in very many documents is skewed on one side only, which adaptive
    execution splits.
    """
    letters = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    runs = letters / 6 * 2 / (WINDOW - RUN + 2)
    width = LEAST_CELLS
    while width < min(4 * runs, MOST_CELLS):
        width *= 2
    rows = suspected(docs, repeated_cells(docs, width))
    least = rows.groupBy("w1", "w2").agg(F.min("doc_id").alias("__first"), F.max("doc_id").alias("__last"))
    hits = rows.join(least.filter("__first < __last"), ["w1", "w2"]).filter("__first < doc_id")
    return hits.groupBy("doc_id", "version").agg(F.collect_list("start").alias("starts"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """Documents without the passages that stand in an earlier one: doc_id, n_words,
    n_removed, kept_sha256, kept_text, one row per input row.

    A word goes if it lies in a window of 50 consecutive words whose sequence also
    starts in a document with a smaller doc_id; all windows are judged on the input.
    ``kept_text`` is the other words joined by one space. Null and empty texts have no
    words. Rows without doc_id neither lose words nor make others lose them. Rows that
    share a doc_id do not count as repeats of each other, whatever their texts. Long texts
    are cut into windows whole. Other columns are ignored. No documents give no rows.
    """
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.hash("text").alias("version"), "text"
    )
    hits = repeated_windows(docs.filter("doc_id is not null and text is not null"))
    # A repeated row finds the same windows again: once is enough.
    joined = docs.join(hits, ["doc_id", "version"], "left").select("doc_id", "text", "starts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, digests, texts = [], [], [], []
            for text, starts in zip(batch.column(1), batch.column(2)):
                words = split_words(text.as_py())
                gone = 0
                kept = words
                if starts.is_valid:
                    lost = covered(np.unique(starts.values.to_numpy()), WINDOW, len(words))
                    gone = int(lost.sum())
                    kept = [w for w, out in zip(words, lost.tolist()) if not out]
                whole = b" ".join(kept)
                total.append(len(words))
                removed.append(gone)
                digests.append(hashlib.sha256(whole).hexdigest())
                texts.append(whole.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(digests, pa.string()), pa.array(texts, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return joined.mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    )
