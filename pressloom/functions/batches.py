"""Arrow batches cut into pieces of a bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

#: Bytes of Arrow rows that become Python objects at one time.
PIECE_BYTES = 1 << 20


def pieces(rows: pa.Array | pa.RecordBatch, limit: int = PIECE_BYTES) -> Iterator[pa.Array | pa.RecordBatch]:
    """Halves of ``rows``, and halves of these, in order, until each has ``limit`` bytes
    at most or is a single row. None is a copy.

    A batch of Spark's has up to 10,000 rows or 64 MB. As Python objects it takes many
    times that, in each task of an executor; a piece at a time takes the same whatever
    the size of the input.
    """
    if len(rows) < 2 or rows.nbytes <= limit:
        yield rows
        return
    half = len(rows) // 2
    yield from pieces(rows.slice(0, half), limit)
    yield from pieces(rows.slice(half), limit)
