"""Integer vectors from floating-point ones, shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Integer components are kept within these, so that floors and offsets stay exact.
LARGEST = 2 ** 50


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are there and finite."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def floors(vector: Column, scale: int) -> Column:
    """``floor(scale * c)`` of each component ``c`` as double, within ``LARGEST``."""
    limit = F.lit(float(LARGEST))
    return F.transform(
        vector, lambda c: F.floor(F.greatest(-limit, F.least(limit, F.lit(float(scale)) * c.cast("double")))))


def matrix(vectors: pa.Array, width: int, fill: int = 0) -> np.ndarray:
    """Vectors of one batch as rows of a matrix, short ones filled up."""
    lengths = np.asarray(vectors.value_lengths())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.full((len(lengths), width), fill, np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out
