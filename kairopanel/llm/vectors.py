"""Shared by the operators on embeddings: which vectors take part, and numpy views of Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(v: Column) -> Column:
    """Not null or empty, no null or non-finite component, not all zero."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))


def key(v: Column) -> Column:
    return F.xxhash64(v)


def distinct(rows: DataFrame) -> DataFrame:
    """rows(vec_id, v) -> one row per distinct vector: node (a number of its own, fixed once written), least (the smallest
    vec_id), n (rows), v. Partial sums keep hot vectors small."""
    got = rows.where(usable(F.col("v"))).groupBy("v").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"))
    return got.select(F.monotonically_increasing_id().alias("node"), "least", "n", "v")


def by_length(lists: pa.ListArray):
    """(indices, matrix in double precision) for every vector length in a list column without nulls."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    offsets = np.asarray(lists.offsets)
    flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(offsets)
    for d in np.unique(sizes):
        at = np.nonzero(sizes == d)[0]
        yield at, flat[offsets[at][:, None] + np.arange(d)]


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; a row's own largest component goes first, so that no square over- or underflows."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, each row alone: equal rows give equal results wherever they stand."""
    a, b = a / np.abs(a).max(1, keepdims=True), b / np.abs(b).max(1, keepdims=True)
    return (a * b).sum(1) / np.sqrt((a * a).sum(1) * (b * b).sum(1))


def mix(*parts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of integer arrays, element by element."""
    h = np.full(np.broadcast_shapes(*(p.shape for p in parts)), 0x9E3779B97F4A7C15, np.uint64)
    with np.errstate(over="ignore"):
        for p in parts:
            h = (h ^ p.astype(np.int64).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
            h *= np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(32)
    return h.view(np.int64)
