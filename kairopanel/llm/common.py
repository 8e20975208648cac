"""Shared helpers: working folders, text normalisation, document keys."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lower-cases A-Z and nothing else; bytes.split() then splits on \x20 and \x09-\x0D only.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir; a local session without it gets a folder of its own, a cluster an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("kairopanel.scratch.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="kairopanel-")
        spark.conf.set("kairopanel.scratch.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder that work_dir named."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def stored(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back: cuts lineage, survives lost executors.

    What is stored stays as long as frames read it: whoever runs a job clears spark.checkpoint.dir after it. folder: one
    of work_dir that the caller drops itself.
    """
    path = f"{folder}/{name}-{uuid.uuid4().hex}" if folder else f"{work_dir(df.sparkSession, name)}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clustered(df: DataFrame, name: str, key: str) -> DataFrame:
    """Writes df, which comes out of a grouping by key, into buckets by key below the shared folder: joins by key then move
    only their other side. As many buckets as the session's shuffle partitions, so that a bucket is written by one task."""
    spark = df.sparkSession
    n, table = int(spark.conf.get("spark.sql.shuffle.partitions")), f"{name}_{uuid.uuid4().hex}"
    df.write.bucketBy(n, key).sortBy(key).option("path", f"{work_dir(spark, name)}.parquet").saveAsTable(table)
    return spark.table(table)


_KEPT: dict = {}  # of this worker process, for its later tasks


def kept(key: tuple, make: Callable[[], Any]) -> Any:
    """What make() gives, kept by the worker process for its later tasks until another key is asked for or a task lets go."""
    if key not in _KEPT:
        let_go()
        _KEPT[key] = make()
    return _KEPT[key]


def let_go() -> None:
    """Frees what earlier tasks of this worker process kept: workers live through all stages of a job, and an executor pays for all it has."""
    _KEPT.clear()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # else freed memory stays with the process
        trim(0)


def words(text: str | None) -> list[bytes]:
    """[^\\x20\\x09-\\x0D]+ of the text, A-Z lower-cased, as UTF-8 bytes; none for null."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(20).integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x5851F42D4C957F2D)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, one text after another, and the number of words of each text.

    A word's hash is a polynomial in its lower-cased bytes, made for all words at once; nothing is kept between calls.
    """
    raw = [t.encode("utf-8", "surrogatepass").translate(LOWER) if t else b"" for t in texts]
    x = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    word = ~_SPACE[x]
    turn = np.flatnonzero(word[1:] != word[:-1]) + 1
    if word[0]:
        turn = np.append(0, turn)
    starts, sizes = turn[::2], turn[1::2] - turn[::2]
    ends = np.cumsum([len(r) + 1 for r in raw])
    counts = np.diff(np.searchsorted(starts, ends), prepend=0)
    if not len(starts):
        return np.zeros(0, np.int64), counts
    first = np.cumsum(sizes) - sizes
    with np.errstate(over="ignore"):
        power = np.multiply.accumulate(np.append(np.uint64(1), np.full(int(sizes.max()) - 1, _STEP)))
        h = np.add.reduceat(_BYTE[x[word]] * power[np.arange(int(sizes.sum())) - np.repeat(first, sizes)], first)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        h += sizes.astype(np.uint64)
    return h.view(np.int64), counts


def n_words(text: Column) -> Column:
    """Number of [^\\x20\\x09-\\x0D]+, 0 for null; JVM-side and without building the words."""
    gaps = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "w")
    return F.length(gaps) - F.length(F.replace(gaps, F.lit("w"), F.lit("")))


def key_of(*cols: Column) -> Column:
    """128 bits of these columns, nulls apart from empty ones; 64 bits would be the same for some rows of very large tables."""
    parts = [F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("n")) for c in cols]
    return F.unhex(F.md5(F.concat(*parts)))


def id_remainder(doc_id: Column, k: int) -> Column:
    """crc32 of the id as text, modulo k; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % k


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
