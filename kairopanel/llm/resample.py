"""Target-distribution importance resampling: array-scored weights, then parallel sorting by regular sampling.

A document's features are its runs of 1 to ``ngrams`` words, hashed into ``buckets``. One array holds a bucket's gain:
the log ratio of its smoothed shares in the target texts and in all documents; a document's weight is the mean gain of
its features. Adding Gumbel noise, which depends on the id and the seed alone, makes the highest scores a draw without
replacement in proportion to exp(weight).

The ranks are exact and no task sees all rows: every partition sorts its rows into a run, every ``spacing``-th row of
each run is a sample, the sorted samples give regular splitters, rows go to the segment between their splitters, where
the pieces of the runs are merged by a local sort, and the segments' prefix counts turn places into ranks. Keys end in
a row number, so equal scores and ids are split like any others.

Defined results: null and empty texts have no features and weight 0; ids are whole numbers, a null one is hashed as the
empty text and comes after all others of its score. Repeated rows are drawn one by one, in any order among equals. With
no documents there are no rows, with no target texts all gains follow the documents alone. Extra columns are ignored.
"""

from __future__ import annotations

import math
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kairopanel.llm.common import stored
from kairopanel.llm.licenses import license_words

_PLACE = (1 << 33) - 1  # the part of a row number that counts within its partition


def features(text: str | None, ngrams: int = 1) -> list[bytes]:
    words = license_words(text)
    return words + [b" ".join(words[i : i + n]) for n in range(2, ngrams + 1) for i in range(len(words) - n + 1)]


def bucket_counts(df: DataFrame, text: str = "text", ngrams: int = 1, buckets: int = 10_000) -> np.ndarray:
    """Features in each bucket over all rows; tasks send their sums, the driver gets one row a bucket."""

    def each(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                for t in b.column(0).slice(lo, 256).to_pylist():
                    if got := list(map(crc32, features(t, ngrams))):
                        total += np.bincount(np.array(got, np.int64) % buckets, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in df.select(text).mapInArrow(each, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed ratio) of each bucket."""
    s_all, t_all, k = int(source.sum()), int(target.sum()), len(source)
    ratio = lambda t, s: (t + 1) * (s_all + k) / ((s + 1) * (t_all + k))
    return np.array([math.floor(1000 * math.log(ratio(int(t), int(s)))) for t, s in zip(target, source, strict=True)], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text", ngrams: int = 1) -> DataFrame:
    """doc_id, n_words, n_features, weight."""
    src = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))

    def each(batches):
        for b in batches:
            rows = []
            for lo in range(0, b.num_rows, 256):
                for t in b.column(1).slice(lo, 256).to_pylist():
                    got = np.array(list(map(crc32, features(t, ngrams))), np.int64)
                    n = len(got)
                    words = n if ngrams == 1 else len(license_words(t))
                    rows.append((words, n, int(gain[got % len(gain)].sum()) // n if n else 0))
            cols = list(zip(*rows, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in cols)], names=["doc_id", "n_words", "n_features", "weight"])

    return src.mapInArrow(each, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n_words bigint, n_features bigint, weight bigint")


def gumbel(doc_id: Column, seed: str = "2024") -> Column:
    """floor(1000 times Gumbel noise), from the id and the seed."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def _segments(splitters: list[tuple], names: tuple[str, str, str]):
    """Adds _seg: how many splitters come before or at a row; order: first name falling, then rising, nulls last."""

    def keys(high, low, at):
        ids = np.array([0 if x is None else x for x in low], np.int64)
        return np.array(high, np.int64), np.array([x is None for x in low], bool), ids, np.array(at, np.int64)

    cut = keys(*(zip(*splitters, strict=True) if splitters else ((), (), ())))

    def each(batches):
        n = len(cut[0])
        for b in batches:
            own = keys(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in names))
            high, none, low, at = (np.concatenate([x, y]) for x, y in zip(cut, own, strict=True))
            order = np.lexsort((at, low, none, -high))
            before = np.empty(len(order), np.int32)
            before[order] = np.cumsum(order < n)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(before[n:], pa.int32())], names=[*b.schema.names, "_seg"])

    return each


def ranked(rows: DataFrame, high: str = "score", low: str = "doc_id", segment_rows: int = 1 << 16, most_segments: int = 20_000, most_samples: int = 1 << 20) -> DataFrame:
    """Adds rank (1, 2, 3, ...) by falling ``high``, then rising ``low``, both whole numbers; see the module's text.

    Splitters are broadcast, at most ``most_segments``; samples, at most ``most_samples`` and one a run, are numbered in
    one task. A run can add at most ``spacing`` rows to a segment beyond its samples.
    """
    order = [F.col(high).desc(), F.col(low).asc_nulls_last(), F.col("_at")]
    runs = stored(rows.sortWithinPartitions(*order[:2]).withColumn("_at", F.monotonically_increasing_id()), "runs")
    n, n_runs = runs.agg(F.count(F.lit(1)), F.countDistinct(F.shiftright("_at", 33))).first()
    segment = max(segment_rows, -(-n // most_segments))
    spacing = max(1, segment // max(64, n_runs), -(-n // most_samples))
    every = -(-segment // spacing)  # samples a segment
    samples = runs.where(F.col("_at").bitwiseAND(F.lit(_PLACE)) % spacing == 0).select(high, low, "_at")
    samples = samples.withColumn("_n", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(*order)))
    splitters = [tuple(r)[:3] for r in samples.where((F.col("_n") % every == 0) & (F.col("_n") > 0)).orderBy("_n").collect()]
    dealt = runs.mapInArrow(_segments(splitters, (high, low, "_at")), f"{_ddl(runs)}, _seg int")
    dealt = stored(dealt, "segments")
    # one row a segment
    sizes = dealt.groupBy("_seg").agg(F.count(F.lit(1)).alias("_size"))
    base = sizes.select(F.col("_seg").alias("_s"), (F.sum("_size").over(W.partitionBy(F.lit(0)).orderBy("_seg")) - F.col("_size")).alias("_base"))
    merged = dealt.withColumn("_in", F.row_number().over(W.partitionBy("_seg").orderBy(*order)))
    out = merged.join(F.broadcast(base), F.col("_seg") == F.col("_s"))  # at most most_segments rows
    return out.select(*rows.columns, (F.col("_base") + F.col("_in")).cast("long").alias("rank"))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", ngrams: int = 1, buckets: int = 10_000, seed: str = "2024", least_words: int = 20, percent: int = 10, **kw) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (null unless drawn)."""
    gain = gains(bucket_counts(target, target_text, ngrams, buckets), bucket_counts(docs, text, ngrams, buckets))
    scored = weights(docs, gain, doc_id, text, ngrams).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    scored = stored(scored, "scored")
    able = scored.where(F.col("n_words") >= least_words)
    drawn = percent * able.count() // 100
    names = ["doc_id", "n_features", "weight", "score"]
    got = ranked(able.select(*names), **kw)
    got = got.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return got.union(scored.where(F.col("n_words") < least_words).select(*names, F.lit(None).cast("long").alias("rank")))


def draw(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", **kw) -> DataFrame:
    """The drawn documents themselves, same columns; needs distinct ids."""
    ids = resample(docs, target, doc_id, **kw).where("rank is not null").select(F.col("doc_id").alias("_id"))
    return docs.join(ids, docs[doc_id].eqNullSafe(F.col("_id")), "left_semi")
