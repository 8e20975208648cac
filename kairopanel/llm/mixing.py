"""Mixing sources to target weights by weighted fair queueing.

The budget is ``share`` times all tokens. It is split over the sources by weight; a source's target stops at
``epochs`` times its size and the excess is reshared by weight until no target is above its stop (water filling).
Within a source documents follow a hashed order, once per epoch. An occurrence's virtual finish time is the
source's tokens up to and with it, divided by the source's target; all occurrences are taken in the order of these
times (ties by id, epoch and size) until the budget is used up, and the last one gets what is left of it.

Nothing is summed in one task. Both running sums have two levels: per cell (of hashed order or of virtual time,
``cells`` a source) a partial sum, a running sum over the few cells, and then rows within a cell. Virtual times are
near uniform, so cells hold equal shares of tokens whatever the sources' sizes.

Defined results: null text has size 0, takes part and is taken 0 times; a null source is a source of its own, the
last one. Without any word all targets are 0. Repeated rows are separate documents; rows that are equal in id and
text are interchangeable. Extra columns are carried in ``mix`` and ignored elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kairopanel.llm.common import key_of, n_words, stored


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, epochs: int = 2) -> DataFrame:
    """sizes(source, source_size), one row a source -> with weight and target. Sources by code point, null last, weigh weights in turn."""
    every = W.partitionBy(F.lit(0))  # one row a source
    order = F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1
    s = sizes.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(order, F.lit(len(weights))))).withColumn("stop", F.col("source_size") * float(epochs))
    # sources reach their stop in the order of stop / weight; the level rises up to the first source that doesn't, then falls
    up = every.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0.0)
    s = s.withColumn("total", F.sum("source_size").over(every) * share)
    s = s.withColumn("level", (F.col("total") - F.coalesce(F.sum("stop").over(up), zero)) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(up), zero)))
    s = s.withColumn("open", F.col("level") * F.col("weight") <= F.col("stop"))
    s = s.withColumn("level", F.max(F.when(F.col("open"), F.col("level"))).over(every))
    return s.select("source", "source_size", "weight", F.least("stop", F.coalesce(F.col("level") * F.col("weight"), F.col("stop"))).alias("target"), "total")


def _running(rows: DataFrame, by: list[str], cell: str, order: list[Column], value: str, name: str) -> DataFrame:
    """Adds name: the sum of value over the rows of ``by`` before this one, by (cell, order); and pos, the place in the cell."""
    keys = [*by, cell]
    sums = rows.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    w = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))  # a few thousand sums
    base = sums.select(*[F.col(c).alias(f"_{c}") for c in keys], (F.sum("_sum").over(w.orderBy(cell)) - F.col("_sum")).alias("_base"))
    inner = W.partitionBy(*keys).orderBy(*order)
    rows = rows.withColumns({"_in": F.sum(value).over(inner.rowsBetween(W.unboundedPreceding, 0)) - F.col(value), "pos": F.row_number().over(inner)})
    # the rows stay dealt by the window's keys, so only the sums move
    joined = rows.join(base, [F.col(c) == F.col(f"_{c}") for c in keys])
    return joined.withColumn(name, F.col("_base") + F.col("_in")).drop("_in", "_base", *[f"_{c}" for c in keys])


def plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix", cells: int = 4096, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, epochs: int = 2) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, and digest (hash of the text)."""
    hashed = F.md5(F.concat(F.lit(seed), F.coalesce(docs[doc_id].cast("string"), F.lit(""))))
    skey = F.coalesce(F.concat(F.lit("s"), docs[source].cast("string")), F.lit("n"))  # never null, so that joins keep their partitioning
    sized = docs.select(docs[doc_id].alias("doc_id"), docs[source].alias("source"), skey.alias("skey"), n_words(docs[text]).cast("long").alias("size"), hashed.alias("h"), F.xxhash64(docs[text]).alias("digest"))
    sized = stored(sized.withColumn("cell", F.floor(F.conv(F.substring("h", 1, 6), 16, 10).cast("int") / ((1 << 24) // cells)).cast("int")), "sizes")
    of = targets(sized.groupBy("source", "skey").agg(F.sum("size").alias("source_size")), weights, share, epochs)
    of = stored(of.select(F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n")).alias("_s"), "source_size", "target", "total"), "targets")
    rows = _running(sized, ["skey"], "cell", [F.col("h"), F.col("doc_id"), F.col("size"), F.col("digest")], "size", "before")
    rows = rows.withColumnRenamed("pos", "place").join(of, F.col("skey") == F.col("_s")).drop("_s", "h")  # one row a source
    # rows without words take nothing and hold up nothing: they stay out of the queue
    times = rows.where("size > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    finish = F.try_divide(F.col("before") + F.col("epoch") * F.col("source_size") + F.col("size"), F.col("target"))
    times = times.withColumn("finish", F.coalesce(finish, F.lit(0.0)))
    # by time 1 every source has its target
    times = times.withColumn("slot", F.floor(F.col("finish") * (cells // 2)))
    times = _running(times, [], "slot", [F.col(c) for c in ("finish", "doc_id", "epoch", "size", "digest")], "size", "used")
    budget = F.floor("total")
    times = times.withColumn("got", F.greatest(F.lit(0), F.least(F.col("size"), budget - F.col("used"))))
    out = times.groupBy("skey", "cell", "place").agg(*[F.any_value(c).alias(c) for c in ("doc_id", "source", "size", "source_size", "target", "digest")], F.sum("got").cast("long").alias("taken"))
    names = ["doc_id", "source", "size", "source_size", "target", "taken", "digest"]
    return out.select(*names).union(rows.where("size = 0").withColumn("taken", F.lit(0).cast("long")).select(*names))


def apply(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **kw) -> DataFrame:
    """The mix itself, same columns: a document once per epoch taken in full; of the one at the budget's end its first words.

    Of rows equal in id, source and text, as many are repeated as the plan says, whichever they are.
    """
    takes = plan(docs, doc_id, text, source, **kw).where("taken > 0")
    full = F.floor(F.col("taken") / F.col("size"))
    # of equal rows at most three kinds: so many whole epochs, fewer, and the one cut off
    kinds = takes.select("doc_id", "source", "digest", full.cast("int").alias("whole"), (F.col("taken") - full * F.col("size")).cast("int").alias("part"))
    kinds = kinds.groupBy("doc_id", "source", "digest", "whole", "part").agg(F.count(F.lit(1)).alias("n"))
    per = kinds.groupBy("doc_id", "source", "digest").agg(F.sort_array(F.collect_list(F.struct("whole", "part", "n")), asc=False).alias("kinds"))
    per = per.select(key_of(F.col("doc_id"), F.col("source"), F.col("digest")).alias("_k"), F.col("kinds").alias("_kinds"))
    src = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), key_of(docs[doc_id], docs[source], F.xxhash64(docs[text])).alias("k"))
    # joined and numbered by one key: a single shuffle of the texts
    both = src.join(per.hint("merge"), F.col("k") == F.col("_k")).withColumn("rn", F.row_number().over(W.partitionBy("k").orderBy("k")))
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(0).alias("whole"), F.lit(0).alias("part"))
    pick = lambda a, x: F.when((a["seen"] < F.col("rn")) & (a["seen"] + x["n"] >= F.col("rn")), F.struct((a["seen"] + x["n"]).alias("seen"), x["whole"].alias("whole"), x["part"].alias("part"))).otherwise(F.struct((a["seen"] + x["n"]).alias("seen"), a["whole"].alias("whole"), a["part"].alias("part")))
    both = both.withColumn("mix", F.aggregate("_kinds", start, pick))
    body = F.col("row").getField(text)
    parts = F.concat(F.array_repeat(F.lit(-1), F.col("mix.whole")), F.when(F.col("mix.part") > 0, F.array(F.col("mix.part"))).otherwise(F.array().cast("array<int>")))
    both = both.select("row", F.explode(parts).alias("part"))
    words = F.split(F.regexp_replace(body, r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+")
    first = F.array_join(F.slice(words, 1, F.greatest(F.col("part"), F.lit(1))), " ")
    cut = F.when(F.col("part") < 0, body).otherwise(first)
    return both.select(*[cut.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])
