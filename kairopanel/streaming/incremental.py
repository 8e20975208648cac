"""Incremental factor upkeep as a stream of daily files.

New bars arrive as files. Each micro-batch merges them into the bars by symbol and day and recomputes the touched
symbols (all symbols where an output ranks across them) from their first new day on, over their whole history, as sums
and recurrences begin with a symbol's first row. The factor table is then that of one evaluation over all bars, and a
replayed batch gives the same table (see Catalog.replace_days).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kairopanel.functions.series import DAY, SYMBOL, Series, evaluate
from kairopanel.sources.catalog import Catalog


def _uses(e: Series, op: str) -> bool:
    return e.op == op or any(_uses(c, op) for c in e.children)


def upkeep(spark: SparkSession, source: str, schema: StructType, catalog: Catalog, bars: str, target: str, outputs: dict[str, Series], checkpoint: str, history_days: int | None = None):
    """A query that, on each new set of bar files, merges them into ``bars`` and updates ``target``; run with availableNow.

    history_days: days of bars read before the first new one; for outputs of short windows only, default all.
    """
    across = any(_uses(e, "rank_desc") for e in outputs.values())
    ahead = any(_uses(e, "lead") for e in outputs.values())

    def merge(rows: DataFrame, name: str) -> None:
        catalog.merge_days(rows, name, [SYMBOL, DAY], DAY)

    def step(batch: DataFrame, _: int) -> None:
        if batch.isEmpty():
            return
        merge(batch, bars)
        every = catalog.read(bars).drop("_day")
        first = batch.groupBy(SYMBOL).agg(F.min(DAY).alias("_first"))
        if across:
            first = every.select(SYMBOL).distinct().crossJoin(batch.agg(F.min(DAY).alias("_first")))
        used = every.join(first.withColumnRenamed("_first", "_since"), SYMBOL)
        if history_days is not None:
            used = used.where(F.col(DAY) >= F.date_sub("_since", history_days))
        done = evaluate(used.drop("_since"), outputs).join(first, SYMBOL)
        merge((done if ahead else done.where(F.col(DAY) >= F.col("_first"))).drop("_first"), target)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True)
