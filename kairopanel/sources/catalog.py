"""Parquet tables by name: reads with optional columns, yearly tables, appends that can be repeated."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass
class Catalog:
    """Tables below a root folder on any file system that Spark reads. Schemas are fixed where given."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _fs(self, name: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path(name))
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def exists(self, name: str) -> bool:
        fs, p = self._fs(name)
        return fs.exists(p)

    def list(self, name: str = "") -> list[str]:
        fs, p = self._fs(name)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def delete(self, name: str) -> bool:
        fs, p = self._fs(name)
        return fs.delete(p, True)

    def read(self, name: str, schema: StructType | None = None, columns: list[str] | None = None, strict: bool = False) -> DataFrame:
        """The table; a missing one is an empty frame of the schema. columns: those of them that it has (strict: all)."""
        if not self.exists(name):
            if schema is None:
                raise FileNotFoundError(self.path(name))
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        df = reader.parquet(self.path(name))
        if columns is None:
            return df
        lacking = [c for c in columns if c not in df.columns]
        if strict and lacking:
            raise ValueError(f"{name} has no {', '.join(lacking)}")
        return df.select(*[c for c in columns if c in df.columns])

    def write(self, df: DataFrame, name: str, compression: str = "zstd") -> None:
        """Replaces the table."""
        df.write.mode("overwrite").option("compression", compression).parquet(self.path(name))

    def append(self, df: DataFrame, name: str, compression: str = "zstd") -> None:
        """Adds rows; the columns must be the table's, in any order."""
        if self.exists(name):
            own = self.spark.read.parquet(self.path(name)).columns
            if sorted(own) != sorted(df.columns):
                raise ValueError(f"columns of {name} are {own}, not {df.columns}")
            df = df.select(*own)
        df.write.mode("append").option("compression", compression).parquet(self.path(name))

    def replace_days(self, df: DataFrame, name: str, day: str = "trade_date") -> None:
        """Writes df into a table partitioned by day: its days are replaced, others stay, so reruns don't repeat rows.

        Only the partitions of df are touched, and a day is one partition whatever else is stored.
        """
        out = df.withColumn("_day", F.col(day)).repartition("_day")
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("_day").parquet(self.path(name))

    def touched(self, name: str, rows: DataFrame, day: str = "trade_date") -> DataFrame:
        """Stored rows of the days of ``rows`` in a table written by replace_days: only those partitions are read."""
        days = [r[0] for r in rows.select(day).distinct().collect()]  # at most a row a day
        return self.read(name).where(F.col("_day").isin(days)).drop("_day")

    def merge_days(self, rows: DataFrame, name: str, keys: list[str], day: str = "trade_date") -> None:
        """Puts rows into a table written by replace_days: they replace those of their keys, which hold the day; other rows
        and days stay, and other days aren't read. Doing it again changes nothing. Keys of ``rows`` are distinct."""
        if self.exists(name):
            old = self.touched(name, rows, day).join(rows.select(*keys), keys, "left_anti")
            rows = rows.unionByName(old.select(*rows.columns))
        # written aside first: a table can't be read and replaced in one job
        self.write(rows, f"{name}_batch")
        self.replace_days(self.read(f"{name}_batch"), name, day)

    def replace_parts(self, df: DataFrame, name: str, by: list[str], compression: str = "zstd") -> None:
        """Writes df into a table partitioned by these columns: partitions that df has are replaced, others stay."""
        if not self.exists(name) and df.isEmpty():
            df.write.option("compression", compression).parquet(self.path(name))  # so that the columns are known
            return
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", compression).partitionBy(*by).parquet(self.path(name))

    def read_years(self, name: str, years: list[int], schema: StructType | None = None, day: str = "trade_date") -> DataFrame:
        """Rows of the given years; on a table written by replace_days only those partitions are read."""
        df = self.read(name, schema)
        by = "_day" if "_day" in df.columns else day
        return df.where(F.year(by).isin([int(y) for y in years])).drop("_day")

    def _clustered(self, name: str) -> str:
        """The session's name of a clustered table; the definition is made again where the session doesn't have it."""
        table = f"clustered_{hashlib.md5(self.path(name).encode()).hexdigest()}"
        if not self.spark.catalog.tableExists(table):
            if not self.exists(f"{name}_layout"):
                raise FileNotFoundError(self.path(name))
            at = self.read(f"{name}_layout").first()
            self.spark.sql(f"CREATE TABLE {table} ({at.columns}) USING parquet OPTIONS (path '{self.path(name)}') PARTITIONED BY (_year) CLUSTERED BY ({at.key}) SORTED BY ({at.key}, {at.day}) INTO {at.buckets} BUCKETS")
            self.spark.catalog.recoverPartitions(table)
        return table

    def write_clustered(self, df: DataFrame, name: str, buckets: int | None = None, key: str = "ts_code", day: str = "trade_date") -> None:
        """Replaces the table by df, a folder a year and in it one file a bucket of symbols, sorted by symbol and day.

        Windows and recurrences over a symbol then run without moving a row. buckets: as many tasks work on a symbol-wise
        job, so choose them by the table's final size (default: the session's shuffle partitions); they stay as they are.
        """
        n = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        out = df.withColumn("_year", F.year(day))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields)
        table = f"clustered_{hashlib.md5(self.path(name).encode()).hexdigest()}"
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._by_bucket(out, n, key, day).write.mode("overwrite").option("compression", "zstd").option("path", self.path(name)).partitionBy("_year").bucketBy(n, key).sortBy(key, day).saveAsTable(table)
        self.write(self.spark.createDataFrame([(key, day, n, columns)], "key string, day string, buckets int, columns string"), f"{name}_layout")

    def replace_years(self, df: DataFrame, name: str) -> None:
        """Puts df's years in place of the clustered table's; other years stay and aren't read. Doing it again changes nothing."""
        table, at = self._clustered(name), self.read(f"{name}_layout").first()
        own = [c for c in self.spark.table(table).columns if c != "_year"]
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:
            out = df.select(*own).withColumn("_year", F.year(at.day))
            self._by_bucket(out, at.buckets, at.key, at.day).write.mode("overwrite").insertInto(table)
        finally:
            self.spark.conf.set(mode, before)
        self.spark.catalog.refreshTable(table)

    @staticmethod
    def _by_bucket(df: DataFrame, n: int, key: str, day: str) -> DataFrame:
        return df.repartition(n, key).sortWithinPartitions("_year", key, day)  # a task writes one bucket, a file a year

    def read_clustered(self, name: str, years: list[int] | None = None) -> DataFrame:
        """The clustered table, of some years or whole; only those folders are read."""
        df = self.spark.table(self._clustered(name))
        return (df if years is None else df.where(F.col("_year").isin([int(y) for y in years]))).drop("_year")

    def sql(self, text: str, args: dict | None = None, **tables: str) -> DataFrame:
        """A SQL query over tables given as view=name."""
        for view, name in tables.items():
            self.read(name).createOrReplaceTempView(view)
        return self.spark.sql(text, args=args or {})
