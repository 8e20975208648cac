"""Landing vendor files: dates as text, duplicate keys, dimensions that are replaced, and checks of what a factor returns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kairopanel.sources.catalog import Catalog


def parse_day(text: Column, strict: bool = False, form: str = "yyyyMMdd") -> Column:
    """A date from text of exactly this form. Other text is null, or with ``strict`` an error that names it; null stays null."""
    got = F.when(F.length(text) == len(form), F.try_to_timestamp(text, F.lit(form)).cast("date"))
    if not strict:
        return got
    return F.coalesce(got, F.when(text.isNotNull(), F.raise_error(F.concat(F.lit(f"not a date of the form {form}: "), text)).cast("date")))


def keep_one(rows: DataFrame, keys: list[str], order: list[Column], last: bool = True) -> DataFrame:
    """One whole row of each key: the last (or first) by ``order``. Partial maxima collapse a hot key before the shuffle.

    Rows that tie in order are told apart by a hash of all columns, so reruns keep the same one.
    """
    row = F.struct(*[rows[c] for c in rows.columns])
    at = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.xxhash64(*[rows[c] for c in rows.columns]).alias("h"))
    pick = (F.max_by if last else F.min_by)(row, at)
    return rows.groupBy(*[rows[k].alias(f"_{k}") for k in keys]).agg(pick.alias("_row")).select(*[F.col("_row").getField(c).alias(c) for c in rows.columns])


def ingest_calendar(catalog: Catalog, raw: DataFrame, name: str = "trade_cal", strict: bool = False) -> DataFrame:
    """Adds days of raw(exchange, cal_date, is_open, pretrade_date), dates as text, to the calendar; newer rows of a key win."""
    new = raw.select("exchange", parse_day(F.col("cal_date"), strict).alias("cal_date"), F.col("is_open").cast("int").alias("is_open"), parse_day(F.col("pretrade_date"), strict).alias("pretrade_date"))
    both = new.withColumn("_new", F.lit(1))
    if catalog.exists(name):
        both = both.unionByName(catalog.read(name).withColumn("_new", F.lit(0)))
    catalog.write(keep_one(both, ["exchange", "cal_date"], [F.col("_new")]).drop("_new"), f"{name}_next")  # a table can't be read and replaced in one job
    catalog.write(catalog.read(f"{name}_next"), name)
    return catalog.read(name)


def ingest_dimension(catalog: Catalog, raw: DataFrame, name: str, key: str, today: dt.date, dates: tuple[str, ...] = ("list_date",), strict: bool = False) -> DataFrame:
    """Replaces a dimension by raw: one row a key, text dates parsed, last_update = today."""
    rows = raw.withColumns({d: parse_day(F.col(d), strict) for d in dates if d in raw.columns}).withColumn("last_update", F.lit(today))
    catalog.write(keep_one(rows, [key], [F.col(c) for c in dates if c in raw.columns]), name)
    return catalog.read(name)


def checked(raw: DataFrame, fields: dict[str, str], required: tuple[str, ...]) -> DataFrame:
    """raw, read as text, with the columns of ``fields`` as their types (dates as yyyyMMdd or yyyy-MM-dd) and ``_reason``:
    what is wrong with a row, null if nothing. Empty text is null; a required field mustn't be."""
    made, wrong = {}, []
    for c, kind in fields.items():
        text = F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit(""))
        got = F.coalesce(parse_day(text), parse_day(text, form="yyyy-MM-dd")) if kind == "date" else text.try_cast(kind) if kind != "string" else text
        wrong.append(F.when(text.isNotNull() & got.isNull(), F.concat(F.lit(f"{c} is no {kind}: "), text)))
        if c in required:
            wrong.append(F.when(text.isNull(), F.lit(f"{c} is missing")))
        made[c] = got
    return raw.select(*[v.alias(c) for c, v in made.items()], *[c for c in raw.columns if c.startswith("_")], F.nullif(F.concat_ws("; ", *wrong), F.lit("")).alias("_reason"), F.to_json(F.struct(*[raw[c] for c in raw.columns if not c.startswith("_")])).alias("_raw"))


def land_files(catalog: Catalog, paths: list[str], table: str, fields: dict[str, str], keys: tuple[str, ...] = ("ts_code", "trade_date"), day: str = "trade_date", form: str = "csv", options: dict[str, str] | None = None) -> DataFrame:
    """Lands files of daily facts once each; returns their rows of the ledger (file, landed, bad).

    Rows that don't parse, or lack a key, go to the table ``table``_quarantine with their file, the reason and their text,
    and don't stop the others. Good rows are merged by key into the days they belong to: of rows with one key that of the
    last file named (within a file the last by value) stays. Files that the table ``table``_ledger names are left out. The
    ledger is written last and each step replaces what an earlier try has written, so a run that broke off is run again.
    """
    ledger, bad = f"{table}_ledger", f"{table}_quarantine"
    known = {r.file for r in catalog.read(ledger).where(F.col("file").isin(list(paths))).collect()} if catalog.exists(ledger) else set()  # at most a row a path
    new = [p for p in dict.fromkeys(paths) if p not in known]
    if new:
        schema = ", ".join(f"`{c}` string" for c in fields)
        reader = catalog.spark.read.format(form).options(**({"header": "true"} if form == "csv" else {}), **(options or {}))
        parts = [(reader.schema(schema) if form in ("csv", "json") else reader).load(p).select(*[F.col(f"`{c}`") for c in fields], F.lit(p).alias("_file"), F.lit(i).alias("_turn")) for i, p in enumerate(new)]
        rows = parts[0]
        for more in parts[1:]:
            rows = rows.union(more)
        catalog.write(checked(rows, fields, keys), f"{table}_landing")
        rows = catalog.read(f"{table}_landing")
        catalog.replace_parts(rows.where("_reason is not null").select(F.col("_file").alias("file"), F.col("_reason").alias("reason"), F.col("_raw").alias("text")), bad, ["file"])
        good = keep_one(rows.where("_reason is null").select(*fields, "_turn"), list(keys), [F.col("_turn")]).drop("_turn")
        if not good.isEmpty():
            catalog.merge_days(good, table, list(keys), day)
        counts = rows.groupBy(F.col("_file").alias("file")).agg(F.count(F.when(F.col("_reason").isNull(), 1)).alias("landed"), F.count("_reason").alias("bad"))
        files = catalog.spark.createDataFrame([(p,) for p in new], "file string")
        catalog.append(files.join(counts, "file", "left").na.fill(0), ledger)
        catalog.delete(f"{table}_landing")
    return catalog.read(ledger).where(F.col("file").isin(list(paths)))


def lacking_fields(columns: list[str], needed: list[str]) -> list[str]:
    return [c for c in needed if c not in columns]


def validate_result(result: DataFrame, outputs: list[str], keys: tuple[str, ...] = ("ts_code", "trade_date"), check_keys: bool = True) -> DataFrame:
    """The result itself, if it has the keys and just these outputs and (one job) no key twice; else a ValueError."""
    if missing := lacking_fields(result.columns, list(keys)):
        raise ValueError(f"the result has no {', '.join(missing)}")
    own = sorted(c for c in result.columns if c not in keys)
    if own != sorted(outputs) or not own:
        raise ValueError(f"outputs are {own}, not {sorted(outputs)}")
    if check_keys and (twice := result.groupBy(*keys).count().where("count > 1").limit(1).collect()):
        raise ValueError(f"{twice[0]} is there more than once")
    return result
