"""Secret scan with JVM-side functions only.

Three fixed patterns find the base spans; their offsets come from the lengths of the pieces that the same pattern
splits the text into, so no Python runs. Two character Markov models, one of random strings and one of ordinary
identifiers, then look at every other run of ``min_run`` or more token characters: it is a span of kind ``markov`` if
the log-likelihood ratio of the two models is ``threshold`` nats or more.

The models are first-order over the alphabet below, smoothed by character frequencies, and fitted on labelled samples:
of the ``sample_docs`` documents whose hashed ids come first, the base spans' values (label random) and up to
``words_per_doc`` words of letters, ``_`` and ``-`` of each, as they are and in upper case (label ordinary); of
``made_strings`` digests three forms (label random) and their digits, in a row and in groups of four (label ordinary, as
account and telephone numbers, dates and times are). These bounds are on the classifier's sample only; every text is
scanned whole.

Defined results: a null text counts as empty; without spans the counts are 0, spans is '' and base_sha256 is the
digest of ''. Repeated rows and null ids are scanned like any other row; with no documents the result is empty.
Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "markov")
#: Fixed values of the base scan. Hex and access keep only long runs, which is the same as dropping short greedy ones.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_STATES = len(ALPHABET) + 1  # 0: the start, or any other character
_BLOCK = 256


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda s, x: s + x)


def _before(lens: Column) -> Column:
    """Sums of all earlier elements, by blocks, so that n elements cost n times the block at most."""
    n = F.size(lens)
    blocks = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.floor((n - 1) / _BLOCK).cast("int")), lambda b: _total(F.slice(lens, b * _BLOCK + 1, _BLOCK)))).otherwise(F.array().cast("array<int>"))

    def at(_: Column, i: Column) -> Column:
        b = F.floor(i / _BLOCK).cast("int")
        return _total(F.slice(blocks, 1, b)) + _total(F.slice(lens, b * _BLOCK + 1, i - b * _BLOCK))

    return F.transform(lens, at)


def _found(df: DataFrame, name: str, pattern: str, when: Column) -> DataFrame:
    """Adds name: array of (start, length) of all matches, from the pieces between them; null where ``when`` fails."""
    df = df.withColumn(f"{name}_m", F.when(when, F.transform(F.regexp_extract_all("t", F.lit(pattern), F.lit(0)), F.length)))
    df = df.withColumn(f"{name}_p", F.when(when, F.transform(F.split("t", pattern, -1), F.length)))
    # piece k and match k come one after the other
    df = df.withColumn(f"{name}_b", _before(F.transform(F.arrays_zip(F.col(f"{name}_m").alias("m"), F.slice(f"{name}_p", 1, F.size(f"{name}_m")).alias("p")), lambda x: x["m"] + x["p"])))
    spans = F.transform(F.arrays_zip(F.col(f"{name}_b").alias("b"), F.col(f"{name}_p").alias("p"), F.col(f"{name}_m").alias("m")), lambda x: F.struct((x["b"] + x["p"]).alias("s"), x["m"].alias("n")))
    return df.withColumn(name, F.slice(spans, 1, F.size(f"{name}_m"))).drop(f"{name}_m", f"{name}_p", f"{name}_b")


def _span(x: Column, kind: str) -> Column:
    return F.struct(x["s"].alias("s"), F.lit(KINDS.index(kind)).alias("k"), (x["s"] + x["n"]).alias("e"))


def _none() -> Column:
    return F.array().cast("array<struct<s:int,k:int,e:int>>")


def base_spans(df: DataFrame) -> DataFrame:
    """Adds base: sorted array of (s, k, e) to a frame with a non-null text t, and values: the assigned values."""
    df = _found(df, "assign", ASSIGN, F.col("t").rlike(ASSIGN))
    df = _found(df, "access", ACCESS, F.contains("t", F.lit("AKIA")))
    df = _found(df, "hex", HEX, F.col("t").rlike(HEX))
    df = df.withColumn("values", F.when(F.col("assign").isNotNull(), F.regexp_extract_all("t", F.lit(ASSIGN), F.lit(2))))
    long = F.filter(F.arrays_zip("assign", "values"), lambda x: F.length(x["values"]) >= 8)
    parts = [F.transform(long, lambda x: _span(x["assign"], "assign"))]
    parts += [F.transform("access", lambda x: _span(x, "access")), F.transform("hex", lambda x: _span(x, "hex"))]
    return df.withColumn("base", F.array_sort(F.concat(*[F.coalesce(p, _none()) for p in parts]))).drop("assign", "access", "hex")


def _codes(token: Column) -> Column:
    return F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_docs: int = 2048, words_per_doc: int = 256, made_strings: int = 1024, smooth: float = 0.5, backing: float = 8.0) -> np.ndarray:
    """Log-likelihood ratios of random over ordinary, by (last state, state), flattened."""
    src = docs.select(docs[doc_id].alias("d"), docs[text].alias("t"))
    ids = src.select("d", F.xxhash64("d").alias("h")).where("d is not null").orderBy("h", "d").limit(sample_docs).select("d").distinct()
    picked = base_spans(src.join(F.broadcast(ids), "d", "left_semi").select("d", F.coalesce("t", F.lit("")).alias("t")))
    values = F.transform("base", lambda x: F.regexp_extract(F.substring(F.col("t"), x["s"] + 1, x["e"] - x["s"]), r"([A-Za-z0-9+/_=-]+)[.]*$", 1))
    ordinary = F.filter(F.slice(F.split("t", r"[^A-Za-z0-9+/_=-]+"), 1, words_per_doc), lambda w: w.rlike("^[A-Za-z_-]{4,}$"))
    ordinary = F.concat(ordinary, F.transform(ordinary, F.upper))
    labelled = picked.select(F.explode(F.array(F.struct(F.lit(1).alias("y"), values.alias("w")), F.struct(F.lit(0).alias("y"), ordinary.alias("w")))).alias("x")).select("x.y", F.explode("x.w").alias("w")).where("w <> ''")
    digest = F.sha2(F.concat(F.lit("sample"), F.col("id").cast("string")), 256)
    made = F.array(F.base64(F.unhex(digest)), digest, F.upper(F.translate(F.base64(F.unhex(digest)), "+/=", "")))
    digits = F.translate(digest, "abcdef", "")
    plain = F.array(F.substring(digits, 1, 20), F.concat_ws("-", *[F.substring(digits, k, 4) for k in (1, 5, 9, 13)]))
    strings = docs.sparkSession.range(made_strings)
    labelled = labelled.union(strings.select(F.lit(1).alias("y"), F.explode(made).alias("w"))).union(strings.select(F.lit(0).alias("y"), F.explode(plain).alias("w")))
    pairs = labelled.withColumn("c", _codes(F.col("w"))).select("y", F.explode(F.arrays_zip(F.concat(F.array(F.lit(0)), F.slice("c", 1, F.size("c") - 1)).alias("a"), F.col("c").alias("b"))).alias("p"))
    counts = pairs.groupBy("y", F.col("p.a").alias("a"), F.col("p.b").alias("b")).count().collect()  # at most 2 * states^2 rows
    n = np.zeros((2, _STATES, _STATES))
    for r in counts:
        n[r.y, r.a, r.b] = r["count"]
    # a state seldom left in one model falls back on that model's frequencies of characters
    alone = (n.sum(1) + smooth) / (n.sum((1, 2))[:, None] + smooth * _STATES)
    p = np.log((n + backing * alone[:, None]) / (n.sum(2, keepdims=True) + backing))
    return (p[1] - p[0]).reshape(-1)


def spans(df: DataFrame, model: np.ndarray, min_run: int = 16, threshold: float = 12.0) -> DataFrame:
    """Adds base and spans (base and markov spans, sorted) to a frame with a non-null text t."""
    table = F.lit(model)
    df = base_spans(df).drop("values")
    run = f"[A-Za-z0-9+/_=-]{{{min_run},}}"
    df = df.withColumn("codes", F.transform(F.regexp_extract_all("t", F.lit(run), F.lit(0)), _codes))
    score = lambda c: F.aggregate(F.zip_with(F.concat(F.array(F.lit(0)), F.slice(c, 1, F.size(c) - 1)), c, lambda a, b: F.get(table, a * _STATES + b)), F.lit(0.0), lambda s, x: s + x)
    df = df.withColumn("flags", F.transform("codes", lambda c: score(c) >= threshold)).drop("codes")
    df = _found(df, "runs", run, F.array_contains("flags", True))
    picked = F.transform(F.filter(F.arrays_zip("runs", "flags"), lambda x: x["flags"]), lambda x: _span(x["runs"], "markov"))
    apart = F.filter(F.coalesce(picked, _none()), lambda m: ~F.exists("base", lambda b: (b["s"] < m["e"]) & (m["s"] < b["e"])))
    return df.withColumn("spans", F.array_sort(F.concat("base", apart))).drop("flags", "runs")


def joined(a: Column | str) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(a, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: np.ndarray | None = None, **kw) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans."""
    model = fit(docs, doc_id, text) if model is None else model
    out = spans(docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("t")), model, **kw)
    count = lambda k: F.size(F.filter("spans", lambda x: x["k"] == k)).cast("long")
    return out.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)], F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: np.ndarray | None = None, mark: str = "[SECRET]", **kw) -> DataFrame:
    """docs with every span (overlapping ones as one) replaced by ``mark``; same columns, a null text stays null."""
    model = fit(docs, doc_id, text) if model is None else model
    out = spans(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.coalesce(docs[text], F.lit("")).alias("t")), model, **kw)
    # a span that starts inside what is already replaced only moves the end
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    step = lambda a, x: F.struct(F.greatest(a["at"], x["e"]).alias("at"), F.when((x["s"] < a["at"]) & (F.size(a["out"]) > 0), a["out"]).otherwise(F.concat(a["out"], F.array(F.substring(F.col("t"), a["at"] + 1, x["s"] - a["at"])))).alias("out"))
    cut = F.aggregate("spans", start, step, lambda a: F.array_join(F.concat(a["out"], F.array(F.substring(F.col("t"), a["at"] + 1, F.length("t")))), mark))
    clean = F.when(F.size("spans") > 0, cut).otherwise(F.col("row").getField(text))
    return out.select(*[clean.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])
