"""A corpus pipeline of five stages; each takes (spark, docs, sf_dir) and returns a DataFrame.

``run`` writes every stage's rows as Parquet in the shared folder and reads them back as the next one's documents.
All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kairopanel.llm import langid, mixing, packing, secrets, simhash
from kairopanel.llm.common import id_remainder, stored
from kairopanel.llm.queries import tokenizer_path

#: A document is rejected if its text has no letters or its language scores less than this many times even odds.
MIN_ODDS = 1.2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters or without a language above MIN_ODDS; with no labelled document the first only."""
    model = langid.fit(docs.where(id_remainder(F.col("doc_id"), 4) != 2))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    # over so many languages even odds are 1 / n; with one or two the best score is never below them
    kept = langid.predict(docs, model).where((F.col("lang_pred") != "und") & (F.col("score") >= min(0.5, MIN_ODDS / len(model.langs))))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates: SimHash tries over five-word shingles, verified similarity 0.8 or more."""
    return simhash.deduplicate(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts; n_chars follows."""
    return _counted(secrets.redact(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and drops documents so that the sources come near their targets."""
    return _counted(mixing.apply(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs, tokenizer_path())


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", without_secrets),
    ("mixing", mixture),
    ("packing", packed),
]

#: Training a network, trie joins and tokenizing are beyond SQL; a test runs all stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage{i + 1}")
    return docs
