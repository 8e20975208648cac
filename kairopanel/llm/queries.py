"""The opN_<name> queries: each applies its operator to the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kairopanel.llm import align, ann, bloom_lm, langid, lattice, licenses, mixing, packing, resample, secrets, simhash, toxicity, warc
from kairopanel.llm.common import id_remainder, read


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = id_remainder(F.col("doc_id"), 4) == 2
    model = langid.fit(docs.where(~held_out))
    out = langid.predict(docs.select("doc_id", "text"), model)
    doc_id = F.col("row.doc_id")
    return out.select(doc_id.alias("doc_id"), (id_remainder(doc_id, 4) == 2).alias("held_out"), "lang_pred", "score")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages")).drop("url")


OP1_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (
  SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS hexed FROM p),
d AS (
  SELECT page_id, payload_bytes,
         list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST((CAST('0x' || substr(hexed, 1 + CAST(5 * (i // 4) AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT), 1)), 'string_agg', '') AS payload_digest,
         min(page_id) OVER (PARTITION BY hexed) AS least
  FROM h)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = least THEN NULL ELSE least END AS refers_to
FROM d
"""


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read(spark, sf_dir, "documents"))


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    return ann.search(rows, rows["vec_id"] % 50 == 0)


def op4_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(read(spark, sf_dir, "embeddings"))


def op5_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = id_remainder(F.col("doc_id"), 5) == 1
    out = bloom_lm.score(docs, ~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path())


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP10_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS i
  FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][CAST(i % 3 AS INT) + 1] AS weight, source_size * 2.0::DOUBLE AS stop
  FROM sources),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS total,
         (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE - coalesce(sum(stop) OVER up, 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER up, 0)) AS level
  FROM weighed
  WINDOW up AS (ORDER BY stop / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
top AS (SELECT max(level) FILTER (WHERE level * weight <= stop) AS level FROM levels),
targets AS (
  SELECT l.source, l.source_size, l.total, least(l.stop, coalesce(o.level * l.weight, l.stop)) AS target
  FROM levels l CROSS JOIN top o),
ordered AS (
  SELECT s.doc_id, s.size, s.h, t.source_size, t.target, t.total,
         CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
times AS (
  SELECT o.*, e.epoch,
         CASE WHEN target = 0 THEN 0.0::DOUBLE ELSE CAST(upto + e.epoch * source_size AS DOUBLE) / target END AS finish
  FROM ordered o CROSS JOIN (VALUES (0), (1)) e(epoch)),
served AS (
  SELECT *, sum(size) OVER (ORDER BY finish, doc_id, epoch, size ROWS UNBOUNDED PRECEDING) - size AS used FROM times)
SELECT doc_id, size, source_size, target,
       CAST(sum(greatest(0, least(size, CAST(floor(total) AS BIGINT) - used))) AS BIGINT) AS taken
FROM served GROUP BY doc_id, size, source_size, target
"""


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels").select("doc_id", "toxic")
    held_out = id_remainder(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs.where(~held_out), labels.where(~held_out))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = align.align(read(spark, sf_dir, "documents"), tokenizer_path(), public_tokenizers.path("piece_bpe_32k.model"))
    return out.drop("doc_row")


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
    FROM range(256) r(i))),
texts AS (
  SELECT 0 AS side, doc_id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
split AS (
  SELECT side, doc_id, row_number() OVER () AS k,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM texts),
long AS (SELECT side, k, unnest(words) AS w FROM split),
distinct_words AS (SELECT DISTINCT w, hex(encode(w)) AS h FROM long),
hashed AS (
  SELECT w, xor(list_reduce(
    list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i: (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1)),
    lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) % 10000 AS bucket
  FROM distinct_words CROSS JOIN crc_table),
used AS (SELECT side, k, bucket FROM long JOIN hashed USING (w)),
sums AS (SELECT bucket, count(*) FILTER (WHERE side = 0) AS s, count(*) FILTER (WHERE side = 1) AS t FROM used GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (sum(s) OVER () + 10000) AS DOUBLE) / CAST((s + 1) * (sum(t) OVER () + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM sums),
weights AS (SELECT k, count(*) AS n, CAST(sum(gain) AS BIGINT) AS total FROM used JOIN gains USING (bucket) WHERE side = 0 GROUP BY k),
scored AS (
  SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(CASE WHEN n IS NULL THEN 0 ELSE (total - (((total % n) + n) % n)) // n END AS BIGINT) AS weight,
         CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT) + CAST(0.5 AS DOUBLE)) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS noise
  FROM split LEFT JOIN weights USING (k) WHERE side = 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY weight + noise DESC, doc_id ASC NULLS LAST) AS place,
         count(*) OVER (PARTITION BY n_features >= 20) AS able
  FROM scored)
SELECT doc_id, n_features, weight, weight + noise AS score,
       CASE WHEN n_features >= 20 AND place <= 10 * able // 100 THEN CAST(place AS BIGINT) END AS rank
FROM placed
"""


QUERIES = {
    "op5_bloom_lm": op5_bloom_lm,
    "op3_ann": op3_ann,
    "op4_lattice": op4_lattice,
    "op7_licenses": op7_licenses,
    "op1_warc": op1_warc,
    "op6_packing": op6_packing,
    "op10_mixing": op10_mixing,
    "op2_secrets": op2_secrets,
    "op8_simhash": op8_simhash,
    "op9_langid": op9_langid,
    "op11_toxicity": op11_toxicity,
    "op12_align": op12_align,
    "op13_resample": op13_resample,
}

ORACLE_SQL: dict[str, str] = {
    "op1_warc": OP1_SQL,
    "op10_mixing": OP10_SQL,
    "op13_resample": OP13_SQL,
}
