"""The registered query of each corpus operator, over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from . import decontamination, jaccard_join, language_id, lm_scoring, media_png, mixing, quality, sharding, token_counts, warc_zstd

SHARD_BYTES = 1 << 20


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_corpus(C.table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.classify(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels"))
    return found.select("row.doc_id", "score", "keep")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = C.table(spark, sf_dir, "pages")
    manifest = warc_zstd.write_pages(pages, C.scratch_path(spark, "warc"))
    found = warc_zstd.read_pages(manifest)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "stored_bytes")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix_sources(docs).select("row.doc_id", "size", "source_size", "target", "taken", "copies")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = C.to_table(media_png.store_texts(C.table(spark, sf_dir, "documents")), "media")
    return media_png.read_features(stored)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(C.table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(C.table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.assign_shards(docs, SHARD_BYTES).select("row.doc_id", "shard", "depth", "page", F.col("bytes").alias("shard_bytes"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(C.table(spark, sf_dir, "documents")).drop("text_hash")


def queries() -> dict:
    return {f.__name__: f for f in (op1_lm_scoring, op2_quality, op3_warc, op4_mixing, op5_decontamination, op6_media, op7_language_id, op8_token_counts, op9_sharding, op10_jaccard_join)}


JACCARD_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""


SHARDING_SQL = f"""
WITH keyed AS (
  SELECT doc_id, ('0x' || substr(md5(concat_ws(chr(31), doc_id::VARCHAR, text)), 1, 15))::BIGINT AS key,
         coalesce(strlen(text), 0)::BIGINT AS size
  FROM documents),
nodes AS (
  SELECT doc_id, key, d, key >> (60 - d) AS prefix,
         sum(size) OVER (PARTITION BY d, key >> (60 - d))::BIGINT AS bytes,
         count(*) OVER (PARTITION BY d, key >> (60 - d)) AS docs
  FROM keyed, (SELECT unnest(range(0, 61))::INT AS d)),
leaf AS (
  SELECT doc_id, key, min(d) AS depth FROM nodes WHERE bytes <= {SHARD_BYTES} OR docs = 1 OR d = 60 GROUP BY doc_id, key)
SELECT n.doc_id, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(n.prefix), depth, '0') END AS shard, depth,
       0::BIGINT AS page, n.bytes AS shard_bytes
FROM leaf JOIN nodes n ON n.doc_id = leaf.doc_id AND n.key = leaf.key AND n.d = leaf.depth
"""


def oracle_sql() -> dict[str, str]:
    return {"op9_sharding": SHARDING_SQL, "op10_jaccard_join": JACCARD_SQL}
