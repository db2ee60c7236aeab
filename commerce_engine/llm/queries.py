"""The operators as queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import anomalies, dac, embeddings, filter_audit, languages, link_sql, mixing, ordinal, packing, prefix_counts, pseudonyms, similarity, suffix_dedup, vector_codes
from ..session import scratch_path
from .common import table

#: The setting that holds the key of the pseudonyms. The given tables are invented: without it they get a public test key.
PII_KEY_SETTING = "spark.llm.pseudonyms.key"
TEST_KEY = "public test key, not for real data"
SEQUENCE = 4096
TOKEN_LIMIT = 512


def pii_key(spark: SparkSession) -> bytes:
    return spark.conf.get(PII_KEY_SETTING, TEST_KEY).encode()


def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.similar_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    dac.write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return dac.read_documents(spark, path)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.schedule(docs).select("doc_id", "source", "block", "release", "deadline", "slot")


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.similar_groups(table(spark, sf_dir, "documents"), words_in_shingle=2, threshold=0.8)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, length=SEQUENCE)


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pseudonyms.pseudonyms(table(spark, sf_dir, "documents").select("doc_id", "text"), pii_key(spark))
    return done.select("doc_id", "text", *(F.col(f"pii.{k}").alias(f"n_{k}") for k in pseudonyms.KINDS))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomalies.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = prefix_counts.prefix_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinal.graded(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.identified(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_embeddings, op2_suffix_dedup, op3_token_files, op4_mixing, op5_minhash, op6_packing, op7_pseudonyms, op8_quality_rules,
        op9_token_counts, op10_quality_classifier, op11_filter_audit, op12_vector_codes, op13_language_id,
    )
}

#: Slots by a recursive fold over one hyperperiod; the place in a source is one plain window.
MIXING_SQL = """
WITH RECURSIVE
counts AS (SELECT source, CAST(floor(sqrt(count(*))) AS BIGINT) AS root FROM documents GROUP BY source),
shares AS (SELECT source, greatest(1, CAST(floor(root * 1000 / (SELECT sum(root) FROM counts)) AS BIGINT)) AS share FROM counts),
numbers AS (SELECT source, share, row_number() OVER (ORDER BY source NULLS FIRST) AS i, (SELECT CAST(sum(share) AS BIGINT) FROM shares) AS period FROM shares),
base AS (SELECT list(share ORDER BY i) AS s, any_value(period) AS h FROM numbers),
fold AS (
  SELECT CAST(0 AS BIGINT) AS t, list_transform(s, lambda x: CAST(0 AS BIGINT)) AS placed, CAST(NULL AS BIGINT) AS pick, s, h FROM base
  UNION ALL
  SELECT t + 1, list_transform(range(1, len(s) + 1), lambda i: placed[i] + CASE WHEN i = chosen THEN 1 ELSE 0 END), chosen, s, h
  FROM (
    SELECT *, list_min(list_transform(
        list_filter(range(1, len(s) + 1), lambda i: (placed[i] * h) // s[i] <= t),
        lambda i: (((placed[i] + 1) * h + s[i] - 1) // s[i]) * 100000 + i)) % 100000 AS chosen
    FROM fold WHERE t < h)
),
slots AS (SELECT pick AS i, t - 1 AS at, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS kth FROM fold WHERE pick IS NOT NULL),
placed AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5('20:' || doc_id), doc_id) - 1 AS block FROM documents)
SELECT p.doc_id, p.source, p.block,
       CAST(p.block * n.period // n.share AS BIGINT) AS release,
       CAST(((p.block + 1) * n.period + n.share - 1) // n.share AS BIGINT) AS deadline,
       CAST((p.block // n.share) * n.period + s.at AS BIGINT) AS slot
FROM placed p JOIN numbers n ON p.source IS NOT DISTINCT FROM n.source JOIN slots s ON s.i = n.i AND s.kth = p.block % n.share
"""

ORACLE: dict[str, str] = {
    "op1_embeddings": link_sql.VECTORS_SQL, "op4_mixing": MIXING_SQL, "op5_minhash": link_sql.DOCUMENTS_SQL,
    "op11_filter_audit": filter_audit.AUDIT_SQL, "op12_vector_codes": vector_codes.CODES_SQL,
}
