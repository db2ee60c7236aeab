"""From raw documents to packed training sequences: five stages, each a table of its own."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_engine.llm import mixing, ordinal, packing, pseudonyms, similarity
from commerce_engine.llm.common import table, written
from commerce_engine.llm.queries import SEQUENCE, pii_key

#: Columns of documents, which every stage but the last returns.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier rejects go; rows without an id are judged by their text as well."""
    verdicts = ordinal.selected(docs, table(spark, sf_dir, "labels"))
    return verdicts.select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first row of the smallest id, of each group of near copies stays (five words, 0.8).

    Rows that share an id are documents of their own: each is judged by its own text.
    Rows without an id stay.
    """
    return similarity.first_documents(docs.select(*COLUMNS), words_in_shingle=5, threshold=0.8)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to pseudonyms; n_chars follows the new text."""
    done = pseudonyms.pseudonyms(docs.select(*COLUMNS).withColumnRenamed("n_chars", "before"), pii_key(spark))
    changed = F.aggregate(F.array(*(F.col(f"pii.{k}") for k in pseudonyms.KINDS)), F.lit(0).cast("bigint"), lambda a, b: a + b) > 0
    return done.withColumn("n_chars", F.when(changed, F.length("text").cast("bigint")).otherwise(F.col("before"))).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in the order of the Pfair schedule of their sources."""
    return mixing.mixed(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of SEQUENCE tokens, which follow the mixed order group by group."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, length=SEQUENCE, in_order=True)


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("mixing", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Stages with a trained model, a randomised join and a keyed cipher have no SQL; tests hold run() against brute force.
ORACLE_SQL = None
