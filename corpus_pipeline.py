"""A training corpus from raw documents, stage by stage.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns the documents it keeps.  Every stage's rows are written as Parquet and
read again before the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bpe, langid, mixing, secrets, simhash
from tidewater.llm.common import materialise, small_batches
from tidewater.sources.tables import read_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's language is identified from its whole text; those without one (no letters) go."""
    small_batches(spark)  # workers live through all stages, so their memory counts
    return langid.accepted(docs, langid.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates the document with the least id stays."""
    return simhash.one_per_group(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to a mark; documents stay."""
    return secrets.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    return (bpe.encode(docs, keep=("doc_id", "lang", "source", "text"))
            .select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
                    (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip")))


STAGES = [
    ("language id", language_id),
    ("simhash near-dedup", near_dedup),
    ("secret scans", secret_scans),
    ("mixing sources", source_mix),
    ("bpe encoding", tokens),
]

#: Language identification and the rounding draws can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    try:
        docs = read_table(spark, sf_dir, "documents")
        for name, stage in STAGES:
            docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
        return docs
    finally:
        spark.conf.set(setting, before)  # the first stage lowers it
