"""A training corpus from raw documents: five stages, each written before the next reads it.

Every stage works on all rows its predecessor kept. Rows with null text, language, source or id pass like
any other (see the operators for each case); an empty table passes every stage as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.llm.decontaminate import decontaminate
from loomset.llm.mixing import mix
from loomset.llm.near_dedup import keep_first
from loomset.llm.pii import redact_pii
from loomset.llm.quality import keep_good
from loomset.llm.queries import MAX_EPOCHS, SEED, SHARE, WEIGHTS, domain_of, table
from loomset.session import materialize

REJECT_BELOW = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``REJECT_BELOW`` go."""
    return keep_good(docs, table(spark, sf_dir, "labels"), threshold=REJECT_BELOW)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group stays."""
    return keep_first(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), mode="documents")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans become ``[KIND]``; ``n_chars`` follows where the text changed."""
    old = docs.withColumnRenamed("n_chars", "_old_chars").withColumn("_old_text", F.col("text"))
    new = redact_pii(old)
    same = F.col("text").eqNullSafe(F.col("_old_text"))
    sized = new.withColumn("n_chars", F.when(same, F.col("_old_chars")).otherwise(F.length("text").cast("long")))
    return sized.select(*[f"`{c}`" for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that fill the target weights, and how often each is taken."""
    return mix(docs, domain_of(F.col("source")), WEIGHTS, SHARE, MAX_EPOCHS, SEED)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("personal_data", personal_data),
    ("mixture", mixture),
]
ORACLE_SQL = None  # a trained network decides in the first stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
