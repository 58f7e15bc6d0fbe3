"""From raw documents to a training mix: quality, line dedup, near dedup, decontamination, mixing.

Each stage takes (spark, docs, folder of the tables) and returns all rows it keeps; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievemark.llm.decontamination import drop_contaminated
from sievemark.llm.line_dedup import drop_repeated_lines
from sievemark.llm.mixing import labelled_sample, mix, train_domains
from sievemark.llm.quality_rules import keep_quality
from sievemark.llm.simhash import drop_near_duplicates
from sievemark.session import materialize

#: Wanted shares of tokens, and tokens wanted for each token that reaches the last stage. The
#: budget lies over 1 so that clean documents keep a rate of at least 1.
TARGETS = {"good": 0.97, "poor": 0.03, "toxic": 0.0}
BUDGET = 1.1


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fingerprints of three-word shingles, linked at two differing bits or fewer; one document of each group stays."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their rate and number of copies; those with no copy are left out.

    The classifier learns from the labelled documents as they were before the other stages.
    """
    raw, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = train_domains(labelled_sample(raw, labels, "text", "doc_id", "doc_id", 3000))
    return mix(docs, model, TARGETS, BUDGET, allow_doubt=True).filter("copies > 0")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: Fingerprints, suffix buckets and the classifier are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
