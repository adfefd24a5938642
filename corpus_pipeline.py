"""From raw documents to training batches: quality classifier, near duplicates, benchmark decontamination, surrogates for
personal data, packing.

Each stage takes (spark, docs, sf_dir), works on all rows it gets and returns a DataFrame; all but the last return the
columns of the documents. `run` writes every stage's result as Parquet in the shared folder and reads it again for the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.llm import decontaminate, jaccard_join, packing, quality_net, surrogates
from barwright.llm.common import fresh, named, table, written

#: The demonstration's key for surrogates. A real corpus takes a secret one.
KEY = "not-a-secret"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects. Word vectors come from the documents given."""
    (score,) = fresh(docs, "__score")
    scored = docs.withColumn(score, quality_net.quality_column(docs, table(spark, sf_dir, "labels")))
    return scored.where(F.col(score) >= quality_net.THRESHOLD).select(*[named(scored, c) for c in docs.columns])


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every group of near duplicates."""
    return jaccard_join.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold benchmark passages."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def hide_people(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and secrets by surrogates."""
    count, kinds = fresh(docs, "__n_replaced", "__kinds")
    replaced = surrogates.replace_entities(docs, KEY, count=count, kinds=kinds)
    return replaced.select(*[named(replaced, c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets and token-budget batches over what is left."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("benchmark_decontamination", drop_benchmark),
    ("personal_data", hide_people),
    ("packing", pack),
]

#: The first stage is a trained model: SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
