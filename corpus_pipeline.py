"""From raw documents to a weighted training mix, as stages that are each written as Parquet and read again.

1. ``quality``: documents that the classifier rejects go.
2. ``near_duplicates``: of each component of the n-gram Jaccard join the document with the smallest id stays.
3. ``repeated_passages``: passages that several documents share stay in one of them.
4. ``decontaminate``: documents that hold a benchmark item go.
5. ``mix``: the words that the mix takes from each document; documents that it takes nothing from go.

All but the last return the columns of ``documents``; ``n_chars`` follows the text. Rows with a NULL ``doc_id`` cannot be named by a join: stages
2 and 4 keep them. Repeated rows of one id stand or fall together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import decontaminate as leaks
from marquee.llm import jaccard, mixing, passages
from marquee.llm import quality as classifier
from marquee.llm.common import table
from marquee.session import passing, scratch_dir, staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
KEEP_FROM = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = classifier.fit(docs, table(spark, sf_dir, "labels"))
    return classifier.scored(docs.select(COLUMNS), model, "_score").where(F.col("_score") >= KEEP_FROM).drop("_score")


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the rows whose ``doc_id`` is among ``ids``."""
    return docs.join(ids.select("doc_id").distinct(), "doc_id", "left_anti")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with passing() as keep:
        found = keep(staged(jaccard.jaccard_components(docs).where("doc_id <> component_id"), "duplicates"))
    return _without(docs.select(COLUMNS), found)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = passages.remove_repeats(docs.select(COLUMNS))
    return cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = leaks.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs.select(COLUMNS), staged(found, "leaks"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).where("taken > 0")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontaminate", decontaminate),
    ("mix", mix),
]

#: No SQL: the first stage is a trained model. ``tests/llm`` holds every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written to the scratch folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
