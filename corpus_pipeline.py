"""The corpus pipeline: quality, near duplicates, test items, secrets, mixing."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from pricepanel.llm import decontaminate, mixing, neardup, quality, secrets
from pricepanel.session import saved, ship

#: The classifier and the unions of links cannot be written in SQL.
ORACLE_SQL = None


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labels of the documents
    at hand."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8."""
    return neardup.keep_one(docs, k=5, percent=80)


def untested(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without test items."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking secrets replaced."""
    return secrets.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the words it takes of each (repeats counted); rows of
    one id are documents of their own."""
    try:
        keyed = with_place(docs)
    except AnalysisException:  # not read from files
        keyed = with_place(saved(docs, "mix-documents"))
    taken = mixing.mix(keyed, row_col="_place").select(F.col("_place").alias("_of"), "target", "taken").where(F.col("taken") > 0)
    return keyed.drop("target", "taken").join(taken, F.col("_place") == F.col("_of")).drop("_place", "_of")


def with_place(docs: DataFrame) -> DataFrame:
    """The documents with the place of each row in its file, which is the same in every reading."""
    return docs.select("*", F.struct(F.xxhash64("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")).alias("_place"))


STAGES = [("quality", good), ("near duplicates", unique), ("test items", untested), ("secrets", without_secrets), ("mix", mixed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), "pipeline")
    return docs
