"""A training corpus from ``documents``: five stages, each an operator of ``payscope.llm``.

A stage takes (spark, docs, sf_dir), works on every document that its predecessor kept, and returns the
columns of ``documents`` for those it keeps; the last returns the packed sequences' pieces. ``docs`` must be a
stored table, as stages read it more than once. Rows are decided on one by one: ids may be null or repeated, whole
rows too. Empty tables give empty results; further columns are carried along by all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payscope.llm.common import scratch, spread_join, stored, table
from payscope.llm.decontaminate import decontaminate
from payscope.llm.exact_dedup import exact_dedup
from payscope.llm.near_join import near_join
from payscope.llm.packing import pack
from payscope.llm.quality import classify
from payscope.llm.queries import vocabulary


ROW = "__row"


def _numbered(docs: DataFrame) -> DataFrame:
    """Rows with a number of their own, the same each time a stored table is read; ids may be null or repeated."""
    return docs.withColumn(ROW, F.monotonically_increasing_id())


def _one_of_each(docs: DataFrame, groups: DataFrame, pick: Callable[[Column], Column]) -> DataFrame:
    """``docs`` without the rows of each group (ROW, group) but the one that ``pick`` takes by id, then by place."""
    members = stored(groups.join(docs.select(ROW, "doc_id"), ROW), "group-members")
    chosen = members.groupBy("group").agg(
        pick(F.struct("doc_id", ROW))[ROW].alias("stays"), F.count(F.lit(1)).alias("n")
    )
    chosen = stored(chosen.where("n > 1"), "group-choices")
    met = spread_join(members, chosen, ["group"], "n", F.col(ROW))
    dropped = met.where(F.col("stays") != F.col(ROW)).select(ROW)
    return docs.join(dropped, ROW, "left_anti").drop(ROW)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; of rows that share an id each is judged by its own text.
    Labels go by id, so none concerns a document without one."""
    return classify(docs, table(spark, sf_dir, "labels")).where("NOT __rejected").select(docs.columns)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the rows with one text (null: empty) that of the largest id: any id before none, one of equal rows.
    Other texts of the same id are untouched."""
    rows = _numbered(docs)
    found = exact_dedup(rows, id_col=ROW).where("group_size > 1")
    groups = found.select(F.col("doc_id").alias(ROW), F.col("keep_id").alias("group"))
    return _one_of_each(rows, groups, F.max).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of linked documents the one of the least id, one without an id before all; documents
    without words link to nothing and stay. Other texts of the same id are untouched."""
    rows = _numbered(docs)
    groups = near_join(rows, id_col=ROW).select(F.col("doc_id").alias(ROW), F.col("class_id").alias("group"))
    return _one_of_each(rows, groups, F.min).select(docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than a trace of the benchmark, each row by its own text; empty ones stay."""
    rows = _numbered(docs)
    found = decontaminate(rows, table(spark, sf_dir, "benchmark"), id_col=ROW).where("contaminated")
    return rows.join(found.select(F.col("doc_id").alias(ROW)), ROW, "left_anti").select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents and their places in sequences of 1024 tokens; an empty or null text is one piece."""
    return pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", copies),
    ("near duplicates", near_copies),
    ("benchmark decontamination", benchmark),
    ("best-fit packing", packing),
]
# Perplexity, MinHash pruning and tokenizing are beyond SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each one's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
