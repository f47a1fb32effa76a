"""Helpers shared by the operators: scratch tables, joins that survive hot keys, Arrow batches."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def on_workers(spark: SparkSession) -> None:
    """Python workers find this package where the session was not started with it on the path."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, or below the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    on_workers(spark)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a frame to the shared scratch folder and reads it back: cuts lineage and survives
    lost executors. Files are compressed with zstd to spare the shared folder."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    collected(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def collected(spark: SparkSession) -> None:
    """Has the driver collect its garbage: plans and task records of finished jobs fill its heap up to the limit
    otherwise, and Spark keeps their shuffle files until their plans are collected."""
    spark.sparkContext._jvm.System.gc()


def tasks(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def picked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` and ``text`` alone (null text: empty); all other columns are left behind."""
    on_workers(docs.sparkSession)
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def released(run: Callable) -> Callable:
    """A task over Arrow batches that, when it ends, gives its worker's free memory back to the system:
    workers outlive tasks and stages, and share their executor's memory with those of other stages."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # not glibc
                pass

    return wrapped


HOT_NODES = 1000
SLICE_ROWS = 1 << 15


def spread_join(
    rows: DataFrame, nodes: DataFrame, keys: list[str], weight: str, spread_by: Column
) -> DataFrame:
    """Left join of rows with the one node of their key, without gathering the rows of a hot key.

    ``weight`` is the number of rows a node meets. At most ``HOT_NODES`` nodes can weigh a
    ``HOT_NODES``-th part of all or more; these are broadcast, and their rows enter the shuffle
    under keys of their own, which no node has. ``nodes`` should be a stored table.
    """
    total = nodes.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    limit = max(HOT_NODES, -(-total // HOT_NODES))
    values = [c for c in nodes.columns if c not in keys]
    hot = nodes.where(F.col(weight) >= limit).select(
        *keys, *[F.col(c).alias(f"__hot_{c}") for c in values], F.lit(1).alias("__is_hot")
    )
    cold = nodes.where(F.col(weight) < limit).select(
        *[F.col(k).alias(f"__k_{k}") for k in keys], *values, F.lit(0).alias("__k_side")
    )
    met = rows.join(F.broadcast(hot), keys, "left").withColumn(
        "__side", F.when(F.col("__is_hot").isNull(), F.lit(0).cast("long"))
        .otherwise(F.xxhash64(spread_by).bitwiseOR(F.lit(1).cast("long")))
    )
    on = [F.col(k) == F.col(f"__k_{k}") for k in keys] + [F.col("__side") == F.col("__k_side")]
    return met.join(cold, on, "left").select(
        *[F.col(c) for c in rows.columns],
        *[F.coalesce(F.col(c), F.col(f"__hot_{c}")).alias(c) for c in values],
    )


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that the text in ``column`` of one is about ``limit`` bytes; whole rows, at most
    ``SLICE_ROWS``."""
    for batch in batches:
        texts = batch.column(column)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        start, size = 0, 0
        for i, n in enumerate(sizes):
            size += int(n)
            if size >= limit or i + 1 - start >= SLICE_ROWS:
                yield batch.slice(start, i + 1 - start)
                start, size = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the least node of its component.

    Rounds of "take the least label of all neighbours, then the label of the label", each stored
    in the shared folder, until nothing changes. A node of many neighbours is combined on the map
    side; labels are exchanged along edges, never gathered.
    """
    both = stored(
        edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), f"{name}-edges"
    )
    labels = stored(
        both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root"))
        .select(F.col("a").alias("node"), "root"),
        f"{name}-labels",
    )
    while True:
        near = (
            both.join(labels, both["b"] == labels["node"]).groupBy("a")
            .agg(F.min("root").alias("near")).select(F.col("a").alias("node"), "near")
        )
        nearer = labels.join(near, "node").select(
            "node", "root", F.least("root", "near").alias("new")
        )
        # The root's own label is at least as small: jump to it.
        jump = labels.select(F.col("node").alias("new"), F.col("root").alias("far"))
        step = nearer.join(jump, "new", "left").select(
            "node", "root", F.least("new", F.coalesce("far", "new")).alias("next")
        )
        step = stored(step, f"{name}-labels")
        labels = step.select("node", F.col("next").alias("root"))
        if step.where(F.col("root") != F.col("next")).isEmpty():
            return labels
