"""Exact duplicates through an extendible-hash index on shared files. DataFrame functions only.

1. *Chains.* Rows meet by 64-bit hash and bytes: texts of one hash are told apart by comparing their
   bytes, and each distinct text becomes one chain node (least sum: keeper and row count). The rows of
   a text are combined on the map side first, so a text on a third of all rows is shuffled once per
   map task.
2. *Directory.* The top bits of the hash name a bucket. The directory starts with one bucket and is
   doubled as long as a bucket that holds more than ``bucket_rows`` nodes can be split; a bucket
   keeps the depth at which it stopped splitting, so several directory cells may share it.
3. *Index files.* Owner tasks take ranges of (bucket, key), number the nodes that chain behind one
   key, and write their pages to the shared folder.
4. *Look-up.* Each row finds its node by key and digest; heavy nodes go by broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from payscope.llm.common import picked, scratch, spread_join, stored, tasks

MAX_DEPTH = 16


@dataclass(frozen=True)
class Index:
    """``pages``: bucket, key, chain, text_sha256, n_bytes, keep_id, group_size;
    ``directory``: cell, bucket, depth; ``depth``: the global depth."""

    pages: DataFrame
    directory: DataFrame
    depth: int


def _key(text: Column, key_bits: int) -> Column:
    return F.shiftleft(F.shiftrightunsigned(F.xxhash64(text), 64 - key_bits), 64 - key_bits)


def _doubled(counts: dict[int, int], bucket_rows: int) -> dict[int, tuple[int, int]]:
    """cell -> (bucket, local depth). ``counts`` has the nodes per cell of the greatest depth."""
    directory, depth = {0: (0, 0)}, 0
    while True:
        full: dict[int, int] = {}
        for cell, n in counts.items():
            prefix = cell >> (MAX_DEPTH - depth)
            full[directory[prefix][0]] = full.get(directory[prefix][0], 0) + n
        over = {b for b, n in full.items() if n > bucket_rows}
        if not over or depth == MAX_DEPTH:
            return directory
        # Twice the cells; only an overfull bucket gets two buckets for its two halves.
        spare, grown, halves = len({b for b, _ in directory.values()}), {}, {}
        for cell in range(2 << depth):
            bucket, local = directory[cell >> 1]
            if bucket in over and cell & 1:
                if bucket not in halves:
                    halves[bucket], spare = spare, spare + 1
                grown[cell] = (halves[bucket], depth + 1)
            else:
                grown[cell] = (bucket, depth + 1 if bucket in over else local)
        directory, depth = grown, depth + 1


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    bucket_rows: int = 1_000_000, key_bits: int = 64,
) -> Index:
    """The index over all rows. ``key_bits`` below 64 shortens the hash, for tests of chaining."""
    spark = docs.sparkSession
    rows = picked(docs, id_col, text_col).withColumn("key", _key(F.col("text"), key_bits))
    nodes = rows.groupBy("key", "text").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    nodes = stored(
        nodes.select(
            "key", F.sha2("text", 256).alias("text_sha256"),
            F.octet_length("text").cast("long").alias("n_bytes"), "keep_id", "group_size",
        ),
        "exact-nodes",
    )
    cell = F.shiftrightunsigned("key", 64 - MAX_DEPTH)
    # At most 2^MAX_DEPTH rows, whatever the input.
    counts = {r[0]: r[1] for r in nodes.groupBy(cell.alias("c")).count().collect()}
    found = _doubled(counts, bucket_rows)
    depth = len(found).bit_length() - 1
    directory = spark.createDataFrame(
        [(c, b, d) for c, (b, d) in found.items()], "cell long, bucket int, depth int"
    )
    # One cell at depth 0; a shift by 64 would be a shift by nothing.
    at = F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")
    owned = nodes.withColumn("cell", at).join(F.broadcast(directory.drop("depth")), "cell")
    owned = owned.repartitionByRange(tasks(spark), "bucket", "key")
    chain = F.row_number().over(W.partitionBy("bucket", "key").orderBy("text_sha256")) - 1
    path = scratch(spark, "exact-index")
    owned.select(
        "bucket", "key", chain.alias("chain"), "text_sha256", "n_bytes", "keep_id", "group_size"
    ).write.parquet(path)
    return Index(spark.read.parquet(path), directory, depth)


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    bucket_rows: int = 1_000_000, key_bits: int = 64,
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, n_bytes, chain for every row.

    Of equal texts the row of the greatest id stays. A null text is an empty text. Rows that repeat
    both id and text are marked alike; a null id stays only where its text has no row with an id.
    Other columns are ignored; an empty table gives an empty result.
    """
    index = build_index(docs, id_col, text_col, bucket_rows, key_bits)
    rows = picked(docs, id_col, text_col).select(
        "doc_id", _key(F.col("text"), key_bits).alias("key"), F.sha2("text", 256).alias("text_sha256")
    )
    nodes = index.pages.select("key", "text_sha256", "keep_id", "group_size", "n_bytes", "chain")
    met = spread_join(rows, nodes, ["key", "text_sha256"], "group_size", F.col("doc_id"))
    return met.select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "n_bytes", "chain",
    )
