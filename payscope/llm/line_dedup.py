"""Boilerplate lines: lines that stand on many distinct sites. DataFrame functions only.

1. Each line hash gets a HyperLogLog sketch of its sites, built per task and merged by aggregation, so
   a line in a third of all documents sends one sketch per task.
2. Lines estimated clearly below the threshold are done with, lines clearly above it are boilerplate.
3. Lines within three standard errors of it get an exact count of distinct sites, over rows that are
   first made distinct by (line, site).
4. The positions of boilerplate lines are found by a join on the line hash and taken out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.llm.common import spread_join, stored

MIN_SITES, LOG_REGISTERS = 10, 8
_LINE = ["h", "h2"]


def _lines(docs: DataFrame) -> DataFrame:
    """A row per line that is not blank; its two hashes, 96 bits together, stand for it."""
    each = docs.select("doc_id", "text_hash", "site", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    line = F.trim("line")
    return each.where(line != "").select(
        "doc_id", "text_hash", "site", "pos", F.xxhash64(line).alias("h"), F.hash(line).alias("h2")
    )


def boilerplate(lines: DataFrame, min_sites: int, log_registers: int = LOG_REGISTERS) -> DataFrame:
    """h, h2, n (rows) of the lines on at least ``min_sites`` distinct sites."""
    error = 3 * 1.04 / (1 << log_registers) ** 0.5
    low, high = min_sites * (1 - error), min_sites * (1 + error)
    sketched = lines.groupBy(*_LINE).agg(
        F.hll_sketch_agg("site", F.lit(log_registers)).alias("sketch"), F.count(F.lit(1)).alias("n")
    )
    spread = stored(
        sketched.select(*_LINE, "n", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= low),
        "line-sketches",
    )
    near = spread.where(F.col("sites") < high)
    pairs = lines.where("site IS NOT NULL").select(*_LINE, "site").distinct()
    exact = (
        pairs.join(near.select(*_LINE, "n"), _LINE).groupBy(*_LINE, "n").agg(F.count("site").alias("sites"))
        .where(F.col("sites") >= min_sites)
    )
    clear = spread.where(F.col("sites") >= high)
    return stored(clear.select(*_LINE, "n").unionByName(exact.select(*_LINE, "n")), "boilerplate")


def line_dedup(
    docs: DataFrame, min_sites: int = MIN_SITES, site: Column | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, n_lines, n_removed, text for every row; ``site`` is ``source`` unless given.

    Lines are compared without blanks at their ends; blank lines are never removed. A null site
    counts as none. Null texts are empty and have one empty line; repeated rows give equal rows; other
    columns are ignored.
    """
    docs = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        (F.col("source") if site is None else site).cast("string").alias("site"),
    ).withColumn("text_hash", F.xxhash64("text"))
    lines = _lines(docs)
    found = boilerplate(lines, min_sites)
    rows = lines.select("doc_id", "text_hash", "pos", *_LINE)
    met = spread_join(rows, found, _LINE, "n", F.struct("doc_id", "pos")).where("n IS NOT NULL")
    gone = met.groupBy(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).agg(
        F.collect_set("pos").alias("gone")
    )
    on = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("text_hash") == F.col("gone_hash"))
    split = F.split("text", "\n")
    kept = F.filter(split, lambda _, i: ~F.array_contains("gone", i))
    return docs.join(gone, on, "left").select(
        "doc_id", F.size(split).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
    )
