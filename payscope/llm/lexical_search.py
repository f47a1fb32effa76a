"""Ranked lexical search by NRA: sequential reads of impact-sorted lists, no random access.

1. *Index*: a posting (term, document, impact) for every query term of every document. Impact is what an
   occurrence count and a document's length give, a whole number; times the weight of the term it is the
   term's part of a score, for every query. Each list is cut by falling impact into blocks of about
   ``BLOCK`` postings, then ``GROWTH`` times as many, and so on; histograms of impacts give the borders, so
   no list is gathered or sorted as a whole. Blocks of one number are stored together.
2. *Rounds*: round r reads block r of every list of the queries at work. A (query, document) seen has
   a lower bound, the sum of the parts read, and an upper bound, which adds for each other term of the query the
   best impact that its list still holds unread.
3. A query whose unread lists together cannot reach its k-th best lower bound takes no new documents: from then
   on, of what is read only the documents it holds matter. Documents whose upper bound lies below
   the k-th lower bound are let go; equality stays, because ties count.
4. A query is done when every document it still holds has equal bounds: membership, ties and scores are
   final. The others go on to the next block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from payscope.llm.common import on_workers, released, scratch, slices, spread_join, stored
from payscope.llm.marks import Marks, chained, split_words, text_hash

K, BLOCK, GROWTH = 10, 1024, 8
SLICE_BYTES = 2 << 20
# Fixed by the score: parts of a thousand for weights, of a million for impacts; share of the length.
WEIGHT, IMPACT, SHARE, PULL = 1000, 1_000_000_000, 90, 8
_BIN = 1 << 13
_WORD = np.ones(256, np.uint8)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 0
_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _postings(wanted: Marks):
    """Rows (row, doc_id, term, tf, n) for words that may be query terms; a row without a term
    gives the number of documents with words (tf) and of their words (n) of a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun = np.full(1, text_hash(""), np.uint64)
        for part in slices(batches, "text", SLICE_BYTES):
            sizes = pc.binary_length(part.column("text")).to_numpy()
            words, begin, _ = split_words(part.column("text").to_pylist(), _WORD)
            ends = np.cumsum(sizes.astype(np.int64) + 1)
            doc = np.searchsorted(ends, begin, "right")
            n = np.bincount(doc, minlength=len(sizes))
            by_term = np.array([text_hash(w) for w in words.dictionary.to_pylist()], np.uint64)
            codes, k = words.indices.to_numpy(), len(words.dictionary)
            keep = wanted.has(chained(by_term, begun))[codes]
            key, tf = np.unique(doc[keep] * k + codes[keep], return_counts=True)
            at = key // max(k, 1)
            yield pa.RecordBatch.from_pydict({
                "row": part.column("row").take(pa.array(at)),
                "doc_id": part.column("doc_id").take(pa.array(at)),
                "term": words.dictionary.take(pa.array(key % max(k, 1))),
                "tf": pa.array(tf, pa.int64()),
                "n": pa.array(n[at], pa.int64()),
            })
            one = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.string())]
            one += [pa.array([int(x)], pa.int64()) for x in ((n > 0).sum(), n.sum())]
            yield pa.RecordBatch.from_arrays(one, names=["row", "doc_id", "term", "tf", "n"])

    return released(run)


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Stored rows (item, item_id, term), an item for each row of ``queries``, its terms once each."""
    text = F.translate(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = F.array_distinct(F.filter(F.split(text, _TERM), lambda x: x != ""))
    rows = queries.select(F.monotonically_increasing_id().alias("item"), F.col(f"`{id_col}`").alias("item_id"), terms.alias("terms"))
    return stored(rows.select("item", "item_id", F.explode("terms").alias("term")), "query-terms")


class Index:
    """Impact-sorted lists of the terms of some queries, in numbered blocks."""

    def __init__(self, docs: DataFrame, terms: DataFrame, block: int, growth: int) -> None:
        """``docs``: doc_id and text; ``terms``: the distinct terms to index, in a stored table."""
        spark = docs.sparkSession
        schema = "row long, doc_id long, term string, tf long, n long"
        marks = Marks.of(terms.select(F.lit("").alias("lang"), F.col("term").alias("phrase")))
        found = stored(
            docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(_postings(marks), schema), "term-counts"
        )
        n_docs, n_words = found.where("term IS NULL").agg(F.sum("tf"), F.sum("n")).first()
        self.n_docs, self.n_words = n_docs or 0, n_words or 0
        m = 100 - SHARE + F.expr(f"({SHARE} * n * {self.n_docs}L) div {max(self.n_words, 1)}L")
        impact = F.expr(f"({IMPACT} * tf) div (1000 * tf + {PULL} * m)")
        rows = found.where("term IS NOT NULL").withColumn("m", m).select("row", "doc_id", "term", impact.alias("x"))
        bins = rows.groupBy("term", F.floor(F.col("x") / _BIN).alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.max("x").alias("top")
        )
        # At most 123 bins a term.
        order = W.partitionBy("term").orderBy(F.desc("bin"))
        before = F.sum("n").over(order) - F.col("n")
        level = F.when(before < block, 0).otherwise(
            1 + F.floor(F.log(before.cast("double") / block) / F.log(F.lit(float(growth))) + 1e-9)
        ).cast("int")
        blocks = stored(bins.withColumn("level", level), "impact-bins")
        by_level = blocks.groupBy("term", "level").agg(F.max("top").alias("top"), F.min("bin").alias("bin"), F.sum("n").alias("n"))
        lists = by_level.groupBy("term").agg(
            F.sum("n").alias("df"),
            F.sort_array(F.collect_list(F.struct("level", "top", "bin"))).alias("blocks"),  # as many as an impact has levels
        )
        ratio = F.lit(2.0 * self.n_docs + 2.0) / (2.0 * F.col("df") + 1.0)
        weight = F.floor(WEIGHT * F.log(ratio)).cast("long")
        # One row per indexed term.
        self.lists = stored(lists.join(terms, "term", "left_semi").select("term", "df", weight.alias("w"), "blocks"), "lists")
        placed = spread_join(rows, self.lists.where("w > 0").select("term", "df", "w", "blocks"), ["term"], "df", F.col("row"))
        bin_ = F.floor(F.col("x") / _BIN)
        level = F.filter("blocks", lambda b: b["bin"] <= bin_)[0]["level"]
        self.path = scratch(spark, "impact-lists")
        self.schema = "term string, row long, doc_id long, part long, level int"
        placed.where("w IS NOT NULL").select(
            "term", "row", "doc_id", (F.col("w") * F.col("x")).alias("part"), level.alias("level")
        ).write.partitionBy("level").option("compression", "zstd").parquet(self.path)
        self.levels = (by_level.agg(F.max("level")).first()[0] or 0) + 1
        self.spark = spark

    def block(self, level: int) -> DataFrame:
        """term, row, doc_id, part: the ``level``-th block of every list; only its files are read."""
        return self.spark.read.schema(self.schema).parquet(self.path).where(F.col("level") == level).drop("level")


def _unread(blocks: Column, weight: Column, level: int) -> Column:
    """The best part that a list holds beyond block ``level``."""
    rest = F.filter(blocks, lambda b: b["level"] > level)
    return F.coalesce(F.try_element_at(rest, F.lit(1))["top"] * weight, F.lit(0).cast("long"))


def search(
    docs: DataFrame, queries: DataFrame, k: int = K, block: int = BLOCK, growth: int = GROWTH,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    log: list | None = None,
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each row of ``queries``, those above 0.

    Equal scores come by ascending document id, null ids first; rows that share an id are documents of their own.
    Null and empty texts hold no term, and a query without a term of any document has no rows. Repeated queries
    have their rows each. Texts are read whole; empty tables give empty results; other columns are ignored.
    ``log`` receives (round, queries at work, documents they hold).
    """
    spark = docs.sparkSession
    on_workers(spark)
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    )
    terms = query_terms(queries, item_col, item_text_col)
    index = Index(rows, stored(terms.select("term").distinct(), "terms"), block, growth)
    place = F.row_number().over(W.partitionBy("item").orderBy("term")) - 1
    pairs = stored(
        terms.join(index.lists.where("w > 0"), "term").withColumn("place", place)
        .select("item", "item_id", "term", "place", "w", "blocks"), "pairs",
    )
    key = ["item", "row", "doc_id"]
    held = spark.createDataFrame([], "item long, row long, doc_id long, low long, seen array<int>")
    # Queries at work, and whether they take new documents.
    working = stored(pairs.select("item").distinct().withColumn("open", F.lit(True)), "working")
    done: list[DataFrame] = []
    level = 0
    while not working.isEmpty():
        asked = pairs.join(working, "item").select("item", "term", "place", "open")
        read = index.block(level)
        fresh = read.join(asked.where("open"), "term").select(*key, "part", "place")
        if level:
            known = read.drop("doc_id").join(held.join(working.where("NOT open"), "item").select(*key), "row")
            fresh = fresh.unionByName(known.join(asked, ["item", "term"]).select(*key, "part", "place"))
        parts = fresh.select(*key, F.col("part").alias("low"), F.array("place").alias("seen"))
        seen = held.unionByName(parts).groupBy(*key).agg(F.sum("low").alias("low"), F.flatten(F.collect_list("seen")).alias("seen"))
        best = pairs.join(working, "item").groupBy("item").agg(
            F.sort_array(F.collect_list(F.struct("place", _unread(F.col("blocks"), F.col("w"), level).alias("top")))).alias("tops")
        ).select("item", F.col("tops.top").alias("tops"))  # as many as the query has terms
        every = F.aggregate("tops", F.lit(0).cast("long"), lambda a, x: a + x)
        best = stored(best.withColumn("unread", every), "unread")
        other = F.col("unread") - F.aggregate("seen", F.lit(0).cast("long"), lambda a, i: a + F.get("tops", i))
        bounded = stored(seen.join(best, "item").withColumn("high", F.col("low") + other).drop("tops", "unread"), "bounds")
        order = W.partitionBy("item").orderBy(F.desc("low"))
        kth = bounded.select("item", "low").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        kth = kth.where(F.col("rank") == k).select("item", F.col("low").alias("kth"))
        limits = stored(best.join(kth, "item", "left").select("item", "unread", F.coalesce("kth", F.lit(0)).alias("kth")), "limits")
        left = bounded.join(limits, "item").where("high >= kth")
        # With fewer than k documents whatever is unread may enter.
        states = limits.join(
            left.groupBy("item").agg(F.count_if(F.col("low") != F.col("high")).alias("loose")), "item", "left"
        ).select("item", ((F.col("unread") > 0) & (F.col("unread") >= F.col("kth"))).alias("open"), F.coalesce("loose", F.lit(0)).alias("loose"))
        states = stored(states, "states")
        ended = states.where("NOT open AND loose = 0").select("item")
        done.append(stored(left.join(ended, "item").select(*key, "low"), "settled"))
        working = states.where("open OR loose > 0").select("item", "open")
        held = stored(left.join(working, "item", "left_semi").select(*key, "low", "seen"), "held")
        if log is not None:
            log.append((level, working.count(), held.count()))
        level += 1
    if not done:
        return spark.createDataFrame([], f"item_id {dict(queries.dtypes)[item_col]}, rank int, doc_id long, score long")
    settled = done[0]
    for more in done[1:]:
        settled = settled.unionByName(more)
    rank = F.row_number().over(W.partitionBy("item").orderBy(F.desc("low"), F.asc_nulls_first("doc_id"), "row"))
    top = settled.withColumn("rank", rank).where((F.col("rank") <= k) & (F.col("low") > 0))
    return top.join(pairs.select("item", "item_id").distinct(), "item").select("item_id", "rank", "doc_id", F.col("low").alias("score"))
