"""Passages of a benchmark in documents, through a positional inverted index. DataFrame functions only.

1. *Test phrases*: each item's windows of ``width`` consecutive words (one shorter window for a
   shorter item).
2. *Frequencies* of the test terms over all document words. A window with a term that no document
   has cannot occur.
3. *Index*: postings (document, term, position) of the two rarest terms of every window, with the
   words around the position, stored in the shared folder. A bitmap of fixed size, tested in the
   same code that splits the text, lets through few other words at any size of the benchmark.
4. *Intersection*: a posting of the rarest term, less the term's offset in the window, is a possible
   start; starts that the second rarest term confirms are compared word by word.

Terms are indexed in full lower case, which is coarser than the lower-casing of A-Z that decides; the
comparison in step 4 uses the latter.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from payscope.llm.common import picked, stored

# Fixed by the definition of a word: every ASCII character but digits and letters separates.
SEPARATORS = "".join(c for c in map(chr, range(128)) if c not in string.digits + string.ascii_letters)
SEPARATOR_RUN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WIDTH = 13
_SLOTS = 1 << 17


def words(text: Column) -> Column:
    """Words of a text as they stand; lower-casing does not move their borders."""
    bare = F.btrim(text, F.lit(SEPARATORS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SEPARATOR_RUN))


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else unchanged."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def phrases(benchmark: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """phrase, item_id, terms for each distinct window of each item."""
    items = benchmark.select(
        F.col(f"`{id_col}`").cast("string").alias("item_id"),
        words(lowered(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))).alias("words"),
    ).where(F.size("words") > 0)
    at = F.sequence(F.lit(1), F.greatest(F.size("words") - width + 1, F.lit(1)))
    cut = items.select("item_id", "words", F.explode(at).alias("at"))
    return cut.select(
        "item_id", F.slice("words", F.col("at"), F.lit(width)).alias("terms")
    ).distinct().select(F.xxhash64("item_id", "terms").alias("phrase"), "item_id", "terms")


def _slots(term: Column) -> list[Column]:
    code = F.xxhash64(term)
    return [F.pmod(code, F.lit(_SLOTS)), F.pmod(F.shiftright(code, 32), F.lit(_SLOTS))]


def _maybe_one_of(terms: DataFrame, term: Column) -> Column:
    """True for every term of ``terms`` (one column) and few others; ``_SLOTS`` bytes at any size."""
    found = terms.select(F.explode(F.array(*_slots(F.col(terms.columns[0])))).alias("s")).distinct()
    marks = bytearray(_SLOTS)
    for (slot,) in found.collect():  # at most _SLOTS numbers
        marks[slot] = 1
    bitmap, one = F.lit(bytes(marks)), F.lit(b"\x01")
    first, second = (F.substr(bitmap, (s + 1).cast("int"), F.lit(1)) == one for s in _slots(term))
    return first & second


def _tokens(docs: DataFrame, terms: DataFrame, *context: Column) -> DataFrame:
    """doc_id, text_hash, pos, term, context for document words that may be one of the terms."""
    split = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("words"))
    each = split.select("*", F.posexplode("words").alias("pos", "word"))
    term = F.lower("word")
    return each.where(_maybe_one_of(terms, term)).select(
        "doc_id", "text_hash", "pos", term.alias("term"), *context
    )


def build_index(docs: DataFrame, terms: DataFrame, width: int) -> DataFrame:
    """Stored postings of the given terms: doc_id, text_hash, term, pos, before, around.

    ``around`` holds the up to ``width - 1`` words on either side, ``before`` how many stand before.
    """
    before = F.least("pos", F.lit(width - 1))
    around = F.slice("words", F.col("pos") - before + 1, before + width)
    found = _tokens(docs, terms, before.alias("before"), around.alias("around"))
    return stored(found.join(terms.select(F.col("rare").alias("term")), "term", "left_semi"), "postings")


def ranked_phrases(docs: DataFrame, tests: DataFrame) -> DataFrame:
    """Phrases that may occur, with their two rarest terms and these terms' offsets."""
    terms = tests.select("phrase", F.posexplode("terms").alias("offset", "term")).withColumn(
        "term", F.lower("term")
    )
    vocabulary = stored(terms.select("term").distinct(), "test-terms")
    counts = stored(_tokens(docs, vocabulary).groupBy("term").agg(F.count(F.lit(1)).alias("n")), "term-counts")
    counted = terms.join(counts, "term", "left").groupBy("phrase").agg(
        F.min(F.coalesce("n", F.lit(0))).alias("least"),
        F.sort_array(F.collect_list(F.struct("n", "offset", "term"))).alias("rare"),
    )
    first, second = F.col("rare")[0], F.try_element_at("rare", F.lit(2))
    return tests.join(counted.where("least > 0"), "phrase").select(
        "phrase", "item_id", "terms",
        first["term"].alias("rare_a"), first["offset"].alias("offset_a"),
        F.coalesce(second["term"], first["term"]).alias("rare_b"),
        F.coalesce(second["offset"], first["offset"]).alias("offset_b"),
    )


def _inputs(docs, benchmark, width, id_col, text_col, item_col, item_text_col):
    docs = picked(docs, id_col, text_col)
    tests = stored(phrases(benchmark, item_col, item_text_col, width), "test-phrases")
    ranked = stored(ranked_phrases(docs, tests), "ranked-phrases")
    rare = stored(ranked.select(F.explode(F.array("rare_a", "rare_b")).alias("rare")).distinct(), "rare-terms")
    return docs, ranked, build_index(docs, rare, width)


def phrase_matches(index: DataFrame, ranked: DataFrame) -> DataFrame:
    """doc_id, text_hash, item_id, start, length of every occurrence of every phrase."""
    confirmed = index.join(
        ranked.select("phrase", F.col("rare_b").alias("term"), "offset_b"), "term"
    ).select("phrase", "doc_id", "text_hash", (F.col("pos") - F.col("offset_b")).alias("start"))
    starts = index.join(ranked.withColumnRenamed("rare_a", "term"), "term").select(
        "phrase", "item_id", "terms", "doc_id", "text_hash", "before", "around", "offset_a",
        (F.col("pos") - F.col("offset_a")).alias("start"),
    ).where("start >= 0 AND before >= offset_a")
    here = F.slice("around", F.col("before") - F.col("offset_a") + 1, F.size("terms"))
    same = F.transform(here, lambda w: lowered(w)) == F.col("terms")
    left, right = starts.where(same).alias("l"), confirmed.alias("r")
    on = (
        (F.col("l.phrase") == F.col("r.phrase")) & (F.col("l.start") == F.col("r.start"))
        & F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l.text_hash") == F.col("r.text_hash"))
    )
    return left.join(right, on, "left_semi").select(
        "doc_id", "text_hash", "item_id", "start", F.size("terms").alias("length")
    )


def proximity_matches(index: DataFrame, ranked: DataFrame, share: float = 0.8) -> DataFrame:
    """doc_id, text_hash, item_id, pos, n_near: places where the rarest term of a phrase has at least
    ``share`` of the phrase's distinct words around it, in any order; the phrase itself included."""
    near = index.join(ranked.withColumnRenamed("rare_a", "term"), "term").withColumn(
        "n_near", F.size(F.array_intersect(F.transform("around", lambda w: lowered(w)), "terms"))
    )
    wanted = F.ceil(F.lit(share) * F.size(F.array_distinct("terms")))
    return near.where(F.col("n_near") >= wanted).select("doc_id", "text_hash", "item_id", "pos", "n_near")


def matches(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, share: float = 0.8,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(exact phrase matches, proximity matches) of all documents."""
    _, ranked, index = _inputs(docs, benchmark, width, id_col, text_col, item_col, item_text_col)
    return phrase_matches(index, ranked), proximity_matches(index, ranked, share)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of ``docs``.

    A document word is hit if it lies in an occurrence of any window; a document is contaminated if
    at least one word in twenty is hit. Null or empty texts have no words; items without words are
    passed over; repeated rows give equal rows; rows that share an id are told apart by their text.
    Other columns are ignored.
    """
    docs, ranked, index = _inputs(docs, benchmark, width, id_col, text_col, item_col, item_text_col)
    found = stored(phrase_matches(index, ranked).distinct(), "phrase-matches")
    key = ["doc_id", "text_hash"]
    order = W.partitionBy(*key).orderBy("start", "length").rowsBetween(W.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    fresh = F.greatest(end - F.greatest("start", F.coalesce(F.max(end).over(order), "start")), F.lit(0))
    hits = (
        found.select(*key, "start", "length").distinct().withColumn("fresh", fresh)
        .groupBy(*key).agg(F.sum("fresh").alias("n_hit"))
    )
    items = found.groupBy(*key).agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    hit = hits.alias("h").join(
        items.alias("i"),
        F.col("h.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("h.text_hash") == F.col("i.text_hash")),
    ).select(F.col("h.doc_id").alias("hit_id"), F.col("h.text_hash").alias("hit_hash"), "n_hit", "items")
    hit = stored(hit, "hit-documents")
    sized = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"),
        F.size(words(F.col("text"))).cast("long").alias("n_words"),
    )
    on = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash"))
    no_items = F.array().cast("array<string>")
    return sized.join(hit, on, "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", no_items)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", no_items), ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) * 20 >= F.greatest("n_words", F.lit(1))).alias("contaminated"),
    )
