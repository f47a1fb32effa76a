"""Phrase collocations per language by best-first branch-and-bound growth.

A phrase of two to four words scores 2,000,000 * a / (l + r), rounded down: a occurrences against those
of its parts at the worst cut. A phrase that starts with the prefix p occurs at most f(p) times, its last
part at least as often as the phrase itself; so no phrase behind p scores above the least of
2,000,000 * f(p) / (f(first k words of p) + f(p)), for whatever k: counts of prefixes alone bound it.

1. Words are counted, then all pairs of words that occur often enough.
2. *Growth*: the prefixes of the frontier with the best bounds are expanded: one pass over the texts counts
   every phrase that is one word longer than an expanded one, on either side. That settles whether an expanded
   phrase survives (no longer phrase around it has nearly its count; if any has, one that is a word
   longer has) and puts the longer phrases on the frontier.
3. The ``top``-th surviving score of a language is its threshold. Growth goes on, with larger and larger
   batches, until no bound on the frontier reaches the threshold of its language; ties are expanded too.

A pass finds the words and phrases that matter by bitmaps of a fixed size (see ``marks``), whatever
the size of the vocabulary or of the frontier; they let a few other phrases through, whose counts are
right as well. Counting is a map-side combine and a shuffle on (language, phrase).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from payscope.llm.common import on_workers, released, slices, stored
from payscope.llm.marks import MAX_WORDS, Marks, chained, split_words, text_hash

TOP, MIN_COUNT = 2000, 30
SCALE, _BIN = 2_000_000, 1000
# A longer phrase with this share (in hundredths) of the count of one inside it replaces it.
COVER = 80
FIRST_BATCH, GROWTH = 4, 8
SLICE_BYTES = 3 << 20
_BLANK, _BREAK = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK


def _rows(lang: str, phrases: pa.Array, m: int, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.repeat(pa.scalar(lang), len(n)), phrases, pa.repeat(pa.scalar(m, pa.int32()), len(n)), pa.array(n, pa.int64())],
        names=["lang", "phrase", "m", "n"],
    )


def _by_lang(part: pa.RecordBatch) -> Iterator[tuple[str, list[str]]]:
    langs = part.column("lang").dictionary_encode()
    for k, lang in enumerate(langs.dictionary.to_pylist()):
        yield lang, part.column("text").filter(pc.equal(langs.indices, k)).to_pylist()


@released
def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text", SLICE_BYTES):
        for lang, texts in _by_lang(part):
            yield _Runs.words(split_words(texts, _KIND)[0]).rows(lang)


class _Runs:
    """Stretches of ``size`` words of a text batch: where each begins (in rising order) and which of the distinct
    ``phrases`` it is; ``n`` is how often each of these occurs."""

    def __init__(self, size: int, at: np.ndarray, codes: np.ndarray, n: np.ndarray, phrases: pa.Array) -> None:
        self.size, self.at, self.codes, self.n, self.phrases = size, at, codes, n, phrases

    @staticmethod
    def words(words: pa.DictionaryArray) -> "_Runs":
        codes = words.indices.to_numpy()
        n = np.bincount(codes, minlength=len(words.dictionary))
        return _Runs(1, np.arange(len(codes)), codes, n, words.dictionary)

    def longer(self, keep: np.ndarray, one: "_Runs") -> "_Runs":
        """Those numbered ``keep``, with the next word behind each."""
        at, k = self.at[keep], len(one.phrases)
        key = self.codes[keep].astype(np.int64) * k + one.codes[at + self.size]
        distinct, codes, n = np.unique(key, return_inverse=True, return_counts=True)
        parts = self.phrases.take(pa.array(distinct // k)), one.phrases.take(pa.array(distinct % k))
        return _Runs(self.size + 1, at, codes, n, pc.binary_join_element_wise(*parts, " "))

    def rows(self, lang: str) -> pa.RecordBatch:
        return _rows(lang, self.phrases, self.size, self.n)


def _count_phrases(common: Marks, expand: Marks | None, grown: Marks | None):
    """Counts pairs of common words (``expand=None``), or the phrases of three and four words whose first or
    last words but one are marked to be expanded. ``grown`` marks the pairs expanded so far, this time
    included; every phrase of three words on the frontier holds one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES):
            for lang, texts in _by_lang(part):
                words, begin, kinds = split_words(texts, _KIND)
                piece = np.cumsum(kinds == _BREAK, dtype=np.int32)[begin]
                one, n = _Runs.words(words), len(words)
                by_word = np.array([text_hash(w) for w in words.dictionary.to_pylist()], np.uint64)
                hashes = by_word[one.codes]
                begun = np.full(1, text_hash(lang), np.uint64)
                ok = common.has(chained(by_word, begun))[one.codes]
                # Whether a word and the next may stand in one phrase; none may at the end.
                joined = np.zeros(n + MAX_WORDS, bool)
                joined[: max(n - 1, 0)] = ok[:-1] & ok[1:] & (piece[:-1] == piece[1:])
                at = np.flatnonzero(joined)
                if expand is None:
                    yield one.longer(at, one).rows(lang)
                    continue
                twos = chained(hashes[at + 1], chained(hashes[at], begun))
                marked, held = np.zeros((2, n + MAX_WORDS), bool)
                marked[at], held[at] = expand.has(twos), grown.has(twos)
                code = np.zeros(n + MAX_WORDS, np.uint64)
                code[at] = twos
                three = joined & np.roll(joined, -1)
                yield _stretch(one, np.flatnonzero(three & (marked | np.roll(marked, -1))), 3).rows(lang)
                at = np.flatnonzero(three & (held | np.roll(held, -1)))
                marked[:] = False
                marked[at] = expand.has(chained(hashes[at + 2], code[at]))
                four = three & np.roll(joined, -2) & (marked | np.roll(marked, -1))
                yield _stretch(one, np.flatnonzero(four), 4).rows(lang)

    return released(run)


def _stretch(one: _Runs, at: np.ndarray, size: int) -> _Runs:
    """The stretches of ``size`` words that begin at these places."""
    found = one.longer(at, one)
    for _ in range(size - 2):
        found = found.longer(np.arange(len(at)), one)
    return found


def _summed(counted: DataFrame, min_count: int, name: str) -> DataFrame:
    total = F.sum("n").alias("n")
    return stored(counted.groupBy("lang", "phrase", "m").agg(total).where(F.col("n") >= min_count), name)


def _ratio(a: str, l: str, r: str) -> Column:
    """Exact at any size: the product may pass 64 bits."""
    return F.expr(f"CAST({SCALE} AS DECIMAL(20, 0)) * CAST({a} AS DECIMAL(18, 0)) div CAST({l} + {r} AS DECIMAL(20, 0))")


def _scored(new: DataFrame, counts: DataFrame) -> DataFrame:
    """lang, phrase, m, a, k, l, r, score, bound, missing for phrases (lang, phrase, m, n) of two words and more.

    ``counts`` holds the parts. Where one has not been counted, ``score`` is an upper bound, as if it occurred
    as often as the phrase, and ``missing`` names such parts. ``bound`` is of what begins with the phrase, itself included.
    """
    cuts = new.select("lang", "phrase", "m", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    cuts = cuts.withColumns({
        "left": F.expr("substring_index(phrase, ' ', k)"), "right": F.expr("substring_index(phrase, ' ', k - m)"),
    })
    for side in ("left", "right"):
        part = counts.select(F.col("lang"), F.col("phrase").alias(side), F.col("n").alias(f"n_{side}"))
        cuts = cuts.join(part, ["lang", side], "left")
    missing = F.filter(F.array(*[F.when(F.col(f"n_{s}").isNull(), F.col(s)) for s in ("left", "right")]), lambda x: x.isNotNull())
    cuts = cuts.withColumns({"missing": missing, "l": F.coalesce("n_left", "a"), "r": F.coalesce("n_right", "a")})
    each = cuts.withColumns({"score": _ratio("a", "l", "r"), "bound": _ratio("a", "l", "a")})
    rows = each.groupBy("lang", "phrase", "m", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.min(F.when(F.col("m") < MAX_WORDS, F.col("bound")).otherwise(F.col("score"))).alias("bound"),
        F.flatten(F.collect_list("missing")).alias("missing"),  # at most three cuts
    )
    return rows.select("lang", "phrase", "m", "a", "cut.*", "bound", "missing")


def _from_top(rows: DataFrame, value: Column, k: int) -> DataFrame:
    """lang, value, before: the greatest value of each language such that ``k`` rows have it or a greater one,
    and how many have a greater one. ``value`` must have a bounded number of values."""
    counted = rows.groupBy("lang", value.alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    order = W.partitionBy("lang").orderBy(F.desc("value"))
    summed = counted.withColumn("upto", F.sum("rows").over(order)).withColumn("before", F.col("upto") - F.col("rows"))
    return summed.where((F.col("upto") >= k) & (F.col("before") < k)).select("lang", "value", "before")


def _limits(surviving: DataFrame, top: int) -> dict[str, int]:
    """The ``top``-th score of each language that has so many, by two histograms of at most 1,001 bins a language."""
    bin_ = F.floor(F.col("score") / _BIN)
    # One row per language, here and in ``_cutoffs``.
    bins = {r["lang"]: (r["value"], r["before"]) for r in _from_top(surviving, bin_, top).collect()}
    inside = surviving.where(bin_ == _per_lang({k: v for k, (v, _) in bins.items()}))
    counted = inside.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("rows"))
    before = _per_lang({k: v for k, (_, v) in bins.items()})
    upto = before + F.sum("rows").over(W.partitionBy("lang").orderBy(F.desc("score")))
    best = counted.withColumn("upto", upto).where(F.col("upto") >= top).groupBy("lang").agg(F.max("score").alias("score"))
    return {r["lang"]: r["score"] for r in best.collect()}


def _cutoffs(frontier: DataFrame, batch: int) -> dict[str, int]:
    """A bound for each language with more than ``batch`` rows, about as many of which reach it."""
    found = _from_top(frontier, F.floor(F.col("bound") / _BIN), batch).collect()
    return {r["lang"]: r["value"] * _BIN for r in found}


def _per_lang(values: dict[str, int]) -> Column:
    """A language's value, null where it has none."""
    if not values:
        return F.lit(None).cast("long")
    found = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.try_element_at(found, F.col("lang")).cast("long")


def _first(rows: DataFrame, top: int, *order: Column) -> DataFrame:
    """The first ``top`` rows of each language with their rank; each task sends on no more than so many."""
    rank = F.row_number().over(W.partitionBy("lang").orderBy(*order))
    return rows.withColumn("rank", rank).where(F.col("rank") <= top)


def collocations(
    docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT, first_batch: int = FIRST_BATCH,
    text_col: str = "text", lang_col: str = "lang", log: list | None = None,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best surviving phrases.

    ``first_batch`` times ``top`` prefixes a language are expanded first, ``GROWTH`` times as many in each
    following round; ``log`` receives the number expanded by each. A null text is empty, a null language
    ``und``; repeated rows count each for itself, phrases never span texts. Ties go by score, count, then phrase.
    A language with fewer phrases has fewer rows; an empty table gives an empty result. Other columns are
    ignored; ``docs`` should be a stored table, as it is read once a round.
    """
    spark = docs.sparkSession
    on_workers(spark)
    texts = docs.select(
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
    )
    schema = "lang string, phrase string, m int, n long"
    words = _summed(texts.mapInArrow(_count_words, schema), 1, "words")
    totals = stored(words.groupBy("lang").agg(F.sum("n").alias("total")), "totals")
    counts = words.where(F.col("n") >= min_count)
    common = Marks.of(counts)
    new = _summed(texts.mapInArrow(_count_phrases(common, None, None), schema), min_count, "phrases")
    counts = counts.unionByName(new)
    scored = stored(_scored(new, counts), "scored")
    # Candidates whose longer phrases have not been counted, and those that survive, both without what no
    # longer can be among the ``top``.
    pool = stored(_scored(new, counts), "scored")
    surviving = pool.limit(0)
    grown, batch = Marks(np.zeros_like(common.bits)), first_batch * top
    while True:
        pool = pool.where(F.col("bound") >= F.coalesce(_per_lang(limits := _limits(surviving, top)), F.lit(0)))
        chosen = F.col("bound") >= F.coalesce(_per_lang(_cutoffs(pool, batch)), F.lit(0))
        best = stored(pool.where(chosen), "best")
        if log is not None:
            log.append(best.count())
        if best.isEmpty():
            break
        # The other three words of a four-word phrase are a part to be counted too: with three words both pairs
        # in them grow. Where a part is missing all the same, its first two words grow.
        pairs = F.array(F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2))
        parts = F.transform("missing", lambda x: F.substring_index(x, " ", 2))
        frontier = best.where(F.col("m") < MAX_WORDS).select("lang", "phrase").unionByName(
            best.where(F.col("m") == 3).select("lang", F.explode(pairs).alias("phrase"))
        ).unionByName(best.select("lang", F.explode(parts).alias("phrase")))
        marks = Marks.of(frontier)
        grown = grown | marks
        found = _summed(texts.mapInArrow(_count_phrases(common, marks, grown), schema), min_count, "phrases")
        # What each phrase says about the two that are a word shorter.
        inside = F.array(F.expr("substring_index(phrase, ' ', m - 1)"), F.expr("substring_index(phrase, ' ', 1 - m)"))
        covers = found.select("lang", F.explode(inside).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("cover"))
        settled = best.where(F.col("m") < MAX_WORDS).join(covers, ["lang", "phrase"], "left").where(
            F.coalesce(100 * F.col("cover") < COVER * F.col("a"), F.lit(True))
        ).drop("cover")
        longer = counts.where("m > 2").select("lang", "phrase")
        fresh = stored(found.join(longer, ["lang", "phrase"], "left_anti").select("lang", "phrase", "m", "n"), "fresh")
        counts = counts.unionByName(fresh)
        again = best.where(F.size("missing") > 0).select("lang", "phrase", "m", F.col("a").alias("n"))
        scored = stored(_scored(fresh.unionByName(again), counts), "scored")
        whole = (F.col("m") == MAX_WORDS) & (F.size("missing") == 0)
        surviving = stored(
            surviving.where(F.col("score") >= F.coalesce(_per_lang(limits), F.lit(0)))
            .unionByName(settled).unionByName(scored.where(whole)), "surviving"
        )
        pool = stored(pool.where(~chosen).unionByName(scored.where(~whole)), "pool")
        batch *= GROWTH
    surviving = surviving.where(F.col("score") >= F.coalesce(_per_lang(limits), F.lit(0)))
    ranked = _first(surviving, top, F.desc("score"), F.desc("a"), F.col("phrase"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )
