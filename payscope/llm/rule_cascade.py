"""Quality rules as a short-circuit cascade. DataFrame functions only.

1. *Sample*: about ``sample_rows`` rows are drawn and stored with their words, lines and measures.
2. *Estimates*: every rule runs over the sample by itself; the time it takes beyond a run without a rule
   is its cost, and one aggregation tells how many rows fail each combination of rules.
3. *Order*: the rule with the most rejections per cost comes first; then the one with the most among
   the rows that the first lets through, and so on.
4. *Cascade*: one conditional expression per row, so a rule is evaluated only for rows that have passed
   all rules before it.

A row is kept if it passes every rule, so the sample decides what the cascade costs and never what it
keeps.
"""

from __future__ import annotations

import time
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.llm.common import stored

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS, SEED, RUNS = 2000, 11, 2
MIN_WORDS, MAX_REPEATED = 50, 50
WORDS, LINES = "__words", "__lines"


@dataclass(frozen=True)
class Rule:
    """``passes`` is a condition over the text, the prepared columns and the measures; null counts as failed."""

    name: str
    passes: Column


def prepared(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with ``__text`` (null: empty), its words and its lines that hold a word."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    docs = docs.withColumn("__text", text)
    bare = F.btrim("__text", F.lit(SPACES))
    none = F.array().cast("array<string>")
    return docs.withColumns({
        WORDS: F.when(bare == "", none).otherwise(F.split(bare, r"[\x20\x09-\x0D]+")),
        LINES: F.filter(F.split("__text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != ""),
    })


def with_measures(docs: DataFrame) -> DataFrame:
    """Prepared rows with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    Where two windows of three words have one hash, the windows of the text are sorted as they stand, each
    with its place, and those equal to a neighbour occur more than once.
    """
    n, text = F.size(WORDS), F.col("__text")
    after = [F.slice(WORDS, k, F.greatest(n - 2, F.lit(0))).alias(f"w{k}") for k in (1, 2, 3)]
    rows = docs.withColumns({
        "n_words": n.cast("long"),
        "word_chars": F.length(F.array_join(WORDS, "")).cast("long"),
        "n_symbols": F.when(
            text.rlike("[#*$%&|<>]"), F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
        ).otherwise(0).cast("long"),
        "n_dup_lines": (F.size(LINES) - F.size(F.array_distinct(LINES))).cast("long"),
        "__threes": F.arrays_zip(*after),
    })
    hashes = F.transform("__threes", lambda x: F.xxhash64(x["w1"], x["w2"], x["w3"]))
    placed = F.transform(
        "__threes", lambda x, i: F.struct(F.concat_ws(" ", x["w1"], x["w2"], x["w3"]).alias("w"), i.alias("i"))
    )
    alike = F.size(F.array_distinct(hashes)) < F.size("__threes")
    rows = rows.withColumn("__windows", F.when(alike, F.sort_array(placed)))
    # Each window beside the one that follows it: both occur again if they are equal.
    pairs = F.arrays_zip(
        F.col("__windows").alias("a"), F.slice("__windows", 2, F.greatest(F.size("__windows"), F.lit(0))).alias("b")
    )
    equal = F.filter(pairs, lambda x: F.coalesce(x["a"]["w"] == x["b"]["w"], F.lit(False)))
    places = F.array_distinct(F.flatten(F.transform(equal, lambda x: F.array(x["a"]["i"], x["b"]["i"]))))
    rows = rows.withColumn("__again", F.sort_array(places))
    gaps = F.zip_with(
        "__again", F.slice("__again", 2, F.greatest(F.size("__again"), F.lit(0))),
        lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)).cast("long"),
    )
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop(
        "__threes", "__windows", "__again"
    )


def base_failed() -> Column:
    """Too few words, or more than half of them in windows that recur."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def prose_rules() -> list[Rule]:
    """Rules for prose in languages that are written with blanks, in whole numbers."""
    n, lines = F.col("n_words"), F.size(LINES)
    upper = F.regexp_count("__text", F.lit("[A-Z]"))
    letters = F.length(F.regexp_replace("__text", "[^A-Za-z]+", ""))

    def words(pattern: str) -> Column:
        return F.size(F.filter(WORDS, lambda w: w.rlike(pattern)))

    def lines_with(pattern: str) -> Column:
        return F.size(F.filter(LINES, lambda x: x.rlike(pattern)))

    return [
        Rule("mean word length from 2 to 12", F.col("word_chars").between(2 * n, 12 * n)),
        Rule("at most a symbol in ten words", 10 * F.col("n_symbols") <= n),
        Rule("at most three repeated lines in ten", 10 * F.col("n_dup_lines") <= 3 * lines),
        Rule("at least seven words in ten with a letter", 10 * words(r"[A-Za-z\x{80}-\x{10FFFF}]") >= 7 * n),
        Rule("at most three words in ten before exclamation marks", 10 * words(r"!\z") <= 3 * n),
        Rule("at most half of the letters capitals", 2 * upper <= letters),
        Rule("at most three lines in ten cut off by dots", 10 * lines_with(r"(\.\.\.|\x{2026})\z") <= 3 * lines),
        Rule("at most nine lines in ten behind bullets", 10 * lines_with(r"\A[\x20\t]*[-*\x{2022}]") <= 9 * lines),
    ]


def _seconds(rows: DataFrame) -> float:
    """Least time of a few runs of a one-row aggregate."""
    took = []
    for _ in range(RUNS):
        began = time.perf_counter()
        rows.collect()
        took.append(time.perf_counter() - began)
    return min(took)


def ordered(sample: DataFrame, rules: list[Rule]) -> list[Rule]:
    """Rules by rejections per cost, each among the sample rows that those before it let through."""
    if not rules:
        return []
    fails = [~F.coalesce(r.passes, F.lit(False)) for r in rules]
    plain = _seconds(sample.agg(F.count_if(F.size(WORDS) < 0)))
    costs = [max(_seconds(sample.agg(F.count_if(f))) - plain, 1e-3) for f in fails]
    # At most as many rows as the sample has.
    patterns = sample.select(F.array(*fails).alias("fails")).groupBy("fails").count().collect()
    return _greedy(rules, costs, [(p["fails"], p["count"]) for p in patterns])


def _greedy(rules: list[Rule], costs: list[float], patterns: Iterable[tuple[list[bool], int]]) -> list[Rule]:
    left, found, patterns = list(range(len(rules))), [], list(patterns)
    while left:
        caught = {k: sum(n for fails, n in patterns if fails[k]) for k in left}
        best = max(left, key=lambda k: (caught[k] / costs[k], -costs[k]))
        left.remove(best)
        found.append(rules[best])
        patterns = [(fails, n) for fails, n in patterns if not fails[best]]
    return found


def drawn(docs: DataFrame, text_col: str, sample_rows: int, seed: int = SEED) -> DataFrame:
    """A stored sample of about ``sample_rows`` rows; only the text is read. ``docs`` should be a stored table."""
    total = max(docs.count(), 1)
    texts = docs.select(F.col(f"`{text_col}`").alias("text"))
    sample = with_measures(prepared(texts.sample(min(1.0, sample_rows / total), seed), "text"))
    return stored(sample, "rule-sample")


def cascade(
    docs: DataFrame, rules: list[Rule] | None = None, first: Column | None = None,
    sample_rows: int = SAMPLE_ROWS, text_col: str = "text",
) -> DataFrame:
    """Every row and column of ``docs``, the five measures, ``base_failed``, ``kept`` and ``failed_rule``,
    the first rule that the row fails in the order that the sample gives, null for kept rows.

    ``first`` (default: the base rule of ``base_failed``) is decided before the cascade. A null text is
    empty and fails the base rule, as an empty one and any text of less than fifty words do. Texts of any
    length are taken whole; repeated rows are judged alike; an empty table gives an empty result. Columns
    of ``docs`` with the names of new ones are replaced.
    """
    rules = prose_rules() if rules is None else rules
    inner = ["__text", WORDS, LINES]
    own = [
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "failed_rule", *inner, "__threes", "__windows", "__again",
    ]
    sample = drawn(docs, text_col, sample_rows)
    docs = docs.withColumnRenamed(text_col, "__given").drop(*[c for c in own if c != text_col])
    rows = with_measures(prepared(docs, "__given")).withColumnRenamed("__given", text_col)
    rows = rows.withColumn("base_failed", base_failed() if first is None else F.coalesce(first, F.lit(True)))
    failed = F.when(F.col("base_failed"), F.lit("base"))
    for rule in ordered(sample, rules):
        failed = failed.when(~F.coalesce(rule.passes, F.lit(False)), F.lit(rule.name))
    return rows.withColumn("failed_rule", failed).withColumn("kept", F.col("failed_rule").isNull()).drop(*inner)
