"""The combined feature table: all families side by side, one row per payment."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.operators import frequency
from payscope.operators.card import CARD, FULL_NUMBER
from payscope.operators.families import COMBINED, family_features, pick_inputs
from payscope.operators.geo import GEO, join_lookup
from payscope.operators.partner import PER_ID
from payscope.options import Options
from payscope.sources.schema import ID
from payscope.sources.tables import scratch_path

PARTNERS_PER_ID = PER_ID.columns[0]
# Repeated keys are marked in a bitmap of this many words of 64 bits, some 50 MB as a broadcast.
MARK_WORDS = 1 << 20


def assemble_features(
    payments: DataFrame,
    ruca: DataFrame,
    options: Options = Options(),
    mode: str = "single",
) -> DataFrame:
    """All families for every payment.

    ``mode="single"`` computes every family on the payment row itself and joins no family to
    another. It needs unique payment ids and fails with a clear error where one repeats.
    ``mode="join"`` builds the families apart and joins them by id; an id that occurs k times then
    gives every combination of its k rows in each family.
    """
    if mode == "single":
        result = _single_pass(payments, ruca, options)
    elif mode == "join":
        result = _joined(payments, ruca, options)
    else:
        raise ValueError(f"mode must be 'single' or 'join', not {mode!r}")
    return result if options.expose_card_number else result.drop(FULL_NUMBER)


def _joined(payments: DataFrame, ruca: DataFrame, options: Options) -> DataFrame:
    """The families joined by id. Each one's columns pass the joins as one struct, which these copy in one
    piece; taken apart before them, every join would copy all columns of the families to its left one by one."""
    parts, columns = [], [f"`{ID}`"]
    for family in COMBINED:
        part = family_features(payments, family.name, ruca, options, final=True)
        names, packed = [c for c in part.columns if c != ID], f"__{family.name}"
        parts.append(part.select(ID, F.struct(*[f"`{c}`" for c in names]).alias(packed)))
        columns += [f"`{packed}`.`{c}` AS `{c}`" for c in names]
    return reduce(lambda left, right: left.join(right, ID, "left"), parts).selectExpr(columns)


def _single_pass(payments: DataFrame, ruca: DataFrame, options: Options) -> DataFrame:
    wanted = [ID] + [column for family in COMBINED for column in family.inputs]
    source = pick_inputs(payments, wanted)
    rows = _with_stats(source, options.hot_rows)
    rows = join_lookup(rows, ruca, options.dedupe_lookup)
    # Step by step over all families at once: a few wide projections instead of many.
    steps = [family.steps(options, payments.sparkSession) for family in COMBINED]
    depths = range(max(map(len, steps)))
    layers = [
        {n: c for family in steps if depth < len(family) for n, c in family[depth].items()}
        for depth in depths
    ]
    computed = {*rows.columns, *(name for layer in layers for name in layer)}
    results = {c for family in COMBINED for c in family.final_columns(computed)}
    if not options.expose_card_number:
        results -= {CARD.final_outputs[FULL_NUMBER]}
    packed = {}
    rows = _pack(rows, _finished(results, layers), packed, 0)
    for depth in depths:
        if layers[depth]:
            rows = rows.withColumns(layers[depth])
            rows = _pack(rows, _finished(results, layers[depth + 1:]), packed, depth + 1)
    available = {**{name: f"`{name}`" for name in rows.columns}, **packed}
    columns = []
    for family in COMBINED:
        # A NULL id meets no family, as in a join by id, and a NULL ZIP no location features.
        condition = f"`{ID}` IS NOT NULL" + (" AND `Zip` IS NOT NULL" if family is GEO else "")
        columns += family.select(
            available, final=True, only_if=None if family is COMBINED[0] else condition
        )
    return rows.selectExpr(columns)


def _finished(results: set[str], layers: list[dict[str, Column]]) -> set[str]:
    """The results whose names do not occur in the text of the columns still to be computed."""
    text = " ".join(str(column) for layer in layers for column in layer.values())
    # The conditions of the outputs need these two.
    return {name for name in results if name not in text} - {ID, "Zip"}


def _pack(rows: DataFrame, finished: set[str], packed: dict[str, str], number: int) -> DataFrame:
    """Puts columns that are only handed on into one struct, which the projections to come copy in one
    piece. ``packed`` keeps the expression that takes each of them out again."""
    columns = [c for c in rows.columns if c in finished]
    if not columns:
        return rows
    name = f"__packed_{number}"
    packed |= {c: f"`{name}`.`{c}`" for c in columns}
    return rows.select(
        *[f"`{c}`" for c in rows.columns if c not in finished],
        F.struct(*[f"`{c}`" for c in columns]).alias(name),
    )


def _key_stats() -> list[frequency.KeyStats]:
    return [s for family in COMBINED for s in family.stats if s is not PER_ID]


def _kind_key(stats: frequency.KeyStats) -> Column:
    """The key of a payment with its family before it, so that all families share one column."""
    return F.concat(F.lit(f"{stats.name}\0"), stats.key())


def _one_by_one(rows: DataFrame) -> DataFrame:
    """A row for each struct in ``__keys``. The array is a column before it is taken apart: outside generated
    stages Spark interprets what a generator is given, and compiles what a projection computes. The outer
    form gives the same rows, as no array is empty; for the other one Spark adds a filter on the size of the
    array, which computes all keys a second time, below a shuffle even from other inputs."""
    return rows.select(*[f"`{c}`" for c in rows.columns if c != "__keys"], F.inline_outer("__keys"))


def key_counts(source: DataFrame) -> DataFrame:
    """kind, key, rows and up to four measures of every key value of every family.

    All keys that are only counted go through one aggregation over one scan.
    """
    counted = [s for s in _key_stats() if s.counted is not None]
    keys = F.array(
        *[
            F.struct(
                F.lit(s.name).alias("kind"), _kind_key(s).alias("key"),
                s.counted(s.key()).cast("int").alias("counts"),
            )
            for s in counted
        ]
    )
    parts = [
        _one_by_one(source.select(keys.alias("__keys"))).groupBy("kind", "key")
        .agg(F.count(F.lit(1)).alias(frequency.ROWS), F.sum("counts").alias("m0"))
    ]
    for s in _key_stats():
        if s.counted is None:
            key = F.concat(F.lit(f"{s.name}\0"), F.col(s.key_column)).alias("key")
            measures = [F.col(c).alias(f"m{i}") for i, c in enumerate(s.columns)]
            parts.append(
                s.stats(source).select(F.lit(s.name).alias("kind"), key, frequency.ROWS, *measures)
            )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _bit(key: Column) -> tuple[Column, Column]:
    """Word of the bitmap, and place in it, of a key."""
    key_hash = F.xxhash64(key)
    word = key_hash.bitwiseAND(F.lit(MARK_WORDS - 1).cast("long"))
    return word, F.call_function("shiftrightunsigned", key_hash, F.lit(58)).cast("int")


def repeated_marks(keys: DataFrame) -> DataFrame:
    """A Bloom filter of one hash over the column ``key``: __word, __bits, at most ``MARK_WORDS`` rows."""
    word, place = _bit(F.col("key"))
    mark = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    return keys.groupBy(word.alias("__word")).agg(F.bit_or(mark).alias("__bits"))


def _only_repeated(records: DataFrame, marks: DataFrame, kinds: list[str]) -> DataFrame:
    """``records`` without those of the given kinds whose key is not marked."""
    word, place = _bit(F.col("key"))
    marked = F.call_function("shiftright", F.col("__bits"), place).bitwiseAND(F.lit(1)) == 1
    return (
        records.join(F.broadcast(marks), word == F.col("__word"), "left")
        .where(~F.col("kind").isin(*kinds) | F.coalesce(marked, F.lit(False)))
        .drop("__word", "__bits")
    )


def _with_stats(source: DataFrame, hot_rows: int | None) -> DataFrame:
    """The payments with the statistics of all their keys, and the number of partners per id.

    The counts are written to the shared folder once, when the frame is built, by a job of their own:
    a frame kept while the payments change mixes old counts with new rows. Hot keys meet theirs by
    broadcast on a row of the keys alone. Of each payment one narrow record, with what hot keys have
    met, and one for each other key go to the counts and come back by id, where they are put together
    and meet the full rows; these are shuffled once, or not at all where payments are bucketed by id. A key that is only counted
    and occurs once needs no look-up: a bitmap of all repeated keys, which misses none of them, keeps
    its record from being sent, and what meets no count at all has occurred once. Where there are too
    many repeated keys for the bitmap to tell much, all records are sent; the counts that they meet
    are those of repeated keys either way. The facts are scanned four
    times: for the counts, for the customers of channels, for the narrow records, and in full. What the
    records have met is kept on the executors' disks by the first action on the frame, so that further
    ones, as a sample before the whole, scan and shuffle the full rows only; what is lost there is
    computed again. It stays until the session ends or ``spark.catalog.clearCache()``.
    """
    spark = source.sparkSession
    path = scratch_path(spark, "key-counts")
    key_counts(source).write.parquet(path)
    counts = spark.read.parquet(path)
    only_counted = [s.name for s in _key_stats() if s.counted is not None]
    once = F.col("kind").isin(*only_counted) & (F.col(frequency.ROWS) == 1)
    # One row per family.
    totals = counts.groupBy("kind").agg(
        F.sum(frequency.ROWS), F.max(frequency.ROWS), F.count_if(~once)
    ).collect()
    total = max((n for _, n, _, _ in totals), default=0)
    repeated = sum(n for _, _, _, n in totals)
    least = frequency.least_hot(hot_rows, frequency.NARROW_HOT_ROWS)
    limit = max(least, -(-total // frequency.MAX_HOT_KEYS))
    has_hot = {kind for kind, _, most, _ in totals if most >= limit}
    hot = counts.where(F.col(frequency.ROWS) >= limit).drop(frequency.ROWS)
    cold = counts.where((F.col(frequency.ROWS) < limit) & ~once).drop(frequency.ROWS, "kind")
    partner = F.col("Partner").isNotNull().cast("int")
    narrow = source.where(F.col(ID).isNotNull()).select(
        ID, partner.alias("partner"), *[_kind_key(s).alias(s.key_column) for s in _key_stats()]
    )
    of_hot = {c: f"__hot{c}" for s in _key_stats() if s.name in has_hot for c in s.columns}
    for s in _key_stats():
        if s.name in has_hot:
            mine = hot.where(F.col("kind") == s.name).select(
                F.col("key").alias(s.key_column),
                *[F.col(f"m{i}").alias(of_hot[c]) for i, c in enumerate(s.columns)],
            )
            narrow = narrow.join(F.broadcast(mine), s.key_column, "left")
    # What hot keys have met goes along with the record of the payment itself.
    met_hot = F.struct(F.lit(0).alias("__none"), *of_hot.values())
    nothing = F.when(F.lit(False), met_hot)
    keys = F.array(
        F.struct(
            F.lit("id").alias("kind"), F.col(ID).alias("key"), F.col("partner"), met_hot.alias("hot")
        ),
        *[
            F.when(
                F.col(of_hot[s.columns[0]]).isNull() if s.name in has_hot else F.lit(True),
                F.struct(
                    F.lit(s.name).alias("kind"), F.col(s.key_column).alias("key"),
                    F.lit(0).alias("partner"), nothing.alias("hot"),
                ),
            )
            for s in _key_stats()
        ],
    )
    records = _one_by_one(narrow.select(ID, keys.alias("__keys"))).where(F.col("kind").isNotNull())
    if repeated < 64 * MARK_WORDS:
        marks = repeated_marks(counts.where(F.col("kind").isin(*only_counted) & ~once))
        records = _only_repeated(records, marks, only_counted)
    met = records.join(cold, "key", "left")

    def measure(s: frequency.KeyStats, i: int, column: str) -> Column:
        cold_one = F.when(F.col("kind") == s.name, F.col(f"m{i}"))
        return F.coalesce(cold_one, F.col("hot")[of_hot[column]]) if s.name in has_hot else cold_one

    of_kind = {
        column: F.max(measure(s, i, column))
        for s in _key_stats()
        for i, column in enumerate(s.columns)
    }
    per_id = met.groupBy(ID).agg(
        F.count(F.when(F.col("kind") == "id", 1)).alias("__n"),
        F.sum("partner").alias(PARTNERS_PER_ID),
        *[c.alias(name) for name, c in of_kind.items()],
    )
    message = F.concat(
        F.lit("payment id "), F.col(ID), F.lit(" is not unique; use mode='join' for such data")
    )
    per_id = per_id.persist(StorageLevel.DISK_ONLY)
    # A filter, so that no choice of columns prunes it.
    per_id = per_id.where(F.assert_true(F.col("__n") == 1, message).isNull()).drop("__n")
    rows = source.join(per_id, ID, "left")
    # What met no count has a key of its own.
    alone = {
        s.columns[0]: F.coalesce(s.columns[0], s.counted(s.key()).cast("long"))
        for s in _key_stats() if s.counted is not None
    }
    return rows.withColumns(alone)
