"""Statistics per key value, and the join that brings them back to the rows.

A key value can be on a large part of all rows (blank names, one busy channel). A window or a plain
shuffle join would send all of them to one task. Here the statistics come from an ordinary
aggregation, which combines on the map side, and rows meet them in two left joins, alike at every
size of the input:

* *hot* keys, on at least ``hot_rows`` rows and on at least one row in ``MAX_HOT_KEYS``, meet their
  statistics through a broadcast. At most ``MAX_HOT_KEYS`` such values can exist, so the broadcast is
  bounded whatever the size of the input;
* all *other* keys meet theirs in a shuffle join. Rows already met, and rows without a key, enter it
  under spread-out keys that match nothing.

Every row is kept once, whether or not its key or its id is NULL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_HOT_ROWS = 1_000_000
# Where only narrow rows meet the broadcast, as in the combined table, it pays from far fewer rows on.
NARROW_HOT_ROWS = 1_000
MAX_HOT_KEYS = 100_000
ROWS = "__rows"


@dataclass(frozen=True)
class KeyStats:
    """Statistics per value of a key.

    ``measures`` are aggregates over the rows of a key value; ``build`` replaces them where one
    aggregation is not enough. ``counted`` tells whether a row counts where the only measure is a
    count. A row whose key is NULL gets 0. ``spread=False`` is for keys that no value fills.
    """

    name: str
    key: Callable[[], Column]
    measures: Callable[[Column], dict[str, Column]] | None = None
    build: Callable[[DataFrame, "KeyStats"], DataFrame] | None = None
    columns: tuple[str, ...] = field(default=())
    counted: Callable[[Column], Column] | None = None
    spread: bool = True

    @property
    def key_column(self) -> str:
        return f"__key_{self.name}"

    def stats(self, rows: DataFrame) -> DataFrame:
        """One row per key value: the key, its row count and the measures."""
        if self.build is not None:
            return self.build(rows, self)
        key = F.col(self.key_column)
        return (
            rows.withColumn(self.key_column, self.key())
            .groupBy(self.key_column)
            .agg(F.count(F.lit(1)).alias(ROWS), *_aliased(self._measures(key)))
        )

    def _measures(self, key: Column) -> dict[str, Column]:
        if self.counted is not None:
            return {self.columns[0]: F.count(F.when(self.counted(key), 1))}
        return self.measures(key)


def _aliased(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def unless_blank(key: Column) -> Column:
    return key != ""


def hot_limit(source: DataFrame, hot_rows: int | None) -> Column:
    """Row count from which a key is hot; the count of the source reads no column."""
    total = source.agg(F.count(F.lit(1)).alias("n")).scalar()
    return F.greatest(F.lit(least_hot(hot_rows)).cast("long"), F.ceil(total / MAX_HOT_KEYS))


def least_hot(hot_rows: int | None, default: int = DEFAULT_HOT_ROWS) -> int:
    return default if hot_rows is None else max(hot_rows, 1)


def attach(
    rows: DataFrame, source: DataFrame, key_stats: KeyStats, hot_rows: int | None
) -> DataFrame:
    """Adds the measures of each row's key value.

    ``source`` holds the rows the statistics are taken over. ``hot_rows=0`` turns the split off.
    """
    key, measures = key_stats.key_column, list(key_stats.columns)
    stats = key_stats.stats(source)
    keyed = rows.withColumn(key, key_stats.key())
    found = {m: F.coalesce(m, F.lit(0)) for m in measures}
    if hot_rows == 0 or not key_stats.spread:
        return keyed.join(stats.drop(ROWS), key, "left").withColumns(found).drop(key)
    limit = hot_limit(source, hot_rows)
    hot = stats.where(F.col(ROWS) >= limit).select(
        F.col(key).alias("__hot_key"), *[F.col(m).alias(f"__hot{m}") for m in measures]
    )
    cold = stats.where(F.col(ROWS) < limit).select(
        F.col(key).alias("__cold_key"), F.lit(0).cast("long").alias("__cold_side"), *measures
    )
    met = keyed.join(F.broadcast(hot), F.col(key) == F.col("__hot_key"), "left").withColumn(
        "__side",
        F.when(F.col("__hot_key").isNull() & F.col(key).isNotNull(), F.lit(0).cast("long"))
        .otherwise(F.xxhash64(*[f"`{c}`" for c in rows.columns]).bitwiseOR(F.lit(1).cast("long"))),
    )
    on = (F.col(key) == F.col("__cold_key")) & (F.col("__side") == F.col("__cold_side"))
    found = {m: F.coalesce(m, f"__hot{m}", F.lit(0)) for m in measures}
    return met.join(cold, on, "left").withColumns(found).select(
        *[f"`{c}`" for c in rows.columns], *measures
    )
