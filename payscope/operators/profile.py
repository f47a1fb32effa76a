"""Looking at data: samples, previews and column profiles, all computed on the cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.sources.schema import ID

HASH_DIGITS = 15


def sample_rows(df: DataFrame, fraction: float = 0.02, key: str = ID) -> DataFrame:
    """A repeatable sample: rows whose key has a hash in the lowest part of its 60 bits.

    The choice depends on the key alone (NULL counts as blank), so reruns, retried tasks and other
    cluster layouts give the same rows.
    """
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must lie between 0 and 1")
    digits = F.left(F.md5(F.coalesce(F.col(key), F.lit(""))), F.lit(HASH_DIGITS))
    return df.where(F.conv(digits, 16, 10).cast("long") < sample_limit(fraction))


def sample_limit(fraction: float) -> int:
    """Hashes below this number are in the sample."""
    return int(fraction * (1 << 4 * HASH_DIGITS))


def sample_rows_at_random(df: DataFrame, fraction: float = 0.02, seed: int = 0) -> DataFrame:
    """A row-by-row random sample, for tables without a key."""
    return df.sample(fraction=fraction, seed=seed)


def preview(df: DataFrame, n: int = 5, order_by: str | None = None) -> DataFrame:
    """First rows; with ``order_by`` the same ones every time."""
    return (df.orderBy(order_by) if order_by else df).limit(n)


def _name(column: str) -> Column:
    return F.col(f"`{column}`")


def _per_column(df: DataFrame, measure, label: str) -> DataFrame:
    """One aggregation over all columns, turned into one row per column."""
    totals = df.agg(*[measure(_name(c)).alias(c) for c in df.columns])
    rows = F.array(
        *[
            F.struct(
                F.lit(position).alias("position"),
                F.lit(column).alias("column_name"),
                F.lit(data_type).alias("data_type"),
                _name(column).alias(label),
            )
            for position, (column, data_type) in enumerate(df.dtypes, start=1)
        ]
    )
    return totals.select(F.inline(rows))


def profile_schema(df: DataFrame) -> DataFrame:
    """Position, name, type and number of non-NULL values of every column."""
    return _per_column(df, F.count, "non_null_count")


def profile_nulls(df: DataFrame) -> DataFrame:
    """Number of NULL values of every column."""
    return _per_column(df, lambda c: F.count(F.when(c.isNull(), 1)), "null_count")


def profile_unique(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column, NULL included."""
    return df.select(_name(column)).distinct()


def profile_value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, NULL included, most frequent first."""
    return df.groupBy(_name(column)).agg(F.count(F.lit(1)).alias("count")).orderBy(
        F.desc("count"), _name(column).asc_nulls_first()
    )
