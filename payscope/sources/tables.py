"""Reading payments and the lookup, writing the feature table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from payscope.sources.schema import ID, PAYMENTS, RUCA


def _read(spark: SparkSession, schema: StructType, path: str | None, table: str | None) -> DataFrame:
    if (table is None) == (path is None):
        raise ValueError("give either a table or a path")
    if path is not None:
        return spark.read.schema(schema).parquet(path)
    found = spark.table(table)
    have = dict(found.dtypes)
    wrong = [
        f"{f.name} is {have.get(f.name, 'missing')}, not {f.dataType.simpleString()}"
        for f in schema
        if have.get(f.name) != f.dataType.simpleString()
    ]
    if wrong:
        raise ValueError(f"table {table}: " + "; ".join(wrong))
    return found.select([f"`{name}`" for name in schema.fieldNames()])


def read_payments(
    spark: SparkSession, path: str | None = None, table: str | None = None
) -> DataFrame:
    """Payments from parquet, with the declared schema so that no file is opened to infer it, or
    from a table whose columns are checked against it."""
    return _read(spark, PAYMENTS, path, table)


def read_ruca(spark: SparkSession, path: str | None = None, table: str | None = None) -> DataFrame:
    """ZIP rurality lookup from parquet or a table, with the declared schema."""
    return _read(spark, RUCA, path, table)


def write_features(
    features: DataFrame,
    table: str | None = None,
    path: str | None = None,
    buckets: int | None = None,
) -> None:
    """Replaces the feature table, or the parquet files at ``path``.

    The rows are written beside the old ones and take their place only when all are there: a run that
    fails leaves the old table or files as they were, and ``features`` may read what it replaces. The
    change is two renames. Where a run dies between them, the old rows lie under the name with
    ``__previous``; the next call puts them back before it writes. One call at a time for a name.
    A table can be bucketed by payment id, which spares later joins on the id their shuffle.
    """
    if (table is None) == (path is None):
        raise ValueError("give either a table or a path")
    if table is not None:
        names, name = _Tables(features.sparkSession), table
    else:
        names, name = _Folders(features.sparkSession), path.rstrip("/")
    staged = _beside(name, f"__staged_{uuid.uuid4().hex}")
    previous = _beside(name, "__previous")
    if names.exists(previous):
        if names.exists(name):
            names.drop(previous)
        else:
            names.rename(previous, name)
    writer = features.write.format("parquet")
    try:
        if table is None:
            writer.save(staged)
        elif buckets:
            writer.bucketBy(buckets, ID).sortBy(ID).saveAsTable(staged)
        else:
            writer.saveAsTable(staged)
    except BaseException:
        names.drop(staged)
        raise
    if names.exists(name):
        names.rename(name, previous)
    try:
        names.rename(staged, name)
    except BaseException:
        if names.exists(previous):
            names.rename(previous, name)
        names.drop(staged)
        raise
    names.drop(previous)


def _beside(name: str, suffix: str) -> str:
    return f"{name[:-1]}{suffix}`" if name.endswith("`") else name + suffix


class _Tables:
    """Tables of the catalog by name."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(name)

    def rename(self, old: str, new: str) -> None:
        self.spark.sql(f"ALTER TABLE {old} RENAME TO {new}")

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")


class _Folders:
    """Folders of the file system that the path names."""

    def __init__(self, spark: SparkSession) -> None:
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.conf = spark._jsc.hadoopConfiguration()

    def _at(self, name: str):
        path = self.path(name)
        return path.getFileSystem(self.conf), path

    def exists(self, name: str) -> bool:
        files, path = self._at(name)
        return files.exists(path)

    def rename(self, old: str, new: str) -> None:
        files, path = self._at(old)
        if not files.rename(path, self.path(new)):
            raise OSError(f"{old} cannot be renamed to {new}")

    def drop(self, name: str) -> None:
        files, path = self._at(name)
        files.delete(path, True)


def write_payments_bucketed(payments: DataFrame, table: str, buckets: int) -> None:
    """Payments as a table bucketed by id.

    Joins on the id then read the payments in place: the combined feature plan needs no shuffle of
    the wide rows. The rows are first gathered by bucket, so each bucket is one file per writer.
    """
    (
        payments.repartition(buckets, ID)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, ID)
        .sortBy(ID)
        .saveAsTable(table)
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder the cluster names in ``spark.checkpoint.dir``, or
    below the warehouse where that is unset."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        shared = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
