"""Readers that pin each input to its schema (files of any format Spark reads, or catalog
tables with ``fmt="table"``).

Only the schema's columns are selected, so Parquet scans read just those columns, and a
cast that is a no-op (file already has the type) is removed by the optimizer, keeping
filters pushable to the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmint.sources.schemas import RATES_CURRENT, RATES_LEGACY, TRANSACTIONS, USERS


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns from ``df`` with its types."""
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def _load(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    if fmt == "table":
        # a catalog table (path = its name); bucketing by CustomerKey is then visible to the
        # planner, and the activity aggregations need no shuffle at all
        return spark.table(path)
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")  # strings, cast to the pinned types by conform
    return reader.load(path)


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    return conform(_load(spark, path, fmt), schema)


def read_transactions(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    window=None,
    date_partition: str | None = None,
) -> DataFrame:
    """Transactions with their schema pinned.

    With a ``window`` and the name of a date partition column whose value is the date of
    ``CreateDate``, the window's bounds are applied to that column too, so only the
    window's partition directories are listed and read (the exact ``CreateDate`` filter is
    still applied later).
    """
    df = _load(spark, path, fmt)
    if window is not None and date_partition is not None:
        from segmint.operators.window import day_literal

        if window.empty:
            df = df.where(F.lit(False))
        else:
            col = F.col(f"`{date_partition}`")
            dtype = df.schema[date_partition].dataType
            df = df.where((col >= day_literal(window.start, dtype)) & (col < day_literal(window.base_day, dtype)))
    return conform(df, TRANSACTIONS)


def read_users(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, USERS, fmt)


def read_rates_legacy(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, RATES_LEGACY, fmt)


def read_rates_current(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, RATES_CURRENT, fmt)
