"""Size-checked broadcast.

A side is broadcast only after its row count is known to be under a limit; otherwise the
join is left to the planner (sort-merge, with AQE splitting skewed partitions).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Every table broadcast here is a handful of narrow columns; a row of the widest one (the
# grading lookup: struct key, two integers, a decimal) takes about this much when hashed.
LOOKUP_ROW_BYTES = 96
DEFAULT_BROADCAST_BYTES = 192 << 20


def rows_within(limit_bytes: int) -> int:
    """Lookup rows that fit a broadcast of ``limit_bytes``."""
    return limit_bytes // LOOKUP_ROW_BYTES


DEFAULT_BROADCAST_ROWS = rows_within(DEFAULT_BROADCAST_BYTES)


def broadcast_if_small(df: DataFrame, limit: int = DEFAULT_BROADCAST_ROWS, rows: int | None = None) -> tuple[DataFrame, bool]:
    """``(broadcast(df), True)`` if ``df`` has at most ``limit`` rows, else ``(df, False)``.

    ``rows`` may pass a count that is already known, to skip the counting job.
    """
    n = df.count() if rows is None else rows  # partial counts per task
    return (F.broadcast(df), True) if n <= limit else (df, False)


def left_join_lookups(base: DataFrame, rounds: Sequence[tuple[Sequence[tuple[DataFrame, str]], Sequence[str]]]) -> DataFrame:
    """Rounds of ``b`` LEFT JOIN each lookup ``l<i>`` ON ``l<i>._key = <key SQL over b>``, projected
    by a select list (SQL over ``b`` and ``l<i>``); ``b`` is ``base``, then the round before.

    All rounds are one statement. It is analysed once, where chained ``join`` calls re-analyse
    the growing plan each time. The temporary views have run-unique names and are dropped as
    soon as the statement is analysed (the plan no longer refers to them by name).
    """
    spark = base.sparkSession
    tag = uuid.uuid4().hex[:12]
    source = f"_segmint_b_{tag}"
    views = {source: base}
    tables: dict[int, str] = {}
    for lookups, select in rounds:
        for df, _ in lookups:
            if id(df) not in tables:
                tables[id(df)] = f"_segmint_l{len(tables)}_{tag}"
                views[tables[id(df)]] = df
        joins = " ".join(f"LEFT JOIN {tables[id(df)]} l{i} ON l{i}._key = {key}" for i, (df, key) in enumerate(lookups))
        source = f"(SELECT {', '.join(select)} FROM {source} b {joins})"
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    try:
        return spark.sql(source)
    finally:
        for name in views:
            spark.catalog.dropTempView(name)


def split_code(value: str) -> str:
    """SQL: ``value`` (one of a wide select list), in a form that keeps the projection it is in
    out of whole-stage code.

    Whole-stage code is one method per chain of operators, and the JVM only interprets methods
    above 8,000 bytes: many lookups and wide select lists in one chain run many times slower
    than compiled. A higher-order function ends the chain, and Spark splits the code of a
    projection by itself into small methods.
    """
    return f"transform(array({value}), v -> v)[0]"
