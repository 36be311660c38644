"""Grades as step functions of the value: bounded tables in place of value lookups.

Inside a band a grade depends on a value's rank only and never falls (or never rises) with
the value. Points have at most 9,891 levels, scores three and groups two, so all grades of
a metric together are a step function with at most ``MAX_STEPS`` steps, whatever the number
of distinct values or customers. The steps are found by one aggregate over the ranked
values, and a customer's step by binary search (``Bucketizer``) in the sorted first values.

A step function also answers for values that do not occur. Where the procedure asks for an
*equal* value (a customer outside the population), ``present_values`` gives exact membership:
a bitmap per 32,768 integers. Money is below 1e8 (``decimal(18,10)``) and the other metrics
are days and counts, so the bitmaps of a metric take about 12.5 MB at the very most.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Point levels of a band (1.00 to 99.95), and the cuts of scores, groups and of a second bound.
MAX_STEPS = 9_896 + 8


@dataclass(frozen=True)
class Steps:
    """One metric's step function: the first value of each step, ascending."""

    firsts: tuple[int, ...]
    grades: tuple[tuple, ...]  # per step, the grade columns


def find_steps(bands: DataFrame, grades: Sequence[str]) -> dict[int, Steps]:
    """The steps per metric index of ``bands`` (``_key`` = struct of metric index and value, and
    the grade columns): a bounded number of rows, collected in one job."""
    m, v = F.col("_key.m").alias("m"), F.col("_key.v").alias("v")
    rows = bands.select(m, v, *grades).groupBy("m", *grades).agg(F.min("v").alias("first")).collect()
    out: dict[int, list] = {}
    for r in rows:
        out.setdefault(r["m"], []).append((r["first"], tuple(r[g] for g in grades)))
    for m, steps in out.items():
        if len(steps) > MAX_STEPS:
            raise ValueError(f"metric {m} has {len(steps)} steps: grades do not follow the value")
        steps.sort(key=lambda s: s[0])
    return {m: Steps(tuple(f for f, _ in s), tuple(g for _, g in s)) for m, s in out.items()}


def step_column(i: int) -> str:
    return f"_step{i}"


def with_steps(df: DataFrame, steps: dict[int, Steps], values: dict[int, str]) -> DataFrame:
    """Adds ``_step<i>``: how many steps of metric ``i`` begin at or below the value (0: none)."""
    used = {i: s for i, s in steps.items() if s.firsts}
    if not used:
        return df
    inputs = {i: f"_in{i}" for i in used}
    df = df.select("*", *(F.col(values[i]).cast("double").alias(c) for i, c in inputs.items()))
    splits = json.dumps([["-Inf", *map(float, s.firsts), "Inf"] for s in used.values()])
    bucketizer = Bucketizer(inputCols=list(inputs.values()), outputCols=[step_column(i) for i in used], handleInvalid="keep")
    # thousands of splits: as one JSON text, for a Python list crosses to the JVM number by number
    java = bucketizer._java_obj
    java.setSplitsArray(java.splitsArray().jsonDecode(splits))
    return bucketizer.transform(df).drop(*inputs.values())


def step_grades(df: DataFrame, steps: dict[int, Steps], grades: dict[str, str]) -> DataFrame:
    """The grades by ``_key`` = struct of metric index and step, as a table of at most
    ``MAX_STEPS`` rows per metric; ``grades``: type by column."""
    rows = [(i, k + 1, *g) for i, s in steps.items() for k, g in enumerate(s.grades)]
    types = {"m": "int", "s": "int"} | grades
    kinds = [pa.int32() if t == "int" else pa.decimal128(*map(int, re.findall(r"\d+", t))) for t in types.values()]
    arrays = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
    ddl = ", ".join(f"`{c}` {t}" for c, t in types.items())
    table = df.sparkSession.createDataFrame(pa.table(arrays, names=list(types)), ddl)
    return table.select(F.struct("m", "s").alias("_key"), *grades)


def long_key(table: DataFrame, part: str) -> DataFrame:
    """``table`` with its ``_key`` (a struct of metric index ``m`` and ``part``) as one integer,
    ``key_of``: Spark hashes those without building a row per probe."""
    return table.withColumn("_key", F.expr(key_of("_key.m", f"_key.{part}")))


def key_of(metric: int | str, part: str) -> str:
    """SQL: metric index (below 64) and a step or bitmap number (within 49 bits) as one integer."""
    return f"(CAST({part} AS BIGINT) * 64 + {metric})"


def present_values(bands: DataFrame, metrics: Sequence[int]) -> DataFrame:
    """``_key`` = struct of metric index and ``bitmap_bucket_number``, ``Bits``: the values of the
    bands of ``metrics`` that occur."""
    v = F.col("_key.v")
    rows = bands.where(F.col("_key.m").isin(list(metrics)))
    return rows.groupBy(F.struct(F.col("_key.m").alias("m"), F.bitmap_bucket_number(v).alias("b")).alias("_key")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(v)).alias("Bits")
    )


def bit_is_set(bits: str, value: str) -> str:
    """SQL: whether the bitmap holds the value (false where there is no bitmap)."""
    at = f"bitmap_bit_position({value})"
    byte = f"CAST(conv(hex(substring({bits}, CAST({at} div 8 AS INT) + 1, 1)), 16, 10) AS INT)"
    return f"coalesce((shiftright({byte}, CAST({at} % 8 AS INT)) & 1) = 1, false)"
