"""Every customer's group (0/1), score (1-5) and points (1-100) per metric.

A customer's value inside the bounds takes the band row of an equal eligible value (none:
NULL, as in the procedure); below / above the bounds gives the low / high end (reversed
for descending metrics). Bounds are literals, so these are plain CASE expressions.

Band rows are not looked up by value. Inside the band the grades are a step function of the
value with a bounded number of steps (``steps.py``): the step is found by binary search and
its grades in one broadcast table of at most ``MAX_STEPS`` rows per metric. An eligible
customer's value occurs by definition. Where eligibility does not follow from the value, an
ineligible customer's is looked up in bitmaps of the values that occur, also bounded. So
grading never shuffles the customers, at any number of distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmint.functions.exact import BASE_POINTS, POINTS_TYPE, ntile_from_rank, points_from_rank
from segmint.operators.bands import Bounds, Extent, lit_map
from segmint.operators.joins import left_join_lookups, split_code
from segmint.operators.steps import (
    bit_is_set,
    find_steps,
    key_of,
    long_key,
    present_values,
    step_column,
    step_grades,
    with_steps,
)
from segmint.plans.specs import MetricSpec


def grade_columns(spec: MetricSpec) -> tuple[str, str, str]:
    return f"{spec.name}Group", f"{spec.name}Score", f"{spec.name}Points"


def _sql_int(v: int | None) -> str:
    return "CAST(NULL AS BIGINT)" if v is None else f"CAST({v} AS BIGINT)"


def _graded(band: str, value: str, lo: str, hi: str, low: str, high: str, dtype: str) -> str:
    """SQL CASE: the band's grade, else the low / high end below / above the bounds."""
    return (
        f"CAST(CASE WHEN {band} IS NULL AND {value} < {lo} THEN {low} "
        f"WHEN {band} IS NULL AND {value} > {hi} THEN {high} ELSE {band} END AS {dtype})"
    )


def band_lookup(
    ranked: DataFrame, specs: Sequence[MetricSpec], bounds: dict[str, Bounds], extents: dict[str, Extent]
) -> DataFrame:
    """The bands of all metrics in one table keyed by ``struct(metric index, value)``, from one
    scan of the ranked values."""
    live = {
        m.name: i
        for i, m in enumerate(specs)
        if (b := bounds.get(m.name)) is not None
        and b.lower is not None
        and extents[m.name].size > 0
    }
    if not live:
        rows = ranked.where(F.lit(False))
    else:
        metric = F.col("Metric")
        lo = lit_map({n: bounds[n].lower for n in live}, "bigint")[metric]
        hi = lit_map({n: bounds[n].upper for n in live}, "bigint")[metric]
        rows = ranked.where(metric.isin(list(live)) & (F.col("Value") >= lo) & (F.col("Value") <= hi))
    metric = F.col("Metric")
    first = lit_map({n: extents[n].first for n in live}, "bigint")[metric]
    size = lit_map({n: extents[n].size for n in live}, "bigint")[metric]
    desc = metric.isin([m.name for m in specs if m.descending and m.name in live])
    rn_asc = F.col("ValueRank") - first + 1
    rn = F.when(desc, size + 1 - rn_asc).otherwise(rn_asc)
    ranks = rows.select(
        F.struct(lit_map(live, "int")[metric].alias("m"), F.col("Value").alias("v")).alias("_key"),
        rn.cast("bigint").alias("_rn"),
        size.cast("bigint").alias("_n"),
    )
    return ranks.select(
        "_key",
        (ntile_from_rank("_rn", "_n", 2) - 1).alias("Group"),
        (ntile_from_rank("_rn", "_n", 3) + 1).alias("Score"),
        points_from_rank("_rn", "_n", BASE_POINTS).alias("Points"),
    )


def band_rows(
    ranked: DataFrame, specs: Sequence[MetricSpec], bounds: dict[str, Bounds], extents: dict[str, Extent]
) -> DataFrame:
    """``(Metric, Value, Points, Score, Group)`` - the grading lookup, by name."""
    names = lit_map({str(i): m.name for i, m in enumerate(specs)}, "string")
    return band_lookup(ranked, specs, bounds, extents).select(
        names[F.col("_key.m").cast("string")].alias("Metric"), F.col("_key.v").alias("Value"), "Points", "Score", "Group"
    )


#: Metrics looked up by one chain of joins.
METRICS_PER_ROUND = 2

GRADE_TYPES = {"Group": "int", "Score": "int", "Points": POINTS_TYPE}


def assign_grades(
    base: DataFrame, ranked: DataFrame, specs: Sequence[MetricSpec], bounds: dict[str, Bounds], extents: dict[str, Extent]
) -> DataFrame:
    """Base columns + 27 grade columns, without a shuffle of ``base``."""
    bands = band_lookup(ranked, specs, bounds, extents)
    steps = find_steps(bands, list(GRADE_TYPES))
    levels = F.broadcast(long_key(step_grades(base, steps, GRADE_TYPES), "s"))
    probed = [i for i, m in enumerate(specs) if i in steps and not m.eligible_by_value]
    present = F.broadcast(long_key(present_values(bands, probed), "b"))
    stepped = with_steps(base, steps, {i: m.value for i, m in enumerate(specs)})
    kept = [f"b.`{c}`" for c in stepped.columns]
    rounds: list[tuple[list[tuple[DataFrame, str]], list[str]]] = []
    # a round per few metrics: joined together, all would make one method too long to be compiled
    for start in range(0, len(specs), METRICS_PER_ROUND):
        joins: list[tuple[DataFrame, str]] = []
        grades: list[str] = []
        names: list[str] = []
        for i, m in list(enumerate(specs))[start : start + METRICS_PER_ROUND]:
            value = f"CAST(b.`{m.value}` AS BIGINT)"
            b = bounds.get(m.name)
            lo, hi = _sql_int(b.lower if b else None), _sql_int(b.upper if b else None)
            at = None
            if i in steps:
                inside = f"{value} BETWEEN {lo} AND {hi}"
                known = f"({m.eligible})"
                if i in probed:
                    bucket = f"IF({inside} AND NOT coalesce({known}, false), bitmap_bucket_number({value}), NULL)"
                    joins.append((present, key_of(i, bucket)))
                    known = f"({known} OR {bit_is_set(f'l{len(joins) - 1}.Bits', value)})"
                joins.append((levels, key_of(i, f"IF({inside} AND {known}, CAST(b.{step_column(i)} AS INT), NULL)")))
                at = f"l{len(joins) - 1}"
            ends = ((1, 0), (5, 1), ("100.00", "1.00")) if m.descending else ((0, 1), (1, 5), ("1.00", "100.00"))
            for (low, high), (col, dtype), name in zip(ends, GRADE_TYPES.items(), grade_columns(m)):
                band = f"{at}.`{col}`" if at else f"CAST(NULL AS {dtype})"
                grades.append(_graded(band, value, lo, hi, str(low), str(high), dtype))
                names.append(name)
        grades[-1] = split_code(grades[-1])
        rounds.append((joins, kept + [f"{g} AS `{name}`" for g, name in zip(grades, names)]))
        kept = kept + [f"b.`{name}`" for name in names]
    rounds.append(([], [f"b.`{c}`" for c in base.columns] + kept[len(stepped.columns) :]))
    return left_join_lookups(stepped, rounds)


def top_score_predicates(specs: Sequence[MetricSpec], bounds: dict[str, Bounds]) -> dict[str, Column]:
    """``<metric>Score = 5`` as a predicate on the base table.

    In-band values score 2-4 (their band's ntile) and below-bound values 1, so a score of
    5 means exactly: above the upper bound (below the lower bound for a descending
    metric); no bounds, no 5. This lets the elite populations be read straight from the
    base table, without the grade joins, and prunes row groups on the bound.
    """
    out = {}
    for m in specs:
        b = bounds.get(m.name)
        v = F.col(m.value).cast("bigint")
        if b is None or b.lower is None or b.upper is None:
            out[grade_columns(m)[1]] = F.lit(False)
        elif m.descending:
            out[grade_columns(m)[1]] = v < F.lit(b.lower).cast("bigint")
        else:
            out[grade_columns(m)[1]] = v > F.lit(b.upper).cast("bigint")
    return out
