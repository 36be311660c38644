"""The elite grades of the top customers (population score 5).

Per elite metric: the ceiling of P99 of ``bound_value`` over the population is the bound;
the distinct ``band_value``s of the population up to a bound form the band, graded
``ntile(3)`` (score) and 1.00-99.95 (points). Score and points bands may be cut at
different bounds (the default spec cuts the USD ticket-size score band at the TRY bound).
Final grade: gate score 5 and a band row -> the band grade; gate 5, no band row and the
value above the bound -> 4 / 100.00; otherwise 0.

As in ``grade.py`` a band is a step function of bounded size. The value of a customer of the
population occurs if it is the value the band was built from; if the population is all
customers above a bound of that very value, no other customer's can occur. Otherwise it is
looked up in bitmaps of the values that occur.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmint.functions.exact import ELITE_POINTS, POINTS_TYPE, ntile_from_rank, points_from_rank
from segmint.operators.bands import (
    Bounds,
    Cut,
    Extent,
    PercentileSpec,
    lit_map,
    percentile_bounds,
    unpivot_values,
    value_histogram,
)
from segmint.operators.grade import METRICS_PER_ROUND, grade_columns
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
from segmint.plans.specs import EliteSpec, MetricSpec

def band_key(e: EliteSpec) -> str:
    """Histogram key of the band values (shared with the bound when the columns agree)."""
    return e.name if e.band_value == e.bound_value else f"{e.name}/band"

def _by_own_value(e: EliteSpec, metric_specs: Sequence[MetricSpec]) -> MetricSpec | None:
    """The metric at whose bound the population is cut, if its value is the band's and the one
    that is looked up: then the values that occur are exactly the population's."""
    owner = {grade_columns(m)[1]: m for m in metric_specs}.get(e.population)
    return owner if owner is not None and e.band_value == e.join_value == owner.value else None


def from_base_ranks(specs: Sequence[EliteSpec], metric_specs: Sequence[MetricSpec]) -> dict[str, MetricSpec]:
    """Elite metrics whose histogram is a part of a base metric's: the population is all who lie
    beyond its bound, all of them are eligible, and bound and band are of the same value."""
    owners = {e.name: _by_own_value(e, metric_specs) for e in specs if e.bound_value == e.band_value}
    return {name: m for name, m in owners.items() if m is not None and m.eligible_beyond}


def elite_values(
    df: DataFrame,
    specs: Sequence[EliteSpec],
    populations: dict[str, Column] | None = None,
    ranked: DataFrame | None = None,
    bounds: dict[str, Bounds] | None = None,
    metric_specs: Sequence[MetricSpec] = (),
) -> DataFrame:
    """Histogram of the populations' bound values (and band values where they differ).

    ``populations`` maps a score column to an equivalent predicate on ``df``; a score
    column not in it is read from ``df`` (which then must be the graded table). With the
    ``ranked`` base histogram and its ``bounds``, what ``from_base_ranks`` names is read there
    and only the rest from ``df``.
    """
    populations = populations or {}
    parts: list[DataFrame] = []
    entries = []
    pops = []
    ready = from_base_ranks(specs, metric_specs) if ranked is not None else {}
    if ready:
        beyond = []
        for name, m in ready.items():
            b = (bounds or {}).get(m.name)
            if b is not None and b.lower is not None and b.upper is not None:
                past = F.col("Value") < b.lower if m.descending else F.col("Value") > b.upper
                beyond.append(F.when((F.col("Metric") == m.name) & past, F.lit(name)))
        if beyond:
            tops = ranked.select(F.explode(F.array_compact(F.array(*beyond))).alias("_elite"), "Value", "Customers")
            parts.append(tops.select(F.col("_elite").alias("Metric"), "Value", "Customers"))
    for e in specs:
        if e.name in ready:
            continue
        pop = populations.get(e.population, F.col(e.population) == 5)
        pops.append(pop)
        entries.append((e.name, F.when(pop, F.col(e.bound_value))))
        if band_key(e) != e.name:
            entries.append((band_key(e), F.when(pop, F.col(e.band_value))))
    if entries or not parts:
        # only customers in some population: the disjunction reaches the Parquet scan
        some = df.where(reduce(lambda a, b: a | b, pops, F.lit(False)))
        parts.append(value_histogram(unpivot_values(some, entries or [(specs[0].name, F.lit(None).cast("int"))])))
    return reduce(DataFrame.unionByName, parts)


def elite_bounds(ranked: DataFrame, specs: Sequence[EliteSpec]) -> DataFrame:
    """U16: ``(Metric, Customers, LowerBound = NULL, UpperBound)``."""
    return percentile_bounds(ranked, [PercentileSpec(e.name, None, e.p_high) for e in specs])

def _upper(bounds: dict[str, Bounds], name: str | None) -> int | None:
    b = bounds.get(name) if name else None
    return b.upper if b else None

def elite_cuts(specs: Sequence[EliteSpec]) -> dict[str, Cut]:
    """Named cuts for ``summarize``: ``<name>:points`` (own bound) and ``<name>:score``."""
    cuts = {}
    for e in specs:
        cuts[f"{e.name}:points"] = Cut(band_key(e), e.name, False)
        cuts[f"{e.name}:score"] = Cut(band_key(e), e.score_bound_of or e.name, False)
    return cuts


def own_elite_cuts(specs: Sequence[EliteSpec]) -> set[str]:
    """The cuts that are a metric's own band (extents come with its bounds)."""
    own = set()
    for e in specs:
        if band_key(e) == e.name:
            own.add(f"{e.name}:points")
            if not e.score_bound_of:
                own.add(f"{e.name}:score")
    return own


def _cuts_of(e: EliteSpec, bounds: dict[str, Bounds]) -> tuple[int | None, int | None]:
    own = _upper(bounds, e.name)
    return own, (_upper(bounds, e.score_bound_of) if e.score_bound_of else own)


def elite_band_rows(
    ranked: DataFrame, specs: Sequence[EliteSpec], bounds: dict[str, Bounds], extents: dict[str, Extent]
) -> DataFrame:
    """``(Metric, Value, EliteScore, ElitePoints)`` - the elite lookup, by name."""
    names = lit_map({str(i): e.name for i, e in enumerate(specs)}, "string")
    return elite_lookup(ranked, specs, bounds, extents).select(
        names[F.col("_key.m").cast("string")].alias("Metric"), F.col("_key.v").alias("Value"), "EliteScore", "ElitePoints"
    )


def elite_columns(e: EliteSpec) -> tuple[str, str]:
    return f"EliteSegmentScore_{e.name}", f"EliteSegmentPoints_{e.name}"

def elite_lookup(
    ranked: DataFrame,
    specs: Sequence[EliteSpec],
    bounds: dict[str, Bounds],
    extents: dict[str, Extent],
) -> DataFrame:
    """Elite bands in one table keyed by ``struct(metric index, value)``."""
    live = {}
    for i, e in enumerate(specs):
        own, score = _cuts_of(e, bounds)
        if own is not None or score is not None:
            live[band_key(e)] = (i, own, score, extents[f"{e.name}:points"].size, extents[f"{e.name}:score"].size)
    metric = F.col("Metric")
    if not live:
        rows = ranked.where(F.lit(False))
    else:
        top = lit_map({k: max(c for c in (v[1], v[2]) if c is not None) for k, v in live.items()}, "bigint")[metric]
        rows = ranked.where(metric.isin(list(live)) & (F.col("Value") <= top))
    own = lit_map({k: v[1] for k, v in live.items()}, "bigint")[metric]
    score = lit_map({k: v[2] for k, v in live.items()}, "bigint")[metric]
    n_points = F.greatest(lit_map({k: v[3] for k, v in live.items()}, "bigint")[metric], F.lit(1).cast("bigint"))
    n_score = F.greatest(lit_map({k: v[4] for k, v in live.items()}, "bigint")[metric], F.lit(1).cast("bigint"))
    ranks = rows.select(
        F.struct(lit_map({k: v[0] for k, v in live.items()}, "int")[metric].alias("m"), F.col("Value").alias("v")).alias("_key"),
        "Value",
        (F.col("ValueRank") + 1).alias("_rn"),  # bands start at the smallest value
        own.alias("_own"),
        score.alias("_cut"),
        n_points.alias("_np"),
        n_score.alias("_ns"),
    )
    return ranks.select(
        "_key",
        F.when(F.col("Value") <= F.col("_cut"), ntile_from_rank("_rn", "_ns", 3)).alias("EliteScore"),
        F.when(F.col("Value") <= F.col("_own"), points_from_rank("_rn", "_np", ELITE_POINTS)).alias("ElitePoints"),
    )


ELITE_TYPES = {"EliteScore": "int", "ElitePoints": POINTS_TYPE}


def assign_elite(
    graded: DataFrame,
    ranked: DataFrame,
    specs: Sequence[EliteSpec],
    bounds: dict[str, Bounds],
    extents: dict[str, Extent],
    metric_specs: Sequence[MetricSpec] = (),
) -> DataFrame:
    """Graded columns + ``EliteSegmentScore_*`` and ``EliteSegmentPoints_*``, without a
    shuffle of ``graded``."""
    bands = elite_lookup(ranked, specs, bounds, extents)
    steps = find_steps(bands, list(ELITE_TYPES))
    levels = F.broadcast(long_key(step_grades(graded, steps, ELITE_TYPES), "s"))
    probed = [i for i, e in enumerate(specs) if i in steps and _by_own_value(e, metric_specs) is None]
    present = F.broadcast(long_key(present_values(bands, probed), "b"))
    stepped = with_steps(graded, steps, {i: e.join_value for i, e in enumerate(specs)})
    kept = [f"b.`{c}`" for c in stepped.columns]
    rounds: list[tuple[list[tuple[DataFrame, str]], list[str]]] = []
    for start in range(0, len(specs), METRICS_PER_ROUND):
        joins: list[tuple[DataFrame, str]] = []
        grades: dict[str, str] = {}
        for i, e in list(enumerate(specs))[start : start + METRICS_PER_ROUND]:
            value = f"CAST(b.`{e.join_value}` AS BIGINT)"
            bound = _upper(bounds, e.name)
            gate = f"b.`{e.gate}` = 5"
            above = f"{value} > " + ("CAST(NULL AS BIGINT)" if bound is None else f"CAST({bound} AS BIGINT)")
            es, ep = "CAST(NULL AS INT)", f"CAST(NULL AS {POINTS_TYPE})"
            if i in steps:
                top = max(c for c in _cuts_of(e, bounds) if c is not None)
                asked = f"{gate} AND {value} <= CAST({top} AS BIGINT)"
                known = f"b.`{e.population}` = 5"
                if i in probed:
                    joins.append((present, key_of(i, f"IF({asked}, bitmap_bucket_number({value}), NULL)")))
                    known = bit_is_set(f"l{len(joins) - 1}.Bits", value)
                joins.append((levels, key_of(i, f"IF({asked} AND {known}, CAST(b.{step_column(i)} AS INT), NULL)")))
                es, ep = (f"l{len(joins) - 1}.`{c}`" for c in ELITE_TYPES)
            score_c, points_c = elite_columns(e)
            grades[score_c] = (
                f"CAST(CASE WHEN {gate} AND {es} IS NULL AND {above} THEN 4 WHEN {gate} AND {es} IS NOT NULL THEN {es} "
                f"ELSE 0 END AS INT)"
            )
            grades[points_c] = (
                f"CAST(CASE WHEN {gate} AND {ep} IS NULL AND {above} THEN 100.00 WHEN {gate} AND {ep} IS NOT NULL THEN {ep} "
                f"ELSE 0.00 END AS {POINTS_TYPE})"
            )
        grades[points_c] = split_code(grades[points_c])
        rounds.append((joins, kept + [f"{g} AS `{name}`" for name, g in grades.items()]))
        kept = kept + [f"b.`{name}`" for name in grades]
    columns = [elite_columns(e)[k] for k in range(2) for e in specs]
    rounds.append(([], [f"b.`{c}`" for c in (*graded.columns, *columns)]))
    return left_join_lookups(stepped, rounds)
