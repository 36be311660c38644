"""The whole segmentation as one function.

Jobs of a run (everything else is lazy and fused by Catalyst):

1. ``base``: scan + filter + broadcast rate join + one aggregation + users join, written
   once to the shared staging folder (every later step reads it).
2. ``histogram``, ``ranked``: the metric histogram, counted once, and its distributed ranks
   (both small, staged).
3. one tiny collect: the per-metric bounds and band extents (a few numbers; the extents
   are read off the percentile positions).
4. ``graded``: base + the bands as step functions, a broadcast of bounded size (map-only).
5. elite ranks and summary, as 2-3; the populations (score 5) are filters on the base,
   and one more tiny count covers the bands cut at another metric's bound.
6. the result: graded + the elite steps, two rows per customer, written by the caller.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from segmint.operators.activity import converted_rows, customer_sums, merge_sources, month_state, sums_of_months
from segmint.operators.bands import (
    Bounds,
    Extent,
    PercentileSpec,
    base_cuts,
    metric_values,
    percentile_bounds,
    rank_values,
    summarize,
)
from segmint.operators.base import lrfm_base, with_metric_values
from segmint.operators.elite import assign_elite, elite_bounds, elite_cuts, elite_values, own_elite_cuts
from segmint.operators.grade import assign_grades, top_score_predicates
from segmint.operators.joins import DEFAULT_BROADCAST_ROWS
from segmint.operators.output import currency_rows, wide_columns
from segmint.operators.rates import rates_in_window
from segmint.operators.window import DEFAULT_FIRST_TX_DATE, LOOKBACK_PERIODS, ObservationWindow, observation_window
from segmint.plans.specs import DEFAULT_ELITE_SPECS, DEFAULT_METRIC_SPECS, EliteSpec, MetricSpec
from segmint.session import Stager, phase

#: Fixed values of the procedure: all history, and the look-back periods in months.
ALL_PERIODS = (0, *LOOKBACK_PERIODS)


@dataclass
class SegmentationResult:
    window: ObservationWindow
    base: DataFrame  # base columns + sums + integer values (staged)
    ranked: DataFrame  # (Metric, Value, Customers, CustomersBefore, ValueRank)
    bounds_frame: DataFrame
    bounds: dict[str, Bounds]
    extents: dict[str, Extent]
    graded: DataFrame
    elite_ranked: DataFrame
    elite_bounds_frame: DataFrame
    elite_bounds: dict[str, Bounds]
    elite_extents: dict[str, Extent]
    scored: DataFrame  # graded + elite columns
    wide: DataFrame  # one row per customer: base columns and every grade in both currencies
    segments: DataFrame  # the result: two rows per customer
    stager: Stager | None = None

    def release(self) -> None:
        """Remove the staged intermediates once the result has been written."""
        if self.stager is not None:
            self.stager.release()


def base_stage(
    sources: Mapping[str, DataFrame],
    users: DataFrame,
    rates: DataFrame,
    window: ObservationWindow,
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    rate_rows: int | None = None,
) -> DataFrame:
    """U3-U7 + integer values, lazily."""
    sums = customer_sums(converted_rows(sources, rates, window, broadcast_rows, rate_rows), list(sources), window)
    merged = merge_sources(sums, list(sources))
    return with_metric_values(lrfm_base(merged, users, window))


def segment_customers(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    users: DataFrame,
    rates: DataFrame,
    day: date,
    period: int,
    first_tx_date: date = DEFAULT_FIRST_TX_DATE,
    metric_specs: Sequence[MetricSpec] = DEFAULT_METRIC_SPECS,
    elite_specs: Sequence[EliteSpec] = DEFAULT_ELITE_SPECS,
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    stage: bool = True,
    staging_dir: str | None = None,
    run_name: str | None = None,
) -> SegmentationResult:
    """Segment every customer active in the window ending at ``day``'s month start.

    ``sources``: transaction tables by name (the procedure has a hot and an archive one);
    ``rates``: the output of :func:`segmint.operators.rates.daily_rates`. Intermediates are
    staged under ``staging_dir`` (default: the session's checkpoint folder) until the
    result's ``release()``; a failing run removes its own.

    With a ``run_name`` a failing or killed run keeps them instead, and the next call with that
    name (and the same parameters, else it is refused) goes on after the last finished stage.
    The inputs must not have changed meanwhile; that is the caller's to know.
    """
    window = observation_window(day, period, first_tx_date)
    manifest = repr((window, sorted(sources), tuple(metric_specs), tuple(elite_specs)))
    stager = Stager(spark, enabled=stage, root=staging_dir, run=run_name, manifest=manifest)
    try:
        return _segment(spark, stager, sources, users, rates, window, metric_specs, elite_specs, broadcast_rows)
    except BaseException:
        if run_name is None:
            stager.release()
        raise


def _segment(
    spark: SparkSession,
    stager: Stager,
    sources: Mapping[str, DataFrame],
    users: DataFrame,
    rates: DataFrame,
    window: ObservationWindow,
    metric_specs: Sequence[MetricSpec],
    elite_specs: Sequence[EliteSpec],
    broadcast_rows: int,
) -> SegmentationResult:
    with phase(spark, "base"):
        # the window's day rates: at most a few rows per day, staged and counted once
        day_rates = stager.stage(rates_in_window(rates, window), "rates")
        base = stager.stage(
            base_stage(sources, users, day_rates, window, broadcast_rows, rate_rows=day_rates.count()), "base"
        )
    return _graded_result(spark, stager, base, window, metric_specs, elite_specs)


def build_months(
    sources: Mapping[str, DataFrame],
    rates: DataFrame,
    first: date,
    end: date,
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """The mergeable state of the months from ``first`` up to (excluding) ``end``: what every
    segmentation over those months needs of the transactions, a row per customer and month.

    Months do not depend on each other: write them partitioned by ``Month`` once
    (:func:`segmint.operators.output.write_months`) and add each new month as it closes.
    """
    span = ObservationWindow(end, end, 0, first)
    return month_state(converted_rows(sources, rates, span, broadcast_rows), list(sources))


def segment_periods(
    spark: SparkSession,
    state: DataFrame,
    source_names: Sequence[str],
    users: DataFrame,
    day: date,
    periods: Sequence[int] = ALL_PERIODS,
    first_tx_date: date = DEFAULT_FIRST_TX_DATE,
    metric_specs: Sequence[MetricSpec] = DEFAULT_METRIC_SPECS,
    elite_specs: Sequence[EliteSpec] = DEFAULT_ELITE_SPECS,
    staging_dir: str | None = None,
) -> dict[int, SegmentationResult]:
    """One segmentation per period from a months' state (:func:`build_months`, whole months from
    ``first_tx_date`` and from the earliest period on): the transactions are not read again.

    ``first_tx_date`` must begin a month, or the state must have been built from that day on and
    no period may start earlier, because a month of the state is taken whole.
    """
    windows = [observation_window(day, p, first_tx_date) for p in periods]
    if first_tx_date.day != 1 and any(w.start is not None and w.start < first_tx_date for w in windows):
        raise ValueError("first_tx_date lies inside a month that another period needs whole")
    out: dict[int, SegmentationResult] = {}
    try:
        for window in windows:
            stager = Stager(spark, root=staging_dir)
            try:
                with phase(spark, f"base {window.period}"):
                    merged = merge_sources(sums_of_months(state, source_names, window), source_names)
                    base = stager.stage(with_metric_values(lrfm_base(merged, users, window)), "base")
                out[window.period] = _graded_result(spark, stager, base, window, metric_specs, elite_specs)
            except BaseException:
                stager.release()
                raise
    except BaseException:
        for r in out.values():
            r.release()
        raise
    return out


def _graded_result(
    spark: SparkSession,
    stager: Stager,
    base: DataFrame,
    window: ObservationWindow,
    metric_specs: Sequence[MetricSpec],
    elite_specs: Sequence[EliteSpec],
) -> SegmentationResult:
    """U8-U20 over a staged base table."""
    with phase(spark, "ranks"):
        histogram = stager.stage(metric_values(base, metric_specs), "histogram")
        ranked = stager.stage(rank_values(histogram), "ranked")
    with phase(spark, "bounds"):
        bounds_frame = percentile_bounds(ranked, [PercentileSpec(m.name, m.p_low, m.p_high) for m in metric_specs])
        cuts = base_cuts(metric_specs)
        bounds, extents = summarize(ranked, bounds_frame, cuts, own=set(cuts))

    with phase(spark, "grades"):
        graded = assign_grades(base, ranked, metric_specs, bounds, extents)

    # the elite populations (score 5) are slices of the ranked base histogram, or literal filters
    # on the staged base: no grade joins
    top = top_score_predicates(metric_specs, bounds)
    pop_source = base if all(e.population in top for e in elite_specs) else graded
    with phase(spark, "elite ranks"):
        ehistogram = stager.stage(elite_values(pop_source, elite_specs, top, ranked, bounds, metric_specs), "elite_histogram")
        eranked = stager.stage(rank_values(ehistogram), "elite_ranked")
    with phase(spark, "elite bounds"):
        ebounds_frame = elite_bounds(eranked, elite_specs)
        ebounds, eextents = summarize(eranked, ebounds_frame, elite_cuts(elite_specs), own=own_elite_cuts(elite_specs))

    with phase(spark, "elite grades"):
        scored = assign_elite(graded, eranked, elite_specs, ebounds, eextents, metric_specs)
    return SegmentationResult(
        window=window,
        base=base,
        ranked=ranked,
        bounds_frame=bounds_frame,
        bounds=bounds,
        extents=extents,
        graded=graded,
        elite_ranked=eranked,
        elite_bounds_frame=ebounds_frame,
        elite_bounds=ebounds,
        elite_extents=eextents,
        scored=scored,
        wide=scored.select(*wide_columns(metric_specs, elite_specs)),
        segments=currency_rows(scored),
        stager=stager,
    )
