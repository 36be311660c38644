"""

Every query reads the driver's tables (through :mod:`segmint.sources.fixture`) and runs
over them whole. ``VIEWS`` are projections of one pipeline run; each query makes its own
run, whose staged files go when the driver process ends.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmint.operators.activity import converted_rows, customer_activity, customer_sums, merge_sources, source_rows
from segmint.operators.base import BASE_COLUMNS, lrfm_base
from segmint.operators.elite import elite_band_rows, elite_columns
from segmint.operators.grade import band_rows
from segmint.operators.output import CODE_COLUMNS, currency_rows, write_months, write_result
from segmint.operators.rates import daily_rates
from segmint.operators.window import observation_window, tag_windows
from segmint.plans.pipeline import SegmentationResult, build_months, segment_customers, segment_periods
from segmint.plans.specs import DEFAULT_ELITE_SPECS, DEFAULT_METRIC_SPECS
from segmint.session import Stager
from segmint.sources.fixture import BASE_DAY, FIRST_TX_DATE, RATE_CUTOVER, FixtureTables, fixture_tables

WINDOW_PERIODS = (0, 1, 3, 6, 9, 12)
BOUND_PERIODS = (0, 12, 3)
SINK_PERIODS = (3, 0, 12)
FULL_PERIODS = {"segmentation_full": 0, "segmentation_p12": 12, "segmentation_p3": 3, "segmentation_p1": 1,
                "segmentation_p6": 6, "segmentation_p9": 9}


def _fixture(spark: SparkSession, sf_dir: str) -> tuple[FixtureTables, DataFrame]:
    fx = fixture_tables(spark, sf_dir)
    return fx, daily_rates(fx.rates_legacy, fx.rates_current, RATE_CUTOVER)


def fixture_run(spark: SparkSession, sf_dir: str, period: int = 0) -> SegmentationResult:
    fx, rates = _fixture(spark, sf_dir)
    return segment_customers(spark, fx.sources, fx.users, rates, BASE_DAY, period, FIRST_TX_DATE)


def _window(period: int = 0):
    return observation_window(BASE_DAY, period, FIRST_TX_DATE)


def q_window_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx, _ = _fixture(spark, sf_dir)
    windows = [_window(p) for p in WINDOW_PERIODS]
    parts = [
        tag_windows(tx, windows).select(
            "Period", F.lit(name).alias("Source"), "Id", "CustomerKey", F.to_date("CreateDate").alias("CreateDate")
        )
        for name, tx in fx.sources.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def q_daily_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fixture(spark, sf_dir)[1]


def q_valid_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx, _ = _fixture(spark, sf_dir)
    rows = source_rows(fx.sources, _window(0))
    return rows.select("Source", "Id", "CustomerKey", F.to_date("CreateDate").alias("CreateDate"), "Amount", "IsValid")


def q_convert_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx, rates = _fixture(spark, sf_dir)
    rows = converted_rows(fx.sources, rates, _window(0))
    return rows.select(
        "Source", "Id", "CustomerKey", F.to_date("CreateDate").alias("CreateDate"), "Amount", "Price_USDTRY",
        F.col("AmountUSD").cast("decimal(38,15)").alias("AmountUSD"),
    )


_ACTIVITY = ("IdCount", "CountDistinctDate", "MinCreateDate", "MaxCreateDate", "SumAmount", "SumAmountUSD")


def _typed_activity(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return df.select(
        *keys,
        F.col("IdCount").cast("bigint").alias("IdCount"),
        F.col("CountDistinctDate").cast("bigint").alias("CountDistinctDate"),
        "MinCreateDate",
        "MaxCreateDate",
        F.col("SumAmount").cast("decimal(38,2)").alias("SumAmount"),
        F.col("SumAmountUSD").cast("decimal(38,15)").alias("SumAmountUSD"),
    )


def q_customer_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx, rates = _fixture(spark, sf_dir)
    w, names = _window(0), list(fx.sources)
    sums = customer_sums(converted_rows(fx.sources, rates, w), names, w)
    return _typed_activity(customer_activity(sums, names), ("Source", "CustomerKey"))


def q_merge_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx, rates = _fixture(spark, sf_dir)
    w, names = _window(0), list(fx.sources)
    sums = customer_sums(converted_rows(fx.sources, rates, w), names, w)
    return _typed_activity(merge_sources(sums, names), ("CustomerKey",))


def q_lrfm_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx, rates = _fixture(spark, sf_dir)
    w, names = _window(0), list(fx.sources)
    merged = merge_sources(customer_sums(converted_rows(fx.sources, rates, w), names, w), names)
    return lrfm_base(merged, fx.users, w).select(*BASE_COLUMNS)


def q_outlier_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        fixture_run(spark, sf_dir, p).bounds_frame.select(
            F.lit(p).alias("Period"), "Metric", "Customers", "LowerBound", "UpperBound"
        )
        for p in BOUND_PERIODS
    ]
    return reduce(DataFrame.unionByName, parts)


CURRENCY_VALUE_COLUMNS = (
    "Monetary", "AvgTicketSize", "AvgTxVolumePerDay", "M", "TicketSize", "VolumePerDay",
    "MonetaryScore", "AvgTicketSizeScore", "AvgTxVolumePerDayScore",
    "MonetaryPoints", "AvgTicketSizePoints", "AvgTxVolumePerDayPoints",
    "ESByMonetary", "ESByAvgTicketSize", "ESByAvgTxVolumePerDay",
    "ESPointsByMonetary", "ESPointsByAvgTicketSize", "ESPointsByAvgTxVolumePerDay",
)


def _bands(column: str) -> Callable[[SegmentationResult], DataFrame]:
    return lambda r: band_rows(r.ranked, DEFAULT_METRIC_SPECS, r.bounds, r.extents).select("Metric", "Value", column)


def _graded(kind: str) -> Callable[[SegmentationResult], DataFrame]:
    return lambda r: r.graded.select("CustomerKey", *[f"{m.name}{kind}" for m in DEFAULT_METRIC_SPECS])


def _elite(which: int) -> Callable[[SegmentationResult], DataFrame]:
    return lambda r: r.scored.select("CustomerKey", *[elite_columns(e)[which] for e in DEFAULT_ELITE_SPECS])


def _per_currency(columns: tuple[str, ...]) -> Callable[[SegmentationResult], DataFrame]:
    return lambda r: currency_rows(r.scored, ("CustomerKey", "Currency", *columns))


def q_segmentation_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six periods from one scan of the transactions: the months' state is written, read back
    and rolled up per period."""
    fx, rates = _fixture(spark, sf_dir)
    end = _window().base_day
    path = f"{Stager(spark).run_dir}/months"
    write_months(build_months(fx.sources, rates, FIRST_TX_DATE, end), path)
    runs = segment_periods(spark, spark.read.parquet(path), list(fx.sources), fx.users, BASE_DAY, WINDOW_PERIODS, FIRST_TX_DATE)
    return reduce(DataFrame.unionByName, [r.segments for r in runs.values()])


def q_result_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of three periods as it is read back from the sink, one of them written over an
    earlier result of other rows."""
    path = f"{Stager(spark).run_dir}/result"
    for period in SINK_PERIODS:
        run = fixture_run(spark, sf_dir, period)
        if period == SINK_PERIODS[0]:
            write_result(run.segments.where(F.col("Currency") == 0), path, run.window)
        write_result(run.segments, path, run.window)
        run.release()
    return spark.read.parquet(path)


#: Queries that look at one run of period 0.
VIEWS: dict[str, Callable[[SegmentationResult], DataFrame]] = {
    "metric_values": lambda r: r.ranked.select("Metric", "Value", "Customers"),
    "band_points": _bands("Points"),
    "band_scores": _bands("Score"),
    "band_groups": _bands("Group"),
    "assign_groups": _graded("Group"),
    "assign_scores": _graded("Score"),
    "assign_points": _graded("Points"),
    "elite_bounds": lambda r: r.elite_bounds_frame.select("Metric", "Customers", "UpperBound"),
    "elite_bands": lambda r: elite_band_rows(r.elite_ranked, DEFAULT_ELITE_SPECS, r.elite_bounds, r.elite_extents),
    "elite_scores": _elite(0),
    "elite_points": _elite(1),
    "scored_wide": lambda r: r.wide,
    "segment_codes": _per_currency(CODE_COLUMNS),
    "currency_rows": _per_currency(CURRENCY_VALUE_COLUMNS),
}


def _view(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: VIEWS[name](fixture_run(spark, sf_dir))


def _full(period: int) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fixture_run(spark, sf_dir, period).segments


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "window_filter": q_window_filter,
    "daily_rates": q_daily_rates,
    "valid_tx": q_valid_tx,
    "convert_currency": q_convert_currency,
    "customer_activity": q_customer_activity,
    "merge_sources": q_merge_sources,
    "lrfm_base": q_lrfm_base,
    "outlier_bounds": q_outlier_bounds,
    **{name: _view(name) for name in VIEWS},
    **{k: _full(p) for k, p in FULL_PERIODS.items()},
    "segmentation_periods": q_segmentation_periods,
    "result_sink": q_result_sink,
}
