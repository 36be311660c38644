"""Property tests of the exact building blocks against Spark's own operators / exact math."""

import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from segmint.functions.exact import (
    BASE_POINTS,
    ELITE_POINTS,
    floor_div,
    ntile_from_rank,
    points_cents,
)
from segmint.operators.bands import PercentileSpec, percentile_bounds, rank_values, value_histogram


def percentile_positions(n: int, p: int) -> tuple[int, int]:
    """0-based position and remainder (in hundredths) of percentile ``p`` of ``n`` values."""
    return divmod(p * (n - 1), 100)


def percentile_bound(x_q: int, x_next: int | None, r: int, upper: bool) -> int:
    """Floor (lower) or ceiling (upper) of the interpolated percentile."""
    num = x_q * (100 - r) + (x_next * r if r else 0)
    return -((-num) // 100) if upper else num // 100


@pytest.mark.parametrize("buckets", [2, 3])
def test_ntile_from_rank_equals_spark_ntile(spark, buckets):
    df = spark.range(1, 121).select(F.col("id").alias("n")).select(
        "n", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("rn")
    )
    w = Window.partitionBy("n").orderBy("rn")
    got = df.select(
        (ntile_from_rank("rn", "n", buckets) == F.ntile(buckets).over(w)).alias("ok")
    ).where(~F.col("ok"))
    assert got.count() == 0


@pytest.mark.parametrize("scale", [BASE_POINTS, ELITE_POINTS])
def test_points_equal_half_up_rounding_of_the_exact_quotient(spark, scale):
    rows = spark.range(2, 601).select(F.col("id").alias("n")).select(
        "n", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("rn")
    ).select("n", "rn", points_cents("rn", "n", scale).alias("c")).collect()
    for r in rows:
        exact = Fraction(scale.low) + Fraction(scale.span * (r.rn - 1), r.n - 1)
        half_up = int((Decimal(exact.numerator) / Decimal(exact.denominator)).quantize(Decimal(1), rounding=ROUND_HALF_UP))
        # 28 significant digits are far more than any quotient here needs
        assert r.c == half_up, (r.n, r.rn)


def test_points_single_value_band_is_the_low_end(spark):
    r = spark.range(1).select(F.lit(1).cast("bigint").alias("rn"), F.lit(1).cast("bigint").alias("n"))
    assert r.select(points_cents("rn", "n", BASE_POINTS)).first()[0] == 105
    assert r.select(points_cents("rn", "n", ELITE_POINTS)).first()[0] == 100


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(min_value=-(2**40), max_value=2**40), min_size=1, max_size=40), st.integers(1, 1000))
def test_floor_div_is_exact(spark, values, b):
    df = spark.createDataFrame([(v,) for v in values], "a bigint")
    got = [r[0] for r in df.select(floor_div("a", b)).collect()]
    assert got == [v // b for v in values]


def _brute_ranks(values):
    """Per value: customers with a smaller value, and rank among distinct values."""
    distinct = sorted(set(values))
    return {v: (sum(1 for x in values if x < v), i) for i, v in enumerate(distinct)}


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.one_of(st.integers(-20000, 20000), st.integers(-(2**31), 2**31 - 1), st.sampled_from([0, 4095, 4096, -1])),
        min_size=1,
        max_size=300,
    )
)
def test_two_level_ranks_equal_global_ranks(spark, values):
    long = spark.createDataFrame([("m", v) for v in values] + [("k", v // 3) for v in values], "Metric string, Value bigint")
    got = {(r.Metric, r.Value): (r.CustomersBefore, r.ValueRank) for r in rank_values(value_histogram(long)).collect()}
    for metric, vals in (("m", values), ("k", [v // 3 for v in values])):
        for v, want in _brute_ranks(vals).items():
            assert got[(metric, v)] == want


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-(10**7), 10**7), min_size=1, max_size=200), st.sampled_from([(5, 95), (1, 99)]))
def test_percentile_bounds_are_exact(spark, values, ps):
    long = spark.createDataFrame([("m", v) for v in values], "Metric string, Value bigint")
    ranked = rank_values(value_histogram(long))
    row = percentile_bounds(ranked, [PercentileSpec("m", ps[0], ps[1])]).first()
    xs = sorted(values)
    for p, upper, got in ((ps[0], False, row.LowerBound), (ps[1], True, row.UpperBound)):
        q, r = percentile_positions(len(xs), p)
        want = percentile_bound(xs[q], xs[q + 1] if r else None, r, upper)
        exact = Fraction(xs[q]) + Fraction(r, 100) * ((xs[q + 1] - xs[q]) if r else 0)
        assert want == (-((-exact.numerator) // exact.denominator) if upper else exact.numerator // exact.denominator)
        assert got == want


def test_percentile_bounds_skip_empty_metrics(spark):
    long = spark.createDataFrame([("m", 3)], "Metric string, Value bigint")
    rows = percentile_bounds(rank_values(value_histogram(long)), [PercentileSpec("m", 5, 95), PercentileSpec("x", 5, 95)]).collect()
    assert [(r.Metric, r.LowerBound, r.UpperBound) for r in rows] == [("m", 3, 3)]


def test_random_percentiles_match_duckdb_integers():
    """Sanity of the integer interpolation against DuckDB's own (double) quantile_cont where
    the double result is far from an integer boundary."""
    import duckdb

    rnd = random.Random(5)
    con = duckdb.connect()
    for _ in range(50):
        xs = [rnd.randint(-1000, 1000) for _ in range(rnd.randint(1, 60))]
        q, r = percentile_positions(len(xs), 5)
        s = sorted(xs)
        lo = percentile_bound(s[q], s[q + 1] if r else None, r, False)
        d = con.sql(f"SELECT quantile_cont(v, 0.05) FROM (SELECT unnest({xs}) AS v)").fetchall()[0][0]
        if abs(d - round(d)) > 1e-6:
            assert lo == int(Decimal(d).to_integral_value(rounding="ROUND_FLOOR"))


@settings(max_examples=20, deadline=None)
@given(
    st.lists(st.integers(-5000, 5000), min_size=1, max_size=150),
    st.lists(st.integers(0, 300), min_size=1, max_size=80),
    st.sampled_from([(5, 95), (1, 99), (None, 99)]),
)
def test_band_extents_from_the_bounds_equal_counting(spark, xs, ys, ps):
    """First rank and size read off the percentile positions = counting values in the band."""
    from segmint.operators.bands import Cut, summarize

    long = spark.createDataFrame([("m", v) for v in xs] + [("k", v) for v in ys], "Metric string, Value bigint")
    ranked = rank_values(value_histogram(long))
    specs = [PercentileSpec("m", ps[0], ps[1]), PercentileSpec("k", ps[0], ps[1])]
    bounds = percentile_bounds(ranked, specs)
    use_lower = ps[0] is not None
    cuts = {"m": Cut("m", "m", use_lower), "k": Cut("k", "k", use_lower)}
    assert summarize(ranked, bounds, cuts, own=set(cuts)) == summarize(ranked, bounds, cuts, own=set())
