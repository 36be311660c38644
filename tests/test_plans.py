"""Physical-plan properties the design depends on at scale (read from ``explain``)."""

import re
from datetime import date

import pytest

from handmade import generate
from segmint.operators.window import observation_window
from segmint.plans.pipeline import base_stage, segment_customers

BASE_DAY = date(2024, 6, 20)
FIRST_TX = date(2023, 1, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def run(spark):
    sources, users, rates = generate(31).spark_frames(spark)
    return sources, users, rates, segment_customers(spark, sources, users, rates, BASE_DAY, 12, FIRST_TX)


def test_no_python_udfs_cartesian_products_or_global_windows(run):
    res = run[3]
    for df in (res.base, res.ranked, res.graded, res.scored, res.segments, res.bounds_frame, res.elite_bounds_frame):
        p = plan(df)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
        # every window is partitioned (no single-task ranking over all values)
        for m in re.finditer(r"Window \[.*?\], \[(.*?)\], \[", p):
            assert m.group(1).strip(), p


def test_base_stage_pushes_filters_broadcasts_rates_and_combines_map_side(spark, tmp_path, run):
    sources, users, rates, _ = run
    # read the sources back from Parquet so scan pushdown is visible
    for name, df in sources.items():
        df.write.parquet(str(tmp_path / name))
    parquet_sources = {name: spark.read.parquet(str(tmp_path / name)) for name in sources}
    df = base_stage(parquet_sources, users, rates, observation_window(BASE_DAY, 12, FIRST_TX))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        p = plan(df)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", p)
    assert len(pushed) == 2, p  # one scan per source
    for f in pushed:
        for want in ("EqualTo(FeatureType,2)", "EqualTo(CardTxType,1)", "GreaterThanOrEqual(CreateDate,2023-06-01T00:00)",
                     "LessThan(CreateDate,2024-06-01T00:00)"):
            assert want in f, f
    assert re.search(r"BroadcastHashJoin \[cast\(CreateDate#\d+ as date\)\], \[_rate_date", p), p
    # one exchange of the transactions, fed by a partial aggregate; the users are the other one
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    assert sorted(k.split("#")[0] for k in keys) == ["CustomerKey", "User_Key"], keys
    assert "partial_count" in p and "partial_sum" in p and "partial_bit_or" in p
    # fixed-width buffers: hash aggregates all the way, nothing sorted before the exchange
    assert "ObjectHashAggregate" not in p and "SortAggregate" not in p, p
    before_exchange = p[p.index("partial_bit_or") : p.index("- Union")]
    assert not re.search(r"\bSort \[", before_exchange), p


def _without_broadcast_sides(p: str) -> str:
    """The plan text less what feeds a broadcast (those subtrees are bounded tables)."""
    kept, hidden = [], None
    for line in p.split("\n"):
        depth = len(line) - len(line.lstrip(" :+-|*()0123456789"))
        if hidden is not None and depth > hidden:
            continue
        hidden = depth if "BroadcastExchange" in line else None
        kept.append(line)
    return "\n".join(kept)


def test_grading_never_shuffles_the_customers(run):
    """At any size of the bands: only bounded tables are broadcast, all joins are map-side."""
    res = run[3]
    for df in (res.graded, res.scored, res.segments):
        p = plan(df)
        assert "BroadcastHashJoin" in p
        assert "SortMergeJoin" not in p and "ShuffledHashJoin" not in p, p
        assert "Exchange hashpartitioning" not in _without_broadcast_sides(p), p


def test_steps_are_bounded_however_many_values(spark):
    """A band of 300,000 values has at most 9,891 point levels; every value gets its own grades."""
    from pyspark.sql import functions as F

    from segmint.functions.exact import BASE_POINTS, ntile_from_rank, points_from_rank
    from segmint.operators.steps import MAX_STEPS, find_steps, present_values, step_column, step_grades, with_steps, bit_is_set

    n = 300_000
    values = spark.range(n).select((F.col("id") * 3 - 1000).alias("v"), (F.col("id") + 1).alias("_rn"), F.lit(n).cast("bigint").alias("_n"))
    bands = values.select(
        F.struct(F.lit(4).alias("m"), F.col("v")).alias("_key"), (ntile_from_rank("_rn", "_n", 2) - 1).alias("Group"),
        (ntile_from_rank("_rn", "_n", 3) + 1).alias("Score"), points_from_rank("_rn", "_n", BASE_POINTS).alias("Points"),
    )
    types = {"Group": "int", "Score": "int", "Points": "decimal(18,2)"}
    steps = find_steps(bands, list(types))
    assert 9_000 < len(steps[4].firsts) <= MAX_STEPS
    asked = bands.select("_key.v", *types)
    found = with_steps(asked, steps, {4: "v"}).select("*", F.struct(F.lit(4).alias("m"), F.col(step_column(4)).cast("int").alias("s")).alias("_key"))
    found = found.alias("a").join(F.broadcast(step_grades(asked, steps, types)).alias("s"), "_key")
    assert found.count() == n
    assert found.where("a.Group <> s.Group OR a.Score <> s.Score OR a.Points <> s.Points").count() == 0
    bits = present_values(bands, [4])
    assert bits.count() == 29  # 900,000 integers in buckets of 32,768, and one below 1
    probe = spark.range(-1010, 3 * n - 990).withColumn("_key", F.expr("struct(4 AS m, bitmap_bucket_number(id) AS b)"))
    held = probe.join(F.broadcast(bits), "_key", "left").where(F.expr(bit_is_set("Bits", "id")))
    assert held.count() == n and held.select("id").exceptAll(values.select("v")).count() == 0


def test_periods_from_months_read_the_transactions_once(spark, tmp_path, run):
    from segmint.operators.output import write_months
    from segmint.plans.pipeline import build_months, segment_periods

    sources, users, rates, res = run
    for name, df in sources.items():
        df.write.parquet(str(tmp_path / name))
    stored = {name: spark.read.parquet(str(tmp_path / name)) for name in sources}
    months, end = str(tmp_path / "months"), res.window.base_day
    write_months(build_months(stored, rates, FIRST_TX, date(2024, 2, 1)), months)
    # the later months as they close; one is written twice, and replaced
    for first, last in ((date(2024, 2, 1), date(2024, 4, 1)), (date(2024, 3, 1), end)):
        write_months(build_months(stored, rates, first, last), months)
    state = spark.read.parquet(months)
    runs = segment_periods(spark, state, list(sources), users, BASE_DAY, (0, 12, 3, 1), FIRST_TX)
    for period, got in runs.items():
        want = segment_customers(spark, sources, users, rates, BASE_DAY, period, FIRST_TX).segments
        assert got.segments.count() == want.count() > 0
        assert got.segments.exceptAll(want).count() == 0
        p = got.base._jdf.queryExecution().toString() + got.segments._jdf.queryExecution().toString()
        assert str(tmp_path / "hot") not in p and str(tmp_path / "archive") not in p
        got.release()
    with pytest.raises(ValueError, match="inside a month"):
        segment_periods(spark, state, list(sources), users, BASE_DAY, (0, 12), date(2024, 1, 15))


def test_months_are_written_in_files_by_their_size(spark, tmp_path):
    """Not one file per task and month: reading the months would cost most of its time in opening them."""
    import os

    from pyspark.sql import functions as F

    from segmint.operators.output import write_months

    rows = spark.range(0, 6000, 1, 8).select(
        F.col("id").alias("CustomerKey"), F.expr("add_months(DATE'2023-01-01', CAST(id % 5 AS INT))").alias("Month")
    )
    path = str(tmp_path / "months")
    write_months(rows, path)
    files = {d: [f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")] for d in os.listdir(path) if d.startswith("Month=")}
    assert len(files) == 5 and all(len(f) == 1 for f in files.values()), files
    assert spark.read.parquet(path).exceptAll(rows).count() == 0 and spark.read.parquet(path).count() == 6000


def test_grading_code_can_be_compiled(spark, run):
    """The JVM interprets methods above 8,000 bytes for ever: no chain of lookups may reach that."""
    res = run[3]
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (res.graded, res.scored, res.segments, res.wide):
            code = spark._jvm.PythonSQLUtils.explainString(df.select("*")._jdf.queryExecution(), "codegen")
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
            assert sizes and max(sizes) < 8000, sizes
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_each_histogram_is_computed_once(run):
    """The histograms are written tables: ranking joins two reads of them, not of the base."""
    import os

    from segmint.operators.bands import metric_values, rank_values
    from segmint.plans.specs import DEFAULT_METRIC_SPECS

    res = run[3]
    folder = re.sub("^file:/+", "/", res.stager.run_dir)
    assert set(os.listdir(folder)) == {"rates", "base", "histogram", "ranked", "elite_histogram", "elite_ranked"}
    assert plan(metric_values(res.base, DEFAULT_METRIC_SPECS)).count("FileScan parquet") == 1
    ranking = plan(rank_values(res.base.sparkSession.read.parquet(f"{folder}/histogram")))
    reads = re.findall(r"ReadSchema: struct<([^>]*)>", ranking)
    assert reads and all(r.startswith("Metric:string,Value:bigint") for r in reads), ranking


def test_elite_populations_do_not_rejoin_the_grades(run):
    from segmint.operators.elite import elite_values
    from segmint.operators.grade import top_score_predicates
    from segmint.plans.specs import DEFAULT_ELITE_SPECS, DEFAULT_METRIC_SPECS

    res = run[3]
    hist = elite_values(res.base, DEFAULT_ELITE_SPECS, top_score_predicates(DEFAULT_METRIC_SPECS, res.bounds))
    p = plan(hist)
    assert "Join" not in p, p
    assert re.search(r"PushedFilters: \[[^\]]*Or\(", p), p  # population bounds reach the staged-base scan


def test_date_partitioned_sources_prune_partitions(spark, tmp_path, run):
    from pyspark.sql import functions as F

    from segmint.sources.readers import read_transactions

    sources = run[0]
    path = str(tmp_path / "tx_by_day")
    sources["hot"].withColumn("dt", F.to_date("CreateDate")).write.partitionBy("dt").parquet(path)
    w = observation_window(BASE_DAY, 1, FIRST_TX)
    df = read_transactions(spark, path, window=w, date_partition="dt")
    p = plan(df)
    assert re.search(r"PartitionFilters: \[[^\]]*dt#\d+ >= 2024-05-01", p), p
    full = read_transactions(spark, path)
    assert df.count() == full.where((F.col("CreateDate") >= "2024-05-01") & (F.col("CreateDate") < "2024-06-01")).count()


def test_sources_bucketed_by_customer_need_no_activity_shuffle(spark, tmp_path, run):
    """Catalog tables bucketed by CustomerKey: the activity aggregation runs without an
    exchange (the union keeps the bucketing); only the users side is shuffled to match."""
    from segmint.sources.readers import read_transactions

    sources, users, rates, _ = run
    names = {}
    for n, df in sources.items():
        names[n] = f"segmint_test_tx_{n}"
        df.write.bucketBy(4, "CustomerKey").option("path", str(tmp_path / n)).mode("overwrite").saveAsTable(names[n])
    try:
        bucketed = {n: read_transactions(spark, t, "table") for n, t in names.items()}
        p = plan(base_stage(bucketed, users, rates, observation_window(BASE_DAY, 0, FIRST_TX)))
        keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
        assert all(k.startswith("User_Key#") for k in keys), keys
    finally:
        for t in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {t}")
