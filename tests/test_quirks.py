
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.errors import PySparkException

from handmade import Inputs, generate
from segmint.operators.rates import daily_rates
from segmint.operators.window import observation_window
from segmint.plans.pipeline import base_stage, segment_customers
from segmint.plans.specs import CONSISTENT_ELITE_SPECS, CONSISTENT_METRIC_SPECS

BASE_DAY = date(2024, 6, 20)  # -> month start 2024-06-01
FIRST_TX = date(2023, 1, 1)
D = Decimal


def tx(i, cust, day, amount, cancel=0, operator=None, feature=2, card=1, hour=10):
    d = date.fromisoformat(day)
    return (i, cust, datetime(d.year, d.month, d.day, hour), D(amount), cancel, operator, feature, card)


def user(cust, day="2022-05-10"):
    d = date.fromisoformat(day)
    return (cust, datetime(d.year, d.month, d.day, 8))


def base_rows(spark, inp: Inputs, period=0):
    sources, users, rates = inp.spark_frames(spark)
    w = observation_window(BASE_DAY, period, FIRST_TX)
    return {r.CustomerKey: r for r in base_stage(sources, users, rates, w).collect()}


def test_observation_windows():
    w0 = observation_window(date(2001, 7, 15), 0, date(1995, 1, 1))
    assert (w0.base_day, w0.year_month, w0.start) == (date(2001, 7, 1), date(2001, 6, 1), date(1995, 1, 1))
    starts = {p: observation_window(date(2024, 3, 31), p).start for p in (1, 3, 6, 9, 12)}
    assert starts == {1: date(2024, 2, 1), 3: date(2023, 12, 1), 6: date(2023, 9, 1), 9: date(2023, 6, 1), 12: date(2023, 3, 1)}
    assert observation_window(date(2024, 3, 31), 0).start == date(2013, 1, 1)
    assert observation_window(date(2024, 3, 31), 7).empty


def test_base_metrics_and_source_merge(spark):
    inp = Inputs()
    inp.rates = [(date(2024, 5, 1), D("2")), (date(2024, 5, 2), D("2")), (date(2024, 5, 2), D("4")), (date(2024, 5, 3), D("1"))]
    hot, arch = inp.tx["hot"], inp.tx["archive"]
    # 1: only on a day without rate (Q3)
    hot.append(tx(1, 1, "2024-04-30", "-100.00"))
    # 2: a day with two rates (Q5)
    hot.append(tx(2, 2, "2024-05-02", "-40.00"))
    # 3: archive holds only an invalid row -> archive dropped, amount too (Q6)
    hot.append(tx(3, 3, "2024-05-01", "-10.00"))
    arch.append(tx(4, 3, "2024-05-03", "50.00", cancel=1))
    # 4: the same day in both sources counts twice (Q6)
    hot.append(tx(5, 4, "2024-05-03", "-10.00"))
    arch.append(tx(6, 4, "2024-05-03", "-20.00", hour=11))
    # 5: two user rows multiply (Q12); 6: no user row -> gone
    hot.append(tx(7, 5, "2024-05-01", "-30.00"))
    hot.append(tx(8, 6, "2024-05-01", "-30.00"))
    # 7: an invalid reversal in a kept source nets out; 8: another card type is ignored
    hot += [tx(9, 7, "2024-05-01", "-100.00"), tx(10, 7, "2024-05-01", "30.00", operator=3)]
    hot += [tx(11, 8, "2024-05-01", "-100.00"), tx(12, 8, "2024-05-03", "-999.00", feature=1)]
    # outside the window: on the month start itself
    hot.append(tx(13, 8, "2024-06-01", "-5.00", hour=0))
    inp.users = [user(c) for c in (1, 2, 3, 4, 7, 8)] + [user(5, "2021-01-01"), user(5, "2022-02-02")]
    b = base_rows(spark, inp)

    assert set(b) == {1, 2, 3, 4, 5, 7, 8}
    assert b[1].Monetary == D("100") and b[1].MonetaryUSD is None
    assert b[1].AvgTicketSizeUSD == 0.0 and b[1].AvgTxVolumePerDayUSD == 0.0
    assert (b[2].Frequency, b[2].DistinctTxDayCount, b[2].Monetary, b[2].MonetaryUSD) == (2, 1, D("80"), D("30"))
    assert (b[3].Frequency, b[3].Monetary, b[3].LastTxDate) == (1, D("10"), date(2024, 5, 1))
    assert (b[4].Frequency, b[4].DistinctTxDayCount, b[4].Length, b[4].Monetary) == (2, 2, 1, D("30"))
    assert (b[5].Frequency, b[5].DistinctTxDayCount, b[5].Monetary) == (2, 2, D("60"))
    assert b[5].RegisterDate == date(2022, 2, 2)
    assert b[5].RegisterDateToFirstTxDate == (date(2024, 5, 1) - date(2021, 1, 1)).days + 1
    assert (b[7].Frequency, b[7].Monetary) == (1, D("70"))
    assert (b[8].Frequency, b[8].Monetary, b[8].LastTxDate) == (1, D("100"), date(2024, 5, 1))
    assert b[8].Recency == (date(2024, 6, 1) - date(2024, 5, 1)).days - 1
    assert b[8].AvgTicketSize == 100.0 and b[8].AvgTxCountPerDay == 1.0 and b[8].TxRangeOfDaysFrequency == 1.0


def test_register_gap_only_for_full_history(spark):
    inp = Inputs()
    inp.rates = [(date(2024, 5, 1), D("2"))]
    inp.tx["hot"].append(tx(1, 1, "2024-05-01", "-10.00"))
    inp.users = [user(1)]
    assert base_rows(spark, inp, period=0)[1].RegisterDateToFirstTxDate is not None
    assert base_rows(spark, inp, period=12)[1].RegisterDateToFirstTxDate is None


def _band_table_inputs() -> Inputs:
    """40 single-day customers on rate-2 days with tickets 100 + 97k, one customer with a
    9.99 ticket on a rate-0.01 day (USD ticket 999, in the USD bounds but no eligible
    customer has it), one with a reversal above its spend."""
    inp = Inputs()
    inp.rates = [(date(2024, 4, 1), D("2")), (date(2024, 4, 2), D("0.01"))]
    for k in range(40):
        inp.tx["hot"].append(tx(k + 1, k + 1, "2024-04-01", f"-{100 + 97 * k}.00"))
        inp.users.append(user(k + 1))
    inp.tx["hot"].append(tx(100, 100, "2024-04-02", "-9.99"))
    inp.tx["hot"] += [tx(101, 101, "2024-04-01", "-10.00"), tx(102, 101, "2024-04-01", "59.90", cancel=1)]
    inp.users += [user(100), user(101)]
    return inp


def test_grades_out_of_set_values_empty_population_and_negatives(spark):
    sources, users, rates = _band_table_inputs().spark_frames(spark)
    res = segment_customers(spark, sources, users, rates, BASE_DAY, 0, FIRST_TX)
    g = {r.CustomerKey: r for r in res.graded.collect()}

    # Q1: inside the USD bounds, but no eligible customer has that value -> NULL
    b = res.bounds["AvgTicketSizeUSD"]
    assert b.lower <= g[100].AvgTicketSizeUSDINT == 999 <= b.upper
    assert (g[100].AvgTicketSizeUSDGroup, g[100].AvgTicketSizeUSDScore, g[100].AvgTicketSizeUSDPoints) == (None, None, None)
    assert (g[100].AvgTicketSizeGroup, g[100].AvgTicketSizeScore, g[100].AvgTicketSizePoints) == (0, 1, D("1.00"))

    # Q4: nobody has Length > 1 or Frequency > 2 -> no bounds, all NULL
    assert "Length" not in res.bounds and "Frequency" not in res.bounds
    assert all(r.LengthGroup is None and r.FrequencyScore is None and r.FrequencyPoints is None for r in g.values())

    # Q10 (deviation): one Recency value in band -> points at the low end, middle score
    assert res.extents["Recency"].size == 1
    assert {(r.RecencyPoints, r.RecencyScore, r.RecencyGroup) for r in g.values()} <= {(D("1.05"), 2, 0), (D("100.00"), 5, 1)}

    # Q13 / Q7: reversal above spend -> negative Monetary, int truncates toward zero
    assert g[101].Monetary == D("-49.9") and g[101].MonetaryINT == -49
    assert (g[101].MonetaryGroup, g[101].MonetaryScore, g[101].MonetaryPoints) == (0, 1, D("1.00"))

    # bands by value: ranks ascend with the value, ends 1.05 / 99.95
    band = sorted((r.MonetaryINT, r.MonetaryPoints) for r in g.values() if b.lower is not None and r.MonetaryPoints is not None
                  and res.bounds["Monetary"].lower <= r.MonetaryINT <= res.bounds["Monetary"].upper)
    pts = [p for _, p in band]
    assert pts == sorted(pts) and pts[0] == D("1.05") and pts[-1] == D("99.95")


def test_codes_skip_null_digits_and_rows_are_consistent(spark):
    sources, users, rates = generate(21).spark_frames(spark)
    rows = [r.asDict() for r in segment_customers(spark, sources, users, rates, BASE_DAY, 0, FIRST_TX).segments.collect()]

    def code(*xs):
        return "".join(str(x) for x in xs if x is not None)

    by_key = {}
    for r in rows:
        assert r["LR"] == code(r["L"], r["R"])
        assert r["LRFM"] == code(r["L"], r["R"], r["F"], r["M"])
        assert r["FM_ByTicketSize"] == code(r["F"], r["TicketSize"])
        assert r["LRFM_ByVolumePerDay"] == code(r["L"], r["R"], r["F"], r["VolumePerDay"])
        assert r["RFM_Score"] == code(r["RecencyScore"], r["FrequencyScore"], r["MonetaryScore"])
        for c in ("L", "R", "F", "M", "TicketSize", "VolumePerDay"):
            assert r[c] in (None, 0, 1)
        for c in ("LengthScore", "RecencyScore", "FrequencyScore", "MonetaryScore", "AvgTicketSizeScore", "AvgTxVolumePerDayScore"):
            assert r[c] in (None, 1, 2, 3, 4, 5)
        for c in ("ESByMonetary", "ESByAvgTicketSize", "ESByAvgTxVolumePerDay"):
            assert r[c] in (0, 1, 2, 3, 4)
        for c in ("LengthPoints", "MonetaryPoints", "ESPointsByMonetary"):
            assert r[c] is None or D("0") <= r[c] <= D("100")
        by_key.setdefault(r["CustomerKey"], {})[r["Currency"]] = r
    shorter = 0
    for cur in by_key.values():
        assert set(cur) == {0, 1}
        for c in ("Length", "Recency", "Frequency", "L", "R", "F", "LengthScore", "LengthPoints", "LR"):
            assert cur[0][c] == cur[1][c]
        shorter += len(cur[1]["RFM_Score"]) < 3
    assert shorter > 0  # Q2 occurs: some USD codes miss a digit


def test_unsupported_period_gives_an_empty_result(spark):
    sources, users, rates = generate(3).spark_frames(spark)
    res = segment_customers(spark, sources, users, rates, BASE_DAY, 7, FIRST_TX)
    assert res.segments.count() == 0
    assert len(res.segments.columns) == 52


def test_non_positive_rate_is_rejected(spark):
    legacy = spark.createDataFrame([(date(2020, 1, 1), D("0"))], "Date date, Price_USDTRY decimal(18,6)")
    current = spark.createDataFrame([], "Tarih date, `USD-A` decimal(18,6), `USD-S` decimal(18,6)")
    with pytest.raises(PySparkException, match="exchange rate must be positive"):
        daily_rates(legacy, current).collect()


def test_daily_rates_cutover_and_duplicates(spark):
    legacy = spark.createDataFrame(
        [(date(2024, 2, 5), D("30")), (date(2024, 2, 5), D("30")), (date(2024, 2, 5), D("31")), (date(2024, 2, 6), D("99"))],
        "Date date, Price_USDTRY decimal(18,6)",
    )
    current = spark.createDataFrame(
        [(date(2024, 2, 5), D("1"), D("2")), (date(2024, 2, 6), D("30.000001"), D("30.000002"))],
        "Tarih date, `USD-A` decimal(18,6), `USD-S` decimal(18,6)",
    )
    got = sorted((r.Date, r.Price_USDTRY) for r in daily_rates(legacy, current).collect())
    assert got == [(date(2024, 2, 5), D("30")), (date(2024, 2, 5), D("31")), (date(2024, 2, 6), D("30.0000015"))]


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.unset("spark.sql.ansi.enabled")


def test_monetary_overflow_fails_like_the_procedure(spark, ansi):
    inp = Inputs()
    inp.rates = [(date(2024, 5, 1), D("1"))]
    inp.tx["hot"] += [tx(i, 1, "2024-05-01", "-50000000.00") for i in range(1, 3)]
    inp.users = [user(1)]
    with pytest.raises(PySparkException, match="Monetary(USD)? out of range"):
        base_rows(spark, inp)


def test_largest_monetary_is_kept(spark, ansi):
    inp = Inputs()
    inp.rates = [(date(2024, 5, 1), D("1"))]
    inp.tx["hot"] += [tx(1, 1, "2024-05-01", "-99999999.99")]
    inp.users = [user(1)]
    assert [r.Monetary for r in base_rows(spark, inp).values()] == [D("99999999.99")]


def test_integer_values_out_of_range_fail(spark, ansi):
    from segmint.operators.base import with_metric_values

    row = spark.sql(
        "SELECT CAST(1 AS DECIMAL(18,10)) AS Monetary, CAST(1 AS DECIMAL(18,10)) AS MonetaryUSD, "
        "CAST(3000000000 AS DECIMAL(38,2)) AS SumAmount, CAST(1 AS DECIMAL(38,15)) AS SumAmountUSD, 1L AS Frequency, 2 AS Length"
    )
    with pytest.raises(PySparkException, match="AvgTicketSize out of range"):
        with_metric_values(row).collect()
    assert with_metric_values(row.withColumn("Frequency", F.lit(2))).first().AvgTicketSizeINT == 1500000000


def test_consistent_specs_change_only_the_cross_wired_columns(spark):
    sources, users, rates = generate(4).spark_frames(spark)
    a = segment_customers(spark, sources, users, rates, BASE_DAY, 0, FIRST_TX).scored
    b = segment_customers(
        spark, sources, users, rates, BASE_DAY, 0, FIRST_TX, CONSISTENT_METRIC_SPECS, CONSISTENT_ELITE_SPECS
    ).scored
    same = [c for c in a.columns if "USD" not in c and not c.startswith("EliteSegment")]
    same += ["EliteSegmentScore_Monetary", "EliteSegmentPoints_Monetary"]
    assert a.select(*same).exceptAll(b.select(*same)).count() == 0
    assert a.select(*a.columns).exceptAll(b.select(*a.columns)).count() > 0


@pytest.mark.parametrize("kind", ["path", "table"])
def test_result_replaces_exactly_its_partition(spark, tmp_path, kind):
    """Re-runs replace, a run without rows leaves none, and other partitions stay intact."""
    from segmint.operators.output import write_result, write_result_table

    sources, users, rates = generate(5, customers=60).spark_frames(spark)
    runs = {p: segment_customers(spark, sources, users, rates, BASE_DAY, p, FIRST_TX) for p in (0, 3)}
    nothing = {n: df.limit(0) for n, df in sources.items()}
    empty = segment_customers(spark, nothing, users, rates, BASE_DAY, 3, FIRST_TX)
    target = str(tmp_path / "out") if kind == "path" else "segmint_test_result"
    write = write_result if kind == "path" else write_result_table

    def back():
        if kind == "path":
            return spark.read.parquet(target)
        spark.catalog.refreshTable(target)
        return spark.table(target)

    try:
        for frame in ("segments", "wide"):
            if kind == "path":
                target = str(tmp_path / frame)
            else:
                spark.sql(f"DROP TABLE IF EXISTS {target}")
            rows = {p: getattr(r, frame) for p, r in runs.items()}
            for p in (0, 3, 3):  # the second run of period 3 replaces the first
                write(rows[p], target, runs[p].window)
            cols = rows[0].columns
            for p in (0, 3):
                found = back().where(f"Period = {p}")
                assert found.count() == rows[p].count() > 0
                assert found.select(*cols).exceptAll(rows[p]).count() == 0
            write(getattr(empty, frame), target, empty.window)
            assert back().where("Period = 3").count() == 0
            assert back().where("Period = 0").count() == rows[0].count()
    finally:
        if kind == "table":
            spark.sql(f"DROP TABLE IF EXISTS {target}")


def test_unsupported_period_gives_no_rows(spark):
    sources, users, rates = generate(5, customers=30).spark_frames(spark)
    res = segment_customers(spark, sources, users, rates, BASE_DAY, 7, FIRST_TX)
    assert res.segments.count() == 0 and res.wide.count() == 0


def test_staged_files_go_after_release_and_after_a_failure(spark, tmp_path):
    import os

    sources, users, rates = generate(5, customers=30).spark_frames(spark)
    root = tmp_path / "staging"
    root.mkdir()
    res = segment_customers(spark, sources, users, rates, BASE_DAY, 3, FIRST_TX, staging_dir=f"file://{root}")
    assert len(os.listdir(root)) == 1
    res.release()
    res.release()
    assert os.listdir(root) == []
    bad = rates.withColumn("Price_USDTRY", F.expr("if(Price_USDTRY > 0, raise_error('no rate'), Price_USDTRY)"))
    with pytest.raises(PySparkException, match="no rate"):
        segment_customers(spark, sources, users, bad, BASE_DAY, 3, FIRST_TX, staging_dir=f"file://{root}")
    assert os.listdir(root) == []


@pytest.mark.parametrize("how", ["rows", "publish"])
def test_a_failed_replacement_leaves_the_old_rows(spark, tmp_path, monkeypatch, how):
    """A write that fails half-way, or whose last rename never happens, loses nothing."""
    import os

    from segmint.operators import output

    sources, users, rates = generate(5, customers=60).spark_frames(spark)
    res = segment_customers(spark, sources, users, rates, BASE_DAY, 3, FIRST_TX)
    target = str(tmp_path / "out")
    output.write_result(res.segments, target, res.window)
    before = spark.read.parquet(target).collect()
    month = f"{target}/YearMonth={res.window.year_month}"
    if how == "rows":
        # fails in the last of several tasks, after others have written their files
        bad = res.segments.repartition(8).withColumn(
            "Monetary", F.expr("if(spark_partition_id() = 7, raise_error('no disk'), Monetary)")
        )
        with pytest.raises(PySparkException, match="no disk"):
            output.write_result(bad, target, res.window)
    else:
        # the writer dies between the renames: the old folder is set aside and nothing in its place
        os.rename(f"{month}/Period=3", f"{month}/{output.OLD_PREFIX}Period=3")
        fs, make = output.file_system(spark, target)
        output._recover(fs, make, month, "Period=3")
    after = spark.read.parquet(target)
    assert sorted(map(str, after.collect())) == sorted(map(str, before)) and before
    assert os.listdir(month) == ["Period=3"]


def test_rates_beyond_the_broadcast_limit_are_joined_in_parts_of_a_day(spark):
    """With no broadcast allowed results are the same, and one hot day does not fill one task."""
    from segmint.operators.rates import convert_currency

    sources, users, rates = generate(6).spark_frames(spark)
    a = segment_customers(spark, sources, users, rates, BASE_DAY, 0, FIRST_TX).segments
    b = segment_customers(spark, sources, users, rates, BASE_DAY, 0, FIRST_TX, broadcast_rows=0).segments
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0
    hot = spark.range(40_000).select(
        F.col("id").alias("Id"), (F.col("id") % 5).alias("CustomerKey"), F.lit(datetime(2024, 3, 1)).cast("timestamp_ntz").alias("CreateDate"),
        F.lit(Decimal("1.00")).alias("Amount"),
    )
    joined = convert_currency(hot, rates, broadcast_rows=0)
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the tasks as they are dealt, not as AQE mends them
    try:
        tasks = sorted(r["count"] for r in convert_currency(hot, rates, broadcast_rows=0).groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(tasks) == 4 and tasks[-1] <= 2 * tasks[len(tasks) // 2]


def test_a_named_run_goes_on_after_its_finished_stages(spark, tmp_path):
    """A run killed after ``base`` resumes in a new call without reading the transactions."""
    sources, users, rates = generate(8, customers=80).spark_frames(spark)
    want = segment_customers(spark, sources, users, rates, BASE_DAY, 12, FIRST_TX).segments
    root = f"file://{tmp_path}/runs"
    import segmint.plans.pipeline as pipeline

    def killed(*args, **kwargs):
        raise KeyboardInterrupt

    plain, pipeline.metric_values = pipeline.metric_values, killed
    try:
        with pytest.raises(KeyboardInterrupt):
            segment_customers(spark, sources, users, rates, BASE_DAY, 12, FIRST_TX, staging_dir=root, run_name="may/12")
    finally:
        pipeline.metric_values = plain
    # reading any transaction would fail now
    gone = {n: df.withColumn("FeatureType", F.expr("if(Id is null, 0, raise_error('read again'))").cast("int")) for n, df in sources.items()}
    with pytest.raises(ValueError, match="computes something else"):
        segment_customers(spark, gone, users, rates, BASE_DAY, 3, FIRST_TX, staging_dir=root, run_name="may/12")
    res = segment_customers(spark, gone, users, rates, BASE_DAY, 12, FIRST_TX, staging_dir=root, run_name="may/12")
    assert res.stager.resumed == ["rates", "base"]
    assert res.segments.count() == want.count() > 0 and res.segments.exceptAll(want).count() == 0
    res.release()
    with pytest.raises(PySparkException, match="read again"):
        segment_customers(spark, gone, users, rates, BASE_DAY, 12, FIRST_TX, staging_dir=root, run_name="may/12")


@pytest.mark.parametrize("consistent", [False, True])
def test_elite_histograms_from_the_base_ranks_equal_those_from_the_customers(spark, consistent):
    """Slices of the ranked base histogram, and no second read of the base where all are slices."""
    from segmint.operators.elite import elite_values, from_base_ranks
    from segmint.operators.grade import top_score_predicates
    from segmint.plans.specs import DEFAULT_ELITE_SPECS, DEFAULT_METRIC_SPECS

    metrics, elites = (CONSISTENT_METRIC_SPECS, CONSISTENT_ELITE_SPECS) if consistent else (DEFAULT_METRIC_SPECS, DEFAULT_ELITE_SPECS)
    sources, users, rates = generate(9).spark_frames(spark)
    res = segment_customers(spark, sources, users, rates, BASE_DAY, 0, FIRST_TX, metrics, elites)
    top = top_score_predicates(metrics, res.bounds)
    direct = elite_values(res.base, elites, top)
    sliced = elite_values(res.base, elites, top, res.ranked, res.bounds, metrics)
    assert direct.count() == sliced.count() > 0
    assert direct.exceptAll(sliced).count() == 0
    ready = from_base_ranks(elites, metrics)
    assert set(ready) == ({e.name for e in elites} if consistent else {"Monetary", "AvgTicketSize", "AvgTxVolumePerDay"})
    reads = sliced._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")
    assert reads == (1 if consistent else 2)


def test_top_score_predicates_equal_score_five(spark):
    from segmint.operators.grade import top_score_predicates
    from segmint.plans.specs import DEFAULT_METRIC_SPECS

    sources, users, rates = generate(7).spark_frames(spark)
    res = segment_customers(spark, sources, users, rates, BASE_DAY, 0, FIRST_TX)
    preds = top_score_predicates(DEFAULT_METRIC_SPECS, res.bounds)
    g = res.graded
    for col, pred in preds.items():
        assert g.where(F.coalesce(pred, F.lit(False)) != F.coalesce(F.col(col) == 5, F.lit(False))).count() == 0, col


def test_job_entry_point_runs_end_to_end(spark, tmp_path):
    """The command-line job reads pinned-schema inputs, writes the result and cleans up."""
    from segmint import job

    inp = generate(8)
    sources, users, rates = inp.spark_frames(spark)
    paths = {}
    for name, df in (("hot", sources["hot"]), ("archive", sources["archive"]), ("users", users)):
        paths[name] = str(tmp_path / name)
        df.write.parquet(paths[name])
    paths["legacy"] = str(tmp_path / "legacy")
    rates.write.parquet(paths["legacy"])
    paths["current"] = str(tmp_path / "current")
    spark.createDataFrame([], "Tarih date, `USD-A` decimal(18,6), `USD-S` decimal(18,6)").write.parquet(paths["current"])
    out, wide, staging = str(tmp_path / "out"), str(tmp_path / "wide"), tmp_path / "staging"
    staging.mkdir()
    job.main([
        "--hot", paths["hot"], "--archive", paths["archive"], "--users", paths["users"],
        "--rates-legacy", paths["legacy"], "--rates-current", paths["current"],
        "--day", BASE_DAY.isoformat(), "--period", "3", "--out", out, "--first-tx-date", FIRST_TX.isoformat(),
        "--cutover", "2100-01-01", "--wide-out", wide, "--staging-dir", f"file://{staging}",
    ])
    assert list(staging.iterdir()) == []
    written = spark.read.parquet(out)
    run = segment_customers(spark, sources, users, rates, BASE_DAY, 3, FIRST_TX)
    direct = run.segments
    assert spark.read.parquet(wide).count() == run.wide.count() == direct.count() / 2
    cols = [c for c in direct.columns if c not in ("YearMonth", "Period")]
    assert written.count() == direct.count() > 0
    assert written.select(*cols).exceptAll(direct.select(*cols)).count() == 0


def test_unstaged_run_equals_staged_run(spark):
    sources, users, rates = generate(9, customers=60).spark_frames(spark)
    a = segment_customers(spark, sources, users, rates, BASE_DAY, 6, FIRST_TX).segments
    b = segment_customers(spark, sources, users, rates, BASE_DAY, 6, FIRST_TX, stage=False).segments
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0


def test_readers_pin_schemas_for_text_formats(spark, tmp_path):
    from segmint.sources import read_transactions
    from segmint.sources.schemas import TRANSACTIONS

    sources, _, _ = generate(10, customers=20).spark_frames(spark)
    path = str(tmp_path / "tx_csv")
    sources["hot"].write.option("header", "true").csv(path)
    back = read_transactions(spark, path, "csv")
    assert back.schema.simpleString() == TRANSACTIONS.simpleString()
    assert back.exceptAll(sources["hot"]).count() == 0 and back.count() == sources["hot"].count()
