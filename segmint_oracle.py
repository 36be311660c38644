"""DuckDB oracle: the procedure written in its own direct form over the fixture.

Independent of the Spark plans: plain ``row_number`` / ``ntile`` windows over the whole
value set, a ``count(distinct ...)`` per source, a join-then-group with the users, one
left join per metric and grade table. Only two things are not written "as the procedure
does" because DuckDB's arithmetic differs from T-SQL's: continuous percentiles and points
are computed in integers (exact), and values are truncated with ``trunc`` (DuckDB's
integer cast rounds). The fixture mapping follows FIXTURES.md.
"""

from __future__ import annotations

from typing import NamedTuple

BASE_DAY = "2001-07-15"
FIRST_TX_DATE = "1995-01-01"
CUTOVER = "1998-06-01"

VALID = "IsCancellation = 0 AND OperatorKey IS NULL"

# Per metric: the value expression over ``base`` and the eligibility predicate, in the
# procedure's own terms (ratios as DOUBLE).
METRIC_SQL = {
    "Length": ("Length", "Length > 1"),
    "Recency": ("Recency", "Recency > 3 AND Recency < 121"),
    "Frequency": ("Frequency", "Frequency > 2"),
    "Monetary": ("MonetaryINT", "Monetary >= 50"),
    "MonetaryUSD": ("MonetaryUSDINT", "Monetary > 50"),
    "AvgTicketSize": ("AvgTicketSizeINT", "AvgTicketSize >= 10"),
    "AvgTicketSizeUSD": ("AvgTicketSizeUSDINT", "AvgTicketSize >= 10"),
    "AvgTxVolumePerDay": ("AvgTxVolumePerDayINT", "AvgTxVolumePerDay >= 0.15"),
    "AvgTxVolumePerDayUSD": ("AvgTxVolumePerDayUSDINT", "AvgTxVolumePerDay >= 0.015"),
}
# The same with each metric's own currency.
CONSISTENT_METRIC_SQL = METRIC_SQL | {
    "MonetaryUSD": ("MonetaryUSDINT", "MonetaryUSD >= 50"),
    "AvgTicketSizeUSD": ("AvgTicketSizeUSDINT", "AvgTicketSizeUSD >= 10"),
    "AvgTxVolumePerDayUSD": ("AvgTxVolumePerDayUSDINT", "AvgTxVolumePerDayUSD >= 0.015"),
}
# Low and high percentile per metric, and the metrics ranked from high to low.
PERCENTILES = {
    "Length": (5, 95),
    "Recency": (5, 95),
    "Frequency": (5, 95),
    "Monetary": (5, 95),
    "MonetaryUSD": (5, 95),
    "AvgTicketSize": (5, 95),
    "AvgTicketSizeUSD": (5, 95),
    "AvgTxVolumePerDay": (5, 95),
    "AvgTxVolumePerDayUSD": (1, 99),
}
DESCENDING = {"Recency"}


class Elite(NamedTuple):
    name: str
    band_value: str  # its distinct values form the band
    bound_value: str  # its 99th percentile is the bound
    join_value: str  # the customer's own value
    population: str  # score that must be 5 to be in the population
    gate: str  # score that must be 5 for a grade
    score_bound_of: str | None = None  # whose bound cuts the score band


ELITES = (
    Elite("Monetary", "MonetaryINT", "MonetaryINT", "MonetaryINT", "MonetaryScore", "MonetaryScore"),
    Elite("MonetaryUSD", "MonetaryUSDINT", "MonetaryUSDINT", "MonetaryUSDINT", "MonetaryScore", "MonetaryUSDScore"),
    Elite("AvgTicketSize", "AvgTicketSizeINT", "AvgTicketSizeINT", "AvgTicketSizeINT", "AvgTicketSizeScore", "MonetaryScore"),
    Elite("AvgTicketSizeUSD", "AvgTicketSizeUSDINT", "AvgTicketSizeUSDINT", "AvgTicketSizeUSDINT", "AvgTicketSizeUSDScore",
          "MonetaryScore", "AvgTicketSize"),
    Elite("AvgTxVolumePerDay", "AvgTxVolumePerDayINT", "AvgTxVolumePerDayINT", "AvgTxVolumePerDayINT", "AvgTxVolumePerDayScore",
          "MonetaryScore"),
    Elite("AvgTxVolumePerDayUSD", "AvgTxVolumePerDayINT", "AvgTxVolumePerDayUSDINT", "AvgTxVolumePerDayUSDINT",
          "AvgTxVolumePerDayUSDScore", "MonetaryScore"),
)
CONSISTENT_ELITES = tuple(
    Elite(e.name, e.join_value, e.join_value, e.join_value, f"{e.name}Score", f"{e.name}Score") for e in ELITES
)


def _fdiv(a: str, b: int) -> str:
    """Exact floor division in DuckDB (``//`` truncates toward zero)."""
    return f"((({a}) - ((({a}) % {b}) + {b}) % {b}) // {b})"


def _cdiv(a: str, b: int) -> str:
    return f"(-{_fdiv(f'-({a})', b)})"


def _points(rn: str, n: str, low: int, span: int) -> str:
    cents = f"CASE WHEN {n} = 1 THEN {low} ELSE {low} + (2 * {span} * ({rn} - 1) + ({n} - 1)) // (2 * ({n} - 1)) END"
    return f"CAST(CAST({cents} AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2))"


def params_cte(period: int, base_day: str = BASE_DAY, first_tx_date: str = FIRST_TX_DATE) -> str:
    """The run parameters: month start, previous month, period and window start (NULL if unsupported)."""
    start = {
        0: f"DATE '{first_tx_date}'",
        **{p: f"CAST(b - INTERVAL {p} MONTH AS DATE)" for p in (1, 3, 6, 9, 12)},
    }
    start_sql = "CASE " + " ".join(f"WHEN {period} = {p} THEN {e}" for p, e in start.items()) + " END"
    return f"""params AS (
  SELECT b AS BaseDay, CAST(b - INTERVAL 1 MONTH AS DATE) AS YearMonth, CAST({period} AS INTEGER) AS Period,
         {start_sql} AS StartDate
  FROM (SELECT CAST(date_trunc('month', DATE '{base_day}') AS DATE) AS b))"""


def fixture_input_ctes() -> list[str]:
    """The driver tables mapped onto the inputs ``tx``, ``users`` and ``daily_rates``."""
    return [
        """tx0 AS (
  SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01 00:00:00' THEN 'archive' ELSE 'hot' END AS Source,
         o_orderkey AS Id, o_custkey AS CustomerKey, CAST(o_orderdate AS TIMESTAMP) AS CreateDate,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS IsCancellation,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 7 END AS OperatorKey,
         CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 2 END AS FeatureType,
         CASE WHEN o_orderkey % 7 = 0 THEN 2 ELSE 1 END AS CardTxType,
         CAST(CAST(floor(o_totalprice / 10) AS BIGINT) AS DECIMAL(18,0)) * 0.01 AS AbsAmount
  FROM orders)""",
        """tx AS (
  SELECT Source, Id, CustomerKey, CreateDate, IsCancellation, OperatorKey, FeatureType, CardTxType,
         CAST(CASE WHEN IsCancellation = 1 THEN AbsAmount ELSE -AbsAmount END AS DECIMAL(18,2)) AS Amount
  FROM tx0)""",
        """users AS (
  SELECT c_custkey AS User_Key, CAST(DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS TIMESTAMP) AS CreateDate
  FROM customer WHERE c_custkey % 50 <> 0)""",
        """rate_days AS (
  SELECT d AS Date, datediff('day', DATE '1995-01-01', d) AS n
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders))""",
        """rate_base AS (
  SELECT Date,
         CAST(CASE n % 6 WHEN 0 THEN 1.25 WHEN 1 THEN 1.6 WHEN 2 THEN 2.0 WHEN 3 THEN 2.5 WHEN 4 THEN 3.2 ELSE 4.0 END
              AS DECIMAL(18,6)) AS rate,
         CAST(CASE n % 6 WHEN 0 THEN 0.8 WHEN 1 THEN 0.625 WHEN 2 THEN 0.5 WHEN 3 THEN 0.4 WHEN 4 THEN 0.3125 ELSE 0.25 END
              AS DECIMAL(10,4)) AS recip
  FROM rate_days WHERE n % 11 <> 0)""",
        f"""daily_rates AS (
  SELECT DISTINCT Date, CAST(rate AS DECIMAL(20,7)) AS Price_USDTRY, recip FROM rate_base WHERE Date < DATE '{CUTOVER}'
  UNION ALL
  SELECT DISTINCT Date, CAST(((rate - 0.01) + (rate + 0.01)) * 0.5 AS DECIMAL(20,7)) AS Price_USDTRY, recip
  FROM rate_base WHERE Date >= DATE '{CUTOVER}')""",
    ]


def core_ctes() -> list[str]:
    """From ``params``, ``tx``, ``users`` and ``daily_rates`` (with ``recip``) to ``base``."""
    return [
        """win AS (
  SELECT t.* FROM tx t, params p WHERE t.CreateDate >= p.StartDate AND t.CreateDate < p.BaseDay)""",
        """conv AS (
  SELECT w.Source, w.Id, w.CustomerKey, w.CreateDate, w.Amount, w.IsCancellation, w.OperatorKey,
         er.Price_USDTRY, w.Amount * er.recip AS AmountUSD
  FROM win w LEFT JOIN daily_rates er ON er.Date = CAST(w.CreateDate AS DATE)
  WHERE w.FeatureType = 2 AND w.CardTxType = 1)""",
        f"""src_agg AS (
  SELECT Source, CustomerKey,
         count(CASE WHEN {VALID} THEN Id END) AS IdCount,
         count(DISTINCT CAST(CASE WHEN {VALID} THEN CreateDate END AS DATE)) AS CountDistinctDate,
         CAST(min(CASE WHEN {VALID} THEN CreateDate END) AS DATE) AS MinCreateDate,
         CAST(max(CASE WHEN {VALID} THEN CreateDate END) AS DATE) AS MaxCreateDate,
         -sum(Amount) AS SumAmount,
         -sum(AmountUSD) AS SumAmountUSD
  FROM conv GROUP BY Source, CustomerKey
  HAVING count(CASE WHEN {VALID} THEN Id END) > 0)""",
        """base0 AS (
  SELECT p.BaseDay AS CreateDate, p.YearMonth, p.Period, l.CustomerKey,
         max(CAST(u.CreateDate AS DATE)) AS RegisterDate,
         CASE WHEN p.Period IN (1, 3, 6, 9, 12) THEN NULL
              ELSE CAST(datediff('day', CAST(min(u.CreateDate) AS DATE), min(l.MinCreateDate)) + 1 AS INTEGER) END
           AS RegisterDateToFirstTxDate,
         min(l.MinCreateDate) AS FirstTxDate, max(l.MaxCreateDate) AS LastTxDate,
         CAST(datediff('day', min(l.MinCreateDate), max(l.MaxCreateDate)) + 1 AS INTEGER) AS Length,
         CAST(datediff('day', max(l.MaxCreateDate), p.BaseDay) - 1 AS INTEGER) AS Recency,
         CAST(sum(l.IdCount) AS BIGINT) AS Frequency,
         sum(l.SumAmount) AS SumAmount, sum(l.SumAmountUSD) AS SumAmountUSD,
         CAST(sum(l.CountDistinctDate) AS BIGINT) AS DistinctTxDayCount
  FROM src_agg l JOIN users u ON u.User_Key = l.CustomerKey CROSS JOIN params p
  GROUP BY p.BaseDay, p.YearMonth, p.Period, l.CustomerKey)""",
        """base1 AS (
  SELECT *,
         CAST(SumAmount AS DECIMAL(18,10)) AS Monetary,
         CAST(SumAmountUSD AS DECIMAL(18,10)) AS MonetaryUSD,
         coalesce(CAST(SumAmount AS DOUBLE) / CAST(nullif(Frequency, 0) AS DOUBLE), 0) AS AvgTicketSize,
         coalesce(CAST(SumAmountUSD AS DOUBLE) / CAST(nullif(Frequency, 0) AS DOUBLE), 0) AS AvgTicketSizeUSD,
         coalesce(CAST(SumAmount AS DOUBLE) / CAST(nullif(Length, 0) AS DOUBLE), 0) AS AvgTxVolumePerDay,
         coalesce(CAST(SumAmountUSD AS DOUBLE) / CAST(nullif(Length, 0) AS DOUBLE), 0) AS AvgTxVolumePerDayUSD,
         coalesce(CAST(Frequency AS DOUBLE) / CAST(nullif(Length, 0) AS DOUBLE), 0) AS AvgTxCountPerDay,
         coalesce(CAST(Length AS DOUBLE) / CAST(nullif(DistinctTxDayCount, 0) AS DOUBLE), 0) AS TxRangeOfDaysFrequency
  FROM base0)""",
        """base AS (
  SELECT *,
         CAST(trunc(Monetary) AS INTEGER) AS MonetaryINT,
         CAST(trunc(MonetaryUSD) AS INTEGER) AS MonetaryUSDINT,
         CAST(trunc(AvgTicketSize) AS INTEGER) AS AvgTicketSizeINT,
         CAST(trunc(AvgTicketSizeUSD) AS INTEGER) AS AvgTicketSizeUSDINT,
         CAST(trunc(AvgTxVolumePerDay) AS INTEGER) AS AvgTxVolumePerDayINT,
         CAST(trunc(AvgTxVolumePerDayUSD) AS INTEGER) AS AvgTxVolumePerDayUSDINT
  FROM base1)""",
    ]


def fixture_ctes(period: int) -> list[str]:
    return [params_cte(period)] + fixture_input_ctes() + core_ctes()


def band_ctes(metric_sql: dict[str, tuple[str, str]] = METRIC_SQL) -> list[str]:
    elig = "\n  UNION ALL\n  ".join(
        f"SELECT '{m}' AS Metric, CAST({v} AS BIGINT) AS Value FROM base WHERE {p} AND {v} IS NOT NULL"
        for m, (v, p) in metric_sql.items()
    )
    pct = ", ".join(f"('{m}', {lo}, {hi})" for m, (lo, hi) in PERCENTILES.items())
    desc = ", ".join(f"'{m}'" for m in DESCENDING)
    num_lo = "x_lo * (100 - rlo) + coalesce(x_lo1, 0) * rlo"
    num_hi = "x_hi * (100 - rhi) + coalesce(x_hi1, 0) * rhi"
    return [
        f"elig AS (\n  {elig})",
        f"pct AS (SELECT * FROM (VALUES {pct}) AS t(Metric, plo, phi))",
        """ord AS (
  SELECT Metric, Value, row_number() OVER (PARTITION BY Metric ORDER BY Value) - 1 AS pos,
         count(*) OVER (PARTITION BY Metric) AS N
  FROM elig)""",
        """qs AS (
  SELECT DISTINCT o.Metric, o.N,
         (p.plo * (o.N - 1)) // 100 AS qlo, (p.plo * (o.N - 1)) % 100 AS rlo,
         (p.phi * (o.N - 1)) // 100 AS qhi, (p.phi * (o.N - 1)) % 100 AS rhi
  FROM ord o JOIN pct p ON p.Metric = o.Metric)""",
        """xs AS (
  SELECT q.Metric, q.N, q.rlo, q.rhi,
         max(CASE WHEN o.pos = q.qlo THEN o.Value END) AS x_lo,
         max(CASE WHEN o.pos = q.qlo + 1 THEN o.Value END) AS x_lo1,
         max(CASE WHEN o.pos = q.qhi THEN o.Value END) AS x_hi,
         max(CASE WHEN o.pos = q.qhi + 1 THEN o.Value END) AS x_hi1
  FROM qs q JOIN ord o ON o.Metric = q.Metric
  GROUP BY q.Metric, q.N, q.rlo, q.rhi)""",
        f"""bounds AS (
  SELECT Metric, CAST(N AS BIGINT) AS Customers,
         CAST({_fdiv(num_lo, 100)} AS BIGINT) AS LowerBound,
         CAST({_cdiv(num_hi, 100)} AS BIGINT) AS UpperBound
  FROM xs)""",
        "vals AS (SELECT DISTINCT Metric, Value FROM elig)",
        f"""inband AS (
  SELECT v.Metric, v.Value, CASE WHEN v.Metric IN ({desc}) THEN -v.Value ELSE v.Value END AS o
  FROM vals v JOIN bounds b ON b.Metric = v.Metric
  WHERE v.Value >= b.LowerBound AND v.Value <= b.UpperBound)""",
        """band0 AS (
  SELECT Metric, Value,
         row_number() OVER (PARTITION BY Metric ORDER BY o) AS RN,
         count(*) OVER (PARTITION BY Metric) AS TotalCount,
         ntile(3) OVER (PARTITION BY Metric ORDER BY o) + 1 AS Score,
         ntile(2) OVER (PARTITION BY Metric ORDER BY o) - 1 AS Grp
  FROM inband)""",
        f"""band AS (
  SELECT Metric, Value, {_points('RN', 'TotalCount', 105, 9890)} AS Points,
         CAST(Score AS INTEGER) AS Score, CAST(Grp AS INTEGER) AS Grp
  FROM band0)""",
    ]


def graded_cte() -> str:
    cols, joins = [], []
    for i, (m, (v, _)) in enumerate(METRIC_SQL.items()):
        b, o = f"b{i}", f"o{i}"
        joins.append(f"LEFT JOIN band {b} ON {b}.Metric = '{m}' AND {b}.Value = t.{v}")
        joins.append(f"LEFT JOIN bounds {o} ON {o}.Metric = '{m}'")
        desc = m in DESCENDING
        grp_lo, grp_hi = (1, 0) if desc else (0, 1)
        sc_lo, sc_hi = (5, 1) if desc else (1, 5)
        pt_lo, pt_hi = ("100.00", "1.00") if desc else ("1.00", "100.00")
        for col, out, (low, high), typ in (
            ("Grp", "Group", (grp_lo, grp_hi), "INTEGER"),
            ("Score", "Score", (sc_lo, sc_hi), "INTEGER"),
            ("Points", "Points", (pt_lo, pt_hi), "DECIMAL(18,2)"),
        ):
            cols.append(
                f"CAST(CASE WHEN {b}.{col} IS NULL AND t.{v} < {o}.LowerBound THEN {low} "
                f"WHEN {b}.{col} IS NULL AND t.{v} > {o}.UpperBound THEN {high} "
                f"ELSE {b}.{col} END AS {typ}) AS {m}{out}"
            )
    return "graded AS (\n  SELECT t.*,\n    " + ",\n    ".join(cols) + "\n  FROM base t\n  " + "\n  ".join(joins) + ")"


def elite_ctes(elites: tuple[Elite, ...] = ELITES) -> list[str]:
    ctes = []
    index = {e.name: i for i, e in enumerate(elites)}
    for i, e in enumerate(elites):
        ctes += [
            f"""e_ord{i} AS (
  SELECT CAST({e.bound_value} AS BIGINT) AS Value, row_number() OVER (ORDER BY {e.bound_value}) - 1 AS pos,
         count(*) OVER () AS N
  FROM graded WHERE {e.population} = 5 AND {e.bound_value} IS NOT NULL)""",
            f"""e_q{i} AS (SELECT DISTINCT N, (99 * (N - 1)) // 100 AS q, (99 * (N - 1)) % 100 AS r FROM e_ord{i})""",
            f"""e_bnd{i} AS (
  SELECT '{e.name}' AS Metric, CAST(q.N AS BIGINT) AS Customers,
         CAST({_cdiv('max(CASE WHEN o.pos = q.q THEN o.Value END) * (100 - q.r) + coalesce(max(CASE WHEN o.pos = q.q + 1 THEN o.Value END), 0) * q.r', 100)} AS BIGINT) AS UpperBound
  FROM e_q{i} q CROSS JOIN e_ord{i} o GROUP BY q.N, q.q, q.r)""",
            f"""e_vals{i} AS (
  SELECT DISTINCT CAST({e.band_value} AS BIGINT) AS Value FROM graded WHERE {e.population} = 5 AND {e.band_value} IS NOT NULL)""",
            f"""e_pts{i} AS (
  SELECT Value, {_points('RN', 'TotalCount', 100, 9895)} AS Points FROM (
    SELECT v.Value, row_number() OVER (ORDER BY v.Value) AS RN, count(*) OVER () AS TotalCount
    FROM e_vals{i} v CROSS JOIN e_bnd{i} b WHERE v.Value <= b.UpperBound))""",
            f"""e_sc{i} AS (
  SELECT v.Value, CAST(ntile(3) OVER (ORDER BY v.Value) AS INTEGER) AS Score
  FROM e_vals{i} v CROSS JOIN e_bnd{index[e.score_bound_of] if e.score_bound_of else i} b WHERE v.Value <= b.UpperBound)""",
        ]
    cols, joins = [], []
    for i, e in enumerate(elites):
        v = f"t.{e.join_value}"
        joins += [
            f"LEFT JOIN e_sc{i} s{i} ON s{i}.Value = {v}",
            f"LEFT JOIN e_pts{i} p{i} ON p{i}.Value = {v}",
            f"LEFT JOIN e_bnd{i} u{i} ON TRUE",
        ]
        cols.append(
            f"CAST(CASE WHEN t.{e.gate} = 5 AND s{i}.Score IS NULL AND {v} > u{i}.UpperBound THEN 4 "
            f"WHEN t.{e.gate} = 5 AND s{i}.Score IS NOT NULL THEN s{i}.Score ELSE 0 END AS INTEGER) "
            f"AS EliteSegmentScore_{e.name}"
        )
        cols.append(
            f"CAST(CASE WHEN t.{e.gate} = 5 AND p{i}.Points IS NULL AND {v} > u{i}.UpperBound THEN 100.00 "
            f"WHEN t.{e.gate} = 5 AND p{i}.Points IS NOT NULL THEN p{i}.Points ELSE 0 END AS DECIMAL(18,2)) "
            f"AS EliteSegmentPoints_{e.name}"
        )
    ctes.append("scored AS (\n  SELECT t.*,\n    " + ",\n    ".join(cols) + "\n  FROM graded t\n  " + "\n  ".join(joins) + ")")
    ctes.append(
        "elite_bounds AS (\n  "
        + "\n  UNION ALL\n  ".join(f"SELECT * FROM e_bnd{i}" for i in range(len(elites)))
        + ")"
    )
    parts = []
    for i, e in enumerate(elites):
        parts.append(
            f"SELECT '{e.name}' AS Metric, coalesce(s.Value, p.Value) AS Value, s.Score AS EliteScore, p.Points AS ElitePoints "
            f"FROM e_sc{i} s FULL OUTER JOIN e_pts{i} p ON p.Value = s.Value"
        )
    ctes.append("elite_bands AS (\n  " + "\n  UNION ALL\n  ".join(parts) + ")")
    return ctes


CURRENCY = {
    0: ("Monetary", "AvgTicketSize", "AvgTxVolumePerDay"),
    1: ("MonetaryUSD", "AvgTicketSizeUSD", "AvgTxVolumePerDayUSD"),
}


def _code(*cols: str) -> str:
    return "concat(" + ", ".join(f"CAST({c} AS VARCHAR)" for c in cols) + ")"


def currency_select(cur: int, columns: list[str] | None = None) -> str:
    mon, tic, vol = CURRENCY[cur]
    exprs = {
        "CreateDate": "CAST(CreateDate AS DATE)",
        "YearMonth": "CAST(YearMonth AS DATE)",
        "Period": "CAST(Period AS INTEGER)",
        "Currency": f"CAST({cur} AS INTEGER)",
        "CustomerKey": "CAST(CustomerKey AS BIGINT)",
        "RegisterDate": "CAST(RegisterDate AS DATE)",
        "RegisterDateToFirstTxDate": "CAST(RegisterDateToFirstTxDate AS INTEGER)",
        "FirstTxDate": "CAST(FirstTxDate AS DATE)",
        "LastTxDate": "CAST(LastTxDate AS DATE)",
        "Length": "CAST(Length AS INTEGER)",
        "Recency": "CAST(Recency AS INTEGER)",
        "Frequency": "CAST(Frequency AS BIGINT)",
        "Monetary": f"CAST({mon} AS DECIMAL(18,10))",
        "AvgTicketSize": f"CAST({tic} AS DOUBLE)",
        "AvgTxVolumePerDay": f"CAST({vol} AS DOUBLE)",
        "AvgTxCountPerDay": "CAST(AvgTxCountPerDay AS DOUBLE)",
        "DistinctTxDayCount": "CAST(DistinctTxDayCount AS BIGINT)",
        "TxRangeOfDaysFrequency": "CAST(TxRangeOfDaysFrequency AS DOUBLE)",
        "L": "LengthGroup",
        "R": "RecencyGroup",
        "F": "FrequencyGroup",
        "M": f"{mon}Group",
        "TicketSize": f"{tic}Group",
        "VolumePerDay": f"{vol}Group",
        "LR": _code("LengthGroup", "RecencyGroup"),
        "FM": _code("FrequencyGroup", f"{mon}Group"),
        "LRFM": _code("LengthGroup", "RecencyGroup", "FrequencyGroup", f"{mon}Group"),
        "FM_ByTicketSize": _code("FrequencyGroup", f"{tic}Group"),
        "LRFM_ByTicketSize": _code("LengthGroup", "RecencyGroup", "FrequencyGroup", f"{tic}Group"),
        "FM_ByVolumePerDay": _code("FrequencyGroup", f"{vol}Group"),
        "LRFM_ByVolumePerDay": _code("LengthGroup", "RecencyGroup", "FrequencyGroup", f"{vol}Group"),
        "LengthScore": "LengthScore",
        "RecencyScore": "RecencyScore",
        "FrequencyScore": "FrequencyScore",
        "MonetaryScore": f"{mon}Score",
        "AvgTicketSizeScore": f"{tic}Score",
        "AvgTxVolumePerDayScore": f"{vol}Score",
        "RFM_Score": _code("RecencyScore", "FrequencyScore", f"{mon}Score"),
        "RFM_Score_ByTicketSize": _code("RecencyScore", "FrequencyScore", f"{tic}Score"),
        "RFM_Score_ByVolumePerDay": _code("RecencyScore", "FrequencyScore", f"{vol}Score"),
        "LengthPoints": "LengthPoints",
        "RecencyPoints": "RecencyPoints",
        "FrequencyPoints": "FrequencyPoints",
        "MonetaryPoints": f"{mon}Points",
        "AvgTicketSizePoints": f"{tic}Points",
        "AvgTxVolumePerDayPoints": f"{vol}Points",
        "ESByMonetary": f"EliteSegmentScore_{mon}",
        "ESByAvgTicketSize": f"EliteSegmentScore_{tic}",
        "ESByAvgTxVolumePerDay": f"EliteSegmentScore_{vol}",
        "ESPointsByMonetary": f"EliteSegmentPoints_{mon}",
        "ESPointsByAvgTicketSize": f"EliteSegmentPoints_{tic}",
        "ESPointsByAvgTxVolumePerDay": f"EliteSegmentPoints_{vol}",
    }
    cols = columns or list(exprs)
    return "SELECT " + ", ".join(f"{exprs[c]} AS {c}" for c in cols) + " FROM scored"


def with_ctes(ctes: list[str], select: str) -> str:
    return "WITH\n" + ",\n".join(ctes) + "\n" + select


def full_ctes(period: int) -> list[str]:
    return fixture_ctes(period) + band_ctes() + [graded_cte()] + elite_ctes()


WINDOW_PERIODS = (0, 1, 3, 6, 9, 12)
BOUND_PERIODS = (0, 12, 3)
SINK_PERIODS = (3, 0, 12)
FULL_PERIODS = {"segmentation_full": 0, "segmentation_p12": 12, "segmentation_p3": 3, "segmentation_p1": 1,
                "segmentation_p6": 6, "segmentation_p9": 9}


def _window_filter_sql() -> str:
    ctes = fixture_ctes(0)[1:3]  # tx0, tx
    values = ", ".join(f"({p})" for p in WINDOW_PERIODS)
    months = " ".join(f"WHEN {p} THEN CAST(b - INTERVAL {p} MONTH AS DATE)" for p in (1, 3, 6, 9, 12))
    ctes.append(
        f"""pp AS (
  SELECT CAST(p AS INTEGER) AS Period, b AS BaseDay,
         CASE p WHEN 0 THEN DATE '{FIRST_TX_DATE}' {months} END AS StartDate
  FROM (VALUES {values}) AS v(p), (SELECT CAST(date_trunc('month', DATE '{BASE_DAY}') AS DATE) AS b))"""
    )
    return with_ctes(
        ctes,
        "SELECT pp.Period, t.Source, t.Id, t.CustomerKey, CAST(t.CreateDate AS DATE) AS CreateDate "
        "FROM tx t JOIN pp ON t.CreateDate >= pp.StartDate AND t.CreateDate < pp.BaseDay",
    )


ACTIVITY_SELECT = (
    "CAST(IdCount AS BIGINT) AS IdCount, CAST(CountDistinctDate AS BIGINT) AS CountDistinctDate, "
    "MinCreateDate, MaxCreateDate, CAST(SumAmount AS DECIMAL(38,2)) AS SumAmount, "
    "CAST(SumAmountUSD AS DECIMAL(38,15)) AS SumAmountUSD"
)

BASE_SELECT = (
    "CreateDate, YearMonth, Period, CustomerKey, RegisterDate, RegisterDateToFirstTxDate, FirstTxDate, LastTxDate, "
    "Length, Recency, Frequency, Monetary, MonetaryUSD, AvgTicketSize, AvgTicketSizeUSD, AvgTxVolumePerDay, "
    "AvgTxVolumePerDayUSD, AvgTxCountPerDay, DistinctTxDayCount, TxRangeOfDaysFrequency"
)

WIDE_SELECT = ", ".join(
    [BASE_SELECT]
    + [f"{m}{g}" for g in ("Group", "Score", "Points") for m in METRIC_SQL]
    + [f"EliteSegment{g}_{e.name}" for g in ("Score", "Points") for e in ELITES]
)

CODES = ("LR", "FM", "LRFM", "FM_ByTicketSize", "LRFM_ByTicketSize", "FM_ByVolumePerDay", "LRFM_ByVolumePerDay",
         "RFM_Score", "RFM_Score_ByTicketSize", "RFM_Score_ByVolumePerDay")
CURRENCY_VALUES = (
    "Monetary", "AvgTicketSize", "AvgTxVolumePerDay", "M", "TicketSize", "VolumePerDay",
    "MonetaryScore", "AvgTicketSizeScore", "AvgTxVolumePerDayScore",
    "MonetaryPoints", "AvgTicketSizePoints", "AvgTxVolumePerDayPoints",
    "ESByMonetary", "ESByAvgTicketSize", "ESByAvgTxVolumePerDay",
    "ESPointsByMonetary", "ESPointsByAvgTicketSize", "ESPointsByAvgTxVolumePerDay",
)


def _currencies(columns: list[str]) -> str:
    return "\nUNION ALL\n".join(currency_select(c, columns) for c in (0, 1))


def oracle_queries() -> dict[str, str]:
    fx0 = fixture_ctes(0)
    bands = fx0 + band_ctes()
    graded = bands + [graded_cte()]
    full0 = full_ctes(0)
    metrics = list(METRIC_SQL)
    elites = [e.name for e in ELITES]
    q = {
        "window_filter": _window_filter_sql(),
        "daily_rates": with_ctes(fx0, "SELECT Date, Price_USDTRY FROM daily_rates"),
        "valid_tx": with_ctes(
            fx0,
            f"SELECT Source, Id, CustomerKey, CAST(CreateDate AS DATE) AS CreateDate, Amount, "
            f"coalesce({VALID}, FALSE) AS IsValid FROM win WHERE FeatureType = 2 AND CardTxType = 1",
        ),
        "convert_currency": with_ctes(
            fx0,
            "SELECT Source, Id, CustomerKey, CAST(CreateDate AS DATE) AS CreateDate, Amount, Price_USDTRY, "
            "CAST(AmountUSD AS DECIMAL(38,15)) AS AmountUSD FROM conv",
        ),
        "customer_activity": with_ctes(fx0, f"SELECT Source, CustomerKey, {ACTIVITY_SELECT} FROM src_agg"),
        "merge_sources": with_ctes(
            fx0,
            "SELECT CustomerKey, "
            + ACTIVITY_SELECT.replace("CAST(IdCount", "CAST(sum(IdCount)")
            .replace("CAST(CountDistinctDate", "CAST(sum(CountDistinctDate)")
            .replace("MinCreateDate, MaxCreateDate", "min(MinCreateDate) AS MinCreateDate, max(MaxCreateDate) AS MaxCreateDate")
            .replace("CAST(SumAmount AS", "CAST(sum(SumAmount) AS")
            .replace("CAST(SumAmountUSD AS", "CAST(sum(SumAmountUSD) AS")
            + " FROM src_agg GROUP BY CustomerKey",
        ),
        "lrfm_base": with_ctes(fx0, f"SELECT {BASE_SELECT} FROM base"),
        "metric_values": with_ctes(
            bands, "SELECT Metric, Value, CAST(count(*) AS BIGINT) AS Customers FROM elig GROUP BY Metric, Value"
        ),
        "outlier_bounds": "\nUNION ALL\n".join(
            "(" + with_ctes(fixture_ctes(p) + band_ctes(), f"SELECT CAST({p} AS INTEGER) AS Period, Metric, Customers, "
                            "LowerBound, UpperBound FROM bounds") + ")"
            for p in BOUND_PERIODS
        ),
        "band_points": with_ctes(bands, "SELECT Metric, Value, Points FROM band"),
        "band_scores": with_ctes(bands, "SELECT Metric, Value, Score FROM band"),
        "band_groups": with_ctes(bands, 'SELECT Metric, Value, Grp AS "Group" FROM band'),
        "assign_groups": with_ctes(graded, "SELECT CustomerKey, " + ", ".join(f"{m}Group" for m in metrics) + " FROM graded"),
        "assign_scores": with_ctes(graded, "SELECT CustomerKey, " + ", ".join(f"{m}Score" for m in metrics) + " FROM graded"),
        "assign_points": with_ctes(graded, "SELECT CustomerKey, " + ", ".join(f"{m}Points" for m in metrics) + " FROM graded"),
        "elite_bounds": with_ctes(full0, "SELECT Metric, Customers, UpperBound FROM elite_bounds"),
        "elite_bands": with_ctes(full0, "SELECT Metric, Value, EliteScore, ElitePoints FROM elite_bands"),
        "elite_scores": with_ctes(
            full0, "SELECT CustomerKey, " + ", ".join(f"EliteSegmentScore_{e}" for e in elites) + " FROM scored"
        ),
        "elite_points": with_ctes(
            full0, "SELECT CustomerKey, " + ", ".join(f"EliteSegmentPoints_{e}" for e in elites) + " FROM scored"
        ),
        "scored_wide": with_ctes(full0, f"SELECT {WIDE_SELECT} FROM scored"),
        "segment_codes": with_ctes(full0, _currencies(["CustomerKey", "Currency", *CODES])),
        "currency_rows": with_ctes(full0, _currencies(["CustomerKey", "Currency", *CURRENCY_VALUES])),
    }
    for key, p in FULL_PERIODS.items():
        q[key] = with_ctes(full_ctes(p), _currencies(None))
    q["segmentation_periods"] = "\nUNION ALL\n".join(f"({with_ctes(full_ctes(p), _currencies(None))})" for p in WINDOW_PERIODS)
    q["result_sink"] = "\nUNION ALL\n".join(f"({with_ctes(full_ctes(p), _currencies(None))})" for p in SINK_PERIODS)
    return q
