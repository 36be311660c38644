"""The per-customer base table (the procedure's first stage table), plus the exact
integer metric values every later grading step keys on.

Users are aggregated per key before the join (copies, first/last creation), so a key
with many duplicate user rows is reduced map-side; the merged activity is already
hash-partitioned by customer, so the inner join shuffles only the users side. Each
duplicate user row multiplies the customer's counts and sums, as the procedure's
join-then-group does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmint.functions.exact import ratio
from segmint.operators.joins import split_code
from segmint.operators.window import LOOKBACK_PERIODS, ObservationWindow

MONETARY_TYPE = T.DecimalType(18, 10)

BASE_COLUMNS = (
    "CreateDate",
    "YearMonth",
    "Period",
    "CustomerKey",
    "RegisterDate",
    "RegisterDateToFirstTxDate",
    "FirstTxDate",
    "LastTxDate",
    "Length",
    "Recency",
    "Frequency",
    "Monetary",
    "MonetaryUSD",
    "AvgTicketSize",
    "AvgTicketSizeUSD",
    "AvgTxVolumePerDay",
    "AvgTxVolumePerDayUSD",
    "AvgTxCountPerDay",
    "DistinctTxDayCount",
    "TxRangeOfDaysFrequency",
)

# Un-rounded sums kept next to the base columns: ratios and eligibility use them.
SUM_COLUMNS = ("SumAmount", "SumAmountUSD")

VALUE_COLUMNS = (
    "MonetaryINT",
    "MonetaryUSDINT",
    "AvgTicketSizeINT",
    "AvgTicketSizeUSDINT",
    "AvgTxVolumePerDayINT",
    "AvgTxVolumePerDayUSDINT",
)


def users_by_key(users: DataFrame) -> DataFrame:
    return users.groupBy("User_Key").agg(
        F.count(F.lit(1)).alias("_copies"),
        F.max(F.to_date("CreateDate")).alias("RegisterDate"),
        F.min("CreateDate").alias("_first_user"),
    )


def _checked(value: Column, result: Column, what: str) -> Column:
    """``result``, or an error where it is NULL though ``value`` is not.

    Overflow fails the job, as it does in the procedure, whether or not
    ``spark.sql.ansi.enabled`` is set: ``result`` is a ``try_`` expression.
    """
    error = F.raise_error(F.concat(F.lit(f"{what} out of range: "), value.cast("string")))
    return F.when(value.isNotNull() & result.isNull(), error).otherwise(result)


def _as(value: Column, dtype: T.DataType | str, what: str) -> Column:
    return _checked(value, value.try_cast(dtype), what)


def _times(x: Column, copies: Column, scale: int, what: str) -> Column:
    """Exact ``x * copies``: operand widths chosen so the product needs no rounding."""
    return _as(x, T.DecimalType(27, scale), what) * _as(copies, T.DecimalType(10, 0), "user rows")


def _count_times(x: Column, copies: Column, what: str) -> Column:
    return _checked(x, F.try_multiply(x, copies), what)


def lrfm_base(activity: DataFrame, users: DataFrame, window: ObservationWindow) -> DataFrame:
    """Base columns (the procedure's constant ``Key`` is not needed) + ``SumAmount``/``SumAmountUSD``."""
    u = users_by_key(users)
    j = activity.join(u, activity["CustomerKey"] == u["User_Key"], "inner")
    copies = F.col("_copies")
    amt_scale = activity.schema["SumAmount"].dataType.scale
    usd_scale = activity.schema["SumAmountUSD"].dataType.scale

    first, last = F.col("MinCreateDate"), F.col("MaxCreateDate")
    length = (F.datediff(last, first) + 1).cast("int")
    frequency = _count_times(F.col("IdCount"), copies, "Frequency")
    days = _count_times(F.col("CountDistinctDate"), copies, "DistinctTxDayCount")
    reg_gap = (
        F.lit(None).cast("int")
        if window.period in LOOKBACK_PERIODS
        else (F.datediff(first, F.to_date("_first_user")) + 1).cast("int")
    )
    staged = j.select(
        F.lit(window.base_day).alias("CreateDate"),
        F.lit(window.year_month).alias("YearMonth"),
        F.lit(window.period).cast("int").alias("Period"),
        "CustomerKey",
        "RegisterDate",
        reg_gap.alias("RegisterDateToFirstTxDate"),
        first.alias("FirstTxDate"),
        F.expr(split_code("MaxCreateDate")).alias("LastTxDate"),
        length.alias("Length"),
        (F.datediff(F.lit(window.base_day), last) - 1).cast("int").alias("Recency"),
        frequency.alias("Frequency"),
        days.alias("DistinctTxDayCount"),
        _times(F.col("SumAmount"), copies, amt_scale, "SumAmount").alias("SumAmount"),
        _times(F.col("SumAmountUSD"), copies, usd_scale, "SumAmountUSD").alias("SumAmountUSD"),
    )
    s, su = F.col("SumAmount"), F.col("SumAmountUSD")
    n, ln, d = F.col("Frequency"), F.col("Length"), F.col("DistinctTxDayCount")
    return staged.select(
        *BASE_COLUMNS[:11],
        _as(s, MONETARY_TYPE, "Monetary").alias("Monetary"),
        _as(su, MONETARY_TYPE, "MonetaryUSD").alias("MonetaryUSD"),
        ratio(s, n).alias("AvgTicketSize"),
        ratio(su, n).alias("AvgTicketSizeUSD"),
        ratio(s, ln).alias("AvgTxVolumePerDay"),
        ratio(su, ln).alias("AvgTxVolumePerDayUSD"),
        ratio(n, ln).alias("AvgTxCountPerDay"),
        "DistinctTxDayCount",
        ratio(ln, d).alias("TxRangeOfDaysFrequency"),
        *SUM_COLUMNS,
    )


def _trunc_ratio(num: str, den: str, what: str) -> Column:
    """``cast(coalesce(num / nullif(den, 0), 0) as int)`` with an exact quotient."""
    return _as(F.coalesce(F.expr(f"`{num}` div nullif(`{den}`, 0)"), F.lit(0)), "int", what)


def with_metric_values(base: DataFrame) -> DataFrame:
    """Adds the integer values the money metrics are graded on (truncation toward zero)."""
    return base.select(
        "*",
        _as(F.col("Monetary"), "int", "Monetary").alias("MonetaryINT"),
        _as(F.col("MonetaryUSD"), "int", "MonetaryUSD").alias("MonetaryUSDINT"),
        _trunc_ratio("SumAmount", "Frequency", "AvgTicketSize").alias("AvgTicketSizeINT"),
        _trunc_ratio("SumAmountUSD", "Frequency", "AvgTicketSizeUSD").alias("AvgTicketSizeUSDINT"),
        _trunc_ratio("SumAmount", "Length", "AvgTxVolumePerDay").alias("AvgTxVolumePerDayINT"),
        _trunc_ratio("SumAmountUSD", "Length", "AvgTxVolumePerDayUSD").alias("AvgTxVolumePerDayUSDINT"),
    )
