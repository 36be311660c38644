"""One daily USD/TRY rate table from two source generations, and conversion."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmint.operators.joins import DEFAULT_BROADCAST_ROWS, broadcast_if_small
from segmint.operators.window import ObservationWindow

# Fixed value of the procedure: the day the current rate source takes over.
DEFAULT_CUTOVER = date(2024, 2, 6)

# (buy + sell) / 2 of two decimal(18,6) prices has at most 7 decimals: decimal(20,7) is exact.
RATE_TYPE = T.DecimalType(20, 7)

#: Parts of a day's transactions in the join that is too large to broadcast.
SALTS = 64


def _checked(rate):
    return F.when(rate.isNull() | (rate > 0), rate).otherwise(
        F.raise_error(F.concat(F.lit("exchange rate must be positive, got "), rate.cast("string")))
    ).cast(RATE_TYPE)


def daily_rates(legacy: DataFrame, current: DataFrame, cutover: date = DEFAULT_CUTOVER) -> DataFrame:
    """Distinct ``(Date, Price_USDTRY)`` of the legacy source before ``cutover`` followed by
    distinct ``(Tarih, (USD-A + USD-S) / 2)`` of the current source from ``cutover`` on.

    Several prices on one date are all kept (each multiplies that day's transactions).
    A rate <= 0 fails the job, as division by it would.
    """
    old = (
        legacy.where(F.col("Date") < F.lit(cutover))
        .select("Date", F.col("Price_USDTRY").cast(RATE_TYPE).alias("Price_USDTRY"))
        .distinct()
    )
    new = (
        current.where(F.col("Tarih") >= F.lit(cutover))
        .select(
            F.col("Tarih").alias("Date"),
            ((F.col("`USD-A`") + F.col("`USD-S`")) / 2).cast(RATE_TYPE).alias("Price_USDTRY"),
        )
        .distinct()
    )
    both = old.unionByName(new)
    return both.select("Date", _checked(F.col("Price_USDTRY")).alias("Price_USDTRY"))


def rates_in_window(rates: DataFrame, window: ObservationWindow) -> DataFrame:
    """Only the days a transaction of the window can match (bounds the broadcast side)."""
    if window.empty:
        return rates.where(F.lit(False))
    return rates.where((F.col("Date") >= F.lit(window.start)) & (F.col("Date") < F.lit(window.base_day)))


def convert_currency(
    tx: DataFrame,
    rates: DataFrame,
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    rate_rows: int | None = None,
) -> DataFrame:
    """Left-join each transaction to its day's rate(s); ``AmountUSD = Amount / rate``.

    Days without a rate give NULL (skipped by sums). The rate table is one row per day, so
    it is broadcast after a row-count check (``rate_rows`` if the caller counted already);
    the transactions are never shuffled here. Beyond the limit both sides are dealt by day
    and one of ``SALTS`` parts of the day's transactions, so that no day's rows meet in one
    task; the rates are repeated per part.
    """
    side = rates.select(F.col("Date").alias("_rate_date"), "Price_USDTRY")
    side, small = broadcast_if_small(side, broadcast_rows, rows=rate_rows)
    same_day = F.to_date(F.col("CreateDate")) == F.col("_rate_date")
    if not small:
        side = side.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("shuffle_merge")
        joined = tx.join(side, same_day & (F.pmod(F.xxhash64("CustomerKey", "Id"), F.lit(SALTS)) == F.col("_part")), "left").drop("_part")
    else:
        joined = tx.join(side, same_day, "left")
    return joined.drop("_rate_date").withColumn("AmountUSD", F.col("Amount") / F.col("Price_USDTRY"))
