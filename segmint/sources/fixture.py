"""The shared test fixture: the driver's ``orders`` / ``customer`` tables mapped onto the
procedure's inputs (two transaction sources, users, two rate sources).

The same mapping is written in SQL for the DuckDB oracle (``segmint_oracle``); both follow
FIXTURES.md. Everything here is a projection or a filter of the given tables, so it grows
with them.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segmint.sources.readers import conform
from segmint.sources.schemas import PRICE, RATES_CURRENT, RATES_LEGACY, TRANSACTIONS, USERS

# Fixed values of the fixture (FIXTURES.md), in natural order.
BASE_DAY = date(2001, 7, 15)
FIRST_TX_DATE = date(1995, 1, 1)
ARCHIVE_BEFORE = date(1998, 1, 1)
RATE_CUTOVER = date(1998, 6, 1)
RATE_EPOCH = date(1995, 1, 1)
RATE_CYCLE = (Decimal("1.25"), Decimal("1.6"), Decimal("2.0"), Decimal("2.5"), Decimal("3.2"), Decimal("4.0"))
RATE_GAP_EVERY = 11  # no rate on days n with n % 11 == 0
RATE_SPREAD = Decimal("0.01")
USER_EPOCH = date(1994, 1, 1)
USER_DROP_EVERY = 50  # customers with c_custkey % 50 == 0 have no user row


@dataclass(frozen=True)
class FixtureTables:
    transactions_hot: DataFrame
    transactions_archive: DataFrame
    users: DataFrame
    rates_legacy: DataFrame
    rates_current: DataFrame

    @property
    def sources(self) -> dict[str, DataFrame]:
        return {"hot": self.transactions_hot, "archive": self.transactions_archive}


def _transactions(orders: DataFrame) -> DataFrame:
    pending = F.col("o_orderstatus") == "P"
    cancel = F.when(pending & (F.col("o_orderpriority") == "1-URGENT"), 1).otherwise(0)
    cents = F.floor(F.col("o_totalprice") / 10).cast("bigint")
    amount = (cents.cast("decimal(18,2)") / 100).cast("decimal(18,2)")
    return conform(
        orders.select(
            F.col("o_orderkey").alias("Id"),
            F.col("o_custkey").alias("CustomerKey"),
            F.col("o_orderdate").cast("timestamp_ntz").alias("CreateDate"),
            F.when(cancel == 1, amount).otherwise(-amount).alias("Amount"),
            cancel.alias("IsCancellation"),
            F.when(pending & (F.col("o_orderpriority") == "5-LOW"), F.lit(7)).alias("OperatorKey"),
            F.when(F.col("o_orderkey") % 10 == 0, 1).otherwise(2).alias("FeatureType"),
            F.when(F.col("o_orderkey") % 7 == 0, 2).otherwise(1).alias("CardTxType"),
        ),
        TRANSACTIONS,
    )


def _rate_days(orders: DataFrame) -> DataFrame:
    day = F.to_date(F.col("o_orderdate"))
    days = orders.select(day.alias("Date")).distinct()
    n = F.datediff(F.col("Date"), F.lit(RATE_EPOCH))
    rate = F.element_at(F.array(*[F.lit(r).cast(PRICE) for r in RATE_CYCLE]), (n % len(RATE_CYCLE) + 1).cast("int"))
    return days.where(n % RATE_GAP_EVERY != 0).select("Date", rate.alias("rate"))


def _spread(rate: Column, sign: int) -> Column:
    return (rate + F.lit(RATE_SPREAD) * sign).cast(PRICE)


def fixture_tables(spark: SparkSession, sf_dir: str) -> FixtureTables:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")

    tx = _transactions(orders)
    archive_before = F.lit(f"{ARCHIVE_BEFORE.isoformat()} 00:00:00").cast("timestamp_ntz")
    hot = tx.where(F.col("CreateDate") >= archive_before)
    archive = tx.where(F.col("CreateDate") < archive_before)

    users = conform(
        customer.where(F.col("c_custkey") % USER_DROP_EVERY != 0).select(
            F.col("c_custkey").alias("User_Key"),
            F.date_add(F.lit(USER_EPOCH), (F.col("c_custkey") % 365).cast("int")).cast("timestamp_ntz").alias("CreateDate"),
        ),
        USERS,
    )

    days = _rate_days(orders)
    legacy = conform(days.select("Date", F.col("rate").alias("Price_USDTRY")), RATES_LEGACY)
    current = conform(
        days.select(
            F.col("Date").alias("Tarih"),
            _spread(F.col("rate"), -1).alias("USD-A"),
            _spread(F.col("rate"), +1).alias("USD-S"),
        ),
        RATES_CURRENT,
    )
    return FixtureTables(hot, archive, users, legacy, current)
