"""Hand-made inputs for the quirk tests, loadable into Spark and into DuckDB alike.

``generate`` draws a small population that hits the special cases on purpose: days in
both sources, sources with only invalid rows, duplicate and missing users, days with two
rates or none, reversals larger than spend, and a rate of 1 so USD values equal TRY
values (which makes the cross-wired USD elite grades non-zero).
"""

from __future__ import annotations

import random
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from segmint.sources.schemas import TRANSACTIONS, USERS

RATE_SCHEMA = T.StructType([T.StructField("Date", T.DateType()), T.StructField("Price_USDTRY", T.DecimalType(20, 7))])

# rates with finite reciprocals, so the oracle can multiply exactly
RATES = (Decimal("1"), Decimal("1.25"), Decimal("2"), Decimal("2.5"), Decimal("4"), Decimal("0.5"))


@dataclass
class Inputs:
    tx: dict[str, list[tuple]] = field(default_factory=lambda: {"hot": [], "archive": []})
    users: list[tuple] = field(default_factory=list)
    rates: list[tuple] = field(default_factory=list)  # (date, rate)

    def spark_frames(self, spark: SparkSession) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
        sources = {k: spark.createDataFrame(v, TRANSACTIONS) for k, v in self.tx.items()}
        users = spark.createDataFrame(self.users, USERS)
        rates = spark.createDataFrame([(d, r) for d, r in self.rates], RATE_SCHEMA)
        return sources, users, rates

    def duckdb(self) -> duckdb.DuckDBPyConnection:
        con = duckdb.connect()
        con.execute(
            "CREATE TABLE tx (Source VARCHAR, Id BIGINT, CustomerKey BIGINT, CreateDate TIMESTAMP, "
            "Amount DECIMAL(18,2), IsCancellation INTEGER, OperatorKey INTEGER, FeatureType INTEGER, CardTxType INTEGER)"
        )
        rows = [(src, *r) for src, rs in self.tx.items() for r in rs]
        if rows:
            con.executemany("INSERT INTO tx VALUES (?, ?, ?, ?, ?, ?, ?, ?, ?)", rows)
        con.execute("CREATE TABLE users (User_Key BIGINT, CreateDate TIMESTAMP)")
        if self.users:
            con.executemany("INSERT INTO users VALUES (?, ?)", self.users)
        con.execute("CREATE TABLE daily_rates (Date DATE, Price_USDTRY DECIMAL(20,7), recip DECIMAL(20,10))")
        if self.rates:
            con.executemany(
                "INSERT INTO daily_rates VALUES (?, ?, ?)",
                [(d, r, None if r is None else Decimal(1) / r) for d, r in self.rates],
            )
        return con


def generate(seed: int, customers: int = 120, start: date = date(2023, 1, 1), days: int = 540) -> Inputs:
    rnd = random.Random(seed)
    inp = Inputs()
    all_days = [start + timedelta(days=i) for i in range(days)]
    for d in all_days:
        u = rnd.random()
        if u < 0.08:
            continue  # no rate that day
        inp.rates.append((d, RATES[0] if u < 0.45 else rnd.choice(RATES)))
        if u > 0.97:
            inp.rates.append((d, rnd.choice(RATES[1:])))  # a second rate on the same day
    tx_id = 0
    for c in range(1, customers + 1):
        kind = rnd.random()
        n = 1 if kind < 0.1 else rnd.randint(1, 4) if kind < 0.5 else rnd.randint(3, 25)
        base_amount = rnd.choice([5, 20, 60, 150, 400, 1500])
        first = rnd.randrange(days)
        spread = rnd.choice([0, 3, 30, 200, days])
        for _ in range(n):
            tx_id += 1
            d = all_days[min(days - 1, first + rnd.randrange(spread + 1))]
            when = datetime(d.year, d.month, d.day, rnd.randrange(24), rnd.randrange(60))
            cancel = 1 if rnd.random() < 0.08 else 0
            operator = 7 if rnd.random() < 0.06 else None
            amount = Decimal(rnd.randint(1, base_amount * 100)) / 100
            amount = amount if cancel else -amount
            if rnd.random() < 0.03:
                amount = Decimal(rnd.randint(1, 500000)) / 100  # a large reversal
            feature = 2 if rnd.random() < 0.93 else 1
            card = 1 if rnd.random() < 0.93 else 2
            source = "hot" if rnd.random() < 0.6 else "archive"
            inp.tx[source].append((tx_id, c, when, amount, cancel, operator, feature, card))
        if rnd.random() < 0.05:
            # a source holding only invalid rows for this customer
            tx_id += 1
            d = all_days[rnd.randrange(days)]
            inp.tx["archive"].append((tx_id, c, datetime(d.year, d.month, d.day), Decimal("-99.99"), 1, None, 2, 1))
        if rnd.random() < 0.95:
            reg = datetime(2020, 1, 1) + timedelta(days=rnd.randrange(1000))
            inp.users.append((c, reg))
            if rnd.random() < 0.04:
                inp.users.append((c, reg + timedelta(days=rnd.randrange(400))))  # duplicate user row
    return inp


def elite_inputs(regular: int = 380) -> Inputs:
    """Regular customers plus single-day "whales": whales on rate-1 days have equal TRY and
    USD volumes (non-zero USD-volume elite grades); whales on rate-2.5 days have USD ticket
    sizes between the USD and the TRY elite bounds (score band from the TRY bound, points
    100.00: Q14)."""
    rnd = random.Random(99)
    inp = Inputs()
    d0 = date(2023, 1, 1)
    for i in range(517):
        d = d0 + timedelta(days=i)
        inp.rates.append((d, Decimal("1") if d.year == 2023 else Decimal("2.5")))
    tx_id = 0
    for c in range(1, regular + 1):
        first = rnd.randrange(300)
        for _ in range(rnd.randint(3, 20)):
            tx_id += 1
            d = d0 + timedelta(days=first + rnd.randrange(200))
            inp.tx["hot" if rnd.random() < 0.5 else "archive"].append(
                (tx_id, c, datetime(d.year, d.month, d.day, 12), -Decimal(rnd.randint(1000, 30000)) / 100, 0, None, 2, 1)
            )
        inp.users.append((c, datetime(2021, 1, 1)))
    whales = [(d0 + timedelta(days=40 + k), Decimal(20000 + 1500 * k)) for k in range(10)]
    whales += [(date(2024, 2, 1) + timedelta(days=k), Decimal(30000 + 2000 * k)) for k in range(8)]
    for k, (d, amount) in enumerate(whales):
        c = regular + 1 + k
        tx_id += 1
        inp.tx["hot"].append((tx_id, c, datetime(d.year, d.month, d.day, 9), -amount, 0, None, 2, 1))
        inp.users.append((c, datetime(2021, 6, 1)))
    return inp


def with_hot_keys(inp: Inputs, seed: int = 0) -> Inputs:
    """Give one customer a third of all transaction rows (spread over days and both
    sources), and make a quarter of the customers share one Monetary value."""
    rnd = random.Random(seed)
    n = sum(len(v) for v in inp.tx.values())
    days = sorted({r[2].date() for v in inp.tx.values() for r in v})
    next_id = max((r[0] for v in inp.tx.values() for r in v), default=0) + 1
    for k in range(n // 2):
        d = days[rnd.randrange(len(days))]
        source = "hot" if k % 3 else "archive"
        inp.tx[source].append((next_id + k, 1, datetime(d.year, d.month, d.day, 7), -Decimal(rnd.randint(100, 9999)) / 100, 0, None, 2, 1))
    next_id += n // 2
    customers = sorted({r[1] for v in inp.tx.values() for r in v if r[1] != 1})
    for c in customers[: len(customers) // 4]:
        # net the customer's valid spend away, then add one identical purchase
        d = days[0]
        inp.tx["hot"] = [r for r in inp.tx["hot"] if r[1] != c]
        inp.tx["archive"] = [r for r in inp.tx["archive"] if r[1] != c]
        inp.tx["hot"].append((next_id, c, datetime(d.year, d.month, d.day, 9), Decimal("-777.77"), 0, None, 2, 1))
        next_id += 1
    return inp
