"""Valid card transactions, per-source customer activity and the merge of sources.

Plan shape (per run, any number of sources):

1. each source is filtered (type predicates and the date window reach the Parquet scan),
   unioned with a ``Source`` tag and joined to the broadcast day-rate table;
2. ``customer_sums``: one aggregate per customer, the only shuffle of the transactions, with
   the per-source figures side by side. Active days are a bitmap of the window's days, as
   64-bit words merged by OR, so every buffer has a fixed width: the aggregate stays a hash
   aggregate with map-side combine, where a set per group would make it sort its input
   after the first few groups. A customer holding a large share of all rows is one row per
   map task;
3. ``customer_activity`` and ``merge_sources`` are projections of it: the per-source HAVING
   applied to the figures, as one row per source or added up.

``month_state`` is the same aggregate per customer and calendar month (a month's days fit
one word), as a table to keep: ``sums_of_months`` adds up the months of any window, so
several periods and later months need no second scan of the transactions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmint.operators.joins import DEFAULT_BROADCAST_ROWS
from segmint.operators.rates import convert_currency, rates_in_window
from segmint.operators.window import ObservationWindow, window_filter

TX_COLUMNS = ("Source", "Id", "CustomerKey", "CreateDate", "Amount", "IsValid")


def valid_tx(tx: DataFrame) -> DataFrame:
    """Card transactions of the graded kind, flagged ``IsValid`` (not cancelled, no operator).

    Invalid rows stay: their amounts still count in the sums, so reversals net out.
    """
    kind = (F.col("FeatureType") == 2) & (F.col("CardTxType") == 1)
    valid = (F.col("IsCancellation") == 0) & F.col("OperatorKey").isNull()
    return tx.where(kind).withColumn("IsValid", F.coalesce(valid, F.lit(False)))


def source_rows(sources: Mapping[str, DataFrame], window: ObservationWindow) -> DataFrame:
    """All sources' rows of the window, tagged with their source name."""
    parts = [
        window_filter(valid_tx(tx), window).select(F.lit(name).alias("Source"), *TX_COLUMNS[1:])
        for name, tx in sources.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def converted_rows(
    sources: Mapping[str, DataFrame],
    rates: DataFrame,
    window: ObservationWindow,
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    rate_rows: int | None = None,
) -> DataFrame:
    return convert_currency(source_rows(sources, window), rates_in_window(rates, window), broadcast_rows, rate_rows)


#: Per source ``i``: valid Ids, days with a valid row, first and last of them, amount sums
#: (NULL without any amount).
SUM_FIELDS = ("_ids", "_days", "_first", "_last", "_amt", "_usd")


def _grouped(converted: DataFrame, names: Sequence[str], keys: Sequence[str], start: Column, words: int) -> DataFrame:
    """The per-source figures per ``keys``; ``start`` is the first day of the bitmap of ``words`` words."""
    day = F.to_date("CreateDate")
    rows = converted.select(
        "*", day.alias("_day"), F.expr(_source_number(names)).alias("_source"), F.datediff(day, start).alias("_nth")
    )
    rows = rows.selectExpr("*", "_nth div 64 AS _word", "shiftleft(1L, _nth % 64) AS _bit")
    aggs, fields = [], []
    for i in range(len(names)):
        mine = f"_source = {i}"
        valid = f"{mine} AND IsValid"
        aggs += [f"count(IF({valid}, Id, NULL)) AS _ids{i}"]
        aggs += [f"bit_or(IF({valid} AND _word = {k}, _bit, NULL)) AS _w{i}_{k}" for k in range(words)]
        aggs += [f"min(IF({valid}, _day, NULL)) AS _first{i}", f"max(IF({valid}, _day, NULL)) AS _last{i}"]
        aggs += [f"sum(IF({mine}, Amount, NULL)) AS _amt{i}", f"sum(IF({mine}, AmountUSD, NULL)) AS _usd{i}"]
        days = " + ".join(f"coalesce(bit_count(_w{i}_{k}), 0)" for k in range(words))
        fields += [f"CAST({days} AS BIGINT) AS _days{i}" if f == "_days" else f"{f}{i}" for f in SUM_FIELDS]
    return rows.groupBy(*keys).agg(*(F.expr(a) for a in aggs)).selectExpr(*keys, *fields)


def _source_number(names: Sequence[str]) -> str:
    quoted = [n.replace("\\", "\\\\").replace("'", "\\'") for n in names]
    return "CASE Source " + " ".join(f"WHEN '{n}' THEN {i}" for i, n in enumerate(quoted)) + " END"


def customer_sums(converted: DataFrame, source_names: Sequence[str], window: ObservationWindow) -> DataFrame:
    """Per ``CustomerKey``, the ``SUM_FIELDS`` of each source over the window's rows."""
    start = window.start or window.base_day
    words = max(1, -(-(window.base_day - start).days // 64))
    return _grouped(converted, source_names, ["CustomerKey"], F.lit(start), words)


def month_state(converted: DataFrame, source_names: Sequence[str]) -> DataFrame:
    """Per ``CustomerKey`` and ``Month`` (its first day), the ``SUM_FIELDS`` of each source."""
    month = F.trunc(F.to_date("CreateDate"), "month")
    return _grouped(converted.withColumn("Month", month), source_names, ["CustomerKey", "Month"], month, 1)


def sums_of_months(state: DataFrame, source_names: Sequence[str], window: ObservationWindow) -> DataFrame:
    """``customer_sums`` of a window from the months it consists of. Days of different months
    differ, so their numbers add up."""
    aggs = []
    for i in range(len(source_names)):
        for field in SUM_FIELDS:
            how = {"_first": "min", "_last": "max"}.get(field, "sum")
            # a sum of sums keeps their type, which is wide enough for all rows
            dtype = state.schema[f"{field}{i}"].dataType.simpleString()
            aggs.append(F.expr(f"CAST({how}({field}{i}) AS {dtype}) AS {field}{i}"))
    months = state.where(F.lit(False)) if window.empty else state.where(
        (F.col("Month") >= F.trunc(F.lit(window.start), "month")) & (F.col("Month") < F.lit(window.base_day))
    )
    return months.groupBy("CustomerKey").agg(*aggs)


def customer_activity(sums: DataFrame, source_names: Sequence[str]) -> DataFrame:
    """The procedure's per-source subquery: per ``(Source, CustomerKey)`` with HAVING IdCount > 0."""
    rows = [
        F.struct(
            F.lit(name).alias("Source"),
            F.col(f"_ids{i}").alias("IdCount"),
            F.col(f"_days{i}").alias("CountDistinctDate"),
            F.col(f"_first{i}").alias("MinCreateDate"),
            F.col(f"_last{i}").alias("MaxCreateDate"),
            (-F.col(f"_amt{i}")).alias("SumAmount"),
            (-F.col(f"_usd{i}")).alias("SumAmountUSD"),
        )
        for i, name in enumerate(source_names)
    ]
    return sums.select("CustomerKey", F.inline(F.array(*rows))).where(F.col("IdCount") > 0)


def _narrow(c: Column, dtype: T.DataType) -> Column:
    """Decimals one digit narrower than the maximum, so adding two keeps the scale."""
    if isinstance(dtype, T.DecimalType):
        return c.cast(T.DecimalType(37, dtype.scale))
    return c


def _sum_skip_nulls(cols: Sequence[Column], dtype: T.DataType) -> Column:
    """SQL ``sum`` over a few columns: NULLs skipped, NULL when all are NULL."""
    all_null = reduce(lambda a, b: a & b, [c.isNull() for c in cols])
    total = reduce(lambda a, b: _narrow(a + b, dtype), [_narrow(F.coalesce(c, F.lit(0)), dtype) for c in cols])
    return F.when(~all_null, total)


def merge_sources(sums: DataFrame, source_names: Sequence[str]) -> DataFrame:
    """Per customer, the UNION ALL of the per-source partials re-aggregated.

    A source contributes only if the customer has a valid Id in it (per-source HAVING),
    and then with all its amounts; a day active in two sources counts twice.
    """
    idx = range(len(source_names))
    keep = [F.col(f"_ids{i}") > 0 for i in idx]

    def kept(cols: Sequence[Column]) -> list[Column]:
        return [F.when(keep[i], cols[i]) for i in idx]

    ids, days, first, last, amt, usd = ([F.col(f"{c}{i}") for i in idx] for c in SUM_FIELDS)
    firsts, lasts = kept(first), kept(last)
    return sums.where(reduce(lambda a, b: a | b, keep)).select(
        "CustomerKey",
        _sum_skip_nulls(kept(ids), T.LongType()).alias("IdCount"),
        _sum_skip_nulls(kept(days), T.LongType()).alias("CountDistinctDate"),
        (F.least(*firsts) if len(idx) > 1 else firsts[0]).alias("MinCreateDate"),
        (F.greatest(*lasts) if len(idx) > 1 else lasts[0]).alias("MaxCreateDate"),
        (-_sum_skip_nulls(kept(amt), sums.schema["_amt0"].dataType)).alias("SumAmount"),
        (-_sum_skip_nulls(kept(usd), sums.schema["_usd0"].dataType)).alias("SumAmountUSD"),
    )
