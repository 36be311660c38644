"""The observation window ``[start, base)`` for a month-end and a look-back period."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the procedure: supported look-back periods (months) and the default
# start of period 0.
PERIOD_MONTHS = {1: 1, 3: 3, 6: 6, 9: 9, 12: 12}
DEFAULT_FIRST_TX_DATE = date(2013, 1, 1)
LOOKBACK_PERIODS = (1, 3, 6, 9, 12)  # periods without RegisterDateToFirstTxDate


def _add_months(d: date, months: int) -> date:
    y, m = divmod(d.year * 12 + (d.month - 1) + months, 12)
    return date(y, m + 1, 1)


@dataclass(frozen=True)
class ObservationWindow:
    base_day: date  # first day of the month of the requested day (exclusive end)
    year_month: date  # the month before ``base_day``
    period: int
    start: date | None  # None for an unsupported period: the window is empty

    @property
    def empty(self) -> bool:
        return self.start is None


def observation_window(day: date, period: int, first_tx_date: date = DEFAULT_FIRST_TX_DATE) -> ObservationWindow:
    base = date(day.year, day.month, 1)
    if period == 0:
        start: date | None = first_tx_date
    elif period in PERIOD_MONTHS:
        start = _add_months(base, -PERIOD_MONTHS[period])
    else:
        start = None
    return ObservationWindow(base, _add_months(base, -1), period, start)


def day_literal(d: date, dtype: T.DataType) -> Column:
    """A literal for ``d`` of the column's own type, so comparisons stay pushable."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"TIMESTAMP_NTZ'{d.isoformat()} 00:00:00'")
    if isinstance(dtype, T.TimestampType):
        return F.expr(f"TIMESTAMP'{d.isoformat()} 00:00:00'")
    return F.expr(f"DATE'{d.isoformat()}'")


def window_filter(tx: DataFrame, window: ObservationWindow, column: str = "CreateDate") -> DataFrame:
    """Rows with ``start <= column < base``; no rows for an unsupported period."""
    if window.empty:
        return tx.where(F.lit(False))
    dtype = tx.schema[column].dataType
    c = F.col(column)
    return tx.where((c >= day_literal(window.start, dtype)) & (c < day_literal(window.base_day, dtype)))


def tag_windows(tx: DataFrame, windows: Sequence[ObservationWindow], column: str = "CreateDate") -> DataFrame:
    """One row per input row and window it lies in, with the window's ``Period``, in one scan.

    The filter on the span of all windows reaches the scan; empty windows match nothing.
    """
    live = [w for w in windows if not w.empty]
    if not live:
        return tx.where(F.lit(False)).select(F.lit(0).alias("Period"), "*")
    dtype = tx.schema[column].dataType
    c = F.col(column)
    low, high = min(w.start for w in live), max(w.base_day for w in live)
    inside = [
        F.when((c >= day_literal(w.start, dtype)) & (c < day_literal(w.base_day, dtype)), F.lit(w.period)) for w in live
    ]
    span = tx.where((c >= day_literal(low, dtype)) & (c < day_literal(high, dtype)))
    return span.select(F.explode(F.array_compact(F.array(*inside))).alias("Period"), "*")
