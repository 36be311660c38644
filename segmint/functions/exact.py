"""Exact arithmetic shared by every grading step.

* ``ntile`` is derived from a row's rank and the row count, so it never needs a window
  over all values.
* Points are ``round(lo + (rn-1) * span / (n-1), 2)`` rounded half away from zero, done in
  integer cents; a double formula crosses a rounding boundary for some ``n``.
* Continuous percentiles are interpolated in integers: with ``h = p * (N-1)`` (p in
  percent), ``q = h // 100`` and ``r = h % 100``, the value is
  ``(x[q] * (100-r) + x[q+1] * r) / 100``; floor/ceiling are then exact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

POINTS_TYPE = "decimal(18,2)"


@dataclass(frozen=True)
class PointsScale:
    """Points scale in cents: the first rank gets ``low``, the last ``low + span``."""

    low: int
    span: int


# Fixed values of the procedure: base points run 1.05 .. 99.95, elite points 1.00 .. 99.95.
BASE_POINTS = PointsScale(low=105, span=9890)
ELITE_POINTS = PointsScale(low=100, span=9895)


def floor_div(a: str, b: int | str) -> Column:
    """Exact ``floor(a / b)`` for a long column ``a`` and ``b > 0`` (``div`` truncates, so the
    remainder is taken with ``pmod`` first)."""
    return F.expr(f"(({a}) - pmod({a}, {b})) div ({b})")


def ntile_from_rank(rn: str, n: str, buckets: int) -> Column:
    """``ntile(buckets) over (order by v)`` of the row ranked ``rn`` (1-based) of ``n`` rows.

    ``rn`` and ``n`` name long columns (both >= 1); the first ``n % buckets`` buckets hold
    one row more, as ``ntile`` does.
    """
    size = f"({n} div {buckets})"
    rem = f"({n} % {buckets})"
    big = f"({rem} * ({size} + 1))"
    return F.expr(
        f"CAST(CASE WHEN {rn} <= {big} THEN ({rn} - 1) div ({size} + 1) + 1 "
        f"ELSE {rem} + ({rn} - 1 - {big}) div greatest({size}, 1) + 1 END AS INT)"
    )


def points_cents(rn: str, n: str, scale: PointsScale) -> Column:
    """``lo + round_half_up(span * (rn-1) / (n-1))`` in integer cents; ``n = 1`` gives ``lo``.

    (The procedure divides by zero for a single-value band; returning the low end is a
    documented deviation.)
    """
    return F.expr(
        f"CASE WHEN {n} <= 1 THEN CAST({scale.low} AS BIGINT) "
        f"ELSE {scale.low} + (2 * {scale.span} * ({rn} - 1) + ({n} - 1)) div (2 * ({n} - 1)) END"
    )


def cents_to_points(cents: Column) -> Column:
    return (cents.cast("decimal(18,0)") / 100).cast(POINTS_TYPE)


def points_from_rank(rn: str, n: str, scale: PointsScale) -> Column:
    return cents_to_points(points_cents(rn, n, scale))


def ratio(num: Column, den: Column) -> Column:
    """``coalesce(num / nullif(den, 0), 0)`` as DOUBLE from the exact operands."""
    return F.coalesce(num.cast("double") / F.nullif(den, F.lit(0)).cast("double"), F.lit(0.0))
