"""Column-level building blocks (all built-in Spark expressions, no UDFs)."""

from segmint.functions.exact import (
    BASE_POINTS,
    ELITE_POINTS,
    PointsScale,
    cents_to_points,
    floor_div,
    ntile_from_rank,
    points_cents,
    points_from_rank,
    ratio,
)

__all__ = [
    "BASE_POINTS",
    "ELITE_POINTS",
    "PointsScale",
    "cents_to_points",
    "floor_div",
    "ntile_from_rank",
    "points_cents",
    "points_from_rank",
    "ratio",
]
