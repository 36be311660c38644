"""segmint: customer LRFM segmentation with percentile outlier bands, on Spark.

The public entry point is :func:`segmint.plans.pipeline.segment_customers`;
every stage of it is importable on its own from :mod:`segmint.operators`.
"""

from segmint.operators.output import write_months, write_result, write_result_table
from segmint.plans.pipeline import SegmentationResult, build_months, segment_customers, segment_periods
from segmint.plans.specs import (
    CONSISTENT_ELITE_SPECS,
    CONSISTENT_METRIC_SPECS,
    DEFAULT_ELITE_SPECS,
    DEFAULT_METRIC_SPECS,
    EliteSpec,
    MetricSpec,
)
from segmint.operators.window import ObservationWindow, observation_window

__all__ = [
    "CONSISTENT_ELITE_SPECS",
    "CONSISTENT_METRIC_SPECS",
    "DEFAULT_ELITE_SPECS",
    "DEFAULT_METRIC_SPECS",
    "EliteSpec",
    "MetricSpec",
    "ObservationWindow",
    "SegmentationResult",
    "build_months",
    "observation_window",
    "segment_customers",
    "segment_periods",
    "write_months",
    "write_result",
    "write_result_table",
]
