"""What is graded, and how: one ``MetricSpec`` per base metric, one ``EliteSpec`` per elite metric.

The default lists reproduce the procedure exactly, including its cross-wired choices
(USD metrics eligible by their TRY counterpart, elite gates on ``MonetaryScore``, the USD
ticket-size score band cut at the TRY bound, the USD volume band built from TRY values).
``CONSISTENT_*`` use each metric's own value, population, gate and bound instead.

Eligibility predicates are exact: ratios are compared through their decimal operands
(``SumAmount >= 10 * Frequency`` for ``AvgTicketSize >= 10``), never through doubles.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class MetricSpec:
    name: str  # output prefix: <name>Group, <name>Score, <name>Points
    value: str  # integer value column of the extended base table
    eligible: str  # SQL predicate over the extended base table
    p_low: int = 5  # percent
    p_high: int = 95
    descending: bool = False  # rank high values first (Recency)
    # whether equal values are equally eligible, so that an ineligible customer's value is
    # never that of an eligible one; False (always correct) makes grading look it up
    eligible_by_value: bool = False
    # whether all customers above (descending: below) an eligible one's value are eligible: then
    # those beyond the bound are in the histogram, and elite populations are read from it
    eligible_beyond: bool = False


@dataclass(frozen=True)
class EliteSpec:
    name: str  # output: EliteSegmentScore_<name>, EliteSegmentPoints_<name>
    band_value: str  # distinct values of this column (in the population) form the band
    bound_value: str  # P99 of this column over the population is the bound
    join_value: str  # the customer's own value looked up in the band and compared to the bound
    population: str  # score column that must be 5 for a customer to be in the population
    gate: str  # score column that must be 5 for a non-zero elite grade
    score_bound_of: str | None = None  # elite metric whose bound cuts the score band (None: own)
    p_high: int = 99


def _ticket(ratio_of: str, threshold: str) -> str:
    return f"Frequency > 0 AND {ratio_of} >= {threshold} * Frequency"


def _volume(ratio_of: str, threshold: str) -> str:
    return f"Length > 0 AND {ratio_of} >= {threshold} * Length"


# Fixed values of the procedure: thresholds and percentiles per metric.
DEFAULT_METRIC_SPECS: tuple[MetricSpec, ...] = (
    MetricSpec("Length", "Length", "Length > 1", eligible_by_value=True),
    MetricSpec("Recency", "Recency", "Recency > 3 AND Recency < 121", descending=True, eligible_by_value=True),
    MetricSpec("Frequency", "Frequency", "Frequency > 2", eligible_by_value=True),
    MetricSpec("Monetary", "MonetaryINT", "Monetary >= 50", eligible_by_value=True, eligible_beyond=True),
    MetricSpec("MonetaryUSD", "MonetaryUSDINT", "Monetary > 50"),
    MetricSpec("AvgTicketSize", "AvgTicketSizeINT", _ticket("SumAmount", "10"), eligible_by_value=True, eligible_beyond=True),
    MetricSpec("AvgTicketSizeUSD", "AvgTicketSizeUSDINT", _ticket("SumAmount", "10")),
    MetricSpec("AvgTxVolumePerDay", "AvgTxVolumePerDayINT", _volume("SumAmount", "0.15"), eligible_beyond=True),
    MetricSpec("AvgTxVolumePerDayUSD", "AvgTxVolumePerDayUSDINT", _volume("SumAmount", "0.015"), p_low=1, p_high=99),
)

DEFAULT_ELITE_SPECS: tuple[EliteSpec, ...] = (
    EliteSpec("Monetary", "MonetaryINT", "MonetaryINT", "MonetaryINT", "MonetaryScore", "MonetaryScore"),
    EliteSpec("MonetaryUSD", "MonetaryUSDINT", "MonetaryUSDINT", "MonetaryUSDINT", "MonetaryScore", "MonetaryUSDScore"),
    EliteSpec("AvgTicketSize", "AvgTicketSizeINT", "AvgTicketSizeINT", "AvgTicketSizeINT", "AvgTicketSizeScore", "MonetaryScore"),
    EliteSpec(
        "AvgTicketSizeUSD",
        "AvgTicketSizeUSDINT",
        "AvgTicketSizeUSDINT",
        "AvgTicketSizeUSDINT",
        "AvgTicketSizeUSDScore",
        "MonetaryScore",
        score_bound_of="AvgTicketSize",
    ),
    EliteSpec(
        "AvgTxVolumePerDay",
        "AvgTxVolumePerDayINT",
        "AvgTxVolumePerDayINT",
        "AvgTxVolumePerDayINT",
        "AvgTxVolumePerDayScore",
        "MonetaryScore",
    ),
    EliteSpec(
        "AvgTxVolumePerDayUSD",
        "AvgTxVolumePerDayINT",
        "AvgTxVolumePerDayUSDINT",
        "AvgTxVolumePerDayUSDINT",
        "AvgTxVolumePerDayUSDScore",
        "MonetaryScore",
    ),
)

CONSISTENT_METRIC_SPECS: tuple[MetricSpec, ...] = (
    *DEFAULT_METRIC_SPECS[:4],
    MetricSpec("MonetaryUSD", "MonetaryUSDINT", "MonetaryUSD >= 50", eligible_by_value=True, eligible_beyond=True),
    DEFAULT_METRIC_SPECS[5],
    MetricSpec("AvgTicketSizeUSD", "AvgTicketSizeUSDINT", _ticket("SumAmountUSD", "10"), eligible_by_value=True, eligible_beyond=True),
    DEFAULT_METRIC_SPECS[7],
    MetricSpec("AvgTxVolumePerDayUSD", "AvgTxVolumePerDayUSDINT", _volume("SumAmountUSD", "0.015"), p_low=1, p_high=99, eligible_beyond=True),
)

CONSISTENT_ELITE_SPECS: tuple[EliteSpec, ...] = tuple(
    EliteSpec(n, v, v, v, f"{n}Score", f"{n}Score")
    for n, v in (
        ("Monetary", "MonetaryINT"),
        ("MonetaryUSD", "MonetaryUSDINT"),
        ("AvgTicketSize", "AvgTicketSizeINT"),
        ("AvgTicketSizeUSD", "AvgTicketSizeUSDINT"),
        ("AvgTxVolumePerDay", "AvgTxVolumePerDayINT"),
        ("AvgTxVolumePerDayUSD", "AvgTxVolumePerDayUSDINT"),
    )
)

# Currency rows of the result: per currency, which graded metric feeds the shared columns.
CURRENCY_METRICS = {
    0: {"Monetary": "Monetary", "AvgTicketSize": "AvgTicketSize", "AvgTxVolumePerDay": "AvgTxVolumePerDay"},
    1: {"Monetary": "MonetaryUSD", "AvgTicketSize": "AvgTicketSizeUSD", "AvgTxVolumePerDay": "AvgTxVolumePerDayUSD"},
}
