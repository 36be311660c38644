"""Segment codes, one row per customer per currency, and the result sink.

The two currency rows come from one pass (``inline`` of a two-element array), not from a
UNION ALL that would evaluate the graded plan twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmint.operators.base import BASE_COLUMNS
from segmint.operators.elite import elite_columns
from segmint.operators.grade import grade_columns
from segmint.operators.joins import split_code
from segmint.operators.window import ObservationWindow
from segmint.plans.specs import CURRENCY_METRICS, EliteSpec, MetricSpec
from segmint.session import file_system

SHARED_HEAD = (
    "CreateDate",
    "YearMonth",
    "Period",
)
CUSTOMER_COLUMNS = (
    "CustomerKey",
    "RegisterDate",
    "RegisterDateToFirstTxDate",
    "FirstTxDate",
    "LastTxDate",
    "Length",
    "Recency",
    "Frequency",
)

CODE_COLUMNS = (
    "LR",
    "FM",
    "LRFM",
    "FM_ByTicketSize",
    "LRFM_ByTicketSize",
    "FM_ByVolumePerDay",
    "LRFM_ByVolumePerDay",
    "RFM_Score",
    "RFM_Score_ByTicketSize",
    "RFM_Score_ByVolumePerDay",
)

RESULT_COLUMNS = (
    *SHARED_HEAD,
    "Currency",
    *CUSTOMER_COLUMNS,
    "Monetary",
    "AvgTicketSize",
    "AvgTxVolumePerDay",
    "AvgTxCountPerDay",
    "DistinctTxDayCount",
    "TxRangeOfDaysFrequency",
    "L",
    "R",
    "F",
    "M",
    "TicketSize",
    "VolumePerDay",
    *CODE_COLUMNS[:7],
    "LengthScore",
    "RecencyScore",
    "FrequencyScore",
    "MonetaryScore",
    "AvgTicketSizeScore",
    "AvgTxVolumePerDayScore",
    *CODE_COLUMNS[7:],
    "LengthPoints",
    "RecencyPoints",
    "FrequencyPoints",
    "MonetaryPoints",
    "AvgTicketSizePoints",
    "AvgTxVolumePerDayPoints",
    "ESByMonetary",
    "ESByAvgTicketSize",
    "ESByAvgTxVolumePerDay",
    "ESPointsByMonetary",
    "ESPointsByAvgTicketSize",
    "ESPointsByAvgTxVolumePerDay",
)


def _code(*columns: str) -> str:
    """SQL: concatenate one-character grades; a NULL grade contributes nothing."""
    return "concat_ws('', " + ", ".join(f"CAST({c} AS STRING)" for c in columns) + ")"


def segment_codes(currency: int) -> dict[str, str]:
    """The code columns of one currency, as SQL expressions over the graded columns."""
    m = CURRENCY_METRICS[currency]
    mon, tic, vol = m["Monetary"], m["AvgTicketSize"], m["AvgTxVolumePerDay"]
    lg, rg, fg = "LengthGroup", "RecencyGroup", "FrequencyGroup"
    rs, fs = "RecencyScore", "FrequencyScore"
    return {
        "LR": _code(lg, rg),
        "FM": _code(fg, f"{mon}Group"),
        "LRFM": _code(lg, rg, fg, f"{mon}Group"),
        "FM_ByTicketSize": _code(fg, f"{tic}Group"),
        "LRFM_ByTicketSize": _code(lg, rg, fg, f"{tic}Group"),
        "FM_ByVolumePerDay": _code(fg, f"{vol}Group"),
        "LRFM_ByVolumePerDay": _code(lg, rg, fg, f"{vol}Group"),
        "RFM_Score": _code(rs, fs, f"{mon}Score"),
        "RFM_Score_ByTicketSize": _code(rs, fs, f"{tic}Score"),
        "RFM_Score_ByVolumePerDay": _code(rs, fs, f"{vol}Score"),
    }


def currency_columns(currency: int) -> dict[str, str]:
    """All result columns of one currency (SQL expressions), by result name."""
    m = CURRENCY_METRICS[currency]
    mon, tic, vol = m["Monetary"], m["AvgTicketSize"], m["AvgTxVolumePerDay"]
    cols: dict[str, str] = {c: c for c in SHARED_HEAD}
    cols["Currency"] = f"CAST({currency} AS INT)"
    cols.update({c: c for c in CUSTOMER_COLUMNS})
    cols.update(
        {
            "Monetary": mon,
            "AvgTicketSize": tic,
            "AvgTxVolumePerDay": vol,
            "AvgTxCountPerDay": "AvgTxCountPerDay",
            "DistinctTxDayCount": "DistinctTxDayCount",
            "TxRangeOfDaysFrequency": "TxRangeOfDaysFrequency",
            "L": "LengthGroup",
            "R": "RecencyGroup",
            "F": "FrequencyGroup",
            "M": f"{mon}Group",
            "TicketSize": f"{tic}Group",
            "VolumePerDay": f"{vol}Group",
            "LengthScore": "LengthScore",
            "RecencyScore": "RecencyScore",
            "FrequencyScore": "FrequencyScore",
            "MonetaryScore": f"{mon}Score",
            "AvgTicketSizeScore": f"{tic}Score",
            "AvgTxVolumePerDayScore": f"{vol}Score",
            "LengthPoints": "LengthPoints",
            "RecencyPoints": "RecencyPoints",
            "FrequencyPoints": "FrequencyPoints",
            "MonetaryPoints": f"{mon}Points",
            "AvgTicketSizePoints": f"{tic}Points",
            "AvgTxVolumePerDayPoints": f"{vol}Points",
            "ESByMonetary": f"EliteSegmentScore_{mon}",
            "ESByAvgTicketSize": f"EliteSegmentScore_{tic}",
            "ESByAvgTxVolumePerDay": f"EliteSegmentScore_{vol}",
            "ESPointsByMonetary": f"EliteSegmentPoints_{mon}",
            "ESPointsByAvgTicketSize": f"EliteSegmentPoints_{tic}",
            "ESPointsByAvgTxVolumePerDay": f"EliteSegmentPoints_{vol}",
        }
    )
    cols.update(segment_codes(currency))
    return cols


def currency_rows(scored: DataFrame, columns: Sequence[str] = RESULT_COLUMNS, currencies=(0, 1)) -> DataFrame:
    """Wide -> long by currency, in one scan of ``scored``."""
    structs, codes = [], []
    for cur in currencies:
        cols = currency_columns(cur)
        for c in CODE_COLUMNS:
            if c in columns:
                codes.append((cols[c], f"_{c}_{cur}"))
                cols[c] = codes[-1][1]
        structs.append("named_struct(" + ", ".join(f"'{c}', {cols[c]}" for c in columns) + ")")
    if codes:
        codes[-1] = (split_code(codes[-1][0]), codes[-1][1])
        scored = scored.selectExpr("*", *(f"{code} AS {name}" for code, name in codes))
    return scored.selectExpr(f"inline(array({', '.join(structs)}))")


def wide_columns(metric_specs: Sequence[MetricSpec], elite_specs: Sequence[EliteSpec]) -> list[str]:
    """Columns of the wide table: base, groups, scores, points, elite scores, elite points."""
    grades = [grade_columns(m) for m in metric_specs]
    elites = [elite_columns(e) for e in elite_specs]
    return [*BASE_COLUMNS, *(g[k] for k in range(3) for g in grades), *(e[k] for k in range(2) for e in elites)]


#: Folders that readers skip: a replacement being written, and what it replaces.
NEW_PREFIX, OLD_PREFIX = "_new-", "_old-"


def _own_rows(rows: DataFrame, window: ObservationWindow) -> DataFrame:
    own = (F.col("YearMonth") == F.lit(window.year_month)) & (F.col("Period") == window.period)
    return rows.where(own).drop("YearMonth", "Period")


def _recover(fs, make, parent: str, name: str) -> None:
    """Finish what a writer that died left: of a replacement only the last step, a rename, can
    be missing; then the old rows are put back."""
    target, old = make(f"{parent}/{name}"), make(f"{parent}/{OLD_PREFIX}{name}")
    if fs.exists(old):
        if fs.exists(target):
            fs.delete(old, True)
        else:
            fs.rename(old, target)


def replace_folder(rows: DataFrame, folder: str) -> None:
    """Replace the Parquet files of ``folder`` by ``rows``, all or nothing.

    The rows are written beside the folder, under a name that readers of the parent skip. Only
    a complete write is published, by renames (the old folder aside, the new one in its place,
    the old one deleted): a failed write leaves the old rows as they were, and one that dies
    between the renames is undone by the next call. Renames are atomic on HDFS and local
    disks; on a store without them a reader may see the folder missing or in part for the time
    of the copy. One writer per folder at a time.
    """
    parent, _, name = folder.rstrip("/").rpartition("/")
    fs, make = file_system(rows.sparkSession, folder)
    target, old, new = make(folder), make(f"{parent}/{OLD_PREFIX}{name}"), make(f"{parent}/{NEW_PREFIX}{uuid.uuid4().hex}")
    _recover(fs, make, parent, name)
    try:
        rows.write.mode("errorifexists").parquet(new.toString())
        if fs.exists(target) and not fs.rename(target, old):
            raise OSError(f"could not set {folder} aside")
        if not fs.rename(new, target):
            fs.rename(old, target)
            raise OSError(f"could not publish {folder}")
        fs.delete(old, True)
    finally:
        fs.delete(new, True)


def write_result(rows: DataFrame, path: str, window: ObservationWindow) -> None:
    """Replace the rows of the window's (month, period) under ``path`` (Parquet), all or
    nothing (:func:`replace_folder`).

    A run without rows leaves an empty partition and never stale ones, and other months and
    periods survive.
    """
    folder = f"{path.rstrip('/')}/YearMonth={window.year_month.isoformat()}/Period={window.period}"
    replace_folder(_own_rows(rows, window), folder)


def write_result_table(rows: DataFrame, table: str, window: ObservationWindow) -> None:
    """U22 for a catalog table, created on first use with the same partitioning. The partition's
    folder is replaced as for a path, then made known to the catalog."""
    spark = rows.sparkSession
    if not spark.catalog.tableExists(table):
        rows.limit(0).write.format("parquet").partitionBy("YearMonth", "Period").saveAsTable(table)
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    write_result(rows.select(*spark.table(table).columns), details["data_type"], window)
    spec = f"PARTITION (YearMonth = DATE'{window.year_month.isoformat()}', Period = {window.period})"
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {spec}")
    spark.catalog.refreshTable(table)


def write_months(state: DataFrame, path: str) -> None:
    """Write a months' state by ``Month``; months it holds are replaced, others survive.

    Spark's dynamic overwrite moves finished files into place when all tasks are done, so a
    failed write changes nothing. A month's rows are brought together first, so that the number
    of files follows their size: each task would write one to every month.
    """
    state.hint("rebalance", "Month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("Month").parquet(path)
