"""Benchmark: the whole segmentation on the fixture at $BENCH_SF_DIR on local[$BENCH_CPUS].

Per headline query: the median wall time of three runs (after one warm-up run of each,
timed round-robin), each writing the result as Parquet (the real sink). Prints ONE JSON line. Job count and shuffle bytes
come from Spark's event log, written to a fresh scratch folder.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = {"segmentation_full": 0, "segmentation_p12": 12, "segmentation_p3": 3}
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session(cpus: str, scratch: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("segmint-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{scratch}/events")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def event_totals(scratch: str) -> tuple[int, int, dict[str, float], float]:
    """Jobs, shuffle bytes written, job seconds per pipeline phase (job description), and the
    seconds in which any job ran."""
    jobs, shuffle = 0, 0
    spans: list[tuple[int, int]] = []
    started: dict[int, tuple[int, str]] = {}
    phases: dict[str, float] = {}
    for path in glob.glob(f"{scratch}/events/**", recursive=True):
        if not os.path.isfile(path):
            continue
        with open(path) as fh:
            for line in fh:
                if '"SparkListenerJobStart"' in line:
                    jobs += 1
                    ev = json.loads(line)
                    desc = (ev.get("Properties") or {}).get("spark.job.description") or "other"
                    started[ev["Job ID"]] = (ev["Submission Time"], desc.removeprefix("segmint: "))
                elif '"SparkListenerJobEnd"' in line:
                    ev = json.loads(line)
                    t0, desc = started.pop(ev["Job ID"], (ev["Completion Time"], "other"))
                    spans.append((t0, ev["Completion Time"]))
                    phases[desc] = phases.get(desc, 0.0) + (ev["Completion Time"] - t0) / 1000
                elif '"SparkListenerTaskEnd"' in line:
                    ev = json.loads(line)
                    m = ev.get("Task Metrics") or {}
                    shuffle += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
    busy, reach = 0, 0
    for a, b in sorted(spans):
        busy += max(0, b - max(a, reach))
        reach = max(reach, b)
    return jobs, shuffle, phases, busy / 1000


def main() -> None:
    from segmint.operators.output import write_result
    from segmint.operators.rates import daily_rates
    from segmint.plans.pipeline import segment_customers
    from segmint.session import phase
    from segmint.sources.fixture import BASE_DAY, FIRST_TX_DATE, RATE_CUTOVER, fixture_tables

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="segmint-bench-")
    os.makedirs(f"{scratch}/events")
    spark = session(cpus, scratch)

    def run(period: int, out: str) -> int:
        fx = fixture_tables(spark, sf_dir)
        rates = daily_rates(fx.rates_legacy, fx.rates_current, RATE_CUTOVER)
        res = segment_customers(spark, fx.sources, fx.users, rates, BASE_DAY, period, FIRST_TX_DATE)
        with phase(spark, "result"):
            write_result(res.segments, out, res.window)
        return res

    began = time.perf_counter()
    # warm every query once, then time them round-robin so JIT warm-up favours none
    for i, (name, period) in enumerate(HEADLINE.items()):
        run(period, f"{scratch}/warm{i}").release()
    samples: dict[str, list[float]] = {name: [] for name in HEADLINE}
    customers: dict[str, int] = {}
    for r in range(RUNS):
        for i, (name, period) in enumerate(HEADLINE.items()):
            t = time.perf_counter()
            res = run(period, f"{scratch}/out{i}_{r}")
            samples[name].append(time.perf_counter() - t)
            if r == RUNS - 1:
                customers[name] = res.base.count()
            res.release()
    wall = time.perf_counter() - began
    times = {name: round(statistics.median(v), 3) for name, v in samples.items()}
    spark.stop()
    jobs, shuffle, phases, busy = event_totals(scratch)
    runs = len(HEADLINE) * (RUNS + 1)
    print(
        json.dumps(
            {
                "metric": "segmentation_full_wall",
                "value": times["segmentation_full"],
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "customers": customers,
                "jobs_per_run": round(jobs / runs, 1),
                "shuffle_bytes_per_run": int(shuffle / runs),
                "wall_per_run": round(wall / runs, 3),
                "wall_outside_jobs_per_run": round((wall - busy) / runs, 3),
                "job_seconds_per_run_by_phase": {k: round(v / runs, 3) for k, v in sorted(phases.items())},
            }
        )
    )


if __name__ == "__main__":
    main()
