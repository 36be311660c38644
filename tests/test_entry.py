"""The driver contract: entry() runs, every query has an oracle, and a few match at sf0.001."""

import os

import duckdb
import pytest

from compare import canonical, differences

SF = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    from __spark_entry__ import oracle_sql, queries
    from segmint.plans.queries import QUERIES

    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
def test_entry_returns_two_rows_per_customer(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert len(df.columns) == 52
    n = df.count()
    assert n > 0 and n == 2 * df.select("CustomerKey").distinct().count()


@pytest.fixture(scope="module")
def shared_run(spark):
    from segmint.plans.queries import fixture_run

    return fixture_run(spark, SF)


def _keys():
    from segmint.plans.queries import QUERIES

    return sorted(QUERIES)


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
@pytest.mark.parametrize("key", _keys())
def test_query_matches_oracle_at_smallest_scale(spark, key, shared_run):
    """Views of one run share it here (one of them also runs as registered)."""
    from __spark_entry__ import oracle_sql, queries
    from segmint.plans.queries import VIEWS

    con = duckdb.connect()
    for t in ("orders", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = VIEWS[key](shared_run) if key in VIEWS and key != "scored_wide" else queries()[key](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(oracle_sql()[key])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert canonical(df.columns, srows) == canonical(rel.columns, orows), differences(df.columns, srows, rel.columns, orows)


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
def test_entry_without_a_configured_checkpoint_dir(tmp_path):
    """A local session with no spark.checkpoint.dir stages under a fresh temporary folder."""
    import subprocess
    import sys

    conf = tmp_path / "conf"
    conf.mkdir()
    (conf / "spark-defaults.conf").write_text("spark.ui.enabled false\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.sql.shuffle.partitions', '4').getOrCreate()\n"
        "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
        "from __spark_entry__ import entry\n"
        "df = entry(spark)\n"
        "print('ROWS', df.count(), len(df.columns), spark.sparkContext.getCheckpointDir())\n"
    ) % root
    env = dict(os.environ, SPARK_CONF_DIR=str(conf))
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=600, cwd=tmp_path)
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("ROWS")]
    assert line, out.stderr[-3000:]
    _, rows, cols, ckpt = line[0].split(" ", 3)
    assert int(rows) > 0 and int(cols) == 52 and "segmint-ckpt-" in ckpt
