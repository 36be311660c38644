"""Session helpers: a local builder for tests/bench and a staging area for intermediates.

Intermediates that are reused by several later jobs are written as Parquet under the
cluster's shared checkpoint folder (``spark.checkpoint.dir``) and read back, which cuts
the lineage: a lost executor never forces a rescan of the fact tables.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import contextmanager
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "segmint", conf: dict[str, str] | None = None
) -> SparkSession:
    """A local session configured like the tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def staging_root(spark: SparkSession) -> str:
    """The shared folder for staged intermediates.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint dir).
    Only a local-mode session without one gets a fresh temporary folder; on a cluster a
    missing setting is an error, because a machine-local folder is not shared.
    """
    sc = _context(spark)
    root = (sc.getCheckpointDir() if sc is not None else None) or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    root = tempfile.mkdtemp(prefix="segmint-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(root)
    return root


@contextmanager
def phase(spark: SparkSession, name: str):
    """Label the jobs of one pipeline phase (shown in Spark's job list and event log)."""
    sc = _context(spark)
    if sc is None:
        yield
        return
    previous = sc.getLocalProperty("spark.job.description")
    sc.setJobDescription(f"segmint: {name}")
    try:
        yield
    finally:
        sc.setJobDescription(previous)


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a remote (Connect) session."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no local context
        return None


class Stager:
    """Writes reused intermediates once, as Parquet, and hands back a reader over them.

    ``root`` is a folder shared by the cluster (default: the session's checkpoint folder).
    What is not released by the end of the driver process is removed then.

    With a ``run`` name the folder is ``segmint-run-<name>`` and outlives the process: a stage that an
    earlier driver finished is read, not computed again. ``manifest`` describes what the run
    computes (any text); it is written first, and a folder of another manifest is refused.
    Only ``release`` removes a named run.
    """

    def __init__(
        self, spark: SparkSession, enabled: bool = True, root: str | None = None, run: str | None = None, manifest: str = ""
    ):
        self.spark = spark
        self.enabled = enabled
        self.run = run if enabled else None
        name = f"segmint-run-{quote(run, safe='')}" if run else f"segmint-{uuid.uuid4().hex}"
        self.run_dir = f"{(root or staging_root(spark)).rstrip('/')}/{name}" if enabled else None
        self.resumed: list[str] = []  # stages found finished
        if self.run:
            self._claim(manifest)
        elif enabled:
            atexit.register(self.release)

    def _claim(self, manifest: str) -> None:
        path = f"{self.run_dir}/_manifest"
        if self._finished(path):
            found = self.spark.read.schema("manifest string").parquet(path).first()[0]
            if found != manifest:
                raise ValueError(f"run {self.run!r} exists and computes something else: {found}")
        else:
            self.spark.createDataFrame([(manifest,)], "manifest string").coalesce(1).write.mode("overwrite").parquet(path)

    def _finished(self, path: str) -> bool:
        """Whether a write to ``path`` was committed: the last thing a committer does is its marker."""
        fs, make = file_system(self.spark, path)
        return fs.exists(make(f"{path}/_SUCCESS"))

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        if not self.enabled:
            return df
        path = f"{self.run_dir}/{name}"
        if self.run and self._finished(path):
            self.resumed.append(name)
        else:
            df.write.mode("overwrite").parquet(path)
        # the schema is known: reading it back needs no inference pass over the footers
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Delete this run's staged files (through Hadoop's FileSystem, so any shared store
        works). DataFrames read from them must not be used afterwards; calling it again,
        or after the session has ended, does nothing."""
        atexit.unregister(self.release)
        sc = _context(self.spark)
        run_dir, self.run_dir = self.run_dir, None
        if run_dir is None or sc is None or sc._jsc is None:
            return
        fs, make = file_system(self.spark, run_dir)
        fs.delete(make(run_dir), True)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of ``path`` (any shared store) and its Path class."""
    sc = spark.sparkContext
    make = sc._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(sc._jsc.hadoopConfiguration()), make
