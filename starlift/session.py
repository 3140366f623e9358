"""Session helpers: a local session for tests/bench and the shared
checkpoint folder taken from the cluster configuration."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cpus: int | str = "*", app: str = "starlift", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark. On a cluster the caller's session is used instead."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared (distributed) folder and is
    used as is. Only when it is unset in a local run do we create a scratch
    folder of our own; on a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="starlift-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


_READS: dict[tuple[int, str], DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; Catalyst prunes columns and pushes filters into the scan.

    The DataFrame (a plan plus its file index, no data) is reused per session
    and path, so footers are not re-read for every query that touches the table.
    """
    path = os.path.join(sf_dir, f"{name}.parquet")
    key = (id(spark._jsparkSession), path)
    if key not in _READS:
        _READS[key] = spark.read.parquet(path)
    return _READS[key]


class Tables:
    """Lazy accessor: ``t.orders`` reads ``<sf_dir>/orders.parquet``.

    ``memo(key, build)`` builds an intermediate once per query plan and
    persists it (memory, spilling to disk), so a frame used by several
    branches of one plan - e.g. the quality-checked events feeding three
    dimensions and a fact - is computed once. Lost cache blocks are
    recomputed from lineage.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._memo: dict[str, DataFrame] = {}

    def memo(self, key: str, build) -> DataFrame:
        if key not in self._memo:
            from pyspark import StorageLevel
            self._memo[key] = build().persist(StorageLevel.MEMORY_AND_DISK)
        return self._memo[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return read_table(self.spark, self.sf_dir, name)


def spread(df: DataFrame, factor: int = 2) -> DataFrame:
    """Spread CPU-heavy per-row work (tokenising whole texts) over all task slots.

    Only when the scan yields fewer splits than the cluster has slots (small
    files, few row groups) is the frame round-robin repartitioned; a large
    table already has enough splits and is left as it is (no extra shuffle).
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:
        return df.repartition(slots * factor)
    return df
