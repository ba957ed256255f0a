"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

STATE_STORE_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "pulseline") -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.unix.domain.socket.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE_PROVIDER)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must name storage that every executor can
    reach.  Only a local session without it (tests) gets a fresh folder.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: start the session with a folder "
                               "that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="pulseline-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/pulseline/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all tables this application has staged.  Call it when results
    are written: plans read their staged tables until then."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def input_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or folder in any storage that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, for clusters where it is not
    installed."""
    folder = tempfile.mkdtemp(prefix="pulseline-zip-")
    here = os.path.dirname(os.path.abspath(__file__))
    spark.sparkContext.addPyFile(shutil.make_archive(
        f"{folder}/pulseline", "zip", os.path.dirname(here), os.path.basename(here)))


def runner_session(app_name: str) -> SparkSession:
    """The session of a program: cluster settings come from spark-submit, what
    results depend on is set here, and the workers get the package."""
    spark = (SparkSession.builder.appName(app_name)
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.python.unix.domain.socket.enabled", "true")
             .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE_PROVIDER)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def materialize(df, name: str = "stage"):
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    read it back: later passes over it neither rescan nor recompute the
    input, lineage is cut, and a lost executor costs no recomputation.

    (An RDD ``checkpoint()`` of an uncached Dataset computes it twice, once
    for the job and once for the checkpoint write; a written table is one
    pass, compressed and columnar.)
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint root."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Runtime settings for as long as a block runs.  A query that starts in it
    keeps them."""
    was = {name: spark.conf.get(name, None) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in was.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


#: Shuffle files go when their job or batch ends.  Else they stay until the
#: driver happens to collect its garbage.
SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


MB = 1024 * 1024


def cluster_settings(input_bytes: int, cores: int, partition_bytes: int = 512 * MB,
                     max_shuffle_partitions: int = 50_000) -> dict[str, str]:
    """Runtime SQL settings sized to the input (for spill-aware shuffles).

    Shuffle partitions start at about one per ``partition_bytes`` of input
    (at least two per core, at most ``max_shuffle_partitions``); AQE then
    coalesces small ones and splits skewed ones at run time.  Scans split
    files at the same size.  The state store is RocksDB with changelog
    checkpoints, so large per-key state lives off-heap and commits cheaply.
    """
    parts = max(2 * cores, min(max_shuffle_partitions, -(-int(input_bytes) // partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(min(partition_bytes, 256 * MB)),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": STATE_STORE_PROVIDER,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }


def apply_cluster_settings(spark: SparkSession, input_bytes: int, cores: int | None = None,
                           **kw) -> dict[str, str]:
    """Set ``cluster_settings`` on a running session (all runtime settings)."""
    cores = cores or spark.sparkContext.defaultParallelism
    conf = cluster_settings(input_bytes, cores, **kw)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf
