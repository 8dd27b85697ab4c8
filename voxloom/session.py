"""Session settings, table access and the few places where partitioning is chosen."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Partitions per core for stages that spend their time in Python.
PYTHON_WAVES = 3


#: What the optimiser takes a relation of unknown size to have, or more.
_UNKNOWN = 1 << 60


def get_session(app: str = "voxloom", **conf: str) -> SparkSession:
    """A session for local use; on a cluster the one that exists is kept as it is."""
    builder = SparkSession.builder.appName(app)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster; a temporary one only where none is set."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="voxloom-checkpoint-")
    context.setCheckpointDir(shared)
    return shared


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; a file or a folder of files."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def utc(column):
    """A TIMESTAMP_NTZ column as a timestamp (the session runs in UTC)."""
    return F.col(column).cast("timestamp") if isinstance(column, str) else column.cast("timestamp")


def input_bytes(df: DataFrame) -> int:
    """Bytes of the relations that a plan reads, from its statistics; nothing is run.

    Rows that come from an RDD have no known size and count for one split a partition.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    total = 0
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        known = int(str(leaf.stats().sizeInBytes()))
        total += known if known < _UNKNOWN else leaf.rdd().getNumPartitions() * split_bytes(df.sparkSession) if leaf.nodeName() == "LogicalRDD" else 0
    return total


def split_bytes(spark: SparkSession) -> int:
    """Bytes that one split of an input may have."""
    return int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())


def spread(df: DataFrame, *keys: str, waves: int = PYTHON_WAVES) -> DataFrame:
    """Give a Python-heavy stage enough partitions.

    A small input arrives in one or two splits and would keep one core busy.
    An input whose size alone gives ``waves`` splits per core is left as it is,
    so nothing is shuffled at scale.  ``keys`` must make the rows spread evenly
    (a unique id); hashing them keeps a recomputed task identical.
    """
    parts = df.sparkSession.sparkContext.defaultParallelism * waves
    if input_bytes(df) >= parts * split_bytes(df.sparkSession):
        return df
    return df.repartition(parts, *keys)


#: Folders of staged results of this driver that are still there.
_STAGED: list[str] = []


def _remove(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result once to the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()``, but computes the rows once and keeps
    them columnar, so later passes read only the columns they need.  The files
    go when a ``staging`` block or the JVM ends.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, removed like a staged result."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/voxloom-{name}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    _STAGED.append(path)
    return path


def mounted(path: str) -> str:
    """A shared folder as the path under which every machine has it mounted, for files that Python writes."""
    return re.sub(r"^file:/+", "/", path)


@contextmanager
def staging(spark: SparkSession):
    """Remove what is staged inside the block at its end, when the block's results are written."""
    before = len(_STAGED)
    try:
        yield
    finally:
        while len(_STAGED) > before:
            _remove(spark, _STAGED.pop())
