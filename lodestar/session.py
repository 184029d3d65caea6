"""Session settings and the shared folders used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


# folder of each local session that names none
_LOCAL_DIRS: dict[str, str] = {}


def get_session(app: str = "lodestar", **settings: str) -> SparkSession:
    """Session with adaptive execution on; a cluster's own settings stay in force."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a path, in whatever store it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(folder).getLength()


def setting_bytes(text: str) -> int:
    """Bytes of a size setting such as 134217728b, 16m or 1g."""
    digits = text.rstrip("bkmgtBKMGT")
    unit = text[len(digits):].lower().removesuffix("b")
    return int(digits) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def size_shuffles(spark: SparkSession, path: str, partition_bytes: int = 512 << 20,
                  most: int = 20_000) -> int:
    """Initial number of shuffle partitions for jobs over the folder ``path``.

    Raised with the size of the data so that a partition fits an executor's memory, and
    never lowered below the session's own number; adaptive execution puts small
    partitions together again. ``most`` bounds the number of shuffle blocks.
    """
    total = path_bytes(spark, path)
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(own, min(total // partition_bytes, most))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", wanted)
    return wanted


def shuffle_width(spark: SparkSession) -> int:
    """Number of partitions that a shuffle starts with."""
    own = spark.conf.get("spark.sql.shuffle.partitions")
    return int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", own))


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach: the one named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a machine-local folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="lodestar-")
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; paths are never reused."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def spread(df: DataFrame, key: str, table_bytes: int) -> DataFrame:
    """Rows of a scan of less than one split per core, hashed to all cores.

    One row group is one task, so a small table would leave most cores idle in CPU-heavy
    work. A table with a split for every core is returned as it is: its rows are not moved.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = setting_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return df.repartition(cores, key) if table_bytes < cores * split else df


def write_scratch(df: DataFrame, name: str) -> str:
    """Writes ``df`` to a new folder of the shared directory; returns the path."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage of iterative jobs: a lost executor costs a re-read of the files
    and not a replay of all rounds. Being files, the result also has a true size,
    which lets the planner choose join methods on facts.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write_scratch(df, name))
