"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings the results or the physical plans rely on.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A task holds rows of one or two dates: write them without sorting whole
    # records by date first.  Tasks with more dates fall back to the sort.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    "spark.sql.parquet.compression.codec": "zstd",
}

#: Bytes one shuffle task should hold.
TASK_BYTES = 256 * 1024 * 1024


def sizing_conf(shuffle_bytes: int, task_bytes: int = TASK_BYTES) -> dict[str, str]:
    """Shuffle settings for a run that moves about ``shuffle_bytes`` per exchange.

    Adaptive execution merges partitions that turn out small but cannot split
    an ordinary exchange, so the first count comes from the volume.
    """
    partitions = max(200, -(-shuffle_bytes // task_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(task_bytes),
        "spark.sql.files.maxPartitionBytes": str(task_bytes),
    }


def build_session(
    app_name: str = "tallyhouse",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session with the settings above plus ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    In local mode a fresh temporary folder is used when the setting is absent.
    A cluster without the setting is an error: a folder local to the driver
    would be invisible to executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    checkpoint_dir = context.getCheckpointDir()
    if checkpoint_dir:
        return checkpoint_dir.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    created = tempfile.mkdtemp(prefix="tallyhouse-")
    context.setCheckpointDir(created)
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/tallyhouse/{purpose}-{uuid.uuid4().hex}"


def write_through(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """Write ``df`` to shared scratch once and return it as a plain file scan.

    Cuts lineage in a way that survives the loss of executors; callers drop the
    path with :func:`drop_path` when they are done.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path made by this package."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    hadoop_path.getFileSystem(conf).delete(hadoop_path, True)
