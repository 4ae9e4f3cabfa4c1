"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every lakeworks job assumes. Sizes are per shuffle partition, so they
# hold at any data volume; AQE picks the partition count from them at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}

# Added on a cluster: scans use fewer, larger tasks. The number of shuffle partitions is
# left to ``size_shuffles``; a fixed initial number would win over it.
CLUSTER = {
    "spark.sql.files.maxPartitionBytes": "512m",
}


def get_session(app: str = "lakeworks", master: str | None = None, **conf) -> SparkSession:
    """Build (or fetch) a session with ``DEFAULTS``; keyword arguments override them.

    Keywords use ``__`` for the dot, e.g. ``spark__sql__shuffle__partitions=8``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    local = (master or "").startswith("local")
    settings = DEFAULTS | ({} if local else CLUSTER) | {k.replace("__", "."): str(v) for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, input_bytes: int, per_partition: int = 256 << 20) -> int:
    """Set the shuffle partition count for a job that shuffles about ``input_bytes``.

    AQE merges partitions that turn out small but does not split ordinary ones, so
    the count has to be large enough for the data before it runs.
    """
    wanted = max(spark.sparkContext.defaultParallelism, -(-input_bytes // per_partition))
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return wanted


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is made only for a local master, where every task can
    see it. On a cluster the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder all executors share")
    made = tempfile.mkdtemp(prefix="lakeworks-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the scratch root that no other run uses."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    The copy outlives lost executors, and later stages restart from it.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on whatever file system the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
