"""Session settings and the shared folder for checkpoints and staged tables."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution does the coalescing, the skew-join splits and the run-time
# choice of join; the advisory size keeps a task's input well inside its memory.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}

_local_dirs: dict[str, str] = {}


def build_session(app_name: str = "orderloom", master: str | None = None,
                  shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """A session with the settings above. On a cluster leave ``master`` unset."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session, of one process, may do without the setting; it gets a folder of its own. The setting is
    taken at its word: a ``file:`` path on a cluster must be a share that is mounted everywhere.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="orderloom-")
    return _local_dirs[context.applicationId]


def run_dir(spark: SparkSession) -> str:
    """The part of the shared folder that this application stages its tables in."""
    return f"{shared_dir(spark)}/run-{spark.sparkContext.applicationId}"


def drop_run_dir(spark: SparkSession) -> None:
    """Remove what this application has staged; call it once results are written elsewhere."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# Spark's setting for removing the shuffle files of a query once it has ended.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs begun within leave no shuffle files behind. Else these stay until the driver happens to collect its garbage,
    and a load of many jobs holds the files of all of them. Only for frames that are run once, such as writes."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def write_staged(df: DataFrame, folder: str) -> DataFrame:
    """Write rows once and read them back, well packed: hash keys take half the room that they take otherwise."""
    spark = df.sparkSession
    with freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
