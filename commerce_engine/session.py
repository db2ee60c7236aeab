"""Session settings and shared-folder materialisation."""

from __future__ import annotations

import atexit
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans rely on. A value given at launch always wins.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the next operator could have reused the
    # join's partitioning: one extra exchange beats one task with a third of
    # the rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # What a reading task takes is bounded by its bytes, not by the input over a fixed
    # number of tasks: many small partitions, put together up to this size.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "512",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # HotSpot never compiles a method above 8,000 bytes: a wide projection that Spark fuses
    # into one would be interpreted for every row. Above this Spark runs its operators
    # one by one, with their expressions split into small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Only at launch. Without it PySpark looks up the caller's source line for every column
# expression, some milliseconds each: more than many of these plans take to run.
AT_LAUNCH = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    launched = spark.sparkContext.getConf()
    for key, value in DEFAULTS.items():
        if not launched.contains(key):
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "commerce_engine", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**AT_LAUNCH, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else one inside the warehouse, which a cluster shares as well."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints").rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the application ends or by :func:`remove_written`."""
    paths = _own_paths()
    paths.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return paths[-1]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Used where several later passes read the same expensive intermediate. A written
    table cuts the lineage: the loss of an executor costs no more than the running
    stage. It keeps column pruning and gives the optimizer a true size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_local = threading.local()
_threads: list[list[str]] = []


def _own_paths() -> list[str]:
    """The scratch paths of this thread: queries in other driver threads have theirs."""
    if not hasattr(_local, "paths"):
        if not _threads:
            atexit.register(_remove_all)
        _local.paths = []
        _threads.append(_local.paths)
    return _local.paths


def _remove_all() -> None:
    for paths in _threads:
        _remove(paths, 0, 0)


def written_so_far() -> int:
    return len(_own_paths())


def remove_written(first: int = 0, keep: int = 0) -> None:
    """Remove what lies under this thread's scratch paths from the ``first`` on, but for the last ``keep``.

    Frames that read them can no longer run. When the application ends, all paths go.
    """
    _remove(_own_paths(), first, keep)


def _remove(written: list[str], first: int, keep: int) -> None:
    spark = SparkSession.getActiveSession()
    if spark is None or spark.sparkContext._jsc is None:
        return
    hadoop = spark._jsc.hadoopConfiguration()
    paths = written[first : len(written) - keep]
    del written[first : len(written) - keep]
    for path in map(spark._jvm.org.apache.hadoop.fs.Path, paths):
        path.getFileSystem(hadoop).delete(path, True)
