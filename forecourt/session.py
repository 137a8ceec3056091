"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the jobs rely on.  AQE splits skewed join and rebalance
# partitions, coalesces small ones and drops branches found empty at run time.
# Listings are wide: above the method limit
# the JVM would not compile a fused stage's code at all, so such stages run as
# separately compiled projections.  A listing is a few bytes in a file and a few hundred in
# a task's aggregation: a task takes no more of a file than its maps can hold, however large the table.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.files.maxPartitionBytes": "16m",
}


def build_session(app_name: str = "forecourt", master: str | None = None,
                  **extra: str) -> SparkSession:
    """A session with :data:`SETTINGS`; ``master`` only for local use."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Give a foreign session those of :data:`SETTINGS` it leaves at Spark's
    defaults; what it sets itself stays."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for staged tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session
    without that setting gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="forecourt-"))
    return context.getCheckpointDir().rstrip("/")


STAGED = "zstd"   # compression of tables that are written to be read again and deleted

_FRESH: dict[str, list[str]] = {}   # by application


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder; :func:`release` deletes it."""
    path = f"{shared_folder(spark)}/forecourt/{label}-{uuid.uuid4().hex}"
    _FRESH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> None:
    """Delete this application's paths of :func:`fresh_path` that are still there.  To be called when
    no table that was built on them is needed any more: results are lazy."""
    for path in _FRESH.pop(spark.sparkContext.applicationId, []):
        drop_path(spark, path)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    Cuts the lineage without depending on executor-local blocks: a lost
    executor re-reads the table instead of recomputing the scan and parse.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path, compression=STAGED)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path this package wrote (a staged table, a replaced table)."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
