"""What a lake knows about itself: its live version and the runs under way.

A full rebuild writes a whole new version beside the old one and then publishes
it by creating one empty file; readers take the version with the highest number.  A rebuild
that fails leaves what readers see as it was.

A run announces itself before its first write.  Rejects of a run that has begun but
has not logged its files yet are not shown; they are deleted when the run must have died.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from forecourt import fixed_values as fixed
from forecourt.session import drop_path, path_exists

VERSIONS_DIR = "_versions"
STARTED_DIR = "_runs"
STARTED_SCHEMA = "run_id string, started_at string"
DIED_AFTER = timedelta(hours=24)   # a run this old without a log is taken for dead


def _folder(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in ``path``, none if it is not there."""
    where, fs = _folder(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def make_folder(spark: SparkSession, path: str) -> None:
    where, fs = _folder(spark, path)
    fs.mkdirs(where)


def rename(spark: SparkSession, source: str, target: str) -> None:
    where, fs = _folder(spark, source)
    if not fs.rename(where, _folder(spark, target)[0]):
        raise OSError(f"could not rename {source} to {target}")


def _version(spark: SparkSession, root: str) -> int:
    return max((int(n) for n in names_in(spark, f"{root}/{VERSIONS_DIR}") if n.isdigit()), default=0)


def version_root(root: str, version: int) -> str:
    return f"{root}/_v{version:06d}" if version else root


def live_root(spark: SparkSession, root: str) -> str:
    """Folder of the version readers see; ``root`` itself before the first rebuild."""
    return version_root(root, _version(spark, root))


def next_version(spark: SparkSession, root: str) -> int:
    """Number of a new version; what a failed rebuild left in its folder is deleted."""
    version = _version(spark, root) + 1
    drop_path(spark, version_root(root, version))
    return version


def publish(spark: SparkSession, root: str, version: int) -> None:
    """Make ``version`` the live one.  The one before stays for readers that have
    begun on it; older ones are deleted."""
    where, fs = _folder(spark, f"{root}/{VERSIONS_DIR}/{version:06d}")
    fs.create(where, False).close()
    for old in range(1, version - 1):
        drop_path(spark, version_root(root, old))
    if version > 1:
        for name in ("listings", fixed.QUARANTINE_DIR, fixed.META_DIR, STARTED_DIR):
            drop_path(spark, f"{root}/{name}")


def utc_text(moment: datetime) -> str:
    return moment.strftime("%Y-%m-%dT%H:%M:%SZ")


def announce_run(spark: SparkSession, live: str, run_id: str, now: datetime | None = None) -> None:
    """Note that ``run_id`` is about to write below ``live``."""
    entry = spark.createDataFrame([(run_id, utc_text(now or datetime.now(timezone.utc)))], STARTED_SCHEMA)
    entry.coalesce(1).write.mode("overwrite").parquet(f"{live}/{STARTED_DIR}/{run_id}")


def unfinished_runs(spark: SparkSession, live: str, log: DataFrame) -> DataFrame:
    """``run_id, started_at`` of runs that have begun and logged nothing yet."""
    path = f"{live}/{STARTED_DIR}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], STARTED_SCHEMA)
    begun = spark.read.schema(STARTED_SCHEMA).option("recursiveFileLookup", "true").parquet(path)
    return begun.join(log.select("run_id"), "run_id", "left_anti")


def dead_runs(spark: SparkSession, live: str, log: DataFrame, now: datetime | None = None) -> list[str]:
    """Unfinished runs that began too long ago to be alive."""
    limit = utc_text((now or datetime.now(timezone.utc)) - DIED_AFTER)
    return [r.run_id for r in unfinished_runs(spark, live, log).where(f"started_at < '{limit}'").collect()]   # few
