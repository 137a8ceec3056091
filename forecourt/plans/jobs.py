"""The two layer jobs: raw -> silver (incremental or full) and silver -> gold."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt.operators.keys import drop_known_keys, first_per_key, pick_rows, with_keys
from forecourt.operators.routing import split_rejected
from forecourt.operators.shape import SILVER
from forecourt.plans import gold
from forecourt.plans.silver import silver_rows
from forecourt.session import STAGED, drop_path, fresh_path, path_exists, stage
from forecourt.sources.keyindex import KeyIndex
from forecourt.sources.listing import file_listing, literal, scanned_path, suspect_files, unreadable_files
from forecourt.sources.readers import CORRUPT, RAW_GLOB, RAW_TEXT, file_log, file_position, line_scan, listing_scan
from forecourt.sources.state import announce_run, dead_runs, live_root, next_version, publish, utc_text, version_root
from forecourt.sources.writers import replace_parquet, run_folder, write_parquet, write_quarantine, write_silver

RUN_LOG_SCHEMA = ("run_id string, completed_at string, table string, rows bigint, columns int, "
                  "skipped boolean")


@dataclass
class RunResult:
    """Outcome of a job; ``details`` is a table (per file or per gold table)."""
    success: bool
    run_id: str
    error: str | None = None
    counts: dict[str, int] = field(default_factory=dict)
    details: DataFrame | None = None


def run_identity() -> tuple[str, str]:
    """A new run id and the current UTC time as ISO text."""
    return str(uuid.uuid4()), utc_text(datetime.now(timezone.utc))


@dataclass(frozen=True)
class SilverLake:
    """Folders of a silver table.  Reading takes the live version (see ``sources.state``)."""
    root: str

    @property
    def listings(self) -> str:
        return f"{self.root}/listings"

    @property
    def file_log(self) -> str:
        return f"{self.root}/{fixed.META_DIR}/file_log"

    def key_index(self, spark: SparkSession) -> KeyIndex:
        return KeyIndex(spark, self.listings, f"{self.root}/{fixed.META_DIR}/key_index")

    def live(self, spark: SparkSession) -> SilverLake:
        return SilverLake(live_root(spark, self.root))

    def read(self, spark: SparkSession, skip_unreadable: bool = False) -> DataFrame:
        """Stored listings; empty before the first run.  ``skip_unreadable`` leaves out
        stored files that cannot be read (see :meth:`unreadable`) instead of failing."""
        path = self.live(spark).listings
        if not path_exists(spark, path):
            return spark.createDataFrame([], SILVER)
        return (spark.read.schema(SILVER).option("ignoreCorruptFiles", str(skip_unreadable).lower())
                .parquet(path))

    def unreadable(self, spark: SparkSession) -> DataFrame:
        """``path`` of stored files that give no rows and do not begin and end as such files do."""
        path = self.live(spark).listings
        listed = file_listing(spark, path, "*.parquet")
        silent = listed.join(self.read(spark, True).select(scanned_path().alias("path")).distinct(), "path", "left_anti")
        chosen = [literal(r.path) for r in silent.collect()]   # broken and empty files only
        if not chosen:
            return silent.select("path")
        mark = F.lit(b"PAR1")
        content = spark.read.format("binaryFile").load(chosen)
        return content.where((F.substring("content", 1, 4) != mark) | (F.substring("content", -4, 4) != mark)).select("path")

    def read_log(self, spark: SparkSession) -> DataFrame:
        return file_log(spark, self.live(spark).root)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def path_below(spark: SparkSession, root: str) -> Callable[[Column], Column]:
    """A file's path below ``root``: files of the same name in different folders stay
    different.  A file outside ``root`` keeps its whole path."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    whole = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(folder)
    start = whole.toUri().getPath().rstrip("/") + "/"

    def below(path: Column) -> Column:
        plain = F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
        return F.when(plain.startswith(start), F.substring(plain, len(start) + 1, 1 << 20)).otherwise(plain)

    return below


def pending_listing(spark: SparkSession, raw_path: str, log: DataFrame, glob: str = RAW_GLOB,
                    source_file: Callable[[Column], Column] | None = None) -> DataFrame:
    """``path, length, source_file`` of the raw files whose ``source_file`` the log does not name."""
    source_file = source_file or path_below(spark, raw_path)
    listed = file_listing(spark, raw_path, glob).select("path", "length", source_file(F.col("path")).alias("source_file"))
    return listed.join(log.select("source_file"), "source_file", "left_anti").select("path", "length", "source_file")


def pending_files(spark: SparkSession, raw_path: str, log: DataFrame, glob: str = RAW_GLOB,
                  source_file: Callable[[Column], Column] | None = None) -> list[str]:
    """Paths, ready for a scan, of the files of :func:`pending_listing`.  Only these
    reach the driver, which lists them for the scan anyway."""
    pending = pending_listing(spark, raw_path, log, glob, source_file)
    return [literal(r.path) for r in pending.select("path").orderBy("path").collect()]


def new_silver(staged: DataFrame, stored: DataFrame) -> DataFrame:
    """Valid staged rows, one per key (first in file order), whose key is not among ``stored``.

    Decided on keys and positions alone; the wide rows are then fetched by their
    row number (:func:`pick_rows`).  The decision is written first: one of few rows, or
    of nearly all, moves no wide row, any other joins on the row number, which no hot key skews.
    """
    key, row = fixed.BUSINESS_KEY, "_row_in_task"
    order = ["_source_file", "_block_start", row]
    valid = staged.where(F.col(fixed.REJECTION_COLUMN) == "")
    # repeats go first: the rank cuts a key with many copies before any shuffle
    firsts = first_per_key(valid.select(key, *order), [key], order)
    chosen = stage(drop_known_keys(firsts, stored, key, valid).select(row), "chosen-rows")
    return pick_rows(valid, chosen, row).select(*fixed.SILVER_COLUMNS)


def stage_raw(raw: DataFrame, path: str, run_id: str, run_ts: str,
              source_file: Callable[[Column], Column] = base_name, source_system: str = fixed.SOURCE_SYSTEM) -> DataFrame:
    """Parse and shape raw files once into a staged table.  All later steps read
    its columns: neither lost executors nor several sinks repeat the parse."""
    block, row = file_position()
    shaped = silver_rows(raw, run_id, run_ts, source_file=source_file(scanned_path()),
                         source_system=source_system,
                         keep={"_block_start": block, "_row_in_task": row, RAW_TEXT: F.col(CORRUPT)})
    shaped.write.mode("overwrite").parquet(path, compression=STAGED)
    return raw.sparkSession.read.schema(shaped.schema).parquet(path)


def file_statistics(staged: DataFrame, written: DataFrame, run_id: str, run_ts: str,
                    listed: DataFrame | None = None, broken: DataFrame | None = None) -> DataFrame:
    """Raw, stored, rejected and deduplicated rows per source file.

    With the run's ``listed`` files, those without a line have a row too; those whose
    path is in ``broken`` are marked as failed.
    """
    rejected = F.col(fixed.REJECTION_COLUMN) != ""
    seen = staged.groupBy(F.col("_source_file").alias("source_file")).agg(
        F.count("*").alias("raw"), F.count_if(rejected).alias("quarantined"))
    kept = written.groupBy(F.col("_source_file").alias("source_file")).agg(F.count("*").alias("silver"))
    if listed is not None:
        marked = listed.withColumn("_bad", F.lit(False))
        if broken is not None:
            marked = listed.join(broken.select("path", F.lit(True).alias("_bad")), "path", "left")
        files = marked.groupBy("source_file").agg(F.coalesce(F.bool_or("_bad"), F.lit(False)).alias("failed"))
        seen = files.join(seen, "source_file", "left")
    else:
        seen = seen.withColumn("failed", F.lit(False))
    raw, bad, silver = (F.coalesce(c, F.lit(0)).cast("bigint") for c in ("raw", "quarantined", "silver"))
    return seen.join(kept, "source_file", "left").select(
        "source_file", F.lit(run_id).alias("run_id"), F.lit(run_ts).alias("completed_at"), raw.alias("raw"),
        silver.alias("silver"), bad.alias("quarantined"), (raw - bad - silver).alias("cross_dedup"), "failed",
        F.when(F.col("failed"), F.lit("unreadable")).alias("error"))


def drop_dead_rejects(spark: SparkSession, live: str, log: DataFrame) -> None:
    """Delete the rejects of runs that died before their log: their files are read again.
    Those of a run that may still be at work stay; readers do not show them."""
    path = f"{live}/{fixed.QUARANTINE_DIR}"
    for run_id in dead_runs(spark, live, log):
        drop_path(spark, run_folder(path, run_id))


def broken_from_the_start(spark: SparkSession, pending: DataFrame, glob: str) -> DataFrame | None:
    """``path`` of those of the ``pending`` files that cannot be read and do not even begin as they should
    (None if there are none): the others need not be read in vain to find them.  What
    tasks cannot unpack is read by Spark, which decides."""
    try:
        suspects = suspect_files(pending)
        suspects = suspects and stage(suspects, "suspect-files")
        if suspects is None or suspects.isEmpty():
            return None
    except Exception:   # tasks cannot look at files of this store
        return None
    try:
        line_scan(spark, [literal(r.path) for r in suspects.select("path").collect()], glob).count()
    except Exception:
        broken = stage(unreadable_files(spark, suspects), "unreadable-files")
        return None if broken.isEmpty() else broken
    return None


def stage_readable(spark: SparkSession, pending: DataFrame, glob: str, path: str, *shape) -> tuple[DataFrame, DataFrame | None]:
    """The ``pending`` files staged by :func:`stage_raw`, and those that cannot be read
    (``path``, None if all can).  Files are only examined whole, one by one, when reading them all fails."""
    def scan(files: DataFrame) -> DataFrame:
        return listing_scan(spark, [literal(r.path) for r in files.select("path").orderBy("path").collect()], glob=glob)

    def without(broken: DataFrame) -> DataFrame:
        sound = pending.join(broken, "path", "left_anti")
        return scan(pending).where(F.lit(False)) if sound.isEmpty() else scan(sound)

    broken = broken_from_the_start(spark, pending, glob)
    try:
        return stage_raw(scan(pending) if broken is None else without(broken), path, *shape), broken
    except Exception:
        broken = stage(unreadable_files(spark, pending), "unreadable-files")
        if broken.isEmpty():
            raise   # something else is wrong
    return stage_raw(without(broken), path, *shape), broken


def run_silver(spark: SparkSession, raw_path: str, silver_root: str, full_refresh: bool = False,
               run_id: str | None = None, run_ts: str | None = None,
               source_file: Callable[[Column], Column] | None = None, source_system: str = fixed.SOURCE_SYSTEM, glob: str = RAW_GLOB,
               retry_failed: bool = False) -> RunResult:
    """Bring new raw files into the silver table.

    Incremental by default: files in the log are skipped and keys already stored
    dropped.  A file is known by its path below ``raw_path``, or by what
    ``source_file`` makes of its path.  A full refresh reads every file into a new version
    of table and log, which takes the old one's place at the end.  The
    file log is written last, so a run that dies before that is repeated and
    finds its keys stored: nothing doubles.

    A file that cannot be read fails alone: it is logged as failed and is not read
    again unless ``retry_failed``.  Counts: files that brought new rows are
    processed, those known before or without new rows skipped.  ``success`` means no file failed.
    """
    fresh_id, fresh_ts = run_identity()
    run_id, run_ts = run_id or fresh_id, run_ts or fresh_ts
    source_file = source_file or path_below(spark, raw_path)
    if not path_exists(spark, raw_path):
        return RunResult(False, run_id, error=f"no raw data at {raw_path}")
    version = next_version(spark, silver_root) if full_refresh else None
    lake = SilverLake(version_root(silver_root, version)) if full_refresh else SilverLake(silver_root).live(spark)
    log = file_log(spark, lake.root)
    known = log.where(~F.coalesce("failed", F.lit(False))) if retry_failed else log
    skipped = known.count()
    pending = stage(pending_listing(spark, raw_path, known, glob, source_file), "pending-files")
    if pending.isEmpty():
        return RunResult(True, run_id, counts={"files_processed": 0, "files_skipped": skipped})

    run_folder(lake.listings, run_id)   # refuses an unsafe run id
    announce_run(spark, lake.root, run_id)
    staging = fresh_path(spark, "staged-silver")
    staged, broken = stage_readable(spark, pending, glob, staging, run_id, run_ts, source_file, source_system)
    stored = lake.key_index(spark).known(staged.where(F.col(fixed.REJECTION_COLUMN) == ""), run_id)
    write_silver(new_silver(staged, stored), lake.listings, run_id)
    drop_dead_rejects(spark, lake.root, log)
    write_quarantine(split_rejected(staged)[1].select(
        *fixed.SILVER_COLUMNS, fixed.REJECTION_COLUMN, RAW_TEXT), lake.root, run_id)

    written = lake.read(spark).where(F.col("_pipeline_run_id") == run_id)
    stats = file_statistics(staged, written, run_id, run_ts, pending, broken)
    write_parquet(stats, f"{lake.file_log}/run={run_id}")
    drop_path(spark, staging)
    if full_refresh:
        publish(spark, silver_root, version)
    details = file_log(spark, lake.root).where(F.col("run_id") == run_id)
    new, bad = F.col("silver") > 0, F.coalesce("failed", F.lit(False))
    totals = details.agg(F.count_if(new & ~bad), F.sum("raw"), F.sum("silver"), F.sum("quarantined"),
                         F.sum("cross_dedup"), F.count_if(bad), F.count_if(~new & ~bad)).first()
    names = ("files_processed", "total_raw_records", "total_silver_records",
             "total_quarantined", "total_cross_dedup", "files_failed", "files_skipped")
    counts = dict(zip(names, (int(v or 0) for v in totals)))
    counts["files_skipped"] += skipped
    return RunResult(counts["files_failed"] == 0, run_id, counts=counts, details=details)


def gold_tables(silver: DataFrame, as_of: datetime | str | None = None,
                as_of_year: int = fixed.CURRENT_YEAR) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Name -> (mart, the rows it is built from), all lazy."""
    clean = gold.clean_listings(silver, as_of_year)
    return {
        "gold_listings_enriched": (gold.listings_enriched(clean, as_of, as_of_year), clean),
        "gold_market_summary": (gold.market_summary(clean), with_keys(clean, fixed.MARKET_KEYS)),
        "gold_price_segments": (gold.price_segments(clean, as_of_year), clean),
        "gold_dealer_performance": (gold.dealer_performance(clean, as_of_year),
                                    with_keys(clean, fixed.DEALER_KEYS)),
        "gold_depreciation_curve": (gold.depreciation_curve(clean, as_of_year),
                                    gold.within_curve(clean, as_of_year)),
    }


def save_tables(spark: SparkSession, root: str, tables: dict[str, tuple[DataFrame, DataFrame]],
                run_id: str, run_ts: str) -> DataFrame:
    """Write every non-empty table below ``root`` and append its row and column
    counts to the run log.  A table is empty when its input is, which one row of
    the input decides without computing the table."""
    entries = []
    for name, (table, origin) in tables.items():
        empty = origin.isEmpty()
        rows = 0 if empty else replace_parquet(table, f"{root}/{name}")
        entries.append((run_id, run_ts, name, rows, len(table.columns), empty))
    log_path = f"{root}/{fixed.META_DIR}/run_log"
    write_parquet(spark.createDataFrame(entries, RUN_LOG_SCHEMA).coalesce(1), log_path, "append")  # one row per table
    return spark.read.schema(RUN_LOG_SCHEMA).parquet(log_path)


def run_gold(spark: SparkSession, silver_root: str, gold_root: str, full_refresh: bool = False,
             run_id: str | None = None, run_ts: str | None = None,
             as_of: datetime | str | None = None,
             as_of_year: int = fixed.CURRENT_YEAR, skip_unreadable: bool = False) -> RunResult:
    """Rebuild the five marts from the silver table.

    Each mart takes its predecessor's place when it is written; a mart that fails leaves the
    old one.  A full refresh also deletes marts that are empty now.  With ``skip_unreadable``
    stored files that cannot be read are left out and counted as ``files_failed``.
    """
    fresh_id, fresh_ts = run_identity()
    run_id, run_ts = run_id or fresh_id, run_ts or fresh_ts
    lake = SilverLake(silver_root)
    silver = lake.read(spark, skip_unreadable)
    if silver.isEmpty():
        return RunResult(False, run_id, error="no silver data to transform")
    tables = gold_tables(silver, as_of or run_ts, as_of_year)
    if tables["gold_listings_enriched"][1].isEmpty():
        return RunResult(False, run_id, error="no rows survived cleaning")
    log = save_tables(spark, gold_root, tables, run_id, run_ts).where(F.col("run_id") == run_id)
    entries = log.collect()   # one a mart
    counts = {r["table"]: r["rows"] for r in entries}
    if full_refresh:
        for r in entries:
            if r["skipped"]:
                drop_path(spark, f"{gold_root}/{r['table']}")
    if skip_unreadable:
        counts["files_failed"] = lake.unreadable(spark).count()
    return RunResult(True, run_id, counts=counts, details=log)
