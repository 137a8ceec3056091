"""Sinks."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt.operators.keys import first_per_key
from forecourt.session import drop_path, fresh_path, path_exists, stage
from forecourt.sources.listing import file_listing, literal
from forecourt.sources.readers import merged_scan
from forecourt.sources.state import make_folder, names_in, rename


STORED = "zstd"   # compression of tables that stay


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = (), replace_partitions: bool = False) -> int:
    """Write a table and return the number of rows, counted while writing.

    ``replace_partitions`` overwrites only the partitions the rows belong to,
    which makes a repeated write of the same partition idempotent.  Files are compressed with :data:`STORED`.
    """
    watch = Observation()
    counted = df.observe(watch, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode(mode)
    if replace_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path, compression=STORED)
    return int(watch.get["rows"])


def replace_table(spark: SparkSession, path: str, write: Callable[[str], int]) -> int:
    """Replace the table at ``path`` by what ``write`` stores at the path it is given,
    and return what ``write`` returns.

    The new table is written aside and takes the old one's place by renaming; a write
    that fails leaves the old table.
    """
    mark = uuid.uuid4().hex
    aside, old = f"{path}.new-{mark}", f"{path}.old-{mark}"
    try:
        rows = write(aside)
    except BaseException:
        drop_path(spark, aside)
        raise
    if path_exists(spark, path):
        rename(spark, path, old)
        try:
            rename(spark, aside, path)
        except BaseException:
            rename(spark, old, path)
            drop_path(spark, aside)
            raise
        drop_path(spark, old)
    else:
        rename(spark, aside, path)
    return rows


def replace_parquet(df: DataFrame, path: str) -> int:
    """:func:`write_parquet` in the place of the table at ``path``, which ``df`` may read."""
    return replace_table(df.sparkSession, path, lambda aside: write_parquet(df, aside))


def run_folder(path: str, run_id: str) -> str:
    """Partition folder of one run; Spark reads the run id from its name."""
    if not re.fullmatch(r"[\w.-]+", run_id):
        raise ValueError(f"run id {run_id!r} must consist of letters, digits, '.', '_' and '-'")
    return f"{path}/_pipeline_run_id={run_id}"


def write_silver(df: DataFrame, path: str, run_id: str, full_refresh: bool = False) -> int:
    """Store a run's silver rows in its own partition folder; the same run
    written again replaces itself.  A full refresh puts them in the place of all runs."""
    rows = df.drop("_pipeline_run_id")
    if full_refresh:
        return replace_table(df.sparkSession, path, lambda aside: write_parquet(rows, run_folder(aside, run_id)))
    return write_parquet(rows, run_folder(path, run_id))


def write_quarantine(df: DataFrame, root: str, run_id: str, full_refresh: bool = False) -> int:
    """Store a run's rejects below the table root in its own partition folder.  The
    same run written again replaces its rejects, also by none; other runs' stay.
    A full refresh puts them in the place of all runs'."""
    path, rows = f"{root}/{fixed.QUARANTINE_DIR}", df.drop("_pipeline_run_id").hint("rebalance")
    if full_refresh:
        return replace_table(df.sparkSession, path, lambda aside: write_parquet(rows, run_folder(aside, run_id)))
    return write_parquet(rows, run_folder(path, run_id))


def listed_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files below ``path``."""
    return int(file_listing(spark, path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0])


def compact_files(spark: SparkSession, paths: Sequence[str], out: str, target_bytes: int = fixed.PART_BYTES) -> int:
    """Rewrite the parquet tables at ``paths`` as one at ``out`` (which may be one of them),
    in files of about ``target_bytes``, and return the number of rows.

    The scan packs files by their sizes into tasks of the target size, larger files are
    cut at their row groups, and each task writes one file: nothing is shuffled.
    """
    packing = spark.newSession()   # settings of this scan alone
    for key, value in {"spark.sql.files.maxPartitionBytes": target_bytes, "spark.sql.files.openCostInBytes": 0,
                       "spark.sql.files.minPartitionNum": 1}.items():
        packing.conf.set(key, str(value))
    packing.conf.unset("spark.sql.files.maxPartitionNum")
    return replace_parquet(merged_scan(packing, [literal(p) for p in paths]), out)


def compact(df: DataFrame, path: str, total_bytes: int | None = None,
            target_bytes: int = fixed.PART_BYTES) -> int:
    """Rewrite any rows into few, large files.  Where ``total_bytes`` is not given they are
    written aside first and packed as stored tables are (:func:`compact_files`): no task
    reads more than the target, nothing is shuffled."""
    if total_bytes is None:
        spark, aside = df.sparkSession, fresh_path(df.sparkSession, "compact")
        df.write.parquet(aside, compression=STORED)   # as the result is: sizes aside tell sizes there
        rows = compact_files(spark, [aside], path, target_bytes)
        drop_path(spark, aside)
        return rows
    return replace_parquet(df.repartition(max(1, math.ceil(total_bytes / target_bytes))), path)


def json_line() -> Column:
    """A whole row as one compact JSON line; null fields are left out."""
    return F.to_json(F.struct("*"))


def _name_parts(spark: SparkSession, written: str, path: str, base: str) -> None:
    """Move the files of the ``part=/file=`` folders in ``written`` to ``path``, numbered in their order.
    Only names are touched, one a part of the size limit."""
    folders = [(int(p.split("=")[1]), int(f.split("=")[1]), f"{written}/{p}/{f}")
               for p in names_in(spark, written) if p.startswith("part=") for f in names_in(spark, f"{written}/{p}")]
    files = [f"{folder}/{name}" for _, _, folder in sorted(folders) for name in names_in(spark, folder) if name.startswith("part-")]
    width = max(3, len(str(len(files))))

    def move(aside: str) -> int:
        make_folder(spark, aside)
        for i, file in enumerate(files, 1):
            rename(spark, file, f"{aside}/{base}_part_{i:0{width}d}.jsonl")
        return len(files)

    replace_table(spark, path, move)


def write_sized_jsonl(df: DataFrame, path: str, line: Column | None = None,
                      key: str | None = None, order_by: Sequence[Column | str] = (),
                      limit_bytes: int = fixed.PART_BYTES, fill: float = 0.9, base: str = "data") -> None:
    """JSON lines in files of at most ``limit_bytes``, named ``<base>_part_NNN.jsonl``.

    The lines (a row's JSON, or ``line``) are written once; they are then dealt by hash into as
    many parts as their measured total needs.  A part is cut where its running sum of bytes would
    pass the limit.  Long lines (above an eighth of the limit) are cut apart from the others,
    so a few of them do not make many small files; a line above the limit stands
    alone.  With ``key``, only the first row of a key in ``order_by`` order is
    written; rows without a key all stay.
    """
    if key:
        has_key = F.coalesce(F.col(key) != "", F.lit(False))
        df = first_per_key(df.where(has_key), [key], order_by or [key]).unionByName(
            df.where(~has_key))
    spark = df.sparkSession
    rows = stage(df.select((json_line() if line is None else line).alias("value")), "json-lines")
    size = F.octet_length("value") + 1
    is_long = size > limit_bytes // 8
    total, short, long = rows.agg(F.sum(size), F.max(F.when(~is_long, size)), F.max(F.when(is_long, size))).first()
    parts = max(1, math.ceil((total or 0) / (fill * limit_bytes)))
    dealt = rows.select("value", size.alias("_size"), is_long.alias("_long"), F.monotonically_increasing_id().alias("_at"))
    dealt = dealt.withColumn("part", (F.pmod(F.xxhash64("_at"), F.lit(parts)) + 1).cast("int"))
    before = F.sum("_size").over(Window.partitionBy("part", "_long").orderBy("_at").rowsBetween(
        Window.unboundedPreceding, -1))
    room = F.when(F.col("_long"), max(1, limit_bytes - (long or 0))).otherwise(max(1, limit_bytes - (short or 0)))
    place = F.floor(F.coalesce(before, F.lit(0)) / room) * 2 + F.col("_long").cast("int")
    written = fresh_path(spark, "sized-parts")
    dealt.withColumn("file", place).select("value", "part", "file").write.partitionBy("part", "file").text(written)
    _name_parts(spark, written, path, base)
    drop_path(spark, written)
