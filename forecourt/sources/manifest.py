"""Manifest of line-oriented files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt.functions import half_even
from forecourt.sources.listing import file_listing, scanned_path
from forecourt.sources.readers import line_scan


def line_checksum(line: Column | str = "value") -> Column:
    """Aggregate: order-independent checksum, 60 bits of each line's MD5 combined by
    exclusive or (which cannot overflow); pairs of equal lines show in the row count."""
    word = F.conv(F.substring(F.md5(line), 1, 15), 16, 10).cast("bigint")
    return F.bit_xor(word)


def dataset_manifest(spark: SparkSession, path: str, limit_bytes: int = fixed.PART_BYTES,
                     glob: str = "*") -> DataFrame:
    """Per file, those without a line included: part number, name, size, rows, checksum, and
    whether it is full.  ``created_at`` is null for files of no bytes."""
    listed = file_listing(spark, path, glob).select(
        F.col("path").alias("filepath"), F.element_at(F.split("path", "/"), -1).alias("filename"),
        F.col("length").alias("size_bytes"), F.col("modified").alias("created_at"))
    lines = line_scan(spark, path, glob).select(scanned_path().alias("filepath"), "value")
    counted = lines.groupBy("filepath").agg(F.count("*").alias("row_count"), line_checksum().alias("checksum"))
    files = listed.join(counted, "filepath", "left")
    part = F.regexp_extract("filepath", r"part[=_-](\d+)", 1).try_cast("int")
    rows, checksum = (F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("row_count", "checksum"))
    return files.select(part.alias("part_number"), "filename", "filepath", "size_bytes", rows, checksum, "created_at",
                        (F.col("size_bytes") >= limit_bytes).alias("is_complete"))


def manifest_summary(manifest: DataFrame) -> DataFrame:
    """Totals over all files."""
    total = F.sum("size_bytes")
    return manifest.agg(F.count("*").alias("total_files"), F.sum("row_count").alias("total_rows"),
                        half_even(total / F.lit(1048576), 2).alias("total_size_mb"))
