"""Profiles of tables and of raw JSON lines; results are tidy tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt.functions import half_even, is_filled, json_preview
from forecourt.operators.frequency import stack_columns, top_values, union_all, value_frequencies
from forecourt.operators.quantiles import exact_quantiles
from forecourt.operators.shape import numeric_columns, string_columns
from forecourt.operators.textvalues import chosen_values, text_counts
from forecourt.session import stage
from forecourt.sources.listing import file_listing, scanned_path
from forecourt.sources.readers import line_prefixes, line_scan



def schema_listing(df: DataFrame) -> DataFrame:
    """(position, column, dtype)."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, dtype string")


def percent_of(part: Column, whole: Column) -> Column:
    """Percentage with 2 decimals; 0 for an empty table."""
    share = F.try_divide(part.cast("double"), whole.cast("double")) * 100.0
    return F.coalesce(half_even(share, 2), F.lit(0.0))


COLUMNS_AT_ONCE = 16   # more aggregates than a generated method holds would run interpreted


def per_column(df: DataFrame, columns: Sequence[str], measures) -> DataFrame:
    """One row per column from aggregations over the whole table, some columns at a time:
    each reads its own columns only.  ``measures(c)`` maps names to aggregates of column ``c``."""
    names = list(measures(columns[0]))
    parts = []
    for at in range(0, len(columns), COLUMNS_AT_ONCE):
        some = columns[at:at + COLUMNS_AT_ONCE]
        wide = df.agg(F.count("*").alias("_rows"), *[
            expression.alias(f"{i}.{name}")
            for i, c in enumerate(some) for name, expression in measures(c).items()])
        entries = [F.struct(F.lit(c).alias("column"), F.col("_rows"),
                            *[F.col(f"`{i}.{name}`").alias(name) for name in names])
                   for i, c in enumerate(some)]
        parts.append(wide.select(F.explode(F.array(*entries)).alias("e")).select("e.*"))
    return union_all(parts)


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, std, min, quartiles, max and nulls per numeric column."""
    chosen = list(columns or numeric_columns(df))

    def measures(c: str) -> dict[str, Column]:
        value = F.col(c).cast("double")
        return {"count": F.count(c), "mean": F.avg(value), "std": F.stddev_samp(value),
                "min": F.min(value), "max": F.max(value)}

    stats = per_column(df, chosen, measures)
    quartiles = exact_quantiles(stack_columns(df, chosen, "double"), ["column"], "value",
                                [0.25, 0.5, 0.75])
    missing = F.col("_rows") - F.col("count")
    return stats.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min", F.col("quantiles")[0].alias("p25"),
        F.col("quantiles")[1].alias("p50"), F.col("quantiles")[2].alias("p75"), "max",
        missing.alias("null_count"), percent_of(missing, F.col("_rows")).alias("null_pct"))


def string_profile(df: DataFrame, columns: Sequence[str] | None = None, k: int = 10,
                   counts: DataFrame | None = None) -> DataFrame:
    """Non-null, filled, null and distinct counts per text column, with its top
    ``k`` values as an array of (value, n).  ``counts`` may hand over the columns'
    ``text_counts``, which are else written first."""
    chosen = list(columns or string_columns(df))
    if counts is None:
        counts = stage(text_counts(df, chosen), "text-counts")
    filled = counts.where("filled")
    totals = counts.groupBy("column").agg(
        F.sum("n").alias("non_null_count"), F.sum(F.when(F.col("filled"), F.col("n"))).alias("non_empty_count"),
        F.count_if(F.col("filled")).alias("unique_count"))
    listed = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("r"), "value")))
    best = chosen_values(filled, df, k, by_count=True).groupBy("column").agg(
        F.transform(listed, lambda x: F.struct(x["value"].alias("value"), (-x["r"]).alias("n")))
        .alias("top_values"))
    asked = df.agg(F.count("*").alias("_rows")).select("_rows", F.explode(F.array(*[F.lit(c) for c in chosen])).alias("column"))
    non_null, non_empty, unique = (F.coalesce(c, F.lit(0)).cast("bigint") for c in ("non_null_count", "non_empty_count", "unique_count"))
    missing = F.col("_rows") - non_null
    return (asked.join(totals, "column", "left").join(best, "column", "left")
            .select("column", non_null.alias("non_null_count"), non_empty.alias("non_empty_count"), missing.alias("null_count"),
                    percent_of(missing, F.col("_rows")).alias("null_pct"), unique.alias("unique_count"),
                    F.coalesce("top_values", F.array().cast("array<struct<value:string,n:bigint>>"))
                    .alias("top_values")))


def category_counts(df: DataFrame, columns: Sequence[str] = fixed.CATEGORY_FIELDS, k: int = 20
                    ) -> DataFrame:
    """The ``k`` most frequent values per category column, null included."""
    present = [c for c in columns if c in df.columns]
    best = top_values(value_frequencies(df, present), k)
    return best.select("column", F.coalesce("value", F.lit(fixed.NULL_LABEL)).alias("value"), "n")


def table_shape(df: DataFrame) -> DataFrame:
    """Rows, columns and files of a table read from files."""
    return df.agg(F.count("*").alias("rows"), F.lit(len(df.columns)).alias("columns"),
                  F.count_distinct("_metadata.file_path").alias("files"))


def silver_profile(silver: DataFrame) -> dict[str, DataFrame]:
    """All sections of a silver profile."""
    return {"shape": table_shape(silver), "schema": schema_listing(silver),
            "numeric_summary": numeric_profile(silver), "string_summary": string_profile(silver),
            "value_counts": category_counts(silver)}


# --- raw lines ---------------------------------------------------------------

SAMPLE_BYTES = 2 * 1024 * 1024


def raw_file_inventory(spark: SparkSession, path: str, sample_fraction: float | None = None,
                       glob: str = "*.json*", sample_bytes: int | None = None, sample: DataFrame | None = None) -> DataFrame:
    """Per file, those without a line included: size, records read and total records.

    Counts are exact by default.  With ``sample_bytes`` only that much of the beginning of each
    file is read, and the total is the file size over the sampled bytes per record
    (0 where no record ends in the sample); ``sample`` may hand over these lines.
    With ``sample_fraction`` all is read and that share of the lines counted.
    """
    listed = file_listing(spark, path, glob).select("path", F.col("length").alias("size_bytes"))
    if sample_bytes is not None:
        lines = line_prefixes(spark, path, sample_bytes, glob) if sample is None else sample
    else:
        lines = line_scan(spark, path, glob).select("value", scanned_path().alias("path"))
    lines = lines.where(is_filled("value"))
    if sample_fraction is not None:
        lines = lines.sample(sample_fraction, seed=0)
    seen = lines.groupBy("path").agg(F.count("*").alias("_seen"), F.avg(F.octet_length("value") + 1).alias("_line"))
    files = listed.join(seen, "path", "left").withColumn("records", F.coalesce("_seen", F.lit(0)).cast("bigint"))
    if sample_bytes is not None:
        per_record = F.least(F.col("size_bytes"), F.lit(sample_bytes)) / F.col("_seen")
        total = F.coalesce(F.floor(F.col("size_bytes") / per_record), F.lit(0))
    elif sample_fraction is not None:
        total = F.coalesce(F.floor(F.col("size_bytes") / F.col("_line")), F.lit(0))
    else:
        total = F.col("records")
    return files.select(F.col("path").alias("file"), half_even(F.col("size_bytes") / F.lit(1048576), 2).alias("size_mb"),
                        F.col("records").alias("sampled_records"), total.cast("bigint").alias("total_records"))


def inventory_totals(files: DataFrame) -> DataFrame:
    return files.agg(F.count("*").alias("total_files"),
                     F.sum("total_records").alias("total_records"),
                     half_even(F.sum("size_mb"), 2).alias("total_size_mb"))


def _python_type(value: Column, written: Column) -> Column:
    """Type label of a JSON value; lists and objects carry their size.  A number is
    whole if it is ``written`` without point and exponent."""
    kind = F.schema_of_variant(value)
    text = F.to_json(value)
    is_list, is_object = kind.startswith("ARRAY"), kind.startswith("OBJECT")
    whole = kind.rlike(r"^(BIGINT|DECIMAL\(\d+,0\))$")
    return (F.when(is_object, F.format_string("dict(%d keys)", F.size(F.json_object_keys(text))))
            .when(is_list, F.format_string("list(len=%d)", F.json_array_length(text)))
            .when(kind == "VOID", F.lit("NoneType")).when(kind == "BOOLEAN", F.lit("bool"))
            .when(whole & ~written.rlike("[.eE]"), F.lit("int")).when(kind == "STRING", F.lit("str"))
            .otherwise(F.lit("float")))


def raw_key_types(lines: DataFrame, column: str = "value") -> DataFrame:
    """(key, type, n, sample) over the top-level keys of JSON lines; lines that
    are not JSON objects count nothing."""
    record = lines.select(F.try_parse_json(column).alias("record"), F.col(column).alias("line")).where(
        F.schema_of_variant("record").startswith("OBJECT"))
    pairs = record.lateralJoin(
        record.sparkSession.tvf.variant_explode(F.col("record").outer())
    ).select("key", _python_type(F.col("value"), F.coalesce(F.call_function(
        "get_json_object", "line", F.concat(F.lit("$['"), "key", F.lit("']"))), F.lit(""))).alias("type"),
             F.when(~F.is_variant_null("value"),
                    json_preview(F.col("value").cast("string"))).alias("preview"))
    return pairs.groupBy("key", "type").agg(F.count("*").alias("n"),
                                            F.min("preview").alias("sample"))


def raw_key_inventory(lines: DataFrame, column: str = "value") -> DataFrame:
    """Per top-level key: occurrences, type histogram (most frequent first),
    whether it is nested, and a sample value; most frequent key first."""
    typed = raw_key_types(lines, column)
    histogram = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("r"), "type")))
    return typed.groupBy("key").agg(
        F.sum("n").alias("seen"),
        F.transform(histogram, lambda x: F.struct(x["type"].alias("type"), (-x["r"]).alias("n")))
        .alias("types"),
        F.bool_or(F.col("type").startswith("dict")).alias("nested"),
        F.min("sample").alias("sample")).orderBy(F.desc("seen"), "key")


def raw_profile(spark: SparkSession, path: str, sample_fraction: float | None = None,
                glob: str = "*.json*", sample_bytes: int | None = None) -> dict[str, DataFrame]:
    """All sections of a raw layer profile.  ``sample_bytes`` (the layer's custom is
    ``SAMPLE_BYTES``) reads the beginning of each file only, once for all sections."""
    lines = line_scan(spark, path, glob) if sample_bytes is None else line_prefixes(spark, path, sample_bytes, glob)
    files = raw_file_inventory(spark, path, sample_fraction, glob, sample_bytes, lines)
    return {"files": files, "totals": inventory_totals(files), "keys": raw_key_inventory(lines)}
