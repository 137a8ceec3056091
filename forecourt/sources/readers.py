"""Scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt import fixed_values as fixed
from forecourt.functions import strip
from forecourt.session import fresh_path, path_exists
from forecourt.sources.listing import _opens, file_listing, literal, opener, scanned_path
from forecourt.sources.state import STARTED_DIR, live_root, unfinished_runs

CORRUPT = "_corrupt"
RAW_TEXT = "_raw_text"
RAW_GLOB = "*.json*"


def raw_schema(scalars: Sequence[str] = fixed.RAW_SCALARS,
               structs: Mapping[str, Mapping[str, str]] = fixed.RAW_STRUCTS) -> T.StructType:
    """Reader schema of a raw record.  Every field is text, so one value of an
    unexpected type never spoils its record; nested values arrive as their JSON
    text.  Types are fixed later by ``enforce_schema``."""
    return T.StructType([T.StructField(name, T.StringType()) for name in (*scalars, *structs, CORRUPT)])


def parsed_structs(raw: DataFrame, structs: Mapping[str, Mapping[str, str]] = fixed.RAW_STRUCTS) -> DataFrame:
    """The JSON text of ``structs`` as structs of text; what is no object (a list,
    plain text, nothing) becomes a struct without values."""
    def kind(inner: Mapping[str, str]) -> T.StructType:
        return T.StructType([T.StructField(f, T.StringType()) for f in inner])

    return raw.withColumns({name: F.from_json(F.when(F.col(name).startswith("{"), F.col(name)), kind(inner))
                            for name, inner in structs.items()
                            if name in raw.columns and isinstance(raw.schema[name].dataType, T.StringType)})


def listing_schema(scalars: Sequence[str] = fixed.RAW_SCALARS,
                   structs: Mapping[str, Mapping[str, str]] = fixed.RAW_STRUCTS) -> T.StructType:
    """:func:`raw_schema` with the nested records as structs of text, which the reader fills in its one parse."""
    text = T.StringType()
    inner = [T.StructField(name, T.StructType([T.StructField(f, text) for f in fields])) for name, fields in structs.items()]
    return T.StructType([*(T.StructField(name, text) for name in scalars), *inner, T.StructField(CORRUPT, text)])


def settled_structs(rows: DataFrame, structs: Mapping[str, Mapping[str, str]] = fixed.RAW_STRUCTS) -> DataFrame:
    """Rows read by :func:`listing_schema` as :func:`raw_schema` and :func:`parsed_structs` give them.

    A line whose ``structs`` hold anything but objects counts as malformed to the reader, which
    keeps its other fields: such lines, and no others, are parsed once more for the texts of their structs.
    """
    line = F.col(CORRUPT)
    again = F.from_json(line, T.StructType([T.StructField(n, T.StringType()) for n in (*structs, CORRUPT)]),
                        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # a line may hold a list of records, a row each: what is no object there has no values
    listed = F.forall(F.from_json(line, "array<string>"), lambda e: e.startswith("{"))

    def texts(name: str, fields: Mapping[str, str]) -> Column:
        value = again[name]
        return F.from_json(F.when(value.startswith("{"), value), T.StructType([T.StructField(f, T.StringType()) for f in fields]))

    odd = line.isNotNull() & ~F.coalesce(F.ltrim(line).startswith("[") & listed, F.lit(False))
    return rows.withColumns({
        **{name: F.when(odd, texts(name, fields)).otherwise(F.col(name)) for name, fields in structs.items()},
        CORRUPT: F.when(odd, again[CORRUPT])})


def keeps_odd_lines(spark: SparkSession) -> bool:
    """Whether the reader keeps the other fields of a line with a field of another kind (Spark's default)."""
    return spark.conf.get("spark.sql.json.enablePartialResults", "true").lower() == "true"


def listing_scan(spark: SparkSession, paths: str | Sequence[str], glob: str = RAW_GLOB) -> DataFrame:
    """:func:`jsonl_scan` with the nested records as structs of text, parsed with their line."""
    if not keeps_odd_lines(spark):
        return parsed_structs(jsonl_scan(spark, paths, glob=glob))
    return settled_structs(jsonl_scan(spark, paths, listing_schema(), glob))


def jsonl_scan(spark: SparkSession, paths: str | Sequence[str],
               schema: T.StructType | None = None, glob: str = RAW_GLOB) -> DataFrame:
    """One row per JSON line.  Blank lines are skipped; a malformed line keeps
    its text in ``_corrupt`` instead of failing the job.  Files are found below
    ``paths`` by name pattern, at any depth."""
    return (spark.read.schema(schema or raw_schema())
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
            .json(paths if isinstance(paths, str) else list(paths)))


def line_scan(spark: SparkSession, paths: str | Sequence[str], glob: str = RAW_GLOB) -> DataFrame:
    """One row per text line (``value``)."""
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return reader.text(paths if isinstance(paths, str) else list(paths))


def line_prefixes(spark: SparkSession, root: str, prefix_bytes: int, glob: str = RAW_GLOB) -> DataFrame:
    """``path, value``: the whole lines within the first ``prefix_bytes`` of every file below
    ``root``, written before it returns.

    Tasks share out the listing and read that many bytes of each file, whatever its size
    (of a compressed file that many unpacked ones).  The last line of a file that
    ends in the prefix counts as whole.  Of a store that only Spark can open all lines are read
    and those within the prefix kept.
    """
    listed = file_listing(spark, root, glob)
    opening = opener(listed, _opens)

    def opened(batches):
        import pyarrow as pa

        for batch in batches:
            for path in batch.column("path").to_pylist():
                with opening(path) as file:
                    data = file.read(prefix_bytes + 1)
                lines = data[:prefix_bytes].split(b"\n")
                if len(data) > prefix_bytes or not lines[-1]:   # cut off, or the end behind the last line break
                    lines.pop()
                values = [line.decode("utf-8", "replace") for line in lines]
                yield pa.RecordBatch.from_pydict({"path": pa.array([path] * len(values), pa.string()),
                                                  "value": pa.array(values, pa.string())})

    if opening is not None:
        lines = listed.where("length > 0").select("path").mapInArrow(opened, "path string, value string")
    else:
        at = Window.partitionBy("path").orderBy("_block", "_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        scan = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(literal(root), lineSep="\n")
        rows = scan.select(scanned_path().alias("path"), "value", F.col("_metadata.file_size").alias("_size"),
                           F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"))
        rows = rows.where(F.col("_block") < prefix_bytes).withColumn("_end", F.sum(F.octet_length("value") + 1).over(at))
        whole = F.when(F.col("_size") > prefix_bytes, F.lit(prefix_bytes)).otherwise(F.col("_size") + 1)
        lines = rows.where(F.col("_end") <= whole).select("path", "value")
    path = fresh_path(spark, "line-prefixes")
    lines.write.parquet(path)
    return spark.read.schema("path string, value string").parquet(path)


def text_list_scan(spark: SparkSession, path: str, column: str = "value") -> DataFrame:
    """One value per line, stripped, blank lines dropped."""
    return (spark.read.text(path).select(strip("value").alias(column))
            .where(F.length(column) > 0))


def file_position() -> list[Column]:
    """Columns that order rows as they stand in their files (file name aside).
    Rows of one file block share a task, which numbers them in reading order."""
    return [F.col("_metadata.file_block_start").alias("_block_start"),
            F.monotonically_increasing_id().alias("_row_in_task")]


FILE_LOG_SCHEMA = ("source_file string, run_id string, completed_at string, raw bigint, "
                   "silver bigint, quarantined bigint, cross_dedup bigint, failed boolean, error string")


def file_log(spark: SparkSession, live: str) -> DataFrame:
    """The log of files that runs have read below ``live``; empty before the first run."""
    path = f"{live}/{fixed.META_DIR}/file_log"
    if not path_exists(spark, path):
        return spark.createDataFrame([], FILE_LOG_SCHEMA)
    return spark.read.schema(FILE_LOG_SCHEMA).option("recursiveFileLookup", "true").parquet(path)


def parquet_scan(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """A table by its root folder.  Spark skips paths that start with ``_``, so
    the quarantine and bookkeeping folders below the root stay out."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(root)


def quarantine_scan(spark: SparkSession, root: str, with_text: bool = False) -> DataFrame:
    """The quarantine below a table root, reasons last; ``with_text`` adds the text
    of lines that could not be parsed.  Rejects of runs that have not ended are left out."""
    live = live_root(spark, root)
    table = spark.read.parquet(f"{live}/{fixed.QUARANTINE_DIR}")
    if path_exists(spark, f"{live}/{STARTED_DIR}"):
        unfinished = unfinished_runs(spark, live, file_log(spark, live))
        table = table.join(F.broadcast(unfinished.select(F.col("run_id").alias("_pipeline_run_id"))),   # runs under way
                           "_pipeline_run_id", "left_anti")
    return table.select(*fixed.SILVER_COLUMNS, fixed.REJECTION_COLUMN, *([RAW_TEXT] if with_text else []))


def merged_scan(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Several parquet tables as one, missing columns null.  Naming a quarantine
    folder among ``paths`` includes it."""
    frames = [spark.read.option("mergeSchema", "true").parquet(p) for p in paths]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def peek(df: DataFrame) -> DataFrame:
    """The first row as (column, value) text."""
    names = df.columns
    first = df.limit(1).select(*[F.col(f"`{c}`").cast("string").alias(c) for c in names])
    return first.unpivot([], names, "column", "value")
