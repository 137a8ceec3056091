"""Which files there are, as a table; which of them can be read."""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Suffixes of whole-file compression: what a broken file of this kind would hold cannot be counted.
COMPRESSED = r"\.(gz|bz2|deflate|zst|lz4|snappy)$"
STREAMED = r"\.(gz|bz2)$"   # those of them that Python tasks unpack piece by piece


def literal(path: str) -> str:
    """``path`` for a reader that takes patterns: glob characters in it stand for themselves."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _one_spelling(path: Column) -> Column:
    """``file:/x`` and ``file:///x`` are one path."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/")


def _decoded(uri: Column) -> Column:
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def scanned_path() -> Column:
    """The file a scanned row comes from, as the file system spells it: the reader gives
    a URI, in which some characters are encoded."""
    return _one_spelling(_decoded(F.col("_metadata.file_path")))


def _names(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``path`` of every file a scan has found.  The scan's own list is turned into a table
    where it is, in the driver's JVM, without passing through Python."""
    jvm = spark.sparkContext._jvm
    found = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(files._jdf.inputFiles())
    names = DataFrame(spark._jsparkSession.createDataset(found, jvm.org.apache.spark.sql.Encoders.STRING()).toDF(), spark)
    return names.select(_one_spelling(_decoded(F.col("value"))).alias("path"))


def file_listing(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """``path, length, modified`` of every file below ``root``.

    Only the listing is read, not the files: their content is not among the columns.
    Names may hold any character; folders and files that begin with ``_`` or ``.`` are left
    out.  Files of no bytes, which no scan opens, have a row as well (``modified`` is null).
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
             .load(literal(root)))
    listed = files.select(_one_spelling(F.col("path")).alias("path"), "length", F.col("modificationTime").alias("modified"))
    empty = _names(spark, files).join(listed.select("path"), "path", "left_anti")
    return listed.unionAll(empty.select("path", F.lit(0).cast("bigint"), F.lit(None).cast("timestamp")))


def _opens(scheme: str, authority: str) -> bool:
    """Whether tasks can open files of this store themselves."""
    from pyarrow import fs

    if scheme == "file":
        return True
    try:
        fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    except Exception:   # unknown store, or no library for it
        return False
    return True


def opener(listed: DataFrame, opens: Callable[[str, str], bool] = _opens) -> Callable | None:
    """What opens a path of ``listed`` (files of one store) inside a task as a stream, unpacked by its
    suffix; None where only Spark can open the store (``opens``)."""
    first = listed.select("path").first()
    found = re.match("([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?", first.path) if first else None
    scheme, authority = (found[1], found[2] or "") if found else ("file", "")
    if not opens(scheme, authority):
        return None

    def opened(path: str):
        from pyarrow import fs

        store, base = (fs.LocalFileSystem(), "") if scheme == "file" else fs.FileSystem.from_uri(f"{scheme}://{authority}/")
        plain = base.rstrip("/") + path.split(":", 1)[1].removeprefix(f"//{authority}")
        return store.open_input_stream(plain, compression="detect", buffer_size=0)

    return opened


def _unpacked(files: DataFrame, opened: Callable, pieces: int | None = None) -> DataFrame:
    """``path`` of the compressed ``files`` that unpack to their end, or as far as their first ``pieces``.  They are
    unpacked a piece at a time: no task holds a file's text."""
    def tried(batches):
        import pyarrow as pa

        for batch in batches:
            whole = []
            for path in batch.column("path").to_pylist():
                try:
                    with opened(path) as file:
                        for _ in count() if pieces is None else range(pieces):
                            if not file.read(1 << 20):
                                break
                except OSError:
                    continue
                whole.append(path)
            yield pa.RecordBatch.from_pydict({"path": pa.array(whole, pa.string())})

    tasks = 4 * files.sparkSession.sparkContext.defaultParallelism
    return files.select("path").repartition(tasks).mapInArrow(tried, "path string")


def suspect_files(listed: DataFrame) -> DataFrame | None:
    """Rows of ``listed`` that are compressed files whose beginning does not unpack in a task; None where
    tasks cannot tell.  Little of a file is read; a file that breaks further on is not found."""
    some = listed.where((F.col("length") > 0) & F.col("path").rlike(STREAMED))
    opened = opener(some)
    return None if opened is None else some.join(_unpacked(some, opened, 1), "path", "left_anti")


def unreadable_files(spark: SparkSession, listed: DataFrame) -> DataFrame:
    """``path`` of those files of ``listed`` that cannot be read to their end.

    Plain files are read as lines, whose bytes must add up to the listed length;
    a compressed file is unpacked to its end (where only Spark can unpack it, it is read as one
    value, which fails as a whole).  What cannot be read is skipped instead of failing the job.
    """
    def scan(files: DataFrame, **options) -> DataFrame | None:
        paths = [literal(r.path) for r in files.select("path").collect()]   # the chosen files' names
        if not paths:
            return None
        reader = spark.read.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
        return reader.text(paths, **options).select(scanned_path().alias("path"), F.octet_length("value").alias("bytes"))

    some = listed.where(F.col("length") > 0)
    packed = F.col("path").rlike(COMPRESSED)
    found = listed.where("length = 0").select("path")
    lines = scan(some.where(~packed), lineSep="\n")
    if lines is not None:
        # the last line may lack its break, and the reader drops a byte order mark of three bytes
        seen = lines.groupBy("path").agg((F.sum(F.col("bytes") + 1) + 3).alias("_seen"))
        found = found.unionAll(some.join(seen, "path").where(F.col("_seen") >= F.col("length")).select("path"))
    opened = opener(some)
    if opened is not None:
        streamed = F.col("path").rlike(STREAMED)
        found = found.unionAll(_unpacked(some.where(streamed), opened))
        packed = packed & ~streamed
    whole = scan(some.where(packed), wholetext=True)
    if whole is not None:
        found = found.unionAll(whole.select("path").distinct())
    return listed.select("path").join(found, "path", "left_anti")
