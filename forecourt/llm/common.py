"""What the operators share: code shipping, table reading, column checks, Arrow batches."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.session import fresh_path

_SHIPPED: set[str] = set()
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per application.

    Python tasks import it there, wherever the driver itself found it.  Arrow batches
    are cut to ``BATCH_ROWS`` rows where the session has Spark's default: rows are
    whole texts, and a task holds a batch several times.
    """
    if spark.conf.get(_BATCH, "10000") == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        if os.path.isdir(root):  # else the package already came in an archive
            packed = io.BytesIO()
            with zipfile.ZipFile(packed, "w") as z:
                for folder, _, names in os.walk(root):
                    for name in names:
                        if name.endswith(".py"):
                            full = os.path.join(folder, name)
                            z.write(full, os.path.relpath(full, os.path.dirname(root)))
            import tempfile
            path = os.path.join(tempfile.mkdtemp(prefix="forecourt-code-"), "forecourt_code.zip")
            with open(path, "wb") as f:
                f.write(packed.getvalue())
            spark.sparkContext.addPyFile(path)
        _SHIPPED.add(app)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` cut to the two columns an operator needs, under fixed names, so
    that no further column of the table can clash with one of the operator's."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))


def map_batches(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, Iterable]],
                schema: str, rows: int = 256) -> DataFrame:
    """``fn`` from and to columns as lists, over slices of at most ``rows`` rows, so
    that a task holds few texts at a time."""
    out_schema = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        want = to_arrow_schema(out_schema)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                got = fn({n: c.to_pylist() for n, c in zip(part.schema.names, part.columns)})
                arrays = [v if isinstance(v, pa.Array) else pa.array(v, type=f.type)
                          for f, v in ((f, got[f.name]) for f in want)]
                yield pa.RecordBatch.from_arrays(arrays, schema=want)

    return df.mapInArrow(run, out_schema)


_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, label: str, free_shuffle: bool = False) -> tuple[DataFrame, str]:
    """``df`` written below the shared folder and read again, and its path.  With
    ``free_shuffle`` the write's shuffle files go as soon as it has ended, not when the
    driver's memory is next cleaned; nothing reads them again."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    before = spark.conf.get(_FREE, "false")
    if free_shuffle:
        spark.conf.set(_FREE, "true")
    try:
        df.write.parquet(path)
    finally:
        if free_shuffle:
            spark.conf.set(_FREE, before)
    return spark.read.schema(df.schema).parquet(path), path


BIT_MAP_BITS = 1 << 23   # 1 MB, whatever it stands for


def set_bits(hashes: DataFrame) -> bytes:
    """A bit map of ``BIT_MAP_BITS`` bits with that of every ``h`` (long) set.

    It is put together on the executors; the driver gets 256 rows of 4 kB at most.
    """
    spot = (F.col("h").bitwiseAND(BIT_MAP_BITS - 1) + 1).alias("spot")
    parts = (hashes.select(spot).groupBy(F.bitmap_bucket_number("spot").alias("k"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits")).collect())
    out = bytearray(BIT_MAP_BITS >> 3)
    for part in parts:
        at = (part.k - 1) * 4096
        out[at:at + 4096] = part.bits
    return bytes(out)


def with_bit(bits: bytes, h: int) -> int:
    """Whether the bit of ``h`` is set: always, if ``h`` was among the hashes."""
    h &= BIT_MAP_BITS - 1
    return bits[h >> 3] >> (h & 7) & 1


def with_bits(bits: bytes, h: np.ndarray) -> np.ndarray:
    """:func:`with_bit` for an array of 64-bit hashes."""
    h = h & np.uint64(BIT_MAP_BITS - 1)
    table = np.frombuffer(bits, dtype=np.uint8)
    return (table[(h >> np.uint64(3)).astype(np.int64)] >> (h & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
