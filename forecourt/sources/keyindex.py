"""Stored keys in hash buckets, so that a small batch need not read the table's keys.

Each run of the table has its keys in one folder of the index, by bucket; folders are
merged when they become many.  A batch reads the buckets its own keys fall into
and nothing of the table.  The index follows the table: what runs are not covered yet is added before
the index is used, so a run that died between table and index costs nothing but that.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt import fixed_values as fixed
from forecourt.session import drop_path
from forecourt.sources.state import names_in

BUCKETS = 64          # more for tables of many billion keys: a run has a file a bucket at most
MAX_FOLDERS = 32      # more are merged into one
_RUN = "_pipeline_run_id="


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class KeyIndex:
    """Index of the ``key`` column of the table of runs at ``table``, kept at ``path``."""

    def __init__(self, spark: SparkSession, table: str, path: str, key: str = fixed.BUSINESS_KEY, buckets: int = BUCKETS):
        self.spark, self.table, self.path, self.key, self.buckets = spark, table, path, key, buckets

    def covered(self) -> dict[str, list[str]]:
        """Folder of the index -> runs whose keys it has.  A folder counts once it is whole:
        the names of its runs are written after its keys."""
        names = names_in(self.spark, f"{self.path}/covers")
        if not names:
            return {}
        rows = self.spark.read.schema("folder string, run_id string").option("recursiveFileLookup", "true").parquet(f"{self.path}/covers")
        out: dict[str, list[str]] = {}
        for r in rows.collect():   # a row a run
            out.setdefault(r.folder, []).append(r.run_id)
        return out

    def stored_runs(self) -> list[str]:
        return [n[len(_RUN):] for n in names_in(self.spark, self.table) if n.startswith(_RUN)]

    def _add(self, keys: DataFrame, runs: Sequence[str]) -> str:
        folder = f"keys-{uuid.uuid4().hex}"
        keyed = keys.where(F.col(self.key).isNotNull()).withColumn("bucket", bucket_of(F.col(self.key), self.buckets))
        keyed.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
        covers = self.spark.createDataFrame([(folder, r) for r in runs], "folder string, run_id string")
        covers.coalesce(1).write.parquet(f"{self.path}/covers/{folder}")
        return folder

    def _drop(self, folder: str) -> None:
        drop_path(self.spark, f"{self.path}/covers/{folder}")   # first, so that no reader goes to a part of it
        drop_path(self.spark, f"{self.path}/{folder}")

    def _read(self, folders: Sequence[str]) -> DataFrame:
        schema = T.StructType([T.StructField(self.key, T.StringType()), T.StructField("bucket", T.IntegerType())])
        if not folders:
            return self.spark.createDataFrame([], schema)
        # an index folder without a key has no files
        parts = [self.spark.read.schema(schema).parquet(f"{self.path}/{f}") for f in folders]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionAll(part)
        return out

    def follow(self, leave_out: str | None = None) -> dict[str, list[str]]:
        """Add the stored runs that the index lacks, ``leave_out`` aside; merge folders if they are many."""
        covered = self.covered()
        have = {r for runs in covered.values() for r in runs}
        new = [r for r in self.stored_runs() if r not in have and r != leave_out]
        if new:
            rows = self.spark.read.schema(f"{self.key} string, _pipeline_run_id string").parquet(self.table)
            covered[self._add(rows.where(F.col("_pipeline_run_id").isin(new)).select(self.key), new)] = new
        # a run that may be written again keeps a folder of its own
        old = [f for f, runs in covered.items() if leave_out not in runs]
        if len(old) > MAX_FOLDERS:
            runs = [r for f in old for r in covered[f]]
            merged = self._add(self._read(old).select(self.key), runs)
            for f in old:
                self._drop(f)
                del covered[f]
            covered[merged] = runs
        return covered

    def known(self, batch: DataFrame, run_id: str | None = None) -> DataFrame:
        """Stored keys, as far as they can equal a key of ``batch``, those of run ``run_id`` aside.

        Reads the buckets of the batch's keys only; their numbers are all that reaches the driver.
        """
        covered = self.follow(run_id)
        own = [f for f, runs in covered.items() if run_id in runs]
        if any(len(covered[f]) > 1 for f in own):   # merged with others when it was not expected again
            rows = self.spark.read.schema(f"{self.key} string, _pipeline_run_id string").parquet(self.table)
            return rows.where((F.col("_pipeline_run_id") != run_id) & F.col(self.key).isNotNull()).select(self.key)
        keys = batch.where(F.col(self.key).isNotNull()).select(bucket_of(F.col(self.key), self.buckets).alias("bucket"))
        touched = [r.bucket for r in keys.distinct().collect()]   # BUCKETS numbers at most
        return self._read([f for f in covered if f not in own]).where(F.col("bucket").isin(touched)).select(self.key)
