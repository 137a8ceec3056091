"""Key-based row selection: keep-first, known-key removal, top-k sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.session import stage


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose ``keys`` are all present.  One plain condition per key, which
    reaches the scan for stored columns and folds away for columns that cannot
    be null."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str],
                  k: int = 1) -> DataFrame:
    """The first ``k`` rows of every key in ``order_by`` order.

    The rank filter lets Spark cut each key to ``k`` rows per map task before
    the shuffle, so a key holding most rows does not end up whole in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return (df.withColumn("_rank", F.row_number().over(window))
            .where(F.col("_rank") <= k).drop("_rank"))


def pick_rows(rows: DataFrame, chosen: DataFrame, row: str) -> DataFrame:
    """Those of ``rows`` whose number ``row`` (unique, not null) is in ``chosen``, a stored table.

    Wide rows join whichever is fewer, the chosen numbers or, stored here, the others: the fewer are
    mostly few enough for a broadcast, so that no wide row is shuffled, sorted or spilled.
    """
    if 2 * chosen.count() <= rows.count():
        return rows.join(chosen, row, "left_semi")
    others = stage(rows.select(row).join(chosen, row, "left_anti"), "other-rows")
    return rows.join(others, row, "left_anti")


def drop_known_keys(batch: DataFrame, known: DataFrame, key: str,
                    batch_keys: DataFrame | None = None) -> DataFrame:
    """Rows of ``batch`` whose ``key`` does not occur in ``known``.

    ``known`` (the stored table) is first reduced to the batch's keys: that side
    can stream past a small batch, or be thinned by a run-time Bloom filter,
    instead of being shuffled whole for every small batch.  ``batch_keys`` is a
    cheaper source of the batch's keys (more keys do no harm).
    """
    source = batch if batch_keys is None else batch_keys
    wanted = source.select(key).where(F.col(key).isNotNull()).distinct()
    seen = known.select(key).join(wanted, key, "left_semi")
    return batch.join(seen, key, "left_anti")


def top_keys(df: DataFrame, key: str, measure: str, k: int) -> DataFrame:
    """The ``k`` keys with the largest sum of ``measure``, with that sum."""
    totals = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum(measure).alias(measure))
    return totals.orderBy(F.desc(measure), F.asc(key)).limit(k)


def keep_keys(df: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is in ``chosen``."""
    return df.join(chosen.select(key), key, "left_semi")


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key value; nulls count as one value."""
    return (df.groupBy(key).agg(F.count("*").alias("n"))
            .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0).cast("bigint")).alias("duplicate_rows")))
