"""Exact quantiles by weighted rank selection, for groups of any size.

Values are counted per group first; copies are combined before any shuffle and the
different values of a group are spread over all tasks.  The wanted ranks are then
found in the counts in two steps, the same for every group:

1. counts are summed per bucket of the value's magnitude; running sums over a group's
   buckets, a bounded number, tell which buckets hold the ranks;
2. running sums over the values of these buckets alone tell the values.

Buckets are a monotone function of the value, so the result is exact.  Both running
sums are windows, which sort and spill; nothing holds a group's values in memory, no
step needs to know which groups are large, and nothing runs before the query does.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.operators.keys import with_keys

BUCKETS_PER_DOUBLING = 1 << 14
_SMALLEST = 1075   # doublings from the smallest positive double to 1


def magnitude_bucket(value: Column) -> Column:
    """A whole number that never falls as ``value`` rises: fine where values are
    near zero as well as where they are large, mirrored for negatives."""
    size = F.abs(value)
    step = (F.floor(F.log2(F.when((size > 0) & (size < float("inf")), size)) * float(BUCKETS_PER_DOUBLING))
            + _SMALLEST * BUCKETS_PER_DOUBLING)
    step = F.when(size == 0, 0).otherwise(F.coalesce(step, F.lit(4 * _SMALLEST * BUCKETS_PER_DOUBLING))).cast("bigint")
    return F.when(value < 0, -step).otherwise(step)


def _ahead(group: Sequence[str], order: str) -> Column:
    """Sum of ``_n`` over the rows of the group before this one."""
    upto = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum("_n").over(upto) - F.col("_n")


def value_counts(df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """``keys, _value, _n``: how often each number occurs in each group; null and NaN do not count."""
    number = value.cast("double")
    rows = df.select(*keys, number.alias("_value")).where(F.col("_value").isNotNull() & ~F.isnan("_value"))
    return rows.groupBy(*keys, "_value").agg(F.count("*").alias("_n"))


def weighted_quantiles(counts: DataFrame, keys: Sequence[str], fractions: Sequence[float]) -> DataFrame:
    """``keys`` and ``quantiles`` (array<double>) of :func:`value_counts`, linear interpolation between ranks."""
    group = list(keys)
    bucketed = counts.withColumn("_bucket", magnitude_bucket(F.col("_value")))
    position = [(F.col("_total") - 1) * F.lit(float(f)) for f in fractions]
    slots = F.array(*[
        F.struct(F.lit(2 * i + side).alias("slot"), near(p).cast("bigint").alias("at"))
        for i, p in enumerate(position) for side, near in enumerate((F.floor, F.ceil))])

    def inside(wanted: Column) -> Column:
        return F.filter(wanted, lambda s: (s["at"] >= F.col("_ahead")) & (s["at"] < F.col("_ahead") + F.col("_n")))

    held = (bucketed.groupBy(*group, "_bucket").agg(F.sum("_n").alias("_n"))
            .select(*group, "_bucket", "_n", _ahead(group, "_bucket").alias("_ahead"),
                    F.sum("_n").over(Window.partitionBy(*group)).alias("_total"))
            .select(*group, "_bucket", "_ahead", "_total", inside(slots).alias("_wanted"))
            .where(F.size("_wanted") > 0)
            .select(*group, "_bucket", F.col("_ahead").alias("_bucket_ahead"), "_total", "_wanted"))
    found = (bucketed.join(held, [*group, "_bucket"])
             .withColumn("_ahead", F.col("_bucket_ahead") + _ahead([*group, "_bucket"], "_value"))
             .select(*group, "_total", "_value", F.explode(inside(F.col("_wanted"))).alias("_hit")))

    def at(slot: int) -> Column:
        return F.max(F.when(F.col("_hit.slot") == slot, F.col("_value")))

    def blend(i: int, f: float) -> Column:
        place = (F.max("_total") - 1) * F.lit(float(f))
        low, high = at(2 * i), at(2 * i + 1)
        share = place - F.floor(place)
        return F.when(low == high, low).otherwise(low * (1.0 - share) + high * share)

    return found.groupBy(*group).agg(
        F.array(*[blend(i, f) for i, f in enumerate(fractions)]).alias("quantiles"))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, fractions: Sequence[float]) -> DataFrame:
    """``keys`` and ``quantiles`` (array<double>) of the values of every group, nulls and
    NaN left out; ``keys`` must not be null."""
    return weighted_quantiles(value_counts(df, keys, F.col(value)), keys, fractions)


def grouped_stats(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column],
                  medians: Mapping[str, str]) -> DataFrame:
    """One row per non-null key: ``aggregates`` plus exact ``medians``
    (output name -> value column).  ``df`` is read once for the aggregates and
    once, keys and value columns alone, for all medians."""
    group = list(keys)
    rows = with_keys(df, group)
    if not medians:
        return rows.groupBy(*group).agg(*aggregates)
    if len(medians) == 1:
        (name, source), = medians.items()
        measured = rows.select(*group, F.lit(name).alias("_measure"), F.col(source).cast("double").alias("_m"))
    else:
        measures = F.explode(F.array(*[
            F.struct(F.lit(name).alias("_measure"), F.col(source).cast("double").alias("_m"))
            for name, source in medians.items()]))
        measured = rows.select(*group, measures.alias("_each")).select(*group, "_each._measure", "_each._m")
    ranked = weighted_quantiles(value_counts(measured, [*group, "_measure"], F.col("_m")), [*group, "_measure"], [0.5])
    table = ranked.groupBy(*group).agg(*[
        F.max(F.when(F.col("_measure") == name, F.col("quantiles")[0])).alias(name) for name in medians])
    if not aggregates:
        return rows.select(*group).distinct().join(table, group, "left")
    return rows.groupBy(*group).agg(*aggregates).join(table, group, "left")
