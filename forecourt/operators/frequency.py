"""Counting operators: value frequencies, most frequent values, reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.operators.keys import first_per_key, with_keys


def stack_columns(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """Wide to long: (column, value) with every value cast to ``kind``."""
    narrow = df.select(*[F.col(c).cast(kind).alias(c) for c in columns])
    return narrow.unpivot([], list(columns), "column", "value")


def value_frequencies(df: DataFrame, columns: Sequence[str], keep: Column | None = None
                      ) -> DataFrame:
    """(column, value, n) over text columns; ``keep`` filters on ``value`` first."""
    stacked = stack_columns(df, columns, "string")
    if keep is not None:
        stacked = stacked.where(keep)
    return stacked.groupBy("column", "value").agg(F.count("*").alias("n"))


def top_values(frequencies: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent values per column, ties by value."""
    return first_per_key(frequencies, ["column"], [F.desc("n"), F.asc_nulls_last("value")], k)


def top_n_joined(df: DataFrame, group: str, value: str, n: int, out: str,
                 separator: str = ", ") -> DataFrame:
    """The ``n`` most frequent ``value``s per group as joined text, most frequent
    first, ties ascending.  Only ``n`` counted values per group are gathered."""
    counted = with_keys(df, [group, value]).groupBy(group, value).agg(F.count("*").alias("_n"))
    best = first_per_key(counted, [group], [F.desc("_n"), F.asc(value)], n)
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("_n")).alias("r"), F.col(value).alias("v"))))
    return best.groupBy(group).agg(
        F.array_join(F.transform(ranked, lambda x: x["v"]), separator).alias(out))


def most_frequent(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """The most frequent ``value`` per group, ties ascending."""
    counted = with_keys(df, [group, value]).groupBy(group, value).agg(F.count("*").alias("_n"))
    return counted.groupBy(group).agg(
        F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(out))


def sorted_distinct_joined(value: Column | str, separator: str = ", ") -> Column:
    """Aggregate: the distinct values in ascending order as joined text."""
    return F.array_join(F.array_sort(F.collect_set(value)), separator)


def pivot_sum(df: DataFrame, rows: str, columns: str, measure: str,
              column_values: Sequence | None = None) -> DataFrame:
    """``rows`` x ``columns`` table of summed ``measure``, empty cells 0.  Without
    ``column_values`` every value found becomes a column; an empty list means none."""
    grouped = with_keys(df, [rows, columns]).groupBy(rows)
    if column_values is not None and not list(column_values):
        return with_keys(df, [rows, columns]).select(rows).distinct()
    spread = grouped.pivot(columns) if column_values is None else grouped.pivot(columns, list(column_values))
    return spread.agg(F.sum(measure)).na.fill(0)


def split_counts(df: DataFrame, column: str, delimiter: str, out: str) -> DataFrame:
    """Count the non-empty parts of delimited text, most frequent first."""
    parts = df.select(F.explode(F.split(F.col(column), delimiter)).alias(out))
    return (parts.select(F.trim(out).alias(out)).where(F.col(out) != "")
            .groupBy(out).agg(F.count("*").alias("n")).orderBy(F.desc("n"), out))


def union_all(frames: Sequence[DataFrame], promote: bool = False) -> DataFrame:
    """Concatenate by column name; ``promote`` fills missing columns with null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=promote)
    return out
