"""Work list of a collection grid: ZIP x model-year range x condition, minus what
is done."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed


def year_ranges(first: int = fixed.GRID_FIRST_YEAR, last: int = fixed.GRID_LAST_YEAR,
                batch_end: int = fixed.GRID_BATCH_YEAR_END) -> list[tuple[int, int]]:
    """Years up to ``batch_end`` as one range, later ones singly."""
    early = [(first, min(batch_end, last))] if first <= batch_end else []
    return early + [(y, y) for y in range(max(batch_end + 1, first), last + 1)]


def coverage_grid(zips: DataFrame, condition: str, ranges: list[tuple[int, int]] | None = None,
                  zip_column: str = "value") -> DataFrame:
    """Every combination with its key ``{zip}_{min}-{max}_{condition}``."""
    spans = F.array(*[F.struct(F.lit(a).alias("year_min"), F.lit(b).alias("year_max"))
                      for a, b in (year_ranges() if ranges is None else ranges)])
    grid = zips.select(F.col(zip_column).cast("string").alias("zip"), F.explode(spans).alias("span"))
    tag = condition.lower()
    return grid.select(
        F.concat_ws("_", "zip", F.concat_ws("-", "span.year_min", "span.year_max"),
                    F.lit(tag)).alias("key"),
        "zip", "span.year_min", "span.year_max", F.lit(tag).alias("condition"))


def open_work(grid: DataFrame, log: DataFrame, retry_errors: bool = False) -> DataFrame:
    """Combinations without a log entry.  A failed one counts as done unless
    ``retry_errors``."""
    done = log.where(F.col("error").isNull()) if retry_errors else log
    return grid.join(done.select("key"), "key", "left_anti")


def log_entries(done: DataFrame, completed_at: str) -> DataFrame:
    """Log rows (key, completed_at, count, error) for finished combinations."""
    return done.select("key", F.lit(completed_at).alias("completed_at"),
                       F.col("count").cast("bigint").alias("count"),
                       F.col("error").cast("string").alias("error"))
