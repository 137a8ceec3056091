"""Numeric functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_even(c: Column | str, digits: int) -> Column:
    """Round to ``digits`` decimals, ties to even, by scaling in binary floating
    point (the rounding array libraries use; decimal rounding would break ties
    on the printed digits instead)."""
    scale = F.lit(float(10 ** digits))
    return F.rint(_col(c) * scale) / scale


def number_or_null(c: Column | str) -> Column:
    """Any value as double; unreadable text and NaN become null."""
    return F.nanvl(_col(c).try_cast("double"), F.lit(None).cast("double"))


def whole_number_or_null(c: Column | str) -> Column:
    """Any value as bigint; text such as ``12.0`` counts, fractions become null.

    Reads through double, which parses both forms without a failed cast (costly
    per value); only magnitudes beyond its exact range are read as text.
    """
    value = _col(c)
    number = value.try_cast("double")
    whole = F.when(number == F.floor(number), number.try_cast("bigint"))
    # NaN is above every number, and no whole number as text either
    return F.when(F.abs(number) < float(2 ** 53), whole).when(
        number.isNotNull(), value.cast("string").try_cast("bigint"))


def clip(c: Column | str, lower: float | None = None, upper: float | None = None) -> Column:
    """Limit to a range; null stays null (``greatest``/``least`` would skip it)."""
    value = _col(c)
    out = value
    if lower is not None:
        out = F.greatest(out, F.lit(lower))
    if upper is not None:
        out = F.least(out, F.lit(upper))
    return F.when(value.isNotNull(), out)


def guarded_ratio(numerator: Column | str, denominator: Column | str, digits: int,
                  scale: float = 1, when: Column | None = None) -> Column:
    """``numerator / denominator * scale``, rounded; null unless ``when`` holds
    (default: a positive denominator)."""
    top, bottom = _col(numerator), _col(denominator)
    guard = (bottom > 0) if when is None else when
    ratio = F.try_divide(top.cast("double"), bottom.cast("double"))
    if scale != 1:
        ratio = ratio * F.lit(float(scale))
    return F.when(guard, half_even(ratio, digits))


def bucket_ordinal(c: Column | str, edges: Sequence[float], right: bool = False) -> Column:
    """0-based bin of a value; the last bin is open above, below the first edge
    gives null.  Bins close on the left, or on the right with ``right``."""
    value = _col(c)
    out = F.when(value <= edges[0] if right else value < edges[0], F.lit(None).cast("int"))
    for i, edge in enumerate(edges[1:]):
        out = out.when(value <= edge if right else value < edge, F.lit(i))
    return out.when(value.isNotNull(), F.lit(len(edges) - 1))


def bucketize(c: Column | str, edges: Sequence[float], labels: Sequence[str],
              right: bool = False) -> Column:
    """Label of the bin that :func:`bucket_ordinal` finds."""
    value = _col(c)
    out = F.when(value <= edges[0] if right else value < edges[0], F.lit(None).cast("string"))
    for edge, label in zip(edges[1:], labels):
        out = out.when(value <= edge if right else value < edge, F.lit(label))
    return out.when(value.isNotNull(), F.lit(labels[-1]))


def compare_to_band(c: Column | str, centre: Column | str, band: Sequence[float],
                    labels: Sequence[str]) -> Column:
    """``labels`` = (below, above, within) for a value against a band around
    ``centre``; null when either side is missing."""
    value, middle = _col(c), _col(centre)
    low, high = band
    below, above, within = labels
    return (F.when(value < middle * F.lit(low), F.lit(below))
            .when(value > middle * F.lit(high), F.lit(above))
            .when(value.isNotNull() & middle.isNotNull(), F.lit(within)))


def age_in_years(year: Column | str, as_of_year: int) -> Column:
    return F.lit(as_of_year).cast("bigint") - _col(year)
