"""Text functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that Unicode text stripping removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Where a camelCase name gets its underscores.
CAMEL_BREAKS = ["([A-Z]+)([A-Z][a-z])", "([a-z0-9])([A-Z])"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _is_plain(char: Column) -> Column:
    """Whether a text begins with a visible ASCII character."""
    return F.ascii(char).between(33, 126)


def strip(c: Column | str) -> Column:
    """Remove leading and trailing whitespace of any kind.  Blanks go first, which is cheap; an end is
    compared with every kind of whitespace only if no visible ASCII character stands there."""
    text = F.trim(_col(c))
    text = F.when(_is_plain(text), text).otherwise(F.ltrim(text, F.lit(WHITESPACE)))
    return F.when(_is_plain(F.substring(text, -1, 1)), text).otherwise(F.rtrim(text, F.lit(WHITESPACE)))


def clean_upper(c: Column | str) -> Column:
    return F.upper(strip(c))


def zip5(c: Column | str) -> Column:
    """The five-character ZIP in front of any extension."""
    return F.substring(strip(c), 1, 5)


def _from_first_visible(c: Column | str) -> Column:
    """``c`` without leading whitespace: reads no further than the first visible character."""
    return F.ltrim(_col(c), F.lit(WHITESPACE))


def is_blank(c: Column | str) -> Column:
    """True for text without a visible character; null stays null."""
    return _from_first_visible(c) == ""


def is_filled(c: Column | str) -> Column:
    """True for non-null text with at least one visible character."""
    return F.coalesce(_from_first_visible(c) != "", F.lit(False))


def snake_case(c: Column | str) -> Column:
    """camelCase text to snake_case, as a column function."""
    out = _col(c)
    for pattern in CAMEL_BREAKS:
        out = F.regexp_replace(out, pattern, "$1_$2")
    return F.lower(out)


def snake_name(name: str) -> str:
    """camelCase column name to snake_case, for schema rewrites on the driver."""
    for pattern in CAMEL_BREAKS:
        name = re.sub(pattern, r"\g<1>_\g<2>", name)
    return name.lower()
