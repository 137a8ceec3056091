"""Silver layer: raw records to the fixed silver schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt.functions import clean_upper, iso_utc, zip5
from forecourt.operators.routing import listing_rules, mark_rejections, split_rejected
from forecourt.operators.shape import (add_lineage, coerce_numbers, drop_columns, enforce_schema,
                                       flatten_struct, nested_to_json, rename_keys,
                                       snake_case_columns)
from forecourt.sources.readers import CORRUPT, parsed_structs


def flatten(raw: DataFrame) -> DataFrame:
    """Nested raw records to one flat level with snake_case names."""
    flat = parsed_structs(drop_columns(raw, fixed.RAW_UNWANTED))
    for struct, fields in fixed.RAW_STRUCTS.items():
        flat = flatten_struct(flat, struct, fields)
    flat = rename_keys(nested_to_json(flat), fixed.RAW_RENAMES)
    return snake_case_columns(flat)


def standardise(flat: DataFrame) -> DataFrame:
    """Upper-cased, stripped categories, five-digit ZIPs, ISO dates, numeric coordinates."""
    present = set(flat.columns)
    cleaned = {c: clean_upper(F.col(c).cast("string"))
               for c in fixed.SILVER_UPPER_TRIMMED if c in present}
    for name, clean in (("vehicle_condition", F.upper), ("dealer_zip", zip5),
                        ("first_seen", iso_utc)):
        if name in present:
            cleaned[name] = clean(F.col(name).cast("string"))
    return coerce_numbers(flat.withColumns(cleaned), ["dealer_latitude", "dealer_longitude"])


def silver_rows(raw: DataFrame, run_id: str, run_ts: str,
                source_file: Column | str | None = None,
                source_system: str = fixed.SOURCE_SYSTEM,
                rules: Mapping[str, Column] | None = None,
                keep: Mapping[str, Column] | None = None) -> DataFrame:
    """All raw rows in silver shape with ``_rejection_reason`` (empty when valid).

    ``keep`` adds columns computed on the scan (row positions) after the reason.
    Scan, parse, flatten, standardise, cast and rule checks are one stage.
    """
    checks = dict(rules or listing_rules())
    kept = [column.alias(name) for name, column in (keep or {}).items()]
    if CORRUPT in raw.columns:
        checks = {"corrupt_json": F.col(CORRUPT).isNotNull(), **checks}
    tagged = add_lineage(standardise(flatten(raw)), run_id, run_ts, source_file, source_system)
    # positions and fault marks ride along in the one projection that casts
    shaped = enforce_schema(tagged, keep=[*kept, *([CORRUPT] if CORRUPT in raw.columns else [])])
    return mark_rejections(shaped, checks).select(
        *fixed.SILVER_COLUMNS, fixed.REJECTION_COLUMN, *(keep or {}))


def silver_transform(raw: DataFrame, run_id: str, run_ts: str, **options
                     ) -> tuple[DataFrame, DataFrame]:
    """(silver, quarantine) of a raw frame."""
    return split_rejected(silver_rows(raw, run_id, run_ts, **options))
