"""Projections that bring records into a declared shape."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.fixed_values import SILVER_COLUMNS, SOURCE_SYSTEM
from forecourt.functions import number_or_null, snake_name, whole_number_or_null


SQL_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "double": T.DoubleType()}


def to_struct_type(columns: Mapping[str, str]) -> T.StructType:
    """A name -> SQL type mapping as a Spark schema."""
    return T.StructType([T.StructField(c, SQL_TYPES[t]) for c, t in columns.items()])


SILVER = to_struct_type(SILVER_COLUMNS)


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename every camelCase column to snake_case."""
    return df.withColumnsRenamed({c: snake_name(c) for c in df.columns})


def flatten_struct(df: DataFrame, struct: str, fields: Mapping[str, str]) -> DataFrame:
    """Replace ``struct`` by its ``fields`` under their new names; a null struct
    gives nulls, a field the struct lacks too."""
    present = set(df.schema[struct].dataType.fieldNames()) if struct in df.columns else set()
    lifted = [
        (F.col(f"{struct}.{src}") if src in present else F.lit(None).cast("string")).alias(dest)
        for src, dest in fields.items()
    ]
    kept = [F.col(f"`{c}`") for c in df.columns if c != struct]
    return df.select(*kept, *lifted)


def nested_to_json(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn list, map and struct columns into JSON text; null stays null."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    chosen = [f.name for f in df.schema if isinstance(f.dataType, nested)
              and (columns is None or f.name in columns)]
    return df.withColumns({c: F.to_json(F.col(c), {"ignoreNullFields": "false"}) for c in chosen})


def rename_keys(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns; names the table lacks are ignored."""
    return df.drop(*columns)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame, with_metadata: bool = False) -> list[str]:
    """Text columns; those starting with ``_`` hold lineage and are left out."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)
            and (with_metadata or not f.name.startswith("_"))]


def coerce_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lossy cast to double: what cannot be read becomes null."""
    return df.withColumns({c: number_or_null(c) for c in columns if c in df.columns})


def add_lineage(df: DataFrame, run_id: str, run_ts: str, source_file: Column | str | None = None,
                source_system: str = SOURCE_SYSTEM) -> DataFrame:
    """Append the five lineage columns.  ``source_file`` defaults to the name of
    the file each row was read from."""
    origin = F.col("_metadata.file_name") if source_file is None else source_file
    origin = F.col(origin) if isinstance(origin, str) else origin
    return df.withColumns({
        "_source_system": F.lit(source_system),
        "_source_file": origin,
        "_ingestion_ts": F.lit(run_ts),
        "_processing_ts": F.lit(run_ts),
        "_pipeline_run_id": F.lit(run_id),
    })


def enforce_schema(df: DataFrame, columns: Mapping[str, str] = SILVER_COLUMNS,
                   keep: Sequence[str] = ()) -> DataFrame:
    """Exactly ``columns``, in order and type (then ``keep``, untouched).

    Missing columns are added as null and extra ones dropped.  Values that do
    not fit their type become null one by one, so the types never drift.
    """
    present = set(df.columns)
    casts = {"bigint": whole_number_or_null, "double": number_or_null}

    def fitted(name: str, kind: str) -> Column:
        if name not in present:
            return F.lit(None).cast(kind).alias(name)
        if df.schema[name].dataType.simpleString() == kind and kind != "double":
            return F.col(name)
        return casts.get(kind, lambda c: F.col(c).try_cast(kind))(name).alias(name)

    return df.select(*[fitted(c, t) for c, t in columns.items()], *keep)
