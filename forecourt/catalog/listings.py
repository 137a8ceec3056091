"""The benchmark tables seen as vehicle listings.

Each column is one scalar expression valid in Spark SQL and in ANSI SQL alike,
so queries and their reference SQL start from the same listings.  Prices are
whole units and scores multiples of 1/8: their sums are exact in floating
point, in whatever order an engine adds them.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt.session import stage, tune

AS_OF_YEAR = 2001
AS_OF = "2001-06-01 00:00:00"
RUN_ID = "run-0001"
RUN_TS = "2001-06-01T00:00:00Z"

_BRANCH = "(case when p_size <= 25 then 0 when p_size <= 40 then 1 else p_size end)"
_DAY = "cast(cast(l_shipdate as date) as string)"

# from lineitem and part alone
VEHICLE = {
    "vin": "'V' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string)",
    "listing_id": "cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-' || "
                  "cast(l_partkey as string) || '-' || cast(l_suppkey as string)",
    "stock_number": "'S' || cast(l_suppkey as string) || '-' || cast(l_partkey as string)",
    "vehicle_condition": "case l_linestatus when 'O' then 'NEW' else 'USED' end",
    "year": "cast(year(l_shipdate) as bigint)",
    "make": "nullif(upper(p_brand), 'BRAND#13')",
    "model": "p_type",
    "trim": "upper(p_name)",
    "sub_trim": "case when p_size % 3 = 0 then null else 'S' || cast(p_size % 3 as string) end",
    "bodytype": "case when l_returnflag = 'A' then 'SEDAN' when l_returnflag = 'N' then 'SUV' "
                "when l_linenumber = 7 then null else 'TRUCK' end",
    "engine": "cast(p_size % 4 + 1 as string) || '.0L'",
    "displacement": "cast(1000 + p_size * 10 as string)",
    "drivetype": "case p_size % 3 when 0 then 'FWD' when 1 then 'RWD' else 'AWD' end",
    "transmission": "case when p_size % 2 = 0 then 'AUTOMATIC' else 'MANUAL' end",
    "fuel": "case p_size % 4 when 0 then 'ELECTRIC' when 1 then 'DIESEL' when 2 then 'HYBRID' "
            "else 'GASOLINE' end",
    "exterior_color": "upper(split_part(p_name, ' ', 1))",
    "interior_color": "case when l_linenumber % 2 = 0 then 'BLACK' else 'TAN' end",
    "bed_length": "case when l_returnflag = 'R' then 'LONG' else null end",
    "cab_type": "case when l_returnflag = 'R' and p_size > 25 then 'CREW' else null end",
    "mileage": "case when l_tax = 0 and l_discount = 0 then 0 "
               "when l_linenumber = 6 and l_tax = 0.08 then null "
               "else cast(floor(l_quantity * 4000) as bigint) end",
    "list_price": "case when l_linenumber = 5 and l_tax = 0.01 then null "
                  "else cast(floor(l_extendedprice + 0.5) as double) end",
    "current_price": "cast(floor(l_extendedprice * (1 - l_discount) + 0.5) as double)",
    "one_price": "case when l_discount = 0 then cast(floor(l_extendedprice + 0.5) as double) "
                 "else null end",
    "monthly_price": "cast(floor(l_extendedprice) as double)",
    "monthly_down_pct": "cast(10 as double)",
    "monthly_interest_rate": "cast(floor(l_tax * 100 + 0.5) as double)",
    "monthly_term_months": "case when l_linenumber = 4 then null "
                           "else cast(12 * (l_linenumber % 6) as bigint) end",
    "monthly_loan_amount": "cast(floor(l_extendedprice * 0.9) as double)",
    "monthly_down_amount": "cast(floor(l_extendedprice * 0.1) as double)",
    "monthly_payment": "cast(floor(l_extendedprice / 60) as double)",
    "mpg_city": "case when p_size % 4 = 0 then null else cast(p_size as double) end",
    "mpg_highway": "case when p_size % 4 = 0 then null else cast(p_size + 7 as double) end",
    "mpg_combined": "case when p_size % 4 = 0 then null else cast(p_size as double) + 3.5 end",
    "accident_history": """case l_linenumber % 4 when 0 then null
        when 1 then '{"icon":"accident","count":' || cast(p_size % 3 as string) || '}'
        when 2 then '{"icon":"noneReported"}' else '{"icon":null}' end""",
    "owner_history": """case l_linenumber % 5 when 0 then '{}' when 1 then '{"history":[]}'
        when 2 then '{"history":[{"owner":1}]}' when 3 then '{"history":[{"owner":1},{"owner":2}]}'
        else '[]' end""",
    "service_history": """case l_linenumber % 4 when 0 then null
        when 1 then '{"number":"12"}' when 2 then '{"number":3.7}'
        else '{"number":' || cast(p_size % 30 as string) || '}' end""",
    "service_records": "cast(p_size % 30 as bigint)",
    "vehicle_use_history": """case when l_linenumber = 3 then '{"use":"fleet"}' else null end""",
    "record_type": "'LISTING'",
    "dealer_carfax_id": f"'D' || cast(l_suppkey as string) || '-' || cast({_BRANCH} as string)",
    "dealer_avg_rating": f"cast((l_suppkey + {_BRANCH}) % 41 as double) / 8",
    "dealer_review_count": f"case when {_BRANCH} = 50 then null "
                           f"else cast((l_suppkey * 7 + {_BRANCH}) % 500 as bigint) end",
    "dealer_type": f"case when {_BRANCH} <= 1 then 'FRANCHISE' else 'INDEPENDENT' end",
    "image_count": "cast(l_linenumber * 3 as bigint)",
    "follow_count": "cast(l_orderkey % 37 as bigint)",
    "distance_to_dealer": "l_quantity",
    "tp_retention_score": "cast(floor(l_tax * 100 + 0.5) as double) / 4",
    "chiclet_badge": "case when l_discount > 0.05 then 'GREAT' else null end",
    "vdp_url": "'/vehicle/' || cast(l_orderkey as string) || '/' || cast(l_linenumber as string)",
    "top_options": """case l_linenumber % 4 when 0 then null when 1 then '[]'
        when 2 then '["abs"]' else '["abs","awd","gps"]' end""",
    "images": """'["' || cast(l_partkey as string) || '.jpg"]'""",
    "one_price_arrows": "cast(null as string)",
    "first_seen": f"case when l_linenumber = 3 then null else {_DAY} || 'T00:00:00Z' end",
    "_source_file": "'feed-' || l_returnflag || '.jsonl'",
}
# from the supplier's side
DEALER = {
    "dealer_name": f"s_name || ' #' || cast({_BRANCH} as string)",
    "dealer_address": "n_name || ' main road'",
    "dealer_city": "upper(n_name)",
    "dealer_state": "upper(r_name)",
    "dealer_zip": "cast(10000 + l_suppkey as string)",
    "dealer_phone": "'555-' || cast(l_suppkey as string)",
    "dealer_latitude": "cast(s_nationkey as double) + 0.25",
    "dealer_longitude": "-1 * cast(s_nationkey as double) * 2",
    "dealer_inventory_url": "'/dealer/' || cast(l_suppkey as string)",
}
LINEAGE = {
    "_source_system": f"'{fixed.SOURCE_SYSTEM}'",
    "_ingestion_ts": f"'{RUN_TS}'", "_processing_ts": f"'{RUN_TS}'",
    "_pipeline_run_id": f"'{RUN_ID}'",
}
# handles for building odd raw values
HANDLES = {"k": "l_linenumber", "q": "cast(l_quantity as int)", "day": _DAY}

EXPRESSIONS = {**VEHICLE, **DEALER, **LINEAGE, **HANDLES}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _ordered(names) -> list[str]:
    fixed_order = [c for c in fixed.SILVER_COLUMNS if c in names]
    return fixed_order + [c for c in names if c not in fixed.SILVER_COLUMNS]


_VIEWS: dict[tuple, DataFrame] = {}


def listings(spark: SparkSession, sf_dir: str, dealer: bool = False,
             handles: bool = False, alike: bool = False) -> DataFrame:
    """Listings in silver shape; ``dealer`` adds the columns that need the
    supplier, nation and region joins, ``alike`` puts similar listings of a task next to
    each other, those of one vehicle in their order.  The analysed plan is kept per session."""
    at = (spark.sparkContext.applicationId, id(spark), sf_dir, dealer, handles, alike)
    if at not in _VIEWS:
        _VIEWS[at] = _listings(spark, sf_dir, dealer, handles, alike)
    return _VIEWS[at]


def store_listings(spark: SparkSession, sf_dir: str) -> None:
    """Write the listings once, in a file a core, and let :func:`listings` read them from there."""
    whole = listings(spark, sf_dir, dealer=True)
    stored = stage(whole.repartition(spark.sparkContext.defaultParallelism), "listings")
    for dealer in (False, True):
        plain = listings(spark, sf_dir, dealer)
        _VIEWS[(spark.sparkContext.applicationId, id(spark), sf_dir, dealer, False, False)] = stored.select(*plain.columns)


def _first_of_vehicle(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` with ``_at``, which counts each task's rows, and ``_supp`` and ``_part``: supplier and part of
    the first of the task's rows that have the row's order and line.  Rows stay in their tasks."""
    keys = ("l_orderkey", "l_linenumber")
    rows = lineitem.withColumn("_at", F.monotonically_increasing_id()).sortWithinPartitions(*keys, "_at")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        before = None   # the last row so far
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if before is None else [before, batch]).combine_chunks()
            new = np.zeros(table.num_rows - 1, dtype=bool)
            for name in keys:
                key = table.column(name).fill_null(-1).to_numpy()
                new |= key[1:] != key[:-1]
            first = np.maximum.accumulate(np.where(np.concatenate(([True], new)), np.arange(table.num_rows), 0))
            for out, name in (("_supp", "l_suppkey"), ("_part", "l_partkey")):
                if before is None:
                    found = table.column(name).take(first)
                else:   # the row before knows its vehicle's first row already
                    known = pa.concat_arrays([before.column(out), batch.column(name)])
                    found = known.take(pa.array(first))
                table = table.set_column(table.schema.get_field_index(out), out, found)
            whole = table.combine_chunks().to_batches()[0]
            before = whole.slice(whole.num_rows - 1)
            yield whole if whole.num_rows == batch.num_rows else whole.slice(1)

    none = {out: F.lit(None).cast(rows.schema[name].dataType) for out, name in (("_supp", "l_suppkey"), ("_part", "l_partkey"))}
    rows = rows.withColumns(none)
    return rows.mapInArrow(run, rows.schema)


def _listings(spark: SparkSession, sf_dir: str, dealer: bool, handles: bool, alike: bool) -> DataFrame:
    sold = table(spark, sf_dir, "lineitem")
    rows = (_first_of_vehicle(sold) if alike else sold).join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"), "left")
    chosen = {**VEHICLE, **LINEAGE}
    if dealer:
        rows = (rows.join(table(spark, sf_dir, "supplier"),
                          F.col("l_suppkey") == F.col("s_suppkey"), "left")
                .join(table(spark, sf_dir, "nation"),
                      F.col("s_nationkey") == F.col("n_nationkey"), "left")
                .join(table(spark, sf_dir, "region"),
                      F.col("n_regionkey") == F.col("r_regionkey"), "left"))
        chosen.update(DEALER)
    if handles:
        chosen.update(HANDLES)
    if alike:   # after the joins (a sort below one is dropped), before the rows grow wide; no shuffle
        rows = rows.sortWithinPartitions("l_linenumber", "_supp", "_part", "_at")
    return rows.select(*[F.expr(chosen[c]).alias(c) for c in _ordered(chosen)])


def listings_sql() -> str:
    """The same listings (all columns and handles) as a SELECT."""
    columns = ",\n  ".join(f'{EXPRESSIONS[c]} AS "{c}"' for c in _ordered(EXPRESSIONS))
    return f"""SELECT {columns}
FROM lineitem
LEFT JOIN part ON l_partkey = p_partkey
LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN nation ON s_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey"""


def with_listings(body: str, *ctes: str) -> str:
    """``body`` with ``listings`` (and further CTEs built on it) in scope."""
    return "WITH " + ",\n".join([f"listings AS ({listings_sql()})", *ctes]) + "\n" + body


def clean_cte() -> str:
    """SQL of the cleaned listings."""
    texts = ", ".join(f"""coalesce(upper(trim("{c}")), '{fixed.NULL_TEXT}') AS "{c}" """
                      for c in fixed.GOLD_UPPER_TRIMMED)
    return f"""clean AS (SELECT * REPLACE ({texts},
      CAST(replace(first_seen, 'Z', '') AS TIMESTAMP) AS first_seen)
    FROM listings
    WHERE current_price > 0 AND year BETWEEN {fixed.FIRST_MODEL_YEAR} AND {AS_OF_YEAR + 1}
      AND mileage >= 0)"""


def r(expression: str, digits: int) -> str:
    """SQL: round half-even the way the library does."""
    return f"(round_even(({expression})::DOUBLE * {10 ** digits}, 0) / {10 ** digits})"
