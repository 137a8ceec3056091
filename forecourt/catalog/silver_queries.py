"""Raw feed, silver layer, sinks, profiles and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt import functions as fn
from forecourt.catalog.gold_queries import clean, gold_sql
from forecourt.catalog.listings import (AS_OF, AS_OF_YEAR, RUN_ID, RUN_TS, listings, r, table,
                                        with_listings)
from forecourt.operators import frequency, keys, routing, shape
from forecourt.plans import coverage, jobs, profile, quality, silver
from forecourt.session import fresh_path, path_exists, stage
from forecourt.sources import manifest, readers, writers
from forecourt.sources.listing import file_listing
from forecourt.sources.state import rename
from forecourt.streaming.incremental import incremental_silver_stream

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build
    return register


# --- the raw feed: listings as JSON lines with faults in them ----------------

# raw values that differ from the silver ones, over listing columns and handles
FAULTS = {
    "vin": "case when k = 7 and q % 5 = 0 then null when k = 7 and q % 5 = 1 then '  ' else vin end",
    "year": "case when k = 6 and q % 10 = 0 then null when k = 6 and q % 10 = 1 then 1899 "
            "when k = 6 and q % 10 = 2 then 2031 else year end",
    "mileage": "case when k = 5 and q % 10 = 3 then -1 else mileage end",
    "dealer_latitude": "case when k = 2 then null else dealer_latitude end",
    "first_seen": "case when k = 1 then day || 'T00:00:00Z' when k = 2 then day || 'T08:00:00Z' "
                  "when k = 3 then null else day || 'T00:00:00Z' end",
}
FIRST_SEEN_TEXT = ("case when k = 1 then day when k = 2 then day || 'T10:00:00+02:00' "
                   "when k = 3 then 'garbage' else day || 'T00:00:00Z' end")
CORRUPT = "k = 4 and q = 17"
BLANK = "k = 4 and q = 18"
SPLICED = {"accidentHistory": "accident_history", "ownerHistory": "owner_history",
           "serviceHistory": "service_history", "vehicleUseHistory": "vehicle_use_history",
           "topOptions": "top_options", "images": "images"}

_FEEDS: dict[tuple[str, str], str] = {}


def _camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(word.capitalize() for word in rest)


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(feed, line): every listing as nested JSON text, faults included.  Similar lines follow
    each other: a compressed file finds only what repeats within its last 32 kB."""
    rows = listings(spark, sf_dir, dealer=True, handles=True, alike=True)
    rows = rows.withColumns({f"raw_{c}": F.expr(e) for c, e in FAULTS.items() if c != "first_seen"})
    padded = {c: F.concat(F.lit(" \t"), F.lower(c), F.lit("  ")) for c in fixed.SILVER_UPPER_TRIMMED}
    special = {
        "vin": F.col("raw_vin"), "mileage": F.col("raw_mileage"),
        "year": F.when(F.col("k") == 3, F.concat(F.col("raw_year").cast("string"), F.lit(".0")))
                 .otherwise(F.col("raw_year").cast("string")),
        "vehicleCondition": F.lower("vehicle_condition"),
        "firstSeen": F.expr(FIRST_SEEN_TEXT),
    }
    nested = set(fixed.DEALER_FIELDS.values()) | set(fixed.MONTHLY_FIELDS.values())
    plain = []
    for camel in fixed.RAW_SCALARS:
        source = {"id": "listing_id"}.get(camel, fn.snake_name(camel))
        if camel in SPLICED or camel == "onePriceArrows" or source in nested:
            continue
        plain.append(special.get(camel, padded.get(source, F.col(source))).alias(camel))
    dealer_values = {**{c: padded.get(c, F.col(c)) for c in fixed.DEALER_FIELDS.values()},
                     "dealer_zip": F.concat("dealer_zip", F.lit("-1234")),
                     "dealer_latitude": F.when(F.col("k") == 2, F.lit("abc"))
                     .otherwise(F.col("dealer_latitude").cast("string"))}
    dealer = F.struct(*[dealer_values[c].alias(f) for f, c in fixed.DEALER_FIELDS.items()])
    monthly = F.struct(*[F.col(c).alias(f) for f, c in fixed.MONTHLY_FIELDS.items()])
    body = F.to_json(F.struct(*plain, dealer.alias("dealer"), monthly.alias("monthlyPaymentEstimate"),
                              F.lit(1).alias("sortTPScore"), F.lit("x").alias("unknownKey")))
    rows, pieces = rows.withColumn("body", body), [F.lit("{")]
    for camel, column in SPLICED.items():
        pieces += [F.lit(f'"{camel}":'), F.coalesce(column, F.lit("null")), F.lit(",")]
    line = F.concat(*pieces, F.expr("substring(body, 2)"))
    line = F.when(F.expr(CORRUPT), F.substring(line, 1, 30)).when(F.expr(BLANK), F.lit("")).otherwise(line)
    return rows.select(F.substring("_source_file", 6, 1).alias("feed"), line.alias("value"))


def raw_feed(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the raw feed, written once per session and table folder."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _FEEDS:
        path = fresh_path(spark, "raw-feed")
        write_feed(raw_lines(spark, sf_dir), path)
        _FEEDS[at] = path
    return _FEEDS[at]


FEED_GLOB = "*.txt*"
FEED_LINES = 1_000_000   # of a file at most: a compressed file is read by one task
FEED_LEVEL = "SEVEN"     # of gzip: the best level takes twice the time to save a twentieth
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def write_feed(lines: DataFrame, path: str) -> None:
    """Raw lines as compressed text, a folder a feed.  A task keeps a file of each feed open:
    the lines, ten times as large as the files, are not sorted by feed (and spilled) first."""
    conf = lines.sparkSession.conf
    before = conf.get(_WRITERS, None)
    conf.set(_WRITERS, "8")
    try:
        lines.write.partitionBy("feed").options(**{
            "compression": "gzip", "zlib.compress.level": FEED_LEVEL, "maxRecordsPerFile": FEED_LINES}).text(path)
    finally:
        conf.unset(_WRITERS) if before is None else conf.set(_WRITERS, before)


def feed_name(path):
    """Source file of a raw row: its feed."""
    return F.concat(F.lit("feed-"), F.regexp_extract(path, "feed=([^/]+)", 1), F.lit(".jsonl"))


def scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.jsonl_scan(spark, raw_feed(spark, sf_dir), glob=FEED_GLOB)


def scanned_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.listing_scan(spark, raw_feed(spark, sf_dir), glob=FEED_GLOB)


_RUNS: dict[tuple[str, str], tuple[str, jobs.RunResult]] = {}


def silver_run(spark: SparkSession, sf_dir: str) -> tuple[str, jobs.RunResult]:
    """Root of a silver lake filled from the feed, once per session and folder."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _RUNS:
        root = fresh_path(spark, "silver-lake")
        result = jobs.run_silver(spark, raw_feed(spark, sf_dir), root, run_id=RUN_ID, run_ts=RUN_TS,
                                 source_file=feed_name, glob=FEED_GLOB)
        _RUNS[at] = (root, result)
    return _RUNS[at]


# reference SQL of the silver layer
_RAW = ", ".join(f'{e} AS "{c}"' for c, e in FAULTS.items())
RAW_CTE = f"""raw AS (SELECT * REPLACE ({_RAW}) FROM listings WHERE NOT ({CORRUPT}) AND NOT ({BLANK}))"""
REASON = """(CASE WHEN vin IS NULL OR trim(vin) = '' THEN 'missing_vin;' ELSE '' END
  || CASE WHEN year IS NULL OR year < 1900 OR year > 2030 THEN 'invalid_year;' ELSE '' END
  || CASE WHEN mileage < 0 THEN 'negative_mileage;' ELSE '' END)"""
MARKED_CTE = f"""marked AS (SELECT *, {REASON} AS _rejection_reason FROM raw)"""
VALID_CTE = """valid AS (SELECT * EXCLUDE (_rejection_reason, k, q, day) FROM marked WHERE _rejection_reason = '')"""
SILVER_CTES = (RAW_CTE, MARKED_CTE, VALID_CTE)
NO_TEXT = "'missing_vin;invalid_year;'"


def silver_sql(body: str, *ctes: str) -> str:
    return with_listings(body, *SILVER_CTES, *ctes)


def silver_frame(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return silver.silver_transform(scanned_listings(spark, sf_dir), RUN_ID, RUN_TS,
                                   source_file=feed_name(F.col("_metadata.file_path")))


# --- scans and silver transform ----------------------------------------------

@query("jsonl_scan", with_listings(f"""
SELECT substr(_source_file, 6, 1) AS feed, count(*) FILTER (NOT ({BLANK})) AS rows,
  count(*) FILTER ({CORRUPT}) AS corrupt,
  count({FAULTS['vin']}) FILTER (NOT ({BLANK}) AND NOT ({CORRUPT})) AS with_vin
FROM listings GROUP BY 1"""))
def jsonl_scan(spark, sf_dir):
    rows = scanned(spark, sf_dir)
    return rows.groupBy(F.regexp_extract("_metadata.file_path", "feed=([^/]+)", 1).alias("feed")).agg(
        F.count("*").alias("rows"), F.count(readers.CORRUPT).alias("corrupt"),
        F.count_if(F.col("vin").isNotNull() & F.col(readers.CORRUPT).isNull()).alias("with_vin"))


_SILVER_LIST = ", ".join(f'"{c}"' for c in fixed.SILVER_COLUMNS)


@query("silver_transform", silver_sql(f"SELECT {_SILVER_LIST} FROM valid"))
def silver_transform(spark, sf_dir):
    return silver_frame(spark, sf_dir)[0]


@query("quarantine_split", silver_sql("""
SELECT _source_file, _rejection_reason, count(*) AS rows FROM (
  SELECT _source_file, _rejection_reason FROM marked WHERE _rejection_reason <> ''
  UNION ALL SELECT _source_file, 'corrupt_json;missing_vin;invalid_year;' FROM listings WHERE """
                                      + CORRUPT + ") GROUP BY ALL"))
def quarantine_split(spark, sf_dir):
    rejected = silver_frame(spark, sf_dir)[1]
    return rejected.groupBy("_source_file", "_rejection_reason").agg(F.count("*").alias("rows"))


@query("flatten_struct", with_listings(f"""
SELECT listing_id, dealer_carfax_id, dealer_name, dealer_phone, dealer_review_count::VARCHAR AS dealer_review_count,
  monthly_term_months::VARCHAR AS monthly_term_months
FROM listings WHERE NOT ({CORRUPT}) AND NOT ({BLANK})"""))
def flatten_struct(spark, sf_dir):
    raw = readers.parsed_structs(scanned(spark, sf_dir).where(F.col("id").isNotNull()))
    flat = shape.flatten_struct(shape.flatten_struct(raw, "dealer", fixed.DEALER_FIELDS),
                                "monthlyPaymentEstimate", fixed.MONTHLY_FIELDS)
    return shape.rename_keys(flat, fixed.RAW_RENAMES).select(
        "listing_id", "dealer_carfax_id", "dealer_name", "dealer_phone", "dealer_review_count",
        "monthly_term_months")


@query("nested_to_json", """
SELECT l_orderkey, '{"key":' || l_orderkey || ',"line":' || l_linenumber || '}' AS ids,
  '["' || l_returnflag || '","' || l_linestatus || '"]' AS flags, count(*) AS n
FROM lineitem GROUP BY ALL""")
def nested_to_json(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.struct(F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("line")).alias("ids"),
        F.array("l_returnflag", "l_linestatus").alias("flags"))
    return shape.nested_to_json(rows).groupBy("l_orderkey", "ids", "flags").agg(F.count("*").alias("n"))


@query("snake_case_columns", "SELECT c_custkey, c_name AS customer_name, c_acctbal AS acct_balusd FROM customer")
def snake_case_columns(spark, sf_dir):
    return shape.snake_case_columns(table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("cCustkey"), F.col("c_name").alias("customerName"),
        F.col("c_acctbal").alias("acctBALUSD"))).withColumnsRenamed(
            {"acct_balusd": "acct_balusd"})


@query("snake_case_values", r"""
SELECT p_partkey, lower(regexp_replace(regexp_replace(n, '([A-Z]+)([A-Z][a-z])', '\1_\2', 'g'),
  '([a-z0-9])([A-Z])', '\1_\2', 'g')) AS snake
FROM (SELECT p_partkey, split_part(p_name, ' ', 1) || upper(split_part(p_name, ' ', 2)) || 'Score' || p_type AS n FROM part)""")
def snake_case_values(spark, sf_dir):
    name = F.concat(F.split_part("p_name", F.lit(" "), F.lit(1)),
                    F.upper(F.split_part("p_name", F.lit(" "), F.lit(2))), F.lit("Score"), F.col("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", fn.snake_case(name).alias("snake"))


@query("rename_key", "SELECT l_orderkey AS listing_id, l_linenumber AS line FROM lineitem")
def rename_key(spark, sf_dir):
    return shape.rename_keys(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"),
                             {"l_orderkey": "listing_id", "l_linenumber": "line", "absent": "x"})


@query("add_lineage", f"""
SELECT o_orderkey, 'orders-feed' AS _source_system, 'orders.parquet' AS _source_file,
  '{RUN_TS}' AS _ingestion_ts, '{RUN_TS}' AS _processing_ts, '{RUN_ID}' AS _pipeline_run_id FROM orders""")
def add_lineage(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    return shape.add_lineage(rows, RUN_ID, RUN_TS, source_system="orders-feed").select(
        "o_orderkey", "_source_system", "_source_file", "_ingestion_ts", "_processing_ts",
        "_pipeline_run_id")


@query("run_identity", "SELECT count(*) AS rows, 1::BIGINT AS runs, true AS well_formed FROM orders")
def run_identity(spark, sf_dir):
    run_id, run_ts = jobs.run_identity()
    rows = shape.add_lineage(table(spark, sf_dir, "orders"), run_id, run_ts)
    form = (F.col("_pipeline_run_id").rlike("^[0-9a-f-]{36}$")
            & F.col("_ingestion_ts").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ$"))
    return rows.agg(F.count("*").alias("rows"), F.count_distinct("_pipeline_run_id").alias("runs"),
                    F.bool_and(form).alias("well_formed"))


@query("enforce_schema", """
SELECT 'P' || p_partkey AS vin, p_size::BIGINT AS year, NULL::BIGINT AS mileage,
  CASE WHEN p_size % 2 = 0 THEN p_size::BIGINT END AS image_count,
  p_retailprice AS list_price, CAST(NULL AS DOUBLE) AS current_price, p_brand AS make FROM part""")
def enforce_schema(spark, sf_dir):
    odd = table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey")).alias("vin"),
        F.concat(F.col("p_size"), F.lit(".0")).alias("year"), F.col("p_name").alias("mileage"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_size")).otherwise(F.col("p_size") + F.lit(0.5)).alias("image_count"),
        F.col("p_retailprice").cast("string").alias("list_price"), F.col("p_brand").alias("make"),
        F.lit(1).alias("not_in_schema"))
    kept = shape.enforce_schema(odd)
    return kept.select("vin", "year", "mileage", "image_count", "list_price", "current_price", "make")


@query("coerce_numbers", """
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size::DOUBLE END AS latitude FROM part""")
def coerce_numbers(spark, sf_dir):
    text = F.when(F.col("p_size") % 3 == 0, F.lit("abc")).otherwise(F.col("p_size").cast("string"))
    return shape.coerce_numbers(table(spark, sf_dir, "part").select("p_partkey", text.alias("latitude")),
                                ["latitude"])


@query("standardised_text", silver_sql("""
SELECT listing_id, vehicle_condition, make, "trim", dealer_city, dealer_zip, first_seen, dealer_latitude FROM raw"""))
def standardised_text(spark, sf_dir):
    flat = silver.standardise(silver.flatten(scanned_listings(spark, sf_dir).where(F.col("id").isNotNull())))
    return flat.select("listing_id", "vehicle_condition", "make", "trim", "dealer_city", "dealer_zip",
                       "first_seen", "dealer_latitude")


@query("filled_text", """
SELECT count(*) FILTER (trim(x) <> '') AS filled, count(*) FILTER (trim(x) = '') AS blank, count(*) AS rows
FROM (SELECT CASE WHEN n_chars % 3 = 0 THEN '   ' WHEN n_chars % 3 = 1 THEN NULL ELSE source END AS x FROM documents)""")
def filled_text(spark, sf_dir):
    n = F.col("n_chars") % 3
    rows = table(spark, sf_dir, "documents").select(
        F.when(n == 0, F.lit(" \t ")).when(n == 2, F.col("source")).alias("x"))
    return rows.agg(F.count_if(fn.is_filled("x")).alias("filled"), F.count_if(fn.is_blank("x")).alias("blank"),
                    F.count("*").alias("rows"))


@query("numeric_and_text_columns", """
SELECT 'numeric' AS kind, unnest(['l_orderkey','l_partkey','l_suppkey','l_linenumber','l_quantity',
  'l_extendedprice','l_discount','l_tax']) AS "column", (SELECT count(*) FROM lineitem) AS rows
UNION ALL SELECT 'text', unnest(['l_returnflag','l_linestatus']), (SELECT count(*) FROM lineitem)""")
def numeric_and_text_columns(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    entries = [F.struct(F.lit(kind).alias("kind"), F.lit(c).alias("column"))
               for kind, found in (("numeric", shape.numeric_columns(rows)),
                                   ("text", shape.string_columns(rows))) for c in found]
    return rows.agg(F.count("*").alias("rows")).select(
        F.explode(F.array(*entries)).alias("e"), "rows").select("e.kind", "e.column", "rows")


# --- keys --------------------------------------------------------------------

@query("keep_first", with_listings("""
SELECT vin, listing_id, current_price FROM listings
QUALIFY row_number() OVER (PARTITION BY vin ORDER BY _source_file, listing_id) = 1"""))
def keep_first(spark, sf_dir):
    rows = listings(spark, sf_dir).select("vin", "listing_id", "current_price", "_source_file")
    return keys.first_per_key(rows, ["vin"], ["_source_file", "listing_id"]).drop("_source_file")


@query("first_three_per_make", with_listings("""
SELECT make, listing_id FROM listings
QUALIFY row_number() OVER (PARTITION BY make ORDER BY current_price DESC, listing_id) <= 3"""))
def first_three_per_make(spark, sf_dir):
    rows = listings(spark, sf_dir).select("make", "listing_id", "current_price")
    return keys.first_per_key(rows, ["make"], [F.desc("current_price"), F.asc("listing_id")], 3).drop(
        "current_price")


@query("drop_known_keys", with_listings("""
SELECT vin, listing_id FROM listings WHERE _source_file = 'feed-R.jsonl'
  AND vin NOT IN (SELECT vin FROM listings WHERE _source_file <> 'feed-R.jsonl')"""))
def drop_known_keys(spark, sf_dir):
    rows = listings(spark, sf_dir).select("vin", "listing_id", "_source_file")
    batch = rows.where(F.col("_source_file") == "feed-R.jsonl")
    stored = rows.where(F.col("_source_file") != "feed-R.jsonl")
    return keys.drop_known_keys(batch, stored, "vin").select("vin", "listing_id")


@query("pending_source_files", """SELECT DISTINCT 'feed-' || l_returnflag || '.jsonl' AS source_file
FROM lineitem WHERE l_returnflag <> 'A'""")
def pending_source_files(spark, sf_dir):
    log = spark.createDataFrame([("feed-A.jsonl",)], "source_file string")
    paths = jobs.pending_files(spark, raw_feed(spark, sf_dir), log, FEED_GLOB, feed_name)
    found = readers.line_scan(spark, paths, FEED_GLOB)
    return found.select(feed_name(F.col("_metadata.file_path")).alias("source_file")).distinct()


@query("key_set_union", with_listings("SELECT DISTINCT vin FROM listings"))
def key_set_union(spark, sf_dir):
    rows = listings(spark, sf_dir).select("vin", "_source_file")
    batch, stored = (rows.where(F.col("_source_file") == "feed-R.jsonl").select("vin").distinct(),
                     rows.where(F.col("_source_file") != "feed-R.jsonl").select("vin").distinct())
    return frequency.union_all([stored, keys.drop_known_keys(batch, stored, "vin")])


# --- runs and sinks ----------------------------------------------------------

DEDUP_CTE = """stored AS (SELECT * FROM valid
  QUALIFY row_number() OVER (PARTITION BY vin ORDER BY _source_file) = 1)"""


@query("run_silver", silver_sql("""
SELECT vin, _source_file, year, _source_system, _pipeline_run_id FROM stored""", DEDUP_CTE))
def run_silver(spark, sf_dir):
    root, _ = silver_run(spark, sf_dir)
    return jobs.SilverLake(root).read(spark).select(
        "vin", "_source_file", "year", "_source_system", "_pipeline_run_id")


@query("run_statistics", silver_sql(f"""
SELECT s._source_file AS source_file, raw, coalesce(silver, 0) AS silver, raw - valid AS quarantined,
  valid - coalesce(silver, 0) AS cross_dedup
FROM (SELECT _source_file, count(*) AS raw FROM listings WHERE NOT ({BLANK}) GROUP BY 1) s
LEFT JOIN (SELECT _source_file, count(*) AS valid FROM valid GROUP BY 1) v USING (_source_file)
LEFT JOIN (SELECT _source_file, count(*) AS silver FROM stored GROUP BY 1) t USING (_source_file)""", DEDUP_CTE))
def run_statistics(spark, sf_dir):
    _, result = silver_run(spark, sf_dir)
    return result.details.select("source_file", "raw", "silver", "quarantined", "cross_dedup")


@query("silver_second_run", silver_sql("SELECT count(*) AS rows, count(DISTINCT vin) AS vins FROM stored",
                                       DEDUP_CTE))
def silver_second_run(spark, sf_dir):
    """Running again over the same files changes nothing."""
    root, _ = silver_run(spark, sf_dir)
    jobs.run_silver(spark, raw_feed(spark, sf_dir), root, run_id="run-0002", run_ts=RUN_TS,
                    source_file=feed_name, glob=FEED_GLOB)
    return jobs.SilverLake(root).read(spark).agg(
        F.count("*").alias("rows"), F.count_distinct("vin").alias("vins"))


@query("full_refresh", silver_sql("SELECT make, count(*) AS rows FROM stored GROUP BY make", DEDUP_CTE.replace(
    "ORDER BY _source_file", "ORDER BY _source_file, listing_id")))
def full_refresh(spark, sf_dir):
    """Replace a table twice; which of a feed's duplicates stays is fixed here by
    counting makes of the first listing id."""
    path, row = fresh_path(spark, "refreshed"), "_row"
    valid = stage(silver_frame(spark, sf_dir)[0].withColumn(row, F.monotonically_increasing_id()), "valid-rows")
    order = ["_source_file", "listing_id"]
    for _ in range(2):
        firsts = stage(keys.first_per_key(valid.select("vin", *order, row), ["vin"], order).select(row), "first-rows")
        writers.write_silver(keys.pick_rows(valid, firsts, row).drop(row), path, RUN_ID, full_refresh=True)
    return readers.parquet_scan(spark, path, shape.SILVER).groupBy("make").agg(F.count("*").alias("rows"))


@query("quarantine_scan", silver_sql(f"""
SELECT _source_file, _rejection_reason, count(*) AS rows FROM (
  SELECT _source_file, _rejection_reason FROM marked WHERE _rejection_reason <> ''
  UNION ALL SELECT _source_file, 'corrupt_json;missing_vin;invalid_year;' FROM listings WHERE {CORRUPT})
GROUP BY ALL"""))
def quarantine_scan(spark, sf_dir):
    root, _ = silver_run(spark, sf_dir)
    return readers.quarantine_scan(spark, root).groupBy("_source_file", "_rejection_reason").agg(
        F.count("*").alias("rows"))


def _lake_with_rejects(spark: SparkSession, sf_dir: str) -> str:
    """A table of orders with a quarantine folder below its root."""
    root = fresh_path(spark, "orders-lake")
    orders = table(spark, sf_dir, "orders")
    good, bad = routing.quarantine(orders, {"late": F.col("o_orderpriority") == "1-URGENT"})
    writers.write_parquet(good, root)
    writers.write_parquet(bad, f"{root}/{fixed.QUARANTINE_DIR}")
    return root


@query("parquet_scan", """SELECT o_orderpriority, count(*) AS rows FROM orders
WHERE o_orderpriority <> '1-URGENT' GROUP BY 1""")
def parquet_scan(spark, sf_dir):
    return readers.parquet_scan(spark, _lake_with_rejects(spark, sf_dir)).groupBy("o_orderpriority").agg(
        F.count("*").alias("rows"))


@query("merged_files", """SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'late;' END AS _rejection_reason,
  count(*) AS rows, sum(o_orderkey)::BIGINT AS keys FROM orders GROUP BY 1""")
def merged_files(spark, sf_dir):
    root = _lake_with_rejects(spark, sf_dir)
    merged = readers.merged_scan(spark, [root, f"{root}/{fixed.QUARANTINE_DIR}"])
    out = fresh_path(spark, "merged")
    writers.compact(merged, out)
    return spark.read.parquet(out).groupBy("_rejection_reason").agg(
        F.count("*").alias("rows"), F.sum("o_orderkey").alias("keys"))


@query("text_list_scan", "SELECT c_name AS value FROM customer WHERE c_nationkey % 5 <> 0")
def text_list_scan(spark, sf_dir):
    path = fresh_path(spark, "names")
    padded = F.when(F.col("c_nationkey") % 5 == 0, F.lit("  ")).otherwise(
        F.concat(F.lit(" "), F.col("c_name"), F.lit("\t")))
    table(spark, sf_dir, "customer").select(padded.alias("value")).write.text(path)
    return readers.text_list_scan(spark, path)


@query("parquet_sink", "SELECT l_returnflag, count(*) AS rows, sum(l_orderkey)::BIGINT AS keys, 2::BIGINT * (SELECT count(*) FROM lineitem) AS written FROM lineitem GROUP BY 1")
def parquet_sink(spark, sf_dir):
    path = fresh_path(spark, "sink")
    rows = table(spark, sf_dir, "lineitem")
    written = sum(writers.write_parquet(rows, path) for _ in range(2))
    return spark.read.parquet(path).groupBy("l_returnflag").agg(
        F.count("*").alias("rows"), F.sum("l_orderkey").alias("keys"), F.lit(written).cast("bigint").alias("written"))


@query("quarantine_sink", """SELECT 'file-' || c_mktsegment AS _source_file, count(*) AS rows
FROM customer WHERE c_acctbal < 0 GROUP BY 1""")
def quarantine_sink(spark, sf_dir):
    root = fresh_path(spark, "rejects")
    rows = table(spark, sf_dir, "customer").withColumn("_source_file", F.concat(F.lit("file-"), "c_mktsegment"))
    bad = routing.quarantine(rows, {"negative_balance": F.col("c_acctbal") < 0})[1]
    for _ in range(2):  # the same run's rejects again replace the first ones
        writers.write_quarantine(bad, root, "run-1")
    return spark.read.parquet(f"{root}/{fixed.QUARANTINE_DIR}").groupBy("_source_file").agg(
        F.count("*").alias("rows"))


_GOLD: dict[tuple[str, str], str] = {}


def gold_run(spark: SparkSession, sf_dir: str) -> str:
    """A gold lake built from the listings, once per session and folder."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _GOLD:
        silver_root, gold_root = fresh_path(spark, "silver-src"), fresh_path(spark, "gold-lake")
        writers.write_silver(listings(spark, sf_dir, dealer=True).select(*fixed.SILVER_COLUMNS),
                             jobs.SilverLake(silver_root).listings, RUN_ID)
        jobs.run_gold(spark, silver_root, gold_root, run_id=RUN_ID, run_ts=RUN_TS, as_of=AS_OF,
                      as_of_year=AS_OF_YEAR)
        _GOLD[at] = gold_root
    return _GOLD[at]


_GOLD_SIZES = f"""SELECT 'gold_listings_enriched' AS "table", (SELECT count(*) FROM clean) AS rows, 70 AS columns
UNION ALL SELECT 'gold_market_summary', (SELECT count(*) FROM (SELECT DISTINCT make, model, year, bodytype FROM clean)), 22
UNION ALL SELECT 'gold_price_segments', (SELECT count(*) FROM (SELECT DISTINCT
   CASE WHEN current_price < 10000 THEN 0 WHEN current_price < 20000 THEN 1 WHEN current_price < 35000 THEN 2
     WHEN current_price < 60000 THEN 3 WHEN current_price < 100000 THEN 4 ELSE 5 END FROM clean)), 13
UNION ALL SELECT 'gold_dealer_performance', (SELECT count(*) FROM (SELECT DISTINCT {', '.join(fixed.DEALER_KEYS)}
   FROM clean WHERE {' AND '.join(f'{k} IS NOT NULL' for k in fixed.DEALER_KEYS)})), 20
UNION ALL SELECT 'gold_depreciation_curve', (SELECT count(*) FROM (SELECT DISTINCT make, year FROM clean
   WHERE {AS_OF_YEAR} - year BETWEEN 0 AND 25)), 10"""


@query("run_gold", gold_sql(_GOLD_SIZES))
def run_gold(spark, sf_dir):
    root = gold_run(spark, sf_dir)
    names = ["gold_listings_enriched", "gold_market_summary", "gold_price_segments",
             "gold_dealer_performance", "gold_depreciation_curve"]
    stored = {n: spark.read.parquet(f"{root}/{n}") for n in names}
    return frequency.union_all([
        t.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table"), "rows",
                                                 F.lit(len(t.columns)).alias("columns"))
        for n, t in stored.items()])


@query("run_metadata", gold_sql(f'SELECT \'{RUN_ID}\' AS run_id, s.*, false AS skipped FROM ({_GOLD_SIZES}) s'))
def run_metadata(spark, sf_dir):
    log = spark.read.schema(jobs.RUN_LOG_SCHEMA).parquet(f"{gold_run(spark, sf_dir)}/{fixed.META_DIR}/run_log")
    return log.select("run_id", "table", "rows", "columns", "skipped")


@query("gold_sink", gold_sql("""SELECT make, count(*) AS rows, max(current_price) AS dearest FROM clean GROUP BY make"""))
def gold_sink(spark, sf_dir):
    """Write several tables, the empty one is skipped; read one back."""
    root = fresh_path(spark, "gold-sink")
    rows = clean(spark, sf_dir)
    by_make = rows.groupBy("make").agg(F.count("*").alias("rows"), F.max("current_price").alias("dearest"))
    none = rows.where(F.col("current_price") < 0)
    log = jobs.save_tables(spark, root, {"by_make": (by_make, rows), "nothing": (none, none)}, RUN_ID, RUN_TS)
    kept = log.where(~F.col("skipped")).select("table").first()["table"]
    return spark.read.parquet(f"{root}/{kept}")


@query("peek_first_row", """
SELECT unnest(['o_orderkey', 'o_orderstatus', 'o_orderpriority']) AS "column",
  unnest([o_orderkey::VARCHAR, o_orderstatus, o_orderpriority]) AS value
FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 1)""")
def peek_first_row(spark, sf_dir):
    return readers.peek(table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority").orderBy("o_orderkey"))


EVENT_LINE = """'{"event_id":' || event_id || ',"user":' || user_id || ',"type":"' || event_type || '","props":' || props || '}'"""
EVENT_LIMIT = 64 * 1024


def _event_parts(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_path(spark, "event-parts")
    line = F.expr(EVENT_LINE.replace("|| event_id ||", "|| cast(event_id as string) ||")
                  .replace("|| user_id ||", "|| cast(user_id as string) ||"))
    writers.write_sized_jsonl(table(spark, sf_dir, "events"), path, line=line, limit_bytes=EVENT_LIMIT)
    return path


_EVENT_TOTALS = f"""count(*) AS total_rows, sum(strlen({EVENT_LINE}) + 1)::BIGINT AS total_bytes"""


@query("sized_jsonl_sink", f"""SELECT {_EVENT_TOTALS}, true AS all_within_limit FROM events""")
def sized_jsonl_sink(spark, sf_dir):
    files = manifest.dataset_manifest(spark, _event_parts(spark, sf_dir), EVENT_LIMIT)
    return files.agg(F.sum("row_count").alias("total_rows"), F.sum("size_bytes").alias("total_bytes"),
                     F.bool_and(F.col("size_bytes") <= EVENT_LIMIT).alias("all_within_limit"))


@query("dataset_manifest", f"""SELECT {_EVENT_TOTALS},
  bit_xor(('0x' || substr(md5({EVENT_LINE}), 1, 15))::BIGINT) AS checksum FROM events""")
def dataset_manifest(spark, sf_dir):
    files = manifest.dataset_manifest(spark, _event_parts(spark, sf_dir), EVENT_LIMIT)
    return files.agg(F.sum("row_count").alias("total_rows"), F.sum("size_bytes").alias("total_bytes"),
                     F.bit_xor("checksum").alias("checksum"))


_EVENT_SUM = f"""bit_xor(('0x' || substr(md5({EVENT_LINE}), 1, 15))::BIGINT)"""


@query("manifest_files", f"""SELECT event_type AS folder, count(*) AS row_count, sum(strlen({EVENT_LINE}) + 1)::BIGINT AS size_bytes,
  {_EVENT_SUM} AS checksum, sum(strlen({EVENT_LINE}) + 1) >= {EVENT_LIMIT} AS is_complete FROM events GROUP BY 1
UNION ALL SELECT 'nothing', 0, 0, 0, false""")
def manifest_files(spark, sf_dir):
    """Every file of a folder a kind of event, and a file without lines."""
    path = fresh_path(spark, "event-files")
    line = F.expr(EVENT_LINE.replace("|| event_id ||", "|| cast(event_id as string) ||")
                  .replace("|| user_id ||", "|| cast(user_id as string) ||"))
    lines = table(spark, sf_dir, "events").select(line.alias("value"), F.col("event_type").alias("kind"))
    lines.repartition("kind").write.partitionBy("kind").text(path)
    _put(spark, f"{path}/kind=nothing/empty.txt", b"")
    files = manifest.dataset_manifest(spark, path, EVENT_LIMIT)
    return files.select(F.regexp_extract("filepath", "kind=([^/]+)", 1).alias("folder"), "row_count", "size_bytes", "checksum", "is_complete")


@query("compacted_files", "SELECT count(*) AS rows, sum(l_orderkey)::BIGINT AS keys, true AS few, true AS sized FROM lineitem")
def compacted_files(spark, sf_dir):
    """Many small files packed into files of a target size, in the place of the table."""
    path = fresh_path(spark, "small-files")
    table(spark, sf_dir, "lineitem").repartition(24).write.parquet(path)
    target = writers.listed_bytes(spark, path) // 4
    writers.compact_files(spark, [path], path, target)
    sizes = file_listing(spark, path, "*.parquet").agg((F.count("*") <= 8).alias("few"), (F.max("length") <= 1.5 * target).alias("sized"))
    return spark.read.parquet(path).agg(F.count("*").alias("rows"), F.sum("l_orderkey").alias("keys")).join(sizes)


@query("incremental_silver_stream", silver_sql("SELECT vin, year, _source_system FROM stored", DEDUP_CTE))
def incremental_silver_stream_(spark, sf_dir):
    """Feed files as a stream of small batches, then once more: same table."""
    root = fresh_path(spark, "stream-lake")
    for _ in range(2):
        incremental_silver_stream(spark, raw_feed(spark, sf_dir), f"{root}/silver", f"{root}/checkpoint",
                                  source_file=feed_name, glob=FEED_GLOB,
                                  files_per_batch=8).awaitTermination()
    return jobs.SilverLake(f"{root}/silver").read(spark).select("vin", "year", "_source_system")


def _stream_lake(spark: SparkSession, sf_dir: str) -> str:
    """A lake filled by the stream from files that are known by their paths."""
    root = fresh_path(spark, "stream-rejects")
    incremental_silver_stream(spark, raw_feed(spark, sf_dir), f"{root}/silver", f"{root}/checkpoint",
                              glob=FEED_GLOB, files_per_batch=2).awaitTermination()
    return f"{root}/silver"


@query("stream_quarantine", silver_sql("SELECT _rejection_reason, count(*) AS rows FROM rejects GROUP BY 1",
       f"""rejects AS (SELECT _rejection_reason FROM marked WHERE _rejection_reason <> ''
  UNION ALL SELECT 'corrupt_json;missing_vin;invalid_year;' FROM listings WHERE {CORRUPT})"""))
def stream_quarantine(spark, sf_dir):
    """Rejects of all batches, several files of the same name among them."""
    found = readers.quarantine_scan(spark, _stream_lake(spark, sf_dir))
    return found.groupBy("_rejection_reason").agg(F.count("*").alias("rows"))


@query("stream_file_log", silver_sql(f"""
SELECT substr(_source_file, 6, 1) AS feed, count(*) AS raw FROM listings WHERE NOT ({BLANK}) GROUP BY 1"""))
def stream_file_log(spark, sf_dir):
    """The stream logs its files; a batch run on the same lake then finds none to read."""
    root = _stream_lake(spark, sf_dir)
    again = jobs.run_silver(spark, raw_feed(spark, sf_dir), root, run_id="again", run_ts=RUN_TS, glob=FEED_GLOB)
    if again.counts["files_processed"]:
        raise AssertionError("files of the stream were read again")
    feed = F.regexp_extract("source_file", "feed=([^/]+)", 1)
    return jobs.SilverLake(root).read_log(spark).groupBy(feed.alias("feed")).agg(F.sum("raw").alias("raw"))


@query("files_known_by_path", silver_sql(f"""
SELECT feed, raw, raw - valid AS quarantined
FROM (SELECT substr(_source_file, 6, 1) AS feed, count(*) AS raw FROM listings WHERE NOT ({BLANK}) GROUP BY 1)
JOIN (SELECT substr(_source_file, 6, 1) AS feed, count(*) AS valid FROM valid GROUP BY 1) USING (feed)"""))
def files_known_by_path(spark, sf_dir):
    """One feed folder after the other, all with files of the same names."""
    root, raw = fresh_path(spark, "by-path"), raw_feed(spark, sf_dir)
    for run, glob in (("one", "feed=A"), ("two", "feed=N"), ("three", "feed=R"), ("four", "feed=R")):
        jobs.run_silver(spark, f"{raw}/{glob}", root, run_id=run, run_ts=RUN_TS, glob=FEED_GLOB,
                        source_file=jobs.path_below(spark, raw))
    feed = F.regexp_extract("source_file", "feed=([^/]+)", 1)
    return jobs.SilverLake(root).read_log(spark).groupBy(feed.alias("feed")).agg(
        F.sum("raw").alias("raw"), F.sum("quarantined").alias("quarantined"))


# folder of each feed, with characters that paths and patterns treat apart
ODD_FOLDERS = {"A": "my feed 100%", "N": "part[1]{x,y}?", "R": "a%20b+\u00e9"}


def _odd_feed(spark: SparkSession, sf_dir: str) -> str:
    """The raw feed in folders of odd names."""
    path = fresh_path(spark, "odd-feed")
    write_feed(raw_lines(spark, sf_dir), path)
    for feed, folder in ODD_FOLDERS.items():
        if path_exists(spark, f"{path}/feed={feed}"):
            rename(spark, f"{path}/feed={feed}", f"{path}/{folder}")
    return path


def _put(spark: SparkSession, path: str, data: bytes) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where)
    for byte in data:
        out.write(byte)
    out.close()


_FOLDER_SQL = "CASE substr(_source_file, 6, 1) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ODD_FOLDERS.items()) + " END"


@query("files_of_any_name", silver_sql(f"""
SELECT folder, raw, coalesce(silver, 0) AS silver, raw - valid AS quarantined, true AS read_once
FROM (SELECT {_FOLDER_SQL} AS folder, count(*) AS raw FROM listings WHERE NOT ({BLANK}) GROUP BY 1)
LEFT JOIN (SELECT {_FOLDER_SQL} AS folder, count(*) AS valid FROM valid GROUP BY 1) USING (folder)
LEFT JOIN (SELECT {_FOLDER_SQL} AS folder, count(*) AS silver FROM stored GROUP BY 1) USING (folder)""",
       """stored AS (SELECT * FROM valid
  QUALIFY row_number() OVER (PARTITION BY vin ORDER BY """ + _FOLDER_SQL + """) = 1)"""))
def files_of_any_name(spark, sf_dir):
    """Names with blanks, percent signs, brackets and letters of any kind; each file is read once."""
    raw, root = _odd_feed(spark, sf_dir), fresh_path(spark, "odd-lake")
    for run in ("one", "two"):
        result = jobs.run_silver(spark, raw, root, run_id=run, run_ts=RUN_TS, glob=FEED_GLOB)
    folder = F.regexp_extract("source_file", "^([^/]*)/", 1)
    return jobs.SilverLake(root).read_log(spark).groupBy(folder.alias("folder")).agg(
        F.sum("raw").alias("raw"), F.sum("silver").alias("silver"), F.sum("quarantined").alias("quarantined"),
        F.lit(result.counts["files_processed"] == 0).alias("read_once"))


@query("unreadable_files", silver_sql(f"""
SELECT count(DISTINCT _source_file) AS files_processed, 1::BIGINT AS files_failed, 2::BIGINT AS files_skipped, false AS success,
  count(*) AS total_raw_records, 0::BIGINT AS pending_after, count(DISTINCT _source_file) + 3 AS known_after
FROM listings WHERE NOT ({BLANK})"""))
def unreadable_files(spark, sf_dir):
    """A file that cannot be read, one of blank lines and one of no bytes among the feeds."""
    raw, root = fresh_path(spark, "faulty-feed"), fresh_path(spark, "faulty-lake")
    write_feed(raw_lines(spark, sf_dir), raw)
    _put(spark, f"{raw}/blank lines.txt", b"\n  \n\n")
    _put(spark, f"{raw}/empty.txt", b"")
    _put(spark, f"{raw}/broken.txt.gz", b"not compressed")

    def named(path):
        feed = F.regexp_extract(path, "feed=([^/]+)", 1)
        return F.when(feed != "", feed).otherwise(F.element_at(F.split(path, "/"), -1))

    first, second = [jobs.run_silver(spark, raw, root, run_id=run, run_ts=RUN_TS, source_file=named, glob="*.txt*")
                     for run in ("one", "two")]
    found = ("files_processed", "files_failed", "files_skipped", "total_raw_records")
    return jobs.SilverLake(root).read_log(spark).agg(
        *[F.lit(first.counts[c]).cast("bigint").alias(c) for c in found], F.lit(first.success).alias("success"),
        F.lit(second.counts["files_processed"]).cast("bigint").alias("pending_after"),
        F.count_distinct("source_file").alias("known_after"))


@query("malformed_line_text", with_listings(f"""
SELECT _source_file, count(*) AS rows, 30 AS shortest, 30 AS longest FROM listings WHERE {CORRUPT} GROUP BY 1"""))
def malformed_line_text(spark, sf_dir):
    """The text of lines that are no JSON is kept with their reject."""
    root, _ = silver_run(spark, sf_dir)
    size = F.length(readers.RAW_TEXT)
    return (readers.quarantine_scan(spark, root, with_text=True).where(F.col(readers.RAW_TEXT).isNotNull())
            .groupBy("_source_file").agg(F.count("*").alias("rows"), F.min(size).alias("shortest"),
                                         F.max(size).alias("longest")))


# --- coverage ----------------------------------------------------------------

RANGES = [(1982, 1995), (1996, 1996), (1997, 1997), (1998, 1998)]
_RANGE_SQL = "(VALUES " + ", ".join(f"({a}, {b})" for a, b in RANGES) + ") y(year_min, year_max)"


def _order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "orders").groupBy(
        F.concat(F.col("o_custkey").cast("string"), F.lit("_"), F.year("o_orderdate"), F.lit("-"),
                 F.year("o_orderdate"), F.lit("_used")).alias("key")).agg(
        F.count("*").alias("count"), F.max(F.when(F.col("o_orderstatus") == "P", F.lit("failed"))).alias("error"))
    return coverage.log_entries(done, RUN_TS)


def _coverage(retry: bool):
    def run(spark, sf_dir):
        zips = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("value"))
        grid = coverage.coverage_grid(zips, "USED", RANGES)
        return coverage.open_work(grid, _order_log(spark, sf_dir), retry)
    return run


_GRID_SQL = f"""SELECT * FROM (SELECT c_custkey || '_' || year_min || '-' || year_max || '_used' AS key,
  c_custkey::VARCHAR AS zip, year_min, year_max, 'used' AS condition FROM customer, {_RANGE_SQL})
WHERE key NOT IN (SELECT o_custkey || '_' || year(o_orderdate) || '-' || year(o_orderdate) || '_used'
  FROM orders GROUP BY 1%s)"""
QUERIES["coverage_open_work"] = _coverage(False)
ORACLES["coverage_open_work"] = _GRID_SQL % ""
QUERIES["coverage_retry_errors"] = _coverage(True)
ORACLES["coverage_retry_errors"] = _GRID_SQL % " HAVING max(CASE WHEN o_orderstatus = 'P' THEN 1 END) IS NULL"


# --- profiles and reports ----------------------------------------------------

# every number and every text of the table but its lineage
PROFILED = [c for c, kind in fixed.SILVER_COLUMNS.items() if kind in ("bigint", "double")]
TEXTS = [c for c, kind in fixed.SILVER_COLUMNS.items() if kind == "string" and not c.startswith("_")]


def _each(columns, template: str) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in columns)


def _rounded(df: DataFrame, *names: str, digits: int = 3) -> DataFrame:
    return df.withColumns({c: fn.half_even(c, digits) for c in names})


@query("numeric_profile", with_listings(_each(PROFILED, f"""
SELECT '{{c}}' AS "column", count({{c}}) AS count, {r('avg({c})', 3)} AS mean, {r('stddev_samp({c})', 3)} AS std,
  min({{c}})::DOUBLE AS min, quantile_cont({{c}}::DOUBLE, 0.25) AS p25, quantile_cont({{c}}::DOUBLE, 0.5) AS p50,
  quantile_cont({{c}}::DOUBLE, 0.75) AS p75, max({{c}})::DOUBLE AS max, count(*) - count({{c}}) AS null_count,
  {r('(count(*) - count({c}))::DOUBLE / count(*) * 100', 2)} AS null_pct FROM listings""")))
def numeric_profile(spark, sf_dir):
    rows = profile.numeric_profile(listings(spark, sf_dir, dealer=True), PROFILED)
    return _rounded(rows, "mean", "std")


@query("string_profile", with_listings(_each(TEXTS, f"""
SELECT '{{c}}' AS "column", count({{c}}) AS non_null_count, count(*) FILTER (trim({{c}}) <> '') AS non_empty_count,
  count(*) - count({{c}}) AS null_count, {r('(count(*) - count({c}))::DOUBLE / count(*) * 100', 2)} AS null_pct,
  count(DISTINCT {{c}}) FILTER (trim({{c}}) <> '') AS unique_count FROM listings""")))
def string_profile(spark, sf_dir):
    return profile.string_profile(listings(spark, sf_dir, dealer=True), TEXTS).drop("top_values")


@query("top_text_values", with_listings(_each(TEXTS, """
SELECT '{c}' AS "column", {c} AS value, n FROM (
  SELECT {c}, count(*) AS n FROM listings WHERE trim({c}) <> '' GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10)""".replace(
    "SELECT '{c}'", "(SELECT '{c}'") + ")")))
def top_text_values(spark, sf_dir):
    best = profile.string_profile(listings(spark, sf_dir, dealer=True), TEXTS)
    return best.select("column", F.explode("top_values").alias("t")).select("column", "t.value", "t.n")


CATEGORIES = list(fixed.CATEGORY_FIELDS)


@query("category_counts", with_listings(_each(CATEGORIES, """
(SELECT '{c}' AS "column", coalesce({c}, '<null>') AS value, n FROM (
  SELECT {c}, count(*) AS n FROM listings GROUP BY 1 ORDER BY n DESC, 1 NULLS LAST LIMIT 20))""")))
def category_counts(spark, sf_dir):
    return profile.category_counts(listings(spark, sf_dir, dealer=True))


@query("table_shape", """SELECT count(*) AS rows, 11 AS columns, 1::BIGINT AS files FROM lineitem""")
def table_shape(spark, sf_dir):
    return profile.table_shape(table(spark, sf_dir, "lineitem"))


@query("schema_listing", """
SELECT (row_number() OVER () - 1)::INTEGER AS position, column_name AS "column",
  CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'timestamp'
  WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS dtype FROM (DESCRIBE lineitem)""")
def schema_listing(spark, sf_dir):
    return profile.schema_listing(table(spark, sf_dir, "lineitem"))


@query("column_completeness", with_listings(_each(TEXTS + PROFILED, f"""
SELECT '{{c}}' AS "column", count(*) - count({{c}}) AS null_count,
  count(*) FILTER (trim({{c}}::VARCHAR) = '') AS empty_string_count, count(*) - count({{c}}) AS total_missing,
  {r('(count(*) - count({c}))::DOUBLE / count(*) * 100', 2)} AS missing_pct, count({{c}}) AS non_null_count
FROM listings""")))
def column_completeness(spark, sf_dir):
    return quality.column_completeness(listings(spark, sf_dir, dealer=True), TEXTS + PROFILED).drop("dtype")


@query("text_samples", with_listings(_each(TEXTS, """
SELECT '{c}' AS "column", count(DISTINCT {c}) AS unique_count,
  coalesce((SELECT string_agg(v, '|' ORDER BY v) FROM (SELECT DISTINCT {c} AS v FROM listings WHERE {c} IS NOT NULL ORDER BY 1 LIMIT 5)), '') AS samples
FROM listings""")))
def text_samples(spark, sf_dir):
    return quality.text_samples(listings(spark, sf_dir, dealer=True), TEXTS).select(
        "column", "unique_count", F.array_join("sample_values", "|").alias("samples"))


@query("number_ranges", with_listings(_each(PROFILED, f"""
SELECT '{{c}}' AS "column", {r('min({c})', 4)} AS min, {r('max({c})', 4)} AS max, {r('avg({c})', 4)} AS mean,
  {r('median({c})', 4)} AS median FROM listings""")))
def number_ranges(spark, sf_dir):
    return quality.number_ranges(listings(spark, sf_dir, dealer=True), PROFILED)


_MISSING = _each(TEXTS + PROFILED, """SELECT '{c}' AS "column", count(*) - count({c}) AS missing, count(*) AS n FROM listings""")


@query("fully_populated_columns", with_listings('SELECT "column" FROM missing WHERE missing = 0',
                                                f"missing AS ({_MISSING})"))
def fully_populated_columns(spark, sf_dir):
    return quality.fully_populated(quality.column_completeness(listings(spark, sf_dir, dealer=True), TEXTS + PROFILED))


@query("mostly_null_columns", with_listings(
    f"""SELECT "column", {r('missing::DOUBLE / n * 100', 2)} AS missing_pct FROM missing WHERE missing * 100.0 / n > 50""",
    f"missing AS ({_MISSING})"))
def mostly_null_columns(spark, sf_dir):
    return quality.mostly_null(quality.column_completeness(listings(spark, sf_dir, dealer=True), TEXTS + PROFILED))


_REJECTS = f"""rejects AS (SELECT _source_file, _rejection_reason FROM marked WHERE _rejection_reason <> ''
  UNION ALL SELECT _source_file, 'corrupt_json;missing_vin;invalid_year;' FROM listings WHERE {CORRUPT})"""


@query("rejection_reasons", silver_sql("""
SELECT reason, count(*) AS n FROM (SELECT unnest(string_split(_rejection_reason, ';')) AS reason FROM rejects)
WHERE reason <> '' GROUP BY reason""", _REJECTS))
def rejection_reasons(spark, sf_dir):
    root, _ = silver_run(spark, sf_dir)
    return quality.rejection_reasons(readers.quarantine_scan(spark, root))


@query("quarantine_totals", silver_sql("""
SELECT count(*) AS total_rejected, count(DISTINCT _source_file) AS quarantine_files FROM rejects""", _REJECTS))
def quarantine_totals(spark, sf_dir):
    root, _ = silver_run(spark, sf_dir)
    return quality.quarantine_totals(readers.quarantine_scan(spark, root))


@query("duplicate_keys", """SELECT sum(n - 1)::BIGINT AS duplicate_rows FROM (
  SELECT count(*) AS n FROM (SELECT nullif(l_linenumber, 3) AS k, l_orderkey AS o FROM lineitem)
  GROUP BY CASE WHEN k IS NULL THEN NULL ELSE o || '-' || k END)""")
def duplicate_keys(spark, sf_dir):
    vin = F.concat_ws("-", "l_orderkey", "l_linenumber")
    rows = table(spark, sf_dir, "lineitem").select(F.when(F.col("l_linenumber") != 3, vin).alias("vin"))
    return keys.duplicate_count(rows, "vin")


@query("quality_report_columns", with_listings(_each(TEXTS + PROFILED, f"""
SELECT '{{c}}' AS "column", count(*) - count({{c}}) AS total_missing, count({{c}}) AS non_null_count FROM listings""")))
def quality_report_columns(spark, sf_dir):
    rows = listings(spark, sf_dir, dealer=True).select(*TEXTS, *PROFILED, "_source_file")
    report = quality.quality_report(rows)["columns"]
    return report.where(F.col("column").isin(TEXTS + PROFILED)).select(
        "column", "total_missing", "non_null_count")


@query("silver_profile_values", silver_sql("""
SELECT 'rows' AS section, count(*) AS n FROM stored
UNION ALL SELECT 'columns', 67 UNION ALL SELECT 'numeric', 24 UNION ALL SELECT 'text', 38""", DEDUP_CTE))
def silver_profile_values(spark, sf_dir):
    root, _ = silver_run(spark, sf_dir)
    sections = profile.silver_profile(jobs.SilverLake(root).read(spark))
    return frequency.union_all([
        sections["shape"].select(F.lit("rows").alias("section"), F.col("rows").alias("n")),
        *[sections[s].agg(F.count("*").alias("n")).select(F.lit(label).alias("section"), "n")
          for label, s in (("columns", "schema"), ("numeric", "numeric_summary"), ("text", "string_summary"))]])


@query("raw_file_inventory", with_listings(f"""
SELECT substr(_source_file, 6, 1) AS feed, count(*) FILTER (NOT ({BLANK})) AS total_records FROM listings GROUP BY 1"""))
def raw_file_inventory(spark, sf_dir):
    files = profile.raw_file_inventory(spark, raw_feed(spark, sf_dir), glob=FEED_GLOB)
    return files.groupBy(F.regexp_extract("file", "feed=([^/]+)", 1).alias("feed")).agg(
        F.sum("total_records").alias("total_records"))


@query("raw_file_inventory_sampled", """
SELECT count(*) AS total_records, sum(100)::BIGINT AS bytes, true AS beginnings_only FROM orders""")
def raw_file_inventory_sampled(spark, sf_dir):
    """The first 10,000 bytes of each file tell how many records of equal length it has."""
    path = fresh_path(spark, "equal-lines")
    line = F.rpad(F.concat(F.lit('{"id":'), F.col("o_orderkey").cast("string"), F.lit("}")), 99, " ")
    table(spark, sf_dir, "orders").select(line.alias("value")).write.text(path)
    files = profile.raw_file_inventory(spark, path, glob=FEED_GLOB, sample_bytes=10_000)
    sizes = file_listing(spark, path, FEED_GLOB).agg(F.sum("length").alias("bytes"))
    return files.agg(F.sum("total_records").alias("total_records"),
                     F.bool_and(F.col("sampled_records") <= 100).alias("beginnings_only")).join(sizes)


_ODD_LINE = """CASE WHEN event_id % 11 = 0 THEN '{"id":' ELSE '{"id":' || {id} || ',"props":' || props ||
  ',"name":"' || event_type || '","flag":' || CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'null' END ||
  CASE WHEN event_id % 3 = 0 THEN ',"tags":["a","b"]' WHEN event_id % 3 = 1 THEN ',"tags":[]' ELSE ',"score":1.5' END || '}' END"""


@query("raw_key_inventory", """
WITH e AS (SELECT * FROM events WHERE event_id % 11 <> 0)
SELECT 'id' AS key, 'int' AS type, count(*) AS n FROM e
UNION ALL SELECT 'props', 'dict(1 keys)', count(*) FROM e
UNION ALL SELECT 'name', 'str', count(*) FROM e
UNION ALL SELECT 'flag', CASE WHEN event_id % 2 = 0 THEN 'bool' ELSE 'NoneType' END, count(*) FROM e GROUP BY 2
UNION ALL SELECT 'tags', CASE WHEN event_id % 3 = 0 THEN 'list(len=2)' ELSE 'list(len=0)' END, count(*) FROM e WHERE event_id % 3 <> 2 GROUP BY 2
UNION ALL SELECT 'score', 'float', count(*) FROM e WHERE event_id % 3 = 2""")
def raw_key_inventory(spark, sf_dir):
    line = F.expr(_ODD_LINE.replace("{id}", "cast(event_id as string)"))
    lines = table(spark, sf_dir, "events").select(line.alias("value"))
    keys_ = profile.raw_key_inventory(lines)
    return keys_.select("key", F.explode("types").alias("t")).select("key", "t.type", "t.n")


@query("raw_profile_nested_keys", with_listings(f"""
SELECT unnest(['dealer', 'monthlyPaymentEstimate', 'vin']) AS key,
  unnest([true, true, false]) AS nested, unnest([n, n, v]) AS seen
FROM (SELECT count(*) AS n, count({FAULTS['vin']}) AS v FROM listings WHERE NOT ({CORRUPT}) AND NOT ({BLANK}))"""))
def raw_profile_nested_keys(spark, sf_dir):
    lines = readers.line_scan(spark, raw_feed(spark, sf_dir), FEED_GLOB)
    found = profile.raw_key_inventory(lines)
    return found.where(F.col("key").isin("dealer", "monthlyPaymentEstimate", "vin")).select(
        "key", "nested", "seen")


# --- whole reports: every section, column and measure as (section, column, measure, number) ----

def _measures(section: str, df: DataFrame, key: str, names: tuple[str, ...]) -> DataFrame:
    narrow = df.select(F.col(key).alias("column"), *[F.col(n).cast("double").alias(n) for n in names])
    return narrow.unpivot(["column"], list(names), "measure", "number").select(F.lit(section).alias("section"), "column", "measure", "number")


def _measures_sql(section: str, body: str, key: str, names: tuple[str, ...]) -> str:
    labels = ", ".join(f"'{n}'" for n in names)
    values = ", ".join(f'("{n}")::DOUBLE' for n in names)
    return (f"SELECT '{section}' AS section, {key} AS \"column\", unnest([{labels}]) AS measure, "
            f"unnest([{values}]) AS number FROM ({body})")


_NUMERIC = ("count", "mean", "std", "min", "p25", "p50", "p75", "max", "null_count", "null_pct")
_TEXTUAL = ("non_null_count", "non_empty_count", "null_count", "null_pct", "unique_count")
_QUALITY = ("null_count", "empty_string_count", "total_missing", "missing_pct", "non_null_count")
_RANGE = ("min", "max", "mean", "median")


@query("silver_profile_report", " UNION ALL ".join([
    _measures_sql("shape", with_listings("SELECT count(*) AS rows FROM listings"), "'table'", ("rows",)),
    _measures_sql("numeric_summary", ORACLES["numeric_profile"], '"column"', _NUMERIC),
    _measures_sql("string_summary", ORACLES["string_profile"], '"column"', _TEXTUAL),
    f"""SELECT 'top_values', "column", value, n FROM ({ORACLES['top_text_values']})""",
    f"""SELECT 'value_counts', "column", value, n FROM ({ORACLES['category_counts']})"""]))
def silver_profile_report(spark, sf_dir):
    rows = stage(listings(spark, sf_dir, dealer=True).select(*TEXTS, *PROFILED), "profiled")
    sections = profile.silver_profile(rows)
    shape_ = sections["shape"].withColumn("column", F.lit("table"))
    top = sections["string_summary"].select("column", F.explode("top_values").alias("t"))
    return frequency.union_all([
        _measures("shape", shape_, "column", ("rows",)),
        _measures("numeric_summary", _rounded(sections["numeric_summary"], "mean", "std"), "column", _NUMERIC),
        _measures("string_summary", sections["string_summary"], "column", _TEXTUAL),
        top.select(F.lit("top_values").alias("section"), "column", F.col("t.value").alias("measure"), F.col("t.n").cast("double").alias("number")),
        sections["value_counts"].select(F.lit("value_counts").alias("section"), "column", F.col("value").alias("measure"),
                                        F.col("n").cast("double").alias("number"))])


@query("quality_report", " UNION ALL ".join([
    _measures_sql("totals", with_listings("SELECT count(*) AS total_records, count(DISTINCT _source_file) AS total_files FROM listings"),
                  "'table'", ("total_records", "total_files")),
    _measures_sql("duplicates", with_listings("SELECT count(*) - count(DISTINCT vin) AS duplicate_rows FROM listings"), "'table'", ("duplicate_rows",)),
    _measures_sql("columns", ORACLES["column_completeness"], '"column"', _QUALITY),
    _measures_sql("columns", ORACLES["text_samples"], '"column"', ("unique_count",)),
    f"""SELECT 'samples', "column", samples, NULL FROM ({ORACLES['text_samples']})""",
    _measures_sql("columns", ORACLES["number_ranges"], '"column"', _RANGE),
    f"""SELECT 'columns_fully_populated', "column", '', NULL FROM ({ORACLES['fully_populated_columns']})""",
    _measures_sql("columns_mostly_null", ORACLES["mostly_null_columns"], '"column"', ("missing_pct",)),
    _measures_sql("quarantine", ORACLES["quarantine_totals"], "'table'", ("total_rejected", "quarantine_files")),
    f"""SELECT 'rejection_reasons', reason, 'n', n FROM ({ORACLES['rejection_reasons']})"""]))
def quality_report(spark, sf_dir):
    rows = stage(listings(spark, sf_dir, dealer=True).select(*TEXTS, *PROFILED, "_source_file"), "reported")
    root, _ = silver_run(spark, sf_dir)
    got = quality.quality_report(rows, readers.quarantine_scan(spark, root))
    columns = stage(got["columns"].where(F.col("column") != "_source_file"), "report-columns")
    own = F.col("column") != "_source_file"
    texts, none = columns.where(F.col("unique_count").isNotNull()), F.lit(None).cast("double").alias("number")
    table_of = {name: got[name].withColumn("column", F.lit("table")) for name in ("totals", "duplicates", "quarantine")}
    return frequency.union_all([
        _measures("totals", table_of["totals"], "column", ("total_records", "total_files")),
        _measures("duplicates", table_of["duplicates"], "column", ("duplicate_rows",)),
        _measures("columns", columns, "column", _QUALITY),
        _measures("columns", texts, "column", ("unique_count",)),
        texts.select(F.lit("samples").alias("section"), "column", F.array_join("sample_values", "|").alias("measure"), none),
        _measures("columns", columns.where(F.col("column").isin(PROFILED)), "column", _RANGE),
        got["columns_fully_populated"].where(own).select(F.lit("columns_fully_populated").alias("section"), "column", F.lit("").alias("measure"), none),
        _measures("columns_mostly_null", got["columns_mostly_null"].where(own), "column", ("missing_pct",)),
        _measures("quarantine", table_of["quarantine"], "column", ("total_rejected", "quarantine_files")),
        _measures("rejection_reasons", got["rejection_reasons"], "reason", ("n",))])


_ODD_SQL = _ODD_LINE.replace("{id}", "event_id")


@query("raw_profile", f"""
SELECT 'files' AS section, event_type AS "column", 'total_records' AS measure, count(*)::DOUBLE AS number, NULL AS sample FROM events GROUP BY 2
UNION ALL SELECT 'totals', 'raw', unnest(['total_files', 'total_records']), unnest([count(DISTINCT event_type)::DOUBLE, count(*)::DOUBLE]), NULL FROM events
UNION ALL SELECT 'types', key, type, n, NULL FROM ({ORACLES['raw_key_inventory']})
UNION ALL SELECT 'seen', key, 'n', sum(n), NULL FROM ({ORACLES['raw_key_inventory']}) GROUP BY key
UNION ALL SELECT 'nested', key, 'n', max((type LIKE 'dict%')::INTEGER), NULL FROM ({ORACLES['raw_key_inventory']}) GROUP BY key
UNION ALL SELECT 'sample', 'id', '', NULL, min(event_id::VARCHAR) FROM events WHERE event_id % 11 <> 0
UNION ALL SELECT 'sample', 'name', '', NULL, min(event_type) FROM events WHERE event_id % 11 <> 0""")
def raw_profile(spark, sf_dir):
    """All sections over files of odd lines, a file a kind of event, under names the default pattern misses."""
    path = fresh_path(spark, "odd-lines")
    line = F.expr(_ODD_LINE.replace("{id}", "cast(event_id as string)"))
    lines = table(spark, sf_dir, "events").select(line.alias("value"), F.col("event_type").alias("kind"))
    lines.repartition("kind").write.partitionBy("kind").text(path)
    got = profile.raw_profile(spark, path, glob=FEED_GLOB)
    keys_ = stage(got["keys"], "raw-keys")
    none, text = F.lit(None).cast("double").alias("number"), F.lit(None).cast("string").alias("sample")
    parts = [
        _measures("files", got["files"].withColumn("kind", F.regexp_extract("file", "kind=([^/]+)", 1)), "kind", ("total_records",)),
        _measures("totals", got["totals"].withColumn("of", F.lit("raw")), "of", ("total_files", "total_records")),
        keys_.select("key", F.explode("types").alias("t")).select(F.lit("types").alias("section"), F.col("key").alias("column"),
                                                                 F.col("t.type").alias("measure"), F.col("t.n").cast("double").alias("number")),
        _measures("seen", keys_.withColumn("n", F.col("seen")), "key", ("n",)),
        _measures("nested", keys_.withColumn("n", F.col("nested").cast("int")), "key", ("n",))]
    samples = keys_.where(F.col("key").isin("id", "name")).select(
        F.lit("sample").alias("section"), F.col("key").alias("column"), F.lit("").alias("measure"), none, "sample")
    return frequency.union_all(parts).withColumn("sample", text).unionByName(samples)


@query("union_by_name", """SELECT k, name FROM (SELECT c_custkey AS k, c_name AS name FROM customer
UNION ALL SELECT s_suppkey, s_name FROM supplier)""")
def union_by_name(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("k"))
    return frequency.union_all([a, b])


@query("union_promoted", """SELECT k, name, segment FROM (
SELECT c_custkey AS k, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier)""")
def union_promoted(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"),
                                                F.col("c_mktsegment").alias("segment"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("k"))
    return frequency.union_all([a, b], promote=True)


@query("explode_delimited", """SELECT part, count(*) AS n FROM (
  SELECT unnest(string_split(p_name, ' ')) AS part FROM part) GROUP BY part""")
def explode_delimited(spark, sf_dir):
    return frequency.split_counts(table(spark, sf_dir, "part"), "p_name", " ", "part")


@query("unpivot_statistics", """
SELECT 'l_quantity' AS "column", min(l_quantity) AS min, max(l_quantity) AS max, count(*) AS count FROM lineitem
UNION ALL SELECT 'l_extendedprice', min(l_extendedprice), max(l_extendedprice), count(*) FROM lineitem""")
def unpivot_statistics(spark, sf_dir):
    return profile.numeric_profile(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"]).select(
        "column", "min", "max", "count")


@query("pivot_sum", """SELECT l_linestatus, sum(l_linenumber) FILTER (l_returnflag = 'A')::BIGINT AS "A",
 sum(l_linenumber) FILTER (l_returnflag = 'N')::BIGINT AS "N", coalesce(sum(l_linenumber) FILTER (l_returnflag = 'X'), 0)::BIGINT AS "X"
FROM lineitem GROUP BY 1""")
def pivot_sum(spark, sf_dir):
    return frequency.pivot_sum(table(spark, sf_dir, "lineitem"), "l_linestatus", "l_returnflag",
                               "l_linenumber", ["A", "N", "X"])


@query("sorted_report", """SELECT l_shipmonth, n FROM (
  SELECT strftime(l_shipdate, '%Y-%m') AS l_shipmonth, count(*) AS n FROM lineitem GROUP BY 1)""")
def sorted_report(spark, sf_dir):
    return (table(spark, sf_dir, "lineitem").groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("l_shipmonth"))
            .agg(F.count("*").alias("n")).orderBy(F.desc("n"), "l_shipmonth"))


@query("iso_timestamps", """SELECT o_orderkey,
  CASE WHEN o_orderkey % 4 = 3 THEN NULL WHEN o_orderkey % 4 = 2 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T08:00:00Z'
  ELSE strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00Z' END AS first_seen FROM orders""")
def iso_timestamps(spark, sf_dir):
    day, k = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey") % 4
    text = (F.when(k == 0, day).when(k == 1, F.concat(day, F.lit("T00:00:00Z")))
            .when(k == 2, F.concat(day, F.lit("T10:00:00+02:00"))).otherwise(F.lit("no date")))
    return table(spark, sf_dir, "orders").select("o_orderkey", fn.iso_utc(text).alias("first_seen"))


@query("iso_timestamps_in_two_zones", """SELECT zone, o_orderkey,
  CASE o_orderkey % 5 WHEN 3 THEN NULL WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T08:00:00Z'
  ELSE strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00Z' END AS first_seen
FROM orders, (VALUES ('America/New_York'), ('Asia/Tokyo')) z(zone)""")
def iso_timestamps_in_two_zones(spark, sf_dir):
    """Texts with and without offset, and one of a given pattern, mean the same in any session."""
    parts = []
    for zone in ("America/New_York", "Asia/Tokyo"):
        session = spark.newSession()
        session.conf.set("spark.sql.session.timeZone", "UTC")
        day, k = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey") % 5
        text = (F.when(k == 0, day).when(k == 1, F.concat(day, F.lit("T00:00:00Z")))
                .when(k == 2, F.concat(day, F.lit("T10:00:00+02:00"))).when(k == 3, F.lit("no date"))
                .otherwise(F.date_format("o_orderdate", "MM/dd/yyyy")))
        path = fresh_path(spark, "zone-texts")
        table(session, sf_dir, "orders").select("o_orderkey", text.alias("text")).write.parquet(path)
        session.conf.set("spark.sql.session.timeZone", zone)
        out = fresh_path(spark, "zone-read")
        session.read.parquet(path).select(F.lit(zone).alias("zone"), "o_orderkey", fn.iso_utc(
            "text", ["MM/dd/yyyy"]).alias("first_seen")).write.parquet(out)
        parts.append(spark.read.parquet(out))
    return parts[0].unionByName(parts[1])


_QUARTILES = ("quantile_cont({0}, 0.25)", "median({0})", "quantile_cont({0}, 0.99)")


def _quantile_sql(value: str, scale: str = "") -> str:
    found = ", ".join(f"{r(f'{q.format(value)}{scale}', 3)} AS {n}" for q, n in zip(_QUARTILES, ("p25", "p50", "p99")))
    return f"SELECT l_returnflag, {found} FROM lineitem GROUP BY 1"


def _quantiles(df, value: str, scale: float = 1.0):
    from forecourt.operators.quantiles import exact_quantiles as quantiles
    found = quantiles(df, ["l_returnflag"], value, [0.25, 0.5, 0.99])
    return found.select("l_returnflag", *[fn.half_even(F.col("quantiles")[i] * F.lit(scale), 3).alias(n)
                                          for i, n in enumerate(("p25", "p50", "p99"))])


@query("exact_quantiles", _quantile_sql("l_extendedprice"))
def exact_quantiles(spark, sf_dir):
    return _quantiles(table(spark, sf_dir, "lineitem"), "l_extendedprice")


@query("exact_quantiles_of_small_numbers", _quantile_sql("(l_extendedprice / 1e12)", " * 1e12"))
def exact_quantiles_of_small_numbers(spark, sf_dir):
    """Values near zero are told apart as well as large ones."""
    small = table(spark, sf_dir, "lineitem").withColumn("small", F.col("l_extendedprice") / F.lit(1e12))
    return _quantiles(small, "small", 1e12)
