"""Gold marts, their building blocks and the summary tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt import functions as fn
from forecourt.catalog.listings import (AS_OF, AS_OF_YEAR, clean_cte, listings, r, with_listings)
from forecourt.functions import accident_flag, age_in_years, half_even
from forecourt.operators.frequency import (most_frequent, sorted_distinct_joined, top_n_joined)
from forecourt.operators.keys import keep_keys, top_keys
from forecourt.operators.shape import drop_columns
from forecourt.plans import gold, summaries
from forecourt.session import fresh_path
from forecourt.sources.writers import write_parquet

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build
    return register


def clean(spark: SparkSession, sf_dir: str, dealer: bool = False) -> DataFrame:
    return gold.clean_listings(listings(spark, sf_dir, dealer), AS_OF_YEAR)


def gold_sql(body: str, *ctes: str) -> str:
    return with_listings(body, clean_cte(), *ctes)


def case_bins(column: str, edges, labels, right: bool = False) -> str:
    op = "<=" if right else "<"
    whens = [f"WHEN {column} {op} {edges[0]} THEN NULL"]
    whens += [f"WHEN {column} {op} {e} THEN '{label}'" for e, label in zip(edges[1:], labels)]
    return f"CASE {' '.join(whens)} WHEN {column} IS NOT NULL THEN '{labels[-1]}' END"


PRICE_CASE = case_bins("current_price", fixed.PRICE_EDGES, fixed.PRICE_LABELS)
MILEAGE_CASE = case_bins("mileage", fixed.MILEAGE_EDGES, fixed.MILEAGE_LABELS)
TIER_CASE = case_bins("inventory_count", fixed.TIER_EDGES, fixed.TIER_LABELS, right=True)
SEGMENT_ORDER = ("CASE price_segment " + " ".join(
    f"WHEN '{label}' THEN {i}" for i, label in enumerate(fixed.PRICE_LABELS)) + " END")

ACCIDENT = "coalesce(contains(lower(json_extract_string(accident_history, '$.icon')), 'accident'), false)"
OWNERS = """CASE WHEN json_type(owner_history) = 'OBJECT' THEN
   CASE WHEN list_contains(json_keys(owner_history), 'history')
        THEN json_array_length(owner_history, '$.history')::BIGINT ELSE 0 END END"""
SERVICES = """nullif(CASE json_type(service_history, '$.number')
   WHEN 'VARCHAR' THEN try_cast(json_extract_string(service_history, '$.number') AS BIGINT)
   ELSE trunc(try_cast(json_extract_string(service_history, '$.number') AS DOUBLE))::BIGINT END, 0)"""
OPTIONS = "coalesce(json_array_length(top_options), 0)::BIGINT"


# --- marts -------------------------------------------------------------------

MARKET_CTES = (f"""stats AS (
  SELECT make, model, year, bodytype, count(current_price) AS listing_count,
    {r('min(current_price)', 2)} AS price_min, {r('max(current_price)', 2)} AS price_max,
    {r('avg(current_price)', 2)} AS price_mean, {r('median(current_price)', 2)} AS price_median,
    {r('stddev_samp(current_price)', 2)} AS price_std, {r('avg(list_price)', 2)} AS list_price_mean,
    {r('avg(mileage)', 2)} AS avg_mileage, {r('median(mileage)', 2)} AS median_mileage,
    {r('avg(mpg_city)', 2)} AS avg_mpg_city, {r('avg(mpg_highway)', 2)} AS avg_mpg_highway,
    {r('avg(mpg_combined)', 2)} AS avg_mpg_combined, {r('avg(dealer_avg_rating)', 2)} AS avg_dealer_rating,
    {r('avg(follow_count)', 2)} AS avg_follow_count, {r('avg(tp_retention_score)', 2)} AS avg_retention_score
  FROM clean WHERE year IS NOT NULL GROUP BY ALL)""", f"""market AS (
  SELECT *, {r('price_max - price_min', 2)} AS price_spread,
    {r('price_std / nullif(price_mean, 0) * 100', 2)} AS price_cv_pct,
    {r('(list_price_mean - price_mean) / nullif(list_price_mean, 0) * 100', 2)} AS avg_discount_pct
  FROM stats)""")


@query("market_summary", gold_sql("SELECT * FROM market", *MARKET_CTES))
def market_summary(spark, sf_dir):
    return gold.market_summary(clean(spark, sf_dir))


SEGMENT_CTES = (f"""placed AS (SELECT *, {PRICE_CASE} AS price_segment FROM clean)""", f"""seg AS (
  SELECT price_segment, count(current_price) AS listing_count, {r('avg(current_price)', 2)} AS avg_price,
    {r('median(current_price)', 2)} AS median_price, {r('min(current_price)', 2)} AS min_price,
    {r('max(current_price)', 2)} AS max_price, {r('avg(mileage)', 2)} AS avg_mileage,
    {r(f'avg({AS_OF_YEAR} - year)', 2)} AS avg_vehicle_age,
    {r('avg(tp_retention_score)', 2)} AS avg_retention_score,
    {r('avg(mpg_combined)', 2)} AS avg_mpg_combined
  FROM placed WHERE price_segment IS NOT NULL GROUP BY price_segment)""", """ranked_makes AS (
  SELECT price_segment, make, row_number() OVER (PARTITION BY price_segment ORDER BY count(*) DESC, make) AS rn
  FROM placed GROUP BY price_segment, make)""", """tops AS (
  SELECT price_segment, string_agg(make, ', ' ORDER BY rn) AS top_makes
  FROM ranked_makes WHERE rn <= 3 GROUP BY price_segment)""", """ranked_bodies AS (
  SELECT price_segment, bodytype, row_number() OVER (PARTITION BY price_segment ORDER BY count(*) DESC, bodytype) AS rn
  FROM placed GROUP BY price_segment, bodytype)""")


@query("price_segments", gold_sql(f"""
SELECT seg.*, {r('listing_count::DOUBLE / (SELECT count(*) FROM clean) * 100', 2)} AS pct_of_market,
  top_makes, b.bodytype AS dominant_body_style
FROM seg LEFT JOIN tops USING (price_segment)
LEFT JOIN ranked_bodies b ON b.price_segment = seg.price_segment AND b.rn = 1""", *SEGMENT_CTES))
def price_segments(spark, sf_dir):
    return gold.price_segments(clean(spark, sf_dir), AS_OF_YEAR)


DEALER_LIST = ", ".join(fixed.DEALER_KEYS)
DEALER_CTES = (f"""dealers AS (
  SELECT {DEALER_LIST}, count(listing_id) AS inventory_count,
    {r('avg(current_price)', 2)} AS avg_price, {r('median(current_price)', 2)} AS median_price,
    {r('avg(list_price)', 2)} AS avg_list_price, {r('avg(mileage)', 2)} AS avg_mileage,
    {r('avg(image_count)', 2)} AS avg_image_count, {r('avg(follow_count)', 2)} AS avg_follow_count,
    {r('avg(tp_retention_score)', 2)} AS avg_retention_score,
    {r(f'avg(CASE WHEN {ACCIDENT} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100', 2)} AS pct_accident,
    {r(f'avg({AS_OF_YEAR} - year)', 1)} AS avg_vehicle_age,
    string_agg(DISTINCT make, ', ' ORDER BY make) AS makes_offered
  FROM clean WHERE {' AND '.join(f'{k} IS NOT NULL' for k in fixed.DEALER_KEYS)}
  GROUP BY {DEALER_LIST})""",)


@query("dealer_performance", gold_sql(f"""
SELECT *, {r('(avg_list_price - avg_price) / nullif(avg_list_price, 0) * 100', 2)} AS avg_discount_pct,
  {TIER_CASE} AS inventory_tier FROM dealers""", *DEALER_CTES))
def dealer_performance(spark, sf_dir):
    return gold.dealer_performance(clean(spark, sf_dir, dealer=True), AS_OF_YEAR)


CURVE_CTES = (f"""curve AS (
  SELECT make, {AS_OF_YEAR} - year AS vehicle_age, count(current_price) AS listing_count,
    {r('avg(current_price)', 2)} AS avg_price, {r('median(current_price)', 2)} AS median_price,
    {r('avg(mileage)', 2)} AS avg_mileage
  FROM clean WHERE {AS_OF_YEAR} - year BETWEEN 0 AND {fixed.MAX_CURVE_AGE}
  GROUP BY make, year)""", """baseline AS (
  SELECT make, avg(avg_price) AS baseline_price FROM curve WHERE vehicle_age <= 1 GROUP BY make)""",
  """nexts AS (
  SELECT *, lead(avg_price) OVER (PARTITION BY make ORDER BY vehicle_age) AS next_yr_avg_price
  FROM curve LEFT JOIN baseline USING (make))""")


@query("depreciation_curve", gold_sql(f"""
SELECT *, {r('avg_price / baseline_price * 100', 2)} AS retained_value_pct,
  {r('(avg_price - next_yr_avg_price) / avg_price * 100', 2)} AS yoy_depreciation_pct
FROM nexts""", *CURVE_CTES))
def depreciation_curve(spark, sf_dir):
    return gold.depreciation_curve(clean(spark, sf_dir), AS_OF_YEAR)


SCORE = f"""{r('''
 0.25::DOUBLE * greatest(least(1 - vehicle_age_years / 20.0::DOUBLE, 1), 0)
 + greatest(least(1 - mileage / 200000.0::DOUBLE, 1), 0) * 0.35::DOUBLE
 + CASE WHEN has_accident THEN 0.0::DOUBLE ELSE 0.25::DOUBLE END
 + greatest(least(coalesce(service_event_count, 0) / 20.0::DOUBLE, 1), 0) * 0.15::DOUBLE''', 3)}"""

FACT_CTES = (f"""facts AS (
  SELECT *, {ACCIDENT} AS has_accident, {OWNERS} AS owner_count, {SERVICES} AS service_event_count,
    {OPTIONS} AS option_count, {AS_OF_YEAR} - year AS vehicle_age_years,
    {r('list_price - current_price', 2)} AS price_discount_abs,
    CASE WHEN list_price > 0 THEN {r('(list_price - current_price) / list_price * 100', 2)} END AS price_discount_pct,
    {PRICE_CASE} AS price_segment, {MILEAGE_CASE} AS mileage_band,
    CASE WHEN mileage > 0 THEN {r('current_price / mileage', 4)} END AS cost_per_mile,
    CASE WHEN first_seen IS NOT NULL THEN greatest(floor((epoch(TIMESTAMP '{AS_OF}') - epoch(first_seen)) / 86400), 0)::BIGINT END
      AS days_on_market,
    median(current_price) OVER (PARTITION BY make, model, year) AS segment_median_price,
    CASE WHEN current_price > 0 AND monthly_term_months > 0
      THEN {r('monthly_payment / current_price * 100', 3)} END AS monthly_pmt_pct_of_price
  FROM clean)""", f"""enriched AS (
  SELECT *, CASE WHEN current_price < segment_median_price * 0.9::DOUBLE THEN 'Below Market'
      WHEN current_price > segment_median_price * 1.1::DOUBLE THEN 'Above Market' ELSE 'At Market' END AS price_vs_market,
    {SCORE} AS quality_score FROM facts)""")
FACT_EXCLUDES = ", ".join(f'"{c}"' for c in [*fixed.ENRICHED_DROPS, "k", "q", "day"])


@query("listings_enriched", gold_sql(
    f"SELECT * EXCLUDE ({FACT_EXCLUDES}) FROM enriched", *FACT_CTES))
def listings_enriched(spark, sf_dir):
    return gold.listings_enriched(clean(spark, sf_dir, dealer=True), AS_OF, AS_OF_YEAR)


@query("clean_listings", gold_sql(
    "SELECT vin, listing_id, year, make, model, bodytype, dealer_type, current_price, list_price, "
    "mileage, first_seen FROM clean"))
def clean_listings(spark, sf_dir):
    return clean(spark, sf_dir).select("vin", "listing_id", "year", "make", "model", "bodytype",
                                       "dealer_type", "current_price", "list_price", "mileage",
                                       "first_seen")


# --- building blocks ---------------------------------------------------------

@query("validity_filter", with_listings(f"""
SELECT year, count(*) AS listings, sum(mileage)::BIGINT AS miles FROM listings
WHERE current_price > 0 AND year BETWEEN 1980 AND {AS_OF_YEAR + 1} AND mileage >= 0 GROUP BY year"""))
def validity_filter(spark, sf_dir):
    rows = gold.valid_listings(listings(spark, sf_dir), AS_OF_YEAR)
    return rows.groupBy("year").agg(F.count("*").alias("listings"), F.sum("mileage").alias("miles"))


@query("age_range_filter", gold_sql(f"""
SELECT {AS_OF_YEAR} - year AS vehicle_age, count(*) AS listings FROM clean
WHERE {AS_OF_YEAR} - year BETWEEN 0 AND 25 GROUP BY year"""))
def age_range_filter(spark, sf_dir):
    return gold.within_curve(clean(spark, sf_dir), AS_OF_YEAR).groupBy("vehicle_age").agg(
        F.count("*").alias("listings"))


@query("segment_median", gold_sql("""
SELECT listing_id, current_price,
  median(current_price) OVER (PARTITION BY make, model, year) AS segment_median_price FROM clean"""))
def segment_median(spark, sf_dir):
    rows = clean(spark, sf_dir).select("listing_id", "make", "model", "year", "current_price")
    return gold.with_segment_median(rows).select("listing_id", "current_price",
                                                 "segment_median_price")


@query("top_makes_per_segment", gold_sql("SELECT * FROM tops WHERE price_segment IS NOT NULL",
                                         *SEGMENT_CTES))
def top_makes_per_segment(spark, sf_dir):
    placed = clean(spark, sf_dir).withColumn("price_segment", gold.price_segment())
    return top_n_joined(placed, "price_segment", "make", 3, "top_makes")


@query("dominant_body_per_segment", gold_sql(
    "SELECT price_segment, bodytype AS dominant_body_style FROM ranked_bodies WHERE rn = 1",
    *SEGMENT_CTES))
def dominant_body_per_segment(spark, sf_dir):
    placed = clean(spark, sf_dir).withColumn("price_segment", gold.price_segment())
    return most_frequent(placed, "price_segment", "bodytype", "dominant_body_style")


@query("segment_makes_join", gold_sql("""
SELECT price_segment, listing_count, top_makes, b.bodytype AS dominant_body_style
FROM seg LEFT JOIN tops USING (price_segment)
LEFT JOIN (SELECT * FROM ranked_bodies WHERE rn = 1) b USING (price_segment)""", *SEGMENT_CTES))
def segment_makes_join(spark, sf_dir):
    placed = clean(spark, sf_dir).withColumn("price_segment", gold.price_segment())
    counts = placed.groupBy("price_segment").agg(F.count("current_price").alias("listing_count"))
    return (counts.join(top_n_joined(placed, "price_segment", "make", 3, "top_makes"),
                        "price_segment", "left")
            .join(most_frequent(placed, "price_segment", "bodytype", "dominant_body_style"),
                  "price_segment", "left"))


@query("makes_offered", gold_sql("""
SELECT dealer_carfax_id, string_agg(DISTINCT make, ', ' ORDER BY make) AS makes_offered
FROM clean GROUP BY dealer_carfax_id"""))
def makes_offered(spark, sf_dir):
    return clean(spark, sf_dir).groupBy("dealer_carfax_id").agg(
        sorted_distinct_joined("make").alias("makes_offered"))


@query("accident_share", gold_sql(f"""
SELECT dealer_type, {r(f'avg(CASE WHEN {ACCIDENT} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100', 2)} AS pct_accident,
  {r(f'avg({AS_OF_YEAR} - year)', 2)} AS avg_vehicle_age FROM clean GROUP BY dealer_type"""))
def accident_share(spark, sf_dir):
    return clean(spark, sf_dir).groupBy("dealer_type").agg(
        half_even(F.avg(accident_flag("accident_history").cast("double")) * 100.0, 2).alias("pct_accident"),
        half_even(F.avg(age_in_years("year", AS_OF_YEAR)), 2).alias("avg_vehicle_age"))


@query("row_and_value_counts", gold_sql("""
SELECT make, count(*) AS listings, count(list_price) AS with_list_price,
  count(monthly_term_months) AS with_term FROM clean GROUP BY make"""))
def row_and_value_counts(spark, sf_dir):
    return clean(spark, sf_dir).groupBy("make").agg(
        F.count("*").alias("listings"), F.count("list_price").alias("with_list_price"),
        F.count("monthly_term_months").alias("with_term"))


@query("baseline_price", gold_sql("SELECT make, baseline_price FROM baseline", *CURVE_CTES))
def baseline_price(spark, sf_dir):
    return gold.baseline_prices(gold.depreciation_curve(clean(spark, sf_dir), AS_OF_YEAR))


@query("curve_baseline_join", gold_sql("""
SELECT make, vehicle_age, avg_price, baseline_price FROM curve LEFT JOIN baseline USING (make)""",
                                       *CURVE_CTES))
def curve_baseline_join(spark, sf_dir):
    curve = gold.depreciation_curve(clean(spark, sf_dir), AS_OF_YEAR).select(
        "make", "vehicle_age", "avg_price")
    return curve.join(gold.baseline_prices(curve), "make", "left")


@query("next_age_price", gold_sql(
    "SELECT make, vehicle_age, avg_price, next_yr_avg_price FROM nexts", *CURVE_CTES))
def next_age_price(spark, sf_dir):
    return gold.depreciation_curve(clean(spark, sf_dir), AS_OF_YEAR).select(
        "make", "vehicle_age", "avg_price", "next_yr_avg_price")


def _from_facts(name: str, columns: list[str], sql_from: str = "enriched"):
    listed = ", ".join(columns)

    @query(name, gold_sql(f"SELECT listing_id, {listed} FROM {sql_from}", *FACT_CTES))
    def run(spark, sf_dir):
        facts = gold.listings_enriched(clean(spark, sf_dir, dealer=False), AS_OF, AS_OF_YEAR)
        return facts.select("listing_id", *columns)
    return run


_from_facts("price_against_market", ["current_price", "segment_median_price", "price_vs_market"])
_from_facts("listing_quality_score", ["vehicle_age_years", "mileage", "quality_score"])


def _row_functions(name: str, sql_columns: dict[str, str], make_columns):
    listed = ", ".join(f"{e} AS {c}" for c, e in sql_columns.items())

    @query(name, with_listings(f"SELECT listing_id, {listed} FROM listings"))
    def run(spark, sf_dir):
        columns = make_columns()
        return listings(spark, sf_dir).select(
            "listing_id", *[columns[c].alias(c) for c in sql_columns])
    return run


def _register_functions() -> None:
    _row_functions("price_segment", {"price_segment": PRICE_CASE},
                   lambda: {"price_segment": gold.price_segment()})
    _row_functions("mileage_band", {"mileage_band": MILEAGE_CASE},
                   lambda: {"mileage_band": gold.mileage_band()})
    _row_functions("guarded_ratios", {
        "price_discount_pct": f"CASE WHEN list_price > 0 THEN {r('(list_price - current_price) / list_price * 100', 2)} END",
        "cost_per_mile": f"CASE WHEN mileage > 0 THEN {r('current_price / mileage', 4)} END",
        "payment_pct": f"CASE WHEN current_price > 0 AND monthly_term_months > 0 THEN {r('monthly_payment / current_price * 100', 3)} END",
    }, lambda: {
        "price_discount_pct": fn.guarded_ratio(F.col("list_price") - F.col("current_price"),
                                               "list_price", 2, scale=100),
        "cost_per_mile": fn.guarded_ratio("current_price", "mileage", 4),
        "payment_pct": fn.guarded_ratio("monthly_payment", "current_price", 3, scale=100,
                                        when=(F.col("current_price") > 0)
                                        & (F.col("monthly_term_months") > 0))})
    _row_functions("clipped_values", {
        "mile_score": "CASE WHEN mileage IS NOT NULL THEN greatest(least(1 - mileage / 100000.0::DOUBLE, 1), 0) END",
        "over_fifty_thousand": "CASE WHEN list_price IS NOT NULL THEN greatest(list_price - 50000, 0) END",
    }, lambda: {
        "mile_score": fn.clip(1 - F.col("mileage") / F.lit(100000), 0.0, 1.0),
        "over_fifty_thousand": fn.clip(F.col("list_price") - 50000, lower=0.0)})
    _row_functions("half_even_rounding", {
        "eighths": r("dealer_avg_rating", 2), "tenths": r("current_price / 16", 1)},
        lambda: {"eighths": fn.half_even("dealer_avg_rating", 2),
                 "tenths": fn.half_even(F.col("current_price") / 16, 1)})
    _row_functions("days_on_market", {
        "days_on_market": f"""CASE WHEN first_seen IS NOT NULL THEN greatest(floor(
          (epoch(TIMESTAMP '{AS_OF}') - epoch(CAST(replace(first_seen, 'Z', '') AS TIMESTAMP))) / 86400), 0)::BIGINT END"""},
        lambda: {"days_on_market": fn.days_since(fn.timestamp_or_null("first_seen"), AS_OF)})
    _row_functions("accident_flag", {"has_accident": ACCIDENT},
                   lambda: {"has_accident": fn.accident_flag("accident_history")})
    _row_functions("owner_count", {"owner_count": OWNERS},
                   lambda: {"owner_count": fn.owner_count("owner_history")})
    _row_functions("service_event_count", {"service_event_count": SERVICES},
                   lambda: {"service_event_count": fn.service_event_count("service_history")})
    _row_functions("option_count", {"option_count": OPTIONS},
                   lambda: {"option_count": fn.json_list_size("top_options")})
    _row_functions("vehicle_age", {"vehicle_age_years": f"{AS_OF_YEAR} - year"},
                   lambda: {"vehicle_age_years": fn.age_in_years("year", AS_OF_YEAR)})
    _row_functions("derived_arithmetic", {
        "price_discount_abs": r("list_price - current_price", 2),
        "discount_share": r("(list_price - current_price) / nullif(list_price, 0) * 100", 2),
    }, lambda: {
        "price_discount_abs": fn.half_even(F.col("list_price") - F.col("current_price"), 2),
        "discount_share": fn.half_even(F.try_divide(F.col("list_price") - F.col("current_price"),
                                                    F.col("list_price")) * 100.0, 2)})
    _row_functions("json_preview", {"preview": "substr(owner_history, 1, 12)"},
                   lambda: {"preview": fn.json_preview("owner_history", 12)})


_register_functions()


@query("inventory_tier", gold_sql(f"""
SELECT dealer_carfax_id, inventory_count, {TIER_CASE} AS inventory_tier FROM (
  SELECT dealer_carfax_id, count(listing_id) AS inventory_count FROM clean GROUP BY 1)"""))
def inventory_tier(spark, sf_dir):
    counts = clean(spark, sf_dir).groupBy("dealer_carfax_id").agg(
        F.count("listing_id").alias("inventory_count"))
    return counts.withColumn("inventory_tier", gold.inventory_tier())


@query("drop_column_list", gold_sql(f"""SELECT * EXCLUDE ({FACT_EXCLUDES}) FROM clean"""))
def drop_column_list(spark, sf_dir):
    return drop_columns(clean(spark, sf_dir, dealer=True), fixed.ENRICHED_DROPS)


# --- summaries over the stored mart ------------------------------------------

_STORED: dict[tuple[str, str], str] = {}


def stored_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The market summary as a written table, built once per session and folder."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _STORED:
        path = fresh_path(spark, "market-summary")
        write_parquet(market_summary(spark, sf_dir), path)
        _STORED[at] = path
    return spark.read.parquet(_STORED[at])


def summary_sql(body: str, *ctes: str) -> str:
    return gold_sql(body, *MARKET_CTES, *ctes)


def leading(k: int) -> str:
    return (f"front_makes AS (SELECT make FROM market GROUP BY make "
            f"ORDER BY sum(listing_count) DESC, make LIMIT {k})")


@query("top_makes", summary_sql("""SELECT make, sum(listing_count)::BIGINT AS listing_count
FROM market GROUP BY make ORDER BY 2 DESC, 1 LIMIT 15"""))
def top_makes(spark, sf_dir):
    return summaries.top_makes(stored_market(spark, sf_dir))


@query("price_by_body", summary_sql("""
SELECT bodytype, median(price_median) AS median_price, sum(listing_count)::BIGINT AS count
FROM market GROUP BY bodytype HAVING sum(listing_count) >= 20"""))
def price_by_body(spark, sf_dir):
    return summaries.price_by_body(stored_market(spark, sf_dir))


@query("price_vs_mileage", summary_sql("""
SELECT make, avg_mileage, price_mean, listing_count FROM market SEMI JOIN front_makes USING (make)""",
                                       leading(10)))
def price_vs_mileage(spark, sf_dir):
    return summaries.price_vs_mileage(stored_market(spark, sf_dir))


@query("year_price_trend", summary_sql(f"""
SELECT make, year, {r('avg(price_mean)', 6)} AS price_mean FROM market SEMI JOIN front_makes USING (make)
GROUP BY make, year""", leading(5)))
def year_price_trend(spark, sf_dir):
    return summaries.year_price_trend(stored_market(spark, sf_dir)).withColumn(
        "price_mean", half_even("price_mean", 6))


HEAT_YEARS = list(range(1997, 2002))


@query("listing_heatmap", summary_sql(f"""
SELECT make, {', '.join(f'coalesce(sum(listing_count) FILTER (year = {y}), 0)::BIGINT AS "{y}"' for y in HEAT_YEARS)}
FROM market SEMI JOIN front_makes USING (make) GROUP BY make""", leading(10)))
def listing_heatmap(spark, sf_dir):
    return summaries.listing_heatmap(stored_market(spark, sf_dir), from_year=HEAT_YEARS[0])


@query("price_variability", summary_sql(f"""
SELECT make, {r('weighted_cv', 6)} AS weighted_cv, total_listings FROM (
  SELECT make, sum(price_cv_pct * listing_count) / sum(listing_count) FILTER (price_cv_pct IS NOT NULL) AS weighted_cv,
    sum(listing_count)::BIGINT AS total_listings FROM market GROUP BY make)
WHERE weighted_cv IS NOT NULL AND total_listings >= 50 ORDER BY weighted_cv DESC, make LIMIT 15"""))
def price_variability(spark, sf_dir):
    return summaries.price_variability(stored_market(spark, sf_dir)).withColumn(
        "weighted_cv", half_even("weighted_cv", 6))


@query("mpg_by_body", summary_sql(f"""
SELECT bodytype, {r('avg(avg_mpg_combined)', 6)} AS avg_mpg, sum(listing_count)::BIGINT AS count
FROM market GROUP BY bodytype HAVING sum(listing_count) >= 20 AND avg(avg_mpg_combined) > 0"""))
def mpg_by_body(spark, sf_dir):
    return summaries.mpg_by_body(stored_market(spark, sf_dir)).withColumn(
        "avg_mpg", half_even("avg_mpg", 6))


@query("discount_by_make", summary_sql(f"""
SELECT make, {r('avg_disc', 6)} AS avg_disc, count FROM (
  SELECT make, avg(avg_discount_pct) AS avg_disc, sum(listing_count)::BIGINT AS count
  FROM market GROUP BY make HAVING sum(listing_count) >= 50
  ORDER BY avg_disc DESC NULLS LAST, make LIMIT 15)"""))
def discount_by_make(spark, sf_dir):
    return summaries.discount_by_make(stored_market(spark, sf_dir)).withColumn(
        "avg_disc", half_even("avg_disc", 6))


@query("leading_makes_listings", gold_sql("""
SELECT listing_id, make, current_price FROM clean SEMI JOIN (
  SELECT make FROM clean GROUP BY make ORDER BY count(listing_id) DESC, make LIMIT 5) USING (make)"""))
def leading_makes_listings(spark, sf_dir):
    rows = clean(spark, sf_dir).select("listing_id", "make", "current_price")
    best = top_keys(rows.withColumn("n", F.lit(1)), "make", "n", 5)
    return keep_keys(rows, best, "make")


@query("weighted_mean_price", summary_sql(f"""
SELECT model, {r('sum(price_mean * listing_count) / sum(listing_count)', 6)} AS weighted_price,
  sum(listing_count)::BIGINT AS listings FROM market GROUP BY model HAVING sum(listing_count) >= 50"""))
def weighted_mean_price(spark, sf_dir):
    market, n = stored_market(spark, sf_dir), F.col("listing_count")
    return market.groupBy("model").agg(
        half_even(F.sum(F.col("price_mean") * n) / F.sum(n), 6).alias("weighted_price"),
        F.sum(n).alias("listings")).where(F.col("listings") >= 50)


@query("market_overview", summary_sql("""
SELECT count(*) AS rows, count(DISTINCT make) AS makes, min(year) AS first_year,
  max(year) AS last_year FROM market"""))
def market_overview(spark, sf_dir):
    return summaries.market_overview(stored_market(spark, sf_dir))
