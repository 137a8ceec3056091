"""Gold layer: cleaned listings and the five marts built from them.

Every mart is one plan over the silver table, so Catalyst prunes the scan to
the columns that mart needs; nothing wide is cached between them.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt.functions import (accident_flag, age_in_years, bucket_ordinal, bucketize,
                                 clean_upper, clip, compare_to_band, days_since, guarded_ratio,
                                 half_even, json_list_size, number_or_null, owner_count,
                                 service_event_count, timestamp_or_null, whole_number_or_null)
from forecourt.operators.frequency import most_frequent, sorted_distinct_joined, top_n_joined
from forecourt.operators.keys import with_keys
from forecourt.operators.quantiles import exact_quantiles, grouped_stats
from forecourt.operators.shape import drop_columns
from forecourt.session import stage


def rounded(df: DataFrame, digits: int, skip: tuple[str, ...] = ()) -> DataFrame:
    """Round every double column half-even."""
    return df.withColumns({c: half_even(c, digits) for c, t in df.dtypes
                           if t == "double" and c not in skip})


def _mean(column: str | Column) -> Column:
    return F.avg(column)


def _percent(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent, 2 decimals; null when the whole is 0 or null."""
    return guarded_ratio(part, whole, 2, scale=100, when=whole.isNotNull())


def valid_listings(df: DataFrame, as_of_year: int = fixed.CURRENT_YEAR) -> DataFrame:
    """Priced listings of a plausible model year and mileage; nulls are out.

    Written on the stored columns, so that all three conditions reach the scan.
    """
    return df.where((F.col("current_price") > 0)
                    & F.col("year").between(fixed.FIRST_MODEL_YEAR, as_of_year + 1)
                    & (F.col("mileage") >= 0))


def clean_listings(df: DataFrame, as_of_year: int = fixed.CURRENT_YEAR) -> DataFrame:
    """Numbers as numbers, valid rows only, categories in clean upper case (null
    becomes the literal text that keeps it a group of its own)."""
    kinds = dict(df.dtypes)
    numbers = {}
    for name, kind, cast in (("current_price", "double", number_or_null),
                             ("list_price", "double", number_or_null),
                             ("mileage", "bigint", whole_number_or_null),
                             ("year", "bigint", whole_number_or_null)):
        if name in kinds and kinds[name] != kind:
            numbers[name] = cast(name)
    df = valid_listings(df.withColumns(numbers) if numbers else df, as_of_year)
    texts = {c: F.coalesce(clean_upper(c), F.lit(fixed.NULL_TEXT))
             for c in fixed.GOLD_UPPER_TRIMMED if c in kinds}
    if "first_seen" in kinds:
        texts["first_seen"] = timestamp_or_null("first_seen")
    return df.withColumns(texts)


def price_segment(price: Column | str = "current_price") -> Column:
    return bucketize(price, fixed.PRICE_EDGES, fixed.PRICE_LABELS)


def mileage_band(mileage: Column | str = "mileage") -> Column:
    return bucketize(mileage, fixed.MILEAGE_EDGES, fixed.MILEAGE_LABELS)


def inventory_tier(count: Column | str = "inventory_count") -> Column:
    return bucketize(count, fixed.TIER_EDGES, fixed.TIER_LABELS, right=True)


def quality_score(age: Column, mileage: Column, accident: Column, services: Column) -> Column:
    """Weighted score in [0, 1] of age, mileage, accident-free and service history."""
    weight, scale = fixed.QUALITY_WEIGHTS, fixed.QUALITY_SCALES
    young = clip(1 - age / F.lit(scale["age"]), 0.0, 1.0)
    low_miles = clip(1 - mileage / F.lit(scale["miles"]), 0.0, 1.0)
    no_accident = F.when(accident, F.lit(0.0)).otherwise(F.lit(1.0))
    serviced = clip(F.coalesce(services, F.lit(0)) / F.lit(scale["service"]), 0.0, 1.0)
    return half_even(young * weight["age"] + low_miles * weight["miles"]
                     + no_accident * weight["accident"] + serviced * weight["service"], 3)


def with_segment_median(df: DataFrame, keys: tuple[str, ...] = ("make", "model", "year"),
                        value: str = "current_price", out: str = "segment_median_price") -> DataFrame:
    """Attach each row's group median.

    Medians are aggregated and joined back rather than taken over a window,
    which would pull every group whole into one task.  They are written first:
    the planner then knows their size, broadcasts them when small, so that the
    wide rows are not shuffled at all, and else joins by a shuffle that AQE
    splits where a group is skewed.
    """
    medians = exact_quantiles(with_keys(df.select(*keys, value), keys), keys, value, [0.5])
    medians = stage(medians.select(*keys, F.col("quantiles")[0].alias(out)), "segment-medians")
    return df.join(medians, list(keys), "left")


def listings_enriched(clean: DataFrame, as_of: datetime | str | Column | None = None,
                      as_of_year: int = fixed.CURRENT_YEAR) -> DataFrame:
    """Row-level facts: history flags, age, discount, bands, days on market,
    price against the group median, quality score, payment share."""
    moment = F.current_timestamp() if as_of is None else as_of
    order = [c for c in clean.columns if c not in fixed.ENRICHED_DROPS]
    price, listed = F.col("current_price"), F.col("list_price")
    base = clean.withColumns({
        "has_accident": accident_flag("accident_history"),
        "owner_count": owner_count("owner_history"),
        "service_event_count": service_event_count("service_history"),
        "option_count": json_list_size("top_options"),
        "vehicle_age_years": age_in_years("year", as_of_year),
        "price_discount_abs": half_even(listed - price, 2),
        "price_segment": price_segment(),
        "mileage_band": mileage_band(),
        "cost_per_mile": guarded_ratio("current_price", "mileage", 4),
        "days_on_market": days_since("first_seen", moment),
        "monthly_pmt_pct_of_price": guarded_ratio(
            "monthly_payment", "current_price", 3, scale=100,
            when=(price > 0) & (F.col("monthly_term_months") > 0)),
    })
    base = base.withColumns({
        "price_discount_pct": guarded_ratio("price_discount_abs", "list_price", 2, scale=100),
        "quality_score": quality_score(F.col("vehicle_age_years"), F.col("mileage"),
                                       F.col("has_accident"), F.col("service_event_count")),
    })
    facts = with_segment_median(drop_columns(base, fixed.ENRICHED_DROPS))
    return facts.withColumn("price_vs_market", compare_to_band(
        "current_price", "segment_median_price", fixed.MARKET_BAND, fixed.MARKET_LABELS)
    ).select(*order, "has_accident", "owner_count", "service_event_count", "option_count",
             "vehicle_age_years", "price_discount_abs", "price_discount_pct", "price_segment",
             "mileage_band", "cost_per_mile", "days_on_market", "segment_median_price",
             "price_vs_market", "quality_score", "monthly_pmt_pct_of_price")


def market_summary(clean: DataFrame) -> DataFrame:
    """Price, mileage, economy and engagement figures per make, model, year and body."""
    means = {"price_mean": "current_price", "list_price_mean": "list_price",
             "avg_mileage": "mileage", "avg_mpg_city": "mpg_city",
             "avg_mpg_highway": "mpg_highway", "avg_mpg_combined": "mpg_combined",
             "avg_dealer_rating": "dealer_avg_rating", "avg_follow_count": "follow_count",
             "avg_retention_score": "tp_retention_score"}
    stats = grouped_stats(
        clean, fixed.MARKET_KEYS,
        [F.count("current_price").alias("listing_count"),
         F.min("current_price").alias("price_min"), F.max("current_price").alias("price_max"),
         F.stddev_samp("current_price").alias("price_std"),
         *[_mean(source).alias(out) for out, source in means.items()]],
        {"price_median": "current_price", "median_mileage": "mileage"})
    table = rounded(stats, 2)
    mean, listed = F.col("price_mean"), F.col("list_price_mean")
    return table.select(
        *fixed.MARKET_KEYS, "listing_count", "price_min", "price_max", "price_mean",
        "price_median", "price_std", "list_price_mean", "avg_mileage", "median_mileage",
        "avg_mpg_city", "avg_mpg_highway", "avg_mpg_combined", "avg_dealer_rating",
        "avg_follow_count", "avg_retention_score",
        half_even(F.col("price_max") - F.col("price_min"), 2).alias("price_spread"),
        _percent(F.col("price_std"), mean).alias("price_cv_pct"),
        _percent(listed - mean, listed).alias("avg_discount_pct"))


def price_segments(clean: DataFrame, as_of_year: int = fixed.CURRENT_YEAR) -> DataFrame:
    """Figures, market share, top makes and dominant body per price segment,
    cheapest segment first."""
    unplaced = -1
    placed = clean.withColumn("_segment", F.coalesce(
        bucket_ordinal("current_price", fixed.PRICE_EDGES), F.lit(unplaced)))
    stats = grouped_stats(
        placed, ["_segment"],
        [F.count("*").alias("_rows"), F.count("current_price").alias("listing_count"),
         _mean("current_price").alias("avg_price"), F.min("current_price").alias("min_price"),
         F.max("current_price").alias("max_price"), _mean("mileage").alias("avg_mileage"),
         _mean(age_in_years("year", as_of_year)).alias("avg_vehicle_age"),
         _mean("tp_retention_score").alias("avg_retention_score"),
         _mean("mpg_combined").alias("avg_mpg_combined")],
        {"median_price": "current_price"})
    # the share is of all rows, placed in a segment or not: at most 7 rows here
    total = F.sum("_rows").over(Window.partitionBy())
    table = (rounded(stats, 2).withColumn("_total", total).where(F.col("_segment") != unplaced)
             .withColumn("pct_of_market", _percent(F.col("listing_count"), F.col("_total"))))
    makes = top_n_joined(placed, "_segment", "make", 3, "top_makes")
    bodies = most_frequent(placed, "_segment", "bodytype", "dominant_body_style")
    labels = F.array(*[F.lit(label) for label in fixed.PRICE_LABELS])
    return (table.join(makes, "_segment", "left").join(bodies, "_segment", "left")
            .orderBy("_segment")
            .select(F.get(labels, F.col("_segment")).alias("price_segment"), "listing_count",
                    "avg_price", "median_price", "min_price", "max_price", "avg_mileage",
                    "avg_vehicle_age", "avg_retention_score", "avg_mpg_combined",
                    "pct_of_market", "top_makes", "dominant_body_style"))


def dealer_performance(clean: DataFrame, as_of_year: int = fixed.CURRENT_YEAR) -> DataFrame:
    """Inventory, price, engagement and quality figures per dealer.  A dealer
    lacking any of the key attributes is left out; one whose rating changed
    shows once per rating."""
    means = {"avg_price": "current_price", "avg_list_price": "list_price",
             "avg_mileage": "mileage", "avg_image_count": "image_count",
             "avg_follow_count": "follow_count", "avg_retention_score": "tp_retention_score"}
    flagged = clean.withColumn("_accident", accident_flag("accident_history").cast("double"))
    stats = grouped_stats(
        flagged, fixed.DEALER_KEYS,
        [F.count("listing_id").alias("inventory_count"),
         *[_mean(source).alias(out) for out, source in means.items()],
         (_mean("_accident") * 100.0).alias("pct_accident"),
         half_even(_mean(age_in_years("year", as_of_year)), 1).alias("avg_vehicle_age")],
        {"median_price": "current_price"})
    # repeats of a make go before its dealer's makes are gathered
    makes = (with_keys(clean, fixed.DEALER_KEYS).select(*fixed.DEALER_KEYS, "make").distinct()
             .groupBy(*fixed.DEALER_KEYS).agg(sorted_distinct_joined("make").alias("makes_offered")))
    table = rounded(stats, 2, skip=("dealer_avg_rating", "avg_vehicle_age")).join(makes, list(fixed.DEALER_KEYS), "left")
    listed, price = F.col("avg_list_price"), F.col("avg_price")
    return table.select(
        *fixed.DEALER_KEYS, "inventory_count", "avg_price", "median_price", "avg_list_price",
        "avg_mileage", "avg_image_count", "avg_follow_count", "avg_retention_score",
        "pct_accident", "avg_vehicle_age", "makes_offered",
        _percent(listed - price, listed).alias("avg_discount_pct"),
        inventory_tier().alias("inventory_tier"))


def within_curve(clean: DataFrame, as_of_year: int = fixed.CURRENT_YEAR) -> DataFrame:
    """Listings with a ``vehicle_age`` the depreciation curve covers."""
    aged = clean.withColumn("vehicle_age", age_in_years("year", as_of_year))
    return aged.where(F.col("vehicle_age").between(0, fixed.MAX_CURVE_AGE))


def baseline_prices(curve: DataFrame) -> DataFrame:
    """Per make, the mean of the curve's average prices at ages 0 and 1."""
    return (curve.where(F.col("vehicle_age") <= 1).groupBy("make")
            .agg(F.avg("avg_price").alias("baseline_price")))


def depreciation_curve(clean: DataFrame, as_of_year: int = fixed.CURRENT_YEAR) -> DataFrame:
    """Average price per make and age, against the make's baseline and against
    its next recorded age."""
    stats = grouped_stats(
        within_curve(clean, as_of_year), ["make", "vehicle_age"],
        [F.count("current_price").alias("listing_count"),
         _mean("current_price").alias("avg_price"), _mean("mileage").alias("avg_mileage")],
        {"median_price": "current_price"})
    # a make has at most 26 ages, so both windows share one small partition
    # per make and the baseline needs no second aggregation or join
    by_make = Window.partitionBy("make")
    fresh = F.when(F.col("vehicle_age") <= 1, F.col("avg_price"))
    curve = rounded(stats, 2).withColumns({
        "baseline_price": F.avg(fresh).over(by_make),
        "next_yr_avg_price": F.lead("avg_price").over(by_make.orderBy("vehicle_age")),
    })
    price = F.col("avg_price")
    return curve.select(
        "make", "vehicle_age", "listing_count", "avg_price", "median_price", "avg_mileage",
        "baseline_price", _percent(price, F.col("baseline_price")).alias("retained_value_pct"),
        "next_yr_avg_price",
        _percent(price - F.col("next_yr_avg_price"), price).alias("yoy_depreciation_pct"))
