"""Summary tables over the market summary mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.operators.frequency import pivot_sum
from forecourt.operators.keys import keep_keys, top_keys, with_keys
from forecourt.operators.quantiles import grouped_stats


def top_makes(market: DataFrame, k: int = 15) -> DataFrame:
    """Makes with the most listings."""
    return top_keys(market, "make", "listing_count", k)


def price_by_body(market: DataFrame, min_listings: int = 20) -> DataFrame:
    """Median of the group medians per body type, dearest first."""
    table = grouped_stats(market, ["bodytype"], [F.sum("listing_count").alias("count")],
                          {"median_price": "price_median"})
    table = table.select("bodytype", "median_price", "count")
    return table.where(F.col("count") >= min_listings).orderBy(F.desc("median_price"), "bodytype")


def price_vs_mileage(market: DataFrame, k: int = 10) -> DataFrame:
    """Price and mileage of every group of the leading makes."""
    leading = keep_keys(market, top_keys(market, "make", "listing_count", k), "make")
    return leading.select("make", "avg_mileage", "price_mean", "listing_count")


def year_price_trend(market: DataFrame, k: int = 5) -> DataFrame:
    """Mean group price per model year of the leading makes."""
    leading = keep_keys(market, top_keys(market, "make", "listing_count", k), "make")
    return (with_keys(leading, ["year"]).groupBy("make", "year")
            .agg(F.avg("price_mean").alias("price_mean")).orderBy("make", "year"))


def listing_heatmap(market: DataFrame, k: int = 10, from_year: int = 2015,
                    years: Sequence[int] | None = None) -> DataFrame:
    """Listings per leading make and model year.  Without ``years`` one small
    job finds the years (the mart holds at most the valid model years)."""
    leading = keep_keys(market, top_keys(market, "make", "listing_count", k), "make")
    if years is None:
        found = leading.where(F.col("year") >= from_year).select("year").distinct()
        years = sorted(row["year"] for row in found.collect())
    return pivot_sum(leading, "make", "year", "listing_count", list(years)).orderBy("make")


def price_variability(market: DataFrame, k: int = 15, min_listings: int = 50) -> DataFrame:
    """Price variation per make, weighted by listings, widest first."""
    cv, n = F.col("price_cv_pct"), F.col("listing_count")
    table = with_keys(market, ["make"]).groupBy("make").agg(
        F.try_divide(F.sum(cv * n), F.sum(F.when(cv.isNotNull(), n))).alias("weighted_cv"),
        F.sum(n).alias("total_listings"))
    return (table.where(F.col("weighted_cv").isNotNull() & (F.col("total_listings") >= min_listings))
            .orderBy(F.desc("weighted_cv"), "make").limit(k))


def mpg_by_body(market: DataFrame, min_listings: int = 20) -> DataFrame:
    """Mean combined economy per body type, thirstiest first."""
    table = with_keys(market, ["bodytype"]).groupBy("bodytype").agg(
        F.avg("avg_mpg_combined").alias("avg_mpg"), F.sum("listing_count").alias("count"))
    return (table.where((F.col("count") >= min_listings) & (F.col("avg_mpg") > 0))
            .orderBy("avg_mpg", "bodytype"))


def discount_by_make(market: DataFrame, k: int = 15, min_listings: int = 50) -> DataFrame:
    """Mean discount per make, deepest first."""
    table = with_keys(market, ["make"]).groupBy("make").agg(
        F.avg("avg_discount_pct").alias("avg_disc"), F.sum("listing_count").alias("count"))
    return (table.where(F.col("count") >= min_listings)
            .orderBy(F.desc_nulls_last("avg_disc"), "make").limit(k))


def market_overview(market: DataFrame) -> DataFrame:
    """Rows, makes and model years of the mart."""
    return market.agg(F.count("*").alias("rows"), F.count_distinct("make").alias("makes"),
                      F.min("year").alias("first_year"), F.max("year").alias("last_year"))
