"""Marts against a brute-force computation in pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt.plans import gold, summaries
from tests.listing_fixtures import silver_row, silver_table
from forecourt.operators.shape import SILVER

@pytest.fixture(scope="module")
def clean(spark):
    return gold.clean_listings(silver_table(spark)).cache()


@pytest.fixture(scope="module")
def frame(clean):
    return clean.toPandas()


def same(got: pd.DataFrame, want: pd.DataFrame, keys: list[str]):
    got = got.sort_values(keys).reset_index(drop=True)
    want = want.sort_values(keys).reset_index(drop=True)
    assert len(got) == len(want)
    for c in want.columns:
        if pd.api.types.is_numeric_dtype(want[c]):
            assert np.allclose(got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=0.0051, equal_nan=True), c
        else:
            a, b = got[c].where(got[c].notna(), None), want[c].where(want[c].notna(), None)
            assert list(a) == list(b), c


def test_clean_listings(frame):
    assert (frame.current_price > 0).all() and (frame.mileage >= 0).all()
    assert set(frame.year) <= {2027, 2026, 2025, 2020, 2001, 2000}
    assert set(frame.make) == {"FORD", "KIA", "AUDI", fixed.NULL_TEXT}


def few(spark, *rows):
    """Listings of one make from (model, year, price, mileage)."""
    return gold.clean_listings(spark.createDataFrame(
        [silver_row(make="a", model=m, bodytype="c", year=y, current_price=p, mileage=n) for m, y, p, n in rows], SILVER))


def test_market_summary(spark):
    got = gold.market_summary(few(spark, ("x", 2020, 10.0, 100), ("x", 2020, 20.0, 300), ("x", 2020, 60.0, 200), ("y", 2021, 5.0, 1)))
    assert len(got.columns) == 22
    x, y = sorted(got.collect(), key=lambda r: r.model)
    assert (x.listing_count, x.price_min, x.price_mean, x.price_median, x.median_mileage) == (3, 10.0, 30.0, 20.0, 200.0)
    assert x.price_std == pytest.approx(26.46, abs=0.01)      # sqrt((400 + 100 + 900) / 2)
    assert (y.listing_count, y.price_mean, y.price_median) == (1, 5.0, 5.0)


def test_median_leaves_out_nan(spark):
    from forecourt.operators.quantiles import grouped_stats
    nan = float("nan")
    rows = spark.createDataFrame([("g", v) for v in (1.0, 2.0, nan, nan, nan, None)], "k string, v double")
    assert grouped_stats(rows, ["k"], [F.count("*").alias("n")], {"m": "v"}).first().m == 1.5


def test_market_summary_single_row_group_has_null_std(spark):
    one = spark.createDataFrame([silver_row(make="a", model="b", bodytype="c", year=2020, current_price=10.0, mileage=1,
                                            list_price=0.0)], SILVER)
    row = gold.market_summary(gold.clean_listings(one)).first()
    assert row.price_std is None and row.price_cv_pct is None and row.avg_discount_pct is None


def test_price_segments(spark):
    now = fixed.CURRENT_YEAR
    rows = [("kia", "suv", 9_000.0, 10, now), ("kia", "suv", 9_500.0, 30, now - 2), ("ford", "van", 5_000.0, 50, now - 4),
            ("audi", "van", 70_000.0, 5, now)]
    table = gold.clean_listings(spark.createDataFrame(
        [silver_row(make=m, model="x", bodytype=b, current_price=p, mileage=n, year=y) for m, b, p, n, y in rows], SILVER))
    low, high = gold.price_segments(table).collect()          # cheapest first
    assert (low.listing_count, low.median_price, low.min_price, low.max_price) == (3, 9_000.0, 5_000.0, 9_500.0)
    assert (low.avg_mileage, low.avg_vehicle_age, low.pct_of_market) == (30.0, 2.0, 75.0)
    assert (low.top_makes, low.dominant_body_style) == ("KIA, FORD", "SUV")
    assert (high.listing_count, high.median_price, high.pct_of_market, high.top_makes) == (1, 70_000.0, 25.0, "AUDI")
    assert [low.price_segment, high.price_segment] == [fixed.PRICE_LABELS[0], fixed.PRICE_LABELS[4]]


def test_dealer_performance(spark):
    now, told = fixed.CURRENT_YEAR, {"dealer_name": "Joe", "dealer_city": "x", "dealer_state": "y", "dealer_type": "new",
                                     "dealer_review_count": 3, "dealer_avg_rating": 4.5}
    rows = [("D1", "kia", 100.0, 120.0, now, "L1", '{"icon":"accident"}'), ("D1", "ford", 300.0, 360.0, now - 1, "L2", None),
            ("D1", "kia", 200.0, 240.0, now - 4, None, "{}"), ("D1", "kia", 200.0, 240.0, now - 5, "L4", None),
            (None, "kia", 1.0, 1.0, now, "L5", None)]         # no dealer key
    table = gold.clean_listings(spark.createDataFrame(
        [silver_row(dealer_carfax_id=d, make=m, current_price=p, list_price=lp, year=y, listing_id=i, accident_history=a, mileage=1,
                    **told) for d, m, p, lp, y, i, a in rows], SILVER))
    got = gold.dealer_performance(table)
    assert len(got.columns) == 20
    one = {r.dealer_carfax_id: r for r in got.collect()}["D1"]
    assert (one.inventory_count, one.avg_price, one.median_price, one.avg_list_price) == (3, 200.0, 200.0, 240.0)
    assert (one.pct_accident, one.avg_vehicle_age, one.makes_offered) == (25.0, 2.5, "FORD, KIA")
    assert one.avg_discount_pct == pytest.approx(16.67, abs=0.01)


def test_depreciation_curve(spark):
    now = fixed.CURRENT_YEAR
    got = gold.depreciation_curve(few(spark, ("x", now, 100.0, 1), ("x", now - 1, 80.0, 1), ("x", now - 1, 60.0, 1),
                                      ("x", now - 4, 34.0, 1), ("x", now - 26, 9.0, 1)))
    assert len(got.columns) == 10
    new, one, four = sorted(got.collect(), key=lambda r: r.vehicle_age)   # age 26 is beyond the curve
    assert [(r.vehicle_age, r.listing_count, r.avg_price) for r in (new, one, four)] == [(0, 1, 100.0), (1, 2, 70.0), (4, 1, 34.0)]
    assert new.baseline_price == one.baseline_price == four.baseline_price == 85.0   # mean of ages 0 and 1
    assert (new.next_yr_avg_price, one.next_yr_avg_price, four.next_yr_avg_price) == (70.0, 34.0, None)
    assert (one.retained_value_pct, new.yoy_depreciation_pct) == (pytest.approx(82.35, abs=0.01), 30.0)


def test_listings_enriched(spark, clean):
    priced = gold.listings_enriched(few(spark, ("x", 2020, 10.0, 1), ("x", 2020, 20.0, 1), ("x", 2020, 60.0, 1), ("y", 2020, 5.0, 1)))
    assert sorted((r.current_price, r.segment_median_price) for r in priced.collect()) == [(5.0, 5.0), (10.0, 20.0), (20.0, 20.0), (60.0, 20.0)]
    out = gold.listings_enriched(clean, "2026-02-01 00:00:00")
    assert len(out.columns) == 70 and dict(out.dtypes)["first_seen"] == "timestamp"
    got = out.toPandas()
    assert set(got.days_on_market.dropna()) == {31}
    noterm = got[~(got.monthly_term_months > 0)]
    assert noterm.monthly_pmt_pct_of_price.isna().all()
    assert got[got.list_price.isna() | (got.list_price == 0)].price_discount_pct.isna().all()
    assert got[got.mileage == 0].cost_per_mile.isna().all()
    assert got.quality_score.between(0, 1).all() and got.option_count.isin([0, 2]).all()


def test_segments_sum_to_total(clean, frame):
    total = gold.price_segments(clean).agg(F.sum("listing_count"), F.sum("pct_of_market")).first()
    assert total[0] == len(frame) and abs(total[1] - 100) < 0.1


def market(spark, rows):
    return spark.createDataFrame(rows, "make string, year long, bodytype string, listing_count long, price_mean double, "
                                 "price_median double, price_cv_pct double, avg_mpg_combined double, avg_discount_pct double, avg_mileage double")


def test_summaries(spark):
    m = market(spark, [("a", 2016, "suv", 60, 10.0, 9.0, 5.0, 20.0, 1.0, 1.0), ("a", 2014, "suv", 40, 20.0, 19.0, None, 0.0, 3.0, 2.0),
                       ("b", 2015, "van", 30, 30.0, 29.0, 50.0, 0.0, None, 3.0), ("c", 2016, "cab", 19, 1.0, 1.0, 1.0, 9.0, 9.0, 4.0)])
    assert [tuple(r) for r in summaries.top_makes(m, 2).collect()] == [("a", 100), ("b", 30)]
    assert [tuple(r) for r in summaries.price_by_body(m).collect()] == [("van", 29.0, 30), ("suv", 14.0, 100)]
    assert [tuple(r) for r in summaries.price_variability(m).collect()] == [("a", 5.0, 100)]
    assert [tuple(r) for r in summaries.mpg_by_body(m).collect()] == [("suv", 10.0, 100)]
    assert [tuple(r) for r in summaries.discount_by_make(m).collect()] == [("a", 2.0, 100)]
    assert summaries.price_vs_mileage(m, 1).count() == 2
    assert [r["year"] for r in summaries.year_price_trend(m, 1).collect()] == [2014, 2016]
    heat = summaries.listing_heatmap(m)
    assert heat.columns == ["make", "2015", "2016"]
    assert [tuple(r) for r in heat.collect()] == [("a", 0, 60), ("b", 30, 0), ("c", 0, 19)]
