import pytest
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt import functions as fn
from forecourt.plans import gold


def values(spark, inputs, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", expression(F.col("v")).alias("o")).orderBy("i").collect()]


def test_half_even_breaks_ties_like_arrays_do(spark):
    assert values(spark, [0.125, 0.375, 2.675, -0.125, None], lambda c: fn.half_even(c, 2), "double") == [
        0.12, 0.38, round(2.675 * 100) / 100, -0.12, None]


@pytest.mark.parametrize("price,label", [
    (None, None), (-1.0, None), (0.01, "Budget"), (9999.99, "Budget"), (10000.0, "Economy"),
    (20000.0, "Mid-Range"), (35000.0, "Premium"), (60000.0, "Luxury"), (99999.99, "Luxury"),
    (100000.0, "Ultra-Luxury"), (1e9, "Ultra-Luxury")])
def test_price_segment_edges(spark, price, label):
    assert values(spark, [price], gold.price_segment, "double") == [label]


def test_mileage_band_edges(spark):
    assert values(spark, [0, 19999, 20000, 50000, 100000, 150000, None], gold.mileage_band, "long") == [
        "Very Low (<20k)", "Very Low (<20k)", "Low (20-50k)", "Mid (50-100k)", "High (100-150k)",
        "Very High (150k+)", None]


def test_inventory_tier_closes_on_the_right(spark):
    assert values(spark, [0, 1, 10, 11, 50, 51, 150, 151, None], gold.inventory_tier, "long") == [
        None, "Small (<10)", "Small (<10)", "Mid (10-50)", "Mid (10-50)", "Large (50-150)",
        "Large (50-150)", "Super (150+)", None]


def test_bucket_ordinal_matches_labels(spark):
    ordinals = values(spark, [0.0, 10000.0, 1e6, -5.0, None],
                      lambda c: fn.bucket_ordinal(c, fixed.PRICE_EDGES), "double")
    assert ordinals == [0, 1, 5, None, None]


def test_clip_keeps_null(spark):
    assert values(spark, [-1.0, 0.5, 2.0, None], lambda c: fn.clip(c, 0.0, 1.0), "double") == [0.0, 0.5, 1.0, None]


def test_guarded_ratio(spark):
    assert values(spark, [4.0, 0.0, -2.0, None], lambda c: fn.guarded_ratio(F.lit(1.0), c, 2), "double") == [
        0.25, None, None, None]


def test_compare_to_band(spark):
    got = values(spark, [89.9, 90.0, 100.0, 110.5, None],
                 lambda c: fn.compare_to_band(c, F.lit(100.0), fixed.MARKET_BAND, fixed.MARKET_LABELS), "double")
    assert got == ["Below Market", "At Market", "At Market", "Above Market", None]


def test_number_or_null(spark):
    assert values(spark, ["1.5", " 2 ", "abc", "NaN", "", None], fn.number_or_null) == [1.5, 2.0, None, None, None, None]


def test_whole_number_or_null(spark):
    got = values(spark, ["12", "12.0", "12.5", "1e3", "abc", "NaN", "Infinity", "9007199254740993", None],
                 fn.whole_number_or_null)
    assert got == [12, 12, None, 1000, None, None, None, 9007199254740993, None]


def test_strip_removes_any_whitespace(spark):
    assert values(spark, [" \t a b  \n", "　", None], fn.strip) == ["a b", "", None]


def test_clean_upper_and_zip5(spark):
    assert values(spark, ["  ford\t"], fn.clean_upper) == ["FORD"]
    assert values(spark, [" 30301-1234", "301", None], fn.zip5) == ["30301", "301", None]


def test_filled_and_blank(spark):
    assert values(spark, ["a", " \t", "", None], fn.is_filled) == [True, False, False, False]
    assert values(spark, ["a", " \t", "", None], fn.is_blank) == [False, True, True, None]


SNAKES = {"sortTPScore": "sort_tp_score", "listPrice": "list_price", "vin": "vin", "tpRetentionScore": "tp_retention_score",
          "mpgCity": "mpg_city", "onePriceArrows": "one_price_arrows", "already_snake": "already_snake"}


def test_snake_case_name_and_value_agree(spark):
    assert {n: fn.snake_name(n) for n in SNAKES} == SNAKES
    assert values(spark, list(SNAKES), fn.snake_case) == list(SNAKES.values())


def test_iso_utc(spark):
    got = values(spark, ["2024-01-05", "2024-01-05T10:00:00Z", "2024-01-05T10:00:00+02:00", "garbage", None], fn.iso_utc)
    assert got == ["2024-01-05T00:00:00Z", "2024-01-05T10:00:00Z", "2024-01-05T08:00:00Z", None, None]


def test_days_since(spark):
    got = values(spark, ["2024-01-01", "2024-01-10T12:00:00", "2024-02-01", None],
                 lambda c: fn.days_since(fn.timestamp_or_null(c), "2024-01-11 00:00:00"))
    assert got == [10, 0, 0, None]


ODD_JSON = ["{}", "[]", "null", '"x"', '{"history":null}', '{"history":[]}', '{"history":[1,{"a":2}]}', "{broken", None]


def test_owner_count(spark):
    assert values(spark, ODD_JSON, fn.owner_count) == [0, None, None, None, None, 0, 2, None, None]


def test_service_event_count(spark):
    got = values(spark, ['{"number":0}', '{"number":"12"}', '{"number":3.7}', '{"number":"3.7"}', '{"number":5}', "{}",
                         "[]", '{"number":null}', "x", None], fn.service_event_count)
    assert got == [None, 12, 3, None, 5, None, None, None, None, None]


def test_accident_flag(spark):
    got = values(spark, ['{"icon":"Accident"}', '{"icon":"noAccident"}', '{"icon":"clean"}', '{"icon":null}', "{}", "[]",
                         "broken", None], fn.accident_flag)
    assert got == [True, True, False, False, False, False, False, False]


def test_json_list_size(spark):
    assert values(spark, ['["a","b"]', "[]", "{}", "bad", None], fn.json_list_size) == [2, 0, 0, 0, 0]


def test_quality_score(spark):
    df = spark.createDataFrame([(0, 0, False, 20), (30, 300000, True, None), (10, 100000, False, 5)],
                               "a long, m long, acc boolean, s long")
    got = [r[0] for r in df.select(gold.quality_score(F.col("a"), F.col("m"), F.col("acc"), F.col("s"))).collect()]
    assert got[:2] == [1.0, 0.0]
    assert abs(got[2] - 0.5875) <= 0.0005


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_iso_utc_in_any_session_zone(spark, zone):
    from forecourt.functions import days_since, iso_utc, timestamp_or_null

    texts = ["2024-01-05", "2024-01-05T00:00:00Z", "2024-01-05 10:00:00+02:00", "2024-03-10 02:30:00", "2024", "2024-02",
             "garbage", None, "01/15/2024", "20240115", "2024-1-5T1:2:3.5"]
    want = ["2024-01-05T00:00:00Z", "2024-01-05T00:00:00Z", "2024-01-05T08:00:00Z", "2024-03-10T02:30:00Z", "2024-01-01T00:00:00Z",
            "2024-02-01T00:00:00Z", None, None, "2024-01-15T00:00:00Z", "2024-01-15T00:00:00Z", "2024-01-05T01:02:03Z"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
        got = frame.select("i", iso_utc("t", ["MM/dd/yyyy", "yyyyMMdd"]).alias("x")).collect()
        assert [r.x for r in sorted(got)] == want
        age = frame.where("i = 0").select(days_since(timestamp_or_null("t"), "2024-01-07").alias("d")).first()
        assert age.d == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
