"""Shapes of physical plans: what reaches the scan, what crosses a shuffle."""

import re

import pytest
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt.operators import frequency, keys, quantiles
from forecourt.plans import gold, jobs, profile, quality
from forecourt.sources import writers
from tests.listing_fixtures import silver_table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df)


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("silver"))
    writers.write_silver(silver_table(spark, 300), f"{root}/listings", "r")
    return jobs.SilverLake(root).read(spark)


def test_validity_filter_and_columns_reach_the_scan(silver):
    text = plan(gold.market_summary(gold.clean_listings(silver)))
    scans = text.split("FileScan parquet")[1:]
    assert text.count("upper(") == 3 * len(scans)  # make, model and bodytype are cleaned once a scan
    for scan in scans:
        pushed = re.search(r"PushedFilters: \[(.*?)\]", scan)[1]
        for part in ("GreaterThan(current_price,0.0)", "GreaterThanOrEqual(year,1980)", "GreaterThanOrEqual(mileage,0)"):
            assert part in pushed
        read = re.search(r"ReadSchema: struct<(.*)>", scan)[1]
        assert "images" not in read and "vin" not in read


def test_market_summary_reads_the_table_twice(silver):
    text = final_plan(gold.market_summary(gold.clean_listings(silver)))
    text = text[:text.index("== Initial Plan ==")]
    assert text.count("FileScan parquet") == 2 and "percentile" not in text
    # one scan has all measures, the other what the medians need
    reads = sorted(re.findall(r"ReadSchema: struct<(.*?)>", text), key=len)
    assert "mpg_city" not in reads[0] and "mpg_city" in reads[1]


def test_first_per_key_cuts_before_the_shuffle(silver):
    text = plan(keys.first_per_key(silver, ["vin"], ["_source_file"]))
    final, partial = text.index("Final"), text.index("Partial")
    assert final < text.index("Exchange hashpartitioning(vin") < partial


def test_enriched_broadcasts_small_medians_and_shuffles_no_wide_rows(silver):
    text = plan(gold.listings_enriched(gold.clean_listings(silver), "2026-01-01 00:00:00"))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text and "Window" not in text


def test_enriched_falls_back_to_a_shuffle_join(spark, silver):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = gold.listings_enriched(gold.clean_listings(silver), "2026-01-01 00:00:00")
        assert "SortMergeJoin" in plan(rows)
        large = {r.vin: r.segment_median_price for r in rows.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    small = gold.listings_enriched(gold.clean_listings(silver), "2026-01-01 00:00:00")
    assert large == {r.vin: r.segment_median_price for r in small.collect()}


def test_skewed_join_is_split(spark, silver):
    """With tiny thresholds AQE splits the hot group's partition of the join."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2048",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4096",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 20000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("m"), F.col("id") % 50)).alias("make"),
            F.lit("x").alias("model"), F.lit(2020).cast("bigint").alias("year"), F.col("id").cast("double").alias("current_price"),
            F.repeat(F.sha2(F.col("id").cast("string"), 256), 4).alias("payload"))
        out = gold.with_segment_median(rows)
        assert "isSkew=true" in final_plan(out) or "skew=true" in plan(out)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_stored_keys_are_reduced_before_the_anti_join(silver):
    text = plan(keys.drop_known_keys(silver.where("year = 2020"), silver, "vin"))
    assert "LeftAnti" in text and "LeftSemi" in text and "Cartesian" not in text


def test_quantiles_never_gather_a_group(spark):
    df = spark.range(1000).select(F.lit("k").alias("k"), F.col("id").cast("double").alias("v"))
    text = plan(quantiles.exact_quantiles(df, ["k"], "v", [0.5]))
    assert "percentile" not in text and "collect_list" not in text
    # copies are combined, then spread by group and value; ranks are found in sums of buckets and inside a bucket
    assert re.search(r"Exchange hashpartitioning\([^)]*_value#\d+, \d+\)", text)
    assert re.search(r"Exchange hashpartitioning\([^)]*_bucket#\d+L, \d+\)", text)


def test_text_reports_read_the_counted_values(silver):
    for report in (profile.string_profile, quality.text_samples):
        text = final_plan(report(silver, ["make", "model"]))
        assert "text-counts" in text and all("make" not in r for r in re.findall(r"ReadSchema: struct<(.*?)>", text))
