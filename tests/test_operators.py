import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt.operators import frequency, keys, quantiles, routing, shape


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- quantiles ---------------------------------------------------------------

def skewed(spark, seed=1):
    """One group with a third of all rows, one of a single value, negatives,
    outliers, heavy ties and near-equal values."""
    rng = np.random.default_rng(seed)
    data = [("hot", float(v)) for v in np.concatenate([
        rng.lognormal(10, 1, 1500), [1e15, -1e15, 0.0, -0.0, 1e-300], 30000 + rng.random(500) * 1e-6])]
    data += [("ties", float(v)) for v in rng.integers(0, 3, 900)]
    data += [("negative", float(-v)) for v in rng.lognormal(3, 2, 901)]
    data += [("single", 7.25)] + [("pair", 1.0), ("pair", 2.0)]
    return spark.createDataFrame(data, "k string, v double"), data


def test_exact_quantiles_agree_with_numpy(spark):
    df, data = skewed(spark)
    fractions = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r["k"]: r["quantiles"] for r in quantiles.exact_quantiles(df, ["k"], "v", fractions).collect()}
    for key in {k for k, _ in data}:
        want = np.quantile([v for k, v in data if k == key], fractions)
        assert np.allclose(got[key], want, rtol=1e-12, atol=0), key


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.floats(allow_nan=False, allow_infinity=False, width=64, min_value=-1e12, max_value=1e12),
                          st.floats(min_value=-1e-8, max_value=1e-8), st.sampled_from([0.0, -0.0, 5e-324, -5e-324, 1.0, 2.0])),
                min_size=1, max_size=60))
def test_quantiles_property(spark, numbers):
    df = spark.createDataFrame([(1, v) for v in numbers], "k int, v double")
    got = quantiles.exact_quantiles(df, ["k"], "v", [0.0, 0.5, 1.0]).first()["quantiles"]
    assert got[0] == min(numbers) and got[2] == max(numbers)
    assert np.isclose(got[1], np.median(numbers), rtol=1e-12, atol=0)


def test_buckets_rise_with_the_value_and_part_small_ones(spark):
    inf = float("inf")
    rng = np.random.default_rng(4)
    values = sorted([-inf, inf, 0.0, 5e-324, -5e-324, 1.0, -1.0, 1e308, -1e308] + list(rng.standard_normal(500) * 10.0 ** rng.integers(-300, 300, 500)))
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double")
    found = [r.b for r in df.select("i", quantiles.magnitude_bucket(F.col("v")).alias("b")).orderBy("i").collect()]
    assert found == sorted(found) and len(set(found)) > 500
    tiny = spark.range(1, 100_001).select((F.col("id") * 1e-13).alias("v")).select(quantiles.magnitude_bucket(F.col("v")).alias("b"))
    assert tiny.groupBy("b").count().agg(F.max("count")).first()[0] < 10


def test_quantiles_skip_null_and_nan(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", float("nan")), ("a", 3.0), ("b", None)],
                               "k string, v double")
    assert rows(quantiles.exact_quantiles(df, ["k"], "v", [0.5])) == [("a", [2.0])]
    assert quantiles.exact_quantiles(df.limit(0), ["k"], "v", [0.5]).count() == 0


def test_grouped_stats(spark):
    df, data = skewed(spark, seed=2)
    df = df.withColumn("w", F.abs("v")).unionByName(
        spark.createDataFrame([(None, 1.0, 1.0), ("none", None, None)], "k string, v double, w double"))
    got = quantiles.grouped_stats(df, ["k"], [F.count("v").alias("n"), F.max("v").alias("top")], {"mid_v": "v", "mid_w": "w"})
    assert got.columns == ["k", "n", "top", "mid_v", "mid_w"]
    found = {r.k: r for r in got.collect()}
    assert len(found) == 6 and (found["none"].n, found["none"].mid_v) == (0, None)      # null key dropped
    for key in {k for k, _ in data}:
        values = np.array([v for k, v in data if k == key])
        assert found[key].n == len(values) and np.isclose(found[key].mid_v, np.median(values), rtol=1e-12)
        assert np.isclose(found[key].mid_w, np.median(np.abs(values)), rtol=1e-12)


def test_grouped_stats_reads_its_table_twice_and_runs_nothing_before(spark, folder):
    df, _ = skewed(spark)
    df.withColumn("w", F.abs("v")).withColumn("wide", F.lit("x")).write.parquet(f"{folder}/t")
    table = spark.read.parquet(f"{folder}/t")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("stats", "")
    got = quantiles.grouped_stats(table, ["k"], [F.count("v").alias("n")], {"mid_v": "v", "mid_w": "w"})
    assert list(tracker.getJobIdsForGroup("stats")) == []
    assert len(got.collect()) == 5
    final = got._jdf.queryExecution().executedPlan().toString()
    final = final[:final.index("== Initial Plan ==")]
    assert final.count("FileScan parquet") == 2 and "wide" not in final
    assert "ReusedExchange" in final or final.count("Exchange hashpartitioning") <= 8


# --- text values -------------------------------------------------------------

def odd_values(spark):
    """Ties, blanks, nulls, long values of one beginning, a value that holds a third of the rows."""
    rng = np.random.default_rng(6)
    long = ["x" * 24 + str(i) for i in range(40)] + ["x" * 24, "é" * 30 + "a", "é" * 30 + "b"]
    data = [(str(rng.choice(long)), str(rng.choice(["", " ", "a", "b", "hot", "hot", "hot"])), f"v{i}", None) for i in range(600)]
    data += [(None, None, None, None)] * 30
    return spark.createDataFrame(data, "long string, few string, unique string, none string").repartition(5), data


def test_text_counts_choose_what_plain_counting_does(spark):
    from collections import Counter

    from forecourt.operators import textvalues

    df, data = odd_values(spark)
    columns = df.columns
    counts = textvalues.text_counts(df, columns).cache()
    plain = {c: Counter(row[i] for row in data if row[i] is not None) for i, c in enumerate(columns)}
    assert {r[0]: r[1] for r in counts.groupBy("column").count().collect()} == {c: len(n) for c, n in plain.items() if n}
    for k in (1, 3, 10, 100):
        for by_count in (True, False):
            got = textvalues.chosen_values(counts, df, k, by_count).collect()
            for c in columns:
                order = sorted(plain[c].items(), key=(lambda v: (-v[1], v[0])) if by_count else (lambda v: v[0]))[:k]
                assert sorted((r.value, r.n) for r in got if r["column"] == c) == sorted(order), (c, k, by_count)


def test_text_counts_shuffle_no_whole_texts(spark, folder):
    from forecourt.operators import textvalues

    df, _ = odd_values(spark)
    df.write.parquet(f"{folder}/t")
    counts = textvalues.text_counts(spark.read.parquet(f"{folder}/t"), df.columns)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    grouped = [line for line in plan.splitlines() if "HashAggregate(keys" in line]
    assert grouped and all("value#" not in line.split("keys=")[1].split("]")[0] for line in grouped)


def test_sketches_count_about_right_and_merge(spark):
    from forecourt.operators import textvalues
    from forecourt.plans import quality

    a = spark.range(20_000).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("t"), F.lit(" ").alias("blank"))
    b = a.union(spark.range(15_000, 30_000).select(F.concat(F.lit("v"), F.col("id").cast("string")), F.lit(None)))
    both = textvalues.text_sketches(a, ["t", "blank"]).unionAll(textvalues.text_sketches(b, ["t", "blank"]))
    got = {r["column"]: r["n"] for r in textvalues.merged_sketches(both).select("column", textvalues.sketched_count().alias("n")).collect()}
    assert abs(got["t"] - 30_000) < 1500 and got["blank"] == 0
    near = {r["column"]: r for r in quality.text_samples(b, ["t", "blank"], approximate=True).collect()}
    assert abs(near["t"].unique_count - 30_000) < 1500 and 0 < len(near["t"].sample_values) <= 5
    assert (near["blank"].unique_count, near["blank"].sample_values) == (0, [])
    assert quality.text_samples(b.limit(0), ["t"], approximate=True).first().unique_count == 0


# --- keys --------------------------------------------------------------------

def test_first_per_key(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, o int, t string")
    assert rows(keys.first_per_key(df, ["k"], ["o"])) == [("a", 1, "y"), ("b", 5, "z")]
    assert keys.first_per_key(df, ["k"], [F.desc("o")], k=2).count() == 3


def test_drop_known_keys(spark):
    batch = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    known = spark.createDataFrame([("b", 0), ("c", 0), ("b", 9)], "k string, m int")
    assert rows(keys.drop_known_keys(batch, known, "k")) == [("a", 1), (None, 3)]


def test_top_and_keep(spark):
    df = spark.createDataFrame([("a", 1), ("b", 5), ("c", 5), (None, 99)], "make string, n int")
    best = keys.top_keys(df, "make", "n", 2)
    assert [r["make"] for r in best.collect()] == ["b", "c"]
    assert rows(keys.keep_keys(df, best, "make")) == [("b", 5), ("c", 5)]


def test_duplicate_count_treats_nulls_as_one_value(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,), (None,)], "vin string")
    assert keys.duplicate_count(df, "vin").first()[0] == 3
    assert keys.duplicate_count(df.limit(0), "vin").first()[0] == 0


# --- frequency ---------------------------------------------------------------

def test_top_n_joined_ties_ascend(spark):
    df = spark.createDataFrame([("s", m) for m in "bbaaccccd"] + [("s", None), (None, "q")], "g string, m string")
    assert rows(frequency.top_n_joined(df, "g", "m", 3, "top")) == [("s", "c, a, b")]
    assert rows(frequency.most_frequent(df, "g", "m", "mode")) == [("s", "c")]
    tied = df.where("m in ('a','b')")
    assert rows(frequency.most_frequent(tied, "g", "m", "mode")) == [("s", "a")]


def test_sorted_distinct_joined(spark):
    df = spark.createDataFrame([("d", "VW"), ("d", "AUDI"), ("d", "VW"), ("d", None)], "k string, m string")
    assert df.groupBy("k").agg(frequency.sorted_distinct_joined("m").alias("x")).first()["x"] == "AUDI, VW"


def test_pivot_fills_zero(spark):
    df = spark.createDataFrame([("a", 2015, 3), ("a", 2016, 1), ("b", 2016, 2), ("b", None, 7)],
                               "make string, year int, n int")
    assert rows(frequency.pivot_sum(df, "make", "year", "n", [2015, 2016])) == [("a", 3, 1), ("b", 0, 2)]


def test_split_counts(spark):
    df = spark.createDataFrame([("a;b;",), ("a;",), (" a ;;",), (None,)], "r string")
    assert [tuple(r) for r in frequency.split_counts(df, "r", ";", "reason").collect()] == [("a", 3), ("b", 1)]


def test_union_all_promotes(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2, "y")], "x int, y string")
    assert rows(frequency.union_all([a, b], promote=True)) == [(1, None), (2, "y")]


# --- shape and routing -------------------------------------------------------

def test_enforce_schema_fixes_every_type(spark):
    odd = spark.createDataFrame([("v", "2020.0", "x", 7, "9.5")], "vin string, year string, mileage string, "
                                "image_count int, list_price string").withColumn("extra", F.lit(1))
    out = shape.enforce_schema(odd)
    assert out.dtypes == list(fixed.SILVER_COLUMNS.items()) and len(out.columns) == 67
    row = out.first()
    assert (row.vin, row.year, row.mileage, row.image_count, row.list_price) == ("v", 2020, None, 7, 9.5)
    assert row.make is None


def test_silver_contract_counts():
    kinds = list(fixed.SILVER_COLUMNS.values())
    assert (len(kinds), kinds.count("string"), kinds.count("bigint"), kinds.count("double")) == (67, 43, 7, 17)


def test_flatten_struct_null_and_missing(spark):
    df = spark.createDataFrame([(1, ("n",)), (2, None)], "i int, dealer struct<name:string>")
    out = shape.flatten_struct(df, "dealer", {"name": "dealer_name", "city": "dealer_city"})
    assert rows(out) == [(1, "n", None), (2, None, None)]
    assert rows(shape.flatten_struct(df.drop("dealer"), "dealer", {"name": "dealer_name"})) == [(1, None), (2, None)]


def test_nested_to_json_keeps_null(spark):
    df = spark.createDataFrame([(["a"], (1, None)), (None, None)], "l array<string>, s struct<x:int,y:int>")
    assert rows(shape.nested_to_json(df)) == [('["a"]', '{"x":1,"y":null}'), (None, None)]


def test_drop_columns_ignores_absent(spark):
    assert shape.drop_columns(spark.range(1).withColumn("b", F.lit(1)), ["b", "nope"]).columns == ["id"]


@pytest.mark.parametrize("vin,year,mileage,reason", [
    ("v", 2000, 5, ""), (None, 2000, None, "missing_vin;"), (" \t", 2000, 0, "missing_vin;"),
    ("v", None, 1, "invalid_year;"), ("v", 1899, 1, "invalid_year;"), ("v", 1900, 1, ""), ("v", 2030, 1, ""),
    ("v", 2031, 1, "invalid_year;"), ("v", 2000, -1, "negative_mileage;"),
    ("", 1, -1, "missing_vin;invalid_year;negative_mileage;")])
def test_listing_rules(spark, vin, year, mileage, reason):
    df = spark.createDataFrame([(vin, year, mileage)], "vin string, year long, mileage long")
    assert routing.mark_rejections(df, routing.listing_rules()).first()["_rejection_reason"] == reason


def test_quarantine_keeps_every_row(spark):
    df = spark.createDataFrame([("v", y, m) for y in (None, 1800, 2000) for m in (None, -1, 1)],
                               "vin string, year long, mileage long")
    valid, rejected = routing.quarantine(df)
    assert valid.count() == 2 and rejected.count() == 7
    assert rows(valid.unionByName(rejected.drop("_rejection_reason"))) == rows(df)
