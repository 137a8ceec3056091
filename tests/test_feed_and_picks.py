"""The compressed raw feed, picking wide rows by number, compressed files that are checked piece by piece."""

import glob
import gzip
import os
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.catalog import silver_queries as s
from forecourt.operators.keys import pick_rows
from forecourt.session import stage
from forecourt.sources import readers, writers
from forecourt.sources.listing import file_listing, opener, unreadable_files


def test_feed_is_compressed_and_keeps_every_line(spark, folder):
    text = '{"id":"%d","make":"brand","model":"economy","trim":"blue"}'
    rows = [("A" if i % 3 else None, text % i if i % 7 else "") for i in range(3000)]
    s.write_feed(spark.createDataFrame(rows, "feed string, value string").repartition(2), f"{folder}/feed")
    files = glob.glob(f"{folder}/feed/feed=*/*.txt*")
    assert files and all(f.endswith(".gz") for f in files)
    assert sum(map(os.path.getsize, files)) < sum(len(v) for _, v in rows) / 4
    found = readers.line_scan(spark, f"{folder}/feed", s.FEED_GLOB)
    assert sorted(r.value for r in found.collect()) == sorted(v for _, v in rows)
    assert spark.conf.get(s._WRITERS) == "0"   # as before


def test_feed_keeps_similar_lines_together(spark, folder):
    """lines of one line number follow each other, so that they compress well; a vehicle's keep their order."""
    keys = [(i, i % 7 + 1, i * 37 % 20, i * 11 % 6) for i in range(600)] + [(None, None, None, None)]
    keys += [(900, 1, 19, 5), (900, 1, 5, 0), (900, 1, 7, 3)]   # one vehicle three times: in this order
    spark.createDataFrame(keys, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long").selectExpr(
        "*", "10.0D l_quantity", "1000.0D l_extendedprice", "0.0D l_discount", "0.0D l_tax", "'N' l_returnflag",
        "'O' l_linestatus", "timestamp '1998-01-01' l_shipdate").coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(20).selectExpr("id p_partkey", "concat('red car ', id) p_name", "'Brand#1' p_brand", "'SMALL' p_type",
                               "cast(id % 5 as int) p_size").write.parquet(f"{folder}/part.parquet")
    spark.range(6).selectExpr("id s_suppkey", "concat('S', id) s_name", "0L s_nationkey").write.parquet(f"{folder}/supplier.parquet")
    spark.sql("select 0L n_nationkey, 'N' n_name, 0L n_regionkey").write.parquet(f"{folder}/nation.parquet")
    spark.sql("select 0L r_regionkey, 'R' r_name").write.parquet(f"{folder}/region.parquet")
    lines = [r.value for r in s.raw_lines(spark, folder).collect()]
    assert len(lines) == 604
    assert [re.search(r'"id":"900-1-(\d+)', line)[1] for line in lines if '"vin":"V900-1"' in line] == ["19", "5", "7"]
    kinds = [re.findall(r'"imageCount":(\d+)', line) for line in lines]
    runs = 1 + sum(a != b for a, b in zip(kinds, kinds[1:]))
    assert runs == len(set(map(str, kinds)))


def test_picked_rows_move_no_wide_row_when_nearly_all_stay(spark):
    rows = stage(spark.range(1000).select(F.col("id").alias("row"), F.repeat(F.lit("x"), 50).alias("wide")), "wide")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4000")   # too little for most of the numbers
    try:
        for keep in (990, 10, 0, 1000):
            chosen = stage(rows.where(F.col("row") < keep).select("row"), "chosen")
            got = pick_rows(rows, chosen, "row")
            assert sorted(r.row for r in got.collect()) == list(range(keep))
            assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_compressed_files_are_checked_piece_by_piece(spark, folder):
    os.makedirs(f"{folder}/raw")
    data = b'{"id":"1"}\n' * 500_000
    whole = gzip.compress(data)
    for name, content in {"good.txt.gz": whole, "two.txt.gz": whole + whole, "cut.txt.gz": whole[:len(whole) // 2],
                          "junk.txt.gz": b"not compressed", "a b%20.txt.gz": whole}.items():
        with open(f"{folder}/raw/{name}", "wb") as f:
            f.write(content)
    listed = file_listing(spark, f"{folder}/raw")
    assert opener(listed) is not None
    found = unreadable_files(spark, listed)
    assert sorted(os.path.basename(r.path) for r in found.collect()) == ["cut.txt.gz", "junk.txt.gz"]
    assert "wholetext" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_compacting_shuffles_nothing(spark, folder, monkeypatch):
    rows = spark.range(20_000, numPartitions=8).select("id", F.md5(F.col("id").cast("string")).alias("text"))

    def shuffled(*args, **kwargs):
        raise AssertionError("rows are shuffled, all of a part are read by one task")

    monkeypatch.setattr(DataFrame, "repartition", shuffled)
    assert writers.compact(rows, f"{folder}/whole") == 20_000
    assert len(glob.glob(f"{folder}/whole/*.parquet")) == 1
    target = writers.listed_bytes(spark, f"{folder}/whole") // 3
    assert writers.compact(rows, f"{folder}/parts", target_bytes=target) == 20_000
    sizes = list(map(os.path.getsize, glob.glob(f"{folder}/parts/*.parquet")))
    assert 3 <= len(sizes) <= 6 and max(sizes) <= 1.5 * target
    assert sorted(r.id for r in spark.read.parquet(f"{folder}/parts").select("id").collect()) == list(range(20_000))


def test_feed_keeps_lines_of_one_dealer_together(spark, folder):
    """lines of one line number follow each other by dealer and part; a vehicle's keep their order, in several batches too."""
    keys = [(i, i % 2 + 1, i * 37 % 20, i * 11 % 6) for i in range(600)] + [(None, 1, 3, None), (None, None, None, 2)]
    keys += [(900, 1, 19, 5), (900, 1, 5, 0), (900, 1, 7, 3), (3, 2, 1, 1)]
    spark.createDataFrame(keys, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long").selectExpr(
        "*", "10.0D l_quantity", "1000.0D l_extendedprice", "0.0D l_discount", "0.0D l_tax", "'N' l_returnflag",
        "'O' l_linestatus", "timestamp '1998-01-01' l_shipdate").coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(20).selectExpr("id p_partkey", "concat('red car ', id) p_name", "'Brand#1' p_brand", "'SMALL' p_type",
                               "cast(id % 5 as int) p_size").write.parquet(f"{folder}/part.parquet")
    spark.range(6).selectExpr("id s_suppkey", "concat('S', id) s_name", "0L s_nationkey").write.parquet(f"{folder}/supplier.parquet")
    spark.sql("select 0L n_nationkey, 'N' n_name, 0L n_regionkey").write.parquet(f"{folder}/nation.parquet")
    spark.sql("select 0L r_regionkey, 'R' r_name").write.parquet(f"{folder}/region.parquet")
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, "7")
    try:
        lines = [r.value for r in s.raw_lines(spark, folder).collect()]
    finally:
        spark.conf.set(batch, before)
    assert len(lines) == len(keys)
    assert [re.search(r'"id":"900-1-(\d+)', x)[1] for x in lines if '"vin":"V900-1"' in x] == ["19", "5", "7"]
    assert [re.search(r'"id":"3-2-(\d+)', x)[1] for x in lines if '"vin":"V3-2"' in x] == ["11", "1"]
    dealers = [re.findall(r'"phone":"555-(\d+)"', x) for x in lines if '"vin":"V900-1"' not in x and '"vin":"V3-2"' not in x]
    assert sum(a != b for a, b in zip(dealers, dealers[1:])) < 20   # unsorted, some 600


def test_stored_tables_are_compressed_well(spark, folder):
    """tables that stay take little more room than staged ones."""
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("vin"), F.md5((F.col("id") % 50).cast("string")).alias("make"))
    assert writers.write_silver(rows, f"{folder}/listings", "run-1") == 20_000
    files = glob.glob(f"{folder}/listings/*/*.parquet")
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert spark.read.parquet(f"{folder}/listings").select("vin").distinct().count() == 20_000
