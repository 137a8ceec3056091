import json
import os

import pytest
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt.plans import coverage, jobs, profile, quality, silver
from forecourt.session import path_exists
from forecourt.sources import manifest, readers, writers
from forecourt.streaming.incremental import incremental_silver_stream
from tests.listing_fixtures import raw_record, silver_table, write_feed


def run(spark, folder, **options):
    return jobs.run_silver(spark, f"{folder}/raw", f"{folder}/silver", **options)


def table(spark, folder):
    return jobs.SilverLake(f"{folder}/silver").read(spark)


def test_silver_transform_shapes_a_record(spark, folder):
    write_feed(f"{folder}/raw", "a.jsonl", [raw_record("1")])
    good, bad = silver.silver_transform(readers.jsonl_scan(spark, f"{folder}/raw"), "r", "2024-02-01T00:00:00Z")
    assert good.dtypes == list(fixed.SILVER_COLUMNS.items())
    assert bad.columns == [*fixed.SILVER_COLUMNS, "_rejection_reason"] and bad.count() == 0
    row = good.first()
    want = {"vin": "1", "listing_id": "id-1", "year": 2020, "make": "FORD", "model": "F-150", "current_price": 99.0,
            "list_price": 100.5, "vehicle_condition": "USED", "dealer_name": "Joe", "dealer_zip": "30301",
            "dealer_latitude": 33.5, "dealer_longitude": None, "dealer_city": "ATLANTA", "dealer_phone": None,
            "monthly_price": 1.5, "monthly_term_months": 60, "monthly_payment": None, "images": None,
            "first_seen": "2024-01-05T00:00:00Z", "_source_system": fixed.SOURCE_SYSTEM, "_source_file": "a.jsonl",
            "_ingestion_ts": "2024-02-01T00:00:00Z", "_pipeline_run_id": "r"}
    assert {c: row[c] for c in want} == want
    assert json.loads(row.top_options) == ["a", "b"] and json.loads(row.accident_history) == {"icon": "accident"}


def test_odd_lines(spark, folder):
    write_feed(f"{folder}/raw", "a.jsonl", [
        raw_record("1", dealer=None, monthlyPaymentEstimate=None), "", "   ", '{"vin": "2", "year": 2',
        raw_record(None), raw_record("3", year="2020.0", mileage="12.5"), raw_record("4", year=None, mileage=-1),
        raw_record("5", year={"odd": 1}, make=7)])
    good, bad = silver.silver_transform(readers.jsonl_scan(spark, f"{folder}/raw"), "r", "t")
    kept = {r.vin: r for r in good.collect()}
    assert set(kept) == {"1", "3"}
    assert kept["1"].dealer_name is None and kept["3"].year == 2020 and kept["3"].mileage is None
    reasons = sorted(r._rejection_reason for r in bad.collect())
    assert len(reasons) == 4 and reasons[0].startswith("corrupt_json;")
    assert reasons[1:] == ["invalid_year;", "invalid_year;negative_mileage;", "missing_vin;"]


def test_a_key_holding_most_rows(spark, folder):
    """Two thirds of the rows are copies of one key, spread over files and tasks."""
    for i in range(4):
        write_feed(f"{folder}/raw", f"{i}.jsonl", [raw_record("hot" if j % 3 else f"{i}-{j}", listPrice=i * 1000 + j)
                                                   for j in range(300)])
    run(spark, folder)
    got = {r.vin: r.list_price for r in table(spark, folder).collect()}
    assert len(got) == 401 and got["hot"] == 1.0
    more = run(spark, folder, full_refresh=True)
    assert more.counts["total_cross_dedup"] == 799


def test_run_silver_incremental_and_idempotent(spark, folder):
    write_feed(f"{folder}/raw", "a.jsonl", [raw_record("1", listPrice=1), raw_record("1", listPrice=2), raw_record("2"), raw_record(None)])
    write_feed(f"{folder}/raw", "b.jsonl", [raw_record("2", listPrice=7), raw_record("3")])
    first = run(spark, folder)
    assert first.success and first.counts == {
        "files_processed": 2, "total_raw_records": 6, "total_silver_records": 3, "total_quarantined": 1,
        "total_cross_dedup": 2, "files_failed": 0, "files_skipped": 0}
    assert {r.vin: r.list_price for r in table(spark, folder).collect()} == {"1": 1.0, "2": 100.5, "3": 100.5}
    again = run(spark, folder)
    assert again.counts == {"files_processed": 0, "files_skipped": 2} and table(spark, folder).count() == 3
    write_feed(f"{folder}/raw", "c.jsonl", [raw_record("3"), raw_record("4")])
    more = run(spark, folder)
    assert more.counts["files_processed"] == 1 and more.counts["total_silver_records"] == 1
    got = table(spark, folder)
    assert got.count() == got.select("vin").distinct().count() == 4
    assert readers.quarantine_scan(spark, f"{folder}/silver").count() == 1
    full = run(spark, folder, full_refresh=True)
    assert full.counts["files_processed"] == 3
    assert {r.vin for r in table(spark, folder).collect()} == {"1", "2", "3", "4"}
    assert readers.quarantine_scan(spark, f"{folder}/silver").count() == 1
    assert table(spark, folder).select("_pipeline_run_id").distinct().count() == 1


def test_file_with_only_known_keys_is_counted_and_not_read_again(spark, folder):
    write_feed(f"{folder}/raw", "a.jsonl", [raw_record("1")])
    run(spark, folder)
    write_feed(f"{folder}/raw", "b.jsonl", [raw_record("1"), raw_record("1", year=1)])
    second = run(spark, folder)
    assert (second.counts["total_raw_records"], second.counts["total_quarantined"], second.counts["total_cross_dedup"]) == (2, 1, 1)
    assert run(spark, folder).counts["files_processed"] == 0


def test_interrupted_run_is_repeated_without_doubles(spark, folder):
    write_feed(f"{folder}/raw", "a.jsonl", [raw_record("1"), raw_record(None)])
    run(spark, folder, run_id="one")
    from forecourt.session import drop_path
    drop_path(spark, f"{folder}/silver/_meta")  # as if the run had died before its log
    run(spark, folder, run_id="two")
    assert table(spark, folder).count() == 1
    assert readers.quarantine_scan(spark, f"{folder}/silver").count() == 1


def test_files_of_one_name_in_two_folders(spark, folder):
    write_feed(f"{folder}/raw/d1", "part_001.jsonl", [raw_record("1"), raw_record(None)])
    assert run(spark, folder).counts["files_processed"] == 1
    write_feed(f"{folder}/raw/d2", "part_001.jsonl", [raw_record("2"), raw_record("3"), raw_record(None), raw_record(None)])
    more = run(spark, folder)
    assert (more.counts["files_processed"], more.counts["total_silver_records"]) == (1, 2)
    assert {r.source_file for r in jobs.SilverLake(f"{folder}/silver").read_log(spark).collect()} == {"d1/part_001.jsonl", "d2/part_001.jsonl"}
    assert readers.quarantine_scan(spark, f"{folder}/silver").count() == 3
    assert run(spark, folder).counts["files_processed"] == 0


def test_text_of_malformed_lines_and_odd_structs(spark, folder):
    write_feed(f"{folder}/raw", "a.jsonl", ['{"vin": "1", "ye', raw_record("2", dealer=[]), raw_record("3", dealer=""),
                                            raw_record("4", dealer="text", monthlyPaymentEstimate=[1]), raw_record("5", dealer=None)])
    run(spark, folder)
    kept = {r.vin: r.dealer_name for r in table(spark, folder).collect()}
    assert kept == {"2": None, "3": None, "4": None, "5": None}
    rejected = readers.quarantine_scan(spark, f"{folder}/silver", with_text=True).collect()
    assert [r._raw_text for r in rejected] == ['{"vin": "1", "ye']


def test_rejects_of_a_repeated_run_are_replaced(spark, folder):
    frame = silver.silver_transform(spark.createDataFrame([("1", None)], "vin string, year string"), "r", "t", source_file=F.lit("f"))[1]
    for rows in (frame, frame, frame.limit(0)):
        from forecourt.sources.writers import write_quarantine
        write_quarantine(rows, f"{folder}/silver", "r")
    assert spark.read.schema(frame.schema).parquet(f"{folder}/silver/{fixed.QUARANTINE_DIR}").count() == 0


ODD_NAMES = ["my file.jsonl", "part[1].jsonl", "100%.jsonl", "a%20b.jsonl", "x+y.jsonl", "{a,b}.jsonl", "q?*.jsonl", "\u00e9 \u4e2d#&.jsonl"]


def test_files_of_any_name(spark, folder):
    for i, name in enumerate(ODD_NAMES):
        write_feed(f"{folder}/raw/odd [d] %", name, [raw_record(f"{i}-{j}") for j in range(i + 1)] + [raw_record(None)])
    first = run(spark, folder)
    assert first.success and first.counts["files_processed"] == len(ODD_NAMES)
    log = {r.source_file: (r.silver, r.quarantined) for r in jobs.SilverLake(f"{folder}/silver").read_log(spark).collect()}
    assert log == {f"odd [d] %/{name}": (i + 1, 1) for i, name in enumerate(ODD_NAMES)}
    assert {r[0] for r in table(spark, folder).select("_source_file").distinct().collect()} == set(log)
    assert run(spark, folder).counts == {"files_processed": 0, "files_skipped": len(ODD_NAMES)}
    write_feed(f"{folder}/raw", "new one.jsonl", [raw_record("n")])
    assert run(spark, folder).counts["files_processed"] == 1


def test_listing_does_not_read_the_files(spark, folder):
    from forecourt.sources.listing import file_listing

    write_feed(f"{folder}/raw", "a b.jsonl", [raw_record("1")])
    open(f"{folder}/raw/empty.jsonl", "w").close()
    listed = file_listing(spark, f"{folder}/raw", "*.json*")
    assert sorted((os.path.basename(r.path), r.length > 0) for r in listed.collect()) == [("a b.jsonl", True), ("empty.jsonl", False)]
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]
    nothing = file_listing(spark, f"{folder}/raw", "*.none")
    assert nothing.count() == 0


def _gz(path, lines, cut=None):
    import gzip

    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = gzip.compress("\n".join(lines).encode())
    with open(path, "wb") as f:
        f.write(data[:cut])


def test_unreadable_and_blank_files_fail_alone(spark, folder):
    lines = [json.dumps({"vin": f"g{i}", "year": 2020, "text": "x" * (i % 50)}) for i in range(5000)]
    write_feed(f"{folder}/raw", "a.jsonl", [raw_record("1"), raw_record("2")])
    write_feed(f"{folder}/raw", "blank.jsonl", ["", "   ", ""])
    open(f"{folder}/raw/empty.jsonl", "w").close()
    _gz(f"{folder}/raw/sound.json.gz", [json.dumps({"vin": "z", "year": 2020})])
    _gz(f"{folder}/raw/cut.json.gz", lines, cut=-4000)        # begins well
    with open(f"{folder}/raw/junk.json.gz", "wb") as f:
        f.write(b"no gzip at all")
    first = run(spark, folder)
    counts = {k: first.counts[k] for k in ("files_processed", "files_failed", "files_skipped", "total_raw_records")}
    assert counts == {"files_processed": 2, "files_failed": 2, "files_skipped": 2, "total_raw_records": 3} and not first.success
    assert sorted(r.vin for r in table(spark, folder).collect()) == ["1", "2", "z"]   # nothing of the cut file
    log = {r.source_file: (r.raw, r.failed, r.error) for r in first.details.collect()}
    assert log["cut.json.gz"] == log["junk.json.gz"] == (0, True, "unreadable")
    assert log["blank.jsonl"] == log["empty.jsonl"] == (0, False, None) and log["a.jsonl"][0] == 2
    assert run(spark, folder).counts == {"files_processed": 0, "files_skipped": 6}
    _gz(f"{folder}/raw/cut.json.gz", lines[:10])              # repaired
    again = run(spark, folder, retry_failed=True)
    assert (again.counts["files_processed"], again.counts["files_failed"], again.counts["files_skipped"]) == (1, 1, 4)
    assert table(spark, folder).count() == 13


def test_only_unreadable_files(spark, folder):
    os.makedirs(f"{folder}/raw")
    with open(f"{folder}/raw/junk.json.gz", "wb") as f:
        f.write(b"no gzip at all")
    first = run(spark, folder)
    assert first.counts["files_failed"] == 1 and table(spark, folder).count() == 0
    assert run(spark, folder).counts == {"files_processed": 0, "files_skipped": 1}


def test_plain_files_are_compared_with_their_listed_length(spark, folder):
    from forecourt.sources.listing import file_listing, unreadable_files

    os.makedirs(f"{folder}/raw")
    for name, data in (("end.jsonl", b"a\nb\n"), ("open.jsonl", b"a\nb"), ("crlf.jsonl", b"a\r\nb\r\n"), ("bom.jsonl", b"\xef\xbb\xbfa\n"),
                       ("odd.jsonl", b"\xff\xfe\n\n"), ("breaks.jsonl", b"\n\n\n")):
        with open(f"{folder}/raw/{name}", "wb") as f:
            f.write(data)
    listed = file_listing(spark, f"{folder}/raw")
    assert unreadable_files(spark, listed).count() == 0
    longer = listed.withColumn("length", F.when(F.col("path").endswith("open.jsonl"), F.col("length") + 50).otherwise(F.col("length")))
    assert [os.path.basename(r.path) for r in unreadable_files(spark, longer).collect()] == ["open.jsonl"]


def test_a_failing_refresh_leaves_the_table(spark, folder, monkeypatch):
    write_feed(f"{folder}/raw", "a.jsonl", [raw_record("1"), raw_record("2"), raw_record(None)])
    run(spark, folder)
    write_feed(f"{folder}/raw", "b.jsonl", [raw_record("3")])

    def broken(*args, **kwargs):
        raise RuntimeError("disk full")

    with monkeypatch.context() as m:
        m.setattr(jobs, "write_quarantine", broken)
        with pytest.raises(RuntimeError):
            run(spark, folder, full_refresh=True)
    assert sorted(r.vin for r in table(spark, folder).collect()) == ["1", "2"]
    assert readers.quarantine_scan(spark, f"{folder}/silver").count() == 1
    assert run(spark, folder).counts["files_processed"] == 1               # goes on where it was
    for _ in range(3):
        assert run(spark, folder, full_refresh=True).counts["files_processed"] == 2
    assert sorted(r.vin for r in table(spark, folder).collect()) == ["1", "2", "3"]
    assert readers.quarantine_scan(spark, f"{folder}/silver").count() == 1
    assert sorted(os.listdir(f"{folder}/silver")) == ["_v000002", "_v000003", "_versions"]   # the live one and the one before


def test_a_table_is_replaced_only_by_a_whole_one(spark, folder):
    path = f"{folder}/t"
    assert writers.replace_parquet(spark.range(3), path) == 3
    with pytest.raises(Exception):
        writers.replace_parquet(spark.range(5).select(F.raise_error(F.lit("bad")).alias("id")), path)
    assert spark.read.parquet(path).count() == 3 and os.listdir(folder) == ["t"]
    assert writers.replace_parquet(spark.read.parquet(path).where("id > 0"), path) == 2      # reads what it replaces
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2]


def test_rejects_of_a_run_under_way_are_neither_shown_nor_deleted(spark, folder):
    from datetime import datetime, timedelta, timezone

    from forecourt.sources import state

    root = f"{folder}/silver"
    bad = silver.silver_transform(spark.createDataFrame([("1", None)], "vin string, year string"), "r", "t", source_file=F.lit("f"))[1]
    for run_id, hours in (("busy", 1), ("dead", 30)):
        state.announce_run(spark, root, run_id, datetime.now(timezone.utc) - timedelta(hours=hours))
        writers.write_quarantine(bad, root, run_id)
    writers.write_quarantine(bad, root, "by-hand")            # never announced: nobody else's to delete
    write_feed(f"{folder}/raw", "a.jsonl", [raw_record("1"), raw_record(None)])
    run(spark, folder, run_id="mine")
    shown = readers.quarantine_scan(spark, root).select("_pipeline_run_id").distinct().collect()
    assert sorted(r[0] for r in shown) == ["by-hand", "mine"]
    stored = spark.read.parquet(f"{root}/{fixed.QUARANTINE_DIR}").select("_pipeline_run_id").distinct().collect()
    assert sorted(r[0] for r in stored) == ["busy", "by-hand", "mine"]


def test_a_batch_reads_the_index_buckets_of_its_keys_only(spark, folder):
    from forecourt.sources.keyindex import KeyIndex, bucket_of

    root = f"{folder}/silver"
    for i, run_id in enumerate("ab"):
        writers.write_silver(spark.range(i * 1000, i * 1000 + 1000).select(F.col("id").cast("string").alias("vin"), F.lit("r").alias("_pipeline_run_id")),
                             f"{root}/listings", run_id)
    index = KeyIndex(spark, f"{root}/listings", f"{root}/index", buckets=512)
    batch = spark.createDataFrame([("5",), ("1500",), ("new",), (None,)], "vin string")
    known = index.known(batch)
    buckets = {r.b for r in batch.where("vin is not null").select(bucket_of(F.col("vin"), 512).alias("b")).collect()}
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "/listings" not in plan and "bucket" in plan.split("PartitionFilters: ")[1].split("]")[0]
    found = {r.vin for r in known.collect()}
    assert {"5", "1500"} <= found and "new" not in found and len(found) < 60       # 3 of 512 buckets
    files = known.select("vin", F.input_file_name().alias("f")).select("f").distinct().collect()
    assert {int(r.f.split("bucket=")[1].split("/")[0]) for r in files} <= buckets
    assert {r.vin for r in index.known(batch, "b").select("vin").collect()} & {"5", "1500"} == {"5"}   # run b is written again
    assert sorted(r for runs in index.covered().values() for r in runs) == ["a", "b"]


def test_the_key_index_catches_up_and_is_merged(spark, folder, monkeypatch):
    from forecourt.sources import keyindex

    monkeypatch.setattr(keyindex, "MAX_FOLDERS", 2)
    root = f"{folder}/t"
    index = keyindex.KeyIndex(spark, root, f"{folder}/index", buckets=8)
    everything = spark.range(100).select(F.col("id").cast("string").alias("vin"))
    assert index.known(everything).count() == 0                       # no table yet
    for n in range(5):
        writers.write_silver(spark.createDataFrame([(str(n), "r"), (None, "r")], "vin string, _pipeline_run_id string"), root, f"run{n}")
        assert sorted(r.vin for r in index.known(everything).collect()) == [str(i) for i in range(n + 1)]
        assert len(index.covered()) <= 3
    assert len(os.listdir(f"{folder}/index")) == len(index.covered()) + 1
    assert sorted(r.vin for r in index.known(everything, "run1").collect()) == ["0", "2", "3", "4"]   # merged: read from the table
    drop = list(index.covered())[0]
    index._drop(drop)                                                 # lost: made again from the table
    assert sorted(r.vin for r in index.known(everything).collect()) == list("01234")


def test_unreadable_stored_files_are_left_out_and_counted(spark, folder):
    root = f"{folder}/silver"
    writers.write_silver(silver_table(spark, 120), f"{root}/listings", "r")
    writers.write_silver(silver_table(spark, 5).where("vin is null and false"), f"{root}/listings", "nothing")
    with open(f"{root}/listings/_pipeline_run_id=r/broken.parquet", "wb") as f:
        f.write(b"not a table")
    with pytest.raises(Exception):
        jobs.SilverLake(root).read(spark).agg(F.count("vin")).collect()
    done = jobs.run_gold(spark, root, f"{folder}/gold", as_of="2026-02-01 00:00:00", skip_unreadable=True)
    assert done.success and done.counts["files_failed"] == 1
    assert [os.path.basename(r.path) for r in jobs.SilverLake(root).unreadable(spark).collect()] == ["broken.parquet"]


def test_missing_raw_folder_is_an_error(spark, folder):
    result = jobs.run_silver(spark, f"{folder}/nope", f"{folder}/silver")
    assert not result.success and "nope" in result.error


def test_run_id_must_be_a_safe_name(spark, folder):
    with pytest.raises(ValueError):
        writers.run_folder(folder, "a/b")


def test_stream_equals_batch(spark, folder):
    for name, vins in (("a.jsonl", "12"), ("b.jsonl", "23"), ("c.jsonl", "345")):
        write_feed(f"{folder}/raw", name, [raw_record(v) for v in vins] + [raw_record(None)])

    def stream():
        incremental_silver_stream(spark, f"{folder}/raw", f"{folder}/silver", f"{folder}/check", files_per_batch=1).awaitTermination()

    stream()
    assert sorted(r.vin for r in table(spark, folder).collect()) == list("12345")
    stream()
    write_feed(f"{folder}/raw", "d.jsonl", [raw_record("5"), raw_record("6")])
    stream()
    assert sorted(r.vin for r in table(spark, folder).collect()) == list("123456")
    assert readers.quarantine_scan(spark, f"{folder}/silver").count() == 3
    run(spark, folder.rstrip("/"), full_refresh=True)
    assert sorted(r.vin for r in table(spark, folder).collect()) == list("123456")


def test_run_gold(spark, folder):
    empty = jobs.run_gold(spark, f"{folder}/silver", f"{folder}/gold")
    assert not empty.success and "no silver data" in empty.error
    writers.write_silver(silver_table(spark, 120), f"{folder}/silver/listings", "r")
    done = jobs.run_gold(spark, f"{folder}/silver", f"{folder}/gold", as_of="2026-02-01 00:00:00")
    assert done.success and len(done.counts) == 5 and all(n > 0 for n in done.counts.values())
    for name, n in done.counts.items():
        assert spark.read.parquet(f"{folder}/gold/{name}").count() == n
    assert {r["table"]: r["columns"] for r in done.details.collect()} == {
        "gold_listings_enriched": 70, "gold_market_summary": 22, "gold_price_segments": 13,
        "gold_dealer_performance": 20, "gold_depreciation_curve": 10}
    none = jobs.run_gold(spark, f"{folder}/silver", f"{folder}/gold2", as_of_year=1900)
    assert not none.success and "survived" in none.error


def test_save_tables_skips_empty(spark, folder):
    df = spark.range(3)
    log = jobs.save_tables(spark, folder, {"some": (df, df), "none": (df.where("id < 0"), df.where("id < 0"))}, "r", "t")
    assert sorted((r["table"], r["rows"], r["skipped"]) for r in log.collect()) == [("none", 0, True), ("some", 3, False)]
    assert not path_exists(spark, f"{folder}/none")


def test_sized_jsonl_and_manifest(spark, folder):
    limit = 50_000
    rows = spark.range(1000).select(
        F.col("id"), F.concat(F.lit("V"), F.col("id") % 900).alias("vin"), F.repeat(F.lit("Test Listing "), 20).alias("title"))
    writers.write_sized_jsonl(rows, f"{folder}/parts", key="vin", order_by=["id"], limit_bytes=limit)
    files = manifest.dataset_manifest(spark, f"{folder}/parts", limit).collect()
    assert sum(f.row_count for f in files) == 900 and all(f.size_bytes <= limit and not f.is_complete for f in files)
    for f in files:
        assert os.path.getsize(f.filepath.removeprefix("file:").replace("///", "/")) == f.size_bytes
    assert {f.part_number for f in files} == set(range(1, max(f.part_number for f in files) + 1))
    back = spark.read.json(f"{folder}/parts")
    assert back.agg(F.max("id")).first()[0] == 899
    totals = manifest.manifest_summary(manifest.dataset_manifest(spark, f"{folder}/parts", limit)).first()
    assert totals.total_rows == 900 and totals.total_files == len(files)


def test_one_long_line_does_not_break_the_limit(spark, folder):
    rows = spark.range(200).select(F.when(F.col("id") == 5, F.repeat(F.lit("x"), 900)).otherwise(F.lit("y")).alias("v"))
    writers.write_sized_jsonl(rows, f"{folder}/p", limit_bytes=1000)
    files = manifest.dataset_manifest(spark, f"{folder}/p", 1000).collect()
    assert sum(f.row_count for f in files) == 200 and max(f.size_bytes for f in files) <= 1000


def test_a_long_line_among_many_short_ones_makes_few_files(spark, folder):
    rows = spark.range(5000).select(F.when(F.col("id") == 5, F.repeat(F.lit("x"), 90_000)).otherwise(F.lit("y")).alias("v"))
    writers.write_sized_jsonl(rows, f"{folder}/p", limit_bytes=100_000)
    files = manifest.dataset_manifest(spark, f"{folder}/p", 100_000).collect()
    assert sum(f.row_count for f in files) == 5000 and max(f.size_bytes for f in files) <= 100_000 and len(files) <= 6
    assert readers.line_scan(spark, f"{folder}/p").count() == 5000      # found by the default pattern


def test_merged_scan_and_compact(spark, folder):
    spark.range(2).write.parquet(f"{folder}/t")
    spark.range(1).withColumn("_rejection_reason", F.lit("x;")).write.parquet(f"{folder}/t/_quarantine")
    assert readers.parquet_scan(spark, f"{folder}/t").count() == 2
    merged = readers.merged_scan(spark, [f"{folder}/t", f"{folder}/t/_quarantine"])
    assert merged.columns == ["id", "_rejection_reason"]
    assert writers.compact(merged, f"{folder}/one") == 3


def test_parts_are_named_and_numbered(spark, folder):
    rows = spark.range(500).select("id", F.when(F.col("id") % 2 == 0, F.lit("x")).alias("even"), F.rand().alias("r"))
    writers.write_sized_jsonl(rows, f"{folder}/p", limit_bytes=4000, base="listings")
    names = sorted(n for n in os.listdir(f"{folder}/p") if not n.startswith((".", "_")))
    assert names == [f"listings_part_{i:03d}.jsonl" for i in range(1, len(names) + 1)] and len(names) > 5
    records = [json.loads(line) for n in names for line in open(f"{folder}/p/{n}")]
    assert sorted(r["id"] for r in records) == list(range(500)) and all(("even" in r) == (r["id"] % 2 == 0) for r in records)
    assert all(os.path.getsize(f"{folder}/p/{n}") <= 4000 for n in names)


def test_manifest_lists_files_without_lines(spark, folder):
    write_feed(folder, "a_part_001.jsonl", ["x", "y", ""])
    open(f"{folder}/a_part_002.jsonl", "w").close()
    write_feed(folder, "odd name [3].jsonl", ["z"])
    files = {r.filename: r for r in manifest.dataset_manifest(spark, folder, 5).collect()}
    assert {n: (r.part_number, r.row_count, r.size_bytes, r.is_complete) for n, r in files.items()} == {
        "a_part_001.jsonl": (1, 3, 5, True), "a_part_002.jsonl": (2, 0, 0, False), "odd name [3].jsonl": (None, 1, 2, False)}
    assert files["a_part_002.jsonl"].checksum == 0
    assert manifest.manifest_summary(manifest.dataset_manifest(spark, folder, 5)).first()[:2] == (3, 4)


def test_compaction_packs_files_by_size(spark, folder):
    rows = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t"))
    rows.repartition(40).write.parquet(f"{folder}/t")
    rows.limit(10).withColumn("more", F.lit(1)).write.parquet(f"{folder}/u")
    total = sum(os.path.getsize(f"{folder}/t/{n}") for n in os.listdir(f"{folder}/t") if n.endswith(".parquet"))
    assert writers.compact_files(spark, [f"{folder}/t", f"{folder}/u"], f"{folder}/t", total // 3) == 60_010     # in its own place
    names = [n for n in os.listdir(f"{folder}/t") if n.endswith(".parquet")]
    assert 3 <= len(names) <= 6 and all(os.path.getsize(f"{folder}/t/{n}") < 1.4 * total / 3 for n in names)
    assert spark.read.parquet(f"{folder}/t").agg(F.sum("id"), F.count("more")).first()[:] == (60_000 * 59_999 // 2 + 45, 10)
    joined = rows.join(spark.range(30_000), "id")                                    # no plain scan: measured
    assert writers.compact(joined, f"{folder}/j", target_bytes=total) == 30_000
    assert len([n for n in os.listdir(f"{folder}/j") if n.endswith(".parquet")]) == 1


def test_text_list_and_coverage(spark, folder):
    with open(f"{folder}/zips.txt", "w") as f:
        f.write("30002\n \n 30004\t\n\n")
    zips = readers.text_list_scan(spark, f"{folder}/zips.txt")
    assert coverage.year_ranges() == [(1982, 2010)] + [(y, y) for y in range(2011, 2027)]
    grid = coverage.coverage_grid(zips, "USED")
    assert grid.count() == 2 * 17 and grid.where("key = '30002_1982-2010_used'").count() == 1
    log = spark.createDataFrame([("30002_1982-2010_used", "t", 5, None), ("30004_2011-2011_used", "t", 0, "boom")],
                                "key string, completed_at string, count long, error string")
    assert coverage.open_work(grid, log).count() == 32
    assert coverage.open_work(grid, log, retry_errors=True).count() == 33


def test_profiles_and_report(spark, folder):
    df = spark.createDataFrame([("a", " ", 1.0, 1), ("a", None, 2.0, None), ("b", "z", 4.0, None), (None, "z", None, None)],
                               "make string, model string, price double, year long").withColumn("_source_file", F.lit("f")).withColumn("vin", F.lit("v"))
    num = {r["column"]: r for r in profile.numeric_profile(df).collect()}
    assert (num["price"]["count"], num["price"].p50, num["price"].null_count, num["price"].null_pct) == (3, 2.0, 1, 25.0)
    assert num["price"].p25 == 1.5 and num["year"].std is None
    text = {r["column"]: r for r in profile.string_profile(df, ["make", "model"]).collect()}
    assert (text["model"].non_null_count, text["model"].non_empty_count, text["model"].unique_count) == (3, 2, 1)
    assert [tuple(t) for t in text["make"].top_values] == [("a", 2), ("b", 1)]
    cats = {(r["column"], r["value"]): r["n"] for r in profile.category_counts(df).collect()}
    assert cats[("make", "<null>")] == 1 and cats[("model", "z")] == 2
    report = quality.quality_report(df, df.select(F.lit("x;y;").alias("_rejection_reason"), "_source_file"))
    cols = {r["column"]: r for r in report["columns"].collect()}
    assert (cols["model"].empty_string_count, cols["model"].total_missing, cols["model"].missing_pct) == (1, 2, 50.0)
    assert cols["make"].sample_values == ["a", "b"] and cols["price"]["median"] == 2.0 and cols["year"].dtype == "bigint"
    assert [r[0] for r in report["columns_mostly_null"].collect()] == ["year"]
    assert "vin" in {r[0] for r in report["columns_fully_populated"].collect()}
    assert report["duplicates"].first()[0] == 3 and report["quarantine"].first().total_rejected == 4
    assert [tuple(r) for r in report["rejection_reasons"].collect()] == [("x", 4), ("y", 4)]


def test_profile_of_empty_table(spark):
    df = spark.createDataFrame([], "make string, price double")
    assert profile.numeric_profile(df).first().null_pct == 0.0
    assert profile.string_profile(df).first().unique_count == 0
    assert quality.column_completeness(df).count() == 2


def test_raw_profile(spark, folder):
    write_feed(f"{folder}/raw", "a.jsonl", [raw_record("1"), raw_record("2", images=[1, 2]), "broken{"])
    sections = profile.raw_profile(spark, f"{folder}/raw")
    assert sections["files"].first().total_records == 3 and sections["totals"].first().total_files == 1
    found = {r["key"]: r for r in sections["keys"].collect()}
    assert found["vin"].seen == 2 and [tuple(t) for t in found["year"].types] == [("int", 2)]
    assert found["dealer"].nested and [tuple(t) for t in found["dealer"].types] == [("dict(5 keys)", 2)]
    assert {tuple(t) for t in found["images"].types} == {("NoneType", 1), ("list(len=2)", 1)}
    assert not found["topOptions"].nested and found["listPrice"].types[0]["type"] == "float"
    assert found["topOptions"].sample == '["a","b"]' and found["images"].sample == "[1,2]"
    sampled = profile.raw_file_inventory(spark, f"{folder}/raw", sample_fraction=1.0).first()
    assert sampled.total_records == 3


def test_sampling_reads_the_beginnings_of_files_only(spark, folder, monkeypatch):
    line = json.dumps({"a": "x" * 183, "n": 1})                       # 200 bytes with its end
    write_feed(f"{folder}/raw", "big one.jsonl", [line] * 100_000)    # 20 MB
    write_feed(f"{folder}/raw", "small.jsonl", [line] * 7)
    write_feed(f"{folder}/raw", "long.jsonl", ['{"a": "' + "y" * 5000 + '"}'])
    open(f"{folder}/raw/empty.jsonl", "w").close()
    with open(f"{folder}/raw/open.jsonl", "w") as f:
        f.write(line + "\n" + line)                                   # no last line break
    found = {os.path.basename(r.file): (r.sampled_records, r.total_records)
             for r in profile.raw_file_inventory(spark, f"{folder}/raw", sample_bytes=2000).collect()}
    size = len(line) + 1
    assert found == {"big one.jsonl": (2000 // size, int(100_000 * size / (2000 / (2000 // size)))), "small.jsonl": (7, 7), "long.jsonl": (0, 0),
                     "empty.jsonl": (0, 0), "open.jsonl": (2, 2)}
    sections = profile.raw_profile(spark, f"{folder}/raw", sample_bytes=2000)
    assert {r.key: r.seen for r in sections["keys"].collect()} == {"a": 2000 // size + 9, "n": 2000 // size + 9}
    with monkeypatch.context() as m:                 # a store that only Spark can open gives the same
        m.setattr(readers, "_opens", lambda scheme, authority: False)
        again = readers.line_prefixes(spark, f"{folder}/raw", 2000)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, readers.line_prefixes(spark, f"{folder}/raw", 2000).collect()))
    plan = readers.file_listing(spark, f"{folder}/raw")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan                     # Spark opens no file, and tasks ask for the prefix only
    exact = {os.path.basename(r.file): r.total_records for r in profile.raw_file_inventory(spark, f"{folder}/raw").collect()}
    assert exact == {"big one.jsonl": 100_000, "small.jsonl": 7, "long.jsonl": 1, "empty.jsonl": 0, "open.jsonl": 2}


def test_columns_without_values_and_written_numbers(spark):
    from forecourt.plans import profile

    df = spark.createDataFrame([("b", None), ("a", None)], "t string, n string")
    assert {r.column: (r.unique_count, r.sample_values) for r in quality.text_samples(df).collect()} == {"t": (2, ["a", "b"]), "n": (0, [])}
    assert {r.column: len(r.top_values) for r in profile.string_profile(df).collect()} == {"t": 2, "n": 0}
    lines = spark.createDataFrame([('{"a": 1.0, "b": 10, "c": 1e2, "d": 2.5, "it\'s": 3}',)], "value string")
    got = {r.key: r.types[0].type for r in profile.raw_key_inventory(lines).collect()}
    assert (got["a"], got["b"], got["c"], got["d"]) == ("float", "int", "float", "float")


def test_empty_list_of_years_gives_no_columns(spark):
    from forecourt.plans import summaries

    rows = spark.createDataFrame([("x", 2001, 5), ("x", 2002, 6)], "make string, year long, listing_count long")
    assert summaries.listing_heatmap(rows).columns == ["make"]


def test_release_deletes_staged_tables(spark):
    from forecourt.session import fresh_path, path_exists, release

    path = fresh_path(spark, "x")
    spark.range(3).write.parquet(path)
    release(spark)
    assert not path_exists(spark, path)
