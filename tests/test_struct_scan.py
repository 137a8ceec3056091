"""Nested records parsed with their lines, texts and dates that need no work."""

import gzip
import os

from pyspark.sql import functions as F

from forecourt import functions as fn
from forecourt.functions.text import WHITESPACE
from forecourt.functions.time import ISO_UTC
from forecourt.plans import jobs, silver
from forecourt.sources import readers

ODD = ['{"vin":"1","dealer":{"name":"a","zip":10000,"phone":5.5},"monthlyPaymentEstimate":{"price":1000.0}}',
       '{"vin":"2","dealer":[],"monthlyPaymentEstimate":{"price":2.5}}', '{"vin":"3","dealer":"","monthlyPaymentEstimate":5,"year":"1999"}',
       '{"vin":"4","dealer":"{\\"name\\":\\"q\\"}","monthlyPaymentEstimate":null,"make":"x"}', '{"vin":"5","dealer":true,"make":{"a":1}}',
       '{"vin":"6","dealer":"{bad"}', '{"vin":"7","ye', '[{"vin":"8","dealer":[]},{"vin":"9","dealer":{"name":"z"}}]', "[1,2]",
       '[{"vin":"10","dealer":{"name":"n"}},{"vi', "nonsense", "", "   ", '"text"', "12", "null", "{}", "[]", '  [{"vin":"11","dealer":7}]',
       '{"vin":"12","dealer":{"name":{"x":1},"zip":[1,2],"city":null}}', '{"vin":"13","dealer":{"name":"a"},"dealer":"b"}',
       '{"vin":"14","dealer":"b","dealer":{"name":"a"}}', '{"vin":"15"} {"vin":"16"}', '{"dealer":3}', '{"vin":"17","_corrupt":"z","dealer":[1]}']


def rows(df):
    return sorted(repr(r.asDict(True)) for r in df.collect())


def test_nested_records_are_parsed_with_their_line(spark, folder):
    """one parse a line, and the rows of two; lines of any other kind too."""
    os.makedirs(f"{folder}/raw")
    with open(f"{folder}/raw/a.json", "w") as f:
        f.write("\n".join(ODD) + "\n")
    scan = readers.listing_scan(spark, f"{folder}/raw")
    plain = readers.jsonl_scan(spark, f"{folder}/raw")
    assert rows(scan) == rows(readers.parsed_structs(plain))
    kept = {"text": F.col(readers.CORRUPT)}
    shaped = silver.silver_rows(scan, "r", "t", keep=kept)
    assert rows(shaped) == rows(silver.silver_rows(plain, "r", "t", keep=kept))
    assert "dealer:struct<" in shaped._jdf.queryExecution().executedPlan().toString()   # of the scan
    before = spark.conf.get("spark.sql.json.enablePartialResults")
    spark.conf.set("spark.sql.json.enablePartialResults", "false")
    try:
        assert rows(readers.listing_scan(spark, f"{folder}/raw")) == rows(readers.parsed_structs(readers.jsonl_scan(spark, f"{folder}/raw")))
    finally:
        spark.conf.set("spark.sql.json.enablePartialResults", before)


def test_stripping_compares_only_ends_that_may_be_blank(spark):
    """as every kind of whitespace is stripped, but only where no visible character stands."""
    ends = ["", " ", "  ", "\t ", " \t", *WHITESPACE, "\x85 "]
    texts = [None, "​"] + [a + b + c for a in ends for b in ("", "a", "~ x", "é é", "€") for c in ends]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    got = df.select("c", fn.strip("c").alias("o"))
    assert got.where(~F.col("o").eqNullSafe(F.btrim("c", F.lit(WHITESPACE)))).count() == 0
    assert "ascii(" in got._jdf.queryExecution().optimizedPlan().toString()


def test_dates_in_their_form_are_only_checked(spark):
    """whatever the session's zone."""
    found = {"1997-06-28T01:02:03Z": "1997-06-28T01:02:03Z", "1997-06-28": "1997-06-28T00:00:00Z", "1997-02-30": None, "1997-02-30T00:00:00Z": None,
             "1997-06-28T24:00:00Z": None, "1582-10-10T01:02:03Z": "1582-10-10T01:02:03Z", "1997-06-28T10:00:00+02:00": "1997-06-28T08:00:00Z",
             " 1997-06-28": "1997-06-28T00:00:00Z", "1997": "1997-01-01T00:00:00Z", "garbage": None}
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = spark.createDataFrame([(t,) for t in found], "c string").select("c", fn.iso_utc("c").alias("o"))
            assert {r.c: r.o for r in got.collect()} == found
            assert ISO_UTC in got._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_files_that_begin_wrong_are_found_before_the_others_are_read(spark, folder, monkeypatch):
    """the sound files are parsed once; a file that breaks further on is still found."""
    record = b'{"vin":"%d","year":2020}\n'
    whole = gzip.compress(b"".join(record % i for i in range(200_000)))
    for folder_, files in {"a": {"x.json.gz": whole, "junk.json.gz": b"not compressed", "none.json.gz": b""},
                           "b": {"x.json.gz": whole, "cut.json.gz": whole[:len(whole) // 2], "junk.json.gz": b"no"},
                           "c": {"junk.json.gz": b"no"}}.items():
        os.makedirs(f"{folder}/{folder_}")
        for name, data in files.items():
            with open(f"{folder}/{folder_}/{name}", "wb") as f:
                f.write(data)
    calls, staged = [], jobs.stage_raw
    monkeypatch.setattr(jobs, "stage_raw", lambda *args: calls.append(1) or staged(*args))
    for name, parses, bad, rows_ in (("a", 1, 1, 200_000), ("b", 2, 2, 200_000), ("c", 1, 1, 0)):
        calls.clear()
        got = jobs.run_silver(spark, f"{folder}/{name}", f"{folder}/lake-{name}")
        assert (len(calls), got.counts["files_failed"], got.counts["total_silver_records"]) == (parses, bad, rows_)
        assert got.details.where("failed").count() == bad
