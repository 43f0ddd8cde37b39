"""Order of written files, and what becomes of lines that can't be read."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.order import order_audit
from tessera.plans import file_jobs as J
from tessera.plans import inputs
from tessera.sources.files import parse_json
from tessera.sources.logs import parse_access_log, unparsed_log_lines

SF = "/root/testdata/sf0.001"


def put(folder, files):
    import os

    os.makedirs(folder, exist_ok=True)
    for name, lines in files.items():
        with open(f"{folder}/{name}", "w") as f:
            f.writelines(f"{x}\n" for x in lines)


def audit(spark, folder, key=None):
    return tuple(order_audit(spark.read.text(folder), F.col("value") if key is None else key).first())


def test_order_inside_and_between_files(spark, tmp_out):
    put(f"{tmp_out}/good", {"part-0": ["a", "b", "b"], "part-1": [], "part-2": ["b", "c"]})
    put(f"{tmp_out}/inside", {"part-0": ["a", "c", "b"], "part-1": ["c", "d"]})
    put(f"{tmp_out}/between", {"part-0": ["a", "c"], "part-1": ["b", "d"], "part-2": ["a"]})
    assert audit(spark, f"{tmp_out}/good") == (5, 0)
    assert audit(spark, f"{tmp_out}/inside") == (5, 1)
    assert audit(spark, f"{tmp_out}/between") == (5, 2)
    put(f"{tmp_out}/none", {"part-0": []})
    assert audit(spark, f"{tmp_out}/none") == (0, 0)


def test_order_of_a_file_that_many_tasks_read(spark, tmp_out):
    rows = [f"{i:06d}" for i in range(20_000)]
    put(f"{tmp_out}/one", {"part-0": rows})
    rows[9_999], rows[10_000] = rows[10_000], rows[9_999]
    put(f"{tmp_out}/two", {"part-0": rows})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        assert spark.read.text(f"{tmp_out}/one").select(F.col("_metadata.file_block_start")).distinct().count() > 5
        assert audit(spark, f"{tmp_out}/one") == (20_000, 0)
        assert audit(spark, f"{tmp_out}/two") == (20_000, 1)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_order_of_numbers_descending_and_nulls_first(spark, tmp_out):
    put(f"{tmp_out}/down", {"part-0": ["10", "9", "-1"], "part-1": ["-5"]})
    assert audit(spark, f"{tmp_out}/down", -F.col("value").cast("long")) == (4, 0)
    assert audit(spark, f"{tmp_out}/down", F.col("value").cast("long")) == (4, 3)
    put(f"{tmp_out}/nulls", {"part-0": ["x", "1", "2", "x"]})
    assert audit(spark, f"{tmp_out}/nulls", F.col("value").try_cast("long")) == (4, 1)


@pytest.mark.parametrize("keep", [True, False])
def test_broken_documents(spark, keep):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    lines = ['{"a":1,"b":"x"}', '{"a":1', '{"a":"no number","b":"y"}', "", None, '{"b":"only"}', "[]", '{"a":null}']
    got = [tuple(r) for r in parse_json(spark.createDataFrame([(x,) for x in lines], "value string"), "value", schema, keep_broken=keep).collect()]
    if keep:
        assert got[0] == (1, "x", None) and got[5] == (None, "only", None) and got[7] == (None, None, None)
        assert [r[2] for r in got[1:5]] == ['{"a":1', '{"a":"no number","b":"y"}', "", ""]
        assert all(r[:2] == (None, None) for r in got[1:5])
    else:
        assert len(got) == len(lines) and got[0] == (1, "x")


def test_quarantine_job_loses_no_line(spark, tmp_out):
    rows = [json.dumps({"author": f"u{i}", "score": i, "subreddit": "s", "body": "x"}) for i in range(30)]
    put(f"{tmp_out}/in", {"a.json": [*rows, "{oops", '{"author": 5'], "b.json": ["not json"]})
    out = J.comment_quarantine(spark, f"{tmp_out}/in", f"{tmp_out}/out").collect()
    assert sorted(r.broken_line for r in out if r.part == "broken") == ["not json", '{"author": 5', "{oops"]
    assert sorted(r.score for r in out if r.part == "good") == list(range(30))


def test_log_lines_are_parsed_or_kept_as_broken(spark):
    lines = spark.createDataFrame([(x,) for x in [
        'h - - [01/Jan/2020:00:00:00 -0800] "GET /a HTTP/1.0" 200 12', 'h - - [01/Jan/2020:00:00:00 -0800] "GET /a HTTP/1.0" 200 -', "junk", None]], "value string")
    assert parse_access_log(lines).count() == 1
    assert sorted(r.broken_line for r in unparsed_log_lines(lines).collect())[::2] == ["", "junk"]


def test_page_count_files_carry_their_hour_in_the_name(spark):
    folder = inputs.pagecount_files(spark, SF)
    names = {r.n for r in spark.read.text(folder).select(F.col("_metadata.file_name").alias("n")).distinct().collect()}
    hours = {r.h for r in spark.read.parquet(f"{SF}/events.parquet").select(F.date_format("ts", "yyyyMMdd-HH").alias("h")).distinct().collect()}
    assert {n[11:22] for n in names} == hours and all(n.startswith("pagecounts-") for n in names)
    assert inputs.pagecount_files(spark, SF) == folder
