import glob
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from tessera.operators.aggregate import linear_fit
from tessera.plans import jobs
from tessera.sinks.files import (
    collect_scalar,
    format_kv,
    replace_table,
    snapshot,
    split_by,
    split_by_scans,
    to_json_lines,
    write_csv,
    write_json,
    write_lines,
)
from tessera.streaming.regression import file_stream, parse_points, run_linear_fit_stream, run_to_table, running_fit

SF = "/root/testdata/sf0.001"


def _texts(path):
    out = []
    for f in sorted(glob.glob(f"{path}/part-*")):
        opener = gzip.open if f.endswith(".gz") else open
        with opener(f, "rt") as h:
            out += h.read().splitlines()
    return out


def test_text_kv_json_csv_round_trips(spark, tmp_out):
    df = spark.createDataFrame([("a", 1, None), ("b", 2, "x")], "k string, n long, s string")
    write_lines(format_kv(df, "k", "n"), f"{tmp_out}/kv", single_file=True)
    assert _texts(f"{tmp_out}/kv") == ["a\t1", "b\t2"]
    arrays = sorted(r.value for r in to_json_lines(df.select("k", "n"), as_array=True).collect())
    assert arrays == ['["a", 1]', '["b", 2]']
    objs = sorted(r.value for r in to_json_lines(df).collect())
    assert json.loads(objs[0]) == {"k": "a", "n": 1}  # NULL field left out
    write_json(df, f"{tmp_out}/js", compression="gzip", single_file=True)
    assert sorted(json.loads(x)["k"] for x in _texts(f"{tmp_out}/js")) == ["a", "b"]
    write_csv(df, f"{tmp_out}/csv", single_file=True)
    assert _texts(f"{tmp_out}/csv") == ["a,1,", "b,2,x"]


def test_split_one_pass_equals_two_scans(spark, tmp_out):
    src = jobs._etl_input(spark, SF)
    split_by(src, f"{tmp_out}/one", jobs.etl_predicates())
    split_by_scans(src, f"{tmp_out}/two", jobs.etl_predicates())
    for part in ("positive", "negative"):
        a = spark.read.json(f"{tmp_out}/one/part={part}").select("event_id").collect()
        b = spark.read.json(f"{tmp_out}/two/part={part}").select("event_id").collect()
        assert sorted(a) == sorted(b) and len(a) > 0
    zero = src.filter(F.col("score") == 0).count()
    total = spark.read.json(f"{tmp_out}/one").count()
    assert total + zero == src.count()


def test_replace_table_and_snapshot(spark, tmp_out):
    replace_table(spark.range(5), f"{tmp_out}/t")
    replace_table(spark.range(3), f"{tmp_out}/t")
    assert spark.read.parquet(f"{tmp_out}/t").count() == 3
    again = snapshot(spark.range(4), f"{tmp_out}/snap", 0)
    assert again.count() == 4 and glob.glob(f"{tmp_out}/snap/iter-0/*.parquet")
    assert collect_scalar(spark.range(7).agg(F.sum("id"))) == 21


def test_stream_equals_batch(spark):
    streamed = run_linear_fit_stream(spark, SF).first()
    batch = linear_fit(spark.read.parquet(f"{SF}/lineitem.parquet"), "l_quantity", "l_extendedprice").first()
    assert streamed.n == batch.n
    assert streamed.slope == pytest.approx(batch.slope, abs=1e-5)
    assert streamed.intercept == pytest.approx(batch.intercept, abs=1e-4)


def test_stream_of_text_messages(spark, tmp_out):
    src = f"{tmp_out}/msgs"
    import os

    os.makedirs(src)
    with open(f"{src}/a.txt", "w") as f:
        f.write("1 2\n2 4.5\nbad\n")
    with open(f"{src}/b.txt", "w") as f:
        f.write("3 6\n4 x\n")
    msgs = file_stream(spark, src, "value string", fmt="text")
    out = run_to_table(running_fit(parse_points(msgs)), f"{tmp_out}/fit").first()
    assert out.n == 3 and out.slope == pytest.approx(2.0) and out.intercept == pytest.approx(0.16667, abs=1e-4)


def test_counted_writes_report_rows_without_a_job(spark, tmp_out):
    from tessera.sinks.files import materialize_counted, snapshot_counted

    got, n = snapshot_counted(spark.range(7), tmp_out, 3)
    assert n == 7 and got.count() == 7
    assert os.path.exists(f"{tmp_out}/iter-3/_SUCCESS")
    empty, zero = materialize_counted(spark.range(7).filter("id < 0"), "empty")
    assert zero == 0 and empty.count() == 0
