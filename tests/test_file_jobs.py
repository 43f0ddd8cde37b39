"""File-level jobs on FIXTURES.md rows."""

import datetime as dt
import glob
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from tessera.plans import file_jobs as J
from tessera.sinks.keyed_store import KeyedStore


def _write(path, lines, gz=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    opener = gzip.open if gz else open
    with opener(path, "wt") as f:
        f.write("\n".join(lines) + "\n")


def _lines(path):
    out = []
    for f in sorted(glob.glob(f"{path}/part-*")):
        opener = gzip.open if f.endswith(".gz") else open
        with opener(f, "rt") as h:
            out += [x for x in h.read().splitlines() if x]
    return out


def test_word_count_job(spark, tmp_out):
    _write(f"{tmp_out}/in/a.txt", ["Hello, hello WORLD!", "", "--"])
    _write(f"{tmp_out}/in/b.txt.gz", ["é É"], gz=True)
    J.word_count(spark, f"{tmp_out}/in", f"{tmp_out}/out", rebalance=3)
    assert _lines(f"{tmp_out}/out") == ["hello 2", "world 1", "é 2"]


COMMENTS = [
    {"subreddit": "pose", "score": 3, "author": "a"},
    {"subreddit": "pose", "score": 5, "author": "b"},
    {"subreddit": "zero", "score": 0, "author": "c"},
    {"subreddit": "neg", "score": -2, "author": "d"},
    {"subreddit": "neg", "author": "no score"},
]


def _comments(tmp_out):
    _write(f"{tmp_out}/c/part.json", [json.dumps(c) for c in COMMENTS] + ["{broken"])
    return f"{tmp_out}/c"


def test_group_average_job(spark, tmp_out):
    out = {r.subreddit: r.average for r in J.group_average(spark, _comments(tmp_out), f"{tmp_out}/o").collect()}
    assert out["pose"] == 4.0 and out["zero"] == 0.0 and out["neg"] == -2.0
    assert "pose,4.0" in _lines(f"{tmp_out}/o")
    J.group_average(spark, _comments(tmp_out), f"{tmp_out}/kv", fmt="kv")
    assert "pose\t4.0" in _lines(f"{tmp_out}/kv")


def test_comment_split_and_relative_score(spark, tmp_out):
    J.comment_split(spark, _comments(tmp_out), f"{tmp_out}/split")
    pos = spark.read.json(f"{tmp_out}/split/part=positive").collect()
    neg = spark.read.json(f"{tmp_out}/split/part=negative").collect()
    assert sorted(r.author for r in pos) == ["a", "b"]  # "zero" has an e but score 0: neither side
    assert sorted(r.author for r in neg) == ["d"]
    rel = J.relative_score(spark, _comments(tmp_out), f"{tmp_out}/rel", strategy="broadcast").collect()
    assert [(r.author, r.relative) for r in rel] == [("b", 1.25), ("a", 0.75)]
    assert _lines(f"{tmp_out}/rel")[0] == '["b", 1.25]'


PAGES = ["en A 5 100", "en B 5 9", "en Main_Page 99 1", "en Special:X 98 1", "fr C 97 1", 'en "q 1 1']


def test_page_jobs(spark, tmp_out):
    _write(f"{tmp_out}/pc/pagecounts-20160801-020000", PAGES)
    top = J.hourly_top_pages(spark, f"{tmp_out}/pc", f"{tmp_out}/top").collect()
    assert [(r.hour, r.title, r.views) for r in top] == [("20160801-02", "A", 5), ("20160801-02", "B", 5)]
    _write(f"{tmp_out}/ph/p.txt", [f"20160801-02 {x}" for x in PAGES] + ["20160801-03 en Z 0 1"])
    J.hourly_max_views(spark, f"{tmp_out}/ph", f"{tmp_out}/mx")
    assert _lines(f"{tmp_out}/mx") == ["20160801-02\t5", "20160801-03\t0"]
    J.hourly_top_page(spark, f"{tmp_out}/ph", f"{tmp_out}/one")
    assert _lines(f"{tmp_out}/one")[0] == "20160801-02\t[5, 'B']"


OBS = [
    "CA1,20200101,TMAX,200,,,S,",
    "CA1,20200101,TMIN,100,,,S,",
    "CA2,20200101,TMAX,150,,,S,",
    "CA2,20200101,TMIN,50,,,S,",
    "US3,20200101,TMAX,300,,X,S,",
    "US3,20200101,TMIN,-300,,,S,",
    "CA1,20200102,TMAX,120,,,S,",
    "US4,20200102,TMAX,99,,,S,",
    "US4,20200102,TMIN,-1,,,S,",
]


def test_weather_jobs(spark, tmp_out):
    _write(f"{tmp_out}/w/obs.csv", OBS)
    etl = J.weather_etl(spark, f"{tmp_out}/w", f"{tmp_out}/etl")
    assert sorted((r.station, r.tmax) for r in etl.collect()) == [("CA1", 12.0), ("CA1", 20.0), ("CA2", 15.0)]
    assert glob.glob(f"{tmp_out}/etl/*.json.gz")
    rng = [(r.date, r.station, r.range) for r in J.temp_range(spark, f"{tmp_out}/w", f"{tmp_out}/tr").collect()]
    assert rng == [("20200101", "CA1", "10.00"), ("20200101", "CA2", "10.00"), ("20200102", "US4", "10.00")]
    sql = [(r.date, r.station, r.range) for r in J.temp_range_sql(spark, f"{tmp_out}/w", f"{tmp_out}/ts").collect()]
    assert sql == [("20200101", "CA1", 10.0), ("20200101", "CA2", 10.0), ("20200102", "US4", 10.0)]


LOGS = [
    'a.net - - [01/Aug/1995:00:00:01 -0400] "GET /x HTTP/1.0" 200 1000',
    'a.net - - [01/Aug/1995:00:00:02 -0400] "GET /y HTTP/1.0" 200 3000',
    'b.net - - [01/Aug/1995:00:00:03 -0400] "GET /x HTTP/1.0" 200 500',
    'c.net - - [01/Aug/1995:00:00:04 -0400] "GET /z HTTP/1.0" 200 7000',
    'c.net - - [01/Aug/1995:00:00:04 -0400] "GET /z HTTP/1.0" 200 -',
    "free text",
]


def test_log_jobs(spark, tmp_out):
    _write(f"{tmp_out}/logs/l.txt", LOGS)
    r = J.correlate_logs(spark, f"{tmp_out}/logs")
    assert (r["n"], r["sum_x"], r["sum_y"]) == (3, 4.0, 11500.0)
    loaded = J.load_logs(spark, f"{tmp_out}/logs", f"{tmp_out}/table", partitions=2)
    assert loaded.count() == 4 and loaded.select("id").distinct().count() == 4
    r2 = J.correlate_logs_table(spark, f"{tmp_out}/table")
    assert r2["r"] == pytest.approx(r["r"])


def test_shortest_path_job(spark, tmp_out):
    _write(f"{tmp_out}/g/links-simple-sorted.txt", ["1: 3 5", "3: 2 5", "5:", "2: 6", "6:"])
    assert J.shortest_path(spark, f"{tmp_out}/g", f"{tmp_out}/sp", 1, 6) == [1, 3, 2, 6]
    assert _lines(f"{tmp_out}/sp/path") == ["1", "3", "2", "6"]
    assert sorted(r.node for r in spark.read.parquet(f"{tmp_out}/sp/iter-2").collect()) == [2]
    assert J.shortest_path(spark, f"{tmp_out}/g", f"{tmp_out}/sp2", 5, 1) == ["NO", "PATH", "FOUND"]


def test_order_jobs(spark, tmp_out):
    root = f"{tmp_out}/tpch"
    spark.createDataFrame([(1, 7, "O", 10.5), (2, 8, "F", 3.0)], "orderkey long, custkey long, orderstatus string, totalprice double").write.parquet(f"{root}/orders")
    spark.createDataFrame([(1, 100), (1, 101), (2, 101)], "orderkey long, partkey long").write.parquet(f"{root}/lineitem")
    spark.createDataFrame([(100, "steel"), (101, "black")], "partkey long, name string").write.parquet(f"{root}/part")
    J.order_lines(spark, root, f"{tmp_out}/ol", keys=[1])
    assert _lines(f"{tmp_out}/ol") == ["Order #1 $10.50: black, steel"]
    J.denormalize_orders(spark, root, f"{tmp_out}/dn")
    J.denormalize_orders(spark, root, f"{tmp_out}/dn")  # second load upserts, no duplicates
    assert KeyedStore(spark, f"{tmp_out}/dn", "o_orderkey").read().count() == 2
    J.order_lines_denormalized(spark, f"{tmp_out}/dn", f"{tmp_out}/od", keys=[1, 2])
    assert _lines(f"{tmp_out}/od") == ["Order #1 $10.50: black, steel", "Order #2 $3.00: black"]


def test_order_loads_merge_and_a_broken_load_changes_nothing(spark, tmp_out):
    """Loads A and B, then one that dies in its write; the table keeps A and B, and the next load merges into them."""
    def load(name, orders, lines):
        root = f"{tmp_out}/{name}"
        spark.createDataFrame(orders, "orderkey long, totalprice double").write.parquet(f"{root}/orders")
        spark.createDataFrame(lines, "orderkey long, partkey long").write.parquet(f"{root}/lineitem")
        spark.createDataFrame([(100, "steel"), (101, "black")], "partkey long, name string").write.parquet(f"{root}/part")
        J.denormalize_orders(spark, root, f"{tmp_out}/dn")

    def table():
        return {r.o_orderkey: r.o_totalprice for r in KeyedStore(spark, f"{tmp_out}/dn", "o_orderkey").read().collect()}

    load("a", [(1, 1.0), (2, 2.0)], [(1, 100), (2, 101)])
    load("b", [(2, 20.0), (3, 3.0)], [(2, 100), (3, 101)])
    with pytest.raises(Exception, match="repeated key"):
        load("twice", [(3, 5.0), (3, 6.0)], [(3, 100)])
    assert table() == {1: 1.0, 2: 20.0, 3: 3.0}
    load("c", [(4, 4.0)], [(4, 100)])
    assert table() == {1: 1.0, 2: 20.0, 3: 3.0, 4: 4.0}


def test_stream_job(spark, tmp_out):
    _write(f"{tmp_out}/s/a.txt", ["1 2", "2 4.5", "bad"])
    _write(f"{tmp_out}/s/b.txt", ["3 6", "4 x"])
    J.stream_regression(spark, f"{tmp_out}/s", timeout_s=120, sink="memory", mode="complete",
                        available_now=True, queryName="beta_alpha")
    row = spark.table("beta_alpha").first()
    assert row.BETA == pytest.approx(2.0) and row.ALPHA == pytest.approx(0.16667, abs=1e-4)


def test_weather_model_jobs(spark, tmp_out):
    rows = []
    for s in range(8):
        for d in range(40):
            day = dt.date(2020, 1, 1) + dt.timedelta(days=d)
            if s == 0 and d == 20:
                continue  # a gap of a day: no pair for day 21
            rows.append(f"S{s},{day},{40 + s},{-120 - s},{100 * s},{10 + s + (d % 7)}")
    _write(f"{tmp_out}/tmax/t.csv", rows)
    metrics = J.weather_train(spark, f"{tmp_out}/tmax", f"{tmp_out}/model")
    assert metrics["rmse"] >= 0
    tested = J.weather_test(spark, f"{tmp_out}/model", f"{tmp_out}/tmax")
    assert set(tested["importances"]) == {"latitude", "longitude", "elevation", "dayofyear", "yesterday_tmax"}
    pred = J.weather_tomorrow(spark, f"{tmp_out}/model", "S1", 41.0, -121.0, 100.0, dt.date(2020, 2, 1), 12.0)
    assert 5 < pred < 25


def test_colour_job(spark, tmp_out):
    rows = []
    for r in range(0, 256, 32):
        for g in range(0, 256, 32):
            for b in range(0, 256, 32):
                rows.append(f"{r},{g},{b},{'dark' if r + g + b < 384 else 'light'},high")
    _write(f"{tmp_out}/col/c.csv", rows)
    scores = J.colour_predict(spark, f"{tmp_out}/col", f"{tmp_out}/pred", grid_resolution=8)
    assert set(scores) == {"rgb", "lab"} and scores["lab"] > 0.7
    assert spark.read.parquet(f"{tmp_out}/pred/predictions-lab").count() == 64


def test_cli_word_count(tmp_out):
    import subprocess
    import sys

    _write(f"{tmp_out}/in/a.txt", ["b a", "a"])
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [sys.executable, "-m", "tessera", "--master", "local[2]", "word_count", f"{tmp_out}/in", f"{tmp_out}/out"],
        cwd=root, capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert _lines(f"{tmp_out}/out") == ["a 2", "b 1"]


def test_cli_parses_every_job():
    from tessera.__main__ import _parser

    p = _parser()
    cases = [
        ["word_count", "i", "o", "--rebalance", "40"], ["group_average", "i", "o", "--fmt", "kv"],
        ["hourly_max_views", "i", "o"], ["hourly_top_page", "i", "o"], ["hourly_top_pages", "i", "o"],
        ["comment_split", "i", "o"], ["relative_score", "i", "o", "--strategy", "broadcast"],
        ["weather_etl", "i", "o"], ["temp_range", "i", "o"], ["temp_range_sql", "i", "o"],
        ["correlate_logs", "i"], ["correlate_logs_table", "t"], ["load_logs", "i", "t", "--partitions", "150"],
        ["shortest_path", "i", "o", "1", "6"], ["order_lines", "i", "o", "--keys", "1", "2"],
        ["denormalize_orders", "i", "o"], ["order_lines_denormalized", "t", "o", "--keys", "5"],
        ["stream_regression", "topic", "--servers", "h:9092", "--timeout", "600"],
        ["colour_predict", "i"], ["weather_train", "i", "m"], ["weather_test", "m", "i"],
        ["weather_tomorrow", "m", "lab", "49.2771", "-122.9146", "330", "2020-11-13", "12"],
    ]
    for argv in cases:
        assert p.parse_args(argv).job == argv[0]
