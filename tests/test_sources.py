import gzip
import os

from pyspark.sql import functions as F

from tessera import schemas
from tessera.operators.aggregate import group_mean
from tessera.sources.files import (
    parse_json,
    read_csv,
    read_delimited,
    read_json,
    read_lines,
    with_hour_from_file,
)
from tessera.sources.graph_text import parse_adjacency
from tessera.sources.logs import parse_access_log


def _write(path, text, gz=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    opener = gzip.open if gz else open
    with opener(path, "wt") as f:
        f.write(text)


def test_read_json_declared_schema_and_average(spark, tmp_out):
    lines = [
        '{"subreddit": "pos", "score": 3, "author": "a"}',
        '{"subreddit": "pos", "score": 5, "author": "b"}',
        '{"subreddit": "zero", "score": 0, "author": "c"}',
        '{"subreddit": "neg", "score": -2, "author": "d"}',
        '{"subreddit": "neg", "author": "no score"}',
        "{broken",
    ]
    _write(f"{tmp_out}/c/part.json", "\n".join(lines))
    df = read_json(spark, f"{tmp_out}/c", schemas.COMMENT)
    assert df.count() == 6
    avg = {r.subreddit: (r.n, r.mean) for r in group_mean(df, "subreddit", "score").collect()}
    assert avg["pos"] == (2, 4.0) and avg["zero"] == (1, 0.0) and avg["neg"] == (1, -2.0)
    assert avg[None] == (0, None)  # the broken line is an all-NULL row


def test_parse_json_column(spark):
    df = spark.createDataFrame([('{"subreddit": "x", "score": 1}',)], "value string")
    row = parse_json(df, "value", schemas.COMMENT).select("subreddit", "score").first()
    assert (row.subreddit, row.score) == ("x", 1)


def test_read_lines_gzip_and_rebalance(spark, tmp_out):
    _write(f"{tmp_out}/t/a.txt.gz", "x y\nz\n", gz=True)
    df = read_lines(spark, f"{tmp_out}/t", rebalance=3)
    assert df.rdd.getNumPartitions() == 3
    assert sorted(r.value for r in df.collect()) == ["x y", "z"]


def test_read_delimited_keeps_quotes_and_hour_from_file(spark, tmp_out):
    rows = ["en A 5 100", "en B 5 9", "en Main_Page 99 1", "en Special:X 98 1", "fr C 97 1", 'en "q 1 1']
    _write(f"{tmp_out}/pc/pagecounts-20160801-020000", "\n".join(rows))
    df = with_hour_from_file(read_delimited(spark, f"{tmp_out}/pc", schemas.PAGECOUNT))
    got = sorted((r.title, r.views, r.hour) for r in df.collect())
    assert ('"q', 1, "20160801-02") in got and len(got) == 6


def test_read_csv_weather(spark, tmp_out):
    _write(f"{tmp_out}/w/a.csv", "CA1,20200101,TMAX,105,,,S,\nUS1,20200101,TMIN,-20,,E,S,\n")
    df = read_csv(spark, f"{tmp_out}/w", schemas.OBSERVATION)
    rows = {r.station: r for r in df.collect()}
    assert rows["CA1"].value == 105 and rows["CA1"].qflag is None and rows["US1"].qflag == "E"


def test_parse_adjacency(spark):
    df = spark.createDataFrame([("1: 3 5",), ("3: 2 5",), ("5:",), ("2: 6",), ("6:",)], "value string")
    edges = sorted((r.src, r.dst) for r in parse_adjacency(df).collect())
    assert edges == [(1, 3), (1, 5), (2, 6), (3, 2), (3, 5)]


def test_parse_access_log_keeps_well_formed_only(spark):
    good = 'a.net - - [01/Aug/1995:00:00:01 -0400] "GET /x HTTP/1.0" 200 1839'
    dash = 'a.net - - [01/Aug/1995:00:00:01 -0400] "GET /x HTTP/1.0" 200 -'
    df = spark.createDataFrame([(good,), (dash,), ("free text",)], "value string")
    out = parse_access_log(df, id_mode="stable").collect()
    assert len(out) == 1
    r = out[0]
    assert (r.host, r.path, r.bytes, str(r.datetime)) == ("a.net", "/x", 1839, "1995-08-01 00:00:01")
    assert len(r.id) == 64
    rnd = parse_access_log(df, id_mode="random").collect()[0]
    assert len(rnd.id) == 36
