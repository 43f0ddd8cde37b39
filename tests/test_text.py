from pyspark.sql import functions as F

from tessera.functions.text import (
    hour_key_from_path,
    json_array_line,
    order_line,
    parse_log_time,
    split_get,
    stable_row_id,
    word_count_line,
)
from tessera.operators.aggregate import word_count


def _counts(spark, lines, **kw):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return {r["word"]: r["n"] for r in word_count(df, **kw).collect()}


def test_word_count_edge_rows(spark):
    assert _counts(spark, ["Hello, hello WORLD!"]) == {"hello": 2, "world": 1}
    assert _counts(spark, [""]) == {}
    assert _counts(spark, ["--"]) == {}
    assert _counts(spark, ["é É"]) == {"é": 2}


def test_word_count_whole_text_and_punctuation(spark):
    text = "a_b c-d " * 1000 + "tail."
    got = _counts(spark, [text])
    assert got == {"a": 1000, "b": 1000, "c": 1000, "d": 1000, "tail": 1}


def test_unicode_blank_option(spark):
    nbsp = "x\u00a0y"
    assert _counts(spark, [nbsp]) == {"x\u00a0y": 1}
    assert _counts(spark, [nbsp], unicode_blanks=True) == {"x": 1, "y": 1}


def test_split_get_out_of_range_is_null(spark):
    df = spark.createDataFrame([("1 2",), ("bad",)], "value string")
    rows = df.select(split_get("value", " ", 1).alias("y")).collect()
    assert [r.y for r in rows] == ["2", None]


def test_hour_key_from_path(spark):
    df = spark.createDataFrame([("/data/pagecounts-20160801-020000",), ("/x/short",)], "p string")
    assert [r.h for r in df.select(hour_key_from_path("p").alias("h")).collect()] == ["20160801-02", ""]


def test_parse_log_time(spark):
    df = spark.createDataFrame([("01/Aug/1995:00:00:01",), ("99/Foo/1995:00:00:01",)], "t string")
    got = [r.ts for r in df.select(parse_log_time("t").alias("ts")).collect()]
    assert str(got[0]) == "1995-08-01 00:00:01" and got[1] is None


def test_line_formats(spark):
    df = spark.createDataFrame(
        [(586119, 21769.33, ["smoke black burnished steel midnight"], "hi", 3)],
        "k long, p double, names array<string>, w string, n long",
    )
    row = df.select(
        order_line("k", "p", "names").alias("o"),
        word_count_line("w", "n").alias("wc"),
        json_array_line("w", F.col("p")).alias("j"),
    ).first()
    assert row.o == "Order #586119 $21769.33: smoke black burnished steel midnight"
    assert row.wc == "hi 3"
    assert row.j == '["hi", 21769.33]'


def test_order_line_sorts_names(spark):
    df = spark.createDataFrame([(1, 2.5, ["b", "a", "c"])], "k long, p double, names array<string>")
    assert df.select(order_line("k", "p", "names").alias("o")).first().o == "Order #1 $2.50: a, b, c"


def test_time_keys_ignore_the_session_time_zone(spark):
    """02:30 on a spring-forward day does not exist in Los Angeles; the keys,
    the log text and the parsed time must keep the wall-clock values anyway."""
    from tessera.functions.text import format_log_time, hour_key, parse_log_time

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:05' AS ts, '10/Mar/2024:02:30:05' AS s, "
                       "'31/Feb/2024:02:30:05' AS bad")
        row = df.select(hour_key("ts").alias("h"), format_log_time("ts").alias("f"),
                        parse_log_time("s").alias("p"), parse_log_time("bad").alias("b")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert row.h == "20240310-02"
    assert row.f == "10/Mar/2024:02:30:05"
    assert str(row.p) == "2024-03-10 02:30:05" and row.b is None


def test_null_and_non_finite_values_in_text_lines(spark):
    from tessera.functions.text import json_array_line, key_value_line

    df = spark.createDataFrame([("a", None), (None, 1.5), ("b", float("nan"))], "k string, v double")
    rows = df.select(json_array_line("k", "v").alias("j"), key_value_line("k", "v").alias("t")).collect()
    assert [r.j for r in rows] == ['["a", null]', "[null, 1.5]", '["b", null]']
    assert [r.t for r in rows][:2] == ["a\t", "\t1.5"]


def test_statistics_on_large_values(spark):
    from tessera.operators.aggregate import linear_fit, pearson
    from tessera.streaming.regression import running_fit

    df = spark.range(10).selectExpr("id + 1e8 AS x", "2 * id + 1e8 AS y")
    assert abs(pearson(df, "x", "y").first()["r"] - 1.0) < 1e-12
    batch, stream = linear_fit(df, "x", "y").first(), running_fit(df).first()
    assert batch["slope"] == stream["slope"] and abs(batch["slope"] - 2.0) < 1e-9
    assert pearson(spark.range(3).selectExpr("id AS x", "1 AS y"), "x", "y").first()["r"] is None


def test_stable_row_id_tells_nulls_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", "")], "x string, y string")
    assert df.select(stable_row_id("x", "y").alias("id")).distinct().count() == 3
