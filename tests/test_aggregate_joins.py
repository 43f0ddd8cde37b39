import numpy as np
import pytest
from pyspark.sql import functions as F

from plan_util import executed_plan
from tessera.operators import aggregate as agg
from tessera.operators import joins
from tessera.streaming.regression import parse_points


def test_argmax_one_ties_go_to_largest_title(spark):
    df = spark.createDataFrame(
        [("h1", "A", 5), ("h1", "B", 5), ("h1", "C", 1), ("h2", "Z", 2)], "hour string, title string, views long"
    )
    got = {r.hour: (r.views, r.title) for r in agg.argmax_one(df, "hour", "views", "title").collect()}
    assert got == {"h1": (5, "B"), "h2": (2, "Z")}


@pytest.mark.parametrize("strategy", ["auto", "broadcast", "shuffle"])
def test_join_back_to_max_keeps_ties(spark, strategy):
    df = spark.createDataFrame(
        [("h1", "A", 5), ("h1", "B", 5), ("h1", "C", 1), ("h2", "Z", 2)], "hour string, title string, views long"
    )
    got = sorted((r.hour, r.title) for r in joins.join_back_to_max(df, "hour", "views", strategy=strategy).collect())
    assert got == [("h1", "A"), ("h1", "B"), ("h2", "Z")]


def test_group_max_floor(spark):
    df = spark.createDataFrame([("h", -3), ("h", -1)], "k string, v long")
    assert agg.group_max(df, "k", "v", floor=0).first().max_value == 0
    assert agg.group_max(df, "k", "v").first().max_value == -1


def test_relative_score_strategies_agree_and_drop_nonpositive_groups(spark):
    df = spark.createDataFrame(
        [(1, "a", 2.0), (2, "a", 4.0), (3, "z", 0.0), (4, "n", -1.0), (5, "n", -3.0)], "id long, k string, v double"
    )
    outs = []
    for strategy in ("auto", "broadcast", "shuffle"):
        rel = joins.relative_to_group_mean(df, "k", "v", strategy=strategy)
        outs.append(sorted((r.id, r.relative) for r in rel.collect()))
    assert outs[0] == outs[1] == outs[2] == [(1, 2.0 / 3.0), (2, 4.0 / 3.0)]


def test_sized_broadcast_goes_by_the_bytes_of_the_rows(spark):
    df = spark.range(100).withColumn("v", F.repeat(F.lit("x"), 20_000))  # 2 MB in few rows, small once compressed
    small, fits = joins.sized_broadcast(df.select("id"), max_bytes=10_000)
    assert fits and small.count() == 100
    large, fits = joins.sized_broadcast(df, max_bytes=1_000_000)
    assert not fits and sorted(r.id for r in large.collect()) == list(range(100))
    empty, fits = joins.sized_broadcast(df.filter("id < 0"), max_bytes=0)
    assert fits and empty.count() == 0


def test_with_previous_day_drops_gaps(spark):
    df = spark.createDataFrame(
        [("s", "2020-01-01", 1.0), ("s", "2020-01-02", 2.0), ("s", "2020-01-04", 4.0), ("t", "2020-01-02", 9.0)],
        "station string, d string, tmax double",
    ).withColumn("date", F.to_date("d")).drop("d")
    got = [(r.station, str(r.date), r.tmax, r.yesterday_tmax) for r in joins.with_previous_day(df, "station", "date", "tmax").collect()]
    assert got == [("s", "2020-01-02", 2.0, 1.0)]


def test_pearson_zero_variance_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert agg.pearson(df, "x", "y").first().r is None
    df2 = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5)], "x double, y double")
    expected = float(np.corrcoef([1.0, 2.0, 3.0], [2.0, 4.0, 6.5])[0, 1])
    assert agg.pearson(df2, "x", "y").first().r == pytest.approx(expected, rel=1e-12)


def test_linear_fit_from_messages(spark):
    msgs = spark.createDataFrame([("1 2",), ("2 4.5",), ("3 6",), ("bad",), ("4 x",)], "value string")
    pts = parse_points(msgs)
    fit = agg.linear_fit(pts, "x", "y").first()
    assert fit.n == 3 and fit.slope == pytest.approx(2.0) and fit.intercept == pytest.approx(0.16667, abs=1e-4)
    mom = agg.linear_fit_from_moments(agg.moments(pts, "x", "y")).first()
    assert mom.slope == pytest.approx(2.0) and mom.intercept == pytest.approx(0.16667, abs=1e-4)


def test_distinct_set_and_min_struct(spark):
    df = spark.createDataFrame([(1, "b", 3), (1, "a", 2), (1, "b", 2), (2, "c", 1)], "k long, name string, d long")
    sets = {r.k: r["values"] for r in agg.distinct_set(df, "k", "name").collect()}
    assert sets == {1: ["a", "b"], 2: ["c"]}
    best = {r.k: (r.d, r.name) for r in agg.min_struct_by(df, "k", ["d", "name"]).collect()}
    assert best == {1: (2, "a"), 2: (1, "c")}


def test_total_and_sums(spark):
    df = spark.createDataFrame([("h", 10), ("h", 5), ("g", 1)], "host string, bytes long")
    assert agg.total(df, "bytes").first().total == 16
    got = {r.host: (r.visits, r.bytes) for r in agg.group_sums(df, "host", {"visits": F.lit(1), "bytes": "bytes"}).collect()}
    assert got == {"h": (2, 15), "g": (1, 1)}


def test_count_by(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, x long")
    assert {(r.k, r.n) for r in agg.count_by(df, "k").collect()} == {("a", 2), ("b", 1)}
    assert {(r.k, r.x, r.c) for r in agg.count_by(df, ["k", "x"], out="c").collect()} == {("a", 1, 1), ("a", 2, 1), ("b", 1, 1)}


def _jobs(sc, group, fn):
    sc.setJobGroup(group, "counted")
    try:
        out = fn()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return out, len(sc.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("groups", [30, 720])
def test_only_the_explicit_broadcast_runs_a_job_while_building(spark, groups):
    df = spark.range(20_000).select((F.col("id") % groups).alias("k"), (F.col("id") % 7).alias("v"))
    sc = spark.sparkContext
    for i, build in enumerate((lambda s: joins.join_back_to_max(df, "k", "v", strategy=s),
                               lambda s: joins.relative_to_group_mean(df, "k", "v", strategy=s))):
        lazy, none = _jobs(sc, f"a-{groups}-{i}", lambda: build("auto"))
        fast, some = _jobs(sc, f"b-{groups}-{i}", lambda: build("broadcast"))
        assert none == 0 and some > 0
        assert sorted(fast.collect()) == sorted(lazy.collect()) == sorted(build("shuffle").collect())


def test_join_back_to_max_of_an_aggregate_computes_it_once(spark):
    df = spark.range(2_000).groupBy((F.col("id") % 20).alias("k"), (F.col("id") % 300).alias("t")).agg(F.count("*").alias("n"))
    assert "ReusedExchange" in executed_plan(joins.join_back_to_max(df, "k", "n"))
