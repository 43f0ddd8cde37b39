"""A key holding a third of all rows: results stay exact and plans stay skew-safe."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from plan_util import plan_text
from tessera.operators import aggregate as agg
from tessera.operators import joins, keyed

N = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(11)
    data = []
    for i in range(N):
        key = "hot" if i % 3 == 0 else f"k{rnd.randrange(500)}"
        data.append((i, key, rnd.randrange(1, 50), float(rnd.randrange(1, 1000)) / 10))
    return data, spark.createDataFrame(data, "id long, k string, title long, v double")


def test_group_mean_and_relative(spark, skewed):
    data, df = skewed
    sums = defaultdict(lambda: [0, 0.0])
    for _, k, _, v in data:
        sums[k][0] += 1
        sums[k][1] += v
    rel = joins.relative_to_group_mean(df, "k", "v", strategy="broadcast")
    got = {r.id: r.relative for r in rel.collect()}
    assert len(got) == N
    for i, k, _, v in data[:500]:
        assert got[i] == pytest.approx(v / (sums[k][1] / sums[k][0]), rel=1e-9)
    plan = plan_text(rel)
    # the means (partial aggregate, measured) are broadcast: the detail
    # rows, hot key included, are never hash-exchanged
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_join_back_to_max_and_argmax_on_hot_key(spark, skewed):
    data, df = skewed
    best = defaultdict(int)
    for _, k, t, _ in data:
        best[k] = max(best[k], t)
    expected = sorted((k, i) for i, k, t, _ in data if t == best[k])
    top = joins.join_back_to_max(df, "k", "title")
    assert sorted((r.k, r.id) for r in top.collect()) == expected
    assert "Window" not in plan_text(top)
    one = {r.k: (r.title, r.id) for r in agg.argmax_one(df, "k", "title", "id").collect()}
    assert one["hot"] == max((t, i) for i, k, t, _ in data if k == "hot")
    assert "partial_max" in plan_text(agg.argmax_one(df, "k", "title", "id"))


def test_word_count_hot_word(spark):
    lines = ["the the the x"] * 2000 + ["a b"] * 1000
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {r.word: r.n for r in agg.word_count(df).collect()}
    assert got == {"the": 6000, "x": 2000, "a": 1000, "b": 1000}
    assert "partial_count" in plan_text(agg.word_count(df))


def test_upsert_with_hot_update_key(spark, skewed):
    data, _ = skewed
    base = spark.createDataFrame([(k, -1, 0.0) for k in ("hot", "a", "b")], "k string, seq long, v double")
    rows = [(k, i, v) for i, k, _, v in data if k in ("hot", "k1")]
    updates = spark.createDataFrame(rows, "k string, seq long, v double")
    out = {r.k: r.v for r in keyed.upsert_by_key(base, updates, "k", seq="seq").collect()}
    last = {k: v for k, _, v in rows}
    assert out == {"a": 0.0, "b": 0.0, **last}


def test_upsert_without_seq_refuses_a_repeated_key(spark):
    base = spark.createDataFrame([(1, 9)], "k long, v long")
    updates = spark.createDataFrame([(1, 9), (1, 3)], "k long, v long")
    with pytest.raises(Exception, match="repeated key"):
        keyed.upsert_by_key(base, updates, "k").collect()


def test_distinct_set_hot_key(spark, skewed):
    data, df = skewed
    sets = {r.k: r["values"] for r in agg.distinct_set(df, "k", "title").collect()}
    assert sets["hot"] == sorted({t for _, k, t, _ in data if k == "hot"})
    assert Counter(len(v) > 0 for v in sets.values())[True] == len(sets)
