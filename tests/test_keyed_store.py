"""Keyed stores: whole versions only, merges that leave other buckets alone, lookups that read few, concurrent writers."""

import os

import pytest
from pyspark.sql import functions as F

from plan_util import plan_text
from tessera.sinks.keyed_store import BUCKET, Conflict, KeyedStore


def files(root):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns
            for d, _, names in os.walk(f"{root}/data") for n in names if n.endswith(".parquet")}


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def numbers(spark, n, value):
    return spark.range(n).select(F.col("id").alias("k"), F.lit(value).alias("v"))


def test_a_load_that_dies_in_its_write_leaves_the_old_table(spark, tmp_out):
    store = KeyedStore(spark, f"{tmp_out}/t", "k", buckets=4)
    assert not store.exists()
    with pytest.raises(FileNotFoundError):
        store.read()
    store.replace(numbers(spark, 100, "old"))
    dies = spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") == 999, F.raise_error(F.lit("killed"))).otherwise("new").alias("v"))
    for write in (store.replace, store.merge):
        with pytest.raises(Exception, match="killed"):
            write(dies)
        assert rows(KeyedStore(spark, f"{tmp_out}/t", "k").read()) == [(i, "old") for i in range(100)]


def test_a_writer_cut_before_publishing_leaves_the_old_table(spark, tmp_out, monkeypatch):
    store = KeyedStore(spark, f"{tmp_out}/t", "k", buckets=4)
    store.replace(numbers(spark, 10, "old"))
    monkeypatch.setattr(KeyedStore, "_publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        store.replace(numbers(spark, 10, "new"))
    monkeypatch.undo()
    assert rows(store.read()) == [(i, "old") for i in range(10)]
    assert rows(store.merge(numbers(spark, 1, "next"))) == [(0, "next"), *((i, "old") for i in range(1, 10))]


def test_a_merge_touches_only_the_buckets_of_its_keys(spark, tmp_out):
    store = KeyedStore(spark, f"{tmp_out}/t", "k", buckets=16)
    store.replace(numbers(spark, 2000, "old"))
    before = files(store.root)
    assert len(before) == 16
    merged = store.merge(spark.createDataFrame([(7, "new"), (5000, "added")], "k long, v string"))
    assert rows(merged) == sorted([(i, "old") for i in range(2000) if i != 7] + [(7, "new"), (5000, "added")])
    after = files(store.root)
    assert all(after[path] == at for path, at in before.items())
    assert 1 <= len(set(after) - set(before)) <= 2
    used = {p.removeprefix("file://").removeprefix("file:") for p in merged.inputFiles()}
    assert len(used & set(before)) >= 14


def test_old_versions_are_readable_until_freed(spark, tmp_out):
    store = KeyedStore(spark, f"{tmp_out}/t", "k", buckets=4)
    first = store.replace(numbers(spark, 10, "a"))
    store.merge(numbers(spark, 3, "b"))
    store.replace(numbers(spark, 2, "c"))
    assert rows(first) == rows(store.read(version=1)) == [(i, "a") for i in range(10)]
    store.vacuum(keep=2)
    assert store.versions() == [2, 3] and rows(store.read()) == [(0, "c"), (1, "c")]
    assert rows(store.read(version=2)) == [(i, "b" if i < 3 else "a") for i in range(10)]
    store.vacuum(keep=1)
    assert store.versions() == [3] and rows(store.read()) == [(0, "c"), (1, "c")]


def test_two_writers_get_two_versions(spark, tmp_out, monkeypatch):
    """A writer that finds its number taken merges again on the other's version; a plain publish of a taken number fails."""
    store, other = (KeyedStore(spark, f"{tmp_out}/t", "k", buckets=2) for _ in range(2))
    store.replace(numbers(spark, 4, "a"))
    whole, calls = KeyedStore._written, []

    def late(self, *args):
        out = whole(self, *args)
        if self is store and not calls:
            calls.append(1)
            other.merge(spark.createDataFrame([(0, "other")], "k long, v string"))
        return out

    monkeypatch.setattr(KeyedStore, "_written", late)
    assert rows(store.merge(spark.createDataFrame([(1, "mine")], "k long, v string"))) == [(0, "other"), (1, "mine"), (2, "a"), (3, "a")]
    assert store.versions() == [1, 2, 3]
    with pytest.raises(Conflict):
        store._publish(3, {}, store.read().schema.json(), 2)


def test_lookups_read_the_buckets_of_their_keys(spark, tmp_out):
    store = KeyedStore(spark, f"{tmp_out}/t", "k", buckets=32)
    table = store.replace(numbers(spark, 3000, "x"))
    found = store.lookup([5, "17", 999_999])
    assert rows(found) == [(5, "x"), (17, "x")] and len(found.inputFiles()) <= 3 < len(table.inputFiles())
    assert "PushedFilters: [In(k, [5,17,999999])]" in plan_text(found) or "In(k" in plan_text(found)
    keys = spark.createDataFrame([(5,), (5,), (None,), (2999,)], "any int")
    found = store.lookup(keys)
    assert rows(found) == [(5, "x"), (2999, "x")] and len(found.inputFiles()) <= 3
    assert store.lookup([]).collect() == [] and store.lookup(keys.limit(0)).collect() == []


def test_hot_null_and_wide_keys(spark, tmp_out):
    """A key of a third of all rows, null keys, and keys of two columns."""
    hot = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("host"), "id")
    store = KeyedStore(spark, f"{tmp_out}/hot", "host", buckets=8)
    assert rows(store.replace(hot).groupBy(F.coalesce("host", F.lit("none")).alias("h")).count().filter("count > 1")) == [("hot", 3000), ("none", 3000)]
    pairs = KeyedStore(spark, f"{tmp_out}/pairs", ["a", "b"], buckets=4)
    pairs.replace(spark.createDataFrame([(1, None, "x"), (1, "y", "z")], "a int, b string, v string"))
    merged = pairs.merge(spark.createDataFrame([(1, "y", "new"), (2, "y", "more")], "a long, b string, v string"))
    assert sorted((r.a, r.b or "", r.v) for r in merged.collect()) == [(1, "", "x"), (1, "y", "new"), (2, "y", "more")]


def test_empty_tables_versions_and_mistakes(spark, tmp_out):
    store = KeyedStore(spark, f"{tmp_out}/t", "k")
    assert store.merge(numbers(spark, 0, "x")).collect() == [] and store.read().columns == ["k", "v"]
    versions = spark.createDataFrame([(1, "late", 2), (1, "early", 1), (2, "only", 1)], "k long, v string, n int").select("k", "v", "n")
    other = KeyedStore(spark, f"{tmp_out}/n", "k")
    assert rows(other.merge(versions, seq="n")) == [(1, "late", 2), (2, "only", 1)]
    assert rows(other.merge(spark.createDataFrame([(1, "old news", 1), (2, "newer", 3)], "k long, v string, n int"), seq="n")) == [(1, "late", 2), (2, "newer", 3)]
    with pytest.raises(ValueError, match="keyed by"):
        KeyedStore(spark, f"{tmp_out}/n", "v").read()
    with pytest.raises(ValueError, match="own column"):
        store.replace(numbers(spark, 1, "x").withColumn(BUCKET, F.lit(1)))
