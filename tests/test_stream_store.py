"""An update-mode stream into a keyed store: stop, resume, replay, failure between write and commit."""

import os

import pytest

from tessera.sinks.keyed_store import KeyedStore
from tessera.streaming.regression import file_stream, run_to_store, running_totals

SCHEMA = "k string, v long"


def put(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/.{name}", "w") as f:
        f.writelines(f"{k},{v}\n" for k, v in rows)
    os.rename(f"{folder}/.{name}", f"{folder}/{name}")


def totals(spark, folder):
    return running_totals(file_stream(spark, folder, SCHEMA, fmt="csv", maxFilesPerTrigger=1), "k", "v")


def rows(df):
    return {r.k: (r.n, r.total, r.batch_id) for r in df.collect()}


@pytest.fixture()
def small_state(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_stop_and_resume_give_the_batch_answer_and_keep_unchanged_groups(spark, tmp_out, small_state):
    source, store = f"{tmp_out}/in", KeyedStore(spark, f"{tmp_out}/t", "k", buckets=4)
    put(source, "1.csv", [("a", 1), ("a", 2), ("b", 5)])
    put(source, "2.csv", [("c", 7)])
    assert {k: x[:2] for k, x in rows(run_to_store(totals(spark, source), store, f"{tmp_out}/cp")).items()} == {"a": (2, 3), "b": (1, 5), "c": (1, 7)}
    put(source, "3.csv", [("a", 10), ("d", 1)])
    # another session's objects, the same checkpoint: only the changed groups are written
    got = rows(run_to_store(totals(spark, source), KeyedStore(spark, f"{tmp_out}/t", "k"), f"{tmp_out}/cp"))
    assert {k: x[:2] for k, x in got.items()} == {"a": (3, 13), "b": (1, 5), "c": (1, 7), "d": (1, 1)}
    assert got["a"][2] == got["d"][2] == 2 and got["b"][2] < 2 and got["c"][2] < 2
    # nothing new: nothing changes
    versions = store.versions()
    assert rows(run_to_store(totals(spark, source), store, f"{tmp_out}/cp")) == got and store.versions() == versions


def test_a_batch_replayed_after_its_write_changes_nothing(spark, tmp_out, small_state, monkeypatch):
    """The job dies after a batch is in the store and before the stream commits it; the next run does that batch again."""
    source, store = f"{tmp_out}/in", KeyedStore(spark, f"{tmp_out}/t", "k", buckets=2)
    put(source, "1.csv", [("a", 1), ("b", 2)])
    run_to_store(totals(spark, source), store, f"{tmp_out}/cp")
    put(source, "2.csv", [("a", 4)])
    merge = KeyedStore.merge

    def then_die(self, *args, **kwargs):
        merge(self, *args, **kwargs)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(KeyedStore, "merge", then_die)
    with pytest.raises(Exception, match="driver lost"):
        run_to_store(totals(spark, source), store, f"{tmp_out}/cp")
    monkeypatch.undo()
    assert {k: x[:2] for k, x in rows(store.read()).items()} == {"a": (2, 5), "b": (1, 2)}
    assert {k: x[:2] for k, x in rows(run_to_store(totals(spark, source), store, f"{tmp_out}/cp")).items()} == {"a": (2, 5), "b": (1, 2)}
