"""Runs of words against brute force, on random words and on the test data."""

import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import runs

SF = "/root/testdata/sf0.001"


def brute(ids, least=6, times=4):
    """By definition: for each period the stretches where words that far apart agree, the smallest period of each."""
    ids, found = np.asarray(ids, dtype=np.int64), {}
    for q in range(1, len(ids) // times + 1):
        agree = np.diff(np.concatenate(([0], (ids[:-q] == ids[q:]).astype(int), [0])))
        for start, end in zip(np.flatnonzero(agree == 1).tolist(), np.flatnonzero(agree == -1).tolist()):
            length = end - start + q
            if length >= max(least, times * q):
                found.setdefault((start, length), q)
    return sorted((start, length, q) for (start, length), q in found.items())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=70), st.integers(1, 12), st.integers(0, 40), st.integers(0, 60))
def test_runs_equal_brute_force(words, period, at, copies):
    words = words[:at] + [words[(at + i % period) % len(words)] for i in range(copies)] + words[at:] if words else words
    assert runs.find_runs(np.array(words, dtype=np.int64)) == brute(words)


@pytest.mark.parametrize("least, times", [(6, 4), (2, 2), (9, 3), (5, 5)])
def test_other_bounds(least, times):
    draw = random.Random(least)
    for _ in range(300):
        words = [draw.randrange(2) for _ in range(draw.randrange(40))]
        assert runs.find_runs(np.array(words, dtype=np.int64), least, times) == brute(words, least, times)


def test_suffix_order_and_shared_lengths():
    draw = random.Random(5)
    for _ in range(200):
        words = [draw.randrange(3) for _ in range(draw.randrange(1, 40))]
        order, shared = runs.suffix_order(np.array(words, dtype=np.int64))
        want = sorted(range(len(words)), key=lambda i: words[i:])
        assert order.tolist() == want
        for k in range(1, len(want)):
            a, b = words[want[k - 1]:], words[want[k]:]
            assert shared[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


@pytest.mark.parametrize("words", [
    [0] * 30_000, [0, 1] * 15_000, [i % 1000 for i in range(30_000)],
    [x for i in range(5_000) for x in (10 + i, 1, 2, 3, 4, 5, 6)],  # one phrase, always between other words
    [x for i in range(3_000) for x in (1, 1, 1, 1, 1, 1, 10 + i)],
], ids=["one", "two", "thousand", "phrase", "many"])
def test_long_texts_take_no_square_time(words):
    began = time.time()
    assert len(runs.find_runs(np.array(words, dtype=np.int64))) == {10: 0, 0: 1, 1: 3_000}.get(words[0], 1)
    assert time.time() - began < 20


def contract(key, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(key).encode())
    if h % 10 == 0 and n:
        a, g = (h // 10) % n, h // 10
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    known = {}
    found = brute([known.setdefault(w, len(known)) for w in words])
    dropped = {i for start, length, q in found for i in range(start + q, start + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None, None, None)
    return (key, len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest())


def test_query_equals_brute_force(spark):
    got = {r.doc_id: tuple(r) for r in runs.op13_periodic_runs(spark, SF).collect()}
    want = {r.doc_id: contract(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert got == want and sum(r[1] for r in want.values()) > 10


def test_operator_on_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "a b " * 5), (4, "x y\u0085z " * 6), (4, "x y\u0085z " * 6), (5, "w " * 40_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("z") for c in ("id", "runs", "collapsed", "n_words")})
    got = sorted(((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.collapse_runs(docs).collect()))
    assert got == [(0, 10, [(0, 10, 2)], "a b"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""),
                   (4, 6, [(0, 6, 1)], "x y\u0085z"), (4, 6, [(0, 6, 1)], "x y\u0085z"), (5, 40_000, [(0, 40_000, 1)], "w")]
    assert runs.collapse_runs(docs.limit(0)).collect() == []
