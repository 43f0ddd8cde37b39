"""Property tests: operators against plain-Python brute force on random small inputs."""

import re
import string
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators import aggregate as agg
from tessera.operators import joins, keyed

SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_st = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 5), st.integers(-3, 3)), min_size=1, max_size=40
)


@SETTINGS
@given(rows=rows_st)
def test_argmax_one_matches_tuple_max(spark, rows):
    df = spark.createDataFrame(rows, "k string, tie long, v long")
    got = {r.k: (r.v, r.tie) for r in agg.argmax_one(df, "k", "v", "tie").collect()}
    want = {}
    for k, tie, v in rows:
        want[k] = max(want.get(k, (v, tie)), (v, tie))
    assert got == want


@SETTINGS
@given(rows=rows_st)
def test_join_back_to_max_keeps_all_ties(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, k string, tie long, v long")
    best = defaultdict(lambda: -(10**9))
    for k, _, v in rows:
        best[k] = max(best[k], v)
    want = sorted(i for i, (k, _, v) in enumerate(rows) if v == best[k])
    for strategy in ("broadcast", "shuffle"):
        got = sorted(r.id for r in joins.join_back_to_max(df, "k", "v", strategy=strategy).collect())
        assert got == want


@SETTINGS
@given(base=st.dictionaries(st.integers(0, 20), st.integers(0, 99), max_size=15),
       updates=st.lists(st.tuples(st.integers(0, 25), st.integers(0, 99)), max_size=15))
def test_upsert_matches_dict_update(spark, base, updates):
    b = spark.createDataFrame([(k, 0, v) for k, v in sorted(base.items())], "k long, seq long, v long")
    u = spark.createDataFrame([(k, i, v) for i, (k, v) in enumerate(updates, 1)][::-1], "k long, seq long, v long")
    got = {r.k: r.v for r in keyed.upsert_by_key(b, u, "k", seq="seq").collect()}
    want = dict(base)
    want.update(updates)  # in order: the last write of a key wins
    assert got == want


text_st = st.lists(st.text(alphabet=string.ascii_letters + string.punctuation + " \t\n0123456789", max_size=60),
                   min_size=1, max_size=8)


@SETTINGS
@given(lines=text_st)
def test_word_count_matches_python_regex(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {r.word: r.n for r in agg.word_count(df).collect()}
    sep = re.compile(r"[%s\s]+" % re.escape(string.punctuation))
    want = Counter(w.lower() for line in lines for w in sep.split(line) if w)
    assert got == dict(want)
