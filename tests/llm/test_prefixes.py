"""The trie of rebuilt conversations against plain Python and DuckDB, with hot, empty, odd and long conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from oracle_check import digest, duck, spark_rows
from tessera.llm import prefixes

TURNS = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Nodes by the definition, from whole prefixes as tuples."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), (role, text)))
    own = {c: [t for _, _, t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children, subtree = defaultdict(int), defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]] += 1
        for d in range(len(node) + 1):
            subtree[node[:d]].append(node)
    out = set()
    for node, ids in members.items():
        saved = sum((len(members[v]) - 1) * len(v[-1][1].encode()) for v in subtree[node] if v)
        leaves = sum(not children[v] for v in subtree[node])
        ends = ",".join(str(c) for c in sorted(ids) if built[c] == node)
        out.add((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), children[node], leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def trie(spark, rows):
    docs = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit(1) for c in ("c", "i", "block", "key", "digest", "n")})
    got = [tuple(r) for r in prefixes.trie(*prefixes.rebuilt(prefixes.numbered(docs))).collect()]
    assert len(got) == len(set(got))
    return set(got)


def drawn(seed, convs=60, words=3):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(-20, 200), convs):
        for turn in range(draw.choice([1, 2, 3, 5, 12])):
            rows.append((c, draw.choice([turn, turn, None]), draw.choice(["user", "assistant", None]), draw.choice(["a", "é", "", None, "bb"][:words + 2])))
    return rows + rows[:3]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, seed):
    rows = drawn(seed)
    assert trie(spark, rows) == brute(rows)


def test_one_conversation_and_one_copied_one_hold_most_turns(spark):
    """A conversation of hundreds of turns is cut into blocks; many of copies end at one node, listed over several chunks."""
    rows = [(5, t, "user", f"t{t % 7}") for t in range(300)] + [(c, t, "user", "same") for c in range(1000, 1200) for t in range(2)]
    rows += [(c, 0, "user", f"t{c % 3}") for c in range(7, 30)]
    assert trie(spark, rows) == brute(rows)


def test_long_lists_of_ends_are_hashed_in_order(spark):
    ids = random.Random(1).sample(range(10**6), 9000)
    whole = spark.createDataFrame([("hot", i) for i in ids] + [("other", 3), ("other", 12), ("other", -4)], "key string, c long")
    got = {r.key: r.ends_sha256 for r in prefixes.ends(whole, chunk=100).collect()}
    want = {"hot": ",".join(map(str, sorted(ids))), "other": "-4,3,12"}
    assert got == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in want.items()}


def test_turnless_null_and_empty(spark):
    absent = next(c for c in range(11, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(absent, 1, "user", "gone"), (None, 1, "user", "of no conversation"), (10**6, None, None, None)]
    assert trie(spark, rows) == brute(rows)
    assert trie(spark, rows[:1]) == {(absent, 0, None, 1, 0, 1, 0, hashlib.sha256(str(absent).encode()).hexdigest())}
    assert trie(spark, rows[1:2]) == set() and trie(spark, []) == set()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_duckdb(spark, sf):
    folder = f"/root/testdata/{sf}"
    con = duck(folder)
    cur = con.execute(prefixes.OP12_SQL)
    cols, rows = spark_rows(prefixes.op12_prefix_trie(spark, folder))
    names, want = [d[0] for d in cur.description], cur.fetchall()
    assert digest(cols, rows)[0] == digest(names, want)[0] and len(rows) == len(want)
