"""Methods without Spark: transducer, UTF-8 machine, trees, signatures, regression, spans."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tessera.llm import bpe, linededup, secret_scan, simhash, topk, toxicity


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY)), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference_encoding(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.transducer.ranks, special_tokens={})


def texts(n=400, seed=1):
    r = random.Random(seed)
    parts = ["the", " and", "\n", "  ", "é", "Übung", "42", "==", "'s", "\t", "東京", "🙂", "a" * 30, " ", "<|endoftext|>", "\u00a0", "naïve "]
    for _ in range(n):
        yield "".join(r.choice(parts) if r.random() < 0.7 else chr(r.choice([r.randrange(32, 127), r.randrange(0xA0, 0xD7FF)])) for _ in range(r.randrange(40)))


def test_bpe_equals_tiktoken_and_round_trips(codec, reference_encoding):
    for text in [*texts(), "", " ", "ab" * 3000 + "a" * 3000 + " " * 500]:
        ids = codec.encode(text)
        assert ids == reference_encoding.encode_ordinary(text)
        assert codec.decode(ids) == text == "".join(codec.decoder.decode(ids))
    assert codec.encode(None) == []


def test_bpe_small_state_table_gives_the_same(reference_encoding, codec):
    small = bpe.Codec(codec.transducer.ranks, public_tokenizers.PATTERN, remember=3)
    small.transducer.max_states = 7
    for text in texts(60, seed=2):
        assert small.encode(text) == reference_encoding.encode_ordinary(text)
        for word in small.find(text):
            assert list(small.transducer.encode(word.encode())) == reference_encoding.encode_ordinary(word)


def test_utf8_machine_replaces_like_the_standard():
    r = random.Random(3)
    decoder = bpe.Decoder({i: bytes([i]) for i in range(256)})
    for _ in range(3000):
        data = bytes(r.choice([r.randrange(256), 0xE2, 0x82, 0xF0, 0x9F, 0xED, 0xA0]) for _ in range(r.randrange(10)))
        assert decoder.decode_all(list(data)) == data.decode("utf-8", "replace") == "".join(decoder.decode(data))


def test_bpe_encodes_each_pre_token_once(codec, reference_encoding):
    own = bpe.Codec(codec.transducer.ranks, public_tokenizers.PATTERN)
    seen, encode_all = Counter(), own.transducer.encode_all
    own.transducer.encode_all = lambda data: seen.update([data]) or encode_all(data)
    for mark in ("\n", ".\n", "-", ",\n"):  # each makes another piece of the same two words
        text = f"Hehaan hewhou{mark}Thesha"
        assert own.encode(text) == reference_encoding.encode_ordinary(text)
    assert seen[b" hewhou"] == seen[b"Thesha"] == 1


def test_bpe_remembers_no_more_than_told(codec):
    own = bpe.Codec(codec.transducer.ranks, public_tokenizers.PATTERN, remember=40)
    for text in texts(200, seed=4):
        assert own.encode(text) == codec.encode(text)
        for kept in (own.pieces, own.words):
            assert len(kept) <= kept.size and len(kept.old) <= kept.size
        assert len(own.transducer.states) <= own.transducer.max_states + 1


def test_decoded_bytes_are_the_machines(codec):
    r = random.Random(6)
    cut = [t for t, b in codec.transducer.bytes_of.items() if b.decode("utf-8", "replace").encode() != b]
    for _ in range(500):
        ids = [r.choice(cut) if r.random() < 0.3 else r.randrange(50_000) for _ in range(r.randrange(12))]
        assert bytes(codec.decoder.decode_bytes(np.array(ids, np.intc))) == "".join(codec.decoder.decode(ids)).encode() == codec.decode(ids).encode()


def brute_groups(points, bits):
    forest = simhash.Forest(len(points))
    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(points[i] ^ points) <= bits):
            forest.join(i, int(j))
    return [forest.find(i) for i in range(len(points))]


@pytest.mark.parametrize("dense", [False, True])
def test_vantage_point_trees_lose_no_link(dense):
    rng = np.random.default_rng(5)
    points = list(rng.integers(0, 2**64, 50 if dense else 1500, dtype=np.uint64))
    for _ in range(1500):
        x = points[0] if dense else points[rng.integers(len(points))]
        for b in rng.choice(np.arange(32, 64) if dense else 64, size=rng.integers(1, 5), replace=False):
            x ^= np.uint64(1) << np.uint64(b)
        points.append(x)
    points = np.unique(np.array(points, dtype=np.uint64))
    forest, place = simhash.Forest(len(points)), {int(p): i for i, p in enumerate(points)}
    for half in simhash.HALVES:
        nodes = simhash.build_tree(points, half, 3, 1.0, 200, 0)
        shards = {}
        for shard, at, home in simhash.route(nodes, points):
            shards.setdefault(shard, []).append((at, np.full(len(at), home)))
        assert len(shards) > 1
        for parts in shards.values():
            at, home = (np.concatenate(x) for x in zip(*parts))
            for a, b in zip(*simhash.link_shard(points[at], home, half, 3, leaf=64)):
                assert np.bitwise_count(a ^ b) >= 0
                forest.join(place[int(a)], place[int(b)])
    assert [forest.find(i) for i in range(len(points))] == brute_groups(points, 3)


def test_fingerprint_edges():
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n\t") == 0
    assert simhash.fingerprint("One two") == simhash.fingerprint(" one\x0bTWO ")
    assert simhash.fingerprint("É a b") != simhash.fingerprint("é a b")  # A-Z only


def test_line_signatures_have_high_recall():
    r = random.Random(7)
    words = ["".join(r.choice("aeioulrstn") for _ in range(r.randrange(2, 9))) for _ in range(300)]
    pairs = []
    while len(pairs) < 800:
        line = " ".join(r.choice(words) for _ in range(r.randrange(4, 60)))
        other = list(line)
        for _ in range(max(1, len(line) // 70)):
            other[r.randrange(len(other))] = r.choice("xyz")
        other = "".join(other)
        if linededup.alike(linededup.shingles(line), linededup.shingles(other), 0.8):
            pairs.append((line, other))
    a, b = (linededup.signatures(list(x)) for x in zip(*pairs))
    near = (linededup.bucket_keys(a) == linededup.bucket_keys(b)).any(axis=1)
    close = np.bitwise_count(linededup.sketches(a) ^ linededup.sketches(b)) <= linededup.SKETCH_BITS
    assert (near & close).mean() > 0.98
    alone = linededup.signatures([pairs[0][0]])
    assert (alone[0] == a[0]).all()  # a line's signature doesn't depend on its neighbours


def test_short_lines_are_one_shingle():
    assert linededup.shingles("ab") == frozenset({"ab\0\0\0"})
    assert len(linededup.signatures(["a", "ab", "abcdef"])) == 3


@pytest.mark.parametrize("scale", [1, 10**6])
def test_ball_tree_search_is_exact(scale):
    rng = np.random.default_rng(9)
    entries = (rng.normal(size=(900, 8)) * 100).astype(np.int64) * scale
    entries[100:200] = entries[0]
    entries = np.unique(entries, axis=0)
    ids = [np.array([i, i + 5000]) for i in range(len(entries))]
    queries = entries[:40]
    want_scores = (queries.astype(object) @ entries.T.astype(object))
    got = {i: (list(a), list(s)) for i, a, s in topk.search(entries, ids, queries, np.arange(40), np.full(40, topk.NO_FLOOR), 10, leaf=16)}
    for i in range(40):
        ranked = sorted((-int(want_scores[i, j]), int(v)) for j in range(len(entries)) for v in ids[j] if v != i)[:10]
        assert got[i] == ([v for _, v in ranked], [-s for s, _ in ranked])


def test_ordinal_regression_orders_grades():
    rng = np.random.default_rng(2)
    grades = rng.integers(0, 4, 2000)
    rows = [([0], [float(g) + rng.normal() * 0.2]) for g in grades]
    weights, cuts = toxicity.fit(rows, grades, 1, 4)
    assert weights[0] > 0 and (np.diff(cuts) > 0).all()
    model = toxicity.Model({"x": 0}, weights, cuts)
    p = model.probabilities(np.array([v[0] * weights[0] for _, v in rows]))
    assert ((p > 0.5).sum(axis=1) == grades).mean() > 0.9
    assert (np.diff(p, axis=1) <= 0).all()


def test_secret_spans():
    text = 'Password = "abc123" token:ab secret=tokens ' + "AKIA" + "A" * 16 + " " + "0f" * 12 + " AKIAAAAA ſecret=abcdefg"
    spans = secret_scan.base_spans(text)
    assert [(secret_scan.KINDS[k], text[s:e]) for s, k, e, _ in spans] == [
        ("assign", 'Password = "abc123'), ("assign", "secret=tokens"), ("access", "AKIA" + "A" * 16), ("hex", "0f" * 12)]
    assert secret_scan.base_spans("") == []
    assert secret_scan.base_spans("secret=token: abcdefgh") == []  # the short value was matched first
    key = "x9Kq2LmZ7pRt4VbN8sWd1"
    assert [text for *_, text in secret_scan.key_spans(f"see {key}.", [])] == [key]


def test_spanning_links_connect_what_all_pairs_do():
    """Against all pairs of string sets: near copies, chains, short lines, and clusters of two blocks."""
    draw = random.Random(1)

    def connected(n, links):
        parent = list(range(n))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for i, j in links:
            parent[find(i)] = find(j)
        return [min(k for k in range(n) if find(k) == find(x)) for x in range(n)]

    for t in range(200):
        base = "".join(draw.choice("abcdé ") for _ in range(draw.choice([3, 30, 200])))
        lines = []
        for _ in range(draw.randint(2, 14)):
            line = list(base)
            for _ in range(draw.randint(0, 6)):
                at = draw.randrange(len(line) + 1)
                line[at:at + draw.randint(0, 2)] = draw.choice("xyz")
            lines.append("".join(line) or "q")
        n = len(lines)
        block = np.array([draw.randrange(2) if t % 3 == 0 else 0 for _ in range(n)])
        crossing = len(set(block.tolist())) > 1
        sets = [linededup.shingles(x) for x in lines]
        want = [(i, j) for i in range(n) for j in range(i + 1, n) if (not crossing or block[i] != block[j]) and linededup.alike(sets[i], sets[j], 0.8)]
        got = linededup.spanning_links(linededup.shingle_sets(lines), block, 0.8)
        assert set(got) <= set(want) and connected(n, got) == connected(n, want)
