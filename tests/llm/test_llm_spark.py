"""Operators on small tables: nulls, empties, ties, repeats, extra columns, and brute force on the test data."""

import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import bpe, catalog, linededup, mixing, rules, secret_scan, simhash, topk, toxicity, urls, warc
from tessera.llm.components import components

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, words string, stats string"


def odd_documents(spark):
    """Nulls in any column, empty, blank and very long texts, repeated rows, and columns with clashing names."""
    long = " ".join(f"word{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two three four five six"), (4, "one two three four five six"), (5, "One two three four five six"),
            (None, "no id here but some words to read"), (6, long), (7, long + " tail"), (None, None)]
    return spark.createDataFrame([(i, t, "en" if i else None, "s" if i != 2 else None, len(t) if t else None, "w", "x") for i, t in rows], DOCS)


def documents(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def ids(df):
    return sorted((r.doc_id for r in df.collect()), key=lambda x: (x is None, x))


def test_every_stage_takes_odd_and_empty_tables(spark):
    odd = odd_documents(spark)
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            rows = out.collect()
            if name != "encode":
                assert out.columns == docs.columns
            if name == "encode":
                assert len(rows) == docs.count() and set(docs.columns) < set(out.columns)
    assert ids(simhash.keep_one(odd)) == [1, 4, 6, None]
    kept = {(r.doc_id, r.text) for r in linededup.keep_first_lines(odd).collect()}
    assert {i for i, _ in kept} == {1, 2, 3, 4, 6, None}


def test_bpe_operator(spark):
    out = bpe.encode(odd_documents(spark))
    back = bpe.decode(out).collect()
    assert all(r.decoded == (r.text or "") and r.n_tokens == len(r.token_ids) for r in back)
    digests = {r.doc_id: r for r in catalog.QUERIES["op1_bpe_codec"](spark, SF).collect()}
    import hashlib
    assert all(digests[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest() for i, t in documents(spark).items())


def test_warc_audit_finds_all_damage(spark):
    assert catalog.QUERIES["op2_warc_merkle_audit"](spark, SF).count() > 0
    rows = [(i, f"{i:064x}", 10) for i in range(9000)] + [(None, "n" * 64, 5), (None, "n" * 64, 5)]
    laid = warc.lay_out(spark.createDataFrame(rows, "id long, hash string, length long"), "id")
    got = sorted((r.file, r.seq, r.offset, r.id) for r in laid.collect())
    assert [(f, s) for f, s, _, _ in got] == [(n // 4096, n % 4096) for n in range(9002)]
    assert got[4096][2] == 0 and got[2][2] == 10 and got[3] == (0, 3, 20, 1)
    bad = laid.withColumnRenamed("hash", "hash_a").withColumn("hash_b", F.when(F.col("id") == 8000, "x").when(~F.col("id").eqNullSafe(F.lit(17)), F.col("hash_a")))
    assert sorted((r.id, r.status) for r in warc.audit(bad).collect()) == [(17, "missing_b"), (8000, "altered")]
    assert warc.audit(bad.limit(0)).count() == 0


def test_raking_meets_targets(spark):
    sizes = iter((900, 50, 30, 20, 5, 70, 11, 300, 60, 8, 90, 40))
    cells = [(s, g, t, next(sizes)) for s in ("a", "b", "(null)") for g in ("en", "fr") for t in ("x", "y")]
    table = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    targets = {"source": 0.5, "lang": {"en": 0.6, "fr": 0.4}, "topic": 1.0}
    raked = mixing.rake(table, targets, tolerance=1e-3).collect()
    assert sum(r.weight for r in raked if r.lang == "fr") == pytest.approx(0.4, abs=2e-3)
    assert sum(r.weight for r in raked) == pytest.approx(1.0, abs=2e-3)
    share = {s: sum(t for a, _, _, t in cells if a == s) ** 0.5 for s in ("a", "b", "(null)")}
    for s, g in share.items():
        assert sum(r.weight for r in raked if r.source == s) == pytest.approx(g / sum(share.values()), abs=2e-3)
    out = mixing.op3_raked_mix(spark, SF).collect()
    assert len(out) == len(documents(spark)) and all(0 <= r.p <= 1 for r in out)
    assert {r.doc_id for r in out if r.sampled} == {r.doc_id for r in mixing.sample(spark.read.parquet(f"{SF}/documents.parquet")).collect()}


def test_simhash_query_against_brute_force(spark):
    docs = documents(spark)
    prints = {}
    for i, text in docs.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        hashes = [xxhash.xxh64_intdigest(" ".join(w[j:j + 3]), 42) for j in range(max(1, len(w) - 2))] if w else []
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    order = sorted(docs)
    forest = simhash.Forest(len(order))
    for a in range(len(order)):
        for b in range(a):
            if (prints[order[a]] ^ prints[order[b]]).bit_count() <= 3:
                forest.join(a, b)
    want = {(i, f"{prints[i]:016x}", order[forest.find(n)]) for n, i in enumerate(order)}
    assert {tuple(r) for r in catalog.QUERIES["op4_simhash_vp_tree"](spark, SF).collect()} == want


def test_components(spark):
    links = [(i + 1, i) for i in range(40)] + [(100, 200), (200, 150), (7, 7), (None, 3)] + [(1000, i) for i in range(2000, 2100)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(41)) and got[200] == got[150] == 100 and got[2050] == 1000
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_line_query_against_brute_force(spark):
    docs = documents(spark)
    places = [(i, n, x) for i in sorted(docs) for n, x in enumerate((docs[i] or "").split("\n")) if x.strip(" \t\n\x0b\x0c\r")]
    lines = sorted({x for *_, x in places})
    sets, forest = [linededup.shingles(x) for x in lines], simhash.Forest(len(lines))
    for a in range(len(lines)):
        for b in range(a):
            if linededup.alike(sets[a], sets[b], 0.8):
                forest.join(a, b)
    group = {x: forest.find(n) for n, x in enumerate(lines)}
    first = {}
    for i, n, x in places:
        first.setdefault(group[x], (i, n))
    want = {(i, n, *first[group[x]], (i, n) == first[group[x]]) for i, n, x in places}
    got = {tuple(r) for r in catalog.QUERIES["op5_fuzzy_lines"](spark, SF).collect()}
    assert len(got ^ want) <= 0.01 * len(want)


def test_large_buckets_are_dealt_by_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a common template line with a number at its end {i}") for i in range(300)], "doc_id long, text string")
    monkeypatch.setattr(linededup, "BLOCK", 40)
    got = linededup.line_classes(docs).collect()
    assert {r.class_doc_id for r in got} == {0} and sum(r.kept for r in got) == 1


def base_statistics(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if windows[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_statistics_and_rules(spark):
    docs = documents(spark)
    rows = {r.doc_id: r for r in catalog.QUERIES["op6_quality_rules"](spark, SF).collect()}
    for i, text in docs.items():
        r = rows[i]
        n, *_, repeated = base_statistics(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_statistics(text)
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n) and not (r.base_failed and r.kept)
    odd = ["a b c a b c a b c", "x x x x", "é è\u00a0ê", "a\n\na\n \na", None, ""]
    got = rules.with_statistics(spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")).collect()
    assert [tuple(r.stats) for r in sorted(got)] == [base_statistics(t) for t in odd]


def test_decision_list_learns_a_conjunction(spark):
    rows = spark.range(4000).select(F.pmod(F.xxhash64("id"), F.lit(100)).cast("double").alias("x"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)).cast("double").alias("y"))
    bad = (F.col("x") >= 60) & (F.col("y") < 30)
    learned = rules.learn(rows, {"x": F.col("x"), "y": F.col("y")}, bad)
    reason = learned.reason({"x": F.col("x"), "y": F.col("y")})
    assert rows.filter(reason.isNotNull() != bad).count() < 80
    assert rules.learn(rows.limit(0), {"x": F.col("x")}, F.lit(True)).rules == []


def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.train(docs, labels.filter("doc_id % 2 = 0"))
    held = toxicity.score(docs, model).join(labels.filter("doc_id % 2 = 1").withColumnRenamed("toxic", "y"), "doc_id")
    n = Counter((r.y, r.toxic) for r in held.collect())
    assert n[1, True] > 0.9 * (n[1, True] + n[1, False]) and n[0, True] < 0.01 * (n[0, True] + n[0, False])
    odd = toxicity.score(odd_documents(spark), model).collect()
    assert len(odd) == 10 and not any(r.toxic for r in odd)
    nothing = toxicity.train(docs, labels.limit(0))
    assert not any(r.toxic for r in toxicity.score(odd_documents(spark), nothing).collect())


def test_toxicity_counts_whole_at_any_number_of_tasks(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    one, many = (toxicity.train(docs.repartition(n, "doc_id"), labels) for n in (1, 97))
    assert one.features and one.features == many.features
    assert np.array_equal(one.weights, many.weights) and np.array_equal(one.thresholds, many.thresholds)


def test_toxicity_sample_is_bounded_in_rows(spark, monkeypatch):
    rows = [(i, f"{'vile' if i % 2 else 'fine'} words {i}") for i in range(60)] + [(7, f"vile again {n}") for n in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    seen, select = [], toxicity.select
    monkeypatch.setattr(toxicity, "select", lambda rows, *how: seen.append(len(rows)) or select(rows, *how))
    model = toxicity.train(docs, labels)
    assert seen == [60] and "vile" in model.features


def plain_bounded_raking(cells, goals, most, sweeps=400):
    """Weights of {cell: tokens}: least(most, raw), raw scaled value by value until the marginals meet the goals; by bisection."""
    whole = sum(cells.values())
    raw = {c: t / whole for c, t in cells.items()}
    for _ in range(sweeps):
        for d, wanted in enumerate(goals):
            for value, goal in wanted.items():
                own = [c for c in cells if c[d] == value]
                low, high = 0.0, 1e9
                for _ in range(200):
                    middle = (low * high) ** 0.5 if low else high / 2
                    if sum(min(most[c], raw[c] * middle) for c in own) < goal:
                        low = middle
                    else:
                        high = middle
                for c in own:
                    raw[c] *= high
    return {c: min(most[c], raw[c]) for c in cells}


def test_full_cells_leave_their_weight_to_others(spark):
    sizes = iter((900, 50, 30, 20, 25, 70, 41, 300, 60, 48, 90, 40))
    cells = {(s, g, t): next(sizes) for s in ("a", "b", "(null)") for g in ("en", "fr") for t in ("x", "y")}
    frame = spark.createDataFrame([(*c, n) for c, n in cells.items()], "source string, lang string, topic string, tokens long")
    targets, budget, whole = {"source": 0.8, "lang": {"en": 0.6, "fr": 0.4}, "topic": 0.9}, 0.7, sum(cells.values())
    got = {(r.source, r.lang, r.topic): r for r in mixing.probabilities(mixing.rake(frame, targets, budget, tolerance=1e-6), budget).collect()}
    sums = [{}, {}, {}]
    for c, n in cells.items():
        for d in range(3):
            sums[d][c[d]] = sums[d].get(c[d], 0) + n
    goals = [{v: n**0.8 for v, n in sums[0].items()}, {"en": 0.6, "fr": 0.4}, {v: n**0.9 for v, n in sums[2].items()}]
    goals = [{v: g / sum(own.values()) for v, g in own.items()} for own in goals]
    plain = plain_bounded_raking(cells, goals, {c: n / whole / budget for c, n in cells.items()})
    assert any(r.p == 1 for r in got.values()) and all(r.p <= 1 for r in got.values())
    for c, w in plain.items():
        assert got[c].weight == pytest.approx(w, abs=1e-4)
        assert got[c].p == pytest.approx(min(1, w * budget * whole / cells[c]), abs=5e-4)
    assert sum(r.p * r.tokens for r in got.values()) == pytest.approx(budget * whole, rel=1e-4)
    rough = mixing.rake(frame, targets, budget, tolerance=1e-3)
    by_joins = mixing.rake(frame, targets, budget, tolerance=1e-3, task_bytes=0)  # the same arithmetic, for tables of any size
    assert {tuple(r)[:3]: r.weight for r in by_joins.select(*targets, "weight").collect()} == pytest.approx(
        {tuple(r)[:3]: r.weight for r in rough.select(*targets, "weight").collect()}, abs=1e-9)


def test_goals_beyond_what_values_hold_are_dealt_on_and_reported(spark, caplog):
    rows = [("a", "en", "x", 900), ("b", "en", "x", 90), ("c", "fr", "y", 10)]
    frame = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    targets = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": 1.0, "topic": 1.0}
    raked = mixing.rake(frame, {"source": targets["source"]}, 0.8)
    got = {r.source: r.weight for r in raked.collect()}
    assert got == pytest.approx({"c": 0.0125, "b": 0.1125, "a": 0.875}, abs=1e-6)  # c and b are taken whole
    told = {(r.dimension, r.value): (r.target, r.reached) for r in mixing.misses(raked, {"source": targets["source"]}).collect()}
    assert told[("source", "c")] == pytest.approx((0.2, 0.0125), abs=1e-6)
    crossed = spark.createDataFrame([("a", "en", "x", 5), ("b", "fr", "y", 5)], "source string, lang string, topic string, tokens long")
    with caplog.at_level("WARNING"):
        raked = mixing.rake(crossed, {"source": {"a": 0.9, "b": 0.1}, "lang": {"en": 0.1, "fr": 0.9}})
    assert "off its goal" in caplog.text
    assert max(abs(r.target - r.reached) for r in mixing.misses(raked, {"source": {"a": 0.9, "b": 0.1}, "lang": {"en": 0.1, "fr": 0.9}}).collect()) > 0.5


def test_clashing_names_in_mixing_and_urls(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("_cell_source", F.lit("x")).withColumn("p", F.lit(2)).withColumn("_tokens", F.lit(1))
    kept = mixing.sample(docs)
    assert kept.columns == docs.columns
    plain = {r.doc_id for r in mixing.sample(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    assert {r.doc_id for r in kept.collect()} == plain
    assert mixing.sample(docs.limit(0)).count() == 0
    pages = spark.createDataFrame([(1, "http://bad.com/9", 7)], "page_id long, url string, _bad_host int")
    outcomes = spark.createDataFrame([("bad.com", 1)] * 60 + [("good.com", 0)] * 60, "host string, bad int")
    assert [(r["_bad_host"], r.verdict) for r in urls.judge(pages, outcomes).collect()] == [(7, "block")]
    assert urls.judge(pages.limit(0), outcomes).count() == 0


def test_secrets_by_ownership(spark):
    key = "x9Kq2LmZ7pRt4VbN8sWd1"
    rows = [(1, f"own {key}", "a", "en"), (2, f"own {key}", "a", "fr"), (3, "shared Zx8Kq2LmZ7pRt4VbN8sWd2", "a", "en"), (4, "shared Zx8Kq2LmZ7pRt4VbN8sWd2", "b", "en"),
            (5, "password=hunter22", "a", None), (6, None, None, None), (None, "", "c", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = {r.doc_id: r for r in secret_scan.find_secrets(docs).withColumn("said", secret_scan.as_text(F.col("spans"))).collect()}
    assert got[1].said == got[2].said == f"key:4:{4 + len(key)}" and got[3].said == got[4].said == ""
    assert got[5].said == "assign:0:17" and got[6].said == "" and got[None].said == ""
    assert secret_scan.find_secrets(docs.limit(0)).count() == 0
    assert catalog.QUERIES["op8_secret_ownership"](spark, SF).count() == len(documents(spark))


def test_secrets_by_share_of_the_corpus(spark):
    stray, wide, pasted, twice, mirrored = (f"x9Kq2LmZ7pRt4VbN8sWd{i}" for i in range(5))
    rows = [(f"s{i}", "en", "none") for i in range(20)] + [("s0", "en", stray), ("s1", "en", f"near {stray}")]
    rows += [(f"s{i}", "fr", wide) for i in range(5)] + [("s0", "en", f"{i} {pasted}") for i in range(100)]
    rows += [("s2", "en", f"{twice} " * 150), ("s2", "fr", twice)] + [("s3", f"l{i}", mirrored) for i in range(8)]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, source string, lang string, text string")
    got = secret_scan.find_secrets(docs).join(docs, "doc_id").collect()

    def said(value):
        return {(len(r.spans) > 0, r.n_live > 0, r.n_copied > 0) for r in got if value in r.text}

    live, copied = {(True, True, False)}, {(False, False, True)}
    assert said(stray) == live and said(twice) == live  # 2 of 20 owners; one document that repeats it
    assert said(wide) == copied and said(pasted) == copied and said(mirrored) == copied  # owners, copies, repositories


def test_copies_are_many_by_the_size_of_the_corpus(spark):
    key = "x9Kq2LmZ7pRt4VbN8sWd1"
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.lit("en").alias("lang"),
                                   F.when(F.col("id") < 15, key).otherwise("none").alias("text"))
    live = secret_scan.find_secrets(docs, many_copies=3).agg(F.sum("n_live"), F.sum("n_copied")).first()
    assert tuple(live) == (15, 0)  # 20 of 400 would be many
    assert tuple(secret_scan.find_secrets(docs.limit(200), many_copies=3).agg(F.sum("n_live"), F.sum("n_copied")).first()) == (0, 15)


def test_urls(spark):
    rows = [(1, "http://Sub.Example.NET/en/1"), (2, "http://a.net/x"), (3, "https://x.org/fr/2?a#b"), (4, "http://bad.com/9"), (5, None), (6, "no scheme"),
            (7, "http://example.com/de/1"), (8, "http://good.com#x://y"), (9, "http://a.net")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    outcomes = spark.createDataFrame([("bad.com", 1)] * 60 + [("good.com", 0)] * 60 + [("new.com", None)], "host string, bad int")
    got = {r.page_id: r for r in urls.judge(pages.withColumn("host", F.lit("clash")), outcomes).collect()}
    assert [(got[i].rule, got[i].verdict) for i in (1, 2, 3, 7)] == [("example.net/en/", "allow"), ("net/", "block"), ("org/fr/", "allow"), ("example.com/de/", "block")]
    assert got[4].verdict == "block" and got[8].verdict == "allow" and (got[8].host, got[8].path) == ("good.com", "")
    assert (got[5].host, got[5].path, got[6].host) == ("", "", "") and got[9].rule is None and got[3].path == "/fr/2"
    assert urls.judge(pages, outcomes.limit(0)).filter("verdict is null").count() == 0


def test_registered_domains_under_suffixes_of_two_labels(spark):
    names = {"www.a.co.uk": ("a.co.uk", "co.uk"), "b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "x.y.uk": ("y.uk", "uk"),
             "w.xco.uk": ("xco.uk", "uk"), "m.example.com": ("example.com", "com"), "localhost": ("localhost", "localhost"), "": ("", "")}
    hosts = spark.createDataFrame([(n,) for n in names], "host string")
    assert {r[0]: (r[1], r[2]) for r in hosts.select("host", *urls.registered(F.col("host"))).collect()} == names
    outcomes = spark.createDataFrame([(f"w{i}.bad.co.uk", 1) for i in range(60)] + [(f"w{i}.good.co.uk", 0) for i in range(60)]
                                     + [("new.bad.co.uk", None), ("new.good.co.uk", None)], "host string, bad int")
    got = {r.host: r.mean for r in urls.reputation(outcomes).collect()}
    assert got["new.bad.co.uk"] > 0.6 and got["new.good.co.uk"] < 0.4
    cut = {r.host: r.mean for r in urls.reputation(outcomes, suffixes=()).collect()}
    assert cut["new.bad.co.uk"] == pytest.approx(cut["new.good.co.uk"])


def test_top_k_edges(spark):
    rows = [(0, [0.5, 0.25]), (1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (None, [1.0, 1.0]), (100, [-0.5, 0.1]), (1, [0.5, 0.25]), (7, [1.0])]
    vectors = topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = topk.top_k(vectors, vectors.filter("id % 100 = 0")).collect()
    assert [(r.rank, r.vec_id) for r in sorted(got, key=lambda r: r.rank) if r.query_id == 0] == [(1, 1), (2, 2), (3, 100)]
    assert len([r for r in got if r.query_id == 100]) == 3
    assert topk.top_k(vectors.limit(0), vectors.limit(0)).count() == 0


def test_top_k_in_waves_over_many_shards(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    centres = rng.normal(0, 3, (6, 8))
    points = np.concatenate([c + rng.normal(0, 0.2, (60, 8)) for c in centres] + [np.tile(centres[0], (120, 1))])
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    vectors = topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    whole = np.floor(points * 1024).astype(int)
    scores = whole @ whole.T
    got = {}
    for r in topk.top_k(vectors, vectors.filter("id % 7 = 0"), k=5, shard_rows=40, block=11, sample_rows=64).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(range(0, len(rows), 7))
    for q, found in got.items():
        best = sorted((j for j in range(len(rows)) if j != q), key=lambda j: (-scores[q, j], j))[:5]
        assert sorted(found) == [(i + 1, j, scores[q, j]) for i, j in enumerate(best)]


def test_top_k_beyond_a_long(spark):
    rows = [(0, [1e300, 1.0]), (1, [1e300, 1.0]), (2, [-1e300, 0.0]), (3, [1.0, 1.0])]
    vectors = topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = sorted((r["rank"], r.vec_id, r.score) for r in topk.top_k(vectors, vectors.filter("id = 0")).collect())
    assert got == [(1, 1, 2**63 - 1), (2, 3, 2**63 - 1), (3, 2, -(2**63))]


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 50 and np.all([r.n_tokens == len(r.token_ids) for r in out.collect()])
