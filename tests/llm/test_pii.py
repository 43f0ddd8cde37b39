"""Personal data: base spans against plain regular expressions, discovery by context, odd rows."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import pii

SF = "/root/testdata/sf0.001"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(k, m[0])]


def named(spans):
    return [(pii.KINDS[s.kind], s.start, s.end) for s in spans]


TRICKY = [
    "a@b.c_d@e.f", "x@y@z.org", "@a.b", "a@b", "mail a.b+c@d-e.f.g, or %@x.yz!", "é@b.fr ü1.2.3.4é",
    "1.2.3.4.5.6.7.8", "300.1.1.1.5 0001.02.003.255", "1.2.3", "256.1.1.1 1.1.1.0000000000255", "1..2.3.4.5",
    "4111 1111 1111 1111", "4111-1111-1111-1111-2", "4111  1111 1111 1111", "0" * 13, "0" * 19, "0" * 20, "x4111111111111111y",
    "+1 (523) 555-1055", "+1+1 234 567 89", "+12 3456", "+1 ((((( 234567890 )", "+1234567890123456", "++49.30.123456789.",
    "tel +1 523 555 1055 a@b.cc 10.0.0.1 4111111111111111 \U0001f600 z@z.zz", "", None, " \n ",
]


def test_base_spans_equal_plain_regular_expressions(spark):
    rows = list(enumerate(TRICKY)) + [(1000 + r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = pii.find_personal(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        assert named(r.base) == brute(texts[r.doc_id]), texts[r.doc_id]


def test_query_digests(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in pii.op11_contextual_pii(spark, SF).collect():
        want = brute(texts[r.doc_id])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in want) for kind in PATTERNS]
        assert r.spans.startswith(line)


def test_hot_repeats_and_long_texts_stay_linear(spark):
    """Runs that a plain pattern reads once per start: letters without @, digits without dots, chains, many places in a text."""
    many = " ".join(f"u{i}@h.org" for i in range(20_000))
    texts = ["a" * 300_000, "7" * 300_000, "1 " * 100_000, "a@b" + ".c" * 50_000, "+1" * 50_000, many]
    got = {r.doc_id: r for r in pii.find_personal(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [len(got[i].base) for i in range(6)] == [0, 0, 0, 1, 0, 20_000]
    assert named(got[5].base)[-1] == ("email", len(many) - len("u19999@h.org"), len(many))


def seeded(spark, extra=()):
    """Phones after 'reach me at', and strings of other shapes in the same and in other places."""
    rows = [(i, f"hello there reach me at +1 (200) 555-{1000 + i} any time you like number {i % 7}") for i in range(100)]
    rows += [(500, "please reach me at 0171-9345678 any time"), (501, "the order 9934567812 was shipped"), (502, "build 20240101123 failed again")]
    return spark.createDataFrame(rows + list(extra), "doc_id long, text string")


def test_contexts_of_seeds_find_an_identifier_of_another_shape(spark):
    got = {r.doc_id: r for r in pii.find_personal(seeded(spark)).collect()}
    assert named(got[500].spans) == [("context", 19, 31)] and got[500].base == []
    assert got[501].spans == [] and got[502].spans == []
    assert all(named(got[i].spans) == [("phone", 24, 41)] for i in range(100))


def test_second_round_reaches_places_that_no_seed_has(spark):
    """A value learned beside seeds vouches for the other places where it is met; those find further values."""
    learned = [(600 + i, f"kindly reach me at 0171-93456{i:02d} any day, mine is 0171-93456{i:02d} for sure") for i in range(12)]
    got = {r.doc_id: r for r in pii.find_personal(seeded(spark, [*learned, (700, "and mine is 0199-777888 for sure")])).collect()}
    assert named(got[700].spans) == [("context", 12, 23)]
    one = {r.doc_id: r for r in pii.find_personal(seeded(spark, [*learned, (700, "and mine is 0199-777888 for sure")]), rounds=1).collect()}
    assert one[700].spans == []


def test_few_seeds_are_no_evidence(spark):
    rows = [(1, "call me at +1 200 555 1000 now"), (2, "call me at 0171-9345678 now")]
    assert all("context" not in [k for k, _, _ in named(r.spans)] for r in pii.find_personal(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_scores_equal_plain_loops(spark):
    """The rounds of the graph on random edges, in plain Python."""
    import math
    import random

    draw = random.Random(3)
    kinds = {f"v{i}": draw.choice([0, 0, 1, 3, 4, 4]) for i in range(60)}
    edges = sorted({(f"p{draw.randrange(12)}", f"v{draw.randrange(60)}") for _ in range(400)})
    known = {v: [float(k == j) for j in range(4)] for v, k in kinds.items() if k < 4}
    for _ in range(3):
        conf = {}
        for p in {p for p, _ in edges}:
            values = [v for q, v in edges if q == p]
            conf[p] = [sum(known.get(v, [0] * 4)[j] for v in values) / (len(values) + 1) for j in range(4)]
        for v in [v for v, k in kinds.items() if k == 4]:
            sure = [conf[p] for p, w in edges if w == v and max(conf[p]) >= 0.3]
            known.pop(v, None)
            if sure:
                known[v] = [1 - math.prod(1 - c[j] for c in sure if c[j] >= 0.3) for j in range(4)]
    got = pii.score(spark.createDataFrame([(p, v, kinds[v]) for p, v in edges], "pattern string, value string, kind int"), min_confidence=0.3).collect()
    assert {r.value: pytest.approx(r.score) for r in got} == {v: max(s) for v, s in known.items() if kinds[v] == 4}
    assert all(known[r.value][r.kind] == pytest.approx(r.score) for r in got)


def test_odd_rows_and_clashing_columns(spark):
    rows = [(1, None, "x", 1), (None, "a@b.cc", "x", 2), (3, "a@b.cc", None, 3), (3, "a@b.cc", "y", 4), (4, "", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, row long").withColumns(
        {c: F.lit(1) for c in ("id", "base", "found", "parts", "hits", "value", "pattern", "kind", "added")})
    got = pii.find_personal(docs)
    assert got.columns == ["doc_id", "base", "spans"]
    assert sorted((r.doc_id or 0, named(r.spans)) for r in got.collect()) == [
        (0, [("email", 0, 6)]), (1, []), (3, [("email", 0, 6)]), (3, [("email", 0, 6)]), (4, [])]
    assert pii.find_personal(docs.limit(0)).collect() == []


def test_no_python_worker_in_the_plan(spark):
    plan = pii.scan(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
