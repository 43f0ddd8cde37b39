"""Personal data: fixed patterns as seeds, and a bootstrapped search for more by the words around them.

Emails, addresses, cards and phone numbers found by fixed (base) patterns are
the seed entities. Every occurrence of a seed, and of any other string that
looks like an identifier (a *candidate*: six digits or more, touching no base
span), induces lexical patterns from the words beside it. Patterns and values
form a bipartite graph over the corpus. It is scored in rounds: a pattern is
as credible as the values it is seen with, a candidate as the credible
patterns around it. Candidates that end above the bound are spans of kind
``context``; base spans always stay.

Column expressions, joins and aggregates only. Texts are read once, in place,
and never shuffled; values travel as hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import SPACE, checkpointed, stored, table

# The kinds in their order; the added kind is the last.
KINDS = ("email", "ip", "card", "phone", "context")
CONTEXT = KINDS.index("context")
SEEDS = KINDS[:CONTEXT]

#: The base patterns, each so that a failing start is left after a bounded look. A match can only begin where a run of its
#: first characters begins (or, for emails, where the last match ended), since every later start in that run reads the same
#: rest; repeats are possessive, since what follows one can't begin with its characters. So the matches are those of
#: ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+`` and so on, in time that grows with the text, not with its runs' squares.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++"
#: Chains of digits with single blanks or hyphens are matched whole, so a chain of 13 to 19 digits is one between its two ends.
CARD = r"[0-9](?<![0-9][0-9])(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PATTERNS = (EMAIL, IP, CARD, PHONE)
#: A text without this character has no match.
NEEDS = ("@", ".", None, "+")
OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"

#: An identifier by its look: a word of letters (8 at most before the first digit) and digits, with inner . / _ and hyphens.
CANDIDATE = r"(?<![A-Za-z0-9])[A-Za-z]{0,8}+[0-9][A-Za-z0-9]*+(?:[./_-][A-Za-z0-9]++)*+"
MANY_DIGITS = r"(?:[0-9][^0-9]*+){6}"
#: Characters looked at on each side for the neighbouring words.
REACH = 64

SPAN = "struct<kind:int,start:bigint,end:bigint>"
OCCURRENCE = f"array<struct<span:{SPAN},value:string,patterns:array<string>>>"


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _running(lengths: Column, block: int = 256) -> Column:
    """The running sums of an array of longs, in blocks, so that a long array isn't copied once per element."""
    zero = F.lit(0).cast("bigint")

    def sums(part: Column) -> Column:
        return F.aggregate(part, F.array().cast("array<bigint>"),
                           lambda done, x: F.concat(done, F.array(F.coalesce(F.get(done, F.size(done) - 1), zero) + x)))

    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(lengths) / block).cast("int")),
                         lambda b: sums(F.slice(lengths, b * block + 1, F.lit(block))))

    def shifted(inner: Column) -> Column:
        totals = sums(F.transform(inner, lambda part: F.coalesce(F.get(part, F.size(part) - 1), zero)))
        return _let(totals, lambda t: F.flatten(F.transform(
            inner, lambda part, b: F.transform(part, lambda x: x + F.coalesce(F.get(t, b - 1), zero)))))

    return _let(blocks, shifted)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check of card numbers; null for null."""
    back = F.reverse(digits)

    def term(i: Column) -> Column:
        d = F.substr(back, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda t, i: t + term(i)) % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    """What a match has to pass besides its pattern."""
    return (F.when(kind == KINDS.index("ip"), value.rlike(OCTETS))
            .when(kind == KINDS.index("card"), luhn(F.regexp_replace(value, r"[\x20-]", "")))
            .when(kind == KINDS.index("phone"), F.length(F.regexp_replace(value, "[^0-9]", "")).between(9, 15))
            .when(kind == CONTEXT, value.rlike(MANY_DIGITS)).otherwise(True))


def _neighbours(before: Column, after: Column) -> Column:
    """Two lexical patterns of a place: its last two words before, and the word on each side; digits as 0, lower case."""

    def words(part: Column) -> Column:
        return F.array_remove(F.split(F.regexp_replace(F.lower(part), "[0-9]+", "0"), SPACE, -1), "")

    def patterns(sides: Column) -> Column:
        left, right = F.get(sides, F.lit(0)), F.get(sides, F.lit(1))
        last = F.coalesce(F.get(left, F.size(left) - 1), F.lit("^"))
        return F.array(F.concat_ws(" ", F.coalesce(F.get(left, F.size(left) - 2), F.lit("^")), last, F.lit("_")),
                       F.concat_ws(" ", last, F.lit("_"), F.coalesce(F.get(right, F.lit(0)), F.lit("$"))))

    return _let(F.array(words(F.substring(before, -REACH, REACH)), words(F.substring(after, 1, REACH))), patterns)


def scan(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: ``id``, ``base`` and ``others``, arrays of found places with value and lexical patterns.

    One narrow pass over the whole texts; null and empty texts have empty
    arrays. Spark gives matches without their places, so these come from the
    pieces of text between the matches of a kind. Pieces shorter than ``REACH``
    at either end simply give fewer words.
    """
    text = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast("array<string>")
    df = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    kinds = list(zip((*PATTERNS, CANDIDATE), (*NEEDS, None)))
    df = df.withColumn("found", F.array(*[
        F.when(F.lit(True) if needs is None else F.contains("text", F.lit(needs)), F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none)
        for pattern, needs in kinds]))
    df = df.withColumn("parts", F.array(*[
        F.when(F.size(F.get("found", F.lit(k))) > 0, F.split("text", pattern, -1)).otherwise(none) for k, (pattern, _) in enumerate(kinds)]))
    df = df.select("id", "found", "parts", F.transform("found", lambda found, k: F.when(F.size(found) == 0, F.array().cast("array<bigint>")).otherwise(_let(
        F.transform(found, lambda x, i: (F.char_length(F.get(F.get("parts", k), i)) + F.char_length(x)).cast("bigint")), lambda lengths: _running(lengths)))).alias("ends"))

    def hit(k: Column, x: Column, i: Column) -> Column:
        end, part = F.get(F.get("ends", k), i), F.get("parts", k)
        span = F.struct(k.alias("kind"), (end - F.char_length(x)).alias("start"), end.alias("end"))
        return F.struct(span.alias("span"), x.alias("value"), _neighbours(F.get(part, i), F.get(part, i + 1)).alias("patterns"))

    def hits(found: Column, k: Column) -> Column:
        return F.filter(F.transform(found, lambda x, i: F.when(_valid(k, x), hit(k, x, i))), lambda x: x.isNotNull())

    df = df.select("id", F.transform("found", hits).alias("hits"))
    df = df.select("id", "hits", F.flatten(F.slice("hits", 1, len(SEEDS))).alias("base"))
    free = F.filter(F.get("hits", F.lit(CONTEXT)), lambda x: ~F.exists(
        "base", lambda s: (s["span"]["start"] < x["span"]["end"]) & (x["span"]["start"] < s["span"]["end"])))
    return df.select("id", F.col("base").cast(OCCURRENCE).alias("base"), free.cast(OCCURRENCE).alias("others"))


def graph(found: DataFrame) -> DataFrame:
    """The edges of ``found`` (kind, value, patterns; once an occurrence): ``pattern``, ``value`` and the value's seed ``kind``.

    One row per pattern and value however often they meet, summed in the tasks
    first, so a line that a third of the texts share is one row per task. A
    value's kind is the first seed kind it was matched as anywhere, else ``context``.
    """
    met = found.groupBy("value", "kind", "patterns").agg(F.count(F.lit(1)).alias("n"))
    kinds = met.groupBy("value").agg(F.min("kind").alias("kind"))
    edges = met.select("value", F.explode("patterns").alias("pattern")).distinct()
    return edges.join(kinds, "value")


def score(edges: DataFrame, rounds: int = 3, min_confidence: float = 0.8, doubt: float = 1.0) -> DataFrame:
    """Scores of the candidate values of ``edges``: ``value``, ``kind`` (number of the seed kind it resembles), ``score``.

    A round: a pattern's confidence for a kind is the sum of its values'
    scores for that kind over their number plus ``doubt``, so a pattern met
    with few values is never sure of anything. A candidate's score is the
    noisy-or of its patterns of at least ``min_confidence``; seeds keep 1. Candidates
    that no such pattern supports have no row. Both steps aggregate over
    edges, in the tasks first; state between rounds is a written table.
    """
    marks = [f"s{k}" for k in range(len(SEEDS))]
    seeds = edges.filter(F.col("kind") < CONTEXT).select("value", *[(F.col("kind") == k).cast("double").alias(m) for k, m in enumerate(marks)]).distinct()
    candidates = edges.filter(F.col("kind") == CONTEXT).select("pattern", "value")
    state = None
    for _ in range(rounds):
        known = seeds if state is None else seeds.unionByName(state)
        of = edges.select("pattern", "value").join(known, "value", "left")
        sure = of.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(m), F.lit(0.0)).alias(m) for m in marks])
        sure = sure.select("pattern", *[(F.col(m) / (F.col("n") + doubt)).alias(m) for m in marks])
        sure = sure.filter(F.greatest(*marks) >= min_confidence)
        doubts = [F.sum(F.when(F.col(m) >= min_confidence, F.log1p(-F.col(m))).otherwise(0.0)) for m in marks]
        state = stored(candidates.join(sure, "pattern").groupBy("value").agg(*[(1 - F.exp(d)).alias(m) for d, m in zip(doubts, marks)]))
    best = F.greatest(*marks)
    return state.select("value", (F.array_position(F.array(*marks), best) - 1).cast("int").alias("kind"), best.alias("score"))


def as_text(spans: Column) -> Column:
    """``kind:start:end`` by kind as listed, then start, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def find_personal(docs: DataFrame, text: str = "text", id_col: str = "doc_id", rounds: int = 3,
                  min_confidence: float = 0.8, min_score: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: its id, ``base`` and ``spans``, arrays of (kind, start, end) in code points.

    ``spans`` are the base spans and those of the candidates that the
    bootstrap scores at ``min_score`` or more. Null and empty texts have empty
    arrays; repeated rows each get a row (and count once in the graph); null
    ids are kept. Other columns of ``docs`` are not read, so their names don't
    matter. The scan is checkpointed, so row numbers stay as they are when an
    executor is lost.
    """
    rows = checkpointed(scan(docs, text, id_col).withColumn("row", F.monotonically_increasing_id()))
    met = rows.select("row", F.explode(F.concat("base", "others")).alias("x")).select(
        "row", "x.span", F.col("x.span.kind").alias("kind"), F.sha2(F.lower("x.value"), 256).alias("value"), "x.patterns")
    edges = stored(graph(met))
    taken = score(edges, rounds, min_confidence).filter(F.col("score") >= min_score).select("value")
    added = met.filter(F.col("kind") == CONTEXT).join(taken, "value", "left_semi")
    added = added.groupBy("row").agg(F.collect_list("span").alias("added"))
    out = rows.select("row", F.col("id").alias(id_col), F.col("base.span").alias("base")).join(added, "row", "left")
    spans = F.concat("base", F.coalesce("added", F.array().cast(f"array<{SPAN}>")))
    return out.select(id_col, "base", F.array_sort(spans).alias("spans"))


def op11_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document; digests of the base spans and all spans as text."""
    found = find_personal(table(spark, sf_dir, "documents"))

    def count(name: str, of: str = "base") -> Column:
        return F.size(F.filter(of, lambda s: s["kind"] == KINDS.index(name))).cast("long").alias(f"n_{name}")

    return found.select("doc_id", *map(count, SEEDS), F.sha2(as_text(F.col("base")), 256).alias("base_sha256"),
                        as_text(F.col("spans")).alias("spans"), count("context", "spans"))
