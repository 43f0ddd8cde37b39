"""Quality rules: decision lists learned by sequential covering, in native expressions.

A rule is a conjunction of thresholds on a document's statistics and rejects
what it matches. Rules are learned one after another from labelled rows: a
rule *grows* on two thirds of them, each time by the condition of the highest
information gain, is *pruned* on the other third to the prefix that separates
best there, and is accepted if it is precise enough on that third; rows that
it covers are then set aside. The list becomes one ordered ``CASE WHEN``.

Everything is DataFrame code. The driver sees counts per (statistic, bin)
only, whose number doesn't depend on the data; labelled rows stay in Spark.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed, free_name, table, words_of

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = "[#*$%&|<>]"


def with_statistics(docs: DataFrame, text: str = "text", into: str = "stats") -> DataFrame:
    """``docs`` with a struct column ``into`` of the five base statistics (long).

    ``n_repeat_words`` counts the words that lie in a 3-word window found twice
    or more. Windows are compared by their 64-bit hash within one text: they
    are sorted with their positions only where some hash repeats, and the
    covered words are counted from the gaps between repeated positions. The
    whole text is used; null and empty texts have all five at zero. No shuffle.
    """
    words, lines, windows, pairs, at = (free_name(docs, f"_q_{n}") for n in ("words", "lines", "windows", "pairs", "at"))
    value = F.coalesce(F.col(text), F.lit(""))

    def next_to(j, step):
        return F.get(F.col(pairs), j + step)["h"]

    df = docs.withColumn(words, words_of(text))
    df = df.withColumn(windows, F.when(F.size(words) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.col(words)[i], F.col(words)[i + 1], F.col(words)[i + 2]),
    )).otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn(pairs, F.when(
        F.size(F.array_distinct(windows)) < F.size(windows),
        F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    ))
    df = df.withColumn(at, F.sort_array(F.transform(
        F.filter(pairs, lambda p, j: F.coalesce(next_to(j, -1) == p["h"], F.lit(False)) | F.coalesce(next_to(j, 1) == p["h"], F.lit(False))),
        lambda p: p["i"],
    )))
    df = df.withColumn(lines, F.filter(F.split(value, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    covered = F.aggregate(
        F.transform(at, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(F.col(at), j + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"), lambda total, n: total + n,
    )
    return df.withColumn(into, F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.char_length(F.concat_ws("", words)).cast("long").alias("word_chars"),
        F.regexp_count(value, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )).drop(words, windows, pairs, at, lines)


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def features(stats: str = "stats") -> dict[str, Column]:
    """What the rules put thresholds on, from the base statistics."""
    s = {n: F.col(f"{stats}.{n}") for n in BASE}
    return {
        "words": s["n_words"].cast("double"),
        "word_length": _share(s["word_chars"], s["n_words"]),
        "symbols_per_word": _share(s["n_symbols"], s["n_words"]),
        "dup_lines_per_word": _share(s["n_dup_lines"], s["n_words"]),
        "repeat_share": _share(s["n_repeat_words"], s["n_words"]),
    }


def base_failed(stats: str = "stats") -> Column:
    n, repeated = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (n < 50) | (100 * repeated > 50 * n)


@dataclass(frozen=True)
class Condition:
    """``feature >= threshold``, or ``<`` where ``above`` is false; ``bin`` is the threshold's number."""

    feature: str
    bin: int
    threshold: float
    above: bool

    def on_bins(self) -> Column:
        column = F.col(f"bin.{self.feature}")
        return column > self.bin if self.above else column <= self.bin

    def on_values(self, values: dict[str, Column]) -> Column:
        column = values[self.feature]
        return column >= self.threshold if self.above else column < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


@dataclass
class DecisionList:
    """Ordered rejecting rules; what none of them matches is kept."""

    rules: list[list[Condition]] = field(default_factory=list)

    def reason(self, values: dict[str, Column]) -> Column:
        """The first matching rule as text, else null: one ordered conditional expression."""
        out = None
        for rule in self.rules:
            test, said = _all([c.on_values(values) for c in rule]), F.lit(" and ".join(map(str, rule)))
            out = F.when(test, said) if out is None else out.when(test, said)
        return F.lit(None).cast("string") if out is None else out


def _gain(p0: int, n0: int, p1: int, n1: int) -> float:
    """FOIL's information gain of going from (p0, n0) to (p1, n1) covered rows."""
    if not p1:
        return 0.0
    return p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0)))


def learn(labelled: DataFrame, values: dict[str, Column], bad: Column, bins: int = 128, max_rules: int = 8,
          max_conditions: int = 4, min_precision: float = 0.9, min_cover: int = 5) -> DecisionList:
    """A decision list that rejects rows where ``bad`` holds.

    Thresholds are the features' ``bins``-quantiles over all labelled rows.
    ``min_precision`` and ``min_cover`` hold for a rule's pruning rows and
    growing rows. Without labelled rows, or with one class only, the list has
    no rule. Rows with a null label are left out. The labelled table is
    checkpointed in binned form; each step is one pre-aggregated count over it.
    """
    names = list(values)
    rows = labelled.select(*[values[n].alias(n) for n in names], bad.alias("bad")).filter(F.col("bad").isNotNull())
    rows = rows.withColumn("grow", F.pmod(F.xxhash64(*names), F.lit(3)) > 0)
    points = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(n, points, 10_000).alias(n) for n in names]).first()
    cuts = {n: sorted({float(x) for x in (found[n] or ())}) for n in names}

    def bin_of(name: str) -> Column:
        """How many thresholds the value reaches."""
        return F.size(F.filter(F.array(*map(F.lit, cuts[name])).cast("array<double>"), lambda cut: cut <= F.col(name)))

    binned = checkpointed(rows.select("bad", "grow", F.struct(*[bin_of(n).alias(n) for n in names]).alias("bin")))

    def counts(left: DataFrame) -> dict[str, list[tuple[int, int, int]]]:
        cells = left.select("bad", F.explode(F.array(*[
            F.struct(F.lit(n).alias("feature"), F.col(f"bin.{n}").alias("at")) for n in names])).alias("cell"))
        out = {n: [] for n in names}
        for r in cells.groupBy("cell.feature", "cell.at").agg(
                F.sum(F.col("bad").cast("long")).alias("p"), F.count(F.lit(1)).alias("n")).collect():
            out[r["feature"]].append((r["at"], r["p"], r["n"] - r["p"]))
        return out

    def grow(left: DataFrame) -> list[Condition]:
        rule: list[Condition] = []
        while len(rule) < max_conditions:
            cells = counts(left)
            p0, n0 = sum(p for _, p, _ in cells[names[0]]), sum(n for _, _, n in cells[names[0]])
            if p0 < min_cover or not n0:
                break
            best, best_gain = None, 1e-9
            for name in names:
                for k, cut in enumerate(cuts[name]):
                    p1 = sum(p for at, p, _ in cells[name] if at > k)
                    n1 = sum(n for at, _, n in cells[name] if at > k)
                    for above, p, n in ((True, p1, n1), (False, p0 - p1, n0 - n1)):
                        gain = _gain(p0, n0, p, n)
                        if gain > best_gain and p >= min_cover:
                            best, best_gain = Condition(name, k, cut, above), gain
            if best is None:
                break
            rule.append(best)
            left = left.filter(best.on_bins())
        return rule

    def pruned(rule: list[Condition], left: DataFrame) -> tuple[list[Condition], float]:
        prefixes = [_all([c.on_bins() for c in rule[:k]]) for k in range(1, len(rule) + 1)]
        got = left.agg(*[F.count_if(test & F.col("bad")).alias(f"p{k}") for k, test in enumerate(prefixes)],
                       *[F.count_if(test & ~F.col("bad")).alias(f"n{k}") for k, test in enumerate(prefixes)]).first()
        worth = [((got[f"p{k}"] - got[f"n{k}"]) / max(1, got[f"p{k}"] + got[f"n{k}"]), -k) for k in range(len(rule))]
        k = -max(worth)[1]
        return rule[:k + 1], got[f"p{k}"] / max(1, got[f"p{k}"] + got[f"n{k}"])

    learned, left = DecisionList(), binned
    while len(learned.rules) < max_rules:
        rule = grow(left.filter("grow"))
        if not rule:
            break
        rule, precision = pruned(rule, left.filter(~F.col("grow")))
        if precision < min_precision:
            break
        learned.rules.append(rule)
        left = left.filter(~_all([c.on_bins() for c in rule]))
    return learned


def judge(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", column: str = "stats", **how) -> tuple[DataFrame, DecisionList]:
    """``stats`` (with the struct ``column``) with ``base_failed``, ``kept`` and ``reason``, and the list learned.

    Rows labelled ``quality`` 0 are the ones to reject; rows that already fail
    the base are not used to learn.
    """
    marks = labels.select(F.col(id_col).alias("_id"), F.col("quality").alias("_quality")).filter("_id is not null").distinct()
    known = stats.select(F.col(id_col).alias("_own"), F.col(column).alias("stats")).filter(~base_failed())
    known = known.join(marks, F.col("_own") == F.col("_id"))
    learned = learn(known, features(), F.col("_quality") == 0, **how)
    return _decided(stats, learned, column), learned


def _decided(stats: DataFrame, learned: DecisionList, column: str = "stats") -> DataFrame:
    reason = learned.reason(features(column))
    return (stats.withColumn("base_failed", base_failed(column))
            .withColumn("reason", F.when(F.col("base_failed"), F.lit("base")).otherwise(reason))
            .withColumn("kept", F.col("reason").isNull()))


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents that pass the base rules and the learned list, with their own columns.

    Two narrow passes over the texts: one gives the labelled statistics, one
    filters; texts are never shuffled. Null and empty texts fail the base;
    repeated rows are judged alike; null ids are judged but not learned from.
    """
    column, once = free_name(docs, "stats"), free_name(docs, "once")
    stats = checkpointed(with_statistics(docs.select(id_col, text), text).select(id_col, "stats"))
    _, learned = judge(stats, labels, id_col)
    passed = ~base_failed(column) & learned.reason(features(column)).isNull()
    # a filter would be pushed below the statistics and repeat them in each of its terms; a generated row isn't
    kept = F.explode(F.when(passed, F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))).alias(once)
    return with_statistics(docs, text, column).select(*docs.columns, kept).drop(once)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base statistics and verdict, by rules learned from the labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stats = checkpointed(with_statistics(docs).select("doc_id", "stats"))
    judged, _ = judge(stats, table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "stats.*", "base_failed", "kept", "reason")
