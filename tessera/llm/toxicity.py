"""Toxicity grades by cumulative-link (proportional-odds) ordinal regression.

P(grade > k) = sigmoid(w.x - theta_k): one weight vector for all thresholds,
which are kept in order. Features are sparse: for each word of the whole text
the word itself and its first four and five letters, as log(1 + count), of
which training keeps those whose presence differs significantly between toxic
and other rows. The expected severity is the sum over k of P(grade > k).

Training reads a bounded sample of labelled rows (``max_rows``); counts for
the features are gathered in the tasks, and the driver fits on the sample's
sparse rows. Scoring is one narrow pass over all texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import checkpointed, table

LETTERS = re.compile(r"[^\W\d_]+")
GRADES = 4
#: Labelled rows that training reads at most.
MAX_ROWS = 20_000
#: The least log-likelihood ratio of a feature; their number is bounded by what ``MAX_ROWS`` documents hold.
LEAST_G2 = 20.0


def features_of(word: str) -> tuple[str, ...]:
    return (word, word[:4] + "*", word[:5] + "*") if len(word) > 5 else (word, word[:4] + "*") if len(word) > 4 else (word,)


def word_counts(text: str | None) -> Counter:
    return Counter(LETTERS.findall((text or "").lower()))


@dataclass
class Model:
    """Selected features, their shared weights, and the ordered thresholds."""

    features: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        """(rows, thresholds): P(grade > k)."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -50, 50)))


class Scorer:
    """A model with a bounded memory of which features a word has."""

    def __init__(self, features: dict[str, int], most: int = 500_000):
        self.features, self.known, self.most = features, {}, most

    def sparse(self, text: str | None) -> tuple[list[int], list[float]]:
        """Feature numbers and log(1 + count) each."""
        counts, found = word_counts(text), Counter()
        for word, n in counts.items():
            own = self.known.get(word)
            if own is None:
                own = tuple(self.features[f] for f in features_of(word) if f in self.features)
                if len(self.known) >= self.most:
                    self.known.clear()
                self.known[word] = own
            for f in own:
                found[f] += n
        return list(found), np.log1p(list(found.values())).tolist()


def fit(rows: list[tuple[list[int], list[float]]], grades: np.ndarray, n_features: int, n_grades: int,
        ridge: float = 1e-5, steps: int = 600, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by maximum likelihood with a ridge penalty (full-batch Adam).

    Thresholds are the first one plus positive steps, so their order holds.
    """
    row = np.repeat(np.arange(len(rows)), [len(c) for c, _ in rows])
    column = np.array([c for own, _ in rows for c in own], dtype=np.int64)
    value = np.array([v for _, own in rows for v in own])
    k = n_grades - 1
    params = np.zeros(n_features + k)
    shares = np.array([(grades > j).mean() for j in range(k)]).clip(1e-4, 1 - 1e-4)
    cuts = np.log((1 - shares) / shares)
    params[n_features] = cuts[0]
    params[n_features + 1:] = np.log(np.maximum(1e-2, np.diff(cuts)))
    m, v = np.zeros_like(params), np.zeros_like(params)

    def thresholds(p: np.ndarray) -> np.ndarray:
        return p[n_features] + np.concatenate([[0.0], np.cumsum(np.exp(p[n_features + 1:]))])

    for step in range(1, steps + 1):
        theta = thresholds(params)
        score = np.bincount(row, weights=value * params[column], minlength=len(rows))
        above = 1 / (1 + np.exp(np.clip(theta[None, :] - score[:, None], -30, 30)))  # P(grade > j)
        edges = np.concatenate([np.ones((len(rows), 1)), above, np.zeros((len(rows), 1))], axis=1)
        own = np.maximum(edges[np.arange(len(rows)), grades] - edges[np.arange(len(rows)), grades + 1], 1e-12)
        slope = above * (1 - above)
        padded = np.concatenate([np.zeros((len(rows), 1)), slope, np.zeros((len(rows), 1))], axis=1)
        lower, upper = padded[np.arange(len(rows)), grades], padded[np.arange(len(rows)), grades + 1]
        by_score = (lower - upper) / own / len(rows)
        by_theta = np.zeros((len(rows), k + 2))
        by_theta[np.arange(len(rows)), grades] -= lower / own / len(rows)
        by_theta[np.arange(len(rows)), grades + 1] += upper / own / len(rows)
        d_theta = by_theta.sum(axis=0)[1:-1]
        gradient = np.concatenate([
            np.bincount(column, weights=value * by_score[row], minlength=n_features) - ridge * params[:n_features],
            [d_theta.sum()], np.exp(params[n_features + 1:]) * np.cumsum(d_theta[::-1])[::-1][1:],
        ])
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        params = params + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return params[:n_features], thresholds(params)


def _without_redundant(found: dict[str, float]) -> list[str]:
    """Features that say more than the shorter beginning they share; unseen forms of a word then keep its full weight."""
    def beginnings(feature: str) -> list[str]:
        stem = feature.rstrip("*")
        return [b for b in (stem[:4] + "*", stem[:5] + "*") if b != feature and len(b) <= len(stem) + 1]

    return [f for f, g2 in found.items() if all(found.get(b, -1.0) < g2 for b in beginnings(f))]


def _g2(t: np.ndarray, n1: float, c: np.ndarray, n0: float) -> np.ndarray:
    """Log-likelihood ratio of presence in ``t`` of ``n1`` against ``c`` of ``n0`` rows."""
    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12)), 0.0)

    rate = (t + c) / max(n1 + n0, 1e-12)
    return 2 * (part(t, n1 * rate) + part(c, n0 * rate) + part(n1 - t, n1 * (1 - rate)) + part(n0 - c, n0 * (1 - rate)))


def select(rows: list[list[int]], toxic: np.ndarray, n_features: int, least: float = LEAST_G2) -> list[int]:
    """Features by significance, each judged on what the ones before it leave unexplained.

    A toxic row's weight is halved for each chosen feature it has, so words
    that merely come along in copies of a toxic text soon have no weight.
    """
    holders: list[list[int]] = [[] for _ in range(n_features)]
    for i, own in enumerate(rows):
        for f in own:
            holders[f].append(i)
    held = [np.array(h, dtype=np.int64) for h in holders]
    clean = np.array([(~toxic[h]).sum() for h in held], dtype=float)
    weight, n0, chosen = toxic.astype(float), float((~toxic).sum()), []
    seen = np.array([weight[h].sum() for h in held])
    while len(chosen) < n_features:
        n1 = weight.sum()
        worth = np.where(seen * n0 > clean * n1, _g2(seen, n1, clean, n0), 0.0)
        worth[chosen] = 0.0
        best = int(worth.argmax())
        if worth[best] < least:
            break
        chosen.append(best)
        mine = held[best][toxic[held[best]]]
        for i in mine.tolist():
            for f in rows[i]:
                seen[f] -= weight[i] / 2
        weight[mine] /= 2
    return chosen


def train(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", max_rows: int = MAX_ROWS) -> Model:
    """A model from labelled ``docs``; ``labels`` has the id and ``toxic`` (0/1), and ``grade`` if rows are graded.

    Without a ``grade`` column, grade 0 is a row that isn't toxic, and toxic
    rows get 1 to 3 by thirds of how much of the chosen features they hold. The sample is drawn by a hash of the id; its ids (at most
    ``max_rows``) are broadcast, so only the sample's texts are shuffled. Of an
    id's repeated rows the text with the least hash is taken. Null labels and
    ids are left out. Without both classes the model says 0 for all.
    """
    spark = docs.sparkSession
    graded = "grade" in labels.columns
    known = labels.filter(F.col(id_col).isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max("toxic").alias("_toxic"), *([F.max("grade").alias("_grade")] if graded else []))
    known = checkpointed(known.orderBy(F.xxhash64("_id"), "_id").limit(max_rows))
    sampled = docs.select(id_col, F.col(text).alias("_text")).join(F.broadcast(known), F.col(id_col) == F.col("_id"))
    own = sampled.select("_id", "_text", F.col("_toxic").cast("int").alias("_toxic"), (F.col("_grade") if graded else F.lit(-1)).cast("int").alias("_grade"))
    # an id that repeats over many rows is one row a task, then one in all: the bound holds for rows too
    own = own.groupBy("_id").agg(F.min(F.struct(F.xxhash64("_text"), "_text")).getField("_text").alias("_text"), F.first("_toxic").alias("_toxic"), F.first("_grade").alias("_grade"))
    own = checkpointed(own.drop("_id"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_, without, rows = Counter(), Counter(), [0, 0]
        for batch in batches:
            for value, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                rows[1 if toxic else 0] += 1
                (with_ if toxic else without).update({f for w in word_counts(value.as_py()) for f in features_of(w)})
        names = sorted(with_.keys() | without.keys())  # all of them: a rare one of this task may be common in the others
        yield pa.RecordBatch.from_arrays([pa.array(["", *names], pa.string()), pa.array([rows[1], *[with_[n] for n in names]], pa.int64()),
                                          pa.array([rows[0], *[without[n] for n in names]], pa.int64())], names=["feature", "t", "c"])

    counted = own.mapInArrow(count, "feature string, t long, c long").groupBy("feature").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    counted = checkpointed(counted.filter((F.col("feature") == "") | (F.col("t") >= 3)))
    totals = counted.filter(F.col("feature") == "").first()
    nothing = Model({}, np.zeros(0), np.full(GRADES - 1, 50.0))
    if totals is None or not totals["t"] or not totals["c"]:
        return nothing
    n1, n0 = float(totals["t"]), float(totals["c"])
    rate = (F.col("t") + F.col("c")) / F.lit(n1 + n0)

    def part(seen, whole, share):
        return F.when(seen > 0, seen * F.log(seen / (whole * share))).otherwise(0.0)

    g2 = 2 * (part(F.col("t"), n1, rate) + part(F.col("c"), n0, rate) + part(n1 - F.col("t"), n1, 1 - rate) + part(n0 - F.col("c"), n0, 1 - rate))
    chosen = counted.filter((F.col("feature") != "") & (F.col("t") * n0 > F.col("c") * n1)).withColumn("g2", g2)
    chosen = chosen.filter(F.col("g2") >= LEAST_G2)
    features = {f: i for i, f in enumerate(_without_redundant({r["feature"]: r["g2"] for r in chosen.select("feature", "g2").collect()}))}
    if not features:
        return nothing
    shared = spark.sparkContext.broadcast(features)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            made = [scorer.sparse(x.as_py()) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([
                batch.column(1), batch.column(2), pa.array([m[0] for m in made], pa.list_(pa.int32())),
                pa.array([m[1] for m in made], pa.list_(pa.float64()))],
                names=["toxic", "grade", "at", "value"])

    rows = own.mapInArrow(vectors, "toxic int, grade int, at array<int>, value array<double>").orderBy("toxic", "grade", "at", "value").collect()
    toxic = np.array([bool(r["toxic"]) for r in rows])
    place = {f: i for i, f in enumerate(select([r["at"] for r in rows], toxic, len(features)))}
    if not place:
        return nothing
    names = list(features)
    kept = [[(place[f], v) for f, v in zip(r["at"], r["value"]) if f in place] for r in rows]
    if graded:
        grades = np.array([r["grade"] or 0 for r in rows], dtype=np.int64)
    else:
        amount = np.array([sum(v for _, v in own) for own in kept])
        grades = np.where(toxic, 1 + np.searchsorted(np.quantile(amount[toxic], [1 / 3, 2 / 3]), amount, side="right"), 0)
    n_grades = max(2, int(grades.max()) + 1)
    weights, thresholds = fit([([c for c, _ in own], [v for _, v in own]) for own in kept], grades, len(place), n_grades)
    return Model({names[f]: i for f, i in place.items()}, weights, thresholds)


SCORES = T.StructType([
    T.StructField("expected_severity", T.DoubleType()), T.StructField("grade", T.IntegerType()),
    T.StructField("p_toxic", T.DoubleType()), T.StructField("toxic", T.BooleanType()),
])


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with expected severity, the median grade, P(grade > 0) and ``toxic`` (that over 1/2).

    Columns of these names are replaced. Null and empty texts have no
    features. Repeated rows are scored alike.
    """
    kept = docs.drop(*SCORES.names)
    at, names = kept.columns.index(text), [*kept.columns, *SCORES.names]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        scorer = Scorer(own.features)
        for batch in batches:
            made = [scorer.sparse(x.as_py()) for x in batch.column(at)]
            scores = np.array([float(np.dot(own.weights[c], v)) if c else 0.0 for c, v in made])
            p = own.probabilities(scores)
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array(p.sum(axis=1)), pa.array((p > 0.5).sum(axis=1).astype(np.int32)), pa.array(p[:, 0]), pa.array(p[:, 0] > 0.5)], names=names)

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *SCORES.fields]))


def op7_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's expected severity, grade and whether it is toxic."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", *SCORES.names)
