"""Exact top-k inner products by ball trees, one tree per shard, searched branch and bound.

Equal vectors are one entry with their ``k + 1`` smallest ids (ties go to the
smaller id and a query leaves out its own, so no other can be among the best
``k``). Entries go to the nearest of some pivots, hot pivots to several
shards. A shard builds a ball tree; a node's upper bound for query q is
``q.centre + |q| radius``. Nodes are visited by falling bound, and a node whose
bound is below the query's current k-th score is not. That score is shared
between shards: a query starts with the k-th score of a common sample, first
visits the ball of shards with its highest bound, and takes the k-th score
found there to the others. Of those it visits only the ones whose ball's
bound reaches that score. Within a shard the score rises leaf by leaf.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed, stored, table

EXACT = 2.0**52  # inner products below this are exact in float64
NO_FLOOR, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
#: Queries that one task gives their first k-th score.
AIMED = 512


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding", scale: int = 1024) -> DataFrame:
    """(id, v): each component x as ``floor(scale * x)``; without null or non-finite vectors and null ids.

    Rows equal in id and vector count once. A component beyond a long's range
    becomes the end of that range.
    """
    own = vectors.select(F.col(id_col).cast("long").alias("id"), F.transform(column, lambda x: x.cast("double")).alias("x"))
    finite = F.forall("x", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    own = own.filter(F.col("id").isNotNull() & F.col("x").isNotNull() & finite)
    return own.select("id", F.transform("x", lambda x: F.floor(x * scale)).alias("v"))


def products(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Inner products of the rows of integer arrays, exact: in float64 where that is, else in Python integers.

    A product beyond a long's range becomes the end of that range.
    """
    one, other = q.astype(np.float64), m.astype(np.float64)
    most = float(np.abs(one).max(initial=0)) * float(np.abs(other).max(initial=0)) * max(1, q.shape[1])
    if most < EXACT:
        return (one @ other.T).astype(np.int64)
    whole = q.astype(object) @ m.T.astype(object)
    return np.clip(whole, NO_FLOOR, MOST).astype(np.int64)


def first_floors(queries: np.ndarray, query_ids: np.ndarray, sample: np.ndarray, ids: list[np.ndarray], k: int, chunk: int = 64) -> np.ndarray:
    """Each query's k-th score among the sampled entries, its own id left out; the least long where they have fewer."""
    floors = np.full(len(queries), NO_FLOOR)
    if not len(sample):
        return floors
    entry, flat = np.repeat(np.arange(len(sample)), [len(x) for x in ids]), np.concatenate(ids)
    if len(flat) < k:
        return floors
    for start in range(0, len(queries), chunk):
        scores = products(queries[start:start + chunk], sample)[:, entry]
        scores[query_ids[start:start + chunk, None] == flat[None, :]] = NO_FLOOR
        floors[start:start + chunk] = np.partition(scores, -k, axis=1)[:, -k]
    return floors


class BallTree:
    """A binary ball tree over the rows of an integer array; leaves hold up to ``leaf`` rows."""

    def __init__(self, rows: np.ndarray, leaf: int = 256):
        self.order = np.arange(len(rows))
        self.centres, self.radii, self.spans, self.children = [], [], [], []
        self._build(rows.astype(np.float64), 0, len(rows), leaf)
        self.centres, self.radii = np.array(self.centres), np.array(self.radii)

    def _build(self, rows: np.ndarray, start: int, end: int, leaf: int) -> None:
        stack = [(start, end, None, 0)]
        while stack:
            start, end, parent, side = stack.pop()
            node = len(self.spans)
            if parent is not None:
                self.children[parent][side] = node
            own = rows[self.order[start:end]]
            centre = own.mean(axis=0)
            away = ((own - centre) ** 2).sum(axis=1)
            self.centres.append(centre)
            self.radii.append(float(np.sqrt(away.max())))
            self.spans.append((start, end))
            self.children.append([None, None])
            if end - start <= leaf:
                continue
            one = own[away.argmax()]
            from_one = ((own - one) ** 2).sum(axis=1)
            other = own[from_one.argmax()]
            lean = from_one - ((own - other) ** 2).sum(axis=1)
            half = (end - start) // 2
            self.order[start:end] = self.order[start:end][np.argpartition(lean, half)]
            stack += [(start + half, end, node, 1), (start, start + half, node, 0)]


def search(entries: np.ndarray, ids: list[np.ndarray], queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, k: int,
           leaf: int = 256) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query number, ids, scores) of up to ``k`` best for each query; scores below its floor may be left out."""
    tree = BallTree(entries, leaf)
    q = queries.astype(np.float64)
    norms = np.sqrt((q**2).sum(axis=1))
    slack = 1e-9 * (1 + norms * np.sqrt((tree.centres**2).sum(axis=1).max(initial=0)) + norms * tree.radii.max(initial=0))

    def bounds(who: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        return (q[who] * tree.centres[nodes]).sum(axis=1) + norms[who] * tree.radii[nodes] + slack[who]

    who, at = np.arange(len(q)), np.zeros(len(q), dtype=np.int64)
    bound = bounds(who, at)
    leaves: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    left = np.array([c[0] if c[0] is not None else -1 for c in tree.children])
    right = np.array([c[1] if c[1] is not None else -1 for c in tree.children])
    while len(who):  # all queries go down the tree together, level by level
        stays = bound >= floors[who]
        who, at, bound = who[stays], at[stays], bound[stays]
        done = left[at] < 0
        leaves.append((who[done], at[done], bound[done]))
        who, at = np.concatenate([who[~done]] * 2), np.concatenate([left[at[~done]], right[at[~done]]])
        bound = bounds(who, at) if len(who) else np.zeros(0)
    who, at, bound = (np.concatenate(x) for x in zip(*leaves))
    order = np.lexsort((-bound, who))
    who, at, bound = who[order], at[order], bound[order]
    first = np.searchsorted(who, np.arange(len(q) + 1))
    best_ids = [np.zeros(0, np.int64)] * len(q)
    best = [np.zeros(0, np.int64)] * len(q)
    kth = floors.copy()
    turn = 0
    active = np.flatnonzero(first[1:] > first[:-1])
    while len(active):  # each query's turn-th best leaf; queries at the same leaf share one product
        place = first[active] + turn
        active = active[bound[place] >= kth[active]]
        place = first[active] + turn
        by_leaf = np.argsort(at[place], kind="stable")
        groups = np.split(active[by_leaf], np.flatnonzero(np.diff(at[place][by_leaf])) + 1) if len(active) else []
        for group in groups:
            start, end = tree.spans[at[first[group[0]] + turn]]
            rows = tree.order[start:end]
            scores = products(queries[group], entries[rows])
            for i, own in zip(group, scores):
                fits = np.flatnonzero(own >= kth[i])
                if not len(fits):
                    continue
                if len(fits) > k + 1:  # no more entries than that can matter; ties at the edge all stay
                    edge = np.partition(own[fits], -(k + 1))[-(k + 1)]
                    fits = fits[own[fits] >= edge]
                new_ids = np.concatenate([ids[rows[j]] for j in fits])
                new = np.concatenate([np.full(len(ids[rows[j]]), own[j]) for j in fits])
                other = new_ids != query_ids[i]
                all_ids, all_scores = np.concatenate([best_ids[i], new_ids[other]]), np.concatenate([best[i], new[other]])
                top = np.lexsort((all_ids, -all_scores))[:k]
                best_ids[i], best[i] = all_ids[top], all_scores[top]
                if len(top) == k:
                    kth[i] = max(kth[i], best[i][-1])
        turn += 1
        active = active[first[active] + turn < first[active + 1]]
    for i in range(len(q)):
        if len(best[i]):
            yield i, best_ids[i], best[i]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = 16_384, block: int = 4_096,
          sample_rows: int = 2_048, seed: int = 7) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of ``vectors`` (id, v) for each of ``queries`` (id, v).

    A query leaves out rows with its own id. Vectors of another length than
    the query's are not candidates. With fewer than ``k`` candidates, all are
    returned; an empty table gives no rows. Scores beyond a long's range are
    the end of that range and tie. Shards of about ``shard_rows`` entries meet
    blocks of ``block`` queries, so a task holds one of each whatever the
    sizes; a shard is read again for each block that has queries for it. The
    driver holds ``sample_rows`` entries (pivots with their radii, and the
    common sample for the first k-th scores): a fixed bound.
    """
    spark = vectors.sparkSession
    near = Window.partitionBy("v").orderBy("id")
    distinct = vectors.distinct().withColumn("n", F.row_number().over(near)).filter(F.col("n") <= k + 1)
    entries = checkpointed(distinct.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("dim", F.size("v")))
    counts = {r["dim"]: r["n"] for r in entries.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = entries.orderBy(F.xxhash64("v", F.lit(seed))).limit(sample_rows).select("v", "ids", "dim").collect()
    sample: dict[int, tuple[np.ndarray, list]] = {}
    for dim in counts:
        own = [r for r in picked if r["dim"] == dim]
        sample[dim] = (np.array([r["v"] for r in own], dtype=np.int64).reshape(len(own), dim), [np.array(r["ids"], dtype=np.int64) for r in own])
    # pivots: as many as shards are wanted; a pivot's share of the sample tells how many shards it needs
    pivots: dict[int, np.ndarray] = {}
    splits: dict[int, np.ndarray] = {}
    base: dict[int, int] = {}
    total = 0
    for dim, n in sorted(counts.items()):
        rows = sample[dim][0]
        wanted = max(1, min(len(rows), -(-n // shard_rows)))
        pivots[dim] = rows[:wanted] if len(rows) else np.zeros((1, dim), dtype=np.int64)
        home = _nearest(rows, pivots[dim]) if len(rows) else np.zeros(0, dtype=np.int64)
        share = np.bincount(home, minlength=len(pivots[dim])) / max(1, len(rows))
        splits[dim] = np.maximum(1, np.ceil(share * n / shard_rows)).astype(np.int64)
        base[dim] = total
        total += int(splits[dim].sum())
    shared = spark.sparkContext.broadcast((pivots, splits, base, sample))
    first_ball = {dim: sum(len(pivots[d]) for d in sorted(counts) if d < dim) for dim in counts}

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pivots, splits, base, _ = shared.value
        for batch in batches:
            shard, ball, away = np.zeros(len(batch), dtype=np.int64), np.zeros(len(batch), dtype=np.int64), np.zeros(len(batch))
            for dim, rows in batch.groupby("dim").indices.items():
                v = np.array(batch["v"].iloc[rows].tolist(), dtype=np.int64).reshape(len(rows), dim)
                home = _nearest(v, pivots[dim])
                starts = base[dim] + np.concatenate([[0], np.cumsum(splits[dim])[:-1]])
                shard[rows] = starts[home] + batch["salt"].to_numpy()[rows] % splits[dim][home]
                ball[rows] = first_ball[dim] + home
                away[rows] = np.sqrt(((v.astype(np.float64) - pivots[dim].astype(np.float64)[home]) ** 2).sum(axis=1))
            yield pd.DataFrame({"shard": shard, "ball": ball, "away": away, "v": batch["v"], "ids": batch["ids"]})

    placed = entries.select("v", "ids", "dim", F.pmod(F.xxhash64("v"), F.lit(1_000_003)).alias("salt"))
    placed = stored(placed.mapInPandas(place, "shard long, ball long, away double, v array<long>, ids array<long>"))
    widest = {r["ball"]: r["away"] for r in placed.groupBy("ball").agg(F.max("away").alias("away")).collect()}
    radii = {dim: np.array([widest.get(first_ball[dim] + i, -1.0) for i in range(len(pivots[dim]))]) for dim in counts}  # -1: an empty ball
    around = spark.sparkContext.broadcast(radii)

    def aim(later: bool):
        """Queries with the shards to visit: those of the ball with the highest bound, or of the others whose bound reaches the floor."""
        def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            pivots, splits, base, sample = shared.value
            for batch in batches:
                floors = batch["floor"].to_numpy().copy() if later else np.full(len(batch), NO_FLOOR)
                shards = [[]] * len(batch)
                for dim, rows in batch.groupby("dim").indices.items():
                    if dim not in base:
                        continue
                    v = np.array(batch["v"].iloc[rows].tolist(), dtype=np.int64).reshape(len(rows), dim)
                    if not later:
                        floors[rows] = first_floors(v, batch["id"].to_numpy()[rows], *sample[dim], k)
                    bound = ball_bounds(v, pivots[dim], around.value[dim])
                    best = bound.argmax(axis=1)
                    starts = base[dim] + np.concatenate([[0], np.cumsum(splits[dim])[:-1]])
                    if later:
                        wanted = bound >= floors[rows, None]
                        wanted[np.arange(len(rows)), best] = False
                        balls = [np.flatnonzero(own) for own in wanted]
                    else:
                        balls = best[:, None]
                    for i, own in zip(rows, balls):
                        shards[i] = np.concatenate([np.arange(starts[b], starts[b] + splits[dim][b]) for b in own]) if len(own) else []
                yield pd.DataFrame({"id": batch["id"], "v": batch["v"], "dim": batch["dim"], "floor": floors, "shards": shards})
        return each

    def run(entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(entries) and len(queries):
            ids = [np.asarray(x, dtype=np.int64) for x in entries["ids"]]
            for i, found, scores in search(np.array(entries["v"].tolist(), dtype=np.int64), ids, np.array(queries["v"].tolist(), dtype=np.int64),
                                           queries["id"].to_numpy(), queries["floor"].to_numpy(), k):
                out["query_id"].append(np.full(len(found), queries["id"].iloc[i]))
                out["vec_id"].append(found)
                out["score"].append(scores)
        return pd.DataFrame({c: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for c, x in out.items()})

    asked = queries.distinct().withColumn("dim", F.size("v"))
    n_queries = asked.count()
    blocks, tasks = max(1, -(-n_queries // block)), max(1, -(-n_queries // AIMED))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")

    def visit(aimed: DataFrame) -> DataFrame:
        """The best of the aimed queries' shards; entries go only to blocks that ask for their shard."""
        aimed = aimed.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int")).withColumn("shard", F.explode("shards")).drop("shards")
        wanted = aimed.select(F.col("shard").alias("to"), F.col("block").alias("part")).distinct()
        sought = placed.join(wanted, F.col("shard") == F.col("to")).select("to", "part", "v", "ids")
        return sought.groupBy("to", "part").cogroup(aimed.groupBy("shard", "block")).applyInPandas(run, "query_id long, vec_id long, score long")

    def best_of(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    aimed_as = "id long, v array<long>, dim int, floor long, shards array<long>"
    first = stored(asked.repartition(tasks, "id", "v").mapInPandas(aim(False), aimed_as))
    if all(len(p) == 1 for p in pivots.values()):  # no vectors of a length have a second ball
        return best_of(visit(first))
    best = stored(best_of(visit(first)))
    risen = best.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("kth"))
    again = first.join(risen, "id", "left").withColumn("floor", F.greatest("floor", F.coalesce("kth", "floor"))).select("id", "v", "dim", "floor")
    others = stored(again.repartition(tasks, "id", "v").mapInPandas(aim(True), aimed_as).filter(F.size("shards") > 0))
    return best_of(best.drop("rank").unionByName(visit(others)))


def ball_bounds(queries: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """Upper bounds of each query's inner product with what lies in each ball, a little wider for rounding; an empty ball has none."""
    q, c = queries.astype(np.float64), centres.astype(np.float64)
    norms, far = np.sqrt((q**2).sum(axis=1))[:, None], np.sqrt((c**2).sum(axis=1))[None, :]
    bound = q @ c.T + norms * radii[None, :] + 1e-9 * (1 + norms * (far + radii[None, :]))
    return np.where(radii[None, :] < 0, -np.inf, bound)


def _nearest(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    a, b = rows.astype(np.float64), pivots.astype(np.float64)
    return ((b**2).sum(axis=1) - 2 * a @ b.T).argmin(axis=1)


def op10_ball_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best vectors for each vector whose id is divisible by 100."""
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.filter(F.col("id") % 100 == 0))


OP10_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, [floor(1024 * x::DOUBLE) for x in embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
QUALIFY rank <= 10
"""
