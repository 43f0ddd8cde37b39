"""SimHash near-duplicates, found exactly with vantage-point trees.

Fingerprints within ``bits`` differing bits agree up to ``bits // 2`` bits in
one half of their 64 bits. For each half, a vantage-point tree built on a
bounded sample cuts the space into shards: a node has a pivot and a radius,
and a fingerprint goes inside or outside by its Hamming distance to the pivot,
counted on that half. That gives each fingerprint one home shard per tree.
By the triangle inequality a partner on the other side of a node lies within
the search radius of the boundary, so a fingerprint is also sent as a visitor
to shards across boundaries which it is that close to. A shard compares its
homes with each other and with its visitors, splitting further by the same
rule until the rest is small, and checks the full distance; so all pairs
within ``bits`` are found, and none else. Equal fingerprints are one entry
before this, and a shard reports a spanning forest of its links instead of
all pairs. Connected components give the groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import checkpointed, free_name, table
from tessera.llm.components import components

FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
HALVES = (np.uint64(0x00000000FFFFFFFF), np.uint64(0xFFFFFFFF00000000))


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a text, unsigned: a bit is set if over half the shingles' hashes have it."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z only, and exactly the six white-space bytes
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    ends = ends[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 65_536):
        hashes = np.array([digest(joined[s:e], seed) for s, e in zip(starts[at:at + 65_536], ends[at:at + 65_536])], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3, column: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint of each row's whole text as a (signed) long; null is like empty."""
    kept = docs.drop(column)
    at = kept.columns.index(text)
    names = [*kept.columns, column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(x.as_py(), shingle) for x in batch.column(at)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made)], names=names)

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(column, T.LongType())]))


@dataclass
class Node:
    """An inner node (pivot, mask, reach, radius, inside, outside) or, with a ``shard``, a leaf."""

    shard: int = -1
    pivot: np.uint64 = np.uint64(0)
    mask: np.uint64 = FULL
    reach: int = 0
    radius: int = 0
    inside: int = -1
    outside: int = -1


def _cut(points: np.ndarray, mask: np.uint64, reach: int, rng: np.random.Generator, tries: int = 6) -> tuple[np.uint64, int] | None:
    """The pivot and radius that send the fewest points across, none of the sides under a fifth; None if none."""
    best = None
    for pivot in rng.choice(points, size=min(tries, len(points)), replace=False):
        inside = np.cumsum(np.bincount(np.bitwise_count((points ^ pivot) & mask), minlength=65)) / len(points)
        for radius in range(64):
            if 0.2 <= inside[radius] <= 0.8:
                across = inside[radius] - (inside[radius - reach] if radius >= reach else 0.0)
                cost = across + abs(inside[radius] - 0.5) / 2
                if best is None or cost < best[0]:
                    best = cost, pivot, radius
    return best and best[1:]


def build_tree(sample: np.ndarray, mask: np.uint64, bits: int, scale: float, shard_rows: int, first_shard: int) -> list[Node]:
    """Nodes of a tree whose shards expect up to ``shard_rows`` of the fingerprints ``sample`` stands for.

    Where a half tells points no longer apart, the full 64 bits (and the full
    reach) do: links found either way are the same links.
    """
    rng = np.random.default_rng(7)
    nodes = [Node()]
    todo, shards = [(0, sample)], first_shard
    while todo:
        at, points = todo.pop()
        made = None
        if len(points) >= 16 and len(points) * scale > shard_rows:
            for own, reach in ((mask, bits // 2), (FULL, bits)):
                if (made := _cut(points, own, reach, rng)) is not None:
                    break
        if made is None:
            nodes[at].shard = shards
            shards += 1
            continue
        pivot, radius = made
        near = np.bitwise_count((points ^ pivot) & own) <= radius
        nodes[at] = Node(-1, pivot, own, reach, radius, len(nodes), len(nodes) + 1)
        nodes += [Node(), Node()]
        todo += [(nodes[at].inside, points[near]), (nodes[at].outside, points[~near])]
    return nodes


def route(nodes: list[Node], points: np.ndarray) -> Iterator[tuple[int, np.ndarray, bool]]:
    """(shard, positions, home): each point's home shard and, across near boundaries, the shards it visits."""
    none = np.zeros(0, dtype=np.int64)
    todo = [(0, np.arange(len(points)), none)]
    while todo:
        at, homes, visits = todo.pop()
        node = nodes[at]
        if node.shard >= 0:
            if len(homes):
                yield node.shard, homes, True
            if len(visits):
                yield node.shard, visits, False
            continue
        far = np.bitwise_count((points[homes] ^ node.pivot) & node.mask).astype(np.int64)
        near = far <= node.radius
        # of a pair that this node parts, the point inside visits the one outside
        crossing = homes[near & (far + node.reach > node.radius)]
        away = np.bitwise_count((points[visits] ^ node.pivot) & node.mask).astype(np.int64)
        todo.append((node.inside, homes[near], visits[away - node.reach <= node.radius]))
        todo.append((node.outside, homes[~near], np.concatenate([visits[away + node.reach > node.radius], crossing])))


class Forest:
    """Union-find over positions, fed with whole blocks of comparisons."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def block(self, near: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> None:
        """Joins row i and column j wherever ``near[i, j]``.

        Where most are near each other, the block's own components are found
        first, so the joins are as many as the points and not as the pairs.
        """
        i, j = np.nonzero(near)
        if len(i) > 8 * (len(rows) + len(columns)):
            none = len(rows)
            of_row, of_column = np.arange(none), None
            while True:
                of_column = np.where(near, of_row[:, None], none).min(axis=0)
                lower = np.minimum(of_row, np.where(near, of_column[None, :], none).min(axis=1))
                if (lower == of_row).all():
                    break
                of_row = lower
            i, j = of_column[of_column < none], np.flatnonzero(of_column < none)
            for x, y in zip(rows.tolist(), rows[of_row].tolist()):
                self.join(x, y)
        for x, y in zip(rows[i].tolist(), columns[j].tolist()):
            self.join(x, y)


def _parted(points: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool, mask: np.uint64, reach: int,
            pivot: np.uint64, radius: int) -> list[tuple[np.ndarray, np.ndarray, bool]]:
    """The comparisons of ``left`` with ``right`` that the triangle bound leaves on either side of a ball."""
    a = np.bitwise_count((points[left] ^ pivot) & mask).astype(np.int64)
    if same:
        inside = a <= radius
        return [(left[inside], left[inside], True), (left[~inside], left[~inside], True),
                (left[inside & (a + reach > radius)], left[~inside & (a - reach <= radius)], False)]
    b = np.bitwise_count((points[right] ^ pivot) & mask).astype(np.int64)
    return [(left[a <= radius], right[b - reach <= radius], False), (left[a > radius], right[b + reach > radius], False)]


def link_shard(points: np.ndarray, home: np.ndarray, half: np.uint64, bits: int, leaf: int = 1_024) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of links within ``bits`` between homes, and between homes and visitors.

    All links that are within ``bits // 2`` on ``half`` are in it; the other
    half's tree has the rest.
    """
    forest, rng = Forest(len(points)), np.random.default_rng(7)
    homes, visits = np.flatnonzero(home), np.flatnonzero(~home)
    todo = [(homes, homes, True), (homes, visits, False)]
    while todo:
        left, right, same = todo.pop()
        if not len(left) or not len(right):
            continue
        parts = None
        if len(left) * len(right) > leaf * leaf:
            larger = left if len(left) >= len(right) else right
            some = points[rng.choice(larger, size=min(2_048, len(larger)), replace=False)]
            for mask, reach in ((half, bits // 2), (FULL, bits)):
                if (made := _cut(some, mask, reach, rng, 12)) is not None:
                    parts = _parted(points, left, right, same, mask, reach, *made)
                    if sum(len(x) * len(y) for x, y, _ in parts) <= 0.8 * len(left) * len(right):
                        break
                    parts = None  # too much crosses: not worth a cut
        if parts is None:
            for at in range(0, len(left), leaf):
                rows = left[at:at + leaf]
                for other in range(at if same else 0, len(right), leaf):
                    columns = right[other:other + leaf]
                    near = np.bitwise_count(points[rows][:, None] ^ points[columns][None, :]) <= bits
                    if same and at == other:
                        np.fill_diagonal(near, False)
                    if near.any():
                        forest.block(near, rows, columns)
            continue
        todo += parts
    roots = np.array([forest.find(i) for i in range(len(points))], dtype=np.int64)
    hung = np.flatnonzero(roots != np.arange(len(points)))
    return points[hung], points[roots[hung]]


def links(distinct: DataFrame, bits: int = 3, shard_rows: int = 4_096, sample_rows: int = 65_536) -> DataFrame:
    """(a, b): links that connect all of ``distinct`` (fp, unique) that are within ``bits`` of each other.

    The trees are built on the driver from a random sample of at most
    ``sample_rows`` fingerprints, a fixed bound; every fingerprint is routed.
    A shard's expected size is ``shard_rows`` as long as the sample can tell
    that many shards apart, and grows only beyond that.
    """
    spark = distinct.sparkSession
    n = distinct.count()
    part = min(1.0, sample_rows / max(1, n))
    picked = distinct.select("fp").sample(part, seed=7) if part < 1 else distinct.select("fp")
    sample = np.array([r["fp"] for r in picked.limit(sample_rows).collect()], dtype=np.int64).view(np.uint64)
    scale = n / max(1, len(sample))
    first = build_tree(sample, HALVES[0], bits, scale, shard_rows, 0)
    second = build_tree(sample, HALVES[1], bits, scale, shard_rows, sum(x.shard >= 0 for x in first))
    second_from = sum(x.shard >= 0 for x in first)
    trees = spark.sparkContext.broadcast((first, second))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for nodes in trees.value:
                for shard, at, home in route(nodes, points):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), shard, np.int32)), pa.array(points[at].view(np.int64)), pa.array(np.full(len(at), home))],
                        names=["shard", "fp", "home"])

    def join(shard: pd.DataFrame) -> pd.DataFrame:
        half = HALVES[int(shard["shard"].iloc[0] >= second_from)]
        a, b = link_shard(shard["fp"].to_numpy().astype(np.int64).view(np.uint64), shard["home"].to_numpy().astype(bool), half, bits)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = distinct.select("fp").mapInArrow(deal, "shard int, fp long, home boolean")
    return dealt.groupBy("shard").applyInPandas(join, "a long, b long")


def classes(prints: DataFrame, bits: int = 3, id_col: str = "doc_id", **how) -> DataFrame:
    """Per distinct fingerprint of ``prints`` (id, fp): ``root``, the group's key, ``keep_fp`` and ``component_id``.

    ``component_id`` is the smallest id in the group (null only if all are),
    and (``component_id``, ``keep_fp``) is the row that stands for it.
    """
    distinct = checkpointed(prints.groupBy("fp").agg(F.min(id_col).alias("least")))
    roots = components(links(distinct, bits, **how))
    keyed = checkpointed(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    first = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "fp")).alias("first")
    chosen = keyed.groupBy("root").agg(first)
    return checkpointed(keyed.join(chosen, "root").select("fp", "root", F.col("first.fp").alias("keep_fp"), F.col("first.least").alias("component_id")))


def near_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = 3, bits: int = 3, **how) -> DataFrame:
    """(id, fp, component_id), one row per row of ``docs``: groups of fingerprints linked within ``bits``.

    ``component_id`` is the smallest id reachable over links, the row's own
    included. Null and empty texts have fingerprint zero and are linked like
    any other. Repeated rows are in the same group; null ids belong to groups
    but don't name them. An empty table gives an empty table.
    """
    prints = checkpointed(fingerprints(docs.select(id_col, text), text, shingle).select(id_col, "fp"))
    return prints.join(classes(prints, bits, id_col, **how).select("fp", "component_id"), "fp").select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = 3, bits: int = 3, **how) -> DataFrame:
    """One document of each group: the one with the smallest id, with its own columns.

    Texts are shuffled once, by id. Of repeated rows, one stays; of a group
    without any id, one stays.
    """
    fp, key, want = (free_name(docs, n) for n in ("_fp", "_key", "_want"))

    def name(column: str):  # ids as text, so that null equals null in the join
        return F.coalesce(F.col(column).cast("string"), F.lit("null"))

    prints = checkpointed(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")), "text", shingle).select("id", "fp"))
    kept = classes(prints, bits, "id", **how).filter(F.col("fp") == F.col("keep_fp"))
    kept = kept.select(name("component_id").alias(key), F.col("keep_fp").alias(want))
    own = docs.withColumn(key, name(id_col)).join(kept, key)
    same = fingerprints(own, text, shingle, fp).filter(F.col(fp) == F.col(want))
    return same.dropDuplicates([key, want]).select(*docs.columns)


def as_hex(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def op4_simhash_vp_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and near-duplicate group: 3-word shingles, 3 bits."""
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", as_hex().alias("fingerprint"), "component_id")
