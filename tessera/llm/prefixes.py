"""The trie of conversation prefixes, by collapsing whole sequences.

Identical conversations become one weighted sequence with the list of those
that end there. Sequences that are proper prefixes of others drop out by an
anti-join; what stays are the leaves. The prefixes of the weighted sequences,
one row each, are then aggregated into nodes.

A prefix is known by its depth and two sums of 60-bit hashes of (place, turn)
over its turns. Sums need no order, so a conversation of any length is split
over tasks: its turns are dealt by range into blocks, and a block's prefixes
start from the sums of the blocks before. Texts are hashed where they are read
and never shuffled.

Sums over a node's subtree use that each node has one *owner*, the sequence
with its smallest conversation. Along a sequence the owned nodes are those from
some depth on, so one number per sequence says which nodes it has to count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored, table

#: The key of the prefix without turns.
ROOT = "0:0:0"
#: Turns that a rebuilt conversation may share with its base: crc32 % 9.
SHARED = 9


def numbered(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns as ``c``, ``i`` (their place from 1), ``block``, ``digest`` and ``bytes`` (of the text in UTF-8).

    Turns are ordered by ``turn``, nulls first, equal ones by the digest of
    role and text; null roles and texts are empty, repeated rows are turns of
    their own. Rows without a conversation id belong to none and are left out.
    Blocks are ranges of that order, cut anywhere, also within a conversation.
    """
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role).cast("string"), F.lit(""))
    rows = conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("c"), F.col(turn).alias("turn"),
        F.sha2(F.concat(F.length(by).cast("string"), F.lit(":"), by, said), 256).alias("digest"), F.octet_length(said).cast("long").alias("bytes"))
    # the running number only parts equal rows, whose order doesn't matter
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    order = [F.asc_nulls_first("turn"), F.asc("digest"), F.asc("tie")]
    rows = stored(rows.repartitionByRange(F.asc("c"), *order).withColumn("block", F.spark_partition_id()))
    sizes = rows.groupBy("c", "block").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("c", "block", (F.sum("n").over(Window.partitionBy("c").orderBy("block")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("c", "block").orderBy(*order)) + F.col("before")
    return rows.join(before, ["c", "block"]).select("c", place.cast("long").alias("i"), "block", "digest", "bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: their turns (``c``, ``d``, ``block``, ``digest``, ``bytes``) and the ids of all of them.

    Conversation c starts with the first h turns of conversation c - c % 5,
    with h = crc32(decimal c) % 9 (fewer, or none, where that has fewer or
    isn't there), and goes on with its own turns after its first h.
    """
    turns = stored(turns)
    sizes = turns.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    plan = sizes.select("c", (F.col("c") - F.col("c") % 5).alias("base"), (F.crc32(F.col("c").cast("string").cast("binary")) % SHARED).alias("h"))
    have = sizes.select(F.col("c").alias("base"), F.col("n").alias("has"))
    plan = stored(plan.join(have, "base", "left").select("c", "base", "h", F.least("h", F.coalesce("has", F.lit(0).cast("long"))).alias("taken")))
    own = turns.join(plan, "c").filter("i > h").select("c", (F.col("i") - F.col("h") + F.col("taken")).alias("d"), (F.col("block") + 1).alias("block"), "digest", "bytes")
    starts = turns.filter(F.col("i") < SHARED).select(F.col("c").alias("base"), F.col("i").alias("d"), "digest", "bytes")
    head = plan.join(starts, "base").filter("d <= h").select("c", "d", F.lit(0).alias("block"), "digest", "bytes")
    return own.unionByName(head), plan.select("c")


def _key(depth: Column, a: Column, b: Column) -> Column:
    return F.concat_ws(":", depth.cast("string"), a.cast("string"), b.cast("string"))


def ends(whole: DataFrame, chunk: int = 4096) -> DataFrame:
    """Per ``key`` of ``whole`` (key, c): ``ends_sha256`` of its ids, ascending, comma-joined.

    Ids are dealt by range of (key, id), so the list of one key is joined by
    many tasks, in chunks; only the chunks of a key meet in one task, which
    hashes them one after another and holds one batch.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, out = None, [], []

        def rows() -> pa.RecordBatch:
            keys, firsts, texts = zip(*out)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(firsts, pa.int64()), pa.array(texts, pa.string())], names=["key", "first", "ids"])

        for batch in batches:
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (k != key or len(ids) == chunk):
                    out.append((key, ids[0], ",".join(map(str, ids))))
                    ids = []
                key = k
                ids.append(c)
            if out:
                yield rows()
        if ids:
            out.append((key, ids[0], ",".join(map(str, ids))))
            yield rows()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if k != key:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*done)], names=["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])

    chunks = whole.select("key", "c").repartitionByRange("key", "c").sortWithinPartitions("key", "c").mapInArrow(joined, "key string, first bigint, ids string")
    return chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(hashed, "key string, ends_sha256 string")


NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"


def trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The nodes of the trie of the conversations ``members`` (``c``, each once) with ``turns`` (``c``, ``d`` from 1, ``block``, ``digest``, ``bytes``).

    Per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves`` and ``saved_tokens`` of its subtree,
    and ``ends_sha256`` of the members that end there. Members without turns
    end at the root. Without members there is no node.
    """
    spark = turns.sparkSession
    mixed = F.sha2(F.concat_ws(":", F.col("d").cast("string"), "digest"), 256)
    halves = [F.conv(F.substring(mixed, at, 15), 16, 10).cast("decimal(19,0)").alias(n) for at, n in ((1, "a"), (16, "b"))]
    turns = stored(turns.select("c", "d", "block", "bytes", *halves))

    # whole sequences, collapsed: one row per distinct one, with its weight and its smallest conversation
    blocks = stored(turns.groupBy("c", "block").agg(F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(x) for x in ("a", "b", "bytes")]))
    sums = blocks.groupBy("c").agg(*[F.sum(x).alias(x) for x in ("n", "a", "b", "bytes")])
    whole = members.join(sums, "c", "left").select(
        "c", F.coalesce("n", F.lit(0).cast("long")).alias("n"), F.coalesce("bytes", F.lit(0).cast("long")).alias("total"),
        F.when(F.col("n").isNull(), ROOT).otherwise(_key(F.col("n"), F.col("a"), F.col("b"))).alias("key"))
    whole = stored(whole)
    weighted = stored(whole.groupBy("key", "n", "total").agg(F.count(F.lit(1)).alias("w"), F.min("c").alias("s")))
    listed = stored(ends(whole))

    # the prefixes of the collapsed sequences, from the sums of the blocks before and those within a block
    ahead = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    start = blocks.select("c", "block", *[F.coalesce(F.sum(x).over(ahead), F.lit(0)).alias(f"{x}0") for x in ("a", "b", "bytes")])
    inside = Window.partitionBy("c", "block").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    upto = {x: F.sum(x).over(inside) + F.col(f"{x}0") for x in ("a", "b", "bytes")}
    prefix = turns.join(start, ["c", "block"]).select(
        "c", "d", "bytes", _key(F.col("d"), upto["a"], upto["b"]).alias("key"),
        _key(F.col("d") - 1, upto["a"] - F.col("a"), upto["b"] - F.col("b")).alias("parent"), (upto["bytes"] - F.col("bytes")).alias("before"))
    prefix = stored(prefix.join(weighted.select(F.col("s").alias("c"), "n", "total", "w"), "c").withColumnRenamed("c", "s"))

    nodes = stored(prefix.groupBy("key", "parent", "d", "bytes", "before").agg(
        F.min("s").alias("conv"), F.sum("w").alias("n_convs"), F.sum(F.col("w") * (F.col("total") - F.col("before"))).alias("said")))
    owned = nodes.groupBy("conv").agg(F.min("d").alias("own_from"), F.min("before").alias("own_before"))
    # a sequence that is no proper prefix of another is a leaf
    inner = prefix.filter("d < n").select("key").distinct()
    leaves = stored(weighted.filter("n > 0").join(inner, "key", "left_anti").select("s", F.lit(1).cast("long").alias("leaf")))
    counted = weighted.select("s").join(owned.withColumnRenamed("conv", "s"), "s", "left").join(leaves, "s", "left")
    # bytes of a subtree's nodes, each once: those that the sequences through here own
    below = prefix.join(counted, "s").groupBy("key").agg(
        F.count_if((F.col("d") < F.col("n")) & (F.col("d") + 1 >= F.col("own_from"))).alias("n_children"),
        F.sum(F.coalesce("leaf", F.lit(0).cast("long"))).alias("n_leaves"),
        F.sum(F.when(F.col("own_from").isNotNull(), F.col("total") - F.greatest("before", "own_before")).otherwise(0)).alias("once"))

    top = weighted.agg(F.min("s").alias("conv"), F.coalesce(F.sum("w"), F.lit(0)).alias("n")).first()
    if top["conv"] is None:
        return spark.createDataFrame([], NODE)
    under = nodes.agg(F.count_if(F.col("d") == 1).alias("children"), F.coalesce(F.sum((F.col("n_convs") - 1) * F.col("bytes")), F.lit(0)).alias("saved")).first()
    root = spark.createDataFrame([(ROOT, top["conv"], 0, None, top["n"], under["children"], leaves.count() if under["children"] else 1, under["saved"])],
                                 "key string, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint")
    # below its first owned node a sequence's parents are its own; that first node's parent belongs to another
    firsts = nodes.filter("d > 1").join(owned.select("conv", F.col("own_from").alias("d")), ["conv", "d"]).select("key", "parent")
    foreign = firsts.join(nodes.select(F.col("key").alias("parent"), F.col("conv").alias("other")), "parent").select("key", "other")
    out = nodes.join(below, "key").join(foreign, "key", "left").select(
        "key", F.col("conv").alias("conv_id"), F.col("d").alias("depth"),
        F.when(F.col("d") == 1, F.lit(top["conv"])).otherwise(F.coalesce("other", "conv")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", (F.col("said") - F.col("once")).alias("saved_tokens"))
    none = hashlib.sha256(b"").hexdigest()
    out = out.unionByName(root).join(listed, "key", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(*rebuilt(numbered(table(spark, sf_dir, "conversations"))))


#: The same by its definition: prefixes as hashes of their turns' list, subtrees by the paths of the smallest members.
OP12_SQL = """
WITH bits AS (
  SELECT k, list_reduce([k, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM (SELECT CAST(range AS BIGINT) AS k FROM range(256))),
crc_table AS (SELECT list(v ORDER BY k) AS t FROM bits),
turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
sizes AS (SELECT c, count(*) AS n FROM turns GROUP BY c),
convs AS (
  SELECT s.c, s.c - s.c % 5 AS base,
         xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(string_split(CAST(s.c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
           lambda crc, x: xor(crc >> 8, crc_table.t[(xor(crc, x) & 255) + 1]))) % 9 AS h
  FROM sizes s, crc_table),
rebuilt AS (
  SELECT v.c, t.i AS d, t.role, t.text FROM convs v JOIN turns t ON t.c = v.base AND t.i <= v.h
  UNION ALL
  SELECT v.c, t.i - v.h + least(v.h, coalesce(b.n, 0)), t.role, t.text
  FROM convs v JOIN turns t ON t.c = v.c AND t.i > v.h LEFT JOIN sizes b ON b.c = v.base),
paths AS (
  SELECT c, d, strlen(text) AS bytes,
         sha256(string_agg(sha256(CAST(length(role) AS VARCHAR) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY d)) AS node
  FROM rebuilt
  UNION ALL SELECT c, 0, 0, 'root' FROM convs),
nodes AS (SELECT node, d, min(c) AS c, count(*) AS n_convs, (count(*) - 1) * max(bytes) AS saved FROM paths GROUP BY node, d),
parents AS (SELECT n.node, p.node AS parent, u.c AS parent_c FROM nodes n JOIN paths p ON p.c = n.c AND p.d = n.d - 1 JOIN nodes u ON u.node = p.node),
children AS (SELECT parent, count(*) AS n FROM parents GROUP BY parent),
subtrees AS (
  SELECT p.node, sum(n.saved) AS saved, count(*) FILTER (ch.n IS NULL) AS leaves
  FROM nodes n JOIN paths p ON p.c = n.c AND p.d <= n.d LEFT JOIN children ch ON ch.parent = n.node GROUP BY p.node),
last AS (SELECT c, arg_max(node, d) AS node FROM paths GROUP BY c),
ends AS (SELECT node, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS h FROM last GROUP BY node)
SELECT CAST(n.c AS BIGINT) AS conv_id, CAST(n.d AS BIGINT) AS depth, CAST(p.parent_c AS BIGINT) AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs,
       CAST(coalesce(ch.n, 0) AS BIGINT) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
       coalesce(e.h, sha256('')) AS ends_sha256
FROM nodes n JOIN subtrees s ON s.node = n.node LEFT JOIN parents p ON p.node = n.node
LEFT JOIN children ch ON ch.parent = n.node LEFT JOIN ends e ON e.node = n.node
"""
