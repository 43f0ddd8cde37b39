"""Bounded single-source shortest hops and routes on an edge table (GRF1, GRF2, JOIN8).

Breadth-first search as a driver loop of DataFrame steps. The edges are stored
once, bucketed by their source, so a round shuffles the newest frontier only:
it joins that with the edges, keeps the smallest parent per node reached (a
hash aggregate of longs, partial on the map side), drops nodes already known,
and writes the round as a table in the shared scratch folder
(the folder of ``spark.checkpoint.dir``): that computes the round once, cuts
the lineage and survives the loss of executors. Routes are rebuilt from the
parents when they are asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.keyed import write_bucketed
from tessera.session import committed, scratch_path, scratch_root
from tessera.sinks.files import materialize_counted, snapshot_counted

NO_PATH = ["NO", "PATH", "FOUND"]


def stage_edges(edges: DataFrame, tag: str | None = None, buckets: int | None = None, src: str = "src", dst: str = "dst") -> DataFrame:
    """The distinct edges as a stored table, bucketed and sorted by ``src``.

    ``tag`` names the input: an earlier staging of it is used again, from any
    session. Without one, each call stores its own. ``buckets`` is the number
    of shuffle partitions by default, so that a join on ``src`` shuffles the
    other side alone.
    """
    spark = edges.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "tables", f"edges-{tag}-{buckets}") if tag else scratch_path(spark, "stages", "edges", unique=True)
    name = f"tessera_edges_{path.rsplit('/', 1)[1].replace('-', '_')}"
    if tag and committed(spark, path):
        if not spark.catalog.tableExists(name):
            spark.sql(f"CREATE TABLE {name} (src BIGINT, dst BIGINT) USING parquet CLUSTERED BY (src) SORTED BY (src) INTO {buckets} BUCKETS LOCATION '{path}'")
        return spark.table(name)
    links = edges.select(F.col(src).cast("long").alias("src"), F.col(dst).cast("long").alias("dst")).distinct()
    return write_bucketed(links, name, "src", buckets, path)


def shortest_paths(edges: DataFrame, source: int, max_hops: int = 6, src: str = "src", dst: str = "dst",
                   staged: bool = False, rounds_path: str | None = None) -> DataFrame:
    """``node, parent, dist`` for every node reachable in at most ``max_hops``.

    ``dist`` is the least number of hops; among equally short routes the
    parent with the smallest id wins, so the result is deterministic. The
    source has ``parent`` NULL and ``dist`` 0. ``staged`` says that ``edges``
    already is the result of :func:`stage_edges`. With ``rounds_path`` the
    nodes found in round ``i`` are kept as the table ``<rounds_path>/iter-<i>``
    (a per-iteration snapshot) instead of an anonymous scratch table.
    """
    spark = edges.sparkSession
    scratch_root(spark)  # make sure the checkpoint folder is set
    links = edges if staged else stage_edges(edges, src=src, dst=dst)
    known = spark.createDataFrame([(int(source), None, 0)], "node long, parent long, dist int")
    frontier = known
    seen = [known]
    for hop in range(1, max_hops + 1):
        best = next_hop(frontier, links, known)
        nxt = best.withColumn("dist", F.lit(hop))
        # the row count is observed while the round is written: no extra job
        nxt, found = snapshot_counted(nxt, rounds_path, hop) if rounds_path else materialize_counted(nxt, "bfs")
        if found == 0:
            break
        seen.append(nxt)
        known = known.unionByName(nxt)
        frontier = nxt
    out = seen[0]
    for piece in seen[1:]:
        out = out.unionByName(piece)
    return out


def next_hop(frontier: DataFrame, links: DataFrame, known: DataFrame) -> DataFrame:
    """One round: ``node, parent`` of the nodes one edge past ``frontier`` that aren't ``known``; the smallest parent wins.

    What is carried per edge is two longs; the minimum is partial on the map
    side, so a node that many edges reach is one row per task.
    """
    reached = frontier.select("node").join(links, frontier["node"] == links["src"], "inner").select(
        F.col("dst").alias("node"), F.col("src").alias("parent"))
    best = reached.groupBy("node").agg(F.min("parent").alias("parent"))
    # not an anti-join: the optimiser would move that down onto the edges and shuffle all of them by their target
    seen = known.select("node", F.lit(True).alias("__seen"))
    return best.join(seen, "node", "left").filter(F.col("__seen").isNull()).select("node", "parent")


ROUTES_SQL = """
WITH RECURSIVE up(target, dist, parent, back) AS (
  SELECT p.node, p.dist, p.parent, array(p.node) FROM {paths} p JOIN {targets} t ON p.node = t.target
  UNION ALL
  SELECT up.target, up.dist, p.parent, array_append(up.back, p.node) FROM up JOIN {paths} p ON p.node = up.parent)
SELECT target, dist, reverse(back) AS path FROM up WHERE parent IS NULL
"""


def routes_to(paths: DataFrame, targets: Sequence[int]) -> DataFrame:
    """``target, dist, path`` for those of the ``targets`` that were reached: parents followed up by a recursive query.

    The recursion holds one row per target and hop. For a list of targets;
    :func:`all_routes` is for whole tables. A repeated target counts once.
    """
    wanted = paths.sparkSession.createDataFrame([(int(t),) for t in sorted(set(targets))], "target long")
    return paths.sparkSession.sql(ROUTES_SQL, paths=paths, targets=wanted)


def all_routes(paths: DataFrame, max_hops: int = 6) -> DataFrame:
    """``node, dist, path`` of every reached node: each distance's nodes joined with the routes of the distance before."""
    routes = level = paths.filter(F.col("dist") == 0).select("node", "dist", F.array("node").alias("path"))
    for hop in range(1, max_hops + 1):
        nodes = paths.filter(F.col("dist") == hop).select("node", "parent", "dist")
        before = level.select(F.col("node").alias("parent"), F.col("path").alias("before"))
        level = nodes.join(before, "parent").select("node", "dist", F.concat("before", F.array("node")).alias("path"))
        routes = routes.unionByName(level)
    return routes


def route_list(paths: DataFrame, target: int) -> list:
    """The route as a Python list, or ``NO PATH FOUND`` words (one row at most)."""
    row = routes_to(paths, [target]).first()
    return list(row["path"]) if row else list(NO_PATH)
