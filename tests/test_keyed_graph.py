import random
from collections import deque

from pyspark.sql import functions as F

from tessera.operators import graph, keyed


def test_upsert_last_write_wins(spark):
    base = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k long, s string, v double")
    upd = spark.createDataFrame([(2, "B", None), (3, "c", 3.0)], "k long, s string, v double")
    got = sorted(tuple(r) for r in keyed.upsert_by_key(base, upd, "k").collect())
    assert got == [(1, "a", 1.0), (2, "B", None), (3, "c", 3.0)]


def test_upsert_with_sequence_column(spark):
    base = spark.createDataFrame([(1, 5, "new"), (2, 1, "x")], "k long, seq long, s string")
    upd = spark.createDataFrame([(1, 3, "old"), (2, 2, "y")], "k long, seq long, s string")
    got = sorted(tuple(r) for r in keyed.upsert_by_key(base, upd, "k", seq="seq").collect())
    assert got == [(1, 5, "new"), (2, 2, "y")]


def test_filter_keys_list_and_frame(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    assert sorted(r.k for r in keyed.filter_keys(df, "k", [3, "5"]).collect()) == [3, 5]
    keys = spark.createDataFrame([(7,), (7,), (8,)], "x long")
    assert sorted(r.k for r in keyed.filter_keys(df, "k", keys).collect()) == [7, 8]


def test_order_lines_join_and_denormalized_agree(spark):
    orders = spark.createDataFrame([(1, 10.5), (2, 3.0), (3, 9.99)], "o_orderkey long, o_totalprice double")
    lineitem = spark.createDataFrame([(1, 100), (1, 101), (1, 100), (2, 101)], "l_orderkey long, l_partkey long")
    part = spark.createDataFrame([(100, "steel"), (101, "black")], "p_partkey long, p_name string")
    joined = {r.o_orderkey: r.line for r in keyed.order_lines(orders, lineitem, part).collect()}
    assert joined == {1: "Order #1 $10.50: black, steel", 2: "Order #2 $3.00: black"}
    denorm = keyed.denormalize_orders(orders, lineitem, part)
    assert {r.o_orderkey: r.line for r in keyed.lines_from_denormalized(denorm).collect()} == joined
    only = keyed.lines_from_denormalized(denorm, keys=[2]).collect()
    assert [r.o_orderkey for r in only] == [2]


def _edges(spark, pairs):
    return spark.createDataFrame(pairs, "src long, dst long")


def test_shortest_path_fixture(spark):
    edges = _edges(spark, [(1, 3), (1, 5), (3, 2), (3, 5), (2, 6)])
    paths = graph.shortest_paths(edges, 1)
    assert graph.route_list(paths, 6) == [1, 3, 2, 6]
    assert graph.route_list(paths, 1) == [1]
    back = graph.shortest_paths(edges, 5)
    assert graph.route_list(back, 1) == graph.NO_PATH
    rows = {r.node: (r.parent, r.dist) for r in paths.collect()}
    assert rows == {1: (None, 0), 3: (1, 1), 5: (1, 1), 2: (3, 2), 6: (2, 3)}


def test_shortest_path_hop_bound(spark):
    chain = _edges(spark, [(i, i + 1) for i in range(10)])
    paths = graph.shortest_paths(chain, 0, max_hops=6)
    assert max(r.dist for r in paths.collect()) == 6
    assert graph.route_list(paths, 7) == graph.NO_PATH


def _brute(pairs, source, max_hops):
    adj = {}
    for s, d in pairs:
        adj.setdefault(s, set()).add(d)
    dist = {source: 0}
    q = deque([source])
    while q:
        u = q.popleft()
        if dist[u] == max_hops:
            continue
        for v in adj.get(u, ()):
            if v not in dist:
                dist[v] = dist[u] + 1
                q.append(v)
    parent = {}
    for s, d in pairs:
        if d in dist and s in dist and dist[s] == dist[d] - 1:
            parent[d] = min(parent.get(d, s), s)
    return dist, parent


def test_shortest_path_matches_brute_force(spark):
    rnd = random.Random(7)
    pairs = sorted({(rnd.randrange(60), rnd.randrange(60)) for _ in range(150)})
    dist, parent = _brute(pairs, 0, 6)
    got = {r.node: (r.parent, r.dist) for r in graph.shortest_paths(_edges(spark, pairs), 0).collect()}
    assert got == {n: (parent.get(n), d) for n, d in dist.items()}


def test_keyed_table_lookup_pushes_key_filter(spark, tmp_out):
    from plan_util import plan_text

    df = spark.range(0, 20_000).select(F.col("id").alias("o_orderkey"), (F.col("id") * 2.5).alias("o_totalprice"),
                                       F.array(F.lit("x")).alias("part_names"))
    keyed.write_keyed_table(df, f"{tmp_out}/kt", "o_orderkey", partitions=8)
    table = spark.read.parquet(f"{tmp_out}/kt")
    assert len(table.inputFiles()) == 8
    lookup = keyed.lines_from_denormalized(table, keys=[5, 19_999])
    assert sorted(r.line for r in lookup.collect()) == ["Order #19999 $49997.50: x", "Order #5 $12.50: x"]
    plan = plan_text(lookup).replace(" ", "")
    assert "PushedFilters:[In(o_orderkey,[19999,5])" in plan or "PushedFilters:[In(o_orderkey,[5,19999])" in plan


def test_bucketed_tables_join_without_exchange(spark, tmp_out):
    from plan_util import plan_text

    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    lineitem = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    o = keyed.write_bucketed(orders, "bucketed_orders", "o_orderkey", 8, f"{tmp_out}/o")
    li = keyed.write_bucketed(lineitem, "bucketed_lineitem", "l_orderkey", 8, f"{tmp_out}/l")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = o.join(li, o["o_orderkey"] == li["l_orderkey"]).groupBy("o_orderkey").count()
        plan = plan_text(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        expected = orders.join(lineitem, orders["o_orderkey"] == lineitem["l_orderkey"]).groupBy("o_orderkey").count()
        assert sorted(joined.collect()) == sorted(expected.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS bucketed_orders")
        spark.sql("DROP TABLE IF EXISTS bucketed_lineitem")


def test_rounds_shuffle_the_frontier_only_and_share_one_staging(spark):
    """The edge side of a round's join has no exchange, though both sides are too big to broadcast here."""
    from plan_util import plan_text

    edges = spark.range(4000).select((F.col("id") % 900).alias("src"), (F.col("id") * 7 % 900).alias("dst"))
    tag = f"test{random.Random().randrange(10**9)}"
    links = graph.stage_edges(edges, tag, buckets=8)
    again = graph.stage_edges(edges.limit(0), tag, buckets=8)  # the stored ones, whatever is passed
    assert sorted(links.collect()) == sorted(again.collect()) == sorted(edges.distinct().collect())
    known = spark.range(300).select(F.col("id").alias("node"), F.lit(None).cast("long").alias("parent"), F.lit(0).alias("dist"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(graph.next_hop(known, links, known), "simple")
        line = next(x for x in plan.splitlines() if "FileScan" in x)
        assert "Bucketed: true" in line and "SelectedBucketsCount: 8 out of 8" in line
        # the frontier, what it reaches and the known nodes are shuffled, edges are not
        assert plan.count("Exchange hashpartitioning(node#") == 3 == plan.count("Exchange")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"DROP TABLE IF EXISTS tessera_edges_edges_{tag}_8")
    spark.sql(f"DROP TABLE IF EXISTS tessera_edges_edges_{tag}_8")
    assert graph.stage_edges(edges, tag, buckets=8).count() == links.count()  # a new session knows the folder by its tag


def test_routes_of_several_targets_and_of_all_nodes(spark):
    rnd = random.Random(11)
    pairs = sorted({(rnd.randrange(80), rnd.randrange(80)) for _ in range(170)})
    dist, parent = _brute(pairs, 0, 6)

    def up(node):
        return up(parent[node]) + [node] if node else [0]

    paths = graph.shortest_paths(_edges(spark, pairs), 0)
    assert {r.node: (r.dist, list(r.path)) for r in graph.all_routes(paths).collect()} == {n: (d, up(n)) for n, d in dist.items()}
    wanted = [0, 5, 17, 17, 1000, *[n for n in range(80) if n not in dist][:2]]
    assert {r.target: list(r.path) for r in graph.routes_to(paths, wanted).collect()} == {n: up(n) for n in wanted if n in dist}
    assert graph.routes_to(paths, []).collect() == []
