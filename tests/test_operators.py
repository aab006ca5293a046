"""Merge properties, plan shape, paths against brute force, sources and sinks."""

import os
import tempfile
from collections import defaultdict

from pyspark.sql import functions as F

from netlens import schema as S
from netlens.functions.expr import link_type_key
from netlens.operators import ingest as I
from netlens.operators import merge as U
from netlens.operators import paths as R
from netlens.sources import io as IO


# ----------------------------------------------------------------- merge
def _edge_merge_inputs(fx):
    rows = fx.link_rows()
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    snap = fx.edges(rows.filter(F.col("last_discovery_ts") < cut))
    inc = (rows.filter(F.col("last_discovery_ts") >= cut).withColumn("link_count", F.lit(1).cast("long"))
           .withColumn("status", F.lit("ACTIVE")).withColumn("is_deleted", F.lit(False)))
    return snap, inc, fx.vertices().filter(~F.col("is_deleted"))


ORDER = ["last_discovery_ts", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def test_merge_counts_add_up_and_are_idempotent(fx):
    snap, inc, live = _edge_merge_inputs(fx)
    merged, out = U.merge_edges(snap, inc, live, "2002-01-01 00:00:00", order=ORDER)
    counts = {r.outcome: r["count"] for r in out.groupBy("outcome").count().collect()}
    deduped = inc.withColumn("link_type_key", link_type_key()).select(*S.EDGE_KEY).distinct().count()
    assert sum(counts.values()) == deduped      # created + updated + skipped = rows after dedupe
    assert merged.count() == snap.count() + counts.get("created", 0)
    # merging the same input again: nothing new, everything that merged is now updated
    merged2, out2 = U.merge_edges(merged, inc, live, "2002-01-01 00:00:00", order=ORDER)
    c2 = {r.outcome: r["count"] for r in out2.groupBy("outcome").count().collect()}
    assert c2.get("created", 0) == 0
    assert c2.get("updated", 0) == counts.get("created", 0) + counts.get("updated", 0)
    assert merged2.exceptAll(merged).count() == 0


def test_merge_is_order_free(fx):
    snap, inc, live = _edge_merge_inputs(fx)
    a, _ = U.merge_edges(snap, inc, live, "2002-01-01 00:00:00", order=ORDER)
    b, _ = U.merge_edges(snap, inc.orderBy(F.rand(7)).repartition(3), live, "2002-01-01 00:00:00", order=ORDER)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_vertex_merge_never_writes_nulls(spark):
    snap = spark.createDataFrame([("a", "VERTEX", 1.0, "UP"), ("b", "VERTEX", 2.0, "UP")],
                                 "ne_name string, relation string, latitude double, ne_status string")
    inc = spark.createDataFrame([("a", "VERTEX", None, "DOWN", "x"), ("c", "VERTEX", 3.0, "UP", "y")],
                                "ne_name string, relation string, latitude double, ne_status string, "
                                "src_vendor string")
    inc = inc.withColumn("last_discovery_ts", F.current_timestamp())
    merged, out = U.merge_vertices(snap, inc, order=["ne_name"])
    got = {r.ne_name: (r.latitude, r.ne_status) for r in merged.collect()}
    assert got == {"a": (1.0, "DOWN"), "b": (2.0, "UP"), "c": (3.0, "UP")}
    assert "src_vendor" not in merged.columns
    assert {r.ne_name: r.outcome for r in out.collect()} == {"a": "updated", "c": "created"}


# ------------------------------------------------------------ plan shape
def test_or_join_views_have_no_nested_loop_or_cartesian(fx):
    ne = fx.network_element()
    plans = [I.interface_vertices(ne, fx.link_table("LLDP"), "LLDP"),
             I.interface_vertices(ne, fx.link_table("OSPF"), "OSPF"),
             I.interface_vertices_isis(ne, fx.link_table("ISIS")),
             I.interface_vertices(ne, fx.link_table("LLDP"), "LLDPSWITCH", "SWITCH")]
    for p in plans:
        text = p._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_filters_and_columns_reach_the_scan(fx):
    df = fx.t("lineitem").filter(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).select(
        "l_orderkey")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in text


# ------------------------------------------------------------------ paths
def _brute_paths(adj, types, attr, starts, allowed, terms, max_depth):
    out = set()

    def walk(path):
        last = path[-1]
        for b in adj[last]:
            if b in path or attr.get(b) != attr.get(path[0]) or attr.get(b) is None:
                continue
            t = types[b]
            if t in terms:
                out.add(tuple(path + [b]))
            elif t in allowed and len(path) < max_depth:
                walk(path + [b])

    for s in starts:
        walk([s])
    return out


def test_simple_paths_match_brute_force(fx):
    v = fx.vertices()
    hops = R.hop_table(fx.edges(), fx.parent_edges())
    starts = v.filter((F.col("ne_type") == "ROUTER") & (F.col("geography_l1") == "EUROPE")).select("ne_name")
    got = {tuple(r.path) for r in R.simple_paths(v, hops, starts, ["ROUTER", "SWITCH"], term_types=["AGG"],
                                                  same_attr="pop_id", max_depth=3).collect() if r.finished}
    adj = defaultdict(set)
    for r in hops.collect():
        adj[r.a].add(r.b)
    types = {r.ne_name: r.ne_type for r in v.collect()}
    attr = {r.ne_name: r.pop_id for r in v.collect()}
    want = _brute_paths(adj, types, attr, [r.ne_name for r in starts.collect()], {"ROUTER", "SWITCH"},
                        {"AGG"}, 3)
    assert got == want and len(got) > 0


def test_reach_and_impact_on_hierarchy(fx):
    pe = fx.parent_edges()
    hops = R.hop_table(pe)
    nodes, _ = R.impact(fx.vertices(), hops, "NATION_3", ["CORE"])
    dep = {r.ne_name for r in nodes.filter("dependent").collect()}
    children = {r.ne_name for r in fx.vertices().filter(F.col("parent_ne") == "NATION_3").collect()}
    assert dep == children


# ---------------------------------------------------------- sources, sinks
def test_export_and_reload(fx, spark):
    out = tempfile.mkdtemp(prefix="netlens-export-")
    v = fx.vertices()
    e = fx.edges()
    IO.export(v, e, out, "both", fmt="csv")
    back = spark.read.option("header", True).csv(f"{out}/vertices")
    assert back.count() == v.filter((F.col("latitude").isNotNull())).count()
    IO.write_graph(v, e, f"{out}/graph")
    assert IO.load_graph(spark, f"{out}/graph/edges").count() == e.count()
    assert set(os.listdir(f"{out}/graph/edges")) >= {"relation=LLDP", "relation=OSPF", "relation=ISIS"}


def test_merge_result_export(fx):
    snap, inc, live = _edge_merge_inputs(fx)
    _, out = U.merge_edges(snap, inc, live, "2002-01-01 00:00:00", order=ORDER)
    cls = U.classify_records(out, snap).withColumn("reject_reason", F.when(
        F.col("record_class") == "failed", F.lit("end element missing")))
    d = tempfile.mkdtemp(prefix="netlens-merge-")
    paths = IO.export_merge_result(cls, d, S.EDGE_KEY)
    assert [os.path.basename(p) for p in paths] == ["new", "updated", "failed"]


def test_type_normalisation(spark):
    df = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (2, "2024-01-01 10:00:05"),
                                (3, "2024-01-01 10:00:05.120")], "id int, s string")
    df = df.withColumn("ts", F.col("s").cast("timestamp_ntz"))
    got = [r.ts for r in IO.to_api_types(df, ["ts"], []).orderBy("id").collect()]
    assert got == ["2024-01-01 10:00", "2024-01-01 10:00:05", "2024-01-01 10:00:05.120"]


# ---------------------------------------------------------- long chains, names under two relations
def _chain(spark, n):
    v = spark.createDataFrame([(f"n{i}", "VERTEX", "AGG" if i == n else "ROUTER", f"n{i - 1}" if i else None, 1)
                               for i in range(n + 1)]
                              + [("n1", "OTHER", "ROUTER", None, 1)],
                              "ne_name string, relation string, ne_type string, parent_ne string, pop_id int")
    e = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(n)], "a string, b string")
    return v, e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))


def test_nothing_is_cut_on_a_long_chain(spark):
    v, hops = _chain(spark, 20)
    assert R.reach(v.filter("ne_name = 'n0'"), hops).count() == 21
    assert R.hierarchy(v, v.filter("ne_name = 'n0'")).count() == 20
    row = R.level_reachable(v, hops, "n0", ["AGG"], ["ROUTER"], None).first()
    assert row.reachable and row.upper_reached == 1
    assert not R.level_reachable(v, hops, "n0", ["AGG"], ["ROUTER"], "n7").first().reachable


def test_hierarchy_ends_on_a_cycle(spark):
    v = spark.createDataFrame([("a", "b", "X"), ("b", "a", "X")], "ne_name string, parent_ne string, ne_type string")
    assert R.hierarchy(v, v.filter("ne_name = 'a'")).count() == 2


def test_paths_by_name_and_open_paths(spark):
    import pytest
    v, hops = _chain(spark, 4)
    p = R.simple_paths(v, hops, v.filter("ne_name = 'n0'"), ["ROUTER"], term_types=["AGG"], max_depth=4)
    assert [r.path for r in p.collect()] == [["n0", "n1", "n2", "n3", "n4"]]
    assert R.affected_nodes(p, v).count() == 5
    with pytest.raises(ValueError):
        R.simple_paths(v, hops, v.filter("ne_name = 'n0'"), ["ROUTER"], term_types=["AGG"], max_depth=3,
                       require_complete=True)
