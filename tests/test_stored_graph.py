"""The graph derived from hand-made tables, and whole jobs on it."""

import datetime as dt

from pyspark.sql import functions as F

from netlens import schema as S
from netlens.operators import ingest as I
from netlens.operators import load as L
from netlens.operators import subgraph as X
from netlens.plans.catalog import load_all
from netlens.session import materialize
from netlens.sources.testdata import Fixtures, stored_graph

REG = load_all()
DAY = dt.datetime(1998, 6, 1)
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey long, s_name string, s_nationkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
}


def store(spark, folder, **rows):
    for name, schema in TABLES.items():
        spark.createDataFrame(rows.get(name, []), schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def order(key, customer, tag="2-HIGH"):
    return (key, customer, "O", 10.0, DAY, tag)


def line(key, supplier, number=1, flag="N", status="O", part=1, quantity=1.0, day=DAY):
    return (key, part, supplier, number, quantity, 1.0, 0.1, 0.1, flag, status, day)


GEO = dict(region=[(0, "ASIA")], nation=[(0, "NATION_00", 0), (1, "NATION_01", 0)])


def test_hops_of_every_constrained_path(spark, tmp_path):
    """One router, five switches of its pop: six paths, and hops of all."""
    at = store(spark, tmp_path, **GEO, supplier=[(1, "R1", 0)],
               customer=[(k, f"S{k}", 0, "X") for k in range(1, 6)],
               orders=[order(k, k) for k in range(1, 6)], lineitem=[line(k, 1) for k in range(1, 6)])
    paths = {r.path: r.finished for r in REG["r1_constrained_paths"][0](spark, at).collect()}
    hops = REG["r8_path_hops"][0](spark, at).collect()
    assert len([p for p, finished in paths.items() if finished]) == 6
    assert {(r.path_id, r.finished) for r in hops} == set(paths.items())
    assert all(sum(r.path_id == p for r in hops) == p.count(">") for p in paths)


def two_rows(spark, folder):
    return store(spark, folder, **GEO, supplier=[(1, "R1", 0), (2, None, 1)],
                 customer=[(1, "S1", 0, "X"), (2, None, 1, "X")],
                 orders=[order(1, 1), order(2, 2, "1-URGENT"), order(3, 1, "5-LOW")],
                 lineitem=[line(1, 1, 1, "R", "F"), line(1, 1, 1, "R", "F ", quantity=3.0), line(3, 1, 2), line(3, 1, 1, "R", "F"),
                           *[line(2, 2, n) for n in (1, 2, 3, 5)]])


def test_edges_are_built_without_storing_link_rows(spark, tmp_path):
    """The edge table alone stores no link rows, and elements without names are grouped by direction."""
    at = two_rows(spark, tmp_path)
    fx = Fixtures(spark, at, materialize=True)
    rows = {(r.src_interface, r.dest_interface, r.relation, r.src_type): r for r in fx.edges().collect()}
    assert "link_rows" not in fx._stored
    assert {k: r.link_count for k, r in rows.items()} == {
        ("R1_1", "S1_1", "ISIS", "ROUTER"): 3, ("S1_2", "R1_2", "OSPF", "SWITCH"): 1,
        (None, None, "OSPF", "ROUTER"): 3, (None, None, "OSPF", "SWITCH"): 1}
    merged = rows["R1_1", "S1_1", "ISIS", "ROUTER"]
    assert (merged.link_type, merged.link_type_key, merged.tag, merged.bandwidth, merged.ckt_id) == (
        "F ", "F", "5-LOW", 3.0, "CKT1")
    assert fx.edges(fx.link_rows()).exceptAll(fx.edges()).count() == 0


def test_a_search_without_relation_builds_no_edges(spark, tmp_path):
    at = two_rows(spark, tmp_path)
    REG["q2_by_pop_id"][0](spark, at).collect()
    assert set(stored_graph(spark, at)._stored) == {"vertices"}


def test_a_stage_rewrites_only_its_relations(spark, fx):
    """Rows of other relations stay in the files where they were."""
    other = materialize(L.empty(spark, S.STORED_VERTEX).unionByName(
        spark.createDataFrame([("x", "LLDP")], "ne_name string, relation string"), allowMissingColumns=True), "other")
    links = fx.link_table("OSPF").limit(20)
    inventory = L.Inventory(fx.network_element(), fx.ne_location(), [fx.geo(i) for i in range(1, 5)], links, links, links)
    stage = [s for s in L.STAGES if s[0] == "lldp_ospf.ospf_interfaces"]
    v, _, summary = L.ingest(inventory, "2002-01-01 00:00:00", other, stages=stage)
    assert set(other.inputFiles()) <= set(v.inputFiles())
    assert v.filter("ne_name = 'x'").count() == 1 and v.count() > 1
    counts = {r.outcome: r["rows"] for r in summary.filter("stage = 'TOTAL' and kind = 'vertex'").collect()}
    assert counts["read"] == counts["created"] + counts.get("updated", 0)


def test_interfaces_are_made_distinct_before_they_meet_their_links(spark, fx):
    """Repeated elements and links give one row, without comparing wide rows once per link."""
    ne, links = fx.network_element(), fx.link_table("ISIS").limit(30)
    for rows in (lambda n, l: I.interface_vertices(n, l, S.OSPF), I.interface_vertices_isis):
        twice = rows(ne.unionByName(ne), links.unionByName(links))
        once = rows(ne, links)
        assert twice.exceptAll(once).count() == 0 and once.exceptAll(twice).count() == 0
        assert once.count() == once.distinct().count() > 0
        plan = twice._jdf.queryExecution().optimizedPlan().toString()
        assert not plan.startswith("Aggregate")


def test_hop_lists_are_dealt_by_order_before_they_are_collected(spark, tmp_path):
    """One shuffle by order and no aggregate of wide hops before it."""
    at = two_rows(spark, tmp_path)
    feed = Fixtures(spark, at).mpls_lsp_link()
    assert {r.mpls_lsp_name: [n.ne_name for n in r.node_details] for r in feed.collect()} == {
        "LSP_1": ["R1", "R1"], "LSP_3": ["R1", "R1"]}
    plan = feed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("collect_list") < plan.index("RepartitionByExpression [lsp_id") < plan.index("Join Inner, (hop_ne_name")


def test_ports_are_dealt_by_pair_before_they_are_collected(spark, tmp_path):
    """One shuffle by pair, stored in the parts of a large table (F13); null far ends stay."""
    at = two_rows(spark, tmp_path)
    fx = Fixtures(spark, at)
    plan = X._adjacency(fx.vertices(), fx.edges())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("collect_set") < plan.index("RepartitionByExpression [ne_name") < plan.index("Union")
    odd = fx.edges().filter("start_ne = 'R1'").limit(1).withColumn("end_ne", F.lit(None).cast("string"))
    made = X.adjacency(fx.vertices(), fx.edges().unionByName(odd))
    assert made.inputFiles()
    assert {(r.ne_name, r.neighbour, tuple(r.ports), r.n_links) for r in made.collect()} == {
        ("R1", "S1", ("1", "2"), 2), ("S1", "R1", ("1", "2"), 2), ("R1", None, ("1",), 1)}


class Written:
    """Stands for a table: keeps the settings that hold while it is written."""

    def __init__(self, spark):
        self.sparkSession, self.write, self.spark = spark, self, spark

    def parquet(self, path):
        self.held = [self.spark.conf.get(k, None) for k in PARTS]
        self.spark.range(1).write.parquet(path)


PARTS = ["spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"]


def test_parts_of_large_tables_are_small(spark):
    """Stored tables are written in parts of 24 MB at most, whatever the session's settings, which come
    back afterwards (F7 to F14)."""
    own = spark.conf.get(PARTS[1], None)
    try:
        for size, held in ((None, 24 << 20), ("64MB", 24 << 20), ("8m", 8 << 20), ("1048576", 1 << 20)):
            spark.conf.set(PARTS[1], size) if size else spark.conf.unset(PARTS[1])
            before = [spark.conf.get(k, None) for k in PARTS]
            table = Written(spark)
            materialize(table, large=True)
            assert table.held == ["200", f"{held}b"]
            assert [spark.conf.get(k, None) for k in PARTS] == before
    finally:
        spark.conf.set(PARTS[1], own) if own else spark.conf.unset(PARTS[1])
