"""Wide rows are dealt once per end they meet, with the rows they had before."""

import pytest
from pyspark.sql import functions as F

from netlens import schema as S
from netlens.operators import ingest as I
from netlens.operators import load as L
from netlens.operators import merge as U
from netlens.operators import paths as R
from netlens.session import materialize
from netlens.sources.testdata import Fixtures

from .conftest import SF001

TS = "2002-01-01 00:00:00"
BROADCAST = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture
def no_broadcast(spark):
    own = spark.conf.get(BROADCAST)
    spark.conf.set(BROADCAST, "-1")
    yield
    spark.conf.set(BROADCAST, own)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def links(spark, *rows):
    cols = "ne_name string, neighbour_ne_name string, ne_type string, relation string, tag string, link_type_key string"
    made = spark.createDataFrame(rows, cols).withColumn("last_discovery_ts", F.lit(TS).cast("timestamp_ntz"))
    return L.edge_rows(materialize(made, "rows"))


def test_a_batch_of_whole_keys_is_dealt_once(spark, no_broadcast):
    """Keys are looked up among the vertices apart from their rows; outcomes and rows stay."""
    names = materialize(spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "ne_name string"), "names")
    rows = links(spark, ("a", "b", "PORT", "OSPF", "1", ""), ("a", "b", "PORT", "OSPF", "2", ""),
                 ("a", "x", "PORT", "OSPF", "3", ""), ("x", "a", "PORT", "OSPF", "4", ""), ("c", "c", "PORT", "OSPF", "5", ""))
    ends = ("src_interface", "dest_interface")
    old = L.empty(spark, S.STORED_EDGE)
    first = U.merged_edges(old, rows, names, TS, ["tag"], ends, keyed=True)
    assert same(first, U.merged_edges(old, rows, names, TS, ["tag"], ends))
    assert {(r.src_interface, r.dest_interface, r.tag, r._outcome, r._n) for r in first.collect()} == {
        ("a", "b", "2", "created", 2), ("a", "x", "3", "skipped", 1), ("x", "a", "4", "skipped", 1),
        ("c", "c", "5", "created", 1)}
    stored = materialize(U.stored_edges(first).drop("_outcome", "_n"), "edges")
    again = U.merged_edges(stored, rows, names, "2003-01-01 00:00:00", ["tag"], ends, keyed=True)
    assert {(r.tag, r._outcome) for r in again.collect()} == {
        ("2", "updated"), ("5", "updated"), ("3", "skipped"), ("4", "skipped")}
    assert {str(r.created_at) for r in U.stored_edges(again).collect()} == {TS}
    plan = executed(first)
    assert plan.index("SortMergeJoin [_h") < plan.index("SortAggregate") < plan.index("Exchange")  # none between


def test_last_rows_do_not_depend_on_the_hash(spark):
    """Keys with nulls are keys like others."""
    rows = spark.createDataFrame([(None, "r", 1, "x"), (None, "r", 2, "a"), ("k", None, 1, "y"), ("k", "r", 1, "z")],
                                 "ne_name string, relation string, at int, v string")
    got = U.dedupe_last(rows, ["ne_name", "relation"], ["at"])
    assert got.columns == [*rows.columns, "_n"]
    assert {(r.ne_name, r.relation, r.v, r._n) for r in got.collect()} == {
        (None, "r", "a", 2), ("k", None, "y", 1), ("k", "r", "z", 1)}


def test_link_tables_are_derived_without_storing_all_link_rows(spark, fx):
    """(F1, F2, F3, F5, F6)"""
    stored = Fixtures(spark, SF001, materialize=True)
    assert same(stored.link_table("OSPF"), fx.link_table("OSPF"))
    assert "link_rows" not in stored._stored
    stored.link_rows()
    assert same(stored.link_table("OSPF"), fx.link_table("OSPF"))


def test_link_rows_are_distinct_where_their_interface_dealt_them(spark, fx, no_broadcast):
    """Repeated elements and links give one row, without another shuffle for that."""
    ne = materialize(fx.network_element(), "ne")
    for relation in ("OSPF", "ISIS"):
        few = materialize(fx.link_table(relation).limit(40), "links")
        once = I.link_rows_routed(ne, few, relation)
        assert same(I.link_rows_routed(ne.unionByName(ne), few.unionByName(few), relation), once)
        assert once.count() > 0
        plan = executed(once)
        assert "HashAggregate" in plan and plan.index("SortMergeJoin") < plan.index("Exchange")


def test_hops_meet_interfaces_that_have_met_their_parent(spark, fx):
    """A hop is dealt once per end, not again for either parent."""
    made = I.lsp_hop_edges(fx.lsp(), fx.lsp_hop(), fx.network_element())
    plan = optimized(made)
    for end, hop in (("s", "src_if"), ("d", "dst_if")):
        assert plan.index(f"Inner, ({hop}#") < plan.index(f"LeftOuter, ({end}_parent_ne_id_fk#")


def test_changes_are_one_row_a_vertex(spark):
    """Repeated vertices give the smallest value; links without an end, of another relation or twice stay."""
    edges = spark.createDataFrame(
        [("p", "q", "LLDP", "", "1"), ("p", "q", "LLDP", "", "1"), ("p", None, "LLDP", "", "2"), (None, "q", "LLDP", "", "3"),
         (None, None, None, "", "4"), ("p", "q", "OSPF", "", "5"), ("p", "p", None, "", "6")],
        "src_interface string, dest_interface string, relation string, link_type_key string, ckt_id string")
    ch = spark.createDataFrame(
        [("p", "LLDP", ["vendor"], "B", "c"), ("p", "LLDP", ["vendor", "ckt_id"], "A", "d"), ("q", "LLDP", ["ckt_id"], "Q", "e"),
         ("p", None, ["vendor"], "N", None), (None, "LLDP", ["vendor"], "X", "x")],
        "ne_name string, relation string, changed array<string>, vendor string, ckt_id string").withColumn(
        "last_discovery_ts", F.lit(TS).cast("timestamp_ntz"))
    table = U.change_table(ch)
    assert {(r.ne_name, r.relation): r["values"].get("vendor") for r in table.collect()} == {
        ("p", "LLDP"): "A", ("q", "LLDP"): None, ("p", ""): "N"}
    out = U.propagate_vertex_changes(edges, ch)
    got = sorted(map(str, ((r.src_interface, r.dest_interface, r.relation, r.ckt_id, r.src_vendor, r.dest_vendor)
                           for r in out.collect())))
    assert got == sorted(map(str, [
        ("p", "q", "LLDP", "d", "A", None), ("p", "q", "LLDP", "d", "A", None), ("p", None, "LLDP", "d", "A", None),
        (None, "q", "LLDP", "e", None, None), (None, None, None, "4", None, None), ("p", "q", "OSPF", "5", None, None),
        ("p", "p", None, "6", "N", "N")]))


def test_ports_are_looked_up_for_pairs_on_paths_only(spark):
    """The smallest link of a pair in either direction gives the ports, both ways round (F8)."""
    edges = spark.createDataFrame(
        [("b_2", "a_9", "OSPF", "", "b", "a"), ("a_3", "b_4", "OSPF", "", "a", "b"), ("c_1", "b_7", "LLDP", "", "c", "b"),
         ("c_1", "b_7", "LLDP", "", "b", "c"), ("a_5", "a_6", "LLDP", "", "a", "a"), ("y_1", "z_1", "LLDP", "", "y", "z"),
         ("n_1", "a_1", "LLDP", "", None, "a")],
        "src_interface string, dest_interface string, relation string, link_type_key string, start_ne string, end_ne string")
    paths = spark.createDataFrame([(["a", "b", "c"],), (["c", "b", "a"],), (["a", "a"],), (["a", "x"],)], "path array<string>")
    got = R.path_hops(paths, edges)
    assert {(r.path_id, r.hop, r.ne_name, r.next_ne, r.relation, r.port, r.next_port) for r in got.collect()} == {
        ("a>b>c", 0, "a", "b", "OSPF", "3", "4"), ("a>b>c", 1, "b", "c", "LLDP", "1", "7"),
        ("c>b>a", 0, "c", "b", "LLDP", "1", "7"), ("c>b>a", 1, "b", "a", "OSPF", "4", "3"),
        ("a>a", 0, "a", "a", "LLDP", "5", "6"), ("a>x", 0, "a", "x", None, None, None)}
    assert "LeftSemi" in optimized(got)
