"""The ingestion chain: outcomes add up, a second run only updates, stages that fail; open properties
and changes pushed onto links."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from netlens import schema as S
from netlens.operators import load as L
from netlens.operators import merge as U
from netlens.session import materialize

TS = "2002-01-01 00:00:00"
SOME = [s for s in L.STAGES if s[0] in ("lldp_ospf.lldp_interfaces", "lldp_ospf.lldp_links")]


@pytest.fixture(scope="module")
def inventory(fx):
    return L.Inventory(materialize(fx.network_element(), "ne"), fx.ne_location(), [fx.geo(i) for i in range(1, 5)],
                       *(materialize(fx.link_table(x).limit(300), "links") for x in ("LLDP", "OSPF", "ISIS")))


def test_outcomes_add_up_and_a_second_run_updates(inventory):
    # one interface loses its type (failed), and the links come before their interfaces (skipped)
    bad = inventory.network_element.withColumn("ne_type", F.when(
        (F.col("ne_type") == "INTERFACE") & (F.col("id") % 11 == 0), F.lit(" ")).otherwise(F.col("ne_type")))
    broken = L.Inventory(bad, *[getattr(inventory, f) for f in (
        "ne_location", "geo", "lldp_link", "ospf_link", "isis_link")])
    v, e, summary = L.ingest(broken, TS, stages=SOME[::-1])
    rows = {(r.stage, r.kind, r.outcome): r["rows"] for r in summary.collect()}
    for stage, kind in {k[:2] for k in rows}:
        parts = [rows.get((stage, kind, o), 0) for o in ("created", "updated", "skipped", "failed")]
        assert sum(parts) == rows[stage, kind, "read"]
    assert rows["TOTAL", "edge", "skipped"] > 0 and rows["TOTAL", "vertex", "failed"] > 0
    v, e, _ = L.ingest(broken, TS, v, e, stages=SOME, summary=False)
    n_v, n_e = v.count(), e.count()
    v2, e2, summary = L.ingest(broken, "2003-01-01 00:00:00", v, e, stages=SOME)
    rows = {(r.stage, r.kind, r.outcome): r["rows"] for r in summary.collect()}
    assert ("TOTAL", "vertex", "created") not in rows and ("TOTAL", "edge", "created") not in rows
    assert (v2.count(), e2.count()) == (n_v, n_e)
    assert [str(r.created_at) for r in e2.select("created_at").distinct().collect()] == [TS]
    assert e2.filter("start_id is null or end_id is null or label is null or start_ne_id is null").count() == 0
    assert e2.filter("src_lat is not null").count() > 0  # some switches have no coordinates


def test_a_stage_that_fails(inventory):
    def broken(v):
        return v.network_element.select("no_such_column")
    stages = [("broken", False, broken), SOME[0]]
    with pytest.raises(AnalysisException):
        L.ingest(inventory, TS, stages=stages)
    v, _, summary = L.ingest(inventory, TS, stages=stages, on_error="skip")
    assert v.count() > 0
    assert summary.filter("stage = 'broken' and kind = 'stage' and outcome = 'failed'").count() == 1


def test_open_properties_survive_merges(spark):
    cols = "ne_name string, relation string, ne_type string, vendor string, last_discovery_ts timestamp_ntz, attrs map<string,string>"
    snap = spark.createDataFrame([("a", "LLDP", "PORT", "x", None, {"old": "1"}), ("b", "LLDP", "PORT", "y", None, None)], cols)
    inc = spark.createDataFrame([("a", "LLDP", "PORT", None, 7, None), ("c", "LLDP", "PORT", "z", None, "s")],
                                "ne_name string, relation string, ne_type string, vendor string, rack int, shelf string"
                                ).withColumn("last_discovery_ts", F.lit(TS).cast("timestamp_ntz"))
    made, out = U.merge_vertices(snap, inc)
    got = {r.ne_name: r.attrs for r in made.collect()}
    assert got == {"a": {"old": "1", "rack": "7"}, "b": {}, "c": {"shelf": "s"}}
    assert {r.ne_name: r.changed for r in out.collect()}["a"] == ["last_discovery_ts", "rack"]
    again = inc.withColumn("rack", F.lit(8)).withColumn("shelf", F.lit(None).cast("string"))
    made, out = U.merge_vertices(materialize(made, "v"), again)
    assert {r.ne_name: r.attrs for r in made.collect()} == {
        "a": {"old": "1", "rack": "8"}, "b": {}, "c": {"rack": "8", "shelf": "s"}}
    assert {r.ne_name: r.changed for r in out.collect()} == {
        "a": ["last_discovery_ts", "rack"], "c": ["last_discovery_ts", "rack"]}


def test_changes_reach_the_links_of_their_relation_once(spark):
    edges = spark.createDataFrame(
        [("p", "q", "LLDP", "", "old", "UP", "1"), ("p", "q", "ISIS", "L2", "old", "UP", "2"),
         ("q", "p", "LLDP", "", "old", "UP", "3"), ("x", "y", "LLDP", "", "old", "UP", "4")],
        "src_interface string, dest_interface string, relation string, link_type_key string, src_vendor string, "
        "status string, tag string")
    ch = spark.createDataFrame(
        [("p", "LLDP", ["vendor", "ne_status", "tag"], "A", "DOWN", None, {"tag": "t"}),
         ("p", "ISIS", ["vendor"], "B", "DOWN", None, {"tag": "t"}),
         ("q", "LLDP", ["vendor", "ne_status"], None, "GONE", "2002-01-01", None)],
        "ne_name string, relation string, changed array<string>, vendor string, ne_status string, ts string, "
        "attrs map<string,string>").withColumn("last_discovery_ts", F.col("ts").cast("timestamp_ntz")).drop("ts")
    out = U.propagate_vertex_changes(edges, ch)
    got = {(r.src_interface, r.relation): (r.src_vendor, r.dest_vendor, r.status, r.tag, str(r.last_discovery_ts)[:10])
           for r in out.collect()}
    assert out.count() == 4
    assert got == {("p", "LLDP"): ("A", None, "DOWN", "t", "2002-01-01"), ("p", "ISIS"): ("B", None, "UP", "2", "None"),
                   ("q", "LLDP"): ("old", "A", "GONE", "3", "2002-01-01"), ("x", "LLDP"): ("old", None, "UP", "4", "None")}


def test_stored_columns_have_one_type_each():
    assert set(S.EDGE_KEY) <= set(S.STORED_EDGE) and set(S.VERTEX_KEY) <= set(S.STORED_VERTEX)
