"""Retention, modification-time, summary and validity rules on hand-made frames."""

import datetime as dt

from pyspark.sql import functions as F

from netlens.operators import ingest as I
from netlens.operators import merge as U
from netlens.operators import stats as A


def test_retention_cutoff_is_end_of_day_and_drops_incident_links(spark):
    v = spark.createDataFrame(
        [("old", dt.datetime(2024, 1, 3, 23, 59, 59)), ("edge", dt.datetime(2024, 1, 4, 0, 0, 0)),
         ("none", None)], "ne_name string, last_discovery_ts timestamp_ntz")
    e = spark.createDataFrame(
        [("old", "edge", dt.datetime(2024, 1, 9)), ("edge", "none", dt.datetime(2024, 1, 9)),
         ("edge", "none", dt.datetime(2024, 1, 2))], "start_ne string, end_ne string, last_discovery_ts timestamp_ntz")
    kv, ke, counts = U.retain_recent(v, e, "2024-01-10", days=7)      # cutoff: 2024-01-03 23:59:59
    assert {r.ne_name for r in kv.collect()} == {"edge", "none"}     # null time kept
    assert [(r.start_ne, r.end_ne) for r in ke.collect()] == [("edge", "none")]
    got = {r.item: r.n for r in counts.collect()}
    assert got == {"vertices_before": 3, "vertices_after": 2, "edges_before": 3, "edges_after": 1}


def test_max_modification_time_empty_is_blank(spark):
    df = spark.createDataFrame([], "a timestamp_ntz, b timestamp_ntz")
    assert A.max_modification_time(df, ["a", "b"]).collect()[0][0] == ""
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5), None)], "a timestamp_ntz, b timestamp_ntz")
    assert A.max_modification_time(df, ["a", "b"]).collect()[0][0] == "2024-01-02 03:04:05"


def test_merge_summary_has_totals(spark):
    a = spark.createDataFrame([("created",), ("updated",), ("created",)], "outcome string")
    b = spark.createDataFrame([("skipped",)], "outcome string")
    s = {(r.stage, r.outcome): r.rows for r in U.merge_summary({"v": a, "e": b}).collect()}
    assert s[("v", "created")] == 2 and s[("e", "skipped")] == 1 and s[("TOTAL", "created")] == 2
    assert s[("TOTAL", "skipped")] == 1 and s[("TOTAL", "updated")] == 1


def test_validity_split_gives_first_reason(spark):
    rows = spark.createDataFrame(
        [("a", "b", "LLDP", "INTERFACE"), ("a", " ", "LLDP", "INTERFACE"), (None, "b", "LLDP", "INTERFACE")],
        "ne_name string, neighbour_ne_name string, relation string, ne_type string")
    ok, bad = I.validate_rows(rows, "edge")
    assert ok.count() == 1
    assert sorted(r.reject_reason for r in bad.collect()) == ["missing ne_name", "missing neighbour_ne_name"]


def test_changed_properties_and_duplicate_keys(spark):
    snap = spark.createDataFrame([("a", "VERTEX", "X", "UP")], "ne_name string, relation string, vendor string, "
                                 "ne_status string")
    inc = spark.createDataFrame([("a", "VERTEX", "X", "DOWN"), ("a", "VERTEX", "Y", "DOWN")],
                                "ne_name string, relation string, vendor string, ne_status string")
    inc = inc.withColumn("seq", F.monotonically_increasing_id())
    _, out = U.merge_vertices(snap.withColumn("seq", F.lit(0).cast("long")), inc, order=["seq", "vendor"])
    row = out.collect()[0]
    assert row.outcome == "updated" and set(row.changed) == {"vendor", "ne_status", "seq"}
    dup = U.duplicate_keys(inc, ["ne_name", "relation"]).collect()
    assert [(r.ne_name, r.copies) for r in dup] == [("a", 2)]
