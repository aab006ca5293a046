"""Semantics that must be decided once, each on a hand-made frame."""

import datetime as dt

from pyspark.sql import functions as F

from netlens import schema as S
from netlens.functions.expr import (escape_regex, extracting_id, has_coordinates, has_value, link_type_key,
                                    num_or_text_sort, page, prefix_regex)
from netlens.operators import lsp as P
from netlens.operators import subgraph as X


def _edges(spark, rows):
    cols = ["src_interface", "dest_interface", "relation", "link_type", "start_ne", "end_ne"]
    df = spark.createDataFrame(rows, ",".join(f"{c} string" for c in cols))
    return df.withColumn("link_type_key", link_type_key())


def test_isis_key_blank_equals_null_and_other_relations_ignore(spark):
    df = _edges(spark, [("a_1", "b_1", "ISIS", None, "a", "b"), ("a_1", "b_1", "ISIS", "  ", "a", "b"),
                        ("a_1", "b_1", "ISIS", "L2", "a", "b"), ("a_1", "b_1", "OSPF", "X", "a", "b"),
                        ("a_1", "b_1", "OSPF", "Y", "a", "b")])
    keys = {tuple(r) for r in df.select(*S.EDGE_KEY).distinct().collect()}
    assert keys == {("a_1", "b_1", "ISIS", ""), ("a_1", "b_1", "ISIS", "L2"), ("a_1", "b_1", "OSPF", "")}


def test_reverse_duplicates_keep_first_direction_parallels_and_one_self_loop(spark):
    df = _edges(spark, [
        ("a_1", "b_1", "LLDP", None, "a", "b"),   # first direction a->b (smallest key)
        ("a_2", "b_2", "LLDP", None, "a", "b"),   # parallel, same direction: kept
        ("b_1", "a_1", "LLDP", None, "b", "a"),   # reverse: dropped
        ("c_1", "c_2", "LLDP", None, "c", "c"),   # self loop, smallest: kept
        ("c_3", "c_4", "LLDP", None, "c", "c"),   # second self loop: dropped
        ("d_1", "x_1", "LLDP", None, "d", None),  # null end: kept
    ])
    out = {r.src_interface for r in X.remove_reverse_duplicates(df).collect()}
    assert out == {"a_1", "a_2", "c_1", "d_1"}


def test_null_sort_first_when_descending_and_mixed_numeric_text(spark):
    df = spark.createDataFrame([("1", "10"), ("2", None), ("3", "9"), ("4", "abc"), ("5", "Abd")],
                               "id string, v string")
    desc = [r.id for r in df.orderBy(*num_or_text_sort(F.col("v"), descending=True), "id").collect()]
    asc = [r.id for r in df.orderBy(*num_or_text_sort(F.col("v")), "id").collect()]
    assert desc[0] == "2"                        # null first in descending order
    # descending negates the comparison: text before numbers
    assert desc[1:] == ["5", "4", "1", "3"]      # 10 > 9 numerically, not as text
    assert asc[:2] == ["3", "1"] and asc[-1] == "2"
    assert asc[2:4] == ["4", "5"]                # text case-insensitive after numbers


def test_meta_predicate_numeric_text_missing_key_and_bad_term(spark):
    df = spark.createDataFrame(
        [("l1", {"age": "10", "state": "Up"}), ("l2", {"age": "9", "state": "down"}),
         ("l3", {"age": "x", "state": "UP"}), ("l4", {"state": "up"})],
        "lsp_name string, meta map<string,string>")
    got = {r.lsp_name for r in df.filter(P.meta_predicate("age>9")).collect()}
    assert got == {"l1", "l3"}                   # 'x' > '9' as text; l4 lacks the key
    got = {r.lsp_name for r in df.filter(P.meta_predicate("state=UP, garbage, age<=10")).collect()}
    assert got == {"l1"}                         # case-insensitive text, bad term ignored, 'x' > '10'
    assert df.filter(P.meta_predicate("state!=up")).count() == 1


def test_page_conventions(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    half = [r.k for r in page(df, [F.col("k")], 2, 5).collect()]
    incl = [r.k for r in page(df, [F.col("k")], 2, 5, inclusive=True).collect()]
    assert half == [2, 3, 4] and incl == [2, 3, 4, 5]
    assert page(df, [F.col("k")], 3, 3).count() == 0


def test_literal_null_parameters_and_regex_escaping():
    assert not has_value(None) and not has_value("  ") and not has_value("null") and not has_value("NULL")
    assert has_value("0")
    assert escape_regex("a.b(c)") == r"a\.b\(c\)"
    assert prefix_regex("pop  a", space_flexible=True) == r"(?i)^pop\s*a"


def test_coordinates_that_do_not_parse(spark):
    df = spark.createDataFrame([("a", "1.5", "2"), ("b", "n/a", "2"), ("c", "", "3"), ("d", None, "1")],
                               "ne_name string, latitude string, longitude string")
    loose = {r.ne_name for r in df.filter(has_coordinates()).collect()}
    strict = {r.ne_name for r in df.filter(has_coordinates(strict=True)).collect()}
    assert loose == {"a", "b"} and strict == {"a"}


def test_extracting_id(spark):
    df = spark.createDataFrame([("node1/cardA/eth_3",), ("foo",)], "n string")
    assert [r.x for r in df.select(extracting_id("n").alias("x")).collect()] == ["3", "foo"]


def test_golden_lsp_directionality(spark):
    """Two LSP links between the same two routers in opposite directions;
    asking for one router returns only the link that starts there."""
    links = spark.createDataFrame(
        [("R1", "R2", "LSP", "lsp-a", {"mplsLspAge": "12"}, dt.datetime(2024, 1, 1)),
         ("R2", "R1", "LSP", "lsp-b", {"mplsLspAge": "7"}, dt.datetime(2024, 1, 1))],
        "start_ne string, end_ne string, relation string, lsp_name string, meta map<string,string>, "
        "timestamp timestamp")
    names = spark.createDataFrame([("R1",)], "ne_name string")
    out = [r.lsp_name for r in P.links_for_names(links, names).collect()]
    assert out == ["lsp-a"]
    assert [r.lsp_name for r in P.links_for_names(links, names, direction="IN").collect()] == ["lsp-b"]
    assert sorted(r.lsp_name for r in P.links_for_names(links, names, direction="BOTH").collect()) == \
        ["lsp-a", "lsp-b"]
    assert P.links_for_names(links, names, direction="sideways").count() == 1   # unknown -> OUT


# ---------------------------------------------------------------- rules that data of one kind hides
def test_merge_without_relation_and_with_ties(spark):
    from netlens.operators import merge as U
    cols = "ne_name string, relation string, vendor string, last_discovery_ts timestamp_ntz"
    import datetime
    t = datetime.datetime(2024, 1, 1)
    snap = spark.createDataFrame([("a", None, "old", t)], cols)
    inc = [("a", None, "new", t), ("a", "", "other", t)]
    got = [U.merge_vertices(snap, spark.createDataFrame(x, cols)) for x in (inc, inc[::-1])]
    assert [[tuple(r) for r in m.collect()] for m, _ in got] == [[("a", "", "other", t)]] * 2
    assert [r.outcome for r in got[0][1].collect()] == ["updated"]


def test_retention_keeps_links_of_a_name_with_a_live_vertex(spark):
    import datetime
    from netlens.operators import merge as U
    old, new = datetime.datetime(2024, 1, 1), datetime.datetime(2024, 2, 1)
    v = spark.createDataFrame([("a", "X", old), ("a", "Y", new), ("b", "X", new), ("c", "X", old)],
                              "ne_name string, relation string, last_discovery_ts timestamp_ntz")
    e = spark.createDataFrame([("a", "b", new), ("c", "b", new)],
                              "start_ne string, end_ne string, last_discovery_ts timestamp_ntz")
    kept, links, _ = U.retain_recent(v, e, "2024-02-02")
    assert kept.count() == 2 and [r.start_ne for r in links.collect()] == ["a"]


def test_alarm_rules(spark):
    from netlens.operators import kpi as K
    alarms = spark.createDataFrame([("n", "A", "OPEN"), ("n", "B", "OPEN"), ("m", "ODD", "OPEN")],
                                   "entity_name string, category string, alarm_status string")
    prio = spark.createDataFrame([("A", 1), ("B", 1)], "category string, priority int")
    top = {r.ne_name: r for r in K.top_alarm(alarms, prio).collect()}
    assert (top["n"].priority, top["n"].alarm_count) == (1, 2)
    assert (top["m"].priority, top["m"].category) == (None, "ODD")
    nodes = spark.createDataFrame([("n", "ENODEB"), ("m", None), ("x", "ROUTER")], "ne_name string, ne_type string")
    got = {r.ne_name: r.alarm_count for r in K.attach_alarms(nodes, alarms, prio).collect()}
    assert got == {"n": None, "m": 1, "x": None}


def test_hourly_of_the_whole_request(spark):
    from netlens.operators import kpi as K
    s = spark.createDataFrame([("l1", "hourly"), ("l1", "daily"), ("l2", "daily")], "link_name string, granularity string")
    assert [tuple(r) for r in K.preferred_granularity(s).collect()] == [("l1", "hourly")]
    daily = s.filter("granularity = 'daily'")
    assert K.preferred_granularity(daily).count() == 2


def test_scope_on_any_column(spark):
    from netlens.operators import search as Q
    v = spark.createDataFrame([("a", "X", "ROUTER"), ("b", None, "SWITCH")], "ne_name string, relation string, ne_type string")
    scope = spark.createDataFrame([("ne_type", "SWITCH")], "column string, value string")
    assert [r.ne_name for r in Q.scope_filter(v, scope).collect()] == ["b"]


def test_descending_mixed_sort_reverses_ascending(spark):
    from netlens.functions.expr import num_or_text_sort
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("10",), ("9",), ("b",), ("A",), (None,)], "x string")
    up = [r.x for r in df.orderBy(*num_or_text_sort(F.col("x"))).collect()]
    down = [r.x for r in df.orderBy(*num_or_text_sort(F.col("x"), descending=True)).collect()]
    assert up == ["9", "10", "A", "b", None] and down == up[::-1]


def test_decimals_that_no_long_holds(spark):
    from netlens.sources.io import normalise_types
    df = spark.sql("select cast(12345678901234567890123 as decimal(38,0)) big, cast(7 as decimal(18,0)) small, "
                   "cast(1.5 as decimal(9,2)) part, 'x' text")
    out = normalise_types(df)
    assert [t for _, t in out.dtypes] == ["double", "bigint", "double", "string"]
    assert tuple(out.first()) == (1.2345678901234568e22, 7, 1.5, "x")
