"""Registered sub-graph and search queries (X1–X7, Q1–Q16) with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import search as Q
from ..operators import subgraph as X
from .catalog import query
from .sqlparts import EDGE_COLS, HAS_XY, HAS_XY_STRICT, nodes_of, revdedupe, types_in

ALL_TYPES = "ROUTER,SWITCH,AGG,CORE"

# ---------------------------------------------------------------- X1–X5, Q6
_REGION_OSPF = f"""
WITH names AS (SELECT DISTINCT ne_name FROM vertices WHERE {types_in(ALL_TYPES)} AND geography_l1 = 'ASIA' AND {HAS_XY}),
l AS (SELECT * FROM edges WHERE upper(relation) IN ('OSPF') AND start_ne IN (SELECT ne_name FROM names)),
d AS ({revdedupe('l')})
"""


@query("q6_region_links", _REGION_OSPF + "SELECT * FROM d", views=("vertices", "edges"))
def q6_region_links(fx):
    """Q6 + X3 + X5: outgoing OSPF links of the ASIA region, reverse duplicates removed."""
    links, _ = Q.by_region(fx.vertices(), fx.edges(), ALL_TYPES, "ASIA", link_relation="OSPF")
    return links


@query("q6_region_nodes", _REGION_OSPF + nodes_of("d", "names"), views=("vertices", "edges"))
def q6_region_nodes(fx):
    """Q6 + X4: nodes of the ASIA OSPF sub-graph (names, starts, ends with coordinates)."""
    _, nodes = Q.by_region(fx.vertices(), fx.edges(), ALL_TYPES, "ASIA", link_relation="OSPF")
    return nodes


@query("x2_outgoing_links", f"""
SELECT * FROM edges WHERE start_ne IN (SELECT ne_name FROM vertices WHERE geography_l1 = 'AMERICA')""",
       views=("vertices", "edges"))
def x2_outgoing_links(fx):
    """All outgoing links (any relation) of the AMERICA elements, no dedupe."""
    v = fx.vertices()
    names = X.names_df(v.filter(F.col("geography_l1") == "AMERICA"))
    return X.links_from(fx.edges(), names)


@query("x1_parent_links", """
WITH names AS (SELECT ne_name FROM vertices WHERE geography_l2 IN ('NATION_3', 'NATION_7', 'NATION_11'))
SELECT * FROM edges WHERE start_ne IN (SELECT ne_name FROM names) AND end_ne IN (SELECT ne_name FROM names)""",
       views=("vertices", "edges"))
def x1_parent_links(fx):
    """X1 parent mode: links with both ends among three nations' elements."""
    v = fx.vertices().filter(F.col("geography_l2").isin("NATION_3", "NATION_7", "NATION_11"))
    links, _ = X.subgraph(fx.vertices(), fx.edges(), X.names_df(v), "parent")
    return links


@query("x1_parent_nodes", f"""
SELECT * FROM vertices WHERE geography_l2 IN ('NATION_3', 'NATION_7', 'NATION_11') AND {HAS_XY}""",
       views=("vertices",))
def x1_parent_nodes(fx):
    """X1 parent mode nodes: the names having coordinates."""
    v = fx.vertices().filter(F.col("geography_l2").isin("NATION_3", "NATION_7", "NATION_11"))
    _, nodes = X.subgraph(fx.vertices(), fx.edges(), X.names_df(v), "parent")
    return nodes


@query("x5_reverse_dedupe", f"""
WITH e AS MATERIALIZED (SELECT *, least(start_ne, end_ne) AS lo, greatest(start_ne, end_ne) AS hi FROM edges),
w AS (SELECT *, first_value(start_ne) OVER pair AS f_start, row_number() OVER pair AS rn
      FROM e WHERE start_ne IS NOT NULL AND end_ne IS NOT NULL
      WINDOW pair AS (PARTITION BY lo, hi ORDER BY src_interface, dest_interface, relation, link_type_key))
SELECT {EDGE_COLS} FROM w WHERE start_ne = f_start AND (start_ne <> end_ne OR rn = 1)
UNION ALL SELECT {EDGE_COLS} FROM e WHERE start_ne IS NULL OR end_ne IS NULL""", views=("edges",))
def x5_reverse_dedupe(fx):
    """X5 over the whole edge table."""
    return X.remove_reverse_duplicates(fx.edges())


@query("x4_nodes_of_links", f"""
WITH l AS (SELECT * FROM edges WHERE relation = 'LLDP' AND tag = '1-URGENT')
{nodes_of('l')}""", views=("vertices", "edges"))
def x4_nodes_of_links(fx):
    """End nodes (with coordinates) of all urgent LLDP links."""
    links = fx.edges().filter((F.col("relation") == "LLDP") & (F.col("tag") == "1-URGENT"))
    return X.nodes_of_links(fx.vertices(), links)


@query("x7_alarm_links", """
WITH names AS (SELECT DISTINCT entity_name AS ne_name FROM alarms WHERE entity_name IS NOT NULL)
SELECT * FROM edges WHERE start_ne IN (SELECT ne_name FROM names) AND end_ne IN (SELECT ne_name FROM names)""",
       views=("alarms", "edges"))
def x7_alarm_links(fx):
    """Parent-mode sub-graph of all alarmed nodes (links)."""
    links, _ = X.with_alarms(fx.vertices(), fx.edges(), fx.alarms())
    return links


def _all_alarms(fx):
    """The fixture's alarms stand at routers only; here the same error events stand at switches too."""
    events = fx.t("events").filter(F.col("event_type") == "error").select("user_id")
    c = fx.t("customer").select("c_custkey", "c_name")
    switches = events.join(c, events.user_id == c.c_custkey).select(F.col("c_name").alias("entity_name"))
    return fx.alarms().select("entity_name").unionByName(switches)


@query("x7_alarm_links_any_element", """
WITH names AS (SELECT DISTINCT entity_name AS ne_name FROM alarms
  UNION SELECT c_name FROM events JOIN customer ON c_custkey = user_id WHERE event_type = 'error')
SELECT * FROM edges WHERE start_ne IN (SELECT ne_name FROM names) AND end_ne IN (SELECT ne_name FROM names)""",
       views=("alarms", "edges"))
def x7_alarm_links_any_element(fx):
    """Links with alarms at both ends, where switches raise alarms as well."""
    links, _ = X.with_alarms(fx.vertices(), fx.edges(), _all_alarms(fx))
    return links


@query("x7_alarm_nodes", f"""
SELECT * FROM vertices WHERE {HAS_XY} AND ne_name IN (SELECT entity_name FROM alarms)""",
       views=("alarms", "vertices"))
def x7_alarm_nodes(fx):
    """Alarmed nodes with coordinates."""
    _, nodes = X.with_alarms(fx.vertices(), fx.edges(), fx.alarms())
    return nodes


# ------------------------------------------------------------------ Q1–Q5
@query("q1_by_name", f"""
SELECT * FROM vertices WHERE {types_in('ROUTER,SWITCH')}
  AND regexp_matches(ne_name, '(?i)^customer#00000012') AND {HAS_XY}""", views=("vertices",))
def q1_by_name(fx):
    """Q1: name starts with 'customer#00000012' (case-insensitive), with coordinates."""
    return Q.by_name(fx.vertices(), None, "ROUTER,SWITCH", "customer#00000012")


@query("q1_by_name_relation", f"""
WITH v AS (SELECT * FROM vertices WHERE {types_in('ROUTER,SWITCH')}),
ends AS (SELECT start_ne AS n FROM edges WHERE upper(relation) = 'ISIS'
         UNION SELECT end_ne FROM edges WHERE upper(relation) = 'ISIS')
SELECT * FROM v WHERE (upper(relation) = 'ISIS' OR ne_name IN (SELECT n FROM ends))
  AND regexp_matches(ne_name, '(?i)^supplier#0000000') AND {HAS_XY}""", views=("vertices", "edges"))
def q1_by_name_relation(fx):
    """Q1 with relation rule: vertices with an incident ISIS link."""
    return Q.by_name(fx.vertices(), fx.edges(), "ROUTER,SWITCH", "supplier#0000000", relation="isis")


@query("q2_by_pop_id", f"""
SELECT * FROM vertices WHERE {types_in(ALL_TYPES)} AND (pop_id = 1012 OR contains(CAST(pop_id AS VARCHAR), '1012'))
  AND {HAS_XY}""",
       views=("vertices",))
def q2_by_pop_id(fx):
    """Q2: pop id 1012 (equal or text contains)."""
    return Q.by_pop_id(fx.vertices(), None, ALL_TYPES, "1012")


@query("q3_by_pop_name", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY pop_name ORDER BY ne_name) AS rn FROM vertices
  WHERE {types_in('ROUTER,SWITCH')} AND {HAS_XY} AND regexp_matches(pop_name, '(?i)^pop\\s*nation_1'))
WHERE rn = 1""", views=("vertices",))
def q3_by_pop_name(fx):
    """Q3: pop name 'pop  nation_1' (flexible spaces), one vertex per pop."""
    return Q.by_pop_name(fx.vertices(), None, "ROUTER,SWITCH", "pop  nation_1")


@query("q4_by_ipv4", f"""
SELECT * FROM vertices WHERE {types_in(ALL_TYPES)} AND {HAS_XY} AND regexp_matches(ipv4, '(?i)^172\\.1\\.')""",
       views=("vertices",))
def q4_by_ipv4(fx):
    """Q4: ipv4 starting with '172.1.'."""
    return Q.by_ipv4(fx.vertices(), None, ALL_TYPES, "172.1.")


@query("q5_by_pop_code", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY pop_code ORDER BY ne_name) AS rn FROM vertices
  WHERE {types_in(ALL_TYPES)} AND {HAS_XY} AND regexp_matches(pop_code, '(?i)^pc1'))
WHERE rn = 1""", views=("vertices",))
def q5_by_pop_code(fx):
    """Q5: pop code starting 'pc1', one vertex per pop code."""
    return Q.by_pop_code(fx.vertices(), None, ALL_TYPES, "pc1")


# ------------------------------------------------------------------ Q7, Q8
@query("q7_area_tag_links", """
SELECT * FROM edges WHERE area_ip_address = '10.5.0.0' AND tag = '2-HIGH'""", views=("edges",))
def q7_area_tag_links(fx):
    """Q7: links in area 10.5.0.0 with tag 2-HIGH."""
    links, _ = Q.by_area_tag(fx.vertices(), fx.edges(), area_ip="10.5.0.0", tag="2-HIGH")
    return links


@query("q7_area_tag_nodes", f"""
WITH l AS (SELECT * FROM edges WHERE area_ip_address = '10.5.0.0' AND tag = '2-HIGH')
{nodes_of('l')}""", views=("vertices", "edges"))
def q7_area_tag_nodes(fx):
    """Q7: end nodes of those links."""
    _, nodes = Q.by_area_tag(fx.vertices(), fx.edges(), area_ip="10.5.0.0", tag="2-HIGH")
    return nodes


_REGION_TAG = f"""
WITH names AS (SELECT DISTINCT ne_name FROM vertices WHERE {types_in(ALL_TYPES)} AND {HAS_XY}
          AND geography_l1 = 'EUROPE'),
l AS (SELECT * FROM edges WHERE tag = '5-LOW'
      AND (start_ne IN (SELECT ne_name FROM names) OR end_ne IN (SELECT ne_name FROM names)))
"""


@query("q8_region_tag_links", _REGION_TAG + "SELECT * FROM l", views=("vertices", "edges"))
def q8_region_tag_links(fx):
    """Q8: 5-LOW links with either end in EUROPE."""
    links, _ = Q.by_region_tag(fx.vertices(), fx.edges(), ALL_TYPES, "EUROPE", "5-LOW")
    return links


@query("q8_region_tag_nodes", _REGION_TAG + nodes_of("l"), views=("vertices", "edges"))
def q8_region_tag_nodes(fx):
    """Q8: end nodes of those links having coordinates."""
    _, nodes = Q.by_region_tag(fx.vertices(), fx.edges(), ALL_TYPES, "EUROPE", "5-LOW")
    return nodes


# ----------------------------------------------------------------- Q10–Q16
_UNIFIED = f"""
WITH n1 AS (SELECT *, 0 AS rk FROM vertices WHERE {types_in(ALL_TYPES)}
            AND regexp_matches(ne_name, '(?i)^supplier#00000004') AND {HAS_XY}),
n2 AS (SELECT *, 3 AS rk FROM vertices WHERE {types_in(ALL_TYPES)} AND {HAS_XY}
       AND regexp_matches(ipv4, '(?i)^10\\.4\\.')),
l5 AS (SELECT * FROM edges WHERE area_ip_address = '10.4.0.0'),
n5 AS (SELECT *, 5 AS rk FROM ({nodes_of('l5')}) z),
alln AS (SELECT * FROM n1 UNION ALL SELECT * FROM n2 UNION ALL SELECT * FROM n5)
"""


@query("q10_unified_nodes", _UNIFIED + """
SELECT * EXCLUDE (rk, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY ne_name ORDER BY rk) AS rn FROM alln) WHERE rn = 1""",
       views=("vertices", "edges"))
def q10_unified_nodes(fx):
    """Q10: name, ipv4 and area-ip dimensions unioned, nodes unique by name."""
    _, nodes = Q.unified(fx.vertices(), fx.edges(), ALL_TYPES, ne_name="supplier#00000004",
                         ipv4="10.4.", area_ip="10.4.0.0")
    return nodes


@query("q10_unified_links", _UNIFIED + "SELECT * FROM l5", views=("vertices", "edges"))
def q10_unified_links(fx):
    """Q10: links of the link-producing dimensions, concatenated."""
    links, _ = Q.unified(fx.vertices(), fx.edges(), ALL_TYPES, ne_name="supplier#00000004",
                         ipv4="10.4.", area_ip="10.4.0.0")
    return links


@query("q11_or_search", f"""
WITH e AS (SELECT start_ne AS n FROM edges WHERE area_ip_address = '10.7.0.0' OR tag = '10.7.0.0'
           UNION SELECT end_ne FROM edges WHERE area_ip_address = '10.7.0.0' OR tag = '10.7.0.0')
SELECT * FROM vertices WHERE {types_in('ROUTER,AGG')} AND {HAS_XY} AND (
  regexp_matches(ne_name, '(?i)^10\\.7\\.0\\.0') OR regexp_matches(coalesce(pop_name, ''), '(?i)^10\\.7\\.0\\.0')
  OR regexp_matches(coalesce(CAST(pop_id AS VARCHAR), ''), '(?i)^10\\.7\\.0\\.0')
  OR ne_name IN (SELECT n FROM e))""",
       views=("vertices", "edges"))
def q11_or_search(fx):
    """Q11: OR search for '10.7.0.0' over routers and sites."""
    return Q.or_search(fx.vertices(), fx.edges(), "ROUTER,AGG", "10.7.0.0")


@query("q12_pop_id_prefix", f"""
SELECT * FROM vertices WHERE {types_in(ALL_TYPES)} AND starts_with(CAST(pop_id AS VARCHAR), '101')""",
       views=("vertices",))
def q12_pop_id_prefix(fx):
    """Q12: pop ids whose digits start with 101."""
    return Q.by_pop_id_prefix(fx.vertices(), None, ALL_TYPES, "101")


@query("q14_scope_filter", """
SELECT * FROM vertices WHERE geography_l1 = 'AFRICA' OR geography_l2 = 'NATION_9' OR domain = 'BUILDING'""",
       views=("vertices",))
def q14_scope_filter(fx):
    """Q14: area-of-authority filter from a scope table derived from region/nation/segment."""
    r = fx.t("region").filter(F.col("r_name") == "AFRICA").select(
        F.lit("geography_l1").alias("column"), F.col("r_name").alias("value"))
    n = fx.t("nation").filter(F.col("n_nationkey") == 9).select(
        F.lit("geography_l2").alias("column"), F.col("n_name").alias("value"))
    c = fx.t("customer").filter(F.col("c_mktsegment") == "BUILDING").select(
        F.lit("domain").alias("column"), F.col("c_mktsegment").alias("value")).distinct()
    return Q.scope_filter(fx.vertices(), r.unionByName(n).unionByName(c))


@query("q14_scope_by_number", """
SELECT * FROM vertices WHERE pop_id = 1004 OR device_level = 1 OR is_deleted""", views=("vertices",))
def q14_scope_by_number(fx):
    """Q14: rules on columns that hold no text."""
    n = fx.t("nation").filter(F.col("n_nationkey") == 4).select(
        F.lit("pop_id").alias("column"), (F.col("n_nationkey") + 1000).cast("string").alias("value"))
    rest = fx.t("region").limit(1).select(F.inline(F.array(
        F.struct(F.lit("device_level").alias("column"), F.lit("1").alias("value")),
        F.struct(F.lit("is_deleted").alias("column"), F.lit("true").alias("value")))))
    return Q.scope_filter(fx.vertices(), n.unionByName(rest))


@query("q15_by_property", """
SELECT ne_name, ne_type, vendor, ipv4 FROM vertices WHERE vendor = 'JUNIPER'""", views=("vertices",))
def q15_by_property(fx):
    """Q15: all vertices with vendor JUNIPER, selected fields."""
    return Q.by_property(fx.vertices(), "vendor", "JUNIPER", ["ne_name", "ne_type", "vendor", "ipv4"])


@query("q16_has_coordinates", f"SELECT * FROM vertices WHERE {HAS_XY_STRICT}", views=("vertices",))
def q16_has_coordinates(fx):
    """Q16 strict: vertices whose coordinates both parse as double."""
    return Q.with_coordinates(fx.vertices(), strict=True)

