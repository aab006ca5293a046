"""Registered filtered-read / count / aggregate queries (A1–A10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import stats as A
from ..operators.subgraph import names_df
from .catalog import query
from .sqlparts import HAS_XY


@query("a1_map_filter", """
SELECT * FROM vertices WHERE ne_type IN ('ROUTER', 'SWITCH') AND vendor = 'HUAWEI'""", views=("vertices",))
def a1_map_filter(fx):
    """A1: ne_type IN (ROUTER, SWITCH) AND vendor = HUAWEI; blank filters ignored."""
    return A.map_filter(fx.vertices(), {"ne_type": "ROUTER,SWITCH", "vendor": "HUAWEI", "domain": " "})


@query("a2_topology_detail_vertex", f"""
SELECT * FROM vertices WHERE {HAS_XY} AND domain IN ('AUTOMOBILE', 'MACHINERY')
ORDER BY ne_name, relation LIMIT 100 OFFSET 50""", views=("vertices",))
def a2_topology_detail_vertex(fx):
    """A2 vertex mode: filtered vertices with coordinates, rows [50, 150) by key."""
    return A.topology_detail(fx.vertices(), fx.edges(), "vertex",
                             {"domain": "AUTOMOBILE,MACHINERY"}, 50, 150)


@query("a2_topology_detail_edge", """
SELECT * FROM edges WHERE relation = 'ISIS' AND tag = '3-MEDIUM'
ORDER BY src_interface, dest_interface, relation, link_type_key LIMIT 200 OFFSET 1000""", views=("edges",))
def a2_topology_detail_edge(fx):
    """A2 edge mode: ISIS 3-MEDIUM links, rows [1000, 1200) by edge key."""
    return A.topology_detail(fx.vertices(), fx.edges(), "edge", {"relation": "ISIS", "tag": "3-MEDIUM"},
                             1000, 1200)


@query("a3_topology_detail_count", f"""
SELECT count(*) AS total FROM vertices WHERE {HAS_XY} AND ne_type = 'SWITCH'""", views=("vertices",))
def a3_topology_detail_count(fx):
    """A3: count of switches with coordinates."""
    return A.topology_detail_count(fx.vertices(), fx.edges(), "vertex", {"ne_type": "SWITCH"})


@query("a4_topology_data_count", """
SELECT count(*) AS total FROM vertices WHERE TRY_CAST(CAST(latitude AS VARCHAR) AS DOUBLE) IS NOT NULL
  AND TRY_CAST(CAST(longitude AS VARCHAR) AS DOUBLE) IS NOT NULL AND vendor IN ('CISCO', 'ARISTA')""",
       views=("vertices",))
def a4_topology_data_count(fx):
    """A4: strict-coordinate count of CISCO/ARISTA vertices."""
    return A.topology_detail_count(fx.vertices(), fx.edges(), "vertex", {"vendor": "CISCO,ARISTA"}, strict=True)


def _geo_sql(col: str, where: str = "") -> str:
    return f"""
SELECT {col} AS geo_name, count(*) AS count,
  arg_min(latitude, ne_name) FILTER (WHERE {HAS_XY}) AS latitude,
  arg_min(longitude, ne_name) FILTER (WHERE {HAS_XY}) AS longitude
FROM vertices WHERE {col} IS NOT NULL {where} GROUP BY {col}"""


@query("a5_count_by_geography", _geo_sql("geography_l3"), views=("vertices",))
def a5_count_by_geography(fx):
    """A5: vertex count per city (L3) with a representative coordinate."""
    return A.count_by_geography(fx.vertices(), "L3")


@query("a5_count_by_region", _geo_sql("geography_l1"), views=("vertices",))
def a5_count_by_region(fx):
    """A5: vertex count per region (L1)."""
    return A.count_by_geography(fx.vertices(), "L1")


@query("a6_count_by_geography_box", _geo_sql(
    "geography_l2", "AND upper(ne_type) IN ('SWITCH') AND latitude > -30 AND latitude < 45 "
    "AND longitude > -100 AND longitude < 120"), views=("vertices",))
def a6_count_by_geography_box(fx):
    """Switch count per nation (L2) inside a strict box."""
    return A.count_by_geography(fx.vertices(), "L2", "SWITCH", (-30, 45, -100, 120))


@query("a6_count_total_box", """
SELECT count(*) AS count FROM vertices WHERE latitude > -30 AND latitude < 45
  AND longitude > -100 AND longitude < 120""", views=("vertices",))
def a6_count_total_box(fx):
    """A6 with an empty type list: single total inside the box."""
    return A.count_by_geography(fx.vertices(), "L2", "", (-30, 45, -100, 120))


@query("a7_max_modification_time", """
SELECT coalesce(strftime(greatest(max(last_discovery_ts), max(modified_ts)), '%Y-%m-%d %H:%M:%S'), '')
  AS max_modification_time FROM link_rows""", views=("link_rows",))
def a7_max_modification_time(fx):
    """Newest discovery / modify time over all link rows."""
    return A.max_modification_time(fx.link_rows(), ["last_discovery_ts", "modified_ts"])


@query("a8_geo_counts_with_labels", """
SELECT geography_l1, geography_l2, geography_l3, count(*) AS count FROM vertices
WHERE geography_l3 IS NOT NULL GROUP BY geography_l1, geography_l2, geography_l3""", views=("vertices",))
def a8_geo_counts_with_labels(fx):
    """Counts per city with region and nation labels."""
    return A.geo_counts_with_labels(fx.vertices(), "L3")


_NAMES_N5 = "SELECT ne_name FROM vertices WHERE geography_l2 = 'NATION_5'"


@query("a9_distinct_link_types", f"""
SELECT DISTINCT link_type FROM (
  SELECT link_type FROM edges WHERE start_ne IN ({_NAMES_N5})
  UNION ALL SELECT link_type FROM edges WHERE end_ne IN ({_NAMES_N5})) z WHERE link_type IS NOT NULL""",
       views=("vertices", "edges"))
def a9_distinct_link_types(fx):
    """Distinct link types of NATION_5 elements' links."""
    names = names_df(fx.vertices().filter(F.col("geography_l2") == "NATION_5"))
    return A.distinct_link_types(fx.edges(), names)


@query("a10_distinct_protocols", f"""
SELECT DISTINCT relation AS protocol FROM (
  SELECT relation FROM edges WHERE link_type = 'O' AND start_ne IN ({_NAMES_N5})
  UNION ALL SELECT relation FROM edges WHERE link_type = 'O' AND end_ne IN ({_NAMES_N5})) z""",
       views=("vertices", "edges"))
def a10_distinct_protocols(fx):
    """A10: distinct protocols of NATION_5 elements' links of link type O."""
    names = names_df(fx.vertices().filter(F.col("geography_l2") == "NATION_5"))
    return A.distinct_protocols(fx.edges(), names, "O")
