"""Registered second-vocabulary sub-graph queries (X8–X23) with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..operators import subgraph as X
from .catalog import query
from .q_ingest import LIVE_HOPS
from .sqlparts import EDGE_COLS, nodes_of

PORT = "regexp_replace({c}, '^.*_', '')"
SP, DP = PORT.format(c="src_interface"), PORT.format(c="dest_interface")
CAT = "CASE WHEN relation = 'LLDP' THEN 'PHYSICAL' ELSE 'LOGICAL' END"


@query("x8_neighbours", f"""
SELECT e.src_interface, e.dest_interface, e.relation, e.link_type_key, e.start_ne, e.end_ne,
  {SP} AS src_port, {DP} AS dest_port, {CAT.replace("relation", "e.relation")} AS connection_category, s.ne_type AS src_type, d.ne_type AS dest_type,
  coalesce(s.geography_l3, '') AS src_city, coalesce(d.geography_l3, '') AS dest_city, d.hostname AS dest_alias
FROM edges e JOIN vertices s ON e.start_ne = s.ne_name JOIN vertices d ON e.end_ne = d.ne_name
WHERE (e.start_ne = 'Supplier#000000005' OR e.end_ne = 'Supplier#000000005')
  AND NOT (s.ne_type <> 'SWITCH' AND d.ne_type = 'SWITCH' AND coalesce(d.mw_type, '') = 'MICROWAVE')""",
       views=("edges", "vertices"))
def x8_neighbours(fx):
    """Links of Supplier#000000005 with both ends, minus router->microwave-switch links."""
    return X.neighbours(fx.vertices(), fx.edges(), "Supplier#000000005", access_type="SWITCH")


@query("x8_neighbours_physical", f"""
SELECT e.src_interface, e.dest_interface, e.relation, e.link_type_key, e.start_ne, e.end_ne,
  {SP} AS src_port, {DP} AS dest_port, {CAT.replace("relation", "e.relation")} AS connection_category, s.ne_type AS src_type, d.ne_type AS dest_type,
  coalesce(s.geography_l3, '') AS src_city, coalesce(d.geography_l3, '') AS dest_city, d.hostname AS dest_alias
FROM edges e JOIN vertices s ON e.start_ne = s.ne_name JOIN vertices d ON e.end_ne = d.ne_name
WHERE (e.start_ne = 'Customer#000000075' OR e.end_ne = 'Customer#000000075') AND e.relation = 'LLDP'
  AND NOT (s.ne_type <> 'ENODEB' AND d.ne_type = 'ENODEB' AND coalesce(d.mw_type, '') = 'MICROWAVE')""",
       views=("edges", "vertices"))
def x8_neighbours_physical(fx):
    """X8 with category PHYSICAL for a switch."""
    return X.neighbours(fx.vertices(), fx.edges(), "Customer#000000075", category="physical")


@query("x9_connections_by_type", """
WITH v AS (SELECT ne_name, ne_type FROM vertices WHERE upper(ne_type) IN ('ROUTER')),
c AS (SELECT * FROM edges WHERE upper(relation) IN ('ISIS') AND start_ne IN (SELECT ne_name FROM v)),
n AS (SELECT start_ne, count(*) AS n FROM c GROUP BY start_ne)
SELECT v.ne_name, v.ne_type, c.end_ne, c.relation, c.src_interface, c.dest_interface,
  coalesce(n.n, 0) AS n_connections
FROM v LEFT JOIN c ON v.ne_name = c.start_ne LEFT JOIN n ON v.ne_name = n.start_ne""", views=("edges", "vertices"))
def x9_connections_by_type(fx):
    """Every router with its outgoing ISIS connections, one row each."""
    return X.connections_by_type(fx.vertices(), fx.edges(), "ROUTER", "ISIS")


_CITY = """
WITH names AS (SELECT ne_name FROM vertices WHERE geography_l3 = 'NATION_5_CITY1'),
l AS (SELECT * FROM edges WHERE start_ne IN (SELECT ne_name FROM names) OR end_ne IN (SELECT ne_name FROM names))
"""


@query("x10_city_links", _CITY + "SELECT * FROM l", views=("edges", "vertices"))
def x10_city_links(fx):
    """Links touching the elements of city NATION_5_CITY1."""
    links, _ = X.city_topology(fx.vertices(), fx.edges(), "NATION_5_CITY1")
    return links


@query("x10_city_nodes", _CITY + nodes_of("l", "names"), views=("edges", "vertices"))
def x10_city_nodes(fx):
    """The city's elements and the far ends, with coordinates."""
    _, nodes = X.city_topology(fx.vertices(), fx.edges(), "NATION_5_CITY1")
    return nodes


_ADJ = f"""
WITH both_dir AS (
  SELECT start_ne AS ne_name, end_ne AS neighbour, {SP} AS port, {DP} AS neighbour_port, relation FROM edges
  UNION ALL SELECT end_ne, start_ne, {DP}, {SP}, relation FROM edges),
adj AS (SELECT ne_name, lower(neighbour) AS neighbour_key, min(neighbour) AS neighbour,
          array_to_string(list_sort(list(DISTINCT port)), ',') AS ports,
          array_to_string(list_sort(list(DISTINCT neighbour_port)), ',') AS neighbour_ports, count(*) AS n_links
        FROM both_dir WHERE ne_name IN (SELECT ne_name FROM vertices WHERE NOT is_deleted)
        GROUP BY ne_name, lower(neighbour))
"""


def _adj(fx):
    a = X.adjacency(fx.vertices(), fx.edges())
    return (a.withColumn("ports", F.array_join("ports", ","))
            .withColumn("neighbour_ports", F.array_join("neighbour_ports", ",")))


@query("x11_adjacency", _ADJ + "SELECT * FROM adj", views=("edges", "vertices"))
def x11_adjacency(fx):
    """X11: whole-graph adjacency of live elements with ports and link counts."""
    return _adj(fx)


@query("x12_filtered_adjacency", _ADJ + """
SELECT ne_name, neighbour, n_links FROM adj WHERE starts_with(ne_name, 'Supplier') AND n_links >= 2""",
       views=("edges", "vertices"))
def x12_filtered_adjacency(fx):
    """routers' neighbours reached over at least two links (projection of X11)."""
    return _adj(fx).filter(F.col("ne_name").startswith("Supplier") & (F.col("n_links") >= 2)).select(
        "ne_name", "neighbour", "n_links")


_CRIT = """
WITH v AS (SELECT * FROM vertices WHERE vendor = 'NOKIA' AND ne_type = 'ROUTER'),
e AS (SELECT * FROM edges WHERE relation = 'OSPF'),
l AS (SELECT * FROM e WHERE start_ne IN (SELECT ne_name FROM v) OR end_ne IN (SELECT ne_name FROM v))
"""


def _crit(fx):
    return X.criteria(fx.vertices(), fx.edges(), "BOTH_E_BY_V",
                      (F.col("vendor") == "NOKIA") & (F.col("ne_type") == "ROUTER"),
                      F.col("relation") == "OSPF", drop_isolated=True)


@query("x13_criteria_links", _CRIT + "SELECT * FROM l", views=("edges", "vertices"))
def x13_criteria_links(fx):
    """X13 BOTH_E_BY_V: OSPF links of NOKIA routers."""
    links, _ = _crit(fx)
    return links


@query("x13_criteria_nodes", _CRIT + """
SELECT * FROM v WHERE ne_name IN (SELECT start_ne FROM l UNION SELECT end_ne FROM l)""",
       views=("edges", "vertices"))
def x13_criteria_nodes(fx):
    """X13 BOTH_E_BY_V with drop flag: NOKIA routers having such links."""
    _, nodes = _crit(fx)
    return nodes


_ONLY = "WITH v AS (SELECT * FROM vertices WHERE vendor = 'NOKIA'), e AS (SELECT * FROM edges WHERE relation = 'OSPF') "


def _mode(fx, mode: str):
    return X.criteria(fx.vertices(), fx.edges(), mode, F.col("vendor") == "NOKIA", F.col("relation") == "OSPF")


@query("x13_vertex_mode", _ONLY + "SELECT * FROM v", views=("edges", "vertices"))
def x13_vertex_mode(fx):
    """X13 VERTEX: NOKIA elements only."""
    return _mode(fx, "VERTEX")[1]


@query("x13_edge_mode", _ONLY + "SELECT * FROM e", views=("edges", "vertices"))
def x13_edge_mode(fx):
    """X13 EDGE: OSPF links only."""
    return _mode(fx, "EDGE")[0]


@query("x13_both_mode", _ONLY + """
SELECT 'link' AS kind, src_interface || '#' || dest_interface || '#' || link_type_key AS id FROM e
UNION ALL SELECT 'node', ne_name FROM v""", views=("edges", "vertices"))
def x13_both_mode(fx):
    """X13 BOTH: OSPF links and NOKIA elements, each by its own filter."""
    links, nodes = _mode(fx, "BOTH")
    return (links.select(F.lit("link").alias("kind"),
                         F.concat_ws("#", "src_interface", "dest_interface", "link_type_key").alias("id"))
            .unionByName(nodes.select(F.lit("node").alias("kind"), F.col("ne_name").alias("id"))))


def _direct_sql(a: str, b: str) -> str:
    return f"""
WITH e AS (SELECT *, {SP} AS src_port, {DP} AS dest_port FROM edges WHERE NOT is_deleted),
both_dir AS (SELECT *, 0 AS o FROM e WHERE start_ne = '{a}' AND end_ne = '{b}'
             UNION ALL SELECT *, 1 FROM e WHERE start_ne = '{b}' AND end_ne = '{a}'),
chosen AS (SELECT * FROM both_dir WHERE o = (SELECT min(o) FROM both_dir)),
out AS (SELECT CASE WHEN o = 1 THEN end_ne ELSE start_ne END AS source,
          CASE WHEN o = 1 THEN start_ne ELSE end_ne END AS destination,
          CASE WHEN o = 1 THEN dest_port ELSE src_port END AS source_port,
          CASE WHEN o = 1 THEN src_port ELSE dest_port END AS destination_port, relation, link_type_key,
          CASE WHEN o = 1 THEN 'BACKWARD_TRUE' ELSE 'FORWARD_TRUE' END AS orientation FROM chosen)
SELECT out.*, s.domain AS source_domain, s.vendor AS source_vendor, d.domain AS destination_domain,
  d.vendor AS destination_vendor
FROM out LEFT JOIN vertices s ON out.source = s.ne_name LEFT JOIN vertices d ON out.destination = d.ne_name"""


@query("x14_direct_links_forward", _direct_sql("Supplier#000000005", "Customer#000000681"),
       views=("edges", "vertices"))
def x14_direct_links_forward(fx):
    """Direct links Supplier#000000005 -> Customer#000000681."""
    return X.direct_links(fx.edges(), fx.vertices(), "Supplier#000000005", "Customer#000000681")


@query("x14_direct_links_backward", _direct_sql("Supplier#000000040", "Customer#000000075"),
       views=("edges", "vertices"))
def x14_direct_links_backward(fx):
    """X14 fallback: no Supplier#000000040 -> Customer#000000075 link, so the reverse ones, swapped."""
    return X.direct_links(fx.edges(), fx.vertices(), "Supplier#000000040", "Customer#000000075")


@query("x15_bundle_ports", f"""
WITH e AS (SELECT *, {SP} AS src_port, {DP} AS dest_port FROM edges
           WHERE start_ne = 'Supplier#000000005' AND end_ne = 'Customer#000000681')
SELECT 'SOURCE' AS side, coalesce(src_port, '') AS port, relation, link_type_key FROM e WHERE src_port = '5'
UNION ALL
SELECT 'DESTINATION', coalesce(dest_port, ''), relation, link_type_key FROM e WHERE dest_port = '5'""",
       views=("edges",))
def x15_bundle_ports(fx):
    """Ports of bundle link 'Supplier#000000005_5#Customer#000000681_5'."""
    return X.bundle_ports(fx.edges(), "Supplier#000000005_5#Customer#000000681_5")


@query("x16_edges_by_keys", """
SELECT src_interface, dest_interface, relation, link_type_key, start_ne, end_ne, bandwidth FROM edges
WHERE tag = '4-NOT SPECIFIED' AND relation = 'LLDP' AND bandwidth >= 45""", views=("edges",))
def x16_edges_by_keys(fx):
    """Edges selected by a key set (high-bandwidth unspecified LLDP links), chosen fields."""
    e = fx.edges()
    keys = e.filter((F.col("tag") == "4-NOT SPECIFIED") & (F.col("relation") == "LLDP") & (F.col("bandwidth") >= 45))
    return X.edges_by_keys(e, keys, S.EDGE_KEY + ["start_ne", "end_ne", "bandwidth"])


@query("x17_by_ring_links", "SELECT * FROM edges WHERE area_ip_address = '10.9.0.0'", views=("edges",))
def x17_by_ring_links(fx):
    """Links of ring (area) 10.9.0.0."""
    links, _ = X.by_ring(fx.vertices(), fx.edges(), "area_ip_address", "10.9.0.0")
    return links


@query("x17_by_ring_nodes", f"""
WITH l AS (SELECT * FROM edges WHERE area_ip_address = '10.9.0.0') {nodes_of('l')}""",
       views=("edges", "vertices"))
def x17_by_ring_nodes(fx):
    """Nodes of ring 10.9.0.0."""
    _, nodes = X.by_ring(fx.vertices(), fx.edges(), "area_ip_address", "10.9.0.0")
    return nodes


_BOX = "device_level = 4 AND latitude BETWEEN -40 AND 40 AND longitude BETWEEN -60 AND 60"


@query("x18_view_port_nodes", f"SELECT * FROM vertices WHERE {_BOX}", views=("vertices",))
def x18_view_port_nodes(fx):
    """Switches inside a view port."""
    _, nodes = X.by_view_port(fx.vertices(), fx.edges(), 4, -40, 40, -60, 60)
    return nodes


@query("x18_view_port_links", f"""
WITH n AS (SELECT ne_name FROM vertices WHERE {_BOX})
SELECT * FROM edges WHERE start_ne IN (SELECT ne_name FROM n) AND end_ne IN (SELECT ne_name FROM n)""",
       views=("vertices", "edges"))
def x18_view_port_links(fx):
    """Links between the view port's switches."""
    links, _ = X.by_view_port(fx.vertices(), fx.edges(), 4, -40, 40, -60, 60)
    return links


_BOTH_LEVELS = _BOX.replace("device_level = 4", "device_level IN (3, 4)")


@query("x18_view_port_links_two_levels", f"""
WITH n AS (SELECT ne_name FROM vertices WHERE {_BOTH_LEVELS})
SELECT * FROM edges WHERE start_ne IN (SELECT ne_name FROM n) AND end_ne IN (SELECT ne_name FROM n)""",
       views=("vertices", "edges"))
def x18_view_port_links_two_levels(fx):
    """Links between the view port's routers and switches."""
    links, _ = X.by_view_port(fx.vertices(), fx.edges(), [3, 4], -40, 40, -60, 60)
    return links


@query("x19_range_read", f"""
SELECT {EDGE_COLS} FROM edges WHERE relation = 'ISIS'
ORDER BY src_interface, dest_interface, relation, link_type_key LIMIT 100 OFFSET 500""", views=("edges",))
def x19_range_read(fx):
    """ISIS links 500..599 in key order."""
    return X.range_read(fx.edges().filter(F.col("relation") == "ISIS"), S.EDGE_KEY, 500, 100)


_LOGICAL = f"""
SELECT e.src_interface, e.dest_interface, e.relation, e.link_type_key, e.start_ne, e.end_ne,
  {SP.replace('src_interface', 'e.src_interface')} AS src_port, {DP.replace('dest_interface', 'e.dest_interface')} AS dest_port,
  s.geography_l3 AS src_site, d.geography_l3 AS dest_site, s.ne_type AS src_ne_type, d.ne_type AS dest_ne_type,
  '{{n}}' AS element, CASE WHEN e.start_ne = '{{n}}' THEN e.end_ne ELSE e.start_ne END AS peer,
  CASE WHEN d.device_level <= 3 THEN 'PRIMARY' ELSE 'SECONDARY' END AS node_priority
FROM edges e LEFT JOIN vertices s ON e.start_ne = s.ne_name LEFT JOIN vertices d ON e.end_ne = d.ne_name
WHERE (e.start_ne = '{{n}}' OR e.end_ne = '{{n}}') AND e.relation <> 'LLDP'"""


@query("x20_logical_connectivity", _LOGICAL.format(n="Supplier#000000009"), views=("edges", "vertices"))
def x20_logical_connectivity(fx):
    """Logical links of Supplier#000000009 with both ends' site and type."""
    return X.logical_connectivity(fx.vertices(), fx.edges(), "Supplier#000000009")


@query("x21_primary_nodes", "SELECT * FROM (" + _LOGICAL.format(n="Customer#000000075")
       + ") z WHERE node_priority = 'PRIMARY'", views=("edges", "vertices"))
def x21_primary_nodes(fx):
    """Logical links of Customer#000000075 towards PRIMARY elements."""
    return X.primary_nodes(fx.vertices(), fx.edges(), "Customer#000000075")


_SRV = """
WITH names AS (SELECT ne_name FROM vertices WHERE ne_name = 'Customer#000000010' AND NOT is_deleted),
l AS (SELECT * FROM edges WHERE (start_ne IN (SELECT ne_name FROM names) OR end_ne IN (SELECT ne_name FROM names))
      AND ((src_type = 'SWITCH' AND dest_type = 'ROUTER') OR (src_type = 'ROUTER' AND dest_type = 'SWITCH')
           OR relation <> 'LLDP'))
"""


@query("x22_server_switch_links", _SRV + "SELECT * FROM l", views=("edges", "vertices"))
def x22_server_switch_links(fx):
    """Switch Customer#000000010's switch-router and logical links."""
    links, _ = X.server_switch(fx.vertices(), fx.edges(), "Customer#000000010")
    return links


@query("x22_server_switch_nodes", _SRV + nodes_of("l", "names"), views=("edges", "vertices"))
def x22_server_switch_nodes(fx):
    """End nodes of those links."""
    _, nodes = X.server_switch(fx.vertices(), fx.edges(), "Customer#000000010")
    return nodes


@query("x23_owner_enrich", """
SELECT e.*, v.domain AS owner_domain, v.vendor AS owner_vendor FROM edges e JOIN vertices v ON e.start_ne = v.ne_name""",
       views=("edges", "vertices"))
def x23_owner_enrich(fx):
    """Every link with its source element's domain and vendor."""
    return X.owner_enrich(fx.edges(), fx.vertices())


_LSP_NAME = "LSP_359"  # of live and deleted hops
_LSP_LINKS = f"""
WITH port AS (SELECT e.*, up.ne_name AS up_name FROM network_element e
              LEFT JOIN network_element up ON up.id = e.parent_ne_id_fk WHERE e.is_deleted = 0),
hop AS ({LIVE_HOPS} WHERE t.lsp_name = '{_LSP_NAME}'),
l AS (
SELECT 'LSP' AS relation, hop.lsp_name, hop.lsp_id, hop.hop_sequence, near.ne_name AS src_interface,
  far.ne_name AS dest_interface, near.up_name AS start_ne, far.up_name AS end_ne
FROM hop JOIN hop nxt ON nxt.lsp_id = hop.lsp_id AND nxt.hop_sequence = hop.hop_sequence + 1
JOIN port near ON near.id = hop.interface_ne_id JOIN port far ON far.id = nxt.interface_ne_id)
"""


def _x6(fx):
    from ..operators.ingest import lsp_hop_edges
    e = lsp_hop_edges(fx.lsp(), fx.lsp_hop(), fx.network_element())
    return X.by_lsp_name(fx.vertices(), e, _LSP_NAME)


@query("x6_lsp_links", _LSP_LINKS + """
SELECT relation, lsp_name, lsp_id, hop_sequence, src_interface, dest_interface, start_ne, end_ne FROM l""",
       views=("network_element", "lsp", "lsp_hop", "vertices"))
def x6_lsp_links(fx):
    """Hop links of one LSP, live hops only."""
    links, _ = _x6(fx)
    return links.select("relation", "lsp_name", "lsp_id", "hop_sequence", "src_interface", "dest_interface",
                        "start_ne", "end_ne")


@query("x6_lsp_nodes", _LSP_LINKS + nodes_of("l"), views=("network_element", "lsp", "lsp_hop", "vertices"))
def x6_lsp_nodes(fx):
    """Routers on that LSP (with coordinates)."""
    _, nodes = _x6(fx)
    return nodes

