"""Registered ingestion queries (I1–I14) with DuckDB twins.

The twins are put together from two things: named row sets (live elements, the
ends of links, an element with the one above it) and column tables that say for
each output column which row set and column it comes from.
"""

from __future__ import annotations

from ..operators import ingest as I
from .catalog import query

INV = ("network_element", "ne_location", "geo_l1", "geo_l2", "geo_l3", "geo_l4")

# ------------------------------------------------------------------ named row sets
#: an element and, beside it, the one above it (its parent), as ``up_*``
WITH_PARENT = """
  SELECT x.*, up.ne_name AS up_name, up.ne_type AS up_type, up.ne_category AS up_category,
    up.vendor AS up_vendor, up.technology AS up_technology, up.domain AS up_domain,
    up.latitude AS up_lat, up.longitude AS up_long, up.is_deleted AS up_deleted, up.id AS up_id
  FROM network_element x LEFT JOIN network_element up ON up.id = x.parent_ne_id_fk"""

#: a location with the names of its four geography levels
PLACES = """
  SELECT n.id AS place_id, n.nel_id, n.nel_code, n.friendly_name AS place_name, """ + ", ".join(
    f"g{i}.geo_name AS level_{i}" for i in range(1, 5)) + """
  FROM ne_location n """ + " ".join(
    f"LEFT JOIN geo_l{i} g{i} ON g{i}.id = n.geography_l{i}_id_fk" for i in range(1, 5))


def link_ends(table: str, kept: str) -> str:
    """One row per end of each link: the interface and what is kept of the link."""
    return " UNION ALL ".join(f"SELECT {end}_interface_ne_id AS end_id, {kept} FROM {table}"
                              for end in ("source", "destination"))


# ------------------------------------------------------------------ column tables
def columns(**by_source: str) -> str:
    """``alias="out=column same ..."``: SELECT list, ``out`` from ``alias.column``."""
    out = []
    for alias, spec in by_source.items():
        for item in spec.split():
            name, _, column = item.partition("=")
            out.append(f"{alias}.{column or name} AS {name}")
    return ", ".join(out)


IDENTITY = " ".join(I.IDENTITY)
STATE = "id ne_name ne_source ne_status ne_type ckt_id is_deleted ne_id ipv4 "
LIVE = "WHERE is_deleted = 0"


# ------------------------------------------------------------------ elements
def element_rows(keep: str, place: str) -> str:
    return f"""
WITH place AS ({PLACES}), related AS ({WITH_PARENT})
SELECT 'VERTEX' AS relation, {columns(
        me=STATE + "source last_discovery_ts=last_discovery_time latitude longitude ne_category vendor "
        "technology domain hostname parent_ne=up_name " + IDENTITY,
        spot="pop_id=nel_id geography_l1=level_1 geography_l2=level_2 geography_l3=level_3 geography_l4=level_4 "
        + place,
        peer="neighbour_ne_id=ne_id neighbour_ne_name=ne_name neighbour_ne_lat=latitude "
        "neighbour_ne_long=longitude neighbour_parent_ne_name=up_name neighbour_parent_ne_lat=up_lat "
        "neighbour_parent_ne_long=up_long")}{", me.modified_time AS ne_modify_ts" if "pop_code" not in place else ""}
FROM (SELECT * FROM related {LIVE} AND {keep}) me
LEFT JOIN place spot ON spot.place_id = me.ne_location_id_fk
LEFT JOIN related peer ON peer.id = me.network_element_id_fk"""


def _in(column: str, values: list[str]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


PARENTS = f"{_in('ne_type', I.PARENT_NE_TYPES)} AND {_in('ne_category', I.PARENT_NE_CATEGORIES)}"
CODE_AND_NAME = "pop_code=nel_code pop_name=place_name"


def _inv(fx):
    return fx.network_element(), fx.ne_location(), [fx.geo(i) for i in range(1, 5)]


@query("i1_parent_vertices", element_rows(PARENTS, CODE_AND_NAME), views=INV)
def i1_parent_vertices(fx):
    """Live parent elements with location, geography, parent and neighbour."""
    ne, loc, geo = _inv(fx)
    return I.parent_vertices(ne, loc, geo)


@query("i2_parent_vertices_sdn", element_rows(PARENTS + " AND source = 'SDN'", CODE_AND_NAME), views=INV)
def i2_parent_vertices_sdn(fx):
    """I1 restricted to SDN-sourced elements."""
    ne, loc, geo = _inv(fx)
    return I.parent_vertices(ne, loc, geo, source="SDN")


@query("i3_parent_vertices_switch",
       element_rows("ne_type = 'SWITCH' AND ne_category = 'SWITCH'", "pop_name=nel_code"), views=INV)
def i3_parent_vertices_switch(fx):
    """Live switches, pop code as pop name, with modify time."""
    ne, loc, geo = _inv(fx)
    return I.parent_vertices(ne, loc, geo, switch=True)


# ------------------------------------------------------------------ interfaces at link ends
def interface_rows(table: str, relation: str, above: str) -> str:
    from_link = relation in ("LLDP", "LLDPSWITCH")  # these name the interface's host by the link
    times = "link_modify_ts=modified_time" if relation == "LLDPSWITCH" else ""
    return f"""
WITH at_end AS ({link_ends(table, "last_discovery_time, link_name, modified_time")}), related AS ({WITH_PARENT})
SELECT DISTINCT '{relation}' AS relation, {columns(
        port=STATE + "latitude longitude bandwidth=capacity parent_ne=up_name " + IDENTITY
        + (" if_modify_ts=modified_time" if times else "") + ("" if from_link else " hostname"),
        at_end="last_discovery_ts=last_discovery_time " + ("hostname=link_name " if from_link else "") + times)}
FROM at_end JOIN related port ON port.id = at_end.end_id
WHERE port.up_deleted = 0 AND '{above}' IN (port.up_type, port.up_category)"""


@query("i4_interface_vertices_lldp", interface_rows("lldp_link", "LLDP", "ROUTER"),
       views=("network_element", "lldp_link"))
def i4_interface_vertices_lldp(fx):
    """I4: interfaces at either end of LLDP links under a live router."""
    return I.interface_vertices(fx.network_element(), fx.link_table("LLDP"), "LLDP")


@query("i5_interface_vertices_ospf", interface_rows("ospf_link", "OSPF", "ROUTER"),
       views=("network_element", "ospf_link"))
def i5_interface_vertices_ospf(fx):
    """Interfaces at either end of OSPF links under a live router."""
    return I.interface_vertices(fx.network_element(), fx.link_table("OSPF"), "OSPF")


@query("i6_interface_vertices_isis", f"""
WITH complete AS (SELECT * FROM isis_link WHERE source_ne_id IN (SELECT id FROM network_element)
                    AND destination_ne_id IN (SELECT id FROM network_element)),
at_end AS ({link_ends("complete", "last_discovery_time, uuid")})
SELECT DISTINCT 'ISIS' AS relation, {columns(
    port=STATE.replace("ckt_id ", "") + "bandwidth hostname "
    + " ".join(c for c in I.IDENTITY if c != "uuid"),
    at_end="last_discovery_ts=last_discovery_time uuid")}
FROM at_end JOIN (SELECT * FROM network_element {LIVE} AND ne_type = 'INTERFACE') port ON port.id = at_end.end_id""",
       views=("network_element", "isis_link"))
def i6_interface_vertices_isis(fx):
    """Live interfaces of ISIS links whose two router ends exist."""
    return I.interface_vertices_isis(fx.network_element(), fx.link_table("ISIS"))


@query("i7_interface_vertices_switch", interface_rows("lldp_link", "LLDPSWITCH", "SWITCH"),
       views=("network_element", "lldp_link"))
def i7_interface_vertices_switch(fx):
    """Interfaces at either end of LLDP links under a live switch."""
    return I.interface_vertices(fx.network_element(), fx.link_table("LLDP"), "LLDPSWITCH", "SWITCH")


# ------------------------------------------------------------------ link rows
def neighbour_link_rows(relation: str, also: str = "true") -> str:
    times = relation == "LLDPSWITCH"
    return f"""
WITH port AS (SELECT * FROM ({WITH_PARENT}) p {LIVE}), wire AS (SELECT * FROM lldp_link {LIVE})
SELECT '{relation}' AS relation, {columns(
        near=STATE + "latitude=up_lat longitude=up_long src_bandwidth=capacity src_type=up_type "
        "src_category=up_category src_vendor=up_vendor src_technology=up_technology src_domain=up_domain "
        "parent_ne=up_name " + IDENTITY + (" if_modify_ts=modified_time" if times else ""),
        far="dest_bandwidth=capacity dest_type=up_type dest_category=up_category dest_vendor=up_vendor "
        "dest_technology=up_technology dest_domain=up_domain neighbour_ne_id=ne_id neighbour_ne_name=ne_name "
        "neighbour_ne_lat=latitude neighbour_ne_long=longitude neighbour_parent_ne_name=up_name "
        "neighbour_parent_ne_lat=up_lat neighbour_parent_ne_long=up_long",
        wire="last_discovery_ts=last_discovery_time hostname=link_name"
        + (" link_modify_ts=modified_time" if times else ""))}
FROM wire JOIN port near ON near.id = wire.source_interface_ne_id
JOIN port far ON far.id = wire.destination_interface_ne_id
WHERE {also}"""


@query("i8_link_rows_lldp", neighbour_link_rows("LLDP"), views=("network_element", "lldp_link"))
def i8_link_rows_lldp(fx):
    """I8: LLDP link rows with both interfaces and parents."""
    return I.link_rows_lldp(fx.network_element(), fx.link_table("LLDP"))


@query("i11_link_rows_switch", neighbour_link_rows(
    "LLDPSWITCH", "'SWITCH' IN (near.up_type, far.up_type) AND near.up_type IN ('SWITCH', 'ROUTER') "
    "AND far.up_type IN ('SWITCH', 'ROUTER')"), views=("network_element", "lldp_link"))
def i11_link_rows_switch(fx):
    """LLDP link rows touching a switch (switch-switch or switch-router)."""
    return I.link_rows_lldp(fx.network_element(), fx.link_table("LLDP"), "LLDPSWITCH", switch_rule=True)


def routed_link_rows(table: str, relation: str, size: str, own: str) -> str:
    """Router values first and interface values behind them, but the other way round for the
    place of the neighbour interface."""
    kinds = {"type": "ne_type", "category": "ne_category", "vendor": "vendor",
             "technology": "technology", "domain": "domain"}
    ends = [f"coalesce({router}.{c}, {router}_port.{c}) AS {side}_{out}"
            for side, router in (("src", "one"), ("dest", "two")) for out, c in kinds.items()]
    return f"""
WITH port AS (SELECT * FROM network_element {LIVE} AND ne_type = 'INTERFACE')
SELECT DISTINCT '{relation}' AS relation, {", ".join(ends)},
  coalesce(one.latitude, one_port.latitude) AS latitude, coalesce(one.longitude, one_port.longitude) AS longitude,
  coalesce(one.ne_name, one_port.ne_name) AS parent_ne,
  coalesce(two.ne_name, two_port.ne_name) AS neighbour_parent_ne_name,
  coalesce(two.latitude, two_port.latitude) AS neighbour_parent_ne_lat,
  coalesce(two.longitude, two_port.longitude) AS neighbour_parent_ne_long,
  coalesce(two_port.latitude, two.latitude) AS neighbour_ne_lat,
  coalesce(two_port.longitude, two.longitude) AS neighbour_ne_long, {columns(
        wire="ckt_id tag last_discovery_ts=last_discovery_time " + own,
        one_port=STATE.replace("ckt_id ", "") + f"hostname src_bandwidth={size} " + IDENTITY,
        two_port=f"dest_bandwidth={size} neighbour_ne_id=ne_id neighbour_ne_name=ne_name")}
FROM {table} wire JOIN port one_port ON one_port.id = wire.source_interface_ne_id
JOIN port two_port ON two_port.id = wire.destination_interface_ne_id
JOIN network_element one ON one.id = wire.source_ne_id JOIN network_element two ON two.id = wire.destination_ne_id"""


@query("i9_link_rows_ospf", routed_link_rows("ospf_link", "OSPF", "capacity", "area_ip_address"),
       views=("network_element", "ospf_link"))
def i9_link_rows_ospf(fx):
    """OSPF link rows, router values first, interface fallback."""
    return I.link_rows_routed(fx.network_element(), fx.link_table("OSPF"), "OSPF")


@query("i10_link_rows_isis", routed_link_rows("isis_link", "ISIS", "bandwidth", "link_type link_uuid=uuid"),
       views=("network_element", "isis_link"))
def i10_link_rows_isis(fx):
    """ISIS link rows with link type and uuid."""
    return I.link_rows_routed(fx.network_element(), fx.link_table("ISIS"), "ISIS")


# ------------------------------------------------------------------ LSP hops
LIVE_HOPS = f"""
  SELECT h.lsp_id, h.hop_sequence, h.interface_ne_id, t.lsp_name, t.modification_time
  FROM (SELECT * FROM lsp_hop {LIVE}) h JOIN (SELECT * FROM lsp {LIVE}) t ON t.id = h.lsp_id"""


@query("i12_lsp_hop_vertices", f"""
WITH hop AS ({LIVE_HOPS}), related AS ({WITH_PARENT})
SELECT DISTINCT 'LSP' AS relation, {columns(
    port=STATE + "latitude longitude bandwidth parent_ne=up_name " + IDENTITY, hop="lsp_modify_ts=modification_time")}
FROM hop JOIN related port ON port.id = hop.interface_ne_id
WHERE coalesce(port.up_deleted, 0) = 0 AND 'ROUTER' IN (port.up_type, port.up_category)""",
       views=("network_element", "lsp", "lsp_hop"))
def i12_lsp_hop_vertices(fx):
    """Hop interfaces of live LSPs under a router."""
    return I.lsp_hop_vertices(fx.lsp(), fx.lsp_hop(), fx.network_element())


@query("i13_lsp_hop_edges", f"""
WITH hop AS ({LIVE_HOPS}), port AS (SELECT * FROM ({WITH_PARENT}) p {LIVE})
SELECT 'LSP' AS relation, {columns(
    hop="lsp_name lsp_id hop_sequence lsp_modify_ts=modification_time",
    near="id ne_type ne_source ne_status ckt_id is_deleted ipv4 hostname src_interface=ne_name start_ne=up_name "
    "src_type=up_type src_category=up_category src_vendor=up_vendor src_technology=up_technology "
    "src_domain=up_domain src_bandwidth=bandwidth start_ne_id=ne_id latitude=up_lat longitude=up_long " + IDENTITY,
    far="dest_interface=ne_name end_ne=up_name dest_type=up_type dest_category=up_category dest_vendor=up_vendor "
    "dest_technology=up_technology dest_domain=up_domain dest_bandwidth=bandwidth end_ne_id=ne_id "
    "neighbour_ne_lat=latitude neighbour_ne_long=longitude neighbour_parent_ne_lat=up_lat "
    "neighbour_parent_ne_long=up_long")}
FROM hop JOIN hop nxt ON nxt.lsp_id = hop.lsp_id AND nxt.hop_sequence - hop.hop_sequence = 1
JOIN port near ON near.id = hop.interface_ne_id JOIN port far ON far.id = nxt.interface_ne_id""",
       views=("network_element", "lsp", "lsp_hop"))
def i13_lsp_hop_edges(fx):
    """Consecutive-hop self join -> LSP edges, live rows only."""
    return I.lsp_hop_edges(fx.lsp(), fx.lsp_hop(), fx.network_element())


@query("i14_valid_link_rows", neighbour_link_rows("LLDP", " AND ".join(
    f"trim({c}) <> ''" for c in ("near.ne_name", "far.ne_name", "near.ne_type"))),
       views=("network_element", "lldp_link"))
def i14_valid_link_rows(fx):
    """Edge-shaped validity filter over the LLDP link rows."""
    valid, _ = I.validate_rows(I.link_rows_lldp(fx.network_element(), fx.link_table("LLDP")), "edge")
    return valid


@query("i14_rejected_vertices", """
SELECT id, 'missing ' || CASE WHEN parent_ne IS NULL THEN 'ne_name' ELSE 'ne_type' END AS reject_reason
FROM (SELECT id, ne_name, up_name AS parent_ne FROM (""" + WITH_PARENT + """) z) y
WHERE parent_ne IS NULL""", views=("network_element",))
def i14_rejected_vertices(fx):
    """I14 vertex kind: elements named by their parent; those without one are rejected."""
    from pyspark.sql import functions as F
    ne = fx.network_element()
    up = ne.select(F.col("id").alias("up_id"), F.col("ne_name").alias("up_name"))
    rows = (ne.join(up, ne.parent_ne_id_fk == up.up_id, "left")
            .select("id", F.col("up_name").alias("ne_name"), "ne_type"))
    _, rejects = I.validate_rows(rows, "vertex")
    return rejects.select("id", "reject_reason")
