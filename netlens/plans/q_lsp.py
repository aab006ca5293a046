"""Registered LSP queries (P1–P12) and feed/config sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lsp as P
from ..sources import io as IO
from .catalog import query

ALL_TYPES = "ROUTER,SWITCH,AGG,CORE"


def _feed(fx):
    return fx.mpls_lsp_link()


def _links(fx):
    return P.aggregate_links(_feed(fx))


def _flat_links(df):
    return df.select("start_ne", "end_ne", "relation", "lsp_name",
                     F.col("meta")["mplsLspAge"].alias("lsp_age"), F.col("meta")["mplsLspState"].alias("lsp_state"),
                     "timestamp")


_FLAT = ("start_ne, end_ne, relation, lsp_name, meta['mplsLspAge'] AS lsp_age, "
         "meta['mplsLspState'] AS lsp_state, timestamp")


@query("p1_default_lsp_list", """
SELECT mpls_lsp_name, source_ip, destination_ip, timestamp, len(node_details) AS n_nodes,
  array_to_string(list_transform(node_details, lambda n: n.ne_name), ',') AS node_names,
  link_details[1].src_ne_name AS first_src, meta_info.fields['mplsLspAge'] AS lsp_age,
  meta_info.fields['mplsLspState'] AS lsp_state
FROM mpls_lsp_link""", views=("mpls_lsp_link",))
def p1_default_lsp_list(fx):
    """One row per LSP (nested fields projected for comparison)."""
    d = P.default_list(_feed(fx))
    return d.select("mpls_lsp_name", "source_ip", "destination_ip", "timestamp",
                    F.size("node_details").alias("n_nodes"),
                    F.array_join(F.transform("node_details", lambda n: n["ne_name"]), ",").alias("node_names"),
                    F.col("link_details")[0]["src_ne_name"].alias("first_src"),
                    F.col("meta_info.fields")["mplsLspAge"].alias("lsp_age"),
                    F.col("meta_info.fields")["mplsLspState"].alias("lsp_state"))


@query("p2_aggregate_links", f"SELECT {_FLAT} FROM lsp_links", views=("lsp_links",))
def p2_aggregate_links(fx):
    """One LSP link per LSP between its source and destination nodes."""
    return _flat_links(_links(fx))


@query("p2_aggregate_nodes", "SELECT * FROM lsp_nodes", views=("lsp_nodes",))
def p2_aggregate_nodes(fx):
    """Endpoint nodes unique by ne_id."""
    return P.aggregate_nodes(_feed(fx))


_AT = """strptime((SELECT min(config_value) FROM config WHERE config_key = 'LSP_WATERMARK'), '%Y%m%d%H%M')"""


def _feed_now(fx):
    return P.feed_at_watermark(_feed(fx), IO.watermark(fx.config(), ["LSP_WATERMARK"]))


@query("p2_links_at_watermark", f"SELECT {_FLAT} FROM lsp_links WHERE timestamp = {_AT}",
       views=("lsp_links", "config"))
def p2_links_at_watermark(fx):
    """P2 at the configured time (S8 -> S7): the links of the LSPs in that feed."""
    return _flat_links(P.aggregate_links(_feed_now(fx)))


@query("p2_time_at_watermark", f"SELECT max(timestamp) AS timestamp FROM mpls_lsp_link WHERE timestamp = {_AT}",
       views=("mpls_lsp_link", "config"))
def p2_time_at_watermark(fx):
    """The time of that feed."""
    return P.aggregate_time(_feed_now(fx))


@query("p3_lsp_detail_links", """
SELECT l.mpls_lsp_name AS lsp_name, l.src_ne_id AS start_ne_id, l.dest_ne_id AS end_ne_id,
  l.src_ne_name AS src_interface, l.dest_ne_name AS dest_interface, l.src_parent_ne_name AS start_ne,
  l.dest_parent_ne_name AS end_ne, l.src_ckt_id AS ckt_id, l.src_ne_type AS src_type, l.dest_ne_type AS dest_type,
  l.src_ne_category AS src_category, l.dest_ne_category AS dest_category
FROM (SELECT unnest(link_details) AS l FROM mpls_lsp_link WHERE mpls_lsp_name = 'LSP_7') z""",
       views=("mpls_lsp_link",))
def p3_lsp_detail_links(fx):
    """Link details of LSP_7 with alias renames."""
    links, _ = P.lsp_detail(_feed(fx), "LSP_7")
    return links


@query("p3_lsp_detail_nodes", """
SELECT pos, n.ne_id AS ne_id, n.ne_name AS ne_name, n.hostname AS hostname, n.ipv4 AS ipv4, n.ne_type AS ne_type,
  n.ne_category AS ne_category, n.geo_l1_name AS geo_l1_name, n.geo_l2_name AS geo_l2_name,
  n.latitude AS latitude, n.longitude AS longitude, n.pop_id AS pop_id, n.pop_name AS pop_name, n.vendor AS vendor
FROM (SELECT generate_subscripts(node_details, 1) - 1 AS pos, unnest(node_details) AS n
      FROM mpls_lsp_link WHERE mpls_lsp_name = 'LSP_7') z""", views=("mpls_lsp_link",))
def p3_lsp_detail_nodes(fx):
    """Nodes of LSP_7 in hop order."""
    _, nodes = P.lsp_detail(_feed(fx), "LSP_7")
    return nodes


def _num_or_text_sql(v: str, desc: bool) -> str:
    num = f"TRY_CAST({v} AS DOUBLE)"
    if desc:
        return f"({v} IS NULL) DESC, ({num} IS NULL) DESC, {num} DESC, lower({v}) DESC"
    return f"({v} IS NULL) ASC, ({num} IS NULL) ASC, {num} ASC, lower({v}) ASC"


@query("p4_lsp_search_page", f"""
SELECT {_FLAT} FROM lsp_links
WHERE contains(lower(start_ne), 'supplier#00000001') AND meta['mplsLspAge'] IS NOT NULL
  AND coalesce(CASE WHEN TRY_CAST(meta['mplsLspAge'] AS DOUBLE) IS NOT NULL
                    THEN TRY_CAST(meta['mplsLspAge'] AS DOUBLE) >= 200000
                    ELSE lower(meta['mplsLspAge']) >= '200000' END, false)
ORDER BY {_num_or_text_sql("meta['mplsLspAge']", True)}, start_ne, end_ne, lsp_name
LIMIT 25 OFFSET 0""", views=("lsp_links",))
def p4_lsp_search_page(fx):
    """Start contains 'supplier#00000001', age >= 200000, by age desc, page [0, 24]."""
    return _flat_links(P.search_page(_links(fx), order_by="mplsLspAge", descending=True, lower=0, upper=24,
                                     start="supplier#00000001", meta_filter="mplsLspAge>=200000"))


@query("p4_lsp_search_page2", f"""
SELECT {_FLAT} FROM lsp_links WHERE starts_with(lower(lsp_name), 'lsp_1')
ORDER BY {_num_or_text_sql("meta['mplsLspState']", False)}, start_ne, end_ne, lsp_name
LIMIT 51 OFFSET 100""", views=("lsp_links",))
def p4_lsp_search_page2(fx):
    """LSP name starts with 'lsp_1', by state (text) asc, page [100, 150]."""
    return _flat_links(P.search_page(_links(fx), order_by="mplsLspState", lower=100, upper=150, lsp_name="lsp_1"))


_P5_WHERE = """
  meta['mplsLspState'] IS NOT NULL AND coalesce(lower(meta['mplsLspState']) = 'f', false)
  AND meta['mplsLspAge'] IS NOT NULL
  AND coalesce(CASE WHEN TRY_CAST(meta['mplsLspAge'] AS DOUBLE) IS NOT NULL
                    THEN TRY_CAST(meta['mplsLspAge'] AS DOUBLE) < 150000.5
                    ELSE lower(meta['mplsLspAge']) < '150000.5' END, false)
  AND meta['mplsLspHops'] IS NOT NULL
  AND coalesce(CASE WHEN TRY_CAST(meta['mplsLspHops'] AS DOUBLE) IS NOT NULL
                    THEN TRY_CAST(meta['mplsLspHops'] AS DOUBLE) != 4
                    ELSE lower(meta['mplsLspHops']) != '4' END, false)"""


@query("p5_meta_filter", f"SELECT {_FLAT} FROM lsp_links WHERE {_P5_WHERE}", views=("lsp_links",))
def p5_meta_filter(fx):
    """P5: 'mplsLspState=F, mplsLspAge<150000.5, mplsLspHops!=4, bad term' (bad term ignored)."""
    return _flat_links(P.search_links(_links(fx),
                                      meta_filter="mplsLspState=F, mplsLspAge<150000.5, mplsLspHops!=4, nonsense"))


@query("p6_lsp_count", f"SELECT count(*) AS total FROM lsp_links WHERE {_P5_WHERE}", views=("lsp_links",))
def p6_lsp_count(fx):
    """Count for the P5 predicates."""
    return P.count_links(_links(fx), meta_filter="mplsLspState=F, mplsLspAge<150000.5, mplsLspHops!=4")


@query("p7_lsp_status", """
WITH codes AS (SELECT trim(x) AS value FROM (
  SELECT unnest(json_extract_string(config_value, '$.codes[*]')) AS x FROM config
  WHERE config_key = 'ALARM_CODES') z WHERE trim(x) <> ''),
t AS (SELECT count(*) AS total FROM lsp_links WHERE contains(lower(start_ne), 'supplier#000000012')),
d AS (SELECT count(*) AS down FROM alarms WHERE lower(entity_name) = 'supplier#000000012'
      AND upper(alarm_status) IN ('OPEN', 'REOPENED') AND alarm_name IN (SELECT value FROM codes))
SELECT total, down, greatest(total - down, 0) AS active FROM t, d""", views=("lsp_links", "config", "alarms"))
def p7_lsp_status(fx):
    """Total / down / active LSPs for Supplier#000000012 with configured alarm codes."""
    codes = IO.config_codes(fx.config(), "ALARM_CODES")
    return P.lsp_status(_links(fx), fx.alarms(), "Supplier#000000012", codes)


@query("p8_graph_by_start_end", f"""
SELECT {_FLAT} FROM lsp_links WHERE contains(lower(start_ne), 'supplier#00000002')
  AND contains(lower(end_ne), 'supplier#00000007')""", views=("lsp_links",))
def p8_graph_by_start_end(fx):
    """LSP links from *supplier#00000002* to *supplier#00000007* (links)."""
    links, _ = P.graph_by_start_end(_links(fx), P.aggregate_nodes(_feed(fx)), "supplier#00000002",
                                    "supplier#00000007")
    return _flat_links(links)


@query("p8_graph_nodes", """
WITH l AS (SELECT * FROM lsp_links WHERE contains(lower(start_ne), 'supplier#00000002')
  AND contains(lower(end_ne), 'supplier#00000007'))
SELECT * FROM lsp_nodes WHERE lower(ne_name) IN (SELECT lower(start_ne) FROM l UNION SELECT lower(end_ne) FROM l)""",
       views=("lsp_links", "lsp_nodes"))
def p8_graph_nodes(fx):
    """Nodes named by those links."""
    _, nodes = P.graph_by_start_end(_links(fx), P.aggregate_nodes(_feed(fx)), "supplier#00000002",
                                    "supplier#00000007")
    return nodes


_N8 = "SELECT ne_name FROM vertices WHERE geography_l2 = 'NATION_8'"


@query("p9_links_for_names", f"SELECT {_FLAT} FROM lsp_links WHERE start_ne IN ({_N8})",
       views=("lsp_links", "vertices"))
def p9_links_for_names(fx):
    """Outgoing LSP links of NATION_8 elements."""
    names = fx.vertices().filter(F.col("geography_l2") == "NATION_8").select("ne_name")
    return _flat_links(P.links_for_names(_links(fx), names))


@query("p9_nodes_for_names", f"""
WITH n AS ({_N8}), l AS (SELECT * FROM lsp_links WHERE start_ne IN (SELECT ne_name FROM n))
SELECT * FROM vertices WHERE ne_name IN (
  SELECT ne_name FROM n UNION SELECT start_ne FROM l UNION SELECT end_ne FROM l)""",
       views=("lsp_links", "vertices"))
def p9_nodes_for_names(fx):
    """P9 node half: the NATION_8 elements and the ends of their outgoing LSP links."""
    v = fx.vertices()
    names = v.filter(F.col("geography_l2") == "NATION_8").select("ne_name")
    return P.nodes_for_links(v, P.links_for_names(_links(fx), names), names)


@query("p10_region_nodes", """
WITH n AS (SELECT ne_name FROM vertices WHERE upper(ne_type) IN ('ROUTER') AND lower(geography_l1) = 'asia'),
l AS (SELECT * FROM lsp_links WHERE start_ne IN (SELECT ne_name FROM n) OR end_ne IN (SELECT ne_name FROM n))
SELECT * FROM vertices WHERE ne_name IN (
  SELECT ne_name FROM n UNION SELECT start_ne FROM l UNION SELECT end_ne FROM l)""",
       views=("lsp_links", "vertices"))
def p10_region_nodes(fx):
    """P10 node half: ASIA routers and the ends of the LSP links that touch them."""
    v = fx.vertices()
    links = P.region_search(_links(fx), v, "Asia", "ROUTER", directional=False)
    return P.nodes_for_links(v, links, P.region_names(v, "Asia", "ROUTER"))


_N3 = "SELECT ne_name FROM vertices WHERE geography_l2 IN ('NATION_8', 'NATION_3', 'NATION_17')"


@query("p9_links_parent_mode", f"SELECT {_FLAT} FROM lsp_links WHERE start_ne IN ({_N3}) AND end_ne IN ({_N3})",
       views=("lsp_links", "vertices"))
def p9_links_parent_mode(fx):
    """P9 parent mode: both ends among three nations' elements."""
    names = fx.vertices().filter(F.col("geography_l2").isin("NATION_8", "NATION_3", "NATION_17")).select("ne_name")
    return _flat_links(P.links_for_names(_links(fx), names, mode="parent"))


@query("p10_region_search", f"""
SELECT {_FLAT} FROM lsp_links WHERE start_ne IN (
  SELECT ne_name FROM vertices WHERE upper(ne_type) IN ('ROUTER') AND lower(geography_l1) = 'asia')""",
       views=("lsp_links", "vertices"))
def p10_region_search(fx):
    """P10: LSP links leaving ASIA routers (directional)."""
    return _flat_links(P.region_search(_links(fx), fx.vertices(), "Asia", "ROUTER"))


@query("p10_region_search_either", f"""
WITH n AS (SELECT ne_name FROM vertices WHERE upper(ne_type) IN ('ROUTER') AND lower(geography_l1) = 'asia')
SELECT {_FLAT} FROM lsp_links WHERE start_ne IN (SELECT ne_name FROM n) OR end_ne IN (SELECT ne_name FROM n)""",
       views=("lsp_links", "vertices"))
def p10_region_search_either(fx):
    """P10 with directional=False: either end in ASIA."""
    return _flat_links(P.region_search(_links(fx), fx.vertices(), "Asia", "ROUTER", directional=False))


@query("p11_region_contains", f"""
SELECT {_FLAT} FROM lsp_links WHERE start_ne IN (
  SELECT ne_name FROM vertices WHERE upper(ne_type) IN ('ROUTER') AND contains(lower(geography_l1), 'meric'))""",
       views=("lsp_links", "vertices"))
def p11_region_contains(fx):
    """Region name contains 'meric' (AMERICA)."""
    return _flat_links(P.region_search(_links(fx), fx.vertices(), "meric", "ROUTER", contains=True))


@query("p12_direction_in", f"SELECT {_FLAT} FROM lsp_links WHERE end_ne IN ({_N8})",
       views=("lsp_links", "vertices"))
def p12_direction_in(fx):
    """Incoming LSP links of NATION_8 elements."""
    names = fx.vertices().filter(F.col("geography_l2") == "NATION_8").select("ne_name")
    return _flat_links(P.links_for_names(_links(fx), names, direction="IN"))


# ------------------------------------------------------------ sources
@query("s2_api_types", """
SELECT src_interface, dest_interface, relation,
  CASE WHEN last_discovery_ts IS NULL THEN NULL
       WHEN second(last_discovery_ts) = 0 AND microsecond(last_discovery_ts) % 1000000 = 0
         THEN strftime(last_discovery_ts, '%Y-%m-%d %H:%M')
       ELSE strftime(last_discovery_ts, '%Y-%m-%d %H:%M:%S') END AS last_discovery_ts,
  epoch_ms(modified_ts) AS modified_ts
FROM link_rows WHERE relation = 'ISIS'""", views=("link_rows",))
def s2_api_types(fx):
    """Discovery time as ISO text, modify time as epoch millis (ISIS rows)."""
    rows = fx.link_rows().filter(F.col("relation") == "ISIS").select(
        "src_interface", "dest_interface", "relation", "last_discovery_ts", "modified_ts")
    return IO.to_api_types(rows, ["last_discovery_ts"], ["modified_ts"])


@query("s2_api_types_events", """
SELECT event_id,
  CASE WHEN second(ts) = 0 AND microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M')
       WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
       WHEN microsecond(ts) % 1000 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || '.' || lpad(CAST((microsecond(ts) % 1000000) // 1000 AS VARCHAR), 3, '0')
       ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') || '.' || lpad(CAST(microsecond(ts) % 1000000 AS VARCHAR), 6, '0') END AS ts
FROM events""")
def s2_api_types_events(fx):
    """Sub-second discovery times rendered as ISO text."""
    return IO.to_api_types(fx.t("events").select("event_id", "ts"), ["ts"], [])


@query("s3_today_only", """
SELECT * EXCLUDE (o_custkey) FROM link_rows WHERE last_discovery_ts >= TIMESTAMP '1998-06-01 00:00:00'
  AND last_discovery_ts < TIMESTAMP '1998-06-02 00:00:00'""", views=("link_rows",))
def s3_today_only(fx):
    """S3: link rows discovered on run date 1998-06-01."""
    return IO.today_only(fx.link_rows(), "last_discovery_ts", "1998-06-01")


@query("s7_feed_at", """
SELECT mpls_lsp_name, source_ip, destination_ip, timestamp FROM mpls_lsp_link
WHERE timestamp = strptime('199806010000', '%Y%m%d%H%M')""", views=("mpls_lsp_link",))
def s7_feed_at(fx):
    """LSP feed rows at time 199806010000."""
    return P.feed_at(_feed(fx), "199806010000").select("mpls_lsp_name", "source_ip", "destination_ip",
                                                        "timestamp")


@query("s8_watermark", """
SELECT min(config_value) AS watermark FROM config
WHERE config_key IN ('PM_WATERMARK_CISCO', 'PM_WATERMARK_JUNIPER', 'PM_WATERMARK_NOKIA')""",
       views=("config",))
def s8_watermark(fx):
    """Time all vendors' KPI feeds have reached."""
    return IO.watermark(fx.config(), [f"PM_WATERMARK_{v}" for v in ("CISCO", "JUNIPER", "NOKIA")])


@query("s9_config_codes", """
SELECT trim(x) AS value FROM (SELECT unnest(json_extract_string(config_value, '$.codes[*]')) AS x
  FROM config WHERE config_key = 'ALARM_CODES') z WHERE trim(x) <> ''""", views=("config",))
def s9_config_codes(fx):
    """Alarm codes from the JSON config value, blanks dropped."""
    return IO.config_codes(fx.config(), "ALARM_CODES")
