"""DuckDB twins of the fixture views (oracle side of the correctness gate).

Each entry is a CTE body over the raw test tables; ``with_views(sql, ...)``
prepends the CTEs a query needs, in dependency order.  This is SQL text for
the external oracle only — the library itself builds the same views with the
DataFrame API (``netlens.sources.testdata``).
"""

from __future__ import annotations

VIEWS: dict[str, tuple[str, list[str]]] = {}


def view(name: str, deps: list[str], sql: str) -> None:
    VIEWS[name] = (sql, deps)


view("nation_region", [], """
SELECT n_nationkey, n_name, n_regionkey, r_name
FROM nation JOIN region ON n_regionkey = r_regionkey""")

_ELEM = """
SELECT {name} AS ne_name, 'VERTEX' AS relation, '{t}' AS ne_type,
  '{p}' || CAST({k} AS VARCHAR) AS ne_id, '{t}' AS ne_category,
  CASE WHEN {deleted} THEN 'DOWN' ELSE 'UP' END AS ne_status,
  {vendor} AS vendor, {tech} AS technology, {domain} AS domain,
  n_name AS parent_ne, {lat} AS latitude, {lng} AS longitude,
  CAST({nk} AS BIGINT) + 1000 AS pop_id,
  'PC' || lpad(CAST({nk} AS VARCHAR), 2, '0') AS pop_code,
  'POP ' || n_name AS pop_name, r_name AS geography_l1, n_name AS geography_l2,
  n_name || '_CITY' || CAST({k} % 4 AS VARCHAR) AS geography_l3,
  n_name || '_ZONE' || CAST({k} % 2 AS VARCHAR) AS geography_l4,
  '{ip}.' || CAST({nk} AS VARCHAR) || '.' || CAST(({k} // 256) % 256 AS VARCHAR) || '.'
     || CAST({k} % 256 AS VARCHAR) AS ipv4,
  lower({name}) AS hostname, {deleted} AS is_deleted,
  TIMESTAMP '2001-10-01 00:00:00' + to_days(CAST({k} % {days} AS INTEGER)) AS last_discovery_ts,
  {level} AS device_level, {mw} AS mw_type
FROM {tbl} JOIN nation_region ON {nk} = n_nationkey"""


def _coord(k, mul, mod, off):
    return f"(CAST(({k} * {mul}) % {mod} - {off} AS DOUBLE) + 0.5)"


view("routers", ["nation_region"], _ELEM.format(
    name="s_name", t="ROUTER", p="R", k="s_suppkey", deleted="(s_suppkey % 23 = 0)",
    vendor="CASE WHEN s_suppkey % 3 = 0 THEN 'CISCO' WHEN s_suppkey % 3 = 1 THEN 'JUNIPER' ELSE 'NOKIA' END",
    tech="'IP'", domain="'TRANSPORT'", lat=_coord("s_suppkey", 37, 180, 90),
    lng=_coord("s_suppkey", 53, 360, 180), nk="s_nationkey", ip="10", days=40, level=3,
    mw="CAST(NULL AS VARCHAR)", tbl="supplier"))

view("switches", ["nation_region"], _ELEM.format(
    name="c_name", t="SWITCH", p="S", k="c_custkey", deleted="(c_custkey % 29 = 0)",
    vendor="CASE WHEN c_custkey % 2 = 0 THEN 'HUAWEI' ELSE 'ARISTA' END",
    tech="'ETHERNET'", domain="c_mktsegment",
    lat=f"CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE {_coord('c_custkey', 37, 180, 90)} END",
    lng=f"CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE {_coord('c_custkey', 53, 360, 180)} END",
    nk="c_nationkey", ip="172", days=45, level=4,
    mw="CASE WHEN c_custkey % 7 = 0 THEN 'MICROWAVE' ELSE 'FIBER' END", tbl="customer"))

view("sites", ["nation_region"], f"""
SELECT n_name AS ne_name, 'VERTEX' AS relation, 'AGG' AS ne_type, 'A' || CAST(n_nationkey AS VARCHAR) AS ne_id,
  'AGG' AS ne_category, 'UP' AS ne_status, 'NOKIA' AS vendor, 'IP' AS technology, 'TRANSPORT' AS domain,
  r_name AS parent_ne, {_coord('n_nationkey', 7, 180, 90)} AS latitude, {_coord('n_nationkey', 11, 360, 180)} AS longitude,
  CAST(n_nationkey AS BIGINT) + 1000 AS pop_id, 'PC' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS pop_code,
  'POP ' || n_name AS pop_name, r_name AS geography_l1, n_name AS geography_l2,
  n_name || '_CITY0' AS geography_l3, n_name || '_ZONE0' AS geography_l4,
  '10.' || CAST(n_nationkey AS VARCHAR) || '.255.1' AS ipv4, lower(n_name) AS hostname, false AS is_deleted,
  TIMESTAMP '2001-11-01 00:00:00' AS last_discovery_ts, 2 AS device_level, CAST(NULL AS VARCHAR) AS mw_type
FROM nation_region
UNION ALL
SELECT r_name, 'VERTEX', 'CORE', 'C' || CAST(r_regionkey AS VARCHAR), 'CORE', 'UP', 'NOKIA', 'IP', 'TRANSPORT',
  CAST(NULL AS VARCHAR), {_coord('r_regionkey', 13, 180, 90)}, {_coord('r_regionkey', 17, 360, 180)},
  CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), r_name, CAST(NULL AS VARCHAR),
  CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), '10.255.' || CAST(r_regionkey AS VARCHAR) || '.1', lower(r_name),
  false, TIMESTAMP '2001-11-01 00:00:00', 1, CAST(NULL AS VARCHAR)
FROM region""")

view("vertices", ["routers", "switches", "sites"], """
SELECT * FROM routers UNION ALL SELECT * FROM switches UNION ALL SELECT * FROM sites""")

view("link_rows", [], """
SELECT CASE l_returnflag WHEN 'A' THEN 'LLDP' WHEN 'N' THEN 'OSPF' ELSE 'ISIS' END AS relation,
  CASE WHEN l_linenumber % 2 = 0 THEN c_name ELSE s_name END AS start_ne,
  CASE WHEN l_linenumber % 2 = 0 THEN s_name ELSE c_name END AS end_ne,
  (CASE WHEN l_linenumber % 2 = 0 THEN c_name ELSE s_name END) || '_' || CAST(l_linenumber AS VARCHAR) AS src_interface,
  (CASE WHEN l_linenumber % 2 = 0 THEN s_name ELSE c_name END) || '_' || CAST(l_linenumber AS VARCHAR) AS dest_interface,
  CASE WHEN l_linenumber % 2 = 0 THEN 'SWITCH' ELSE 'ROUTER' END AS src_type,
  CASE WHEN l_linenumber % 2 = 0 THEN 'ROUTER' ELSE 'SWITCH' END AS dest_type,
  l_linestatus AS link_type, l_quantity AS bandwidth, l_shipdate AS last_discovery_ts,
  o_orderdate AS modified_ts, o_orderpriority AS tag,
  '10.' || CAST(s_nationkey AS VARCHAR) || '.0.0' AS area_ip_address,
  'CKT' || CAST(l_orderkey AS VARCHAR) AS ckt_id,
  l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax, o_custkey
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey""")

view("edges", ["link_rows"], """
SELECT src_interface, dest_interface, relation,
  max(link_type) AS link_type,
  CASE WHEN upper(relation) = 'ISIS' THEN coalesce(trim(link_type), '') ELSE '' END AS link_type_key,
  max(start_ne) AS start_ne, max(end_ne) AS end_ne, max(src_type) AS src_type, max(dest_type) AS dest_type,
  max(bandwidth) AS bandwidth, max(last_discovery_ts) AS last_discovery_ts, max(tag) AS tag,
  max(area_ip_address) AS area_ip_address, 'CKT' || CAST(min(l_orderkey) AS VARCHAR) AS ckt_id,
  count(*) AS link_count,
  'ACTIVE' AS status, false AS is_deleted
FROM link_rows
GROUP BY src_interface, dest_interface, relation,
  CASE WHEN upper(relation) = 'ISIS' THEN coalesce(trim(link_type), '') ELSE '' END""")

view("parent_edges", ["vertices"], """
SELECT ne_name AS src_interface, parent_ne AS dest_interface, 'PARENT' AS relation,
  ne_name AS start_ne, parent_ne AS end_ne, ne_type AS src_type, last_discovery_ts
FROM vertices WHERE parent_ne IS NOT NULL""")

view("lsp_hop", [], """
SELECT l_orderkey AS lsp_id,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
                     l_extendedprice) AS hop_sequence,
  3000000000000 + s_suppkey * 16 + l_linenumber AS interface_ne_id, s_name AS hop_ne_name,
  CAST(l_partkey % 23 = 0 AS INTEGER) AS is_deleted
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""")

view("lsp", [], """
SELECT o_orderkey AS id, 'LSP_' || CAST(o_orderkey AS VARCHAR) AS lsp_name, CAST(o_orderkey % 19 = 0 AS INTEGER) AS is_deleted,
  o_orderdate AS modification_time, o_orderstatus, o_totalprice
FROM orders""")

view("pm_sample", [], """
SELECT s_name AS nodename, 'hourly' AS granularity, date_trunc('hour', ts) AS date,
  event_type AS kpi_id, value, event_id
FROM events JOIN supplier ON user_id = s_suppkey WHERE event_type IN ('view', 'click', 'purchase')
UNION ALL
SELECT s_name, 'daily', date_trunc('day', ts), event_type, value, event_id
FROM events JOIN supplier ON user_id = s_suppkey WHERE event_type IN ('view', 'click', 'purchase')""")

view("alarms", [], """
SELECT s_name AS entity_name,
  'ALM_' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS VARCHAR) AS alarm_name,
  CASE WHEN event_id % 2 = 0 THEN 'OPEN' ELSE 'CLEARED' END AS alarm_status,
  CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 25 THEN 'CRITICAL'
       WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 50 THEN 'MAJOR'
       WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 75 THEN 'MINOR'
       ELSE 'WARNING' END AS category,
  ts AS raised_ts, event_id
FROM events JOIN supplier ON user_id = s_suppkey WHERE event_type = 'error'""")


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs of ``names`` and their dependencies."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in VIEWS[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return sql
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][0]}\n)" for n in order)
    body = sql.lstrip()
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


# ------------------------------------------------------------ inventory views
view("ne_elements", ["vertices"], """
SELECT CASE ne_type WHEN 'ROUTER' THEN 1000000000000 WHEN 'SWITCH' THEN 2000000000000
                    WHEN 'AGG' THEN 100 ELSE 1 END + CAST(substr(ne_id, 2) AS BIGINT) AS id,
  ne_id, ne_name, ne_type, ne_category,
  CASE WHEN ne_type = 'ROUTER' AND CAST(substr(ne_id, 2) AS BIGINT) % 2 = 0 THEN 'SDN' ELSE 'EMS' END AS source,
  'DISCOVERED' AS ne_source, ne_status, vendor, technology, domain, latitude, longitude,
  CAST(NULL AS DOUBLE) AS capacity, CAST(NULL AS DOUBLE) AS bandwidth, CAST(NULL AS VARCHAR) AS ckt_id,
  CAST(is_deleted AS INTEGER) AS is_deleted, ipv4, hostname,
  last_discovery_ts AS last_discovery_time, last_discovery_ts AS modified_time,
  CASE WHEN ne_type <> 'CORE' THEN
    CAST(regexp_extract(geography_l2, 'NATION_([0-9]+)', 1) AS BIGINT) * 4
    + CASE WHEN ne_type IN ('ROUTER', 'SWITCH') THEN CAST(regexp_extract(geography_l3, '_CITY([0-9]+)$', 1) AS INTEGER)
           ELSE 0 END + 1 END AS ne_location_id_fk,
  CASE WHEN ne_type IN ('ROUTER', 'SWITCH') THEN 100 + CAST(regexp_extract(geography_l2, 'NATION_([0-9]+)', 1) AS BIGINT)
       WHEN ne_type = 'AGG' THEN 1 + CAST((SELECT r_regionkey FROM region WHERE r_name = geography_l1) AS BIGINT)
  END AS parent_ne_id_fk,
  CASE ne_type WHEN 'ROUTER' THEN 1000000000000 + CAST(substr(ne_id, 2) AS BIGINT) // 2
               WHEN 'SWITCH' THEN 1000000000000 + CAST(substr(ne_id, 2) AS BIGINT) % 50 END AS network_element_id_fk
FROM vertices""")

view("ne_interfaces", [], """
SELECT id, 'I' || CAST(id AS VARCHAR) AS ne_id, owner || '_' || CAST(l_linenumber AS VARCHAR) AS ne_name,
  'INTERFACE' AS ne_type, 'INTERFACE' AS ne_category, 'EMS' AS source, 'DISCOVERED' AS ne_source,
  'UP' AS ne_status, CAST(NULL AS VARCHAR) AS vendor, CAST(NULL AS VARCHAR) AS technology,
  CAST(NULL AS VARCHAR) AS domain, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
  CAST(l_linenumber * 100 AS DOUBLE) AS capacity, CAST(l_linenumber * 1000 AS DOUBLE) AS bandwidth,
  'CKT_IF' || CAST(l_linenumber AS VARCHAR) AS ckt_id, CAST(id % 29 = 0 AS INTEGER) AS is_deleted, CAST(NULL AS VARCHAR) AS ipv4,
  lower(owner || '_' || CAST(l_linenumber AS VARCHAR)) AS hostname,
  TIMESTAMP '2001-11-01 00:00:00' AS last_discovery_time, TIMESTAMP '2001-11-01 00:00:00' AS modified_time,
  CAST(NULL AS BIGINT) AS ne_location_id_fk, pid AS parent_ne_id_fk, CAST(NULL AS BIGINT) AS network_element_id_fk
FROM (
  SELECT 3000000000000 + s_suppkey * 16 + l_linenumber AS id, s_name AS owner,
         1000000000000 + s_suppkey AS pid, l_linenumber
  FROM (SELECT DISTINCT l_suppkey, l_linenumber FROM lineitem) a JOIN supplier ON l_suppkey = s_suppkey
  UNION ALL
  SELECT 4000000000000 + c_custkey * 16 + l_linenumber, c_name, 2000000000000 + c_custkey, l_linenumber
  FROM (SELECT DISTINCT o_custkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey) b
  JOIN customer ON o_custkey = c_custkey) z""")

view("network_element", ["ne_elements", "ne_interfaces"], """
SELECT *, 'PM' || (id % 97) AS pm_ems_id, 'FM' || (id % 89) AS fm_ems_id, 'CM' || (id % 83) AS cm_ems_id,
  'fd00::' || (id % 9973) AS ipv6, 'MODEL-' || (id % 13) AS model, '02:' || id AS mac_address,
  lower(ne_name) || ' unit' AS friendly_name, 'ne-' || id AS uuid, 'SN' || id AS serial_number
FROM (SELECT * FROM ne_elements UNION ALL SELECT * FROM ne_interfaces) both_kinds""")

view("ne_location", ["nation_region"], """
SELECT CAST(n_nationkey AS BIGINT) * 4 + k + 1 AS id, CAST(n_nationkey AS BIGINT) + 1000 AS nel_id,
  'PC' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS nel_code, 'POP ' || n_name AS friendly_name,
  CAST(n_regionkey AS BIGINT) + 1 AS geography_l1_id_fk, CAST(n_nationkey AS BIGINT) + 1 AS geography_l2_id_fk,
  CAST(n_nationkey AS BIGINT) * 4 + k + 1 AS geography_l3_id_fk,
  CAST(n_nationkey AS BIGINT) * 2 + k % 2 + 1 AS geography_l4_id_fk
FROM nation_region, (SELECT unnest([0, 1, 2, 3]) AS k) ks""")

view("geo_l1", [], "SELECT CAST(r_regionkey AS BIGINT) + 1 AS id, r_name AS geo_name FROM region")
view("geo_l2", ["nation_region"], "SELECT CAST(n_nationkey AS BIGINT) + 1 AS id, n_name AS geo_name FROM nation_region")
view("geo_l3", ["nation_region"], """
SELECT CAST(n_nationkey AS BIGINT) * 4 + k + 1 AS id, n_name || '_CITY' || CAST(k AS VARCHAR) AS geo_name
FROM nation_region, (SELECT unnest([0, 1, 2, 3]) AS k) ks""")
view("geo_l4", ["nation_region"], """
SELECT CAST(n_nationkey AS BIGINT) * 2 + k + 1 AS id, n_name || '_ZONE' || CAST(k AS VARCHAR) AS geo_name
FROM nation_region, (SELECT unnest([0, 1]) AS k) ks""")


def _link_table(rel: str) -> str:
    sw = "l_linenumber % 2 = 0"
    return f"""
SELECT CASE WHEN {sw} THEN 2000000000000 + o_custkey ELSE 1000000000000 + l_suppkey END AS source_ne_id,
  CASE WHEN {sw} THEN 1000000000000 + l_suppkey ELSE 2000000000000 + o_custkey END AS destination_ne_id,
  CASE WHEN {sw} THEN 4000000000000 + o_custkey * 16 + l_linenumber
       ELSE 3000000000000 + l_suppkey * 16 + l_linenumber END AS source_interface_ne_id,
  CASE WHEN {sw} THEN 3000000000000 + l_suppkey * 16 + l_linenumber
       ELSE 4000000000000 + o_custkey * 16 + l_linenumber END AS destination_interface_ne_id,
  src_interface || '#' || dest_interface AS link_name, ckt_id, tag, area_ip_address, link_type,
  'U' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS uuid,
  CAST(l_partkey % 17 = 0 AS INTEGER) AS is_deleted,
  last_discovery_ts AS last_discovery_time, modified_ts AS modified_time
FROM link_rows WHERE relation = '{rel}'"""


view("lldp_link", ["link_rows"], _link_table("LLDP"))
view("ospf_link", ["link_rows"], _link_table("OSPF"))
view("isis_link", ["link_rows"], _link_table("ISIS"))


# ------------------------------------------------------------------ LSP feed
view("mpls_lsp_link", ["lsp_hop", "routers", "lsp"], """
SELECT nodes[1].ne_id AS source_ip, nodes[len(nodes)].ne_id AS destination_ip, l.lsp_name AS mpls_lsp_name,
  l.modification_time AS timestamp, nodes AS node_details,
  [struct_pack(mpls_lsp_name := l.lsp_name, src_ne_id := nodes[1].ne_id, dest_ne_id := nodes[len(nodes)].ne_id,
               src_ne_name := nodes[1].ne_name, dest_ne_name := nodes[len(nodes)].ne_name,
               src_parent_ne_name := nodes[1].ne_name, dest_parent_ne_name := nodes[len(nodes)].ne_name,
               src_ckt_id := 'CKT' || CAST(per.lsp_id AS VARCHAR), src_ne_type := nodes[1].ne_type,
               dest_ne_type := nodes[len(nodes)].ne_type, src_ne_category := nodes[1].ne_category,
               dest_ne_category := nodes[len(nodes)].ne_category)] AS link_details,
  struct_pack(fields := map(['mplsLspAge', 'mplsLspState', 'mplsLspHops'],
                            [CAST(l.o_totalprice AS VARCHAR), l.o_orderstatus, CAST(len(nodes) AS VARCHAR)])) AS meta_info
FROM (
  SELECT h.lsp_id, list(struct_pack(ne_id := r.ne_id, ne_name := r.ne_name, hostname := r.hostname, ipv4 := r.ipv4,
           ne_type := r.ne_type, ne_category := r.ne_category, geo_l1_name := r.geography_l1,
           geo_l2_name := r.geography_l2, latitude := CAST(r.latitude AS VARCHAR),
           longitude := CAST(r.longitude AS VARCHAR), pop_id := CAST(r.pop_id AS VARCHAR), pop_name := r.pop_name,
           vendor := r.vendor) ORDER BY h.hop_sequence) AS nodes
  FROM lsp_hop h JOIN routers r ON h.hop_ne_name = r.ne_name
  GROUP BY h.lsp_id HAVING count(*) >= 2) per
JOIN lsp l ON per.lsp_id = l.id""")

view("lsp_links", ["mpls_lsp_link"], """
SELECT sel[1].ne_name AS start_ne,
  coalesce(list_filter(sel, lambda n: n.ne_id = destination_ip)[1].ne_name, sel[2].ne_name) AS end_ne,
  'LSP' AS relation, mpls_lsp_name AS lsp_name, meta_info.fields AS meta, timestamp
FROM (SELECT *, list_concat(list_filter(node_details, lambda n: n.ne_id = source_ip),
                            list_filter(node_details, lambda n: n.ne_id <> source_ip AND n.ne_id = destination_ip)) AS sel
      FROM mpls_lsp_link) z
WHERE len(sel) >= 2""")

view("lsp_nodes", ["mpls_lsp_link"], """
SELECT ne_id, n.ne_name AS ne_name, n.hostname AS hostname, n.ipv4 AS ipv4, n.ne_type AS ne_type,
  n.geo_l1_name AS geo_l1_name, n.latitude AS latitude, n.longitude AS longitude, n.vendor AS vendor
FROM (SELECT n.ne_id AS ne_id, arg_min(n, mpls_lsp_name) AS n FROM (
  SELECT mpls_lsp_name, unnest(sel) AS n FROM (
    SELECT *, list_concat(list_filter(node_details, lambda n: n.ne_id = source_ip),
                          list_filter(node_details, lambda n: n.ne_id <> source_ip AND n.ne_id = destination_ip)) AS sel
    FROM mpls_lsp_link) a WHERE len(sel) >= 2) b GROUP BY n.ne_id) c""")

view("config", ["pm_sample", "routers", "lsp", "alarms"], """
SELECT 'PM_WATERMARK_' || vendor AS config_key, strftime(max(date), '%Y%m%d%H%M') AS config_value
FROM pm_sample p JOIN routers r ON p.nodename = r.ne_name WHERE granularity = 'hourly' GROUP BY vendor
UNION ALL SELECT 'LSP_WATERMARK', strftime(max(modification_time), '%Y%m%d%H%M') FROM lsp
UNION ALL SELECT 'ALARM_CODES', '{"codes":[' || string_agg('"' || alarm_name || '"', ',' ORDER BY alarm_name)
  || ',"  "]}' FROM (SELECT DISTINCT alarm_name FROM alarms) a""")


# ------------------------------------------------------------------ KPI views
view("link_samples", ["link_rows"], """
SELECT src_interface || '#' || dest_interface AS link_name,
  CASE WHEN l_linenumber <= 2 THEN 'hourly' ELSE 'daily' END AS granularity, last_discovery_ts AS date,
  l_discount * 100 AS in_util, CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_tax * 100 END AS out_util
FROM link_rows""")

view("kpi_def", ["pm_sample", "routers"], """
SELECT DISTINCT kpi_id || '_' || lower(vendor) AS kpi_id, upper(kpi_id) || ' RATE' AS kpi_name, domain, vendor
FROM (SELECT DISTINCT nodename, kpi_id FROM pm_sample) p JOIN routers r ON p.nodename = r.ne_name""")

view("element_sample", [], """
SELECT 'R' || CAST(s_suppkey AS VARCHAR) AS ne_id, ts,
  CASE WHEN event_type = 'view' THEN (CASE WHEN value < 1 THEN 'n/a' ELSE CAST(value AS VARCHAR) END) END AS cpu,
  CASE WHEN event_type = 'click' THEN (CASE WHEN value < 1 THEN 'n/a' ELSE CAST(value AS VARCHAR) END) END AS memory
FROM events JOIN supplier ON user_id = s_suppkey WHERE event_type IN ('view', 'click')""")

view("pm", ["pm_sample", "routers"], """
SELECT m.nodename, m.date, m.kpijson, r.domain, r.vendor, r.technology
FROM (SELECT nodename, date, map(list(kpi_id ORDER BY kpi_id), list(CAST(value AS VARCHAR) ORDER BY kpi_id)) AS kpijson
      FROM (SELECT nodename, strftime(date, '%Y-%m-%d') AS date, kpi_id, max(value) AS value FROM pm_sample
            WHERE granularity = 'daily' GROUP BY ALL) a GROUP BY nodename, date) m
LEFT JOIN routers r ON m.nodename = r.ne_name""")
