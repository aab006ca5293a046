"""Registered merge / maintenance queries (U1–U12) with DuckDB twins.

Scenario (FIXTURES.md part B): the vertex snapshot holds elements discovered
before 2001-10-25 and the increment re-discovers those from 2001-10-15 on
(status changed, routers with a new vendor and no coordinates); the edge
snapshot is built from link rows shipped before 1998-01-01 and the increment
is every later link row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..operators import merge as U
from ..operators.ingest import interface_vertices
from .catalog import query

RUN_TS = "2002-01-01 00:00:00"
ROW_ORDER = ["last_discovery_ts", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


# ----------------------------------------------------------------- vertices
def _vertex_inputs(fx):
    v = fx.vertices()
    snap = v.filter(F.col("last_discovery_ts") < F.lit("2001-10-25").cast("timestamp_ntz"))
    inc = (v.filter(F.col("last_discovery_ts") >= F.lit("2001-10-15").cast("timestamp_ntz"))
           .withColumn("ne_status", F.lit("REDISCOVERED"))
           .withColumn("vendor", F.when(F.col("ne_type") == "ROUTER", "ACME").otherwise(F.col("vendor")))
           .withColumn("latitude", F.when(F.col("ne_type") == "ROUTER", F.lit(None)).otherwise(F.col("latitude")))
           .withColumn("neighbour_ne_name", F.lit("dropped edge-only column")))
    return snap, inc


def _vertex_merge(fx):
    snap, inc = _vertex_inputs(fx)
    return U.merge_vertices(snap, inc)


_V_INPUTS = """
WITH snap AS (SELECT * FROM vertices WHERE last_discovery_ts < TIMESTAMP '2001-10-25 00:00:00'),
inc0 AS (SELECT * REPLACE ('REDISCOVERED' AS ne_status,
                           CASE WHEN ne_type = 'ROUTER' THEN 'ACME' ELSE vendor END AS vendor,
                           CASE WHEN ne_type = 'ROUTER' THEN NULL ELSE latitude END AS latitude)
         FROM vertices WHERE last_discovery_ts >= TIMESTAMP '2001-10-15 00:00:00'),
inc AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY ne_name, coalesce(relation, '')
          ORDER BY last_discovery_ts DESC, ne_name DESC) AS rn FROM inc0) z WHERE rn = 1),
j AS (SELECT o.ne_name AS o_key, n.ne_name AS n_key, coalesce(o.ne_name, n.ne_name) AS k_ne_name,
             coalesce(o.relation, n.relation) AS k_relation, {pairs}
      FROM snap o FULL OUTER JOIN inc n ON o.ne_name = n.ne_name AND o.relation = n.relation)
"""
_VCOLS = [c for c in S.VERTEX_COLUMNS if c not in S.VERTEX_KEY]
_V_SQL = _V_INPUTS.format(pairs=", ".join(f"o.{c} AS o_{c}, n.{c} AS n_{c}" for c in _VCOLS))


@query("u1_merge_vertices", _V_SQL + "SELECT k_ne_name AS ne_name, k_relation AS relation, "
       + ", ".join(f"coalesce(n_{c}, o_{c}) AS {c}" for c in _VCOLS) + " FROM j", views=("vertices",))
def u1_merge_vertices(fx):
    """New vertex snapshot after the upsert (coalesce of non-null values)."""
    merged, _ = _vertex_merge(fx)
    return merged


def _changed_sql() -> str:
    items = []
    for c in _VCOLS:
        cond = (f"n_{c} IS NOT NULL" if c == "last_discovery_ts"
                else f"n_{c} IS NOT NULL AND n_{c} IS DISTINCT FROM o_{c}")
        items.append(f"CASE WHEN {cond} THEN '{c}' END")
    return "list_filter([" + ", ".join(items) + "], lambda x: x IS NOT NULL)"


@query("u4_vertex_outcomes", _V_SQL + f"""
SELECT k_ne_name AS ne_name, k_relation AS relation,
  CASE WHEN o_key IS NOT NULL THEN 'updated' ELSE 'created' END AS outcome,
  array_to_string({_changed_sql()}, ',') AS changed
FROM j WHERE n_key IS NOT NULL""", views=("vertices",))
def u4_vertex_outcomes(fx):
    """U1 outcomes with U4 changed properties (as a comma list)."""
    _, out = _vertex_merge(fx)
    return out.withColumn("changed", F.array_join("changed", ","))


_U5_LISTED = ["latitude", "vendor", "ne_type", "ne_status", "hostname", "ne_id", "parent_ne", "tag", "dest_bandwidth",
              "ckt_id", "is_deleted"]


def _targets(names: dict) -> dict[str, str]:
    return {edge: vertex for vertex, edge in names.items()}


def _u5_sql() -> str:
    source, far = _targets(U.SOURCE_COLUMNS), _targets(U.DESTINATION_COLUMNS)
    kinds = {"is_deleted": "BOOLEAN", "last_discovery_ts": "TIMESTAMP"}
    out = []
    for c in S.EDGE_COLUMNS + sorted({*source, *far} - set(S.EDGE_COLUMNS)):
        new = [f"{end}.{names[c]}" for end, names in (("s", source), ("d", far)) if names.get(c) in _U5_LISTED]
        if c == "last_discovery_ts":
            new = ["s.last_discovery_ts", "d.last_discovery_ts"]
        if c in S.EDGE_COLUMNS:
            new = [f"CAST({x} AS {kinds.get(c, 'VARCHAR')})" for x in new]
            out.append(f"coalesce({', '.join([*new, 'e.' + c])}) AS {c}")
        else:
            out.append(f"{'coalesce(' + ', '.join(f'CAST({x} AS VARCHAR)' for x in new) + ')' if new else 'NULL'} AS {c}")
    return f"""
WITH ch AS (SELECT ne_name, r.relation, CAST(id % 90 AS INT) AS latitude,
    CASE WHEN id % 2 = 0 THEN 'V_' || r.relation END AS vendor, 'PORT' AS ne_type,
    CASE WHEN id % 3 = 0 THEN 'DOWN' END AS ne_status, 'host-' || ne_name AS hostname, ne_id,
    CASE WHEN id % 10 = 0 THEN 'moved' END AS parent_ne, 't' || r.relation AS tag, CAST(id % 7 AS INT) AS dest_bandwidth,
    CAST(NULL AS VARCHAR) AS ckt_id, id % 5 = 0 AND id % 4 = 0 AS is_deleted,
    CASE r.relation WHEN 'LLDP' THEN TIMESTAMP '2002-01-01' ELSE TIMESTAMP '2002-02-02' END AS last_discovery_ts
  FROM network_element, (SELECT unnest(['LLDP', 'ISIS']) AS relation) r WHERE ne_type = 'INTERFACE' AND id % 5 = 0)
SELECT {", ".join(out)} FROM edges e
LEFT JOIN ch s ON s.ne_name = e.src_interface AND s.relation = e.relation
LEFT JOIN ch d ON d.ne_name = e.dest_interface AND d.relation = e.relation"""


@query("u5_propagate_vertex_changes", _u5_sql(), views=("network_element", "edges"))
def u5_propagate_vertex_changes(fx):
    """U5 + U6: changed interfaces, each under two relations, pushed onto the links of that relation."""
    when = F.when
    ch = (fx.network_element().filter("ne_type = 'INTERFACE' and id % 5 = 0")
          .select("ne_name", F.explode(F.array(F.lit("LLDP"), F.lit("ISIS"))).alias("relation"), "id", "ne_id")
          .withColumns({
              "latitude": (F.col("id") % 90).cast("int"),
              "vendor": when(F.col("id") % 2 == 0, F.concat(F.lit("V_"), "relation")),
              "ne_type": F.lit("PORT"), "ne_status": when(F.col("id") % 3 == 0, "DOWN"),
              "hostname": F.concat(F.lit("host-"), "ne_name"), "parent_ne": when(F.col("id") % 10 == 0, "moved"),
              "tag": F.concat(F.lit("t"), "relation"), "dest_bandwidth": (F.col("id") % 7).cast("int"),
              "ckt_id": F.lit(None).cast("string"), "is_deleted": F.col("id") % 4 == 0,
              "domain": F.lit("not listed"),
              "last_discovery_ts": when(F.col("relation") == "LLDP", "2002-01-01").otherwise("2002-02-02")
              .cast("timestamp_ntz"), "changed": F.array(*[F.lit(c) for c in _U5_LISTED])}).drop("id"))
    return U.propagate_vertex_changes(fx.edges(), ch)


# -------------------------------------------------------------------- edges
def _edge_inputs(fx):
    rows = fx.link_rows()
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    snap = fx.edges(rows.filter(F.col("last_discovery_ts") < cut))
    inc = (rows.filter(F.col("last_discovery_ts") >= cut)
           .withColumn("link_count", F.lit(1).cast("long"))
           .withColumn("status", F.lit("ACTIVE")).withColumn("is_deleted", F.lit(False)))
    live = fx.vertices().filter(~F.col("is_deleted"))
    return snap, inc, live


def _edge_merge(fx):
    snap, inc, live = _edge_inputs(fx)
    return U.merge_edges(snap, inc, live, RUN_TS, order=ROW_ORDER)


_E_ECOLS = [c for c in S.EDGE_COLUMNS if c not in S.EDGE_KEY]
_E_SQL = """
WITH snap AS (SELECT src_interface, dest_interface, relation,
  max(link_type) AS link_type,
  CASE WHEN upper(relation) = 'ISIS' THEN coalesce(trim(link_type), '') ELSE '' END AS link_type_key,
  max(start_ne) AS start_ne, max(end_ne) AS end_ne, max(src_type) AS src_type, max(dest_type) AS dest_type,
  max(bandwidth) AS bandwidth, max(last_discovery_ts) AS last_discovery_ts, max(tag) AS tag,
  max(area_ip_address) AS area_ip_address, 'CKT' || CAST(min(l_orderkey) AS VARCHAR) AS ckt_id,
  count(*) AS link_count,
  'ACTIVE' AS status, false AS is_deleted
  FROM link_rows WHERE last_discovery_ts < TIMESTAMP '1998-01-01 00:00:00'
  GROUP BY src_interface, dest_interface, relation,
    CASE WHEN upper(relation) = 'ISIS' THEN coalesce(trim(link_type), '') ELSE '' END),
inc0 AS (SELECT *, CASE WHEN upper(relation) = 'ISIS' THEN coalesce(trim(link_type), '') ELSE '' END AS link_type_key,
           CAST(1 AS BIGINT) AS link_count, 'ACTIVE' AS status, false AS is_deleted
         FROM link_rows WHERE last_discovery_ts >= TIMESTAMP '1998-01-01 00:00:00'),
inc AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
          PARTITION BY src_interface, dest_interface, relation, link_type_key
          ORDER BY last_discovery_ts DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC,
                   l_extendedprice DESC) AS rn FROM inc0) z WHERE rn = 1),
live AS (SELECT ne_name FROM vertices WHERE NOT is_deleted),
ok AS (SELECT * FROM inc WHERE start_ne IN (SELECT ne_name FROM live) AND end_ne IN (SELECT ne_name FROM live)),
skipped AS (SELECT * FROM inc WHERE NOT (start_ne IN (SELECT ne_name FROM live) AND end_ne IN (SELECT ne_name FROM live))),
j AS (SELECT o.src_interface AS o_key, n.src_interface AS n_key,
        coalesce(o.src_interface, n.src_interface) AS k_src_interface,
        coalesce(o.dest_interface, n.dest_interface) AS k_dest_interface,
        coalesce(o.relation, n.relation) AS k_relation, coalesce(o.link_type_key, n.link_type_key) AS k_link_type_key,
        {pairs}
      FROM snap o FULL OUTER JOIN ok n ON o.src_interface = n.src_interface AND o.dest_interface = n.dest_interface
        AND o.relation = n.relation AND o.link_type_key = n.link_type_key)
""".format(pairs=", ".join(f"o.{c} AS o_{c}, n.{c} AS n_{c}" for c in _E_ECOLS))


def _pick_sql(c: str) -> str:
    if c in ("ckt_id", "link_type"):
        return f"CASE WHEN n_key IS NOT NULL AND o_key IS NULL THEN n_{c} ELSE o_{c} END AS {c}"
    if c in ("start_ne", "end_ne"):
        return (f"CASE WHEN n_key IS NOT NULL AND n_{c} IS NOT NULL AND trim(n_{c}) <> '' THEN n_{c} "
                f"ELSE o_{c} END AS {c}")
    if c == "status":
        return f"CASE WHEN n_key IS NOT NULL AND o_key IS NULL THEN 'ACTIVE' ELSE o_{c} END AS {c}"
    if c == "is_deleted":
        return f"CASE WHEN n_key IS NOT NULL THEN coalesce(n_{c}, false) ELSE o_{c} END AS {c}"
    return f"CASE WHEN n_key IS NOT NULL THEN n_{c} ELSE o_{c} END AS {c}"


@query("u2_merge_edges", _E_SQL + "SELECT k_src_interface AS src_interface, k_dest_interface AS dest_interface, "
       "k_relation AS relation, k_link_type_key AS link_type_key, " + ", ".join(_pick_sql(c) for c in _E_ECOLS)
       + " FROM j", views=("vertices", "link_rows"))
def u2_merge_edges(fx):
    """New edge snapshot after upserting the post-1997 link rows."""
    merged, _ = _edge_merge(fx)
    return merged


_E_OUT = _E_SQL + """
, outc AS (
  SELECT k_src_interface AS src_interface, k_dest_interface AS dest_interface, k_relation AS relation,
         k_link_type_key AS link_type_key, CASE WHEN o_key IS NOT NULL THEN 'updated' ELSE 'created' END AS outcome
  FROM j WHERE n_key IS NOT NULL
  UNION ALL SELECT src_interface, dest_interface, relation, link_type_key, 'skipped' FROM skipped)
"""


@query("u2_edge_outcomes", _E_OUT + "SELECT * FROM outc", views=("vertices", "link_rows"))
def u2_edge_outcomes(fx):
    """U2 outcome per incoming edge key: created / updated / skipped."""
    _, out = _edge_merge(fx)
    return out


@query("u9_classify_records", _E_OUT + """
SELECT *, CASE outcome WHEN 'skipped' THEN 'failed' WHEN 'updated' THEN 'updated' ELSE 'new' END AS record_class
FROM outc""", views=("vertices", "link_rows"))
def u9_classify_records(fx):
    """New / updated / failed per incoming record."""
    snap, _, _ = _edge_inputs(fx)
    _, out = _edge_merge(fx)
    return U.classify_records(out, snap)


@query("u8_merge_summary", _E_OUT + """
SELECT 'edges' AS stage, outcome, count(*) AS rows FROM outc GROUP BY outcome
UNION ALL SELECT 'TOTAL', outcome, count(*) FROM outc GROUP BY outcome""", views=("vertices", "link_rows"))
def u8_merge_summary(fx):
    """U8: rows per stage and outcome, plus totals (edge stage)."""
    _, out = _edge_merge(fx)
    return U.merge_summary({"edges": out})


# ---------------------------------------------------------------- U7, U10, U12
@query("u7_link_child_to_parent", """
SELECT ne_name AS src_interface, parent_ne AS dest_interface, 'PARENT' AS relation, ne_name AS start_ne,
  parent_ne AS end_ne
FROM (SELECT DISTINCT ne_name, parent_ne FROM vertices
      WHERE ne_type IN ('ROUTER', 'SWITCH') AND parent_ne IS NOT NULL AND trim(parent_ne) <> '') c
WHERE parent_ne IN (SELECT ne_name FROM vertices)
  AND NOT EXISTS (SELECT 1 FROM parent_edges p WHERE p.relation = 'PARENT' AND p.start_ne = c.ne_name
                  AND p.end_ne = c.parent_ne AND p.src_type = 'ROUTER')""", views=("vertices", "parent_edges"))
def u7_link_child_to_parent(fx):
    """Parent edges missing for routers and switches when only the
    routers' parent edges are stored."""
    v = fx.vertices()
    children = v.filter(F.col("ne_type").isin("ROUTER", "SWITCH"))
    have = fx.parent_edges().filter(F.col("src_type") == "ROUTER")
    return U.link_child_to_parent(children, v, have)


_RET = """
WITH v2 AS (SELECT * FROM vertices UNION ALL
  SELECT * REPLACE ('LLDP' AS relation, last_discovery_ts + INTERVAL 5 DAY AS last_discovery_ts)
  FROM vertices WHERE ne_type = 'ROUTER'),
kv AS (SELECT * FROM v2 WHERE NOT coalesce(last_discovery_ts < TIMESTAMP '2001-10-30 00:00:00', false)),
dropped AS (SELECT ne_name FROM v2 WHERE last_discovery_ts < TIMESTAMP '2001-10-30 00:00:00'
            EXCEPT SELECT ne_name FROM kv),
ke AS (SELECT * FROM edges WHERE NOT coalesce(last_discovery_ts < TIMESTAMP '2001-10-30 00:00:00', false)
       AND start_ne NOT IN (SELECT ne_name FROM dropped) AND end_ne NOT IN (SELECT ne_name FROM dropped))
"""


def _retain(fx):
    """Routers stand under a second relation, found five days later: some names lose one vertex only."""
    v = fx.vertices()
    again = v.filter("ne_type = 'ROUTER'").withColumn("relation", F.lit("LLDP")).withColumn(
        "last_discovery_ts", F.expr("last_discovery_ts + interval 5 days"))
    return U.retain_recent(v.unionByName(again), fx.edges(), "2001-11-05")


@query("u10_retain_vertices", _RET + "SELECT * FROM kv", views=("vertices",))
def u10_retain_vertices(fx):
    """Vertices kept with run date 2001-11-05 and 7-day retention."""
    v, _, _ = _retain(fx)
    return v


@query("u10_retain_edges", _RET + "SELECT * FROM ke", views=("vertices", "edges"))
def u10_retain_edges(fx):
    """Links kept (own time inside the window, both ends kept)."""
    _, e, _ = _retain(fx)
    return e


@query("u10_retain_counts", _RET + """
SELECT 'vertices_before' AS item, count(*) AS n FROM v2 UNION ALL
SELECT 'vertices_after', count(*) FROM kv UNION ALL
SELECT 'edges_before', count(*) FROM edges UNION ALL
SELECT 'edges_after', count(*) FROM ke""", views=("vertices", "edges"))
def u10_retain_counts(fx):
    """Before / after counts."""
    _, _, c = _retain(fx)
    return c


@query("u12_duplicate_keys", """
SELECT ne_name, relation, count(*) AS copies FROM (
  SELECT DISTINCT 'LLDP' AS relation, src.id, src.ne_name, src.ne_type, l.last_discovery_time AS last_discovery_ts,
    src.latitude, src.longitude, src.capacity AS bandwidth, src.ne_source, src.ne_status, src.ckt_id,
    src.is_deleted, src.ne_id, src.ipv4, l.link_name AS hostname, p.ne_name AS parent_ne
  FROM (SELECT source_interface_ne_id AS if_id, last_discovery_time, link_name FROM lldp_link
        UNION ALL SELECT destination_interface_ne_id, last_discovery_time, link_name FROM lldp_link) l
  JOIN network_element src ON l.if_id = src.id
  LEFT JOIN network_element p ON src.parent_ne_id_fk = p.id
  WHERE p.is_deleted = 0 AND (p.ne_type IN ('ROUTER') OR p.ne_category IN ('ROUTER'))) z
GROUP BY ne_name, relation HAVING count(*) > 1""", views=("network_element", "lldp_link"))
def u12_duplicate_keys(fx):
    """Interface vertex keys seen on more than one LLDP interface row."""
    iv = interface_vertices(fx.network_element(), fx.link_table("LLDP"), "LLDP")
    return U.duplicate_keys(iv, S.VERTEX_KEY)
