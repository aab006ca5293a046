"""Registered queries of the whole ingestion (stages I* -> U1 / U2 -> U8) with DuckDB twins: the twins
put the stages' rows together and take the last value of every column."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..operators.load import ROW_ORDER, STAGES, Inventory, ingest
from ..session import materialize
from . import q_ingest  # noqa: F401  (its twins are the stages' rows)
from .catalog import REGISTRY, query

RUN_TS = "2002-01-01 00:00:00"
STAGE_QUERIES = [
    "i1_parent_vertices", "i4_interface_vertices_lldp", "i8_link_rows_lldp", "i5_interface_vertices_ospf",
    "i9_link_rows_ospf", "i2_parent_vertices_sdn", "i6_interface_vertices_isis", "i10_link_rows_isis",
    "i3_parent_vertices_switch", "i7_interface_vertices_switch", "i11_link_rows_switch"]
_ROWS = " UNION ALL BY NAME ".join(
    f"SELECT {n} AS stage, {str(links).lower()} AS links, * FROM ({REGISTRY[q][1]}) s{n}"
    for n, (q, (_, links, _)) in enumerate(zip(STAGE_QUERIES, STAGES, strict=True), 1))
_LAST = ", ".join(f"{c} DESC NULLS LAST" for c in ROW_ORDER)
_GRAPH = f"""
WITH all_rows AS MATERIALIZED ({_ROWS}),
v_rows AS (SELECT *, row_number() OVER (PARTITION BY stage, ne_name, relation ORDER BY {_LAST}) AS rn
           FROM all_rows WHERE trim(ne_name) <> '' AND trim(ne_type) <> ''),
names AS (SELECT ne_name, min(stage) AS since FROM v_rows GROUP BY ne_name),
e_rows AS (SELECT *, CASE WHEN relation = 'ISIS' THEN coalesce(trim(link_type), '') ELSE '' END AS link_type_key,
             (SELECT count(*) FROM names WHERE names.ne_name = r.neighbour_ne_name AND since <= stage) > 0 AS ok
           FROM all_rows r WHERE links AND trim(ne_name) <> '' AND trim(ne_type) <> ''
             AND trim(neighbour_ne_name) <> ''),
e_last AS (SELECT *, row_number() OVER (PARTITION BY stage, ne_name, neighbour_ne_name, link_type_key ORDER BY {_LAST}) AS rn
           FROM e_rows WHERE ok)
"""
_ATTRS = ["tag", "area_ip_address", "link_type", "source", "src_bandwidth"]
_PLAIN = [c for c in S.STORED_VERTEX if c not in ("ne_name", "relation", "attrs", "is_deleted")]


def _graph(fx):
    """The ingested graph: its tables are stored, so one run serves all queries of an application.  The
    inventory tables are stored tables that every stage reads."""
    if "ingested" not in fx._stored:
        inv = Inventory(fx.network_element(), fx.ne_location(),
                        [fx.geo(i) for i in range(1, 5)],
                        *(materialize(fx.link_table(x), "links", large=True) for x in ("LLDP", "OSPF", "ISIS")))
        fx._stored["ingested"] = ingest(inv, RUN_TS)
    return fx._stored["ingested"]


@query("ingest_vertices", _GRAPH + "SELECT ne_name, relation, " + ", ".join(
    f"arg_max({c}, stage) FILTER ({c} IS NOT NULL) AS {c}" for c in _PLAIN) + """,
  arg_max(is_deleted, stage) FILTER (is_deleted IS NOT NULL) <> 0 AS is_deleted, """ + ", ".join(
    f"arg_max({c}, stage) FILTER ({c} IS NOT NULL) AS attr_{c}" for c in _ATTRS)
       + " FROM v_rows WHERE rn = 1 GROUP BY ne_name, relation")
def ingest_vertices(fx):
    """The vertices after all stages, with some of their open properties."""
    v, _, _ = _graph(fx)
    attrs = {f"attr_{c}": F.try_element_at("attrs", F.lit(c)) for c in _ATTRS}
    attrs["attr_src_bandwidth"] = attrs["attr_src_bandwidth"].cast("double")
    return v.withColumns(attrs).drop("attrs")


_EDGE = {**{c: c for c in S.STORED_EDGE}, **S.EDGE_FROM_ROW,
         "start_id": "regexp_replace(ne_name, '^.*_', '')", "end_id": "regexp_replace(neighbour_ne_name, '^.*_', '')",
         "is_deleted": "coalesce(is_deleted <> 0, false)", "status": "'ACTIVE'", "created_at": f"TIMESTAMP '{RUN_TS}'",
         **{c: "NULL" for c in ("neighbour_vendor", "neighbour_domain", "neighbour_technology", "lsp_name", "lsp_id",
                                "hop_sequence")}}


@query("ingest_edges", _GRAPH + "SELECT " + ", ".join(f"{v} AS {c}" for c, v in _EDGE.items())
       + " FROM e_last WHERE rn = 1")
def ingest_edges(fx):
    """The edges after all stages, with all stored columns."""
    _, e, _ = _graph(fx)
    return e


_STAGE_NAMES = "[" + ", ".join(f"'{n}'" for n, _, _ in STAGES) + "]"
_SUMMARY = _GRAPH + f"""
, keys AS (SELECT ne_name, relation, min(stage) AS stage FROM v_rows GROUP BY ne_name, relation),
parts AS (
  SELECT stage, 'vertex' AS kind, 'read' AS outcome, count(*) AS n FROM all_rows GROUP BY stage
  UNION ALL SELECT stage, 'vertex', 'failed', count(*) FROM all_rows
    WHERE NOT coalesce(trim(ne_name) <> '' AND trim(ne_type) <> '', false) GROUP BY stage
  UNION ALL SELECT stage, 'vertex', 'created', count(*) FROM keys GROUP BY stage
  UNION ALL SELECT v.stage, 'vertex', 'updated', count(*) - (SELECT count(*) FROM keys k WHERE k.stage = v.stage)
    FROM v_rows v GROUP BY v.stage
  UNION ALL SELECT stage, 'edge', 'read', count(*) FROM all_rows WHERE links GROUP BY stage
  UNION ALL SELECT a.stage, 'edge', 'failed', count(*) - (SELECT count(*) FROM e_rows e WHERE e.stage = a.stage)
    FROM all_rows a WHERE links GROUP BY a.stage
  UNION ALL SELECT stage, 'edge', 'skipped', count(*) FROM e_rows WHERE NOT ok GROUP BY stage
  UNION ALL SELECT stage, 'edge', 'created', count(*) FROM e_last WHERE rn = 1 GROUP BY stage
  UNION ALL SELECT stage, 'edge', 'updated', count(*) FROM e_last WHERE rn > 1 GROUP BY stage),
nonzero AS (SELECT * FROM parts WHERE n > 0)
SELECT {_STAGE_NAMES}[stage] AS stage, kind, outcome, n AS rows FROM nonzero
UNION ALL SELECT 'TOTAL', kind, outcome, sum(n)::BIGINT FROM nonzero GROUP BY kind, outcome"""


@query("u8_ingest_summary", _SUMMARY)
def u8_ingest_summary(fx):
    """U8: rows read, created, updated, skipped and failed of every stage, and totals."""
    _, _, summary = _graph(fx)
    return summary
