"""Reusable DuckDB SQL fragments for the oracle twins (text only)."""

EDGE_COLS = ("src_interface, dest_interface, relation, link_type, link_type_key, start_ne, end_ne, "
             "src_type, dest_type, bandwidth, last_discovery_ts, tag, area_ip_address, ckt_id, "
             "link_count, status, is_deleted")

HAS_XY = ("(latitude IS NOT NULL AND trim(CAST(latitude AS VARCHAR)) <> '' "
          "AND longitude IS NOT NULL AND trim(CAST(longitude AS VARCHAR)) <> '')")

HAS_XY_STRICT = ("(TRY_CAST(CAST(latitude AS VARCHAR) AS DOUBLE) IS NOT NULL "
                 "AND TRY_CAST(CAST(longitude AS VARCHAR) AS DOUBLE) IS NOT NULL)")


def types_in(types: str) -> str:
    items = ", ".join(f"'{t.strip().upper()}'" for t in types.split(",") if t.strip())
    return f"upper(ne_type) IN ({items})"


def revdedupe(src: str) -> str:
    """SELECT over CTE ``src`` (edge columns) removing reverse duplicates."""
    return f"""
SELECT {EDGE_COLS} FROM (
  SELECT k.*, f.f_start, f.f_si, f.f_di, f.f_rel, f.f_lt, f.lo AS f_lo
  FROM (SELECT *, least(start_ne, end_ne) AS lo, greatest(start_ne, end_ne) AS hi FROM {src}) k
  LEFT JOIN (
    SELECT lo, hi, start_ne AS f_start, src_interface AS f_si, dest_interface AS f_di,
           relation AS f_rel, link_type_key AS f_lt
    FROM (SELECT *, least(start_ne, end_ne) AS lo, greatest(start_ne, end_ne) AS hi,
                 row_number() OVER (PARTITION BY least(start_ne, end_ne), greatest(start_ne, end_ne)
                   ORDER BY src_interface, dest_interface, relation, link_type_key) AS rn
          FROM {src} WHERE start_ne IS NOT NULL AND end_ne IS NOT NULL) z
    WHERE rn = 1) f ON k.lo = f.lo AND k.hi = f.hi
) x
WHERE f_lo IS NULL
   OR (start_ne <> end_ne AND start_ne = f_start)
   OR (start_ne = end_ne AND src_interface = f_si AND dest_interface = f_di AND relation = f_rel
       AND link_type_key = f_lt)"""


def nodes_of(links: str, names: str | None = None, strict: bool = False) -> str:
    extra = f" UNION SELECT ne_name FROM {names}" if names else ""
    xy = HAS_XY_STRICT if strict else HAS_XY
    return f"""
SELECT * FROM vertices WHERE {xy} AND ne_name IN (
  SELECT start_ne FROM {links} WHERE start_ne IS NOT NULL
  UNION SELECT end_ne FROM {links} WHERE end_ne IS NOT NULL{extra})"""
