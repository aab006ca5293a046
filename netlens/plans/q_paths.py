"""Registered path / reachability queries.

Oracles are recursive CTEs: paths (R1 up to its depth, R3 until every start has its
paths) and reachability (BFS; R2 with every vertex taken away in turn).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import paths as R
from .catalog import query

_HOPS = """
hops AS (SELECT DISTINCT a, b FROM (
  SELECT start_ne AS a, end_ne AS b FROM edges UNION ALL SELECT end_ne, start_ne FROM edges
  UNION ALL SELECT start_ne, end_ne FROM parent_edges UNION ALL SELECT end_ne, start_ne FROM parent_edges) z
  WHERE a IS NOT NULL AND b IS NOT NULL AND a <> b)"""

_R1_SQL = f"""
WITH RECURSIVE {_HOPS},
st AS (SELECT ne_name AS start_ne, pop_id AS sa FROM vertices WHERE ne_type = 'ROUTER' AND geography_l1 = 'ASIA'),
p(start_ne, sa, last, path, depth, done) AS (
  SELECT start_ne, sa, start_ne, [start_ne], 0, false FROM st
  UNION ALL
  SELECT p.start_ne, p.sa, h.b, list_append(p.path, h.b), p.depth + 1, upper(v.ne_type) IN ('AGG')
  FROM p JOIN hops h ON h.a = p.last JOIN vertices v ON v.ne_name = h.b
  WHERE NOT p.done AND p.depth < 4 AND NOT list_contains(p.path, h.b)
    AND upper(v.ne_type) IN ('ROUTER', 'SWITCH', 'AGG') AND v.pop_id = p.sa)
"""

# where an AGG site of the pop can be reached from
_R1_WAYS = """, ways(v) AS (
  SELECT DISTINCT h.a FROM hops h JOIN vertices v ON v.ne_name = h.b JOIN vertices u ON u.ne_name = h.a
  WHERE upper(v.ne_type) = 'AGG' AND v.pop_id = u.pop_id
  UNION
  SELECT h.a FROM ways w JOIN hops h ON h.b = w.v JOIN vertices v ON v.ne_name = h.b JOIN vertices u ON u.ne_name = h.a
  WHERE upper(v.ne_type) IN ('ROUTER', 'SWITCH') AND v.pop_id = u.pop_id)
"""


def _r1(fx):
    v = fx.vertices()
    starts = v.filter((F.col("ne_type") == "ROUTER") & (F.col("geography_l1") == "ASIA")).select("ne_name")
    hops = R.hop_rows(fx.edges(), fx.parent_edges())
    return R.simple_paths(v, hops, starts, ["ROUTER", "SWITCH"], term_types=["AGG"], same_attr="pop_id",
                          max_depth=4)


@query("r1_constrained_paths", _R1_SQL + _R1_WAYS + """
SELECT start_ne, last AS end_ne, depth, array_to_string(path, '>') AS path, done AS finished FROM p
WHERE done OR (depth = 4 AND last IN (SELECT v FROM ways))""",
       views=("vertices", "edges", "parent_edges"))
def r1_constrained_paths(fx):
    """Simple paths from ASIA routers through same-pop routers / switches to an AGG site: those that
    end within 4 hops, and flagged those that are still open then."""
    p = _r1(fx)
    return p.select("start_ne", "end_ne", "depth", F.array_join("path", ">").alias("path"), "finished")


def _asia(fx):
    v = fx.vertices()
    starts = v.filter((F.col("ne_type") == "ROUTER") & (F.col("geography_l1") == "ASIA")).select("ne_name")
    return v, R.hop_rows(fx.edges(), fx.parent_edges()), starts


# A vertex is on a simple path from a start to a site T, of any length, iff no other vertex cuts it off
# from what is left of {start, T}.  The twin takes every vertex of the pop away in turn.
_R2_SQL = f"""
WITH RECURSIVE {_HOPS},
kind AS (SELECT ne_name, upper(ne_type) AS ne_type, pop_id, geography_l1 FROM vertices WHERE pop_id IS NOT NULL),
one_way AS (SELECT h.a, CASE WHEN y.ne_type = 'AGG' THEN 'T' || y.pop_id ELSE h.b END AS b, x.pop_id
  FROM hops h JOIN kind x ON x.ne_name = h.a JOIN kind y ON y.ne_name = h.b AND y.pop_id = x.pop_id
  WHERE x.ne_type IN ('ROUTER', 'SWITCH') AND y.ne_type IN ('ROUTER', 'SWITCH', 'AGG')),
g AS MATERIALIZED (SELECT a, b, pop_id FROM one_way UNION SELECT b, a, pop_id FROM one_way),
v AS MATERIALIZED (SELECT DISTINCT a AS v, pop_id FROM g),
st AS (SELECT ne_name AS s, pop_id FROM kind WHERE ne_type = 'ROUTER' AND geography_l1 = 'ASIA'),
plain(s, pop_id, v) AS (SELECT s, pop_id, s FROM st
  UNION SELECT p.s, p.pop_id, g.b FROM plain p JOIN g ON g.a = p.v WHERE NOT starts_with(p.v, 'T')),
ok AS MATERIALIZED (SELECT DISTINCT s, pop_id, v AS t FROM plain WHERE starts_with(v, 'T')),
walk(s, cut, v) AS (
  SELECT ok.s, v.v, e.e FROM ok JOIN v ON v.pop_id = ok.pop_id, LATERAL (SELECT unnest([ok.s, ok.t]) AS e) e
  WHERE v.v <> e.e
  UNION SELECT w.s, w.cut, g.b FROM walk w JOIN g ON g.a = w.v WHERE g.b <> w.cut),
on_path AS (SELECT w.s, w.v FROM walk w JOIN ok ON ok.s = w.s GROUP BY w.s, w.v, ok.pop_id
  HAVING count(*) = (SELECT count(*) FROM v z WHERE z.pop_id = ok.pop_id) - 1)
SELECT DISTINCT x.ne_name, x.ne_type FROM vertices x JOIN on_path o
ON o.v = CASE WHEN upper(x.ne_type) = 'AGG' THEN 'T' || x.pop_id ELSE x.ne_name END"""


@query("r2_affected_nodes", _R2_SQL, views=("vertices", "edges", "parent_edges"))
def r2_affected_nodes(fx):
    """R2: distinct elements on the paths of any length from ASIA routers through same-pop routers /
    switches to an AGG site."""
    return R.vertices_on_paths(*_asia(fx), ["ROUTER", "SWITCH"], term_types=["AGG"], same_attr="pop_id")


# The twin goes on, hop by hop, with every start that has fewer than three paths so far.
_R3_TOP = f"""
WITH RECURSIVE {_HOPS},
st AS (SELECT ne_name AS start_ne, pop_id AS sa FROM vertices WHERE ne_type = 'ROUTER' AND geography_l1 = 'ASIA'),
p(start_ne, sa, last, path, depth, done, found) AS (
  SELECT start_ne, sa, start_ne, [start_ne], 0, false, 0 FROM st
  UNION ALL
  SELECT start_ne, sa, last, path, depth, done, (found + sum(done::INT) OVER (PARTITION BY start_ne))::INT
  FROM (SELECT p.start_ne, p.sa, h.b AS last, list_append(p.path, h.b) AS path, p.depth + 1 AS depth,
               upper(v.ne_type) IN ('AGG') AS done, p.found
        FROM p JOIN hops h ON h.a = p.last JOIN vertices v ON v.ne_name = h.b
        WHERE NOT p.done AND p.found < 3 AND NOT list_contains(p.path, h.b)
          AND upper(v.ne_type) IN ('ROUTER', 'SWITCH', 'AGG') AND v.pop_id = p.sa) z)
, top AS (SELECT * FROM (SELECT start_ne, last AS end_ne, depth, path, row_number() OVER (
    PARTITION BY start_ne ORDER BY depth, array_to_string(path, '>')) AS rn FROM p WHERE done) z WHERE rn <= 3)
"""


def _r3(fx):
    v, hops, starts = _asia(fx)
    return R.backhaul(v, hops, fx.edges(), starts, ["ROUTER", "SWITCH"], 3, term_types=["AGG"], same_attr="pop_id")


@query("r3_backhaul_paths", _R3_TOP + """
SELECT start_ne, end_ne, depth, array_to_string(path, '>') AS path FROM top""",
       views=("vertices", "edges", "parent_edges"))
def r3_backhaul_paths(fx):
    """The 3 shortest backhaul paths per start, of any length."""
    top, _ = _r3(fx)
    return top.select("start_ne", "end_ne", "depth", F.array_join("path", ">").alias("path"))


@query("r3_backhaul_links", _R3_TOP + """
, n AS (SELECT DISTINCT unnest(path) AS ne_name FROM top)
SELECT * FROM edges WHERE relation = 'LLDP' AND (start_ne IN (SELECT ne_name FROM n) OR end_ne IN (SELECT ne_name FROM n))""",
       views=("vertices", "edges", "parent_edges"))
def r3_backhaul_links(fx):
    """Physical links touching any node on the chosen backhaul paths."""
    _, links = _r3(fx)
    return links


@query("r4_level_reachable", f"""
WITH RECURSIVE {_HOPS},
inside(v) AS (
  SELECT ne_name FROM vertices WHERE ne_name = 'Customer#000000001'
  UNION
  SELECT h.b FROM inside JOIN hops h ON h.a = inside.v JOIN vertices x ON x.ne_name = h.b
  WHERE upper(x.ne_type) = 'ROUTER'),
ends AS (SELECT DISTINCT h.b FROM hops h JOIN vertices x ON x.ne_name = h.b
  WHERE h.a IN (SELECT v FROM inside) AND upper(x.ne_type) = 'AGG' AND h.b <> 'NATION_19')
SELECT 'Customer#000000001' AS element, count(*) > 0 AS reachable, count(*) AS upper_reached FROM ends""",
       views=("vertices", "edges", "parent_edges"))
def r4_level_reachable(fx):
    """Can Customer#000000001 reach an AGG via routers without its own AGG (NATION_19)?"""
    hops = R.hop_table(fx.edges(), fx.parent_edges())
    return R.level_reachable(fx.vertices(), hops, "Customer#000000001", ["AGG"], ["ROUTER"], "NATION_19")


_R5_SQL = """
WITH RECURSIVE g AS (SELECT DISTINCT a, b FROM (
  SELECT start_ne AS a, end_ne AS b FROM parent_edges UNION ALL SELECT end_ne, start_ne FROM parent_edges) z
  WHERE a <> 'NATION_3' AND b <> 'NATION_3'),
served(v) AS (SELECT ne_name FROM vertices WHERE upper(ne_type) IN ('CORE') AND ne_name <> 'NATION_3'
  UNION SELECT g.b FROM served JOIN g ON g.a = served.v),
around(v) AS (SELECT start_ne FROM parent_edges WHERE end_ne = 'NATION_3'
  UNION SELECT end_ne FROM parent_edges WHERE start_ne = 'NATION_3'
  UNION SELECT g.b FROM around JOIN g ON g.a = around.v),
flag AS (SELECT v AS ne_name, v NOT IN (SELECT v FROM served) AS dependent FROM around)
"""


def _r5(fx):
    hops = R.hop_table(fx.parent_edges())
    return R.impact(fx.vertices(), hops, "NATION_3", ["CORE"])


@query("r5_impact_nodes", _R5_SQL + """
SELECT v.ne_name, v.ne_type, f.dependent FROM vertices v JOIN flag f USING (ne_name)""",
       views=("vertices", "parent_edges"))
def r5_impact_nodes(fx):
    """Removing AGG NATION_3 from the hierarchy: which elements become dependent."""
    nodes, _ = _r5(fx)
    return nodes


@query("r5_impact_links", _R5_SQL + """
, h AS (SELECT DISTINCT a, b FROM (
  SELECT start_ne AS a, end_ne AS b FROM parent_edges UNION ALL SELECT end_ne, start_ne FROM parent_edges) z
  WHERE a IS NOT NULL AND b IS NOT NULL AND a <> b)
SELECT a, b FROM h WHERE a IN (SELECT ne_name FROM flag WHERE dependent)
UNION ALL SELECT a, b FROM h WHERE a = 'NATION_3'""", views=("vertices", "parent_edges"))
def r5_impact_links(fx):
    """Hierarchy links of the dependent elements and of the removed one."""
    _, links = _r5(fx)
    return links


@query("r5_impact_on_links", f"""
WITH RECURSIVE g AS (SELECT DISTINCT a, b FROM (
  SELECT start_ne AS a, end_ne AS b FROM edges WHERE relation = 'ISIS'
  UNION ALL SELECT end_ne, start_ne FROM edges WHERE relation = 'ISIS') z
  WHERE a <> b AND a <> 'Supplier#000000003' AND b <> 'Supplier#000000003'),
served(v) AS (SELECT ne_name FROM vertices WHERE ne_type = 'ROUTER' AND ne_name <> 'Supplier#000000003'
  UNION SELECT g.b FROM served JOIN g ON g.a = served.v),
around(v) AS (SELECT end_ne FROM edges WHERE relation = 'ISIS' AND start_ne = 'Supplier#000000003'
  UNION SELECT start_ne FROM edges WHERE relation = 'ISIS' AND end_ne = 'Supplier#000000003'
  UNION SELECT g.b FROM around JOIN g ON g.a = around.v)
SELECT x.ne_name, x.ne_type, x.ne_name NOT IN (SELECT v FROM served) AS dependent
FROM vertices x JOIN around ON around.v = x.ne_name""", views=("vertices", "edges"))
def r5_impact_on_links(fx):
    """R5 on the link graph: who depends on Supplier#000000003 over ISIS links."""
    nodes, _ = R.impact(fx.vertices(), R.hop_table(fx.edges(), relations=["ISIS"]),
                        "Supplier#000000003", ["ROUTER"])
    return nodes


_R5_LEVEL_LINKS = """
two_way AS (SELECT DISTINCT a, a_port, b, b_port FROM (
  SELECT start_ne AS a, regexp_replace(src_interface, '^.*_', '') AS a_port, end_ne AS b,
         regexp_replace(dest_interface, '^.*_', '') AS b_port FROM edges WHERE relation = 'LLDP' AND bandwidth >= 48
  UNION ALL SELECT end_ne, regexp_replace(dest_interface, '^.*_', ''), start_ne,
         regexp_replace(src_interface, '^.*_', '') FROM edges WHERE relation = 'LLDP' AND bandwidth >= 48
  UNION ALL SELECT start_ne, NULL, end_ne, NULL FROM parent_edges WHERE src_type IN ('ROUTER', 'AGG')
  UNION ALL SELECT end_ne, NULL, start_ne, NULL FROM parent_edges WHERE src_type IN ('ROUTER', 'AGG')) z WHERE a <> b),
lvl AS (SELECT ne_name, ne_type, CASE ne_type WHEN 'CORE' THEN 1 WHEN 'AGG' THEN 2 WHEN 'ROUTER' THEN 3 ELSE 4 END AS l
        FROM vertices),
near AS (SELECT DISTINCT b AS v FROM two_way WHERE a = 'Supplier#000000003'),
g AS (SELECT a, b, x.l AS al, y.l AS bl, y.ne_type AS bt FROM two_way JOIN lvl x ON x.ne_name = a JOIN lvl y ON y.ne_name = b
      WHERE a <> 'Supplier#000000003' AND b <> 'Supplier#000000003'),
switch_up(v) AS (SELECT a FROM g WHERE bt IN ('CORE', 'AGG')
  UNION SELECT g.a FROM switch_up u JOIN g ON g.b = u.v WHERE g.bt NOT IN ('CORE', 'AGG')),
agg_up(v) AS (SELECT a FROM g WHERE bt = 'CORE' AND al <= 2
  UNION SELECT g.a FROM agg_up u JOIN g ON g.b = u.v WHERE g.bt <> 'CORE' AND g.al <= 2 AND g.bl <= 2),
router_up(v) AS (SELECT a FROM two_way JOIN lvl x ON x.ne_name = a JOIN lvl y ON y.ne_name = b WHERE x.l = 3 AND y.l < 3),
refused AS (SELECT a AS v FROM two_way JOIN lvl x ON x.ne_name = a JOIN lvl y ON y.ne_name = b
  WHERE x.l > 3 AND y.l <= 3 GROUP BY a
  HAVING NOT bool_or(b = 'Supplier#000000003' OR b IN (SELECT v FROM router_up) OR (y.l = 2 AND b IN (SELECT v FROM agg_up)))),
dep(v) AS (
  SELECT v FROM near JOIN lvl ON ne_name = v WHERE (l = 4 AND v NOT IN (SELECT v FROM switch_up))
    OR (l = 2 AND v NOT IN (SELECT v FROM agg_up))
  UNION SELECT g.b FROM dep JOIN g ON g.a = dep.v WHERE g.bl >= g.al AND g.b NOT IN (SELECT v FROM refused))"""


def _r5_level(fx):
    links = fx.edges().filter("relation = 'LLDP' and bandwidth >= 48")
    up = fx.parent_edges().filter(F.col("src_type").isin("ROUTER", "AGG"))
    return R.correlated_connectivity(fx.vertices(), R.port_links(links, up), "Supplier#000000003")


@query("r5_correlated_nodes", f"""
WITH RECURSIVE {_R5_LEVEL_LINKS}
SELECT ne_name, ne_type, ne_name IN (SELECT v FROM dep) OR ne_name = 'Supplier#000000003' AS dependent FROM vertices
WHERE ne_name IN (SELECT v FROM near UNION SELECT v FROM dep) OR ne_name = 'Supplier#000000003'""",
       views=("vertices", "edges", "parent_edges"))
def r5_correlated_nodes(fx):
    """R5 by the level rule, over wide LLDP links and the routers' and sites' parents: what hangs on
    Supplier#000000003."""
    nodes, _ = _r5_level(fx)
    return nodes


@query("r5_correlated_links", f"""
WITH RECURSIVE {_R5_LEVEL_LINKS}
SELECT a, a_port, b, b_port FROM two_way WHERE a = 'Supplier#000000003'
UNION ALL
SELECT t.a, t.a_port, t.b, t.b_port FROM two_way t JOIN lvl x ON x.ne_name = t.a JOIN lvl y ON y.ne_name = t.b
WHERE t.a IN (SELECT v FROM dep) AND y.l >= x.l AND t.b <> 'Supplier#000000003' AND t.b NOT IN (SELECT v FROM refused)""",
       views=("vertices", "edges", "parent_edges"))
def r5_correlated_links(fx):
    """R5 by the level rule: the links of that."""
    _, links = _r5_level(fx)
    return links


@query("r7_hierarchy", """
WITH RECURSIVE d(ancestor, descendant, descendant_type, depth) AS (
  SELECT r.ne_name, c.ne_name, c.ne_type, 1 FROM vertices r JOIN vertices c ON c.parent_ne = r.ne_name
  WHERE r.ne_type = 'CORE'
  UNION ALL
  SELECT d.ancestor, c.ne_name, c.ne_type, d.depth + 1 FROM d JOIN vertices c ON c.parent_ne = d.descendant)
SELECT * FROM d""", views=("vertices",))
def r7_hierarchy(fx):
    """All descendants of every CORE site."""
    v = fx.vertices()
    return R.hierarchy(v, v.filter(F.col("ne_type") == "CORE").select("ne_name"))


@query("r7_children_by_type", """
SELECT parent_ne, ne_type AS child_type, count(*) AS children
FROM vertices WHERE parent_ne IS NOT NULL GROUP BY parent_ne, ne_type""", views=("vertices",))
def r7_children_by_type(fx):
    """R7 one level: children per parent and type."""
    return R.children_by_type(fx.vertices())


@query("r8_path_hops", _R1_SQL + _R1_WAYS + """
, paths AS (SELECT array_to_string(path, '>') AS path_id, path, done AS finished FROM p
          WHERE done OR (depth = 4 AND last IN (SELECT v FROM ways))),
steps AS (SELECT path_id, finished, i - 1 AS hop, path[i] AS ne_name, path[i + 1] AS next_ne
          FROM paths, range(1, len(path)) t(i)),
k AS (SELECT start_ne AS ne_name, end_ne AS next_ne, src_interface, dest_interface, relation, link_type_key,
        regexp_replace(src_interface, '^.*_', '') AS port, regexp_replace(dest_interface, '^.*_', '') AS next_port
      FROM edges
      UNION ALL SELECT end_ne, start_ne, src_interface, dest_interface, relation, link_type_key,
        regexp_replace(dest_interface, '^.*_', ''), regexp_replace(src_interface, '^.*_', '') FROM edges),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ne_name, next_ne
           ORDER BY src_interface, dest_interface, relation, link_type_key, port, next_port) AS rn FROM k) z WHERE rn = 1)
SELECT s.path_id, s.hop, s.ne_name, s.next_ne, b.relation, b.port, b.next_port, s.finished
FROM steps s LEFT JOIN best b ON s.ne_name = b.ne_name AND s.next_ne = b.next_ne""",
       views=("vertices", "edges", "parent_edges"))
def r8_path_hops(fx):
    """The R1 paths, finished and (flagged) open ones, as ordered hop rows with oriented ports."""
    return R.path_hops(_r1(fx), fx.edges(), keep=["finished"])


@query("r9_paths_to_target", f"""
WITH RECURSIVE {_HOPS},
inside(v) AS (
  SELECT ne_name FROM vertices WHERE ne_name = 'Customer#000000004'
  UNION
  SELECT h.b FROM inside JOIN hops h ON h.a = inside.v JOIN vertices x ON x.ne_name = h.b
  WHERE upper(x.ne_type) = 'SWITCH' AND h.b <> 'Supplier#000000007'),
prev AS (SELECT a AS prev FROM hops WHERE b = 'Supplier#000000007' AND a IN (SELECT v FROM inside)),
te AS (SELECT CASE WHEN start_ne = 'Supplier#000000007' THEN end_ne ELSE start_ne END AS prev,
         CASE WHEN start_ne = 'Supplier#000000007' THEN regexp_replace(src_interface, '^.*_', '')
              ELSE regexp_replace(dest_interface, '^.*_', '') END AS target_port
       FROM edges WHERE start_ne = 'Supplier#000000007' OR end_ne = 'Supplier#000000007')
SELECT 'Customer#000000004' AS element, 'Supplier#000000007' AS target,
  (SELECT count(*) FROM prev) AS last_hops,
  (SELECT count(*) FROM te WHERE prev IN (SELECT prev FROM prev) AND target_port <> '3') > 0 AS holds""",
       views=("vertices", "edges", "parent_edges"))
def r9_paths_to_target(fx):
    """Does Customer#000000004 reach Supplier#000000007 over switches, and by
    a link that meets the target on a port other than 3?"""
    hops = R.hop_table(fx.edges(), fx.parent_edges())
    return R.paths_to_target(fx.vertices(), hops, fx.edges(), "Customer#000000004", "Supplier#000000007",
                             "SWITCH", "3")
