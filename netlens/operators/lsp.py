"""MPLS LSP views.

Input is the nested LSP feed (``mpls_lsp_link``): one row per LSP with
``node_details`` (array of node structs in hop order), ``link_details``
(array of link structs), ``meta_info.fields`` (map of strings) and a
timestamp.  Per-LSP work uses higher-order functions on the arrays (no
explode + regroup); cross-LSP work (node uniqueness, paging, counts) is
ordinary aggregation / ordering.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.expr import csv_list, has_value, num_or_text_cmp, num_or_text_sort, page


def feed_at(feed: DataFrame, ts: str | None = None, lsp_name: str | None = None) -> DataFrame:
    """LSP rows at one feed time (``yyyyMMddHHmm``, UTC), optionally one LSP."""
    f = feed
    if has_value(ts):
        f = f.filter(F.col("timestamp") == F.to_timestamp_ntz(F.lit(ts), F.lit("yyyyMMddHHmm")))
    if has_value(lsp_name):
        f = f.filter(F.col("mpls_lsp_name") == lsp_name)
    return f


def feed_at_watermark(feed: DataFrame, watermark: DataFrame) -> DataFrame:
    """S8 -> S7: the LSP rows at the configured time (``watermark``: one row with a text
    ``yyyyMMddHHmm``).  A broadcast of one row; without a time there are no rows."""
    at = watermark.limit(1).select(F.to_timestamp_ntz("watermark", F.lit("yyyyMMddHHmm")).alias("timestamp"))
    return feed.join(F.broadcast(at), "timestamp", "left_semi")


def default_list(feed: DataFrame) -> DataFrame:
    """One row per LSP with its nested nodes, links and meta fields."""
    return feed.select("mpls_lsp_name", "source_ip", "destination_ip", "node_details", "link_details",
                       "meta_info", "timestamp")


def _endpoint_nodes(src: Column, dst: Column) -> Column:
    """Nodes whose ne_id is the source or destination IP, source first."""
    sel = F.filter("node_details", lambda n: (n["ne_id"] == src) | (n["ne_id"] == dst))
    return F.concat(F.filter(sel, lambda n: n["ne_id"] == src), F.filter(sel, lambda n: n["ne_id"] != src))


def aggregate_links(feed: DataFrame) -> DataFrame:
    """P2 links: per LSP the endpoint nodes; when there are at least two, one
    link start (source node) -> end (first destination node)."""
    sel = _endpoint_nodes(F.col("source_ip"), F.col("destination_ip"))
    x = feed.withColumn("_sel", sel).filter(F.size("_sel") >= 2)
    dst = F.filter("_sel", lambda n: n["ne_id"] == F.col("destination_ip"))
    return x.select(
        F.col("_sel")[0]["ne_name"].alias("start_ne"),
        F.coalesce(F.try_element_at(dst, F.lit(1))["ne_name"], F.col("_sel")[1]["ne_name"]).alias("end_ne"),
        F.lit(S.LSP).alias("relation"), F.col("mpls_lsp_name").alias("lsp_name"),
        F.col("meta_info.fields").alias("meta"), "timestamp")


def aggregate_nodes(feed: DataFrame) -> DataFrame:
    """P2 nodes: endpoint nodes of every LSP with >= 2 of them, unique by
    ne_id (the one of the smallest LSP name wins) — a min_by aggregate."""
    sel = _endpoint_nodes(F.col("source_ip"), F.col("destination_ip"))
    x = feed.withColumn("_sel", sel).filter(F.size("_sel") >= 2)
    nodes = x.select("mpls_lsp_name", F.explode("_sel").alias("n"))
    return (nodes.groupBy(F.col("n.ne_id").alias("ne_id"))
            .agg(F.min_by("n", "mpls_lsp_name").alias("n"))
            .select("ne_id", "n.ne_name", "n.hostname", "n.ipv4", "n.ne_type", "n.geo_l1_name",
                    "n.latitude", "n.longitude", "n.vendor"))


def aggregate_time(feed: DataFrame) -> DataFrame:
    """P2 time: the newest row's."""
    return feed.agg(F.max("timestamp").alias("timestamp"))


def lsp_detail(feed: DataFrame, lsp_name: str, source: str | None = None,
               destination: str | None = None) -> tuple[DataFrame, DataFrame]:
    """One LSP by exact name: its nodes and its link details with the
    alias renames applied (also inside explicit / record route lists when
    present).  Optional source / destination must match."""
    f = feed.filter(F.col("mpls_lsp_name") == lsp_name)
    if has_value(source):
        f = f.filter(F.lower("source_ip").contains(source.strip().lower()))
    if has_value(destination):
        f = f.filter(F.lower("destination_ip").contains(destination.strip().lower()))
    nodes = f.select(F.posexplode("node_details").alias("pos", "n")).select("pos", "n.*")
    links = f.select(F.explode("link_details").alias("l")).select("l.*")
    links = links.withColumnsRenamed({k: v for k, v in S.LSP_ALIASES.items() if k in links.columns})
    for lst in ("explicit_route_link_details", "record_route_link_details"):
        if lst in links.columns:
            fields = links.schema[lst].dataType.elementType.fields
            links = links.withColumn(lst, F.transform(lst, lambda e: F.struct(
                *[e[f.name].alias(S.LSP_ALIASES.get(f.name, f.name)) for f in fields])))
    return links, nodes


# ------------------------------------------------------------ P4 / P5 / P6
_META_RX = re.compile(r"^\s*([A-Za-z0-9_]+)\s*(>=|<=|!=|=|>|<)\s*(.*?)\s*$")


def meta_predicate(expr: str | None, meta: str = "meta") -> Column:
    """P5: ``key op value`` terms joined by commas (AND).  Operators
    >=, <=, !=, =, >, <.  A term whose key is missing fails; a term that does
    not parse is ignored.  Numeric compare when both sides parse, else
    case-insensitive text compare."""
    cond: Column = F.lit(True)
    if not has_value(expr):
        return cond
    for term in str(expr).split(","):
        m = _META_RX.match(term)
        if not m or not m.group(3):
            continue
        key, op, val = m.group(1), m.group(2), m.group(3)
        v = F.col(meta)[key]
        cond = cond & v.isNotNull() & num_or_text_cmp(v, op, val)
    return cond


def search_links(links: DataFrame, start: str | None = None, end: str | None = None,
                 lsp_name: str | None = None, meta_filter: str | None = None) -> DataFrame:
    """P4 filter part: start / end contain (case-insensitive), LSP name
    starts with, metaInfo comparisons."""
    x = links
    if has_value(start):
        x = x.filter(F.lower("start_ne").contains(start.strip().lower()))
    if has_value(end):
        x = x.filter(F.lower("end_ne").contains(end.strip().lower()))
    if has_value(lsp_name):
        x = x.filter(F.lower("lsp_name").startswith(lsp_name.strip().lower()))
    return x.filter(meta_predicate(meta_filter))


def search_page(links: DataFrame, order_by: str = "start_ne", descending: bool = False,
                lower: int = 0, upper: int = S.LSP_DEFAULT_PAGE - 1, **filters) -> DataFrame:
    """Filtered links ordered by a link column or a metaInfo key (mixed
    numeric / text order, nulls first when descending), tie-break start, end,
    LSP name; 0-based inclusive page ``[lower, upper]``."""
    x = search_links(links, **filters)
    key = F.col(order_by) if order_by in links.columns else F.col("meta")[order_by]
    order = num_or_text_sort(key, descending) + [F.col("start_ne"), F.col("end_ne"), F.col("lsp_name")]
    return page(x, order, lower, upper, inclusive=True)


def count_links(links: DataFrame, **filters) -> DataFrame:
    """Count of links matching the P4 predicates."""
    return search_links(links, **filters).agg(F.count(F.lit(1)).alias("total"))


def lsp_status(links: DataFrame, alarms: DataFrame, entity: str, alarm_names: DataFrame) -> DataFrame:
    """Total LSP links whose start contains the entity; down = open or
    reopened alarms on the entity with a configured name; active =
    max(total - down, 0)."""
    total = (links.filter(F.lower("start_ne").contains(entity.lower()))
             .select(F.lit("total").alias("k")))
    names = alarm_names.select(F.col("value").alias("alarm_name")).distinct()
    down = (alarms.filter((F.lower("entity_name") == entity.lower())
                          & F.upper("alarm_status").isin("OPEN", "REOPENED"))
            .join(names, "alarm_name", "left_semi").select(F.lit("down").alias("k")))
    both = total.unionByName(down)
    t = F.count(F.when(F.col("k") == "total", 1))
    d = F.count(F.when(F.col("k") == "down", 1))
    return both.agg(t.alias("total"), d.alias("down"), F.greatest(t - d, F.lit(0)).alias("active"))


def graph_by_start_end(links: DataFrame, nodes: DataFrame, start: str | None, end: str | None):
    """Links matching start / end (contains, case-insensitive) and the
    nodes named by their ends (case-insensitive)."""
    x = search_links(links, start=start, end=end)
    ends = x.select(F.lower("start_ne").alias("_k")).unionByName(x.select(F.lower("end_ne").alias("_k"))).distinct()
    n = nodes.join(ends, F.lower(nodes.ne_name) == ends._k, "left_semi")
    return x, n


def links_for_names(links: DataFrame, names: DataFrame, mode: str | None = None,
                    direction: str = "OUT") -> DataFrame:
    """LSP links for a name set.  ``mode='parent'`` keeps links with
    both ends in names; another non-blank mode is a relation filter; direction
    OUT (start in names, the default also for blank / unknown), IN (end in
    names) or BOTH (either end)."""
    n = names.select(F.col("ne_name").alias("_n"))
    m = (mode or "").strip().lower()
    x = links
    if m == "parent":
        return (x.join(n, x.start_ne == n._n, "left_semi").join(n, x.end_ne == n._n, "left_semi"))
    if has_value(mode):
        x = x.filter(F.upper("relation") == mode.strip().upper())
    d = (direction or "OUT").strip().upper()
    if d == "IN":
        return x.join(n, x.end_ne == n._n, "left_semi")
    if d == "BOTH":
        a = x.join(n, x.start_ne == n._n, "left_semi")
        b = x.join(n, x.end_ne == n._n, "left_semi").join(n, x.start_ne == n._n, "left_anti")
        return a.unionByName(b)
    return x.join(n, x.start_ne == n._n, "left_semi")


def nodes_for_links(nodes: DataFrame, links: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Node half of P9–P12: the nodes at the ends of the links and, if given, of the names."""
    ends = links.select(F.col("start_ne").alias("ne_name")).unionByName(links.select(F.col("end_ne").alias("ne_name")))
    if names is not None:
        ends = ends.unionByName(names.select("ne_name"))
    return nodes.join(ends.distinct(), "ne_name", "left_semi")


def region_names(vertices: DataFrame, region: str, ne_types: str, contains: bool = False) -> DataFrame:
    """Element names of a region (case-insensitive equality, or
    substring for P11) and types."""
    types = csv_list(ne_types, upper=True)
    v = vertices.filter(F.upper("ne_type").isin(types))
    g = F.lower("geography_l1")
    v = v.filter(g.contains(region.strip().lower()) if contains else (g == region.strip().lower()))
    return v.select("ne_name").distinct()


def region_search(links: DataFrame, vertices: DataFrame, region: str, ne_types: str,
                  directional: bool = True, contains: bool = False) -> DataFrame:
    """P10 (P11 with ``contains``): LSP links of a region's elements, outgoing
    only by default, either end when ``directional=False``."""
    names = region_names(vertices, region, ne_types, contains)
    return links_for_names(links, names, direction="OUT" if directional else "BOTH")
