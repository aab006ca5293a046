"""Sub-graph extraction (X1–X23): links and nodes around a set of names.

A sub-graph is returned as two DataFrames, ``(links, nodes)``; nothing is
collected.  Name sets are DataFrames with a ``ne_name`` column (never Python
lists) so they can be as large as the graph; membership tests are semi joins,
which AQE turns into broadcast joins only when the measured name set is small.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.expr import csv_list, has_coordinates, has_value
from ..session import materialize

LINK_COLUMNS = S.EDGE_COLUMNS


def names_df(df: DataFrame, col: str = "ne_name") -> DataFrame:
    return df.select(F.col(col).alias("ne_name")).filter(F.col("ne_name").isNotNull()).distinct()


def _semi(edges: DataFrame, names: DataFrame, side: str) -> DataFrame:
    n = names.select(F.col("ne_name").alias("_n"))
    return edges.join(n, edges[side] == n["_n"], "left_semi")


def links_from(edges: DataFrame, names: DataFrame, relation: str | None = None) -> DataFrame:
    """Outgoing links of the names (``start_ne`` in names)."""
    e = edges
    if has_value(relation):
        e = e.filter(F.upper("relation").isin(csv_list(relation, upper=True)))
    return _semi(e, names, "start_ne")


def links_between(edges: DataFrame, names: DataFrame) -> DataFrame:
    """X1 parent mode: both ends in names."""
    return _semi(_semi(edges, names, "start_ne"), names, "end_ne")


def links_touching(edges: DataFrame, names: DataFrame) -> DataFrame:
    """Either end in names, each link once (union of two semi joins, then the
    rows from the second that the first already has are removed by an
    anti join on the start side — no OR-join, no distinct over all columns)."""
    a = _semi(edges, names, "start_ne")
    b = _semi(edges, names, "end_ne")
    n = names.select(F.col("ne_name").alias("_n"))
    b_only = b.join(n, b["start_ne"] == n["_n"], "left_anti")
    return a.unionByName(b_only)


def remove_reverse_duplicates(links: DataFrame) -> DataFrame:
    """Per unordered end pair keep the direction of the smallest edge key
    (all parallel links in that direction stay, reverse ones go); a self-loop
    keeps only its smallest link; links with a null end are kept.

    The first direction per pair is a map-side combined ``min`` aggregate, then
    joined back: a hot pair reduces to one row before the shuffle, and the join
    of a hot key against a single row is split by AQE's skew handling (a
    window over the pair would put the whole group in one task)."""
    both = F.col("start_ne").isNotNull() & F.col("end_ne").isNotNull()
    # least / greatest skip nulls, so a link with one null end gets no pair
    lo = F.when(both, F.least("start_ne", "end_ne"))
    hi = F.when(both, F.greatest("start_ne", "end_ne"))
    keyed = links.withColumn("_lo", lo).withColumn("_hi", hi)
    first = (keyed.filter(F.col("_lo").isNotNull() & F.col("_hi").isNotNull())
             .groupBy("_lo", "_hi")
             .agg(F.min(F.struct(*[F.col(c) for c in S.EDGE_KEY], F.col("start_ne"))).alias("_f")))
    j = keyed.join(first, ["_lo", "_hi"], "left")
    f = F.col("_f")
    same_key = F.lit(True)
    for c in S.EDGE_KEY:
        same_key = same_key & (F.col(c) == f[c])
    keep = (f.isNull()
            | ((F.col("start_ne") != F.col("end_ne")) & (F.col("start_ne") == f["start_ne"]))
            | ((F.col("start_ne") == F.col("end_ne")) & same_key))
    return j.filter(keep).drop("_lo", "_hi", "_f")


def nodes_of_links(vertices: DataFrame, links: DataFrame, names: DataFrame | None = None,
                   strict: bool = False) -> DataFrame:
    """Names ∪ link starts ∪ link ends, as vertices with coordinates.
    Both ends come from one pass over the links (explode of the pair)."""
    ends = links.select(F.explode(F.array("start_ne", "end_ne")).alias("ne_name"))
    if names is not None:
        ends = ends.unionByName(names.select("ne_name"))
    ends = ends.filter(F.col("ne_name").isNotNull()).distinct()
    v = vertices.filter(has_coordinates(strict))
    return v.join(ends, "ne_name", "left_semi")


def subgraph(vertices: DataFrame, edges: DataFrame, names: DataFrame, mode: str | None = None,
             dedupe_reverse: bool = True) -> tuple[DataFrame, DataFrame]:
    """X1–X3 by mode: ``parent`` = both ends in names; ``lldp``/``ospf``/``isis``
    = outgoing links of that relation; default = outgoing links of any relation.
    Reverse duplicates are removed (X5), nodes are X4."""
    m = (mode or "").strip().lower()
    if m == "parent":
        links = links_between(edges, names)
        nodes = vertices.filter(has_coordinates()).join(names, "ne_name", "left_semi")
        return links, nodes
    rel = m.upper() if m in ("lldp", "ospf", "isis", "lldpswitch") else None
    links = links_from(edges, names, rel)
    if dedupe_reverse:
        links = remove_reverse_duplicates(links)
    return links, nodes_of_links(vertices, links, names)


def by_lsp_name(vertices: DataFrame, lsp_edges: DataFrame, lsp_name: str) -> tuple[DataFrame, DataFrame]:
    """Links of one LSP and their end nodes."""
    links = lsp_edges.filter(F.col("lsp_name") == lsp_name)
    return links, nodes_of_links(vertices, links)


def with_alarms(vertices: DataFrame, edges: DataFrame, alarms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct alarmed node names -> parent-mode sub-graph."""
    names = names_df(alarms, "entity_name")
    return subgraph(vertices, edges, names, "parent")


# ------------------------------------------------------- second vocabulary
def _ports(e: DataFrame) -> DataFrame:
    """Ports are the interface suffix after the element name."""
    return (e.withColumn("src_port", F.regexp_replace("src_interface", "^.*_", ""))
             .withColumn("dest_port", F.regexp_replace("dest_interface", "^.*_", "")))


def connection_category(relation: Column) -> Column:
    return F.when(relation == S.LLDP, "PHYSICAL").otherwise("LOGICAL")


def neighbours(vertices: DataFrame, edges: DataFrame, name: str, category: str | None = None,
               access_type: str = "ENODEB") -> DataFrame:
    """Links incident to one element (either end), optional connection
    category, enriched with both end vertices.  Valid-edge rule: a link from a
    non-access element to an access element (``access_type``) whose microwave
    type is MICROWAVE is dropped."""
    e = edges.filter((F.col("start_ne") == name) | (F.col("end_ne") == name))
    e = e.withColumn("connection_category", connection_category(F.col("relation")))
    if has_value(category):
        e = e.filter(F.upper("connection_category") == category.strip().upper())
    sv = vertices.select(F.col("ne_name").alias("s_name"), F.col("ne_type").alias("s_type"),
                         F.col("geography_l3").alias("s_city"), F.col("mw_type").alias("s_mw"))
    dv = vertices.select(F.col("ne_name").alias("d_name"), F.col("ne_type").alias("d_type"),
                         F.col("geography_l3").alias("d_city"), F.col("mw_type").alias("d_mw"),
                         F.col("hostname").alias("d_alias"))
    j = e.join(sv, e.start_ne == sv.s_name).join(dv, e.end_ne == dv.d_name)
    invalid = ((F.col("s_type") != access_type) & (F.col("d_type") == access_type)
               & (F.coalesce(F.col("d_mw"), F.lit("")) == "MICROWAVE"))
    j = _ports(j.filter(~invalid))
    return j.select("src_interface", "dest_interface", "relation", "link_type_key", "start_ne",
                    "end_ne", "src_port", "dest_port", "connection_category",
                    F.col("s_type").alias("src_type"), F.col("d_type").alias("dest_type"),
                    F.coalesce("s_city", F.lit("")).alias("src_city"),
                    F.coalesce("d_city", F.lit("")).alias("dest_city"),
                    F.col("d_alias").alias("dest_alias"))


def connections_by_type(vertices: DataFrame, edges: DataFrame, ne_types: str,
                        relations: str | None = None) -> DataFrame:
    """Vertices of the given types with their outgoing connections of the
    given relations: one row per (vertex, connection), plus the vertex's
    connection count; a vertex without connections gives one row with null
    connection fields.  Connections stay rows (a hub's list is never gathered
    into one value); the count is a partial aggregate joined back."""
    types = csv_list(ne_types, upper=True)
    v = vertices.filter(F.upper("ne_type").isin(types)).select("ne_name", "ne_type")
    e = edges
    if has_value(relations):
        e = e.filter(F.upper("relation").isin(csv_list(relations, upper=True)))
    conn = e.join(v.select(F.col("ne_name").alias("start_ne")), "start_ne", "left_semi").select(
        F.col("start_ne").alias("ne_name"), "end_ne", "relation", "src_interface", "dest_interface")
    counts = conn.groupBy("ne_name").agg(F.count(F.lit(1)).alias("n_connections"))
    return (v.join(conn, "ne_name", "left").join(counts, "ne_name", "left")
            .withColumn("n_connections", F.coalesce("n_connections", F.lit(0).cast("long"))))


def city_topology(vertices: DataFrame, edges: DataFrame, city: str) -> tuple[DataFrame, DataFrame]:
    """Vertices in a city, links touching them, plus far-end vertices."""
    inside = vertices.filter(F.col("geography_l3") == city)
    names = names_df(inside)
    links = links_touching(edges, names)
    return links, nodes_of_links(vertices, links, names)


def adjacency(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """X11: per live vertex, its neighbours (case-insensitive), with ports and
    link counts; ports are oriented to the vertex.  Both directions are made
    by a union (no self join), then reduced by (vertex, neighbour): a hub
    vertex is spread over as many groups as it has neighbours.  Rows are dealt by
    that pair first, whose links are few: sets of ports cannot be held in a hash
    map before the shuffle, and the aggregate would sort all rows of a task.
    The result is stored, in as many parts as keep those sorts in memory."""
    return materialize(_adjacency(vertices, edges), "adjacency", large=True)


def _adjacency(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    live = vertices.filter(~F.col("is_deleted")).select("ne_name")
    e = _ports(edges)
    fwd = e.select(F.col("start_ne").alias("ne_name"), F.col("end_ne").alias("neighbour"),
                   F.col("src_port").alias("port"), F.col("dest_port").alias("neighbour_port"),
                   "relation")
    rev = e.select(F.col("end_ne").alias("ne_name"), F.col("start_ne").alias("neighbour"),
                   F.col("dest_port").alias("port"), F.col("src_port").alias("neighbour_port"),
                   "relation")
    both = (fwd.unionByName(rev).join(live, "ne_name", "left_semi")
            .withColumn("neighbour_key", F.lower("neighbour")).repartition("ne_name", "neighbour_key"))
    return both.groupBy("ne_name", "neighbour_key").agg(
        F.min("neighbour").alias("neighbour"),
        F.array_sort(F.collect_set("port")).alias("ports"),
        F.array_sort(F.collect_set("neighbour_port")).alias("neighbour_ports"),
        F.count(F.lit(1)).alias("n_links"))


def direct_links(edges: DataFrame, vertices: DataFrame, a: str, b: str) -> DataFrame:
    """Live links a -> b; if there are none, the reverse links b -> a
    with ends and ports swapped and flag BACKWARD_TRUE (FORWARD_TRUE
    otherwise); adds domain and vendor of both ends."""
    e = _ports(edges.filter(~F.col("is_deleted")))
    fwd = e.filter((F.col("start_ne") == a) & (F.col("end_ne") == b)).withColumn("_o", F.lit(0))
    bwd = e.filter((F.col("start_ne") == b) & (F.col("end_ne") == a)).withColumn("_o", F.lit(1))
    both = fwd.unionByName(bwd)
    best = both.agg(F.min("_o").alias("_best"))
    # ``best`` is a one-row global aggregate: a proven size bound for broadcast
    chosen = both.join(F.broadcast(best), F.col("_o") == F.col("_best"))
    swap = F.col("_o") == 1
    out = chosen.select(
        F.when(swap, F.col("end_ne")).otherwise(F.col("start_ne")).alias("source"),
        F.when(swap, F.col("start_ne")).otherwise(F.col("end_ne")).alias("destination"),
        F.when(swap, F.col("dest_port")).otherwise(F.col("src_port")).alias("source_port"),
        F.when(swap, F.col("src_port")).otherwise(F.col("dest_port")).alias("destination_port"),
        "relation", "link_type_key",
        F.when(swap, "BACKWARD_TRUE").otherwise("FORWARD_TRUE").alias("orientation"))
    sv = vertices.select(F.col("ne_name").alias("source"), F.col("domain").alias("source_domain"),
                         F.col("vendor").alias("source_vendor"))
    dv = vertices.select(F.col("ne_name").alias("destination"),
                         F.col("domain").alias("destination_domain"),
                         F.col("vendor").alias("destination_vendor"))
    return out.join(sv, "source", "left").join(dv, "destination", "left")


def bundle_ports(edges: DataFrame, link_name: str) -> DataFrame:
    """Link name ``A_p#B_q`` -> source ports of A->B links whose source
    bundle is p and destination ports where the destination bundle is q.
    The bundle of an interface is its suffix; a null port is ''."""
    m = re.match(r"^(.*)_([^_#]*)#(.*)_([^_]*)$", link_name)
    if not m:
        raise ValueError(f"bad bundle link name {link_name!r}")
    a, p, b, q = m.groups()
    e = _ports(edges.filter((F.col("start_ne") == a) & (F.col("end_ne") == b)))
    src = e.filter(F.col("src_port") == p).select(
        F.lit("SOURCE").alias("side"), F.coalesce("src_port", F.lit("")).alias("port"), "relation",
        "link_type_key")
    dst = e.filter(F.col("dest_port") == q).select(
        F.lit("DESTINATION").alias("side"), F.coalesce("dest_port", F.lit("")).alias("port"),
        "relation", "link_type_key")
    return src.unionByName(dst)


def edges_by_keys(edges: DataFrame, keys: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Edges whose key is in a key DataFrame, selected fields."""
    out = edges.join(keys.select(*S.EDGE_KEY).distinct(), S.EDGE_KEY, "left_semi")
    return out.select(*(fields or S.EDGE_COLUMNS))


def by_ring(vertices: DataFrame, edges: DataFrame, ring_col: str, ring_id: str) -> tuple[DataFrame, DataFrame]:
    """Links of one ring (ring id column on the edge) and their nodes."""
    links = edges.filter(F.col(ring_col) == ring_id)
    return links, nodes_of_links(vertices, links)


def by_view_port(vertices: DataFrame, edges: DataFrame, level: int | list[int], lat_min: float, lat_max: float,
                 lng_min: float, lng_max: float) -> tuple[DataFrame, DataFrame]:
    """Vertices of a device level (or several) inside a box, links between them."""
    v = vertices.filter(F.col("device_level").isin(level)
                        & F.col("latitude").between(lat_min, lat_max)
                        & F.col("longitude").between(lng_min, lng_max))
    names = names_df(v)
    return links_between(edges, names), v


def range_read(df: DataFrame, order_cols: list[str], offset: int, count: int) -> DataFrame:
    """Deterministic offset window over a labelled set."""
    return df.orderBy(*order_cols).offset(offset).limit(count)


def logical_connectivity(vertices: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """Logical links incident to one element with both ends' site and type
    and the far end's node priority.  Names and ports keep the link direction;
    only the (asked, other) pair is oriented to the asked element."""
    e = _ports(edges.filter(((F.col("start_ne") == name) | (F.col("end_ne") == name))
                            & (connection_category(F.col("relation")) == "LOGICAL")))
    sv = vertices.select(F.col("ne_name").alias("start_ne"), F.col("geography_l3").alias("src_site"),
                         F.col("ne_type").alias("src_ne_type"))
    dv = vertices.select(F.col("ne_name").alias("end_ne"), F.col("geography_l3").alias("dest_site"),
                         F.col("ne_type").alias("dest_ne_type"), F.col("device_level").alias("dest_level"))
    j = e.join(sv, "start_ne", "left").join(dv, "end_ne", "left")
    asked_is_start = F.col("start_ne") == name
    return j.select(
        "src_interface", "dest_interface", "relation", "link_type_key", "start_ne", "end_ne",
        "src_port", "dest_port", "src_site", "dest_site", "src_ne_type", "dest_ne_type",
        F.lit(name).alias("element"),
        F.when(asked_is_start, F.col("end_ne")).otherwise(F.col("start_ne")).alias("peer"),
        F.when(F.col("dest_level") <= 3, "PRIMARY").otherwise("SECONDARY").alias("node_priority"))


def primary_nodes(vertices: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """X20 restricted to PRIMARY far ends."""
    return logical_connectivity(vertices, edges, name).filter(F.col("node_priority") == "PRIMARY")


def server_switch(vertices: DataFrame, edges: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """A live vertex with its SWITCH-ROUTER links plus logical links, and
    the end nodes."""
    live = vertices.filter((F.col("ne_name") == name) & ~F.col("is_deleted"))
    names = names_df(live)
    e = links_touching(edges, names)
    e = e.filter(((F.col("src_type") == "SWITCH") & (F.col("dest_type") == "ROUTER"))
                 | ((F.col("src_type") == "ROUTER") & (F.col("dest_type") == "SWITCH"))
                 | (connection_category(F.col("relation")) == "LOGICAL"))
    return e, nodes_of_links(vertices, e, names)


def owner_enrich(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Add domain and vendor of the source element; links whose source
    element is unknown are dropped (inner join)."""
    v = vertices.select(F.col("ne_name").alias("start_ne"), F.col("domain").alias("owner_domain"),
                        F.col("vendor").alias("owner_vendor"))
    return edges.join(v, "start_ne")


def criteria(vertices: DataFrame, edges: DataFrame, mode: str, vertex_filter: Column | None = None,
             edge_filter: Column | None = None, drop_isolated: bool = False):
    """Has-filters on vertices and/or edges.  VERTEX, EDGE, BOTH, or
    BOTH_E_BY_V = edges of the matched vertices (optionally dropping matched
    vertices without edges).  Returns (links, nodes)."""
    m = mode.upper()
    v = vertices if vertex_filter is None else vertices.filter(vertex_filter)
    e = edges if edge_filter is None else edges.filter(edge_filter)
    if m == "VERTEX":
        return e.limit(0), v
    if m == "EDGE":
        return e, v.limit(0)
    if m == "BOTH":
        return e, v
    names = names_df(v)
    links = links_touching(e, names)
    if drop_isolated:
        ends = links.select(F.col("start_ne").alias("ne_name")).unionByName(
            links.select(F.col("end_ne").alias("ne_name")))
        v = v.join(ends, "ne_name", "left_semi")
    return links, v

