"""Vertex search (Q1–Q16).

Every search takes the mandatory ``ne_types`` CSV and an optional
``relation`` CSV.  Relation rule: the vertex's own relation is in the list
*or* one of its incident links has it — the second half is a semi join of
vertices against the link ends of those relations (no OR-join).

Argument handling (which dimension was given, regex escaping) is plain
driver-side Python: it decides which lazy plan to build.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.expr import csv_list, has_coordinates, has_value, prefix_regex
from .subgraph import links_from, links_touching, names_df, nodes_of_links, remove_reverse_duplicates


def _base(vertices: DataFrame, edges: DataFrame | None, ne_types: str, relation: str | None,
          located: bool = True) -> DataFrame:
    """Elements of the types; only a search by relation reads ``edges`` (else it may be None)."""
    types = csv_list(ne_types, upper=True)
    if not types:
        raise ValueError("ne_types is mandatory")
    v = vertices.filter(F.upper("ne_type").isin(types))
    if located:  # searches answer with elements that can be drawn
        v = v.filter(has_coordinates())
    rels = csv_list(relation, upper=True)
    if rels:
        e = edges.filter(F.upper("relation").isin(rels))
        ends = e.select(F.col("start_ne").alias("ne_name")).unionByName(
            e.select(F.col("end_ne").alias("ne_name")))
        via_edge = v.join(ends, "ne_name", "left_semi")
        own = v.filter(F.upper("relation").isin(rels))
        v = own.unionByName(via_edge.join(own.select("ne_name", "relation"),
                                          ["ne_name", "relation"], "left_anti"))
    return v


def _one_per(df: DataFrame, prop: str) -> DataFrame:
    """One vertex per distinct property value: the smallest name.  A
    ``min_by`` aggregate (partial, map-side) instead of a window so a value
    shared by a third of all vertices still reduces before the shuffle."""
    cols = [c for c in df.columns if c != prop]
    return (df.groupBy(prop)
            .agg(F.min_by(F.struct(*cols), F.col("ne_name")).alias("_v"))
            .select(prop, "_v.*").select(*df.columns))


def by_name(vertices, edges, ne_types, pattern, relation=None) -> DataFrame:
    """Q1: name starts with (case-insensitive, literal), coordinates present."""
    v = _base(vertices, edges, ne_types, relation)
    return v.filter(F.col("ne_name").rlike(prefix_regex(pattern)))


def by_pop_id(vertices, edges, ne_types, pop_id, relation=None) -> DataFrame:
    """Q2: numeric pop id equal, or its decimal text contains the input;
    non-numeric input gives an empty result."""
    v = _base(vertices, edges, ne_types, relation)
    text = str(pop_id).strip()
    try:
        x = int(text)
    except ValueError:
        return v.limit(0)
    return v.filter((F.col("pop_id") == x) | F.col("pop_id").cast("string").contains(text))


def by_pop_name(vertices, edges, ne_types, name, relation=None) -> DataFrame:
    """Q3: pop name regex (spaces match any white space), one vertex per pop."""
    v = _base(vertices, edges, ne_types, relation)
    v = v.filter(F.col("pop_name").rlike(prefix_regex(name, space_flexible=True)))
    return _one_per(v, "pop_name")


def by_ipv4(vertices, edges, ne_types, ip, relation=None) -> DataFrame:
    """Q4: ipv4 starts with the literal."""
    v = _base(vertices, edges, ne_types, relation)
    return v.filter(F.col("ipv4").rlike(prefix_regex(ip)))


def by_pop_code(vertices, edges, ne_types, code, relation=None) -> DataFrame:
    """Q5: as Q3 on pop code."""
    v = _base(vertices, edges, ne_types, relation)
    v = v.filter(F.col("pop_code").rlike(prefix_regex(code, space_flexible=True)))
    return _one_per(v, "pop_code")


def region_names(vertices, edges, ne_types, region, relation=None) -> DataFrame:
    v = _base(vertices, edges, ne_types, relation)
    return names_df(v.filter(F.col("geography_l1") == region))


def by_region(vertices, edges, ne_types, region, relation=None, link_relation=None):
    """Q6: names in region -> outgoing links (X2/X3) -> reverse-duplicate
    removal (X5) -> nodes (X4).  Returns (links, nodes)."""
    names = region_names(vertices, edges, ne_types, region, relation)
    links = remove_reverse_duplicates(links_from(edges, names, link_relation))
    return links, nodes_of_links(vertices, links, names)


def by_area_tag(vertices, edges, area_ip=None, tag=None):
    """Q7: links equal on the given area ip and/or tag, plus end nodes."""
    if not has_value(area_ip) and not has_value(tag):
        raise ValueError("area_ip or tag required")
    e = edges
    if has_value(area_ip):
        e = e.filter(F.col("area_ip_address") == area_ip.strip())
    if has_value(tag):
        e = e.filter(F.col("tag") == tag.strip())
    links = e.dropDuplicates(["src_interface", "dest_interface", "relation", "link_type_key"])
    return links, nodes_of_links(vertices, links)


def by_region_tag(vertices, edges, ne_types, region, tag, relation=None):
    """Q8: links of a tag with either end in the region, plus end nodes with
    coordinates."""
    names = region_names(vertices, edges, ne_types, region, relation)
    e = edges.filter(F.col("tag") == tag.strip())
    links = links_touching(e, names)
    return links, nodes_of_links(vertices, links)


DIMENSIONS = ["ne_name", "pop_id", "pop_name", "ipv4", "pop_code", "area_ip", "region", "tag"]


def unified(vertices, edges, ne_types, relation=None, **dims):
    """Q10: every given dimension searched, nodes unioned and unique by name
    (first dimension in DIMENSIONS order wins), links concatenated as-is."""
    node_parts, link_parts = [], []
    for rank, d in enumerate(DIMENSIONS):
        x = dims.get(d)
        if not has_value(x):
            continue
        links = None
        if d == "ne_name":
            nodes = by_name(vertices, edges, ne_types, x, relation)
        elif d == "pop_id":
            nodes = by_pop_id(vertices, edges, ne_types, x, relation)
        elif d == "pop_name":
            nodes = by_pop_name(vertices, edges, ne_types, x, relation)
        elif d == "ipv4":
            nodes = by_ipv4(vertices, edges, ne_types, x, relation)
        elif d == "pop_code":
            nodes = by_pop_code(vertices, edges, ne_types, x, relation)
        elif d == "area_ip":
            links, nodes = by_area_tag(vertices, edges, area_ip=x)
        elif d == "region":
            links, nodes = by_region(vertices, edges, ne_types, x, relation)
        else:
            links, nodes = by_area_tag(vertices, edges, tag=x)
        node_parts.append(nodes.withColumn("_rank", F.lit(rank)))
        if links is not None:
            link_parts.append(links.select(*edges.columns))
    if not node_parts:
        raise ValueError("no search dimension given")
    allnodes = node_parts[0]
    for p in node_parts[1:]:
        allnodes = allnodes.unionByName(p)
    cols = [c for c in allnodes.columns if c not in ("ne_name", "_rank")]
    nodes = (allnodes.groupBy("ne_name")
             .agg(F.min_by(F.struct(*cols), F.col("_rank")).alias("_v"))
             .select("ne_name", "_v.*").select(*vertices.columns))
    if link_parts:
        links = link_parts[0]
        for p in link_parts[1:]:
            links = links.unionByName(p)
    else:
        links = edges.limit(0)
    return links, nodes


def or_search(vertices, edges, ne_types, text, relation=None) -> DataFrame:
    """Q11: elements with coordinates, OR over name / pop name / pop id regex and
    the area ip or tag of an incident link with that exact value; the relation
    rule as in the other searches."""
    v = _base(vertices, edges, ne_types, relation)
    rx = prefix_regex(text)
    e = edges.filter((F.col("area_ip_address") == text) | (F.col("tag") == text))
    ends = e.select(F.col("start_ne").alias("_e")).unionByName(
        e.select(F.col("end_ne").alias("_e"))).distinct().withColumn("_hit", F.lit(True))
    v = v.join(ends, v.ne_name == ends._e, "left")
    cond = (F.col("ne_name").rlike(rx) | F.col("pop_name").rlike(rx)
            | F.col("pop_id").cast("string").rlike(rx) | F.col("_hit").isNotNull())
    return v.filter(cond).drop("_e", "_hit")


def by_pop_id_prefix(vertices, edges, ne_types, prefix: str, relation=None) -> DataFrame:
    """Q12: pop id whose decimal text starts with the digits given."""
    v = _base(vertices, edges, ne_types, relation, located=False)
    p = str(prefix).strip()
    if not p.isdigit():
        return v.limit(0)
    return v.filter(F.col("pop_id").cast("string").startswith(p))


def scope_filter(vertices: DataFrame, scope: DataFrame) -> DataFrame:
    """Q14: keep vertices inside the caller's area of authority.  ``scope``
    rows are (column, value); a vertex is allowed when any rule matches, on
    whatever column (numbers and times by their text).  One pass: each vertex becomes its (column, value)
    pairs, which meet the rules in one semi join on both; the keys that are
    allowed are joined back."""
    plain = [f.name for f in vertices.schema.fields if not hasattr(f.dataType, "elementType")
             and not hasattr(f.dataType, "valueType") and not hasattr(f.dataType, "fields")]
    pairs = vertices.select(*S.VERTEX_KEY, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in plain])).alias("_p"))
    allowed = (pairs.select(*S.VERTEX_KEY, "_p.column", "_p.value").filter(F.col("value").isNotNull())
               .join(scope.select("column", "value"), ["column", "value"], "left_semi")
               .select(*[F.col(c).alias(f"_{c}") for c in S.VERTEX_KEY]).distinct())
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in S.VERTEX_KEY]
    return vertices.join(allowed, same[0] & same[1], "left_semi")


def by_property(vertices: DataFrame, prop: str, value, fields: list[str] | None = None,
                first: bool = False) -> DataFrame:
    """Q15: vertices where ``prop == value``, selected fields; ``first`` keeps
    the smallest name only."""
    v = vertices.filter(F.col(prop) == value)
    if first:
        v = v.orderBy("ne_name").limit(1)
    return v.select(*(fields or vertices.columns))


def with_coordinates(vertices: DataFrame, strict: bool = False) -> DataFrame:
    """Q16: vertices with coordinates (strict: both parse as double)."""
    return vertices.filter(has_coordinates(strict))

