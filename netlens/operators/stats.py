"""Filtered reads, counts and aggregates (A1–A10).

All aggregates are ``groupBy().agg()`` with partial (map-side) aggregation;
representative values use ``min_by`` so a hot group is reduced before the
shuffle and never materialised in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.expr import csv_list, has_coordinates, has_value, page


def map_filter(df: DataFrame, filters: dict[str, str] | None) -> DataFrame:
    """A1: AND over properties; a comma list means IN; blank values ignored."""
    cond: Column = F.lit(True)
    for k, v in (filters or {}).items():
        if not has_value(v):
            continue
        items = csv_list(v)
        cond = cond & (F.col(k).isin(items) if len(items) > 1 else (F.col(k) == items[0]))
    return df.filter(cond)


def _detail_source(vertices: DataFrame, edges: DataFrame, opmode: str, strict: bool) -> tuple[DataFrame, list[str]]:
    m = (opmode or "").strip().lower()
    if m == "vertex":
        return vertices.filter(has_coordinates(strict)), S.VERTEX_KEY
    if m == "edge":
        return edges, S.EDGE_KEY
    raise ValueError("opmode must be vertex or edge")


def topology_detail(vertices, edges, opmode: str, filters: dict | None, lower: int, upper: int) -> DataFrame:
    """A2: filtered vertices (with coordinates) or edges, page [lower, upper)
    in key order."""
    if lower < 0 or upper < lower:
        raise ValueError("bad page bounds")
    src, key = _detail_source(vertices, edges, opmode, False)
    return page(map_filter(src, filters), [F.col(c).asc_nulls_last() for c in key], lower, upper)


def topology_detail_count(vertices, edges, opmode: str, filters: dict | None, strict: bool = False) -> DataFrame:
    """A3 (A4 with ``strict``): count of the A2 rows, one-row DataFrame."""
    src, _ = _detail_source(vertices, edges, opmode, strict)
    return map_filter(src, filters).agg(F.count(F.lit(1)).alias("total"))


def count_by_geography(vertices: DataFrame, level: str, ne_types: str | None = None,
                       box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Vertices per geography value of a level (L1..L4) with one
    representative coordinate pair (of the smallest name having coordinates).
    A6 adds a type list and a strict box (lat_min, lat_max, lng_min, lng_max);
    an empty type list in A6 gives a single total row."""
    col = S.GEO_LEVEL_COLUMN[level.upper()]
    v = vertices
    if box is not None:
        la0, la1, lo0, lo1 = box
        v = v.filter((F.col("latitude") > la0) & (F.col("latitude") < la1)
                     & (F.col("longitude") > lo0) & (F.col("longitude") < lo1))
    if ne_types is not None:
        types = csv_list(ne_types, upper=True)
        if not types:
            return v.agg(F.count(F.lit(1)).alias("count"))
        v = v.filter(F.upper("ne_type").isin(types))
    xy = has_coordinates()
    return (v.filter(F.col(col).isNotNull())
            .groupBy(F.col(col).alias("geo_name"))
            .agg(F.count(F.lit(1)).alias("count"),
                 F.min_by(F.when(xy, F.col("latitude")), F.when(xy, F.col("ne_name"))).alias("latitude"),
                 F.min_by(F.when(xy, F.col("longitude")), F.when(xy, F.col("ne_name"))).alias("longitude")))


def max_modification_time(df: DataFrame, time_cols: list[str]) -> DataFrame:
    """Newest of several time columns as UTC 'yyyy-MM-dd HH:mm:ss', '' if none."""
    newest = F.greatest(*[F.max(c) for c in time_cols]) if len(time_cols) > 1 else F.max(time_cols[0])
    return df.agg(F.coalesce(F.date_format(newest, "yyyy-MM-dd HH:mm:ss"), F.lit(""))
                  .alias("max_modification_time"))


def geo_counts_with_labels(vertices: DataFrame, level: str) -> DataFrame:
    """Counts per location of a level with the names of the levels above."""
    n = int(level.upper().lstrip("L"))
    cols = [S.GEO_LEVEL_COLUMN[f"L{i}"] for i in range(1, n + 1)]
    return (vertices.filter(F.col(cols[-1]).isNotNull())
            .groupBy(*cols).agg(F.count(F.lit(1)).alias("count")))


def distinct_link_types(edges: DataFrame, names: DataFrame) -> DataFrame:
    """Distinct link types of the links touching the names."""
    n = names.select(F.col("ne_name").alias("_n"))
    a = edges.join(n, edges.start_ne == n._n, "left_semi").select("link_type")
    b = edges.join(n, edges.end_ne == n._n, "left_semi").select("link_type")
    return a.unionByName(b).filter(F.col("link_type").isNotNull()).distinct()


def distinct_protocols(edges: DataFrame, names: DataFrame, link_type: str | None = None) -> DataFrame:
    """A10: distinct protocols (relations) of the links touching the names,
    optionally of one link type."""
    e = edges if not has_value(link_type) else edges.filter(F.col("link_type") == link_type)
    n = names.select(F.col("ne_name").alias("_n"))
    a = e.join(n, e.start_ne == n._n, "left_semi").select(F.col("relation").alias("protocol"))
    b = e.join(n, e.end_ne == n._n, "left_semi").select(F.col("relation").alias("protocol"))
    return a.unionByName(b).distinct()
