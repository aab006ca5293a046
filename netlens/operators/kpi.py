"""KPI (PM) and alarm enrichment.

Sample tables are long (one row per node / link, time and KPI); per-link and
per-node reductions are map-side combined aggregates (``max``, ``max_by``,
``avg``), and enrichment is a left join *after* paging, so only the page's
rows meet the KPI table.  No side is broadcast by hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.expr import page

# alarm category priorities (1 = most urgent), fixed values
ALARM_PRIORITY = [("CRITICAL", 1), ("MAJOR", 2), ("MINOR", 3), ("WARNING", 4)]


def pm_table(samples: DataFrame, nodes: DataFrame) -> DataFrame:
    """KPI rows keyed by (nodename, date) with a ``kpijson`` map, plus the
    node's domain / vendor / technology.  One value per KPI = the max."""
    per = (samples.filter(F.col("granularity") == "daily")
           .groupBy("nodename", F.date_format("date", "yyyy-MM-dd").alias("date"), "kpi_id")
           .agg(F.max("value").alias("value")))
    m = per.groupBy("nodename", "date").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("kpi_id", F.col("value").cast("string")))))
        .alias("kpijson"))
    n = nodes.select(F.col("ne_name").alias("nodename"), "domain", "vendor", "technology")
    return m.join(n, "nodename", "left")


def links_with_kpi(links: DataFrame, pm: DataFrame, date: str, codes: list[str] | None,
                   contains: str | None, lower: int, upper: int, filters: dict[str, str] | None = None,
                   order_by: str | None = None, descending: bool = False,
                   scope: dict[str, str] | None = None) -> DataFrame:
    """K1: links filtered by ``start_ne`` contains and by ``filters`` (column ->
    text that it contains, case-insensitive), ordered by ``order_by`` and the
    key, paged ``[lower, upper]`` inclusive, then each page row joined to the
    start and end node KPI maps of ``date`` (missing -> empty map), maps
    restricted to ``codes``.  ``scope`` limits the KPI rows by domain, vendor or
    technology (equal, case-insensitive)."""
    x = _wanted(links, contains, filters)
    key = [F.col(c) for c in S.EDGE_KEY]
    if order_by:
        first = F.col(order_by)
        key = [first.desc_nulls_first() if descending else first.asc_nulls_last(), *key]
    pg = page(x, key, lower, upper, inclusive=True)
    for c, value in (scope or {}).items():
        pm = pm.filter(F.lower(c) == value.lower())
    day = pm.filter(F.col("date") == date).select("nodename", "kpijson")
    if codes:
        keep = F.array(*[F.lit(c) for c in codes])
        day = day.withColumn("kpijson", F.map_filter("kpijson", lambda k, v: F.array_contains(keep, k)))
    s = day.select(F.col("nodename").alias("_s"), F.col("kpijson").alias("start_kpi"))
    e = day.select(F.col("nodename").alias("_e"), F.col("kpijson").alias("end_kpi"))
    empty = F.create_map().cast("map<string,string>")
    j = pg.join(s, pg.start_ne == s._s, "left").join(e, pg.end_ne == e._e, "left")
    return j.select(*pg.columns, F.coalesce("start_kpi", empty).alias("start_kpi"),
                    F.coalesce("end_kpi", empty).alias("end_kpi"))


def _wanted(links: DataFrame, contains: str | None, filters: dict[str, str] | None) -> DataFrame:
    tests = [*([("start_ne", contains)] if contains else []), *(filters or {}).items()]
    for c, text in tests:
        links = links.filter(F.lower(F.col(c).cast("string")).contains(text.lower()))
    return links


def count_links(links: DataFrame, contains: str | None, filters: dict[str, str] | None = None) -> DataFrame:
    """K2: count of the K1 link set."""
    x = _wanted(links, contains, filters)
    return x.agg(F.count(F.lit(1)).alias("total"))


def kpi_ids_for_name(kpi_def: DataFrame, name: str, domain: str | None = None,
                     vendor: str | None = None) -> DataFrame:
    """K3: KPI definitions whose name contains ``name`` -> id and display key
    ``domain_vendor_name``; the chart variant also needs equal domain and
    vendor (case-insensitive)."""
    x = kpi_def.filter(F.lower("kpi_name").contains(name.lower()))
    if domain is not None:
        x = x.filter(F.lower("domain") == domain.lower())
    if vendor is not None:
        x = x.filter(F.lower("vendor") == vendor.lower())
    return x.select("kpi_id", F.concat_ws("_", "domain", "vendor", "kpi_name").alias("kpi_key"))


def rename_kpis(samples: DataFrame, kpi_def: DataFrame) -> DataFrame:
    """K4: replace KPI ids by names in every sample (unknown ids keep the id;
    whether the definitions are small enough to broadcast is measured by AQE)."""
    d = kpi_def.select("kpi_id", "kpi_name").distinct()
    return (samples.join(d, "kpi_id", "left")
            .withColumn("kpi", F.coalesce("kpi_name", "kpi_id")).drop("kpi_name"))


def orient_links(links: DataFrame, vertices: DataFrame) -> DataFrame:
    """K5: order the link ends by device level (upper level first; equal
    levels keep the stored direction) and name the link ``src#dst`` of the
    oriented interfaces."""
    lv = vertices.select(F.col("ne_name").alias("_n"), F.col("device_level").alias("_l"))
    s = lv.select(F.col("_n").alias("_sn"), F.col("_l").alias("_sl"))
    d = lv.select(F.col("_n").alias("_dn"), F.col("_l").alias("_dl"))
    j = links.join(s, links.start_ne == s._sn, "left").join(d, links.end_ne == d._dn, "left")
    swap = F.coalesce(F.col("_sl") > F.col("_dl"), F.lit(False))
    si = F.when(swap, F.col("dest_interface")).otherwise(F.col("src_interface"))
    di = F.when(swap, F.col("src_interface")).otherwise(F.col("dest_interface"))
    return j.select(*S.EDGE_KEY, F.when(swap, F.col("end_ne")).otherwise(F.col("start_ne")).alias("upper_ne"),
                    F.when(swap, F.col("start_ne")).otherwise(F.col("end_ne")).alias("lower_ne"),
                    F.concat(si, F.lit("#"), di).alias("link_name"), swap.alias("swapped"))


def preferred_granularity(samples: DataFrame) -> DataFrame:
    """K8: the hourly samples of a request if it has any, else the daily ones.
    One decision for all its links (a scalar sub-query)."""
    hourly = samples.agg(F.max(F.col("granularity") == "hourly").alias("h")).scalar()
    return samples.filter(F.col("granularity") == F.when(hourly, "hourly").otherwise("daily"))


def utilisation_max_latest(samples: DataFrame, key: str = "link_name") -> DataFrame:
    """K6: per sample value = max(in, out) ignoring nulls; per link the max
    and the value at the newest date (ties: larger value)."""
    x = samples.withColumn("util", F.greatest("in_util", "out_util"))
    return x.groupBy(key).agg(
        F.max("util").alias("max_util"),
        F.max_by("util", F.struct("date", "util")).alias("latest_util"),
        F.max("date").alias("latest_date"))


def utilisation_avg(samples: DataFrame, key: str = "link_name") -> DataFrame:
    """K7: average in and out utilisation per link."""
    return samples.groupBy(key).agg(F.round(F.avg("in_util"), 6).alias("avg_in_util"),
                                    F.round(F.avg("out_util"), 6).alias("avg_out_util"))


def utilisation_chart(samples: DataFrame, link_name: str | DataFrame, descending: bool = False) -> DataFrame:
    """K9: samples of one link (or of the names in a DataFrame) in time order."""
    x = (samples.filter(F.col("link_name") == link_name) if isinstance(link_name, str)
         else samples.join(link_name.select("link_name"), "link_name", "left_semi"))
    return x.orderBy(F.col("date").desc() if descending else F.col("date").asc(), "granularity")


def attach_utilisation(links: DataFrame, util: DataFrame, key: str = "link_name") -> DataFrame:
    """Left join of links (with a ``link_name``) and per-link utilisation."""
    return links.join(util, key, "left")


def element_utilisation(samples: DataFrame) -> DataFrame:
    """Max CPU and max memory per element; non-numeric / null skipped."""
    return samples.groupBy("ne_id").agg(
        F.max(F.col("cpu").try_cast("double")).alias("max_cpu"),
        F.max(F.col("memory").try_cast("double")).alias("max_memory"))


def priority_table(spark) -> DataFrame:
    return spark.createDataFrame(ALARM_PRIORITY, "category string, priority int")


def top_alarm(alarms: DataFrame, priority: DataFrame, open_only: bool = True) -> DataFrame:
    """Per node, the most urgent priority among its alarms with the number
    of alarms of that priority (and its first category).  A category without a
    priority comes after all others, with a null priority."""
    a = alarms
    if open_only:
        a = a.filter(F.upper("alarm_status").isin("OPEN", "REOPENED"))
    per = a.groupBy("entity_name", "category").agg(F.count(F.lit(1)).alias("cnt"))
    per = (per.join(priority, "category", "left").groupBy("entity_name", "priority")
           .agg(F.sum("cnt").alias("cnt"), F.min("category").alias("category")))
    known_first = F.struct(F.col("priority").isNull(), "priority")
    return per.groupBy("entity_name").agg(
        F.min_by(F.struct("priority", "category", "cnt"), known_first).alias("t")).select(
        F.col("entity_name").alias("ne_name"), "t.priority", "t.category", F.col("t.cnt").alias("alarm_count"))


def attach_alarms(nodes: DataFrame, alarms: DataFrame, priority: DataFrame, by: str = "node",
                  exclude_type: str = "ENODEB") -> DataFrame:
    """All nodes, left joined to their top alarm (node-wise) or to the
    open-alarm count of their location (``by='l3'``).  Alarms are not looked up
    for nodes of ``exclude_type``; the nodes stay."""
    asked = ~F.col("ne_type").eqNullSafe(exclude_type)
    if by == "node":
        top = top_alarm(alarms, priority).withColumnRenamed("ne_name", "_n")
        return nodes.join(top, (F.col("ne_name") == F.col("_n")) & asked, "left").drop("_n")
    open_a = alarms.filter(F.upper("alarm_status").isin("OPEN", "REOPENED"))
    loc = (open_a.join(nodes.select(F.col("ne_name").alias("entity_name"), "geography_l3"), "entity_name")
           .groupBy("geography_l3").agg(F.count(F.lit(1)).alias("location_alarms")))
    loc = loc.withColumnRenamed("geography_l3", "_l3")
    return nodes.join(loc, (F.col("geography_l3") == F.col("_l3")) & asked, "left").drop("_l3").withColumn(
        "location_alarms", F.coalesce("location_alarms", F.lit(0)))


def cause_code(samples: DataFrame, key: str = "link_name",
               kpis: dict[str, str] | None = None) -> DataFrame:
    """Per link the newest sample; of its KPI values the largest gives
    the cause id and value (per link, not shared across links).  ``kpis`` maps
    each KPI column to its id."""
    kpis = kpis or {"in_util": "IN_UTIL", "out_util": "OUT_UTIL"}
    newest = samples.groupBy(key).agg(
        F.max_by(F.struct(*kpis), F.struct("date", "granularity", *kpis)).alias("s"))
    entries = F.array(*[F.struct(F.col(f"s.{c}").alias("v"), F.lit(k).alias("k"))
                        for c, k in kpis.items()])
    best = F.array_max(F.filter(entries, lambda e: e["v"].isNotNull()))
    return newest.select(key, best["k"].alias("cause_id"), best["v"].alias("cause_value"))


def topology_with_enrichment(links: DataFrame, nodes: DataFrame, alarms: DataFrame | None = None,
                             priority: DataFrame | None = None, util: DataFrame | None = None,
                             causes: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """A topology (links, nodes) with alarms on nodes (K13) when given,
    utilisation (K10) and cause codes (K14) on links when given."""
    if alarms is not None and priority is not None:
        nodes = attach_alarms(nodes, alarms, priority)
    if util is not None:
        links = attach_utilisation(links, util)
    if causes is not None:
        links = links.join(causes, "link_name", "left")
    return links, nodes

