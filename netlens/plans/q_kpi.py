"""Registered KPI / alarm enrichment queries (K1–K15) with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import kpi as K
from .catalog import query
from .sqlparts import EDGE_COLS

CODES = ["view", "purchase"]


def _pm(fx):
    return K.pm_table(fx.pm_sample(), fx.routers())


def _k1(fx):
    links = fx.edges().filter(F.col("relation") == "LLDP")
    out = K.links_with_kpi(links, _pm(fx), "2024-01-05", CODES, "supplier#0000000", 0, 99)
    return out.select(*links.columns,
                      F.size("start_kpi").alias("n_start_kpi"), F.size("end_kpi").alias("n_end_kpi"),
                      F.col("start_kpi")["view"].alias("start_view"),
                      F.col("start_kpi")["purchase"].alias("start_purchase"),
                      F.col("end_kpi")["view"].alias("end_view"))


@query("k1_links_with_kpi", f"""
WITH pg AS (SELECT * FROM edges WHERE relation = 'LLDP' AND contains(lower(start_ne), 'supplier#0000000')
            ORDER BY src_interface, dest_interface, relation, link_type_key LIMIT 100),
day AS (SELECT nodename, map_from_entries(list_filter(map_entries(kpijson), lambda e: e.key IN ('view', 'purchase')))
          AS kpijson FROM pm WHERE date = '2024-01-05')
SELECT {EDGE_COLS.replace('src_interface', 'pg.src_interface', 1)},
  coalesce(len(map_keys(s.kpijson)), 0) AS n_start_kpi, coalesce(len(map_keys(e.kpijson)), 0) AS n_end_kpi,
  s.kpijson['view'] AS start_view, s.kpijson['purchase'] AS start_purchase, e.kpijson['view'] AS end_view
FROM pg LEFT JOIN day s ON pg.start_ne = s.nodename LEFT JOIN day e ON pg.end_ne = e.nodename""",
       views=("edges", "pm"))
def k1_links_with_kpi(fx):
    """K1: first 100 LLDP links from routers, with start / end KPI maps of 2024-01-05."""
    return _k1(fx)


@query("k1_links_filtered_sorted", """
WITH pg AS (SELECT * FROM edges WHERE relation = 'LLDP' AND contains(lower(end_ne), 'customer#00000')
              AND contains(lower(tag), 'high')
            ORDER BY bandwidth DESC NULLS FIRST, src_interface, dest_interface, relation, link_type_key
            LIMIT 50 OFFSET 20),
day AS (SELECT nodename, kpijson FROM pm WHERE date = '2024-01-05' AND lower(vendor) = 'juniper')
SELECT pg.src_interface, pg.dest_interface, pg.bandwidth, s.kpijson['view'] AS start_view,
  e.kpijson['view'] AS end_view
FROM pg LEFT JOIN day s ON pg.start_ne = s.nodename LEFT JOIN day e ON pg.end_ne = e.nodename""",
       views=("edges", "pm"))
def k1_links_filtered_sorted(fx):
    """K1 with a filter map, a sort column and a vendor limit: rows 20 to 69."""
    out = K.links_with_kpi(fx.edges().filter(F.col("relation") == "LLDP"), _pm(fx), "2024-01-05", None, None, 20, 69,
                           filters={"end_ne": "Customer#00000", "tag": "high"}, order_by="bandwidth",
                           descending=True, scope={"vendor": "Juniper"})
    return out.select("src_interface", "dest_interface", "bandwidth", F.col("start_kpi")["view"].alias("start_view"),
                      F.col("end_kpi")["view"].alias("end_view"))


@query("k2_link_count", """
SELECT count(*) AS total FROM edges WHERE relation = 'LLDP' AND contains(lower(start_ne), 'supplier#0000000')""",
       views=("edges",))
def k2_link_count(fx):
    """K2: count for the K1 link set."""
    return K.count_links(fx.edges().filter(F.col("relation") == "LLDP"), "supplier#0000000")


@query("k3_kpi_ids", """
SELECT kpi_id, concat_ws('_', domain, vendor, kpi_name) AS kpi_key FROM kpi_def
WHERE contains(lower(kpi_name), 'click')""", views=("kpi_def",))
def k3_kpi_ids(fx):
    """K3: KPI ids whose name contains 'click'."""
    return K.kpi_ids_for_name(fx.kpi_def(), "click")


@query("k3_kpi_ids_chart", """
SELECT kpi_id, concat_ws('_', domain, vendor, kpi_name) AS kpi_key FROM kpi_def
WHERE contains(lower(kpi_name), 'rate') AND lower(domain) = 'transport' AND lower(vendor) = 'juniper'""",
       views=("kpi_def",))
def k3_kpi_ids_chart(fx):
    """K3 chart variant: domain and vendor must match too."""
    return K.kpi_ids_for_name(fx.kpi_def(), "rate", "Transport", "Juniper")


@query("k4_rename_kpis", """
SELECT s.*, coalesce(d.kpi_name, s.kpi_id) AS kpi FROM (
  SELECT p.nodename, p.granularity, p.date, p.kpi_id || '_' || lower(r.vendor) AS kpi_id, p.value, p.event_id
  FROM pm_sample p JOIN routers r ON p.nodename = r.ne_name) s
LEFT JOIN (SELECT DISTINCT kpi_id, kpi_name FROM kpi_def) d ON s.kpi_id = d.kpi_id""",
       views=("pm_sample", "routers", "kpi_def"))
def k4_rename_kpis(fx):
    """K4: KPI ids replaced by names in every sample."""
    r = fx.routers().select(F.col("ne_name").alias("nodename"), "vendor")
    s = fx.pm_sample().join(r, "nodename").withColumn(
        "kpi_id", F.concat(F.col("kpi_id"), F.lit("_"), F.lower("vendor"))).drop("vendor")
    return K.rename_kpis(s, fx.kpi_def()).select("nodename", "granularity", "date", "kpi_id", "value",
                                                 "event_id", "kpi")


@query("k5_orient_links", """
SELECT e.src_interface, e.dest_interface, e.relation, e.link_type_key,
  CASE WHEN coalesce(s.device_level > d.device_level, false) THEN e.end_ne ELSE e.start_ne END AS upper_ne,
  CASE WHEN coalesce(s.device_level > d.device_level, false) THEN e.start_ne ELSE e.end_ne END AS lower_ne,
  CASE WHEN coalesce(s.device_level > d.device_level, false) THEN e.dest_interface || '#' || e.src_interface
       ELSE e.src_interface || '#' || e.dest_interface END AS link_name,
  coalesce(s.device_level > d.device_level, false) AS swapped
FROM edges e LEFT JOIN vertices s ON e.start_ne = s.ne_name LEFT JOIN vertices d ON e.end_ne = d.ne_name""",
       views=("edges", "vertices"))
def k5_orient_links(fx):
    """K5: every link oriented upper level -> lower level, named src#dst."""
    return K.orient_links(fx.edges(), fx.vertices())


@query("k6_utilisation_max_latest", """
SELECT link_name, max(greatest(in_util, out_util)) AS max_util,
  arg_max(greatest(in_util, out_util), (date, greatest(in_util, out_util))) AS latest_util,
  max(date) AS latest_date
FROM link_samples GROUP BY link_name""", views=("link_samples",))
def k6_utilisation_max_latest(fx):
    """K6: per link max(in, out) overall and at the newest sample."""
    return K.utilisation_max_latest(fx.link_samples())


@query("k7_utilisation_avg", """
SELECT link_name, round(avg(in_util), 6) AS avg_in_util, round(avg(out_util), 6) AS avg_out_util
FROM link_samples GROUP BY link_name""", views=("link_samples",))
def k7_utilisation_avg(fx):
    """K7: average in / out utilisation per link."""
    return K.utilisation_avg(fx.link_samples())


@query("k8_preferred_granularity", """
SELECT * FROM link_samples WHERE granularity = CASE
  WHEN EXISTS (SELECT 1 FROM link_samples WHERE granularity = 'hourly') THEN 'hourly' ELSE 'daily' END""", views=("link_samples",))
def k8_preferred_granularity(fx):
    """K8: the hourly samples, as the response has any."""
    return K.preferred_granularity(fx.link_samples())


@query("k9_utilisation_chart", """
SELECT * FROM link_samples WHERE link_name IN (
  SELECT min(link_name) FROM link_samples WHERE starts_with(link_name, 'Supplier#000000003_'))""",
       views=("link_samples",))
def k9_utilisation_chart(fx):
    """K9: time-ordered samples of the first link of Supplier#000000003."""
    s = fx.link_samples()
    first = s.filter(F.col("link_name").startswith("Supplier#000000003_")).agg(F.min("link_name").alias("ln"))
    return K.utilisation_chart(s, first.withColumnRenamed("ln", "link_name"))


@query("k10_attach_utilisation", """
WITH k AS (SELECT src_interface || '#' || dest_interface AS link_name, * FROM edges WHERE relation = 'OSPF'),
u AS (SELECT link_name, max(greatest(in_util, out_util)) AS max_util,
        arg_max(greatest(in_util, out_util), (date, greatest(in_util, out_util))) AS latest_util,
        max(date) AS latest_date FROM link_samples GROUP BY link_name)
SELECT k.*, u.max_util, u.latest_util, u.latest_date FROM k LEFT JOIN u USING (link_name)""",
       views=("edges", "link_samples"))
def k10_attach_utilisation(fx):
    """OSPF links with their K6 utilisation."""
    e = fx.edges().filter(F.col("relation") == "OSPF")
    e = e.withColumn("link_name", F.concat(F.col("src_interface"), F.lit("#"), F.col("dest_interface")))
    return K.attach_utilisation(e, K.utilisation_max_latest(fx.link_samples()))


@query("k11_element_utilisation", """
SELECT ne_id, max(TRY_CAST(cpu AS DOUBLE)) AS max_cpu, max(TRY_CAST(memory AS DOUBLE)) AS max_memory
FROM element_sample GROUP BY ne_id""", views=("element_sample",))
def k11_element_utilisation(fx):
    """Max CPU / memory per router, text values parsed, junk skipped."""
    return K.element_utilisation(fx.element_sample())


_PRIO = "(VALUES ('CRITICAL', 1), ('MAJOR', 2), ('MINOR', 3), ('WARNING', 4)) p(category, priority)"


_TOP_ALARM = f"""
SELECT entity_name AS ne_name, priority, category, alarm_count FROM (
  SELECT *, row_number() OVER (PARTITION BY entity_name ORDER BY priority NULLS LAST) AS urgency
  FROM (SELECT entity_name, priority, min(category) AS category, count(*) AS alarm_count
        FROM alarms LEFT JOIN {_PRIO} USING (category)
        WHERE upper(alarm_status) IN ('OPEN', 'REOPENED') GROUP BY entity_name, priority) per_priority) ranked
WHERE urgency = 1"""


@query("k12_top_alarm", _TOP_ALARM, views=("alarms",))
def k12_top_alarm(fx):
    """Most urgent open alarm category per node with its count."""
    return K.top_alarm(fx.alarms(), K.priority_table(fx.spark))


@query("k13_attach_alarms", f"""
WITH t AS ({_TOP_ALARM})
SELECT v.*, t.priority, t.category, t.alarm_count
FROM vertices v LEFT JOIN t ON t.ne_name = v.ne_name AND v.ne_type <> 'SWITCH'""", views=("alarms", "vertices"))
def k13_attach_alarms(fx):
    """K13 node-wise: all vertices, those that are no switch with their top alarm."""
    return K.attach_alarms(fx.vertices(), fx.alarms(), K.priority_table(fx.spark), exclude_type="SWITCH")


@query("k13_location_alarms", """
WITH loc AS (SELECT v.geography_l3, count(*) AS location_alarms FROM alarms a JOIN vertices v ON a.entity_name = v.ne_name
             WHERE upper(a.alarm_status) IN ('OPEN', 'REOPENED') GROUP BY v.geography_l3)
SELECT v.*, coalesce(loc.location_alarms, 0) AS location_alarms
FROM vertices v LEFT JOIN loc ON loc.geography_l3 = v.geography_l3 AND v.ne_type <> 'CORE'""", views=("alarms", "vertices"))
def k13_location_alarms(fx):
    """K13 location-wise: open alarms per city; not looked up for CORE vertices."""
    return K.attach_alarms(fx.vertices(), fx.alarms(), K.priority_table(fx.spark), by="l3", exclude_type="CORE")


_CAUSE = """
SELECT link_name, CASE WHEN s.out_util IS NOT NULL AND (s.in_util IS NULL OR (s.out_util, 'OUT_UTIL') > (s.in_util, 'IN_UTIL'))
                       THEN 'OUT_UTIL' WHEN s.in_util IS NOT NULL THEN 'IN_UTIL' END AS cause_id,
  CASE WHEN s.out_util IS NOT NULL AND (s.in_util IS NULL OR (s.out_util, 'OUT_UTIL') > (s.in_util, 'IN_UTIL'))
       THEN s.out_util ELSE s.in_util END AS cause_value
FROM (SELECT link_name, arg_max(struct_pack(in_util := in_util, out_util := out_util),
                                (date, granularity, in_util, out_util)) AS s
      FROM link_samples GROUP BY link_name) z"""


@query("k14_cause_code", _CAUSE, views=("link_samples",))
def k14_cause_code(fx):
    """Per link, the larger KPI of the newest sample (id and value)."""
    return K.cause_code(fx.link_samples())


@query("k15_topology_enriched_links", f"""
WITH k AS (SELECT src_interface || '#' || dest_interface AS link_name, * FROM edges WHERE relation = 'ISIS'
           AND tag = '1-URGENT'),
c AS ({_CAUSE})
SELECT k.*, c.cause_id, c.cause_value FROM k LEFT JOIN c USING (link_name)""", views=("edges", "link_samples"))
def k15_topology_enriched_links(fx):
    """Urgent ISIS links (criteria query) with cause codes."""
    e = fx.edges().filter((F.col("relation") == "ISIS") & (F.col("tag") == "1-URGENT"))
    e = e.withColumn("link_name", F.concat(F.col("src_interface"), F.lit("#"), F.col("dest_interface")))
    links, _ = K.topology_with_enrichment(e, fx.vertices(), causes=K.cause_code(fx.link_samples()))
    return links
