"""Ingestion views (I1–I14): inventory tables -> vertex and link rows.

The inventory is ``network_element`` (elements and interfaces, with parent,
neighbour and location foreign keys), ``ne_location``, ``geo_l1..l4`` and the
link tables (LLDP / OSPF / ISIS) plus ``lsp`` / ``lsp_hop``.

Join strategy
* geography levels and locations are left to AQE's measured-size broadcast.
* element self joins (parent, neighbour) are equi joins on ids: shuffle joins
  at scale, never broadcast by hint.
* "interface at either end of a link" is an OR join in SQL; here the link
  ends are unioned first (one row per end) and joined once on the id — the
  equivalent of a union of two equi joins, with no nested-loop join.
* distinct interfaces at link ends (I4–I7, I12): the link ends are made distinct as narrow
  rows, the elements as element rows, before they meet on the id that stays in the
  result; so no wide row is compared or shuffled once per link.
* links meet elements that have met their parent (I8, I11, I13): an element is fewer rows than
  its links, which are so dealt once per end only, the end with the wide columns last.
* link rows of routers (I9, I10) meet the source interface last, whose id is in the result: what
  is dealt by that id holds all equal rows, so they are made distinct where they are.
* the consecutive-hop self join (I13) joins on ``(lsp_id, hop_sequence)``,
  which spreads even a very long LSP over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.expr import col_has_value

# element types / categories of the parent-vertex stage, fixed values
PARENT_NE_TYPES = ["GNE", "ILA", "MDWDM", "NIC", "NODE", "OADM", "OTN", "ROUTER"]
PARENT_NE_CATEGORIES = ["GATEWAY_INTERFACE", "OPTICAL_AMPLIFIERS", "DWDM", "OTN", "NODE", "ROUTER"]

# identity columns that every element-shaped row carries
IDENTITY = ["pm_ems_id", "fm_ems_id", "cm_ems_id", "ipv6", "model", "mac_address", "friendly_name",
            "uuid", "serial_number"]


def _ne(ne: DataFrame, alias: str, cols: list[str]) -> DataFrame:
    return ne.select(*[F.col(c).alias(f"{alias}_{c}") for c in cols])


def _with_parent(elements: DataFrame, alias: str, parents: DataFrame, above: str) -> DataFrame:
    """``elements`` (columns ``{alias}_*``) with the columns ``{above}_*`` of their parent, if it exists."""
    return elements.join(parents, F.col(f"{alias}_parent_ne_id_fk") == F.col(f"{above}_id"), "left").drop(
        f"{alias}_parent_ne_id_fk", f"{above}_id")


def parent_vertices(ne: DataFrame, loc: DataFrame, geo: list[DataFrame], ne_types=None,
                    categories=None, source: str | None = None, switch: bool = False) -> DataFrame:
    """I1 (I2 with ``source='SDN'``, I3 with ``switch=True``): live elements of
    the given types and categories with location, geography names, parent and
    neighbour (and the neighbour's parent)."""
    types = ["SWITCH"] if switch else (ne_types or PARENT_NE_TYPES)
    cats = ["SWITCH"] if switch else (categories or PARENT_NE_CATEGORIES)
    base = ne.filter((F.col("is_deleted") == 0) & F.col("ne_type").isin(types)
                     & F.col("ne_category").isin(cats))
    if source:
        base = base.filter(F.col("source") == source)
    l = loc.select(F.col("id").alias("loc_id"), F.col("nel_id").alias("pop_id"),
                   F.col("nel_code").alias("pop_code"), F.col("friendly_name").alias("pop_name"),
                   "geography_l1_id_fk", "geography_l2_id_fk", "geography_l3_id_fk", "geography_l4_id_fk")
    x = base.join(l, base.ne_location_id_fk == l.loc_id, "left")
    for i, g in enumerate(geo, start=1):
        gi = g.select(F.col("id").alias(f"g{i}_id"), F.col("geo_name").alias(f"geography_l{i}"))
        x = x.join(gi, x[f"geography_l{i}_id_fk"] == gi[f"g{i}_id"], "left")
    par = _ne(ne, "par", ["id", "ne_name"])
    nb = _ne(ne, "nb", ["id", "ne_id", "ne_name", "latitude", "longitude", "parent_ne_id_fk"])
    nbp = _ne(ne, "nbp", ["id", "ne_name", "latitude", "longitude"])
    x = (x.join(par, x.parent_ne_id_fk == par.par_id, "left")
         .join(nb, x.network_element_id_fk == nb.nb_id, "left"))
    x = x.join(nbp, x.nb_parent_ne_id_fk == nbp.nbp_id, "left")
    cols = [
        F.lit(S.VERTEX).alias("relation"), "id", "ne_name", "source",
        F.col("last_discovery_time").alias("last_discovery_ts"), "latitude", "longitude",
        "ne_source", "ne_status", "ne_type", "ne_category", "vendor", "ckt_id", "is_deleted",
        "technology", "pop_id",
    ]
    if switch:
        cols += [F.col("pop_code").alias("pop_name"), F.col("modified_time").alias("ne_modify_ts")]
    else:
        cols += ["pop_code", "pop_name"]
    cols += [
        "domain", "ne_id", "ipv4", "hostname", "geography_l1", "geography_l2", "geography_l3",
        "geography_l4", F.col("nb_ne_id").alias("neighbour_ne_id"),
        F.col("nb_ne_name").alias("neighbour_ne_name"), F.col("nb_latitude").alias("neighbour_ne_lat"),
        F.col("nb_longitude").alias("neighbour_ne_long"), F.col("par_ne_name").alias("parent_ne"),
        F.col("nbp_ne_name").alias("neighbour_parent_ne_name"),
        F.col("nbp_longitude").alias("neighbour_parent_ne_long"),
        F.col("nbp_latitude").alias("neighbour_parent_ne_lat"), *IDENTITY,
    ]
    return x.select(*cols)


def _link_ends(link: DataFrame, extra: list) -> DataFrame:
    a = link.select(F.col("source_interface_ne_id").alias("if_id"), *extra)
    b = link.select(F.col("destination_interface_ne_id").alias("if_id"), *extra)
    return a.unionByName(b)


def interface_vertices(ne: DataFrame, link: DataFrame, relation: str, parent_type: str = "ROUTER") -> DataFrame:
    """Distinct interfaces at either end of a link whose parent is a
    live element of ``parent_type`` (by type or category)."""
    extra = [F.col("last_discovery_time").alias("last_discovery_ts"), F.col("link_name"),
             F.col("modified_time").alias("link_modify_ts")]
    host = "link_name" if relation in (S.LLDP, S.LLDPSWITCH) else "hostname"
    ends = _link_ends(link, extra)
    mine = ["if_id", "last_discovery_ts", *(["link_name"] if host == "link_name" else []),
            *(["link_modify_ts"] if relation == S.LLDPSWITCH else [])]
    ends = ends.select(*mine).distinct()
    src = ne.select(F.col("id").alias("if_id"), "ne_name", "ne_type", "latitude", "longitude",
                    F.col("capacity").alias("bandwidth"), "ne_source", "ne_status", "ckt_id",
                    "is_deleted", "ne_id", "ipv4", "hostname", "parent_ne_id_fk",
                    F.col("modified_time").alias("if_modify_ts"), *IDENTITY)
    src = src.drop(*(["hostname"] if host == "link_name" else []),
                   *([] if relation == S.LLDPSWITCH else ["if_modify_ts"]))
    par = ne.filter((F.col("is_deleted") == 0)
                    & ((F.col("ne_type") == parent_type) | (F.col("ne_category") == parent_type))
                    ).select(F.col("id").alias("p_id"), F.col("ne_name").alias("parent_ne"))
    owned = (src.join(par, F.col("parent_ne_id_fk") == F.col("p_id")).drop("parent_ne_id_fk", "p_id")
             .distinct())
    j = ends.join(owned, "if_id")
    cols = [F.lit(relation).alias("relation"), F.col("if_id").alias("id"), "ne_name", "ne_type",
            "last_discovery_ts", "latitude", "longitude", "bandwidth", "ne_source", "ne_status",
            "ckt_id", "is_deleted", "ne_id", "ipv4", F.col(host).alias("hostname"), "parent_ne", *IDENTITY]
    if relation == S.LLDPSWITCH:
        cols += ["link_modify_ts", "if_modify_ts"]
    return j.select(*cols)


def interface_vertices_isis(ne: DataFrame, link: DataFrame) -> DataFrame:
    """Distinct live INTERFACE elements at either end of an ISIS link whose
    two router ends both exist."""
    ids = ne.select(F.col("id").alias("_rid"))
    l = (link.join(ids, link.source_ne_id == ids._rid, "left_semi")
         .join(ids, link.destination_ne_id == ids._rid, "left_semi"))
    ends = _link_ends(l, [F.col("last_discovery_time").alias("last_discovery_ts"), "uuid"]).distinct()
    it = ne.filter((F.col("is_deleted") == 0) & (F.col("ne_type") == "INTERFACE")).select(
        F.col("id").alias("if_id"), "ne_name", "ne_type", "ne_source", "bandwidth", "ne_status",
        "is_deleted", "ne_id", "ipv4", "hostname", *[c for c in IDENTITY if c != "uuid"]).distinct()
    return ends.join(it, "if_id").select(
        F.lit(S.ISIS).alias("relation"), F.col("if_id").alias("id"), "ne_name", "ne_type",
        "last_discovery_ts", "ne_source", "bandwidth", "ne_status", "is_deleted", "ne_id",
        "ipv4", "hostname", *IDENTITY)


def link_rows_lldp(ne: DataFrame, link: DataFrame, relation: str = S.LLDP,
                   switch_rule: bool = False) -> DataFrame:
    """I8 (I11 with ``switch_rule``): live link with live source and
    destination interfaces, plus both parents (left joins)."""
    l = link.filter(F.col("is_deleted") == 0)
    live = ne.filter(F.col("is_deleted") == 0)
    s = _ne(live, "s", ["id", "ne_name", "ne_id", "ne_type", "capacity", "ne_source", "ne_status",
                        "ckt_id", "is_deleted", "ipv4", "parent_ne_id_fk", "modified_time", *IDENTITY])
    d = _ne(live, "d", ["id", "ne_name", "ne_id", "capacity", "latitude", "longitude", "parent_ne_id_fk"])
    pcols = ["id", "ne_name", "ne_type", "ne_category", "vendor", "technology", "domain", "latitude",
             "longitude"]
    s = _with_parent(s, "s", _ne(ne, "ps", pcols), "ps")
    d = _with_parent(d, "d", _ne(ne, "pd", pcols), "pd")
    j = (l.join(d, l.destination_interface_ne_id == d.d_id)
         .join(s, l.source_interface_ne_id == s.s_id))
    if switch_rule:
        st, dt = F.col("ps_ne_type"), F.col("pd_ne_type")
        j = j.filter(((st == "SWITCH") & dt.isin("SWITCH", "ROUTER"))
                     | ((dt == "SWITCH") & st.isin("SWITCH", "ROUTER")))
    cols = [
        F.lit(relation).alias("relation"), F.col("s_id").alias("id"), F.col("s_ne_name").alias("ne_name"),
        F.col("last_discovery_time").alias("last_discovery_ts"), F.col("ps_latitude").alias("latitude"),
        F.col("ps_longitude").alias("longitude"), F.col("s_capacity").alias("src_bandwidth"),
        F.col("d_capacity").alias("dest_bandwidth"), F.col("s_ne_source").alias("ne_source"),
        F.col("s_ne_status").alias("ne_status"), F.col("ps_ne_type").alias("src_type"),
        F.col("pd_ne_type").alias("dest_type"), F.col("s_ne_type").alias("ne_type"),
        F.col("ps_ne_category").alias("src_category"), F.col("pd_ne_category").alias("dest_category"),
        F.col("ps_vendor").alias("src_vendor"), F.col("pd_vendor").alias("dest_vendor"),
        F.col("s_ckt_id").alias("ckt_id"), F.col("s_is_deleted").alias("is_deleted"),
        F.col("ps_technology").alias("src_technology"), F.col("pd_technology").alias("dest_technology"),
        F.col("ps_domain").alias("src_domain"), F.col("pd_domain").alias("dest_domain"),
        F.col("s_ne_id").alias("ne_id"), F.col("s_ipv4").alias("ipv4"),
        F.col("link_name").alias("hostname"), F.col("d_ne_id").alias("neighbour_ne_id"),
        F.col("d_ne_name").alias("neighbour_ne_name"), F.col("d_latitude").alias("neighbour_ne_lat"),
        F.col("d_longitude").alias("neighbour_ne_long"), F.col("ps_ne_name").alias("parent_ne"),
        F.col("pd_ne_name").alias("neighbour_parent_ne_name"),
        F.col("pd_longitude").alias("neighbour_parent_ne_long"),
        F.col("pd_latitude").alias("neighbour_parent_ne_lat"),
        *[F.col(f"s_{c}").alias(c) for c in IDENTITY],
    ]
    if relation == S.LLDPSWITCH:
        cols += [F.col("modified_time").alias("link_modify_ts"),
                 F.col("s_modified_time").alias("if_modify_ts")]
    return j.select(*cols)


def link_rows_routed(ne: DataFrame, link: DataFrame, relation: str) -> DataFrame:
    """I9 (OSPF) / I10 (ISIS): link joined to both routers (inner) and both
    live INTERFACE ends; router value first, interface as fallback, for the
    location / type / vendor columns; distinct.  The source interface comes last: its join has dealt the rows
    by its id, so equal rows are together and the distinct deals them no more."""
    isis = relation == S.ISIS
    bw = "bandwidth" if isis else "capacity"

    def co(x: str, y: str) -> Column:
        return F.coalesce(F.col(x), F.col(y))

    shared = ["ne_name", "ne_type", "ne_category", "vendor", "technology", "domain", "latitude", "longitude"]
    src = _ne(ne, "r", ["id", *shared])
    rem = _ne(ne, "m", ["id", *shared])
    live_if = ne.filter((F.col("is_deleted") == 0) & (F.col("ne_type") == "INTERFACE"))
    a = _ne(live_if, "a", ["id", *shared, "ne_id", bw, "ne_source", "ne_status", "is_deleted", "ipv4", "hostname",
                           *IDENTITY])
    b = _ne(live_if, "b", ["id", *shared, "ne_id", bw])
    own = [link[c] for c in ["ckt_id", "tag", "last_discovery_time", *(["link_type"] if isis else ["area_ip_address"])]]
    own += [link["uuid"].alias("link_uuid")] if isis else []
    l = link.select("source_ne_id", "destination_ne_id", "source_interface_ne_id", "destination_interface_ne_id", *own)
    far = [co(f"m_{c}", f"b_{c}").alias(out) for c, out in (
        ("ne_type", "dest_type"), ("ne_category", "dest_category"), ("vendor", "dest_vendor"),
        ("technology", "dest_technology"), ("domain", "dest_domain"), ("ne_name", "neighbour_parent_ne_name"),
        ("latitude", "neighbour_parent_ne_lat"), ("longitude", "neighbour_parent_ne_long"))]
    far += [F.col("b_ne_id").alias("neighbour_ne_id"), F.col("b_ne_name").alias("neighbour_ne_name"),
            co("b_latitude", "m_latitude").alias("neighbour_ne_lat"),
            co("b_longitude", "m_longitude").alias("neighbour_ne_long"), F.col(f"b_{bw}").alias("dest_bandwidth")]
    far_end = (l.join(rem, l.destination_ne_id == rem.m_id)
               .join(b, l.destination_interface_ne_id == b.b_id)
               .select(*[c for c in l.columns if not c.startswith("destination_")], *far))
    j = (far_end.join(src, far_end.source_ne_id == src.r_id)
         .join(a, far_end.source_interface_ne_id == a.a_id))
    cols = [
        F.lit(relation).alias("relation"), "ckt_id", F.col("a_id").alias("id"),
        F.col("a_ne_name").alias("ne_name"), co("r_latitude", "a_latitude").alias("latitude"),
        co("r_longitude", "a_longitude").alias("longitude"), F.col("a_ne_type").alias("ne_type"),
        "tag", F.col("last_discovery_time").alias("last_discovery_ts"),
        F.col(f"a_{bw}").alias("src_bandwidth"), "dest_bandwidth",
        F.col("a_ne_source").alias("ne_source"), F.col("a_ne_status").alias("ne_status"),
        co("r_ne_type", "a_ne_type").alias("src_type"), "dest_type",
        co("r_ne_category", "a_ne_category").alias("src_category"), "dest_category",
        co("r_vendor", "a_vendor").alias("src_vendor"), "dest_vendor",
        F.col("a_is_deleted").alias("is_deleted"),
        co("r_technology", "a_technology").alias("src_technology"), "dest_technology",
        co("r_domain", "a_domain").alias("src_domain"), "dest_domain",
        F.col("a_ne_id").alias("ne_id"), F.col("a_ipv4").alias("ipv4"), F.col("a_hostname").alias("hostname"),
        "neighbour_ne_id", "neighbour_ne_name", "neighbour_ne_lat", "neighbour_ne_long",
        co("r_ne_name", "a_ne_name").alias("parent_ne"),
        "neighbour_parent_ne_name", "neighbour_parent_ne_lat", "neighbour_parent_ne_long",
        *[F.col(f"a_{c}").alias(c) for c in IDENTITY],
    ]
    cols += ["link_type", "link_uuid"] if isis else ["area_ip_address"]
    return j.select(*cols).distinct()


def lsp_hop_vertices(lsp: DataFrame, hop: DataFrame, ne: DataFrame) -> DataFrame:
    """Distinct hop interfaces of live LSPs whose parent is a ROUTER that
    is live (or has no deleted flag)."""
    l = lsp.filter(F.col("is_deleted") == 0).select(F.col("id").alias("lsp_id"),
                                                    F.col("modification_time").alias("lsp_modify_ts"))
    h = hop.filter(F.col("is_deleted") == 0).select("lsp_id", "interface_ne_id")
    s = ne.select(F.col("id").alias("interface_ne_id"), "ne_name", "ne_type", "latitude", "longitude",
                  "bandwidth", "ne_source", "ne_status", "ckt_id", "is_deleted", "ne_id", "ipv4",
                  "parent_ne_id_fk", *IDENTITY)
    p = ne.filter((F.col("is_deleted").isNull() | (F.col("is_deleted") == 0))
                  & ((F.col("ne_type") == "ROUTER") | (F.col("ne_category") == "ROUTER"))
                  ).select(F.col("id").alias("p_id"), F.col("ne_name").alias("parent_ne"))
    owned = (s.join(p, F.col("parent_ne_id_fk") == F.col("p_id")).drop("parent_ne_id_fk", "p_id")
             .distinct())
    j = l.join(h, "lsp_id").select("interface_ne_id", "lsp_modify_ts").distinct().join(owned, "interface_ne_id")
    return j.select(F.lit(S.LSP).alias("relation"), F.col("interface_ne_id").alias("id"), "ne_name",
                    "ne_type", "lsp_modify_ts", "latitude", "longitude", "bandwidth", "ne_source",
                    "ne_status", "ckt_id", "is_deleted", "ne_id", "ipv4", "parent_ne", *IDENTITY)


def lsp_hop_edges(lsp: DataFrame, hop: DataFrame, ne: DataFrame) -> DataFrame:
    """Consecutive live hops of one live LSP between live interfaces as an
    edge: equi self join on ``(lsp_id, hop_sequence) = (lsp_id, hop_sequence + 1)``."""
    def live(df: DataFrame) -> DataFrame:
        return df.filter(F.col("is_deleted") == 0)

    l = live(lsp).select(F.col("id").alias("lsp_id"), "lsp_name",
                         F.col("modification_time").alias("lsp_modify_ts"))
    h1 = live(hop).select("lsp_id", "hop_sequence", F.col("interface_ne_id").alias("src_if"))
    h2 = live(hop).select("lsp_id", (F.col("hop_sequence") - 1).alias("hop_sequence"),
                          F.col("interface_ne_id").alias("dst_if"))
    pair = h1.join(h2, ["lsp_id", "hop_sequence"]).join(l, "lsp_id")
    s = _ne(live(ne), "s", ["id", "ne_name", "ne_id", "ne_type", "ne_source", "ne_status", "ckt_id", "is_deleted",
                            "ipv4", "hostname", "parent_ne_id_fk", "bandwidth", *IDENTITY])
    d = _ne(live(ne), "d", ["id", "ne_name", "ne_id", "parent_ne_id_fk", "bandwidth", "latitude", "longitude"])
    pc = ["id", "ne_name", "ne_type", "ne_category", "vendor", "technology", "domain", "latitude",
          "longitude"]
    s, d = _with_parent(s, "s", _ne(ne, "ps", pc), "ps"), _with_parent(d, "d", _ne(ne, "pd", pc), "pd")
    j = pair.join(d, pair.dst_if == d.d_id).join(s, pair.src_if == s.s_id)
    ends = [F.col(f"{p}_{c}").alias(f"{out}_{name}")
            for p, out in (("ps", "src"), ("pd", "dest"))
            for c, name in (("ne_type", "type"), ("ne_category", "category"), ("vendor", "vendor"),
                            ("technology", "technology"), ("domain", "domain"))]
    return j.select(
        F.lit(S.LSP).alias("relation"), "lsp_name", "lsp_id", "hop_sequence", "lsp_modify_ts",
        F.col("s_ne_name").alias("src_interface"), F.col("d_ne_name").alias("dest_interface"),
        F.col("ps_ne_name").alias("start_ne"), F.col("pd_ne_name").alias("end_ne"), *ends,
        F.col("s_bandwidth").alias("src_bandwidth"), F.col("d_bandwidth").alias("dest_bandwidth"),
        F.col("s_ne_id").alias("start_ne_id"), F.col("d_ne_id").alias("end_ne_id"),
        F.col("s_id").alias("id"), *[F.col(f"s_{c}").alias(c) for c in (
            "ne_type", "ne_source", "ne_status", "ckt_id", "is_deleted", "ipv4", "hostname")],
        F.col("ps_latitude").alias("latitude"), F.col("ps_longitude").alias("longitude"),
        F.col("d_latitude").alias("neighbour_ne_lat"), F.col("d_longitude").alias("neighbour_ne_long"),
        F.col("pd_latitude").alias("neighbour_parent_ne_lat"),
        F.col("pd_longitude").alias("neighbour_parent_ne_long"),
        *[F.col(f"s_{c}").alias(c) for c in IDENTITY])


def validate_rows(rows: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """Split rows into (valid, rejects).  Edge-shaped rows need ne_name,
    neighbour_ne_name, relation and ne_type; vertex rows need ne_name and
    ne_type.  Rejects carry the first failing reason."""
    need = (["ne_name", "neighbour_ne_name", "relation", "ne_type"] if kind == "edge"
            else ["ne_name", "ne_type"])
    reason = F.lit(None).cast("string")
    for c in reversed(need):
        reason = F.when(~col_has_value(c), F.lit(f"missing {c}")).otherwise(reason)
    tagged = rows.withColumn("reject_reason", reason)
    return (tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
            tagged.filter(F.col("reject_reason").isNotNull()))
