"""The whole ingestion: inventory tables -> stored vertices and edges, stage by stage.

The stages run in a fixed order (LLDP / OSPF, ISIS, SWITCH; in each the parent elements, then
the interfaces, then the links).  Every row of a stage is a vertex row (a link row
describes its source interface); the rows of link stages are edge rows as well, merged
after the stage's vertices, so an edge finds the vertices made before it and by its own
stage.  Each stage reads the snapshot that the stage before it wrote to the shared folder:
a chain of dependent merges whose lineage is cut at every link.  A key holds its relation, so a
merge reads and writes only the snapshot's rows of its batch's relations.

Outcomes of rows: created, updated, skipped (an end vertex does not exist) and failed (a key
or type is missing: I14, with the reason).  For every stage and kind they add up to the rows
read.

Inventories change little between runs, so a stage's batch is reduced to its keys before it
meets the snapshot (``merge``).  The outcome and the number of rows of each key are written with the
merged rows, so that they are counted without a second merge.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.expr import link_type_key
from ..session import materialize
from . import ingest as I
from .merge import counted_outcomes, merged_edges, merged_vertices, stored_edges

# which of several rows of a key in a batch is the last one
ROW_ORDER = ["last_discovery_ts", "id", "hostname", "neighbour_ne_name", "ckt_id", "tag", "area_ip_address",
             "link_type", "link_uuid", "uuid"]


@dataclass(frozen=True)
class Inventory:
    """The tables that the stages read."""
    network_element: DataFrame
    ne_location: DataFrame
    geo: list[DataFrame]
    lldp_link: DataFrame
    ospf_link: DataFrame
    isis_link: DataFrame


# (stage, does it hold links, rows)
STAGES = [
    ("lldp_ospf.parents", False, lambda v: I.parent_vertices(v.network_element, v.ne_location, v.geo)),
    ("lldp_ospf.lldp_interfaces", False, lambda v: I.interface_vertices(v.network_element, v.lldp_link, S.LLDP)),
    ("lldp_ospf.lldp_links", True, lambda v: I.link_rows_lldp(v.network_element, v.lldp_link)),
    ("lldp_ospf.ospf_interfaces", False, lambda v: I.interface_vertices(v.network_element, v.ospf_link, S.OSPF)),
    ("lldp_ospf.ospf_links", True, lambda v: I.link_rows_routed(v.network_element, v.ospf_link, S.OSPF)),
    ("isis.parents", False, lambda v: I.parent_vertices(v.network_element, v.ne_location, v.geo, source="SDN")),
    ("isis.interfaces", False, lambda v: I.interface_vertices_isis(v.network_element, v.isis_link)),
    ("isis.links", True, lambda v: I.link_rows_routed(v.network_element, v.isis_link, S.ISIS)),
    ("switch.parents", False, lambda v: I.parent_vertices(v.network_element, v.ne_location, v.geo, switch=True)),
    ("switch.interfaces", False,
     lambda v: I.interface_vertices(v.network_element, v.lldp_link, S.LLDPSWITCH, parent_type="SWITCH")),
    ("switch.links", True,
     lambda v: I.link_rows_lldp(v.network_element, v.lldp_link, S.LLDPSWITCH, switch_rule=True)),
]


@dataclass(frozen=True)
class _Snapshot:
    """A stored table of which a merge rewrites the relations of its batch (a few fixed names)."""
    stored: DataFrame
    written: dict[str, DataFrame] = field(default_factory=dict)

    def of(self, relations: list[str]) -> DataFrame:
        return reduce(DataFrame.unionByName, [
            self.written[r] if r in self.written else self.stored.filter(F.col("relation") == r) for r in relations])

    def after(self, relations: list[str], made: DataFrame) -> _Snapshot:
        return _Snapshot(self.stored, self.written | {
            r: made if len(relations) == 1 else made.filter(F.col("relation") == r) for r in relations})

    def whole(self) -> DataFrame:
        kept = self.stored.filter(~F.coalesce(F.col("relation").isin(list(self.written)), F.lit(False)))
        return reduce(DataFrame.unionByName, self.written.values(), kept)


def empty(spark: SparkSession, columns: dict[str, str]) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in columns.items()))


def edge_rows(rows: DataFrame) -> DataFrame:
    """Link rows with the stored edge's columns; ids are the last part of the interface names."""
    made = rows.withColumns({k: F.col(v) for k, v in S.EDGE_FROM_ROW.items() if v in rows.columns})
    made = made.withColumn("start_id", F.regexp_replace("src_interface", "^.*_", "")).withColumn(
        "end_id", F.regexp_replace("dest_interface", "^.*_", ""))
    if "link_type" not in made.columns:
        made = made.withColumn("link_type", F.lit(None).cast("string"))
    if "link_type_key" not in made.columns:
        made = made.withColumn("link_type_key", link_type_key())
    return made.select(*[F.col(c).cast(t) if c in made.columns else F.lit(None).cast(t).alias(c)
                         for c, t in S.STORED_EDGE.items()], *[c for c in ROW_ORDER if c in made.columns
                                                               and c not in S.STORED_EDGE])


def ingest(inventory: Inventory, run_ts: str, vertices: DataFrame | None = None, edges: DataFrame | None = None,
           stages: list | None = None, on_error: str = "raise",
           summary: bool = True) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Run the stages on top of the stored graph (empty if None).

    Returns (vertices, edges, summary); ``summary`` has (stage, kind, outcome, rows) with kind
    vertex / edge, outcome read / created / updated / skipped / failed, and a stage TOTAL.  With
    ``on_error`` "skip" a stage that fails as a whole leaves the graph as it was and is a row of
    kind ``stage`` and outcome ``failed``; otherwise its error is raised and later stages do not run.
    Without ``summary`` rows are not counted and None is returned for it."""
    spark = inventory.network_element.sparkSession
    vertices = empty(spark, S.STORED_VERTEX) if vertices is None else vertices
    vertices = _Snapshot(vertices.withColumn("relation", F.coalesce("relation", F.lit(""))))
    edges = _Snapshot(empty(spark, S.STORED_EDGE) if edges is None else edges)
    counted = []
    for name, links, rows_of in stages or STAGES:
        try:
            v, e, counts = _stage(name, links, rows_of(inventory), vertices, edges, run_ts, summary)
        except PySparkException:
            if on_error != "skip":
                raise
            counts = spark.range(1).selectExpr(f"'{name}' as stage", "'stage' as kind", "'failed' as outcome",
                                               "cast(null as bigint) as rows")
        else:
            vertices, edges = v, e
        counted += [counts] if summary else []
    vertices, edges = vertices.whole(), edges.whole()
    if not summary:
        return vertices, edges, None
    per = materialize(reduce(DataFrame.unionByName, counted), "ingest_summary")
    total = per.groupBy("kind", "outcome").agg(F.sum("rows").alias("rows")).select(
        F.lit("TOTAL").alias("stage"), "kind", "outcome", "rows")
    return vertices, edges, per.unionByName(total)


def _stage(name, links, rows, vertices: _Snapshot, edges: _Snapshot, run_ts, summary):
    if links:  # stored like the other key columns: a constant is no part of what rows are dealt by
        link_type = "link_type" if "link_type" in rows.columns else F.lit(None).cast("string")
        rows = rows.withColumn("link_type_key", link_type_key(link_type=link_type))
    rows = materialize(rows, "stage_rows", large=True)
    relation = F.coalesce("relation", F.lit(""))
    relations = sorted(r[0] for r in rows.select(relation).distinct().collect()) or [""]
    order = [c for c in ROW_ORDER if c in rows.columns]
    valid, rejects = I.validate_rows(rows, "vertex")
    made = materialize(merged_vertices(
        vertices.of(relations), valid.drop("link_type_key").withColumn("is_deleted", F.col("is_deleted").cast("boolean")),
        order=order).drop("_changed"), "vertices", large=True)
    vertices = vertices.after(relations, made.drop("_outcome", "_n"))
    parts = [_counts(name, "vertex", rows, rejects, made)]
    if links:
        valid, rejects = I.validate_rows(rows, "edge")
        made = materialize(merged_edges(edges.of(relations), edge_rows(valid), vertices.whole(), run_ts, order=order,
                                        ends=("src_interface", "dest_interface"), keyed=True), "edges", large=True)
        edges = edges.after(relations, stored_edges(made).drop("_outcome", "_n"))
        parts.append(_counts(name, "edge", rows, rejects, made))
    counts = materialize(reduce(DataFrame.unionByName, parts), "stage_counts") if summary else None
    return vertices, edges, counts


def _counts(stage: str, kind: str, rows: DataFrame, rejects: DataFrame, merged: DataFrame) -> DataFrame:
    outcomes = counted_outcomes(merged.filter("_outcome is not null").select(F.col("_outcome").alias("outcome"), "_n"))

    def all_of(df, outcome):
        return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(outcome).alias("outcome"), "rows")

    both = all_of(rows, "read").unionByName(all_of(rejects, "failed").filter("rows > 0")).unionByName(outcomes)
    return both.select(F.lit(stage).alias("stage"), F.lit(kind).alias("kind"), "outcome", "rows")
