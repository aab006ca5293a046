"""Graph merge (upsert) and maintenance.

A merge produces a *new snapshot* DataFrame (write it as a new table version;
nothing is updated in place) plus an outcome per incoming key.

Plan shape
* incoming rows are reduced to one row per key with ``max_by(struct, order)``
  — a partial aggregation, so a key repeated by a third of the batch still
  reduces map-side before the shuffle.
* snapshot and increment meet in one full outer equi join on the key
  (sort-merge or shuffle-hash, AQE skew-split); no per-key lookups.
* end-vertex existence for edges is two left joins on the names, as a flag.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.expr import col_has_value, link_type_key


def dedupe_last(df: DataFrame, key: list[str], order: list[str], last: list[str] | None = None) -> DataFrame:
    """One row per key: the last by ``order``; rows equal in that are ordered by
    all their other columns (``last`` after the rest), so the result does not depend on the input's
    order.  ``_n`` is the number of the key's rows.  Without maps, which have no order, a row
    is its own order: a struct of it, kept once."""
    return _last_rows(df, key, order, last).drop("_h")


def _hashed(df: DataFrame, key: list[str]) -> DataFrame:
    """``df`` with ``_h``, a hash of the key, to go before it in groups and joins: names begin alike, and
    sorting wide rows by them compares whole texts; the hash decides before."""
    return df.withColumn("_h", F.xxhash64(*key))


def _last_rows(df: DataFrame, key: list[str], order: list[str], last: list[str] | None = None) -> DataFrame:
    """``dedupe_last`` with ``_h``, dealt by ``_h`` and the key."""
    others = [c for c in df.columns if c not in key]
    plain = [c for c in others if "map<" not in df.schema[c].dataType.simpleString()]
    ranked = [c for c in order if c in plain]
    ranked += [c for c in plain if c not in ranked and c not in (last or [])]
    ranked += [c for c in plain if c not in ranked]
    row = F.max(F.struct(*ranked)) if ranked and len(plain) == len(others) else F.max_by(
        F.struct(*others), F.struct(*order, *[c for c in ranked if c not in order]))
    return (_hashed(df, key).groupBy("_h", *key).agg(row.alias("_r"), F.count(F.lit(1)).alias("_n"))
            .select("_h", *key, "_r.*", "_n").select("_h", *df.columns, "_n"))


def merge_vertices(snapshot: DataFrame, incoming: DataFrame, order: list[str] | None = None,
                   key: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Upsert vertices.  Matched keys take each incoming non-null value
    (``coalesce(new, old)``), unmatched incoming keys are inserted, snapshot
    rows without incoming keep as they are.  Edge-only columns of the input
    are dropped.  If the snapshot has a map ``attrs``, incoming columns that it
    does not know are kept there as text, key by key under the same rule (no nulls).
    Returns ``(new_snapshot, outcomes)`` where outcomes has one row per incoming
    key with ``outcome`` created / updated."""
    key = key or S.VERTEX_KEY
    both = merged_vertices(snapshot, incoming, order, key)
    return (both.select(*snapshot.columns),
            both.filter("_outcome is not null").select(*key, F.col("_outcome").alias("outcome"),
                                                       F.col("_changed").alias("changed")))


def merged_vertices(snapshot: DataFrame, incoming: DataFrame, order: list[str] | None = None,
                    key: list[str] | None = None) -> DataFrame:
    """The new snapshot of ``merge_vertices`` with, on keys of the batch, ``_outcome``, ``_changed`` and
    ``_n`` (rows of the key): what a caller stores to have both at the cost of one merge."""
    key = key or S.VERTEX_KEY
    order = order or ["last_discovery_ts"]
    if "relation" in key:  # a vertex without relation is one vertex, stored or incoming
        snapshot = snapshot.withColumn("relation", F.coalesce("relation", F.lit("")))
    inc = incoming.drop(*[c for c in S.EDGE_ONLY_PROPERTIES if c in incoming.columns and c not in order])
    inc = inc.withColumn("relation", F.coalesce(F.col("relation"), F.lit("")))
    open_map = "attrs" in snapshot.columns
    extra = [c for c in inc.columns if open_map and c not in snapshot.columns and c not in S.EDGE_ONLY_PROPERTIES]
    if "attrs" in inc.columns and open_map:
        inc = _last_rows(_with_attrs(inc, extra, order), key, order)
    else:  # only the rows that stay get a map
        inc = _last_rows(inc, key, order, last=extra)
        inc = _with_attrs(inc, extra, order) if open_map else inc
    cols = [c for c in snapshot.columns if c not in key and c != "attrs"]
    maps = ["attrs"] if open_map else []
    o = _hashed(snapshot, key).select("_h", *key, *[F.col(c).alias(f"o_{c}") for c in cols + maps],
                                      F.lit(True).alias("_old"))
    n = inc.select("_h", *key, *[F.col(c).alias(f"n_{c}") if c in inc.columns else
                           F.lit(None).alias(f"n_{c}") for c in cols + maps], "_n", F.lit(True).alias("_new"))
    j = o.join(n, ["_h", *key], "full_outer")
    changed = changed_properties_expr(cols)
    out = [F.coalesce(F.col(f"n_{c}"), F.col(f"o_{c}")).cast(snapshot.schema[c].dataType).alias(c) for c in cols]
    if open_map:
        old, new = _no_nulls("o_attrs"), _no_nulls("n_attrs")
        out.append(F.map_zip_with(old, new, lambda k, a, b: F.coalesce(b, a)).alias("attrs"))
        differs = F.map_filter(new, lambda k, b: ~b.eqNullSafe(F.try_element_at(old, k)))
        changed = F.concat(changed, F.array_sort(F.map_keys(differs)))
    outcome = F.when(F.col("_new").isNotNull(), F.when(F.col("_old").isNotNull(), "updated").otherwise("created"))
    return (j.select(*key, *out, outcome.alias("_outcome"), changed.alias("_changed"), "_n")
            .select(*snapshot.columns, "_outcome", "_changed", "_n"))


def _no_nulls(attrs: str) -> Column:
    """The map without null values; no map is an empty one."""
    empty = F.create_map().cast("map<string,string>")
    return F.map_filter(F.coalesce(F.col(attrs), empty), lambda k, v: v.isNotNull())


def _with_attrs(df: DataFrame, extra: list[str], order: list[str]) -> DataFrame:
    """``df`` with its ``extra`` columns as text in the map ``attrs`` (nulls left out, what it
    already holds kept unless an extra column has its name)."""
    pairs = [x for c in extra for x in (F.lit(c), F.col(c).cast("string"))]
    made = F.create_map(*pairs).cast("map<string,string>")
    if "attrs" in df.columns:
        made = F.map_zip_with(F.coalesce(F.col("attrs"), F.create_map().cast("map<string,string>")), made,
                              lambda k, a, b: F.coalesce(b, a))
    return (df.withColumn("attrs", F.map_filter(made, lambda k, v: v.isNotNull()))
            .drop(*[c for c in extra if c not in order]))


def changed_properties_expr(cols: list[str], time_cols: tuple[str, ...] = ("last_discovery_ts",)) -> Column:
    """U4: names of columns whose incoming value is non-null and differs from
    the stored one; time columns count whenever non-null."""
    items = []
    for c in cols:
        new, old = F.col(f"n_{c}"), F.col(f"o_{c}")
        if c in time_cols:
            cond = new.isNotNull()
        else:
            cond = new.isNotNull() & ~new.eqNullSafe(old)
        items.append(F.when(cond, F.lit(c)))
    return F.array_compact(F.array(*items))


def merge_edges(snapshot: DataFrame, incoming: DataFrame, vertices: DataFrame,
                run_ts: str, order: list[str] | None = None,
                ends: tuple[str, str] = ("start_ne", "end_ne")) -> tuple[DataFrame, DataFrame]:
    """Upsert edges keyed by (src_interface, dest_interface, relation,
    link_type_key).  Incoming rows whose ends (the elements; with ``ends`` the interfaces)
    do not both exist are skipped.  Matched edges take the incoming row's columns (null included),
    but keep circuit id, link type, status and creation time; ``start_ne`` /
    ``end_ne`` (and their ids) change only when non-blank.  New edges get status
    ACTIVE and ``created_at = run_ts``.  Skipped rows go through the same join
    without a match, so the batch is read once.
    Returns ``(new_snapshot, outcomes)`` with created / updated / skipped."""
    both = merged_edges(snapshot, incoming, vertices, run_ts, order, ends)
    return (stored_edges(both).select(*snapshot.columns),
            both.filter("_outcome is not null").select(*S.EDGE_KEY, F.col("_outcome").alias("outcome")))


def stored_edges(both: DataFrame) -> DataFrame:
    """The rows of ``merged_edges`` that belong to the new snapshot."""
    return both.filter("_outcome is null or _outcome <> 'skipped'")


def merged_edges(snapshot: DataFrame, incoming: DataFrame, vertices: DataFrame, run_ts: str,
                 order: list[str] | None = None, ends: tuple[str, str] = ("start_ne", "end_ne"),
                 keyed: bool = False) -> DataFrame:
    """The new snapshot of ``merge_edges`` and its skipped rows, with, on keys of the batch, ``_outcome``
    and ``_n`` (rows of the key).  With ``keyed`` the batch has whole keys without nulls and the ends are columns
    of them: then the keys alone are looked up among the vertices, and the rows are dealt once."""
    order = order or ["last_discovery_ts"]
    inc = incoming if keyed else incoming.withColumn("link_type_key", link_type_key())
    keep = [c for c in snapshot.columns if c in inc.columns]
    rows = inc.select(*keep, *[c for c in order if c not in keep])
    inc = _last_rows(rows, S.EDGE_KEY, order).select("_h", *keep, "_n")
    names = vertices.select("ne_name").distinct()
    starts = names.select(F.col("ne_name").alias("_sn"))
    others = names.select(F.col("ne_name").alias("_en"))
    if keyed:
        found = (rows.select(*S.EDGE_KEY).join(starts, F.col(ends[0]) == F.col("_sn"), "left_semi")
                 .join(others, F.col(ends[1]) == F.col("_en"), "left_semi"))
        found = _hashed(found, S.EDGE_KEY).select("_h", *S.EDGE_KEY).distinct().withColumn("_found", F.lit(True))
        inc = inc.join(found, ["_h", *S.EDGE_KEY], "left").withColumn("_ok", F.col("_found").isNotNull()).drop("_found")
    else:
        inc = (inc.join(starts, F.col(ends[0]) == F.col("_sn"), "left")
               .join(others, F.col(ends[1]) == F.col("_en"), "left"))
        inc = inc.withColumn("_ok", F.col("_sn").isNotNull() & F.col("_en").isNotNull()).drop("_sn", "_en")
    cols = [c for c in snapshot.columns if c not in S.EDGE_KEY]
    o = _hashed(snapshot, S.EDGE_KEY).select("_h", *S.EDGE_KEY, *[F.col(c).alias(f"o_{c}") for c in cols],
                                             F.lit(True).alias("_old"))
    n = inc.select("_h", *S.EDGE_KEY, *[(F.col(c) if c in inc.columns else F.lit(None)).alias(f"n_{c}") for c in cols],
                   "_ok", "_n", F.lit(True).alias("_new"))
    # a skipped row has no partner: its flag never equals the stored row's
    j = o.withColumn("_ok", F.lit(True)).join(n, ["_h", *S.EDGE_KEY, "_ok"], "full_outer")
    is_new, is_old = F.col("_new").isNotNull(), F.col("_old").isNotNull()

    def pick(c: str) -> Column:
        new, old = F.col(f"n_{c}"), F.col(f"o_{c}")
        if c in ("start_ne", "end_ne", "start_ne_id", "end_ne_id"):
            return F.when(is_new & col_has_value(new), new).otherwise(old)
        if c == "status":
            return F.when(is_new & ~is_old, F.lit("ACTIVE")).otherwise(old)
        if c == "created_at":
            return F.when(is_new & ~is_old, F.lit(run_ts).cast("timestamp_ntz")).otherwise(old)
        if c in ("ckt_id", "link_type"):
            return F.when(is_new & ~is_old, new).otherwise(old)
        if c == "is_deleted":
            return F.when(is_new, F.coalesce(new.cast("boolean"), F.lit(False))).otherwise(old)
        return F.when(is_new, new).otherwise(old)

    outcome = F.when(is_new, F.when(~F.col("_ok"), "skipped").when(is_old, "updated").otherwise("created"))
    return (j.select(*S.EDGE_KEY, *[pick(c).cast(snapshot.schema[c].dataType).alias(c) for c in cols],
                     outcome.alias("_outcome"), "_n").select(*snapshot.columns, "_outcome", "_n"))


# U5 column map: vertex column -> edge column, by the end the vertex stands at
SOURCE_COLUMNS = {
    "tag": "tag", "area_ip_address": "area_ip_address", "src_bandwidth": "src_bandwidth",
    "latitude": "src_lat", "longitude": "src_long", "is_deleted": "is_deleted",
    "ne_category": "src_category", "vendor": "src_vendor", "technology": "src_technology",
    "domain": "src_domain", "ne_type": "src_type", "hostname": "line_name", "ne_status": "status",
    "ne_id": "start_ne_id", "parent_ne": "start_ne", "ckt_id": "ckt_id",
}
DESTINATION_COLUMNS = {
    "dest_bandwidth": "dest_bandwidth", "latitude": "dest_lat", "longitude": "dest_long",
    "is_deleted": "is_deleted", "ne_category": "dest_category", "vendor": "dest_vendor",
    "technology": "dest_technology", "domain": "dest_domain", "ne_type": "dest_type",
    "hostname": "line_name", "ne_status": "status", "ne_id": "end_ne_id", "parent_ne": "end_ne",
    "ckt_id": "ckt_id",
}


def change_table(changed: DataFrame) -> DataFrame:
    """(ne_name, relation, values): each changed vertex's new values as a map of text, of the columns
    that are in ``changed`` and not null, and its discovery time.  Of several rows of a vertex the
    smallest value of a column counts."""
    known = sorted({*SOURCE_COLUMNS, *DESTINATION_COLUMNS} & set(changed.columns))
    attrs = {c for c in {*SOURCE_COLUMNS, *DESTINATION_COLUMNS} - set(known)} if "attrs" in changed.columns else set()

    def pair(name: str, value: Column, counts: Column) -> Column:
        return F.when(counts & value.isNotNull(), F.struct(F.lit(name).alias("column"),
                                                           value.cast("string").alias("value")))

    listed = F.col("changed")
    pairs = [pair(c, F.col(c), F.array_contains(listed, c)) for c in known]
    pairs += [pair(c, F.try_element_at(F.col("attrs"), F.lit(c)), F.array_contains(listed, c)) for c in sorted(attrs)]
    pairs.append(pair("last_discovery_ts", F.col("last_discovery_ts"), F.lit(True)))
    rows = changed.filter("ne_name is not null").select(
        "ne_name", F.coalesce("relation", F.lit("")).alias("relation"), F.array_compact(F.array(*pairs)).alias("_pairs"))
    per = rows.groupBy("ne_name", "relation").agg(F.array_sort(F.flatten(F.collect_list("_pairs"))).alias("_pairs"))
    first = F.filter("_pairs", lambda x, i: (i == 0) | (x["column"] != F.get("_pairs", i - 1)["column"]))
    return per.select("ne_name", "relation", F.map_from_entries(first).alias("values"))


def propagate_vertex_changes(edges: DataFrame, changed: DataFrame) -> DataFrame:
    """U5 + U6: push changed vertex values onto the links of the same relation whose source (or
    destination) interface is that vertex.  ``changed`` has the vertex key, a ``changed`` array
    of column names and the new values; a value is copied only when it is listed and not
    null.  Links at a changed vertex take its discovery time.  Where both ends of a link
    set one column, the source end's value stays.

    The changes are one row a vertex, which the links meet at their source and at their
    destination: a link is dealt once per end, whatever the number of changed columns, and not at
    all if no vertex of its relation (a few fixed names) changed.  Links without an interface
    at an end are spread by their key there."""
    table = change_table(changed)
    at = F.coalesce("relation", F.lit(""))
    some = F.broadcast(changed.select(at.alias("_some")).distinct())
    plain = edges.join(some, at == F.col("_some"), "left_anti")
    j = edges.join(some, at == F.col("_some"), "left_semi")
    for interface, values in (("src_interface", "_src"), ("dest_interface", "_dest")):
        # a name with a sign before it never equals a number
        name = F.coalesce(F.concat(F.lit("="), interface), F.xxhash64(*S.EDGE_KEY).cast("string"))
        mine = table.select(F.concat(F.lit("="), "ne_name").alias("_name"), F.col("relation").alias("_at"),
                            F.col("values").alias(values))
        j = j.join(mine, (name == F.col("_name")) & (at == F.col("_at")), "left").drop("_name", "_at")
    # the untouched links are those without values
    none = F.lit(None).cast(table.schema["values"].dataType)
    j = j.unionByName(plain.withColumns({"_src": none, "_dest": none}))
    time = {"last_discovery_ts": "last_discovery_ts"}
    source = {edge: vertex for vertex, edge in (SOURCE_COLUMNS | time).items()}
    far = {edge: vertex for vertex, edge in (DESTINATION_COLUMNS | time).items()}
    out = []
    for c in [*edges.columns, *sorted({*source, *far} - set(edges.columns))]:
        new = [F.try_element_at(end, F.lit(names[c])) for end, names in (("_src", source), ("_dest", far)) if c in names]
        if not new:
            out.append(F.col(c))
        elif c in edges.columns:
            out.append(F.coalesce(F.coalesce(*new).cast(edges.schema[c].dataType), F.col(c)).alias(c))
        else:
            out.append(F.coalesce(*new).alias(c))
    return j.select(*out)


def link_child_to_parent(children: DataFrame, vertices: DataFrame, parent_edges: DataFrame,
                         label: str = S.PARENT) -> DataFrame:
    """Parent edges to add so every child has one edge of ``label`` to its
    parent: parent must exist (semi join), edge must not exist (anti join)."""
    c = children.select("ne_name", "parent_ne").filter(col_has_value("parent_ne")).distinct()
    parents = vertices.select(F.col("ne_name").alias("parent_ne")).distinct()
    c = c.join(parents, "parent_ne", "left_semi")
    have = parent_edges.filter(F.col("relation") == label).select(
        F.col("start_ne").alias("ne_name"), F.col("end_ne").alias("parent_ne"))
    new = c.join(have, ["ne_name", "parent_ne"], "left_anti")
    return new.select(F.col("ne_name").alias("src_interface"), F.col("parent_ne").alias("dest_interface"),
                      F.lit(label).alias("relation"), F.col("ne_name").alias("start_ne"),
                      F.col("parent_ne").alias("end_ne"))


def row_outcomes(rows: DataFrame, outcomes: DataFrame, key: list[str]) -> DataFrame:
    """(outcome, rows): what became of every row of a batch, from the outcomes of its keys.  Of the
    rows of a created key the first creates and the others update it."""
    return counted_outcomes(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
                            .join(outcomes.select(*key, "outcome"), key))


def counted_outcomes(per_key: DataFrame) -> DataFrame:
    """``row_outcomes`` of keys with their ``outcome`` and number of rows ``_n``."""
    made = F.col("outcome") == "created"
    both = F.array(F.struct(F.col("outcome"), F.when(made, 1).otherwise(F.col("_n")).cast("long").alias("rows")),
                   F.struct(F.lit("updated").alias("outcome"), F.when(made, F.col("_n") - 1).otherwise(0).alias("rows")))
    return per_key.select(F.inline(both)).groupBy("outcome").agg(F.sum("rows").alias("rows")).filter("rows > 0")


def merge_summary(outcomes: dict[str, DataFrame]) -> DataFrame:
    """U8: rows per (stage, outcome) and a TOTAL stage."""
    parts = [df.select(F.lit(stage).alias("stage"), "outcome") for stage, df in outcomes.items()]
    allrows = reduce(DataFrame.unionByName, parts)
    per = allrows.groupBy("stage", "outcome").agg(F.count(F.lit(1)).alias("rows"))
    tot = allrows.groupBy("outcome").agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit("TOTAL").alias("stage"), "outcome", "rows")
    return per.unionByName(tot)


def classify_records(edge_outcomes: DataFrame, snapshot_edges: DataFrame) -> DataFrame:
    """New / updated / failed per incoming record.  Skipped rows are
    failed; an updated edge is "updated"; everything else is "new".  If the
    stored graph was empty every record is new (an empty snapshot has no
    matched key, so the join rule gives exactly that)."""
    cls = (F.when(F.col("outcome") == "skipped", "failed")
           .when(F.col("outcome") == "updated", "updated").otherwise("new"))
    return edge_outcomes.withColumn("record_class", cls)


def retain_recent(vertices: DataFrame, edges: DataFrame, run_date: str,
                  days: int = S.RETENTION_DAYS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Drop vertices and edges discovered on or before the end of day
    ``run_date - days``; a name without any vertex left loses its links.  Null
    times are kept.  Returns (vertices, edges, counts)."""
    cutoff = F.date_add(F.lit(run_date).cast("date"), -days + 1).cast("timestamp_ntz")
    old_v = F.col("last_discovery_ts") < cutoff
    keep_v = vertices.filter(~F.coalesce(old_v, F.lit(False)))
    dropped = (vertices.filter(F.coalesce(old_v, F.lit(False))).join(keep_v.select("ne_name"), "ne_name", "left_anti")
               .select(F.col("ne_name").alias("_d")).distinct())
    e = edges.filter(~F.coalesce(F.col("last_discovery_ts") < cutoff, F.lit(False)))
    e = (e.join(dropped, e.start_ne == dropped._d, "left_anti")
         .join(dropped, e.end_ne == dropped._d, "left_anti"))
    counts = (vertices.agg(F.count(F.lit(1)).alias("n")).select(F.lit("vertices_before").alias("item"), "n")
              .unionByName(keep_v.agg(F.count(F.lit(1)).alias("n")).select(F.lit("vertices_after").alias("item"), "n"))
              .unionByName(edges.agg(F.count(F.lit(1)).alias("n")).select(F.lit("edges_before").alias("item"), "n"))
              .unionByName(e.agg(F.count(F.lit(1)).alias("n")).select(F.lit("edges_after").alias("item"), "n")))
    return keep_v, e, counts


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys present on more than one row (inconsistency report)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
