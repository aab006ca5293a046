"""Path and reachability operators.

Paths are found by an iterative *frontier join*: each round joins the open
paths' last vertex with the hop table (an equi join on the vertex name),
drops revisits (simple paths: ``array_contains``), applies the hop filters
and splits the result into finished paths (termination reached) and the next
frontier.  All state is DataFrames; the driver only runs the bounded loop.

Scale
* listing all simple paths (R1) takes a depth from the caller, as their number grows
  exponentially; what is still open there is returned and flagged.  The shortest
  paths (R3) and the vertices on paths (R2, by blocks and cut vertices) have no
  limit, nor have reachability (R4, R5, R9) and the hierarchy (R7): they run until a
  round finds nothing new.
* each round is written once to the shared checkpoint folder as Parquet and
  read back (``materialize``), so lineage stays flat, a lost executor costs no
  earlier round, and the empty test reads a footer.
* hub vertices: the frontier ⋈ hops join is an ordinary shuffle join, which
  AQE splits when one vertex key is skewed.
* reachability is a vertex-set BFS: the visited set grows by anti joins, never
  enumerating paths.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..session import materialize


def without_bundles(edges: DataFrame) -> DataFrame:
    """The links that are no part of a bundle (no ``src_bundle`` and no ``dest_bundle``)."""
    for c in ("src_bundle", "dest_bundle"):
        if c in edges.columns:
            edges = edges.filter(F.coalesce(F.trim(F.col(c)), F.lit("")) == "")
    return edges


def hop_table(edges: DataFrame, parent_edges: DataFrame | None = None,
              relations: list[str] | None = None, skip_bundles: bool = False) -> DataFrame:
    """Undirected element adjacency ``(a, b)``, one row per distinct pair and
    direction, from links (optionally of some relations, or none that is part of a
    bundle) and parent edges."""
    return hop_rows(edges, parent_edges, relations, skip_bundles).distinct()


def hop_rows(edges: DataFrame, parent_edges: DataFrame | None = None,
             relations: list[str] | None = None, skip_bundles: bool = False) -> DataFrame:
    """The rows of ``hop_table``, a pair as often as it is linked: for the path searches, which
    make the hops distinct once only those of allowed vertices are left."""
    e = edges if not relations else edges.filter(F.col("relation").isin(relations))
    if skip_bundles:
        e = without_bundles(e)
    parts = [e.select(F.col("start_ne").alias("a"), F.col("end_ne").alias("b"))]
    if parent_edges is not None:
        parts.append(parent_edges.select(F.col("start_ne").alias("a"), F.col("end_ne").alias("b")))
    one = reduce(DataFrame.unionByName, parts)
    both = one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))


def one_per_name(vertices: DataFrame, *cols: str) -> DataFrame:
    """One row per element name (the vertex of the smallest relation): hops and
    paths go by name, and a name can be stored under several relations."""
    first = F.coalesce("relation", F.lit("")) if "relation" in vertices.columns else F.struct(*cols)
    return (vertices.groupBy("ne_name")
            .agg(F.min_by(F.struct(*cols), first).alias("_v"))
            .select("ne_name", "_v.*"))


def _steps(vertices: DataFrame, hops: DataFrame, allowed_types: list[str], term_types: list[str] | None,
           term_names: DataFrame | None, same_attr: str | None, exclude: DataFrame | None) -> DataFrame:
    """The hops a path may take, one row each: (_last, _b, _term).  The filters that do not depend
    on the path are applied once, and before the hops (``hop_rows`` or ``hop_table``) are made distinct: the target's type must be allowed (or terminal), it must not be
    excluded, and with ``same_attr`` both ends must share the attribute (exact: every vertex
    on a path shares the start's value, so the hop's source does too)."""
    allowed = [t.upper() for t in allowed_types]
    terms = [t.upper() for t in (term_types or [])]
    names = one_per_name(vertices, "ne_type", *([same_attr] if same_attr else []))
    vb = names.select(F.col("ne_name").alias("_b"), F.upper("ne_type").alias("_bt"),
                      *([F.col(same_attr).alias("_ba")] if same_attr else []))
    if term_names is not None:
        tn = term_names.select(F.col("ne_name").alias("_b")).distinct().withColumn("_tn", F.lit(True))
        vb = vb.join(tn, "_b", "left")
    else:
        vb = vb.withColumn("_tn", F.lit(None).cast("boolean"))
    is_term = F.col("_bt").isin(terms) | F.coalesce(F.col("_tn"), F.lit(False))
    vb = vb.filter(F.col("_bt").isin(allowed) | is_term).withColumn("_term", is_term)
    if exclude is not None:
        vb = vb.join(exclude.select(F.col("ne_name").alias("_b")), "_b", "left_anti")
    h = hops.select(F.col("a").alias("_last"), F.col("b").alias("_b")).join(vb, "_b")
    if same_attr:
        va = names.select(F.col("ne_name").alias("_last"), F.col(same_attr).alias("_la"))
        h = h.join(va, "_last").filter(F.col("_la") == F.col("_ba"))
    return materialize(h.select("_last", "_b", "_term").distinct(), "hops", large=True)  # read by every round


def distances(steps: DataFrame) -> DataFrame:
    """(v, dist): the fewest hops from every vertex that can reach a termination, found
    backwards, a level a round."""
    level = materialize(steps.filter("_term").select(F.col("_last").alias("v")).distinct()
                        .withColumn("dist", F.lit(1)), "distances")
    parts, dist = [level], 1
    while not level.isEmpty():
        dist += 1
        known = reduce(DataFrame.unionByName, parts)
        level = materialize(
            steps.filter("not _term").join(level.select(F.col("v").alias("_b")), "_b", "left_semi")
            .select(F.col("_last").alias("v")).distinct().join(known, "v", "left_anti")
            .withColumn("dist", F.lit(dist)), "distances")
        parts.append(level)
        if len(parts) > 8:
            parts = [materialize(reduce(DataFrame.unionByName, parts), "distances")]
    return reduce(DataFrame.unionByName, parts)


def simple_paths(vertices: DataFrame, hops: DataFrame, starts: DataFrame, allowed_types: list[str],
                 term_types: list[str] | None = None, term_names: DataFrame | None = None,
                 same_attr: str | None = None, exclude: DataFrame | None = None, *,
                 max_depth: int, require_complete: bool = False) -> DataFrame:
    """Simple paths from each start; every hop's vertex must be of an
    allowed type (or the termination), optionally share ``same_attr`` with the
    start, and not be excluded; a path stops at the first vertex of a
    termination type (or name).  At least one hop (do-while).  Returns
    ``(start_ne, end_ne, depth, path, finished)``.  Nothing is cut in silence: a
    path that has not ended after ``max_depth`` hops and from whose end a
    termination can be reached (if only through the path itself) is returned with ``finished`` false (with
    ``require_complete`` it is an error).  The search without a limit, for the
    shortest paths, is ``shortest_paths``."""
    h = _steps(vertices, hops, allowed_types, term_types, term_names, same_attr, exclude)
    ways = distances(h).select(F.col("v").alias("_last"))
    st = starts.select(F.col("ne_name").alias("start_ne")).distinct()
    frontier = st.select("start_ne", F.col("start_ne").alias("_last"), F.array(F.col("start_ne")).alias("path"))
    parts = []
    for depth in range(1, max_depth + 1):
        step = materialize(
            frontier.join(h, "_last").filter(~F.array_contains("path", F.col("_b")))
            .select("start_ne", F.col("_b").alias("_last"),
                    F.concat("path", F.array(F.col("_b"))).alias("path"), F.col("_term").alias("finished")),
            "paths")
        frontier = step.filter("not finished").drop("finished").join(ways, "_last", "left_semi")
        parts.append(step.filter("finished").withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            break
    else:
        if require_complete:
            raise ValueError(f"paths are still open after {max_depth} hops")
        parts.append(frontier.withColumn("finished", F.lit(False)).withColumn("depth", F.lit(max_depth)))
    return reduce(DataFrame.unionByName, parts).select(
        "start_ne", F.col("_last").alias("end_ne"), "depth", "path", "finished")


def shortest_paths(vertices: DataFrame, hops: DataFrame, starts: DataFrame, allowed_types: list[str],
                   term_types: list[str] | None = None, term_names: DataFrame | None = None,
                   same_attr: str | None = None, exclude: DataFrame | None = None, *,
                   max_paths: int) -> DataFrame:
    """The ``max_paths`` shortest simple paths of each start (ties by path text), of any
    length: ``(start_ne, end_ne, depth, path)``.

    Best first: an open path's bound is its hops so far and the distance of its end
    to a termination.  A round extends, for each start, the open paths of the least
    bound by a hop; the others wait.  Once a start has its paths, what is open with
    a bound beyond its last one is dropped.  So only beginnings that may still be among the
    shortest are ever made (all of them: ties are settled by text, so paths as long as a
    start's last one are all found)."""
    h = _steps(vertices, hops, allowed_types, term_types, term_names, same_attr, exclude)
    dist = distances(h).select(F.col("v").alias("_last"), "dist")
    st = starts.select(F.col("ne_name").alias("start_ne")).distinct()
    waiting = materialize(
        st.withColumn("_last", F.col("start_ne")).join(dist, "_last")
        .select("start_ne", "_last", F.array("start_ne").alias("path"), F.col("dist").alias("bound")), "open_paths")
    found = None
    while not waiting.isEmpty():
        least = waiting.groupBy("start_ne").agg(F.min("bound").alias("least"))
        flagged = waiting.join(least, "start_ne")
        step = materialize(
            flagged.filter("bound = least").join(h, "_last")
            .filter(~F.array_contains("path", F.col("_b")))
            .select("start_ne", F.col("_b").alias("_last"), F.concat("path", F.array("_b")).alias("path"), "_term"),
            "paths")
        ended = step.filter("_term").select("start_ne", F.col("_last").alias("end_ne"),
                                            (F.size("path") - 1).alias("depth"), "path")
        found = materialize(_first_paths(ended if found is None else found.unionByName(ended), max_paths),
                            "found_paths")
        more = (step.filter("not _term").join(dist, "_last")
                .select("start_ne", "_last", "path", (F.size("path") - 1 + F.col("dist")).alias("bound")))
        full = (found.groupBy("start_ne").agg(F.count(F.lit(1)).alias("n"), F.max("depth").alias("limit"))
                .filter(F.col("n") >= max_paths).select("start_ne", "limit"))
        waiting = materialize(
            flagged.filter("bound > least").drop("least").unionByName(more)
            .join(full, "start_ne", "left").filter("limit is null or bound <= limit").drop("limit"), "open_paths")
    if found is None:
        found = waiting.select("start_ne", F.col("_last").alias("end_ne"), F.lit(0).alias("depth"), "path")
    return found


def _first_paths(paths: DataFrame, max_paths: int, buckets: int = 256) -> DataFrame:
    """The first ``max_paths`` paths per start by (depth, text).  Two-phase, so a start with a
    huge number of paths is never ranked in one task: paths are first ranked inside
    (start, depth, hash bucket of the path) groups and only each group's first survive.
    Exact, because every overall top-k path is in the top-k of its own bucket."""
    columns = paths.columns
    p = (paths.withColumn("_txt", F.array_join("path", ">"))
         .withColumn("_b", F.pmod(F.xxhash64("_txt"), F.lit(buckets))))
    w1 = Window.partitionBy("start_ne", "depth", "_b").orderBy("_txt")
    w2 = Window.partitionBy("start_ne").orderBy("depth", "_txt")
    return (p.withColumn("_r", F.row_number().over(w1)).filter(F.col("_r") <= max_paths)
            .withColumn("_r", F.row_number().over(w2)).filter(F.col("_r") <= max_paths).select(*columns))


# --- vertices on paths, without listing the paths ------------------------------------------

def components(pairs: DataFrame) -> DataFrame:
    """(v, label): connected components of the undirected pairs (x, y), labelled by their
    least vertex: labels spread to neighbours and jump to their label's label."""
    both = materialize(pairs.select("x", "y").unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y")))
                       .distinct(), "pairs")
    labels = materialize(both.groupBy(F.col("x").alias("v")).agg(F.min("y").alias("m"))
                         .select("v", F.least("v", "m").alias("label")), "labels")
    while True:
        near = (both.join(labels.select(F.col("v").alias("y"), "label"), "y")
                .groupBy(F.col("x").alias("v")).agg(F.min("label").alias("near")))
        spread = materialize(labels.join(near, "v").select(
            "v", F.least("label", "near").alias("label"), (F.col("near") < F.col("label")).alias("moved")), "labels")
        if spread.filter("moved").isEmpty():
            return spread.select("v", "label")
        jump = spread.select(F.col("v").alias("label"), F.col("label").alias("next"))
        labels = materialize(spread.join(jump, "label").select("v", F.col("next").alias("label")), "labels")


def blocks(edges: DataFrame, root: str) -> DataFrame:
    """Blocks (two-connected parts, bridges included) of the undirected simple graph (a, b)
    around ``root``: (v, parent, depth, block) for every other vertex that is connected to
    it, where ``block`` names the block of the edge to the parent in a breadth-first tree.

    An edge that is not in the tree closes a cycle through the nearest common
    ancestor of its ends; the tree edges on a cycle are in one block.  Pairs of vertices of
    equal depth climb together from each such edge, deepest level first, until they share
    their parent; equal pairs merge on the way.  The blocks are the components
    of the tree edges that were linked."""
    e = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                    .filter(F.col("a") != F.col("b")).distinct(), "block_edges")
    spark = e.sparkSession
    level = spark.createDataFrame([(root, None, 0)], "v string, parent string, depth int")
    levels = []
    while True:
        known = reduce(DataFrame.unionByName, [level, *levels[-1:]])  # a neighbour is one level off at most
        nxt = materialize(
            e.join(level.select(F.col("v").alias("a")), "a").groupBy(F.col("b").alias("v"))
            .agg(F.min("a").alias("parent")).join(known.select("v"), "v", "left_anti")
            .withColumn("depth", F.lit(len(levels) + 1)), "tree")
        if nxt.isEmpty():
            break
        levels.append(level)
        level = nxt
    levels.append(level)
    if len(levels) == 1:
        return level.filter("depth > 0").withColumn("block", F.col("v"))
    tree = materialize(reduce(DataFrame.unionByName, levels[1:]), "tree")
    up = tree.select("v", "parent", "depth")

    # edges beside the tree, the deeper end (or the lesser name) first
    ends = (e.join(up.select(F.col("v").alias("a"), F.col("parent").alias("pa"), F.col("depth").alias("da")), "a")
            .join(up.select(F.col("v").alias("b"), F.col("parent").alias("pb"), F.col("depth").alias("db")), "b"))
    beside = materialize(
        ends.filter("a <> pb and b <> pa and (da > db or (da = db and a < b))").select("a", "pa", "da", "b", "db"),
        "beside")
    links = [beside.filter("da > db").select(F.col("a").alias("x"), F.col("pa").alias("y"))]
    same = beside.select(F.when(F.col("da") > F.col("db"), F.col("pa")).otherwise(F.col("a")).alias("x"),
                         F.col("b").alias("y"), F.col("db").alias("depth"))
    carried = None
    for depth in range(len(levels) - 1, 0, -1):
        at = same.filter(F.col("depth") == depth).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        if carried is not None:
            at = at.unionByName(carried)
        on = up.filter(F.col("depth") == depth)
        pairs = materialize(
            at.distinct().join(on.select(F.col("v").alias("x"), F.col("parent").alias("px")), "x")
            .join(on.select(F.col("v").alias("y"), F.col("parent").alias("py")), "y"), "cycle_pairs")
        apart = pairs.filter("px <> py")
        links += [pairs.select("x", "y"), apart.select("x", F.col("px").alias("y")),
                  apart.select(F.col("y").alias("x"), F.col("py").alias("y"))]
        carried = apart.select(F.least("px", "py").alias("x"), F.greatest("px", "py").alias("y"))
    labels = components(reduce(DataFrame.unionByName, links))
    return materialize(tree.join(labels, "v", "left").select(
        "v", "parent", "depth", F.coalesce("label", "v").alias("block")), "blocks")


TERMINATION = "\u0000termination"  # all terminations as one vertex; no element's name


def affected_nodes(paths: DataFrame, vertices: DataFrame) -> DataFrame:
    """Distinct (name, type) of the vertices on listed paths."""
    names = paths.select(F.explode("path").alias("ne_name")).distinct()
    return names.join(one_per_name(vertices, "ne_type"), "ne_name")


def vertices_on_paths(vertices: DataFrame, hops: DataFrame, starts: DataFrame, allowed_types: list[str],
                      term_types: list[str] | None = None, term_names: DataFrame | None = None,
                      same_attr: str | None = None, exclude: DataFrame | None = None) -> DataFrame:
    """R2: distinct (ne_name, ne_type) of the vertices on R1's paths, of any length, without
    listing them (hops go both ways).

    With the terminations drawn together into one vertex, a vertex is on a simple
    path from a start to it iff its block is on the way between them in the tree of blocks.
    So the start's block is marked, and from each marked block the one above,
    up to the termination.  A start whose type is not allowed is on no other path, so its
    neighbours start for it.  Terminations count if a start reaches a neighbour of theirs.
    A start that is a termination itself is an error: its paths end at others only."""
    steps = _steps(vertices, hops, allowed_types, term_types, term_names, same_attr, exclude)
    st = materialize(starts.select(F.col("ne_name").alias("v")).distinct(), "starts")
    if not steps.filter("_term").join(st.select(F.col("v").alias("_b")), "_b", "left_semi").isEmpty():
        raise ValueError("a start is a termination itself")
    inner = steps.filter("not _term").select(F.col("_last").alias("a"), F.col("_b").alias("b"))
    last = steps.filter("_term").select(F.col("_last").alias("a")).distinct().withColumn("b", F.lit(TERMINATION))
    passed = inner.select(F.col("b").alias("v")).distinct()
    apart = materialize(st.join(passed, "v", "left_anti").select(F.col("v").alias("a")), "apart")
    of = blocks(inner.unionByName(last).join(passed.select(F.col("v").alias("a")), "a", "left_semi"), TERMINATION)
    begin = st.unionByName(inner.join(apart, "a", "left_semi").select(F.col("b").alias("v")))
    block_of = of.select("v", "block")
    # The topmost vertices of a block hang below a vertex of the block above, or the termination.
    above = materialize(
        of.select("block", F.col("parent").alias("v")).join(block_of.withColumnRenamed("block", "upper"), "v")
        .filter("block <> upper").select("block", "upper").distinct(), "above")
    marked = materialize(block_of.join(begin, "v", "left_semi").select("block").distinct(), "marked")
    parts = [marked]
    while not marked.isEmpty():
        seen = reduce(DataFrame.unionByName, parts)
        marked = materialize(above.join(marked, "block", "left_semi").select(F.col("upper").alias("block"))
                             .distinct().join(seen, "block", "left_anti"), "marked")
        parts.append(marked)
        if len(parts) > 8:
            parts = [materialize(reduce(DataFrame.unionByName, parts), "marked")]
    on = of.join(reduce(DataFrame.unionByName, parts), "block", "left_semi")
    reached = reach(st.select(F.col("v").alias("ne_name")), inner)
    ends = (steps.filter("_term").join(reached.select(F.col("ne_name").alias("_last")), "_last", "left_semi")
            .select(F.col("_b").alias("v")))
    useful = of.select(F.col("v").alias("b")).unionByName(last.select("b").distinct())
    from_outside = (inner.unionByName(last).join(apart, "a", "left_semi").join(useful, "b", "left_semi")
                    .select(F.col("a").alias("v")))
    names = reduce(DataFrame.unionByName, [on.select("v"), on.select(F.col("parent").alias("v")), ends, from_outside])
    return one_per_name(vertices, "ne_type").join(names.select(F.col("v").alias("ne_name")).distinct(), "ne_name")


def backhaul(vertices: DataFrame, hops: DataFrame, edges: DataFrame, starts: DataFrame,
             allowed_types: list[str], max_paths: int, **kwargs) -> tuple[DataFrame, DataFrame]:
    """The ``max_paths`` shortest paths per start to a termination (``shortest_paths``, of
    any length), and the physical links (LLDP) touching any node on them."""
    top = shortest_paths(vertices, hops, starts, allowed_types, max_paths=max_paths, **kwargs)
    n = top.select(F.explode("path").alias("_n")).distinct()
    phys = edges.filter(F.col("relation") == S.LLDP)
    a = phys.join(n, phys.start_ne == n._n, "left_semi")
    b = phys.join(n, phys.end_ne == n._n, "left_semi").join(n, phys.start_ne == n._n, "left_anti")
    return top, a.unionByName(b)


def level_reachable(vertices: DataFrame, hops: DataFrame, element: str, upper_types: list[str],
                    allowed_types: list[str], avoid: str | None) -> DataFrame:
    """Can ``element`` reach an upper-level type over allowed types without
    passing ``avoid``?  One row (element, reachable, upper_reached: how many
    upper-level vertices).  A vertex-set search at any distance; the upper
    level ends it."""
    upper, allowed = ([t.upper() for t in x] for x in (upper_types, allowed_types))
    kind = F.upper("ne_type")
    v = one_per_name(vertices, "ne_type").filter(kind.isin(upper + allowed))
    if avoid:
        v = v.filter(F.col("ne_name") != avoid)
    via = v.select(F.col("ne_name").alias("b"), kind.isin(upper).alias("is_upper"))
    known = hops.join(via, "b")
    inner = known.filter(~F.col("is_upper")).select("a", "b")
    starts = vertices.filter(F.col("ne_name") == element).select("ne_name").distinct()
    inside = reach(starts, inner)
    ends = (known.filter("is_upper").join(inside.select(F.col("ne_name").alias("a")), "a", "left_semi")
            .select("b").distinct())
    return ends.agg(F.count(F.lit(1)).alias("upper_reached")).select(
        F.lit(element).alias("element"), (F.col("upper_reached") > 0).alias("reachable"), "upper_reached")


def reach(seeds: DataFrame, hops: DataFrame) -> DataFrame:
    """Vertex-set BFS: every vertex connected to a seed (seeds included), at any
    distance.  The hops are written once; each round reads them."""
    h = materialize(hops.select(F.col("a").alias("v"), F.col("b").alias("w")), "hops", large=True)
    frontier = materialize(seeds.select(F.col("ne_name").alias("v")).distinct(), "reach")
    parts = [frontier]
    while not frontier.isEmpty():
        visited = reduce(DataFrame.unionByName, parts)
        frontier = materialize(frontier.join(h, "v").select(F.col("w").alias("v")).distinct()
                               .join(visited, "v", "left_anti"), "reach")
        parts.append(frontier)
        if len(parts) > 8:
            parts = [materialize(reduce(DataFrame.unionByName, parts), "reach")]
    return reduce(DataFrame.unionByName, parts).select(F.col("v").alias("ne_name"))


def impact(vertices: DataFrame, hops: DataFrame, element: str,
           upper_types: list[str]) -> tuple[DataFrame, DataFrame]:
    """Remove ``element``; the vertices still connected to an upper-level
    seed are served; of the vertices connected to the element's neighbours
    (without the element), the unserved ones are *dependent*.  Returns
    (nodes with a ``dependent`` flag, links among them)."""
    hops = materialize(hops, "hops")
    g = hops.filter((F.col("a") != element) & (F.col("b") != element))
    seeds = vertices.filter(F.upper("ne_type").isin([t.upper() for t in upper_types])
                            & (F.col("ne_name") != element)).select("ne_name")
    served = reach(seeds, g)
    nbrs = hops.filter(F.col("a") == element).select(F.col("b").alias("ne_name"))
    around = reach(nbrs, g)
    flagged = around.join(served.withColumn("_s", F.lit(True)), "ne_name", "left").select(
        "ne_name", F.col("_s").isNull().alias("dependent"))
    nodes = one_per_name(vertices, "ne_type").join(flagged, "ne_name")
    dep = flagged.filter("dependent").select(F.col("ne_name").alias("a"))
    links = (hops.join(dep, "a", "left_semi")
             .unionByName(hops.filter(F.col("a") == element).select("a", "b")))
    return nodes, links


def port_links(edges: DataFrame, parent_edges: DataFrame | None = None) -> DataFrame:
    """Links seen from either end: (a, a_port, b, b_port, bundled).  Ports are the interface
    suffixes; parent edges have none."""
    def port(c):
        return F.regexp_replace(c, "^.*_", "")

    bundled = reduce(lambda x, y: x | y, [F.coalesce(F.trim(F.col(c)), F.lit("")) != ""
                                          for c in ("src_bundle", "dest_bundle") if c in edges.columns], F.lit(False))
    one = edges.select(F.col("start_ne").alias("a"), port("src_interface").alias("a_port"),
                       F.col("end_ne").alias("b"), port("dest_interface").alias("b_port"), bundled.alias("bundled"))
    if parent_edges is not None:
        none = F.lit(None).cast("string")
        one = one.unionByName(parent_edges.select(F.col("start_ne").alias("a"), none.alias("a_port"),
                                                  F.col("end_ne").alias("b"), none.alias("b_port"),
                                                  F.lit(False).alias("bundled")))
    back = one.select(F.col("b").alias("a"), F.col("b_port").alias("a_port"), F.col("a").alias("b"),
                      F.col("a_port").alias("b_port"), "bundled")
    return one.unionByName(back).filter("a is not null and b is not null and a <> b").distinct()


def correlated_connectivity(vertices: DataFrame, links: DataFrame, element: str, port: str | None = None,
                            levels: dict[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """R5 by the level rule: what hangs on ``element`` (or on one ``port`` of it).

    ``links`` is ``port_links``; ``levels`` gives each type its level, 1 on top.

    1. A neighbour (by a link on the port) is *served* if it still reaches a higher level
       without the element: over vertices of its own level or higher and no bundle, up to the
       first vertex of a higher type (the element's own type does not end it, if there
       is another; at the top, another vertex of the same type does).  One that is
       not is dependent.
    2. Dependent vertices spread to neighbours of their own level or lower, except the element.
       A hop to ``w`` counts if the element's level is not above ``w``'s, or no neighbour of
       ``w`` is at the element's level or higher, or the element is such a neighbour (by
       another port, if a port is asked for), or one of them reaches a level above its own.

    Whether a hop counts is a fact of its end alone, so it is worked out once for all vertices
    (a search per level, not per vertex); the spread is then one reachability search.

    Returns (ne_name, ne_type, dependent) of the element, its neighbours and the dependent
    vertices, and (a, a_port, b, b_port) of the links by which they were reached."""
    levels = {t.upper(): n for t, n in (levels or S.DEVICE_LEVELS).items()}
    level_of = F.create_map(*[F.lit(x) for t, n in levels.items() for x in (t, n)])
    v = materialize(one_per_name(vertices, "ne_type").select(
        "ne_name", "ne_type", F.upper("ne_type").alias("_t"), level_of[F.upper("ne_type")].alias("_l"))
        .filter("_l is not null"), "levels")
    own = v.filter(F.col("ne_name") == element).select("_t", "_l").first()
    if own is None:
        raise ValueError(f"no element {element} of a type with a level")
    h = materialize(
        links.join(v.select(F.col("ne_name").alias("a"), F.col("_t").alias("at"), F.col("_l").alias("al")), "a")
        .join(v.select(F.col("ne_name").alias("b"), F.col("_t").alias("bt"), F.col("_l").alias("bl")), "b"), "level_links")
    at = h.filter(F.col("a") == element)
    if port:
        at = at.filter(F.lower("a_port") == port.lower())
    near = materialize(at.select(F.col("b").alias("ne_name"), F.col("bt").alias("_t"), F.col("bl").alias("_l"))
                       .distinct(), "neighbours")

    rest = h.filter((F.col("a") != element) & (F.col("b") != element))
    served = []
    for r in near.select("_l").distinct().collect():  # at most one row a level
        higher = [t for t, n in levels.items() if n < r["_l"]]
        ends = [t for t in higher if t != own["_t"]] if len(higher) > 1 else higher
        ends = ends or [t for t, n in levels.items() if n == r["_l"]]
        # backwards from the last hop: a hop to an end, then hops through what does not end the way
        up = rest.filter(~F.col("bundled") & (F.col("bl") <= r["_l"]) & (F.col("al") <= r["_l"]))
        last = up.filter(F.col("bt").isin(ends)).select(F.col("a").alias("ne_name"))
        through = up.filter(~F.col("bt").isin(ends)).select(F.col("b").alias("a"), F.col("a").alias("b"))
        served.append(reach(last, through).join(near.filter(F.col("_l") == r["_l"]), "ne_name", "left_semi"))
    unserved = near if not served else near.join(reduce(DataFrame.unionByName, served), "ne_name", "left_anti")

    # facts for step 2: who reaches a level above its own, and whose hops count
    lifted = []
    for n in sorted(x for x in set(levels.values()) if 1 < x <= own["_l"]):
        same = h.filter((F.col("al") == n) & (F.col("bl") == n)).select("a", "b")
        lifted.append(reach(h.filter((F.col("al") == n) & (F.col("bl") < n)).select(F.col("a").alias("ne_name")), same))
    up = (reduce(DataFrame.unionByName, lifted) if lifted else v.limit(0).select("ne_name")).select(
        F.col("ne_name").alias("b"), F.lit(True).alias("_up"))
    other_port = F.lower(F.coalesce("b_port", F.lit(""))) != port.lower() if port else F.lit(True)
    facts = (h.filter((F.col("al") > own["_l"]) & (F.col("bl") <= own["_l"])).join(up.distinct(), "b", "left")
             .groupBy("a").agg(F.max(((F.col("b") == element) & other_port) | F.coalesce("_up", F.lit(False)))
                               .alias("_ok")))
    refused = facts.filter("not _ok").select(F.col("a").alias("b"))
    spread = materialize(rest.filter(F.col("bl") >= F.col("al")).join(refused, "b", "left_anti")
                         .select("a", "a_port", "b", "b_port"), "spread")
    dependent = materialize(reach(unserved.select("ne_name"), spread.select("a", "b")), "dependent")

    flagged = (dependent.withColumn("dependent", F.lit(True))
               .unionByName(near.select("ne_name").join(dependent, "ne_name", "left_anti")
                            .withColumn("dependent", F.lit(False)))
               .unionByName(v.filter(F.col("ne_name") == element).select("ne_name", F.lit(True).alias("dependent"))))
    nodes = v.select("ne_name", "ne_type").join(flagged, "ne_name")
    out = (at.select("a", "a_port", "b", "b_port")
           .unionByName(spread.join(dependent.select(F.col("ne_name").alias("a")), "a", "left_semi")
                        .select("a", "a_port", "b", "b_port")))
    return nodes, out


def hierarchy(vertices: DataFrame, roots: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Descendants of the roots by ``parent_ne``, depth by depth:
    (ancestor, descendant, descendant type, depth), down to the last level (or
    to ``max_depth``, if the caller asks for that).  Each round is one equi
    join of the current level with the children table; a pair that was found
    before is not followed again, so a cycle ends."""
    child = materialize(
        one_per_name(vertices.filter(F.col("parent_ne").isNotNull()), "parent_ne", "ne_type")
        .select(F.col("parent_ne").alias("_p"), F.col("ne_name").alias("descendant"),
                F.col("ne_type").alias("descendant_type")), "children")
    level = roots.select(F.col("ne_name").alias("ancestor"), F.col("ne_name").alias("_p"))
    parts, depth = [], 0
    while max_depth is None or depth < max_depth:
        depth += 1
        nxt = level.join(child, "_p").select("ancestor", "descendant", "descendant_type",
                                             F.lit(depth).alias("depth"))
        if parts:
            nxt = nxt.join(reduce(DataFrame.unionByName, parts).select("ancestor", "descendant"),
                           ["ancestor", "descendant"], "left_anti")
        nxt = materialize(nxt, "hierarchy")
        parts.append(nxt)
        if nxt.isEmpty():
            break
        level = nxt.select("ancestor", F.col("descendant").alias("_p"))
    return reduce(DataFrame.unionByName, parts)


def children_by_type(vertices: DataFrame) -> DataFrame:
    """R7 (one level): number of children per parent and child type (the
    children themselves are the rows of ``hierarchy`` at depth 1; they are
    not gathered into one list per parent)."""
    return (one_per_name(vertices.filter(F.col("parent_ne").isNotNull()), "parent_ne", "ne_type")
            .groupBy(F.col("parent_ne"), F.col("ne_type").alias("child_type"))
            .agg(F.count(F.lit(1)).alias("children")))


def path_hops(paths: DataFrame, edges: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per hop of each path (path id = start + path text):
    (hop index, element, next element, ports oriented to the element, and the
    path's columns ``keep``) —
    ``posexplode`` + ``lead`` inside the path array (no window over rows),
    ports from the smallest-key link between the pair in either direction.
    Only links between neighbours on a path are looked at, once for both directions; the pairs of
    neighbours are stored, so that few of them are broadcast and the links stay where they are."""
    keep = keep or []
    p = paths.select(F.array_join("path", ">").alias("path_id"), "path", *keep)
    steps = p.select("path_id", *keep, F.posexplode(F.slice("path", 1, F.size("path") - 1)).alias("hop", "ne_name"),
                     "path")
    steps = steps.select("path_id", *keep, "hop", "ne_name",
                         F.element_at("path", F.col("hop") + 2).alias("next_ne"))
    steps = steps.select("path_id", *keep, "hop", *_pair("ne_name", "next_ne"))
    pairs = materialize(steps.select("_x", "_y").filter("_x is not null and _y is not null").distinct(), "path_pairs")
    port, next_port = (F.regexp_replace(c, "^.*_", "") for c in ("src_interface", "dest_interface"))
    key = [F.col(c) for c in S.EDGE_KEY]
    ahead = F.struct(*key, port.alias("port"), next_port.alias("next_port"))
    back = F.struct(*key, next_port.alias("port"), port.alias("next_port"))
    links = edges.select(*S.EDGE_KEY, *_pair("start_ne", "end_ne")).join(pairs, ["_x", "_y"], "left_semi")
    # a link of a vertex to itself goes both ways
    there, other = (F.when(F.col("_x") == F.col("_y"), F.least(ahead, back)).when(F.col("_ahead"), a).otherwise(b)
                    for a, b in ((ahead, back), (back, ahead)))
    best = links.groupBy("_x", "_y").agg(F.min(there).alias("_there"), F.min(other).alias("_back"))
    k = F.when(F.col("_ahead"), F.col("_there")).otherwise(F.col("_back"))
    j = steps.join(best, ["_x", "_y"], "left").withColumn("k", k)
    name, after = (F.when(F.col("_ahead"), F.col(a)).otherwise(F.col(b)) for a, b in (("_x", "_y"), ("_y", "_x")))
    return j.select("path_id", "hop", name.alias("ne_name"), after.alias("next_ne"),
                    F.col("k.relation").alias("relation"),
                    F.col("k.port").alias("port"), F.col("k.next_port").alias("next_port"), *keep)


def _pair(a: str, b: str) -> list[Column]:
    """Two names in their order, so that both directions are one pair, and whether ``a`` is the first of them."""
    ahead = F.coalesce(F.col(a) <= F.col(b), F.lit(True))
    return [F.when(ahead, F.col(a)).otherwise(F.col(b)).alias("_x"),
            F.when(ahead, F.col(b)).otherwise(F.col(a)).alias("_y"), ahead.alias("_ahead")]


def paths_to_target(vertices: DataFrame, hops: DataFrame, edges: DataFrame, element: str, target: str,
                    hop_type: str, asked_port: str | None) -> DataFrame:
    """Can ``element`` reach the vertex named ``target`` over vertices of
    ``hop_type``, and does some link by which it gets there use a target port
    other than ``asked_port`` (``holds``)?  ``last_hops`` counts the vertices
    from which the target is reached.  A vertex-set search at any distance: a
    vertex that is reached without the target is on a simple path to it."""
    via = (one_per_name(vertices, "ne_type")
           .filter((F.upper("ne_type") == hop_type.upper()) & (F.col("ne_name") != target))
           .select(F.col("ne_name").alias("b")))
    starts = vertices.filter(F.col("ne_name") == element).select("ne_name").distinct()
    inside = reach(starts, hops.join(via, "b", "left_semi").select("a", "b"))
    prev = materialize(hops.filter(F.col("b") == target)
                       .join(inside.select(F.col("ne_name").alias("a")), "a", "left_semi")
                       .select(F.col("a").alias("prev")), "last_hops")
    port = F.when(F.col("start_ne") == target, F.regexp_replace("src_interface", "^.*_", "")).otherwise(
        F.regexp_replace("dest_interface", "^.*_", ""))
    te = edges.filter((F.col("start_ne") == target) | (F.col("end_ne") == target)).select(
        F.when(F.col("start_ne") == target, F.col("end_ne")).otherwise(F.col("start_ne")).alias("prev"),
        port.alias("target_port"))
    hit = te.join(prev, "prev", "left_semi")
    if asked_port:
        hit = hit.filter(F.col("target_port") != asked_port)
    both = (prev.select(F.lit(1).alias("hop"), F.lit(0).alias("other"))
            .unionByName(hit.select(F.lit(0).alias("hop"), F.lit(1).alias("other"))))
    return both.agg(F.coalesce(F.sum("hop"), F.lit(0)).alias("n"), F.max("other").alias("o")).select(
        F.lit(element).alias("element"), F.lit(target).alias("target"), F.col("n").alias("last_hops"),
        (F.coalesce("o", F.lit(0)) > 0).alias("holds"))
