"""SimHash near-duplicates: fingerprints, a binary-trie self-join, connected components.

Fingerprint: one bit per position of the 64-bit hashes of all word shingles, set if
it is set in over half of them.  Equal fingerprints are reduced to one before any
join, so a group of copies costs one row whatever its size.

Self-join: the distinct fingerprints form a binary trie.  Its top is a table of
nodes: a node with more than ``LEAF`` fingerprints below it is split by further
bits until none is left, wherever the fingerprints crowd.  Spark traverses pairs of
these nodes from the root, counts the bits in which their prefixes differ and drops
a pair as soon as the count exceeds the budget.  A pair that is left is one unit of
work: its two sub-tries (at most ``LEAF`` fingerprints each) are traversed together
in a task, bit by bit, pruned by the same budget.  No pair of fingerprints is
compared but by this descent, and none within the budget is lost.

Components: the links of a unit are handed on as stars (each linked fingerprint to
the smallest of its local group; the same connectivity, at most one row per
fingerprint), then large-star/small-star rounds run until nothing changes.

Defined results: null text counts as empty; a text without words has fingerprint
zero, which links like any other.  A text of fewer words than a shingle is one
shingle.  Repeated rows are in one group.  ``component_id`` is the smallest
non-null id that is reachable (null if there is none).  Only id and text are read,
so further columns cannot clash.  An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, taken_over, text_of

LEAF = 1024  # fingerprints of one trie node of the top, at most
SPLIT_BITS, STEP_BITS = 2, 4
SHINGLE, MAX_BITS, SEED = 3, 2, 42


# --- fingerprints ----------------------------------------------------------------------

def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned fingerprint of one text."""
    words = text.encode().lower().split()  # bytes: A-Z and the six ASCII white spaces only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in
                       zip(starts[:len(words) - k + 1].tolist(), (ends[k - 1:] - 1).tolist(),
                           strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(__id, __h, fp): id, hash of the text and signed fingerprint of every row."""
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("__id"), F.xxhash64(text).alias("__h"),
                       text.alias("__t"))

    def run(batches):
        taken_over("simhash")
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle, seed) for t in b.column(2)],
                           np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(fps.view(np.int64))],
                                             ["__id", "__h", "fp"])

    kind = rows.schema["__id"].dataType.simpleString()
    return rows.mapInArrow(run, f"__id {kind}, __h long, fp long")


# --- the top of the trie -----------------------------------------------------------------

def _prefix(fp: Column, depth: Column) -> Column:
    """The first ``depth`` bits, zeros behind them."""
    return F.when(depth > 0, fp.bitwiseAND(
        F.call_function("shiftleft", F.lit(-1).cast("long"), F.lit(64) - depth))
    ).otherwise(F.lit(0).cast("long"))


def trie_nodes(fps: DataFrame, leaf: int = LEAF) -> DataFrame:
    """(prefix, depth, fps): nodes with at most ``leaf`` of the distinct ``fps`` each,
    none above another, together holding all of them."""
    n = fps.count()
    depth = max(0, math.ceil(math.log2(max(1, n / leaf)) / SPLIT_BITS) * SPLIT_BITS)
    parts, open_ = [], fps.select("fp")
    while True:
        at = open_.withColumn("prefix", _prefix(F.col("fp"), F.lit(depth)))
        heavy = stored(at.groupBy("prefix").count().filter(F.col("count") > leaf)
                       .select("prefix"), "simhash_heavy")
        settled = at.join(heavy, "prefix", "left_anti")
        parts.append(settled.groupBy("prefix").agg(F.collect_list("fp").alias("fps"))
                     .withColumn("depth", F.lit(depth)))
        if heavy.isEmpty():
            break
        open_ = stored(at.join(heavy, "prefix", "left_semi").select("fp"), "simhash_open")
        depth = min(64, depth + SPLIT_BITS)
    nodes = parts[0]
    for p in parts[1:]:
        nodes = nodes.unionByName(p)
    return stored(nodes, "simhash_nodes")


def node_pairs(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, a_depth, b, b_depth): unordered pairs of ``nodes``, a node with itself too,
    whose common prefixes differ in at most ``max_bits`` bits; descent from the root."""
    spark = nodes.sparkSession
    deepest = nodes.agg(F.max("depth")).first()[0]
    keys = nodes.select("prefix", "depth")

    def cut(depth: int) -> tuple[Column, Column]:
        at = F.least(F.col("depth"), F.lit(depth))
        return _prefix(F.col("prefix"), at), at

    zero = F.lit(0)
    pairs = spark.range(1).select(F.col("id").alias("a"), zero.alias("a_depth"),
                                  F.col("id").alias("b"), zero.alias("b_depth"))  # the root
    for depth in range(STEP_BITS, (deepest or 0) + STEP_BITS, STEP_BITS):
        up, _ = cut(depth - STEP_BITS)
        own, own_depth = cut(depth)
        kids = keys.select(up.alias("up"), own.alias("own"), own_depth.alias("own_depth")).distinct()
        left = kids.select(F.col("up").alias("a"), F.col("own").alias("a2"),
                           F.col("own_depth").alias("a2_depth"))
        right = kids.select(F.col("up").alias("b"), F.col("own").alias("b2"),
                            F.col("own_depth").alias("b2_depth"))
        common = F.least("a2_depth", "b2_depth")
        differ = F.bit_count(_prefix(F.col("a2").bitwiseXOR(F.col("b2")), common))
        pairs = stored(pairs.join(left, "a").join(right, "b")
                       .filter(((F.col("a") != F.col("b")) | (F.col("a2") <= F.col("b2")))
                               & (differ <= max_bits))
                       .select(F.col("a2").alias("a"), F.col("a2_depth").alias("a_depth"),
                               F.col("b2").alias("b"), F.col("b2_depth").alias("b_depth")),
                       "simhash_pairs")
    return pairs


# --- the descent within a pair of nodes ----------------------------------------------------

def descend(a: np.ndarray, b: np.ndarray, start: int, max_bits: int,
            same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (into the sorted ``a`` and ``b``) at most ``max_bits`` bits apart.

    ``start``: bits above it differ by what the prefixes differ; ``same``: ``b`` is ``a``.
    A pair of sub-tries is a pair of ranges, with the differing bits so far.
    """
    if not len(a) or not len(b):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    above = int(a[0] ^ b[0]) >> (64 - start) if start else 0
    r = np.array([[0], [len(a)], [0], [len(b)], [above.bit_count()]], np.int32)
    found = []
    for bit in range(start, 65):
        single = (r[1] - r[0] == 1) & (r[3] - r[2] == 1)
        if single.any():  # two leaves: the rest of both paths at once
            i, j = r[0, single], r[2, single]
            near = np.bitwise_count(a[i] ^ b[j]) <= max_bits
            found.append((i[near], j[near]))
            r = r[:, ~single]
        if not r.shape[1] or bit == 64:
            break
        shift = np.uint64(63 - bit)
        a_ones = np.concatenate(([0], np.cumsum((a >> shift) & np.uint64(1), dtype=np.int32)))
        b_ones = (a_ones if same else
                  np.concatenate(([0], np.cumsum((b >> shift) & np.uint64(1), dtype=np.int32))))
        am = (r[1] - (a_ones[r[1]] - a_ones[r[0]])).astype(np.int32)
        bm = (r[3] - (b_ones[r[3]] - b_ones[r[2]])).astype(np.int32)
        one = r[4] + 1
        mirror = (r[0] == r[2]) if same else np.zeros(r.shape[1], bool)
        kids = np.concatenate([
            np.stack([r[0], am, r[2], bm, r[4]]), np.stack([am, r[1], bm, r[3], r[4]]),
            np.stack([r[0], am, bm, r[3], one]),
            np.stack([am, r[1], r[2], bm, one])[:, ~mirror]], axis=1)
        r = kids[:, (kids[0] < kids[1]) & (kids[2] < kids[3]) & (kids[4] <= max_bits)]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    i = np.concatenate([x for x, _ in found]).astype(np.int64)
    j = np.concatenate([y for _, y in found]).astype(np.int64)
    if same:
        i, j = i[(off := i != j)], j[off]
    return i, j


def _stars(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """The smallest index that is linked to each of ``n`` indices, over any steps."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return label
        label = new


def links(nodes: DataFrame, pairs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(u, v): stars over the fingerprints that link within each pair of nodes, v < u."""
    left = nodes.select(F.col("prefix").alias("a"), F.col("fps").alias("a_fps"))
    right = nodes.select(F.col("prefix").alias("b"), F.col("fps").alias("b_fps"))
    work = (pairs.join(left, "a").join(right, "b")
            .select(F.least("a_depth", "b_depth").alias("start"),
                    (F.col("a") == F.col("b")).alias("same"), "a_fps", "b_fps"))

    def run(batches):
        for batch in batches:
            us, vs = [], []
            for start, same, x, y in zip(*batch.columns, strict=True):
                a = np.sort(x.values.to_numpy(zero_copy_only=False).view(np.uint64))
                same = same.as_py()
                b = a if same else np.sort(y.values.to_numpy(zero_copy_only=False).view(np.uint64))
                i, j = descend(a, b, start.as_py(), max_bits, same)
                if not len(i):
                    continue
                both = a if same else np.concatenate([a, b])
                star = _stars(i, j if same else j + len(a), len(both))
                off = np.flatnonzero(star != np.arange(len(both)))
                us.append(both[off].view(np.int64))
                vs.append(both[star[off]].view(np.int64))
            if us:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])

    return work.mapInArrow(run, "u long, v long")


# --- components -----------------------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """(u, root): every vertex of ``edges`` (u, v longs) but the smallest of its
    component, with that smallest one.  Large-star and small-star rounds."""
    def oriented(df: DataFrame) -> DataFrame:
        return df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
                         ).filter("u <> v").distinct()

    edges, before = stored(oriented(edges), "links"), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.select("u", F.col("v").alias("root"))
        before = state
        ways = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ways.groupBy("u").agg(F.min("v").alias("m"))
        large = (ways.join(least, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")))
        large = stored(oriented(large), "links_large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        down = large.join(least, "u")
        small = (down.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
        edges = stored(oriented(small), "links")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                   seed: int = SEED) -> DataFrame:
    """(id_col, fingerprint, component_id, text_hash) for every row of ``docs``; the
    fingerprint is a signed long, ``text_hash`` (xxhash64) tells rows of one id apart."""
    rows = stored(fingerprints(docs, id_col, text_col, shingle, seed), "simhash")
    distinct = stored(rows.groupBy("fp").agg(F.min("__id").alias("least_id")), "simhash_fps")
    nodes = trie_nodes(distinct)
    stars = components(links(nodes, node_pairs(nodes, max_bits), max_bits))
    rooted = (distinct.join(stars, distinct["fp"] == stars["u"], "left")
              .select("fp", "least_id", F.coalesce("root", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_fp = stored(rooted.join(least, "root").select("fp", "component_id"), "simhash_of")
    return rows.join(of_fp, "fp").select(F.col("__id").alias(id_col),
                                         F.col("fp").alias("fingerprint"), "component_id",
                                         F.col("__h").alias("text_hash"))
