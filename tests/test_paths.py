"""Paths without a limit, and the vertices on them, against enumeration of all simple paths."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from netlens.operators import paths as R

V = "ne_name string, relation string, ne_type string, pop_id long"
PICK = dict(term_types=["AGG"], same_attr="pop_id")


def graph(spark, types, edges, pops=None):
    v = spark.createDataFrame([(n, "VERTEX", t, (pops or {}).get(n, 1)) for n, t in types.items()], V)
    hops = spark.createDataFrame([*edges, *((b, a) for a, b in edges)], "a string, b string").distinct()
    return v.coalesce(1), hops.coalesce(1)


def all_paths(types, edges, start, pops=None):
    near = defaultdict(set)
    for a, b in edges:
        if (pops or {}).get(a, 1) == (pops or {}).get(b, 1):
            near[a].add(b)
            near[b].add(a)
    out, open_ = [], [[start]]
    while open_:
        path = open_.pop()
        for b in near[path[-1]]:
            if b in path or types[b] not in ("ROUTER", "AGG"):
                continue
            (out if types[b] == "AGG" else open_).append([*path, b])
    return out


def check(spark, types, edges, starts, k=3, pops=None):
    v, hops = graph(spark, types, edges, pops)
    st = v.filter(F.col("ne_name").isin(starts))
    paths = {s: sorted(all_paths(types, edges, s, pops), key=lambda p: (len(p), ">".join(p))) for s in starts}
    got = defaultdict(list)
    for r in R.shortest_paths(v, hops, st, ["ROUTER"], max_paths=k, **PICK).collect():
        assert r.depth == len(r.path) - 1 and r.end_ne == r.path[-1]
        got[r.start_ne].append(r.path)
    for s in starts:
        assert sorted(got[s], key=lambda p: (len(p), ">".join(p))) == paths[s][:k]
    on = {r.ne_name: r.ne_type for r in R.vertices_on_paths(v, hops, st, ["ROUTER"], **PICK).collect()}
    assert on == {n: types[n] for ps in paths.values() for p in ps for n in p}


@pytest.mark.parametrize("seed", range(3))
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    names = [f"n{i:02d}" for i in range(12)]
    types = {n: rng.choices(["ROUTER", "AGG", "SWITCH"], [9, 2, 2])[0] for n in names}
    pops = {n: rng.choices([1, 2], [5, 1])[0] for n in names}
    edges = {tuple(rng.sample(names, 2)) for _ in range(rng.choice([12, 15, 18]))}
    starts = [n for n in names if types[n] != "AGG"][:4] + [n for n in names if types[n] == "SWITCH"][:1]
    check(spark, types, sorted(edges), sorted(set(starts)), pops=pops)


def test_chain_of_twelve_hops_and_third_path_of_seven(spark):
    chain = [f"c{i:02d}" for i in range(13)]
    types = {"s": "ROUTER", "t": "AGG", "u": "ROUTER", **{f"d{i}": "ROUTER" for i in range(6)},
             **{f"x{i}": "ROUTER" for i in range(4)}, **dict.fromkeys(chain[:-1], "ROUTER"), chain[-1]: "AGG"}
    edges = [("s", "t"), ("s", "u"), ("u", "t"), ("s", "d0"), *((f"d{i}", f"d{i + 1}") for i in range(5)),
             ("d5", "t"), ("s", "x0"), ("x0", "x1"), ("x1", "x2"), ("x2", "x3"), ("x3", "x1"),
             *zip(chain, chain[1:])]
    assert [len(p) - 1 for p in all_paths(types, edges, chain[0])] == [12]
    assert sorted(len(p) - 1 for p in all_paths(types, edges, "s")) == [1, 2, 7]
    check(spark, types, edges, ["s", chain[0], chain[6]])


def test_hub_where_listing_explodes(spark):
    """Two hubs and 60 routers between them, each pair of neighbours linked: more simple paths than
    could ever be listed.  Everything but the spur is on one."""
    mid = [f"m{i:02d}" for i in range(60)]
    types = dict.fromkeys(["s", "h1", "h2", "spur", *mid], "ROUTER") | {"t": "AGG"}
    edges = [("s", "h1"), ("h2", "t"), ("h1", "spur"), *(("h1", m) for m in mid), *((m, "h2") for m in mid),
             *zip(mid, mid[1:])]
    v, hops = graph(spark, types, edges)
    st = v.filter("ne_name = 's'")
    on = {r.ne_name for r in R.vertices_on_paths(v, hops, st, ["ROUTER"], **PICK).collect()}
    assert on == set(types) - {"spur"}
    top = R.shortest_paths(v, hops, st, ["ROUTER"], max_paths=2, **PICK).collect()
    assert sorted(r.path[2] for r in top) == ["m00", "m01"] and {r.depth for r in top} == {4}


def test_open_paths_are_flagged(spark):
    types = {"s": "ROUTER", "a": "ROUTER", "b": "ROUTER", "c": "ROUTER", "t": "AGG", "dead": "ROUTER", "end": "ROUTER"}
    v, hops = graph(spark, types, [("s", "a"), ("a", "b"), ("b", "c"), ("c", "t"), ("s", "dead"), ("dead", "end")])
    got = R.simple_paths(v, hops, v.filter("ne_name = 's'"), ["ROUTER"], max_depth=2, **PICK).collect()
    assert sorted((r.path, r.finished) for r in got) == [(["s", "a", "b"], False), (["s", "dead", "end"], False)]
    got = R.simple_paths(v, hops, v.filter("ne_name = 's'"), ["ROUTER"], max_depth=4, **PICK).collect()
    assert [(r.path, r.finished) for r in got] == [(["s", "a", "b", "c", "t"], True)]


def test_a_start_that_is_a_termination(spark):
    v, hops = graph(spark, {"s": "AGG", "t": "AGG", "a": "ROUTER"}, [("s", "a"), ("a", "t")])
    with pytest.raises(ValueError):
        R.vertices_on_paths(v, hops, v.filter("ne_name = 's'"), ["ROUTER"], **PICK)
    got = R.shortest_paths(v, hops, v.filter("ne_name = 's'"), ["ROUTER"], max_paths=3, **PICK).collect()
    assert [r.path for r in got] == [["s", "a", "t"]]


def test_no_starts_and_no_termination(spark):
    v, hops = graph(spark, {"s": "ROUTER", "a": "ROUTER"}, [("s", "a")])
    for st in (v, v.limit(0)):
        assert R.shortest_paths(v, hops, st, ["ROUTER"], max_paths=3, **PICK).count() == 0
        assert R.vertices_on_paths(v, hops, st, ["ROUTER"], **PICK).count() == 0


# ------------------------------------------------------------ R5 by the level rule, R4 over bundles
LEVEL = {"C": ("CORE", 1), "A": ("AGG", 2), "R": ("ROUTER", 3), "S": ("SWITCH", 4)}


def level_graph(spark, links):
    """Links (a, b) or (a, a_port, b, b_port[, bundled]); a name's first letter is its type."""
    rows = [(k[0], "1", k[1], "1", False) if len(k) == 2 else (*k, False)[:5] for k in links]
    names = {n for r in rows for n in (r[0], r[2])}
    v = spark.createDataFrame([(n, "VERTEX", LEVEL[n[0]][0], 1) for n in names], V).coalesce(1)
    both = rows + [(b, q, a, p, x) for a, p, b, q, x in rows]
    return v, spark.createDataFrame(both, "a string, a_port string, b string, b_port string, bundled boolean").coalesce(1)


def hanging(spark, links, element, port=None):
    nodes, out = R.correlated_connectivity(*level_graph(spark, links), element, port)
    got = {r.ne_name: r.dependent for r in nodes.collect()}
    assert got.pop(element) is True
    return got, {frozenset((r.a, r.b)) for r in out.collect()}


def brute_hanging(links, element):
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)

    def l(n):
        return LEVEL[n[0]][1]

    def reaches(v, ends, allowed, without):
        open_, seen = [v], {v}
        while open_:
            for w in near[open_.pop()]:
                if w != without and w not in seen and l(w) <= allowed:
                    if w[0] in ends:
                        return True
                    seen.add(w)
                    open_.append(w)
        return False

    def served(v):
        higher = [t for t in "CARS" if LEVEL[t][1] < l(v)]
        ends = [t for t in higher if t != element[0]] if len(higher) > 1 else higher
        return reaches(v, ends or [v[0]], l(v), element)

    def counts(w):
        if l(element) >= l(w):
            return True
        at = [x for x in near[w] if l(x) <= l(element)]
        return not at or element in at or any(
            reaches(x, [t for t in "CARS" if LEVEL[t][1] < l(x)], l(x), None) for x in at)
    dependent = {v for v in near[element] if not served(v)}
    open_ = list(dependent)
    while open_:
        u = open_.pop()
        for w in near[u]:
            if w != element and w not in dependent and l(w) >= l(u) and counts(w):
                dependent.add(w)
                open_.append(w)
    return {v: v in dependent for v in dependent | near[element]}


def test_level_rule_by_hand(spark):
    # S2 has another router with a way up, S3's other router has none; S1 and what hangs on it have
    # none but R1; S5 does not follow, as its router R3 is neither R1 nor leads up
    links = [("C1", "A1"), ("A1", "R1"), ("A1", "R2"), ("R1", "S1"), ("R1", "S2"), ("R2", "S2"), ("R1", "S3"),
             ("R3", "S3"), ("S1", "S4"), ("S4", "S5"), ("S5", "R3"), ("S4", "S6")]
    got, out = hanging(spark, links, "R1")
    assert got == brute_hanging(links, "R1")
    assert got == {"A1": False, "S1": True, "S2": False, "S3": True, "S4": True, "S6": True}
    assert out == {frozenset(k) for k in (("R1", "A1"), ("R1", "S1"), ("R1", "S2"), ("R1", "S3"), ("S1", "S4"),
                                          ("S4", "S6"))}


def test_level_rule_on_one_port_and_over_bundles(spark):
    links = [("C1", "1", "A1", "1"), ("A1", "2", "R1", "1"), ("R1", "2", "S1", "1"), ("R1", "3", "S2", "1"),
             ("A1", "3", "R2", "1"), ("R2", "2", "S2", "2", True)]
    got, out = hanging(spark, links, "R1", "2")
    assert got == {"S1": True} and out == {frozenset(("R1", "S1"))}
    got, _ = hanging(spark, links, "R1", "3")
    assert got == {"S2": True}  # its other way is a bundle


@pytest.mark.parametrize("seed", range(2))
def test_level_rule_on_random_graphs(spark, seed):
    rng = random.Random(seed)
    names = ["C1", "C2", "A1", "A2", "R1", "R2", "R3", "R4", "S1", "S2", "S3", "S4", "S5", "S6"]
    links = sorted({tuple(sorted(rng.sample(names, 2))) for _ in range(18)})
    for element in ("R1", "A1"):
        if any(element in k for k in links):
            got, _ = hanging(spark, links, element)
            assert got == brute_hanging(links, element)


def test_reach_through_a_bundle_only_is_no(spark):
    v = spark.createDataFrame([(n, "VERTEX", t, 1) for n, t in (("s", "SWITCH"), ("r", "ROUTER"), ("t", "AGG"))], V)
    edges = spark.createDataFrame(
        [("LLDP", "s", "r", "b1", None), ("LLDP", "r", "t", None, " ")],
        "relation string, start_ne string, end_ne string, src_bundle string, dest_bundle string")
    for skip, want in ((False, True), (True, False)):
        hops = R.hop_table(edges, skip_bundles=skip)
        assert R.level_reachable(v, hops, "s", ["AGG"], ["ROUTER"], None).first().reachable is want


def test_repeated_hops_give_each_path_once(spark):
    """Searches take hops as often as they are linked, and make those of allowed vertices distinct."""
    types = {"r": "ROUTER", "s": "ROUTER", "x": "SWITCH", "t": "AGG"}
    v, _ = graph(spark, types, [])
    edges = spark.createDataFrame([("r", "s"), ("r", "s"), ("s", "r"), ("s", "t"), ("t", "s"), ("r", "x"), ("r", None)],
                                  "start_ne string, end_ne string")
    rows, st = R.hop_rows(edges), v.filter("ne_name = 'r'")
    assert rows.count() == 12 and R.hop_table(edges).count() == 6
    assert [r.path for r in R.simple_paths(v, rows, st, ["ROUTER"], max_depth=3, **PICK).collect()] == [["r", "s", "t"]]
    assert [r.path for r in R.shortest_paths(v, rows, st, ["ROUTER"], max_paths=3, **PICK).collect()] == [["r", "s", "t"]]
    assert R._steps(v, rows, ["ROUTER"], ["AGG"], None, "pop_id", None).count() == 5
