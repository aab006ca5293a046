"""Benchmark the headline queries.

Builds the stored graph, then runs each query of HEADLINE at ``$BENCH_SF_DIR`` (default sf0.1) on
``local[$BENCH_CPUS]``, fully materialising the result with the ``noop`` sink
(no driver collect), and prints one JSON line: ``value`` is the build and all queries
together, ``build`` and ``query_total`` the two apart.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from netlens.operators import search  # noqa: E402
from netlens.plans.catalog import load_all  # noqa: E402
from netlens.session import build_session  # noqa: E402
from netlens.sources.testdata import Fixtures, stored_graph  # noqa: E402

HEADLINE = [
    "q6_region_links", "q6_region_nodes", "x5_reverse_dedupe",
    "i4_interface_vertices_lldp", "i8_link_rows_lldp", "i13_lsp_hop_edges",
    "u1_merge_vertices", "u2_merge_edges", "a5_count_by_geography",
    "p4_lsp_search_page", "k1_links_with_kpi", "r1_constrained_paths",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    reg = load_all()
    names = [n for n in HEADLINE if n in reg]
    # warm-up: JVM, parquet footers (nothing of it is stored)
    lazy = Fixtures(spark, sf_dir)
    search.by_region(lazy.vertices(), lazy.edges(), "ROUTER,SWITCH", "ASIA", link_relation="OSPF")[0].write.format(
        "noop").mode("overwrite").save()
    t0 = time.time()
    graph = stored_graph(spark, sf_dir)
    for table in (graph.vertices, graph.link_rows, graph.edges, graph.network_element, graph.lsp_hop,
                  graph.mpls_lsp_link):
        table()
    build = round(time.time() - t0, 3)
    times = {}
    for n in names:
        t0 = time.time()
        reg[n][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": round(build + total, 3), "unit": "sec",
                      "queries": times, "build": build, "query_total": total, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
