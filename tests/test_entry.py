"""The entry point without the training-data operators, and queries over the stored graph."""

import sys

import __spark_entry__ as entry
from netlens.plans.catalog import load_all
from netlens.sources.testdata import stored_graph

from .conftest import SF001


def test_topology_queries_stay_when_the_rest_cannot_be_imported(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)  # its import fails
    assert set(entry.queries()) == set(load_all())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_read_the_stored_graph(spark):
    graph = stored_graph(spark, SF001)
    assert stored_graph(spark, SF001 + "/") is graph
    graph.vertices(), graph.edges()
    for name in ("q6_region_nodes", "x10_city_nodes", "q10_unified_nodes"):
        if name not in load_all():
            continue
        df = load_all()[name][0](spark, SF001)
        assert not [f for f in df.inputFiles() if "lineitem" in f], name
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") <= 20, name
