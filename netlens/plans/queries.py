"""Importing this module registers every query family."""

from . import q_graph, q_ingest, q_kpi, q_load, q_lsp, q_merge, q_paths, q_stats, q_sub  # noqa: F401
