"""All registered queries, one module per operator family."""

from importlib import import_module

from loomspark.catalog.base import ORACLES, QUERIES

FAMILIES = ["ngram_queries", "window_queries", "token_queries", "function_queries", "vector_queries", "metric_queries", "dist_queries", "prep_queries", "calib_queries", "weight_queries", "bench_queries", "reply_queries", "source_queries", "stream_queries"]

for _name in FAMILIES:
    import_module(f"loomspark.catalog.{_name}")

__all__ = ["ORACLES", "QUERIES"]
