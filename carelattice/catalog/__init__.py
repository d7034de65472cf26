"""All registered queries, loaded on first use."""

from importlib import import_module

MODULES = ("views_and_sources", "functions", "aggregates", "tables", "quality", "graphs", "streams")


def load():
    for module in MODULES:
        import_module(f"carelattice.catalog.{module}")
    from carelattice.catalog.registry import ORACLES, QUERIES

    return QUERIES, ORACLES
