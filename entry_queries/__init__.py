"""Queries of the driver contract: library operators on views of the driver's tables."""

import importlib

MODULES = ("cleaning", "dimensions", "merging", "timeseries", "featuring", "files")


def registry():
    for module in MODULES:
        importlib.import_module(f"entry_queries.{module}")
    from entry_queries.core import QUERIES
    return QUERIES
