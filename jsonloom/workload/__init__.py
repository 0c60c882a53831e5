"""Queries over the given tables, one per operator."""

import importlib
import pkgutil

from jsonloom.workload.registry import ORACLES, QUERIES

for _module in pkgutil.iter_modules(__path__):
    importlib.import_module(f"{__name__}.{_module.name}")

__all__ = ["ORACLES", "QUERIES"]
