"""Importing this module registers every query."""

import importlib
import pkgutil

import assay.plans as _plans
from assay.plans.registry import ORACLES, QUERIES

for _m in pkgutil.iter_modules(_plans.__path__):
    if _m.name.startswith("queries_"):
        importlib.import_module(f"assay.plans.{_m.name}")

__all__ = ["ORACLES", "QUERIES"]
