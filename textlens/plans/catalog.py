"""The core query catalogue: every module here that has QUERIES (and ORACLES, the same in SQL)."""

from __future__ import annotations

import importlib
import pkgutil

import textlens.plans


def collect(package) -> tuple[dict, dict]:
    queries, oracles = {}, {}
    for m in pkgutil.iter_modules(package.__path__):
        mod = importlib.import_module(f"{package.__name__}.{m.name}")
        queries |= getattr(mod, "QUERIES", {})
        oracles |= getattr(mod, "ORACLES", {})
    return queries, oracles


def catalogue() -> tuple[dict, dict]:
    return collect(textlens.plans)
