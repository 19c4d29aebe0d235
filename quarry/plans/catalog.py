"""Imports every query module so that the registry is complete."""

from __future__ import annotations

import importlib

from quarry.plans.registry import REGISTRY

MODULES = ["weblog", "ballots", "graphs", "textsim", "songs", "itemsets", "ml", "qa", "streams", "io", "recommend", "spectral"]


def all_queries():
    for m in MODULES:
        importlib.import_module(f"quarry.plans.{m}")
    return dict(REGISTRY)
