"""Independent DuckDB SQL for each registered query (the correctness gate)."""

from __future__ import annotations

import importlib

MODULES = ["weblog", "ballots", "graphs", "textsim", "songs", "itemsets", "ml", "qa", "streams", "io", "recommend", "spectral"]


def all_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in MODULES:
        mod = importlib.import_module(f"oracles.{m}")
        for k, v in mod.SQL.items():
            if k in out:
                raise ValueError(f"duplicate oracle {k}")
            out[k] = v
    return out
