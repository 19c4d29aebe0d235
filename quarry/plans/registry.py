"""Query registry: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.tables import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    """Register ``fn(t: Tables) -> DataFrame`` under ``name``."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return fn
    return deco
