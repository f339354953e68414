"""Query registry shared by ``__spark_entry__``, ``bench.py`` and the tests."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    tag: str  # SURVEY §2 row id


REGISTRY: dict[str, Query] = {}


def query(name: str, tag: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")

        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            from quarry.session import checkpoint_dir, ship_package
            checkpoint_dir(spark)
            ship_package(spark)
            return fn(spark, sf_dir)
        build.__name__ = getattr(fn, "__name__", name)
        build.__doc__ = fn.__doc__
        REGISTRY[name] = Query(name, build, oracle, tag)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the plan modules fills the registry.
    from quarry.plans import (  # noqa: F401
        tabular, distributions, statistics, text_stats, sampling,
        evaluation, similarity, models_plan, files_plan,
    )
    return REGISTRY
