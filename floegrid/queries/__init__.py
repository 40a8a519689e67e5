"""Registered queries over the driver's tables, each with its DuckDB twin where SQL can say it."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[Query, str | None]] = {}

_MODULES = ("overlap", "naming", "pixels", "dating", "cubes", "vectors", "catalogues", "geometry",
            "warping", "tiling", "swaths", "flows")


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = (fn, oracle)
        return fn
    return register


def load_all() -> dict[str, tuple[Query, str | None]]:
    for module in _MODULES:
        importlib.import_module(f"{__name__}.{module}")
    return REGISTRY
