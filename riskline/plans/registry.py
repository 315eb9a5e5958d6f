"""Registry of all queries and their oracle SQL, collected from the per-stage modules."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare
from . import queries_drift, queries_fit, queries_model, queries_profile, queries_quality, queries_stream

_MODULES = [queries_quality, queries_drift, queries_profile, queries_model, queries_stream, queries_fit]


def wrapped(fn):
    """The query with the session made ready: checkpoint folder, package on the workers."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict = {}
    for m in _MODULES:
        for k, fn in m.QUERIES.items():
            out[k] = wrapped(fn)
    return out


def all_oracles() -> dict[str, str]:
    out: dict = {}
    for m in _MODULES:
        out.update(m.oracles())
    return out


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    qs = all_queries()
    return qs["psi_table"](spark, sf_dir) if "psi_table" in qs else qs["features"](spark, sf_dir)
