"""

Every entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame. The clock is a fixed literal
so that stamped outputs are reproducible; the SQL twin of each entry is in ``oracles.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import pin_utc

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}

# Fixed run clock for registered queries (deterministic `*_at_utc` stamps).
RUN_CLOCK = "2025-01-01 00:00:00"
JOB_NAME = "lakeward_check"


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin_utc(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return run

    return deco


def queries() -> dict[str, QueryFn]:
    # import for the registration side effect
    from . import queries_gate, queries_ingest, queries_lifecycle, queries_match, queries_snap, queries_stream  # noqa: F401

    return dict(REGISTRY)
