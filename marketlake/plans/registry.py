"""Registered queries: one per operator of the inventory, each with the
equivalent DuckDB SQL over the same tables where SQL can express it.

Every query reads the supplied tables (or frames Spark derives from them) in
full; limits appear only where they are the feature (top-k reports).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import presentable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, base: str) -> DataFrame:
            # the plans do day arithmetic on zone-less timestamps: pin UTC
            if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
                spark.conf.set("spark.sql.session.timeZone", "UTC")
            return presentable(fn(spark, base))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return run
    return deco


def load_all() -> None:
    # importing the modules fills QUERIES / ORACLE_SQL
    from . import q_signals, q_store, q_ingest, q_inventory, q_calendar, q_extras  # noqa: F401
