"""Registered queries: the Spark side and its SQL twin side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cairngraph.plans.bindings import Tables, oracle_text

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, uses: str = "") -> Callable:
    """Register a function of the bound tables; `sql` is its twin over the bindings in `uses`."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(Tables(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = oracle_text(sql, uses.split())
        return build

    return register
