"""Named queries over the given tables, each with equivalent SQL where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``sql`` gives the same rows."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(use_utc(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles for comparison across engines; -0.0 becomes 0.0."""
    doubles = {name for name, kind in df.dtypes if kind == "double"}
    return df.select(
        *[
            (F.round(name, digits) + F.lit(0.0)).alias(name) if name in doubles else F.col(name)
            for name in df.columns
        ]
    )


def r6(expression: str, name: str | None = None) -> str:
    """SQL twin of :func:`rounded` for one expression."""
    return f"round({expression}, 6) + CAST(0 AS DOUBLE) AS {name or expression}"
