"""Where registered queries and their SQL meet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with equivalent SQL where SQL can say it."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round floating-point columns; adding zero turns -0.0 into 0.0."""
    return df.select(
        *[
            (F.round(c, digits) + F.lit(0.0)).alias(c) if t == "double" else F.col(c)
            for c, t in df.dtypes
        ]
    )
