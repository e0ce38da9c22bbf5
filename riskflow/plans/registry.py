"""Registered queries and their DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and reads the given parquet tables. The
output is passed through ``comparable`` (doubles rounded to 6 places, timestamps
as TIMESTAMP_NTZ) so that it can be compared value by value with the oracle,
which applies the same rounding. Library functions themselves return full
precision.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.sources.fixtures import AS_OF, DUCKDB_FIXTURE_CTE, load_fixture

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

ROUND_DIGITS = 6


def comparable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = round6(c)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def round6(c):
    """Round half up on the binary value with plain IEEE operations.

    The same formula runs in the oracle (see ``r``), so bit-equal inputs give
    bit-equal outputs; the engines' own ``round`` disagree on ties.
    """
    scale = float(10 ** ROUND_DIGITS)
    return (F.floor(c.cast("double") * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale))


def register(name: str, oracle: str | None = None, fixture_cte: bool = True):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle_text(oracle, fixture_cte)
        return fn

    return deco


def oracle_text(body: str, fixture_cte: bool = True) -> str:
    """Prefix the fixture mapping as WITH items; ``body`` may start with its own ``WITH``-less CTE list."""
    body = body.strip()
    if not fixture_cte:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {DUCKDB_FIXTURE_CTE},\n{body[5:]}"
    return f"WITH {DUCKDB_FIXTURE_CTE}\n{body}"


def fixture(spark: SparkSession, sf_dir: str, days: int | None = None):
    """(tx, labels) of the fixture; with ``days`` only those of the days up to the fixture's as-of time."""
    if days is None:
        return load_fixture(spark, sf_dir)
    return load_fixture(spark, sf_dir, F.expr(f"TIMESTAMP '{AS_OF}' - INTERVAL {int(days)} DAYS"), AS_OF)


def r(expr: str) -> str:
    """DuckDB rounding used by the oracles, matching ``comparable``."""
    scale = float(10 ** ROUND_DIGITS)
    return f"(floor(CAST({expr} AS DOUBLE) * {scale} + 0.5) / {scale})"


def load_all() -> None:
    """Import every module that registers queries."""
    import riskflow.plans.queries_eda  # noqa: F401
    import riskflow.plans.queries_features  # noqa: F401
    import riskflow.plans.queries_joins  # noqa: F401
    import riskflow.plans.queries_models  # noqa: F401
    import riskflow.plans.queries_sources  # noqa: F401
    import riskflow.plans.queries_stream  # noqa: F401
    import riskflow.plans.queries_views  # noqa: F401
