"""Query registry: one Spark callable ``(spark, sf_dir) -> DataFrame`` per
operator, with the equivalent DuckDB SQL (or ``None`` when no SQL form exists)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def query(name: str, sql: str | None = None, round_cols=(), digits: int = 9):
    """Register ``fn`` under ``name`` with its oracle ``sql``.  ``round_cols``
    are double columns computed in a different operation order by the two
    engines; both results are rounded to ``digits`` decimals."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        if round_cols:
            from pyspark.sql import functions as F

            from newsfeat.queries.sql import rounded

            def wrapped(spark, sf_dir, _fn=fn):
                df = _fn(spark, sf_dir)
                return df.select(*[F.round(F.col(c), digits).alias(c) if c in round_cols else F.col(c)
                                   for c in df.columns])
            wrapped.__doc__ = fn.__doc__
            REGISTRY[name] = (wrapped, rounded(sql, round_cols, digits) if sql else None)
        else:
            REGISTRY[name] = (fn, sql)
        return fn
    return deco


def load_all() -> dict[str, tuple[QueryFn, str | None]]:
    # importing the family modules fills REGISTRY
    from newsfeat.queries import (articles, exploration, incremental, io, learning, statistics,  # noqa: F401
                                  text)
    return REGISTRY
