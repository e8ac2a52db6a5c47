"""Proof queries by name, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def whole(c: str) -> Column:
    """A money column as whole units."""
    return F.floor(F.col(c)).cast("bigint")


def dotted(n: Column) -> Column:
    """A whole number as German text with thousand dots."""
    return F.replace(F.format_number(n, 0), F.lit(","), F.lit("."))


def text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def load_all() -> None:
    from lotledger.plans import proofs_extract, proofs_merge, proofs_ranges, proofs_stream, proofs_text  # noqa: F401
