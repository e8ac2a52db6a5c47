"""Deduplication and first-per-key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lotledger.functions.urls import clear_params


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key in a given order.

    `row_number() = 1` is limited per map task before the shuffle (window group
    limit), so a hot key sends one row per task and not all of them.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def dedupe_url(
    df: DataFrame, url: str = "url", order: Sequence[str] = ("page_id",), exempt: Column | None = None
) -> DataFrame:
    """One row per URL with its parameters cleared; exempt rows all stay.

    Select the narrow columns first: page text does not belong in this shuffle.
    """
    clean = df.withColumn("clean_url", clear_params(F.col(url)))
    if exempt is None:
        return first_per_key(clean, ["clean_url"], order)
    spared = F.coalesce(exempt, F.lit(False))
    # An exempt row is its own group, which also spreads them over all tasks.
    own = F.when(spared, F.struct(*[F.col(c).cast("string").alias(f"o{i}") for i, c in enumerate([url, *order])]))
    return first_per_key(clean.withColumn("_own", own), ["clean_url", "_own"], order).drop("_own")


def dedupe_in(df: DataFrame, facet: str, key: str) -> DataFrame:
    """One row per link within one facet query (only the two columns count)."""
    return df.dropDuplicates([facet, key])


def priced_first(order: Sequence[str], price: str) -> list[Column]:
    """An order in which rows without a price come last, so that one of them never hides a priced row of its link."""
    return [F.col(price).isNull(), *[F.col(c) for c in order]]


def dedupe_run(df: DataFrame, key: str, order: Sequence[str | Column], run: str | None = None) -> DataFrame:
    """One row per link within one run: the earliest capture."""
    return first_per_key(df, [run, key] if run else [key], order)
