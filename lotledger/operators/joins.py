"""Lookups and enrichment against the stored table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

KEY = "origin_link"


def lookup(table: DataFrame, batch: DataFrame, cols: Sequence[str], key: str = KEY) -> DataFrame:
    """Stored rows whose key is in the batch, only the wanted columns.

    The batch may hold a key many times; it is reduced map-side first, on the
    partitioning that the join needs anyway.
    """
    return table.select(*cols).join(batch.select(key).distinct(), key, "left_semi")


def mark_seen(batch: DataFrame, table: DataFrame, key: str = KEY) -> DataFrame:
    """The batch with a `seen` flag, in one join for both halves."""
    known = table.select(key).distinct().withColumn("seen", F.lit(True))
    return batch.join(known, key, "left").withColumn("seen", F.coalesce("seen", F.lit(False)))


def split_seen(batch: DataFrame, table: DataFrame, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """(seen, new) rows of a batch; the table has each key once."""
    keys = table.select(key)
    return batch.join(keys, key, "left_semi"), batch.join(keys, key, "left_anti")


def enrich(shallow: DataFrame, detail: DataFrame, keep: Sequence[str] = ("colour", "body_type"), key: str = KEY) -> DataFrame:
    """Detail rows of the batch; `keep` columns come from the shallow row, nothing else does."""
    own = [c for c in detail.columns if c not in keep and c != key]
    side = shallow.select(key, *keep)
    return side.join(detail.select(key, *own), key).select(key, *own, *keep)


def job_logs(jobs: DataFrame, logs: DataFrame, key: str = "job_id") -> DataFrame:
    """Log rows of the given jobs. Filter both sides first; logs may be skewed, jobs are unique."""
    return logs.join(jobs, key)


def split_rejects(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(good, rejects): rows with a reason go to the second output."""
    marked = df.withColumn("reason", reason)
    return marked.where(F.col("reason").isNull()).drop("reason"), marked.where(F.col("reason").isNotNull())
