"""Stateful seen-set."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def seen_once(stream: DataFrame, key: str, horizon: str | None = None, ts: str = "ts", salts: int = 8) -> DataFrame:
    """First row per key of a stream.

    Without a horizon every key is remembered for good; with one, a key is
    forgotten that long after its event time, and `ts` may be zone-free.
    Rows meet in two state stores: first per (key, salt), then per key. A hot
    key thus spreads over `salts` tasks and sends on one row from each of them.
    """
    keys = [key]
    if horizon is not None:
        stream = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, horizon)
    first = stream.dropDuplicates if horizon is None else stream.dropDuplicatesWithinWatermark
    if salts <= 1:
        return first(keys)
    others = [c for c in stream.columns if c != key]
    salted = stream.withColumn("_salt", F.pmod(F.xxhash64(*others), F.lit(salts)) if others else F.lit(0))
    if horizon is None:
        return salted.dropDuplicates([key, "_salt"]).dropDuplicates(keys).drop("_salt")
    return (
        salted.dropDuplicatesWithinWatermark([key, "_salt"]).dropDuplicatesWithinWatermark(keys).drop("_salt")
    )
