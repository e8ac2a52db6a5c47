"""Micro-batch ingest of shallow rows into a site's stored table.

A batch adds its new listings and one narrow row per listing seen again, and is
part of the table once a manifest names it (see `sources.store`). A replayed batch is known
by its number and changes nothing. The log is folded into the table
every few batches, so files and rows stay bounded however long the stream runs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from lotledger.functions.text import stamp
from lotledger.operators.dedupe import dedupe_run, priced_first
from lotledger.operators.joins import KEY, mark_seen
from lotledger.operators.merge import PRICE, Run, stamp_run
from lotledger.sources.store import Store


def _store(spark: SparkSession, path: str, rows: DataFrame, key: str, fold_after: int) -> Store:
    """The store of rows like these with run columns."""
    return Store(spark, path, stamp_run(rows, Run("", 0, "1970-01-01")).schema, key=key, fold_after=fold_after)


def ingest_batch(
    batch: DataFrame,
    batch_id: int,
    path: str,
    run: Run,
    order: Sequence[str],
    detail: Callable[[DataFrame], DataFrame] | None = None,
    key: str = KEY,
    price: str = PRICE,
    fold_after: int = 16,
) -> None:
    """One micro-batch: dedupe, split seen and new, insert, touch.

    `detail` turns new shallow rows into full rows (extraction or a join); it
    runs on new links only. Rows without a price neither touch nor insert, but a new one
    counts as tried.
    """
    spark = batch.sparkSession
    first = dedupe_run(batch, key, priced_first(order, price))
    store = _store(spark, path, detail(first) if detail else first, key, fold_after)
    manifest = store.manifest()
    if store.applied(run, batch_id, manifest):
        return
    # A stream's session has adaptive execution off for the sake of state stores. This job
    # keeps none, and its join wants runtime sizes and skew splitting; later batches get the setting back.
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    rows = first.persist()
    try:
        marked = mark_seen(rows, store.keys_of(rows, manifest), key).persist()
        try:
            attempted = marked.where(~F.col("seen")).count()
            priced = marked.where(F.col(price).isNotNull())
            new = priced.where(~F.col("seen")).drop("seen")
            again = priced.where("seen").select(key, F.lit(run.iteration_id).cast("bigint").alias("iteration_id"), stamp(run.run_date).alias("parse_date"))
            store.add(stamp_run(detail(new) if detail else new, run), again, attempted, run, batch_id, manifest)
        finally:
            marked.unpersist()
    finally:
        rows.unpersist()
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def ingest(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    run: Run,
    order: Sequence[str],
    detail: Callable[[DataFrame], DataFrame] | None = None,
    key: str = KEY,
    price: str = PRICE,
    fold_after: int = 16,
) -> StreamingQuery:
    """Drain the stream into the table, batch by batch, and stop. `Store.close` then ends the run."""
    return (
        stream.writeStream.foreachBatch(
            lambda batch, batch_id: ingest_batch(batch, batch_id, path, run, order, detail, key, price, fold_after)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current(spark: SparkSession, path: str, schema: T.StructType, key: str = KEY) -> DataFrame:
    """The table as of now: each listing with its latest run metadata."""
    return Store(spark, path, schema, key=key).rows()
