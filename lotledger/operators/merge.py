"""Run state and upsert.

A run takes one batch of shallow rows, the stored table and the detail rows of
the links, and gives touched and inserted rows, a label per item, and the list
of mandatory columns that stayed empty.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lotledger.functions.predicates import is_gone, is_valid
from lotledger.functions.text import null_if_empty, stamp
from lotledger.operators.dedupe import first_per_key
from lotledger.operators.joins import KEY, mark_seen

# Mandatory columns, and the label of each outcome.
MANDATORY = (
    "make",
    "model",
    "sales_price_incl_vat",
    "currency",
    "body_type",
    "mileage",
    "fuel_consumption_comb",
    "first_registration",
    "colour",
)
IN_DATABASE = "Already in database"
SOLD = "Car was sold"
PARSE_AGAIN = "Car will parse again"
INVALID = "Invalid response"
NO_PRICE = "Car hasn't price"
PRICE_UPDATED = "Updated car price"
INSERTED = "inserted"

PRICE = "sales_price_incl_vat"
RUN_COLUMNS = ("iteration_id", "is_synced", "parse_date")


@dataclass(frozen=True)
class Run:
    """One run of one site; the date (`yyyy-MM-dd`) is an argument, so a rerun gives the same rows."""

    site: str
    iteration_id: int
    run_date: str


def last_iteration(control: DataFrame, site: str) -> DataFrame:
    """One row (site_name, iteration_id): the last run of a site, 0 if it never ran."""
    last = F.coalesce(F.max("iteration_id"), F.lit(0)).cast("bigint")
    return control.where(F.col("site_name") == site).agg(last.alias("iteration_id")).select(
        F.lit(site).alias("site_name"), "iteration_id"
    )


def next_iteration(control: DataFrame, site: str) -> DataFrame:
    return last_iteration(control, site).withColumn("iteration_id", F.col("iteration_id") + 1)


def stamp_run(df: DataFrame, run: Run) -> DataFrame:
    """Run metadata of a new row."""
    return df.withColumns(
        {
            "iteration_id": F.lit(run.iteration_id).cast("bigint"),
            "is_synced": F.lit(0).cast("int"),
            "parse_date": stamp(run.run_date),
        }
    )


def empty_to_null(df: DataFrame) -> DataFrame:
    """Empty text counts as absent."""
    return df.select(
        *[null_if_empty(F.col(f.name)).alias(f.name) if f.dataType.simpleString() == "string" else F.col(f.name) for f in df.schema]
    )


def touch(table: DataFrame, keys: DataFrame, run: Run, key: str = KEY) -> DataFrame:
    """The table with new run metadata on the rows whose key is given; `is_synced` and price stay."""
    hit = keys.select(key).distinct().withColumn("_hit", F.lit(True))
    matched = F.col("_hit").isNotNull()
    return (
        table.join(hit, key, "left")
        .withColumn("iteration_id", F.when(matched, F.lit(run.iteration_id).cast("bigint")).otherwise(F.col("iteration_id")))
        .withColumn("parse_date", F.when(matched, stamp(run.run_date)).otherwise(F.col("parse_date")))
        .drop("_hit")
    )


def insert_new(batch: DataFrame, table: DataFrame, run: Run, key: str = KEY) -> DataFrame:
    """Rows of the batch that the table does not have, with run metadata."""
    return stamp_run(batch.join(table.select(key), key, "left_anti"), run)


def update_price(table: DataFrame, batch: DataFrame, run: Run, key: str = KEY, price: str = PRICE) -> DataFrame:
    """Touch, and where the price of the batch differs take it over and reset `is_synced`.

    A seen row without a price is skipped. Of a link's prices in the batch the lowest counts.
    """
    new = batch.where(F.col(price).isNotNull()).groupBy(key).agg(F.min(price).alias("_price"))
    matched = F.col("_price").isNotNull()
    changed = matched & ~F.col(price).eqNullSafe(F.col("_price"))
    return (
        table.join(new, key, "left")
        .withColumns(
            {
                "iteration_id": F.when(matched, F.lit(run.iteration_id).cast("bigint")).otherwise(F.col("iteration_id")),
                "parse_date": F.when(matched, stamp(run.run_date)).otherwise(F.col("parse_date")),
                "is_synced": F.when(changed, F.lit(0).cast("int")).otherwise(F.col("is_synced")),
                price: F.when(changed, F.col("_price")).otherwise(F.col(price)),
            }
        )
        .drop("_price")
    )


def merge_run(
    table: DataFrame, batch: DataFrame, run: Run, change_price: bool = False, key: str = KEY, price: str = PRICE, inserted: DataFrame | None = None
) -> DataFrame:
    """Stored rows, touched where the batch has their link, and inserted rows.

    `batch` has the table's columns; of rows that repeat a link the lowest price counts,
    as in `update_price`, so stored rows never multiply. Stored rows meet only the links and prices of the batch, which Spark broadcasts while
    they are small, so that a small batch does not shuffle the table. Rows of
    `batch` without a price neither touch nor insert. Where `inserted` is given,
    `batch` is the rows that touch; those of `inserted` were judged before and come
    in whatever their price.
    """
    new = batch.where(F.col(price).isNotNull())
    hits = new.groupBy(key).agg(F.min(price).alias("_price"))
    matched = F.col("_price").isNotNull()
    changed = matched & ~F.col(price).eqNullSafe(F.col("_price")) & F.lit(change_price)
    values = {
        "iteration_id": F.when(matched, F.lit(run.iteration_id).cast("bigint")).otherwise(F.col("iteration_id")),
        "parse_date": F.when(matched, stamp(run.run_date)).otherwise(F.col("parse_date")),
        "is_synced": F.when(changed, F.lit(0).cast("int")).otherwise(F.col("is_synced")),
        price: F.when(changed, F.col("_price")).otherwise(F.col(price)),
    }
    stored = table.join(hits, key, "left").select(*[values.get(c, F.col(c)).alias(c) for c in table.columns])
    fresh = stamp_run(inserted if inserted is not None else first_per_key(new.join(table.select(key), key, "left_anti"), [key], [price, *(c for c in new.columns if c in table.columns and c not in (key, price))]), run)
    absent = F.lit(None)
    return stored.unionByName(
        fresh.select(*[(F.col(f.name) if f.name in fresh.columns else absent).cast(f.dataType).alias(f.name) for f in table.schema])
    )


def classify(
    batch: DataFrame,
    table: DataFrame,
    detail: DataFrame,
    required: Sequence[str] = (),
    key: str = KEY,
    price: str = PRICE,
) -> DataFrame:
    """(key, price, seen, information, detail) per item of the batch, in one pass.

    `detail` has one row per link with `status`, `currency` and the `required`
    columns, and comes back as a struct. A seen row without a price is skipped
    and has no label. For a new row the order is: sold, parse again, no
    currency, no shallow price, inserted. Batch, table and detail are unique on
    the key, so each is shuffled once and no key is hot.
    """
    d = detail.select(key, F.struct(*[c for c in detail.columns if c != key]).alias("detail"))
    rows = mark_seen(batch.select(key, F.col(price).alias("price")), table, key).join(d, key, "left")
    no_price = F.col("price").isNull()
    broken = F.col("detail").isNull()
    if required:
        broken = broken | ~is_valid(*[F.col(f"detail.{c}") for c in required])
    label = (
        F.when(F.col("seen"), F.when(~no_price, IN_DATABASE))
        .when(is_gone(F.col("detail.status")), SOLD)
        .when(broken, PARSE_AGAIN)
        .when(F.col("detail.currency").isNull(), INVALID)
        .when(no_price, NO_PRICE)
        .otherwise(INSERTED)
    )
    return rows.select(key, "price", "seen", label.alias("information"), "detail")


def outcome(
    batch: DataFrame,
    table: DataFrame,
    detail: DataFrame,
    required: Sequence[str] = (),
    key: str = KEY,
    price: str = PRICE,
) -> DataFrame:
    """(key, seen, information) per item of the batch (see `classify`)."""
    needed = list(dict.fromkeys([key, "status", "currency", *required]))
    return classify(batch, table, detail.select(*needed), required, key, price).select(key, "seen", "information")


def bad_fields(attempted: DataFrame, inserted: Column, mandatory: Sequence[str] = MANDATORY, by: Sequence[str] = ()) -> DataFrame:
    """(by, bad_fields): mandatory columns that are null in every inserted row.

    `attempted` holds the new items of the run and `inserted` tells which of
    them were stored. Nothing attempted gives an empty list (or, with `by`, no
    row); attempted but nothing inserted gives all names. A column the rows do
    not have is empty. One pass, one aggregation.
    """
    absent = F.lit(None).cast("string")
    filled = [
        F.count(F.when(inserted, F.col(c) if c in attempted.columns else absent)).alias(f"_{c}") for c in mandatory
    ]
    counts = attempted.groupBy(*by).agg(F.count("*").alias("_n"), *filled)
    empty = F.array_compact(F.array(*[F.when((F.col("_n") > 0) & (F.col(f"_{c}") == 0), F.lit(c)) for c in mandatory]))
    return counts.select(*by, empty.alias("bad_fields"))


def control_row(bad: DataFrame, run: Run) -> DataFrame:
    """The run-counter row (site_name, iteration_id, bad_fields) that closes a run."""
    return bad.select(
        F.lit(run.site).alias("site_name"), F.lit(run.iteration_id).cast("bigint").alias("iteration_id"), "bad_fields"
    )
