"""One run of a site, from captures to the next version of its table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from lotledger.functions.predicates import REQUIRED_FIELDS
from lotledger.functions.urls import clear_params
from lotledger.operators.dedupe import dedupe_run, first_per_key, priced_first
from lotledger.operators.joins import KEY, enrich
from lotledger.operators.merge import (
    INSERTED,
    PRICE,
    Run,
    bad_fields,
    classify,
    control_row,
    empty_to_null,
    merge_run,
    stamp_run,
)
from lotledger.operators.pages import hrefs, tag_text
from lotledger.plans import sites
from lotledger.session import scratch_dir, written


@dataclass(frozen=True)
class RunResult:
    """Outputs of a run as plans over its classified items and the stored table."""

    table: DataFrame
    outcomes: DataFrame
    rejects: DataFrame
    control: DataFrame


def new_links(batch: DataFrame, table: DataFrame) -> DataFrame:
    """The links of a batch that the table does not have: the pages to extract in detail."""
    return batch.select(KEY).join(table.select(KEY), KEY, "left_anti")


def own_rows(table: DataFrame, run: Run) -> DataFrame:
    """The table's rows of the run's site; where it is partitioned by site, no other is read."""
    return table.where(F.col("site") == run.site) if "site" in table.columns else table


def newest_capture(detail: DataFrame) -> DataFrame:
    """One detail row per link: a good page before a failed one, a priced one before one without a price, then the latest capture.

    Captures of the same time follow their page id, and what is still alike its values, so a rerun stores the same row.
    """
    detail = empty_to_null(detail)
    time = [F.col(c).desc_nulls_last() for c in ("fetched_at", "page_id") if c in detail.columns]
    usable = F.coalesce(F.col("status").between(200, 299), F.lit(False))
    values = F.to_json(F.struct(*[F.col(c) for c in detail.columns]))
    first = first_per_key(detail, [KEY], [~usable, F.col(PRICE).isNull(), *time, "status", values])
    return first.drop("fetched_at", "page_id")


def run_site(
    shallow: DataFrame,
    detail: DataFrame,
    table: DataFrame,
    run: Run,
    order: Sequence[str],
    required: Sequence[str] = (),
    from_shallow: Sequence[str] = (),
    change_price: bool = False,
) -> RunResult:
    """Merge one run's rows into the site table.

    Only the site's own rows of `table` are seen, touched and returned: a link of
    another site is another listing.

    `detail` holds listing rows (with `status`) for new links. `required` is set
    for layout S, `from_shallow` for layout U (colour and body type).

    The items of the run are classified once and written to the shared folder.
    All outputs read that table, so pages are extracted a single time, and a
    lost executor does not send the run back to the captures.
    """
    table = own_rows(table, run)
    batch = dedupe_run(shallow, KEY, priced_first(order, PRICE))
    detail = newest_capture(detail)
    if from_shallow:
        detail = enrich(batch, detail, from_shallow)
    items = written(classify(batch, table, detail, required), scratch_dir(batch.sparkSession, "run"))
    inserted = F.col("information") == INSERTED
    seen = F.col("seen") & F.col("information").isNotNull()

    # A touched row needs only the key and the batch price; an inserted row is its detail row.
    full = items.where(inserted).select(KEY, "detail.*").drop("status")
    touched = items.where(seen).select(KEY, F.col("price").alias(PRICE))
    return RunResult(
        table=merge_run(table, touched, run, change_price, inserted=full.withColumn("site", F.lit(run.site))),
        outcomes=items.select(KEY, "seen", "information"),
        rejects=items.where(~F.col("seen") & ~inserted).select(KEY, F.col("information").alias("reason")),
        control=control_row(bad_fields(items.where("NOT seen").select("information", "detail.*"), inserted), run),
    )


def run_captures(
    layout: str,
    results: DataFrame,
    details: DataFrame,
    table: DataFrame,
    run: Run,
    origin: str,
    order: Sequence[str] = ("page_id",),
    catalogs: tuple[DataFrame, DataFrame] | None = None,
    change_price: bool = False,
) -> RunResult:
    """A whole run from stored captures of result pages and detail pages.

    `order` names capture columns of `results`; the earliest priced capture of a
    link counts. `catalogs` are the (brands, models) of layout S. Result pages are
    extracted once; of the detail pages only those of links that the site's table
    lacks.
    """
    if layout not in ("S", "U", "A"):
        raise ValueError(f"unknown page layout {layout!r}")
    found = {"S": sites.shallow_s, "U": sites.shallow_u, "A": sites.shallow_a}[layout](results, origin, order)
    # Only what the merge reads moves: other facts of a result item come from its detail page.
    used = [c for c in (KEY, PRICE, "model", "colour", "body_type") if c in found.columns]
    found = found.select(*used, *[c for c in order if c not in used])
    batch = written(dedupe_run(found, KEY, priced_first(order, PRICE)), scratch_dir(results.sparkSession, "batch"))
    link = clear_params(F.col("url")) if layout == "S" else F.col("url")
    fresh = new_links(batch, own_rows(table, run)).withColumnRenamed(KEY, "_link")
    details = details.withColumn("_link", link).join(fresh, "_link", "left_semi").drop("_link")
    if layout == "S":
        detail = sites.detail_s(details, *(catalogs or ()))
        return run_site(batch, detail, table, run, order, REQUIRED_FIELDS, change_price=change_price)
    if layout == "U":
        detail = sites.with_model_u(sites.detail_u(details), batch)
        return run_site(batch, detail, table, run, order, (), ("colour", "body_type"), change_price)
    return run_site(batch, sites.detail_a(details), table, run, order, change_price=change_price)


def pages_added(pages: DataFrame, stored: DataFrame, run: Run) -> DataFrame:
    """Distinct pages that a run adds, with title, heading and link count and the run metadata.

    Page text is read by a few expressions and dropped before the first
    shuffle; dedupe and the anti-join move only the narrow rows.
    """
    fields = pages.select(
        "page_id",
        clear_params(F.col("url")).alias(KEY),
        tag_text(F.col("html"), "title").alias("title"),
        tag_text(F.col("html"), "h1").alias("heading"),
        F.size(hrefs(F.col("html"))).cast("bigint").alias("n_links"),
    )
    first = dedupe_run(fields, KEY, ["page_id"])
    return stamp_run(first.join(stored.select(KEY), KEY, "left_anti"), run)
