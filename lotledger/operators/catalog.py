"""Brand and model catalog, facets and code lookup."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from lotledger.functions.binding import let
from lotledger.functions.predicates import not_other
from lotledger.functions.text import is_sub_model, match, strip_ws
from lotledger.functions.urls import facet_token, fix_percent

# Fixed value: where the brand and model arrays stand in a page's script.
SCRIPT_MODELS = r"brandsAndModels: (\{.*\}),"
_MODEL_ARRAYS = "map<string,array<array<string>>>"


def item_elements(html: Column, tag: str = "item") -> Column:
    """array<struct<key,value>> of elements with `key` and `value` attributes, in page order."""
    found = F.regexp_extract_all(html, F.lit(rf"<{tag}\s[^>]*>"), F.lit(0))
    return F.transform(
        found,
        lambda e: F.struct(match(e, r'\skey="([^"]*)"', 1).alias("key"), match(e, r'\svalue="([^"]*)"', 1).alias("value")),
    )


def without_parents(items: Column) -> Column:
    """Drop a model that a sub-model follows directly, then strip the names.

    Works inside one page row, so it needs neither a shuffle nor a window.
    """

    def kept(all_: Column) -> Column:
        def keep(m: Column, i: Column) -> Column:
            follower = F.get(all_, i + 1)["value"]
            return is_sub_model(m["value"]) | ~F.coalesce(is_sub_model(follower), F.lit(False))

        return F.filter(all_, keep)

    return F.transform(
        let(items, kept), lambda m: F.struct(m["key"].alias("key"), strip_ws(m["value"]).alias("value"))
    )


def last_per_key(items: Column) -> Column:
    """Of several entries with one key the last one counts."""

    def kept(all_: Column) -> Column:
        keys = F.reverse(F.transform(all_, lambda m: m["key"]))
        return let(
            keys,
            lambda newest_first: F.filter(
                all_, lambda m, i: i + F.array_position(newest_first, m["key"]) == F.size(all_)
            ),
        )

    return let(items, kept)


def drop_parents(models: DataFrame, by: str = "brand_key", pos: str = "pos", value: str = "value") -> DataFrame:
    """The same rule for a catalog table with dense positions.

    The neighbour comes from an equi-join on (brand, position), so that a brand
    with a third of all rows is still spread over all tasks.
    """
    subs = models.where(is_sub_model(F.col(value))).select(by, (F.col(pos) - 1).alias(pos)).distinct()
    parents = subs.withColumn("followed", F.lit(True))
    kept = models.join(parents, [by, pos], "left").where(is_sub_model(F.col(value)) | F.col("followed").isNull())
    return kept.drop("followed").withColumn(value, strip_ws(F.col(value)))


def brands(pages: DataFrame, html: str = "html") -> DataFrame:
    """(key, value) per brand element, without the bucket for others."""
    rows = pages.select(F.explode(item_elements(F.col(html))).alias("b"))
    return rows.select("b.key", "b.value").where(not_other(F.col("value")))


def models(pages: DataFrame, brand_key: Column, html: str = "html") -> DataFrame:
    """(brand_key, pos, key, value) per model element of a brand's page."""
    kept = last_per_key(without_parents(item_elements(F.col(html))))
    rows = pages.select(brand_key.alias("brand_key"), F.posexplode(kept).alias("pos", "m"))
    return rows.select("brand_key", "pos", "m.key", "m.value")


def script_catalog(text: Column) -> Column:
    """map<brand, models> out of `"A":[["x","x"],["y","y"]],...` in a script."""
    return F.from_json(match(text, SCRIPT_MODELS, 1), _MODEL_ARRAYS)


def catalog(pages: DataFrame, text: str = "html", key: str = "page_id") -> DataFrame:
    """(page, brand, model) out of the script arrays; the second of each pair is the model."""
    per_brand = pages.select(key, F.explode(script_catalog(F.col(text))).alias("brand", "pairs"))
    rows = per_brand.select(key, "brand", F.explode("pairs").alias("pair"))
    return rows.select(
        key,
        fix_percent(facet_token(F.col("brand"))).alias("brand"),
        facet_token(F.get(F.col("pair"), F.lit(1))).alias("model"),
    )


def cross_facets(models: DataFrame, facets: Mapping[str, Column]) -> DataFrame:
    """Every model with every combination of facet values.

    The option lists come as array Columns of the same row, so the product is a
    local explode: no join, no shuffle, and the work is linear in the models.
    """
    for name, values in facets.items():
        models = models.withColumn(name, F.explode(values))
    return models


def lookup_names(df: DataFrame, brands: DataFrame, models: DataFrame) -> DataFrame:
    """Add `make` and `model` for `brand_key` and `model_key`; null where the code is unknown.

    The dimensions carry no broadcast hint: Spark broadcasts them when their
    measured size is under its threshold, and otherwise shuffles with skew split.
    """
    b = brands.select(F.col("key").alias("brand_key"), F.col("value").alias("make"))
    m = models.select("brand_key", F.col("key").alias("model_key"), F.col("value").alias("model"))
    return df.join(b, "brand_key", "left").join(m, ["brand_key", "model_key"], "left")
