"""The three page layouts (S, U, A): captures to shallow rows and to typed detail rows.

Input is a capture table with `url` and `html`. Only `html` and the columns a
layout needs cross to the element task; everything after it is one select per
step, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from lotledger.functions.binding import let
from lotledger.functions.predicates import is_gone
from lotledger.functions.text import (
    capitalise_list,
    currency,
    drop_dots,
    drop_other,
    efficiency_class,
    first_word,
    headline,
    match,
    month_year,
    nth_float,
    nth_int,
    null_if_empty,
    strip_ws,
)
from lotledger.functions.urls import clear_params, fix_percent, get_param, raw_param
from lotledger.functions.values import AIRBAGS, PARKING_SENSORS, REFINE, TAGS, address, engine, first_nonempty, flags, join_values, tag_value
from lotledger.operators.catalog import lookup_names
from lotledger.operators.joins import split_rejects
from lotledger.operators.merge import PARSE_AGAIN
from lotledger.operators.pages import (
    Elements,
    children,
    first_attr,
    first_text,
    has_attr,
    has_class,
    has_text,
    label_pairs,
    page_fields,
    page_nodes,
    page_rows,
    sibling_after,
    spec_select,
    subtree,
    subtrees,
    text_nodes,
)
from lotledger.schema import LISTING_FIELDS

# Place of a fact in the list of a result item of layout S.
FACTS_S = {
    "mileage": 1,
    "first_registration": 2,
    "power": 3,
    "number_of_previous_owners": 5,
    "gearbox": 6,
    "fuel": 7,
    "fuel_consumption_comb": 8,
    "co2_emission": 9,
}

# URL parameters of the two range-searched sites.
PARAMS_S = {
    "brand": "mmvmk0",
    "model": "mmvmd0",
    "price_from": "pricefrom",
    "price_to": "priceto",
    "mileage_from": "kmfrom",
    "mileage_to": "kmto",
}
PARAMS_U = {
    "brand": "s%5Bbrand%5D=",
    "min_price": "&s%5Bmin_price%5D=",
    "max_price": "&s%5Bmax_price%5D=",
    "model": "&s%5Bcar_model%5D=",
    "body_type": "s%5Bbody_types%5D%5B%5D=",
    "colour": "&s%5Bcolors%5D%5B%5D=",
}
# Field -> label in front of it, site S.
LABELS_S = {
    "body_type": "Karosserieform",
    "cubic_capacity": "Hubraum",
    "fuel": "Kraftstoff",
    "co2_emission": "CO2-Emissionen",
    "number_of_seats": "Sitzplätze",
    "number_of_doors": "Anzahl Türen",
    "gearbox": "Getriebeart",
    "emission_class": "Schadstoffklasse",
    "emission_sticker": "Feinstaubplakette",
    "service_maintenance": "HU Prüfung",
    "colour_manufacturer": "Farbe laut Hersteller",
    "colour": "Außenfarbe",
    "interior": "Innenausstattung",
}
CONSUMPTION_LABEL_S = "Kraftstoffverbrauch"
CONSUMPTION_S = {
    "fuel_consumption_comb": "komb",
    "fuel_consumption_city": "innerorts",
    "fuel_consumption_country": "außerorts",
}
CLIMATE_S = "Klimaautomatik"
# Field -> (group, position) in the basic-data block, site S.
BASIC_S = {
    "mileage": (1, 1),
    "first_registration": (2, 1),
    "number_of_previous_owners": (2, 2),
    "power_in_kw": (3, 1),
    "power_in_ps": (3, 2),
}
# Field -> data-content key of its label or cell, site A.
LABEL_KEYS_A = {
    "make": "brand",
    "model": "model",
    "marketing_headline": "modelVariant",
    "body_type": "bodyType",
    "cubic_capacity": "cubicCapacity",
    "consumption": "consumption",
    "co2_emission": "co2",
    "number_of_seats": "seatCount",
    "number_of_doors": "doorCount",
    "emission_class": "contaminantType",
    "number_of_previous_owners": "previousOwnerCount",
    "colour": "exteriorColor",
    "interior_type": "intType",
    "interior_colour": "intColor",
}
CELL_KEYS_A = {
    "mileage": "mileage",
    "power": "power",
    "fuel": "fuelType",
    "gearbox": "gearbox",
    "first_registration": "registrationDate",
    "service_maintenance": "huDate",
}
SPAN_KEYS_A = {
    "air_con": "hasAirCon",
    "air_con_auto": "hasAirConAutomatic",
    "parking_sensors": "hasParkingAssist",
    "airbags": "hasAirbags",
}
# Field -> class of the list item that shows it, site U.
ITEM_CLASSES_U = {
    "first_registration": "year",
    "mileage": "km",
    "engine": "engine",
    "co2_emission": "co2_emission",
    "energy_efficiency_class": "co2_class",
    "power_in_ps": "hp",
}
ADDRESS_LABEL_U = "PLZ / Stadt:"


def _tag(name: str, *classes: str):
    if not classes:
        return lambda n: n["tag"] == name
    return lambda n: (n["tag"] == name) & has_class(n, *classes)


def _attr(name: str, key: str, value: str):
    return lambda n: (n["tag"] == name) & has_attr(n, key, value)


def _under(nodes: Column, outer, inner) -> Column:
    """First text of an element inside the first matching container."""
    return first_text(subtree(nodes, outer), inner)


#: What tells captures of one page apart; it goes along until a run has chosen one.
CAPTURE = ("status", "fetched_at", "page_id")


def as_listing(df: DataFrame) -> DataFrame:
    """All listing columns in the common types, null where the site has none, and those of the capture; other columns are dropped."""
    given = {c: F.col(c) for c in df.columns}
    return df.select(
        *[given.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in LISTING_FIELDS.items()],
        *[given[c] for c in CAPTURE if c in given],
    )


# Site S


def _facts_s(item: Column) -> Column:
    """The entries of an item's list of facts: the list stands in the second cell of the third block of its first part."""
    part = subtree(item, children(item, "div", 1))
    block = let(part, lambda p: subtree(p, children(p, "div", 3)))
    cell = let(block, lambda b: subtree(b, children(b, "div", 2)))
    entries = let(cell, lambda c: subtree(c, children(c, "ul")))
    return let(entries, lambda ul: F.filter(ul, children(ul, "li")))


def _fact_s(name: str) -> Column:
    """First text of the fact's entry; null where the site has put a placeholder."""
    given = lambda n: (n["nth"] == FACTS_S[name]) & n["attrs"]["data-placeholder"].isNull()
    return null_if_empty(strip_ws(first_text(F.col("facts"), given)))


def shallow_s(pages: DataFrame, origin: str, keep: Sequence[str] = ()) -> DataFrame:
    """One typed row per listing of a result page: its link, the page, headline, price and the list of facts.

    A fact that is missing, empty or a placeholder is null, as is a number that isn't one.
    """
    rows = page_rows(
        page_nodes(pages.select(*keep, "url", "html")),
        _attr("div", "data-item-name", "listing-summary-container"),
        lambda item: first_attr(item, _attr("a", "data-item-name", "detail-page-link"), "href"),
    )
    head = lambda n: (n["tag"] == "h2") & n["attrs"]["class"].contains("cldt-summary-version")
    rows = rows.select(
        *keep,
        F.concat(F.lit(origin), F.col("link")).alias("origin_link"),
        F.col("url").alias("old_url"),
        null_if_empty(strip_ws(first_text(F.col("item"), head))).alias("marketing_headline"),
        first_text(F.col("item"), _attr("span", "data-item-name", "price")).alias("price"),
        _facts_s(F.col("item")).alias("facts"),
    )
    return rows.select(
        "origin_link",
        F.col("origin_link").alias("new_url"),
        "old_url",
        "marketing_headline",
        nth_int(F.col("price")).alias("sales_price_incl_vat"),
        currency(F.col("price"), "symbol").alias("currency"),
        nth_int(_fact_s("mileage")).alias("mileage"),
        nth_int(_fact_s("power"), 0).alias("power_in_kw"),
        nth_int(_fact_s("power"), 1).alias("power_in_ps"),
        _fact_s("fuel").alias("fuel"),
        nth_float(_fact_s("fuel_consumption_comb")).alias("fuel_consumption_comb"),
        nth_int(_fact_s("co2_emission")).alias("co2_emission"),
        _fact_s("gearbox").alias("gearbox"),
        month_year(_fact_s("first_registration")).alias("first_registration"),
        nth_int(_fact_s("number_of_previous_owners")).alias("number_of_previous_owners"),
        *keep,
    )


def _basic_s(pages: Elements, block: np.ndarray) -> list[pa.Array]:
    cells = pages.children("div", block)
    spans = {group: pages.children("span", pages.first(cells, group)) for group, _ in BASIC_S.values()}
    return [pages.text(pages.first(spans[group], position)) for group, position in BASIC_S.values()]


def _consumption_s(pages: Elements, value: np.ndarray) -> list[pa.Array]:
    lines = pages.with_text(pages.children("div", value))
    texts = pages.text(lines)
    has = [pc.match_substring(texts, word).to_numpy(zero_copy_only=False) for word in CONSUMPTION_S.values()]
    return [pages.text(pages.first(lines[mask])) for mask in has]


def _found_s(pages: Elements) -> list[pa.Array]:
    """What detail pages show, in the order of `FOUND_S`."""
    main = pages.first(pages.ids("main"))
    divs, spans, labels = (pages.ids(tag, main) for tag in ("div", "span", "dt"))
    values = np.full(len(pages.tags) + 1, -1)
    values[labels] = pages.after(labels, pages.ids("dd", main))

    def box(cls: str) -> np.ndarray:
        return pages.first(pages.with_class(divs, cls))

    def has(tagged: np.ndarray, text: str) -> np.ndarray:
        return pages.first(pages.with_text(tagged, pc.equal(pages.texts, text)))

    named = pages.with_text(labels)
    names = pc.index_in(pages.text(named), pa.array(LABELS_S.values(), pa.string())).fill_null(-1).to_numpy()
    equipment = pc.is_in(pages.texts, pa.array([*PARKING_SENSORS.values(), *AIRBAGS.values()], pa.string()))
    shown = np.flatnonzero(equipment.to_numpy(zero_copy_only=False) & np.isin(pages.owner, spans))
    return [
        pages.text(pages.first(pages.with_text(pages.ids("h1", box("cldt-headline"))))),
        pages.text(pages.first(pages.with_text(pages.ids("h2", box("cldt-price"))))),
        *_basic_s(pages, box("cldt-stage-basic-data")),
        *_consumption_s(pages, values[has(labels, CONSUMPTION_LABEL_S)]),
        pages.text(has(spans, CLIMATE_S)),
        pages.first_attr(pages.ids("img", box("cldt-co2-efficiency")), "src"),
        # Of several labels with one name the first counts.
        *[pages.text(values[pages.first(named[names == i])]) for i in range(len(LABELS_S))],
        pages.lists(shown),
    ]


#: Fields of a detail page as they are found there.
TEXTS_S = (
    "marketing_headline",
    "price_text",
    *BASIC_S,
    *CONSUMPTION_S,
    "climate_control",
    "energy_efficiency_class",
    *LABELS_S,
)
FOUND_S = dict.fromkeys(TEXTS_S, "string") | {"equipment": "array<string>"}


def detail_s(pages: DataFrame, brands: DataFrame | None = None, models: DataFrame | None = None) -> DataFrame:
    """Typed listing rows from detail pages.

    `pages` has url, html, status; the brand and model codes stand in the URL.
    With the two catalogs the codes become names. The names are joined to the
    extracted rows, not to the pages, so that no page text is shuffled.
    """
    keep = [c for c in ("url", *CAPTURE) if c in pages.columns]
    found = page_fields(pages.select(*keep, "html"), FOUND_S, _found_s)
    spans = F.col("found")["equipment"]
    found = found.withColumns({"parking_sensors": flags(spans, PARKING_SENSORS), "airbags": flags(spans, AIRBAGS)})
    raw = spec_select(found, "found", {name: itemgetter(name) for name in TEXTS_S})
    label = {name: null_if_empty(F.col(name)) for name in LABELS_S}
    typed = raw.select(
        *[c for c in keep if c != "url"],
        clear_params(F.col("url")).alias("origin_link"),
        get_param(F.col("url"), PARAMS_S["brand"]).alias("brand_key"),
        get_param(F.col("url"), PARAMS_S["model"]).alias("model_key"),
        "marketing_headline",
        nth_int(F.col("price_text")).alias("sales_price_incl_vat"),
        currency(F.col("price_text"), "symbol").alias("currency"),
        *[nth_int(F.col(c)).alias(c) for c in ("mileage", "power_in_kw", "power_in_ps", "number_of_previous_owners")],
        *[nth_int(label[c]).alias(c) for c in ("co2_emission", "number_of_seats", "number_of_doors")],
        nth_int(label["cubic_capacity"]).alias("cubic_capacity_cm3"),
        *[nth_float(F.col(c)).alias(c) for c in CONSUMPTION_S],
        month_year(F.col("first_registration")).alias("first_registration"),
        month_year(label["service_maintenance"]).alias("service_maintenance"),
        efficiency_class(F.col("energy_efficiency_class")).alias("energy_efficiency_class"),
        "climate_control",
        "parking_sensors",
        "airbags",
        *[
            label[c].alias(c)
            for c in (
                "body_type",
                "fuel",
                "gearbox",
                "emission_class",
                "emission_sticker",
                "colour_manufacturer",
                "colour",
                "interior",
            )
        ],
    )
    if brands is None or models is None:
        named = typed.withColumns({"make": F.col("brand_key"), "model": F.col("model_key")})
    else:
        named = lookup_names(typed, brands, models)
    title = headline(F.col("marketing_headline"), F.col("make"), F.col("model"))
    return as_listing(named.withColumn("marketing_headline", title))


# Site U


def shallow_u(pages: DataFrame, origin: str, keep: Sequence[str] = ()) -> DataFrame:
    """(origin_link, model, colour, body_type, sales_price_incl_vat) per listing of a result page."""
    rows = page_rows(
        page_nodes(pages.select(*keep, "url", "html")),
        _tag("div", "listing-item-container"),
        lambda item: first_attr(
            subtree(subtree(item, lambda n: has_class(n, "car-details-headline-wrapper")), _tag("h3")), _tag("a"), "href"
        ),
    )
    price = first_attr(subtree(F.col("item"), _tag("div", "price-container")), _tag("span", "price"), "content")
    facet = {c: fix_percent(raw_param(F.col("url"), PARAMS_U[c])) for c in ("model", "colour", "body_type")}
    return rows.select(
        F.concat(F.lit(origin), F.col("link")).alias("origin_link"),
        *[value.alias(name) for name, value in facet.items()],
        price.try_cast("double").cast("bigint").alias("sales_price_incl_vat"),
        *keep,
    )


def _item_u(cls: str):
    return lambda car: _under(car, _tag("li", cls), _tag("span"))


def _title_u(car: Column) -> Column:
    """Text of a span inside a span of the title, else of any span."""

    def pick(title: Column) -> Column:
        return F.coalesce(first_text(F.flatten(_inner_spans(title)), _tag("span")), first_text(title, _tag("span")))

    return let(subtree(car, _tag("h3", "car-title")), pick)


def _inner_spans(nodes: Column) -> Column:
    """Per span, the elements under it."""
    return F.transform(subtrees(nodes, _tag("span")), lambda part: F.slice(part, 2, F.size(part)))


SPEC_U = {
    "make": lambda car: first_text(subtree(subtree(car, _tag("h3", "car-title")), _tag("span")), _tag("b")),
    "price_text": lambda car: first_attr(subtree(car, _tag("div", "pricing")), _tag("span", "price"), "content"),
    "currency_text": lambda car: _under(car, _tag("div", "pricing"), _tag("span", "price")),
    "title": _title_u,
    "consumption": lambda car: first_text(
        F.flatten(_inner_spans(subtree(car, _tag("li", "fuel_efficiency")))), _tag("span")
    ),
    "emission_name": lambda car: _under(car, _tag("li", "euro_emission_class"), _tag("dfn")),
    "emission_value": lambda car: _under(car, _tag("li", "euro_emission_class"), _tag("span")),
    **{name: _item_u(cls) for name, cls in ITEM_CLASSES_U.items()},
}


def detail_u(pages: DataFrame) -> DataFrame:
    """Typed listing rows from detail pages; `pages` has url, html and maybe status and model.

    The model stands on the result page only. Without it see `with_model_u`.
    """
    if "model" not in pages.columns:
        pages = pages.withColumn("model", F.lit(None).cast("string"))
    keep = [c for c in ("url", *CAPTURE, "model") if c in pages.columns]
    nodes = page_nodes(pages.select(*keep, "html"))
    tags = text_nodes(
        subtree(subtree(F.col("nodes"), _tag("section", "equipment")), _tag("ul", "equipment_pills")), _tag("span")
    )
    contact = subtree(F.col("nodes"), _tag("section", "contact-information"))
    label = F.get(F.filter("contact", lambda n: (n["tag"] == "span") & has_text(n, ADDRESS_LABEL_U)), F.lit(0))
    place = let(
        label,
        lambda mark: first_text(
            F.col("contact"),
            lambda n: (n["tag"] == "span")
            & has_class(n, "value")
            & (n["parent"] == mark["parent"])
            & (n["id"] > mark["id"]),
        ),
    )
    nodes = nodes.withColumn("contact", contact)
    cars = nodes.select(
        *keep,
        subtree(F.col("nodes"), _tag("div", "car-details-wrapper")).alias("car"),
        tags.alias("tags"),
        address(place).alias("place"),
        first_attr(F.col("nodes"), _attr("meta", "itemprop", "datePublished"), "content").alias("published"),
    )
    raw = spec_select(cars, "car", SPEC_U)
    motor = engine(F.col("engine"))
    typed = raw.select(
        *[c for c in (*CAPTURE, "model") if c in keep],
        F.col("url").alias("origin_link"),
        "make",
        headline(F.col("title"), F.col("make"), F.col("model"), plus_is_space=True).alias("marketing_headline"),
        F.col("price_text").try_cast("double").cast("bigint").alias("sales_price_incl_vat"),
        currency(F.col("currency_text"), "word").alias("currency"),
        "first_registration",
        nth_int(drop_dots(F.col("mileage"))).alias("mileage"),
        motor["litres"].alias("cubic_capacity_l"),
        motor["fuel"].alias("fuel"),
        nth_float(F.col("consumption")).alias("fuel_consumption_comb"),
        first_word(F.col("co2_emission")).try_cast("bigint").alias("co2_emission"),
        "energy_efficiency_class",
        first_word(F.col("power_in_ps")).try_cast("bigint").alias("power_in_ps"),
        join_values(" ", F.col("emission_name"), F.col("emission_value")).alias("emission_class"),
        *[tag_value(F.col("tags"), vocab).alias(name) for name, vocab in TAGS.items()],
        null_if_empty(F.col("place")["postal_code"]).alias("postal_code"),
        null_if_empty(F.col("place")["country"]).alias("country"),
        F.try_to_date(F.col("published"), "yyyy-MM-dd").alias("published_date"),
    )
    return as_listing(typed)


def with_model_u(detail: DataFrame, shallow: DataFrame) -> DataFrame:
    """Detail rows with the model of their shallow row, which also leaves the headline."""
    model = shallow.select("origin_link", F.col("model").alias("_model"))
    title = headline(F.col("marketing_headline"), F.lit(None).cast("string"), F.col("_model"), plus_is_space=True)
    joined = detail.join(model, "origin_link", "left")
    return joined.withColumns({"marketing_headline": title, "model": F.col("_model")}).drop("_model")


# Site A


def shallow_a(pages: DataFrame, origin: str, keep: Sequence[str] = ()) -> DataFrame:
    """(origin_link, sales_price_incl_vat) per listing of a result page."""
    rows = page_rows(
        page_nodes(pages.select(*keep, "url", "html")),
        _tag("li", "offers", "size1of1", "contentDesc"),
        lambda item: first_attr(item, _tag("a", "vehicleOffersBox"), "href"),
    )
    price = match(first_text(F.col("item"), _tag("span", "priceBig")), REFINE["word"])
    return rows.select(
        F.concat(F.lit(origin), F.col("link")).alias("origin_link"),
        nth_int(drop_dots(price)).alias("sales_price_incl_vat"),
        *keep,
    )


def next_page_a(html: Column) -> Column:
    """Link behind the next-page arrow of a result page, null on the last one."""
    arrow = match(html, r'<a\b[^>]*class="[^"]*icon-right-dir[^"]*"[^>]*>', 0)
    return match(arrow, r'href="([^"]*)"', 1)


def _cell_a(name: str, key: str):
    return lambda nodes: first_text(nodes, _attr(name, "data-content", key))


def _contact_a(nodes: Column) -> Column:
    """Second text of the paragraph after the contact table: postal code and town."""
    box = subtree(nodes, _tag("div", "dealerContactBox"))
    return first_text(subtree(box, _tag("div", "contentBox")), _tag("p"), 1)


SPEC_A = {
    "price_text": lambda nodes: first_text(nodes, _tag("span", "priceBig")),
    "net_text": lambda nodes: first_text(nodes, _tag("td", "priceInfo")),
    "energy_efficiency_class": lambda nodes: first_text(nodes, _tag("span", "coClass")),
    "contact": _contact_a,
    **{name: _cell_a("td", key) for name, key in CELL_KEYS_A.items()},
    **{name: _cell_a("span", key) for name, key in SPAN_KEYS_A.items()},
}


def detail_a(pages: DataFrame) -> DataFrame:
    """Typed listing rows from detail pages; `pages` has url, html and maybe status."""
    keep = [c for c in ("url", *CAPTURE) if c in pages.columns]
    nodes = page_nodes(pages.select(*keep, "html"))
    labelled = nodes.withColumn("labels", label_pairs(F.col("nodes"), lambda n: n["attrs"]["data-content"]))
    raw = spec_select(labelled, "nodes", SPEC_A)
    label = {name: null_if_empty(strip_ws(F.col("labels")[key])) for name, key in LABEL_KEYS_A.items()}

    def price(c: str) -> Column:
        return drop_dots(match(F.col(c), REFINE["price"])).try_cast("bigint")

    typed = raw.select(
        *[c for c in CAPTURE if c in keep],
        F.col("url").alias("origin_link"),
        *[label[c].alias(c) for c in ("make", "model", "marketing_headline", "body_type", "emission_class")],
        price("price_text").alias("sales_price_incl_vat"),
        price("net_text").alias("sales_price_excl_vat"),
        currency(F.col("price_text"), "last").alias("currency"),
        drop_dots(match(F.col("mileage"), REFINE["word"])).try_cast("bigint").alias("mileage"),
        drop_dots(match(label["cubic_capacity"], REFINE["word"])).try_cast("bigint").alias("cubic_capacity_cm3"),
        *[match(F.col("power"), REFINE[c], 1).cast("bigint").alias(c) for c in ("power_in_kw", "power_in_ps")],
        null_if_empty(F.col("fuel")).alias("fuel"),
        *[
            nth_float(match(label["consumption"], REFINE[c], 1)).alias(c)
            for c in ("fuel_consumption_comb", "fuel_consumption_city", "fuel_consumption_country")
        ],
        *[match(label[c], REFINE["digits"]).cast("bigint").alias(c) for c in ("co2_emission", "number_of_doors")],
        *[nth_int(label[c]).alias(c) for c in ("number_of_seats", "number_of_previous_owners")],
        null_if_empty(F.col("energy_efficiency_class")).alias("energy_efficiency_class"),
        match(F.col("gearbox"), REFINE["word"]).alias("gearbox"),
        match(F.col("first_registration"), REFINE["first_registration"], 1).alias("first_registration"),
        match(F.col("service_maintenance"), REFINE["service_maintenance"], 1).alias("service_maintenance"),
        first_nonempty(F.col("air_con"), F.col("air_con_auto")).alias("climate_control"),
        null_if_empty(F.col("parking_sensors")).alias("parking_sensors"),
        null_if_empty(F.col("airbags")).alias("airbags"),
        capitalise_list(drop_other(label["colour"])).alias("colour"),
        join_values(
            ", ",
            capitalise_list(drop_other(label["interior_type"])),
            capitalise_list(drop_other(label["interior_colour"])),
        ).alias("interior"),
        match(F.col("contact"), REFINE["postal_code"], 1).alias("postal_code"),
        null_if_empty(strip_ws(match(F.concat(F.col("contact"), F.lit(" ")), REFINE["country"], 1))).alias("country"),
    )
    return as_listing(typed)


def usable(detail: DataFrame, required: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of detail pages: gone pages are neither, incomplete ones are rejects."""
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(c).isNull()
    here = detail.where(~is_gone(F.col("status"))) if "status" in detail.columns else detail
    return split_rejects(here, F.when(missing, PARSE_AGAIN))
