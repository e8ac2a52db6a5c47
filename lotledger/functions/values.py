"""Values out of extracted text: refinement, counts, flags, tags, address, engine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from lotledger.functions.binding import let
from lotledger.functions.text import drop_dots, first_word, match, null_if_empty, nth_int

# Equipment label -> text of the span that shows it.
PARKING_SENSORS = {
    "Einparkhilfe": "Einparkhilfe",
    "hinten": "Einparkhilfe Sensoren hinten",
    "vorne": "Einparkhilfe Sensoren vorne",
    "kamera": "Einparkhilfe Kamera",
    "selbstlenkendes System": "Einparkhilfe selbstlenkendes System",
}
AIRBAGS = {
    "Beifahrerairbag": "Beifahrerairbag",
    "Fahrerairbag": "Fahrerairbag",
    "hinten": "Airbag hinten",
    "Kopfairbag": "Kopfairbag",
    "Seitenairbag": "Seitenairbag",
}
# Column -> tags, the first one present wins.
TAGS = {
    "climate_control": ["Klimaanlage", "Klimaautomatik"],
    "gearbox": ["Schaltgetriebe", "Automatik"],
    "parking_sensors": ["Einparkhilfe"],
}
# Refinement patterns of site A.
REFINE = {
    "word": r"\S+",
    "digits": r"\d+",
    "price": r"[\d.]+",
    "power_in_kw": r"(\d+) kW",
    "power_in_ps": r"(\d+) PS",
    "fuel_consumption_comb": r"kombiniert: (\S+)",
    "fuel_consumption_city": r"innerorts: (\S+)",
    "fuel_consumption_country": r"ausserorts: (\S+)",
    "first_registration": r"EZ (.*)",
    "service_maintenance": r"HU (.*)",
    "postal_code": r"\s*([0-9]*)",
    "country": r"\s*[0-9]*\s((\S+\s{1})*)",
}


def refine(c: Column, pattern: str, group: int = 0) -> Column:
    return match(c, pattern, group)


def count_text(c: Column) -> Column:
    """Result count with thousand dots (`1.234 Angebote`); no text counts 0."""
    return F.coalesce(drop_dots(first_word(c)).try_cast("bigint"), F.lit(0).cast("bigint"))


def count_run(c: Column) -> Column:
    """First number of a result line, wherever it stands."""
    return nth_int(match(c, r"[\d.]+"))


def flags(texts: Column, vocab: Mapping[str, str]) -> Column:
    """Labels whose text is among `texts`, in vocabulary order, joined; null if none."""

    def present(all_: Column) -> Column:
        return F.concat_ws(", ", *[F.when(F.array_contains(all_, text), F.lit(label)) for label, text in vocab.items()])

    return null_if_empty(let(texts, present))


def tag_value(tags: Column, vocab: Sequence[str]) -> Column:
    """First vocabulary entry among `tags` (vocabulary order, not page order)."""
    return F.get(F.array_intersect(F.array(*[F.lit(v) for v in vocab]), tags), F.lit(0))


def address(c: Column) -> Column:
    """struct<postal_code,country>: leading digits, and what follows the first space."""
    # Both patterns.
    return F.when(
        c.isNotNull(),
        F.struct(
            F.regexp_extract(c, "^[0-9]*", 0).alias("postal_code"),
            F.when(c.contains(" "), F.regexp_extract(c, "[0-9]* (.*)", 1)).alias("country"),
        ),
    )


def engine(c: Column) -> Column:
    """struct<litres,fuel> of an engine line such as `2.0 Diesel`."""
    # Both patterns.
    return F.struct(
        match(c, r"\d+\.?\d*").try_cast("decimal(18,6)").alias("litres"),
        match(c, "[a-zA-Z]+").alias("fuel"),
    )


def first_nonempty(*cols: Column) -> Column:
    return F.coalesce(*[null_if_empty(c) for c in cols])


def join_values(sep: str, *cols: Column) -> Column:
    return null_if_empty(F.concat_ws(sep, *[null_if_empty(c) for c in cols]))


def facets(text: Column) -> Column:
    """Labels of a flattened pair list `"k","v"],["k","v"`: every second element."""
    flat = F.replace(F.replace(text, F.lit("],["), F.lit(",")), F.lit('"'), F.lit(""))
    return F.filter(F.split(flat, ","), lambda _, i: i % 2 == 1)


def script_options(html: Column, name: str) -> Column:
    """The option list `name: … options: [[value, label], …]` of a page's scripts, as an array of arrays of text.

    The list begins at its first bracket, and the JSON reader finds its end, so quotes, commas
    and brackets inside a label are part of the label. Null without such a list, or if it is no list of lists.
    """
    scripts = F.array_join(F.regexp_extract_all(html, F.lit(r"(?is)<script\b[^>]*>(.*?)</script>"), 1), "\n")
    found = F.regexp_extract(scripts, rf"\b\Q{name}\E\s*:.*\s*?.*?\boptions\s*:\s*(\[(?s:.*))", 1)
    return F.from_json(null_if_empty(found), "array<array<string>>")


def script_facets(html: Column, name: str) -> Column:
    """Labels of a page's option list, in its order; an empty array without one."""
    labels = F.transform(script_options(html, name), lambda p: F.get(p, F.lit(1)))
    return F.coalesce(F.filter(labels, lambda x: x.isNotNull()), F.array().cast("array<string>"))
