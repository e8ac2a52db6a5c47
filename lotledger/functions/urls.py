"""URL parameters, as Columns.

A query is read as `&` or `;` separated pairs. Pairs with a blank value do not
count, and of several pairs with one name the last wins. A rewritten query
keeps the order of the pairs, and a parameter that is set goes last.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from lotledger.functions.binding import let
from lotledger.functions.text import null_if_empty

# The percent sequences that are folded to plain letters.
PERCENT_FIXES = (("%21", "!"), ("%E9", "e"), ("%C3%AB", "e"))

_HEAD = r"^[^?#]*"
_QUERY = r"^[^?#]*\?([^#]*)"
_FRAGMENT = r"#(.+)$"


def _decode(c: Column) -> Column:
    """Decoded text; null for a sequence that is no UTF-8."""
    plain = F.try_url_decode(c)
    return F.when(~plain.contains("\N{REPLACEMENT CHARACTER}"), plain)


def _encode(c: Column) -> Column:
    return F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A"))


def _raw_pairs(u: Column) -> Column:
    """array<string> of the pairs that count, as they came."""
    return F.filter(F.split(F.regexp_extract(u, _QUERY, 1), "[&;]"), lambda p: p.rlike("^[^=]*=."))


def _sides(p: Column) -> tuple[Column, Column]:
    return F.substring_index(p, "=", 1), F.substr(p, F.instr(p, F.lit("=")) + 1)


def _pairs(u: Column) -> Column:
    """array<struct<k,v,text>> of the pairs that count.

    k and v are decoded, text is the pair as it is written back. A pair that
    does not decode is kept as it came.
    """

    def pair(p: Column) -> Column:
        raw_k, raw_v = _sides(p)
        k, v = _decode(raw_k), _decode(raw_v)
        return F.struct(
            F.coalesce(k, raw_k).alias("k"),
            F.coalesce(v, raw_v).alias("v"),
            F.coalesce(F.concat(_encode(k), F.lit("="), _encode(v)), p).alias("text"),
        )

    return F.transform(_raw_pairs(u), pair)


def _read(c: Column) -> Column:
    """Decoded text, or the text as it came; most has nothing to decode."""
    return F.when(c.contains("%") | c.contains("+"), F.coalesce(_decode(c), c)).otherwise(c)


def get_param(u: Column, name: str) -> Column:
    # Names are read to find the pair; the value is read of that one only, and nothing is written back.
    found = F.filter(_raw_pairs(u), lambda p: _read(_sides(p)[0]) == name)
    return let(F.try_element_at(found, F.lit(-1)), lambda p: _read(_sides(p)[1]))


def _rebuild(u: Column, query: Column) -> Column:
    fragment = F.regexp_extract(u, _FRAGMENT, 1)
    return F.concat(
        F.regexp_extract(u, _HEAD, 0),
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
        F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""),
    )


def _kept(u: Column, dropped: list[str]) -> Column:
    """Texts of the pairs that stay: the last of each name, without the dropped names."""

    def last_of_each(pairs: Column, newest_first: Column) -> Column:
        return F.filter(
            pairs,
            lambda p, i: (i + F.array_position(newest_first, p["k"]) == F.size(pairs)) & ~p["k"].isin(dropped),
        )

    def texts(pairs: Column) -> Column:
        names = F.reverse(F.transform(pairs, lambda p: p["k"]))
        return F.transform(let(names, lambda newest_first: last_of_each(pairs, newest_first)), lambda p: p["text"])

    return let(_pairs(u), texts)


def remove_param(u: Column, name: str) -> Column:
    return let(F.array_join(_kept(u, [name]), "&"), lambda query: _rebuild(u, query))


def set_params(u: Column, params: Mapping[str, Column]) -> Column:
    """Set several parameters in one pass; a null value leaves the parameter out."""
    new = [
        F.concat(F.lit(name + "="), _encode(value.cast("string")))
        for name, value in params.items()
    ]
    joined = F.concat(_kept(u, list(params)), F.array_compact(F.array(*new)))
    return let(F.array_join(joined, "&"), lambda query: _rebuild(u, query))


def set_param(u: Column, name: str, value: Column) -> Column:
    return set_params(u, {name: value})


def clear_params(u: Column) -> Column:
    with_fragment = F.regexp_replace(F.regexp_replace(u, r"^([^?#]*)\?[^#]*", "$1"), "#$", "")
    return F.when(~u.contains("#"), F.substring_index(u, "?", 1)).otherwise(with_fragment)


def fix_percent(u: Column) -> Column:
    for seq, letter in PERCENT_FIXES:
        u = F.replace(u, F.lit(seq), F.lit(letter))
    return u


def facet_token(c: Column) -> Column:
    return F.translate(c, ' ",', "+")


def raw_param(u: Column, prefix: str, as_int: bool = False, default: int | str | None = None) -> Column:
    """Text after a literal prefix, up to the next `&`, not decoded."""
    text = null_if_empty(F.regexp_extract(u, rf"\Q{prefix}\E([^&]+)", 1))
    value = text.try_cast("bigint") if as_int else text
    return value if default is None else F.coalesce(value, F.lit(default))


def limits(u: Column, low: str, high: str, default: tuple[int, int]) -> Column:
    """struct<lo,hi> of two integer parameters; the default range unless both are there."""
    lo, hi = raw_param(u, low, as_int=True), raw_param(u, high, as_int=True)
    both = lo.isNotNull() & hi.isNotNull()
    return F.struct(
        F.when(both, lo).otherwise(F.lit(default[0])).cast("bigint").alias("lo"),
        F.when(both, hi).otherwise(F.lit(default[1])).cast("bigint").alias("hi"),
    )


def build_url(base: Column, params: Mapping[str, Column]) -> Column:
    return set_params(base, params)


def origin(u: Column) -> Column:
    """`scheme://host` of a URL."""
    return F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)


def absolute(base: Column, href: Column) -> Column:
    """Resolve a link against the URL of its page."""
    site = origin(base)
    path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.regexp_extract(path, r"^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    return (
        F.when(href == "", base)
        .when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, "^[^:]+:", 0), href))
        .when(href.startswith("/"), F.concat(site, _resolve_dots(href)))
        .when(href.startswith("?"), F.concat(site, path, href))
        .when(href.startswith("#"), F.concat(F.substring_index(base, "#", 1), href))
        .otherwise(F.concat(site, _resolve_dots(F.concat(folder, href))))
    )


def _resolve_dots(path: Column) -> Column:
    """Take `.` and `..` segments out of a path; what follows `?` or `#` is left alone."""
    tail = F.regexp_extract(path, r"[?#].*$", 0)
    head = F.regexp_extract(path, r"^[^?#]*", 0)
    folded = F.aggregate(
        F.split(head, "/"),
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1))))
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    ends_in_dots = F.when(head.rlike(r"(^|/)\.\.?$"), F.lit("/")).otherwise("")
    # Most links have no dot segment and skip the fold.
    return F.when(head.rlike(r"(^|/)\.\.?(/|$)"), F.concat(F.array_join(folded, "/"), ends_in_dots, tail)).otherwise(path)
