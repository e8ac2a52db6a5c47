"""Scalar normalisation of listing text (all JVM-side, none of them raises on a bad row)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Number, month and image patterns, the "other" word.
NUMBER_RUN = r"[\d.,]+"
MONTH_YEAR = r"\d{2}/\d{4}"
CLASS_IMAGE = r"envkv(\w+).svg$"
OTHER_WORD = "andere"
PHONE_PREFIX = "tel:"

# Everything a text strip removes, also U+00A0 (which trim keeps).
SPACE = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def match(c: Column, pattern: str, group: int = 0) -> Column:
    """First match of `pattern`, null where there is none."""
    return null_if_empty(F.regexp_extract(c, pattern, group))


def _nth_run(c: Column, n: int) -> Column:
    if n == 0:
        return match(c, NUMBER_RUN)
    return F.get(F.regexp_extract_all(c, F.lit(NUMBER_RUN), F.lit(0)), F.lit(n))


def nth_int(c: Column, n: int = 0, decimal: bool = False) -> Column:
    """n-th number of a text as bigint, both separators deleted.

    `12.345,50` gives 1234550; with `decimal=True` a one- or two-digit part
    after a comma is dropped first, which gives 12345.
    """
    run = _nth_run(c, n)
    if decimal:
        run = F.regexp_replace(run, r",\d{1,2}$", "")
    return F.translate(run, ".,", "").try_cast("bigint")


def nth_float(c: Column, n: int = 0) -> Column:
    """n-th number of a text as double, comma read as the decimal point."""
    return F.replace(_nth_run(c, n), F.lit(","), F.lit(".")).try_cast("double")


def month_year(c: Column) -> Column:
    return match(c, MONTH_YEAR)


def month_start(c: Column) -> Column:
    """`MM/yyyy` text as the first day of that month."""
    return F.try_to_date(F.concat(F.lit("01/"), month_year(c)), "dd/MM/yyyy")


def phone(c: Column) -> Column:
    return F.replace(c, F.lit(PHONE_PREFIX), F.lit(""))


def strip_ws(c: Column, newlines_only: bool = False) -> Column:
    if newlines_only:
        return F.regexp_replace(c, r"^\n+|\n+$", "")
    return F.btrim(c.cast("string"), F.lit(SPACE))


def currency(c: Column, rule: str) -> Column:
    """`symbol`: first visible character; `last`: last one; `word`: first word."""
    if rule == "symbol":
        return match(c, r"\S")
    if rule == "last":
        return null_if_empty(F.right(strip_ws(c), F.lit(1)))
    if rule == "word":
        return first_word(strip_ws(c))
    raise ValueError(f"unknown currency rule {rule!r}")


def drop_dots(c: Column) -> Column:
    return F.replace(c, F.lit("."), F.lit(""))


def first_word(c: Column) -> Column:
    return F.split_part(c, F.lit(" "), F.lit(1))


def capitalise_list(c: Column) -> Column:
    """Upper-case the first letter of each `, ` separated token, keep the rest."""
    return F.array_join(
        F.transform(
            F.split(c, ", "),
            lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2))),
        ),
        ", ",
    )


def drop_other(c: Column) -> Column:
    """Stripped text; null when blank or the word for "other"."""
    text = strip_ws(c)
    return F.when((F.length(text) > 0) & (F.lower(text) != OTHER_WORD), text)


def _cut_first(c: Column, part: Column) -> Column:
    at = F.instr(c, part)
    return F.when(at > 0, F.overlay(c, F.lit(""), at, F.length(part))).otherwise(c)


def headline(c: Column, make: Column, model: Column, plus_is_space: bool = False) -> Column:
    """Headline without the first literal make, then without the first literal model."""
    if plus_is_space:
        make = F.replace(make, F.lit("+"), F.lit(" "))
        model = F.replace(model, F.lit("+"), F.lit(" "))
    return strip_ws(_cut_first(_cut_first(c, make), model))


def efficiency_class(c: Column) -> Column:
    return match(c, CLASS_IMAGE, 1)


def reformat_date(c: Column, src: str = "yyyy-MM-dd", dst: str = "dd-MM-yyyy") -> Column:
    return F.date_format(F.try_to_date(c, src), dst)


def stamp(run_date: str) -> Column:
    """Run date as a job argument (`yyyy-MM-dd`), so that a rerun writes the same rows."""
    return F.lit(run_date).cast("date")


def is_sub_model(c: Column) -> Column:
    return c.rlike(r"^\xa0{2}")


def epoch_ms(c: Column) -> Column:
    """Epoch milliseconds as a timestamp, truncated to whole seconds."""
    return F.timestamp_seconds(F.floor(c / F.lit(1000)).cast("bigint"))


def alert_text(ts: Column, message: Column) -> Column:
    return F.concat_ws("\n", F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), message)
