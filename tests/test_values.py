"""Value cases of the column functions."""

import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from lotledger.functions import text as X
from lotledger.functions import urls as U
from lotledger.functions import values as V
from lotledger.functions.predicates import is_recent

NBSP = "\N{NO-BREAK SPACE}"
lit = F.lit


def null():
    return F.lit(None).cast("string")



def test_numbers(values):
    assert values(
        X.nth_int(lit("\N{EURO SIGN} 12.345,-")),
        X.nth_int(lit("66 kW / 90 PS"), 1),
        X.nth_int(lit("12.345,50")),
        X.nth_int(lit("12.345,50"), decimal=True),
        X.nth_int(lit("keine")),
        X.nth_int(lit(",")),
        X.nth_int(lit("66 kW"), 1),
        X.nth_float(lit("5,4 l/100 km")),
        X.nth_float(lit("1.234,5")),
    ) == (12345, 90, 1234550, 12345, None, None, None, 5.4, None)


def test_text(values):
    assert values(
        X.month_year(lit("EZ 03/2015")),
        X.month_year(lit("neu")),
        X.currency(lit("\N{EURO SIGN} 9.990"), "symbol"),
        X.currency(lit("9.990 \N{EURO SIGN}"), "last"),
        X.currency(lit(" EUR VB "), "word"),
        X.capitalise_list(lit("dunkel blau, hell-grau")),
        X.drop_other(lit(" Andere ")),
        X.drop_other(lit("  ")),
        X.drop_other(lit(" rot ")),
        X.strip_ws(lit(NBSP + NBSP + "A3")),
        X.strip_ws(lit("\n A3\n"), newlines_only=True),
        X.efficiency_class(lit("/img/envkvB.svg")),
        X.phone(lit("tel:089")),
    ) == ("03/2015", None, "\N{EURO SIGN}", "\N{EURO SIGN}", "EUR", "Dunkel blau, Hell-grau", None, None, "rot", "A3", " A3", "B", "089")


def test_headline_and_dates(values):
    assert values(
        X.headline(lit("BMW 116 BMW i"), lit("BMW"), lit("116")),
        X.headline(lit("a.b c"), lit("."), lit("x")),
        X.headline(lit("Golf GTI"), null(), lit("Golf")),
        X.reformat_date(lit("2018-03-09")),
        X.reformat_date(lit("bad")),
        F.unix_seconds(X.epoch_ms(lit(1520590000999))),
        X.is_sub_model(lit(NBSP + NBSP + "I")),
        X.is_sub_model(lit(NBSP + "I")),
        X.alert_text(lit("2018-03-09 10:06:40").cast("timestamp"), lit("boom")),
    ) == ("BMW i", "ab c", "GTI", "09-03-2018", None, 1520590000, True, False, "2018-03-09 10:06:40\nboom")


def test_urls(values):
    assert values(
        U.get_param(lit("http://h/p?a=1&a=2&a="), "a"),
        U.get_param(lit("http://h/p?a=1"), "b"),
        U.get_param(lit("http://h/p?a=x%20y;b=1#a=9"), "a"),
        U.remove_param(lit("http://h/p?a=1&b=2"), "a"),
        U.remove_param(lit("http://h/p?a=1"), "a"),
        U.set_param(lit("http://h/p?a=1&b="), "c", lit(3)),
        U.set_param(lit("http://h/p#f"), "c", lit("x y*")),
        U.set_param(lit("http://h/p?m=Coup%E9"), "c", lit(3)),
        U.set_param(lit("http://h/p?m=100%2541"), "c", lit(3)),
        U.clear_params(lit("https://h/p?a=1#top")),
        U.clear_params(lit("https://h/p#top?a=1")),
        U.fix_percent(lit("Citro%C3%ABn Coup%E9 up%21")),
        U.raw_param(lit("h?s%5Bbrand%5D=BMW&x"), "s%5Bbrand%5D="),
    ) == (
        "2",
        None,
        "x y",
        "http://h/p?b=2",
        "http://h/p",
        "http://h/p?a=1&c=3",
        "http://h/p?c=x+y%2A#f",
        "http://h/p?m=Coup%E9&c=3",
        "http://h/p?m=100%2541&c=3",
        "https://h/p#top",
        "https://h/p#top?a=1",
        "Citroen Coupe up!",
        "BMW",
    )


def test_set_then_get_and_clear_twice(values):
    url = lit("http://h/p?a=1&b=2&a=3#x")
    assert values(
        U.get_param(U.set_param(url, "k", lit("a&b=c d")), "k"), U.clear_params(U.clear_params(url)), U.get_param(url, "a")
    ) == ("a&b=c d", "http://h/p#x", "3")


def test_absolute(values):
    base = lit("https://h.x/a/b/c.html?q=1#t")
    cases = {
        "/z": "https://h.x/z",
        "z": "https://h.x/a/b/z",
        "../z?y=../1": "https://h.x/a/z?y=../1",
        "./z": "https://h.x/a/b/z",
        "..": "https://h.x/a/",
        "?p=2": "https://h.x/a/b/c.html?p=2",
        "#k": "https://h.x/a/b/c.html?q=1#k",
        "//o.y/z": "https://o.y/z",
        "http://o.y/z": "http://o.y/z",
    }
    assert values(*[U.absolute(base, lit(h)) for h in cases]) == tuple(cases.values())


def test_extracted_values(values):
    tags = F.array(lit("Klimaautomatik"), lit("Klimaanlage"))
    assert values(
        V.tag_value(tags, V.TAGS["climate_control"]),
        V.tag_value(F.array(lit("Radio")), V.TAGS["climate_control"]),
        V.address(lit("80331 M\N{LATIN SMALL LETTER U WITH DIAERESIS}nchen"))["postal_code"],
        V.address(lit("Muenchen"))["postal_code"],
        V.address(lit("Muenchen"))["country"],
        V.address(lit("80331 Muenchen Ost"))["country"],
        V.engine(lit("2.0 Diesel"))["litres"],
        V.engine(lit("2.0 Diesel"))["fuel"],
        V.engine(lit("12800 Diesel"))["litres"].cast("string"),
        V.engine(lit("1.995"))["litres"].cast("string"),
        V.engine(null())["litres"],
        V.count_text(lit("1.234 Angebote")),
        V.count_text(null()),
        V.flags(F.array(lit("Airbag hinten"), lit("Fahrerairbag")), V.AIRBAGS),
        V.flags(F.array(lit("x")), V.AIRBAGS),
        V.first_nonempty(null(), lit(""), lit("x")),
        V.join_values(", ", lit("Leder"), null(), lit("schwarz")),
        V.refine(lit("12.345.678 x"), V.REFINE["price"]),
    ) == (
        "Klimaanlage",
        None,
        "80331",
        "",
        None,
        "Muenchen Ost",
        Decimal("2.00"),
        "Diesel",
        "12800.000000",
        "1.995000",
        None,
        1234,
        0,
        "Fahrerairbag, hinten",
        None,
        "x",
        "Leder, schwarz",
        "12.345.678",
    )


def test_recent_is_inclusive(values):
    now = "2018-03-09 10:00:00"
    at = lambda s: lit(f"2018-03-09 {s}").cast("timestamp")
    assert values(is_recent(at("09:59:00"), now), is_recent(at("09:58:59"), now), is_recent(at("10:05:00"), now)) == (
        True,
        False,
        True,
    )


def test_stamp(values):
    assert values(X.stamp("2018-03-09")) == (datetime.date(2018, 3, 9),)


def test_script_facets(values):
    page = """<body><script>colors: [1]</script><script type="x">var p = {
      bodyType: { id: 3,
        options: [["1","Coupé, Sport"],["2","Van [7]]"],[3, 'it\\'s'],["4","a\\"b"]], open: [["5","no"]] },
      colors: { id: 4, options: [] }, more: {options: [["6","other"]]} }</script></body>"""
    got = values(V.script_facets(F.lit(page), "bodyType"), V.script_facets(F.lit(page), "none"), V.script_facets(F.lit(None).cast("string"), "bodyType"))
    assert got == (["Coupé, Sport", "Van [7]]", "it's", 'a"b'], [], [])
    assert values(V.script_facets(F.lit("<script>bodyType: {options: [[</script>"), "bodyType"), V.script_facets(F.lit("bodyType: {options: [[1,2]]}"), "bodyType")) == ([], [])
