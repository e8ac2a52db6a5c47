"""Page extraction on hand-written pages of the three layouts."""

import datetime
import time
from decimal import Decimal

from pyspark.sql import functions as F

from lotledger.functions.predicates import REQUIRED_FIELDS
from lotledger.operators import pages as G
from lotledger.operators.catalog import brands, catalog, models
from lotledger.operators.merge import Run
from lotledger.plans import sites
from lotledger.plans.site_run import run_captures
from lotledger.schema import LISTING

EURO = "\N{EURO SIGN}"
NBSP = "\N{NO-BREAK SPACE}"


def frame(spark, *rows, columns="url string, html string, status int"):
    return spark.createDataFrame([tuple(r) for r in rows], columns)


def nodes_of(spark, html):
    df = G.page_nodes(spark.createDataFrame([("u", html)], "url string, html string"))
    return df.first()["nodes"]


def test_elements(spark):
    found = nodes_of(
        spark,
        "<!DOCTYPE html><P class='a  b' ID=x>hi &amp; <b>z</b> ho<br>!<p>two<script>if (a<b) '<p>no</p>'</script>"
        "<ul><li>1<li>2</ul><!-- <p>no</p> --></x>",
    )
    assert [(n["tag"], n["parent"], n["last"], n["nth"], n["texts"]) for n in found] == [
        ("p", -1, 2, 1, ["hi & ", " ho", "!"]),
        ("b", 0, 1, 1, ["z"]),
        ("br", 0, 2, 1, []),
        ("p", -1, 7, 2, ["two"]),
        ("script", 3, 4, 1, ["if (a<b) '<p>no</p>'"]),
        ("ul", 3, 7, 1, []),
        ("li", 5, 6, 1, ["1"]),
        ("li", 5, 7, 2, ["2"]),
    ]
    assert found[0]["classes"] == ["a", "b"] and found[0]["attrs"] == {"class": "a  b", "id": "x"}


def test_no_page(spark):
    assert nodes_of(spark, None) == [] and nodes_of(spark, "just text") == []


def test_flat_patterns(values):
    html = F.lit('<title>T</title><script>var t="<p>no</p>"</script><p>a<b>b</b></p><a class=x href="/l">l</a><!--<p>c</p>-->')
    assert values(G.tag_text(html, "title"), G.tag_text(html, "h1"), G.blocks(html, "p"), G.hrefs(html)) == (
        "T",
        None,
        ["a<b>b</b>"],
        ["/l"],
    )


DETAIL_S = f"""
<html><body><dl><dt>Hubraum</dt><dd>9</dd></dl><main>
<div class='cldt-headline'><div><div><h1>BMW 116 BMW i</h1></div></div></div>
<div class='cldt-stage wide'><div class='cldt-stage-data'>
 <div class='cldt-stage-headline'><div class='cldt-price'><h2>
 {EURO} 12.345,-</h2></div></div>
 <div class='cldt-stage-basic-data-and-highlights'><div class='cldt-stage-basic-data'>
  <div><span>98.765 km</span></div><div><span>03/2015</span><span>2 Vorbesitzer</span></div>
  <div><span>85 kW</span><span>116 PS</span></div></div></div></div></div>
<dl><dt>Karosserieform</dt><dd>Kombi</dd><dt>Hubraum</dt><dd>1.598 cm3</dd><dt>Anzahl Türen</dt><dd> 5 </dd>
<dt>Kraftstoffverbrauch</dt><dd><div>5,4 l/100 km (komb)</div><div>6,8 l/100 km (innerorts)</div><div>4,6 (außerorts)</div></dd>
<dt>HU Prüfung</dt><dd>neu 11/2019</dd><dt>Außenfarbe</dt><dd>Blau</dd></dl>
<div class='cldt-co2-efficiency'><img src='/img/envkvB.svg'></div>
<span>Klimaautomatik</span><span>Einparkhilfe Kamera</span><span>Einparkhilfe</span><span>Kopfairbag</span>
</main></body></html>"""


def test_detail_s(spark):
    url = "https://s.example/d/1?mmvmk0=13&mmvmd0=1639&x=1"
    df = sites.detail_s(frame(spark, (url, DETAIL_S, 200), (url, "<main></main>", 200), (url, None, 410)))
    good, rejects = sites.usable(df, REQUIRED_FIELDS)
    row = good.first().asDict()
    assert {k: v for k, v in row.items() if v is not None} == {
        "status": 200,
        "origin_link": "https://s.example/d/1",
        "make": "13",
        "model": "1639",
        "marketing_headline": "BMW 116 BMW i",
        "sales_price_incl_vat": 12345,
        "currency": EURO,
        "body_type": "Kombi",
        "colour": "Blau",
        "mileage": 98765,
        "cubic_capacity_cm3": 1598,
        "power_in_kw": 85,
        "power_in_ps": 116,
        "number_of_previous_owners": 2,
        "number_of_doors": 5,
        "fuel_consumption_comb": 5.4,
        "fuel_consumption_city": 6.8,
        "fuel_consumption_country": 4.6,
        "energy_efficiency_class": "B",
        "first_registration": "03/2015",
        "service_maintenance": "11/2019",
        "climate_control": "Klimaautomatik",
        "parking_sensors": "Einparkhilfe, kamera",
        "airbags": "Kopfairbag",
    }
    # The empty page is a reject, the gone one neither.
    assert good.count() == 1 and [r["reason"] for r in rejects.collect()] == ["Car will parse again"]


def test_detail_s_odd_pages(spark):
    """Pages of several slices keep their own values, whatever stands between them."""
    odd = [
        "<div class='cldt-headline'><h1>no main</h1></div>",
        f"<main><div title='cldt-price'><h2>{EURO} 1,-</h2></div><div class='x cldt&#45;price'><h2>{EURO} 7,-</h2></div></main>",
        "<main><div class='cldt-headline'></div><div class='cldt-headline'><h1>second</h1></div></main>",
        "<main><dl><dt>Hubraum<dd>1.598 cm3<dt>Hubraum<dd>2<dt>Kraftstoff</dt></dl></main><dl><dt>Kraftstoff</dt><dd>out</dd></dl>",
        "<main><dl><dt>a<b></b>Kraftstoffverbrauch</dt><dd><p><div>1 komb</div></p><div>5,4 &amp; (komb)</div></dd></dl></main>",
        "<main><span>z<i></i>Klimaautomatik</span><i>Kopfairbag</i><script>'<span>Kopfairbag</span>'</script></main>",
        "<main><div class='cldt-stage-basic-data'><p></p><div><b><span>1 km</span></b><span>2 km</span></div><div></div>"
        "<div><i></i><span>85 kW</span><span>116 PS</span></main>",
        None,
        "",
    ]
    expected = [
        {},
        {"sales_price_incl_vat": 7, "currency": EURO},
        {},
        {"cubic_capacity_cm3": 1598},
        {"fuel_consumption_comb": 5.4},
        {"climate_control": "z"},
        {"mileage": 2, "power_in_kw": 85, "power_in_ps": 116},
        {},
        {},
    ]
    good = "<main><div class='cldt-headline'><h1>T {0}</h1></div><dl><dt>Anzahl Türen</dt><dd>{0}</dd></dl><span>Einparkhilfe</span></main>"
    pages = {f"u{i}": odd[i % 11] if i % 11 < len(odd) else good.format(i) for i in range(1210)}
    rows = sites.detail_s(frame(spark, *[(u, html, 200) for u, html in pages.items()]).coalesce(1)).collect()
    assert len(rows) == len(pages)
    for row in rows:
        i = int(row.origin_link[1:])
        want = expected[i % 11] if i % 11 < len(odd) else {
            "marketing_headline": f"T {i}", "number_of_doors": i, "parking_sensors": "Einparkhilfe"
        }
        assert {k: v for k, v in row.asDict().items() if v is not None} == want | {"origin_link": f"u{i}", "status": 200}
    none = sites.detail_s(frame(spark, ("u", None, 200), ("u", "text", 200)))
    assert [(r.origin_link, r.mileage, r.airbags) for r in none.collect()] == [("u", None, None)] * 2


def test_tags_that_never_end_are_read_in_time():
    """A name was given back letter by letter for every such tag, which took minutes."""
    start = time.perf_counter()
    assert [len(G.Elements([text * 1000]).tags) for text in ("<div", "<script", "<p x='")] == [0, 0, 0]
    assert time.perf_counter() - start < 10


def test_shallow_s(spark):
    item = (
        "<div data-item-name='listing-summary-container'><div><div><div>{}</div></div><div></div>"
        "<div><div><span data-item-name='price'>\n" + EURO + " {},-</span></div></div></div></div>"
    )
    link = "<a data-item-name='detail-page-link' href='/d/{}'>x</a>"
    html = item.format(link.format(1), "9.990") + item.format("", "1") + item.format(link.format(2), "VB")
    rows = sites.shallow_s(frame(spark, ("https://s.example/list", html, 200)), "https://s.example").collect()
    assert [(r.origin_link, r.old_url, r.sales_price_incl_vat) for r in rows] == [
        ("https://s.example/d/1", "https://s.example/list", 9990),
        ("https://s.example/d/2", "https://s.example/list", None),
    ]


def test_shallow_s_facts(spark):
    """Places of facts, a placeholder, an empty entry, a list that stands elsewhere, a part too few."""
    facts = "<ul><li>\n12.500 km\n</li><li>EZ 03/2016</li><li>85 kW (116 PS)</li><li>Gebraucht</li><li>2 Halter</li><li> </li><li>Diesel</li><li data-placeholder>- (l/100 km)</li><li>119 g</li></ul>"
    item = "<div data-item-name='listing-summary-container'><div><div><div><a data-item-name='detail-page-link' href='/d/{}'>x</a></div></div>{}</div></div>"
    head = "<div><h2 class='a cldt-summary-version b'> Top Auto\n</h2><ul><li>1 km</li></ul></div>"
    price = "<div><span data-item-name='price'>\n" + EURO + " 9.990,-</span></div>"
    full = item.format(1, head + f"<div>{price}<div>{facts}</div></div>")
    short = item.format(2, head + price)
    rows = sites.shallow_s(frame(spark, ("https://s.example/list", full + short, 200)), "https://s.example").collect()
    one, two = ({k: v for k, v in r.asDict().items() if v is not None} for r in rows)
    links = lambda n: {"origin_link": f"https://s.example/d/{n}", "new_url": f"https://s.example/d/{n}", "old_url": "https://s.example/list"}
    common = {"marketing_headline": "Top Auto", "sales_price_incl_vat": 9990, "currency": EURO}
    assert one == {
        **links(1), **common, "mileage": 12500, "first_registration": "03/2016", "power_in_kw": 85, "power_in_ps": 116,
        "number_of_previous_owners": 2, "fuel": "Diesel", "co2_emission": 119,
    }
    assert two == {**links(2), **common}


DETAIL_U = """
<html><head><meta itemprop='datePublished' content='2018-03-09'></head><body><div class='car-list-item'>
<div class='car-details-wrapper'><h3 class='car-title'><span><b>Alfa Romeo</b> <span>Alfa Romeo Giulia Veloce</span></span></h3>
<div class='pricing'><span class='price' content='12345'> EUR VB </span></div>
<ul><li class='year'><span>2015</span></li><li class='km'><span> 98.765 km</span></li><li class='engine'><span>2.0 Diesel</span></li>
<li class='fuel_efficiency'><span>ca. <span>5,4 l</span></span></li><li class='co2_emission'><span>119 g/km</span></li>
<li class='co2_class'><span>A</span></li><li class='hp'><span>150 PS</span></li>
<li class='euro_emission_class'><dfn>Euro</dfn><span>6</span></li></ul></div></div>
<section class='equipment'><ul class='equipment_pills'><li><span>Klimaautomatik</span></li><li><span>Klimaanlage</span></li>
<li><span>Automatik</span></li></ul></section>
<section class='contact-information'><ul><li><span>Tel</span><span class='value'>1</span></li>
<li><span>PLZ / Stadt:</span><span class='value'>80331 Bad Tal</span></li></ul></section></body></html>"""


def test_detail_u(spark):
    pages = spark.createDataFrame([("https://u.example/d/1", DETAIL_U, "Giulia")], "url string, html string, model string")
    row = sites.detail_u(pages).first().asDict()
    assert {k: v for k, v in row.items() if v is not None} == {
        "origin_link": "https://u.example/d/1",
        "make": "Alfa Romeo",
        "model": "Giulia",
        "marketing_headline": "Veloce",
        "sales_price_incl_vat": 12345,
        "currency": "EUR",
        "first_registration": "2015",
        "mileage": 98765,
        "cubic_capacity_l": Decimal("2.00"),
        "fuel": "Diesel",
        "fuel_consumption_comb": 5.4,
        "co2_emission": 119,
        "energy_efficiency_class": "A",
        "power_in_ps": 150,
        "emission_class": "Euro 6",
        "climate_control": "Klimaanlage",
        "gearbox": "Automatik",
        "postal_code": "80331",
        "country": "Bad Tal",
        "published_date": datetime.date(2018, 3, 9),
    }


def test_shallow_u(spark):
    item = (
        "<div class='listing-item'><div class='listing-item-container'><div><div class='x car-details-headline-wrapper'>"
        "<h3><a href='/d/{}'>t</a></h3></div></div><div class='price-container'><span class='price' content='{}'>p</span></div></div></div>"
    )
    url = "https://u.example/?s%5Bbrand%5D=VW&s%5Bcar_model%5D=up%21&s%5Bbody_types%5D%5B%5D=Coup%E9&s%5Bcolors%5D%5B%5D=Rot"
    rows = sites.shallow_u(frame(spark, (url, item.format(1, 500) + item.format(2, ""), 200)), "https://u.example").collect()
    assert [tuple(r) for r in rows] == [
        ("https://u.example/d/1", "up!", "Rot", "Coupe", 500),
        ("https://u.example/d/2", "up!", "Rot", "Coupe", None),
    ]


DETAIL_A = f"""
<dl><dt data-content='brand'>Marke</dt><dd> VW </dd><dt data-content='model'>Modell</dt><dd>Golf</dd>
<dt data-content='cubicCapacity'>Hubraum</dt><dd>1.598 cm3</dd>
<dt data-content='consumption'>V</dt><dd>kombiniert: 5,4 l innerorts: 6,8 l ausserorts: 4,6 l</dd>
<dt data-content='co2'>C</dt><dd>ca. 119 g</dd><dt data-content='doorCount'>T</dt><dd>4/5</dd>
<dt data-content='exteriorColor'>F</dt><dd>dunkel blau, hell-grau</dd>
<dt data-content='intType'>I</dt><dd>leder</dd><dt data-content='intColor'>I</dt><dd> Andere </dd></dl>
<span class='priceBig'>1.234.567 {EURO}</span><table><tr><td class='priceInfo'>Netto 10.374 {EURO}</td>
<td data-content='mileage'>98.765 km</td><td data-content='power'>85 kW (116 PS)</td><td data-content='gearbox'>Schaltung 6</td>
<td data-content='registrationDate'>EZ 03/2015</td><td data-content='huDate'>HU neu</td></tr></table>
<span data-content='hasAirConAutomatic'>Klimaautomatik</span><span class='contentSprite coClass'>B</span>
<div class='x dealerContactBox'><div class='contentBox defaultBox contentGreyDark'><table></table>
<p>Weg 1<br> 80331 Bad Tal </p></div></div>"""


def test_detail_a(spark):
    row = sites.detail_a(frame(spark, ("https://a.example/d/1", DETAIL_A, 200))).first().asDict()
    assert {k: v for k, v in row.items() if v is not None} == {
        "status": 200,
        "origin_link": "https://a.example/d/1",
        "make": "VW",
        "model": "Golf",
        "sales_price_incl_vat": 1234567,
        "sales_price_excl_vat": 10374,
        "currency": EURO,
        "mileage": 98765,
        "cubic_capacity_cm3": 1598,
        "power_in_kw": 85,
        "power_in_ps": 116,
        "fuel_consumption_comb": 5.4,
        "fuel_consumption_city": 6.8,
        "fuel_consumption_country": 4.6,
        "co2_emission": 119,
        "number_of_doors": 4,
        "energy_efficiency_class": "B",
        "gearbox": "Schaltung",
        "first_registration": "03/2015",
        "service_maintenance": "neu",
        "climate_control": "Klimaautomatik",
        "colour": "Dunkel blau, Hell-grau",
        "interior": "Leder",
        "postal_code": "80331",
        "country": "Bad Tal",
    }


def test_shallow_a_and_next(spark, values):
    html = (
        "<ul class='vehicleOffers vehicleList'><li class='offers size1of1 contentDesc'><a class='vehicleOffersBox' href='/d/1'>x</a>"
        "<span class='priceBig'> 1.234 E</span></li></ul><div class='pagNext'><a href=\"/p2\" class=\"icon-right-dir\">w</a></div>"
    )
    rows = sites.shallow_a(frame(spark, ("u", html, 200)), "https://a.example").collect()
    assert [tuple(r) for r in rows] == [("https://a.example/d/1", 1234)]
    assert values(sites.next_page_a(F.lit(html)), sites.next_page_a(F.lit("<a href='x'>"))) == ("/p2", None)


def test_catalog(spark):
    item = '<item key="{}" value="{}"></item>'
    page = "".join(
        item.format(k, v)
        for k, v in [("1", "Golf"), ("2", NBSP * 2 + "Golf I"), ("3", NBSP * 2 + "Golf II"), ("4", "Polo")]
    )
    pages = spark.createDataFrame([("74", page)], "brand string, html string")
    rows = models(pages, F.col("brand")).orderBy("pos").collect()
    assert [(r.brand_key, r.key, r.value) for r in rows] == [("74", "2", "Golf I"), ("74", "3", "Golf II"), ("74", "4", "Polo")]
    first_is_sub = pages.select("brand", F.lit(item.format("9", NBSP * 2 + "Sub")).alias("html"))
    assert [r.value for r in models(first_is_sub, F.col("brand")).collect()] == ["Sub"]
    bucket = pages.select(F.lit(item.format("1", "BMW") + item.format("2", "Sonstige Marken")).alias("html"))
    assert [tuple(r) for r in brands(bucket).collect()] == [("1", "BMW")]
    script = 'x brandsAndModels: {"Hummer":[["H3 Alpha","H3 Alpha"],["H3T","H3T"]],"VW":[["up","up!"]]},\n y'
    rows = catalog(spark.createDataFrame([(1, script)], "page_id int, html string")).collect()
    assert sorted((r.brand, r.model) for r in rows) == [("Hummer", "H3+Alpha"), ("Hummer", "H3T"), ("VW", "up!")]


# Whole runs from captures


def empty_table(spark):
    return spark.createDataFrame([], LISTING)


def result_pages(spark, *pages):
    return spark.createDataFrame([(i, url, html) for i, (url, html) in enumerate(pages)], "page_id int, url string, html string")


def test_run_captures_s(spark):
    link = "<a data-item-name='detail-page-link' href='/d/{}'>x</a>"
    item = "<div data-item-name='listing-summary-container'>" + link + "<span data-item-name='price'>E {}</span></div>"
    results = result_pages(
        spark, ("https://s.example/list?p=1", item.format(1, "9.990") + item.format(2, "5")), ("https://s.example/list?p=2", item.format(1, "1"))
    )
    url = "https://s.example/d/{}?mmvmk0=13&mmvmd0=1639"
    details = frame(spark, (url.format(1), DETAIL_S, 200), (url.format(2), "<main></main>", 200))
    catalogs = (
        spark.createDataFrame([("13", "BMW")], "key string, value string"),
        spark.createDataFrame([("13", "1639", "116")], "brand_key string, key string, value string"),
    )
    run = Run("S", 1, "2018-03-09")
    out = run_captures("S", results, details, empty_table(spark), run, "https://s.example", catalogs=catalogs)
    row = out.table.first()
    assert out.table.count() == 1 and row.origin_link == "https://s.example/d/1" and row.site == "S"
    assert (row.make, row.model, row.marketing_headline, row.iteration_id) == ("BMW", "116", "BMW i", 1)
    assert [tuple(r) for r in out.rejects.collect()] == [("https://s.example/d/2", "Car will parse again")]
    assert out.control.first().bad_fields == []
    again = run_captures("S", results, details, out.table, Run("S", 2, "2018-03-10"), "https://s.example", catalogs=catalogs)
    assert again.outcomes.where("NOT seen").count() == 1
    row = again.table.first()
    assert (row.iteration_id, row.sales_price_incl_vat, str(row.parse_date)) == (2, 12345, "2018-03-10")


def test_run_captures_u_and_a(spark):
    item = (
        "<div class='listing-item-container'><div class='car-details-headline-wrapper'><h3><a href='/d/1'>t</a></h3></div>"
        "<div class='price-container'><span class='price' content='500'>p</span></div></div>"
    )
    url = "https://u.example/?s%5Bbrand%5D=Alfa&s%5Bcar_model%5D=Giulia&s%5Bbody_types%5D%5B%5D=Van&s%5Bcolors%5D%5B%5D=Rot"
    details = frame(spark, ("https://u.example/d/1", DETAIL_U, 200))
    run = Run("U", 1, "2018-03-09")
    row = run_captures("U", result_pages(spark, (url, item)), details, empty_table(spark), run, "https://u.example").table.first()
    assert (row.model, row.marketing_headline, row.colour, row.body_type) == ("Giulia", "Veloce", "Rot", "Van")
    item = "<li class='offers size1of1 contentDesc'><a class='vehicleOffersBox' href='/d/1'>x</a><span class='priceBig'>5 E</span></li>"
    details = frame(spark, ("https://a.example/d/1", DETAIL_A, 200))
    run = Run("A", 1, "2018-03-09")
    row = run_captures("A", result_pages(spark, ("u", item)), details, empty_table(spark), run, "https://a.example").table.first()
    assert (row.make, row.sales_price_incl_vat, row.interior, row.is_synced) == ("VW", 1234567, "Leder", 0)
