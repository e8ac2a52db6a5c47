"""Proofs of scans, sinks, page extraction, catalog and chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lotledger.functions import values as V
from lotledger.functions.predicates import has_errors, in_state, is_error
from lotledger.operators import catalog as C
from lotledger.operators import pages as G
from lotledger.operators.chain import walk_chain
from lotledger.operators.dedupe import dedupe_url
from lotledger.operators.joins import job_logs
from lotledger.plans import sites
from lotledger.plans.proofs_text import EURO, NBSP
from lotledger.plans.registry import dotted, query, read, text, whole
from lotledger.session import scratch_dir, spread
from lotledger.sources import readers, writers

# The SQL side's reading of a page: scripts, styles and comments out, then flat patterns.
_SQL_VISIBLE = "regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'g')"
_SQL_WORDS = "regexp_extract_all(html, '<li><a href=\"[^\"]*\">([^<]*)</a></li>', 1)"


def _nav_words() -> Column:
    return F.regexp_extract_all("html", F.lit(r'<li><a href="[^"]*">([^<]*)</a></li>'), F.lit(1))


def _plain(words: Column) -> Column:
    """Words without the characters that stand for structure in a script array."""
    return F.transform(words, lambda w: F.translate(w, ',"\\[]{}', ""))


@query("s1_captures", "SELECT page_id, url, length(html) AS n_chars, 1 AS no_status FROM pages")
def s1_captures(spark: SparkSession, sf: str) -> DataFrame:
    pages = readers.captures(spark, f"{sf.rstrip('/')}/pages.parquet")
    return pages.select("page_id", "url", F.length("html").cast("bigint").alias("n_chars"), F.isnull("status").cast("int").alias("no_status"))


@query(
    "s4_catalog",
    f"""
    WITH w AS (SELECT page_id, regexp_extract(url, '//([^/?#]*)', 1) AS brand, unnest({_SQL_WORDS}) AS word FROM pages)
    SELECT page_id, brand, replace(translate(word, ',"\\[]{{}}', ''), ' ', '+') AS model FROM w
    """,
)
def s4_catalog(spark: SparkSession, sf: str) -> DataFrame:
    pair = F.transform(_plain(_nav_words()), lambda w: F.concat(F.lit('["'), w, F.lit('","'), w, F.lit('"]')))
    host = F.regexp_extract("url", "//([^/?#]*)", 1)
    script = text('<script>brandAndModel: {\n brandsAndModels: {"', host, '":[', F.array_join(pair, ","), "]},\n</script>")
    return C.catalog(read(spark, sf, "pages").select("page_id", script.alias("html")))


@query(
    "s4_catalog_elements",
    f"""
    WITH w AS (SELECT page_id, unnest({_SQL_WORDS}) AS word, generate_subscripts({_SQL_WORDS}, 1) AS i FROM pages)
    SELECT 'b' || page_id AS brand_key, 'k' || i AS key, word AS value FROM w
    """,
)
def s4_catalog_elements(spark: SparkSession, sf: str) -> DataFrame:
    item = F.transform(
        _nav_words(), lambda w, i: F.concat(F.lit('<item key="k'), (i + 1).cast("string"), F.lit('" value="'), w, F.lit('"></item>'))
    )
    pages = read(spark, sf, "pages").select("page_id", F.array_join(item, "\n").alias("html"))
    return C.models(pages, text("b", F.col("page_id"))).select("brand_key", "key", "value")


@query(
    "s5_facets",
    f"""
    WITH w AS (SELECT page_id, unnest({_SQL_WORDS}) AS word, generate_subscripts({_SQL_WORDS}, 1) AS i FROM pages)
    SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, translate(word, ',"\\[]{{}}', '') AS label FROM w
    """,
)
def s5_facets(spark: SparkSession, sf: str) -> DataFrame:
    pair = F.transform(_plain(_nav_words()), lambda w: F.concat(F.lit('"x","'), w, F.lit('"')))
    labels = V.facets(F.array_join(pair, "],["))
    return read(spark, sf, "pages").where(F.size(_nav_words()) > 0).select("page_id", F.posexplode(labels).alias("pos", "label"))


@query(
    "s5_script_facets",
    f"""
    WITH w AS (SELECT page_id, unnest({_SQL_WORDS}) AS word, generate_subscripts({_SQL_WORDS}, 1) AS i FROM pages)
    SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, word || ', "[' || CAST(i AS VARCHAR) || ']],[ ' || word AS label FROM w
    """,
)
def s5_script_facets(spark: SparkSession, sf: str) -> DataFrame:
    """Labels with quotes, commas and brackets, cut from the script of a page that has another list before and after."""
    label = lambda w, i: F.concat(w, F.lit(', "['), (i + 1).cast("string"), F.lit("]],[ "), w)
    pairs = F.transform(_nav_words(), lambda w, i: F.array(i.cast("string"), label(w, i)))
    other = F.lit('x: {\n options: [["9","none"]], more: 1},\n')
    script = F.concat(F.lit("<body><script>var a = [1];</script><script>\n"), other, F.lit("bodyType: { kind: 1,\n  options: "), F.to_json(pairs), F.lit(", open: [[2]]},\n"), F.replace(other, F.lit("x:"), F.lit("y:")), F.lit("</script></body>"))
    pages = read(spark, sf, "pages").where(F.size(_nav_words()) > 0)
    return pages.select("page_id", F.posexplode(V.script_facets(script, "bodyType")).alias("pos", "label"))


@query(
    "s6_logs",
    """
    SELECT CAST(user_id AS VARCHAR) AS job_id, CASE WHEN event_type = 'error' THEN 40 ELSE 20 END AS level,
           epoch_us(ts) // 1000 AS time, props AS message
    FROM events
    """,
)
def s6_logs(spark: SparkSession, sf: str) -> DataFrame:
    return _logs(spark, sf)


def _logs(spark: SparkSession, sf: str) -> DataFrame:
    logs = read(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("job_id"),
        F.when(F.col("event_type") == "error", 40).otherwise(20).alias("level"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("time"),
        F.col("props").alias("message"),
    )
    path = scratch_dir(spark, "logs")
    writers.export_json(logs, path)
    return readers.read_logs(spark, path)


@query(
    "s6_job_errors",
    """
    WITH counts AS (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1),
    jobs AS (SELECT c_custkey AS id, CASE WHEN c_nationkey < 12 THEN 'running' ELSE 'finished' END AS state, n
             FROM customer LEFT JOIN counts ON user_id = c_custkey)
    SELECT CAST(id AS VARCHAR) AS job_id, n AS errors_count, epoch_us(ts) // 1000 AS time, props AS message
    FROM jobs JOIN events ON user_id = id WHERE state = 'running' AND n <> 0 AND event_type = 'error'
    """,
)
def s6_job_errors(spark: SparkSession, sf: str) -> DataFrame:
    """The error logs of running jobs that count errors, from job and log files."""
    errors = read(spark, sf, "events").where("event_type = 'error'").groupBy("user_id").agg(F.count("*").alias("errors_count"))
    customers = read(spark, sf, "customer")
    jobs = customers.join(errors, customers["c_custkey"] == errors["user_id"], "left").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.when(F.col("c_nationkey") < 12, "running").otherwise("finished").alias("state"),
        "errors_count",
    )
    path = scratch_dir(spark, "jobs")
    writers.export_json(jobs, path)
    wanted = readers.read_jobs(spark, path).where(in_state(F.col("state"), "running") & has_errors(F.col("errors_count")))
    logs = _logs(spark, sf).where(is_error(F.col("level")))
    return job_logs(wanted.select(F.col("id").alias("job_id"), "errors_count"), logs).select("job_id", "errors_count", "time", "message")


def _listings(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").select(
        text("/o/", F.col("o_orderkey")).alias("origin_link"),
        whole("o_totalprice").alias("sales_price_incl_vat"),
        F.col("o_orderpriority").alias("body_type"),
        F.col("o_orderdate").cast("date").alias("parse_date"),
        F.col("o_orderstatus").alias("site"),
    )


_SQL_LISTINGS = """
    SELECT '/o/' || o_orderkey AS origin_link, CAST(floor(o_totalprice) AS BIGINT) AS sales_price_incl_vat,
           o_orderpriority AS body_type, strftime(o_orderdate, '{}') AS parse_date, o_orderstatus AS site
    FROM orders
"""


@query("k1_append_roundtrip", _SQL_LISTINGS.format("%Y-%m-%d"))
def k1_append_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    rows = _listings(spark, sf)
    path = scratch_dir(spark, "append")
    writers.append(rows.where("site = 'F'").drop("site"), path, site="F")
    writers.append(rows.where("site <> 'F'"), path)
    return spark.read.schema(rows.schema).parquet(path).withColumn("parse_date", F.date_format("parse_date", "yyyy-MM-dd"))


def _roundtrip(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    rows = _listings(spark, sf)
    path = scratch_dir(spark, kind)
    writers.export(rows, path, kind)
    reader = spark.read.schema("origin_link string, sales_price_incl_vat bigint, body_type string, parse_date string, site string")
    if kind == "xml":
        reader = reader.option("rowTag", "item")
    return reader.format(kind).load(path)


@query("k2_json_roundtrip", _SQL_LISTINGS.format("%d-%m-%Y"))
def k2_json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return _roundtrip(spark, sf, "json")


@query("k3_xml_roundtrip", _SQL_LISTINGS.format("%d-%m-%Y"))
def k3_xml_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return _roundtrip(spark, sf, "xml")


@query(
    "e1_page_rows",
    f"""
    WITH l AS (SELECT page_id, regexp_extract_all({_SQL_VISIBLE}, '<li><a href="([^"]*)"', 1) AS h FROM pages)
    SELECT page_id, replace(link, '&amp;', '&') AS link FROM (SELECT page_id, unnest(h) AS link FROM l)
    """,
)
def e1_page_rows(spark: SparkSession, sf: str) -> DataFrame:
    nodes = G.page_nodes(read(spark, sf, "pages").select("page_id", "html"))
    rows = G.page_rows(
        nodes, lambda n: n["tag"] == "li", lambda item: G.first_attr(item, lambda n: n["tag"] == "a", "href")
    )
    return rows.select("page_id", "link")


@query(
    "e1_blocks",
    f"""
    WITH b AS (SELECT page_id, regexp_extract_all({_SQL_VISIBLE}, '(?s)<p>(.*?)</p>', 1) AS x FROM pages)
    SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, md5(block) AS block
    FROM (SELECT page_id, unnest(x) AS block, generate_subscripts(x, 1) AS i FROM b)
    """,
)
def e1_blocks(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "pages").select("page_id", F.posexplode(G.blocks(F.col("html"), "p")).alias("pos", "block"))
    return rows.select("page_id", "pos", F.md5("block").alias("block"))


@query(
    "e2_title_h1",
    """
    SELECT page_id, nullif(regexp_extract(html, '<title>([^<]*)', 1), '') AS title,
           nullif(regexp_extract(html, '<h1>([^<]*)', 1), '') AS h1
    FROM pages
    """,
)
def e2_title_h1(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "pages").select(
        "page_id", G.tag_text(F.col("html"), "title").alias("title"), G.tag_text(F.col("html"), "h1").alias("h1")
    )


def _definition_list(spark: SparkSession, sf: str) -> DataFrame:
    html = text(
        "<main><dl><dt>Hubraum</dt><!-- <dd>no</dd> --><dd>",
        whole("o_totalprice"),
        "</dd><dt>Kraftstoff<dd>",
        F.col("o_orderpriority"),
        " &amp; Gas<dt>Hubraum</dt><dd>second</dd></dl><script>var t='<dt>Farbe</dt><dd>no</dd>';</script></main>",
    )
    return spread(read(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")).select(
        "o_orderkey", html.alias("html")
    )


@query(
    "e2_label_map",
    """
    SELECT o_orderkey, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS cubic_capacity,
           o_orderpriority || ' & Gas' AS fuel, CAST(NULL AS VARCHAR) AS colour
    FROM orders
    """,
)
def e2_label_map(spark: SparkSession, sf: str) -> DataFrame:
    labels = G.label_map(G.page_nodes(_definition_list(spark, sf)))
    return labels.select(
        "o_orderkey",
        F.col("labels")["Hubraum"].alias("cubic_capacity"),
        F.col("labels")["Kraftstoff"].alias("fuel"),
        F.col("labels")["Farbe"].alias("colour"),
    )


@query(
    "e3_spec_select",
    """
    SELECT page_id, trim(replace(regexp_extract(html, '<title>([^<]*)', 1), '&amp;', '&')) AS title,
           trim(replace(regexp_extract(html, '<h1>([^<]*)', 1), '&amp;', '&')) AS heading,
           nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS lang,
           nullif(regexp_extract(html, '<meta charset="([^"]*)"', 1), '') AS charset, CAST(NULL AS VARCHAR) AS absent
    FROM pages
    """,
)
def e3_spec_select(spark: SparkSession, sf: str) -> DataFrame:
    spec = {
        "title": lambda nodes: G.first_text(nodes, lambda n: n["tag"] == "title"),
        "heading": lambda nodes: G.first_text(G.subtree(nodes, lambda n: n["tag"] == "article"), lambda n: n["tag"] == "h1"),
        "lang": lambda nodes: G.first_attr(nodes, lambda n: n["tag"] == "html", "lang"),
        "charset": lambda nodes: G.first_attr(nodes, lambda n: n["tag"] == "meta", "charset"),
        "absent": lambda nodes: G.first_text(nodes, lambda n: n["tag"] == "dt"),
    }
    return G.spec_select(G.page_nodes(read(spark, sf, "pages").select("page_id", "html")), "nodes", spec)


@query(
    "e3_detail_record",
    """
    SELECT 'https://lots.example/d/' || o_orderkey AS origin_link, 'BMW' AS make, '116' AS model, 'i Kombi' AS marketing_headline,
           CAST(floor(o_totalprice) AS BIGINT) AS sales_price_incl_vat, '\N{EURO SIGN}' AS currency, o_custkey AS mileage,
           strftime(o_orderdate, '%m/%Y') AS first_registration, CAST(66 AS BIGINT) AS power_in_kw, o_custkey + 1 AS power_in_ps,
           CAST(1998 AS BIGINT) AS cubic_capacity_cm3, CAST(5.4 AS DOUBLE) AS fuel_consumption_comb, o_orderpriority AS fuel,
           'B' AS energy_efficiency_class, 'Einparkhilfe, vorne' AS parking_sensors, 'Klimaautomatik' AS climate_control
    FROM orders
    """,
)
def e3_detail_record(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    html = text(
        "<html><body><main><div class='cldt-headline'><div><div><h1> BMW 116 i Kombi\n</h1></div></div></div>"
        "<div class='cldt-stage x'><div class='cldt-stage-data'><div class='cldt-stage-headline'><div class='cldt-price'><h2>\n"
        + EURO
        + " ",
        dotted(whole("o_totalprice")),
        ",-</h2></div></div><div class='cldt-stage-basic-data-and-highlights'><div class='cldt-stage-basic-data'>"
        "<div><span>",
        dotted(F.col("o_custkey")),
        " km</span></div><div><span>EZ ",
        F.date_format("o_orderdate", "MM/yyyy"),
        "</span><span>2 Halter</span></div><div><span>66 kW</span><span>",
        F.col("o_custkey") + 1,
        " PS</span></div></div></div></div></div><dl><dt>Hubraum</dt><dd>1.998 cm3</dd><dt>Kraftstoff</dt><dd>",
        F.col("o_orderpriority"),
        "</dd><dt>Kraftstoffverbrauch</dt><dd><div>6,1 l/100 km (innerorts)</div><div>5,4 l/100 km (komb)</div></dd></dl>"
        "<div class='cldt-co2-efficiency'><a><img src='/img/envkvB.svg'></a></div><span>Klimaautomatik</span>"
        "<span>Einparkhilfe Sensoren vorne</span><span>Einparkhilfe</span></main></body></html>",
    )
    url = text("https://lots.example/d/", key, "?mmvmk0=BMW&mmvmd0=116")
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    pages = spread(orders).select(url.alias("url"), html.alias("html"))
    return sites.detail_s(pages).select(
        "origin_link",
        "make",
        "model",
        "marketing_headline",
        "sales_price_incl_vat",
        "currency",
        "mileage",
        "first_registration",
        "power_in_kw",
        "power_in_ps",
        "cubic_capacity_cm3",
        "fuel_consumption_comb",
        "fuel",
        "energy_efficiency_class",
        "parking_sensors",
        "climate_control",
    )


@query(
    "e3_shallow_record",
    """
    SELECT 'https://lots.example/d/' || o_orderkey AS origin_link, 'https://lots.example/list?c=' || o_custkey AS old_url,
           o_orderpriority || ' Kombi' AS marketing_headline, CAST(floor(o_totalprice) AS BIGINT) AS sales_price_incl_vat,
           '\N{EURO SIGN}' AS currency, CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS mileage,
           CAST(66 AS BIGINT) AS power_in_kw, o_custkey + 1 AS power_in_ps,
           CASE WHEN o_orderstatus = 'O' THEN 'Diesel' ELSE 'Benzin' END AS fuel, CAST(5.4 AS DOUBLE) AS fuel_consumption_comb,
           CAST(119 AS BIGINT) AS co2_emission, CAST(NULL AS VARCHAR) AS gearbox,
           strftime(o_orderdate, '%m/%Y') AS first_registration, CAST(day(o_orderdate) AS BIGINT) AS number_of_previous_owners
    FROM orders
    """,
)
def e3_shallow_record(spark: SparkSession, sf: str) -> DataFrame:
    """Result pages of many items (a customer's orders), each with all facts, a placeholder and an empty one; every page has an item without a link."""
    mileage = F.when(F.col("o_orderstatus") == "F", "<li data-placeholder='x'>- km</li>").otherwise(
        text("<li>\n", dotted(F.col("o_custkey")), " km</li>")
    )
    shell = "<div data-item-name='listing-summary-container'><div><div><div>{}</div></div>{}</div></div>"
    before, after = shell.format("<a data-item-name='detail-page-link' href='/d/{}'>x</a>", "{}").split("{}", 1)
    link_end, item_end = after.split("{}", 1)
    item = text(
        before,
        F.col("o_orderkey"),
        link_end + "<div><h2 class='sc cldt-summary-version'>\n",
        F.col("o_orderpriority"),
        " Kombi</h2></div><div><div><span data-item-name='price'>\n" + EURO + " ",
        dotted(whole("o_totalprice")),
        ",-</span></div><div><ul>",
        mileage,
        "<li>EZ ",
        F.date_format("o_orderdate", "MM/yyyy"),
        "</li><li>66 kW (",
        F.col("o_custkey") + 1,
        " PS)</li><li>Gebraucht</li><li>",
        F.dayofmonth("o_orderdate"),
        " Fahrzeughalter</li><li>\n</li><li> ",
        F.when(F.col("o_orderstatus") == "O", "Diesel").otherwise("Benzin"),
        "</li><li>5,4 l/100 km (komb)</li><li>119 g CO2/km</li></ul></div></div>" + item_end,
    )
    columns = ["o_custkey", "o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus", "o_orderdate"]
    # The narrow rows are dealt by page; the text is built where the page is read.
    orders = spread(read(spark, sf, "orders").select(*columns), "o_custkey").select("o_custkey", item.alias("item"))
    pages = orders.groupBy("o_custkey").agg(F.array_join(F.collect_list("item"), "").alias("items"))
    url = text("https://lots.example/list?c=", F.col("o_custkey"))
    html = text("<html><body><main>", F.col("items"), shell.format("", "<div></div>"), "</main></body></html>")
    return sites.shallow_s(pages.select(url.alias("url"), html.alias("html")), "https://lots.example").drop("new_url")


@query(
    "e5_links",
    f"""
    WITH l AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*') AS origin,
                      regexp_extract_all({_SQL_VISIBLE}, '<a href="([^"]*)"', 1) AS h FROM pages)
    SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, origin || href AS link
    FROM (SELECT page_id, origin, unnest(h) AS href, generate_subscripts(h, 1) AS i FROM l)
    """,
)
def e5_links(spark: SparkSession, sf: str) -> DataFrame:
    return G.links(read(spark, sf, "pages"))


@query(
    "e6_chain",
    """
    WITH RECURSIVE walk(url) AS (
        SELECT o_orderkey FROM orders WHERE o_orderpriority = '2-HIGH'
        UNION
        SELECT o.o_custkey FROM walk w JOIN orders o ON o.o_orderkey = w.url WHERE o.o_orderstatus <> 'F'
    )
    SELECT url FROM walk
    """,
)
def e6_chain(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders")
    pages = orders.select(
        F.col("o_orderkey").alias("url"), F.when(F.col("o_orderstatus") != "F", F.col("o_custkey")).alias("next_url")
    )
    seeds = orders.where("o_orderpriority = '2-HIGH'").select(F.col("o_orderkey").alias("url"))
    return walk_chain(pages, seeds).select("url")


@query(
    "e6_chain_deep",
    """
    WITH RECURSIVE links AS (SELECT event_id AS src, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS dst FROM events),
    walk(url, step) AS (
        SELECT min(event_id), CAST(0 AS BIGINT) FROM events WHERE user_id % 3 = 0 GROUP BY user_id
        UNION ALL
        SELECT dst, step + 1 FROM walk JOIN links ON src = url WHERE dst IS NOT NULL
    )
    SELECT url, step FROM walk
    """,
)
def e6_chain_deep(spark: SparkSession, sf: str) -> DataFrame:
    """Every event points at the user's next one; the walk starts at the first event of each third user."""
    events = read(spark, sf, "events").select("event_id", "user_id")
    ahead = F.lead("event_id").over(Window.partitionBy("user_id").orderBy("event_id"))
    pages = events.select(F.col("event_id").alias("url"), ahead.alias("next_url"))
    seeds = events.where("user_id % 3 = 0").groupBy("user_id").agg(F.min("event_id").alias("url"))
    return walk_chain(pages, seeds)


@query(
    "e8_flags",
    f"""
    WITH w AS (SELECT page_id, {_SQL_WORDS} AS w FROM pages)
    SELECT page_id, nullif(concat_ws(', ', CASE WHEN list_contains(w, 'The') THEN 'en' END,
        CASE WHEN list_contains(w, 'and') THEN 'en2' END, CASE WHEN list_contains(w, 'la') THEN 'fr' END,
        CASE WHEN list_contains(w, 'de') THEN 'es' END, CASE WHEN list_contains(w, 'der') THEN 'de' END), '') AS flags
    FROM w
    """,
)
def e8_flags(spark: SparkSession, sf: str) -> DataFrame:
    vocab = {"en": "The", "en2": "and", "fr": "la", "es": "de", "de": "der"}
    return read(spark, sf, "pages").select("page_id", V.flags(_nav_words(), vocab).alias("flags"))


@query(
    "w1_lead",
    """
    WITH m AS (SELECT p_partkey // 50 AS brand_key, p_partkey % 50 AS pos, p_type = 'SMALL' AS sub, p_name FROM part),
         n AS (SELECT *, lead(sub) OVER (PARTITION BY brand_key ORDER BY pos) AS next_sub FROM m)
    SELECT brand_key, pos, p_name AS value FROM n WHERE sub OR NOT coalesce(next_sub, false)
    """,
)
def w1_lead(spark: SparkSession, sf: str) -> DataFrame:
    name = text(F.when(F.col("p_type") == "SMALL", NBSP + NBSP).otherwise(""), F.col("p_name"))
    models = read(spark, sf, "part").select(
        F.expr("p_partkey div 50").alias("brand_key"), (F.col("p_partkey") % 50).alias("pos"), name.alias("value")
    )
    return C.drop_parents(models).select("brand_key", "pos", "value")


@query(
    "w1_page_models",
    f"""
    WITH w AS (SELECT page_id, unnest({_SQL_WORDS}) AS word, generate_subscripts({_SQL_WORDS}, 1) AS i FROM pages),
         n AS (SELECT *, length(word) <= 4 AS sub,
                      lead(length(word) <= 4) OVER (PARTITION BY page_id ORDER BY i) AS next_sub FROM w)
    SELECT page_id, 'k' || i AS key, word AS value FROM n WHERE sub OR NOT coalesce(next_sub, false)
    """,
)
def w1_page_models(spark: SparkSession, sf: str) -> DataFrame:
    item = F.transform(
        _nav_words(),
        lambda w, i: F.struct(
            F.concat(F.lit("k"), (i + 1).cast("string")).alias("key"),
            F.concat(F.when(F.length(w) <= 4, NBSP + NBSP).otherwise(""), w).alias("value"),
        ),
    )
    rows = read(spark, sf, "pages").select("page_id", F.explode(C.without_parents(item)).alias("m"))
    return rows.select("page_id", "m.key", "m.value")


@query(
    "d1_clean_url",
    """
    WITH u AS (SELECT page_id, url, url LIKE '%spam-farm%' AS spared FROM pages
               UNION ALL SELECT page_id + 1000000000, regexp_extract(url, '^[^?#]*') || '?page=7' || regexp_extract(url, '#.*$'),
                                url LIKE '%spam-farm%' FROM pages),
         c AS (SELECT *, regexp_replace(url, '\\?[^#]*', '') AS clean FROM u)
    SELECT page_id, clean AS clean_url FROM c WHERE spared
    UNION ALL
    SELECT min(page_id), clean FROM c WHERE NOT spared GROUP BY clean
    """,
)
def d1_clean_url(spark: SparkSession, sf: str) -> DataFrame:
    from lotledger.functions.urls import set_param, clear_params

    pages = read(spark, sf, "pages").select("page_id", "url")
    again = pages.select(
        (F.col("page_id") + 1_000_000_000).alias("page_id"), set_param(clear_params(F.col("url")), "page", F.lit(7)).alias("url")
    )
    both = pages.unionByName(again)
    return dedupe_url(both, exempt=F.col("url").contains("spam-farm")).select("page_id", "clean_url")
