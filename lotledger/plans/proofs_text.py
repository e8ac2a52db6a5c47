"""Proofs of the scalar, URL, predicate and value functions.

Listing text is built from a number or word of a table, and the SQL returns
that number or word, so it does not repeat the parsing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lotledger.functions import predicates as P
from lotledger.functions import text as X
from lotledger.functions import urls as U
from lotledger.functions import values as V
from lotledger.functions.rules import apply_rules
from lotledger.plans.registry import dotted, query, read, text, whole

NBSP = "\N{NO-BREAK SPACE}"
EURO = "\N{EURO SIGN}"


@query(
    "f1_nth_int",
    """
    SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS price, o_custkey AS power_in_ps,
           CAST(floor(o_totalprice) AS BIGINT) * 100 + 50 AS inflated,
           CAST(floor(o_totalprice) AS BIGINT) AS exact, 1 AS no_number
    FROM orders
    """,
)
def f1_nth_int(spark: SparkSession, sf: str) -> DataFrame:
    price = dotted(whole("o_totalprice"))
    return read(spark, sf, "orders").select(
        "o_orderkey",
        X.nth_int(text(EURO + " ", price, ",-")).alias("price"),
        X.nth_int(text("66 kW / ", F.col("o_custkey"), " PS"), 1).alias("power_in_ps"),
        X.nth_int(text(price, ",50")).alias("inflated"),
        X.nth_int(text(price, ",50"), decimal=True).alias("exact"),
        X.nth_int(text("keine ", F.lit(","))).isNull().cast("int").alias("no_number"),
    )


@query(
    "f2_nth_float",
    """
    SELECT p_partkey, CAST(p_size AS DOUBLE) / 10 AS comb, 1 AS broken FROM part
    """,
)
def f2_nth_float(spark: SparkSession, sf: str) -> DataFrame:
    shown = text(F.floor(F.col("p_size") / 10), ",", F.col("p_size") % 10, " l/100 km (komb)")
    return read(spark, sf, "part").select(
        "p_partkey",
        X.nth_float(shown).alias("comb"),
        X.nth_float(text("1.234,", F.col("p_size"))).isNull().cast("int").alias("broken"),
    )


@query(
    "f3_month_year",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%m/%Y') AS first_registration,
           strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start, CAST(NULL AS VARCHAR) AS none
    FROM orders
    """,
)
def f3_month_year(spark: SparkSession, sf: str) -> DataFrame:
    shown = text("EZ ", F.date_format("o_orderdate", "MM/yyyy"), " neu")
    return read(spark, sf, "orders").select(
        "o_orderkey",
        X.month_year(shown).alias("first_registration"),
        F.date_format(X.month_start(shown), "yyyy-MM-dd").alias("month_start"),
        X.month_year(F.col("o_orderpriority")).alias("none"),
    )


@query("f4_phone", "SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS phone FROM customer")
def f4_phone(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "customer").select("c_custkey", X.phone(text("tel:", F.col("c_custkey"))).alias("phone"))


@query(
    "f5_currency",
    """
    SELECT p_partkey, '\N{EURO SIGN}' AS symbol, '\N{EURO SIGN}' AS last, p_type AS word FROM part
    """,
)
def f5_currency(spark: SparkSession, sf: str) -> DataFrame:
    price = dotted(whole("p_retailprice"))
    return read(spark, sf, "part").select(
        "p_partkey",
        X.currency(text(" \n" + EURO + " ", price), "symbol").alias("symbol"),
        X.currency(text(price, " " + EURO + " "), "last").alias("last"),
        X.currency(text(" ", F.col("p_type"), " VB "), "word").alias("word"),
    )


@query("f6_dots", "SELECT o_orderkey, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS mileage FROM orders")
def f6_dots(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").select("o_orderkey", X.drop_dots(dotted(whole("o_totalprice"))).alias("mileage"))


@query("f7_first_word", "SELECT p_partkey, string_split(p_name, ' ')[1] AS word FROM part")
def f7_first_word(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "part").select("p_partkey", X.first_word(F.col("p_name")).alias("word"))


@query(
    "f8_capitalise",
    """
    SELECT p_partkey,
           upper(p_name[1]) || p_name[2:] || ', ' || p_type || ', X-' || p_brand AS colour
    FROM part
    """,
)
def f8_capitalise(spark: SparkSession, sf: str) -> DataFrame:
    shown = text(F.col("p_name"), ", ", F.col("p_type"), ", x-", F.col("p_brand"))
    return read(spark, sf, "part").select("p_partkey", X.capitalise_list(shown).alias("colour"))


@query(
    "f9_drop_other",
    """
    SELECT p_partkey, CASE WHEN p_type <> 'ECONOMY' THEN p_type END AS colour, CAST(NULL AS VARCHAR) AS blank
    FROM part
    """,
)
def f9_drop_other(spark: SparkSession, sf: str) -> DataFrame:
    shown = F.when(F.col("p_type") == "ECONOMY", " Andere ").otherwise(text("\t", F.col("p_type"), " "))
    return read(spark, sf, "part").select(
        "p_partkey", X.drop_other(shown).alias("colour"), X.drop_other(F.lit(f" {NBSP} ")).alias("blank")
    )


@query("f10_strip", "SELECT p_partkey, p_name AS model, ' ' || p_name AS lines_only FROM part")
def f10_strip(spark: SparkSession, sf: str) -> DataFrame:
    name = F.col("p_name")
    return read(spark, sf, "part").select(
        "p_partkey",
        X.strip_ws(text(NBSP + NBSP + " \n", name, "\t" + NBSP)).alias("model"),
        X.strip_ws(text("\n\n ", name, "\n"), newlines_only=True).alias("lines_only"),
    )


@query(
    "f11_headline",
    """
    SELECT p_partkey, p_brand || ' ' || p_type AS headline, p_brand || ' XL' AS plus, p_type || ' GT' AS absent FROM part
    """,
)
def f11_headline(spark: SparkSession, sf: str) -> DataFrame:
    name, brand, kind = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    return read(spark, sf, "part").select(
        "p_partkey",
        X.headline(text(brand, " ", name, " ", brand, " ", kind), brand, name).alias("headline"),
        X.headline(
            text(name, " ", brand, " XL"), F.replace(name, F.lit(" "), F.lit("+")), F.lit("no model"), plus_is_space=True
        ).alias("plus"),
        X.headline(text(" ", kind, " GT"), brand, name).alias("absent"),
    )


@query(
    "f12_class",
    "SELECT c_custkey, c_mktsegment[1] AS energy_efficiency_class, CAST(NULL AS VARCHAR) AS none FROM customer",
)
def f12_class(spark: SparkSession, sf: str) -> DataFrame:
    letter = F.left("c_mktsegment", F.lit(1))
    return read(spark, sf, "customer").select(
        "c_custkey",
        X.efficiency_class(text("/assets/envkv", letter, ".svg")).alias("energy_efficiency_class"),
        X.efficiency_class(text("/assets/", letter, ".svg")).alias("none"),
    )


@query(
    "f13_date",
    "SELECT o_orderkey, strftime(o_orderdate, '%d-%m-%Y') AS published, CAST(NULL AS VARCHAR) AS bad FROM orders",
)
def f13_date(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").select(
        "o_orderkey",
        X.reformat_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("published"),
        X.reformat_date(F.col("o_orderpriority")).alias("bad"),
    )


@query("f14_stamp", "SELECT o_orderkey, '09-03-2018' AS parse_date FROM orders")
def f14_stamp(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").select(
        "o_orderkey", F.date_format(X.stamp("2018-03-09"), "dd-MM-yyyy").alias("parse_date")
    )


@query("f15_nullif", "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status FROM orders")
def f15_nullif(spark: SparkSession, sf: str) -> DataFrame:
    from lotledger.operators.merge import empty_to_null

    shown = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus"))
    return empty_to_null(read(spark, sf, "orders").select("o_orderkey", shown.alias("status")))


@query("f16_sub_model", "SELECT p_partkey, CAST(p_type = 'SMALL' AS INTEGER) AS is_sub FROM part")
def f16_sub_model(spark: SparkSession, sf: str) -> DataFrame:
    shown = text(F.when(F.col("p_type") == "SMALL", NBSP + NBSP).otherwise(NBSP), F.col("p_name"))
    return read(spark, sf, "part").select("p_partkey", X.is_sub_model(shown).cast("int").alias("is_sub"))


@query(
    "f17_epoch",
    """
    SELECT event_id, CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT) AS second,
           strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS shown
    FROM events
    """,
)
def f17_epoch(spark: SparkSession, sf: str) -> DataFrame:
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    at = X.epoch_ms(ms)
    return read(spark, sf, "events").select(
        "event_id", F.unix_seconds(at).alias("second"), F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("shown")
    )


@query(
    "f18_alert_text",
    """
    SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') || chr(10) || event_type || ' ' || props AS text
    FROM events
    """,
)
def f18_alert_text(spark: SparkSession, sf: str) -> DataFrame:
    message = text(F.col("event_type"), " ", F.col("props"))
    return read(spark, sf, "events").select("event_id", X.alert_text(F.date_trunc("second", "ts"), message).alias("text"))


@query(
    "n1_rules",
    """
    SELECT p_partkey, upper(p_name[1]) || p_name[2:] AS colour,
           CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) AS mileage,
           CASE WHEN p_type <> 'ECONOMY' THEN p_type END AS interior, p_brand
    FROM part
    """,
)
def n1_rules(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("p_type") == "ECONOMY", "andere").otherwise(F.col("p_type"))
    raw = read(spark, sf, "part").select(
        "p_partkey",
        text(NBSP + " ", F.col("p_name"), " ").alias("colour"),
        text(" ", dotted(whole("p_retailprice")), " km").alias("mileage"),
        kind.alias("interior"),
        "p_brand",
    )
    rules = {
        "colour": [X.drop_other, X.capitalise_list],
        "mileage": [X.strip_ws, X.first_word, X.drop_dots],
        "interior": [X.drop_other, X.capitalise_list],
    }
    return apply_rules(raw, rules)


# URL functions


def _link(*parts) -> F.Column:
    return text("https://lots.example/p", *parts)


@query(
    "u1_get_param",
    """
    SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page,
           nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS utm_source,
           CAST(page_id AS VARCHAR) AS last_one, CAST(NULL AS VARCHAR) AS blank, 'a b' AS decoded
    FROM pages
    """,
)
def u1_get_param(spark: SparkSession, sf: str) -> DataFrame:
    built = _link("?k=first&k=", F.col("page_id"), "&k=&b=&t=a+b#k=no")
    return read(spark, sf, "pages").select(
        "page_id",
        U.get_param(F.col("url"), "page").alias("page"),
        U.get_param(F.col("url"), "utm_source").alias("utm_source"),
        U.get_param(built, "k").alias("last_one"),
        U.get_param(built, "b").alias("blank"),
        U.get_param(built, "t").alias("decoded"),
    )


@query(
    "u2_remove_param",
    """
    SELECT page_id, replace(replace(replace(url, '?page=2&ref=x', '?ref=x'), '?page=2', ''), '&page=2', '') AS url,
           'https://lots.example/p?id=' || page_id || '#top' AS built
    FROM pages
    """,
)
def u2_remove_param(spark: SparkSession, sf: str) -> DataFrame:
    built = _link("?a=1&id=", F.col("page_id"), "&a=2#top")
    return read(spark, sf, "pages").select(
        "page_id", U.remove_param(F.col("url"), "page").alias("url"), U.remove_param(built, "a").alias("built")
    )


@query(
    "u3_set_param",
    """
    SELECT page_id,
           regexp_extract(url, '^[^?#]*') || '?'
             || CASE WHEN url LIKE '%?%' THEN regexp_extract(url, '\\?([^#]*)', 1) || '&' ELSE '' END
             || 'size=20' || regexp_extract(url, '#.*$') AS url,
           'https://lots.example/p?a=1&c=' || page_id AS built
    FROM pages
    """,
)
def u3_set_param(spark: SparkSession, sf: str) -> DataFrame:
    built = _link("?c=9&a=1&b=")
    return read(spark, sf, "pages").select(
        "page_id",
        U.set_param(F.col("url"), "size", F.lit(20)).alias("url"),
        U.set_param(built, "c", F.col("page_id")).alias("built"),
    )


@query(
    "u4_clear",
    "SELECT page_id, regexp_replace(url, '\\?[^#]*', '') AS url FROM pages",
)
def u4_clear(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "pages").select("page_id", U.clear_params(F.col("url")).alias("url"))


@query("u5_fixups", "SELECT p_partkey, p_name || 'en e!' AS model FROM part")
def u5_fixups(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "part").select("p_partkey", U.fix_percent(text(F.col("p_name"), "%C3%ABn %E9%21")).alias("model"))


@query("u6_token", "SELECT p_partkey, p_type || replace(p_name, ' ', '+') AS token FROM part")
def u6_token(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "part").select("p_partkey", U.facet_token(text('"', F.col("p_type"), ",", F.col("p_name"), '"')).alias("token"))


@query(
    "u7_raw_param",
    """
    SELECT page_id, nullif(regexp_extract(url, 'ref=([^&]+)', 1), '') AS ref,
           CAST(coalesce(nullif(regexp_extract(url, 'page=([0-9]+)', 1), ''), '0') AS BIGINT) AS page,
           page_id AS lo, page_id + 7 AS hi, CAST(0 AS BIGINT) AS lo_default, CAST(10000000 AS BIGINT) AS hi_default
    FROM pages
    """,
)
def u7_raw_param(spark: SparkSession, sf: str) -> DataFrame:
    low, high = "&s%5Bmin_price%5D=", "&s%5Bmax_price%5D="
    both = U.limits(_link("?x=1" + low, F.col("page_id"), high, F.col("page_id") + 7), low, high, (0, 10_000_000))
    one = U.limits(_link("?x=1" + low, F.col("page_id")), low, high, (0, 10_000_000))
    return read(spark, sf, "pages").select(
        "page_id",
        U.raw_param(F.col("url"), "ref=").alias("ref"),
        U.raw_param(F.col("url"), "page=", as_int=True, default=0).alias("page"),
        both["lo"].alias("lo"),
        both["hi"].alias("hi"),
        one["lo"].alias("lo_default"),
        one["hi"].alias("hi_default"),
    )


@query(
    "u8_build_url",
    """
    SELECT p_partkey,
           'https://lots.example/p?brand=' || replace(p_brand, '#', '%23') || '&model=' || replace(p_name, ' ', '+')
             || '&pricefrom=0&priceto=' || CAST(floor(p_retailprice) AS BIGINT) AS url
    FROM part
    """,
)
def u8_build_url(spark: SparkSession, sf: str) -> DataFrame:
    params = {
        "brand": F.col("p_brand"),
        "model": F.col("p_name"),
        "pricefrom": F.lit(0),
        "priceto": whole("p_retailprice"),
    }
    return read(spark, sf, "part").select("p_partkey", U.build_url(_link(), params).alias("url"))


# Predicates


@query(
    "p1_valid",
    """
    SELECT event_id, user_id, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k
    FROM events WHERE event_type <> 'view' AND value >= 5
    """,
)
def p1_valid(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "events").select(
        "event_id",
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("make"),
        F.when(F.col("value") >= 5, F.col("value")).alias("price"),
    )
    required = [F.col(c) for c in ("user_id", "k", "make", "price")]
    return rows.where(P.is_valid(*required)).select("event_id", "user_id", "k")


@query("p2_price", "SELECT event_id FROM events WHERE value >= 10")
def p2_price(spark: SparkSession, sf: str) -> DataFrame:
    shown = F.when(F.col("value") >= 10, text(EURO + " ", F.col("value"))).otherwise("auf Anfrage")
    return read(spark, sf, "events").where(P.has_price(X.nth_int(shown))).select("event_id")


@query("p3_currency", "SELECT event_id, '\N{EURO SIGN}' AS currency FROM events WHERE event_type = 'purchase'")
def p3_currency(spark: SparkSession, sf: str) -> DataFrame:
    shown = F.when(F.col("event_type") == "purchase", text(F.col("value"), " " + EURO))
    return (
        read(spark, sf, "events")
        .select("event_id", X.currency(shown, "last").alias("currency"))
        .where(P.has_currency(F.col("currency")))
    )


@query("p4_exclude", "SELECT p_partkey, p_name FROM part WHERE p_name NOT LIKE '%widget%' AND p_type <> 'SMALL'")
def p4_exclude(spark: SparkSession, sf: str) -> DataFrame:
    bucket = F.when(F.col("p_type") == "SMALL", "Sonstige Modelle").otherwise(F.col("p_type"))
    return (
        read(spark, sf, "part")
        .where(P.not_other(bucket) & P.not_other(F.col("p_name"), "widget"))
        .select("p_partkey", "p_name")
    )


@query("p5_gone", "SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS sold FROM orders")
def p5_gone(spark: SparkSession, sf: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", 410).when(F.col("o_orderstatus") == "O", 200)
    return read(spark, sf, "orders").select("o_orderkey", P.is_gone(status).cast("int").alias("sold"))


@query(
    "p6_errors",
    "SELECT event_id, user_id FROM events WHERE event_type = 'error' AND CAST(regexp_extract(props, '[0-9]+') AS BIGINT) <> 0",
)
def p6_errors(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "events").where(P.is_error(F.col("event_type"), "error"))
    return rows.where(P.has_errors(F.get_json_object("props", "$.k").cast("bigint"))).select("event_id", "user_id")


@query("p7_recent", "SELECT event_id FROM events WHERE ts + INTERVAL 1 MINUTE >= TIMESTAMP '2024-01-20 12:00:00'")
def p7_recent(spark: SparkSession, sf: str) -> DataFrame:
    now = F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    return read(spark, sf, "events").where(P.is_recent(F.col("ts"), now)).select("event_id")


# Values out of extracted text


@query(
    "e4_regex_refine",
    """
    SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS power_in_kw, o_custkey AS power_in_ps,
           strftime(o_orderdate, '%m/%Y') AS first_registration, CAST(NULL AS VARCHAR) AS none
    FROM orders
    """,
)
def e4_regex_refine(spark: SparkSession, sf: str) -> DataFrame:
    power = text(whole("o_totalprice"), " kW (", F.col("o_custkey"), " PS)")
    return read(spark, sf, "orders").select(
        "o_orderkey",
        V.refine(power, V.REFINE["power_in_kw"], 1).cast("bigint").alias("power_in_kw"),
        V.refine(power, V.REFINE["power_in_ps"], 1).cast("bigint").alias("power_in_ps"),
        V.refine(text("EZ ", F.date_format("o_orderdate", "MM/yyyy")), V.REFINE["first_registration"], 1).alias(
            "first_registration"
        ),
        V.refine(F.col("o_orderpriority"), V.REFINE["service_maintenance"], 1).alias("none"),
    )


@query(
    "e7_count",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE CAST(floor(o_totalprice) AS BIGINT) END AS found,
           CAST(floor(o_totalprice) AS BIGINT) AS found_anywhere
    FROM orders
    """,
)
def e7_count(spark: SparkSession, sf: str) -> DataFrame:
    n = dotted(whole("o_totalprice"))
    return read(spark, sf, "orders").select(
        "o_orderkey",
        V.count_text(F.when(F.col("o_orderstatus") != "P", text(n, " Angebote"))).alias("found"),
        V.count_run(text("Es gibt ", n, " Angebote")).alias("found_anywhere"),
    )


@query(
    "e9_tags",
    """
    WITH d AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents)
    SELECT doc_id,
           CASE WHEN list_contains(w, 'the') THEN 'the' WHEN list_contains(w, 'der') THEN 'der'
                WHEN list_contains(w, 'la') THEN 'la' END AS climate_control,
           CASE WHEN list_contains(w, 'with') THEN 'with' WHEN list_contains(w, 'of') THEN 'of' END AS gearbox
    FROM d
    """,
)
def e9_tags(spark: SparkSession, sf: str) -> DataFrame:
    words = F.split("text", " ")
    return read(spark, sf, "documents").select(
        "doc_id",
        V.tag_value(words, ["the", "der", "la"]).alias("climate_control"),
        V.tag_value(words, ["with", "of"]).alias("gearbox"),
    )


@query(
    "e10_address",
    """
    SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE lpad(CAST(c_custkey AS VARCHAR), 9, '0') END AS postal_code,
           CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS country
    FROM customer
    """,
)
def e10_address(spark: SparkSession, sf: str) -> DataFrame:
    digits = F.lpad(F.col("c_custkey").cast("string"), 9, "0")
    shown = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).otherwise(text(digits, " ", F.col("c_name")))
    return read(spark, sf, "customer").select("c_custkey", V.address(shown).alias("a")).select("c_custkey", "a.*")


@query(
    "e11_engine",
    "SELECT p_partkey, CAST(p_size * 10 AS BIGINT) AS centilitres, p_type AS fuel FROM part",
)
def e11_engine(spark: SparkSession, sf: str) -> DataFrame:
    shown = text(F.floor(F.col("p_size") / 10), ".", F.col("p_size") % 10, " ", F.col("p_type"))
    motor = V.engine(shown)
    return read(spark, sf, "part").select(
        "p_partkey", (motor["litres"] * 100).cast("bigint").alias("centilitres"), motor["fuel"].alias("fuel")
    )


@query("e12_first", "SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN p_brand ELSE p_type END AS climate_control FROM part")
def e12_first(spark: SparkSession, sf: str) -> DataFrame:
    first = F.when(F.col("p_type") != "SMALL", F.col("p_type")).otherwise("")
    return read(spark, sf, "part").select(
        "p_partkey", V.first_nonempty(F.lit(None).cast("string"), first, F.col("p_brand")).alias("climate_control")
    )


@query(
    "e13_join",
    """
    SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN p_brand ELSE p_type || ', ' || p_brand END AS interior,
           p_brand || ' ' || p_name AS emission_class, CAST(NULL AS VARCHAR) AS none
    FROM part
    """,
)
def e13_join(spark: SparkSession, sf: str) -> DataFrame:
    first = F.when(F.col("p_type") != "SMALL", F.col("p_type"))
    return read(spark, sf, "part").select(
        "p_partkey",
        V.join_values(", ", first, F.col("p_brand")).alias("interior"),
        V.join_values(" ", F.col("p_brand"), F.lit(""), F.col("p_name")).alias("emission_class"),
        V.join_values(", ", F.lit(None).cast("string")).alias("none"),
    )
