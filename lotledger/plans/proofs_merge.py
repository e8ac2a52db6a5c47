"""Proofs of lookups, joins, upsert and run state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lotledger.functions.predicates import in_state, is_error
from lotledger.operators import catalog as C
from lotledger.operators import joins as J
from lotledger.operators import merge as M
from lotledger.operators.dedupe import dedupe_run
from lotledger.plans.registry import query, read, text, whole
from lotledger.plans.site_run import pages_added, run_site
from lotledger.session import scratch_dir
from lotledger.sources import readers, writers
from lotledger.sources.store import Store

RUN = M.Run("S", 2, "2018-03-09")
_RUN_DATE = "2018-03-09"


def _link(c: str) -> Column:
    return text("/o/", F.col(c)).alias("origin_link")


# Stored listings are the finished and open orders; the batch brings the open and pending ones.
def _stored(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").where("o_orderstatus <> 'P'").select(
        _link("o_orderkey"),
        whole("o_totalprice").alias("sales_price_incl_vat"),
        F.lit(1).cast("bigint").alias("iteration_id"),
        F.lit(1).cast("int").alias("is_synced"),
        F.col("o_orderdate").cast("date").alias("parse_date"),
    )


def _batch(spark: SparkSession, sf: str) -> DataFrame:
    price = whole("o_totalprice") + F.when(F.col("o_orderpriority") == "1-URGENT", 100).otherwise(0)
    return read(spark, sf, "orders").where("o_orderstatus <> 'F'").select(
        _link("o_orderkey"),
        F.when(F.col("o_orderpriority") != "5-LOW", price).alias("sales_price_incl_vat"),
        "o_orderpriority",
    )


_SQL = """
    WITH stored AS (
        SELECT '/o/' || o_orderkey AS origin_link, CAST(floor(o_totalprice) AS BIGINT) AS price, CAST(1 AS BIGINT) AS it,
               CAST(1 AS INTEGER) AS synced, strftime(o_orderdate, '%Y-%m-%d') AS d
        FROM orders WHERE o_orderstatus <> 'P'),
    batch AS (
        SELECT '/o/' || o_orderkey AS origin_link, o_orderpriority,
               CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(floor(o_totalprice) AS BIGINT)
                    + CASE WHEN o_orderpriority = '1-URGENT' THEN 100 ELSE 0 END END AS price
        FROM orders WHERE o_orderstatus <> 'F')
"""


def _shown(df: DataFrame) -> DataFrame:
    return df.withColumn("parse_date", F.date_format("parse_date", "yyyy-MM-dd"))


@query(
    "s2_lookup",
    """
    SELECT '/o/' || o_orderkey AS origin_link, CAST(1 AS INTEGER) AS is_synced, CAST(floor(o_totalprice) AS BIGINT) AS sales_price_incl_vat
    FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)
    """,
)
def s2_lookup(spark: SparkSession, sf: str) -> DataFrame:
    batch = read(spark, sf, "lineitem").where("l_quantity > 45").select(_link("l_orderkey"))
    return J.lookup(_stored(spark, sf), batch, ["origin_link", "is_synced", "sales_price_incl_vat"])


def _control(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("site_name"), F.col("o_custkey").alias("iteration_id")
    )


@query(
    "s3_last_run",
    """
    SELECT 'F' AS site_name, coalesce(max(o_custkey), 0) AS iteration_id FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'none', CAST(0 AS BIGINT)
    """,
)
def s3_last_run(spark: SparkSession, sf: str) -> DataFrame:
    control = _control(spark, sf)
    return M.last_iteration(control, "F").unionByName(M.last_iteration(control, "none"))


@query(
    "a3_next_run",
    """
    SELECT 'O' AS site_name, max(o_custkey) + 1 AS iteration_id FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT 'none', CAST(1 AS BIGINT)
    """,
)
def a3_next_run(spark: SparkSession, sf: str) -> DataFrame:
    control = _control(spark, sf)
    return M.next_iteration(control, "O").unionByName(M.next_iteration(control, "none"))


@query("j1_seen", _SQL + "SELECT origin_link, price AS sales_price_incl_vat FROM batch SEMI JOIN stored USING (origin_link)")
def j1_seen(spark: SparkSession, sf: str) -> DataFrame:
    seen, _ = J.split_seen(_batch(spark, sf).drop("o_orderpriority"), _stored(spark, sf))
    return seen


@query("j1_new", _SQL + "SELECT origin_link, price AS sales_price_incl_vat FROM batch ANTI JOIN stored USING (origin_link)")
def j1_new(spark: SparkSession, sf: str) -> DataFrame:
    _, new = J.split_seen(_batch(spark, sf).drop("o_orderpriority"), _stored(spark, sf))
    return new


@query(
    "j2_enrich",
    """
    SELECT '/o/' || l_orderkey AS origin_link, l_linenumber, l_extendedprice, o_orderpriority AS colour, o_orderstatus AS body_type
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    """,
)
def j2_enrich(spark: SparkSession, sf: str) -> DataFrame:
    shallow = read(spark, sf, "orders").select(
        _link("o_orderkey"), F.col("o_orderpriority").alias("colour"), F.col("o_orderstatus").alias("body_type")
    )
    detail = read(spark, sf, "lineitem").select(
        _link("l_orderkey"), "l_linenumber", "l_extendedprice", F.lit("detail").alias("colour")
    )
    return J.enrich(shallow, detail)


@query(
    "j3_lookup",
    """
    SELECT c_custkey, r_name AS make, n_name AS model
    FROM customer LEFT JOIN region ON r_regionkey = c_custkey % 6
         LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey = c_custkey % 6
    """,
)
def j3_lookup(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "customer").select(
        "c_custkey", (F.col("c_custkey") % 6).alias("brand_key"), F.col("c_nationkey").alias("model_key")
    )
    brands = read(spark, sf, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("value"))
    models = read(spark, sf, "nation").select(
        F.col("n_regionkey").alias("brand_key"), F.col("n_nationkey").alias("key"), F.col("n_name").alias("value")
    )
    return C.lookup_names(rows, brands, models).select("c_custkey", "make", "model")


@query(
    "j4_cross",
    """
    WITH m AS (SELECT DISTINCT p_brand AS brand, p_name AS model FROM part),
         b AS (SELECT unnest(['Coupe', 'Kombi', 'Van']) AS body_type), c AS (SELECT unnest(['rot', 'blau']) AS colour)
    SELECT brand, model, body_type, colour FROM m, b, c
    """,
)
def j4_cross(spark: SparkSession, sf: str) -> DataFrame:
    models = read(spark, sf, "part").select(F.col("p_brand").alias("brand"), F.col("p_name").alias("model")).distinct()
    facets = {
        "body_type": F.array(F.lit("Coupe"), F.lit("Kombi"), F.lit("Van")),
        "colour": F.array(F.lit("rot"), F.lit("blau")),
    }
    return C.cross_facets(models, facets)


@query(
    "j5_job_logs",
    """
    SELECT c_name AS job, event_id, props AS message FROM events JOIN customer ON c_custkey = user_id
    WHERE c_mktsegment = 'BUILDING' AND event_type = 'error'
    """,
)
def j5_job_logs(spark: SparkSession, sf: str) -> DataFrame:
    jobs = (
        read(spark, sf, "customer")
        .where(in_state(F.col("c_mktsegment"), "BUILDING"))
        .select(F.col("c_custkey").alias("job_id"), F.col("c_name").alias("job"))
    )
    logs = (
        read(spark, sf, "events")
        .where(is_error(F.col("event_type"), "error"))
        .select(F.col("user_id").alias("job_id"), "event_id", F.col("props").alias("message"))
    )
    return J.job_logs(jobs, logs).drop("job_id")


@query(
    "m1_touch",
    _SQL
    + f"""
    SELECT origin_link, s.price AS sales_price_incl_vat, CAST(CASE WHEN b.origin_link IS NULL THEN it ELSE 2 END AS BIGINT) AS iteration_id,
           synced AS is_synced, CASE WHEN b.origin_link IS NULL THEN d ELSE '{_RUN_DATE}' END AS parse_date
    FROM stored s LEFT JOIN batch b USING (origin_link)
    """,
)
def m1_touch(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(M.touch(_stored(spark, sf), _batch(spark, sf), RUN))


@query(
    "m2_insert",
    _SQL
    + f"""
    SELECT origin_link, price AS sales_price_incl_vat, CAST(2 AS BIGINT) AS iteration_id, CAST(0 AS INTEGER) AS is_synced,
           '{_RUN_DATE}' AS parse_date
    FROM batch ANTI JOIN stored USING (origin_link)
    """,
)
def m2_insert(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(M.insert_new(_batch(spark, sf).drop("o_orderpriority"), _stored(spark, sf), RUN))


_SQL_MERGE = (
    _SQL
    + f""",
    lines AS (
        SELECT '/o/' || l_orderkey AS origin_link, CAST(floor(l_extendedprice) AS BIGINT) AS price,
               row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_extendedprice) AS r
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'F'),
    first AS (SELECT * FROM lines WHERE r = 1)
    SELECT origin_link, price AS sales_price_incl_vat, it AS iteration_id, synced AS is_synced, d AS parse_date
    FROM stored ANTI JOIN first USING (origin_link)
    UNION ALL
    SELECT origin_link, s.price, CAST(2 AS BIGINT), synced, '{_RUN_DATE}' FROM stored s JOIN first USING (origin_link)
    UNION ALL
    SELECT origin_link, price, CAST(2 AS BIGINT), CAST(0 AS INTEGER), '{_RUN_DATE}' FROM first ANTI JOIN stored USING (origin_link)
    """
)


@query("m3_merge", _SQL_MERGE)
def m3_merge(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(M.merge_run(_stored(spark, sf), _line_batch(spark, sf), RUN))


def _line_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The first order line of every order that isn't finished, as a row per link."""
    wanted = read(spark, sf, "orders").where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    lines = read(spark, sf, "lineitem").join(wanted, "l_orderkey", "left_semi")
    captures = lines.select(
        _link("l_orderkey"), whole("l_extendedprice").alias("sales_price_incl_vat"), "l_shipdate", "l_linenumber", "l_extendedprice"
    )
    batch = dedupe_run(captures, "origin_link", ["l_shipdate", "l_linenumber", "l_extendedprice"])
    return batch.select("origin_link", "sales_price_incl_vat")


def _store(spark: SparkSession, sf: str) -> Store:
    """The stored listings as version 1 of a bucketed table."""
    stored = _stored(spark, sf)
    store = Store(spark, scratch_dir(spark, "store"), stored.schema)
    store.publish(stored, M.Run("S", 1, "2018-03-02"), ["colour"])
    return store


@query("m3_store", _SQL_MERGE)
def m3_store(spark: SparkSession, sf: str) -> DataFrame:
    """The same merge as the next version of a bucketed table; the stored rows aren't shuffled."""
    store = _store(spark, sf)
    store.merge(_line_batch(spark, sf), RUN)
    return _shown(store.rows())


@query(
    "m4_switch",
    _SQL
    + f""",
    new AS (
        SELECT origin_link, s.price, CAST(CASE WHEN b.price IS NULL THEN it ELSE 2 END AS BIGINT) AS it, synced, CASE WHEN b.price IS NULL THEN d ELSE '{_RUN_DATE}' END AS d
        FROM stored s LEFT JOIN batch b USING (origin_link)
        UNION ALL
        SELECT origin_link, price, CAST(2 AS BIGINT), CAST(0 AS INTEGER), '{_RUN_DATE}' FROM batch ANTI JOIN stored USING (origin_link) WHERE price IS NOT NULL)
    SELECT 'before' AS seen_by, CAST(1 AS BIGINT) AS last_run, 'colour' AS bad_fields, origin_link, price AS sales_price_incl_vat, it AS iteration_id, synced AS is_synced, d AS parse_date FROM stored
    UNION ALL SELECT 'dead', CAST(1 AS BIGINT), 'colour', * FROM stored
    UNION ALL SELECT 'after', CAST(2 AS BIGINT), 'make', * FROM new
    """,
)
def m4_switch(spark: SparkSession, sf: str) -> DataFrame:
    """What readers see before a run, after one that died once its rows were written, and after one that was committed."""
    store = _store(spark, sf)
    batch = _batch(spark, sf).drop("o_orderpriority")

    def seen(by: str) -> DataFrame:
        m = store.manifest()
        told = {"seen_by": F.lit(by), "last_run": F.lit(m.iteration_id).cast("bigint"), "bad_fields": F.lit(",".join(m.bad_fields))}
        return store.rows(m).withColumns(told)

    before = seen("before")
    store._write_base(M.merge_run(store.rows(), batch, RUN), store.manifest().buckets)
    dead = seen("dead")
    store.merge(batch, RUN, ["make"])
    return _shown(before.unionByName(dead).unionByName(seen("after")))


@query("j1_seen_store", _SQL + "SELECT DISTINCT origin_link FROM batch SEMI JOIN stored USING (origin_link)")
def j1_seen_store(spark: SparkSession, sf: str) -> DataFrame:
    """The batch's links that a bucketed table has; only buckets of the batch are read."""
    store = _store(spark, sf)
    batch = _batch(spark, sf).select("origin_link").distinct()
    return batch.join(store.keys_of(batch, store.manifest()), "origin_link", "left_semi")



_SQL_PRICE = """
    SELECT origin_link, CASE WHEN b.price IS NOT NULL THEN b.price ELSE s.price END AS sales_price_incl_vat,
           CAST(CASE WHEN b.price IS NULL THEN it ELSE 2 END AS BIGINT) AS iteration_id,
           CASE WHEN b.price <> s.price THEN 0 ELSE synced END AS is_synced,
           CASE WHEN b.price IS NULL THEN d ELSE '2018-03-09' END AS parse_date
    FROM stored s LEFT JOIN batch b USING (origin_link)
"""


@query("m5_price", _SQL + _SQL_PRICE)
def m5_price(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(M.update_price(_stored(spark, sf), _batch(spark, sf), RUN))


@query(
    "m5_merge_price",
    _SQL
    + _SQL_PRICE
    + """
    UNION ALL
    SELECT origin_link, price, CAST(2 AS BIGINT), CAST(0 AS INTEGER), '2018-03-09'
    FROM batch ANTI JOIN stored USING (origin_link) WHERE price IS NOT NULL
    """,
)
def m5_merge_price(spark: SparkSession, sf: str) -> DataFrame:
    batch = _batch(spark, sf).drop("o_orderpriority")
    return _shown(M.merge_run(_stored(spark, sf), batch, RUN, change_price=True))


# Detail pages of the batch: the customer decides what a page says, so that every outcome occurs.
def _detail(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_custkey") % 5
    return read(spark, sf, "orders").where("o_orderstatus <> 'F'").select(
        _link("o_orderkey"),
        F.when(key == 0, 410).otherwise(200).alias("status"),
        F.when(key != 1, F.col("o_orderpriority")).alias("make"),
        F.when(key != 2, "EUR").alias("currency"),
    )


_SQL_OUTCOME = (
    _SQL
    + """,
    labelled AS (
        SELECT b.origin_link, s.origin_link IS NOT NULL AS seen,
               CASE WHEN s.origin_link IS NOT NULL THEN CASE WHEN b.price IS NOT NULL THEN 'Already in database' END
                    WHEN o_custkey % 5 = 0 THEN 'Car was sold'
                    WHEN o_custkey % 5 = 1 THEN 'Car will parse again'
                    WHEN o_custkey % 5 = 2 THEN 'Invalid response'
                    WHEN b.price IS NULL THEN 'Car hasn''t price'
                    ELSE 'inserted' END AS information
        FROM batch b LEFT JOIN stored s USING (origin_link) JOIN orders ON '/o/' || o_orderkey = b.origin_link)
"""
)


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    return M.outcome(_batch(spark, sf), _stored(spark, sf), _detail(spark, sf), required=["make"])


@query("m6_outcome", _SQL_OUTCOME + "SELECT origin_link, CAST(seen AS INTEGER) AS seen, information FROM labelled")
def m6_outcome(spark: SparkSession, sf: str) -> DataFrame:
    return _labels(spark, sf).withColumn("seen", F.col("seen").cast("int"))


@query("m6_outcome_counts", _SQL_OUTCOME + "SELECT information, count(*) AS n FROM labelled GROUP BY 1")
def m6_outcome_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _labels(spark, sf).groupBy("information").agg(F.count("*").alias("n"))


@query(
    "k6_rejects",
    _SQL_OUTCOME
    + "SELECT origin_link, information AS reason FROM labelled WHERE NOT seen AND information <> 'inserted'",
)
def k6_rejects(spark: SparkSession, sf: str) -> DataFrame:
    labels = _labels(spark, sf).where("NOT seen").drop("seen")
    failed = F.when(F.col("information") != M.INSERTED, F.col("information"))
    _, rejects = J.split_rejects(labels, failed)
    path = scratch_dir(spark, "rejects")
    writers.write_rejects(rejects.select("origin_link", "reason"), path)
    return spark.read.schema("origin_link string, reason string").parquet(path)


# New orders as attempted items: a column per completeness case.
def _attempted(spark: SparkSession, sf: str) -> DataFrame:
    stored = F.col("o_orderstatus") == "P"
    return read(spark, sf, "orders").where("o_orderstatus <> 'F'").select(
        F.col("o_orderpriority").alias("site"),
        stored.alias("stored"),
        F.col("o_custkey").alias("make"),
        F.when(F.lit(False), F.col("o_custkey")).alias("mileage"),
        F.when(~stored, F.col("o_custkey")).alias("colour"),
        F.when(F.col("o_orderpriority") != "2-HIGH", F.col("o_custkey")).alias("body_type"),
    )


@query(
    "a1_bad_fields",
    "SELECT 'mileage, colour' AS bad_fields UNION ALL SELECT 'make, mileage, colour, body_type'",
)
def a1_bad_fields(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["make", "mileage", "colour", "body_type"]
    attempted = _attempted(spark, sf)
    some = M.bad_fields(attempted, F.col("stored"), columns)
    none = M.bad_fields(attempted, F.lit(False), columns)
    return some.unionByName(none).select(F.array_join("bad_fields", ", ").alias("bad_fields"))


@query(
    "a1_bad_fields_by_site",
    """
    SELECT o_orderpriority AS site, CASE WHEN o_orderpriority = '2-HIGH' THEN 'mileage, colour, body_type' ELSE 'mileage, colour' END AS bad_fields
    FROM orders GROUP BY 1
    """,
)
def a1_bad_fields_by_site(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["make", "mileage", "colour", "body_type"]
    bad = M.bad_fields(_attempted(spark, sf), F.col("stored"), columns, by=["site"])
    return bad.select("site", F.array_join("bad_fields", ", ").alias("bad_fields"))


@query("k4_run_row", "SELECT 'S' AS site_name, CAST(2 AS BIGINT) AS iteration_id, 'mileage, colour' AS bad_fields")
def k4_run_row(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["make", "mileage", "colour", "body_type"]
    bad = M.bad_fields(_attempted(spark, sf), F.col("stored"), columns)
    path = scratch_dir(spark, "control")
    writers.save_run(M.control_row(bad.select(F.array(F.lit("old")).alias("bad_fields")), M.Run("S", 1, _RUN_DATE)), path)
    writers.save_run(M.control_row(bad, RUN), path)
    return readers.read_control(spark, path).withColumn("bad_fields", F.array_join("bad_fields", ", "))


def _site_run(spark: SparkSession, sf: str, detail_price: str = "sales_price_incl_vat"):
    stored = _stored(spark, sf).withColumns(
        {"make": F.lit("old"), "currency": F.lit("EUR"), "mileage": F.lit(None).cast("bigint"), "site": F.lit("S")}
    )
    prices = _batch(spark, sf).select("origin_link", F.expr(detail_price).alias("sales_price_incl_vat"))
    detail = _detail(spark, sf).join(prices, "origin_link")
    return run_site(
        _batch(spark, sf), detail, stored, RUN, order=["o_orderpriority"], required=["make"]
    )


@query(
    "m4_run",
    _SQL_OUTCOME
    + f"""
    SELECT origin_link, s.price AS sales_price_incl_vat, 'old' AS make,
           CAST(CASE WHEN l.information IS NULL THEN it ELSE 2 END AS BIGINT) AS iteration_id, synced AS is_synced,
           CASE WHEN l.information IS NULL THEN d ELSE '{_RUN_DATE}' END AS parse_date
    FROM stored s LEFT JOIN labelled l USING (origin_link)
    UNION ALL
    SELECT origin_link, price, o_orderpriority, CAST(2 AS BIGINT), CAST(0 AS INTEGER), '{_RUN_DATE}'
    FROM batch JOIN labelled USING (origin_link) WHERE information = 'inserted'
    """,
)
def m4_run(spark: SparkSession, sf: str) -> DataFrame:
    table = _site_run(spark, sf).table
    return _shown(table).select("origin_link", "sales_price_incl_vat", "make", "iteration_id", "is_synced", "parse_date")


@query(
    "m4_run_u",
    _SQL_OUTCOME
    + f"""
    SELECT origin_link, s.price AS sales_price_incl_vat, CAST(CASE WHEN l.information IS NULL THEN it ELSE 2 END AS BIGINT) AS iteration_id,
           CASE WHEN l.information IS NULL THEN d ELSE '{_RUN_DATE}' END AS parse_date
    FROM stored s LEFT JOIN labelled l USING (origin_link)
    UNION ALL
    SELECT origin_link, CASE WHEN o_orderpriority <> '1-URGENT' THEN coalesce(price, 0) + 7 END, CAST(2 AS BIGINT), '{_RUN_DATE}'
    FROM batch JOIN labelled USING (origin_link) WHERE information = 'inserted'
    """,
)
def m4_run_u(spark: SparkSession, sf: str) -> DataFrame:
    """The price of a detail page differs from that of the result page, and either may be absent."""
    detail_price = "CASE WHEN o_orderpriority <> '1-URGENT' THEN coalesce(sales_price_incl_vat, 0) + 7 END"
    table = _site_run(spark, sf, detail_price).table
    return _shown(table).select("origin_link", "sales_price_incl_vat", "iteration_id", "parse_date")


@query(
    "m4_control",
    """
    SELECT 'S' AS site_name, CAST(2 AS BIGINT) AS iteration_id,
           'model, body_type, mileage, fuel_consumption_comb, first_registration, colour' AS bad_fields
    """,
)
def m4_control(spark: SparkSession, sf: str) -> DataFrame:
    return _site_run(spark, sf).control.withColumn("bad_fields", F.array_join("bad_fields", ", "))


@query(
    "flagship_pages_added",
    """
    WITH p AS (SELECT page_id, regexp_replace(url, '\\?[^#]*', '') AS origin_link,
                      nullif(regexp_extract(html, '<title>([^<]*)', 1), '') AS title,
                      nullif(regexp_extract(html, '<h1>([^<]*)', 1), '') AS heading,
                      length(html) AS n,
                      len(regexp_extract_all(regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'g'),
                                             '<a href="[^"]*"')) AS n_links
               FROM pages),
         stored AS (SELECT DISTINCT regexp_replace(url, '\\?[^#]*', '') AS origin_link FROM pages WHERE url LIKE 'https:%'),
         f AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY origin_link ORDER BY page_id) = 1)
    SELECT page_id, origin_link, title, heading, CAST(n_links AS BIGINT) AS n_links, CAST(2 AS BIGINT) AS iteration_id,
           CAST(0 AS INTEGER) AS is_synced, '2018-03-09' AS parse_date
    FROM f ANTI JOIN stored USING (origin_link)
    """,
)
def flagship_pages_added(spark: SparkSession, sf: str) -> DataFrame:
    from lotledger.functions.urls import clear_params

    pages = read(spark, sf, "pages")
    stored = pages.where("url LIKE 'https:%'").select(clear_params(F.col("url")).alias("origin_link"))
    return _shown(pages_added(pages, stored, RUN))
