"""Proofs of range splits, caps, pages and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lotledger.functions.predicates import CAP_S, CAP_U
from lotledger.operators import ranges as R
from lotledger.operators.dedupe import dedupe_in, dedupe_run, first_per_key
from lotledger.plans.registry import query, read, whole

# The halving itself, as a recursion over a histogram h(g, v, n): the SQL side of every split.
_SQL_SPLIT = """
    {name}(g, lo, hi, n) AS (
        SELECT g, CAST({lo} AS BIGINT), CAST({hi} AS BIGINT), CAST(sum(n) AS BIGINT) FROM {hist} GROUP BY g
        UNION ALL
        SELECT c.g, c.lo, c.hi, CAST(sum(h.n) AS BIGINT)
        FROM (SELECT g, lo, lo + (hi - lo) // 2 AS hi FROM {name} WHERE n > {cap} AND lo < hi
              UNION ALL
              SELECT g, lo + (hi - lo) // 2 + 1, hi FROM {name} WHERE n > {cap} AND lo < hi) c
        JOIN {hist} h ON h.g = c.g AND h.v BETWEEN c.lo AND c.hi
        GROUP BY c.g, c.lo, c.hi
    )
"""


def _sql_split(name: str, hist: str, bounds: tuple[int, int], cap: int) -> str:
    return _SQL_SPLIT.format(name=name, hist=hist, lo=bounds[0], hi=bounds[1], cap=cap)


@query(
    "r1_split",
    f"""
    WITH RECURSIVE hist AS (SELECT 0 AS g, CAST(floor(o_totalprice) AS BIGINT) AS v, count(*) AS n FROM orders GROUP BY v),
    {_sql_split("t", "hist", R.PRICE_RANGE_S, CAP_S)}
    SELECT lo, hi, n FROM t WHERE n <= {CAP_S} OR lo = hi
    """,
)
def r1_split(spark: SparkSession, sf: str) -> DataFrame:
    return R.split_ranges(read(spark, sf, "orders"), F.col("o_totalprice"), *R.PRICE_RANGE_S, CAP_S)


@query(
    "r1_split_by",
    f"""
    WITH RECURSIVE hist AS (SELECT l_returnflag AS g, CAST(floor(l_extendedprice) AS BIGINT) AS v, count(*) AS n
                            FROM lineitem GROUP BY g, v),
    {_sql_split("t", "hist", R.PRICE_RANGE_U, CAP_U)}
    SELECT g AS l_returnflag, lo, hi, n FROM t WHERE n <= {CAP_U} OR lo = hi
    """,
)
def r1_split_by(spark: SparkSession, sf: str) -> DataFrame:
    return R.split_ranges(
        read(spark, sf, "lineitem"), F.col("l_extendedprice"), *R.PRICE_RANGE_U, CAP_U, by=["l_returnflag"]
    )


@query(
    "r2_split2",
    f"""
    WITH RECURSIVE h1 AS (SELECT 0 AS g, CAST(floor(l_quantity) AS BIGINT) AS v, count(*) AS n FROM lineitem GROUP BY v),
    h2 AS (SELECT CAST(floor(l_quantity) AS BIGINT) AS g, CAST(floor(l_extendedprice) AS BIGINT) AS v, count(*) AS n
           FROM lineitem GROUP BY g, v),
    {_sql_split("t1", "h1", R.PRICE_RANGE_S, CAP_S)},
    over AS (SELECT lo FROM t1 WHERE lo = hi AND n > {CAP_S}),
    h3 AS (SELECT * FROM h2 WHERE g IN (SELECT lo FROM over)),
    {_sql_split("t2", "h3", R.MILEAGE_RANGE_S, CAP_S)}
    SELECT lo, hi, CAST(NULL AS BIGINT) AS lo2, CAST(NULL AS BIGINT) AS hi2, n FROM t1 WHERE n <= {CAP_S}
    UNION ALL
    SELECT g, g, lo, hi, n FROM t2 WHERE n <= {CAP_S} OR lo = hi
    """,
)
def r2_split2(spark: SparkSession, sf: str) -> DataFrame:
    return R.split_two(
        read(spark, sf, "lineitem"),
        F.col("l_quantity"),
        F.col("l_extendedprice"),
        R.PRICE_RANGE_S,
        R.MILEAGE_RANGE_S,
        CAP_S,
    ).drop("outside")


# Prices that are absent or beyond the root, and a group without a name.
def _gaps(spark: SparkSession, sf: str) -> DataFrame:
    price = F.when(F.col("l_linenumber") == 5, F.lit(-1)).otherwise(F.floor("l_extendedprice").cast("bigint"))
    return read(spark, sf, "lineitem").select(
        F.expr("nullif(l_returnflag, 'A')").alias("g"),
        "l_suppkey",
        F.floor("l_quantity").cast("bigint").alias("quantity"),
        F.when(F.col("l_linenumber") != 3, price).alias("price"),
    )


_SQL_GAPS = """
    gaps AS (SELECT nullif(l_returnflag, 'A') AS g, l_suppkey, CAST(floor(l_quantity) AS BIGINT) AS quantity,
                    CASE l_linenumber WHEN 3 THEN NULL WHEN 5 THEN -1 ELSE CAST(floor(l_extendedprice) AS BIGINT) END AS price FROM lineitem)
"""
# A supplier's rows are few at every scale, so some groups fit this cap and some don't.
_GROUP_CAP = 600


@query(
    "r1_split_whole",
    f"""
    WITH RECURSIVE {_SQL_GAPS},
    total AS (SELECT l_suppkey AS g, count(*) AS n FROM gaps GROUP BY 1),
    hist AS (SELECT l_suppkey AS g, price AS v, count(*) AS n FROM gaps
             WHERE price BETWEEN 0 AND 10000000 AND l_suppkey IN (SELECT g FROM total WHERE n > {_GROUP_CAP}) GROUP BY 1, 2),
    {_sql_split("t", "hist", R.PRICE_RANGE_U, _GROUP_CAP)}
    SELECT g AS l_suppkey, lo, hi, n FROM t WHERE n <= {_GROUP_CAP} OR lo = hi
    UNION ALL SELECT g, NULL, NULL, n FROM total WHERE n <= {_GROUP_CAP}
    """,
)
def r1_split_whole(spark: SparkSession, sf: str) -> DataFrame:
    """Layout U: a group that fits is searched without price limits, so it has its unpriced rows too."""
    return R.split_ranges(_gaps(spark, sf), F.col("price"), *R.PRICE_RANGE_U, _GROUP_CAP, by=["l_suppkey"], whole=True)


@query(
    "r1_outside",
    f"WITH {_SQL_GAPS} SELECT g, count(*) - count(price) AS n_missing, count(price) AS n_outside FROM gaps "
    "WHERE price IS NULL OR price NOT BETWEEN 0 AND 10000000 GROUP BY g",
)
def r1_outside(spark: SparkSession, sf: str) -> DataFrame:
    return R.outside_root(_gaps(spark, sf), F.col("price"), *R.PRICE_RANGE_U, by=["g"])


@query(
    "r2_split2_rest",
    f"""
    WITH RECURSIVE {_SQL_GAPS},
    h1 AS (SELECT coalesce(g, '') AS g, quantity AS v, count(*) AS n FROM gaps GROUP BY 1, 2),
    {_sql_split("t1", "h1", R.PRICE_RANGE_S, CAP_S)},
    cell AS (SELECT g, lo, hi, n FROM t1 WHERE lo = hi AND n > {CAP_S}),
    h2 AS (SELECT coalesce(g, '') || '/' || quantity AS g, price AS v, count(*) AS n FROM gaps
           WHERE price BETWEEN 0 AND 10000000 AND (coalesce(g, ''), quantity) IN (SELECT (g, lo) FROM cell) GROUP BY 1, 2),
    {_sql_split("t2", "h2", R.MILEAGE_RANGE_S, CAP_S)},
    deep AS (SELECT split_part(g, '/', 1) AS g, CAST(split_part(g, '/', 2) AS BIGINT) AS q, lo, hi, n
             FROM t2 WHERE n <= {CAP_S} OR lo = hi),
    rest AS (SELECT cell.g, cell.lo, cell.n - coalesce(sum(deep.n), 0) AS n FROM cell LEFT JOIN deep ON deep.g = cell.g AND deep.q = cell.lo
             GROUP BY cell.g, cell.lo, cell.n)
    SELECT nullif(g, '') AS g, lo, hi, CAST(NULL AS BIGINT) AS lo2, CAST(NULL AS BIGINT) AS hi2, n, 0 AS outside FROM t1 WHERE n <= {CAP_S}
    UNION ALL SELECT nullif(g, ''), q, q, lo, hi, n, 0 FROM deep
    UNION ALL SELECT nullif(g, ''), lo, lo, NULL, NULL, CAST(n AS BIGINT), 1 FROM rest WHERE n > 0
    """,
)
def r2_split2_rest(spark: SparkSession, sf: str) -> DataFrame:
    cells = R.split_two(
        _gaps(spark, sf), F.col("quantity"), F.col("price"), R.PRICE_RANGE_S, R.MILEAGE_RANGE_S, CAP_S, by=["g"]
    )
    return cells.withColumn("outside", F.col("outside").cast("int"))


_LINE = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]


@query(
    "r3_cap",
    f"""
    SELECT CAST(l_quantity AS BIGINT) AS price, l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (
        SELECT *, row_number() OVER (PARTITION BY l_quantity ORDER BY {", ".join(_LINE)}) AS r FROM lineitem)
    WHERE r <= {CAP_S}
    """,
)
def r3_cap(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "lineitem").select(whole("l_quantity").alias("price"), *_LINE)
    return R.cap_cells(rows, ["price"], _LINE, CAP_S).select("price", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query(
    "r3_cap_u",
    f"""
    SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (
        SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY {", ".join(_LINE)}) AS r FROM lineitem)
    WHERE r <= {CAP_U}
    """,
)
def r3_cap_u(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "lineitem").select("l_returnflag", *_LINE)
    kept = R.cap_cells(rows, ["l_returnflag"], _LINE, CAP_U)
    return kept.select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query(
    "r3_left_out",
    f"""
    SELECT CAST(l_quantity AS BIGINT) AS price, count(*) AS n, count(*) - {CAP_S} AS left_out
    FROM lineitem GROUP BY 1 HAVING count(*) > {CAP_S}
    """,
)
def r3_left_out(spark: SparkSession, sf: str) -> DataFrame:
    return R.overflow_rows(read(spark, sf, "lineitem").select(whole("l_quantity").alias("price")), ["price"], CAP_S)


@query(
    "a2_counts",
    f"""
    WITH RECURSIVE hist AS (SELECT 0 AS g, CAST(floor(o_totalprice) AS BIGINT) AS v, count(*) AS n FROM orders GROUP BY v),
    {_sql_split("t", "hist", R.PRICE_RANGE_S, CAP_S)},
    leaf AS (SELECT lo, hi FROM t WHERE n <= {CAP_S} OR lo = hi),
    lines AS (SELECT CAST(floor(l_extendedprice) AS BIGINT) AS v, count(*) AS n FROM lineitem GROUP BY v)
    SELECT lo, hi, CAST(coalesce(sum(n), 0) AS BIGINT) AS n
    FROM leaf LEFT JOIN lines ON v BETWEEN lo AND hi GROUP BY lo, hi
    """,
)
def a2_counts(spark: SparkSession, sf: str) -> DataFrame:
    ranges = R.split_ranges(read(spark, sf, "orders"), F.col("o_totalprice"), *R.PRICE_RANGE_S, CAP_S)
    return R.count_by_range(read(spark, sf, "lineitem"), F.col("l_extendedprice"), ranges, *R.PRICE_RANGE_S)


@query(
    "a2_counts_any",
    f"""
    WITH {_SQL_GAPS},
    hist AS (SELECT g, price AS v, count(*) AS n FROM gaps WHERE price BETWEEN 0 AND 10000000 GROUP BY 1, 2),
    ranges AS (SELECT nullif(o_orderstatus, 'P') AS g, CAST(floor(o_totalprice / 10) AS BIGINT) - 50 AS lo,
                      max(CAST(floor(o_totalprice / 5) AS BIGINT)) AS hi FROM orders GROUP BY 1, 2)
    SELECT r.g, lo, hi, CAST(coalesce(sum(n), 0) AS BIGINT) AS n
    FROM ranges AS r LEFT JOIN hist AS h ON r.g IS NOT DISTINCT FROM CASE h.g WHEN 'N' THEN 'O' WHEN 'R' THEN 'F' END AND v BETWEEN lo AND hi
    GROUP BY r.g, lo, hi
    """,
)
def a2_counts_any(spark: SparkSession, sf: str) -> DataFrame:
    """Ranges that are no cells of a split, overlap and cross the root."""
    rows = _gaps(spark, sf).withColumn("g", F.when(F.col("g") == "N", "O").when(F.col("g") == "R", "F"))
    ranges = read(spark, sf, "orders").groupBy(
        F.expr("nullif(o_orderstatus, 'P')").alias("g"), (F.floor(F.col("o_totalprice") / 10).cast("bigint") - 50).alias("lo")
    ).agg(F.max(F.floor(F.col("o_totalprice") / 5).cast("bigint")).alias("hi"))
    return R.count_by_range(rows, F.col("price"), ranges, *R.PRICE_RANGE_U, by=["g"])


@query(
    "a4_overflow",
    f"""
    SELECT l_returnflag AS brand, l_linestatus AS model, CAST(l_quantity AS BIGINT) AS price, count(*) AS quantity
    FROM lineitem GROUP BY ALL HAVING count(*) > 150
    """,
)
def a4_overflow(spark: SparkSession, sf: str) -> DataFrame:
    by = ["l_returnflag", "l_linestatus"]
    cells = R.split_ranges(read(spark, sf, "lineitem"), F.col("l_quantity"), *R.PRICE_RANGE_S, 150, by=by)
    return R.overflow_report(cells, 150).select(
        F.col("l_returnflag").alias("brand"),
        F.col("l_linestatus").alias("model"),
        F.col("lo").alias("price"),
        F.col("n").alias("quantity"),
    )


@query(
    "w2_pages",
    """
    SELECT o_orderstatus, o_orderkey, CAST((r + 19) // 20 AS INTEGER) AS page FROM (
        SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice, o_orderkey) AS r FROM orders)
    WHERE r <= 400
    """,
)
def w2_pages(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "orders").select("o_orderstatus", "o_totalprice", "o_orderkey")
    return R.paginate(rows, ["o_orderstatus"], ["o_totalprice", "o_orderkey"]).select("o_orderstatus", "o_orderkey", "page")


@query(
    "w2_page_requests",
    """
    WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
    SELECT o_custkey, n, CAST(unnest(range(1, least((n + 4) // 5, 3) + 1)) AS INTEGER) AS page FROM c
    """,
)
def w2_page_requests(spark: SparkSession, sf: str) -> DataFrame:
    counts = read(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return R.page_requests(counts, size=5, max_pages=3)


@query(
    "w3_first",
    """
    SELECT user_id, event_id, event_type FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) WHERE r = 1
    """,
)
def w3_first(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    return first_per_key(rows, ["user_id"], ["ts", "event_id"]).drop("ts")


@query("d2_facet", "SELECT DISTINCT event_type AS facet, user_id AS origin_link FROM events")
def d2_facet(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "events").select(F.col("event_type").alias("facet"), F.col("user_id").alias("origin_link"))
    return dedupe_in(rows, "facet", "origin_link")


@query(
    "d3_run",
    """
    SELECT run, origin_link, event_id FROM (
        SELECT CAST(day(ts) AS INTEGER) AS run, user_id AS origin_link, event_id,
               row_number() OVER (PARTITION BY day(ts), user_id ORDER BY ts, event_id) AS r FROM events) WHERE r = 1
    """,
)
def d3_run(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "events").select(
        F.dayofmonth("ts").alias("run"), F.col("user_id").alias("origin_link"), "ts", "event_id"
    )
    return dedupe_run(rows, "origin_link", ["ts", "event_id"], run="run").drop("ts")
