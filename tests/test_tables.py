"""Table cases: catalog, pages, ranges, dedupe, chain, merge, run state."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lotledger.operators import merge as M
from lotledger.operators import ranges as R
from lotledger.operators.catalog import cross_facets, drop_parents
from lotledger.operators.chain import walk_chain
from lotledger.operators.dedupe import dedupe_run, dedupe_url
from lotledger.operators.joins import enrich, split_seen
from lotledger.plans.site_run import newest_capture, run_site
from lotledger.session import scratch_dir
from lotledger.sources import readers, writers

RUN = M.Run("S", 2, "2018-03-09")
NBSP2 = "\N{NO-BREAK SPACE}" * 2


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Ranges


def halved(values, lo, hi, cap):
    """The halving, one range at a time."""
    inside = [v for v in values if lo <= v <= hi]
    if not inside:
        return []
    if len(inside) <= cap or lo == hi:
        return [(lo, hi, len(inside))]
    mid = lo + (hi - lo) // 2
    return halved(inside, lo, mid, cap) + halved(inside, mid + 1, hi, cap)


@pytest.mark.parametrize(
    "values,lo,hi,cap",
    [
        ([0, 1, 2, 3, 4], 0, 4, 2),
        ([7] * 5, 0, 15, 2),
        ([3], 3, 3, 5),
        ([3, 3], 3, 3, 1),
        ([1, 2], 0, 100, 2),
        ([-5, -1, 200, 3, 3, 3], 0, 100, 2),
        ([-5, -4, -4, -1], -7, -1, 1),
    ],
)
def test_split_small(spark, values, lo, hi, cap):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    assert rows(R.split_ranges(df, F.col("x"), lo, hi, cap)) == sorted(halved(values, lo, hi, cap), key=repr)


@pytest.mark.parametrize("band", [1, 10, 40])
def test_split_random(spark, band):
    rng = random.Random(band)
    groups = {}
    for g in ["a", "b", None]:
        hot = rng.randrange(10**6)
        groups[g] = [rng.choice([hot, rng.randrange(2000), rng.randrange(10**6)]) for _ in range(400)]
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, x bigint")
    hist = R.histogram(df, F.col("x"), 0, 999_999, ["g"])
    got = rows(R.split_counts(hist, 0, 999_999, 7, ["g"], band=band))
    want = [(g, *cell) for g, vs in groups.items() for cell in halved(vs, 0, 999_999, 7)]
    assert got == sorted(want, key=repr)


def test_split_empty(spark):
    df = spark.createDataFrame([], "x int")
    assert rows(R.split_ranges(df, F.col("x"), 0, 9, 2)) == []


def test_split_two_levels(spark):
    rng = random.Random(3)
    data = [(rng.choice([5, 5, 5, rng.randrange(50)]), rng.choice([10, rng.randrange(1000)])) for _ in range(500)]
    want = []
    for lo, hi, n in halved([p for p, _ in data], 0, 63, 20):
        if lo == hi and n > 20:
            deep = halved([m for p, m in data if p == lo], 0, 1023, 20)
            want += [(lo, hi, lo2, hi2, k) for lo2, hi2, k in deep]
        else:
            want.append((lo, hi, None, None, n))
    df = spark.createDataFrame(data, "p int, m int")
    got = rows(R.split_two(df, F.col("p"), F.col("m"), (0, 63), (0, 1023), 20).drop("outside"))
    assert got == sorted(want, key=repr)


def test_split_loses_no_row(spark):
    rng = random.Random(5)
    data = [
        (rng.choice(["a", None]), rng.choice([None, -1, 7, 7, 7, rng.randrange(64), 99]), rng.choice([None, -3, 2, rng.randrange(16), 50]))
        for _ in range(600)
    ]
    df = spark.createDataFrame(data, "g string, p int, m int")
    outside = {r.g: (r.n_missing, r.n_outside) for r in R.outside_root(df, F.col("p"), 0, 63, ["g"]).collect()}
    cells = R.split_two(df, F.col("p"), F.col("m"), (0, 63), (0, 15), 20, ["g"]).collect()
    once = R.split_ranges(df, F.col("p"), 0, 63, 20, ["g"]).collect()
    for g in ("a", None):
        own = [(p, m) for k, p, m in data if k == g]
        assert outside[g] == (sum(p is None for p, _ in own), sum(p in (-1, 99) for p, _ in own))
        for out in (cells, once):
            assert sum(r.n for r in out if r.g == g) + sum(outside[g]) == len(own)
        rest = [r for r in cells if r.g == g and r.outside and r.lo == 7]
        assert [r.n for r in rest] == [sum(p == 7 and (m is None or not 0 <= m <= 15) for p, m in own)]


def test_split_takes_a_group_that_fits_whole(spark):
    data = [("few", None), ("few", 3), ("few", 99), (None, None), (None, 1)] + [("many", v) for v in [None, 99, 0, 1, 2, 3]]
    df = spark.createDataFrame(data, "g string, x int")
    got = rows(R.split_ranges(df, F.col("x"), 0, 3, 3, ["g"], whole=True))
    assert got == sorted([("few", None, None, 3), (None, None, None, 2), ("many", 0, 1, 2), ("many", 2, 3, 2)], key=repr)
    one = rows(R.split_ranges(df.where("g = 'few'").drop("g"), F.col("x"), 0, 3, 3, whole=True))
    assert one == [(None, None, 3)]


@pytest.mark.parametrize("lo,hi", [(0, 15), (-3, 40), (5, 5)])
def test_count_by_any_range(spark, lo, hi):
    rng = random.Random(hi)
    data = [(rng.choice(["a", None, "b"]), rng.choice([None, rng.randrange(-10, 60)])) for _ in range(300)]
    wanted = [(g, a, b) for g in ("a", None, "z") for a in (None, -50, -3, 0, 3, 5, 44) for b in (None, -9, 2, 5, 12, 39, 70)]
    df = spark.createDataFrame(data, "g string, x int")
    ranges = spark.createDataFrame(wanted + wanted[:2], "g string, lo bigint, hi bigint")

    def count(g, a, b):
        a, b = lo if a is None else a, hi if b is None else b
        return sum(k == g and x is not None and max(a, lo) <= x <= min(b, hi) for k, x in data)

    got = rows(R.count_by_range(df, F.col("x"), ranges, lo, hi, ["g"]))
    assert got == sorted([(*w, count(*w)) for w in wanted + wanted[:2]], key=repr)


def test_overflow(spark):
    df = spark.createDataFrame([(7,)] * 5 + [(1,)], "x int")
    cells = R.split_ranges(df, F.col("x"), 0, 15, 2)
    assert rows(R.overflow_report(cells, 2)) == [(7, 7, 5)]


def test_count_by_range(spark):
    a = spark.createDataFrame([(v,) for v in [0, 1, 2, 3, 4, 9]], "x int")
    b = spark.createDataFrame([(v,) for v in [0, 0, 2, 3, 3, 8, 99]], "x int")
    ranges = R.split_ranges(a, F.col("x"), 0, 9, 2)
    got = rows(R.count_by_range(b, F.col("x"), ranges, 0, 9))
    assert got == sorted(
        ((lo, hi, sum(lo <= v <= hi for v in [0, 0, 2, 3, 3, 8])) for lo, hi, _ in halved([0, 1, 2, 3, 4, 9], 0, 9, 2)), key=repr
    )


def test_pages_of_a_cell(spark):
    df = spark.range(401).select(F.lit("c").alias("cell"), F.col("id"))
    pages = Counter(r.page for r in R.paginate(df, ["cell"], ["id"]).collect())
    assert pages == {p: 20 for p in range(1, 21)}
    assert rows(R.overflow_rows(df, ["cell"], 400)) == [("c", 401, 1)]


@pytest.mark.parametrize("salts", [1, 8])
def test_rank_is_exact_with_salts(spark, salts):
    df = spark.range(1000).select((F.col("id") % 3 == 0).cast("int").alias("cell"), F.col("id"))
    got = {(r.cell, r.id, r.rank) for r in R.ranked(df, ["cell"], ["id"], 50, salts=salts).collect()}
    hot = [i for i in range(1000) if i % 3]
    cold = [i for i in range(1000) if not i % 3]
    assert got == {(0, v, k + 1) for k, v in enumerate(hot[:50])} | {(1, v, k + 1) for k, v in enumerate(cold[:50])}


def test_page_requests(spark):
    df = spark.createDataFrame([("a", 0), ("b", 41), ("c", 900)], "cell string, n int")
    got = Counter(r.cell for r in R.page_requests(df).collect())
    assert got == {"b": 3, "c": 20}


# Catalog, dedupe, chain


def test_drop_parents(spark):
    names = ["Golf", NBSP2 + "Golf I", NBSP2 + "Golf II", "Polo"]
    df = spark.createDataFrame([("vw", i, n) for i, n in enumerate(names)], "brand_key string, pos int, value string")
    assert [r.value for r in drop_parents(df).orderBy("pos").collect()] == ["Golf I", "Golf II", "Polo"]


def test_cross_facets(spark):
    df = spark.createDataFrame([("m",), ("n",)], "model string")
    out = cross_facets(df, {"body": F.array(F.lit("x"), F.lit("y")), "colour": F.array(F.lit("r"))})
    assert rows(out) == [("m", "x", "r"), ("m", "y", "r"), ("n", "x", "r"), ("n", "y", "r")]


@pytest.mark.parametrize("parts", [1, 5])
def test_dedupe_url(spark, parts):
    urls = ["https://h/u?x=1", "https://h/u?x=2", "https://h/search?p=1", "https://h/search?p=2"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string").repartition(parts)
    out = dedupe_url(df, exempt=F.col("url").contains("/search"))
    assert [r.page_id for r in out.orderBy("page_id").collect()] == [0, 2, 3]


def test_chain(spark):
    def walk(edges, seeds):
        pages = spark.createDataFrame(edges, "url string, next_url string")
        starts = spark.createDataFrame([(s,) for s in seeds], "url string")
        return {r.url: r.step for r in walk_chain(pages, starts).collect()}

    assert walk([("a", "b"), ("b", "c"), ("c", None), ("z", "a")], ["a"]) == {"a": 0, "b": 1, "c": 2}
    assert walk([("x", "y"), ("y", "x")], ["x"]) == {"x": 0, "y": 1}
    # Many pages point at one, and two seeds share a tail.
    edges = [(f"n{i}", "hub") for i in range(30)] + [("hub", "t1"), ("t1", "t2"), ("t2", "hub"), ("s", "n3")]
    assert walk(edges, ["s", "n7"]) == {"s": 0, "n3": 1, "n7": 0, "hub": 1, "t1": 2, "t2": 3}
    # A page that was captured twice, with different next links, has one of them.
    assert walk([("a", "c"), ("a", "b"), ("a", "b"), ("b", "d")], ["a"]) == {"a": 0, "b": 1, "d": 2}
    long = [(f"p{i}", f"p{i + 1}") for i in range(37)]
    assert walk(long, ["p0"]) == {f"p{i}": i for i in range(38)}
    # Long chains that meet past the first steps, a long cycle, and no seed.
    meet = [*long, *[(f"q{i}", f"q{i + 1}") for i in range(9)], ("q9", "p20")]
    want = {f"p{i}": i for i in range(30)} | {f"q{i}": i for i in range(10)} | {f"p{i}": min(i, 10 + i - 20) for i in range(20, 38)}
    assert walk(meet, ["p0", "q0"]) == want
    assert walk([(f"c{i}", f"c{(i + 1) % 11}") for i in range(11)], ["c4"]) == {f"c{(4 + i) % 11}": i for i in range(11)}
    assert walk(long, []) == {}


def test_chain_of_one_seed_shuffles_no_links(spark):
    """One frontier page over 150,000 links: the links are read where they lie, and only what was reached moves."""
    from lotledger.operators.chain import _hop
    from lotledger.session import scratch_dir, written

    links = written(spark.range(150_000).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst")), scratch_dir(spark, "links"))
    front = written(spark.range(7, 8).select(F.col("id").alias("url")), scratch_dir(spark, "front"))
    step = _hop(front, links)
    assert [r.url for r in step.collect()] == [8]
    plan = step._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    join = plan.index("BroadcastHashJoin")
    assert "Exchange hashpartitioning" not in plan[join:]


# Merge and run state


def table(spark, *links, price=10):
    data = [(k, price, 1, 1, "2018-01-01") for k in links]
    df = spark.createDataFrame(data, "origin_link string, sales_price_incl_vat bigint, iteration_id bigint, is_synced int, parse_date string")
    return df.withColumn("parse_date", F.col("parse_date").cast("date"))


def batch(spark, *items):
    return spark.createDataFrame(list(items), "origin_link string, sales_price_incl_vat bigint")


def state(df):
    return {
        r.origin_link: (r.sales_price_incl_vat, r.iteration_id, r.is_synced, str(r.parse_date)) for r in df.collect()
    }


OLD, NEW = "2018-01-01", "2018-03-09"


def test_merge(spark):
    out = M.merge_run(table(spark, "a", "b"), batch(spark, ("b", 99), ("c", 5)), RUN)
    want = {"a": (10, 1, 1, OLD), "b": (10, 2, 1, NEW), "c": (5, 2, 0, NEW)}
    assert state(out) == want
    # A rerun of the same batch over its own result changes nothing.
    assert state(M.merge_run(out, batch(spark, ("b", 99), ("c", 5)), RUN)) == want


def test_merge_with_price_change(spark):
    out = M.merge_run(table(spark, "a", "b", "d"), batch(spark, ("a", 10), ("b", 99), ("d", None), ("e", None)), RUN, change_price=True)
    assert state(out) == {"a": (10, 2, 1, NEW), "b": (99, 2, 0, NEW), "d": (10, 1, 1, OLD)}


def test_merge_keeps_one_row_per_link(spark):
    twice = spark.createDataFrame([("c", 7, 2), ("c", 5, 1)], "origin_link string, sales_price_incl_vat bigint, at int")
    out = M.merge_run(table(spark, "a"), dedupe_run(twice, "origin_link", ["at"]).drop("at"), RUN)
    assert state(out) == {"a": (10, 1, 1, OLD), "c": (5, 2, 0, NEW)}


def test_touch_insert_update(spark):
    stored, incoming = table(spark, "a", "b"), batch(spark, ("b", 99), ("c", 5))
    assert state(M.touch(stored, incoming, RUN)) == {"a": (10, 1, 1, OLD), "b": (10, 2, 1, NEW)}
    assert state(M.insert_new(incoming, stored, RUN)) == {"c": (5, 2, 0, NEW)}
    assert state(M.update_price(stored, incoming, RUN)) == {"a": (10, 1, 1, OLD), "b": (99, 2, 0, NEW)}
    seen, new = split_seen(incoming, stored)
    assert rows(seen) == [("b", 99)] and rows(new) == [("c", 5)]


def test_outcome(spark):
    detail = spark.createDataFrame(
        [("gone", 410, "m", "EUR"), ("cur", 200, "m", None), ("free", 200, "m", "EUR"), ("ok", 200, "m", "EUR"), ("part", 200, None, "EUR")],
        "origin_link string, status int, make string, currency string",
    )
    items = batch(spark, ("gone", 1), ("cur", 1), ("free", None), ("ok", 1), ("part", 1), ("lost", 1), ("a", 1), ("b", None))
    got = {r.origin_link: r.information for r in M.outcome(items, table(spark, "a", "b"), detail, ["make"]).collect()}
    assert got == {
        "gone": "Car was sold",
        "cur": "Invalid response",
        "free": "Car hasn't price",
        "ok": "inserted",
        "part": "Car will parse again",
        "lost": "Car will parse again",
        "a": "Already in database",
        "b": None,
    }


def test_bad_fields(spark):
    def bad(data):
        df = spark.createDataFrame(data, "stored boolean, mileage int, colour string")
        return M.bad_fields(df, F.col("stored"), ["mileage", "colour"]).first()["bad_fields"]

    assert bad([(True, None, "x"), (True, None, None)]) == ["mileage"]
    assert bad([]) == []
    assert bad([(False, 1, "x")]) == ["mileage", "colour"]
    assert M.bad_fields(spark.createDataFrame([(1,)], "k int"), F.lit(False)).first()["bad_fields"] == list(M.MANDATORY)


def test_enrich_takes_only_facets(spark):
    shallow = spark.createDataFrame([("a", "rot", "Van", 1)], "origin_link string, colour string, body_type string, price int")
    detail = spark.createDataFrame([("a", "x", 2)], "origin_link string, colour string, price int")
    assert enrich(shallow, detail).first().asDict() == {"origin_link": "a", "price": 2, "colour": "rot", "body_type": "Van"}


def test_run_counter(spark):
    path = scratch_dir(spark, "control")
    bad = spark.createDataFrame([(["colour"],)], "bad_fields array<string>")
    for run in (M.Run("S", 1, NEW), M.Run("U", 4, NEW), M.Run("S", 2, NEW)):
        writers.save_run(M.control_row(bad, run), path)
    control = readers.read_control(spark, path)
    assert rows(control) == [("S", 2, ["colour"]), ("U", 4, ["colour"])]
    assert rows(M.next_iteration(control, "S")) == [("S", 3)] and rows(M.next_iteration(control, "A")) == [("A", 1)]


def test_site_run(spark):
    stored = table(spark, "a", "b").withColumns({"make": F.lit("m"), "currency": F.lit("EUR"), "site": F.lit("S")})
    shallow = spark.createDataFrame(
        [("b", 7, 1), ("c", 5, 2), ("c", 6, 1), ("d", 5, 1), ("e", 5, 1), ("f", None, 1)],
        "origin_link string, sales_price_incl_vat bigint, at int",
    )
    detail = spark.createDataFrame(
        [("c", 55, "", "EUR", 200), ("d", 1, "x", None, 200), ("e", 1, "x", "EUR", 410), ("f", 1, "x", "EUR", 200)],
        "origin_link string, sales_price_incl_vat bigint, make string, currency string, status int",
    )
    result = run_site(shallow, detail, stored, RUN, order=["at"])
    assert state(result.table) == {"a": (10, 1, 1, OLD), "b": (10, 2, 1, NEW), "c": (55, 2, 0, NEW)}
    assert {r.origin_link: r.make for r in result.table.collect()} == {"a": "m", "b": "m", "c": None}
    assert rows(result.rejects) == [("d", "Invalid response"), ("e", "Car was sold"), ("f", "Car hasn't price")]
    control = result.control.first()
    assert control.iteration_id == 2 and "make" in control.bad_fields and "currency" not in control.bad_fields


def test_site_run_keeps_to_its_site_and_loses_no_item(spark):
    stored = table(spark, "a", "b").withColumns(
        {"make": F.lit("m"), "currency": F.lit("EUR"), "site": F.when(F.col("origin_link") == "a", "U").otherwise("S")}
    )
    shallow = spark.createDataFrame(
        [("a", 3, 1), ("b", 7, 1), ("c", None, 1), ("c", 5, 2), ("d", 9, 1), ("e", None, 1), ("f", 4, 1)],
        "origin_link string, sales_price_incl_vat bigint, at int",
    )
    # The detail price may be absent where the shallow one is not, and the other way round.
    detail = spark.createDataFrame(
        [("a", 30, "x", "EUR", 200), ("c", None, "x", "EUR", 200), ("d", 1, "x", "EUR", 503), ("d", 90, "y", "EUR", 200), ("e", 50, "x", "EUR", 200)],
        "origin_link string, sales_price_incl_vat bigint, make string, currency string, status int",
    )
    result = run_site(shallow, detail, stored, RUN, order=["at"])
    assert state(result.table) == {"a": (30, 2, 0, NEW), "b": (10, 2, 1, NEW), "c": (None, 2, 0, NEW), "d": (90, 2, 0, NEW)}
    assert {r.site for r in result.table.collect()} == {"S"}
    assert rows(result.rejects) == [("e", "Car hasn't price"), ("f", "Car will parse again")]
    assert result.outcomes.count() == 6 == 3 + 1 + result.rejects.count()


def test_versions(spark):
    path = scratch_dir(spark, "versions")
    df = table(spark, "a").withColumn("site", F.lit("S"))
    first = writers.write_version(df, path, 1)
    merged = M.merge_run(spark.read.parquet(first), batch(spark, ("b", 1)), RUN)
    second = writers.write_version(merged.fillna("S", ["site"]), path, 2)
    assert state(spark.read.parquet(second)).keys() == {"a", "b"} and state(spark.read.parquet(first)).keys() == {"a"}


def test_the_newest_good_capture_counts(spark):
    schema = "origin_link string, sales_price_incl_vat bigint, colour string, status int, fetched_at timestamp, page_id bigint"
    rows = [
        ("a", 90, "old", 200, 1, 1), ("a", 120, "new", 200, 2, 2), ("a", 80, "failed", 500, 3, 3), ("a", None, "no price", 200, 4, 4),
        ("b", 5, "x", 200, None, 1), ("b", 6, "y", 200, None, 2), ("b", 7, "timed", 200, 1, 0),
        ("c", 5, "p", 200, 1, 1), ("c", 4, "q", 200, 1, 1), ("d", None, "", 410, 1, 1),
    ]
    made = spark.createDataFrame([(*r[:4], r[4], r[5]) for r in rows], schema.replace("timestamp", "int"))
    made = made.withColumn("fetched_at", F.timestamp_seconds("fetched_at"))
    for df in (made, made.repartition(7, "colour"), made.orderBy(F.col("colour").desc())):
        got = newest_capture(df)
        assert got.columns == ["origin_link", "sales_price_incl_vat", "colour", "status"]
        assert sorted(map(tuple, got.collect())) == [("a", 120, "new", 200), ("b", 7, "timed", 200), ("c", 4, "q", 200), ("d", None, None, 410)]
