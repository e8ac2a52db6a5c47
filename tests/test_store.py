"""The stored table: bounded however many batches, pruned by bucket, merged in place of its buckets, switched at once."""

import re

import pytest
from pyspark.sql import functions as F, types as T

from lotledger.operators.merge import MANDATORY, Run, bad_fields, merge_run, stamp_run
from lotledger.schema import LISTING
from lotledger.session import scratch_dir
from lotledger.sources.store import Store
from lotledger.streaming.ingest import current, ingest_batch

SCHEMA = "origin_link string, sales_price_incl_vat bigint, colour string"
FULL = T.StructType([*(T.StructField(c, LISTING[c].dataType) for c in ("origin_link", "sales_price_incl_vat", "colour")), *LISTING.fields[-3:]])
RUN = Run("S", 1, "2018-03-09")


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def state(df):
    return sorted(tuple(r) for r in df.select("origin_link", "sales_price_incl_vat", "colour", "iteration_id", "is_synced", F.col("parse_date").cast("string")).collect())


def new_store(spark, rows=200, **options):
    store = Store(spark, scratch_dir(spark, "store"), FULL, **options)
    store.publish(stamp_run(frame(spark, [(f"l{i}", i, "rot") for i in range(rows)]), RUN), RUN, [])
    return store


def test_many_batches_stay_bounded(spark):
    store = Store(spark, scratch_dir(spark, "store"), FULL, buckets=4, fold_after=8)
    meta = stamp_run(frame(spark, [("x", 1, None)]), RUN).select("origin_link", "iteration_id", "parse_date")
    for i in range(40):
        m = store.manifest()
        inserted = stamp_run(frame(spark, [(f"l{i}", i, "rot" if i else None)]), RUN).coalesce(1)
        touched = meta.withColumn("origin_link", F.lit("l0")).withColumn("parse_date", F.lit(f"2018-04-{i % 28 + 1:02d}").cast("date"))
        before = state(store.rows(m)) if i % 20 == 7 else None
        m = store.add(inserted, touched, 1, RUN, i, m)
        if before:
            assert len(state(store.rows())) == len(before) + 1
        assert len(m.inserts) < 8 and len(m.touches) < 8
    folders = [s.getPath().getName() for f in ("log", "base") for s in store._files.listStatus(store._path(f"{store.root}/{f}"))]
    # Two kept manifests at most name a log of `fold_after` batches (two folders each) and a base.
    assert len(folders) <= 2 * (2 * 8 + 1) and len(store.versions()) <= 10
    rows = state(store.rows())
    assert len(rows) == 40 and rows[0] == ("l0", 0, None, 1, 0, "2018-04-28")
    assert m.state.attempted == 40 and m.state.filled["colour"] == 39 and m.state.filled["mileage"] == 0


def test_replay_before_and_after_a_fold(spark):
    path, detail = scratch_dir(spark, "store"), None
    parts = [[("a", 1, "x"), ("b", None, "x")], [("a", 5, "x"), ("b", 2, "x")], [("c", 3, None)]]
    for i, part in enumerate(parts):
        for _ in range(2):
            ingest_batch(frame(spark, part), i, path, RUN, ["colour"], detail, fold_after=2)
    want = [("a", 1, "x", 1, 0, "2018-03-09"), ("b", 2, "x", 1, 0, "2018-03-09"), ("c", 3, None, 1, 0, "2018-03-09")]
    assert state(current(spark, path, FULL)) == want
    store = Store(spark, path, FULL)
    store.fold()
    for i, part in enumerate(parts):
        ingest_batch(frame(spark, part), i, path, RUN, ["colour"], detail, fold_after=2)
    assert state(current(spark, path, FULL)) == want
    store.close(RUN)
    with pytest.raises(ValueError, match="closed"):
        ingest_batch(frame(spark, parts[0]), 3, path, RUN, ["colour"])
    ingest_batch(frame(spark, [("a", 9, "y")]), 0, path, Run("S", 2, "2018-03-10"), ["colour"])
    assert state(current(spark, path, FULL))[0] == ("a", 1, "x", 2, 0, "2018-03-10")


def test_streamed_run_closes_like_a_batch_run(spark):
    cases = [[], [("a", None, "x")], [("a", 1, None), ("b", 2, None)], [("a", 1, None), ("b", 2, "x"), ("c", None, "x"), ("a", 3, "x")]]
    for number, rows in enumerate(cases, 1):
        run, path = Run("S", number, "2018-03-09"), scratch_dir(spark, "store")
        for i, r in enumerate(rows):
            ingest_batch(frame(spark, [r]), i, path, run, ["colour"])
        store = Store(spark, path, FULL)
        store.close(run)
        firsts = {}
        for link, price, colour in rows:
            if link not in firsts or firsts[link][1] is None:
                firsts[link] = (link, price, colour)
        want = bad_fields(frame(spark, list(firsts.values())), F.col("sales_price_incl_vat").isNotNull()).first()["bad_fields"]
        got = store.control("S").first()
        assert (got.iteration_id, sorted(got.bad_fields)) == (number, sorted(want))


def test_lookup_opens_the_batch_buckets_only(spark):
    store = new_store(spark, buckets=8)
    m = store.manifest()
    assert len({re.search(r"_(\d{5})\.c", f)[1] for f in m.files}) == 8
    batch = frame(spark, [("l7", 1, "x"), ("l7", 2, "x")])
    wanted = batch.select(store.bucket(m)).first()[0]
    opened = store.keys_of(batch, m).inputFiles()
    assert opened and all(f"_{wanted:05d}.c" in f for f in opened)
    assert {r[0] for r in store.keys_of(batch, m).collect()} >= {"l7"}
    every = frame(spark, [(f"l{i}", 1, "x") for i in range(200)] + [("new", 1, "x")])
    assert {r[0] for r in store.keys_of(every, m).collect()} == {f"l{i}" for i in range(200)}


def test_merge_leaves_stored_rows_in_their_buckets(spark):
    store = new_store(spark)
    batch = frame(spark, [(f"l{i}", i, "blau") for i in range(100, 300)])
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = merge_run(store.rows(), batch, Run("S", 2, "2018-03-10"))._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        scans = [k for k, x in enumerate(lines) if "FileScan parquet" in x]
        assert len(scans) == 2
        for k in scans:
            depth, above = len(re.match(r"\W*", lines[k])[0]), []
            for x in reversed(lines[:k]):
                if (d := len(re.match(r"\W*", x)[0])) < depth:
                    depth = d
                    above.append(x)
                    if "Join" in x:
                        break
            assert "Join" in above[-1] and not any("Exchange" in x for x in above) and "Bucketed: true" in lines[k]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    store.merge(batch, Run("S", 2, "2018-03-10"))
    rows = state(store.rows())
    assert len(rows) == 300 and sum(r[3] == 2 for r in rows) == 200


def test_a_dead_job_changes_nothing(spark, monkeypatch):
    store = new_store(spark)
    before, last = state(store.rows()), store.control("S").collect()

    def die(_):
        raise OSError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(store, "commit", die)
        for job in (lambda: store.merge(frame(spark, [("z", 1, "x")]), Run("S", 2, "2018-03-10")), lambda: store.close(Run("S", 2, "2018-03-10"))):
            with pytest.raises(OSError):
                job()
    assert state(store.rows()) == before and store.control("S").collect() == last
    store.merge(frame(spark, [("z", 1, "x")]), Run("S", 2, "2018-03-10"), ["make"])
    assert len(state(store.rows())) == len(before) + 1
    assert [tuple(r) for r in store.control("S").collect()] == [("S", 2, ["make"])]
    assert state(store.rows(store.manifest(1))) == before


def test_the_second_of_two_jobs_fails(spark):
    store = new_store(spark)
    m = store.manifest()
    store.publish(store.rows(m), Run("S", 2, "2018-03-10"), [], m)
    with pytest.raises(RuntimeError, match="another job"):
        store.publish(store.rows(m), Run("S", 2, "2018-03-10"), [], m)


def test_merge_takes_repeated_links_once(spark):
    table = stamp_run(frame(spark, [("a", 5, "x")]), RUN)
    batch = frame(spark, [("a", 9, "p"), ("a", 7, "q"), ("b", 4, "r"), ("b", 3, "s"), ("c", None, "t")])
    out = state(merge_run(table, batch, Run("S", 2, "2018-03-10"), change_price=True))
    assert out == [("a", 7, "x", 2, 0, "2018-03-10"), ("b", 3, "s", 2, 0, "2018-03-10")]
    assert len(MANDATORY) == 9
