"""Streams give the batch answer, and a replay changes nothing."""

from pyspark.sql import functions as F

from lotledger.operators.merge import Run
from lotledger.schema import LISTING
from lotledger.session import scratch_dir
from lotledger.sources.readers import captures_stream, read_alerts
from lotledger.streaming.alerts import alert_batch, alert_stream, alerts
from lotledger.streaming.ingest import current, ingest, ingest_batch
from lotledger.streaming.seen import seen_once

SCHEMA = "origin_link string, sales_price_incl_vat bigint, at int"


def chunks(spark, *parts):
    path = scratch_dir(spark, "in")
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return captures_stream(spark, path, spark.createDataFrame([], SCHEMA).schema, 1)


def listing_schema(stream):
    from pyspark.sql import types as T

    return T.StructType([*stream.schema.fields, *LISTING.fields[-3:]])


def state(df):
    return {r.origin_link: (r.sales_price_incl_vat, r.iteration_id, r.is_synced, str(r.parse_date)) for r in df.collect()}


def test_ingest_many_batches_and_runs(spark):
    table, checkpoint = scratch_dir(spark, "t"), scratch_dir(spark, "c")
    first = chunks(spark, [("a", 1, 1), ("a", 9, 0), ("n", None, 0)], [("b", 2, 1), ("a", 5, 1)], [("b", 3, 1)])
    ingest(first, table, checkpoint, Run("S", 1, "2018-03-09"), ["at"]).awaitTermination()
    schema = listing_schema(first)
    assert state(current(spark, table, schema)) == {"a": (9, 1, 0, "2018-03-09"), "b": (2, 1, 0, "2018-03-09")}
    second = chunks(spark, [("b", 7, 1), ("c", 7, 1)])
    ingest(second, table, scratch_dir(spark, "c"), Run("S", 2, "2018-03-10"), ["at"]).awaitTermination()
    want = {"a": (9, 1, 0, "2018-03-09"), "b": (2, 2, 0, "2018-03-10"), "c": (7, 2, 0, "2018-03-10")}
    assert state(current(spark, table, schema)) == want


def test_replayed_batch_changes_nothing(spark):
    table, run = scratch_dir(spark, "t"), Run("S", 1, "2018-03-09")
    df = spark.createDataFrame([("a", 1, 1), ("b", 2, 1)], SCHEMA)
    detail = lambda rows: rows.withColumn("make", F.lit("m"))
    for _ in range(2):
        ingest_batch(df, 0, table, run, ["at"], detail)
    got = current(spark, table, listing_schema(detail(df))).collect()
    assert sorted((r.origin_link, r.make) for r in got) == [("a", "m"), ("b", "m")]


def drain(spark, stream):
    path = scratch_dir(spark, "out")
    writer = stream.writeStream.format("parquet").option("checkpointLocation", scratch_dir(spark, "c"))
    writer.option("path", path).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def test_seen_once_over_batches(spark):
    parts = [[("a", i, i) for i in range(20)], [("a", 1, 50), ("b", 2, 51)], [("b", 3, 60), ("c", 1, 61)]]
    for salts in (1, 4):
        out = drain(spark, seen_once(chunks(spark, *parts), "origin_link", salts=salts))
        assert sorted(r.origin_link for r in out.collect()) == ["a", "b", "c"]


def test_alert_stream_is_batch(spark):
    now = "2018-03-09 10:00:00"
    data = [
        (1, 40, "2018-03-09 09:59:00", "edge"),
        (2, 40, "2018-03-09 09:58:59", "old"),
        (3, 20, "2018-03-09 09:59:30", "info"),
        (4, 40, "2018-03-09 09:59:59", "new"),
        (4, 40, "2018-03-09 09:59:59", "new"),
    ]
    logs = spark.createDataFrame(data, "log_id int, level int, ts string, message string")
    logs = logs.withColumn("ts", F.col("ts").cast("timestamp"))
    path, out = scratch_dir(spark, "logs"), scratch_dir(spark, "alerts")
    logs.write.parquet(path)
    alert_stream(captures_stream(spark, path, logs.schema), now, out, scratch_dir(spark, "c")).awaitTermination()
    got = sorted(tuple(r) for r in read_alerts(spark, out, "log_id", "int").select("log_id", "text").collect())
    assert got == sorted({tuple(r) for r in alerts(logs, now).collect()})
    assert [t for _, t in got] == ["2018-03-09 09:59:00\nedge", "2018-03-09 09:59:59\nnew"]


def test_second_poll_and_replay_alert_once(spark):
    """A late error of the second poll, an error sent again, and a batch that is run twice."""

    def logs(*rows):
        df = spark.createDataFrame([(i, level, t, m) for i, level, t, m in rows], "log_id int, level int, ts string, message string")
        return df.withColumn("ts", F.col("ts").cast("timestamp"))

    path, out, checkpoint = scratch_dir(spark, "logs"), scratch_dir(spark, "alerts"), scratch_dir(spark, "c")
    day = "2018-03-09 "
    polls = [
        (day + "10:00:00", logs((1, 40, day + "09:59:30", "a"), (2, 40, day + "09:59:50", "b"), (3, 20, day + "10:00:30", "info"))),
        (day + "10:00:40", logs((2, 40, day + "09:59:50", "b"), (4, 40, day + "09:59:41", "late"), (5, 40, day + "09:59:39", "too late"), (6, 40, day + "10:00:35", "c"))),
    ]
    for now, rows in polls:
        rows.write.mode("append").parquet(path)
        alert_stream(captures_stream(spark, path, rows.schema), now, out, checkpoint).awaitTermination()
    want = [(1, "a", 0), (2, "b", 0), (4, "late", 1), (6, "c", 1)]

    def sent():
        return sorted((r.log_id, r.text.split("\n")[1], r.batch) for r in read_alerts(spark, out, "log_id", "int").collect())

    assert sent() == want
    alert_batch(polls[1][1], 1, polls[1][0], out, "alerts")
    assert sent() == want
