"""Proofs of the streaming jobs: each drains a stream and gives its final table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lotledger.operators.merge import Run
from lotledger.plans.registry import query, read, text, whole
from lotledger.schema import LISTING
from lotledger.session import scratch_dir
from lotledger.sources.readers import captures_stream, read_alerts, table_stream
from lotledger.sources.store import Store
from lotledger.streaming.alerts import alert_batch, alert_stream, alerts
from lotledger.streaming.ingest import current, ingest, ingest_batch
from lotledger.streaming.seen import seen_once

_RUNS = 4
_NOW = "2024-01-20 12:00:00"


def _run_date(run: int) -> str:
    return f"2024-02-0{run}"


_SQL_INGEST = """
    WITH e AS (SELECT *, least(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 8 + 1, 4) AS run FROM events),
         f AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM e),
         m AS (SELECT user_id, max(run) AS run FROM e GROUP BY 1)
    SELECT '/u/' || user_id AS origin_link, CAST(floor(value) AS BIGINT) AS sales_price_incl_vat, run AS iteration_id,
           CAST(0 AS INTEGER) AS is_synced, '2024-02-0' || run AS parse_date
    FROM f JOIN m USING (user_id) WHERE r = 1
"""


def _weeks(spark: SparkSession, sf: str) -> DataFrame:
    """Events as captures, with the run that drains them."""
    days = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    return read(spark, sf, "events").select(
        text("/u/", F.col("user_id")).alias("origin_link"),
        whole("value").alias("sales_price_incl_vat"),
        "ts",
        "event_id",
        F.least(F.floor(days / 8) + 1, F.lit(_RUNS)).alias("run"),
    )


def _listings(now: DataFrame) -> DataFrame:
    return now.select("origin_link", "sales_price_incl_vat", "iteration_id", "is_synced", F.date_format("parse_date", "yyyy-MM-dd").alias("parse_date"))


@query("t1_ingest", _SQL_INGEST)
def t1_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Captures arrive week by week; each run drains what came."""
    events = _weeks(spark, sf)
    incoming, table, checkpoint = (scratch_dir(spark, n) for n in ("incoming", "listings", "checkpoint"))
    rows = events.drop("run")
    for run in range(1, _RUNS + 1):
        events.where(F.col("run") == run).drop("run").write.mode("append").parquet(incoming)
        stream = captures_stream(spark, incoming, rows.schema)
        ingest(stream, table, checkpoint, Run("S", run, _run_date(run)), order=["ts", "event_id"]).awaitTermination()
    schema = T.StructType([*rows.schema.fields, *LISTING.fields[-3:]])
    return _listings(current(spark, table, schema))


@query("t1_folded", _SQL_INGEST)
def t1_folded(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches a run in the order of time, folded every other batch; each is sent again, before and after the fold, and each run is closed."""
    events, table = _weeks(spark, sf), scratch_dir(spark, "listings")
    schema = T.StructType([*events.drop("run").schema.fields, *LISTING.fields[-3:]])
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    half = day - 8 * (F.col("run") - 1) >= 4
    for number in range(1, _RUNS + 1):
        run = Run("S", number, _run_date(number))
        own = events.where(F.col("run") == number)
        for batch_id, part in enumerate((own.where(~half), own.where(half))):
            for _ in range(2):
                ingest_batch(part.drop("run"), batch_id, table, run, ["ts", "event_id"], fold_after=2)
        Store(spark, table, schema).close(run)
    return _listings(current(spark, table, schema))


@query(
    "a1_streamed",
    """
    SELECT 'S' AS site_name, CAST(3 AS BIGINT) AS iteration_id,
           CASE WHEN count(*) = 0 THEN '' ELSE concat_ws(',',
             'make', CASE WHEN count(CASE WHEN priced AND event_type <> 'error' THEN event_type END) = 0 THEN 'model' END,
             CASE WHEN count(CASE WHEN priced THEN 1 END) = 0 THEN 'sales_price_incl_vat' END,
             'currency', 'body_type', 'mileage', 'fuel_consumption_comb', 'first_registration', 'colour') END AS bad_fields
    FROM (SELECT event_type, value >= 0 AS priced FROM events)
    """,
)
def a1_streamed(spark: SparkSession, sf: str) -> DataFrame:
    """A run in three batches; its control row comes from counts that the batches left."""
    table = scratch_dir(spark, "listings")
    rows = read(spark, sf, "events").select(
        text("/e/", F.col("event_id")).alias("origin_link"), whole("value").alias("sales_price_incl_vat"), "event_id",
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("model"), F.lit(None).cast("string").alias("colour"),
    )
    run = Run("S", 3, _run_date(3))
    for batch_id in range(3):
        ingest_batch(rows.where(F.col("event_id") % 3 == batch_id), batch_id, table, run, ["event_id"])
    store = Store(spark, table, T.StructType([*rows.schema.fields, *LISTING.fields[-3:]]))
    store.close(run)
    return store.control("S").withColumn("bad_fields", F.array_join("bad_fields", ","))


def _drain(spark: SparkSession, stream: DataFrame) -> DataFrame:
    path = scratch_dir(spark, "stream-out")
    (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", scratch_dir(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(stream.schema).parquet(path)


@query("t2_seen", "SELECT DISTINCT user_id || '/' || event_type AS origin_link FROM events")
def t2_seen(spark: SparkSession, sf: str) -> DataFrame:
    stream = table_stream(spark, f"{sf.rstrip('/')}/events.parquet").select(
        text(F.col("user_id"), "/", F.col("event_type")).alias("origin_link"), "event_id"
    )
    return _drain(spark, seen_once(stream, "origin_link")).select("origin_link")


@query("t2_seen_horizon", "SELECT DISTINCT user_id || '/' || event_type AS origin_link FROM events")
def t2_seen_horizon(spark: SparkSession, sf: str) -> DataFrame:
    stream = table_stream(spark, f"{sf.rstrip('/')}/events.parquet").select(
        text(F.col("user_id"), "/", F.col("event_type")).alias("origin_link"), "event_id", "ts"
    )
    return _drain(spark, seen_once(stream, "origin_link", horizon="40 days")).select("origin_link")


_SQL_ALERTS = f"""
    SELECT event_id AS log_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') || chr(10) || props AS text
    FROM events WHERE event_type = 'error' AND ts + INTERVAL 1 MINUTE >= TIMESTAMP '{_NOW}'
"""


def _logs(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("log_id"),
        F.when(F.col("event_type") == "error", 40).otherwise(20).alias("level"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("props").alias("message"),
    )


@query("t3_alerts", _SQL_ALERTS)
def t3_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return alerts(_logs(read(spark, sf, "events")), _NOW)


@query("t3_alerts_stream", _SQL_ALERTS)
def t3_alerts_stream(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "alerts")
    logs = _logs(table_stream(spark, f"{sf.rstrip('/')}/events.parquet"))
    alert_stream(logs, _NOW, path, scratch_dir(spark, "checkpoint")).awaitTermination()
    return read_alerts(spark, path, "log_id", "bigint").select("log_id", "text")


@query(
    "t3_alerts_polls",
    """
    WITH e AS (SELECT *, event_id % 4 AS part FROM events WHERE event_type = 'error'),
    s AS (SELECT * FROM e WHERE part < 2 AND ts + INTERVAL 10 DAY >= TIMESTAMP '2024-01-12 00:00:00'
          UNION SELECT * FROM e WHERE part >= 1 AND ts + INTERVAL 10 DAY >= TIMESTAMP '2024-01-20 00:00:00')
    SELECT event_id AS log_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') || chr(10) || props AS text FROM s
    """,
)
def t3_alerts_polls(spark: SparkSession, sf: str) -> DataFrame:
    """Two polls, ten days back each: the second has late errors, some of the first poll's again, and a batch that is sent twice."""
    logs, path = _logs(read(spark, sf, "events")), scratch_dir(spark, "alerts")
    part = F.col("log_id") % 4
    incoming, checkpoint = scratch_dir(spark, "logs"), scratch_dir(spark, "checkpoint")
    for now, rows in (("2024-01-12 00:00:00", logs.where(part < 2)), ("2024-01-20 00:00:00", logs.where(part >= 1))):
        rows.write.mode("append").parquet(incoming)
        alert_stream(captures_stream(spark, incoming, logs.schema), now, path, checkpoint, "10 DAYS").awaitTermination()
    alert_batch(logs.where(part >= 1), 1, "2024-01-20 00:00:00", path, "alerts", "10 DAYS")
    return read_alerts(spark, path, "log_id", "bigint").select("log_id", "text")
