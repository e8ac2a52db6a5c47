"""Error alerts from job logs, as a batch and as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from lotledger.functions.predicates import ALERT_HORIZON, is_error, is_recent
from lotledger.functions.text import alert_text, epoch_ms
from lotledger.operators.dedupe import first_per_key
from lotledger.sources.readers import read_alerts
from lotledger.sources.writers import write_alerts


def with_time(logs: DataFrame) -> DataFrame:
    """Log rows with their epoch-millisecond `time` as timestamp `ts`."""
    return logs.withColumn("ts", epoch_ms(F.col("time")))


def alerts(
    logs: DataFrame,
    now: str | Column,
    horizon: str = ALERT_HORIZON,
    key: str = "log_id",
    code: int | str | None = None,
    with_ts: bool = False,
) -> DataFrame:
    """(key, text) per error row not older than the horizon at `now`; `with_ts` adds its time."""
    error = is_error(F.col("level")) if code is None else is_error(F.col("level"), code)
    return logs.where(error & is_recent(F.col("ts"), now, horizon)).select(
        key, alert_text(F.date_trunc("second", "ts"), F.col("message")).alias("text"), *(["ts"] if with_ts else [])
    )


def alert_batch(
    logs: DataFrame,
    batch_id: int,
    now: str | Column,
    path: str,
    query: str,
    horizon: str = ALERT_HORIZON,
    key: str = "log_id",
    code: int | str | None = None,
) -> None:
    """Write the alerts of a batch of logs that no other batch has sent.

    Only alerts within the horizon can come again, so only these are looked up. Of rows that
    repeat a key the latest counts.
    """
    spark = logs.sparkSession
    instant = F.lit(now).cast("timestamp") if isinstance(now, str) else now
    due = first_per_key(alerts(logs, now, horizon, key, code, with_ts=True), [key], [F.col("ts").desc(), "text"])
    kind = logs.schema[key].dataType.simpleString()
    own = (F.col("query") == query) & (F.col("batch") == batch_id)
    sent = read_alerts(spark, path, key, kind).where(~own & (F.col("ts") + F.expr(f"INTERVAL {horizon}") >= instant)).select(key)
    write_alerts(due.join(sent, key, "left_anti"), path, query, batch_id)


def alert_stream(
    logs: DataFrame,
    now: str | Column,
    path: str,
    checkpoint: str,
    horizon: str = ALERT_HORIZON,
    key: str = "log_id",
    code: int | str | None = None,
    query: str = "alerts",
) -> StreamingQuery:
    """One poll: write each alert once, whatever the polling interval, and stop (see `alert_batch`).

    The next poll starts from the same checkpoint with a later `now`. What was sent is read from the alerts
    themselves, so a batch that is sent again and an error that arrives late both give one alert.
    """
    return (
        logs.writeStream.foreachBatch(lambda batch, batch_id: alert_batch(batch, batch_id, now, path, query, horizon, key, code))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
