"""Scans: captures, run control, jobs and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lotledger.schema import JOB, LOG, RUN_CONTROL


def captures(spark: SparkSession, path: str) -> DataFrame:
    """Stored page captures. Missing `status` and `fetched_at` columns read as null."""
    df = spark.read.parquet(path)
    for name, kind in (("status", "int"), ("fetched_at", "timestamp")):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df


def captures_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Captures (or any Parquet rows) as they arrive in a folder."""
    return _stream(spark, schema, files_per_batch).parquet(path)


def table_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A stored Parquet table as a stream; its schema is read from the files.

    A stream source is a folder, so a table that is one file is picked out of
    its folder by name.
    """
    schema = spark.read.parquet(path).schema
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    is_file = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(where).isFile()
    if not is_file:
        return captures_stream(spark, path, schema, files_per_batch)
    folder, name = path.rsplit("/", 1)
    return _stream(spark, schema, files_per_batch).option("pathGlobFilter", name).parquet(folder)


def _stream(spark: SparkSession, schema: T.StructType, files_per_batch: int | None):
    reader = spark.readStream.schema(schema)
    return reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader


def read_control(spark: SparkSession, path: str) -> DataFrame:
    """Latest row per site of the run control."""
    rows = spark.read.schema(RUN_CONTROL).parquet(path)
    latest = rows.groupBy("site_name").agg(F.max_by(F.struct("iteration_id", "bad_fields"), "iteration_id").alias("r"))
    return latest.select("site_name", "r.iteration_id", "r.bad_fields")


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(JOB).json(path)


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG).json(path)


def read_alerts(spark: SparkSession, path: str, key: str, kind: str) -> DataFrame:
    """Alerts that were written (key, text, ts) with the query and batch that sent them; none before the first."""
    rows = T.StructType.fromDDL(f"`{key}` {kind}, text string, ts timestamp, query string, batch bigint")
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], rows)
    return spark.read.schema(rows).parquet(path)
