"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", memory: str = "8g", app: str = "lotledger") -> SparkSession:
    """A session for tests and the local bench. A cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared `spark.checkpoint.dir`.

    Only a local master may go without that setting: its executors share the
    driver's disk, so a temporary folder is visible to all of them.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_LOCAL_BASE: list[str] = []


def _local_base() -> str:
    if not _LOCAL_BASE:
        _LOCAL_BASE.append(tempfile.mkdtemp(prefix="lotledger-"))
    return _LOCAL_BASE[0]


def written(df: DataFrame, path: str) -> DataFrame:
    """The rows as a stored table: what reads them later doesn't compute them again."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables that live only inside a `with` block, in one folder under the shared scratch folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.count = spark, scratch_dir(spark, name), 0

    def __enter__(self) -> Scratch:
        return self

    def keep(self, df: DataFrame) -> DataFrame:
        self.count += 1
        return written(df, f"{self.folder}/{self.count}")

    def __exit__(self, *_) -> None:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


#: Rows of a CPU-heavy step (about a millisecond each) that one task takes on.
SPREAD_ROWS = 10_000


def spread(df: DataFrame, *key: str) -> DataFrame:
    """The rows of a small scan, or of few columns, dealt evenly over tasks of about SPREAD_ROWS rows; with a key, by the key.

    For CPU-heavy steps. How many pieces the input comes in says nothing about
    where its rows are (a file has more splits than row groups), so the rows
    are counted: of a stored table that is a look at its footers.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // SPREAD_ROWS))
    return df.repartition(tasks, *key)
