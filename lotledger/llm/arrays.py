"""Arrow columns as flat arrays, word digests, and gapless ranks: what several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lotledger.session import scratch_dir

#: Text bytes that are held as 64-bit arrays at once; a longer text makes a piece of its own.
PIECE = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = []


#: Rows of whole texts that go to a Python worker at once: some megabytes, where Spark's own setting may mean hundreds.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """For queries and stages over long texts: smaller Arrow batches, which change no result."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that leaves no pattern."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, PIECE + 1)
        _powers[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)])) for b in (_BASE, _BACK)]
    return _powers[0][:n], _powers[1][:n]


def running(buf: np.ndarray) -> np.ndarray:
    """Prefix sums from which any substring's digest is had: (r[e] - r[s]) * inverse power of s."""
    up, _ = powers(len(buf))
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up, out=out[1:])
    return out


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column in one array, and where each row starts (and the end); null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return buf[at[0] : at[-1]], at - at[0]


def pieces(column: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about `limit` bytes: first row, end row, bytes, starts."""
    buf, at = flat(column)
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield i, j, buf[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def lowered() -> np.ndarray:
    """A byte table that lower-cases A-Z and nothing else."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def words(buf: np.ndarray, at: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the words (maximal runs of bytes for which `inner` holds), and each row's first word (and the end)."""
    if not len(buf):
        return np.empty(0, np.uint64), np.zeros(len(at), np.int64)
    is_in = inner[buf]
    first = np.empty(len(buf), bool)
    first[0] = True
    np.logical_not(is_in[:-1], out=first[1:])
    last = np.empty(len(buf), bool)
    last[-1] = True
    np.logical_not(is_in[1:], out=last[:-1])
    edge = at[(at > 0) & (at < len(buf))]
    first[edge] = True
    last[edge - 1] = True
    starts = np.flatnonzero(first & is_in)
    ends = np.flatnonzero(last & is_in) + 1
    total = running(buf)
    _, down = powers(len(buf) + 1)
    return mix((total[ends] - total[starts]) * down[starts]), np.searchsorted(starts, at)


def ngrams(digests: np.ndarray, bounds: np.ndarray, steps: tuple[int, ...], salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the words at i + steps of every row, and each row's first one (and the end)."""
    n = len(digests)
    reach = steps[-1]
    out = np.full(n, np.uint64((salt * 2 + 1) * int(_BACK) % (1 << 64)))
    for k, step in enumerate(steps):
        out[: max(0, n - step)] += digests[step:] * np.uint64(0xD1342543DE82EF95 + 2 * k * 0x632BE59BD9B4E019 & (1 << 64) - 1 | 1)
    size = np.diff(bounds)
    whole = np.arange(n) + reach < np.repeat(bounds[1:], size)
    kept = np.concatenate([[0], np.cumsum(np.maximum(size - reach, 0))])
    return mix(out[whole]), kept


def ranked(df: DataFrame, order: list[Column], name: str) -> tuple[DataFrame, DataFrame]:
    """The rows in order, written to the shared scratch folder with `part` and `pos`; and a row for each part.

    A range partitioning deals out the order, so a hot value is no single task's;
    the place within a partition is counted while it is written. Global places
    follow from the sizes of the parts, of which there are as many as partitions.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    place = F.monotonically_increasing_id()
    df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_mid", place).write.parquet(path)
    rows = (
        spark.read.parquet(path)
        .withColumn("part", F.shiftright("_mid", 33).cast("int"))
        .withColumn("pos", F.col("_mid").bitwiseAND((1 << 33) - 1))
        .drop("_mid")
    )
    return rows, rows.groupBy("part").agg(F.count("*").alias("n"))


#: Bits of the filter of `only`; its size doesn't follow the data.
FILTER_BITS = 1 << 22


def only(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose long `key` is in `wanted` (a table that was written), told by a join on the key.

    A filter of FILTER_BITS bits goes ahead and keeps most of the rest out of the
    shuffle; in a corpus that fills it, the join alone does the work.
    """
    spark = rows.sparkSession
    place = f"pmod(xxhash64(`{key}`), {FILTER_BITS})"
    told = wanted.groupBy(F.expr(f"shiftright({place}, 5)").alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast({place} & 31 AS int))")).alias("bits")).toPandas()
    table = np.zeros(FILTER_BITS >> 5, np.int64)
    table[told["word"]] = told["bits"]
    shared = spark.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for b in batches:
            at = np.asarray(b.column("_at").fill_null(0))
            yield b.drop_columns(["_at"]).filter(pa.array(bits[at >> 5] >> (at & 31) & 1 == 1))

    return rows.withColumn("_at", F.expr(place)).mapInArrow(run, rows.schema).join(wanted.select(F.col(key)), key, "left_semi")
