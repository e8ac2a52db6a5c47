"""Product codes of vectors; each part's nearest codebook entry is found by Orchard's search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lotledger.session import scratch_dir, written

#: Steps of a component's unit; parts of a vector; entries of a part's codebook; rounds of reassignment.
SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Whole components are held within plus or minus this, so that distances and sums stay within 64 bits.
BOUND = 1 << 27


def whole(column: pa.Array) -> np.ndarray:
    """The vectors of a batch (all of one length, nothing null) as whole numbers, one row each."""
    x = np.asarray(column.flatten(), np.float64).reshape(len(column), -1)
    return np.clip(np.floor(x * SCALE), -BOUND, BOUND).astype(np.int64)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(-1)


class Codebook:
    """Entries of one part, each with the others in the order of their distance to it."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        apart = squared(entries[:, None], entries[None])
        self.order = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.order, 1)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each point's nearest entry, the first of equals, and the squared distance to it.

        A point walks down the list of its best entry so far and measures those it
        hasn't visited. A better one's list is taken up from its start. An entry more
        than twice as far from the best as the point is cannot be as near, nor
        can the rest of the list, so the walk ends there.
        """
        n, k = len(points), len(self.entries)
        best, distance = np.zeros(n, np.int64), squared(points, self.entries[0])
        visited = np.zeros((n, k), bool)
        visited[:, 0] = True
        place = np.zeros(n, np.int64)
        walking = np.arange(n)
        while True:
            walking = walking[place[walking] < k]
            at = best[walking], place[walking]
            walking, other = (x[self.apart[at] <= 4 * distance[walking]] for x in (walking, self.order[at]))
            if not len(walking):
                return best, distance
            place[walking] += 1
            fresh = ~visited[walking, other]
            asked, other = walking[fresh], other[fresh]
            visited[asked, other] = True
            to = squared(points[asked], self.entries[other])
            better = (to < distance[asked]) | (to == distance[asked]) & (other < best[asked])
            asked = asked[better]
            best[asked], distance[asked], place[asked] = other[better], to[better], 0


class Codebooks:
    """The codebooks of all parts: an array of (part, entry, position)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.parts = [Codebook(x) for x in entries]

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance per vector and part."""
        width = self.entries.shape[2]
        found = [book.nearest(vectors[:, i * width : (i + 1) * width]) for i, book in enumerate(self.parts)]
        return np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def usable(vector: Column) -> Column:
    """Neither null nor with a component that is null or not finite."""
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def learn(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks | None]:
    """The rows (`id`, `vector`) that can be coded, and their codebooks (None if there are no such rows).

    A codebook starts as its part of the vectors with the smallest ids (null ids
    last, of equal ids the smaller vector first). A round sums each entry's parts,
    a row per task, entry and position; the driver gets as many sums as the books have
    components, whatever the corpus. Entries without parts stay as they are.
    """
    rows = rows.where(usable(F.col("vector")) & (F.size("vector") > 0) & (F.size("vector") % parts == 0))
    order = [F.col("id").asc_nulls_last(), F.col("vector")]
    first = rows.orderBy(*order).select(F.size("vector")).first()
    if first is None:
        return rows, None
    rows = rows.where(F.size("vector") == first[0])
    seeds = np.array([r[0] for r in rows.orderBy(*order).limit(entries).select("vector").collect()])
    start = np.clip(np.floor(seeds * SCALE), -BOUND, BOUND).astype(np.int64)
    books = Codebooks(np.ascontiguousarray(start.reshape(len(start), parts, -1).swapaxes(0, 1)))
    for _ in range(rounds):
        books = _moved(rows, books)
    return rows, books


def _moved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry at the floored mean of the parts that are nearest to it."""
    shape = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        for b in batches:
            vectors = whole(b.column("vector"))
            entry, _ = books.assign(vectors)
            for i in range(shape[0]):
                np.add.at(total[i], entry[:, i], vectors[:, i * shape[2] : (i + 1) * shape[2]])
                count[i] += np.bincount(entry[:, i], minlength=shape[1])[:, None]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel()), pa.array(count.ravel())], ["cell", "total", "n"])

    summed = rows.select("vector").mapInArrow(run, "cell bigint, total bigint, n bigint").groupBy("cell").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    out = books.entries.copy().ravel()
    for cell, total, n in summed.where("n > 0").collect():
        out[cell] = total // n
    return Codebooks(out.reshape(shape))


def encode(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Per vector `vec_id`, `code`, `error`, `label_error`, `codebooks_sha256`.

    A component x counts as floor(4096 * x), held within plus or minus 2^27. `code` has
    two hex digits per part, `error` is the squared distance to the entries it names,
    and `label_error` sums the errors of all vectors of the same label (null is a label).
    Rows whose vector is null, or has a null, infinite or NaN component, go; so do those of
    no components, of a number that `parts` does not divide, or of another number
    than the vector with the smallest id. Repeated rows and rows without an id are
    coded like any other. An empty table gives no rows.
    """
    kind = vectors.schema[vec_id].dataType.simpleString()
    tag = vectors.schema[label].dataType.simpleString()
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(label).alias("tag"), F.col(vector).cast("array<double>").alias("vector"))
    rows, books = learn(rows, parts, entries, rounds)
    if books is None:
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, code string, error bigint, label_error bigint, codebooks_sha256 string")
    hexed = np.array([f"{i:02x}" for i in range(entries)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            entry, distance = books.assign(whole(b.column("vector")))
            code = ["".join(c) for c in hexed[entry].tolist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("tag"), pa.array(code, pa.string()), pa.array(distance.sum(1))], ["vec_id", "tag", "code", "error"])

    coded = written(rows.mapInArrow(run, f"vec_id {kind}, tag {tag}, code string, error bigint"), scratch_dir(vectors.sparkSession, "codes"))
    errors = coded.groupBy(F.col("tag").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(errors, F.col("tag").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
