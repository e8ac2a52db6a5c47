"""Benchmark decontamination: Wu-Manber search of word windows in whole documents."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lotledger.session import scratch_dir

WINDOW = 10
#: Bytes of item text whose windows a task holds at once. More items are searched in as many passes.
BATCH_BYTES = 32 << 20

#: One pass lower-cases A-Z and turns all that is no letter, digit or non-ASCII byte into blanks.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))


def split_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TABLE).split()


class Searcher:
    """Wu-Manber over words, for patterns of one length.

    A block is two words (one, if the patterns are single words). `shift` tells for
    a block how far the window may move on: no pattern ends before that. Blocks
    that end a pattern have shift 0 and lead to the bucket of patterns with that
    suffix; those are compared word by word.
    """

    def __init__(self, patterns: dict[tuple[bytes, ...], list[str]], length: int):
        self.length, self.block = length, min(2, length)
        self.shift: dict = {}
        self.bucket: dict = defaultdict(list)
        for words, items in patterns.items():
            for end in range(self.block, length + 1):
                b = self._block(words, end - 1)
                self.shift[b] = min(self.shift.get(b, length), length - end)
            self.bucket[self._block(words, length - 1)].append((list(words), items))

    def _block(self, words, i):
        return words[i] if self.block == 1 else (words[i - 1], words[i])

    def search(self, words: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """Where patterns start, and their items."""
        m, n = self.length, len(words)
        skip, shift, bucket = m - self.block + 1, self.shift.get, self.bucket
        i = m - 1
        if self.block == 1:
            for i in range(n):
                for _, items in bucket.get(words[i], ()):
                    yield i, items
            return
        while i < n:
            block = words[i - 1], words[i]
            step = shift(block, skip)
            if step:
                i += step
                continue
            start = i - m + 1
            found = words[start : i + 1]
            for pattern, items in bucket[block]:
                if pattern == found:
                    yield start, items
            i += 1


def searchers(items: list[tuple[str, bytes | None]], window: int) -> list[Searcher]:
    by_length: dict[int, dict[tuple[bytes, ...], list[str]]] = defaultdict(lambda: defaultdict(list))
    for item, text in items:
        words = split_words(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            owners = by_length[size][tuple(words[i : i + size])]
            if item not in owners:
                owners.append(item)
    return [Searcher(patterns, size) for size, patterns in sorted(by_length.items())]


def find(tools: list[Searcher], words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
    """Runs of hit words (start, end), in order and apart, and the items."""
    hits: list[tuple[int, int]] = []
    items: set[str] = set()
    for tool in tools:
        for start, owners in tool.search(words):
            hits.append((start, start + tool.length))
            items.update(owners)
    return merge(hits), items


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def _batches(items: DataFrame, item_id: str, text: str, limit: int) -> list[list[tuple[str, bytes | None]]]:
    """The items in lists of at most `limit` bytes of text (a longer item is alone); read one list's worth at a time."""
    rows = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).cast("binary").alias("text")).where("item IS NOT NULL")
    out, size = [[]], 0
    for row in rows.toLocalIterator():
        n = len(row["text"] or b"")
        if out[-1] and size + n > limit:
            out.append([])
            size = 0
        out[-1].append((row["item"], bytes(row["text"] or b"")))
        size += n
    return out


def occurrences(
    docs: DataFrame, items: DataFrame, key: list[str], text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Per row: key, `n_words`, `hits` (runs of hit words: start, end) and `items` (ids as strings, sorted).

    A document goes through the tables of all items at once while these are at most
    `batch_bytes` of text; beyond that a numbered copy of the rows is searched once
    for each batch, and the runs of a row are merged. Null and empty texts have no
    words and no hits; items with null id, null text or without words are in no
    occurrence. Repeated rows come out as often as they came in.
    """
    spark = docs.sparkSession
    batches = _batches(items, item_id, item_text, batch_bytes)
    found = "n_words bigint, hits array<struct<start:int,end:int>>, items array<string>"
    rows = docs.select(*key, F.col(text).cast("binary").alias("_text"))
    if len(batches) == 1:
        return _pass(rows, batches[0], key, found, window)
    path = scratch_dir(spark, "numbered")
    rows.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    numbered = spark.read.parquet(path)
    parts = [_pass(numbered, b, [*key, "_row"], found, window) for b in batches]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    one = union.groupBy("_row", *key).agg(F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    kind = "array<struct<start:int,end:int>>"
    glued = F.aggregate(
        "hits",
        F.array().cast(kind),
        lambda done, h: F.when((F.size(done) > 0) & (h["start"] <= F.element_at(done, -1)["end"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], h["end"]).alias("end"))))).otherwise(F.concat(done, F.array(h))).cast(kind),
    )
    return one.select(*key, "n_words", glued.alias("hits"), "items")


def _pass(rows: DataFrame, items: list[tuple[str, bytes | None]], key: list[str], found: str, window: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = searchers(shared.value, window)
        spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for b in batches:
            counts, hits, names = [], [], []
            for text in b.column("_text"):
                words = split_words(text.as_py())
                runs, own = find(tools, words)
                counts.append(len(words))
                hits.append([{"start": s, "end": e} for s, e in runs])
                names.append(sorted(own))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(k) for k in key], pa.array(counts, pa.int64()), pa.array(hits, spans), pa.array(names, pa.list_(pa.string()))],
                [*key, "n_words", "hits", "items"],
            )

    fields = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in key]
    return rows.mapInArrow(run, ", ".join([*fields, found]))


def contaminated(docs: DataFrame, items: DataFrame, key: list[str], **names) -> DataFrame:
    """Key, `n_words`, `n_hit`, `n_items`, `items_sha256`, `contaminated` of occurrences()."""
    hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, h: n + h["end"] - h["start"])
    return occurrences(docs, items, key, **names).select(
        *key, "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )
