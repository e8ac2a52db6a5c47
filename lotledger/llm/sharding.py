"""Shards of near-equal bytes: the smallest capacity for which a greedy cut of ordered groups needs no more shards."""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from lotledger.llm.arrays import ranked

#: Hex digits of the first cells, and those by which a cell is split. Both bound what the driver sees at once.
FIRST, NEXT = 3, 2
#: Cells that one round splits.
SPLIT = 256


@dataclass(frozen=True)
class Cell:
    """Groups whose key begins with `prefix`: their bytes, and the key if there is one group alone."""

    prefix: str
    size: int
    only: str | None


def greedy(sizes: list[int], capacity: int, ends: list[int] | None = None) -> list[int]:
    """Where a greedy cut of atoms into runs of at most `capacity` ends each run; an atom over the capacity ends the cut."""
    ends = list(accumulate(sizes)) if ends is None else ends
    cuts, done, i = [], 0, 0
    while i < len(sizes):
        j = bisect_right(ends, done + capacity)
        if j == i:
            return [*cuts, -1]
        cuts.append(j)
        done, i = ends[j - 1], j
    return cuts


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """Binary search for the least capacity with which a greedy cut needs at most `shards` runs."""
    if not sizes:
        return 0
    ends = list(accumulate(sizes))
    lo = max(max(sizes), -(-ends[-1] // shards))
    hi = max(sizes) + -(-ends[-1] // shards)
    while lo < hi:
        mid = (lo + hi) // 2
        cuts = greedy(sizes, mid, ends)
        if len(cuts) <= shards and cuts[-1] != -1:
            hi = mid
        else:
            lo = mid + 1
    return lo


def relaxed_capacity(cells: list[Cell], shards: int) -> int:
    """A capacity below which no cut can do: as the search, but a cell of several groups may be cut anywhere."""
    ends = list(accumulate(c.size for c in cells))
    if not ends:
        return 0
    lo = max([-(-ends[-1] // shards), *(c.size for c in cells if c.only)])
    hi = max(c.size for c in cells) + -(-ends[-1] // shards)
    while lo < hi:
        mid = (lo + hi) // 2
        done = 0
        for _ in range(shards):
            done = _reach(cells, ends, done + mid)
        lo, hi = (lo, mid) if done >= ends[-1] else (mid + 1, hi)
    return lo


def _reach(cells: list[Cell], ends: list[int], most: int) -> int:
    """The farthest place up to `most` at which a relaxed cut may end a run."""
    j = bisect_right(ends, most)
    if j == len(ends):
        return ends[-1]
    return most if cells[j].only is None else ends[j] - cells[j].size


def cut_keys(groups: DataFrame, shards: int) -> tuple[int, list[str]]:
    """Of groups (`key` hex text, `size`): the smallest capacity, and the first keys of shards 1, 2, ...

    The driver sees sums of cells (common key prefixes), never the groups. As long
    as a cell of several groups may hold a cut, or is too large to tell, it is
    split by further digits; what remains whole cannot change the answer.
    """
    cells = _cells(groups, FIRST)
    if not cells:
        return 0, []
    while True:
        sizes, ends = [c.size for c in cells], list(accumulate(c.size for c in cells))
        high, low = smallest_capacity(sizes, shards), relaxed_capacity(cells, shards)
        wanted = _unsure(cells, ends, low, high, shards)
        if not wanted:
            cuts = greedy(sizes, high, ends)
            return high, [cells[j].only or cells[j].prefix for j in cuts[:-1]]
        split = sorted(wanted, key=lambda c: -c.size)[:SPLIT]
        parts: dict[str, list[Cell]] = {c.prefix: [] for c in split}
        for length in {len(c.prefix) for c in split}:
            chosen = [c.prefix for c in split if len(c.prefix) == length]
            for part in _cells(groups.where(F.substring("key", 1, length).isin(chosen)), length + NEXT):
                parts[part.prefix[:length]].append(part)
        cells = [p for c in cells for p in (parts[c.prefix] if c.prefix in parts else [c])]


def _unsure(cells: list[Cell], ends: list[int], low: int, high: int, shards: int) -> list[Cell]:
    """Cells of several groups that may hold a cut of any capacity from low to high."""
    out, first, last = {}, 0, 0
    for _ in range(shards):
        # The least place after a run of `low` from the least start, and the greatest after one of `high`.
        i = bisect_right(ends, first + low)
        first = ends[i - 1] if i else 0
        last = _reach(cells, ends, last + high)
        if first >= ends[-1]:
            break
        for j in range(i, min(len(cells), bisect_right(ends, last) + 1)):
            if cells[j].only is None:
                out[j] = cells[j]
    return list(out.values())


def _cells(groups: DataFrame, digits: int) -> list[Cell]:
    rows = groups.groupBy(F.substring("key", 1, digits).alias("prefix")).agg(F.sum("size").alias("size"), F.min("key").alias("low"), F.max("key").alias("high"))
    return [Cell(r["prefix"], r["size"], r["low"] if r["low"] == r["high"] else None) for r in rows.orderBy("prefix").collect()]


def shard(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with `size`, `text_crc32`, `law`, `shard`, `slot`, `grown_shard` (null: the law is by bytes).

    Equal texts are one group (null counts as empty: size 1, checksum 0). Groups are
    ordered by the digest of their text, so a shard is a range of digests and a row
    finds its shard by comparing, without a join. Slots follow (digest, doc_id);
    of repeated rows each has a slot of its own. A group larger than a fair share
    stays whole, and shards at the end may then be empty, as may those of a table
    with fewer groups than shards.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        F.sha2(body, 256).alias("key"),
    )
    rows, parts = ranked(narrow, [F.col("key"), F.col("doc_id")], "shards")
    _, keys = cut_keys(rows.select("key", "size"), shards)
    number: Column = F.lit(0)
    for k in keys:
        number = number + (F.col("key") >= k).cast("int")
    placed = rows.withColumn("shard", number)
    # At most (partitions + shards) rows: a shard is a range of the order.
    runs = placed.groupBy("part", "shard").agg(F.count("*").alias("n"), F.min("pos").alias("first"))
    starts, seen = {}, {}
    for r in sorted(runs.collect(), key=lambda r: (r["part"], r["shard"])):
        starts[r["part"], r["shard"]] = seen.get(r["shard"], 0) - r["first"]
        seen[r["shard"]] = seen.get(r["shard"], 0) + r["n"]
    spark = docs.sparkSession
    shift = spark.createDataFrame([(p, s, x) for (p, s), x in starts.items()], "part int, shard int, shift bigint")
    return placed.join(F.broadcast(shift), ["part", "shard"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("pos") + F.col("shift")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
