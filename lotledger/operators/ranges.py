"""Capped ranges, page numbers and cell caps.

A population is cut along an integer column into cells that hold at most `cap`
rows each, by halving [lo, hi] at lo + (hi - lo) // 2 until a cell fits or
spans one value. The halving points do not depend on the data: the way from the
root to a value is a bit per level (0 left, 1 right), and a cell is a prefix of
that path. So the cut is a matter of counting prefixes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from lotledger.functions.predicates import over_cap
from lotledger.session import Scratch, scratch_dir, written

# Root ranges and page limits of the two range-searched sites.
PRICE_RANGE_S = (0, 1_000_000_000)
MILEAGE_RANGE_S = (0, 10_000_000)
PRICE_RANGE_U = (0, 10_000_000)
PAGE_SIZE = 20
MAX_PAGES_S = 20
MAX_PAGES_U = 100

# Levels that one counting pass covers.
BAND = 15

# Cells of the lowest level that one task rolls up: each gives a row per level.
ROLL_UP_ROWS = 50_000

# Slices of a cell that are ranked apart.
SALTS = 64


def _depth(lo: int, hi: int) -> int:
    return (hi - lo).bit_length()


def _value(col: Column, lo: int, hi: int) -> Column:
    """The whole value inside [lo, hi]; null outside."""
    v = F.floor(col).cast("bigint")
    return F.when(v.between(lo, hi), v)


def histogram(df: DataFrame, col: Column, lo: int, hi: int, by: Sequence[str] = ()) -> DataFrame:
    """(by, v, n): rows per whole value inside [lo, hi]."""
    v = _value(col, lo, hi)
    return df.select(*by, v.alias("v")).where(F.col("v").isNotNull()).groupBy(*by, "v").agg(F.count("*").alias("n"))


def outside_root(df: DataFrame, col: Column, lo: int, hi: int, by: Sequence[str] = ()) -> DataFrame:
    """(by, n_missing, n_outside): rows that no range of [lo, hi] can reach, for groups that have any."""
    rest = df.select(*by, col.alias("_col"), _value(col, lo, hi).alias("_v")).where(F.col("_v").isNull())
    return rest.groupBy(*by).agg(
        F.count(F.when(F.col("_col").isNull(), 1)).alias("n_missing"), F.count("_col").alias("n_outside")
    )


def _same(by: Sequence[str]) -> Column:
    """Equality with columns that carry a leading underscore, null beside null."""
    return reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by], F.lit(True))


def _other(df: DataFrame, by: Sequence[str], *more: Column) -> DataFrame:
    return df.select(*[F.col(c).alias(f"_{c}") for c in by], *more)


def _halve(s: Column, v: Column) -> tuple[Column, Column, Column]:
    """(lo, hi, goes right) of the half of cell `s` that holds `v`."""
    mid = s["lo"] + F.shiftright(s["hi"] - s["lo"], 1)
    right = v > mid
    return F.when(right, mid + 1).otherwise(s["lo"]), F.when(right, s["hi"]).otherwise(mid), right


def _long(n: int) -> Column:
    return F.lit(n).cast("bigint")


def _steps(depth: int) -> Column:
    return F.sequence(F.lit(1), F.lit(depth))


# A path and the level of a leaf share one bigint, so that one column comes back from Python.
_LEAF_BITS = 6


def with_path(hist: DataFrame, lo: int, hi: int) -> DataFrame:
    """Add `path` (depth bits) and `leaf` (level from which the value is alone in its cell).

    The halving is a loop over levels on whole Arrow batches of distinct values.
    """
    depth = _depth(lo, hi)

    def walk(v: pd.Series) -> pd.Series:
        value = v.to_numpy()
        low, high = np.full(len(value), lo, np.int64), np.full(len(value), hi, np.int64)
        path, leaf = np.zeros(len(value), np.int64), np.zeros(len(value), np.int64)
        for _ in range(depth):
            mid = low + ((high - low) >> 1)
            right = value > mid
            leaf += low < high
            path = (path << 1) + right
            low, high = np.where(right, mid + 1, low), np.where(right, high, mid)
        return pd.Series((path << _LEAF_BITS) + leaf)

    coded = hist.withColumn("_at", F.coalesce(F.pandas_udf(walk, "bigint")("v"), _long(0)))
    return coded.select(
        *hist.columns,
        F.shiftright("_at", _LEAF_BITS).alias("path"),
        (F.col("_at") % (1 << _LEAF_BITS)).cast("int").alias("leaf"),
    )


def _bounds(v: Column, level: Column, lo: int, hi: int) -> Column:
    """struct<lo,hi> of the cell of `v` at a level."""

    def step(s: Column, _: Column) -> Column:
        low, high, _right = _halve(s, v)
        return F.struct(low.alias("lo"), high.alias("hi"))

    return F.aggregate(
        F.slice(_steps(_depth(lo, hi)), F.lit(1), level), F.struct(_long(lo).alias("lo"), _long(hi).alias("hi")), step
    )


def _prefix(path: Column, level: Column | int, depth: int) -> Column:
    """First `level` bits of a path."""
    shift = F.lit(depth - level) if isinstance(level, int) else F.lit(depth) - level
    return F.call_function("shiftright", path, shift)


def _children(cells: DataFrame, first: int, end: int, depth: int, by: list[str]) -> DataFrame:
    """Cells of the levels first + 1 to end, each with its own count and that of its parent.

    Values are summed to the cells of the lowest level first, map-side too, and
    only these, at most 2 ** (end - first) per open cell, are rolled up. They
    are dealt by number first: their bytes, by which Spark merges partitions,
    don't show that each becomes a row per level. One aggregation per parent
    cell counts both halves. `cells` is a stored table.
    """
    level, tasks = F.col("level"), max(1, -(-cells.count() // ROLL_UP_ROWS))
    lowest = cells.groupBy(*by, _prefix(F.col("path"), end, depth).alias("path")).agg(
        F.sum("n").alias("n"), F.min("v").alias("v"), F.min("leaf").alias("leaf")
    )
    if tasks > 1:
        lowest = lowest.repartition(tasks, *by, "path")
    down = lowest.select(*by, "v", "n", "leaf", "path", F.explode(F.sequence(F.lit(first), F.lit(end - 1))).alias("level")).select(
        *by,
        "level",
        "v",
        "n",
        "leaf",
        _prefix(F.col("path"), level, end).alias("cell"),
        (_prefix(F.col("path"), level + 1, end) % 2 == 1).alias("right"),
    )
    sides = []
    for side, here in (("l", ~F.col("right")), ("r", F.col("right"))):
        sides += [F.sum(F.when(here, F.col("n")).otherwise(0)).alias(f"n_{side}")]
        sides += [F.min(F.when(here, F.col(c))).alias(f"{c}_{side}") for c in ("v", "leaf")]
    parents = down.groupBy(*by, "level", "cell").agg(*sides)
    half = [
        F.struct(
            (F.col("cell") * 2 + bit).alias("cell"),
            F.col(f"n_{side}").alias("n"),
            F.col(f"v_{side}").alias("v"),
            F.col(f"leaf_{side}").alias("leaf"),
        )
        for bit, side in enumerate("lr")
    ]
    return (
        parents.select(
            *by,
            (level + 1).alias("level"),
            (F.col("n_l") + F.col("n_r")).alias("n_parent"),
            F.least("leaf_l", "leaf_r").alias("leaf_parent"),
            F.explode(F.array(*half)).alias("c"),
        )
        .select(*by, "level", "n_parent", "leaf_parent", "c.cell", "c.n", "c.v", "c.leaf")
        .where("n > 0")
    )


def split_counts(hist: DataFrame, lo: int, hi: int, cap: int, by: Sequence[str] = (), band: int = BAND) -> DataFrame:
    """(by, lo, hi, n) of all non-empty cells, from a histogram (by, v, n).

    A cell is a result if it fits while its parent does not, so the counts of
    a cell and its parent settle it, without a walk. The levels are counted in
    bands, and only values in cells that still overflow enter the next band.
    The values and each band are written once; the result is a stored table.
    """
    by, depth, spark = list(by), _depth(lo, hi), hist.sparkSession
    level = F.col("level")
    fits = (F.col("n") <= cap) | (F.col("leaf") <= level)
    open_parent = (F.col("n_parent") > cap) & (F.col("leaf_parent") > level - 1)
    with Scratch(spark, "split") as scratch:
        cells = scratch.keep(with_path(hist, lo, hi))
        roots = cells.groupBy(*by).agg(F.sum("n").alias("n")).where("n > 0")
        out = roots.where((F.col("n") <= cap) | F.lit(depth == 0)).select(*by, _long(lo).alias("lo"), _long(hi).alias("hi"), "n")
        for first in range(0, depth, band):
            end = min(first + band, depth)
            children = scratch.keep(_children(cells, first, end, depth, by).where(open_parent & (fits | (level == end))))
            found = children.where(fits).select(*by, "n", _bounds(F.col("v"), level, lo, hi).alias("b"))
            out = out.unionByName(found.select(*by, "b.lo", "b.hi", "n"))
            over = _other(children.where(~fits), by, F.col("cell").alias("_cell"))
            if end == depth or over.isEmpty():
                break
            inside = _same(by) & (_prefix(F.col("path"), end, depth) == F.col("_cell"))
            cells = scratch.keep(cells.join(over, inside, "left_semi"))
        return written(out, scratch_dir(spark, "cells"))


def split_ranges(
    df: DataFrame, col: Column, lo: int, hi: int, cap: int, by: Sequence[str] = (), whole: bool = False
) -> DataFrame:
    """(by, lo, hi, n): ranges of at most `cap` rows, or of one value.

    Rows without a value, or with one outside [lo, hi], are in no range;
    `outside_root` counts them. With `whole`, a group of at most `cap` rows is
    one cell without bounds (null lo and hi) that holds those rows too, and only
    larger groups are cut.
    """
    if not whole:
        return split_counts(histogram(df, col, lo, hi, by), lo, hi, cap, by)
    with Scratch(df.sparkSession, "groups") as scratch:
        hist = df.select(*by, _value(col, lo, hi).alias("v")).groupBy(*by, "v").agg(F.count("*").alias("n"))
        hist = scratch.keep(hist)
        totals = scratch.keep(hist.groupBy(*by).agg(F.sum("n").alias("n")))
        large = _other(totals.where(F.col("n") > cap), by)
        cut = split_counts(hist.where("v IS NOT NULL").join(large, _same(by), "left_semi"), lo, hi, cap, by)
        none = F.lit(None).cast("bigint")
        small = totals.where(F.col("n").between(1, cap)).select(*by, none.alias("lo"), none.alias("hi"), "n")
        return written(small.unionByName(cut), scratch_dir(df.sparkSession, "cells"))


def overflow_report(cells: DataFrame, cap: int) -> DataFrame:
    """Cells of one value that still hold more than `cap` rows."""
    return cells.where((F.col("lo") == F.col("hi")) & over_cap(F.col("n"), cap))


def split_two(
    df: DataFrame,
    col1: Column,
    col2: Column,
    bounds1: tuple[int, int],
    bounds2: tuple[int, int],
    cap: int,
    by: Sequence[str] = (),
) -> DataFrame:
    """(by, lo, hi, lo2, hi2, n, outside): one-value cells over the cap are split again by a second column.

    The rows are counted once, per pair of values; the first cut is a roll-up of
    those counts. Cells that needed no second cut have null lo2, hi2. Rows of a
    second cut that no range of `bounds2` reaches are one row with null lo2, hi2
    and `outside`; those outside `bounds1` are counted by `outside_root`.
    """
    by, spark = list(by), df.sparkSession
    none = F.lit(None).cast("bigint")
    with Scratch(spark, "pairs") as scratch:
        pairs = scratch.keep(
            df.select(*by, _value(col1, *bounds1).alias("v1"), _value(col2, *bounds2).alias("v2"))
            .where(F.col("v1").isNotNull())
            .groupBy(*by, "v1", "v2")
            .agg(F.count("*").alias("n"))
        )
        cells = split_counts(pairs.groupBy(*by, F.col("v1").alias("v")).agg(F.sum("n").alias("n")), *bounds1, cap, by)
        over = _other(overflow_report(cells, cap), by, F.col("lo").alias("_v1"))
        again = scratch.keep(pairs.join(over, _same([*by, "v1"]), "left_semi"))
        deep = split_counts(again.where("v2 IS NOT NULL").select(*by, "v1", F.col("v2").alias("v"), "n"), *bounds2, cap, [*by, "v1"])
        rest = again.where("v2 IS NULL").select(
            *by, F.col("v1").alias("lo"), F.col("v1").alias("hi"), none.alias("lo2"), none.alias("hi2"), "n", F.lit(True).alias("outside")
        )
        rest = written(rest, scratch_dir(spark, "cells"))
    inside = F.lit(False).alias("outside")
    deep = deep.select(
        *by, F.col("v1").alias("lo"), F.col("v1").alias("hi"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"), "n", inside
    )
    shallow = cells.where((F.col("n") <= cap) | (F.col("lo") < F.col("hi"))).select(
        *by, "lo", "hi", none.alias("lo2"), none.alias("hi2"), "n", inside
    )
    return shallow.unionByName(deep).unionByName(rest)


def count_by_range(
    df: DataFrame, col: Column, ranges: DataFrame, lo: int, hi: int, by: Sequence[str] = ()
) -> DataFrame:
    """(by, lo, hi, n): rows of `df` inside [lo, hi] per given range; ranges without rows count 0.

    Any ranges will do: overlapping ones, ones that cross the root (only its
    inside counts), and ones with a null bound (open on that side). A count is a
    difference of two running counts, so no range join is needed. Runs are summed
    within slices of the root and over the slices, at most about the square root
    of its width each, so neither window grows with the rows.
    """
    by, half = list(by), -(-_depth(lo, hi) // 2)
    part = F.shiftright(F.col("v") - lo, half).alias("part")
    ends = ranges.select(
        *by,
        "lo",
        "hi",
        (F.least(F.greatest(F.coalesce("lo", _long(lo)), _long(lo)), _long(hi + 1)) - 1).alias("_before"),
        F.greatest(F.least(F.coalesce("hi", _long(hi)), _long(hi)), _long(lo - 1)).alias("_last"),
    )
    marks = ends.select(*by, F.col("_before").alias("v")).unionByName(ends.select(*by, F.col("_last").alias("v")))
    marks = marks.where(F.col("v") >= lo).distinct().select(*by, "v", _long(0).alias("n"), F.lit(True).alias("mark"))
    with Scratch(df.sparkSession, "counts") as scratch:
        counts = histogram(df, col, lo, hi, by).withColumn("mark", F.lit(False))
        both = scratch.keep(counts.unionByName(marks).select("*", part))
        inner = Window.partitionBy(*by, "part").orderBy("v")
        running = both.withColumn("upto", F.sum("n").over(inner)).where("mark").select(*by, "part", "v", "upto")
        outer = Window.partitionBy(*by).orderBy("part")
        slices = both.groupBy(*by, "part").agg(F.sum("n").alias("m"))
        slices = _other(slices.withColumn("before", F.sum("m").over(outer) - F.col("m")), [*by, "part"], F.col("before"))
        upto = running.join(slices, _same([*by, "part"])).select(*by, "v", (F.col("upto") + F.col("before")).alias("upto"))
        upto = written(upto, scratch_dir(df.sparkSession, "running"))
    for edge in ("_before", "_last"):
        at = _other(upto, by, F.col("v").alias("_v"), F.col("upto").alias(f"_upto{edge}"))
        ends = ends.join(at, _same(by) & (F.col(edge) == F.col("_v")), "left").drop("_v", *[f"_{c}" for c in by])
    n = F.coalesce("_upto_last", _long(0)) - F.coalesce("_upto_before", _long(0))
    return ends.select(*by, "lo", "hi", F.greatest(n, _long(0)).alias("n"))


def ranked(df: DataFrame, cell: Sequence[str], order: Sequence[str], cap: int, salts: int = SALTS) -> DataFrame:
    """First `cap` rows per cell with their 1-based `rank` in the cell.

    A cell is ranked in two steps: each salted slice of it gives up at most
    `cap` rows, and only those are ranked together. That is exact, as a row past
    the cap in its slice is past the cap in its cell. Each map task cuts its rows
    of a slice to `cap` before the shuffle, for which the session's group-limit
    threshold is raised to the cap. A cell with a third of all rows is so
    sorted by `salts` tasks, and the last step gets `salts * cap` of its rows at
    most, whatever the cluster. `order` must be unique within a cell.
    """
    conf, limit = df.sparkSession.conf, "spark.sql.optimizer.windowGroupLimitThreshold"
    if int(conf.get(limit, "1000")) < cap:
        conf.set(limit, str(cap))
    slices = Window.partitionBy(*cell, "_salt").orderBy(*order)
    df = (
        df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
        .withColumn("_slice_rank", F.row_number().over(slices))
        .where(F.col("_slice_rank") <= cap)
        .drop("_salt", "_slice_rank")
    )
    whole = Window.partitionBy(*cell).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= cap)


def cap_cells(df: DataFrame, cell: Sequence[str], order: Sequence[str], cap: int) -> DataFrame:
    """At most `cap` rows per cell; `overflow_rows` tells what was left out."""
    return ranked(df, cell, order, cap).drop("rank")


def overflow_rows(df: DataFrame, cell: Sequence[str], cap: int) -> DataFrame:
    """(cell, n, left_out) of the cells over the cap."""
    counts = df.groupBy(*cell).agg(F.count("*").alias("n"))
    return counts.where(over_cap(F.col("n"), cap)).withColumn("left_out", F.col("n") - cap)


def paginate(
    df: DataFrame, cell: Sequence[str], order: Sequence[str], size: int = PAGE_SIZE, max_pages: int = MAX_PAGES_S
) -> DataFrame:
    """Rows with their `page` in the cell; only reachable pages are kept."""
    kept = ranked(df, cell, order, size * max_pages)
    return kept.withColumn("page", F.ceil(F.col("rank") / F.lit(size)).cast("int")).drop("rank")


def page_requests(
    counts: DataFrame, n: str = "n", size: int = PAGE_SIZE, max_pages: int = MAX_PAGES_S
) -> DataFrame:
    """One row per reachable result page of a counted cell: pages 1..min(ceil(n/size), max)."""
    last = F.least(F.ceil(F.col(n) / F.lit(size)).cast("int"), F.lit(max_pages))
    return counts.where(F.col(n) > 0).withColumn("page", F.explode(F.sequence(F.lit(1), last)))
