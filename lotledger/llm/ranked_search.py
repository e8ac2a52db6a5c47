"""Ranked search of a corpus: MaxScore over blocks of an index, with bounds of term pairs."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lotledger.llm.arrays import PIECE, flat, lowered, words
from lotledger.session import scratch_dir, written

#: Results per query.
TOP = 50
#: Postings of an index block, about: this bounds a task's memory.
BLOCK = 1 << 18
#: Terms of the queries that are searched together, about; more queries take more passes over the corpus.
PASS_TERMS = 1 << 19
#: Impacts are told apart by levels of a quarter power of two when thresholds are set.
LEVELS = np.unique((2 ** (np.arange(4 * 62) / 4)).astype(np.int64))

TERM = np.zeros(256, bool)
TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def term_runs(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Digests of a text column's terms and the row of each, a bounded number of bytes at a time.

    A term is a run of letters, digits and bytes beyond ASCII, lower-cased in ASCII only. Texts are cut between terms.
    """
    buf, at = flat(column)
    buf = lowered()[buf]
    start = 0
    while start < len(buf):
        end = min(start + PIECE, len(buf))
        while end < len(buf) and TERM[buf[end]]:
            gap = np.flatnonzero(~TERM[buf[end : end + PIECE]])
            end = end + int(gap[0]) if len(gap) else min(end + PIECE, len(buf))
        row = int(np.searchsorted(at, start, "right")) - 1
        inside = at[(at > start) & (at < end)]
        digests, bounds = words(buf[start:end], np.concatenate([[start], inside, [end]]) - start, TERM)
        yield digests, np.repeat(np.arange(row, row + len(bounds) - 1), np.diff(bounds))
        start = end


def query_terms(queries: DataFrame, item_id: str, text: str) -> DataFrame:
    """One row per item and different term digest: `item_id`, `term`. Rows of one id are one item."""
    kind = queries.schema[item_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for digests, row in term_runs(b.column("text")):
                yield pa.RecordBatch.from_arrays([b.column("item_id").take(pa.array(row)), pa.array(digests.view(np.int64))], ["item_id", "term"])

    rows = queries.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"item_id {kind}, term bigint").distinct()


@dataclass
class Pass:
    """Queries that are searched together. Their size is bounded by PASS_TERMS, not by the corpus.

    A query's terms are paired in the order of their weight. `units` holds, per
    query, (pair or -1, term, other term or -1) for each pair and for a term that is left.
    """

    items: pa.Array
    terms: list[np.ndarray]
    vocabulary: np.ndarray
    weights: np.ndarray | None = None
    pairs: np.ndarray | None = None
    units: list[np.ndarray] | None = None
    documents: int = 0
    occurrences: int = 0
    least: np.ndarray | None = None

    def weigh(self, documents: int, occurrences: int, holding: dict[int, int]) -> None:
        self.documents, self.occurrences = documents, occurrences
        self.weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * holding.get(t, 0) + 1))) for t in range(len(self.vocabulary))], np.int64)
        numbers: dict[tuple[int, int], int] = {}
        self.units = []
        for terms in self.terms:
            ordered = terms[np.lexsort((terms, -self.weights[terms]))].tolist()
            twos = [(a, b) if a < b else (b, a) for a, b in zip(ordered[::2], ordered[1::2])]
            rest = [(-1, ordered[-1], -1)] if len(ordered) % 2 else []
            self.units.append(np.array([(numbers.setdefault(p, len(numbers)), *p) for p in twos] + rest, np.int64).reshape(-1, 3))
        self.pairs = np.array(list(numbers), np.int64).reshape(-1, 2)


def passes(spark: SparkSession, terms: DataFrame) -> Iterator[Pass]:
    """The queries in passes of bounded size; equal terms of a pass have one number."""
    items = terms.groupBy("item_id").agg(F.collect_list("term").alias("terms"))
    items = written(items, scratch_dir(spark, "queries"))
    total = items.agg(F.sum(F.size("terms"))).first()[0] or 0
    count = 2 * total // PASS_TERMS + 1
    for k in range(count):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(count)) == k).toArrow()
        digests = np.asarray(own.column("terms").combine_chunks().flatten()).view(np.uint64)
        vocabulary, number = np.unique(digests, return_inverse=True)
        ends = np.cumsum(np.asarray(pc.list_value_length(own.column("terms")).combine_chunks()))
        if len(ends):
            yield Pass(own.column("item_id").combine_chunks(), np.split(number, ends[:-1]), vocabulary)


def forward(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Per document its number of terms `n`, and which terms of the vocabulary it holds (`terms`) how often (`tfs`)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            n, hits = np.zeros(b.num_rows, np.int64), [np.empty(0, np.int64)]
            for digests, row in term_runs(b.column("text")):
                n += np.bincount(row, minlength=b.num_rows)
                place = np.minimum(np.searchsorted(known, digests), len(known) - 1)
                hit = known[place] == digests
                hits.append(row[hit] * len(known) + place[hit])
            key, tf = np.unique(np.concatenate(hits), return_counts=True)
            ends = pa.array(np.searchsorted(key, np.arange(b.num_rows + 1) * len(known)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (key % len(known), tf)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n), *lists], ["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, tfs array<int>")


def _lists(key: np.ndarray, of: int) -> tuple[np.ndarray, np.ndarray]:
    """Which lists a sorted key (list * of + slot) has, and where each begins (and the end)."""
    held, begin = np.unique(key // of, return_index=True)
    return held, np.append(begin, len(key))


#: Columns of an index block, each an array: the documents, the lists of terms, those of pairs.
INDEX = {"docs": "bigint", "term": "int", "term_at": "int", "slot": "int", "impact": "bigint", "most": "bigint", "pair": "int", "pair_at": "int", "pair_slot": "int", "pair_most": "bigint"}
#: How many impacts a list has in each level.
COUNTS = "level array<struct<list:int,level:int,n:int>>"


def index(rows: DataFrame, search: Pass) -> DataFrame:
    """The corpus in blocks of documents, a row each.

    A block has its terms' lists (documents and impacts) with their greatest impacts,
    and for every pair of terms that some query pairs the list of documents that hold
    both, with the greatest sum of both impacts. `level` counts impacts by
    level: of terms, and (numbered after them) of pairs.
    """
    shared = rows.sparkSession.sparkContext.broadcast((search.weights, search.pairs, search.documents, search.occurrences))

    def block(docs: list[pa.Array], n: np.ndarray, size: np.ndarray, term: np.ndarray, tf: np.ndarray) -> list[tuple]:
        weights, pairs, total, occurrences = shared.value
        count = len(n)
        slot = np.repeat(np.arange(count), size)
        m = 50 + 50 * n * total // max(occurrences, 1)
        impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[slot]))
        some = impact > 0
        key = term[some] * count + slot[some]
        order = np.argsort(key)
        key, impact = key[order], impact[some][order]
        held, begin = _lists(key, count)
        size_of = np.zeros(len(weights) + 1, np.int64)
        size_of[held] = np.diff(begin)
        first = np.zeros(len(weights) + 1, np.int64)
        first[held] = begin[:-1]
        # Of each pair the shorter list's documents, looked up in the longer one.
        both = np.flatnonzero((size_of[pairs[:, 0]] > 0) & (size_of[pairs[:, 1]] > 0)) if len(pairs) else np.empty(0, np.int64)
        a, b = pairs[both].T if len(both) else (both, both)
        a, b = np.where(size_of[a] <= size_of[b], a, b), np.where(size_of[a] <= size_of[b], b, a)
        each = size_of[a]
        at = np.repeat(first[a] - np.append(0, np.cumsum(each))[:-1], each) + np.arange(each.sum())
        wanted = np.repeat(b, each) * count + key[at] % count
        found = np.minimum(np.searchsorted(key, wanted), max(len(key) - 1, 0))
        hit = key[found] == wanted if len(key) else np.empty(0, bool)
        pair_key = np.repeat(both, each)[hit] * count + key[at][hit] % count
        joint = impact[at[hit]] + impact[found[hit]]
        order = np.argsort(pair_key)
        pair_key, joint = pair_key[order], joint[order]
        pair, pair_begin = _lists(pair_key, count)
        list_of = np.concatenate([key // count, len(weights) + pair_key // count])
        level, number = np.unique(list_of * len(LEVELS) + np.searchsorted(LEVELS, np.concatenate([impact, joint]), "right") - 1, return_counts=True)
        levels = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (level // len(LEVELS), level % len(LEVELS), number)], ["list", "level", "n"])
        greatest = lambda x, begin: np.maximum.reduceat(x, begin[:-1]) if len(x) else np.empty(0, np.int64)
        return [pa.concat_arrays(docs), held.astype(np.int32), begin.astype(np.int32), (key % count).astype(np.int32), impact, greatest(impact, begin), pair.astype(np.int32), pair_begin.astype(np.int32), (pair_key % count).astype(np.int32), greatest(joint, pair_begin), levels]

    def packed(parts: list[tuple]) -> pa.RecordBatch:
        docs, n, size, term, tf = zip(*parts)
        made = block(list(docs), *[np.concatenate(x) for x in (n, size, term, tf)])
        lists = [x if isinstance(x, pa.Array) else pa.array(x) for x in made]
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists], [*INDEX, "level"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for b in batches:
            ends = np.append(0, np.cumsum(np.asarray(pc.list_value_length(b.column("terms")), np.int64)))
            term, tf = (np.asarray(b.column(c).flatten(), np.int64) for c in ("terms", "tfs"))
            n = np.asarray(b.column("n"))
            i = 0
            while i < b.num_rows:
                j = max(i + 1, int(np.searchsorted(ends, ends[i] + BLOCK - held, "right")) - 1)
                parts.append((b.column("doc_id").slice(i, j - i), n[i:j], np.diff(ends[i : j + 1]), term[ends[i] : ends[j]], tf[ends[i] : ends[j]]))
                held += int(ends[j] - ends[i])
                i = j
                if held >= BLOCK or i < b.num_rows:
                    yield packed(parts)
                    parts, held = [], 0
        if parts:
            yield packed(parts)

    return rows.where(F.size("terms") > 0).mapInArrow(run, ", ".join([*(f"{c} array<{kind}>" for c, kind in INDEX.items()), COUNTS]))


def thresholds(blocks: DataFrame, search: Pass, top: int) -> np.ndarray:
    """Per query a score that `top` documents reach: they have a term or a pair of that impact, counted over all blocks."""
    counted = blocks.select(F.explode("level").alias("l")).groupBy("l.list", "l.level").agg(F.sum("l.n").alias("n"))
    above = F.sum("n").over(Window.partitionBy("list").orderBy(F.col("level").desc()))
    reached = counted.withColumn("above", above).where(F.col("above") >= top).groupBy("list").agg(F.max("level").alias("level")).toArrow()
    least = np.zeros(len(search.vocabulary) + len(search.pairs) + 1, np.int64)
    least[np.asarray(reached.column("list"))] = LEVELS[np.asarray(reached.column("level"))]
    out = []
    for units in search.units:
        pair, term, other = units.T
        known = np.concatenate([term, other[other >= 0], len(search.vocabulary) + pair[pair >= 0]])
        out.append(least[known].max(initial=0))
    return np.array(out, np.int64)


class Block:
    """One row of the index as arrays, with lists found by their number."""

    def __init__(self, row: dict[str, np.ndarray], terms: int, pairs: int):
        self.docs, self.size = row["docs"], len(row["docs"])
        self.row = row
        self.term, self.most = self._by_number("term", "most", terms)
        self.pair, self.pair_most = self._by_number("pair", "pair_most", pairs)

    def _by_number(self, name: str, most: str, count: int) -> tuple[np.ndarray, np.ndarray]:
        place, bound = np.full(count + 1, -1), np.zeros(count + 1, np.int64)
        place[self.row[name]] = np.arange(len(self.row[name]))
        bound[self.row[name]] = self.row[most]
        return place, bound

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        k = self.term[term]
        s, e = self.row["term_at"][k : k + 2] if k >= 0 else (0, 0)
        return self.row["slot"][s:e], self.row["impact"][s:e]

    def together(self, pair: int) -> np.ndarray:
        k = self.pair[pair]
        s, e = self.row["pair_at"][k : k + 2] if k >= 0 else (0, 0)
        return self.row["pair_slot"][s:e]

    def best(self, units: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents (slots) that score `least` or more, all of them, and their scores.

        A pair of terms adds at most the greater of its terms' maxima to a document that
        holds one, and its joint maximum to one that holds both. Pairs are left aside,
        least first, while their terms' maxima sum to less than `least`: a document that
        holds no term of the other pairs must then be in one of the lists of both terms.
        Candidates so found are looked up in the pairs aside, as long as all that
        is left could lift them to `least`.
        """
        pair, term, other = units.T
        alone = np.maximum(self.most[term], self.most[other])
        units, alone = units[alone > 0], alone[alone > 0]
        order = np.argsort(alone, kind="stable")
        units, alone = units[order], alone[order]
        bound = np.maximum(alone, self.pair_most[units[:, 0]])
        if not len(units) or bound.sum() < least:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        aside = int(np.searchsorted(np.cumsum(alone), least, "left"))
        score, asked = np.zeros(self.size, np.int64), np.zeros(self.size, bool)
        for _, a, b in units[aside:].tolist():
            for t in (a, b):
                slot, impact = self.postings(t)
                score[slot] += impact
                asked[slot] = True
        for p in units[:aside, 0].tolist():
            asked[self.together(p)] = True
        slots = np.flatnonzero(asked)
        later = np.argsort(-bound[:aside], kind="stable")
        left = int(bound[:aside].sum())
        for u in later.tolist():
            slots = slots[score[slots] + left >= least]
            if not len(slots):
                break
            for t in units[u, 1:].tolist():
                own, impact = self.postings(t)
                if len(own):
                    place = np.minimum(np.searchsorted(own, slots), len(own) - 1)
                    hit = own[place] == slots
                    score[slots[hit]] += impact[place[hit]]
            left -= int(bound[u])
        slots = slots[(score[slots] >= least) & (score[slots] > 0)]
        return slots, score[slots]


def search_blocks(blocks: DataFrame, search: Pass, top: int, kind: str) -> DataFrame:
    """(item_id of the given type, doc_id, score): of every task the best documents of each query, at most `top`."""
    shared = blocks.sparkSession.sparkContext.broadcast(search)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        want = shared.value
        least = want.least.copy()
        # Of each query: scores, ids, and whether the id is null (which comes last).
        kept = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)) for _ in want.terms]
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].values for c in batch.schema.names}
                absent = np.asarray(row["docs"].is_null())
                row = {c: np.asarray(v.fill_null(0) if v.null_count else v) for c, v in row.items()}
                b = Block(row, len(want.vocabulary), len(want.pairs))
                for q, units in enumerate(want.units):
                    slots, score = b.best(units, int(least[q]))
                    if not len(slots):
                        continue
                    score, ids, null = (np.concatenate(x) for x in zip(kept[q], (score, b.docs[slots], absent[slots])))
                    order = np.lexsort((ids, null, -score))[:top]
                    kept[q] = score[order], ids[order], null[order]
                    if len(order) == top:
                        least[q] = max(least[q], kept[q][0][-1])
        size = [len(k[0]) for k in kept]
        score, ids, null = (np.concatenate(x) for x in zip(*kept))
        yield pa.RecordBatch.from_arrays([want.items.take(pa.array(np.repeat(np.arange(len(size)), size))), pa.array(ids, pa.int64(), mask=null), pa.array(score)], ["item_id", "doc_id", "score"])

    return blocks.select(*INDEX).mapInArrow(run, f"item_id {kind}, doc_id bigint, score bigint")


def search(docs: DataFrame, queries: DataFrame, top: int = TOP, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", query: str = "text") -> DataFrame:
    """Per query its `top` best documents: `item_id`, `rank` (from 1), `doc_id`, `score` (above 0).

    A document scores the weights of the query's terms times their frequency, damped by
    its own length, all in whole numbers but the weight's logarithm. Equal scores
    follow the integer `doc_id`, null last; equal rows are documents of their own, in any order among
    themselves. Rows of one `item_id` are one query with all their terms. Null and empty texts hold no
    terms, and very long ones are read a piece at a time. A query without terms, or whose terms no
    document holds, has no rows. Terms are told apart by 64-bit digests.
    """
    spark = docs.sparkSession
    kind = queries.schema[item_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    out = spark.createDataFrame([], f"item_id {kind}, doc_id bigint, score bigint")
    for want in passes(spark, query_terms(queries, item_id, query)):
        held = written(forward(rows, want.vocabulary), scratch_dir(spark, "forward"))
        documents, occurrences = held.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        holding = dict(held.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
        want.weigh(documents, occurrences, holding)
        blocks = written(index(held, want), scratch_dir(spark, "index"))
        want.least = thresholds(blocks, want, top)
        out = out.unionByName(search_blocks(blocks, want, top, kind))
    rank: Column = F.row_number().over(Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return out.withColumn("rank", rank).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
