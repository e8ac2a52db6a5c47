"""Word windows that a corpus repeats, found by recompression: texts shrink as runs and pairs get names that hold everywhere."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lotledger.llm.arrays import mix, only, pieces, powers, running, words
from lotledger.session import scratch_dir

#: Words of a window.
WINDOW = 13
#: Levels at which windows look for a mark; levels that a task makes before names are compared; levels of a Spark round.
MARKS, BASE, STEP = 2, 11, 6
#: Bits of the filters that keep most rows without a partner out of a join; their size doesn't follow the data, and the joins are exact without them.
FILTER_BITS = 1 << 25

_INNER = np.ones(256, bool)
_INNER[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes as other bytes, so that a second digest of a word doesn't depend on the first.
_OTHER = np.random.default_rng(13).permutation(256).astype(np.uint8)
_OTHER_INNER = np.empty(256, bool)
_OTHER_INNER[_OTHER] = _INNER

LAST = (1 << 63) - 1


def named(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two digests of each word of some texts, and each text's first word (and the end)."""
    one, bounds = words(buf, at, _INNER)
    two, _ = words(_OTHER[buf], at, _OTHER_INNER)
    return one, two, bounds


def digests(names: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The digest of names[lo:hi] for each pair."""
    total = running(names)
    _, down = powers(len(names) + 1)
    return mix((total[hi] - total[lo]) * down[lo])


def shrink(a: np.ndarray, b: np.ndarray, apart: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One level: symbols join their equals (a run), and runs of left symbols the run of right ones behind them (a pair).

    A name (a, b) alone tells whether a symbol is left or right at a level, so what happens between
    two symbols depends on these two only. `apart` forbids joins with the symbol
    before. Returns which symbols begin a new one, and the new names; a symbol that joined nothing keeps its own.
    """
    right = mix(a ^ np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) & np.uint64(1) == 1
    joins = (a[1:] == a[:-1]) & (b[1:] == b[:-1]) | ~right[:-1] & right[1:]
    head = np.flatnonzero(np.concatenate([[True], ~joins | apart[1:]])) if len(a) else np.empty(0, np.int64)
    end = np.append(head[1:], len(a))
    alone = end - head == 1
    return head, *(np.where(alone, x[head], digests(x, head, end)) for x in (a, b))


class Parsed:
    """Some texts as symbols. Each text is preceded by a fence, which takes a place but is no word; two end the last, so that what follows its last word is in sight of no window."""

    def __init__(self, one: np.ndarray, two: np.ndarray, bounds: np.ndarray, window: int):
        self.window, self.size = window, np.diff(bounds)
        rows = len(bounds) - 1
        self.base = bounds[:-1] + np.arange(rows) + 1
        place = np.arange(len(one)) + np.repeat(np.arange(rows), self.size) + 1
        total = len(one) + rows + 2
        self.fence = np.ones(total, bool)
        self.fence[place] = False
        self.a, self.b = np.zeros(total, np.uint64), np.zeros(total, np.uint64)
        self.a[place], self.b[place] = one, two

    def levels(self) -> Iterator[tuple]:
        """Per level: symbol starts, names, fences, and the places left and right that were looked at to know each start, with the digest of the words between."""
        a, b, start, fence = self.a, self.b, np.arange(len(self.a)), self.fence
        left, right = start, start
        for level in range(1, max(MARKS, BASE) + 1):
            apart = fence | np.concatenate([[True], fence[:-1]])
            head, na, nb = shrink(a, b, apart, level)
            before, after = np.maximum(head - 1, 0), np.minimum(head + 1, len(a) - 1)
            left, right = left[before], right[after]
            seen = digests(self.a, left, right) if level <= MARKS else None
            a, b, start, fence = na, nb, start[head], fence[head]
            yield start, a, b, fence, left, right, seen

    def marks(self, levels: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Marks as (row, name, first window); a mark serves the windows up to the row's next mark.

        A window takes the highest level of which it has a symbol boundary with all that
        made it one. Of several it takes the one with the most words around it, then that with the least digest.
        That depends on the window's words only, so equal windows have equal marks. Without
        any (as in a long run of one word) its mark is its own digest.
        """
        count = np.maximum(self.size - self.window + 1, 0)
        row = np.repeat(np.arange(len(count)), count)
        first = np.repeat(self.base - np.append(0, np.cumsum(count))[:-1], count) + np.arange(count.sum())
        name, at = np.zeros(len(first), np.uint64), np.full(len(first), -1)
        todo = np.arange(len(first))
        for start, _, _, _, left, right, seen in reversed(levels[:MARKS]):
            s = first[todo]
            order = (np.maximum(63 - (right - left), 0).astype(np.uint64) << np.uint64(58)) | (seen >> np.uint64(6))
            lo, hi = np.searchsorted(left, s, "left"), np.searchsorted(right, s + self.window, "right")
            some = hi > lo
            mine, lo, hi = todo[some], lo[some], hi[some]
            best = lo.copy()
            for k in range(1, int((hi - lo).max(initial=1))):
                nearer = np.flatnonzero(lo + k < hi)
                other = lo[nearer] + k
                better = order[other] < order[best[nearer]]
                best[nearer[better]] = other[better]
            name[mine], at[mine] = seen[best], start[best]
            todo = todo[~some]
        name[todo] = digests(self.a, first[todo], first[todo] + self.window)
        fresh = np.ones(len(first), bool)
        fresh[1:] = (name[1:] != name[:-1]) | (at[1:] != at[:-1]) | (row[1:] != row[:-1])
        return row[fresh], name[fresh], first[fresh] - self.base[row[fresh]]

    def symbols(self, levels: list[tuple]) -> tuple[np.ndarray, ...]:
        """The symbols of level BASE as (row, a, b, first word, end)."""
        start, a, b, fence, *_ = levels[BASE - 1]
        end = np.append(start[1:], len(self.a))
        own = ~fence
        row = np.searchsorted(self.base, start[own], "right") - 1
        return row, a[own], b[own], start[own] - self.base[row], end[own] - self.base[row]


def _lists(row: np.ndarray, rows: int, *columns: np.ndarray) -> list[pa.Array]:
    """Columns sorted by row as lists, one per row."""
    ends = pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32))
    return [pa.ListArray.from_arrays(ends, pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int32))) for c in columns]


def spans_of(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Maximal runs (start, end) that spans cover, in order."""
    if not len(lo):
        return np.empty((0, 2), np.int64)
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    first = np.concatenate([[True], lo[1:] > hi[:-1]])
    return np.column_stack([lo[first], hi[np.append(np.flatnonzero(first)[1:] - 1, len(lo) - 1)]])


class Filter:
    """Which values a long column of a written table may have: one bit for each remainder by FILTER_BITS."""

    def __init__(self, table: DataFrame, key: str):
        place = F.col(key).bitwiseAND(FILTER_BITS - 1)
        told = table.groupBy(F.shiftright(place, 5).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(`{key}` & {FILTER_BITS - 1} & 31 AS int))")).alias("bits")).toArrow()
        bits = np.zeros(FILTER_BITS >> 5, np.uint32)
        bits[np.asarray(told.column("word"))] = np.asarray(told.column("bits"))
        self.key, self.size, self.bits = key, FILTER_BITS, table.sparkSession.sparkContext.broadcast(bits)

    def may(self, values: np.ndarray) -> np.ndarray:
        at = values & (self.size - 1)
        return self.bits.value[at >> 5] >> (at & 31) & 1 == 1

    def of(self, rows: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(pa.array(self.may(np.asarray(b.column(self.key)))))

        return rows.mapInArrow(run, rows.schema)


class Dedup:
    """The tables of one run, each written once to the shared scratch folder."""

    def __init__(self, docs: DataFrame, doc_id: str, text: str, window: int):
        self.spark, self.window = docs.sparkSession, window
        self.folder = scratch_dir(self.spark, "symbols")
        body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
        self.docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LAST)).alias("doc"), F.xxhash64(F.col(doc_id), body).alias("row"), body.alias("text"))

    def kept(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        """Deletes tables that nothing reads any more."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        files = path(self.folder).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for name in names:
            files.delete(path(f"{self.folder}/{name}"), True)

    def scanned(self) -> DataFrame:
        """Per row `n_words`, `sha` of its words, its marks (`mark`, `lo`) and its symbols (`a`, `b`, `at`, `until`)."""
        window = self.window

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column("text")
                for i, j, buf, at in pieces(texts):
                    own = batch.slice(i, j - i)
                    sha = [hashlib.sha256(b" ".join(t.as_py().split())).hexdigest() for t in own.column("text")]
                    parsed = Parsed(*named(buf, at), window)
                    levels = list(parsed.levels())
                    lists = _lists(*(m := parsed.marks(levels))[:1], j - i, *m[1:]) + _lists(*(s := parsed.symbols(levels))[:1], j - i, *s[1:])
                    yield pa.RecordBatch.from_arrays([*(own.column(c) for c in ("doc_id", "doc", "row")), pa.array(parsed.size), pa.array(sha), *lists], ["doc_id", "doc", "row", "n_words", "sha", "mark", "lo", "a", "b", "at", "until"])

        kind = self.docs.schema["doc_id"].dataType.simpleString()
        return self.kept(self.docs.mapInArrow(run, f"doc_id {kind}, doc bigint, row bigint, n_words bigint, sha string, mark array<bigint>, lo array<int>, a array<bigint>, b array<bigint>, at array<int>, until array<int>"), "scanned")

    def settled(self, scanned: DataFrame) -> DataFrame:
        """Spans (`doc`, `row`, `start`, `end`) whose words a document with a smaller id has in one piece, from rounds of names.

        A round finds the names that more than one document has, with the least of these. Only such
        names go on: a symbol that is no one else's stays between them as a gap, at which longer symbols end. Then
        what lies side by side is shrunk by STEP levels. The rounds end when nothing is left to join.
        """
        number = F.sequence(F.lit(0), F.size("a") - 1)
        strings, found, turn = scanned.where(F.size("a") > 0).select("doc", "row", number.alias("k"), "a", "b", "at", "until"), [], 0
        while True:
            each = strings.select("doc", "row", F.inline(F.arrays_zip("k", "a", "b", "at", "until")))
            # Written, so that both sides of the join below come from a shuffle of their own and a hot name can be split.
            shared = self.kept(each.groupBy("a", "b").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most").select("a", "b", "least"), f"names{turn}")
            hits = self.kept(Filter(shared, "a").of(each).join(shared, ["a", "b"]), f"hits{turn}")
            long = F.col("until") - F.col("at") >= self.window
            found.append(hits.where((F.col("doc") > F.col("least")) & long).select("doc", "row", F.col("at").alias("start"), F.col("until").alias("end")))
            turn += 1
            strings = self.shrunk(hits.groupBy("doc", "row").agg(F.array_sort(F.collect_set(F.struct("k", "a", "b", "at", "until"))).alias("s")).where(F.size("s") > 1), BASE + (turn - 1) * STEP)
            again = f"strings{turn}"
            strings = self.kept(strings, again)
            self.drop(f"strings{turn - 1}", f"names{turn - 1}")
            if strings.isEmpty():
                break
        out = found[0]
        for f in found[1:]:
            out = out.unionByName(f)
        out = self.kept(out, "settled")
        self.drop(again, *(f"hits{i}" for i in range(turn)))
        return out

    def shrunk(self, strings: DataFrame, level: int) -> DataFrame:
        """Strings of shared symbols, STEP levels on; symbols that neither changed nor have a neighbour are done with."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                s = batch.column("s")
                row = np.repeat(np.arange(batch.num_rows), np.asarray(s.value_lengths()))
                k, a, b, at, until = (np.asarray(s.flatten().field(c)) for c in ("k", "a", "b", "at", "until"))
                a, b = a.view(np.uint64), b.view(np.uint64)
                apart = np.ones(len(k), bool)
                apart[1:] = (k[1:] != k[:-1] + 1) | (row[1:] != row[:-1])
                old, changed = apart, np.zeros(len(k), bool)
                for turn in range(STEP):
                    head, na, nb = shrink(a, b, apart, level + 1 + turn)
                    changed = np.logical_or.reduceat(changed, head) | (np.diff(np.append(head, len(a))) > 1) if len(head) else changed
                    until = until[np.append(head[1:], len(a)) - 1] if len(head) else until
                    a, b, at, row, apart = na, nb, at[head], row[head], apart[head]
                near = ~apart
                near[:-1] |= ~apart[1:]
                # A gap in the numbers wherever there was one between the symbols.
                number = np.arange(len(a)) + np.cumsum(apart)
                going = near | changed
                lists = _lists(row[going], batch.num_rows, number[going], a[going], b[going], at[going], until[going])
                out = pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("row"), *lists], ["doc", "row", "k", "a", "b", "at", "until"])
                yield out.filter(pa.array(np.bincount(row[going], minlength=batch.num_rows) > 0))

        return strings.mapInArrow(run, "doc bigint, row bigint, k array<int>, a array<bigint>, b array<bigint>, at array<int>, until array<int>")

    def candidates(self, scanned: DataFrame, texts: DataFrame, settled: DataFrame) -> DataFrame:
        """Per row the windows (`lo`, `hi` of each run) that aren't settled and whose mark occurs in another text too."""
        window = self.window
        text = F.conv(F.substring("sha", 1, 15), 16, 10).cast("bigint").alias("text")
        marks = scanned.select(F.explode("mark").alias("mark"), text).groupBy("mark").agg(F.min("text").alias("one"), F.max("text").alias("other"))
        often = self.kept(marks.where("one <> other").select("mark"), "often")
        filled = Filter(often, "mark")

        def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Marks that may occur more than once, with their windows."""
            for b in batches:
                length = np.asarray(b.column("mark").value_lengths())
                mark, lo = (np.asarray(b.column(c).flatten()) for c in ("mark", "lo"))
                row = np.repeat(np.arange(b.num_rows), length)
                hi = np.append(lo[1:], 0) - 1
                some = length > 0
                hi[np.cumsum(length)[some] - 1] = (np.asarray(b.column("n_words")) - window)[some]
                hit = filled.may(mark)
                of = pa.array(row[hit])
                yield pa.RecordBatch.from_arrays([b.column("doc").take(of), b.column("row").take(of), pa.array(mark[hit]), pa.array(lo[hit]), pa.array(hi[hit].astype(np.int32))], ["doc", "row", "mark", "lo", "hi"])

        marks = scanned.select("doc", "row", "n_words", "mark", "lo").mapInArrow(maybe, "doc bigint, row bigint, mark bigint, lo int, hi int").join(often, "mark", "left_semi")
        copies = scanned.select("doc", "row", "sha", "n_words").join(texts, "sha").where(F.col("doc") > F.col("least"))
        whole = settled.unionByName(copies.select("doc", "row", F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
        done = whole.groupBy("doc", "row").agg(F.collect_set(F.struct("start", "end")).alias("done"))
        wanted = self.kept(marks.groupBy("doc", "row").agg(F.collect_set(F.struct("lo", "hi")).alias("want")), "wanted")

        def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Runs of windows that don't lie in one settled span as a whole."""
            for b in batches:
                out = []
                for want, spans in zip(b.column("want"), b.column("done")):
                    lo, hi = (np.asarray(want.values.field(c), np.int64) for c in ("lo", "hi"))
                    order = np.argsort(lo)
                    lo, hi = lo[order], hi[order]
                    if spans.is_valid:
                        s, e = (np.asarray(spans.values.field(c), np.int64) for c in ("start", "end"))
                        order = np.lexsort((-e, s))
                        s, e = s[order], np.maximum.accumulate(e[order])
                        k = np.searchsorted(s, lo, "right") - 1
                        open_ = (k < 0) | (e[k] < hi + window)
                        lo, hi = lo[open_], hi[open_]
                    out.append((lo, hi))
                size = np.array([len(x) for x, _ in out], np.int64)
                row = np.repeat(np.arange(len(out)), size)
                lists = _lists(row, len(out), *(np.concatenate([np.empty(0, np.int64), *(x[i] for x in out)]) for i in range(2)))
                yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("row"), *lists], ["doc", "row", "lo", "hi"]).filter(pa.array(size > 0))

        out = self.kept(wanted.join(done, ["doc", "row"], "left").select("doc", "row", "want", "done").mapInArrow(rest, "doc bigint, row bigint, lo array<int>, hi array<int>"), "candidates")
        self.drop("wanted", "often")
        return out

    def verified(self, candidates: DataFrame) -> DataFrame:
        """Spans (`doc`, `row`, `start`, `end`) of windows that a document with a smaller id has word by word (128 bits of digest)."""
        window = self.window

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i, j, buf, at in pieces(b.column("text")):
                    one, two, bounds = named(buf, at)
                    lists = [b.column(c).slice(i, j - i) for c in ("lo", "hi")]
                    row = np.repeat(np.arange(j - i), np.asarray(lists[0].value_lengths()))
                    lo, hi = (np.asarray(x.flatten(), np.int64) for x in lists)
                    each = hi - lo + 1
                    row, first = np.repeat(row, each), np.repeat(lo - np.append(0, np.cumsum(each))[:-1], each) + np.arange(each.sum())
                    start = first + bounds[row]
                    w1, w2 = (digests(x, start, start + window) for x in (one, two))
                    # Equal windows side by side, as in a run of one word, are one row.
                    fresh = np.ones(len(start), bool)
                    fresh[1:] = (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1]) | (row[1:] != row[:-1]) | (first[1:] != first[:-1] + 1)
                    head = np.flatnonzero(fresh)
                    end = first[np.append(head[1:], len(first)) - 1] + window if len(head) else first
                    of = pa.array(row[head] + i)
                    yield pa.RecordBatch.from_arrays([pa.array(w1[head].view(np.int64)), pa.array(w2[head].view(np.int64)), b.column("doc").take(of), b.column("row").take(of), pa.array(first[head].astype(np.int32)), pa.array(end.astype(np.int32))], ["w1", "w2", "doc", "row", "start", "end"])

        text = self.texts(candidates)
        windows = self.kept(text.select("doc", "row", "text", "lo", "hi").mapInArrow(run, "w1 bigint, w2 bigint, doc bigint, row bigint, start int, end int"), "windows")
        first = self.kept(windows.groupBy("w1", "w2").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most").select("w1", "w2", "least"), "first")
        out = self.kept(Filter(first, "w1").of(windows).join(first, ["w1", "w2"]).where(F.col("doc") > F.col("least")).select("doc", "row", "start", "end"), "verified")
        self.drop("windows", "first", "candidates")
        return out

    def texts(self, wanted: DataFrame) -> DataFrame:
        """The written rows of `wanted` with their texts; those of no other row enter the shuffle, as far as a filter tells."""
        return only(self.docs.select("doc", "row", "text"), "row", wanted).join(wanted, ["doc", "row"])


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row `doc_id`, `n_words`, `n_removed`, `kept_sha256` once the words of windows that a smaller id has too are gone.

    Words are runs of bytes that aren't blank; a window is `window` of them. A word goes if a window
    that covers it also starts in a document with a smaller integer id; texts of fewer words stay whole.
    A null id comes after all others. Rows with equal ids (repeated rows too) take nothing from each
    other. Null counts as empty and has no words. A text is read by one task, whatever its length.
    """
    run = Dedup(docs, doc_id, text, window)
    scanned = run.scanned()
    # The narrow columns apart, so that the marks can go before texts move.
    every = run.kept(scanned.select("doc_id", "doc", "row", "n_words", "sha"), "rows")
    texts = run.kept(every.where(F.col("n_words") >= window).groupBy("sha").agg(F.min("doc").alias("least")), "texts")
    settled = run.settled(scanned)
    candidates = run.candidates(scanned, texts, settled)
    run.drop("scanned")
    spans = settled.unionByName(run.verified(candidates))
    some = run.kept(spans.groupBy("doc", "row").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            gone, sha = [], []
            for body, spans in zip(b.column("text"), b.column("spans")):
                runs = spans_of(*(np.asarray(spans.values.field(c), np.int64) for c in ("start", "end")))
                parts, done, ws = [], 0, body.as_py().split()
                for s, e in runs.tolist():
                    parts += ws[done:s]
                    done = e
                gone.append(int((runs[:, 1] - runs[:, 0]).sum()))
                sha.append(hashlib.sha256(b" ".join(parts + ws[done:])).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("row"), pa.array(gone, pa.int64()), pa.array(sha, pa.string())], ["doc", "row", "gone", "kept"])

    partly = run.texts(some).select("doc", "row", "text", "spans").mapInArrow(cut, "doc bigint, row bigint, gone bigint, kept string").dropDuplicates(["doc", "row"])
    rows = every.join(texts, "sha", "left").join(partly, ["doc", "row"], "left")
    copied = F.coalesce(F.col("doc") > F.col("least"), F.lit(False))
    return rows.select(
        "doc_id",
        "n_words",
        F.when(copied, F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0).cast("bigint"))).alias("n_removed"),
        F.when(copied, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
    )
