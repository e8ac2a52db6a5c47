"""Long strings that a corpus repeats, found in collection suffix orders that grow by a symbol per string and round."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lotledger.llm.arrays import mix, only, pieces, powers, running
from lotledger.session import scratch_dir

#: Bytes of a string that counts as repeated; bytes of an anchor; bytes of a symbol.
WINDOW, ANCHOR, SYMBOL = 200, 32, 8
#: Contexts that one collection holds, about: this bounds a task's memory.
COLLECTION = 1000
#: An anchor in more texts than this is split by its windows instead of being gathered in one collection.
HOT = 20_000
#: Places per block of the range minimum.
BLOCK = 256

_PLACE = np.uint64((1 << 32) - 1)


def anchors(buf: np.ndarray, window: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one text: anchors, their digests, and the first string start that each serves.

    A string of `window` bytes is served by its k-gram whose digest has the least upper
    half, the leftmost of equals; so equal strings have equal anchors at equal places. The
    starts that an anchor serves are a run, and runs follow in the order of anchors.
    Of a run of one byte only the first string has an anchor: the others repeat
    the one before them, and their starts follow as a run with anchor -1.
    """
    if len(buf) < window:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    total = running(buf)
    _, down = powers(len(buf) + 1)
    n = len(buf) - size + 1
    h = mix((total[size:] - total[:-size]) * down[:n])
    width = window - size + 1
    # Upper half and place in one word: the least of each run of `width`, from the running minima of aligned blocks to either side.
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max)
    padded[:n] = (h & ~_PLACE) | np.arange(n, dtype=np.uint64)
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - width + 1
    place = (np.minimum(back[:starts], ahead[width - 1 : width - 1 + starts]) & _PLACE).astype(np.int64)
    change = np.concatenate([[0], np.cumsum(buf[1:] != buf[:-1])])
    flat = change[window - 1 :] == change[:starts]
    place[1:][flat[1:] & flat[:-1]] = -1
    los = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    at = place[los]
    return at, h[at], los


def range_least(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """min(values[lo:hi]) of each pair, lo < hi; whole blocks inside are looked up."""
    padded = np.concatenate([values, np.full(BLOCK - len(values) % BLOCK + BLOCK, np.iinfo(values.dtype).max, values.dtype)])
    whole = padded[: len(padded) // BLOCK * BLOCK].reshape(-1, BLOCK).min(1)

    def reduce(table: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        order = np.argsort(a, kind="stable")
        out = np.empty(len(a), table.dtype)
        out[order] = np.minimum.reduceat(table, np.column_stack([a[order], b[order]]).ravel())[::2]
        return out

    long = hi - lo > 2 * BLOCK
    out = np.empty(len(lo), values.dtype)
    if (~long).any():
        out[~long] = reduce(padded, lo[~long], hi[~long])
    if long.any():
        a, b = lo[long], hi[long]
        up, down = -(-a // BLOCK), b // BLOCK
        edges = np.minimum(reduce(padded, a, np.maximum(up * BLOCK, a + 1)), reduce(padded, np.minimum(down * BLOCK, b - 1), b))
        out[long] = np.minimum(edges, reduce(whole, up, down))
    return out


def collection(symbols: np.ndarray, bounds: np.ndarray, depth: int) -> np.ndarray:
    """For each symbol of some strings, whether `depth` symbols from it on also begin elsewhere in the collection.

    Strings are read from their ends. In every round each string that isn't used up
    puts its next symbol before its last suffix, and all these suffixes enter the
    sorted order at once: a suffix is (first symbol, place of the rest), which is
    how the Burrows-Wheeler transform's LF step orders them. An entry's common
    prefix with the one before it is 1 + the least between the places of their
    rests, or 0 if the first symbols differ.
    """
    m = len(bounds) - 1
    sym, tail, lcp = np.full(m, -1, np.int64), np.arange(m), np.zeros(m, np.int32)
    source = np.full(m, -1, np.int64)
    place = np.arange(m)
    left = np.diff(bounds)
    for turn in range(1, int(left.max(initial=0)) + 1):
        live = np.flatnonzero(left >= turn)
        at = bounds[live + 1] - turn
        size = len(sym)
        key = symbols[at] * (1 << 31) + place[live]
        order = np.argsort(key, kind="stable")
        live, at, key = live[order], at[order], key[order]
        into = np.searchsorted(sym * (1 << 31) + tail, key)
        new = into + np.arange(len(into))
        moved = np.arange(size) + np.cumsum(np.bincount(into, minlength=size + 1))[:size]
        total = size + len(new)
        merged_sym, rest, common, origin = np.empty(total, np.int64), np.empty(total, np.int64), np.empty(total, np.int32), np.empty(total, np.int64)
        for target, old, fresh in ((merged_sym, sym, symbols[at]), (rest, tail, place[live]), (common, lcp, 0), (origin, source, at)):
            target[moved] = old
            target[new] = fresh
        ask = np.unique(np.concatenate([new, new + 1]))
        ask = ask[(ask > 0) & (ask < total)]
        common[ask] = 0
        ask = ask[merged_sym[ask] == merged_sym[ask - 1]]
        if len(ask):
            common[ask] = 1 + range_least(lcp, rest[ask - 1] + 1, rest[ask] + 1)
        place[live] = new
        sym, tail, lcp, source = merged_sym, moved[rest], common, origin
    deep = np.zeros(len(symbols), bool)
    hit = lcp >= depth
    hit[:-1] |= hit[1:].copy()
    deep[source[hit & (source >= 0)]] = True
    return deep


def repeated_starts(contexts: list[bytes], offsets: list[int], window: int, symbol: int) -> list[np.ndarray]:
    """Of contexts whose anchors lie at `offsets`: the starts of strings that some context has at another place too.

    Starts are taken apart by their distance to the anchor modulo the symbol size,
    so that equal strings are cut into equal symbols.
    """
    strings, owner, first = [], [], []
    for i, (c, off) in enumerate(zip(contexts, offsets)):
        for phase in range(symbol):
            start = (off - phase) % symbol
            count = (len(c) - window - start) // symbol + 1
            if count > 0:
                end = start + (count - 1) * symbol + window
                strings.append(np.frombuffer(c[start:end], f">u{symbol}"))
                owner.append(i)
                first.append(start)
    if not strings:
        return [np.empty(0, np.int64) for _ in contexts]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in strings])])
    _, ids = np.unique(np.concatenate(strings), return_inverse=True)
    deep = collection(ids.astype(np.int64), bounds, window // symbol)
    out: list[list[np.ndarray]] = [[] for _ in contexts]
    for k, i in enumerate(owner):
        hit = np.flatnonzero(deep[bounds[k] : bounds[k + 1]])
        if len(hit):
            out[i].append(first[k] + hit * symbol)
    return [np.sort(np.concatenate(x)) if x else np.empty(0, np.int64) for x in out]


def agreement(parts: list[bytes]) -> list[int]:
    """For each of some byte strings, the longest prefix that it shares with another one of them."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    best = [0] * len(parts)
    for i, j in zip(order, order[1:]):
        a, b = parts[i], parts[j]
        low, high = 0, min(len(a), len(b))
        if a[:high] == b[:high]:
            low = high
        while low < high:
            mid = (low + high + 1) // 2
            if a[low:mid] == b[low:mid]:
                low = mid
            else:
                high = mid - 1
        best[i], best[j] = max(best[i], low), max(best[j], low)
    return best


def shared_parts(contexts: list[tuple[int, bytes]], window: int) -> list[tuple[int, int] | None]:
    """Of an anchor's contexts (its offset, bytes): the part that any other context can share around the anchor; none if shorter than a window.

    Strings that two contexts share lie alike to the anchor, so they reach no further to
    either side than the best agreement on that side.
    """
    left = agreement([c[:off][::-1] for off, c in contexts])
    right = agreement([c[off:] for off, c in contexts])
    return [(off - x, off + y) if x + y >= window else None for (off, _), x, y in zip(contexts, left, right)]


def runs(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """The bytes that strings from sorted starts cover, as maximal runs (start, end)."""
    if not len(starts):
        return []
    gap = np.flatnonzero(np.diff(starts) > window)
    return list(zip(starts[np.concatenate([[0], gap + 1])].tolist(), (starts[np.concatenate([gap, [len(starts) - 1]])] + window).tolist()))


class Dedup:
    """The tables of one run, each written once to the shared scratch folder."""

    def __init__(self, docs: DataFrame, doc_id: str, text: str, window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT):
        self.spark = docs.sparkSession
        self.window, self.anchor, self.hot = window, anchor, hot
        self.folder = scratch_dir(self.spark, "suffixes")
        body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
        self.docs = docs.select(F.col(doc_id).alias("doc_id"), body.alias("text"), F.xxhash64(F.col(doc_id), body).alias("row"))

    def kept(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def scanned(self) -> DataFrame:
        """Per row: `doc_id`, `row`, `d` (the text's digest), `n_bytes`, `sha`, and its anchors."""
        window, size = self.window, self.anchor

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = []
                for i, j, buf, at in pieces(b.column("text")):
                    found += [anchors(buf[at[r] : at[r + 1]], window, size) for r in range(j - i)]
                ends = pa.array(np.cumsum([0, *[len(f[0]) for f in found]]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0, k), *[f[i].astype(k) if i != 1 else f[i].view(k) for f in found]]))) for i, k in ((0, np.int32), (1, np.int64), (2, np.int32))]
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("doc_id", "row", "d", "n_bytes", "sha")], *lists], ["doc_id", "row", "d", "n_bytes", "sha", "pos", "hash", "lo"])

        kind = self.docs.schema["doc_id"].dataType.simpleString()
        rows = self.docs.withColumn("d", F.md5("text")).withColumn("n_bytes", F.octet_length("text").cast("bigint")).withColumn("sha", F.sha2("text", 256))
        return self.kept(rows.mapInArrow(run, f"doc_id {kind}, row bigint, d string, n_bytes bigint, sha string, pos array<int>, hash array<bigint>, lo array<int>"), "scanned")

    def texts(self, scanned: DataFrame) -> DataFrame:
        """One row per different text: `d`, its `copies`, the least `row` that has it, and the anchors (alike in all copies)."""
        long = scanned.where(F.col("n_bytes") >= self.window)
        return self.kept(long.groupBy("d").agg(F.count("*").alias("copies"), F.min("row").alias("row"), F.first("n_bytes").alias("n_bytes"), F.first("pos").alias("pos"), F.first("hash").alias("hash"), F.first("lo").alias("lo")), "texts")

    def served(self, texts: DataFrame) -> DataFrame:
        """A row per anchor: `row`, `hash`, `pos` and the string starts `lo` to `hi` that it serves."""
        each = texts.select("row", "n_bytes", F.posexplode("hash").alias("k", "hash"), "pos", "lo")
        last = F.when(F.col("k") + 1 < F.size("lo"), F.element_at("lo", F.col("k") + 2) - 1).otherwise(F.col("n_bytes").cast("int") - self.window)
        return each.select("row", "hash", F.element_at("pos", F.col("k") + 1).alias("pos"), F.element_at("lo", F.col("k") + 1).alias("lo"), last.alias("hi"))

    def flat_runs(self, texts: DataFrame) -> DataFrame:
        """Runs of bytes (`row`, `start`, `end`) under strings of one byte that start next to each other."""
        own = self.served(texts.where(F.array_contains("pos", -1))).where("pos < 0")
        return own.select("row", (F.col("lo") - 1).cast("bigint").alias("start"), (F.col("hi") + self.window).cast("bigint").alias("end"))

    def contexts(self, texts: DataFrame) -> DataFrame:
        """The surroundings of anchors that occur more than once: `hash`, `n`, `row`, `lo`, `off`, `context`."""
        each = self.served(texts).where("pos >= 0")
        # Written, so that both sides of the join below come from a shuffle of their own and a hot anchor can be split.
        often = self.kept(each.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1"), "often")
        wanted = each.join(often, "hash").groupBy("row").agg(F.collect_list(F.struct("hash", "n", "pos", "lo", "hi")).alias("want"))
        wanted = self.kept(wanted, "wanted")
        one = only(self.docs.select("row", "text"), "row", wanted).join(wanted, "row").select("row", "text", F.explode("want").alias("w"))
        return one.select(F.col("w.hash").alias("hash"), F.col("w.n").alias("n"), "row", F.col("w.lo").alias("lo"), (F.col("w.pos") - F.col("w.lo")).alias("off"), F.substring("text", F.col("w.lo") + 1, F.col("w.hi") - F.col("w.lo") + self.window).alias("context"))

    def covered(self, contexts: DataFrame) -> DataFrame:
        """Runs of bytes (`row`, `start`, `end`) that repeated strings cover."""
        window = self.window

        def solve(groups: list[dict]) -> pa.RecordBatch:
            """Anchors' contexts, each with the places that have it. One that several places have is repeated as a whole."""
            out: list[tuple[int, int, int]] = []
            several = []
            for g in groups:
                if len(g) > 1:
                    for ((off, c), places), part in zip(g.items(), shared_parts(list(g), window)):
                        if len(places) > 1:
                            out += [(row, lo, lo + len(c)) for row, lo in places]
                        if part is not None:
                            several.append((off - part[0], c[part[0] : part[1]], part[0], places))
            starts = repeated_starts([c for _, c, _, _ in several], [off for off, _, _, _ in several], window, SYMBOL)
            for (_, _, shift, places), found in zip(several, starts):
                if len(places) == 1:
                    ((row, lo),) = places
                    out += [(row, s + shift + lo, e + shift + lo) for s, e in runs(found, window)]
            for g in groups:
                if len(g) == 1:
                    (((_, c), places),) = g.items()
                    out += [(row, lo, lo + len(c)) for row, lo in places if len(places) > 1]
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(3)], ["row", "start", "end"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            groups, size, before = [], 0, None
            for b in batches:
                for h, row, lo, off, c in zip(*[b.column(x).to_pylist() for x in ("hash", "row", "lo", "off", "context")]):
                    if h != before:
                        if size >= COLLECTION:
                            yield solve(groups)
                            groups, size = [], 0
                        groups.append({})
                        before = h
                    groups[-1].setdefault((off, c), []).append((row, lo))
                    size += 1
            if groups:
                yield solve(groups)

        usual = contexts.where(F.col("n") <= self.hot).repartition("hash").sortWithinPartitions("hash").select("hash", "row", "lo", "off", "context")
        return usual.mapInArrow(run, "row bigint, start bigint, end bigint").unionByName(self.hot_covered(contexts.where(F.col("n") > self.hot)))

    def hot_covered(self, contexts: DataFrame) -> DataFrame:
        """The same for anchors of very many texts: equal strings meet under their 128-bit digest, one row per different string."""
        window = self.window

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for row, lo, c in zip(*[b.column(x).to_pylist() for x in ("row", "lo", "context")]):
                    buf = np.frombuffer(c, np.uint8)
                    n = len(buf) - window + 1
                    _, down = powers(len(buf) + 1)
                    flipped = running(buf[::-1])
                    one, two = running(buf), (flipped[window:] - flipped[:-window])[::-1] * down[len(buf) - window :: -1][:n] if n else None
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(mix((one[window:] - one[:-window]) * down[:n]).view(np.int64)), pa.array(mix(two).view(np.int64)), pa.array(np.full(n, row)), pa.array(np.arange(lo, lo + n))], ["w1", "w2", "row", "start"]
                    )

        strings = contexts.select("row", "lo", "context").mapInArrow(run, "w1 bigint, w2 bigint, row bigint, start bigint")
        often = strings.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").select("w1", "w2")
        return strings.join(often, ["w1", "w2"]).select("row", "start", (F.col("start") + window).alias("end"))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """Per row `doc_id`, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256` once all repeated strings of `window` bytes are gone.

    A byte goes if a string of `window` bytes that covers it also starts at another
    place of the corpus, of the same text too. Null counts as empty; texts shorter
    than the window stay whole. Of equal texts (repeated rows too) nothing remains,
    if they have the length of a window. `window` must be a multiple of SYMBOL. A text
    of one repeated byte has one context, whatever its length.
    """
    run = Dedup(docs, doc_id, text, window, anchor, hot)
    scanned = run.scanned()
    texts = run.texts(scanned)
    covered = run.covered(run.contexts(texts)).unionByName(run.flat_runs(texts)).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("runs"))
    some = run.kept(covered.join(texts.where("copies = 1").select("row"), "row"), "covered")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for row, body, spans in zip(*[b.column(c).to_pylist() for c in ("row", "text", "runs")]):
                kept, done, gone, count = hashlib.sha256(), 0, 0, 0
                for s in spans:
                    if s["start"] > done or not count:
                        kept.update(body[done : s["start"]])
                        count, gone, done = count + 1, gone + s["end"] - s["start"], s["end"]
                    elif s["end"] > done:
                        gone, done = gone + s["end"] - done, s["end"]
                kept.update(body[done:])
                out.append((row, gone, count, kept.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))], ["row", "n_removed", "n_spans", "kept"])

    rows = only(run.docs.select("row", "text"), "row", some).join(some, "row").select("row", "text", "runs")
    partly = rows.mapInArrow(cut, "row bigint, n_removed bigint, n_spans bigint, kept string")
    copied = texts.where("copies > 1").select("d", F.lit(True).alias("all"))
    whole = scanned.select("doc_id", "row", "d", "n_bytes", "sha").join(copied, "d", "left").join(partly, "row", "left")
    gone = F.col("all").isNotNull()
    return whole.select(
        "doc_id", "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
    )
