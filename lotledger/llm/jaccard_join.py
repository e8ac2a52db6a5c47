"""Near-duplicate documents: a grouped prefix join on word shingles, and the components of its links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lotledger.llm.arrays import lowered, mix, ngrams, only, pieces, words
from lotledger.session import scratch_dir

#: Shingles are counted in 2**CELL_BITS cells, whatever the corpus; only their order, never the result, depends on how many share one.
CELL_BITS = 24
#: Cells that travel in one row.
BLOCK = 1 << 12
#: Columns of 64 bits that mark which shingles a prefix has.
MARKS = tuple(f"m{i}" for i in range(8))
#: Eighths of a prefix whose last shingles travel with it.
EIGHTHS = (4, 6, 7, 8)
#: Rows whose sets are held at once.
ROWS = 256
#: Classes of a group that the others are held against, where many did not link to the first; and how many are many.
LEADERS, MANY = 4, 16

_LOWER = lowered()
_INNER = np.ones(256, bool)
_INNER[[32, 9, 10, 11, 12, 13]] = False


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Per row the sorted digests of its distinct k-word shingles; fewer words than k are one shingle."""
    for i, j, buf, at in pieces(column):
        digests, bounds = words(_LOWER[buf], at, _INNER)
        grams, starts = ngrams(digests, bounds, tuple(range(k)), k)
        for r in range(j - i):
            own = digests[bounds[r] : bounds[r + 1]]
            if 0 < len(own) < k:
                yield ngrams(own, np.array([0, len(own)]), tuple(range(len(own))), len(own))[0]
            else:
                yield np.unique(grams[starts[r] : starts[r + 1]])


def overlap(a, b, percent: int):
    """Shared shingles that sets of these sizes need at least: 100 * i >= percent * (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n, percent: int):
    """Sets that link share one of so many first shingles, in any order that all sets use."""
    return n - -(-percent * n // 100) + 1


def short_length(n, percent: int):
    """As above, for the smaller set of a pair."""
    return n - -(-2 * percent * n // (100 + percent)) + 1


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if not len(a) or not len(b):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


class Join:
    """The tables of one join, each written once to the shared scratch folder."""

    def __init__(self, docs: DataFrame, k: int, percent: int, doc_id: str = "doc_id", text: str = "text"):
        self.spark: SparkSession = docs.sparkSession
        self.k, self.percent = k, percent
        self.folder = scratch_dir(self.spark, "join")
        self.docs = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).cast("binary").alias("text"))

    def kept(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def spent(self, *names: str) -> None:
        """Deletes tables that nothing reads any more: what came from them is written."""
        for name in names:
            where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

    def levels(self) -> np.ndarray:
        """How frequent the shingles of a cell are, in half powers of two: a byte for each of the 2**CELL_BITS cells.

        Counted over all documents. A task counts in 16 bits a cell and sends its counts as
        compressed blocks of cells, whenever a cell is nearly full and at its end; they
        are summed one after another, and the driver gets the levels alone.
        """
        k = self.k

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells = np.zeros(1 << CELL_BITS, np.uint16)
            for b in batches:
                for s in shingle_sets(b.column("text"), k):
                    at = (s >> np.uint64(64 - CELL_BITS)).astype(np.int64)
                    for some in (at[i : i + BLOCK] for i in range(0, len(at), BLOCK)):
                        if cells[some].max() > np.iinfo(np.uint16).max - BLOCK:
                            yield from packed(cells.reshape(-1, BLOCK))
                            cells[:] = 0
                        np.add.at(cells, some, 1)
            yield from packed(cells.reshape(-1, BLOCK))

        def packed(table: np.ndarray) -> Iterator[pa.RecordBatch]:
            at = np.flatnonzero(table.any(axis=1))
            for i in range(0, len(at), 64):
                part = [pa.compress(np.ascontiguousarray(table[j].astype(np.int32).view(np.uint8).reshape(BLOCK, 4).T), "zstd", asbytes=True) for j in at[i : i + 64]]
                yield pa.RecordBatch.from_arrays([pa.array(at[i : i + 64].astype(np.int32)), pa.array(part, pa.binary())], ["block", "counts"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for b in batches:
                for block, counts in zip(b.column("block").to_pylist(), b.column("counts").to_pylist()):
                    planes = np.frombuffer(pa.decompress(counts, 4 * BLOCK, "zstd", asbytes=True), np.uint8).reshape(4, BLOCK)
                    one = np.ascontiguousarray(planes.T).view(np.int32).ravel()
                    total[block] = total[block] + one if block in total else one.astype(np.int64)
            for block, counts in total.items():
                level = np.minimum(2 * np.log2(np.maximum(counts, 1)), 62).astype(np.int8)
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([level.tobytes()], pa.binary())], ["block", "counts"])

        counts = self.docs.select("text").mapInArrow(run, "block int, counts binary")
        told = counts.repartition("block").mapInArrow(add, "block int, counts binary").toArrow()
        out = np.zeros((1 << CELL_BITS) // BLOCK * BLOCK, np.int8).reshape(-1, BLOCK)
        for block, level in zip(told.column("block").to_pylist(), told.column("counts").to_pylist()):
            out[block] = np.frombuffer(level, np.int8)
        return out.ravel()

    def sets(self) -> DataFrame:
        """Per row `id`, `n`, digest of the set (`d1`, `d2`), and of its rarest shingles: `prefix`, their digest (`p1`, `p2`), `score`."""
        k, percent = self.k, self.percent
        shared = self.spark.sparkContext.broadcast(self.levels())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            levels = shared.value
            for b in (batch.slice(i, ROWS) for batch in batches for i in range(0, batch.num_rows, ROWS)):
                n, digests, prefixes, scores, marks = [], [], [], [], []
                for s in shingle_sets(b.column("text"), k):
                    often = levels[(s >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
                    # Level and digest in one number: it orders the shingles and, but for a rare tie that costs a pair more, names them.
                    ranks = np.sort(often.astype(np.int64) << 57 | (s >> np.uint64(7)).astype(np.int64))
                    first = ranks[: prefix_length(len(s), percent) if len(s) else 0]
                    n.append(len(s))
                    digests.append([d for x in (s, first.view(np.uint64)) for d in (mix(x).sum(), mix(x ^ np.uint64(len(x))).sum())])
                    prefixes.append(first)
                    marks.append(np.zeros(64 * len(MARKS), bool))
                    marks[-1][first & 64 * len(MARKS) - 1] = True
                    scores.append(int(often.min()) if len(s) else 0)
                table = np.array(digests, np.uint64).reshape(-1, 4).view(np.int64)
                bits = np.packbits(np.array(marks).reshape(-1, 64 * len(MARKS)), axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array(n, pa.int32()), *[pa.array(table[:, i]) for i in range(4)], pa.array(prefixes, pa.list_(pa.int64())), pa.array(scores, pa.int64()), *[pa.array(bits[:, i]) for i in range(len(MARKS))]],
                    ["id", "n", "d1", "d2", "p1", "p2", "prefix", "score", *MARKS],
                )

        marked = ", ".join(f"{m} bigint" for m in MARKS)
        return self.kept(self.docs.mapInArrow(run, f"id bigint, n int, d1 bigint, d2 bigint, p1 bigint, p2 bigint, prefix array<bigint>, score bigint, {marked}"), "sets")

    def classes(self, sets: DataFrame) -> DataFrame:
        """Equal sets are one class `c` (its smallest id), classes of equal size and prefix one group `g` (the smallest c)."""
        one = self.kept(sets.where("n > 0 AND id IS NOT NULL").groupBy("n", "d1", "d2", "p1", "p2").agg(F.min("id").alias("c")), "one")
        groups = one.groupBy("n", "p1", "p2").agg(F.min("c").alias("g"))
        return self.kept(one.join(groups, ["n", "p1", "p2"]).select("c", "g", "n", "d1", "d2"), "classes")

    def groups(self, sets: DataFrame, classes: DataFrame) -> DataFrame:
        """Per group `g` its `n`, `score`, `prefix` and its marks: the one time that prefixes move."""
        key = ["g", "n", "d1", "d2"]
        rows = sets.withColumnRenamed("id", "g").select(*key, "score", "prefix", *MARKS).join(classes.where("c = g").select(*key), key)
        return self.kept(rows.groupBy(*key).agg(F.any_value("score").alias("score"), F.any_value("prefix").alias("prefix"), *[F.any_value(m).alias(m) for m in MARKS]).select("g", "n", "score", "prefix", *MARKS), "groups")

    def shared(self, groups: DataFrame) -> DataFrame:
        """Prefix shingles that several groups have: `tok`, `g`, `n`, `pos`, `prev` (the one before), and the bucket's centre: `centre`, `centre_n`.

        The centre is the group whose rarest shingle is the most frequent one: of
        near copies, the text with the fewest edits of its own.
        """
        rows = groups.select("g", "n", "score", "prefix", F.posexplode("prefix").alias("pos", "tok"))
        rows = rows.withColumn("prev", F.when(F.col("pos") > 0, F.element_at("prefix", F.col("pos")))).drop("prefix")
        centres = rows.groupBy("tok").agg(F.count("*").alias("m"), F.max(F.struct("score", (-F.col("g")).alias("g"), "n")).alias("x")).where("m > 1")
        return self.kept(rows.join(centres, "tok").select("tok", "g", "n", "pos", "prev", (-F.col("x.g")).alias("centre"), F.col("x.n").alias("centre_n")), "shared")

    def fits(self, a: Column, b: Column) -> Column:
        return F.least(a, b) * 100 >= F.greatest(a, b) * self.percent

    def possible(self, pairs: DataFrame, groups: DataFrame) -> DataFrame:
        """The pairs of groups (`g1`, `g2`) that may hold a link, as far as their prefixes tell.

        Up to the earlier of the two last prefix shingles both sets are known; what
        they share beyond it is at most what either has beyond it.
        """
        x, y = (groups.select(F.col("g").alias(f"g{i}"), F.col("n").alias(f"n{i}"), F.col("prefix").alias(f"p{i}")) for i in (1, 2))
        both = pairs.join(x, "g1").join(y, "g2")
        known = F.least(F.element_at("p1", -1), F.element_at("p2", -1))
        beyond = [F.col(f"n{i}") - F.size(F.filter(f"p{i}", lambda t: t <= F.col("known"))) for i in (1, 2)]
        most = F.size(F.array_intersect("p1", "p2")) + F.least(*beyond)
        need = F.ceil(self.percent * (F.col("n1") + F.col("n2")) / (100 + self.percent))
        return both.withColumn("known", known).where(most >= need).select("g1", "g2")

    def texts(self, pairs: DataFrame, name: str) -> DataFrame:
        """The texts of the classes in some pairs: `c`, `text`."""
        own = self.kept(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct(), f"{name}_ids")
        return self.kept(only(self.docs, "id", own).select(F.col("id").alias("c"), "text").dropDuplicates(["c"]), name)

    def verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs (a, b) of a table that link, by their whole sets."""
        k, percent = self.k, self.percent
        texts = self.texts(pairs, f"{name}_texts")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in (batch.slice(i, ROWS) for batch in batches for i in range(0, batch.num_rows, ROWS)):
                ok = [linked(x, y, percent) for x, y in zip(shingle_sets(b.column("x"), k), shingle_sets(b.column("y"), k))]
                yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(ok, pa.bool_())], ["a", "b", "ok"])

        left = pairs.join(texts.select(F.col("c").alias("a"), F.col("text").alias("x")), "a")
        both = left.join(texts.select(F.col("c").alias("b"), F.col("text").alias("y")), "b").select("a", "b", "x", "y")
        out = self.kept(both.mapInArrow(run, "a bigint, b bigint, ok boolean").where("ok").select("a", "b"), name)
        self.spent(f"{name}_texts_ids", f"{name}_texts")
        return out

    def led(self, apart: DataFrame) -> tuple[DataFrame, DataFrame] | None:
        """Where many classes of a group are apart from its first, a few of them lead: the pairs (a, b) of the others with each leader, and those that link.

        So a large family that the first class is no part of costs rows, not pairs.
        """
        drawn = [F.min(F.struct(F.xxhash64("c", F.lit(i)).alias("h"), "c"))["c"] for i in range(LEADERS)]
        leaders = self.kept(apart.groupBy("g").agg(F.count("*").alias("m"), F.array_distinct(F.array(*drawn)).alias("leaders")).where(F.col("m") > MANY).select("g", "leaders"), "leaders")
        if leaders.isEmpty():
            return None
        others = apart.join(leaders, "g").where(~F.array_contains("leaders", F.col("c")))
        pairs = self.kept(others.select(F.col("c").alias("a"), F.explode("leaders").alias("b")), "led_first")
        return pairs, self.verified(pairs, "led")

    def links(self, classes: DataFrame, groups: DataFrame) -> DataFrame:
        """Links (a, b) of classes that have the components of all links.

        First every class is held against its group, and every group against the
        centres of its buckets: one pair per row. What is linked to the same centre
        is connected and needs no pair of its own, so large families of near copies
        cost rows, not pairs. What is left is found by pairs of groups that may
        have different families. Such a pair is held by one class of each family
        first; the links found join families, and all classes meet only where
        families of two groups, or of one, still differ.
        """
        shared = self.shared(groups)
        mates = classes.where("c != g").select(F.col("c").alias("a"), F.col("g").alias("b"))
        stars = shared.where("g != centre").where(self.fits(F.col("n"), F.col("centre_n"))).select(F.col("g").alias("g1"), F.col("centre").alias("g2")).distinct()
        first = self.kept(mates.unionByName(self.possible(stars, groups).toDF("a", "b")), "first")
        found = self.verified(first, "found")

        to_group = found.join(mates, ["a", "b"], "left_semi").select(F.col("a").alias("c"))
        apart = self.kept(classes.where("c != g").select("c", "g").join(to_group, "c", "left_anti"), "apart")
        led, tried = self.led(apart), first
        if led:
            tried, found = first.unionByName(led[0]), found.unionByName(led[1])
        tried = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

        family = self.families(classes, found, "family")
        met = self.group_pairs(shared, groups, family)
        heads = family.groupBy("g", "family").agg(F.min("c").alias("c"))
        ahead = self.kept(self.between(met, heads).join(tried, ["a", "b"], "left_anti"), "ahead")
        found = found.unionByName(self.verified(ahead, "joined"))

        several = family.groupBy("g").agg(F.count("*").alias("m")).where("m > 1")
        met = met.join(several.select(F.col("g").alias("g1"), F.col("m").alias("m1")), "g1", "left").join(several.select(F.col("g").alias("g2"), F.col("m").alias("m2")), "g2", "left")
        met = self.kept(met.where("m1 > 1 OR m2 > 1").select("g1", "g2"), "several")
        if met.isEmpty():
            return found
        rest = self.between(met, self.families(classes, found, "merged")).join(tried.unionByName(ahead), ["a", "b"], "left_anti")
        return found.unionByName(self.verified(self.kept(rest, "rest"), "more"))

    def families(self, classes: DataFrame, links: DataFrame, name: str) -> DataFrame:
        """Per class `c` its group `g` and its `family`, the component of these links."""
        known = self.components(links, name)
        return self.kept(classes.select("c", "g").join(known, "c", "left").select("c", "g", F.coalesce("component", "c").alias("family")), name)

    def between(self, groups: DataFrame, members: DataFrame) -> DataFrame:
        """The pairs (a, b), a < b, of members of two groups `g1` and `g2` (or of one) that are of different families."""
        x, y = (members.select(F.col("g").alias(f"g{i}"), F.col("c").alias(f"c{i}"), F.col("family").alias(f"f{i}")) for i in (1, 2))
        both = groups.join(x, "g1").join(y, "g2").where("f1 != f2")
        return both.select(F.least("c1", "c2").alias("a"), F.greatest("c1", "c2").alias("b")).distinct()

    def group_pairs(self, shared: DataFrame, groups: DataFrame, family: DataFrame) -> DataFrame:
        """The pairs of groups (`g1`, `g2`) that may hold a link between different families, as far as sizes and prefixes tell.

        Buckets hold rows of groups, with the marks of their prefixes: `only` is the family of all its classes,
        or null where there are several. The largest family of a bucket meets the
        others but not itself. A group of several families meets itself, too, in
        the bucket of its first shingle, even if no other group has that shingle.
        """
        only = family.groupBy("g").agg(F.min("family").alias("low"), F.max("family").alias("high")).select("g", F.when(F.col("low") == F.col("high"), F.col("low")).alias("only"))
        own = groups.join(only.where("only IS NULL"), "g", "left_semi").join(shared.where("pos = 0"), "g", "left_anti")
        own = own.select(F.element_at("prefix", 1).alias("tok"), "g", "n", F.lit(0).alias("pos"), F.lit(None).cast("bigint").alias("prev"))
        rows = shared.select("tok", "g", "n", "pos", "prev").unionByName(own).join(only, "g")
        heads = rows.groupBy("tok", "only").agg(F.count("*").alias("m")).groupBy("tok").agg(
            F.count("*").alias("k"), F.bool_or(F.col("only").isNull()).alias("several"), F.max(F.when(F.col("only").isNotNull(), F.struct("m", "only")))["only"].alias("head")
        )
        marks = groups.select("g", F.size("prefix").alias("size"), *MARKS, *[F.expr(f"element_at(prefix, cast(ceil(size(prefix) * {e} / 8) AS int))").alias(f"q{e}") for e in EIGHTHS])
        rows = self.kept(rows.join(heads.where("k > 1 OR several").select("tok", "head"), "tok").join(marks, "g"), "open")
        low, high = (rows.select("tok", *[F.col(c).alias(f"{c}{i}") for c in ("g", "n", "pos", "prev", "only", "size", *[f"q{e}" for e in EIGHTHS], *MARKS)], *(["head"] if i == 1 else [])) for i in (1, 2))
        need = F.ceil(self.percent * (F.col("n1") + F.col("n2")) / (100 + self.percent))
        # A mark that only one of the two has stands for a shingle, at least, that the other lacks.
        common = F.least(*[F.col(f"size{i}") - sum((F.bit_count(F.col(f"{m}{i}").bitwiseAND(F.bitwise_not(f"{m}{j}"))) for m in MARKS), F.lit(0)) for i, j in ((1, 2), (2, 1))])
        # So many of a prefix's shingles, at least, come no later than the other prefix's last one: up to there both are known.
        known = [F.greatest(*[F.when(F.col(f"q{e}{i}") <= F.col(f"q8{j}"), F.ceil(F.col(f"size{i}") * e / 8)).otherwise(0) for e in EIGHTHS]) for i, j in ((1, 2), (2, 1))]
        beyond = F.least(F.col("n1") - known[0], F.col("n2") - known[1])
        room = F.least(F.col("pos1") + 1, F.col("pos2") + 1, common) + F.least(F.col("n1") - 1 - F.col("pos1"), F.col("n2") - 1 - F.col("pos2"))
        small = F.least("n1", "n2")
        pos = F.when(F.col("n1") < F.col("n2"), F.col("pos1")).when(F.col("n1") > F.col("n2"), F.col("pos2")).otherwise(F.least("pos1", "pos2"))
        short = small - F.ceil(2 * self.percent * small / (100 + self.percent)) + 1
        # Where both have the same shingle just before, its bucket makes the pair: there too the families differ, and the room is no smaller.
        fresh = F.coalesce(F.col("prev1") != F.col("prev2"), F.lit(True))
        differ = F.coalesce(F.col("only1") != F.col("only2"), F.lit(True))
        once = F.coalesce(F.col("only2") == F.col("head"), F.lit(False)) | (F.col("g1") <= F.col("g2"))
        pairs = (
            low.where(F.coalesce(F.col("only1") != F.col("head"), F.lit(True))).join(high, "tok").where(differ).where(fresh).where(once)
            .where(self.fits(F.col("n1"), F.col("n2"))).where(room >= need).where(common + beyond >= need).where(pos < short)
            .select(F.least("g1", "g2").alias("g1"), F.greatest("g1", "g2").alias("g2")).distinct()
        )
        return self.kept(self.possible(self.kept(pairs, "met"), groups), "possible")

    def components(self, links: DataFrame, name: str = "linked") -> DataFrame:
        """Per linked class `c` the smallest class `component` it reaches, by alternating stars; a hub is only ever a minimum."""
        links, table = self.kept(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}_edges"), f"{name}_edges"
        mark = self._mark(links)
        turn = 0
        while True:
            both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            large = self.kept(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), f"{name}_large{turn}")
            least = large.groupBy("u").agg(F.min("v").alias("m"))
            down = large.join(least, "u")
            small = down.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
            links = self.kept(small, f"{name}_small{turn}")
            self.spent(table, f"{name}_large{turn}")
            new, turn, table = self._mark(links), turn + 1, f"{name}_small{turn}"
            if new == mark:
                return links.select(F.col("u").alias("c"), F.col("v").alias("component"))
            mark = new

    @staticmethod
    def _mark(links: DataFrame) -> tuple:
        return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(docs: DataFrame, k: int, percent: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row `doc_id`, `n_shingles`, `component_id`: the smallest id reachable by links.

    Documents link when their sets of k-word shingles have at least `percent` of
    their union in common. Null and empty texts, and those of white space, have no
    shingles and link with nothing. Rows with a null id form no links and keep a
    null component. Rows that repeat an id come out as often as they came in; with
    different texts each has the component of its own text.
    """
    join = Join(docs, k, percent, doc_id, text)
    sets = join.sets()
    classes = join.classes(sets)
    groups = join.groups(sets, classes)
    ids = join.kept(sets.select("id", "n", "d1", "d2"), "ids")
    join.spent("sets", "one")
    found = join.components(join.links(classes, groups))
    named = join.kept(classes.select("n", "d1", "d2", "c").join(found, "c", "left").select("n", "d1", "d2", F.coalesce("component", "c").alias("component_id")), "named")
    join.spent("classes", "groups", "shared", "first", "open", "met", "possible", "ahead", "several", "rest", "family", "merged")
    rows = ids.where("n > 0 AND id IS NOT NULL").join(named, ["n", "d1", "d2"]).select("id", "n", "component_id")
    alone = ids.where("n = 0 OR id IS NULL").select("id", "n", F.col("id").alias("component_id"))
    return rows.unionByName(alone).select(F.col("id").alias("doc_id"), F.col("n").cast("bigint").alias("n_shingles"), "component_id")
