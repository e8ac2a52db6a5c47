"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, subtracted and peeled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lotledger.llm.arrays import ranked
from lotledger.session import scratch_dir

#: Cells of each of the three tables of a fingerprint.
CELLS = 4
#: Keys that a bin of a retried pair has on average, and the cells of its tables; these grow by GROWTH until all is peeled.
BIN, BIN_CELLS, GROWTH = 12, 12, 4
#: Peeling steps: by turns, finding the keys that are alone in a cell and taking them out.
STEPS = 40

_NONE = "cast(array() AS array<struct<x:bigint,n:bigint>>)"


def keys(text: str) -> Column:
    """The distinct digests of a text's paragraphs (lines that aren't empty)."""
    return F.expr(f"array_distinct(transform(filter(split({text}, '\\n', -1), p -> p <> ''), p -> xxhash64(p)))")


def _in_cell(key: str, cell: str, m: int) -> str:
    return f"pmod(shiftrightunsigned({key}, cast(({cell} div {m}) * 20 AS int)), {m}L) = {cell} % {m}"


def sketch(pairs: str, m: int) -> str:
    """Of keys with signs (x, n): 3 * m cells, each with the sum of signs, the xor of keys and the xor of their digests."""
    zero = "named_struct('n', 0L, 'x', 0L, 'y', 0L)"
    add = "named_struct('n', a.n + k.n, 'x', a.x ^ k.x, 'y', a.y ^ xxhash64(k.x))"
    return f"transform(sequence(0, {3 * m - 1}), c -> aggregate(filter({pairs}, k -> {_in_cell('k.x', 'c', m)}), {zero}, (a, k) -> {add}))"


def signed(array: str, sign: int) -> str:
    return f"transform({array}, k -> named_struct('x', k, 'n', {sign}L))"


def subtract(a: str, b: str) -> str:
    return f"zip_with({a}, {b}, (p, q) -> named_struct('n', p.n - q.n, 'x', p.x ^ q.x, 'y', p.y ^ q.y))"


def peel(cells: str, m: int) -> str:
    """What is left of the cells (`cells`) and how many keys came out (`d`)."""
    alone = "array_distinct(transform(filter(s.cells, c -> abs(c.n) = 1 AND c.y = xxhash64(c.x)), c -> named_struct('x', c.x, 'n', c.n)))"
    take = "named_struct('n', a.n - k.n, 'x', a.x ^ k.x, 'y', a.y ^ xxhash64(k.x))"
    rest = f"transform(s.cells, (c, i) -> aggregate(filter(s.alone, k -> {_in_cell('k.x', 'i', m)}), c, (a, k) -> {take}))"
    find = f"named_struct('cells', s.cells, 'alone', {alone}, 'd', s.d)"
    take_out = f"CASE WHEN size(s.alone) = 0 THEN s ELSE named_struct('cells', {rest}, 'alone', {_NONE}, 'd', s.d + size(s.alone)) END"
    start = f"named_struct('cells', {cells}, 'alone', {_NONE}, 'd', 0L)"
    return f"aggregate(sequence(1, {STEPS}), {start}, (s, t) -> CASE WHEN t % 2 = 1 THEN {find} ELSE {take_out} END)"


_CLEAN = "NOT exists({0}.cells, c -> c.n <> 0 OR c.x <> 0 OR c.y <> 0)"


def printed(cells: str) -> Column:
    """A fingerprint as text: per cell the count, the xor of keys and half of the check."""
    return F.expr(f"array_join(transform({cells}, c -> concat(hex(c.n), ':', hex(c.x), ':', hex(c.y & 4294967295))), '.')")


def likeness(a: Column, b: Column, d: Column) -> Column:
    """Shared over all keys, from the sizes of two sets and of their difference; two empty sets are alike."""
    return F.when(a + b == 0, F.lit(1.0)).otherwise((a + b - d) / (a + b + d).cast("double"))


def followers(docs: DataFrame) -> DataFrame:
    """Per `doc_id` the id before it (`before`, the last one for the first) and that text's length (`before_n`)."""
    ids = docs.groupBy("doc_id").agg(F.max(F.length("text")).alias("n"))
    rows, sizes = ranked(ids, [F.col("doc_id")], "ids")
    at, starts = 0, []
    for r in sorted(sizes.collect(), key=lambda r: r["part"]):
        starts.append((r["part"], at))
        at += r["n"]
    shift = docs.sparkSession.createDataFrame(starts, "part int, shift bigint")
    placed = rows.join(F.broadcast(shift), "part").select("doc_id", "n", (F.col("pos") + F.col("shift")).alias("rank"))
    earlier = placed.select(F.col("doc_id").alias("before"), F.col("n").alias("before_n"), F.pmod(F.col("rank") + 1, F.lit(max(at, 1))).alias("rank"))
    return placed.select("doc_id", "rank").join(earlier, "rank").drop("rank")


def edited(docs: DataFrame) -> DataFrame:
    """Of rows (`doc_id`, `text`): `n`, `own` keys, `changed` (the last half replaced by the start of the next document), `next_keys`.

    Only the half that stays, and the start that is put in, travel.
    """
    known = docs.where("doc_id IS NOT NULL")
    heads = known.join(followers(known), "doc_id").select("before", F.expr("substring(text, 1, cast(floor(before_n / 2) AS int))").alias("head"), keys("text").alias("next_keys"))
    # Where an id is repeated, its least text is the next one of the id before.
    heads = heads.groupBy("before").agg(F.min(F.struct("head", "next_keys")).alias("h")).select(F.col("before").alias("doc_id"), "h.head", "h.next_keys")
    half = "cast(floor(n / 2) AS int)"

    def halved(df: DataFrame) -> DataFrame:
        return df.select("doc_id", F.length("text").alias("n"), keys("text").alias("own"), F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) AS int))").alias("front"))

    rows = halved(known).join(heads, "doc_id").unionByName(halved(docs.where("doc_id IS NULL")).withColumn("head", F.lit("")).withColumn("next_keys", F.lit(None).cast("array<bigint>")))
    return rows.withColumn("changed", F.expr(f"concat(front, substring(head, 1, {half}))")).drop("front", "head")


def differences(pairs: DataFrame, folder: str) -> DataFrame:
    """Of pairs (`row`, `which`, `a`, `b`: digests) the size of the difference, `d`.

    The keys of a pair are dealt to bins by another digest, so that a sketch has few
    cells whatever the length of a text. Bins that can't be peeled are tried again
    with more cells, until none is left.
    """
    spark = pairs.sparkSession
    both = f"concat({signed('a', 1)}, {signed('b', -1)})"
    rows = pairs.select("row", "which", F.expr(both).alias("keys")).withColumn("bins", F.expr(f"cast(ceil(greatest(1, size(keys)) / {BIN}) AS int)"))
    # Keys are sorted by bin once and cut where the bin changes, so that a pair of many keys takes time in proportion.
    # An array of one element binds a value that the expression uses often.
    by_bin = "sort_array(transform(keys, k -> named_struct('bin', pmod(xxhash64(k.x, 1), bins), 'x', k.x, 'n', k.n)))"
    starts = "filter(sequence(1, size(ks)), i -> i = 1 OR ks[i - 1].bin <> ks[greatest(i - 2, 0)].bin)"
    cut = "transform(at, (s, i) -> transform(slice(ks, s, coalesce(get(at, i + 1), size(ks) + 1) - s), k -> named_struct('x', k.x, 'n', k.n)))"
    parts = f"transform(array({by_bin}), ks -> transform(array({starts}), at -> {cut})[0])[0]"
    rows = rows.where("size(keys) > 0").select("row", "which", F.explode(F.expr(parts)).alias("keys"))
    done, m, turn = None, BIN_CELLS, 0
    while True:
        rows.select("row", "which", "keys", F.expr(peel(sketch("keys", m), m)).alias("p")).select(
            "row", "which", F.expr("p.d").alias("d"), F.expr(_CLEAN.format("p")).alias("ok"), F.expr(f"CASE WHEN {_CLEAN.format('p')} THEN NULL ELSE keys END").alias("keys")
        ).write.parquet(f"{folder}/peeled{turn}")
        tried = spark.read.parquet(f"{folder}/peeled{turn}")
        done = tried.where("ok") if done is None else done.unionByName(tried.where("ok"))
        rows = tried.where("NOT ok").select("row", "which", "keys")
        if rows.isEmpty():
            return done.groupBy("row", "which").agg(F.sum("d").alias("d"))
        m, turn = m * GROWTH, turn + 1


def compared(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row `doc_id`, `n_chars`, `edited_sha256`, both fingerprints, `near_edited`, `near_next`.

    A likeness is that of the two sets of paragraph digests, as peeled from the
    difference of their sketches; what the fingerprints' own cells can't tell is
    asked of larger sketches. Null text is empty. An empty text has no paragraphs
    and is like an empty one. A single document is its own next. Rows without an id
    have no next: their edited text is the first half, their `near_next` 0. Of
    an id with several texts the least is what comes next.
    """
    spark = docs.sparkSession
    folder = scratch_dir(spark, "sketches")
    rows = edited(docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")))
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.col("n").cast("bigint").alias("n_chars"), F.sha2("changed", 256).alias("edited_sha256"),
        "own", keys("changed").alias("edit"), F.coalesce("next_keys", F.array().cast("array<bigint>")).alias("next"), F.col("next_keys").isNull().alias("last"),
    )
    sketches = rows.select("*", *[F.expr(sketch(signed(c, 1), CELLS)).alias(f"s_{c}") for c in ("own", "edit", "next")])
    peeled = sketches.select("*", *[F.expr(peel(subtract("s_own", f"s_{c}"), CELLS)).alias(f"p_{c}") for c in ("edit", "next")])
    told = lambda c: F.expr(f"CASE WHEN {_CLEAN.format(f'p_{c}')} THEN p_{c}.d END").alias(f"d_{c}")
    # Keys go on only where a sketch has to be asked again.
    open_ = {c: F.expr(f"NOT ({_CLEAN.format(f'p_{c}')})") for c in ("edit", "next")}
    again = [F.when(open_["edit"] | open_["next"], F.col("own")).alias("own"), *(F.when(o, F.col(c)).alias(c) for c, o in open_.items())]
    peeled.select("row", "doc_id", "n_chars", "edited_sha256", *again, "last", *[F.size(c).alias(f"n_{c}") for c in ("own", "edit", "next")], printed("s_own").alias("fingerprint"), printed("s_edit").alias("edited_fingerprint"), told("edit"), told("next")).write.parquet(f"{folder}/first")
    first = spark.read.parquet(f"{folder}/first")
    failed = [first.where(F.col(f"d_{c}").isNull()).select("row", F.lit(c).alias("which"), F.col("own").alias("a"), F.col(c).alias("b")) for c in ("edit", "next")]
    more = differences(failed[0].unionByName(failed[1]), folder)
    late = more.groupBy("row").agg(*[F.max(F.when(F.col("which") == c, F.col("d"))).alias(f"l_{c}") for c in ("edit", "next")])
    whole = first.join(late, "row", "left")
    near = lambda c: likeness(F.col("n_own"), F.col(f"n_{c}"), F.coalesce(f"d_{c}", f"l_{c}"))
    return whole.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", near("edit").alias("near_edited"), F.when(F.col("last"), 0.0).otherwise(near("next")).alias("near_next")
    )
