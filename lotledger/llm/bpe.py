"""Byte-level BPE: overlapping chunks, stitched where their pre-token boundaries meet again."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Code points that a chunk owns, and how far it reads on into the next.
CHUNK, OVERLAP = 32768, 1024
#: Rows that are turned into ids or bytes at once; this bounds a worker's memory.
ROWS = 256
#: A pre-token that ends this near to a chunk's end may go on beyond it (contractions look two ahead).
MARGIN = 4


class Codec:
    """Ranks and pattern; the encoder is made once in each Python worker."""

    _encoders: dict[str, object] = {}
    _tables: dict[str, pa.Array] = {}

    def __init__(self, lines: bytes, pattern: str):
        self.lines, self.pattern = lines, pattern
        self.key = hashlib.sha256(lines + pattern.encode()).hexdigest()

    def _ranks(self) -> dict[bytes, int]:
        pairs = (line.split() for line in self.lines.splitlines() if line)
        return {base64.b64decode(token): int(rank) for token, rank in pairs}

    def _encoder(self):
        if self.key not in self._encoders:
            import tiktoken

            self._encoders[self.key] = tiktoken.Encoding(self.key, pat_str=self.pattern, mergeable_ranks=self._ranks(), special_tokens={})
        return self._encoders[self.key]

    def _table(self) -> pa.Array:
        """The bytes of each id."""
        if self.key not in self._tables:
            ranks = self._ranks()
            table = [b""] * (max(ranks.values()) + 1)
            for token, rank in ranks.items():
                table[rank] = token
            self._tables[self.key] = pa.array(table, pa.large_binary())
        return self._tables[self.key]

    def encode(self, pieces: list[str | None]) -> pa.Array:
        """Lists of ids."""
        encoding = self._encoder()
        ids = [encoding.encode_to_numpy(x or "", disallowed_special=()) for x in pieces]
        ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
        values = np.concatenate([np.empty(0, np.uint32), *ids]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))

    def ends(self, text: str) -> np.ndarray:
        """Where the pre-tokens of a text end."""
        import regex

        return np.fromiter((m.end() for m in regex.finditer(self.pattern, text)), np.int64)

    def decode(self, ids: pa.Array) -> pa.Array:
        """The bytes of lists of ids: the tokens' bytes lie one after the other, so only the row ends are picked."""
        tokens = self._table().take(ids.flatten())
        lengths = np.where(np.asarray(ids.is_valid()), np.asarray(ids.value_lengths().fill_null(0)), 0)
        _, offsets, data = tokens.buffers()
        at = np.frombuffer(offsets, np.int64)[: len(tokens) + 1] if len(tokens) else np.zeros(1, np.int64)
        ends = at[np.concatenate([[0], np.cumsum(lengths)])]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(ends.astype(np.int64)), data or pa.py_buffer(b"")]).cast(pa.binary())


def read_codec(ranks_path: str, pattern: str) -> Codec:
    """The driver reads the vocabulary file; it travels with the tasks (a megabyte or two)."""
    with open(ranks_path, "rb") as f:
        return Codec(f.read(), pattern)


def _mapped(df: DataFrame, codec: Codec, source: str, target: str, kind: str, fn) -> DataFrame:
    """`source` turned into `target` by fn(codec, column); the other columns stay."""
    shared = df.sparkSession.sparkContext.broadcast((codec.lines, codec.pattern))
    keep = [c for c in df.columns if c != source]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Codec(*shared.value)
        for b in (batch.slice(i, ROWS) for batch in batches for i in range(0, batch.num_rows, ROWS)):
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], fn(tool, b.column(source))], [*keep, target])

    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    return df.mapInArrow(run, ", ".join([*fields, f"{target} {kind}"]))


def stitched(texts: DataFrame, codec: Codec, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Of texts (`_id`, `_text`), pieces that may be encoded by themselves: `_id`, `piece_no`, `piece`.

    Chunks are pre-tokenised apart from one another. Where a boundary of chunk k,
    not too near to its end, is a boundary of chunk k + 1 too, all later ones
    agree, because a match depends on nothing before it: there the text is cut. A
    pair of chunks without such a place stays joined, so a pre-token of any
    length comes out right.
    """
    shared = texts.sparkSession.sparkContext.broadcast((codec.lines, codec.pattern))

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Codec(*shared.value)
        for b in batches:
            heads, tails = [], []
            for at, piece in zip(b.column("at").to_pylist(), b.column("piece").to_pylist()):
                ends = tool.ends(piece)
                heads.append(ends[ends <= overlap] + at)
                tails.append(ends[(ends > chunk) & (ends <= len(piece) - MARGIN)] + at)
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("chunk_no"), pa.array(heads, kind), pa.array(tails, kind)], ["_id", "chunk_no", "heads", "tails"])

    count = F.greatest(F.lit(1), F.ceil((F.length("_text") - overlap) / chunk).cast("int"))
    chunks = texts.select("_id", "_text", F.explode(F.sequence(F.lit(0), count - 1)).alias("chunk_no")).select(
        "_id",
        "chunk_no",
        (F.col("chunk_no").cast("bigint") * chunk).alias("at"),
        F.substring("_text", F.col("chunk_no") * chunk + 1, F.lit(chunk + overlap)).alias("piece"),
    )
    found = chunks.repartition("_id", "chunk_no").mapInArrow(bounds, "_id string, chunk_no int, heads array<bigint>, tails array<bigint>")
    # The boundaries of the overlap, seen from both sides, meet under the later chunk's number.
    sides = found.select("_id", "chunk_no", "heads", F.lit(None).cast("array<bigint>").alias("tails")).unionByName(
        found.select("_id", (F.col("chunk_no") + 1).alias("chunk_no"), F.lit(None).cast("array<bigint>").alias("heads"), "tails")
    )
    meets = sides.groupBy("_id", "chunk_no").agg(F.array_min(F.array_intersect(F.max("heads"), F.max("tails"))).alias("cut"))
    cuts = meets.where("cut IS NOT NULL").groupBy("_id").agg(F.sort_array(F.collect_list("cut")).alias("cuts"))
    joined = texts.join(cuts, "_id", "left").withColumn("cuts", F.coalesce("cuts", F.array().cast("array<bigint>")))
    lo = F.concat(F.array(F.lit(0).cast("bigint")), F.col("cuts"))
    hi = F.concat(F.col("cuts"), F.array(F.length("_text").cast("bigint")))
    parts = joined.select("_id", "_text", F.posexplode(F.arrays_zip(lo.alias("lo"), hi.alias("hi"))).alias("piece_no", "span"))
    piece = F.substring("_text", (F.col("span.lo") + 1).cast("int"), (F.col("span.hi") - F.col("span.lo")).cast("int"))
    return parts.select("_id", "piece_no", piece.alias("piece"))


def encode(docs: DataFrame, codec: Codec, key: list[str], text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """The ids of every row's whole text: the key columns and `ids`.

    Null counts as empty and has no ids. Repeated rows and keys come out as often
    as they came in. A text of one chunk is its own piece; of longer ones every
    different text is stitched and encoded once, pieces apart.
    """
    rows = docs.select(*key, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    one = F.length("_text") <= chunk + overlap
    ids = lambda tool, column: tool.encode(column.to_pylist())
    short = _mapped(rows.where(one), codec, "_text", "ids", "array<int>", ids)
    long = rows.where(~one).withColumn("_id", F.sha2("_text", 256))
    pieces = _mapped(stitched(long.select("_id", "_text").dropDuplicates(["_id"]), codec, chunk, overlap), codec, "piece", "ids", "array<int>", ids)
    in_order = F.array_sort(F.collect_list(F.struct("piece_no", "ids")))
    whole = pieces.groupBy("_id").agg(F.flatten(F.transform(in_order, lambda p: p["ids"])).alias("ids"))
    return short.unionByName(long.drop("_text").join(whole, "_id").drop("_id"))


def decode(tokens: DataFrame, codec: Codec, ids: str = "ids") -> DataFrame:
    """`ids` replaced by `decoded`, the bytes of the tokens one after the other."""
    return _mapped(tokens, codec, ids, "decoded", "binary", lambda tool, column: tool.decode(column))


def digested(docs: DataFrame, codec: Codec, key: list[str], text: str = "text") -> DataFrame:
    """Key, `n_tokens`, `ids_sha256`, `decoded_sha256` of encode() and then decode()."""
    tokens = encode(docs, codec, key, text)
    spelled = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    listed = tokens.select(*key, "ids", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(spelled, 256).alias("ids_sha256"))
    return decode(listed, codec).select(*key, "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
