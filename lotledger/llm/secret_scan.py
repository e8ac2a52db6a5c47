"""Secrets in texts: fixed patterns, and strings that pass a battery of randomness tests."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lotledger.llm.arrays import pieces

# The base patterns, in the order in which their kinds are listed.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+", re.ASCII)
ACCESS_LEAST = 20
HEX = re.compile(r"[0-9a-f]+", re.ASCII)
HEX_LEAST = 24

#: Shortest string that is tested, and the first lengths of the classes that share a null distribution.
LEAST = 20
CLASSES = (20, 28, 40, 56, 88)
#: The battery's statistic is kept in bins of this width, up to a last one.
STEP, BINS = 0.1, 800
#: Share of false ones among the strings found.
FDR = 0.01

_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % LEAST, re.ASCII)
_IS_TOKEN = bytes(120 if chr(c) in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-" else 32 for c in range(256))
_IS_HEX = bytes(120 if chr(c) in "0123456789abcdef" else 32 for c in range(256))
_LETTER = np.full(256, 255, np.uint8)
_LETTER[97:123] = _LETTER[65:91] = np.arange(26)

_LOWER, _UPPER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Encodings, the smallest alphabet first; a string is of the first one that has all its characters.
ENCODINGS = tuple(
    (name, {c: i for i, c in enumerate(alphabet)})
    for name, alphabet in (
        ("decimal", _DIGIT), ("hex", _DIGIT + "abcdef"), ("HEX", _DIGIT + "ABCDEF"), ("lower", _LOWER), ("upper", _UPPER),
        ("base32", _UPPER + "234567"), ("base36", _DIGIT + _LOWER), ("BASE36", _DIGIT + _UPPER),
        ("base62", _DIGIT + _UPPER + _LOWER), ("base64", _UPPER + _LOWER + _DIGIT + "+/"), ("base64url", _UPPER + _LOWER + _DIGIT + "-_"),
        ("any", _UPPER + _LOWER + _DIGIT + "+/-_"),
    )
)


def battery(values: np.ndarray, size: int) -> np.ndarray:
    """For rows of symbols below `size`, how far each row is from random: 0 is ideal, about 3 usual, natural text far more.

    The sum of squares of three normal scores. Chi-squared against a uniform
    alphabet, by its exact mean and variance (only an excess counts); runs above and
    below the middle of the alphabet; correlation of neighbours.
    """
    n, length = values.shape
    counts = np.bincount((np.arange(n)[:, None] * size + values).ravel(), minlength=n * size).reshape(n, size)
    chi = (counts.astype(np.float64) ** 2).sum(1) * size / length - length
    z_chi = np.maximum(0, (chi - (size - 1)) / np.sqrt(2 * (size - 1) * (length - 1) / length))
    high = values * 2 >= size
    runs = (high[:, 1:] != high[:, :-1]).sum(1)
    z_runs = (runs - (length - 1) / 2) / np.sqrt((length - 1) / 4)
    centred = values - values.mean(1, keepdims=True)
    spread = np.maximum((centred**2).sum(1), 1e-9)
    z_serial = ((centred[:, 1:] * centred[:, :-1]).sum(1) / spread + 1 / length) * np.sqrt(length)
    return z_chi**2 + z_runs**2 + z_serial**2


def encoding(token: str) -> tuple[str, dict[str, int]]:
    chars = set(token)
    return next((name, places) for name, places in ENCODINGS if chars <= places.keys())


def length_class(length: int) -> int:
    return sum(length >= c for c in CLASSES) - 1


def candidates(text: str) -> list[tuple[int, int, int, int]]:
    """Strings that might be random: start, end, length class, bin of the statistic."""
    out = []
    for m in _TOKEN.finditer(text):
        token = m.group().rstrip("=")
        _, places = encoding(token)
        statistic = battery(np.array([[places[c] for c in token]]), len(places))[0]
        out.append((m.start(), m.end(), length_class(len(token)), min(BINS - 1, int(statistic / STEP))))
    return out


def base(data: bytes, text: str) -> list[tuple[int, int, int]]:
    """Matches of the fixed patterns: start, end, kind. `data` is the text in UTF-8, for quick misses."""
    out = []
    low = data.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    if b"AKIA" in data:
        out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    if b"x" * HEX_LEAST in data.translate(_IS_HEX):
        out += [(m.start(), m.end(), 2) for m in HEX.finditer(text) if m.end() - m.start() >= HEX_LEAST]
    return sorted(out, key=lambda s: (s[0], s[2]))


def possible(data: bytes) -> bool:
    return b"x" * LEAST in data.translate(_IS_TOKEN)


def _null(histogram: np.ndarray, column: pa.Array) -> None:
    """Adds what the battery makes of ordinary text: each row's letters, in blocks as long as a class's shortest string."""
    for _, _, buf, at in pieces(column, 1 << 18):
        letters = _LETTER[buf]
        row = np.repeat(np.arange(len(at) - 1), np.diff(at))
        keep = letters < 26
        letters, row = letters[keep].astype(np.int64), row[keep]
        bounds = np.searchsorted(row, np.arange(len(at)))
        for c, length in enumerate(CLASSES):
            starts = np.concatenate([np.arange(s, e - length + 1, length) for s, e in zip(bounds, bounds[1:])] or [np.empty(0, np.int64)]).astype(np.int64)
            for i in range(0, len(starts), 1 << 14):
                blocks = letters[starts[i : i + (1 << 14), None] + np.arange(length)]
                histogram[c] += np.bincount(np.minimum(BINS - 1, (battery(blocks, 26) / STEP).astype(np.int64)), minlength=BINS)


@dataclass(frozen=True)
class Cuts:
    """Per length class, the number of bins from 0 on that count as random."""

    bins: tuple[int, ...]


def decide(null: np.ndarray, found: np.ndarray, rate: float = FDR) -> Cuts:
    """Weighted Benjamini-Hochberg over all candidates of the corpus.

    A candidate's p is the share of ordinary text of its length that looks at least
    as random. Its weight is the length of its class, over the mean of all
    candidates: a long random string is worth more of the error rate than a short one.
    """
    total = found.sum()
    if not total:
        return Cuts((0,) * len(CLASSES))
    p = (np.cumsum(null, 1) + 1) / (null.sum(1, keepdims=True) + 1)
    lengths = np.array(CLASSES, float)[:, None]
    q = p / (lengths / ((lengths * found).sum() / total))
    order = np.argsort(q, axis=None, kind="stable")
    counts, ranked = found.ravel()[order], q.ravel()[order]
    reached = np.cumsum(counts)
    good = np.flatnonzero((counts > 0) & (ranked <= rate * reached / total))
    limit = ranked[good[-1]] if len(good) else -1.0
    return Cuts(tuple(int((row <= limit).sum()) for row in q))


def fit(docs: DataFrame, text: str = "text", rate: float = FDR) -> Cuts:
    """The cuts for a corpus, from all its texts. The driver gets two histograms of fixed size.

    Without texts, or with too few to tell ordinary from random, nothing is random.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        null, found = np.zeros((2, len(CLASSES), BINS), np.int64)
        for b in batches:
            _null(null, b.column("t"))
            for value in b.column("t"):
                data = value.as_py() or b""
                if possible(data):
                    for _, _, c, at in candidates(data.decode()):
                        found[c, at] += 1
        for kind, table in enumerate((null, found)):
            c, at = np.nonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c), kind, np.int32)), pa.array(c.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(table[c, at])], ["kind", "class", "bin", "n"])

    rows = docs.select(F.col(text).cast("binary").alias("t")).mapInArrow(run, "kind int, class int, bin int, n bigint")
    tables = np.zeros((2, len(CLASSES), BINS), np.int64)
    for r in rows.groupBy("kind", "class", "bin").agg(F.sum("n").alias("n")).collect():
        tables[r["kind"], r["class"], r["bin"]] = r["n"]
    return decide(tables[0], tables[1], rate)


def spans(data: bytes, cuts: Cuts) -> list[tuple[int, int, int]]:
    """All spans of a text: start, end, kind; a random string that touches a base span is that span's."""
    text = data.decode()
    own = base(data, text)
    if possible(data):
        more = [(s, e, 3) for s, e, c, at in candidates(text) if at < cuts.bins[c] and not any(s < f and b < e for b, f, _ in own)]
        own = sorted(own + more, key=lambda s: (s[0], s[2]))
    return own


def find(docs: DataFrame, cuts: Cuts, key: list[str], text: str = "text") -> DataFrame:
    """Per row: key and `spans` (kind, start, end in code points, end exclusive), by start and then kind.

    Null and empty texts have none. Repeated rows come out as often as they came in.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for b in batches:
            found = [[{"kind": KINDS[k], "start": s, "end": e} for s, e, k in spans(t.as_py() or b"", cuts)] for t in b.column("_text")]
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in key], pa.array(found, kind)], [*key, "spans"])

    fields = [f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in key]
    return docs.select(*key, F.col(text).cast("binary").alias("_text")).mapInArrow(run, ", ".join([*fields, "spans array<struct<kind:string,start:int,end:int>>"]))


def redact(docs: DataFrame, cuts: Cuts, text: str = "text") -> DataFrame:
    """The same rows and columns; each secret is replaced by its kind in brackets. Of overlapping spans one mark is left."""

    def clean(value: pa.Scalar) -> str | None:
        body = value.as_py()
        found = spans(body.encode(), cuts) if body else []
        out, done = [], 0
        for s, e, k in found:
            if s >= done:
                out += [body[done:s], f"[{KINDS[k]}]"]
            done = max(done, e)
        return "".join([*out, body[done:]]) if found else body

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(text)
            yield b.set_column(at, b.schema.field(at), pa.array([clean(v) for v in b.column(at)], b.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def reported(found: DataFrame, key: list[str]) -> DataFrame:
    """Key, `n_assign`, `n_access`, `n_hex`, `base_sha256`, `spans` of find()."""

    def spelled(of):
        return F.concat_ws(",", F.transform(of, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        *key, *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(spelled(F.filter("spans", lambda s: s["kind"] != KINDS[3])), 256).alias("base_sha256"), spelled(F.col("spans")).alias("spans"),
    )
