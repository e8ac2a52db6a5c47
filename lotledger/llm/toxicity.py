"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lotledger.llm.arrays import lowered, ngrams, pieces, words

#: Weights, and the word steps of a feature: words, pairs of neighbours, pairs with one and two words between.
BITS = 20
SHAPES = ((0,), (0, 1), (0, 2), (0, 3))
#: Labelled rows that are learned from, about; those with the smallest hash of their id. This bounds what one task reads.
MAX_ROWS = 16_000
EPOCHS = 5
ALPHA, BETA, L1, L2 = 1.0, 1.0, 10.0, 0.1
THRESHOLD = 0.3

_INNER = np.zeros(256, bool)
_INNER[48:58] = _INNER[65:91] = _INNER[97:123] = _INNER[128:] = True
_LOWER = lowered()


@dataclass(frozen=True)
class Model:
    """Places and values of the weights that are not zero, and the log-odds of label 1."""

    places: np.ndarray
    weights: np.ndarray
    prior: float


def features(buf: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each shape: the hashed features of some rows, and where each row's begin."""
    digests, bounds = words(_LOWER[buf], at, _INNER)
    for k, steps in enumerate(SHAPES):
        grams, starts = ngrams(digests, bounds, steps, k)
        yield (grams >> np.uint64(64 - BITS)).astype(np.int64), starts


class Ftrl:
    """Per-coordinate learning rates and L1: a weight is zero until its evidence is larger than L1."""

    def __init__(self, prior: float):
        self.prior = prior
        self.z = np.zeros(1 << BITS)
        self.n = np.zeros(1 << BITS)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, label: int) -> None:
        """One row of distinct features, each of value 1."""
        w = self.weights(at)
        g = probability(w.sum() + self.prior) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def probability(log_odds):
    return 1 / (1 + np.exp(-np.clip(log_odds, -35, 35)))


def held_out(doc_id: str | Column) -> Column:
    """Rows whose crc32(id as text) mod 4 is 2. A null id isn't held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, epochs: int = EPOCHS) -> Model:
    """A model of `labels.toxic` from about `max_rows` labelled rows that aren't held out.

    Of an id with several labels the highest holds; null labels and ids, and labels
    without a document, teach nothing. The sampled labels (ids and bits, bounded by
    `max_rows`) are broadcast to the documents, so no text of others moves; one task
    then learns in order of the hash. Without labelled rows all scores are the
    prior, one in eleven.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32))
    n, positive = known.agg(F.count("*"), F.sum("toxic")).first()
    prior = float(np.log(((positive or 0) + 1) / (n - (positive or 0) + 10)))
    # The hash of an id is even, so this many come in below the bound; a fifth is left for chance.
    sample = known.withColumn("place", place).where(F.col("place") < int((1 << 32) * min(1.0, max_rows / max(1, n))))
    sample = sample.orderBy("place", "doc_id").limit(max_rows + max_rows // 5)
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(sample), "doc_id").select("place", "doc_id", "toxic", "text")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, marks = [], []
        for b in batches:
            for i, j, buf, at in pieces(b.column("text")):
                shapes = list(features(buf, at))
                seen += [np.unique(np.concatenate([f[s[r] : s[r + 1]] for f, s in shapes])).astype(np.int32) for r in range(j - i)]
                marks += b.column("toxic")[i:j].to_pylist()
        model = Ftrl(prior)
        for epoch in range(epochs):
            for r in np.random.default_rng(epoch).permutation(len(seen)):
                model.learn(seen[r], marks[r])
        w = model.weights(slice(None))
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(w[at])], ["place", "weight"])

    told = rows.repartition(1).sortWithinPartitions("place", "doc_id", "text").mapInArrow(learn, "place int, weight double").toPandas()
    return Model(told["place"].to_numpy(), told["weight"].to_numpy(), prior)


def _scored(model_parts, column: pa.Array) -> np.ndarray:
    table, prior = model_parts
    out = np.zeros(len(column))
    for i, j, buf, at in pieces(column):
        for f, starts in features(buf, at):
            hit = np.flatnonzero(table[f])
            row = np.searchsorted(starts, hit, "right") - 1
            distinct = np.unique(row << BITS | f[hit])
            out[i:j] += np.bincount(distinct >> BITS, table[distinct & (1 << BITS) - 1], minlength=j - i)
    return probability(out + prior)


def score(docs: DataFrame, model: Model, name: str = "score", text: str = "text") -> DataFrame:
    """The rows with all their columns and the probability of label 1.

    A null or empty text has no features and gets the prior.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.places, model.weights.astype(np.float64), model.prior))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, weights, prior = shared.value
        table = np.zeros(1 << BITS)
        table[places] = weights
        for b in batches:
            at = b.schema.get_field_index(text)
            yield b.append_column(name, pa.array(_scored((table, prior), b.column(at))))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, `{name}` double")
