"""Recompression against plain window sets, on odd rows and on texts that repeat in many ways."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import rows

from lotledger.llm import recompression
from lotledger.llm.arrays import flat


def by_hand(body, window):
    last = (1 << 63) - 1
    split = [(last if i is None else i, i, (t or "").encode().split()) for i, t in body]
    least = {}
    for k, _, ws in split:
        for s in range(len(ws) - window + 1):
            key = tuple(ws[s : s + window])
            least[key] = min(least.get(key, k), k)
    out = []
    for k, i, ws in split:
        gone = {p for s in range(len(ws) - window + 1) if least[tuple(ws[s : s + window])] < k for p in range(s, s + window)}
        kept = b" ".join(w for p, w in enumerate(ws) if p not in gone)
        out.append((i, len(ws), len(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def got(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect())


def frame(spark, body):
    return spark.createDataFrame([(i, t, 1, "x", 3) for i, t in body], "doc_id bigint, text string, row int, a string, least int")


def test_odd_rows(spark, docs):
    assert got(recompression.dedup(docs)) == by_hand(rows(), 13)
    assert recompression.dedup(docs.where("false")).collect() == []


def repeats(seed):
    """Passages, their pieces, runs, periodic stretches and near copies, of few and of many different words."""
    rng = random.Random(seed)
    few, many = ["a", "b", "c"], [f"w{k}" for k in range(500)]
    text = lambda n, vocabulary: [rng.choice(vocabulary) for _ in range(n)]
    passages = [text(n, v) for n in (13, 14, 30, 400) for v in (few, many)] + [["x"] * 60, ["p", "q"] * 40, ["p", "q", "r"] * 30]
    long = text(900, many)
    out = [(0, long)]
    for i in range(1, 60):
        ws = []
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            s = rng.randrange(len(p))
            ws += text(rng.randrange(12), rng.choice((few, many))) + p[s : s + rng.randrange(1, len(p) + 1)]
        if i % 9 == 0:
            ws = long[: rng.randrange(100, 900)]
            ws[rng.randrange(len(ws))] = "edit"
        out.append((rng.choice((i, i, i, -i)), ws))
    return [(i, rng.choice((" ", "\n", " \t ")).join(ws)) for i, ws in out]


@pytest.mark.parametrize("seed, window", [(1, 13), (2, 13), (3, 5)])
def test_repeats(spark, monkeypatch, seed, window):
    if seed == 2:  # rounds of names from the lowest level on, and a filter that is full
        monkeypatch.setattr(recompression, "BASE", 5)
        monkeypatch.setattr(recompression, "STEP", 2)
        monkeypatch.setattr(recompression, "FILTER_BITS", 64)
    body = repeats(seed)
    assert got(recompression.dedup(frame(spark, body), window=window)) == by_hand(body, window)


def test_long_runs_make_few_marks():
    one, two, bounds = recompression.named(*flat(pa.array(["a " * 20000])))
    parsed = recompression.Parsed(one, two, bounds, 13)
    row, _, _ = parsed.marks(list(parsed.levels()))
    assert len(row) == 1


@pytest.mark.parametrize("seed", range(3))
def test_equal_windows_have_equal_marks(seed):
    body = repeats(seed)
    parsed = recompression.Parsed(*recompression.named(*flat(pa.array([t for _, t in body]))), 13)
    row, mark, lo = parsed.marks(list(parsed.levels()))
    seen, count = {}, 0
    for r, (_, t) in enumerate(body):
        ws = t.split()
        own, at = mark[row == r], lo[row == r]
        for s in range(len(ws) - 12):
            m = own[np.searchsorted(at, s, "right") - 1]
            assert seen.setdefault(tuple(ws[s : s + 13]), m) == m
            count += 1
    assert count > len(seen)


def test_equal_stretches_share_inner_symbols():
    """Away from its ends a stretch shrinks to the same names wherever it stands."""
    rng = random.Random(5)
    stretch = [f"w{rng.randrange(300)}" for _ in range(3000)]
    texts = [" ".join([f"h{k}{j}" for j in range(k * 7 + 1)] + stretch + [f"t{k}"]) for k in range(3)]
    parsed = recompression.Parsed(*recompression.named(*flat(pa.array(texts))), 13)
    row, a, b, at, until = parsed.symbols(list(parsed.levels()))
    names = [set(zip(a[row == k].tolist(), b[row == k].tolist())) for k in range(3)]
    common = set.intersection(*names)
    assert len(common) > 0.8 * len(names[0])
    assert (until[row == 0][:-1] == at[row == 0][1:]).all()
