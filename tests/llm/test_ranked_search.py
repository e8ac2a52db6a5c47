"""Ranked search against plain scoring of every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from conftest_llm import rows

from lotledger.llm import ranked_search
from lotledger.llm.ranked_search import Block, Pass

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def by_hand(body, items, top):
    """The scores of each item's best documents; ids are compared apart from rows that tie with equal ids."""
    counts = [(i, Counter(terms(t))) for i, t in body]
    total = sum(1 for _, c in counts if c)
    every = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for item, ts in wanted.items():
        scored = []
        for i, c in counts:
            n = sum(c.values())
            m = 50 + 50 * n * total // every if every else 0
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in ts if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:top])]
    return sorted(out, key=repr)


def got(df):
    return sorted([tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()], key=repr)


QUERIES = [(1, "the QUICK brown fox"), (2, "word5 word7 line3 nothing"), (3, None), (4, ""), (5, "zzz absent"), (6, "über Café one two"), (7, "aaaa a edit line0"), (1, "lazy dog"), (1, "lazy dog"), (None, "one"), (8, "漢字 tail head end")]


@pytest.mark.parametrize("top, block, terms_of_pass", [(50, 1 << 18, 1 << 19), (2, 40, 1 << 19), (3, 1, 4)])
def test_search(spark, docs, monkeypatch, top, block, terms_of_pass):
    monkeypatch.setattr(ranked_search, "BLOCK", block)
    monkeypatch.setattr(ranked_search, "PASS_TERMS", terms_of_pass)
    items = spark.createDataFrame([(i, t, 3, "x") for i, t in QUERIES], "item_id int, text string, doc_id int, n string")
    assert got(ranked_search.search(docs, items, top)) == by_hand(rows(), QUERIES, top)


def test_long_text_is_cut_between_terms(spark, monkeypatch):
    body = [(i, " ".join(f"Term{(i * 31 + k * k) % 97}" for k in range(300)) + "é" * i) for i in range(8)] + [(9, "x" * 3000), (10, ""), (11, None)]
    monkeypatch.setattr(ranked_search, "PIECE", 64)
    import pyarrow as pa

    digests, row = (np.concatenate(x) for x in zip(*ranked_search.term_runs(pa.array([t for _, t in body]))))
    assert Counter(row.tolist()) == Counter({k: len(terms(t)) for k, (_, t) in enumerate(body) if terms(t)})
    named = {}
    for d, t in zip(digests.tolist(), (t for _, text in body for t in terms(text))):
        assert named.setdefault(t, d) == d
    assert len(set(named.values())) == len(named)


def test_no_documents_or_queries(spark, docs):
    items = spark.createDataFrame([(1, "one two")], "item_id int, text string")
    assert got(ranked_search.search(docs.where("false"), items)) == []
    assert got(ranked_search.search(docs, items.where("false"))) == []


@pytest.mark.parametrize("seed", range(6))
def test_bounds_lose_nothing_and_skip(spark, seed):
    """A block of random postings: whatever the threshold, all documents that reach it come, with whole scores."""
    rng = np.random.default_rng(seed)
    n_terms, n_docs = 12, 400
    held = rng.random((n_terms, n_docs)) < rng.uniform(0.005, 0.4, (n_terms, 1))
    impact = np.where(held, rng.integers(1, 1000, (n_terms, n_docs)) * rng.integers(1, 30, (n_terms, 1)), 0)
    pairs = [(0, 1), (2, 3), (4, 5), (6, 7), (8, 9)]
    lists = [np.flatnonzero(x) for x in impact]
    both = [np.flatnonzero((impact[a] > 0) & (impact[b] > 0)) for a, b in pairs]
    kept = [k for k, x in enumerate(lists) if len(x)]
    joint = [k for k, x in enumerate(both) if len(x)]
    row = {
        "docs": np.arange(n_docs), "term": np.array(kept, int), "term_at": np.cumsum([0, *[len(lists[k]) for k in kept]]),
        "slot": np.concatenate([lists[k] for k in kept]), "impact": np.concatenate([impact[k][lists[k]] for k in kept]), "most": np.array([impact[k].max() for k in kept]),
        "pair": np.array(joint, int), "pair_at": np.cumsum([0, *[len(both[k]) for k in joint]]), "pair_slot": np.concatenate([both[k] for k in joint] or [[]]).astype(int),
        "pair_most": np.array([(impact[pairs[k][0]] + impact[pairs[k][1]])[both[k]].max() for k in joint], int),
    }
    units = np.array([(k, a, b) for k, (a, b) in enumerate(pairs)] + [(-1, 10, -1)])
    block = Block(row, n_terms, len(pairs))
    full = impact[:11].sum(0)
    for least in (0, 1, *np.sort(full)[[n_docs // 2, -50, -5, -1]].tolist(), int(full.max()) + 1):
        slots, score = block.best(units, least)
        want = np.flatnonzero((full >= least) & (full > 0))
        assert slots.tolist() == want.tolist() and score.tolist() == full[want].tolist()


def test_pairs_follow_weights():
    search = Pass(None, [np.array([0, 1, 2, 3, 4])], np.arange(5, dtype=np.uint64))
    search.weigh(100, 1000, {0: 50, 1: 1, 2: 20, 3: 2, 4: 90})
    assert search.units[0].tolist() == [[0, 1, 3], [1, 0, 2], [-1, 4, -1]]
