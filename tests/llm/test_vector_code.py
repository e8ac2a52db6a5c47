"""Vector codes against plain loops, on odd rows and on ties."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from lotledger.llm import vector_code


def by_hand(body, parts, entries, rounds):
    kept = [(i, v, t) for i, v, t in body if v and all(x is not None and math.isfinite(x) for x in v) and len(v) % parts == 0]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = len(kept[0][1]) // parts
    cut = [[[min(max(math.floor(4096 * x), -(1 << 27)), 1 << 27) for x in v[p * width : (p + 1) * width]] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(c[p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        chosen = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [c[p] for c, a in zip(cut, chosen) if a[p][1] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own)]
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    errors, out = defaultdict(int), []
    for (i, _, t), a in zip(kept, assign()):
        errors[t] += sum(d for d, _ in a)
        out.append((i, t, "".join(f"{k:02x}" for _, k in a), sum(d for d, _ in a)))
    return Counter((i, code, e, errors[t], sha) for i, t, code, e in out)


def frame(spark, body):
    return spark.createDataFrame([(i, v, t, "x", 1) for i, v, t in body], "vec_id bigint, embedding array<float>, label int, id string, n int")


def got(df):
    return Counter(tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())


def vectors(n, dim, seed=3):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(size=dim).astype(np.float32)], int(rng.integers(0, 3))) for i in range(n)]


@pytest.mark.parametrize("parts, entries, rounds", [(8, 16, 6), (2, 5, 1), (1, 40, 3)])
def test_codes(spark, parts, entries, rounds):
    body = vectors(90, 16)
    same = body[3][1]
    body += [(200 + i, same, None) for i in range(30)] + [body[5], body[5], (None, body[7][1], 1), (None, None, 1)]
    body += [(300, None, 1), (301, [], 2), (302, [1.0] * 15 + [None], 0), (303, [math.nan] * 16, 0), (304, [math.inf] + [0.0] * 15, 0), (305, [1.0] * 8, 0), (306, [1e30] * 16, 4), (307, [0.0] * 16, 5)]
    assert got(vector_code.encode(frame(spark, body), parts=parts, entries=entries, rounds=rounds)) == by_hand(body, parts, entries, rounds)


def test_few_rows_and_none(spark):
    body = vectors(3, 8)
    assert got(vector_code.encode(frame(spark, body))) == by_hand(body, 8, 16, 6)
    assert vector_code.encode(frame(spark, body).where("false")).collect() == []
    assert vector_code.encode(frame(spark, [(1, None, 1)])).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_search_finds_the_first_nearest():
    rng = np.random.default_rng(1)
    for _ in range(20):
        entries = rng.integers(-4, 5, size=(rng.integers(1, 40), 2))
        points = rng.integers(-6, 7, size=(200, 2))
        entry, distance = vector_code.Codebook(entries).nearest(points)
        apart = ((points[:, None] - entries[None]) ** 2).sum(-1)
        assert (entry == apart.argmin(1)).all() and (distance == apart.min(1)).all()
