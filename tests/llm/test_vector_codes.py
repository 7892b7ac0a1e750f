from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfrisk.llm import vector_codes as V

from .conftest import rows

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error int, part int, entry string, total int"


def table(spark, data):
    return spark.createDataFrame([(i, v, l, "x", 1, 2, "y", 3) for i, v, l in data], SCHEMA)


def plain(data, rounds=4):
    """The contract, word by word, with Python integers."""
    ok = [(i, v, l) for i, v, l in data if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not ok:
        return {}, None
    width = max(4, -(-max(len(v) for _, v, _ in ok) // 4) * 4)
    w = width // 4
    ints = [[max(-2**53, min(2**53, math.floor(1024 * x))) for x in v] + [0] * (width - len(v)) for _, v, _ in ok]
    order = sorted(range(len(ok)), key=lambda k: (ok[k][0] is None, ok[k][0] or 0, ok[k][1]))[:256]
    books = [[ints[k][p * w:(p + 1) * w] for k in order] for p in range(4)]

    def near(part, p):
        d = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in books[p]]
        return min(range(len(d)), key=lambda k: (d[k], k)), min(d)

    for _ in range(rounds):
        for p in range(4):
            got = {}
            for x in ints:
                got.setdefault(near(x[p * w:(p + 1) * w], p)[0], []).append(x[p * w:(p + 1) * w])
            books[p] = [[sum(c) // len(c) for c in zip(*got[k])] if k in got else e for k, e in enumerate(books[p])]
    out, by_label = [], {}
    for (i, _, l), x in zip(ok, ints):
        found = [near(x[p * w:(p + 1) * w], p) for p in range(4)]
        error = min(sum(d for _, d in found), 2**63 - 1)
        by_label[l] = by_label.get(l, 0) + error
        out.append((i, l, "".join(f"{k:02x}" for k, _ in found), error))
    text = ",".join(str(c) for p in books for e in p for c in e)
    digest = hashlib.sha256(text.encode()).hexdigest()
    return sorted(((i, c, e, min(by_label[l], 2**63 - 1), digest) for i, l, c, e in out), key=repr), digest


def got(df):
    return sorted(((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in rows(df)), key=repr)


def test_sequency():
    for n in (1, 2, 8, 32):
        h = V.transform(np.eye(n, dtype=np.int64)).T
        assert [int((np.diff(r) != 0).sum()) for r in h] == list(range(n))
        assert (h @ h.T == n * np.eye(n)).all()


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 40), st.integers(1, 60), st.sampled_from([2, 50, 10**6, 2**53]), st.integers(0, 10**6))
def test_nearest_is_exact(width, entries, n, top, seed):
    rng = random.Random(seed)
    x, e = (np.array([[rng.randint(-top, top) for _ in range(width)] for _ in range(k)], np.int64) for k in (n, entries))
    index, error = V.nearest(x, e)
    for row, i, d in zip(x.tolist(), index, error):
        true = [sum((a - b) ** 2 for a, b in zip(row, c)) for c in e.tolist()]
        assert int(d) == min(true) and i == true.index(min(true))


def test_against_plain_code(spark):
    rng = random.Random(5)
    base = [[rng.gauss(0, 0.3) for _ in range(20)] for _ in range(12)]
    data = [(i * 3 % 401, [x + rng.gauss(0, 0.05) for x in rng.choice(base)], rng.choice([0, 1, None])) for i in range(400)]
    data += [data[7]] * 130                       # a third of the rows are copies
    assert got(V.compress(table(spark, data).repartition(7))) == plain(data)[0]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [(1, None, 1), (2, [1.0, None, 0.0, 0.0], 1), (3, [nan, 0.0, 0.0, 0.0], 1), (4, [inf, 0.0, 0.0, 0.0], None), (5, [], None),
            (6, [0.5, -0.5, 0.25, 0.1, 0.3], None), (None, [-0.0001, 0.0001, 0.0, 0.0], 7), (6, [0.5, -0.5, 0.25, 0.1, 0.3], 7),
            (8, [1e300, -1e300, 3e10, 5.0], 9), (9, [1e15, 1.0, -1e15, 0.0], 9), (None, None, None)]
    assert got(V.compress(table(spark, data))) == plain(data)[0]
    assert len(plain(data)[0]) == 6
    assert got(V.compress(table(spark, data[:4]))) == [] == got(V.compress(table(spark, [])))


@pytest.mark.parametrize("rounds", [0, 1])
def test_training_rounds(spark, rounds):
    rng = random.Random(6)
    data = [(i, [rng.random() for _ in range(8)], i % 3) for i in range(300)]
    assert got(V.compress(table(spark, data), rounds)) == plain(data, rounds)[0]
