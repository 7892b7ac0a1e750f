from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfrisk.llm.quality import BITS, features, ftrl, score, tokens, train, training_sample
from shelfrisk.llm.registry import op3_quality
from shelfrisk.llm.words import text_buffer

from .conftest import SF, needs_data, rows


def of(texts):
    return text_buffer(pa.array(texts, pa.string()))


def test_features_by_hand():
    h, first = tokens(*of(["Ab ab, CD EF !!", None, "ab"]))
    assert list(np.diff(first)) == [6, 0, 1]
    assert h[1] != h[0] and h[0] == h[6]          # the second word repeats the first
    assert h[3] != h[4]                            # two capital words: the second is a repeat
    r, i, x = features(*of(["a a a a", "", "b"]))
    assert set(r) == {0, 2} and np.allclose(x[r == 2], 1)
    assert abs((x[r == 0] ** 2).sum() - (4 + 3) / 4) < 1e-9


@settings(deadline=None, max_examples=30)
@given(st.lists(st.text(alphabet="aB! \né", max_size=20), min_size=1, max_size=6))
def test_features_do_not_cross_rows(texts):
    r, i, x = features(*of(texts))
    for n, t in enumerate(texts):
        _, one, value = features(*of([t]))
        assert (i[r == n] == one).all() and np.allclose(x[r == n], value)


def test_one_text_for_each_id(spark):
    """A labelled id that a third of the rows share is one training row, and null ids are none."""
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(None, "x")] * 20 + [(i, None if i == 7 else f"own {i}")
                                 for i in range(2, 60)], "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)] * 2 + [(None, 1)], "doc_id long, quality int")
    sample = training_sample(docs, labels, 1000)
    got = rows(sample)
    assert len(got) == 59 and len({r["key"] for r in got}) == 59
    assert sorted(map(str, got)) == sorted(map(str, rows(training_sample(docs.repartition(3), labels, 1000))))
    assert len(rows(training_sample(docs, labels, 10))) < 30


def test_ftrl_is_the_plain_update():
    rng = np.random.default_rng(0)
    data = [(np.sort(rng.choice(16, 3, replace=False)), rng.random(3), float(rng.integers(2))) for _ in range(50)]
    z, n = [0.0] * 17, [0.0] * 17

    def weight(j):
        l1, l2 = (0, 0) if j == 16 else (0.1, 0.2)
        return 0.0 if abs(z[j]) <= l1 else -(z[j] - np.sign(z[j]) * l1) / ((1 + n[j] ** 0.5) / 0.5 + l2)

    for i, x, y in data:
        pairs = [*zip(i, x), (16, 1.0)]
        w = {j: weight(j) for j, _ in pairs}
        p = 1 / (1 + np.exp(-sum(w[j] * v for j, v in pairs)))
        for j, v in pairs:
            g = (p - y) * v
            z[j] += g - ((n[j] + g * g) ** 0.5 - n[j] ** 0.5) / 0.5 * w[j]
            n[j] += g * g
    assert np.allclose(ftrl(data, 4, alpha=0.5, beta=1.0, l1=0.1, l2=0.2), [weight(j) for j in range(17)])


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(3, 1, 0), (9, 0, 0), (None, 1, 0), (6, None, 0), (7, 1, 0), (7, 0, 0), (99, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    w = train(odd, labels)
    assert w.size == (1 << BITS) + 1
    got = rows(score(odd, w, ("doc_id",)))
    assert len(got) == odd.count() and all(0 <= r["__score"] <= 1 for r in got)
    assert len({r["__score"] for r in got if r["doc_id"] in (0, 1, 2)}) == 1      # without tokens: the bias
    none = train(odd, labels.limit(0))
    assert {r["__score"] for r in rows(score(odd, none, ("doc_id",)))} == {0.5}
    assert rows(score(odd.limit(0), w, ("doc_id",))) == []


@needs_data
def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in rows(spark.read.parquet(f"{SF}/labels.parquet"))}
    got = rows(op3_quality(spark, SF))
    assert len(got) == 1000
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert r["predicted"] == int(r["score"] >= 0.7)
    held = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert got == rows(op3_quality(spark, SF)) or sorted(got, key=str) == sorted(rows(op3_quality(spark, SF)), key=str)
