from __future__ import annotations

import hashlib
import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfrisk.llm import fingerprint as P

from .conftest import frame, needs_data, rows, words


def true_sets(text):
    w = words(text)
    k = min(5, len(w))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()


def order(docs):
    """(id, text) in the operator's order where ids are distinct."""
    return sorted(((r["doc_id"], r["text"] or "") for r in rows(docs)), key=lambda x: (x[0] is not None, x[0] or 0))


def check(docs, got, distinct=True):
    data = order(docs)
    assert len(got) == len(data)
    if not distinct:
        return
    by = {r["doc_id"]: r for r in got}
    for (i, text), (_, after) in zip(data, data[1:] + data[:1]):
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        g = by[i]
        assert (g["n_chars"], g["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        own, other, follow = (P.sketches([t])[0] for t in (text, edited, after))
        assert g["fingerprint"] == P.encode(own) and g["edited_fingerprint"] == P.encode(other)
        assert (g["near_edited"], g["near_next"]) == (P.likeness(own, other), P.likeness(own, follow))


def test_sketches_estimate():
    rng = random.Random(2)
    base = [f"w{rng.randrange(5000)}" for _ in range(4000)]
    a, b = " ".join(base), " ".join(base[:3000] + [f"x{i}" for i in range(1000)])
    x, y = P.sketches([a, b])
    want = len(true_sets(a) & true_sets(b)) / len(true_sets(a) | true_sets(b))
    assert abs(P.likeness(x, y) - want) < 0.05
    short = P.sketches([" ".join(base[:400])])[0]
    assert P.containment(short, x) == 1.0 and P.containment(x, short) < 0.2
    assert P.decode(P.encode(x))[0] == x[0] and (P.decode(P.encode(x))[1] == x[1]).all()
    assert (P.merge(x, y)[1] == P.merge(y, x)[1]).all()
    assert P.sketches(["A b, c d e!"])[0][0] == 1


def test_short_texts():
    """Equal short texts are alike though none of their hashes is low."""
    texts = [f"word{i}" for i in range(200)] + ["", " .,"]
    got = P.sketches(texts)
    assert sum(h[0] >= P.low_hashes(P.SCALE) for n, h in got if n) > 100
    for i, a in enumerate(got):
        assert P.likeness(a, a) == 1.0 and P.likeness(a, got[i - 3]) == 0.0
        n, h = P.decode(P.encode(a))
        assert n == a[0] and (h == a[1]).all()
    # the union of sketches is the sketch of the union
    long = P.sketches([" ".join(f"w{i}" for i in range(300))])[0]
    for a in got[:200]:
        low = a[1] < P.low_hashes(P.SCALE)
        assert set(P.merge(a, long)[1].tolist()) == set(long[1].tolist()) | set(a[1][low].tolist())
        assert P.merge(a, got[0])[1].size >= 1


@settings(deadline=None, max_examples=30)
@given(st.lists(st.text(alphabet="ab cé.", max_size=30), min_size=1, max_size=6))
def test_sketches_do_not_depend_on_the_batch(texts):
    for t, (n, h) in zip(texts, P.sketches(texts)):
        m, g = P.sketches([t])[0]
        assert n == m and (h == g).all()


def test_neighbours_over_ranges(spark, monkeypatch):
    texts = [" ".join(f"w{(i * 7 + j) % 50}" for j in range(i % 40)) for i in range(200)]
    ids = [i * i * 3 - 500 for i in range(200)]
    for per_range in (7, 1, 1000):
        docs = frame(spark, texts, ids)
        monkeypatch.setattr(P, "CHUNK_CHARS", 300)
        got = rows(P.with_next(docs, per_range))
        assert sum(not r["donor"] for r in got) == 200
        monkeypatch.setattr(P.with_next, "__defaults__", (per_range,))
        check(docs, rows(P.compare_with_next(docs)))


def test_hot_ids_are_cut(spark, monkeypatch):
    """A third of the rows under a null id, a fifth under another: no range grows with them."""
    n = 1500
    texts = [" ".join(f"w{(i * 13 + j * j) % 97}x{i}" for j in range(6)) for i in range(n)]
    ids = [None if i % 3 == 0 else 700 if i % 5 == 1 else i for i in range(n)]
    docs = frame(spark, texts, ids)
    got = [r for r in rows(P.with_next(docs, 50)) if not r["donor"]]
    sizes = Counter(r["bucket"] for r in got)
    assert len(got) == n and max(sizes.values()) < 200 and len(sizes) > 15
    monkeypatch.setattr(P.with_next, "__defaults__", (50,))
    ordered = docs.selectExpr("doc_id", "text", "xxhash64(text) AS tie").orderBy(F.col("doc_id").asc_nulls_first(), "tie").collect()
    want = []
    for a, b in zip(ordered, ordered[1:] + ordered[:1]):
        half = len(a.text) // 2
        want.append((str(a.doc_id), hashlib.sha256((a.text[:len(a.text) - half] + b.text[:half]).encode()).hexdigest()))
    assert sorted((str(r["doc_id"]), r["edited_sha256"]) for r in rows(P.compare_with_next(docs))) == sorted(want)


def test_odd_rows(spark, odd):
    got = rows(P.compare_with_next(odd))
    check(odd, got, distinct=False)
    assert len({r["fingerprint"] for r in got if r["doc_id"] in (7, 8)}) == 1
    check(odd.where("doc_id <> 7"), rows(P.compare_with_next(odd.where("doc_id <> 7"))))
    one = frame(spark, ["only one text of some words"])
    check(one, rows(P.compare_with_next(one)))
    assert rows(P.compare_with_next(odd.limit(0))) == []
    assert {r["doc_id"]: r["fingerprint"] for r in rows(P.fingerprints(odd))}[0] == "0:"


def test_merged_groups(spark):
    docs = frame(spark, ["a b c d e f g h i j", "a b c d e f g", "q r s t u v w x"], sources=["x", "x", "y"])
    prints = P.fingerprints(docs).join(docs.select("doc_id", "source"), "doc_id")
    got = {(r["source"], r["hash"]) for r in rows(P.merged_sketches(prints, "source"))}
    want = {(s, int(h)) for r, s in zip(rows(docs), "xxy") for h in P.sketches([r["text"]])[0][1]
            if h < P.low_hashes(P.SCALE)}
    assert got == want


@needs_data
def test_whole_table(spark, documents):
    check(documents, rows(P.compare_with_next(documents)))


def test_containment_of_a_bare_sketch_is_unknown():
    some = [" ".join(f"b{i}w{j}" for j in range(5)) for i in range(40)]
    both = P.sketches(some + [""])
    bare = [i for i in range(40) if both[i][1][0] >= P.low_hashes(P.SCALE)]
    other = [i for i in range(40) if i not in bare]
    assert len(bare) > 10 and len(other) > 3
    whole = P.sketches([" ".join(some)])[0]
    assert all(P.containment(both[i], whole) is None for i in bare)              # they lie in it whole
    assert all(P.containment(both[i], whole) == 1.0 for i in other)
    assert all(P.containment(both[i], both[i]) == 1.0 and P.containment(both[i], both[-1]) == 0.0 for i in bare)
    assert all(P.containment(whole, both[i]) == 0.0 for i in bare)
    high, low = sorted(bare[:2], key=lambda i: -int(both[i][1][0]))
    assert P.containment(both[high], both[low]) is None and P.containment(both[low], both[high]) == 0.0
