from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from shelfrisk.llm import near_dup as N
from shelfrisk.llm.words import distinct_shingles, shingles, text_buffer, word_hashes

from .conftest import frame, needs_data, rows, words


def weighted(text):
    w = words(text)
    if not w:
        return Counter()
    k = min(5, len(w))
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def jp(x, y):
    """Probability Jaccard by its definition."""
    both = set(x) | set(y)
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in both) for i in set(x) & set(y))


def classes(texts, at_least=0.8):
    """Connected components of all pairs, by brute force over shared shingles."""
    sets = [weighted(t) for t in texts]
    where, pairs, up = defaultdict(list), Counter(), list(range(len(texts)))
    for i, s in enumerate(sets):
        for g in s:
            for j in where[g]:
                pairs[j, i] += 1
            where[g].append(i)

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for (i, j), n in pairs.items():
        plain = set(sets[i].values()) == set(sets[j].values()) == {1}     # then it is the Jaccard similarity
        like = n / (len(sets[i]) + len(sets[j]) - n) if plain else 0
        if not plain and n >= 0.4 * min(len(sets[i]), len(sets[j])):
            like = jp(sets[i], sets[j])
        if like >= at_least:
            a, b = sorted((find(i), find(j)))
            up[b] = a
    return [find(i) for i in range(len(texts))]


def as_arrays(text):
    w, first = word_hashes(*text_buffer(pa.array([text])))
    _, e, n = distinct_shingles(*shingles(w, first))
    return e, n.astype(float)


def test_exact_similarity_and_its_estimate():
    rng = random.Random(1)
    base = [rng.choice("abcdefgh") for _ in range(300)]
    for change in (0, 2, 20, 100):
        other = base[:]
        for i in rng.sample(range(300), change):
            other[i] = "z"
        a, b = " ".join(base), " ".join(other + other[:change])
        want = jp(weighted(a), weighted(b))
        assert abs(N.probability_jaccard(as_arrays(a), as_arrays(b)) - want) < 1e-9
        w, first = word_hashes(*text_buffer(pa.array([a, b])))
        reg = N.prob_minhash(*distinct_shingles(*shingles(w, first)), 2, 4096)
        assert abs((reg[0] == reg[1]).mean() - want) < 0.04


def test_registers_do_not_depend_on_the_batch():
    texts = ["a b c d e f g", "", "x", "a a a a a a a b", "q " * 500]
    w, first = word_hashes(*text_buffer(pa.array(texts)))
    every = N.prob_minhash(*distinct_shingles(*shingles(w, first)), len(texts), 64)
    for i, t in enumerate(texts):
        w, first = word_hashes(*text_buffer(pa.array([t])))
        assert (N.prob_minhash(*distinct_shingles(*shingles(w, first)), 1, 64)[0] == every[i]).all()


def edited(rng, base, n):
    out = base[:]
    for i in rng.sample(range(len(base)), n):
        out[i] = f"new{rng.random()}"
    return " ".join(out)


def test_classes_against_brute_force(spark):
    rng = random.Random(5)
    texts = []
    for g in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([8, 60, 200]))]
        texts += [" ".join(base)] * rng.choice([1, 3]) + [edited(rng, base, n) for n in (0, 1, 1, 2, 5) if n < len(base)]
    passage = " ".join(f"common{i}" for i in range(40))
    texts += [passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(30)) for _ in range(40)]
    texts += ["short", "short", "short one", "a b c d", "A B, C d!"]
    rng.shuffle(texts)
    got = sorted(rows(N.near_duplicates(frame(spark, texts))), key=lambda r: r["doc_id"])
    assert [r["class_id"] for r in got] == classes(texts)
    assert sum(r["is_head"] for r in got) == len(set(classes(texts)))


def test_impure_buckets(spark, monkeypatch):
    """One register a band: buckets hold many dissimilar nodes, and all must be compared."""
    rng = random.Random(9)
    shared = [f"c{i}" for i in range(60)]
    texts = [" ".join(shared + [f"x{g}y{i}" for i in range(40)]) + f" z{c}" * c for g in range(30) for c in range(2)]
    rng.shuffle(texts)
    for nodes in (7, 512):
        monkeypatch.setattr(N, "BLOCK_NODES", nodes)
        got = sorted(rows(N.near_duplicates(frame(spark, texts), bands=12, rows=1)), key=lambda r: r["doc_id"])
        assert [r["class_id"] for r in got] == classes(texts)


def test_group_of_edited_copies(spark, monkeypatch):
    """Copies whose likeness to their origin lies on both sides of the threshold."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(300)}" for _ in range(150)]
    texts = [" ".join(base)] + [edited(rng, base, rng.choice([1, 2, 3, 4, 6, 9])) for _ in range(150)]
    texts += [edited(rng, texts[i].split(), 1) for i in range(100, 140)]
    monkeypatch.setattr(N, "BLOCK_NODES", 40)
    got = sorted(rows(N.near_duplicates(frame(spark, texts))), key=lambda r: r["doc_id"])
    want = classes(texts)
    assert len(set(want)) > 30 and [r["class_id"] for r in got] == want


def test_similarities_in_blocks(monkeypatch):
    rng = random.Random(12)
    monkeypatch.setattr(N, "SLICE", 16)
    texts = [" ".join(rng.choices("abcdefghij", k=rng.choice([6, 40]))) for _ in range(12)]
    texts += [edited(rng, t.split(), 1) for t in texts] + ["q w e r t y u i o p l k j h g f d s a z x"] * 2
    sets = [as_arrays(t) for t in texts]
    at = np.arange(len(texts))
    for threshold in (0.3, 0.8):
        got = {(a, b): s for a, b, s in N.similarities([e for e, _ in sets], [w for _, w in sets], at, at,
                                                       at[:, None] < at[None, :], threshold) if s >= threshold}
        want = {(a, b): jp(weighted(texts[a]), weighted(texts[b])) for a in at for b in at if a < b}
        want = {k: v for k, v in want.items() if v >= threshold}
        assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_long_chain(spark):
    """A chain of links is one class although its ends differ."""
    base = [f"w{i}" for i in range(400)]
    texts = [" ".join(base[12 * i:] + [f"n{j}" for j in range(12 * i)]) for i in range(16)]
    want = classes(texts)
    assert want == [0] * 16 and jp(weighted(texts[0]), weighted(texts[-1])) < 0.5
    assert [r["class_id"] for r in sorted(rows(N.near_duplicates(frame(spark, texts))), key=lambda r: r["doc_id"])] == want


def test_odd_rows(spark, odd):
    got = rows(N.near_duplicates(odd))
    assert len(got) == odd.count()
    same = [r for r in got if r["doc_id"] in (7, 8)]
    assert {r["class_id"] for r in same} == {7} and all(r["n_copies"] == 3 for r in same)
    for r in got:
        if r["doc_id"] not in (7, 8):
            assert r["class_id"] == r["doc_id"] and r["is_head"]
    kept = rows(N.keep_one(odd, N.near_duplicates(odd)))
    assert len(kept) == odd.count() - 2 and sum("same" in (r["text"] or "") for r in kept) == 1
    assert set(kept[0]) == set(odd.columns)
    assert rows(N.near_duplicates(odd.limit(0))) == []
    # an id that two different texts share
    twice = frame(spark, ["a b c d e f", "g h i j k l", "a b c d e f"], [1, 1, 2])
    assert sorted((r["doc_id"], r["class_id"]) for r in rows(N.near_duplicates(twice))) == [(1, 1), (1, 1), (2, 1)]
    assert len(rows(N.keep_one(twice, N.near_duplicates(twice)))) == 2


def test_a_hot_null_id(spark):
    """Many texts under a null id: each is read once, not paired with all others."""
    rng = random.Random(5)
    base = [[f"w{rng.randrange(500)}" for _ in range(30)] for _ in range(120)]
    texts = [" ".join(b) for b in base] + [" ".join(b + ["more"]) for b in base]
    ids = [None if i % 2 else i for i in range(len(texts))]
    docs = frame(spark, texts, ids)
    got = rows(N.near_duplicates(docs))
    least = {c: min((ids[j] for j, d in enumerate(classes(texts)) if d == c and ids[j] is not None), default=None) for c in classes(texts)}
    assert sorted(str(r["class_id"]) for r in got) == sorted(str(least[c]) for c in classes(texts))
    nodes = N.signatures(docs).where("node IS NOT NULL")
    plan = N.shingle_sets(docs, nodes)._jdf.queryExecution().optimizedPlan().toString()
    assert "text_key" in next(line for line in plan.split("\n") if "Join Inner" in line)


@needs_data
def test_whole_table(spark, documents):
    data = sorted(rows(documents), key=lambda r: r["doc_id"])
    want = classes([r["text"] for r in data])
    got = {r["doc_id"]: r["class_id"] for r in rows(N.near_duplicates(documents))}
    assert [got[r["doc_id"]] for r in data] == [data[c]["doc_id"] for c in want]
    assert len(np.unique(list(got.values()))) < len(got)
