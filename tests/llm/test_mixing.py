from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfrisk.llm import mixing as M

from .conftest import frame, needs_data, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes):
    """Share by weight, cap, share the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    target, free, rest = {}, set(names), float(sum(sizes.values()))
    while free:
        level = rest / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > 3 * sizes[s] + 1e-9}
        if not full:
            target |= {s: level * weight[s] for s in free}
            break
        for s in full:
            target[s] = 3.0 * sizes[s]
            rest -= target[s]
        free -= full
    return target


def check(docs, got, near):
    data, by = rows(docs), defaultdict(int)
    sizes = [len(WORD.findall(r["text"] or "")) for r in data]
    for r, n in zip(data, sizes):
        by[r["source"]] += n
    target = plain_targets(by)
    ids = {r["doc_id"]: r["source"] for r in data}
    assert Counter((r["doc_id"], n) for r, n in zip(data, sizes)) == Counter((r["doc_id"], r["size"]) for r in got)
    taken, unknown = defaultdict(int), {r["source"] for r in data if r["doc_id"] is None}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        if r["doc_id"] is not None:
            assert r["source_size"] == by[ids[r["doc_id"]]] and r["target"] == pytest.approx(target[ids[r["doc_id"]]])
            if ids[r["doc_id"]] not in unknown:
                taken[ids[r["doc_id"]]] += r["taken"]
    for s, n in taken.items():
        assert abs(n - target[s]) <= near, (s, n, target[s])


@pytest.mark.parametrize("good,bad,n", [(5, 7, 6), (40, 3, 30), (3, 400, 200), (1, 1, 1), (60, 50, 100), (2, 900, 880)])
def test_draws_follow_the_distribution(good, bad, n):
    """Against the exact probabilities of small counts (chi-square)."""
    rng = np.random.default_rng(good)
    got = Counter(M.hypergeometric(rng, good, bad, n) for _ in range(20_000))
    chance = {k: math.comb(good, k) * math.comb(bad, n - k) / math.comb(good + bad, n) for k in range(max(0, n - bad), min(n, good) + 1)}
    assert set(got) <= set(chance)
    cells = [(got[k], 20_000 * p) for k, p in chance.items() if 20_000 * p >= 5]
    assert sum((o - e) ** 2 / e for o, e in cells) < len(cells) + 5 * (2 * len(cells)) ** 0.5 + 5


@pytest.mark.parametrize("good", [10**4, 999_999, 10**6, 10**9 - 1, 10**9, 10**12, 2**61])
@pytest.mark.parametrize("share", [0.5, 0.003])
def test_draws_at_every_count(good, share):
    """One method at every size: mean, spread, skewness and tails as they should be."""
    bad, n = int(good * 1.7), int(good * 2.7 * share)
    rng, total = np.random.default_rng(3), good + bad
    p = good / total
    spread = math.sqrt(n * p * (1 - p) * ((total - n) / (total - 1)))
    z = np.array([(M.hypergeometric(rng, good, bad, n) * total - n * good) / total / spread for _ in range(6000)])
    assert abs(z.mean()) < 0.06 and abs(z.std() - 1) < 0.05
    skew = (1 - 2 * p) * (1 - 2 * n / total) / spread
    assert abs((z**3).mean() - skew) < 0.2 and abs((z**4).mean() - 3) < 0.5
    for edge in (-1, 0, 0.5, 2):
        assert abs((z <= edge).mean() - (1 + math.erf(edge / 2**0.5)) / 2) < 0.03 + 0.5 / spread


def test_draws_at_the_ends():
    rng = np.random.default_rng(1)
    for good, bad, n, want in ((0, 5, 3, 0), (5, 0, 3, 3), (10**12, 10**12, 0, 0), (10**12, 7, 10**12 + 7, 10**12)):
        assert M.hypergeometric(rng, good, bad, n) == want
    counts = np.array([10**12, 0, 3, 10**9, 10**15])
    out = M.split(rng, counts, 10**14)
    assert out.sum() == 10**14 and (out <= counts).all() and out[1] == 0


def test_targets():
    for sizes in ({"a": 10, "b": 0, "c": 1000, None: 3}, {"a": 0}, {"a": 5}, {f"s{i}": i * i for i in range(40)},
                  {"é": 7, "z": 1, "a": 90, "": 4}):
        assert M.targets(list(sizes.items())) == pytest.approx(plain_targets(sizes))


def test_permutations():
    for n in (1, 2, 3, 7, 64, 1000):
        at = M.permuted(np.arange(n), n, 5)
        assert sorted(at.tolist()) == list(range(n))
    assert (M.permuted(np.arange(1000), 1000, 5) != M.permuted(np.arange(1000), 1000, 6)).any()


def test_shards_add_up():
    draws = np.array([100, 0, 5000, 37])
    n = -(-int(draws.sum()) // 64)
    each = [M.shard_counts(draws, s, n, 64) for s in range(n)]
    assert (sum(c for c, _ in each) == draws).all()
    run = np.zeros(4, int)
    for s, (c, before) in enumerate(each):
        assert (before == run).all() and c.sum() == (64 if s < n - 1 else draws.sum() - 64 * (n - 1))
        run += c
    spread = np.array([c[0] for c, _ in each[:-1]])
    assert spread.std() > 0 and abs(spread.mean() - 64 * 100 / draws.sum()) < 0.3


def test_odd_rows(spark, odd):
    got = rows(M.mix_sources(odd, block=2))
    check(odd, got, 4)
    assert sorted(map(str, got)) == sorted(map(str, rows(M.mix_sources(odd, block=2))))
    assert rows(M.mix_sources(odd.limit(0))) == []
    none = rows(M.mix_sources(frame(spark, [None, "", " "])))
    assert [(r["size"], r["target"], r["taken"]) for r in none] == [(0, 0.0, 0)] * 3


def test_pieces_of_a_document():
    assert M.runs_taken([(0, 4, 1), (4, 4, 2), (12, 2, 1)]) == [(0, 8), (12, 2), (4, 4)]
    assert M.runs_taken([(4, 4, 3), (0, 4, 3)]) == [(0, 8)] * 3


def test_mixed_documents_are_what_the_mix_takes(spark, odd):
    for docs in (odd, frame(spark, [f"a{i} b\nc{i} d  e{i}" for i in range(50)], sources=["hot"] * 40 + ["x"] * 10)):
        words = Counter()
        for r in rows(M.mix_sources(docs, block=2)):
            words[r["doc_id"]] += r["taken"]
        out = M.mixed_documents(docs, block=2)
        assert out.columns == docs.columns
        texts, found = defaultdict(list), Counter()
        for r in rows(docs):
            texts[r["doc_id"]].append(r["text"] or "")
        for r in rows(out):
            assert any(r["text"] in t for t in texts[r["doc_id"]]) and r["n_chars"] == len(r["text"])
            found[r["doc_id"]] += len(WORD.findall(r["text"]))
        assert +found == +words


@needs_data
def test_whole_table(spark, documents):
    check(documents, rows(M.mix_sources(documents)), 160)
