from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfrisk.llm import simhash as H

from .conftest import SMALL, frame, needs_data, rows

WORD = re.compile("[^\x20\x09-\x0D]+")


def plain_bits(text):
    w = WORD.findall((text or "").translate(SMALL))
    runs = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(bits, radius=4):
    """Least index of the component of each fingerprint, all pairs compared."""
    value = np.array(bits, np.uint64)
    parent = list(range(len(bits)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(bits)):
        for j in np.flatnonzero(np.bitwise_count(value[:i] ^ value[i]) <= radius).tolist():
            a, b = sorted((top(i), top(j)))
            parent[b] = a
    return [top(i) for i in range(len(bits))]


def clustered(rng, n, flips=6):
    """Fingerprints around a few centres, and some alone."""
    centres = [rng.getrandbits(64) for _ in range(4)] + [0, 2**64 - 1]
    out = set()
    while len(out) < n:
        x = rng.choice(centres) if rng.random() < 0.8 else rng.getrandbits(64)
        for _ in range(rng.randrange(flips + 1)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aBÉ \t\n\x0b .", max_size=60)), max_size=8))
def test_fingerprints(texts):
    column = H.pa.array(texts, H.pa.large_string())
    hashes, row = H.shingle_hashes(*H.text_buffer(column))
    assert H.majority(hashes, row, len(texts)).tolist() == [plain_bits(t) for t in texts]


def test_long_text_in_slices():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdefg") * rng.randint(1, 9) for _ in range(n)) for n in (3, 40_000, 0, 5, 33_000)]
    hashes, row = H.shingle_hashes(*H.text_buffer(H.pa.array(texts)))
    assert H.majority(hashes, row, 5).tolist() == [plain_bits(t) for t in texts]


def test_hash_is_the_engines(spark):
    got = spark.createDataFrame([("the quick brown föx",), ("",)], "t string").select(F.xxhash64("t")).collect()
    assert [r[0] & (2**64 - 1) for r in got] == [xxhash.xxh64_intdigest(t.encode(), 42) for t in ("the quick brown föx", "")]


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**9), st.integers(1, 60), st.integers(1, 5))
def test_trees_find_what_is_near(seed, n, groups):
    rng = random.Random(seed)
    value = np.array(clustered(rng, n), np.uint64)
    group = np.array([rng.randrange(groups) * 3 for _ in range(n)])
    asked = np.concatenate((value, np.array(clustered(rng, 20), np.uint64)))
    where = np.concatenate((group, np.array([rng.choice(group.tolist()) for _ in range(20)])))
    forest = H.Forest(value, group)
    found = {(int(i), int(j)) for a, b in forest.within(asked, where, 4) for i, j in zip(a, b)}
    assert found == {(i, j) for i in range(asked.size) for j in range(n)
                     if where[i] == group[j] and int(asked[i] ^ value[j]).bit_count() <= 4}
    assert forest.child.size + forest.roots.size == n


def check_links(spark, bits, size):
    nodes = spark.createDataFrame([(x - 2**64 if x >= 2**63 else x,) for x in bits], "bits long")
    links = [(r["a"] % 2**64, r["b"] % 2**64) for r in rows(H.near_bits(nodes, size=size))]
    at = {x: i for i, x in enumerate(bits)}
    label = H.least_labels(len(bits), np.array([at[a] for a, _ in links], int), np.array([at[b] for _, b in links], int))
    assert label.tolist() == plain_components(bits)
    return links


def test_links_connect_as_all_pairs_do(spark):
    bits = clustered(random.Random(4), 900)
    assert check_links(spark, bits, H.SHARD)


@pytest.mark.parametrize("size", [3, 40])
def test_hot_shards_are_split(spark, size):
    """A third of the fingerprints share blocks: trees across tasks, same links."""
    rng = random.Random(size)
    hot = rng.getrandbits(64) & ~(2**42 - 1)
    bits = sorted({hot | rng.getrandbits(42) & rng.getrandbits(42) & rng.getrandbits(42) for _ in range(150)} | set(clustered(rng, 200)))
    check_links(spark, bits, size)


def test_blocks_prove_links():
    rng = random.Random(8)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for _ in range(4):
            b ^= 1 << rng.randrange(64)
        same, at = 0, 0
        for w in H.WIDTHS:
            same += (a >> at & (1 << w) - 1) == (b >> at & (1 << w) - 1)
            at += w
        assert at == 64 and same >= 2


def check(docs, found):
    data = [(r["doc_id"], r["text"]) for r in rows(docs)]
    bits = [plain_bits(t) for _, t in data]
    names = sorted(set(bits))
    label = dict(zip(names, plain_components(names)))
    least = {}
    for (i, _), b in zip(data, bits):
        if i is not None:
            least[label[b]] = min(least.get(label[b], i), i)
    want = sorted((repr(i), f"{b:016x}", repr(least.get(label[b]))) for (i, _), b in zip(data, bits))
    assert sorted((repr(r["doc_id"]), r["fingerprint"], repr(r["component_id"])) for r in found) == want


def test_odd_documents(spark, odd):
    check(odd, rows(H.components(odd)))
    assert rows(H.components(odd.limit(0))) == []


def test_null_ids_and_copies(spark):
    texts = ["a b c d e f g"] * 40 + ["x y z"] * 3 + [f"some other text number {i} of its own" for i in range(60)]
    ids = [None] * 30 + list(range(10)) + [None] * 3 + list(range(100, 160))
    docs = frame(spark, texts, ids).repartition(6)
    check(docs, rows(H.components(docs)))


@needs_data
def test_query_on_data(spark, documents):
    docs = documents.select("doc_id", "text")
    check(docs, rows(H.components(documents)))


def test_widths(spark):
    with pytest.raises(ValueError):
        H.components(frame(spark, ["a"]), widths=(16, 16, 16, 16))
