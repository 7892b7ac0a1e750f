from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfrisk.llm import spelling as S

from .conftest import SMALL, frame, rows

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    """One inserted, deleted or replaced code point, the plain way."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_words(docs, least=6, count=5):
    total = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(SMALL)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= least and n >= count}


def plain(docs):
    n = plain_words(docs)
    about = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, all_near in about.items():
        best = min(all_near, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w] or "", root(w), n[w], len(about[w]), n[form[w]] if form[w] else -1) for w in n)


def got(df):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], -1 if r["form_n"] is None else r["form_n"]) for r in rows(df))


def edited(word, rng, letters):
    i, kind = rng.randrange(len(word) + 1), rng.randrange(3)
    if kind == 0 or i == len(word):
        return word[:i] + rng.choice(letters) + word[i:]
    return word[:i] + (rng.choice(letters) if kind == 1 else "") + word[i + 1:]


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**9), st.sampled_from(["ab", "abcde", "abcdefghijklmnopqrstuvwxyzàÿ×"]), st.integers(4, 24))
def test_pivots_meet_every_near_word(seed, letters, length):
    """Each near pair shares a key asked by the shorter word."""
    rng = random.Random(seed)
    some = {"".join(rng.choice(letters) for _ in range(rng.randint(4, length))) for _ in range(12)}
    some |= {w for v in list(some) for w in (edited(v, rng, letters), edited(v, rng, letters)) if len(w) >= 4}
    some = sorted(some)
    count = np.zeros(1 << 16, np.int64)
    for w in some:
        for g in {(ord(a) << 8) + ord(b) for a, b in zip(w, w[1:])}:
            count[g] += 1
    listed, asked = {}, {}
    for which, points in S.by_length(some):
        for out, (row, key) in zip((listed, asked), S.entries(points, count)):
            for r, k in zip(row.tolist(), key.tolist()):
                out.setdefault(some[which[r]], set()).add(k)
    for a in some:
        assert len(asked[a]) <= 6 and len(listed[a]) <= 119
        for b in some:
            if near(a, b) and (len(a), a) < (len(b), b):
                assert asked[a] & listed[b], (a, b)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 10**12)), st.text("aZÀéÿ×Ā -9", max_size=120)), max_size=6))
def test_words_of_texts(docs):
    data = [(i, (t * 3)) for i, t in docs]
    column = S.pa.array([t for _, t in data], S.pa.large_string())
    found = S.counted_runs([i for i, _ in data], *S.text_buffer(column), 2)
    assert {x["values"]: x["counts"] for x in found.to_pylist()} == plain_words(data, 2, 1)


def test_checksums():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = np.array([0, 10, 10, 300, 400, 4999])
    ends = np.array([0, 11, 74, 365, 4999, 5000])
    state = np.array([zlib.crc32(f"{i}:".encode()) for i in range(6)], np.uint32)
    want = [zlib.crc32(f"{i}:".encode() + data[s:e].tobytes()) for i, (s, e) in enumerate(zip(starts, ends))]
    assert S.checksums(data, starts, ends, state).tolist() == want


def test_against_plain_code(spark):
    rng = random.Random(3)
    syllables = ["er", "on", "tion", "the", "é", "ña", "mente", "x"]
    base = ["".join(rng.choice(syllables) for _ in range(rng.randint(2, 5))) for _ in range(60)] + ["aaaaaaa", "abababab", "z" * 300]
    typos = [edited(w, rng, "abé") for w in base for _ in range(3)]
    typos += [edited(w, rng, "abé") for w in typos]
    docs = [(i, " ".join(rng.choices(base, k=80) * 4 + rng.choices(typos, k=60)).upper() if i % 5 == 0 else
             ", ".join(rng.choices(base, k=80) * 4 + rng.choices(typos, k=60))) for i in range(60)]
    docs += [docs[3]] * 30 + [(None, docs[5][1])] * 6             # a third of the rows are copies
    want = plain(docs)
    assert any(r[1] and r[2] != r[1] for r in want) and max(r[4] for r in want) > 5
    assert got(S.variants(frame(spark, [t for _, t in docs], [i for i, _ in docs]).repartition(5))) == want


def test_chain_of_forms(spark):
    """Forms of forms lead to one root, over more steps than one round takes."""
    chain = ["abcdefgh" + "x" * k for k in range(5)]
    text = " ".join(w for k, w in enumerate(chain) for _ in range(5 * 6**k))
    found = {r["word"]: r for r in rows(S.variants(frame(spark, [text] * 2)))}
    chosen = plain([(0, text), (1, text)])
    assert got(S.variants(frame(spark, [text] * 2))) == chosen
    assert found[chain[0]]["form"] == chain[1] and found[chain[0]]["root"] == chain[-1] and found[chain[-1]]["form"] is None


def test_odd_documents(spark, odd):
    data = [(r["doc_id"], r["text"]) for r in rows(odd)]
    assert got(S.variants(odd)) == plain(data)
    assert rows(S.variants(odd.limit(0))) == []
