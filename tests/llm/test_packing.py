from __future__ import annotations

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfrisk.llm import packing
from shelfrisk.llm.packing import (END_ID, ID_TYPE, best_fit_decreasing, encode_text, load_encoding, pack_documents,
                                   position_ids, write_packed)
from shelfrisk.llm.token_counts import count_tokens

from .conftest import frame, needs_data, rows

ENC = load_encoding()


def unpack(packed):
    """(doc_id, first offset, ids) of each segment."""
    out = []
    for r in packed:
        ids = np.frombuffer(r["input_ids"], ID_TYPE)
        cu = r["cu_seqlens"]
        assert len(ids) == r["n_tokens"] == cu[-1] and r["position_resets"] == cu[:-1]
        assert list(np.flatnonzero(position_ids(cu) == 0)) == r["position_resets"]
        out += [(d, s, ids[a:b].tolist()) for d, s, a, b in zip(r["doc_ids"], r["segment_starts"], cu, cu[1:])]
    return out


def restored(packed):
    """Texts by joining segments of a document in order."""
    enc, docs, whole = load_encoding(), [], {}
    for d, s, ids in sorted(unpack(packed), key=lambda x: (str(x[0]), x[1])):
        whole.setdefault(d, []).extend(ids)
    for d, ids in whole.items():
        cuts = [i for i, t in enumerate(ids) if t == END_ID]
        for a, b in zip([0, *[c + 1 for c in cuts]], cuts):
            docs.append((d, enc.decode(ids[a:b])))
    return docs


@given(st.lists(st.integers(1, 20), max_size=60))
def test_best_fit_against_plain_search(sizes):
    room, want = [], []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fit = [r for r in range(len(room)) if room[r] >= sizes[i]]
        best = min((room[r] for r in fit), default=None)
        if best is None:
            room.append(20 - sizes[i])
            want.append([i])
        else:   # any row with the least room: rows differ, their rooms do not
            r = next(r for r in fit if room[r] == best)
            room[r] -= sizes[i]
            want[r].append(i)
    got = best_fit_decreasing(sizes, 20)
    assert sorted(i for r in got for i in r) == list(range(len(sizes)))
    assert sorted(sum(sizes[i] for i in r) for r in got) == sorted(sum(sizes[i] for i in r) for r in want)


@settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(text=st.text(alphabet="ab7!' \n\t\xa0\x1cé\u2003s", max_size=60))
def test_long_runs_as_the_pattern_cuts_them(monkeypatch, text):
    monkeypatch.setattr(packing, "LONG_SPACE", 3)
    assert encode_text(ENC, text) == ENC.encode_ordinary(text)


def test_very_long_white_space(spark):
    texts = [" " * 1_500_000, "a" + "\n" * 1_500_000 + " b", "x" * 300_000]
    docs = frame(spark, texts)
    assert [t for _, t in restored(rows(pack_documents(docs)))] == texts
    for r, t in zip(sorted(rows(count_tokens(docs)), key=lambda r: r["doc_id"]), texts):
        assert r["n_sections"] == t.count("\n") + 1 == len(r["section_tokens"])


def test_odd_rows(spark, odd):
    got = rows(pack_documents(odd.where("doc_id IS NOT NULL AND doc_id <> 7"), capacity=64))
    want = {(r["doc_id"], r["text"] or "") for r in rows(odd) if r["doc_id"] not in (None, 7)}
    assert set(restored(got)) == want
    assert all(r["n_tokens"] <= 64 for r in got)
    assert len({(r["shard"], r["pack"]) for r in got}) == len(got)
    every = unpack(rows(pack_documents(odd)))
    assert sum(len(i) for *_, i in every) == sum(len(load_encoding().encode_ordinary(r["text"] or "")) + 1 for r in rows(odd))
    assert rows(pack_documents(odd.limit(0))) == []


@needs_data
def test_whole_table_round_trip(spark, documents, tmp_path):
    write_packed(documents, f"{tmp_path}/packed", shard_tokens=100_000)
    got = rows(spark.read.parquet(f"{tmp_path}/packed"))
    assert dict(restored(got)) == {r["doc_id"]: r["text"] for r in rows(documents)}
    assert sum(r["n_tokens"] for r in got) / (2048 * len(got)) > 0.95
