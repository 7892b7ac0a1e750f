from __future__ import annotations

import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfrisk.llm import token_counts as T
from shelfrisk.llm.packing import load_encoding

from .conftest import frame, needs_data, rows

ENC = load_encoding()


def plain(parts, place, rule):
    """Token by token and interval by interval."""
    raw = [(p or "").encode() + b"\n" for p in parts]
    spans, at = [], 0
    for i, r in enumerate(raw):
        if i == place:
            for line in r.split(b"\n")[:-1]:
                spans.append((i, at, at + len(line) + 1))
                at += len(line) + 1
        else:
            spans.append((i, at, at + len(r)))
            at += len(r)
    counts, at, crossing = [0] * len(spans), 0, 0
    tokens = ENC.encode_ordinary(b"".join(raw).decode())
    for t in tokens:
        end = at + len(ENC.decode_single_token_bytes(t))
        over = [max(0, min(end, b) - max(at, a)) for _, a, b in spans]
        hit = [i for i, n in enumerate(over) if n]
        crossing += len(hit) > 1
        if rule == "split":
            for i in hit:
                counts[i] += over[i] / sum(over)
        else:
            counts[{"start": hit[0], "end": hit[-1], "largest": max(hit, key=lambda i: over[i])}[rule]] += 1
        at = end
    return (len(tokens), [sum(c for c, s in zip(counts, spans) if s[0] == i) for i in range(len(parts))],
            [c for c, s in zip(counts, spans) if s[0] == place], crossing)


def check(spark, docs, rule):
    got = rows(T.count_tokens(docs, rule=rule))
    data = rows(docs)
    key = lambda x: (str(x[0]), str(x[1:]))
    want = sorted(((r["doc_id"], *plain([r["lang"], r["source"], r["text"]], 2, rule)) for r in data), key=key)
    have = sorted(((r["doc_id"], r["n_tokens"], [r["lang_tokens"], r["source_tokens"], r["text_tokens"]],
                    r["section_tokens"], r["n_crossing"]) for r in got), key=key)
    for w, h in zip(want, have, strict=True):
        assert w[0] == h[0] and w[1] == h[1] and w[4] == h[4]
        assert h[2] == pytest.approx(w[2]) and h[3] == pytest.approx(w[3])


@pytest.mark.parametrize("rule", T.RULES)
def test_rules(spark, odd, rule):
    texts = ["a\n\n\nb\n \n c", "x  \n\n  y\n", "\n", "tab\t\n\t\nend", "é\n ñ 漢字\n\n"]
    check(spark, frame(spark, texts), rule)
    check(spark, odd.where("doc_id IS NULL OR doc_id <> 6"), rule)


def test_unknown_rule_and_empty(spark, odd):
    with pytest.raises(ValueError):
        T.count_tokens(odd, rule="any")
    assert rows(T.count_tokens(odd.limit(0))) == []


@settings(deadline=None, max_examples=60)
@given(st.text(max_size=40))
def test_spans_cover_the_text(text):
    spans = T.token_spans(ENC, text)
    assert [s[0] for s in spans] == ENC.encode_ordinary(text)
    covered = np.zeros(len(text), bool)
    for _, a, b in spans:
        assert a < b <= len(text)
        covered[a:b] = True
    assert covered.all()


@pytest.mark.skipif(not os.path.exists("/opt/tokenizers/byte_bpe_50k.json"), reason="no vocabulary")
def test_spans_agree_with_another_library():
    from tokenizers import Tokenizer

    other = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    for text in ["Hello, World  again\n\nfoo", "no accents here 123", "été señor"]:
        got = other.encode(text, add_special_tokens=False)
        mine = T.token_spans(ENC, text)
        assert got.ids == [i for i, *_ in mine]
        assert [len(text[a:b].strip()) > 0 or not text[a:b].strip() for _, a, b in mine]
        assert [o[1] for o in got.offsets] == [b for *_, b in mine]


@needs_data
def test_whole_table(spark, documents):
    check(spark, documents, "largest")
