from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfrisk.llm import words as W

MASK = (1 << 64) - 1


def plain(word):
    """The hash of one word, byte by byte."""
    total = sum(int(W.BYTE_CODE[b]) * pow(W.BASE, i, 1 << 64) for i, b in enumerate(word)) & MASK
    return int(W.mix(np.array([total], np.uint64))[0])


@settings(deadline=None)
@given(st.lists(st.text(alphabet="abé .,Z", max_size=40), min_size=1, max_size=5), st.sampled_from([1, 3, 8, 1 << 16]))
def test_segments_do_not_change_hashes(texts, segment):
    data, offsets = W.join_texts(texts)
    low = W.LOWER_BYTE[data]
    starts, ends = W.runs(W.WORD_BYTE[low], offsets)
    held, W.SEGMENT = W.SEGMENT, segment
    W.power_table.cache_clear()
    try:
        got = W.hash_spans(low, starts, ends).tolist()
    finally:
        W.SEGMENT = held
        W.power_table.cache_clear()
    assert got == [plain(low[a:b].tobytes()) for a, b in zip(starts, ends)]


def test_a_word_longer_than_a_segment():
    data = np.concatenate((np.full(5, 97, np.uint8), [32], np.full(3 * W.SEGMENT, 98, np.uint8), [32, 99])).astype(np.uint8)
    h = W.hash_spans(data, np.array([0, 6, data.size - 1]), np.array([5, data.size - 2, data.size]))
    assert h[0] == plain(b"aaaaa") and h[2] == plain(b"c")
    assert h[1] == W.hash_spans(np.full(3 * W.SEGMENT, 98, np.uint8), np.array([0]), np.array([3 * W.SEGMENT]))[0]
