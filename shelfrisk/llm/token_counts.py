"""Token counts (operator 8): offset-mapped attribution.

The fields of a document are joined, each followed by a line feed, and encoded
once.  The tokens' spans are joined to the intervals of fields and sections
(the lines of the text field); a token that crosses a boundary goes by ``rule``:
``start`` (where its first byte lies), ``end``, ``largest`` (most bytes, ties to
the earlier interval) or ``split`` (by bytes, so counts are fractions).

Defined cases: null fields are empty; the feed after a field belongs to it, and
the feed that ends a line to that line; a text always has one section at least;
null and repeated ids are rows of their own; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import VOCABULARY, encode_text, share_encoding

FIELDS = ("lang", "source", "text")
RULES = ("start", "end", "largest", "split")


def token_lengths(encoding) -> np.ndarray:
    """Bytes of each token."""
    out = np.zeros(encoding.n_vocab, np.int64)
    for token, rank in encoding._mergeable_ranks.items():
        out[rank] = len(token)
    return out


def attribute(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, int]:
    """Tokens of each interval [bounds[i], bounds[i+1]), and how many cross."""
    n = bounds.size - 1
    a = np.searchsorted(bounds, starts, "right") - 1
    b = np.searchsorted(bounds, ends, "left") - 1
    crossing = np.flatnonzero(a < b)
    if rule in ("start", "end"):
        return np.bincount(a if rule == "start" else b, minlength=n), crossing.size
    own = a < b
    counts = np.bincount(a[~own], minlength=n).astype(float if rule == "split" else np.int64)
    for t in crossing.tolist():
        over = np.diff(np.concatenate(([starts[t]], bounds[a[t] + 1:b[t] + 1], [ends[t]])))
        if rule == "split":
            counts[a[t]:b[t] + 1] += over / over.sum()
        else:
            counts[a[t] + int(np.argmax(over))] += 1
    return counts, crossing.size


def count_tokens(docs: DataFrame, fields: tuple[str, ...] = FIELDS, text_field: str = "text", rule: str = "largest",
                 vocabulary: str = VOCABULARY) -> DataFrame:
    """Per document: its tokens, those of each field and of each section of the
    text field, and the tokens that cross a boundary."""
    if rule not in RULES or text_field not in fields:
        raise ValueError(f"rule is one of {RULES}, and text_field one of fields")
    shared = share_encoding(docs.sparkSession, vocabulary)
    kind, arrow = ("double", pa.float64()) if rule == "split" else ("long", pa.int64())
    names = ["doc_id", "n_tokens", *(f"{f}_tokens" for f in fields), "n_sections", "section_tokens", "n_crossing"]
    schema = (f"doc_id long, n_tokens long, {', '.join(f'`{f}_tokens` {kind}' for f in fields)}, n_sections long, "
              f"section_tokens array<{kind}>, n_crossing long")
    place = fields.index(text_field)

    def one(encoding, length, parts):
        raw = [(p or "").encode() + b"\n" for p in parts]
        whole = b"".join(raw)
        ends = np.cumsum(length[encode_text(encoding, whole.decode())])
        starts = np.concatenate(([0], ends[:-1]))
        edge = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
        lines = np.flatnonzero(np.frombuffer(raw[place], np.uint8) == 10) + 1 + edge[place]
        bounds = np.concatenate((edge[:place + 1], lines, edge[place + 2:]))
        counts, crossing = attribute(starts, ends, bounds, rule)
        section = counts[place:place + lines.size]
        per_field = [*counts[:place], section.sum(), *counts[place + lines.size:]]
        return (ends.size, *per_field, lines.size, section, crossing)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, length = shared.value, token_lengths(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = [one(encoding, length, [c.as_py() for c in row]) for row in zip(*part.columns[1:])]
                cols = list(zip(*rows))
                kinds = [pa.int64(), *[arrow] * len(fields), pa.int64(), pa.list_(arrow), pa.int64()]
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, cols, kinds)], names=names)

    return (docs.select(F.col("doc_id").cast("long"), *(F.col(f).cast("string") for f in fields))
            .mapInArrow(run, schema))


def token_spans(encoding, text: str) -> list[tuple[int, int, int]]:
    """(id, first character, end) of each token; a token that holds part of a
    character covers it."""
    ids = encode_text(encoding, text)
    ends = np.cumsum(token_lengths(encoding)[ids]) if ids else np.empty(0, np.int64)
    data = np.frombuffer(text.encode(), np.uint8)
    upto = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    starts = np.concatenate(([0], ends[:-1])) if ids else ends
    inside = np.concatenate(((data & 0xC0) == 0x80, [False]))
    return [(i, int(upto[s]) - int(inside[s]), int(upto[e])) for i, s, e in zip(ids, starts, ends)]
