"""Token-id output (operator 2): best-fit-decreasing packing.

Documents are tokenised with a public vocabulary, followed by an end id, and
packed into rows of ``capacity`` ids.  A document longer than a row is split
losslessly into full rows and a rest.  Within a shard (consecutive documents of
one input partition, up to ``shard_tokens`` ids) pieces are placed in
decreasing size into the row with the least sufficient room, found with a
segment tree over capacities.  No shuffle: a shard needs its own rows only.

Defined cases: a null or empty text is the end id alone; null and repeated ids
are kept; equal sizes keep document order, so a rerun gives equal rows; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import packed

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits text before the merges of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Fixed value: the characters that the pattern's \\s stands for.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_SPACE = 100_000         # white space from which a run is not given to the pattern (its stack is bounded)
END_ID = 50256               # free in the vocabulary
CAPACITY = 2048
SHARD_TOKENS = 2_000_000

PACKED = ("shard long, pack int, n_tokens int, input_ids binary, cu_seqlens array<int>, "
          "position_resets array<int>, segment_starts array<int>, doc_ids array<long>")
ID_TYPE = np.dtype("<u2")    # little-endian, two bytes: every id is below 65,536


def load_encoding(path: str = VOCABULARY) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode_text(encoding: tiktoken.Encoding, text: str) -> list[int]:
    """Ids of a text of any length.  A very long run of white space is one piece
    of the pattern, but for its last character where something follows."""
    if len(text) < LONG_SPACE:
        return encoding.encode_ordinary(text)
    out, at = [], 0
    for run in re.finditer(f"[{SPACE}]{{{LONG_SPACE},}}", text):
        end = run.end() - (run.end() < len(text))
        out += encoding.encode_ordinary(text[at:run.start()])
        out += encoding._encode_single_piece(text[run.start():end])
        at = end
    return out + encoding.encode_ordinary(text[at:])


def share_encoding(spark: SparkSession, path: str = VOCABULARY):
    """The vocabulary as a broadcast: of fixed size, built once per worker."""
    return spark.sparkContext.broadcast(load_encoding(path))


class CapacityTree:
    """Which rooms (1 to capacity) some open row has: a binary segment tree of
    counts; ``at_least(n)`` is the least such room not under n, in O(log)."""

    def __init__(self, capacity: int):
        self.base = 1 << max(1, capacity.bit_length())
        self.count = [0] * (2 * self.base)

    def add(self, room: int, n: int = 1) -> None:
        i = self.base + room
        while i:
            self.count[i] += n
            i >>= 1

    def at_least(self, room: int) -> int | None:
        i, count = self.base + room, self.count
        if count[i]:
            return room
        while i > 1:
            if not i & 1 and count[i + 1]:   # a right sibling holds larger rooms
                i += 1
                while i < self.base:
                    i = 2 * i if count[2 * i] else 2 * i + 1
                return i - self.base
            i >>= 1
        return None


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Item numbers of each row.  Of equally good rows the latest is taken."""
    rows: list[list[int]] = []
    tree, open_rows = CapacityTree(capacity), [[] for _ in range(capacity + 1)]
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        n = sizes[item]
        room = tree.at_least(n)
        if room is None:
            row, room = len(rows), capacity
            rows.append([])
        else:
            row = open_rows[room].pop()
            tree.add(room, -1)
        rows[row].append(item)
        if room > n:
            open_rows[room - n].append(row)
            tree.add(room - n)
    return rows


def split_long(lengths: list[int], capacity: int) -> list[tuple[int, int, int]]:
    """(document, start, size) pieces: full rows, then the rest."""
    return [(d, s, min(capacity, n - s)) for d, n in enumerate(lengths) for s in range(0, n, capacity)]


def pack_shard(shard: int, ids: list, tokens: list[np.ndarray], capacity: int) -> Iterator[pa.RecordBatch]:
    pieces = split_long([len(t) for t in tokens], capacity)
    rows = best_fit_decreasing([n for *_, n in pieces], capacity)
    for at in range(0, len(rows), 512):
        some = rows[at:at + 512]
        flat = [pieces[i] for row in some for i in row]
        sizes = np.array([n for *_, n in flat])
        per_row = np.array([len(r) for r in some])
        lists = np.concatenate(([0], np.cumsum(per_row)))
        ends = np.cumsum(sizes)[lists[1:] - 1]
        seq, resets = [], []
        for a, b in zip(lists[:-1], lists[1:]):
            cu = np.concatenate(([0], np.cumsum(sizes[a:b]))).astype(np.int32)
            seq.append(cu)
            resets.append(cu[:-1])
        data = np.concatenate([tokens[d][s:s + n] for d, s, n in flat])
        offsets = pa.array(lists, pa.int32())
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(some), shard), pa.int64()),
            pa.array(np.arange(at, at + len(some)), pa.int32()),
            pa.array(np.diff(np.concatenate(([0], ends))), pa.int32()),
            packed(data, ends),
            pa.array(seq, pa.list_(pa.int32())),
            pa.array(resets, pa.list_(pa.int32())),
            pa.ListArray.from_arrays(offsets, pa.array([s for _, s, _ in flat], pa.int32())),
            pa.ListArray.from_arrays(offsets, pa.array([ids[d] for d, *_ in flat], pa.int64())),
        ], names=[c.split()[0] for c in PACKED.split(", ")])


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, shard_tokens: int = SHARD_TOKENS,
                   vocabulary: str = VOCABULARY) -> DataFrame:
    """Rows of the packed id matrix: ids (two bytes each), cumulative segment
    lengths, the columns where positions restart at 0, and for each segment its
    document and the offset of its first id in that document."""
    shared = share_encoding(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoding = shared.value
        shard = TaskContext.get().partitionId() << 32
        ids, tokens, held = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                got = np.array([*encode_text(encoding, text.as_py() or ""), END_ID], ID_TYPE)
                if held and held + got.size > shard_tokens:
                    yield from pack_shard(shard, ids, tokens, capacity)
                    shard, ids, tokens, held = shard + 1, [], [], 0
                ids.append(doc)
                tokens.append(got)
                held += got.size
        if held:
            yield from pack_shard(shard, ids, tokens, capacity)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PACKED)


def write_packed(docs: DataFrame, path: str, **kw) -> None:
    """The packed rows as Parquet files."""
    pack_documents(docs, **kw).write.parquet(path)


def position_ids(cu_seqlens) -> np.ndarray:
    """0, 1, ... within each segment."""
    cu = np.asarray(cu_seqlens)
    return np.arange(cu[-1]) - np.repeat(cu[:-1], np.diff(cu))
