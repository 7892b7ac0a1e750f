"""Benchmark decontamination (operator 4): a positional inverted index of the
training words, searched with the windows of the benchmark items.

``build_index`` stores, per shard of consecutive documents, the postings of
every word: its positions, in order.  The benchmark is stored too, as blocks of
hashed words.  ``search`` meets every shard with every block (a stated query set
against all rows, in blocks: neither is broadcast or held by the driver), takes
each window, orders its words by list length, starts from the rarest and
intersects the others with it, adjusted by offset.

A phrase match has all words at their places.  A proximity match is a place for
the window such that all its words but ``MISSING`` of 13 (in proportion for
shorter windows, rounded down) stand within ``SLOP`` words of where they belong.
One of the ``MISSING + 1`` rarest is always among those, so their lists give all
candidates; all other words are then compared.  Which lists are rarest in a
shard only orders the work: the matches are the same for any shards and blocks.

Words are compared by 64-bit hashes.  A window is ``window`` consecutive words
of an item; an item of fewer, but not none, is one window.  Defined cases: null
and empty texts have no words; a null item id is listed as ''; equal item ids
count once; repeated documents are independent rows; other columns are ignored,
whatever their names; an empty benchmark gives zeros and an empty table no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import stored, unused
from .words import packed, row_chunks, text_buffer, word_hashes

U = np.uint64
WINDOW = 13
SLOP = 3                      # words by which a word of a proximity match may be displaced
MISSING = 2                   # words of a whole window that a proximity match may lack
SHARD_BYTES = 2 << 20         # text of a shard (a longer document is a shard of its own)
GAP = 64                      # empty positions between documents: no match crosses them
BLOCK_BYTES = 1 << 20         # benchmark text of a block (a longer item is a block of its own)
CANDIDATES = 1 << 18          # candidate places intersected at once (all are, in turn)

INDEX = ("doc_ids array<long>, text_keys array<long>, word_counts array<long>, terms binary, lengths binary, postings binary")
BLOCKS = "items array<string>, item_words binary, words binary"
HITS = ("shard long, at int, spans array<struct<first:int,after:int>>, items array<string>, near_items array<string>")


def build_index(docs: DataFrame) -> DataFrame:
    """One row per shard: ids and word counts of its documents, the hashes of
    its words in order, the length of each list, and the lists themselves.  It is
    to be stored before it is searched, as ``shard`` numbers its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_chunks(batch, "text", SHARD_BYTES):
                words, first = word_hashes(*text_buffer(part.column("text")))
                n = np.diff(first)
                place = np.arange(words.size) + np.repeat(np.arange(n.size) * GAP, n)
                order = np.argsort(words, kind="stable")
                ranked = words[order]
                begin = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))) if words.size else order
                lengths = np.diff(np.append(begin, words.size))
                yield pa.RecordBatch.from_arrays([
                    *(pa.array([v], pa.list_(pa.int64())) for v in (part.column("doc_id").to_pylist(),
                                                                    part.column("key").to_pylist(), n)),
                    *(packed(v, [v.size]) for v in (ranked[begin], lengths.astype(np.int32), place[order].astype(np.int32))),
                ], names=[c.split()[0] for c in INDEX.split(", ")])

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("key"))
            .mapInArrow(run, INDEX).withColumn("shard", F.monotonically_increasing_id()))


class Windows(NamedTuple):
    """Distinct windows of a block of items: word hashes (rows padded with 0),
    lengths, and (window, item) pairs in order."""

    words: np.ndarray
    length: np.ndarray
    of_window: np.ndarray
    of_item: np.ndarray
    items: list[str]


def benchmark_blocks(benchmark: DataFrame) -> DataFrame:
    """One row per block of items: their ids, numbers of words and word hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_chunks(batch, "text", BLOCK_BYTES):
                words, first = word_hashes(*text_buffer(part.column("text")))
                yield pa.RecordBatch.from_arrays([
                    pa.array([part.column("item").to_pylist()], pa.list_(pa.string())),
                    *(packed(v, [v.size]) for v in (np.diff(first).astype(np.int32), words)),
                ], names=[c.split()[0] for c in BLOCKS.split(", ")])

    return (benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             F.col("text").cast("string").alias("text")).mapInArrow(run, BLOCKS))


def windows_of(items: list[str], item_words: bytes, words: bytes, window: int) -> Windows:
    n, words = np.frombuffer(item_words, np.int32).astype(np.int64), np.frombuffer(words, U)
    first = np.cumsum(n) - n
    count = np.where(n > 0, np.maximum(1, n - window + 1), 0)
    item = np.repeat(np.arange(n.size), count)
    place = np.arange(item.size) - np.repeat(np.cumsum(count) - count, count) + first[item]
    length = np.minimum(n[item], window)
    each = np.arange(window)
    inside = each < length[:, None]
    table = np.zeros((item.size, window + 1), U)
    table[:, :window][inside] = words[(place[:, None] + each)[inside]]
    table[:, window] = length
    rows = np.ascontiguousarray(table).view(np.dtype((np.void, table.itemsize * (window + 1)))).reshape(-1)
    _, one, of = np.unique(rows, return_index=True, return_inverse=True)
    pairs = np.unique(np.stack([of.reshape(-1), item], axis=1), axis=0)
    return Windows(table[one, :window], length[one], pairs[:, 0], pairs[:, 1], items)


class Shard:
    """Postings of one index row as sorted (term, place) keys."""

    def __init__(self, row: dict):
        self.n = np.array(row["word_counts"], np.int64)
        self.start = np.cumsum(self.n) - self.n + np.arange(self.n.size) * GAP
        self.terms = np.frombuffer(row["terms"], U)
        self.lengths = np.frombuffer(row["lengths"], np.int32).astype(np.int64)
        self.begin = np.cumsum(self.lengths) - self.lengths
        self.places = np.frombuffer(row["postings"], np.int32)
        self.span = int(self.n.sum()) + GAP * (self.n.size + 2)
        self.keys = np.repeat(np.arange(self.terms.size), self.lengths) * self.span + self.places

    def near(self, term: np.ndarray, place: np.ndarray, slop: int) -> np.ndarray:
        """Whether the term's list has a place within ``slop`` of this one."""
        at = np.searchsorted(self.keys, term * self.span + np.maximum(place - slop, 0))
        found = self.keys[np.minimum(at, self.keys.size - 1)]
        return (at < self.keys.size) & (found <= term * self.span + place + slop)

    def places_of(self, pick: np.ndarray, off: np.ndarray, term: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, place) for all postings of the word at ``off`` of each
        picked window; the place is that of the window's first word."""
        size = self.lengths[term]
        block = np.cumsum(size) // CANDIDATES
        for b in np.unique(block):
            on = block == b
            n = size[on]
            at = np.repeat(self.begin[term[on]] - np.cumsum(n) + n, n) + np.arange(n.sum())
            yield np.repeat(pick[on], n), self.places[at].astype(np.int64) - np.repeat(off[on], n)

    def lookup(self, w: Windows) -> tuple[np.ndarray, np.ndarray]:
        """The term of each word of the windows, and whether it is in the shard."""
        term = np.minimum(np.searchsorted(self.terms, w.words), self.terms.size - 1)
        return term, self.terms[term] == w.words

    def phrases(self, w: Windows) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, place) of all phrase matches."""
        if not self.terms.size or not w.length.size:
            return
        term, known = self.lookup(w)
        inside = np.arange(w.words.shape[1]) < w.length[:, None]
        freq = np.where(inside, np.where(known, self.lengths[term], 0), np.iinfo(np.int64).max)
        order = np.argsort(freq, axis=1, kind="stable")
        # a missing word: no phrase match
        live = np.flatnonzero(np.take_along_axis(freq, order[:, :1], 1)[:, 0] > 0)
        off = order[live, 0]
        for win, place in self.places_of(live, off, term[live, off]):
            win, place = win[place >= 0], place[place >= 0]
            for k in range(1, w.words.shape[1]):
                o = order[win, k]
                ok = (k >= w.length[win]) | self.near(term[win, o], place + o, 0)
                win, place = win[ok], place[ok]
            yield win, place

    def proximities(self, w: Windows) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, place of one of its words) of all proximity matches, phrase
        matches among them."""
        if not self.terms.size or not w.length.size:
            return
        term, known = self.lookup(w)
        size = w.words.shape[1]
        inside = np.arange(size) < w.length[:, None]
        spare = w.length * MISSING // size
        freq = np.where(inside, np.where(known, self.lengths[term], 0), np.iinfo(np.int64).max)
        order = np.argsort(freq, axis=1, kind="stable")
        live = (inside & ~known).sum(axis=1) <= spare

        def enough(win: np.ndarray, start: np.ndarray, slop: int, *also: np.ndarray) -> tuple[np.ndarray, ...]:
            """Those of which no more than the spare words are missing, the rarest looked up first."""
            lacks = np.zeros(win.size, np.int64)
            for k in range(size):
                o = order[win, k]
                there = known[win, o] & self.near(term[win, o], start + o, slop)
                lacks += (k < w.length[win]) & ~there
                ok = lacks <= spare[win]
                win, start, lacks, *also = (x[ok] for x in (win, start, lacks, *also))
            return win, start, *also

        shifts = np.arange(-SLOP, SLOP + 1)
        for k in range(int(spare.max()) + 1):
            off = order[:, k]
            pick = np.flatnonzero(live & (k <= spare) & (k < w.length) & known[np.arange(off.size), off])
            for win, start in self.places_of(pick, off[pick], term[pick, off[pick]]):
                # two words of a match are displaced by twice the slop at most, seen from one another
                win, start = enough(win, start, 2 * SLOP)
                seen = np.repeat(start + off[win], shifts.size)
                win, start = np.repeat(win, shifts.size), (start[:, None] + shifts).reshape(-1)
                win, _, seen = enough(win, start, SLOP, seen)
                yield win, seen

    def rows(self, shard: int, w: Windows) -> Iterator[tuple]:
        """A row of ``HITS`` for each document with matches."""
        cover = np.zeros(self.span + 1, np.int32)
        found, close = {}, {}
        first = np.searchsorted(w.of_window, np.arange(w.length.size + 1))

        def note(seen: dict, win: np.ndarray, place: np.ndarray) -> None:
            doc = np.searchsorted(self.start, place, "right") - 1
            for key in np.unique(doc * w.length.size + win).tolist():
                d, at = divmod(key, w.length.size)
                seen.setdefault(d, set()).update(w.items[i] for i in w.of_item[first[at]:first[at + 1]].tolist())

        for win, place in self.phrases(w):
            np.add.at(cover, place, 1)
            np.add.at(cover, place + w.length[win], -1)
            note(found, win, place)
        for win, place in self.proximities(w):
            note(close, win, place)
        hit = np.concatenate(([False], np.cumsum(cover) > 0, [False]))
        begin, end = np.flatnonzero(hit[1:] & ~hit[:-1]), np.flatnonzero(~hit[1:] & hit[:-1])
        for d in sorted(found.keys() | close.keys()):
            own = slice(*np.searchsorted(begin, [self.start[d], self.start[d] + self.n[d]]))
            yield (shard, d, [{"first": a, "after": b} for a, b in zip((begin[own] - self.start[d]).tolist(), (end[own] - self.start[d]).tolist())],
                   sorted(found.get(d, ())), sorted(close.get(d, ())))


#: Words of a document inside any of its spans, which may overlap.
COVERED = """aggregate(array_sort(flatten(collect_list(spans))), struct(0L AS n, 0 AS till),
    (s, x) -> struct(s.n + greatest(0, x.after - greatest(x.first, s.till)) AS n, greatest(s.till, x.after) AS till), s -> s.n)"""


def search(index: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document of the stored ``index``: words, words inside phrase
    matches, the items with phrase matches, and those with proximity matches only."""
    if window + 2 * SLOP > GAP:
        raise ValueError(f"a window has at most {GAP - 2 * SLOP} words")
    blocks = stored(benchmark_blocks(benchmark).withColumn("block", F.monotonically_increasing_id()), "benchmark")
    arrow = pa.schema([("shard", pa.int64()), ("at", pa.int32()),
                       ("spans", pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())]))),
                       ("items", pa.list_(pa.string())), ("near_items", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        @lru_cache(4)
        def opened(_, items: tuple, item_words: bytes, words: bytes) -> Windows:
            return windows_of(list(items), item_words, words, window)

        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: v[0] for k, v in batch.slice(i, 1).to_pydict().items()}
                if held is None or held[0] != row["shard"]:
                    held = row["shard"], Shard(row)
                got = list(held[1].rows(row["shard"], opened(row["block"], tuple(row["items"]), row["item_words"], row["words"])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*got), arrow)] if got else
                                                 [pa.array([], t.type) for t in arrow], schema=arrow)

    pairs = index.select("shard", "word_counts", "terms", "lengths", "postings").crossJoin(blocks.hint("shuffle_replicate_nl"))
    hits = (pairs.mapInArrow(run, HITS).groupBy("shard", "at")
            .agg(F.expr(COVERED).alias("n_hit"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
                 F.array_distinct(F.flatten(F.collect_list("near_items"))).alias("near_items")))
    none = F.array().cast("array<string>")
    docs = (index.select("shard", F.posexplode(F.arrays_zip("doc_ids", "text_keys", "word_counts")).alias("at", "doc"))
            .select("shard", "at", F.col("doc.doc_ids").alias("doc_id"), F.col("doc.text_keys").alias("text_key"),
                    F.col("doc.word_counts").alias("n_words")))
    return (docs.join(hits, ["shard", "at"], "left")
            .select("doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.array_sort(F.coalesce("items", none)).alias("items"),
                    F.array_sort(F.array_except(F.coalesce("near_items", none), F.coalesce("items", none))).alias("near_items")))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Index, store, search; a document is contaminated if it has hit words and
    they are a twentieth of its words or more."""
    found = search(stored(build_index(docs), "postings"), benchmark, window)
    return found.withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    i, bad, key = unused(docs, "__id", "__bad", "__key")
    found = (contamination(docs, benchmark, window).where("contaminated")
             .select(F.col("doc_id").alias(i), F.col("text_key").alias(bad)).distinct())
    return (docs.withColumn(key, F.xxhash64("text"))
            .join(found, F.col("doc_id").cast("long").eqNullSafe(F.col(i)) & (F.col(key) == F.col(bad)), "left_anti").drop(key))


def items_digest(items: str = "items"):
    return F.sha2(F.array_join(F.array_sort(items), ",").cast("binary"), 256)
