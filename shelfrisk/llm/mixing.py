"""Mixing sources to target weights (operator 6).

The words of a source's documents, in order, form a stream that is cut into
blocks of ``block`` words.  A source's target, in blocks, is drawn over output
shards: each shard's counts are multinomial, given that the totals are met.
Slots of a source are numbered over the shards and mapped through a
pseudorandom permutation of its block indices, a new one for each pass, so a
block is taken at most once more than any other; blocks join by index.

Targets: sources by code point (null last) weigh ``weights`` in turn and share
all sizes; a target stops at ``most`` times its source's size and the excess is
shared again by weight.

Defined cases: a size is the number of runs without white space, 0 for null and
empty texts, whose rows are returned with nothing taken; null ids and repeated
rows are rows of their own; ties in id are ordered by text hash; other columns
are ignored; an empty table gives no rows.  One row per source is held on the
driver (weights are per-source parameters); nothing else is.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import stored, unused
from .words import SPACE_BYTE, mix, row_chunks, run_counts, text_buffer

BLOCK = 128
WEIGHTS = (1, 2, 3)
MOST = 3
SHARD_SLOTS = 4096
STREAM_ROWS = 1000            # rows of a source that are numbered in one task, about
SEED = 20240601
LARGE = 10**6                 # factorials of greater numbers by Stirling's series, to 10^-20

SIZES = "doc_id long, source string, size long, tie long"


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, tie): tie orders rows of equal id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_chunks(batch, "text"):
                data, offsets = text_buffer(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("source"),
                     pa.array(run_counts(~SPACE_BYTE[data], offsets), pa.int64()), part.column("tie")],
                    names=["doc_id", "source", "size", "tie"])

    return (docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string"),
                        F.xxhash64("text").alias("tie")).mapInArrow(run, SIZES))


def targets(source_sizes: list[tuple], weights=WEIGHTS, most: int = MOST) -> dict:
    """Target of each source.  The level at which weights are served rises
    until the sizes are shared out; a source leaves when it is full."""
    order = sorted(source_sizes, key=lambda r: (r[0] is None, (r[0] or "").encode()))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    out = {s: 0.0 for s, _ in order}
    rest = float(sum(n for _, n in order))
    open_weight = float(sum(weight.values()))
    for s, n in sorted(order, key=lambda r: r[1] / weight[r[0]]):
        out[s] = min(most * float(n), rest * weight[s] / open_weight)
        rest -= out[s]
        open_weight -= weight[s]
    return out


def shard_counts(draws: np.ndarray, shard: int, n_shards: int, slots: int = SHARD_SLOTS, seed: int = SEED):
    """How many of a shard's slots each source gets, and how many of its slots
    lie in earlier shards.  The totals are split down a binary tree of shards:
    the left half's counts are a seeded draw without replacement, so each shard
    finds its own counts alone and all add up."""
    low, high = 0, n_shards
    held, before = draws.astype(np.int64), np.zeros(draws.size, np.int64)
    while high - low > 1:
        mid = (low + high) // 2
        rng = np.random.Generator(np.random.Philox(key=[seed, (low << 32) | high]))
        left = split(rng, held, (mid - low) * slots)
        if shard < mid:
            held, high = left, mid
        else:
            before, held, low = before + left, held - left, mid
    return held, before


def split(rng, counts: np.ndarray, n: int) -> np.ndarray:
    """A draw of ``n`` without replacement from ``counts`` of each colour."""
    out, rest = np.zeros_like(counts), int(counts.sum())
    for i, c in enumerate(counts.tolist()):
        rest -= c
        if n and c:
            out[i] = hypergeometric(rng, c, rest, n)
            n -= int(out[i])
    return out


def log_factorial_ratio(a: int, b: int) -> tuple[float, int]:
    """(r, b) with log(a! / b!) = r + (a - b) log b for large numbers, (r, 1) for
    others.  The part that grows is left to the caller, who can cancel it."""
    if min(a, b) < LARGE:
        return math.lgamma(a + 1) - math.lgamma(b + 1), 1
    d = a - b
    return (a + 0.5) * math.log1p(d / b) - d + (1 / a - 1 / b) / 12, b


def hypergeometric(rng, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws without replacement are good, at every count that
    64 bits hold: ratio-of-uniforms rejection under a hat of the distribution's
    width (constants of the table mountain hat: sqrt(8/e) and 3 - sqrt(12/e)).
    Log-probabilities are taken relative to the mode; what grows with the counts
    cancels in integers, so they are as exact for 10^15 as for 10."""
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    total = good + bad
    mode = (n + 1) * (good + 1) // (total + 2)
    mean = n * (good / total)
    width = math.sqrt(8 / math.e) * math.sqrt(mean * (bad / total) * ((total - n) / max(1, total - 1)) + 0.5) + 3 - math.sqrt(12 / math.e)
    while True:
        u, v = 1.0 - rng.random(), rng.random()
        k = mode + math.floor(mean - mode + 0.5 + width * (v - 0.5) / u)
        if not low <= k <= high:
            continue
        d, rest, above, below = k - mode, 0.0, 1, 1
        for new, old, up in ((k, mode, True), (bad - n + k, bad - n + mode, True), (good - k, good - mode, False), (n - k, n - mode, False)):
            ratio, base = log_factorial_ratio(new, old)
            rest += ratio
            above, below = (above * base, below) if up else (above, below * base)
        slope = (math.log1p((above - below) / below) if 2 * above > below else math.log(above) - math.log(below)) * d
        if 2 * math.log(u) <= -rest - slope:
            return k


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of range(n): a four-round Feistel network on
    the next power of four, walked until the image is below ``n``."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask, out = np.uint64((1 << half) - 1), index.astype(np.uint64)
    todo = np.arange(out.size)
    while todo.size:
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for r in range(4):
            left, right = right, left ^ (mix(right + np.uint64((key * 4 + r + 1) * 0x9E3779B97F4A7C15 % 2**64)) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


class Plan:
    """Sizes, targets and block draws of each source, numbered by code point."""

    def __init__(self, sized: DataFrame, block: int = BLOCK, weights=WEIGHTS, most: int = MOST):
        rows = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
        rows = sorted(rows, key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
        self.block = block
        self.source = [r["source"] for r in rows]
        self.size = [r["size"] for r in rows]
        self.docs = [r["n"] for r in rows]
        share = targets([(r["source"], r["size"]) for r in rows], weights, most)
        self.target = [share[s] for s in self.source]
        self.blocks = np.array([-(-n // block) for n in self.size], np.int64)
        # whole passes over the source, then blocks for the rest
        passes = [int(t / n + 1e-9) if n else 0 for t, n in zip(self.target, self.size)]
        rest = [round((t - k * n) / block) for t, k, n in zip(self.target, passes, self.size)]
        self.draws = np.array(passes, np.int64) * self.blocks + np.clip(np.array(rest, np.int64), 0, self.blocks)

    def table(self, spark) -> DataFrame:
        rows = [(i, s, n, float(t), -(-d // STREAM_ROWS)) for i, (s, n, t, d) in
                enumerate(zip(self.source, self.size, self.target, self.docs))]
        return spark.createDataFrame(rows, "source_no long, name string, source_size long, target double, buckets long")


def numbered(sized: DataFrame, plan: Plan) -> DataFrame:
    """Adds ``begin``, the row's first word in its source's stream.  A source is
    dealt into as many buckets as its rows ask for; buckets are summed first,
    so no task holds a whole source."""
    table = plan.table(sized.sparkSession)
    dealt = stored(sized.join(table, F.col("source").eqNullSafe(F.col("name"))).drop("name")
                   .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "tie"), "buckets")), "dealt")
    earlier = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (dealt.groupBy("source_no", "bucket").agg(F.sum("size").alias("total"))
             .select("source_no", "bucket", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base")))
    own = (Window.partitionBy("source_no", "bucket").orderBy("doc_id", "tie", "size")
           .rowsBetween(Window.unboundedPreceding, -1))
    return (dealt.withColumn("inside", F.coalesce(F.sum("size").over(own), F.lit(0)))
            .join(bases.hint("merge"), ["source_no", "bucket"])
            .withColumn("begin", F.col("base") + F.col("inside")).drop("base", "inside", "bucket", "buckets"))


def slots(spark, plan: Plan, slots_each: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """The mix: (shard, slot, source_no, block, copy) for every slot of every
    output shard, each shard drawn in its own task."""
    draws, blocks = plan.draws, plan.blocks
    n_shards = max(1, -(-int(draws.sum()) // slots_each))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"].tolist():
                counts, before = shard_counts(draws, shard, n_shards, slots_each, seed)
                parts = []
                for s in np.flatnonzero(counts).tolist():
                    j = before[s] + np.arange(counts[s])
                    copy, place = j // blocks[s], j % blocks[s]
                    for e in np.unique(copy).tolist():
                        at = permuted(place[copy == e], int(blocks[s]), seed + 7919 * s + 104729 * e)
                        parts.append(pd.DataFrame({"source_no": s, "block": at, "copy": e}))
                if parts:
                    out = pd.concat(parts, ignore_index=True)
                    place = np.random.Generator(np.random.Philox(key=[seed + 1, shard])).permutation(len(out))
                    out.insert(0, "slot", place)
                    out.insert(0, "shard", shard)
                    yield out

    tasks = max(1, min(n_shards, -(-n_shards // 64), 100_000))
    return (spark.range(0, n_shards, 1, tasks)
            .mapInPandas(run, "shard long, slot long, source_no long, block long, copy long"))


def pieces(placed: DataFrame, block: int) -> DataFrame:
    """The blocks' contents: for each document the blocks that it is in, with
    its first word there (from 0) and how many words."""
    return (placed.where("size > 0")
            .withColumn("block", F.explode(F.expr(f"sequence(begin div {block}, (begin + size - 1) div {block})")))
            .withColumn("first", F.expr(f"greatest(begin, block * {block}) - begin"))
            .withColumn("words", F.expr(f"least(begin + size, (block + 1) * {block}) - begin - first")))


# Stored tables are so compressed that file sizes say little of rows: joins whose
# sides grow are hinted as sort-merge joins, which the engine may split but not broadcast.


def taken_pieces(docs: DataFrame, block: int = BLOCK, weights=WEIGHTS, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """Documents placed in their streams, and the taken pieces of each with how
    many times the mix takes them."""
    sized = stored(sizes(docs), "sizes")
    plan = Plan(sized, block, weights, most)
    placed = stored(numbered(sized, plan), "streams")
    times = slots(docs.sparkSession, plan).groupBy("source_no", "block").agg(F.count("*").alias("times"))
    return placed, pieces(placed, block).join(times.hint("merge"), ["source_no", "block"])


def mix_sources(docs: DataFrame, block: int = BLOCK, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per document: size, source_size, target, and the words of it
    that the mix takes, repeats counted."""
    placed, used = taken_pieces(docs, block, weights, most)
    # a place in a stream belongs to one document with words
    taken = used.groupBy("source_no", "begin").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    empty = placed.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return (placed.where("size > 0").join(taken.hint("merge"), ["source_no", "begin"], "left")
            .withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long")).unionByName(empty)
            .select("doc_id", "size", "source_size", "target", "taken"))


def runs_taken(blocks: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(first word, words) of the pieces to emit, from (first, words, times):
    neighbouring pieces of one copy are joined, so a document that is taken
    whole stays whole."""
    out: list[tuple[int, int]] = []
    for copy in range(1, max(t for *_, t in blocks) + 1):
        start = end = None
        for first, words, times in sorted(blocks):
            if times < copy:
                continue
            if first == end:
                end += words
            else:
                if end is not None:
                    out.append((start, end - start))
                start, end = first, first + words
        out.append((start, end - start))
    return out


def mixed_documents(docs: DataFrame, block: int = BLOCK, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix as documents: the rows of ``docs`` cut to the words that the mix
    takes, one row per contiguous piece and copy; ``n_chars`` is the piece's."""
    tie, i, source, key, size_of, blocks_of = unused(docs, "__t", "__id", "__source", "__tie", "__size", "__blocks")
    _, used = taken_pieces(docs, block, weights, most)
    cuts = (used.groupBy("doc_id", "source", "tie", "size", "begin")
            .agg(F.collect_list(F.struct("first", "words", "times")).alias(blocks_of))
            .select(F.col("doc_id").alias(i), F.col("source").alias(source), F.col("tie").alias(key),
                    F.col("size").alias(size_of), blocks_of))
    names, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = re.compile(r"[^ \t-\r]+")
        for batch in batches:
            keep, texts = [], []
            for row, (text, size, blocks) in enumerate(zip(batch.column("text"), batch.column(size_of).to_pylist(),
                                                         batch.column(blocks_of).to_pylist())):
                text = text.as_py()
                at = None
                for first, n in runs_taken([(b["first"], b["words"], b["times"]) for b in blocks]):
                    if n == size:
                        texts.append(text)
                    else:
                        at = at or [m.span() for m in word.finditer(text)]
                        texts.append(text[at[first][0]:at[first + n - 1][1]])
                    keep.append(row)
            got = batch.select(names).take(pa.array(keep, pa.int64()))
            new = {"text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())}
            yield pa.RecordBatch.from_arrays([new[n].cast(got.column(n).type) if n in new else got.column(n) for n in names], names=names)

    once = docs.withColumn(tie, F.xxhash64("text")).dropDuplicates(["doc_id", "source", tie])
    return (once.join(cuts.hint("merge"), F.col("doc_id").cast("long").eqNullSafe(F.col(i))
                      & F.col("source").eqNullSafe(F.col(source)) & (F.col(tie) == F.col(key)))
            .select(*names, size_of, blocks_of).mapInArrow(run, schema))
