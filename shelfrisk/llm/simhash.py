"""SimHash near-duplicates (operator 11): BK-trees over shards of fingerprints.

A bit of a document's fingerprint is set if it is set in over half of the XXH64
hashes of its four-word shingles.  Equal fingerprints are one node.  Of six blocks
of a fingerprint two fingerprints that differ in at most four bits share two at
least, so each pair of blocks gives a shard key (15 in all) and every link lies in
some shard.  A shard's members form a BK-tree: a child hangs on its parent by their
integer Hamming distance, and a search that is at distance d from a node follows
only the edges d-4 .. d+4.

A shard of more than ``SHARD`` members is the top of a tree that lies across the
cluster: one member is its root, the others are dealt by their distance to it into
the shards of its children, and each also visits the children's shards on the edges
it may follow, until all shards are small.  A small shard's tree goes to every
block of its visitors.  So no task holds more than a shard and a block, and no key,
however many fingerprints share it, is compared pair by pair.  A task returns its
links as stars around the least member of each local component, at most one row a
fingerprint, which connects the same nodes as all links would.

Defined cases: a null or empty text, or one without words, has fingerprint zero
and is linked like any other; with fewer than four words the whole sequence is the
one shingle; repeated rows are returned each; a null id is kept and is the
component's id only if it has no other; other columns are ignored; an empty table
gives no rows.  A task holds one text at a time however long it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .near_dup import connect
from .scratch import stored
from .words import LOWER_BYTE, SPACE_BYTE, row_chunks, runs, text_buffer

U = np.uint64
SHINGLE, SEED, RADIUS = 4, 42, 4
WIDTHS = (11, 11, 11, 11, 10, 10)      # bits of the blocks; RADIUS + 2 of them share two
SHARD = 4096                           # members of a tree, visitors of a block
SLICE = 1 << 15                        # shingles whose bits are counted at once
PAIRS = 1 << 20                        # (visitor, node) pairs followed at once, about


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each run of ``k`` words, joined by one space, and its row."""
    starts, ends = runs(~SPACE_BYTE[data], offsets)
    first = np.searchsorted(starts, offsets)
    count = np.diff(first)
    size = ends - starts + 1                            # with the space after it
    begin = np.concatenate(([0], np.cumsum(size)))
    source = np.arange(begin[-1]) + np.repeat(starts - begin[:-1], size)
    joined = LOWER_BYTE[data[np.minimum(source, max(0, data.size - 1))]]
    joined[begin[1:] - 1] = 32
    row = np.repeat(np.arange(count.size), count)
    place = np.arange(starts.size) - first[row]
    opens = np.flatnonzero((place + k <= count[row]) | (place == 0))
    shuts = begin[np.minimum(opens + k, first[row[opens] + 1])] - 1
    text, digest = joined.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(text[s:e], SEED) for s, e in zip(begin[opens].tolist(), shuts.tolist())), U, opens.size)
    return hashes, row[opens]


def majority(hashes: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
    """The bits set in over half of each row's hashes."""
    counts = np.zeros((n_rows, 64), np.int64)
    for at in range(0, hashes.size, SLICE):
        some = row[at:at + SLICE]
        bits = np.unpackbits(hashes[at:at + SLICE].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        begin = np.flatnonzero(np.concatenate(([True], some[1:] != some[:-1])))
        counts[some[begin]] += np.add.reduceat(bits, begin, axis=0, dtype=np.int64)
    half = np.bincount(row, minlength=n_rows)[:, None]
    return np.packbits(2 * counts > half, axis=1, bitorder="little").view("<u8").reshape(-1).astype(U)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, bits) of every document; bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_chunks(batch, "text"):
                hashes, row = shingle_hashes(*text_buffer(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(majority(hashes, row, part.num_rows).astype(np.int64))],
                    names=["doc_id", "bits"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, bits long")


class Forest:
    """BK-trees over integers, one for each group; all trees grow and are
    searched together, level by level."""

    def __init__(self, values: np.ndarray, group: np.ndarray):
        self.values = values
        order = np.argsort(group, kind="stable")
        head = np.flatnonzero(np.concatenate(([True], group[order][1:] != group[order][:-1]))) if order.size else order
        self.groups, self.roots = group[order[head]], order[head]
        self.sizes = np.diff(np.append(head, order.size))
        node = self.roots[np.searchsorted(self.groups, group)]
        item = np.setdiff1d(np.arange(values.size), self.roots)
        node, edges, children = node[item], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        while item.size:                                # the first item on an edge is its child, the others go on from there
            edge = node * 65 + self.distance(item, node)
            kind, first, where = np.unique(edge, return_index=True, return_inverse=True)
            child = item[first]
            edges.append(kind)
            children.append(child)
            left = np.ones(item.size, bool)
            left[first] = False
            item, node = item[left], child[where][left]
        edge, child = np.concatenate(edges), np.concatenate(children)
        order = np.argsort(edge)
        self.edge, self.child = edge[order], child[order]

    def distance(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(self.values[a] ^ self.values[b]).astype(np.int64)

    def within(self, visitor: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(visitor's index, node) of all nodes of the visitor's tree within
        ``radius``, at most about ``PAIRS`` at once."""
        at = np.searchsorted(self.groups, group)
        cost = np.cumsum(self.sizes[at])                # a visitor meets no node of its tree twice
        begin = 0
        while begin < visitor.size:
            end = max(begin + 1, int(np.searchsorted(cost, cost[begin] + PAIRS)))
            index, found = np.arange(begin, min(end, visitor.size)), []
            node = self.roots[at[index]]
            while index.size:
                d = np.bitwise_count(visitor[index] ^ self.values[node]).astype(np.int64)
                near = d <= radius
                found.append((index[near], node[near]))
                low = np.searchsorted(self.edge, node * 65 + np.maximum(d - radius, 0), "left")
                n = np.searchsorted(self.edge, node * 65 + np.minimum(d + radius, 64), "right") - low
                index = np.repeat(index, n)
                node = self.child[np.repeat(low - np.cumsum(n) + n, n) + np.arange(index.size)]
            yield tuple(np.concatenate(x) for x in zip(*found))
            begin = end


def least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index that the links (a, b) lead to, for each of ``n`` nodes."""
    label = np.arange(n)
    while True:
        new = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label, new.copy())           # a label's own node hears of it too
        new = new[new]
        if (new == label).all():
            return label
        label = new


def stars(members: list[np.ndarray], visitors: list[np.ndarray], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, least of its component) in each shard, between its
    members and between members and visitors."""
    own = np.repeat(np.arange(len(members)), [m.size for m in members])
    other = np.repeat(np.arange(len(visitors)), [v.size for v in visitors])
    value = np.concatenate([np.empty(0, np.int64), *members, *visitors]).view(U)
    forest = Forest(value[:own.size], own)
    label = np.arange(value.size)
    for i, j in forest.within(value, np.concatenate((own, other)), radius):
        i, j = label[i], label[j]
        if (i != j).any():
            label = least_labels(label.size, i[i != j], j[i != j])[label]
    moved = np.flatnonzero(label != np.arange(value.size))
    found = value.view(np.int64)
    return found[moved], found[label[moved]]


def shard_keys(bits: Column, widths: tuple[int, ...] = WIDTHS) -> Column:
    """The shard of each pair of blocks."""
    shift = [sum(widths[:i]) for i in range(len(widths))]
    block = [F.shiftrightunsigned(bits, s).bitwiseAND(F.lit((1 << w) - 1)) for s, w in zip(shift, widths)]
    pairs = list(combinations(range(len(widths)), 2))
    return F.array(*(F.lit(n << 32) + F.shiftleft(block[i], 11) + block[j] for n, (i, j) in enumerate(pairs)))


def search(shards: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) of the shards (members, visitors: arrays of at most about ``SHARD``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for column in (batch.column("members"), batch.column("visitors")):
                at, flat = column.offsets.to_numpy(), column.flatten().to_numpy()
                sides.append([flat[s:e] for s, e in zip(at[:-1] - at[0], at[1:] - at[0])])
            a, b = stars(*sides, radius)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return shards.select("members", "visitors").mapInArrow(run, "a long, b long")


def split(rows: DataFrame, big: DataFrame, radius: int) -> DataFrame:
    """One level of the trees of the big shards: (shard, bits, member) of their
    children.  Members go down their own edge and visit the greater edges within
    the radius; visitors visit all edges within it."""
    at = rows.join(big.select("shard", "root"), "shard").withColumn("d", F.bit_count(F.col("bits").bitwiseXOR(F.col("root"))))
    visits = F.sequence(F.when(F.col("member"), F.col("d")).otherwise(F.greatest(F.col("d") - radius, F.lit(0))),
                        F.least(F.col("d") + radius, F.lit(64)))
    return (at.withColumn("edge", F.explode(visits))
            .select(F.xxhash64("shard", "edge").alias("shard"), "bits", (F.col("member") & (F.col("edge") == F.col("d"))).alias("member")))


def blocks(rows: DataFrame, counts: DataFrame, size: int) -> DataFrame:
    """(members, visitors): each small shard's members beside every block of its visitors."""
    own = (rows.where("member").join(counts.select("shard"), "shard").groupBy("shard")
           .agg(F.collect_list("bits").alias("members")))
    dealt = (rows.where("NOT member").join(counts.select("shard", "visitors"), "shard")
             .withColumn("block", F.pmod(F.xxhash64("bits"), F.ceil(F.col("visitors") / size)))
             .groupBy("shard", "block").agg(F.collect_list("bits").alias("visitors")))
    return own.join(dealt, "shard", "left").select("members", F.coalesce("visitors", F.array().cast("array<bigint>")).alias("visitors"))


def near_bits(nodes: DataFrame, radius: int = RADIUS, widths: tuple[int, ...] = WIDTHS, size: int = SHARD) -> DataFrame:
    """Links (a, b) that connect all fingerprints (column ``bits``, distinct) of
    at most ``radius`` differing bits."""
    rows = nodes.select(F.explode(shard_keys(F.col("bits"), widths)).alias("shard"), "bits", F.lit(True).alias("member"))
    links, level = [], 0
    while True:
        about = rows.groupBy("shard").agg(
            F.count_if("member").alias("members"), F.count_if(~F.col("member")).alias("visitors"),
            F.min(F.when(F.col("member"), F.struct(F.xxhash64("bits"), "bits"))).alias("root"))
        counts = stored(about.where("members + visitors > 1 AND members > 0").select("shard", "members", "visitors", "root.bits")
                        .withColumnRenamed("bits", "root"), "shards")
        small, big = counts.where(F.col("members") <= size), counts.where(F.col("members") > size)
        links.append(stored(search(blocks(rows, small, size), radius), "links"))
        if not big.limit(1).count():
            return reduce(DataFrame.union, links)
        level += 1
        rows = stored(split(rows, big, radius), f"level_{level}")


def components(docs: DataFrame, radius: int = RADIUS, widths: tuple[int, ...] = WIDTHS, size: int = SHARD) -> DataFrame:
    """One row per document: its fingerprint, the least document id that links
    lead to, and how many documents have its fingerprint."""
    if len(widths) < radius + 2 or sum(widths) != 64 or max(widths) > 11:
        raise ValueError("widths: two blocks more than the radius, of at most 11 bits, 64 in all")
    found = stored(fingerprints(docs), "fingerprints")
    nodes = stored(found.groupBy("bits").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_copies")), "nodes")
    member = connect(nodes.select(F.col("bits").alias("node")), near_bits(nodes, radius, widths, size))
    heads = member.join(nodes.withColumnRenamed("bits", "node"), "node")
    heads = heads.join(heads.groupBy("class").agg(F.min("least").alias("component_id")), "class")
    return (found.join(heads.select(F.col("node").alias("bits"), "component_id", "n_copies"), "bits")
            .select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id", "n_copies"))
