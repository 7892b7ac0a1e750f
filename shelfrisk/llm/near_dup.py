"""Near-duplicates (operator 5): ProbMinHash over weighted five-word shingles,
banding, verification, connected classes.

The weight of a shingle is its count.  Each shingle's arrivals form a Poisson
process of its weight; register k of a document holds the shingle that arrives
there first, and a document's shingles stop once their next arrival is later
than every register's first.  Two documents agree in a register with probability
J_p, the probability Jaccard similarity (for equal weights the plain Jaccard).

Texts with the same word sequence are one node, so copies are never paired.
Nodes that agree in a band are a bucket, and each meets its bucket's hub, the
node whose buckets are largest: in a group of edited copies that is the text
they come from.  J_p of each such pair is computed from the whole shingle sets;
links of at least ``threshold`` join classes.  Where the nodes that met one hub
are then of several classes, all of different classes are compared in blocks of
bounded size, inside tasks.  So every two nodes of a bucket have been compared
or are of one class, and no list of all pairs is made.

With 32 bands of 6 registers a pair of J_p 0.8 becomes a candidate with
probability 0.9999, one of 0.9 with 1 - 1e-10.  Defined cases: texts without
words are never linked, each is its own class; a null id is kept (its class id
is the least id of the class, null if there is none); repeated rows are copies;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import stored, unused
from .words import distinct_shingles, mix, packed, row_chunks, shingles, text_buffer, word_hashes

U = np.uint64
SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 6
BLOCK_NODES, BLOCK_ELEMENTS = 512, 200_000   # nodes and shingles of a block, about
SLICE = 4096                  # shingles whose incidence is held at once
LOW = U(0xFFFFFFFF)


def prob_minhash(row: np.ndarray, element: np.ndarray, weight: np.ndarray, n_rows: int, k: int) -> np.ndarray:
    """Registers (n_rows x k) of the weighted sets given as (row, element,
    weight) triples: the 32 low bits of the element that arrives first."""
    first = np.full(n_rows * k, np.iinfo(U).max)     # arrival time (float32 bits), then element
    time, step = np.zeros(row.size), 0
    while row.size:
        step += 1
        seed = mix(element + U(step * 0x9E3779B97F4A7C15 % 2**64))
        time = time - np.log(((seed >> U(11)) + U(1)).astype(np.float64) * 2.0**-53) / weight
        at = row * k + (mix(seed ^ U(0xA0761D6478BD642F)) % U(k)).astype(np.int64)
        np.minimum.at(first, at, (time.astype(np.float32).view(np.uint32).astype(U) << U(32)) | (mix(element) & LOW))
        rows, at = np.unique(row, return_inverse=True)
        latest = first.reshape(n_rows, k)[rows].max(axis=1) >> U(32)
        limit = np.where(latest == LOW, np.inf, latest.astype(np.uint32).view(np.float32))[at]
        on = time <= limit * (1 + 1e-6)
        row, element, weight, time = row[on], element[on], weight[on], time[on]
    return (first & LOW).reshape(n_rows, k)


def band_hashes(registers: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=U)), (registers.shape[0], bands))
    parts = registers.reshape(-1, bands, rows)
    for j in range(rows):
        out = mix(out * U(3) + parts[:, :, j])
    return out


def text_keys(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """16 bytes per row that identify its word sequence (two independent sums)."""
    n = np.diff(first)
    place = np.arange(words.size, dtype=np.int64) - np.repeat(first[:-1], n)
    out = []
    for salt in (0x2545F4914F6CDD1D, 0x5851F42D4C957F2D):
        total = np.zeros(words.size + 1, U)
        np.cumsum(mix(words + mix(place.astype(U) + U(salt))), out=total[1:])
        out.append(mix(total[first[1:]] - total[first[:-1]] + n.astype(U)))
    return np.stack(out, axis=1).astype(">u8")


def fixed_binary(keys: np.ndarray) -> pa.Array:
    flat = keys.reshape(-1)
    return packed(flat, np.arange(1, keys.shape[0] + 1) * keys.shape[1])


def keyed_texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.xxhash64(F.col("text").cast("string")).alias("text_key"))


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, k: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, node, n_words, bands): node identifies the word
    sequence; texts without words have no node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_chunks(batch, "text"):
                words, first = word_hashes(*text_buffer(part.column("text")))
                n = np.diff(first)
                sets = distinct_shingles(*shingles(words, first, k))
                found = band_hashes(prob_minhash(*sets, n.size, bands * rows), bands, rows).astype(np.int64)
                some = n > 0
                ends = np.concatenate(([0], np.cumsum(some * bands)))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("text_key"),
                    pc.if_else(pa.array(some), fixed_binary(text_keys(words, first)),
                                       pa.scalar(None, pa.binary())),
                    pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found[some].reshape(-1)))],
                    names=["doc_id", "text_key", "node", "n_words", "bands"])

    return keyed_texts(docs).mapInArrow(run, "doc_id long, text_key long, node binary, n_words long, bands array<long>")


def probability_jaccard(x: tuple, y: tuple) -> float:
    """J_p of two weighted sets, each (sorted elements, weights)."""
    (ex, wx), (ey, wy) = x, y
    both, ix, iy = np.intersect1d(ex, ey, assume_unique=True, return_indices=True)
    if not both.size:
        return 0.0
    a = np.concatenate((wx[ix], np.delete(wx, ix), np.zeros(ey.size - both.size)))
    b = np.concatenate((wy[iy], np.zeros(ex.size - both.size), np.delete(wy, iy)))
    ratio = np.divide(a, b, out=np.full(a.size, np.inf), where=b > 0)
    order = np.argsort(ratio, kind="stable")
    ratio, a_sum, b_sum = ratio[order], np.cumsum(a[order]), np.cumsum(b[order])
    own, count = np.unique(wx[ix] / wy[iy], return_inverse=True)
    lower = np.searchsorted(ratio, own, "left")         # elements with a smaller ratio count by b
    below_a = np.where(lower > 0, a_sum[lower - 1], 0)
    below_b = np.where(lower > 0, b_sum[lower - 1], 0)
    total = (a_sum[-1] - below_a) + own * below_b
    return float(np.sum(wx[ix] / total[count]))


def shingle_sets(docs: DataFrame, nodes: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(node, elements, weights) of the given (doc_id, text_key, node) rows, from
    the whole text of one document of each node.  Texts meet them by id and text
    hash, so an id that many texts share pairs each text with its own node."""
    asked = nodes.select(F.col("doc_id").alias("asked_id"), F.col("text_key").alias("asked_key"), F.col("node").alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_chunks(batch, "text"):
                words, first = word_hashes(*text_buffer(part.column("text")))
                row, element, weight = distinct_shingles(*shingles(words, first, k))
                ends = np.searchsorted(row, np.arange(1, part.num_rows + 1))
                own = fixed_binary(text_keys(words, first))
                yield pa.RecordBatch.from_arrays(
                    [own, packed(element.astype("<i8"), ends), packed(weight.astype("<i4"), ends),
                     pc.equal(own, part.column("asked"))],
                    names=["node", "elements", "weights", "same"])

    # equal hashes of different texts, and repeated rows: only the asked text is kept, once
    return (keyed_texts(docs).join(asked, F.col("doc_id").eqNullSafe(F.col("asked_id")) & (F.col("text_key") == F.col("asked_key")))
            .select("text", "asked")
            .mapInArrow(run, "node binary, elements binary, weights binary, same boolean")
            .where("same").drop("same").dropDuplicates(["node"]))


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, similarity) of the candidate pairs."""
    def side(name):
        return sets.select(F.col("node").alias(name), F.col("elements").alias(f"{name}_e"),
                           F.col("weights").alias(f"{name}_w"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = {c: batch.column(c) for c in ("a_e", "a_w", "b_e", "b_w")}
            like = []
            for i in range(batch.num_rows):
                x, y = ((np.frombuffer(got[f"{s}_e"][i].as_py(), "<i8"), np.frombuffer(got[f"{s}_w"][i].as_py(), "<i4")
                         .astype(float)) for s in "ab")
                like.append(probability_jaccard(x, y))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(like, pa.float64())],
                                             names=["a", "b", "similarity"])

    joined = pairs.join(side("b").hint("merge"), "b").join(side("a").hint("merge"), "a")
    return joined.mapInArrow(run, "a binary, b binary, similarity double")


def connect(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, class): the least node that links lead to.  Labels spread along
    links and then jump to their label's label, so rounds grow with the
    logarithm of a class's width; each round is stored."""
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    label = stored(both.groupBy("a").agg(F.min("b").alias("m"))
                   .select(F.col("a").alias("node"), F.least("a", "m").alias("class")), "labels")
    while True:
        near = (both.join(label.withColumnRenamed("node", "b").hint("merge"), "b").groupBy("a").agg(F.min("class").alias("seen")))
        spread = (label.join(near.hint("merge"), F.col("node") == F.col("a"))
                  .select("node", F.col("class").alias("old"), F.least("class", "seen").alias("class")))
        spread = stored(spread, "spread")
        jump = spread.select(F.col("node").alias("class"), F.col("class").alias("next"))
        new = stored(spread.join(jump.hint("merge"), "class", "left")
                     .select("node", "old", F.least("class", F.coalesce("next", "class")).alias("class")), "labels")
        changed = new.where("class <> old").limit(1).count()
        label = new.drop("old")
        if not changed:
            return (nodes.select("node").join(label.hint("merge"), "node", "left")
                    .select("node", F.coalesce("class", "node").alias("class")))


def similarities(elements: list[np.ndarray], weights: list[np.ndarray], left: np.ndarray, right: np.ndarray,
                 wanted: np.ndarray, threshold: float):
    """(i, j, J_p) of the wanted pairs (left x right) of at least ``threshold``.
    Shared shingles are counted for all pairs at once; that is J_p where all
    weights are equal, the other pairs are computed one by one unless the
    Bhattacharyya coefficient, which bounds J_p, is too small."""
    size = np.array([e.size for e in elements])
    flat = np.concatenate(elements)
    row = np.repeat(np.arange(size.size), size)
    root = np.sqrt(np.concatenate([w / w.sum() for w in weights])).astype(np.float32)
    names, column, n = np.unique(flat, return_inverse=True, return_counts=True)
    place = np.cumsum(n > 1) - 1                        # a shingle of one node is shared by none
    keep = n[column] > 1
    row, column, root = row[keep], place[column[keep]], root[keep]
    both, bound = np.zeros((2, left.size, right.size), np.float32)
    for start in range(0, int((n > 1).sum()), SLICE):
        some = (column >= start) & (column < start + SLICE)
        for out, value in ((both, np.float32(1)), (bound, root[some])):
            grid = np.zeros((size.size, SLICE), np.float32)
            grid[row[some], column[some] - start] = value
            out += grid[left] @ grid[right].T
    plain = np.array([w.min() == w.max() for w in weights])
    exact = plain[left][:, None] & plain[right][None, :]
    like = both / (size[left][:, None] + size[right][None, :] - both)
    for i, j in np.argwhere(wanted & exact & (like >= threshold - 1e-5)).tolist():
        shared = int(both[i, j])
        yield left[i], right[j], shared / int(size[left[i]] + size[right[j]] - shared)
    for i, j in np.argwhere(wanted & ~exact & (bound >= threshold - 1e-3)).tolist():
        a, b = left[i], right[j]
        yield a, b, probability_jaccard((elements[a], weights[a]), (elements[b], weights[b]))


def compare_blocks(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b, similarity) between the members (hub, node, class) of one
    hub that are of different classes.  A hub's nodes are dealt into blocks;
    each pair of blocks is one group of bounded size."""
    sized = members.join(sets, "node").withColumn("size", F.length("elements") / 8)
    mixed = (sized.groupBy("hub").agg(F.min("class").alias("low"), F.max("class").alias("high"),
                                      F.greatest(F.ceil(F.count("*") / BLOCK_NODES),
                                                 F.ceil(F.sum("size") / BLOCK_ELEMENTS)).alias("blocks"))
             .where("low <> high").select("hub", "blocks"))
    dealt = (sized.join(mixed, "hub").withColumn("own", F.pmod(F.xxhash64("node"), "blocks"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("hub", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own",
                     "node", "class", "elements", "weights"))

    def run(table: pa.Table) -> pa.Table:
        own, i, j = (table.column(c).to_numpy() for c in ("own", "i", "j"))
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        node = table.column("node").to_pylist()
        label = np.unique(np.array([c.hex() for c in table.column("class").to_pylist()]), return_inverse=True)[1]
        wanted = label[left][:, None] != label[right][None, :]
        if left.size and i[0] == j[0]:
            wanted &= left[:, None] < right[None, :]
        found = list(similarities([np.frombuffer(x, "<i8") for x in table.column("elements").to_pylist()],
                                  [np.frombuffer(x, "<i4").astype(float) for x in table.column("weights").to_pylist()],
                                  left, right, wanted, threshold)) if wanted.any() else []
        ends = [sorted((node[a], node[b])) for a, b, _ in found]
        return pa.table({"a": pa.array([a for a, _ in ends], pa.binary()), "b": pa.array([b for _, b in ends], pa.binary()),
                         "similarity": pa.array([s for *_, s in found], pa.float64())})

    return (dealt.groupBy("hub", "i", "j").applyInArrow(run, "a binary, b binary, similarity double")
            .where(F.col("similarity") >= threshold))


def similar_nodes(docs: DataFrame, nodes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Verified links (a, b, similarity) that hold each class together."""
    bands = stored(nodes.select(F.explode("bands").alias("bucket"), "node"), "bands")
    size = bands.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(bands.join(size.hint("merge"), "bucket"), "shared_bands")
    weight = shared.groupBy("node").agg(F.sum("n").alias("n"))
    hubs = (shared.drop("n").join(weight.hint("merge"), "node").groupBy("bucket")
            .agg(F.max(F.struct("n", "node")).alias("hub")).select("bucket", F.col("hub.node").alias("hub")))
    met = stored(shared.drop("n").join(hubs.hint("merge"), "bucket").select("hub", "node").distinct(), "met")
    # every node of a shared bucket met a hub, or is one
    asked = nodes.select("doc_id", "text_key", "node").join(met.select("node").distinct().hint("merge"), "node", "left_semi")
    sets = stored(shingle_sets(docs, asked), "shingles")
    pairs = met.where("hub <> node").select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()
    links = stored(verify(pairs, sets).where(F.col("similarity") >= threshold), "links")
    members = (met.join(connect(nodes, links).hint("merge"), "node"))
    return links.union(stored(compare_blocks(members, sets, threshold), "more_links"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: its class id (the least document id of its class),
    how many documents have its text, its words, and whether its text and id
    stand for its class."""
    found = stored(signatures(docs, bands, rows), "signatures")
    nodes = stored(found.where("node IS NOT NULL").groupBy("node")
                   .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("least"),
                        F.count("*").alias("n_copies"), F.first("bands").alias("bands"))
                   .select("node", "least.doc_id", "least.text_key", "n_copies", "bands"), "nodes")
    member = connect(nodes, similar_nodes(docs, nodes, threshold))
    # (id, node) that stands for a class: the least id, then the least node
    heads = (member.join(nodes.select("node", "doc_id").hint("merge"), "node").groupBy("class")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node")).alias("head")))
    about = (member.join(heads.hint("merge"), "class").join(nodes.select("node", "n_copies").hint("merge"), "node")
             .select("node", F.col("head.doc_id").alias("class_id"), F.col("head.node").alias("head_node"), "n_copies"))
    return (found.drop("bands", "text_key").join(about.hint("merge"), "node", "left")
            .select("doc_id", F.expr("CASE WHEN node IS NULL THEN doc_id ELSE class_id END").alias("class_id"),
                    F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"), "n_words",
                    F.expr("node IS NULL OR (doc_id <=> class_id AND node = head_node)").alias("is_head"), "node"))


def keep_one(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The documents without near-duplicates, and one of each class: the whole
    rows of ``docs``, matched by id and word sequence."""
    node, i, head = unused(docs, "__node", "__id", "__head")
    heads = classes.where("is_head").select(F.col("doc_id").alias(i), F.col("node").alias(head)).distinct()
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_chunks(batch, "text"):
                words, first = word_hashes(*text_buffer(part.column("text")))
                own = pc.if_else(pa.array(np.diff(first) > 0), fixed_binary(text_keys(words, first)),
                                 pa.scalar(None, pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns, own], names=[*part.schema.names, node])

    keyed = docs.mapInArrow(run, type(schema)([*schema.fields]).add(node, "binary"))
    kept = keyed.join(heads, keyed["doc_id"].cast("long").eqNullSafe(heads[i])
                      & keyed[node].eqNullSafe(heads[head]), "left_semi")
    wordless = kept.where(F.col(node).isNull())
    return kept.where(F.col(node).isNotNull()).dropDuplicates(["doc_id", node]).union(wordless).drop(node)
