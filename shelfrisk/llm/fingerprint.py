"""Document fingerprints (operator 10): threshold-scaled sketches.

A sketch retains every five-word shingle hash below ``2^40 / scale``, whatever
the text's length; equal texts have equal sketches, the sketch of a union is
the union of sketches, and containment of a text in a very long one is estimated
without bias, if the text has such a hash.  A short text of which no hash is that
low retains its least hash, so that equal short texts are still alike; whether
another text holds it is unknown (None) where that one retains lower hashes only.  A fingerprint is the
shingle count and the retained hashes (40 bits each, ascending, base64).

``with_next`` pairs each document with the next by id: rows are dealt into
ranges of ids (an id of several ranges' rows is cut by text hash), each range also gets the first document of the one after it, and
a range is read in order.  The whole text is shuffled once.

Defined cases: null and empty texts have no shingles and an empty sketch, and no
text has a likeness with them but an equally empty one (1.0); two texts that
retain their least hash only are alike (1.0) if it is the same, else not (0.0);
fewer than five words, but not none, are one shingle; null ids come first; ties in id are
ordered by text hash and text; one document is its own next; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import join_texts, shingles, word_hashes

U = np.uint64
SHINGLE = 5
SCALE = 4
ROWS_PER_RANGE = 2000
RANGES = 200_000              # most ranges: bounds what the driver holds of them
CHUNK_CHARS = 1 << 20

Sketch = tuple[int, np.ndarray]


def low_hashes(scale: int) -> np.uint64:
    """Hashes below this one are always retained."""
    return U((1 << 40) // scale)


def sketches(texts: list[str], scale: int = SCALE, k: int = SHINGLE) -> list[Sketch]:
    """(number of shingles, ascending retained hashes) of each text."""
    words, first = word_hashes(*join_texts(texts))
    h, row = shingles(words, first, k)
    h = h >> U(24)
    total = np.bincount(row, minlength=len(texts))
    keep = h < low_hashes(scale)
    bare = (total > 0) & (np.bincount(row[keep], minlength=len(texts)) == 0)
    least = np.full(len(texts), np.iinfo(U).max)
    np.minimum.at(least, row[bare[row]], h[bare[row]])
    h, row = np.concatenate((h[keep], least[bare])), np.concatenate((row[keep], np.flatnonzero(bare)))
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(h.size, bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    cut = np.searchsorted(row, np.arange(len(texts) + 1))
    return [(int(n), h[a:b]) for n, a, b in zip(total, cut[:-1], cut[1:])]


def encode(sketch: Sketch) -> str:
    n, hashes = sketch
    raw = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes()
    return f"{n}:{base64.b64encode(raw).decode()}"


def decode(fingerprint: str) -> Sketch:
    n, _, raw = fingerprint.partition(":")
    got = np.frombuffer(base64.b64decode(raw), np.uint8).reshape(-1, 5)
    wide = np.zeros((got.shape[0], 8), np.uint8)
    wide[:, 3:] = got
    return int(n), wide.reshape(-1).view(">u8").astype(U)


def common(a: Sketch, b: Sketch) -> int:
    return np.intersect1d(a[1], b[1], assume_unique=True).size


def likeness(a: Sketch, b: Sketch) -> float:
    """Estimated Jaccard similarity of the shingle sets."""
    both = common(a, b)
    union = a[1].size + b[1].size - both
    return both / union if union else float(a[0] == b[0] == 0)


def containment(a: Sketch, b: Sketch, scale: int = SCALE) -> float | None:
    """Estimated share of a's shingles that b has; None (unknown) if a is a least
    hash only and b has a lower one, as b then does not retain a's."""
    if a[1].size and b[1].size and a[1][0] >= low_hashes(scale) and b[1][0] < a[1][0]:
        return None
    return common(a, b) / a[1].size if a[1].size else float(a[0] == 0)


def merge(a: Sketch, b: Sketch, scale: int = SCALE) -> Sketch:
    """Sketch of the union (its count is an upper bound)."""
    both = np.union1d(a[1], b[1])
    low = both[both < low_hashes(scale)]
    return a[0] + b[0], low if low.size else both[:1]


def fingerprints(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """(doc_id, fingerprint) of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in text_chunks(zip(batch.column(0).to_pylist(), map(lambda t: t.as_py(), batch.column(1)))):
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()),
                                                  pa.array(map(encode, sketches(texts, scale)))],
                                                 names=["doc_id", "fingerprint"])

    return (docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
            .mapInArrow(run, "doc_id long, fingerprint string"))


def text_chunks(rows) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of about ``CHUNK_CHARS`` each."""
    ids, texts, held = [], [], 0
    for i, t in rows:
        ids.append(i)
        texts.append(t)
        held += len(t)
        if held >= CHUNK_CHARS:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def merged_sketches(prints: DataFrame, by: str, scale: int = SCALE) -> DataFrame:
    """The union of the sketches of each group as rows (group, hash) of all low
    hashes: as long as its texts ask for, so it stays a table that any number
    of tasks share.  A group of short texts without low hashes has no rows."""
    schema = type(prints.schema)([prints.schema[by]]).add("hash", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [h[h < low_hashes(scale)] for _, h in map(decode, batch.column(1).to_pylist())]
            row = np.repeat(np.arange(len(got)), [h.size for h in got])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(np.concatenate([*got, np.empty(0, U)]).astype(np.int64))],
                names=schema.names)

    return prints.select(by, "fingerprint").mapInArrow(run, schema).distinct()


def with_next(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(bucket, donor, doc_id, text) sorted within partitions so that each
    document is followed by the next one; ``donor`` rows only follow.  A cut that
    repeats is an id of more rows than a range: as many ranges share its rows by
    text hash.  (Equal rows, of one id and text, stay in one range and stream.)"""
    spark = docs.sparkSession
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                        F.coalesce(F.col("doc_id").cast("long"), F.lit(-2**63)).alias("id"))
    keyed = keyed.withColumn("at", F.col("id").cast("double"))
    ids = keyed.select("at")
    ranges = max(1, min(RANGES, -(-ids.count() // rows_per_range)))
    at = [i / ranges for i in range(1, ranges)]
    found = Counter(ids.approxQuantile("at", at, 0.2 / ranges) if at else [0.0])
    cuts = sorted(found)
    dealt = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="at",
                       outputCol="range").transform(keyed).withColumn("tie", F.xxhash64("text"))
    repeated = [c for c in cuts if found[c] > 1]
    least = dict(keyed.where(F.col("at").isin(repeated)).groupBy("at").agg(F.min("id")).collect()) if repeated else {}
    hot = [(float(n + 1), least[c], found[c]) for n, c in enumerate(cuts) if c in least]
    split = F.broadcast(spark.createDataFrame(hot, "range double, hot long, parts long"))      # fewer than the ranges
    dealt = (dealt.join(split, "range", "left")
             .withColumn("part", F.expr("CASE WHEN parts IS NULL THEN 0 WHEN id = hot "
                                        "THEN shiftright((shiftright(tie, 40) + 8388608) * parts, 24) ELSE parts - 1 END"))
             .withColumn("bucket", F.col("range").cast("long") * RANGES + F.col("part")))
    firsts = sorted((r["bucket"], tuple(r["head"])) for r in dealt.groupBy("bucket").agg(
        F.min(F.struct("id", "tie")).alias("head")).collect())
    heads = [(*head, firsts[i - 1][0]) for i, (_, head) in enumerate(firsts)]
    table = F.broadcast(spark.createDataFrame(heads, "id long, tie long, before long"))   # one row per range
    rows = (dealt.join(table, ["id", "tie"], "left")
            .withColumn("to", F.explode(F.expr("CASE WHEN before IS NULL THEN array(struct(bucket AS b, false AS donor)) "
                                               "ELSE array(struct(bucket AS b, false AS donor), "
                                               "struct(before AS b, true AS donor)) END")))
            .select(F.col("to.b").alias("bucket"), "to.donor", "id", "tie", "doc_id", "text"))
    place = F.expr(f"CAST((bucket DIV {RANGES} + bucket % {RANGES}) % {ranges + 1} AS INT)")
    return (rows.repartitionById(ranges + 1, place).sortWithinPartitions("bucket", "donor", "id", "tie", "text")
            .select("bucket", "donor", "doc_id", "text"))


EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def edited_text(text: str, following: str) -> str:
    """The last half replaced by the first as many code points of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likeness
    to each other and to the next document's."""

    def pairs(batches):
        held = None
        for batch in batches:
            for bucket, donor, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                                batch.column(2).to_pylist(), batch.column(3)):
                text = text.as_py()
                if held and held[0] == bucket and not held[1]:
                    yield held[2], held[3], text
                held = (bucket, donor, doc, text)

    def emit(rows):
        ids, texts, after = zip(*rows)
        edited = [edited_text(t, n) for t, n in zip(texts, after)]
        own, other = sketches(list(texts), scale), sketches(edited, scale)
        beyond = [i for i, a in enumerate(after) if i + 1 == len(texts) or a is not texts[i + 1]]
        follow = own[1:] + [None]
        for i, sketch in zip(beyond, sketches([after[i] for i in beyond], scale)):
            follow[i] = sketch
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array(map(len, texts), pa.int64()),
            pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
            pa.array(map(encode, own)), pa.array(map(encode, other)),
            pa.array(map(likeness, own, other), pa.float64()), pa.array(map(likeness, own, follow), pa.float64()),
        ], names=[c.split()[0] for c in EDITED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for row in pairs(batches):
            rows.append(row)
            held += len(row[1])
            if held >= CHUNK_CHARS:
                yield emit(rows)
                rows, held = [], 0
        if rows:
            yield emit(rows)

    return with_next(docs).mapInArrow(run, EDITED)
