"""Quality classifier (operator 3): hashed word n-grams, logistic regression
trained with follow-the-regularised-leader (proximal) updates, scored as
sparse dot products.

Tokens are runs of word characters (A-Z lower-cased, words without lower-case
letters share one mark) and runs of other visible characters; a word that
repeats the word before becomes a repeat mark.  Features are hashed 1- and 2-grams, valued
by the square root of their share in the text.  Nothing but the text is read.

Training uses a bounded sample of the labelled rows (``max_rows``, chosen by a
hash of the id).  The updates follow one another, so one task makes them all:
the bound is what it holds; averaging shards was less accurate on few labels.
Defined cases: a null text is empty and scores by the bias alone; labels that
are null or of unknown ids are ignored, of several labels of an id the least
counts; without any label every score is 0.5; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import unused
from .words import LOWER_BYTE, SPACE_BYTE, WORD_BYTE, hash_spans, mix, row_chunks, runs, text_buffer

U = np.uint64
BITS = 18                    # features are hashed to 2^BITS weights; one more is the bias
MAX_ROWS = 8_000             # bound of the training sample
EPOCHS = 5
ALPHA, BETA, L1, L2 = 4.0, 1.0, 0.1, 0.1
ACCEPT = 0.7

UPPER = U(0x5851F42D4C957F2D)
REPEAT = U(0x14057B7EF767814F)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes in order and where each row's tokens begin."""
    low = LOWER_BYTE[data]
    word = WORD_BYTE[data]
    ws, we = runs(word, offsets)
    ps, pe = runs(~word & ~SPACE_BYTE[data], offsets)
    starts, ends = np.concatenate((ws, ps)), np.concatenate((we, pe))
    order = np.argsort(starts, kind="stable")
    starts, ends, is_word = starts[order], ends[order], order < ws.size
    h = hash_spans(low, starts, ends)
    letters = np.concatenate(([0], np.cumsum((data >= 97) & (data <= 122))))
    capitals = np.concatenate(([0], np.cumsum((data >= 65) & (data <= 90))))
    h = np.where((letters[ends] == letters[starts]) & (capitals[ends] - capitals[starts] > 1), UPPER, h)
    first = np.searchsorted(starts, offsets)
    words = np.flatnonzero(is_word)
    row = np.repeat(np.arange(offsets.size - 1), np.diff(first))[words]
    again = words[1:][(h[words[1:]] == h[words[:-1]]) & (row[1:] == row[:-1])]
    h[again] = REPEAT
    return h, first


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS):
    """Sparse rows: (row, index, value) ordered by row and index."""
    h, first = tokens(data, offsets)
    n = np.diff(first)
    row = np.repeat(np.arange(n.size), n)
    two = mix(h[:-1] * U(3) + h[1:]) if h.size > 1 else h[:0]
    inside = row[1:] == row[:-1]
    idx = np.concatenate((mix(h) >> U(64 - bits), two[inside] >> U(64 - bits)))
    key = np.sort((np.concatenate((row, row[1:][inside])).astype(U) << U(bits)) | idx)
    if not key.size:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    count = np.diff(np.append(at, key.size))
    r, i = (key[at] >> U(bits)).astype(np.int64), (key[at] & U((1 << bits) - 1)).astype(np.int64)
    return r, i, np.sqrt(count / n[r])


def ftrl(examples, bits: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
    """Weights after one update per example (index, value, label).  The bias
    (the last weight) is not regularised."""
    z, s = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    lasso, ridge = np.full_like(z, l1), np.full_like(z, l2)
    lasso[-1] = ridge[-1] = 0

    def weights(i):
        over = np.abs(z[i]) > lasso[i]
        return np.where(over, -(z[i] - np.sign(z[i]) * lasso[i]) / ((beta + np.sqrt(s[i])) / alpha + ridge[i]), 0.0)

    for i, x, y in examples:
        i, x = np.append(i, 1 << bits), np.append(x, 1.0)
        w = weights(i)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
        z[i] += g - (np.sqrt(s[i] + g * g) - np.sqrt(s[i])) / alpha * w
        s[i] += g * g
    return weights(np.arange(z.size))


def training_sample(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """(key, text, label) of labelled documents, at most about ``max_rows``: one
    text for each id, the one of the least hash, so that an id however often
    repeated is one row.  The sample of ids is broadcast: its size is bounded by
    that parameter."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label"))
             .where("doc_id IS NOT NULL AND label IS NOT NULL")
             .groupBy("doc_id").agg(F.min("label").alias("label")))
    n = known.count()
    share = min(1.0, max_rows / max(n, 1))
    key = F.xxhash64("doc_id", F.lit("sample"))
    chosen = known.withColumn("key", key).where(F.pmod("key", F.lit(1 << 20)) < int(share * (1 << 20)))
    found = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
             .join(F.broadcast(chosen), "doc_id"))
    return (found.groupBy("doc_id", "key", "label").agg(F.min(F.struct(F.xxhash64("text").alias("order"), "text")).alias("one"))
            .select("key", "one.text", "label"))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, epochs: int = EPOCHS,
          bits: int = BITS) -> np.ndarray:
    """The weights (2^bits and the bias).  Only they reach the driver."""

    def fit(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("key", "ascending"), ("text", "ascending")])
        rows = []
        for batch in table.to_batches():
            for part in row_chunks(batch, "text"):
                r, i, x = features(*text_buffer(part.column("text")), bits)
                cut = np.searchsorted(r, np.arange(part.num_rows + 1))
                rows += [(i[a:b].astype(np.int32), x[a:b].astype(np.float32), y)
                         for a, b, y in zip(cut[:-1], cut[1:], part.column("label").to_pylist())]
        order = np.random.default_rng(7)
        w = ftrl((rows[j] for _ in range(epochs) for j in order.permutation(len(rows))), bits)
        at = np.flatnonzero(w)
        return pa.table({"i": pa.array(at, pa.int64()), "w": pa.array(w[at])})

    sample = training_sample(docs, labels, max_rows)
    table = sample.groupBy(F.lit(0).alias("model")).applyInArrow(fit, "i long, w double").toArrow()
    w = np.zeros((1 << bits) + 1)
    w[table["i"].to_numpy()] = table["w"].to_numpy()
    return w


def score(docs: DataFrame, weights: np.ndarray, keep: tuple[str, ...], text_col: str = "text",
          into: str = "__score") -> DataFrame:
    """The columns ``keep`` and ``into``, the probability of label 1."""
    bits = (weights.size - 1).bit_length() - 1
    shared = docs.sparkSession.sparkContext.broadcast(weights)   # fixed size
    held = unused(docs, "__text")[0]
    chosen = docs.select(*keep, F.col(text_col).cast("string").alias(held))
    schema = type(chosen.schema)(chosen.schema.fields[:-1]).add(into, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            for part in row_chunks(batch, held):
                data, offsets = text_buffer(part.column(held))
                r, i, x = features(data, offsets, bits)
                dot = np.bincount(r, w[i] * x, part.num_rows) + w[-1]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(1 / (1 + np.exp(-np.clip(dot, -500, 500))))], names=schema.names)

    return chosen.mapInArrow(run, schema)
