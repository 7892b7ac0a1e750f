"""Vector codes (operator 12): product codebooks searched in Walsh-Hadamard space.

A vector's components become the integers floor(1024 * x) and are cut into four
equal consecutive parts; each part is replaced by the index of its nearest
codebook entry.  Parts and entries are zero-padded to a power of two and pass an
integer Walsh-Hadamard transform, rows in sequency order (few sign changes
first).  The transform multiplies every squared distance by its length, so the
scaled distance is a sum of squared coefficient differences, most of it early
where neighbouring components move together.  A search adds the first
coefficients for all entries, takes the whole distance of the best as a bound,
and drops an entry as soon as its sum passes the bound; an entry at the bound
stays, so the nearest one, and of equally near ones the lowest, is exact.  All is
integer arithmetic (numbers that 64 bits could not hold are Python integers).

Training: the codebook of each part starts as that part of the 256 smallest kept
ids; each round assigns all parts and replaces entries by floor(sum / count).
Tasks send sums per entry and component, at most 256 x width numbers each; the
driver holds the codebooks, 256 x width numbers, and nothing that grows with rows.

Defined cases: a vector that is null, or that holds null or non-finite
components, is dropped; a null id sorts last, equal ids by their vectors; with
fewer than 256 kept vectors there are that many entries; all vectors are
zero-padded to the longest kept length, rounded up to a multiple of four, so
ragged and empty vectors have codes too; integers saturate at +-2^53 and an error
at the largest long; repeated rows are coded each; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS, ENTRIES, ROUNDS = 4, 256, 4
SCALE = 1024
SATURATED = 2**53
FIRST = 4                    # coefficients added for all entries, and per step after that
GRID = 1 << 20               # (vector, entry) pairs held at once
LONG = 2**63 - 1


def sequency_order(n: int) -> np.ndarray:
    """Row of the natural-order Hadamard matrix with 0, 1, 2, ... sign changes."""
    bits = n.bit_length() - 1
    index = np.arange(n)
    gray = index ^ (index >> 1)
    return sum(((gray >> b) & 1) << (bits - 1 - b) for b in range(bits)) if bits else index


def transform(parts: np.ndarray) -> np.ndarray:
    """Integer Walsh-Hadamard coefficients of each row, zero-padded, in sequency order."""
    rows, width = parts.shape
    n = 1 << max(0, width - 1).bit_length()
    out = np.zeros((rows, n), parts.dtype)
    out[:, :width] = parts
    step = 1
    while step < n:
        pair = out.reshape(rows, n // (2 * step), 2, step)
        out = np.stack((pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]), axis=2).reshape(rows, n)
        step *= 2
    return out[:, sequency_order(n)]


def fitting(*values: np.ndarray) -> list[np.ndarray]:
    """The arrays as 64-bit integers where scaled distances fit these, else as Python's."""
    top = max((int(abs(v).max()) for v in values if v.size), default=0)
    n = 1 << max(0, values[0].shape[1] - 1).bit_length()
    return [v.astype(np.int64 if (2 * n * top) ** 2 < LONG else object) for v in values]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each part's nearest entry (the lowest of equally near ones) and
    the squared distance to it."""
    x, e = (transform(v) for v in fitting(parts, entries))
    index, error = np.zeros(len(x), np.int64), np.zeros(len(x), x.dtype)
    size = max(1, GRID // max(1, len(e)))
    for at in range(0, len(x), size):
        index[at:at + size], error[at:at + size] = _nearest(x[at:at + size], e)
    return index, error // x.shape[1]


def _nearest(x: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    total = np.zeros((len(x), len(e)), x.dtype)
    for k in range(min(FIRST, x.shape[1])):
        total += (x[:, k, None] - e[None, :, k]) ** 2
    bound = ((x - e[total.argmin(axis=1)]) ** 2).sum(axis=1)
    row, entry = np.nonzero(total <= bound[:, None])
    total = total[row, entry]
    for k in range(FIRST, x.shape[1], FIRST):
        total = total + ((x[row, k:k + FIRST] - e[entry, k:k + FIRST]) ** 2).sum(axis=1)
        live = total <= bound[row]
        row, entry, total = row[live], entry[live], total[live]
    begin = np.searchsorted(row, np.arange(len(x)))           # the bound's own entry stays in every row
    least = np.minimum.reduceat(total, begin)
    best = np.flatnonzero(total == least[row])
    return entry[best[np.searchsorted(row[best], np.arange(len(x)))]], least


def integers(column, width: int) -> np.ndarray:
    """Rows of floor(1024 * x), zero-padded to ``width``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.diff(column.offsets.to_numpy()) if len(column) else np.empty(0, np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        value = np.clip(np.floor(flat * SCALE), -SATURATED, SATURATED).astype(np.int64)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width)[None, :] < size[:, None]] = value
    return out


def kept(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector, label) of the rows whose vector is whole and finite."""
    def sound(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    read = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").alias("vector"), F.col("label"))
    return read.where(F.col("vector").isNotNull() & F.coalesce(F.forall("vector", sound), F.lit(False)))


def seeds(rows: DataFrame) -> np.ndarray | None:
    """Codebooks (part, entry, position) of the smallest ids; None without rows."""
    longest = rows.agg(F.max(F.size("vector"))).first()[0]
    if longest is None:
        return None
    width = max(PARTS, -(-longest // PARTS) * PARTS)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(ENTRIES).select("vector").toArrow()
    start = integers(first.column("vector"), width)
    return start.reshape(len(start), PARTS, width // PARTS).transpose(1, 0, 2)


def entry_sums(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """(part, entry, position, total, n) over all parts assigned to an entry."""
    _, entries, w = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((PARTS, entries, w), object), np.zeros((PARTS, entries), np.int64)
        for batch in batches:
            value = integers(batch.column("vector"), PARTS * w)
            exact = value if int(abs(value).max(initial=0)) * len(value) < LONG else value.astype(object)
            for p in range(PARTS):
                index, _ = nearest(value[:, p * w:(p + 1) * w], books[p])
                order = np.argsort(index, kind="stable")
                used, begin = np.unique(index[order], return_index=True)
                if used.size:
                    total[p, used] += np.add.reduceat(exact[order, p * w:(p + 1) * w], begin, axis=0)
                    count[p] += np.bincount(index, minlength=entries)
        part, entry, at = (x.ravel() for x in np.indices(total.shape))
        n = count[part, entry]
        some = n > 0
        sums = [Decimal(int(t)) for t in total.ravel()[some]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part[some], pa.int32()), pa.array(entry[some], pa.int32()), pa.array(at[some], pa.int32()),
             pa.array(sums, pa.decimal128(38, 0)), pa.array(n[some], pa.int64())],
            names=["part", "entry", "position", "total", "n"])

    sums = rows.select("vector").mapInArrow(run, "part int, entry int, position int, total decimal(38,0), n long")
    return sums.groupBy("part", "entry", "position").agg(F.sum("total").cast("decimal(38,0)").alias("total"), F.sum("n").alias("n"))


def train(vectors: DataFrame, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (part, entry, position) after ``rounds`` of assignment and
    replacement; None if no vector is kept."""
    rows = kept(vectors)
    books = seeds(rows)
    for _ in range(rounds if books is not None else 0):
        new = books.copy()
        for r in entry_sums(rows, books).toArrow().to_pylist():
            new[r["part"], r["entry"], r["position"]] = int(r["total"]) // r["n"]
        books = new
    return books


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every kept vector."""
    rows, w = kept(vectors), books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = integers(batch.column("vector"), PARTS * w)
            index, error = zip(*(nearest(value[:, p * w:(p + 1) * w], books[p]) for p in range(PARTS)))
            code = np.stack(index, axis=1).astype(np.uint8).tobytes().hex()
            error = [min(int(e), LONG) for e in sum(x.astype(object) for x in error)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"),
                 pa.array([code[i:i + 2 * PARTS] for i in range(0, len(code), 2 * PARTS)], pa.string()),
                 pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])

    label = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def codebook_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in books.ravel()).encode()).hexdigest()


def compress(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per kept vector: its code, error, its label's error and the
    digest of the codebooks."""
    books = train(vectors, rounds)
    if books is None:
        return vectors.sparkSession.createDataFrame(
            [], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    coded = encode(vectors, books)
    by_label = coded.groupBy("label").agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("long").alias("label_error"))
    by_label = by_label.withColumnRenamed("label", "own_label")
    return (coded.join(by_label, coded["label"].eqNullSafe(by_label["own_label"]))
            .select("vec_id", "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256")))
