r"""Spelling variants (operator 13): pivotal bigrams, position limits, verification.

Words are near if one inserted, deleted or replaced code point makes one the
other.  A word's bigrams are ordered from the rarest (in how many words each
stands; ties by the bigram, then by position).  From the ``PREFIX`` rarest, dynamic
programming chooses two pivots that share no code point, so that one edit leaves
one of them whole.  An edit makes at most two new bigrams, so a whole pivot is
among the ``PREFIX + 2`` rarest bigrams of the near word, its gram prefix, and the
pivots of every word are looked up in all words' gram prefixes.

Position limits: with one edit, all to the left of the edit stands at the same
place from the start, all to the right at the same place from the end.  An edit
at or behind the second pivot leaves the first one and what lies between them; an
edit at or before the first leaves the second one and that; an edit between leaves
both, with all before and all behind.  So a pivot's entry names its place from that
side, the code points on the unedited side (with up to ``REACH`` of those between
the pivots), and the near word's length, all folded into one 64-bit key.  The
pivots are those for which these lists are the shortest: the first ends far from
the word's end, the second begins far from its start, then the rarer.  Pairs that
meet are verified by edit distance in the join itself, and met from the shorter word.

Bigram statistics come from all words; their table has at most 90 x 90 rows, as
words consist of 90 letters, and goes through the driver.  Everything else stays
in Spark.  Defined cases: null and empty texts have no words; a null id stands as
an empty string in the checksum; repeated rows count each; very long words have
at most 119 entries; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import BATCH_BYTES, stored
from .words import BASE, BASE_INVERSE, LOWER_BYTE, mix, power_table, powers, row_chunks, runs, text_buffer

U = np.uint64
LEAST_LENGTH, LEAST_COUNT = 6, 5
SWAP = 199                   # a run whose checksum this divides loses a code point
FORM_RATIO = 5               # a form is at least so many times as frequent
PREFIX, REACH = 5, 6
LEAD = 0xC3                  # first byte of U+00C0 to U+00FF, of nothing else
LETTER = ((LOWER_BYTE >= 97) & (LOWER_BYTE <= 122))
SHORT = 64                   # bytes of a run whose checksum is computed with others'
CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    CRC = np.where(CRC & 1, np.uint32(0xEDB88320) ^ (CRC >> 1), CRC >> 1)


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, state: np.ndarray) -> np.ndarray:
    """crc32 of each span, continued from the crc32 in ``state``."""
    value = state.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    size = ends - starts
    order = np.argsort(-np.where(size > SHORT, 0, size), kind="stable")
    alive = np.searchsorted(-np.where(size > SHORT, 0, size)[order], -np.arange(SHORT), "left")
    for j in range(SHORT):
        some = order[:alive[j]]
        if not some.size:
            break
        value[some] = CRC[(value[some] ^ data[starts[some] + j]) & 255] ^ (value[some] >> np.uint32(8))
    value ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > SHORT):
        value[i] = zlib.crc32(data[starts[i]:ends[i]].tobytes(), int(state[i]))
    return value


def counted_runs(ids: list, data: np.ndarray, offsets: np.ndarray, least: int) -> pa.StructArray:
    """(values, counts): the words of at least ``least`` code points of some texts."""
    low = LOWER_BYTE[data]
    lead = data == LEAD
    member = LETTER[low] | lead
    member[1:] |= lead[:-1]
    starts, ends = runs(member, offsets)
    leads = np.concatenate(([0], np.cumsum(lead)))
    length = ends - starts - (leads[ends] - leads[starts])
    starts, ends, length = (x[length >= least] for x in (starts, ends, length))
    state = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    check = checksums(low, starts, ends, state[np.searchsorted(offsets, starts, "right") - 1])
    swapped = np.flatnonzero(check % SWAP == 0)
    edited = []
    for i in swapped.tolist():
        run, at = low[starts[i]:ends[i]].tobytes().decode(), int(check[i]) % int(length[i])
        edited.append(run[:at] + run[at + 1:])
    whole = np.delete(np.arange(starts.size), swapped)
    size = (ends - starts)[whole]
    end = np.cumsum(size)
    source = np.arange(size.sum()) + np.repeat(starts[whole] - end + size, size)
    plain = pa.Array.from_buffers(pa.large_string(), whole.size, [
        None, pa.py_buffer(np.concatenate(([0], end)).astype(np.int64).tobytes()), pa.py_buffer(low[source].tobytes())])
    return pc.value_counts(pa.concat_arrays([plain, pa.array([w for w in edited if len(w) >= least], pa.large_string())]))


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_chunks(batch, "text", BATCH_BYTES):
                found = counted_runs(part.column("doc_id").to_pylist(), *text_buffer(part.column("text")), least_length)
                yield pa.RecordBatch.from_arrays([found.field(0).cast(pa.string()), found.field(1)], names=["word", "n"])

    read = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return read.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index, code points) of the words of each length."""
    size = np.array([len(w) for w in words])
    for n in np.unique(size):
        index = np.flatnonzero(size == n)
        flat = "".join(words[i] for i in index).encode("utf-32-le")
        yield index, np.frombuffer(flat, "<u4").reshape(index.size, n).astype(np.int64)


def bigrams(points: np.ndarray) -> np.ndarray:
    return points[:, :-1] * 256 + points[:, 1:]          # letters are below 256


def bigram_counts(words: DataFrame) -> np.ndarray:
    """In how many words each bigram stands, by its number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for _, points in by_length(batch.column("word").to_pylist()):
                gram = np.sort(bigrams(points), axis=1)
                first = np.concatenate((np.ones((len(gram), 1), bool), gram[:, 1:] != gram[:, :-1]), axis=1)
                total += np.bincount(gram[first], minlength=1 << 16)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["gram", "n"])

    out = np.zeros(1 << 16, np.int64)
    for gram, n in words.select("word").mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n")).collect():
        out[gram] = n
    return out


def pivots(place: np.ndarray, count: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row's bigrams (places ascending, counts beside them) the two that
    share no code point and whose lists are the shortest, found from the left:
    the best first pivot before each place is the best so far."""
    rarity = count / (1.0 + count.max(initial=1)) * 2.0**-40         # decides between equal places only
    as_first = 8.0 ** -(length - place - 2.0).clip(max=12) + rarity   # shares of the words that share the other side
    as_second = 8.0 ** -place.clip(max=12).astype(float) + rarity
    n, k = place.shape
    row = np.arange(n)
    best, first, second = np.full(n, np.inf), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for j in range(1, k):
        cost = np.where(place[:, :j] + 2 <= place[:, j:j + 1], as_first[:, :j], np.inf)
        i = cost.argmin(axis=1)
        total = cost[row, i] + as_second[:, j]
        better = total < best
        best = np.where(better, total, best)
        first, second = np.where(better, place[row, i], first), np.where(better, place[:, j], second)
    return first, second


def side_hashes(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every start and every end of each word."""
    n = points.shape[1]
    power, inverse = ((power_table(b, 64) if n <= 64 else powers(b, n)) for b in (BASE, BASE_INVERSE))
    total = np.zeros((len(points), n + 1), U)
    np.cumsum(mix(points.astype(U) + U(1)) * power[:n], axis=1, out=total[:, 1:])
    return mix(total), mix((total[:, -1:] - total) * inverse[:n + 1] + U(1))


def entries(points: np.ndarray, count: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """(row, key) of the gram prefixes' entries and of the pivots' for words of one length."""
    n, length = points.shape
    gram = bigrams(points)
    order = np.lexsort((np.broadcast_to(np.arange(length - 1), gram.shape), gram, count[gram]), axis=1)
    prefix = np.sort(order[:, :PREFIX], axis=1)
    listed = np.sort(order[:, :PREFIX + 2], axis=1)
    a, b = pivots(prefix, count[np.take_along_axis(gram, prefix, axis=1)], length)
    start, end = side_hashes(points)
    row = np.arange(n)

    def key(case, value, size):
        return mix(value ^ mix(np.array([case + 4 * size], U)))

    # gram prefixes: all starts and ends within reach of a gram, all pairs of grams
    begins, ends = np.zeros((2, n, length + 1), bool)
    for at in listed.T:
        for m in range(REACH + 1):
            begins[row, np.minimum(at + 2 + m, length)] = True
            ends[row, np.maximum(at - m, 0)] = True
    listing = []
    for case, where, value in ((0, begins, start), (1, ends, end)):
        r, t = np.nonzero(where)
        listing.append((r, key(case, value[r, t], length)))
    for i in range(listed.shape[1]):
        for j in range(i + 1, listed.shape[1]):
            r = np.flatnonzero(listed[:, i] + 2 <= listed[:, j])
            listing.append((r, key(2, mix(start[r, listed[r, i] + 2]) ^ end[r, listed[r, j]], length)))

    asking = []
    between = np.flatnonzero(b > a + 2)
    both = mix(start[row, a + 2]) ^ end[row, b]
    for size in (length, length + 1):                    # a shorter near word asks for this one
        asking.append((row, key(0, start[row, np.minimum(b, a + 2 + REACH)], size)))
        asking.append((row, key(1, end[row, np.maximum(a + 2, b - REACH)], size)))
        asking.append((between, key(2, both[between], size)))
    return tuple(tuple(np.concatenate(x) for x in zip(*found)) for found in (listing, asking))


def index(words: DataFrame, count: np.ndarray) -> DataFrame:
    """(word, listed, asked): keys of each word's gram prefix and of its pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for which, points in by_length(batch.column("word").to_pylist()):
                sides = []
                for row, key in entries(points, count):
                    order = np.lexsort((key, row))
                    row, key = row[order], key[order]
                    once = np.concatenate(([True], (row[1:] != row[:-1]) | (key[1:] != key[:-1])))
                    at = np.searchsorted(row[once], np.arange(which.size + 1))
                    sides.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(key[once].astype(np.int64))))
                yield pa.RecordBatch.from_arrays([batch.column("word").take(pa.array(which)), *sides],
                                                 names=["word", "listed", "asked"])

    return words.select("word").mapInArrow(run, "word string, listed array<long>, asked array<long>")


def near_words(words: DataFrame) -> DataFrame:
    """(a, b): every pair of near words, once, the shorter or lesser first."""
    keys = stored(index(words, bigram_counts(words)), "bigrams")
    asked = keys.select(F.explode("asked").alias("key"), F.col("word").alias("a"))
    listed = keys.select(F.explode("listed").alias("key"), F.col("word").alias("b"))
    ordered = (F.length("a") < F.length("b")) | ((F.length("a") == F.length("b")) & (F.col("a") < F.col("b")))
    met = asked.join(listed, "key").where(ordered & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "b").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: each round doubles the steps
    taken, and a form is several times as frequent, so a few rounds do."""
    found = stored(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while found.where("moved").limit(1).count():
        onward = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = stored(found.join(onward, "root", "left")
                       .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
    return found.drop("moved")


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
             ratio: int = FORM_RATIO) -> DataFrame:
    """One row per word: its form (its most frequent near word, if that is at
    least ``ratio`` times as frequent), the root its forms lead to, and counts."""
    if least_length < 4 or ratio < 2:
        raise ValueError("least_length: two pivots need the three bigrams of four code points; ratio: 2 or more, so that forms lead on")
    words = stored(word_counts(docs, least_length, least_count), "words")
    pairs = stored(near_words(words), "near_words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).union(pairs.select("b", "a"))
    best = (both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").groupBy("word")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near", "near_n")).alias("best")))
    found = words.join(best, "word", "left")
    has_form = F.col("best.near_n") >= ratio * F.col("n")
    found = stored(found.select("word", "n", F.when(has_form, F.col("best.near")).alias("form"),
                                F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                F.when(has_form, F.col("best.near_n")).alias("form_n")), "forms")
    return (found.join(roots(found.where("form IS NOT NULL")), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
