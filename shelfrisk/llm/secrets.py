"""Secret scans (operator 7): high-recall candidates, then a random forest that
removes false positives.

Candidates are values assigned to a credential's name (which may follow other
words and '_' or '-'; in quotes up to the closing quote) and long unbroken
strings, from every whole text.  Features: length, character classes, character
transitions (mean log-probability under the corpus's own letter pairs),
dictionary coverage (share of four-letter pieces found in frequent corpus
words), the path (hashed ``source``), and the neighbouring words (hashed).  The
forest is trained from labelled findings, any table of (findings, label); where
there is none, ``weak_label`` labels those of which simple rules are sure (others
train nothing), and findings of many forms are made up beside them.

Corpus statistics count all texts: letter pairs in a fixed table, and words of a
share of at least ``FREQUENT`` of all words, of which there can be 1/FREQUENT at
most.  Defined cases: null and empty texts have no candidates; a null source is
its own path; null and repeated ids give findings of their own; a long
string in an assigned value counts once, with that value, but a quoted value with
white space is a candidate beside those in it, and one over several lines also
beside its unquoted start; where a table of labelled findings lacks one of the
kinds, every score is the share of positive labels (0.5 without any);
other columns are ignored.
"""

from __future__ import annotations

import math
import random
import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import stored
from .words import LOWER_BYTE, hash_spans, row_chunks, runs, text_buffer, WORD_BYTE

U = np.uint64
FREQUENT = 2e-5               # share of all words: at most 50,000 words can reach it
HELD_WORDS = 200_000          # distinct words a task holds before it passes their counts on
MAX_TRAINING = 50_000         # bound of the labelled findings used for training, chosen by hash
TREES, DEPTH, SEED = 60, 12, 17
EXAMPLES = 6_000              # made-up findings
CUT = 0.5
NAME_BUCKETS, PATH_BUCKETS = 32, 16

#: Names that credentials are assigned to, and candidate strings.
NAMES = r"pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth(?:orization)?|credentials?|private[_-]?key"
ASSIGNED = re.compile(
    rf"(?P<name>(?i:(?<![A-Za-z0-9])(?:{NAMES}))\b)[\"']?\s*(?::=|=>|[:=])\s*"
    r"(?=(?P<quoted>\"(?:[^\"\\]++|\\.)*+\"|'(?:[^'\\]++|\\.)*+')?)[\"']?(?P<plain>[^\s\"'<>,;]{6,})?",
    re.ASCII | re.DOTALL)
LONG = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9_/+.-]{9,}+={1,6}(?![A-Za-z0-9_/+.=-])|[A-Za-z0-9_/+.-]{14,}[A-Za-z0-9])", re.ASCII)
SHORTEST, SHORTEST_LONG = 6, 16
#: Strict formats by which findings are labelled positive.
STRICT = re.compile(r"(?:A(?:KIA|SIA)[A-Z2-7]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}"
                    r"|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|eyJ[\w-]+\.eyJ[\w-]+\.[\w-]+)\Z")
HEX = re.compile(r"[0-9A-Fa-f]{16,}\Z")
#: Forms by which findings are labelled negative.
HARMLESS = re.compile(r"(?:[^\W\d_]+|[0-9]+)(?:[\s_/.:+-]+(?:[^\W\d_]+|[0-9]+))*[\s_/.:+-]*\Z|[/.~][\w./+-]*\Z|[<$%{*].*\Z", re.DOTALL)

FINDINGS = ("doc_id long, start long, end long, rule string, value string, length int, digits double, capitals double, "
            "marks double, transitions double, coverage double, path int, before int, after int, weak_label int")
FEATURES = ("length", "digits", "capitals", "marks", "transitions", "coverage", "path", "before", "after")


def pair_code(data: np.ndarray) -> np.ndarray:
    """Character class of each byte: letters by case, digits, other, non-ASCII."""
    code = np.full(256, 63, np.int64)
    code[48:58] = np.arange(10)
    code[97:123] = np.arange(10, 36)
    code[65:91] = np.arange(36, 62)
    code[128:] = 62
    return code[data]


def corpus_statistics(docs: DataFrame) -> DataFrame:
    """Counts over all texts: (kind, key, n) with kind 0 a pair of character
    classes and kind 1 a word, summed in each task first."""
    names = ["kind", "key", "n"]

    def flush(words: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ones(len(words), np.int32)), pa.array([w for w, _ in words.values()], pa.binary()),
             pa.array([n for _, n in words.values()], pa.int64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(64 * 64, np.int64)
        words: dict[int, tuple] = {}
        for batch in batches:
            for part in row_chunks(batch, "text"):
                data, offsets = text_buffer(part.column("text"))
                code = pair_code(data)
                starts, ends = runs(WORD_BYTE[data], offsets)
                inside = np.zeros(data.size, bool)
                inside[:-1] = WORD_BYTE[data[:-1]] & WORD_BYTE[data[1:]]
                inside[ends - 1] = False
                at = np.flatnonzero(inside)
                pairs += np.bincount(code[at] * 64 + code[at + 1], minlength=64 * 64)
                low = LOWER_BYTE[data]
                h, first, n = np.unique(hash_spans(low, starts, ends), return_index=True, return_counts=True)
                raw = low.tobytes()
                for key, i, j, c in zip(h.tolist(), starts[first].tolist(), ends[first].tolist(), n.tolist()):
                    held = words.get(key)
                    words[key] = (held[0], held[1] + c) if held else (raw[i:j], c)
                if len(words) > HELD_WORDS:
                    yield flush(words)
                    words = {}
        yield flush(words)
        some = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(some.size, np.int32)), pa.array([bytes(divmod(p, 64)) for p in some.tolist()], pa.binary()),
             pa.array(pairs[some])], names=names)

    return (docs.select(F.col("text").cast("string")).mapInArrow(run, "kind int, key binary, n long")
            .groupBy("kind", "key").agg(F.sum("n").alias("n")))


class Statistics:
    """Log-probabilities of character pairs, and pieces of frequent words."""

    def __init__(self, log: np.ndarray, pieces: set[bytes]):
        self.log, self.pieces = log, pieces

    def transitions(self, value: bytes) -> float:
        code = pair_code(np.frombuffer(value, np.uint8))
        return float(self.log[code[:-1], code[1:]].mean()) if len(value) > 1 else 0.0

    def coverage(self, value: bytes) -> float:
        low = value.lower()
        n = len(low) - 3
        return sum(low[i:i + 4] in self.pieces for i in range(n)) / n if n > 0 else 0.0


def bounded_statistics(counts: DataFrame) -> tuple[np.ndarray, set[bytes]]:
    """What scoring needs of the counts: 64 x 64 log-probabilities, and the
    four-byte pieces of the words that are frequent enough."""
    held = stored(counts, "corpus_counts")
    total = held.where("kind = 1").agg(F.sum("n")).first()[0] or 0
    pairs = np.zeros((64, 64))
    for r in held.where("kind = 0").collect():
        pairs[tuple(r["key"])] = r["n"]
    frequent = held.where(F.col("kind") == 1).where(F.col("n") >= max(2, math.ceil(FREQUENT * total)))
    pieces = {bytes(w[i:i + 4]) for (w,) in frequent.select("key").collect() for i in range(len(w) - 3)}
    return np.log((pairs + 0.5) / (pairs.sum(axis=1, keepdims=True) + 32)), pieces


def bucket(word: str, n: int) -> int:
    return zlib.crc32(word.lower().encode()) % n


def weak_label(name: str | None, value: str) -> int | None:
    """A label where rules are sure of one.  1: a provider's format or an
    assigned hexadecimal string, also as one of the words of a quoted value.
    0: words, identifiers, paths and versions (pieces of letters or of digits), a
    bare hexadecimal string (a hash of something), a placeholder, a repeated
    character.  Else None: a finding that trains nothing."""
    if any(STRICT.match(v) or (name and HEX.match(v)) for v in value.split()):
        return 1
    if HARMLESS.match(value) or len(set(value)) < 3 or (not name and HEX.match(value)):
        return 0
    return None


def assigned(text: str) -> Iterator[tuple[int, int, str, bool]]:
    """(start, end, name, whole) of assigned values; what lies in a whole one is
    not a candidate of its own."""
    at = 0
    while m := ASSIGNED.search(text, at):
        at = m.end()
        start, end = m.start("quoted") + 1, m.end("quoted") - 1
        quoted = m["quoted"] is not None
        blank = quoted and re.search(r"\s", text[start:end])
        if quoted and end - start >= SHORTEST:
            yield start, end, m["name"], not blank
        # a quote that is closed on a later line may be a stray one
        if m["plain"] and (not quoted or "\n" in text[start:end]):
            yield *m.span("plain"), m["name"], True
        elif quoted:
            at = start if blank else end + 1


def find(text: str) -> Iterator[tuple[int, int, str, str, str | None]]:
    """(start, end, rule, value, name) of the candidates of a text."""
    whole = [(0, 0)]
    for start, end, name, alone in assigned(text):
        yield start, end, "assigned", text[start:end], name
        if alone:
            whole.append((start, end))
    whole.sort()
    k = 0
    for m in LONG.finditer(text):
        start, end = m.span()
        while k + 1 < len(whole) and whole[k + 1][0] <= start:
            k += 1
        if end - start >= SHORTEST_LONG and start >= whole[k][1]:
            yield start, end, "long", m[0], None


def candidates(docs: DataFrame, statistics: tuple[np.ndarray, set[bytes]]) -> DataFrame:
    """One row per candidate with its features; positions are code points."""
    shared = docs.sparkSession.sparkContext.broadcast(statistics)    # bounded, see above
    word = re.compile(r"\w+")

    def row(doc, text, path, hit, known):
        start, end, rule, value, name = hit
        raw = value.encode()
        around = word.findall(text[max(0, start - 60):start]), word.findall(text[end:end + 60])
        n = len(value)
        return (doc, start, end, rule, value, n, sum(c.isdigit() for c in value) / n,
                sum(c.isupper() for c in value) / n, sum(not c.isalnum() for c in value) / n,
                known.transitions(raw), known.coverage(raw), path,
                bucket(around[0][-1], NAME_BUCKETS) if around[0] else NAME_BUCKETS,
                bucket(around[1][0], NAME_BUCKETS) if around[1] else NAME_BUCKETS, weak_label(name, value))

    names = [c.split()[0] for c in FINDINGS.split(", ")]
    kinds = [{"long": pa.int64(), "string": pa.string(), "int": pa.int32(), "double": pa.float64()}[c.split()[1]]
             for c in FINDINGS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Statistics(*shared.value)
        for batch in batches:
            rows = []
            for doc, text, source in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                text = text.as_py()
                path = PATH_BUCKETS if source is None else bucket(source, PATH_BUCKETS)
                rows += [row(doc, text, path, hit, known) for hit in find(text)] if text else []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                       F.col("source").cast("string")).mapInArrow(run, FINDINGS)


def example_texts(n: int = EXAMPLES, seed: int = SEED) -> list[tuple[int, str, str, int]]:
    """(doc_id, text, value, label): made-up findings of many forms, so that the
    forest knows more of them than a corpus happens to hold.  Secrets are
    assigned; harmless values are assigned or stand alone."""
    rng = random.Random(seed)
    lower, digit, marks = string.ascii_lowercase, string.digits, "!@#$%^&*?-_+."
    parts = ["con", "ther", "ing", "ment", "ra", "lo", "ster", "pre", "ble", "an", "horse", "key", "light", "wa", "ter", "su", "di", "ex"]

    def some(letters, low, high):
        return "".join(rng.choices(letters, k=rng.randint(low, high)))

    def word(k=3):
        return "".join(rng.choices(parts, k=rng.randint(1, k)))

    def mixed(letters, low, high):
        return some(letters, low, high) + rng.choice(digit) + rng.choice(lower) + rng.choice(digit + string.ascii_uppercase)

    def leet():
        return (word().capitalize() + word()).translate(str.maketrans("aeo", "430")) + rng.choice(marks) + some(digit + lower, 1, 3)

    def joined(sep):
        return sep.join(word() for _ in range(rng.randint(2, 4)))

    secrets = [lambda: some("0123456789abcdef", 16, 64), lambda: some("0123456789ABCDEF", 16, 40),
               lambda: mixed(string.ascii_letters + digit, 9, 40), lambda: mixed(string.ascii_letters + digit + "-_", 14, 40),
               lambda: mixed(string.ascii_letters + digit + marks, 6, 16), leet,
               lambda: word() + word() + some(digit, 2, 4), lambda: word().capitalize() + rng.choice(marks) + some(digit, 2, 5),
               lambda: "AKIA" + some(string.ascii_uppercase + "234567", 16, 16), lambda: "ghp_" + some(string.ascii_letters + digit, 36, 36)]
    harmless = [lambda: word(4) + "ed", lambda: joined("_"), lambda: joined("-"), lambda: joined("."), lambda: "/" + joined("/"),
                lambda: joined("/") + ".txt", lambda: f"{word()}{rng.randint(1, 9)}.{word()}.com", lambda: joined("_").upper(),
                lambda: ".".join(some(digit, 1, 3) for _ in range(4)), lambda: f"20{some(digit, 2, 2)}-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}",
                lambda: f"<{joined('-')}>", lambda: "${" + joined("_") + "}", lambda: "your-" + joined("-"), lambda: "xxxxxxxx" + "x" * rng.randint(0, 9),
                lambda: joined("_") + "()", lambda: "".join(word().capitalize() for _ in range(4))]
    bare = [*harmless, lambda: some("0123456789abcdef", 32, 64), lambda: f"{joined('_')}_{some(digit, 1, 3)}",
            lambda: "-".join(some("0123456789abcdef", k, k) for k in (8, 4, 4, 4, 12))]
    names = ["password", "pwd", "secret", "token", "api_key", "access_key", "client_secret", "db_password", "auth", "passphrase"]
    out = []
    for i in range(n):
        label, alone = i % 2, i % 4 == 2
        value = rng.choice(secrets if label else bare if alone else harmless)()
        quote, sep = rng.choice(["", "", '"', "'"]), rng.choice([" = ", "=", ": ", ":"])
        before, after = (" ".join(word() for _ in range(rng.randint(0, 5))) for _ in range(2))
        name = "" if alone else rng.choice(names) + sep
        out.append((i, f"{before} {name}{quote}{value}{quote} {after}", value, label))
    return out


def example_findings(spark: SparkSession, statistics: tuple[np.ndarray, set[bytes]]) -> DataFrame:
    """The made-up findings with ``label``, their features by the corpus's statistics."""
    made = spark.createDataFrame(example_texts(), "doc_id long, text string, made string, label int")
    found = candidates(made.withColumn("source", F.lit(None).cast("string")), statistics)
    return found.join(made.select("doc_id", F.col("made").alias("value"), "label"), ["doc_id", "value"])


def train(labelled: DataFrame, max_rows: int = MAX_TRAINING, made: DataFrame | None = None):
    """A forest from findings with ``label``, at most about ``max_rows`` of them,
    and all of ``made``; None if they lack a kind, with the share of positives."""
    known = labelled.where("label IS NOT NULL").withColumn("label", F.col("label").cast("double"))
    share = min(1.0, max_rows / max(1, known.count()))
    rows = known.where(F.pmod(F.xxhash64("doc_id", "start", "value"), F.lit(1 << 20)) < int(share * (1 << 20))).select("label", *FEATURES)
    if made is not None:
        rows = rows.unionByName(made.withColumn("label", F.col("label").cast("double")).select("label", *FEATURES))
    rows = stored(rows, "training")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n = sum(counts.values())
    if len(counts) < 2:
        return None, counts.get(1.0, 0) / n if n else 0.5
    # both kinds weigh the same
    rows = rows.withColumn("weight", F.when(F.col("label") == 1, n / (2 * counts[1.0])).otherwise(n / (2 * counts[0.0])))
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, weightCol="weight",
                                  featuresCol="features", labelCol="label").fit(data), None


def judge(found: DataFrame, model, otherwise: float | None = None) -> DataFrame:
    """Findings with ``score`` and ``is_secret``."""
    from pyspark.ml.functions import vector_to_array

    if model is None:
        scored = found.withColumn("score", F.lit(float(otherwise)))
    else:
        data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found)
        scored = model.transform(data).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "start", "end", "rule", "value", "score", (F.col("score") >= CUT).alias("is_secret"))


def in_training(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(4)) != 2


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """All candidates of all documents, scored.  ``labelled`` are findings with
    ``label``; without them the weak labels of three quarters of the documents
    and the made-up findings, each half of the weight of its kind."""
    statistics = bounded_statistics(corpus_statistics(docs))
    found = stored(candidates(docs, statistics), "findings")
    made = None
    if labelled is None:
        labelled, made = found.where(in_training()).withColumn("label", F.col("weak_label")), example_findings(docs.sparkSession, statistics)
    return judge(found, *train(labelled, made=made))
