from __future__ import annotations

import os
import re

import pytest

SF = "/root/testdata/sf0.01"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, bucket string, node int, size int"

needs_data = pytest.mark.skipif(not os.path.exists(f"{SF}/documents.parquet"), reason="no driver data")


def words(text):
    """The words of a text, the plain way."""
    return WORDS.findall((text or "").translate(SMALL))


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def frame(spark, texts, ids=None, sources=None):
    """Documents with extra columns whose names the operators also use."""
    n = len(texts)
    ids = list(range(n)) if ids is None else ids
    sources = sources or [f"s{i % 3}" for i in range(n)]
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 0.5, "x", 1, 2)
                                  for i, t, s in zip(ids, texts, sources)], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, null ids and sources."""
    long = " ".join(f"w{i} the of and" for i in range(30_000))
    texts = [None, "", "   \n\t ", "one", "two words", "Éa É K ñ", long, "same text here for all of us", "same text here for all of us",
             "same text here for all of us", "!!! ... ###", "no id here but words enough to count", None, "\u2028x\x00y z"]
    ids = [0, 1, 2, 3, 4, 5, 6, 7, 7, 8, 9, None, None, 10]
    sources = ["a", "a", None, "b", "b", "é", "a", "c", "c", "c", None, None, "a", "b"]
    return frame(spark, texts, ids, sources)
