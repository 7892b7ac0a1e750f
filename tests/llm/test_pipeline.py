from __future__ import annotations

import json
import os
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from .conftest import SF, frame, needs_data, rows

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@needs_data
def test_stages_chain_and_keep_columns(spark, documents):
    import corpus_pipeline as C

    docs, counts = documents, [documents.count()]
    for _, stage in C.STAGES[:-1]:
        docs = C.stored(stage(spark, docs, SF), "stage")
        assert docs.columns == documents.columns
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] > 0
    got = rows(C.run(spark, SF))
    assert sum(r["n_tokens"] for r in got) > 0 and {d for r in got for d in r["doc_ids"]} <= {
        r["doc_id"] for r in rows(documents)}


@needs_data
def test_every_stage_takes_odd_and_empty_tables(spark, odd):
    import corpus_pipeline as C

    for docs in (odd, odd.limit(0)):
        for name, stage in C.STAGES:
            out = stage(spark, docs, SF)
            n = out.count()
            if docs is not odd:
                assert n == 0, name
            elif name != "packing":
                assert out.columns == odd.columns


@needs_data
def test_a_contaminated_document_goes_and_clean_ones_stay(spark):
    import corpus_pipeline as C

    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    docs = frame(spark, [item, "clean words only " * 20, item + " " + "other words " * 2000])
    kept = {r["doc_id"] for r in rows(C.decontamination_stage(spark, docs, SF))}
    assert kept == {1, 2}


@needs_data
def test_every_stage_takes_clashing_names(spark, documents):
    """Columns named like those that the stages add are kept with their values."""
    import corpus_pipeline as C

    docs = documents
    for n, c in enumerate(("__node", "__id", "__head", "__key", "__bad", "__t", "__tie", "__source", "__size", "__blocks", "__text",
                           "__score", "__SCORE_", "shard", "bucket", "node")):
        docs = docs.withColumn(c, F.col("doc_id") + n)
    for name, stage in C.STAGES[:-1]:
        plain, out = stage(spark, documents, SF), stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert out.where("__node <> doc_id OR __t <> doc_id + 5 OR __score <> doc_id + 11 OR bucket <> doc_id + 14").count() == 0
        assert sorted(map(str, rows(out.select(plain.columns)))) == sorted(map(str, rows(plain))), name


@needs_data
@pytest.mark.parametrize("name", ["op1_chat_format", "op4_decontamination"])
def test_oracle(spark, name):
    from tools.compare_oracle import compare

    got = compare(spark, SF, [name])[name]
    assert got.get("hash_match") and got["spark_rows"] == got["oracle_rows"], got


def test_entry_names_and_repository_rules():
    code = ("import __spark_entry__ as e, json; q = e.queries(); "
            "print(json.dumps([n for n in q if n == 'pipeline' or n.startswith('op')]))")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout
    names = json.loads(out.strip().splitlines()[-1])
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names if n != "pipeline"} == set(range(1, 14)) and "pipeline" in names
