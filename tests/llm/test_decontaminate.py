from __future__ import annotations

import hashlib
import random

from shelfrisk.llm import decontaminate as D

from .conftest import frame, needs_data, rows, words

ITEMS = "item_id long, text string, n_words int"


def brute(docs, items):
    """Every window at every place, by comparing words."""
    out = []
    for text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            q = words(t)
            k = min(13, len(q))
            wins = {tuple(q[i:i + k]) for i in range(len(q) - k + 1)} if q else set()
            for i in range(len(w) - k + 1 if k else 0):
                if tuple(w[i:i + k]) in wins:
                    hit.update(range(i, i + k))
                    found.add("" if item is None else str(item))
        out.append((len(w), len(hit), sorted(found)))
    return out


def check(spark, docs, items):
    df = frame(spark, docs)
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], ITEMS)
    got = sorted(rows(D.contamination(df, bench)), key=lambda r: r["doc_id"])
    want = brute(docs, items)
    assert [(r["n_words"], r["n_hit"], r["items"]) for r in got] == want
    assert [r["contaminated"] for r in got] == [h > 0 and 20 * h >= n for n, h, _ in want]
    return got


def test_against_brute_force(spark):
    rng = random.Random(3)
    some = ["a", "b", "cc", "É", "d9", "e"]
    items = [(i, " ".join(rng.choices(some, k=rng.choice([1, 3, 12, 13, 14, 30])))) for i in range(20)]
    docs = [" ".join(rng.choices(some, k=rng.choice([0, 1, 5, 13, 40, 300]))) for _ in range(60)]
    docs += [f"x y z {t.upper()}, q {t}" for _, t in items]
    check(spark, docs, items + [(3, "a b"), (5, items[5][1]), (None, "d9 d9"), (40, None), (41, " .. ")])


def test_odd_rows(spark, odd):
    items = [(1, "same text here for all"), (2, "w7 the of and w8 the of and w9 the of and w10 the of and"), (3, "one")]
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], ITEMS)
    order = sorted(rows(D.contamination(odd, bench)), key=lambda r: (str(r["doc_id"]), r["n_words"]))
    data = sorted(rows(odd), key=lambda r: (str(r["doc_id"]), len(words(r["text"]))))
    assert [(r["n_words"], r["n_hit"], r["items"]) for r in order] == brute([r["text"] for r in data], items)
    empty = rows(D.contamination(odd, bench.limit(0)))
    assert len(empty) == odd.count() and not any(r["n_hit"] or r["contaminated"] for r in empty)
    assert rows(D.contamination(odd.limit(0), bench)) == []


def test_blocks_agree_with_one(spark, monkeypatch):
    items = [(i, f"alpha{i} beta gamma{i}") for i in range(9)]
    docs = [" ".join(f"alpha{i} beta gamma{i}" for i in range(j)) for j in range(9)]
    one = check(spark, docs, items)
    monkeypatch.setattr(D, "BLOCK_BYTES", 40)
    assert check(spark, docs, items) == one


def test_proximity(spark):
    item = " ".join(f"p{i}" for i in range(13))
    moved = item.replace("p6", "between p6")      # one word more: no phrase, but near
    got = check(spark, [item, moved, item.replace("p6", "other"), "p0 p1"], [(5, item)])
    assert [r["near_items"] for r in got] == [[], ["5"], ["5"], []]


def test_proximity_does_not_depend_on_shards(spark):
    """A passage with a replaced word is near, wherever the missing word is."""
    item = " ".join(f"p{i}" for i in range(13))
    other = item.replace("p6", "other")
    bench = spark.createDataFrame([(5, item, 0), (6, "q1 the q2 q3 q4 q5", 0)], ITEMS)
    cut = " ".join(item.split()[2:])              # starts before the document
    texts = [other, "p6 " * 40, "nothing", cut, "the " * 9, f"x {other}"]
    want = [["5"], [], [], ["5"], [], ["5"]]

    def near(order, parts):
        docs = frame(spark, [texts[i] for i in order], order).repartition(parts)
        got = {r["doc_id"]: (r["near_items"], r["n_hit"]) for r in rows(D.contamination(docs, bench))}
        return [got[i] for i in range(len(texts))]

    texts[1] += " p0 p1 " * 30                    # the rarest are others than p0, p1 and p6
    for parts in (1, 3, 6):
        for order in (list(range(6)), list(range(6))[::-1]):
            assert near(order, parts) == [(w, 0) for w in want]
    # a word that the corpus has nowhere is a missing one like any other
    gone = frame(spark, [other, "p0 p1"])
    assert [r["near_items"] for r in sorted(rows(D.contamination(gone, bench)), key=lambda r: r["doc_id"])] == [["5"], []]


def test_clean_documents(spark, odd):
    bench = spark.createDataFrame([(1, "same text here for all of us", 0)], ITEMS)
    kept = D.clean_documents(odd, bench)
    assert kept.columns == odd.columns
    assert sorted(map(str, rows(kept))) == sorted(str(r) for r in rows(odd) if "same" not in (r["text"] or ""))


@needs_data
def test_whole_table(spark, documents):
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    got = {r["doc_id"]: r for r in rows(D.contamination(documents, bench).withColumn("h", D.items_digest()))}
    data = rows(documents)
    for r, (n, h, items) in zip(data, brute([r["text"] for r in data], [tuple(x) for x in bench.collect()])):
        g = got[r["doc_id"]]
        assert (g["n_words"], g["n_hit"], g["items"]) == (n, h, items)
        assert g["h"] == hashlib.sha256(",".join(items).encode()).hexdigest()


@needs_data
def test_near_items_are_a_result(spark, documents):
    from shelfrisk.llm.registry import QUERIES

    got = rows(QUERIES["op4_proximity"](spark, "/root/testdata/sf0.01"))
    assert len(got) == documents.count() and all(r["n_near_items"] == len(r["near_items"]) for r in got)


def near_brute(text, query):
    """Whether a place exists at which enough words stand close to where they belong."""
    w, q = words(text), words(query)
    for s in range(max(1, len(q) - 12) if q else 0):
        win = q[s:s + 13]
        least = len(win) - len(win) * 2 // 13
        for p in range(-16, len(w) + 4):
            if sum(v in w[max(0, p + j - 3):max(0, p + j + 4)] for j, v in enumerate(win)) >= least:
                return True
    return False


def exact_brute_ids(text, items):
    return {i for i, t in items if str(i) in brute([text], [(i, t)])[0][2]}


def test_proximity_against_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    pool = [f"v{i}" for i in range(30)]
    items = [(i, " ".join(rng.choices(pool, k=rng.choice([2, 6, 7, 13, 14, 20])))) for i in range(12)]
    docs = [""]
    for i, t in items * 4:
        q = t.split()
        for _ in range(rng.randint(0, 4)):               # replace, remove, insert, swap
            at = rng.randrange(len(q))
            kind = rng.randrange(4)
            q[at:at + 2 - (kind < 3)] = ([rng.choice(pool)], q[at:at + 1][:len(q) < 2], [rng.choice(pool), q[at]], q[at:at + 2][::-1])[kind]
        docs.append(" ".join(rng.choices(pool, k=rng.randint(0, 20)) + q + rng.choices(pool, k=rng.randint(0, 9))))
    docs += [" ".join(rng.choices(pool, k=200)) for _ in range(5)]
    want = [sorted(str(i) for i, t in items if near_brute(d, t) and i not in exact_brute_ids(d, items)) for d in docs]
    assert sum(map(bool, want)) > 10 and not all(want)
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], ITEMS)

    def near(parts):
        got = rows(D.contamination(frame(spark, docs).repartition(parts), bench))
        return [r["near_items"] for r in sorted(got, key=lambda r: r["doc_id"])]

    assert near(1) == want
    monkeypatch.setattr(D, "CANDIDATES", 7)
    monkeypatch.setattr(D, "BLOCK_BYTES", 60)
    monkeypatch.setattr(D, "SHARD_BYTES", 300)
    assert near(4) == want


def test_all_words_are_compared(spark):
    """Shared rare words are not enough, and any two words may be missing."""
    item = " ".join(f"p{i}" for i in range(13))
    p = item.split()
    rare = " ".join(p[:5] + ["totally", "different", "words", "go", "on", "here", "and", "there"])
    two = [" ".join("new" if j in (a, b) else v for j, v in enumerate(p)) for a, b in ((0, 1), (0, 12), (5, 7), (11, 12))]
    three = " ".join("new" if j in (1, 5, 9) else v for j, v in enumerate(p))
    docs = [rare, three, *two, " ".join(f"p{i} filler" for i in range(5, 13)) * 9]
    bench = spark.createDataFrame([(5, item, 0)], ITEMS)
    got = sorted(rows(D.contamination(frame(spark, docs), bench)), key=lambda r: r["doc_id"])
    assert [r["near_items"] for r in got] == [[], []] + [["5"]] * 4 + [[]]


def test_benchmark_stays_in_tasks(spark, odd):
    """The plan of the search neither broadcasts nor collects the benchmark."""
    bench = spark.createDataFrame([(1, "same text here for all of us", 0)], ITEMS)
    plan = D.contamination(odd, bench)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "BroadcastNestedLoop" not in plan


def test_clashing_names(spark):
    docs = frame(spark, ["same text here for all of us", "another text"])
    for c in ("__id", "__bad", "__key", "shard", "AT", "items"):
        docs = docs.withColumn(c, docs["node"] + 41)
    kept = D.clean_documents(docs, spark.createDataFrame([(1, "same text here for all of us", 0)], ITEMS))
    assert kept.columns == docs.columns and rows(kept) == rows(docs.where("doc_id = 1"))
