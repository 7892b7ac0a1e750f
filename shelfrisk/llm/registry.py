"""Queries of the training-data operators over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, decontaminate, fingerprint, licenses, mixing, near_dup, packing, quality, secrets, simhash, spelling,
               token_counts, vector_codes)
from .scratch import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"))
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.read_back(chat.format_turns(turns)).drop("valid")


def op2_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"))


def op3_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(4)) == 2
    weights = quality.train(docs, table(spark, sf, "labels").where(~held_out))
    return (quality.score(docs, weights, ("doc_id",), "text")
            .select("doc_id", held_out.alias("held_out"), F.col("__score").alias("score"),
                    (F.col("__score") >= quality.ACCEPT).cast("int").alias("predicted")))


def op4_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        decontaminate.items_digest().alias("items_sha256"), "contaminated")


def op4_proximity(spark: SparkSession, sf: str) -> DataFrame:
    """The items near each document, without those that it holds exactly."""
    found = decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", F.size("near_items").cast("long").alias("n_near_items"), "near_items")


def op5_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf, "documents")).drop("node")


def op6_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf, "documents"))


def op7_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.scan(table(spark, sf, "documents"))


def op8_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf, "documents"))


def op9_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(table(spark, sf, "documents")).drop("matches")


def op10_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprint.compare_with_next(table(spark, sf, "documents"))


def op11_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.components(table(spark, sf, "documents"))


def op12_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf, "embeddings"))


def op13_spelling(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(table(spark, sf, "documents"))


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_chat_format, op2_packing, op3_quality, op4_decontamination, op4_proximity, op5_near_duplicates, op6_mixing, op7_secrets,
    op8_token_counts, op9_licenses, op10_fingerprints, op11_simhash, op12_vector_codes, op13_spelling, pipeline)}

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

def _vector_codes_sql(rounds: int = 4) -> str:
    """Plain product codes: every part against every entry in each round."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS (SELECT r, p, min(struct_pack(d := d, e := e)) AS best FROM (
  SELECT x.r, x.p, c.e, sum((x.v - c.v) * (x.v - c.v)) AS d FROM x JOIN c{k} c USING (p, pos) GROUP BY ALL) GROUP BY ALL)""")
        if k < rounds:
            steps.append(f"""c{k + 1} AS (SELECT p, e, pos, CASE WHEN n IS NULL THEN c.v ELSE (s - ((s % n) + n) % n) // n END AS v
  FROM c{k} c LEFT JOIN (SELECT p, best.e AS e, pos, sum(v) AS s, count(*) AS n FROM a{k} JOIN x USING (r, p) GROUP BY ALL) USING (p, e, pos))""")
    return f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, len(embedding) // 4 AS w,
    list_transform(embedding, lambda y: floor(1024 * y::DOUBLE)::HUGEINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
x AS (SELECT r, (i - 1) // w AS p, (i - 1) % w AS pos, v[i] AS v FROM (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM kept)),
c0 AS (SELECT p, r - 1 AS e, pos, v FROM x WHERE r <= 256),
{(',' + chr(10)).join(steps)},
books AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY p, e, pos)) AS h FROM c{rounds}),
coded AS (SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d) AS error FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error::BIGINT AS error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM kept JOIN coded USING (r), books"""


ORACLE: dict[str, str] = {
    "op1_chat_format": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<turn>') + length(regexp_replace(role, '(\\|<turn>|</turn>|### |\n)', '\\\1', 'g')) + 1
      + length(regexp_replace(text, '(\\|<turn>|</turn>|### )', '\\\1', 'g')) + length('</turn>') + 1)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id""",
    "op4_decontamination": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '{WORD}') AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({LOWER}, '{WORD}') AS w FROM benchmark),
bw AS (SELECT item, len(w) AS n, unnest(CASE WHEN len(w) >= 13 THEN list_transform(range(1, len(w) - 11), lambda i: w[i:i + 12])
                                             WHEN len(w) > 0 THEN [w] ELSE [] END) AS win FROM b),
win AS (SELECT DISTINCT item, array_to_string(win, ' ') AS win, len(win) AS k FROM bw),
ks AS (SELECT DISTINCT k FROM win),
dw AS (SELECT r, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: {{'place': i, 'win': array_to_string(w[i:i + k - 1], ' ')}})) AS x
       FROM d, ks WHERE len(w) >= k),
hit AS (SELECT dw.r, dw.x.place AS place, dw.k, win.item FROM dw JOIN win ON dw.x.win = win.win AND dw.k = win.k),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(place, place + k)) AS p FROM hit) GROUP BY r),
it AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN it USING (r)""",
    "op12_vector_codes": _vector_codes_sql(),
    # words by deletion: equal lengths are near if they agree without one code point, others if one is the other without one
    "op13_spelling": rf"""
WITH crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c FROM range(256) r(i))),
runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all({LOWER}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
byte AS (SELECT id, run, count(*) AS n, hex(encode(id || ':' || run)) AS x FROM runs WHERE length(run) >= 6 GROUP BY ALL),
checked AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, length(x) // 2), lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h FROM byte, crc),
words AS (SELECT w, sum(n)::BIGINT AS n FROM (SELECT n, CASE WHEN h % 199 = 0
    THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS w FROM checked)
  WHERE length(w) >= 6 GROUP BY w HAVING sum(n) >= 5),
cut AS (SELECT w, n, i, substr(w, 1, i - 1) || substr(w, i + 1) AS rest FROM (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM words)),
near AS (SELECT a.w, a.n, b.w AS v, b.n AS m FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.w <> b.w
  UNION SELECT cut.w, cut.n, words.w, words.n FROM cut JOIN words ON cut.rest = words.w
  UNION SELECT words.w, words.n, cut.w, cut.n FROM cut JOIN words ON cut.rest = words.w),
best AS (SELECT w, count(*) AS n_near, arg_min(v, (-m, v)) AS v, max(m) AS m FROM (SELECT DISTINCT * FROM near) GROUP BY w),
forms AS (SELECT words.w, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN v END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n
  FROM words LEFT JOIN best USING (w)),
path AS (WITH RECURSIVE step(w, root) AS (SELECT w, w FROM forms UNION ALL SELECT step.w, f.form FROM step JOIN forms f ON f.w = step.root WHERE f.form IS NOT NULL)
  SELECT step.w, step.root FROM step JOIN forms f ON f.w = step.root WHERE f.form IS NULL)
SELECT w AS word, form, root, n, n_near, form_n FROM forms JOIN path USING (w)""",
}
