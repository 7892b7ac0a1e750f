"""License scans (operator 9), with DataFrame functions only.

Ordered signature rules (`signatures`): each is a regular expression written by
hand behind a keyword that its text must hold, and behind a hint and the literals
that stand in all that it matches.  All rules run on the whole text of a document
that has these; matches are intervals of characters.  A match inside another is
dropped (of equal intervals the rule of higher priority stays), and of two that
overlap otherwise the one of higher priority stays.  Beside the rules, the base
phrases are found as consecutive words anywhere in the text.

Nothing is shuffled: a row is scanned where it is read.  Defined cases: a null
text is empty, has no words and no labels; null and repeated ids are rows of
their own; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .signatures import SIGNATURES

# Letters of either case count as their small ones.  Characters one by one are one lookup for Java, ranges a chain of calls.
BETWEEN = "".join(chr(i) for i in range(128) if not chr(i).isalnum())
NO_WORD = "".join(rf"\x{ord(c):02X}" for c in BETWEEN)
WORD = f"[^{NO_WORD}]"
GAP = f"[{NO_WORD}]+"
BEFORE, AFTER = rf"(?<!{WORD})", rf"(?!{WORD})"

#: Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: A blank of an expression, the marks that a keyword's single blank stands for, and what <3> stands for.
BLANK = r"[\s*#/]+"
MARKS = r"[\s*#/-]+"
VERSION = r"(?: as published by the free software foundation)?(?:[,;:] ?| )?(?:either )?(?:version|v\.?)? ?{v}(?:\.0)?(?:(?: of the license)?,? or (?:any |\(at your option\) any )?later(?: version)?)?"

#: A text without any of these strings matches no rule and no base phrase.
HINTS = ("licen", "gpl", "wtfpl", "creative", "cc", "spdx", "domain", "permission", "redistribution", "provided", "distributed",
         "warrant", "copyright", "(c)", "reserved", "proprietary", "commercial", "advertising", "royalty",
         "prohibited", ".org")


#: Marks around matches, and what stands for such characters of a text: no expression tells the three apart.
OPEN, CLOSE, NEUTRAL = "\x01", "\x02", "\x03"

#: Folds append within blocks of this many items, as each step copies what it appends to.
BLOCK = 256


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str
    confidence: float
    needs: tuple[str, ...]    # beside the keyword, written as keywords are
    hint: str


def tokens(signature: str) -> list[str]:
    """Groups, classes, bars and single characters of a signature."""
    out, depth, at = [""], 0, 0
    while at < len(signature):
        c = signature[at]
        end = at + 2 if c == "\\" else signature.index("]", at) + 1 if c == "[" else at + 1
        depth += (c == "(") - (c == ")")
        out[-1] += signature[at:end]
        out += [""] if not depth else []
        at = end
    return out[:-1]


def starts(signature: str) -> set[str]:
    """Characters that a match of a signature may begin with."""
    parts = tokens(signature)
    if "|" in parts:
        at = parts.index("|")
        return starts("".join(parts[:at])) | starts("".join(parts[at + 1:]))
    first = starts(parts[0][3:-1]) if parts[0].startswith("(?:") else {parts[0].lstrip("\\")[0]}
    return first | starts("".join(parts[2:])) if parts[1:2] == ["?"] else first


def expression(signature: str) -> str:
    """The regular expression of a signature, between ends of words and numbers.
    Most places of a text fail at its beginning, so that is a word, which Java
    searches for by leaps, or a look at one character."""
    word = re.match("[a-z]{4,}(?![a-z?*+{])", signature) if "|" not in tokens(signature) else None
    body = re.sub("<([^<>]+)>", lambda m: VERSION.replace("{v}", m[1]), signature[word.end():] if word else signature)
    body = body.replace("[ -]?", f"(?:{MARKS})?").replace("[ -]+", MARKS).replace("[ -]", MARKS)
    body = body.replace(" ?", f"(?:{BLANK})?").replace(" ", BLANK)
    before = rf"{word[0]}(?<![a-z0-9]{word[0]})" if word else rf"(?![^{''.join(sorted(starts(signature)))}])(?<![a-z0-9])"
    return rf"{before}(?:{body})(?![a-z0-9]|\.[0-9])"


def literals(signature: str) -> tuple[str, ...]:
    """Strings that stand in whatever a signature matches, with single blanks
    for blanks, hyphens, slashes and comment marks: what is left of it without
    versions, groups, classes and characters that may be missing."""
    cut = "\0"
    text = re.sub(r"\\(.)", lambda m: chr(0xE000 + ord(m[1])), signature)        # escaped characters are no syntax
    text = re.sub("<[^<>]+>", cut, text)
    text = re.sub(r"\[[^\]]*\](?:[?*+]|\{[0-9,]+\})?", cut, text)
    while (less := re.sub(r"\(\?:[^()]*\)(?:[?*+]|\{[0-9,]+\})?", cut, text)) != text:
        text = less
    text = re.sub(r"[^\0][?*]", cut, text)
    text = re.sub("[\uE000-\uE07F]", lambda m: chr(ord(m[0]) - 0xE000) if m[0] != "\uE07C" else cut, text)
    ways = [{re.sub(MARKS, " ", run).strip() for run in way.split(cut)} for way in text.split("|")]
    return tuple(sorted(set.intersection(*ways) - {""}))


@lru_cache(maxsize=1)
def rules() -> list[Rule]:
    """All rules in order of priority."""
    out = []
    for label, confidence, keyword, signature in SIGNATURES:
        sure = [keyword, *literals(signature)]
        needs = tuple(x for x in sure[1:] if x != keyword and not any(x in y for y in sure if y != x))
        hint = max((h for h in HINTS if any(h in x for x in sure)), key=len, default="")     # of several, the rarest is likely the longest
        out.append(Rule(label, keyword, expression(signature), confidence, needs, hint))
    return out


def n_words(text: Column) -> Column:
    """Words become one letter each, with the gap after them; a gap before the first is taken off."""
    return F.length(F.ltrim(F.regexp_replace(text, f"{WORD}+(?:{GAP})?", "x"), F.lit(BETWEEN)))


def let(value: Column, use) -> Column:
    """``use(value)``, where ``value`` is computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def blocks(items: Column) -> Column:
    """A non-empty array cut into arrays of ``BLOCK`` items."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")),
                       lambda i: F.slice(items, i * BLOCK + 1, F.lit(BLOCK)))


SPAN, MATCH = "struct<start:int,end:int>", "struct<start:int,close:int,rule:int>"


def spans(text: Column, pattern: Column) -> Column:
    """(start, end) of each match.  One pass puts marks around the matches (the
    text has none); what lies between the marks is measured."""
    def step(acc, x):
        return F.struct((acc["at"] + x["p"] + x["m"]).alias("at"),
                        F.concat(acc["out"], F.array(F.struct((acc["at"] + x["p"]).alias("start"),
                                                              (acc["at"] + x["p"] + x["m"]).alias("end")))).alias("out"))

    def block(acc, xs):
        ends = F.aggregate(xs, F.struct(acc["at"].alias("at"), F.array().cast(f"array<{SPAN}>").alias("out")), step)
        return let(ends, lambda e: F.struct(e["at"].alias("at"), F.concat(acc["out"], F.array(e["out"])).alias("out")))

    def measured(parts):
        sizes = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda x: F.struct(
            (F.instr(x, OPEN) - 1).alias("p"), (F.length(x) - F.instr(x, OPEN)).alias("m")))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{SPAN}>>").alias("out"))
        return (F.when(F.size(parts) > 1, let(sizes, lambda s: F.aggregate(blocks(s), start, block, lambda acc: F.flatten(acc["out"]))))
                .otherwise(F.array().cast(f"array<{SPAN}>")))

    return let(F.split(F.regexp_replace(text, pattern, F.lit(f"{OPEN}$0{CLOSE}")), CLOSE, -1), measured)


def asked_rules(low: Column) -> Column:
    """Rules whose hint, keyword and literals the text holds: number, expression."""
    by_hint: dict[str, dict[str, list]] = {}
    for i, r in enumerate(rules()):
        by_hint.setdefault(r.hint, {}).setdefault(r.keyword, []).append(F.struct(
            F.lit(i).alias("rule"), F.lit(r.pattern).alias("pattern"),
            F.array(*map(F.lit, r.needs)).cast("array<string>").alias("needs")))
    table = F.array(*(F.struct(F.lit(h).alias("hint"), F.array(*(
        F.struct(F.lit(k).alias("keyword"), F.array(*v).alias("rules")) for k, v in keywords.items())).alias("keywords"))
        for h, keywords in by_hint.items()))

    def asked(words):
        hinted = F.flatten(F.transform(F.filter(table, lambda h: F.contains(words, h["hint"])), lambda h: h["keywords"]))
        keyed = F.flatten(F.transform(F.filter(hinted, lambda k: F.contains(words, k["keyword"])), lambda k: k["rules"]))
        return F.filter(keyed, lambda r: F.forall(r["needs"], lambda x: F.contains(words, x)))

    return let(F.regexp_replace(low, MARKS, " "), asked)        # keywords are written with single blanks


def kept_matches(low: Column, rules_asked: Column) -> Column:
    """Matches that stay: start, end, rule number."""
    free = F.replace(F.replace(low, F.lit(OPEN), F.lit(NEUTRAL)), F.lit(CLOSE), F.lit(NEUTRAL))
    found = let(free, lambda text: F.flatten(F.transform(rules_asked, lambda r: F.transform(
        spans(text, r["pattern"]),
        lambda m: F.struct(m["start"].alias("start"), (-m["end"]).alias("back"), r["rule"].alias("rule"))))))

    def state(out, last):
        return F.struct(out.alias("out"), last.alias("last"))

    def take(kept, m):
        last, match = kept["last"], F.struct(m["start"].alias("start"), (-m["back"]).alias("close"), m["rule"].alias("rule"))
        return (F.when(last.isNull(), state(kept["out"], match))
                .when(m["start"] >= last["close"], state(F.concat(kept["out"], F.array(last)), match))
                .when((-m["back"] > last["close"]) & (m["rule"] < last["rule"]), state(kept["out"], match))
                .otherwise(kept))

    def block(kept, ms):
        more = F.aggregate(ms, state(F.array().cast(f"array<{MATCH}>"), kept["last"]), take)
        return let(more, lambda x: state(F.concat(kept["out"], F.array(x["out"])), x["last"]))

    # by start, longest first, then priority: what lies inside a kept match comes after it
    start = state(F.array().cast(f"array<array<{MATCH}>>"), F.lit(None).cast(MATCH))
    return let(F.array_sort(found), lambda f: F.when(F.size(f) > 0, F.aggregate(
        blocks(f), start, block, lambda kept: F.concat(F.flatten(kept["out"]), F.array(kept["last"]))))
        .otherwise(F.array().cast(f"array<{MATCH}>")))


def scan(docs: DataFrame) -> DataFrame:
    """Per document: its words, base phrases (number, first and last start,
    labels), the rules' kept matches, all labels, and a score: the highest
    confidence of a kept match, 0.9 for a base phrase, else 0."""
    table = rules()
    phrase = {p: F.lit(BEFORE + GAP.join(p.split()) + AFTER) for p in BASE}
    any_phrase = F.lit(f"(?i)(?![^{''.join(sorted({p[0] for p in BASE}))}]){BEFORE}(?:{'|'.join(GAP.join(p.split()) for p in BASE)}){AFTER}")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    step = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("body"), F.lower(text).alias("low"))
    step = step.withColumn("asked", F.expr(" OR ".join(f"contains(low, '{h}')" for h in HINTS)))
    phrased = F.expr(" OR ".join(f"({' AND '.join(f"contains(low, '{w}')" for w in p.split())})" for p in BASE))
    step = (step
            .withColumn("n_words", n_words(F.col("body")).cast("long"))
            .withColumn("base", F.when(F.col("asked") & phrased, F.regexp_extract_all("body", any_phrase, F.lit(0))))
            .withColumn("parts", F.when(F.size("base") > 0, F.split("body", any_phrase, -1)))
            .withColumn("rules_asked", F.when(F.col("asked"), asked_rules(F.col("low"))))
            .withColumn("matches", F.when(F.size("rules_asked") > 0, kept_matches(F.col("low"), F.col("rules_asked")))
                        .otherwise(F.array().cast(f"array<{MATCH}>"))))
    said = F.transform("base", lambda m: F.lower(m))
    base_labels = F.array_compact(F.array(*(F.when(F.exists(said, lambda m: F.regexp_like(m, phrase[p])), F.lit(label))
                                            for p, label in BASE.items())))
    labels = F.array(*(F.lit(r.label) for r in table))
    weights = F.array(*(F.lit(r.confidence) for r in table))
    step = (step.withColumn("base_list", F.when(F.size("base") > 0, base_labels).otherwise(F.array().cast("array<string>")))
            .withColumn("rule_list", F.transform("matches", lambda m: F.element_at(labels, m["rule"] + 1)))
            .withColumn("rule_score", F.array_max(F.transform("matches", lambda m: F.element_at(weights, m["rule"] + 1)))))
    last = n_words(F.element_at("parts", -1)) + n_words(F.element_at("base", -1))
    return step.select(
        "doc_id", "n_words", F.when(F.size("base") > 0, F.size("base")).otherwise(0).cast("long").alias("n_base"),
        F.when(F.size("base") > 0, n_words(F.element_at("parts", 1))).cast("long").alias("first_word"),
        F.when(F.size("base") > 0, F.col("n_words") - last).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base_list")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base_list", "rule_list"))), ",").alias("labels"),
        F.greatest(F.coalesce("rule_score", F.lit(0.0)), F.when(F.size("base_list") > 0, 0.9).otherwise(0.0))
        .cast("double").alias("score"),
        F.transform("matches", lambda m: F.struct(m["start"].alias("start"), m["close"].alias("end"),
                                                  F.element_at(labels, m["rule"] + 1).alias("label"))).alias("matches"))
