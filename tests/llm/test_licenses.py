from __future__ import annotations

import random
import re
from re import _constants as C
from re import _parser

from shelfrisk.llm import licenses as L

from .conftest import frame, needs_data, rows, words

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def base(text):
    """Places by comparing words one by one."""
    w = words(text)
    at = [(i, label) for phrase, label in BASE.items() for i in range(len(w))
          if w[i:i + len(phrase.split())] == phrase.split()]
    return (len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None),
            ",".join(sorted({label for _, label in at})))


def kept(text):
    """All rules on all of the text, then the suppression, in plain Python."""
    low = text.lower()
    blanks = re.sub(L.MARKS, " ", low, flags=re.ASCII)
    found = sorted((m.start(), -m.end(), i) for i, r in enumerate(L.rules()) if r.keyword in blanks
                   for m in re.finditer(r.pattern, low, re.ASCII))
    out = []
    for s, e, i in found:
        if not out or s >= out[-1][1]:
            out.append((s, -e, i))
        elif -e > out[-1][1] and i < out[-1][2]:
            out[-1] = (s, -e, i)
    return [(s, e, L.rules()[i].label) for s, e, i in out]


def check(data, got):
    for r, g in zip(data, got):
        text = r["text"] or ""
        assert (g["n_words"], g["n_base"], g["first_word"], g["last_word"], g["base_labels"]) == base(text), text[:200]
        if any(h in text.lower() for h in L.HINTS):
            assert [(m["start"], m["end"], m["label"]) for m in g["matches"]] == kept(text)
            labels = {m["label"] for m in g["matches"]} | set(filter(None, g["base_labels"].split(",")))
            assert g["labels"] == ",".join(sorted(labels))
        else:
            assert kept(text) == [] == g["matches"] and g["labels"] == ""
        assert 0 <= g["score"] <= 1 and (g["score"] > 0) == bool(g["labels"])


TEXTS = [
    "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.",
    "cc   by cc.by CC\nBY ccby cc-byx éCC by", "All rights\treserved. ALL RIGHTS RESERVED all right reserved",
    "general  public license general public Kicense", "Released under the MIT License\nCopyright (c) 2020 X",
    "Licensed under the Apache License, Version 2.0. Apache Software License 2.0", "mit license mit-style license",
    "GNU Lesser General Public License v2.1 or later; GNU Affero General Public License",
    "SPDX-License-Identifier: BSD-3-Clause", "two-clause BSD licence, BSD\nLICENSE provided 'as is'", "all rights reserved" * 3,
    "cc by " * 2000, "nothing here at all", "Creative Commons Attribution-ShareAlike 4.0 and cc0 1.0",
]


def test_rules_are_many_and_ordered():
    table = L.rules()
    assert len(table) >= 250 and len({r.pattern for r in table}) == len(table)


def test_against_plain_python(spark):
    df = frame(spark, TEXTS)
    check([{"text": t} for t in TEXTS], sorted(rows(L.scan(df)), key=lambda r: r["doc_id"]))


def ungated(text):
    """The same without keywords: every rule on every text."""
    low = text.lower()
    out = []
    for s, e, i in sorted((m.start(), -m.end(), i) for i, r in enumerate(L.rules())
                          for m in re.finditer(r.pattern, low, re.ASCII)):
        if not out or s >= out[-1][1]:
            out.append((s, -e, i))
        elif -e > out[-1][1] and i < out[-1][2]:
            out[-1] = (s, -e, i)
    return [(s, e, L.rules()[i].label) for s, e, i in out]


def sample(tree, rng):
    """A text that an expression matches, its alternatives chosen at random."""
    out = ""
    for op, arg in tree:
        if op is C.LITERAL:
            out += chr(arg)
        elif op is C.IN:
            kind, x = rng.choice(arg)
            out += ({C.CATEGORY_SPACE: " \n\t", C.CATEGORY_DIGIT: "0479"}[x][rng.randrange(3)] if kind is C.CATEGORY
                    else chr(rng.randint(*x) if kind is C.RANGE else x))
        elif op is C.NOT_LITERAL:
            out += "x" if arg != ord("x") else "y"
        elif op is C.BRANCH:
            out += sample(rng.choice(arg[1]), rng)
        elif op is C.MAX_REPEAT:
            out += "".join(sample(arg[2], rng) for _ in range(rng.randint(arg[0], min(arg[1], arg[0] + 1))))
        elif op is C.SUBPATTERN:
            out += sample(arg[-1], rng)
        else:
            assert op is C.ASSERT_NOT, op
    return out


def samples(n):
    rng = random.Random(9)
    trees = [(r, _parser.parse(r.pattern, re.ASCII)) for r in L.rules()]
    return [(r, sample(tree, rng)) for r, tree in trees for _ in range(n)]


def test_no_keyword_hides_a_rule():
    """What a rule matches holds its keyword and a hint, whichever alternative."""
    for r, text in samples(40):
        assert re.fullmatch(r.pattern, text, re.ASCII), (r, text)
        assert r.keyword in re.sub(L.MARKS, " ", text, flags=re.ASCII) and any(h in text for h in L.HINTS), (r, text)


def test_no_gate_hides_a_rule():
    """What a rule matches holds its one hint and the literals beside its keyword; most rules ask for some."""
    for r, text in samples(20):
        low = re.sub(L.MARKS, " ", text, flags=re.ASCII)
        assert r.hint in low and all(x in low for x in r.needs), (r, text)
    assert sum(bool(r.needs) and bool(r.hint) for r in L.rules()) > 250
    assert L.literals(r"mit(?:[ -]style)? licen[sc]e") == ("e", "licen", "mit")
    assert L.literals(r"x?y\+z a/b[ab]|[cd]y\+z a/b") == ("y+z a b",)
    assert L.starts(r"(?:gnu )?(?:lesser|xy)?(?:a|\(b)c|de") == set("glxa(d")


def test_blanks_are_replaced_once_a_text(spark, odd):
    """Not again for each keyword that is looked for."""
    plan = L.scan(odd)._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"[Cc]ontains\(regexp_replace", plan)


def test_many_matches_and_marks(spark):
    """Folds in blocks, and texts that hold the characters put around matches."""
    texts = [f"{'x' * (n % 7)} mit license, gpl-2 " * n for n in (1, 128, 129, 256, 257, 1025)]
    texts += [f"{L.OPEN}mit{L.CLOSE} license {L.CLOSE}mit license{L.OPEN} CC{L.OPEN}by", L.OPEN * 3 + "gpl" + L.CLOSE, "\U0001F600 mit license \U0001F600"]
    check([{"text": t} for t in texts], sorted(rows(L.scan(frame(spark, texts))), key=lambda r: r["doc_id"]))


def test_gated_scan_against_all_rules(spark):
    texts = [f"See: {text}." for _, text in samples(1)] + ["under the GNU Library General Public License version 2"]
    got = sorted(rows(L.scan(frame(spark, texts))), key=lambda r: r["doc_id"])
    for text, g in zip(texts, got):
        assert [(m["start"], m["end"], m["label"]) for m in g["matches"]] == ungated(text), text
    assert [m["label"] for m in got[-1]["matches"]] == ["lgpl-2"]


#: Lines as they stand in files, and the labels that a scan gives.
REAL = [
    ("// SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception", "apache-2-llvm"), ("/* SPDX-License-Identifier: GPL-2.0-or-later */", "gpl-2"),
    ("# SPDX-License-Identifier: LicenseRef-Acme-1", "spdx"), ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3"),
    (" * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as"
     " published by\n * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.", "gpl-3"),
    ("# This library is free software; you can redistribute it and/or\n# modify it under the terms of the GNU Lesser General Public\n"
     "# License as published by the Free Software Foundation; either\n# version 2.1 of the License, or (at your option) any later version.", "lgpl-2.1"),
    ("it under the terms of the GNU Affero General Public License, version 3", "agpl-3"), ("released under GPLv2 or later", "gpl-2"),
    ("You should have received a copy of the GNU General Public License along with this", "gpl"), ("LGPL-2.1+", "lgpl-2.1"),
    ("Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.", "gnu"),
    ("Licensed under the Apache License, Version 2.0 (the \"License\");", "apache-2"),
    ("you may not use this file except in compliance with the License.", "apache-2"), ("Apache Software License 1.1", "apache-1.1"),
    ("//\n// Unless required by applicable law or agreed to in writing, software\n// distributed under the License is", "apache-2"),
    ("http://www.apache.org/licenses/LICENSE-2.0", "apache-2"), ("https://opensource.org/licenses/MIT", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated files", "mit"),
    ("Permission is hereby granted, free of charge, to any person or organization\nobtaining a copy of the software", "boost-1"),
    ("The above copyright notice and this permission notice shall be included in all copies", "mit"),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted", "isc"),
    ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that", "bsd"),
    ("   * Redistributions in binary form must reproduce the above copyright notice, this list", "bsd"),
    ("Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from"
     " this software without specific prior written permission.", "bsd-3"),
    ("All advertising materials mentioning features or use of this software must display the following acknowledgement: This product"
     " includes software distributed", "bsd-4"), ("the three-clause BSD license", "bsd-3"), ("new BSD License", "bsd-3"),
    ("This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0.", "mpl-2"), ("https://mozilla.org/MPL/2.0/", "mpl-2"),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License", "epl"),
    ("Eclipse Public License - v 2.0", "epl"), ("Eclipse Public License v2.0", "epl-2"),
    ("Permission is granted to anyone to use this software for any purpose,\nincluding commercial applications", "zlib"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"), ("https://unlicense.org", "unlicense"),
    ("has dedicated the work to the public domain by waiving all of his or her rights", "cc0"), ("Do What The Fuck You Want To Public License", "wtfpl"),
    ("CC BY-NC-SA 4.0", "cc-by,cc-by-nc-sa"), ("https://creativecommons.org/licenses/by-sa/4.0/", "cc-by-sa"),
    ("Creative Commons Attribution-ShareAlike 3.0", "cc-by-sa"), ("Creative Commons Attribution-NonCommercial-NoDerivs", "cc-by-nc-nd"),
    ("Server Side Public License", "sspl"), ("Business Source License 1.1", "business-source"), ("Some rights reserved", "reserved"),
    ("Unauthorized copying of this file, via any medium, is strictly prohibited", "proprietary"), ("Copyright (C) 2019-2024 Someone", "copyright"),
    ("Proprietary and confidential", "proprietary"), ("(c) 2020", "copyright"), ("see LICENSE for details", "license-text"),
]

#: Near misses: texts with a hint and no label.
NEAR = [
    "a driving licence and a fishing license", "the general public was not amused, license or not", "apache helicopters need a licence",
    "permission was hereby refused", "she granted permission to use the car", "redistribution of wealth", "mitigating license fees",
    "gplay", "egpl v2x", "according to ccby", "copyright law of 1790", "(c) the third answer", "the domain is public", "unreserved seats",
    "eclipse of the sun, public holiday, licence", "the warranty card", "commercial television", "cc0x and cc byte", "python licensed handler",
    "mozilla foundation public statement on licences", "provided as if by magic", "distributed as islands", "www.example.org", "opensource.org/blog",
    "without warranting it", "all right, reserved", "the boost gauge is licensed", "bsd license2", "mit licensee", "spdx-license: mit",
]


def test_lines_of_real_files(spark):
    got = sorted(rows(L.scan(frame(spark, [t for t, _ in REAL]))), key=lambda r: r["doc_id"])
    for (text, labels), g in zip(REAL, got):
        assert set(g["labels"].split(",")) - set(g["base_labels"].split(",")) == set(labels.split(",")) - set(
            g["base_labels"].split(",")), (text, g["labels"])


def test_near_misses(spark):
    got = sorted(rows(L.scan(frame(spark, NEAR))), key=lambda r: r["doc_id"])
    for text, g in zip(NEAR, got):
        assert g["labels"] == "" and g["score"] == 0, (text, g["labels"])
        assert any(h in text for h in L.HINTS), text


def test_containment_and_priority(spark):
    one, two = sorted(rows(L.scan(frame(spark, [TEXTS[0], TEXTS[1]]))), key=lambda r: r["doc_id"])
    assert "gpl-3" in one["labels"].split(",") and "gpl" in one["labels"].split(",")
    assert two["labels"] == "cc-by,cc-by-nc"


def test_odd_rows(spark, odd):
    got = rows(L.scan(odd))
    assert len(got) == odd.count()
    order = lambda r: (str(r["doc_id"]), len(words(r.get("text"))) if "text" in r else r["n_words"])
    check(sorted(rows(odd), key=order), sorted(got, key=order))
    assert rows(L.scan(odd.limit(0))) == []


def test_native(spark, odd):
    plan = L.scan(odd)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@needs_data
def test_whole_table(spark, documents):
    data = sorted(rows(documents), key=lambda r: r["doc_id"])
    check(data, sorted(rows(L.scan(documents)), key=lambda r: r["doc_id"]))
