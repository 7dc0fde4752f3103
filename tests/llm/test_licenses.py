import itertools
import random
import re
from re import _parser

from tonality.llm import licenses as S


def brute_base(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    hits = [(i, lab) for i in range(len(w)) for ph, lab in S.BASE if w[i:i + len(ph.split())] == ph.split()]
    return len(w), len(hits), hits[0][0] if hits else None, hits[-1][0] if hits else None, ",".join(sorted({h[1] for h in hits}))


def test_base_columns_match_brute_force():
    r = random.Random(4)
    bits = ["MIT", "mit", "License", "license", "Apache", "general", "Public", "GNU", "été", "x1", "licenses", "submit", "日本"]
    seps = [" ", "  ", "-", "\n", "_", "|", "", "\x00", "."]
    for _ in range(600):
        t = "".join(r.choice(bits) + r.choice(seps) for _ in range(r.randint(0, 30)))
        g = S.scan_text(t)
        assert (g["n_words"], g["n_base"], g["first_word"], g["last_word"], g["base_labels"]) == brute_base(t), t


def test_there_are_hundreds_of_rules_and_gates_lose_nothing():
    assert len(S.rules()) > 250
    r = random.Random(8)
    parts = ["Licensed under CC BY-NC 4.0.", "Released under the MIT License.", "SPDX-License-Identifier: GPL-2.0-or-later", "see https://www.gnu.org/licenses/gpl-3.0.html",
             "under the terms of the GNU Lesser General Public License, version 2.1", "License: ISC", "all rights reserved", "plain words here", "BSD 3-Clause License", "Mozilla Public License 2.0", "the Unlicense", "SIL Open Font License"]
    everything = set(range(len(S.rules())))
    for _ in range(60):
        t = " ".join(r.choice(parts) for _ in range(r.randint(1, 40)))
        norm = S.normalise(t)
        want = S.detect(norm, everything)
        got = S.scan_text(t)["found"]
        assert [(g[0], g[1], g[5]) for g in got] == [(d[2].label, d[2].kind, norm[d[0]:d[1]]) for d in want]
        slow = []
        for d in sorted(((m.start(), m.end(), x) for x in S.rules() for m in x.find(norm)), key=lambda d: (d[2].order, d[0] - d[1], d[0])):
            if not any(k[0] <= d[0] and d[1] <= k[1] for k in slow):
                slow.append(d)
        assert [d[:2] for d in want] == sorted(d[:2] for d in slow)


def test_priority_and_containment():
    g = S.scan_text("This work is licensed under the GNU Lesser General Public License, version 2.1, and no other.")
    assert [(f[0], f[1]) for f in g["found"]] == [("lgpl-2.1", "grant")] and g["labels"] == "gpl,lgpl-2.1" and g["base_labels"] == "gpl"
    assert S.scan_text("Licensed under CC BY-NC 4.0.")["labels"] == "cc-by-nc"
    assert S.scan_text("Released under the MIT License.")["labels"] == "mit"
    assert S.scan_text("We commit a simple disc to the rubygems epilogue")["labels"] == ""


def test_defined_cases(spark):
    rows = [(1, None, "a"), (2, "", "b"), (None, "MIT license", "c"), (4, "Apache License, Version 2.0", None), (4, "Apache License, Version 2.0", None), (5, "word " * 50_000 + "mit license", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    out = S.scan(df).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(rows) and by[1].n_words == by[2].n_words == 0 and by[1].labels == "" and by[1].first_word is None
    assert by[4].labels == "apache,apache-2.0" and by[5].first_word == by[5].last_word == 50_000 and 0 < by[5].score <= 1
    assert {r.label for r in S.detections(df).collect()} == {"mit", "apache-2.0"}
    assert S.scan(df.limit(0)).collect() == []


def spellings(tokens):
    """Every string of a parsed regex; of an open repeat its shortest two, of a class its first character."""
    ways = []
    for op, arg in tokens:
        op = str(op)
        if op == "LITERAL":
            ways.append([chr(arg)])
        elif op == "IN":
            ways.append([chr(c) for kind, c in arg if str(kind) == "LITERAL"] or ["4"])
        elif op == "BRANCH":
            ways.append([x for part in arg[1] for x in spellings(part)])
        elif op == "SUBPATTERN":
            ways.append(list(spellings(arg[3])))
        elif op == "NOT_LITERAL":
            ways.append(["x"])
        elif op == "MAX_REPEAT":
            one = list(spellings(arg[2]))
            ways.append(["".join(x) for n in range(arg[0], min(arg[1], arg[0] + 1) + 1) for x in itertools.product(one, repeat=n)])
        else:
            assert op == "ASSERT_NOT", op
    return {"".join(x) for x in itertools.product(*ways)}


def test_gates_hold_for_every_spelling_of_every_rule():
    everything, seen = set(range(len(S.rules()))), 0
    for rule in S.rules():
        for text in spellings(_parser.parse(rule.find.__self__.pattern)):
            text = text.strip()
            assert any(k in text for k in rule.gates), (rule.label, rule.kind, text)
            if rule.kind in ("identifier", "page", "name", *S.TEXTS):  # the other forms have the gates of these
                want = [(d[2].label, d[2].kind, text[d[0]:d[1]]) for d in S.detect(text, everything)]
                assert want and rule.label in S.scan_text(text)["labels"].split(",") or rule.kind not in S.TEXTS, (rule.label, text)
                assert want and [(g[0], g[1], g[5]) for g in S.scan_text(text)["found"]] == want, text
                seen += 1
    assert seen > 500


def test_run_together_names():
    for text, label in (("Licensed under GPLv3.", "gpl-3.0"), ("Licensed under GPLv2.", "gpl-2.0"), ("MPLv2", "mpl-2.0"), ("under the AGPLv3", "agpl-3.0"),
                        ("AGPL v3", "agpl-3.0"), ("Open Data Commons Attribution License", "odc-by-1.0")):
        assert S.scan_text(text)["labels"] == label, text


def test_words_end_at_spaces_only():
    """Every character that can stand in a word, right before and after a phrase: the word is another one then."""
    for c in [chr(x) for x in range(0x80, 0x180)] + list("国日à\u2028\u3000"):
        for text in (f"voil{c}mit license", f"{c}apache license 2.0", f"mit license{c}", f"{c}gplv3", f"gplv3{c}"):
            assert S.scan_text(text)["labels"] == "", (c, text)
    assert S.scan_text("à mit license, 国")["labels"] == "mit"


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version {} of the License, or (at your option) any later version."""


def test_license_texts_without_a_name():
    assert len({pattern for *_, pattern in S.SIGNATURES}) == len(S.SIGNATURES) > 150
    assert S.scan_text(MIT)["labels"] == "mit" and S.scan_text(MIT)["base_labels"] == ""
    assert S.scan_text(GPL.format(3))["labels"] == "gpl,gpl-3.0" and S.scan_text(GPL.format(2))["labels"] == "gpl,gpl-2.0"
    bsd = "Neither the name of the ACME Company nor the names of its contributors may be used to endorse or promote products derived from this software"
    assert S.scan_text(bsd)["labels"] == "bsd-3-clause"
    assert S.scan_text("you may not use this file, and the software is provided as it is")["labels"] == ""
