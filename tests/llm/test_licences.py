import random
import re

from spotgrid.llm import licences, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places = [(i, label) for phrase, label in licences.PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


CASES = [(1, None), (2, ""), (3, "CC-BY cc by CC BY 4.0"), (4, "GNU General Public License, all rights reserved. All Rights\nReserved"), (5, "cc é by"), (6, "ccby cc"),
         (7, "x " * 40_000 + "all rights reserved"), (8, "the general public general public license"), (8, "the general public general public license"), (None, "a\x7fb{c}é")]


def test_phrases(documents):
    got = licences.scan_licences(documents(CASES)).collect()
    assert len(got) == len(CASES)
    for r in got:
        assert tuple(r)[1:6] == plain(next(t for i, t in CASES if i == r.doc_id))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels
        assert 0 <= r.score <= 1
    assert licences.scan_licences(documents([])).collect() == []


def test_phrases_in_random_text():
    rng, scanner = random.Random(6), licences.LicenceScanner()
    vocabulary = ["cc", "by", "general", "public", "license", "all", "rights", "reserved", "the", "gnu", "zzz"]
    for _ in range(400):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))
        assert scanner.judge(text)[:5] == plain(text)


def test_matching_statistics():
    """Every step gives the longest run of words ending here that stands in a template."""
    rng = random.Random(8)
    sequences = [[rng.randint(0, 3) for _ in range(rng.randint(1, 25))] for _ in range(6)]
    runs = {tuple(s[i:j]): None for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    automaton, text = licences.SuffixAutomaton(sequences), [rng.randint(0, 3) for _ in range(600)]
    state = matched = 0
    for i, word in enumerate(text):
        state, matched = automaton.step(state, matched, word)
        want = max((n for n in range(min(i + 1, 25) + 1) if not n or tuple(text[i + 1 - n : i + 1]) in runs), default=0)
        assert matched == want
        if matched:
            ends = [(s, e) for s, q in enumerate(sequences) for e in range(matched - 1, len(q)) if q[e + 1 - matched : e + 1] == text[i + 1 - matched : i + 1]]
            assert automaton.ends[state] == sorted(ends)


def test_templates_are_found_with_gaps_and_edits():
    scanner = licences.LicenceScanner()
    for label, words in licences.TEMPLATES:
        assert label in scanner.judge(f"some text {words.title()} more text")[5].split(",")
    notice = dict(licences.TEMPLATES)["bsd"].split()
    notice[6] = "any"
    assert scanner.judge(" ".join(notice))[5] == "bsd"
    assert scanner.judge("licensed under the terms that apply to the software")[5] == ""
    assert scanner.judge("Permission is hereby granted")[5] == ""
    spans = scanner.judge("zzz Released under the MIT License. zzz")[7]
    assert [(s["first"], s["end"], s["label"]) for s in spans] == [(1, 6, "mit")]


def test_neighbours_are_told_apart():
    judge = licences.LicenceScanner().judge
    cc = "This work is licensed under a Creative Commons {} 4.0 International License."
    cases = {
        cc.format("Attribution"): "cc-by", cc.format("Attribution-NonCommercial"): "cc-by-nc", cc.format("Attribution-ShareAlike"): "cc-by-sa",
        cc.format("Attribution-NoDerivatives"): "cc-by-nd", cc.format("Attribution-NonCommercial-NoDerivatives"): "cc-by-nc-nd",
        cc.format("Attribution-Non-Commercial-Share-Alike"): "cc-by-nc-sa",
        "Licensed under CC BY-NC-ND 4.0": "cc-by,cc-by-nc-nd", "Licensed under CC BY-NC-SA 4.0": "cc-by,cc-by-nc-sa", "Licensed under CC BY-NC 4.0": "cc-by,cc-by-nc",
        "Licensed under the GNU Lesser General Public License version 3": "gpl,lgpl-3.0", "Licensed under the GNU Affero General Public License version 3": "agpl-3.0,gpl",
        "Licensed under the GNU General Public License, version 2": "gpl,gpl-2.0", "Licensed under the GNU General Public License, version 3": "gpl,gpl-3.0",
        "Licensed under the GNU General Public License, version 1": "gpl", "Licensed under the GNU Lesser General Public License version 2.1": "gpl,lgpl-2.1",
        "SPDX-License-Identifier: Apache-2.0": "apache-2.0", "SPDX-License-Identifier: MIT": "mit", "// SPDX-License-Identifier: GPL-2.0-only": "gpl-2.0",
        "Licensed under the Apache License, Version 1.1": "",
    }
    for text, want in cases.items():
        assert judge(f"zzz {text} zzz")[5] == want, text
    for label in ("agpl", "lgpl"):
        notice = next(w for x, w in licences.TEMPLATES if x == label)
        assert judge(notice)[5] == f"{label},gpl" if label == "agpl" else "gpl,lgpl"


def test_spans_inside_larger_ones_go():
    rng = random.Random(9)
    for _ in range(300):
        spans = [(i, a := rng.randint(0, 20), a + (n := rng.randint(1, 9)), rng.randint(1, n)) for i in range(rng.randint(0, 8))]
        kept = licences._outermost(spans)
        assert len(set(kept)) == len(kept) and set(kept) <= set(spans)
        for span in set(spans) - set(kept):
            assert any(o[1] <= span[1] and span[2] <= o[2] and span[3] < o[3] for o in spans)


def test_query(spark, sf, sf_docs):
    texts = {r.doc_id: r.text for r in sf_docs.collect()}
    for r in queries.op5_licence_scan(spark, sf).collect():
        assert tuple(r)[1:6] == plain(texts[r.doc_id])
        for line, label in (("Apache License, Version 2.0", "apache-2.0"), ("MIT License", "mit"), ("GNU General Public License, version 3", "gpl-3.0"), ("CC BY-NC 4.0", "cc-by-nc")):
            assert (line in texts[r.doc_id]) <= (label in r.labels.split(","))
