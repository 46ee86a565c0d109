r"""Licence scan by a generalised suffix automaton.

The automaton is built over the words of all licence templates. A text's words stream through it and give, at every
word, the longest run ending there that stands in some template (matching statistics). Matches that can't be extended
are chained per template: a match joins a chain if it goes on where the chain ended, in the text and in the template,
with small gaps that hold no word which tells licences apart. A chain that covers enough of its template, and all of its
telling words if it is a short one, is a span with the template's label, unless it lies in a span that covers more words.

Short fixed phrases are templates too, and every place where one stands is counted: a phrase ends at a word if it is a
suffix of the match there, which the automaton's links tell.

Words are runs of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after A-Z are lower-cased, numbered from 0.

Defined cases: null text is empty and has no label; repeated rows give repeated results; an empty table gives none;
columns other than key and text are ignored. Words that no template has reset the match, so a text without licence
words costs little more than its words' lookup, however long it is.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from spotgrid.llm.batches import Field, map_text

#: Fixed phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Licence notices and the openings of licence texts: (label, words).
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the "
            "software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
            "distribute sublicense and or sell copies of the software"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you "
                   "may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published "
            "by the free software foundation"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as "
             "published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions "
            "are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("lgpl-2.1", "licensed under the gnu lesser general public license version 2 1"),
    ("lgpl-3.0", "licensed under the gnu lesser general public license version 3"),
    ("agpl-3.0", "licensed under the gnu affero general public license version 3"),
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as "
             "published by the free software foundation"),
    ("cc0", "no rights reserved"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("boost", "distributed under the boost software license version 1 0"),
)
#: Creative Commons licences: the short name, and the long one in its two spellings.
CREATIVE_COMMONS = (
    ("by", "attribution", "attribution"), ("by nc", "attribution noncommercial", "attribution non commercial"),
    ("by sa", "attribution sharealike", "attribution share alike"), ("by nd", "attribution noderivatives", "attribution no derivatives"),
    ("by nc sa", "attribution noncommercial sharealike", "attribution non commercial share alike"),
    ("by nc nd", "attribution noncommercial noderivatives", "attribution non commercial no derivatives"),
)
TEMPLATES += tuple((f"cc {name}".replace(" ", "-"), words) for name, *spellings in CREATIVE_COMMONS for words in (
    f"licensed under cc {name} 4 0", f"spdx license identifier cc {name} 4 0",
    *dict.fromkeys(f"this work is licensed under a creative commons {spelling} 4 0 international license" for spelling in spellings)))
#: Identifiers on a line of their own, as label and words.
TEMPLATES = tuple((label, f"spdx license identifier {words}") for label, words in (
    ("mit", "mit"), ("apache-2.0", "apache 2 0"), ("gpl-2.0", "gpl 2 0"), ("gpl-3.0", "gpl 3 0"), ("lgpl-2.1", "lgpl 2 1"), ("lgpl-3.0", "lgpl 3 0"),
    ("agpl-3.0", "agpl 3 0"), ("bsd", "bsd 2 clause"), ("bsd", "bsd 3 clause"), ("isc", "isc"), ("mpl-2.0", "mpl 2 0"), ("unlicense", "unlicense"), ("boost", "bsl 1 0"))) + TEMPLATES
#: Words that tell licences apart, as numbers do. A chain skips none of them, in the text or in the template.
TELLING = ("affero", "alike", "commercial", "derivatives", "lesser", "library", "nc", "nd", "no", "noderivatives", "non", "noncommercial", "sa", "share", "sharealike")
#: A match that is shorter than this doesn't enter a chain; a chain may skip so many words, in the text or in the template.
LEAST_MATCH = 3
GAP = 4
#: A chain counts if it covers this share of its template, or so many words of it.
LEAST_COVER = 0.85
LEAST_WORDS = 20

_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_TABLE).split()


def _tells(word: bytes) -> bool:
    return word.isdigit() or word.decode() in TELLING


def _outermost(spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Spans (template, first, end, covered) that don't lie inside one that covers more words."""
    kept: list[tuple[int, int, int, int]] = []
    end = covered = -1  # of the span so far that reaches farthest
    for span in sorted(spans, key=lambda s: (s[1], -s[2], -s[3])):
        if span[2] <= end and span[3] < covered:
            continue
        kept.append(span)
        if span[2] > end or span[3] > covered:
            end, covered = span[2], span[3]
    return kept


class SuffixAutomaton:
    """All runs of words of several sequences. State 0 is the empty run."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[list[tuple[int, int]]] = [[]]  # per state: (sequence, place of its last word)
        for number, sequence in enumerate(sequences):
            last = 0
            for place, word in enumerate(sequence):
                last = self._extend(last, word, ends)
                ends[last].append((number, place))
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            ends[self.link[state]].extend(ends[state])
        self.ends = [sorted(set(e)) for e in ends]

    def _state(self, length: int, link: int, moves: dict[int, int], ends: list) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        ends.append([])
        return len(self.length) - 1

    def _split(self, state: int, word: int, target: int, ends: list) -> int:
        """The part of ``target`` that ``state`` reaches: the target itself, or a shorter copy put before it."""
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]), ends)
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int, ends: list) -> int:
        if word in self.next[last]:
            return self._split(last, word, self.next[last][word], ends)
        new, state = self._state(self.length[last] + 1, 0, {}, ends), last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, word, self.next[state][word], ends)
        return new

    def step(self, state: int, matched: int, word: int) -> tuple[int, int]:
        """The longest match after one more word."""
        while state and word not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        return (self.next[state][word], matched + 1) if word in self.next[state] else (0, 0)


class LicenceScanner:
    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        texts = [*phrases, *((words, label) for label, words in templates)]
        self.labels, sequences, self.vocabulary = [label for _, label in texts], [], {}
        for words, _ in texts:
            sequences.append([self.vocabulary.setdefault(w.encode(), len(self.vocabulary)) for w in words.split()])
        self.telling = [[_tells(w.encode()) for w in words.split()] for words, _ in texts]
        self.sizes, self.n_phrases = [len(s) for s in sequences], len(phrases)
        self.automaton = SuffixAutomaton(sequences)
        # Of each state: the phrases that end where it ends, with the words that must have been matched.
        self.suffixes: list[tuple[tuple[int, int], ...]] = [()] * len(self.automaton.length)
        homes = {self._state_of(s): i for i, s in enumerate(sequences[: self.n_phrases])}
        for state in sorted(range(1, len(self.suffixes)), key=self.automaton.length.__getitem__):
            own = ((homes[state], self.sizes[homes[state]]),) if state in homes else ()
            self.suffixes[state] = self.suffixes[self.automaton.link[state]] + own

    def _state_of(self, sequence: list[int]) -> int:
        state = 0
        for word in sequence:
            state = self.automaton.next[state][word]
        return state

    def scan(self, text: str) -> tuple[int, list[tuple[int, int]], list[tuple[int, int, int, int]]]:
        """Number of words, places (start, phrase), and spans (template, first word, end, words covered)."""
        words = words_of(text)
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int32, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate([[False], ids >= 0, [False]]).astype(np.int8)))
        places, matches, step, least = [], [], self.automaton.step, min([LEAST_MATCH, *self.sizes])
        for low, high in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if high - low < least:
                continue
            state = matched = 0
            run = ids[low:high].tolist()
            for at, word in enumerate(run, low):
                before, had = state, matched
                state, matched = step(state, matched, word)
                if matched <= had and had >= LEAST_MATCH:
                    matches.append((at - had, at, before))
                for phrase, size in self.suffixes[state]:
                    if matched >= size:
                        places.append((at + 1 - size, phrase))
            if matched >= LEAST_MATCH:
                matches.append((high - matched, high, state))
        return len(words), places, self._chain(matches, words)

    def _chain(self, matches: list[tuple[int, int, int]], words: list[bytes]) -> list[tuple[int, int, int, int]]:
        """matches: (start, end, state) in order. The open chain of a template is [first, end, template end, covered, last match's start, skipped a telling word]."""
        chains: dict[int, list[int]] = {}
        done = []
        for start, end, state in matches:
            for number, last in self.automaton.ends[state]:
                from_, to = last + 1 - (end - start), last + 1
                chain = chains.get(number)
                if chain and (start, end) == (chain[4], chain[1]):
                    continue  # the same words elsewhere in the template
                tells = self.telling[number]
                if (chain and chain[1] - end < 0 and -GAP <= start - chain[1] <= GAP and 0 <= to - chain[2] and from_ - chain[2] <= GAP
                        and not any(_tells(w) for w in words[chain[1] : start])):
                    chain[3] += min(end - max(start, chain[1]), to - max(from_, chain[2]))
                    chain[5] |= any(tells[chain[2] : from_])
                    chain[1], chain[2], chain[4] = end, to, start
                else:
                    if chain:
                        done.append((number, chain))
                    chains[number] = [start, end, to, end - start, start, any(tells[:from_])]
        done += chains.items()
        return _outermost([(number, *chain[:2], chain[3]) for number, chain in done if self._counts(number, chain)])

    def _counts(self, number: int, chain: list[int]) -> bool:
        skipped = chain[5] or any(self.telling[number][chain[2] :])
        return chain[3] >= min(LEAST_WORDS, LEAST_COVER * self.sizes[number]) and not (skipped and self.sizes[number] <= LEAST_WORDS)

    def judge(self, text: str) -> tuple:
        n_words, places, spans = self.scan(text)
        base = sorted({self.labels[p] for _, p in places})
        spans = sorted((first, end, self.labels[t], min(1.0, covered / self.sizes[t])) for t, first, end, covered in spans)
        score = max([1.0 if places else 0.0, *(s[3] for s in spans)])
        starts = [s for s, _ in places]
        return (n_words, len(places), min(starts, default=None), max(starts, default=None), ",".join(base),
                ",".join(sorted({*base, *(s[2] for s in spans)})), score,
                [{"first": f, "end": e, "label": x, "cover": c} for f, e, x, c in spans])


FIELDS: list[Field] = [
    ("n_words", "long", pa.int64()), ("n_base", "long", pa.int64()), ("first_word", "long", pa.int64()), ("last_word", "long", pa.int64()),
    ("base_labels", "string", pa.string()), ("labels", "string", pa.string()), ("score", "double", pa.float64()),
    ("spans", "array<struct<first:long,end:long,label:string,cover:double>>",
     pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("cover", pa.float64())]))),
]


def scan_licences(docs: DataFrame, key: str = "doc_id", text: str = "text", templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """One row per document: key, the phrases' places and labels, all labels, the best cover and the covered spans."""
    return map_text(docs, key, text, FIELDS, lambda: LicenceScanner(templates, phrases).judge)
