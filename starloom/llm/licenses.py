"""Licence scan: a generalised suffix automaton of licence words reads every text once.

After each word the automaton knows the longest run of words that ends there and stands in any template: the matching
statistics. Phrases are found as suffixes of these runs. Long runs of one template that follow each other in the text
as they do in the template are chained into a covered span.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Fixed phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
# Notices as their licences ask to state them; a label is given where a chain covers enough of one.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
)
# Words of a run that counts, words that may stand between two runs, part of a template to be covered.
RUN, GAP, COVER = 3, 12, 0.75


def split(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


@dataclass
class Automaton:
    """States 0.. with transitions by word, suffix links, lengths, and per state the templates that hold its runs."""

    steps: list[dict[bytes, int]]
    links: list[int]
    lengths: list[int]
    ends: list[dict[int, int]]
    phrases: list[list[tuple[int, int]]]
    words: frozenset[bytes]

    @classmethod
    def of(cls, texts: list[list[bytes]], phrases: int) -> Automaton:
        """Of word lists, the first `phrases` of which are to be found exactly."""
        steps, links, lengths = [{}], [-1], [0]

        def add(last: int, word: bytes) -> int:
            if word in steps[last] and lengths[steps[last][word]] == lengths[last] + 1:
                return steps[last][word]
            clone_only, state = word in steps[last], len(steps)
            if not clone_only:
                steps.append({})
                lengths.append(lengths[last] + 1)
                links.append(0)
            p = last
            while p != -1 and word not in steps[p]:
                steps[p][word] = state
                p = links[p]
            if p == -1:
                return state
            q = steps[p][word]
            if lengths[q] == lengths[p] + 1:
                links[state] = q
                return state
            clone = len(steps)
            steps.append(dict(steps[q]))
            lengths.append(lengths[p] + 1)
            links.append(links[q])
            links[q] = clone
            if not clone_only:
                links[state] = clone
            while p != -1 and steps[p].get(word) == q:
                steps[p][word] = clone
                p = links[p]
            return clone if clone_only else state

        for words in texts:
            last = 0
            for word in words:
                last = add(last, word)
        ends: list[dict[int, int]] = [{} for _ in steps]
        found: list[set[tuple[int, int]]] = [set() for _ in steps]
        for t, words in enumerate(texts):
            state = 0
            for i, word in enumerate(words):
                state = up = steps[state][word]
                while up > 0 and t not in ends[up]:
                    ends[up][t] = i + 1
                    up = links[up]
            if t < phrases:
                found[state].add((len(words), t))
        for state in sorted(range(1, len(steps)), key=lengths.__getitem__):
            found[state] |= found[links[state]]
        return cls(steps, links, lengths, ends, [sorted(f) for f in found], frozenset(w for words in texts for w in words))

    def statistics(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(place, state, length of the longest run that ends there), for places where a run ends."""
        state, length, before = 0, 0, -2
        known = self.words
        for i in [i for i, w in enumerate(words) if w in known]:
            if i != before + 1:
                state = length = 0
            word, before = words[i], i
            while state and word not in self.steps[state]:
                state = self.links[state]
                length = self.lengths[state]
            if word in self.steps[state]:
                state, length = self.steps[state][word], length + 1
                yield i, state, length


@dataclass
class Scan:
    n_words: int
    places: list[tuple[int, int]]
    spans: list[tuple[int, int, int, float]]


def _chained(runs: list[tuple[int, int, int]], size: int) -> tuple[int, int, float] | None:
    """Of runs (first word, words, end in the template) in text order, the chain that covers most of the template."""
    chains: list[tuple[int, int, int, int]] = []  # covered, first word, end word, end in the template
    for start, n, end in runs:
        best = (n, start, start + n, end)
        for covered, first, last, at in chains[-8:]:
            overlap = max(0, last - start, at - (end - n))
            if start - last <= GAP and end > at and n > overlap and start + n > last and covered + n - overlap > best[0]:
                best = (covered + n - overlap, first, start + n, end)
        chains.append(best)
    if not chains:
        return None
    covered, first, last, _ = max(chains, key=lambda c: (c[0], -c[1]))
    return first, last, min(1.0, covered / size)


def scan(text: bytes, automaton: Automaton, sizes: list[int], phrases: int) -> Scan:
    words = split(text)
    places, runs, before = [], {}, None

    def close(i: int, state: int, length: int) -> None:
        if length >= RUN:
            for t, end in automaton.ends[state].items():
                if t >= phrases:
                    runs.setdefault(t, []).append((i - length + 1, length, end))

    for i, state, length in automaton.statistics(words):
        for n, t in automaton.phrases[state]:
            if n <= length:
                places.append((i - n + 1, t))
        if before and not (i == before[0] + 1 and length == before[2] + 1):
            close(*before)
        before = (i, state, length)
    if before:
        close(*before)
    chained = [(t, _chained(r, sizes[t])) for t, r in sorted(runs.items())]
    return Scan(len(words), places, [(t, *c) for t, c in chained if c])


@cache
def _automaton(texts: tuple[str, ...], phrases: int) -> tuple[Automaton, list[int]]:
    words = [split(t.encode()) for t in texts]
    return Automaton.of(words, phrases), [len(w) for w in words]


COLUMNS = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,first_word:long,end_word:long,cover:double>>"


def scanned(docs: DataFrame, phrases: tuple[tuple[str, str], ...] = PHRASES, templates: tuple[tuple[str, str], ...] = TEMPLATES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of `docs`: words, phrase places, labels, score and the template spans that are covered enough.

    A-Z count as lower case. Null and empty texts have no words, no labels and score 0. The score is 1 where a phrase
    stands, else the largest part of a template that a chain covers. Repeated rows are scanned each on its own; other
    columns are not used. Templates are a parameter of bounded size; the texts are read whole.
    """
    sources, labels = tuple(t for _, t in templates), [label for _, label in phrases] + [label for label, _ in templates]
    texts, count = (*(p for p, _ in phrases), *sources), len(phrases)

    def scan_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, sizes = _automaton(texts, count)
        for batch in batches:
            rows = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = scan(value or b"", automaton, sizes, count)
                base = sorted({labels[t] for _, t in s.places})
                spans = [(labels[t], first, last, cover) for t, first, last, cover in s.spans if cover >= COVER]
                score = 1.0 if base else max((c for *_, c in s.spans), default=0.0)
                starts = [p for p, _ in s.places]
                rows.append((doc, s.n_words, len(starts), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(sorted({*base, *(x[0] for x in spans)})), score, [dict(zip(("label", "first_word", "end_word", "cover"), x, strict=True)) for x in spans]))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("cover", pa.float64())]))]
            names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text")).mapInArrow(scan_all, COLUMNS)
