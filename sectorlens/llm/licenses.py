"""License scans: phrases, and an exact set-similarity join of text blocks with templates.

A block is a window of as many consecutive words as the template has, wherever lines end; block
and template are sets of words.  A template meets a block when the block contains at least
``threshold`` of its words.  Template words are ordered by their frequency in all documents,
rarest first, so that a block that meets a template holds one of its first few words: only blocks
around these are looked at.  A length filter (the block has words enough) and a positional one
(enough template words from the first met on, and enough of them in the block) leave few blocks
to be counted.  The templates are a small parameter; the documents are never shuffled.

Notices resemble each other, so overlapping matches compete: the larger containment wins, then the
template of more words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import NOT_LETTERS, Words, slices, words_of

PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by",
           "mit license": "mit"}
# Usual notices and the licenses' own wording, label by label.
TEMPLATES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so",
    ),
    "reserved": ("All rights reserved.",),
}
THRESHOLD = 0.8


# Wordings by label: one text or several.
Templates = Mapping[str, str | Sequence[str]]


def _texts(templates: Templates) -> list[tuple[str, str]]:
    return [(label, text) for label in sorted(templates)
            for text in ([templates[label]] if isinstance(templates[label], str) else templates[label])]


def _hashes(text: str) -> np.ndarray:
    return words_of(pa.array([text]), NOT_LETTERS).hash


@dataclass(frozen=True)
class Match:
    """A met block of a row: its words from ``first`` to ``last`` count from 0 in the batch."""

    row: int
    first: int
    last: int
    label: str
    words: int
    containment: float

    def loses(self, other: Match) -> bool:
        """Whether another label's overlapping match is the better one."""
        return (self.label != other.label and self.first <= other.last and other.first <= self.last
                and (self.containment, self.words) < (other.containment, other.words))


class Index:
    """Templates with their words in the global order, and what each needs to be met."""

    def __init__(self, templates: Templates, frequency: Mapping[int, int], threshold: float):
        texts = [(label, _hashes(text)) for label, text in _texts(templates)]
        self.labels = [label for label, words in texts if len(words)]
        self.lengths = [len(words) for _, words in texts if len(words)]
        sets = [sorted(set(map(int, words)), key=lambda w: (frequency.get(w, 0), w))
                for _, words in texts if len(words)]
        self.words = np.unique(np.array([w for s in sets for w in s], np.uint64))
        # rank[t, w]: place of the word in the template's order, or -1.
        self.rank = np.full((len(sets), len(self.words)), -1)
        for t, words in enumerate(sets):
            self.rank[t, np.searchsorted(self.words, np.array(words, np.uint64))] = range(len(words))
        self.sizes = [len(s) for s in sets]
        # As in exact arithmetic: 0.8 of 5 words are 4.
        self.needed = [max(1, math.ceil(round(threshold * n, 9))) for n in self.sizes]

    def blocks(self, t: int, at: np.ndarray, rank: np.ndarray, stop: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and last template word and shared words of the blocks that meet a template.

        ``at`` are the places of its words, ``rank`` which ones, ``stop`` the ends of their texts.
        A block may begin at a template word: no other beginning holds more of them.
        """
        size, needed, length = self.sizes[t], self.needed[t], self.lengths[t]
        prefix = size - needed
        rare = at[rank <= prefix]
        if not len(rare):
            return (np.zeros(0, np.int64),) * 3
        end = np.minimum(at + length, stop)
        near = np.searchsorted(rare, end) > np.searchsorted(rare, at)
        inside = np.searchsorted(at, end) - np.arange(len(at))
        begin = np.flatnonzero(near & (inside >= needed))
        begin, end = at[begin], end[begin]
        shared, possible = np.zeros(len(begin), np.int64), np.zeros(len(begin), bool)
        for r in range(size):
            places = at[rank == r]
            has = np.searchsorted(places, end) > np.searchsorted(places, begin)
            if r <= prefix:
                # The first word met is the r-th: size - r words can still be shared.
                possible |= has & (size - r >= needed)
            elif r == prefix + 1:
                begin, end, shared, has = begin[possible], end[possible], shared[possible], has[possible]
            shared += has
        met = shared >= needed
        last = at[np.searchsorted(at, end[met]) - 1]
        return begin[met], last, shared[met]


def _best(first: np.ndarray, last: np.ndarray, shared: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Blocks of one template, by place, that no overlapping one beats: more words, then the first."""
    rows = list(zip(first.tolist(), last.tolist(), shared.tolist()))
    low = 0
    for i, (a, z, n) in enumerate(rows):
        while rows[low][1] < a:
            low += 1
        before = any(rows[j][2] >= n for j in range(low, i) if rows[j][1] >= a)
        after = i + 1
        while not before and after < len(rows) and rows[after][0] <= z:
            before = rows[after][2] > n
            after += 1
        if not before:
            yield a, z, n


def frequencies(docs: DataFrame, templates: Templates, text: str = "text") -> dict[int, int]:
    """How often each template word stands in all documents; as many rows as template words."""
    wanted = np.unique(np.concatenate([np.zeros(0, np.uint64), *(_hashes(t) for _, t in _texts(templates))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), np.int64)
        for batch in slices(batches, text):
            found = words_of(batch[text], NOT_LETTERS).hash
            place = np.searchsorted(wanted, found)
            place[place == len(wanted)] = 0
            total += np.bincount(place[wanted[place] == found], minlength=len(wanted))
        yield pa.RecordBatch.from_arrays([pa.array(wanted.view(np.int64)), pa.array(total)],
                                         ["word", "n"])

    if not len(wanted):
        return {}
    counts = docs.select(F.col(text).alias(text)).mapInArrow(run, "word long, n long")
    rows = counts.groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {int(np.int64(r["word"]).view(np.uint64)): r["n"] for r in rows}


def scanned(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
            phrases: Mapping[str, str] = PHRASES, templates: Templates = TEMPLATES,
            threshold: float = THRESHOLD, keep: bool = True) -> DataFrame:
    """Scan whole texts for license phrases and notices.

    Per row: the id, ``n_words``, ``n_base`` (places of all phrases), ``first_word`` and
    ``last_word`` (smallest and largest start of a phrase, or null), ``base_labels``, ``labels``
    (with those of met templates; comma-joined), ``score`` (1 for a phrase, else the largest
    containment that reached the threshold, else 0) and, with ``keep``, ``matches``: met blocks
    (line of the first word, from 0; first word, from 0; words up to the last template word) with
    label and containment.  Of overlapping blocks of a template the best stays, else the first;
    of different labels the larger containment, then the template of more words.  A null or blank text has no words, no
    labels and score 0; repeated rows are scanned each; other columns are ignored.
    """
    index = Index(templates, frequencies(docs, templates, text), threshold)
    wanted = [(_hashes(p), label) for p, label in sorted(phrases.items())]
    kind = docs.schema[id_column].dataType.simpleString()
    schema = (f"`{id_column}` {kind}, n_words long, n_base long, first_word long, last_word long, "
              "base_labels string, labels string, score double")
    schema += ", matches array<struct<block:int,first_word:long,n_words:long,label:string,containment:double>>" if keep else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            words = words_of(batch[text], NOT_LETTERS)
            n, begin = len(batch), words.first()
            base: list[set[str]] = [set() for _ in range(n)]
            places: list[list[int]] = [[] for _ in range(n)]
            for phrase, label in wanted:
                at = np.flatnonzero(words.hash[:len(words.hash) - len(phrase) + 1] == phrase[0]) \
                    if len(words.hash) >= len(phrase) else np.zeros(0, int)
                for step in range(1, len(phrase)):
                    at = at[words.hash[at + step] == phrase[step]]
                at = at[words.row[at] == words.row[at + len(phrase) - 1]]
                for row, place in zip(words.row[at].tolist(), (at - begin[words.row[at]]).tolist()):
                    base[row].add(label)
                    places[row].append(place)
            labels = [set(b) for b in base]
            scores = [1.0 if b else 0.0 for b in base]
            matches: list[list[dict]] = [[] for _ in range(n)]
            for m in _met(words, index, begin):
                labels[m.row].add(m.label)
                scores[m.row] = max(scores[m.row], m.containment)
                line = np.count_nonzero(words.data[words.offsets[m.row]:words.start[m.first]] == 10)
                matches[m.row].append({
                    "block": int(line), "first_word": int(m.first - begin[m.row]),
                    "n_words": m.last - m.first + 1, "label": m.label, "containment": m.containment})
            columns = [
                batch[id_column], pa.array(np.diff(begin), pa.int64()),
                pa.array([len(p) for p in places], pa.int64()),
                pa.array([min(p) if p else None for p in places], pa.int64()),
                pa.array([max(p) if p else None for p in places], pa.int64()),
                pa.array([",".join(sorted(b)) for b in base], pa.string()),
                pa.array([",".join(sorted(x)) for x in labels], pa.string()),
                pa.array(scores, pa.float64())]
            names = [id_column, "n_words", "n_base", "first_word", "last_word", "base_labels",
                     "labels", "score"]
            if keep:
                columns.append(pa.array(matches, pa.list_(pa.struct(
                    [("block", pa.int32()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("label", pa.string()), ("containment", pa.float64())]))))
                names.append("matches")
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(id_column, F.col(text).alias(text)).mapInArrow(run, schema)


def _met(words: Words, index: Index, begin: np.ndarray) -> Iterator[Match]:
    """Matches of a batch that stand, by row and place."""
    if not len(words.hash) or not len(index.words):
        return
    place = np.searchsorted(index.words, words.hash)
    place[place == len(index.words)] = 0
    at = np.flatnonzero(index.words[place] == words.hash)
    place, stop = place[at], begin[words.row[at] + 1]
    found: dict[int, list[Match]] = {}
    for t, label in enumerate(index.labels):
        rank = index.rank[t, place]
        own = rank >= 0
        for first, last, shared in _best(*index.blocks(t, at[own], rank[own], stop[own])):
            row = int(words.row[first])
            found.setdefault(row, []).append(
                Match(row, first, last, label, index.lengths[t], shared / index.sizes[t]))
    for row, matches in sorted(found.items()):
        matches.sort(key=lambda m: (m.first, m.label, m.words))
        reach, waiting = -1, []
        for m in [*matches, None]:
            # Matches up to a gap are compared with each other.
            if m is None or m.first > reach:
                yield from (x for x in waiting if not any(x.loses(y) for y in waiting))
                waiting = []
            if m is not None:
                reach = max(reach, m.last)
                waiting.append(m)
