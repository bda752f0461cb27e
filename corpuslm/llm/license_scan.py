"""License scans: phrases that stand in a text, and blocks that contain most of a license template.

A block is a line. It meets a template when at least `threshold` of the template's distinct words
stand in it. The exact set-similarity join finds every such pair: words are ordered by their number over
all documents, rarest first; a block that meets a template has one of the template's first words in
that order (prefix filter), has enough words (length filter), and what is left on both sides behind a
common word can still fill the gap (position filter). The words left over are then counted.

With `wrapped`, notices that are broken over lines are met too: blocks are then also the windows of a paragraph's
words that are as long as the template, and a short template wants the words that set it apart.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslm.llm.common import map_texts

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Notices by which a license is commonly declared, and the labels of the method.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"),
    ("mit", "released under the MIT License"),
    ("apache", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance "
               "with the License"),
    ("apache", "licensed under the Apache License, Version 2.0"),
    ("gpl", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("gpl", "licensed under the GNU General Public License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
]
THRESHOLD = 0.8
# Distinct words of a short template, at most.
SHORT = 8

# Words are digits, letters a-z, and all characters beyond ASCII; every other byte separates.
_SEPARATED = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().translate(_SEPARATED).split()


def template_counts(docs: DataFrame, templates: list[tuple[str, str]], text: str = "text") -> dict[bytes, int]:
    """How often each word of the templates stands in all texts: as many numbers as templates have words."""
    vocabulary = {w for _, t in templates for w in words_of(t)}

    def make():
        from collections import Counter

        import pyarrow as pa

        total: Counter = Counter()

        def step(texts):
            total.clear()
            for t in texts:
                total.update(w for w in words_of(t) if w in vocabulary)
            # one list for the batch, at its first row
            items = [[{"word": w.decode(), "n": n} for w, n in total.items()]] + [[]] * (len(texts) - 1)
            return [pa.array(items, pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())])))]

        return step

    found = map_texts(docs, [F.lit(1).alias("one")], F.col(text), make, "counts array<struct<word:string,n:long>>", kept="one int")
    summed = found.select(F.inline("counts")).groupBy("word").agg(F.sum("n").alias("n"))
    return {w: 0 for w in vocabulary} | {r.word.encode(): r.n for r in summed.collect()}


class Templates:
    """The templates' words in the global order, with the inverted lists of their prefixes."""

    def __init__(self, templates: list[tuple[str, str]], counts: dict[bytes, int], threshold: float):
        self.order = {w: i for i, w in enumerate(sorted(counts, key=lambda w: (counts[w], w)))}
        self.labels = [label for label, _ in templates]
        self.words = [sorted({self.order[w] for w in words_of(t)}) for _, t in templates]
        self.needed = [max(1, math.ceil(threshold * len(t) - 1e-9)) for t in self.words]
        self.lists: dict[int, list[tuple[int, int]]] = {}
        for number, (t, need) in enumerate(zip(self.words, self.needed, strict=True)):
            for at, w in enumerate(t[: len(t) - need + 1]):
                self.lists.setdefault(w, []).append((number, at))
        self.lengths = [len(words_of(t)) for _, t in templates]
        self.apart = [
            set(t).difference(*(o for o, other in zip(self.words, self.labels, strict=True) if other != label)) if len(t) <= SHORT else set()
            for t, label in zip(self.words, self.labels, strict=True)
        ]
        place = {i: w for w, i in self.order.items()}
        self.probes = {place[w] for w in self.lists}

    def met(self, words: list[bytes]) -> list[tuple[int, int]]:
        """(number, common words) of the templates that the block meets."""
        distinct = set(words)
        block = sorted(self.order[w] for w in distinct if w in self.order)
        seen, found = set(), []
        for at, w in enumerate(block):
            for number, position in self.lists.get(w, ()):
                t, need = self.words[number], self.needed[number]
                # the first common word decides, as all before it have none in common
                if number in seen or len(distinct) < need:
                    continue
                seen.add(number)
                if 1 + min(len(t) - position - 1, len(block) - at - 1) < need:
                    continue
                common = len(set(block) & set(t))
                if common >= need:
                    found.append((number, common))
        return found

    def matches(self, line_words: list[bytes]) -> dict[str, float]:
        """Labels of the templates that the block meets, with the greatest containment."""
        found: dict[str, float] = {}
        for number, common in self.met(line_words):
            label = self.labels[number]
            found[label] = max(found.get(label, 0.0), common / len(self.words[number]))
        return found

    def wrapped(self, lines: list[list[bytes]]) -> dict[str, float]:
        """The same for the lines of a text: a block is a line, or a window over a paragraph of lines.

        A paragraph ends at a line without words. A window has as many words as the template.
        """
        found: dict[str, float] = {}
        blocks = [(line, None) for line in lines]
        paragraph: list[list[bytes]] = []
        for line in [*lines, []]:
            if line:
                paragraph.append(line)
                continue
            if len(paragraph) > 1:
                blocks.append(([w for part in paragraph for w in part], True))
            paragraph = []
        for words, sliding in blocks:
            for number, _ in self.met(words):
                common = self._most(words, number, self.lengths[number] if sliding else len(words))
                if common >= self.needed[number]:
                    label = self.labels[number]
                    found[label] = max(found.get(label, 0.0), common / len(self.words[number]))
        return found

    def _most(self, words: list[bytes], number: int, wide: int) -> int:
        """The most words of the template in a window of the given width that has those that set it apart."""
        t, apart = set(self.words[number]), self.apart[number]
        places = [(at, self.order[w]) for at, w in enumerate(words) if self.order.get(w) in t]
        held: dict[int, int] = {}
        most = first = 0
        for at, w in places:
            held[w] = held.get(w, 0) + 1
            while places[first][0] <= at - wide:
                gone = places[first][1]
                held[gone] -= 1
                if not held[gone]:
                    del held[gone]
                first += 1
            if len(held) > most and apart <= held.keys():
                most = len(held)
        return most


def scan(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates: list[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    wrapped: bool = False,
) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word long, base_labels, labels string, score double).

    n_base counts every place where a phrase's words stand one after the other, the smallest and
    largest word number of such a place are first_word and last_word, null without one. labels also
    holds those of met templates; score is the greatest containment, 1 where a phrase stands, else
    0. Null text is empty: no words, empty labels. One row per row, equal or null ids too. The texts
    are read twice (the counts of template words come first); only those counts reach the driver.
    With `wrapped`, templates are also met across the lines of a paragraph, and short ones by their own words only.
    """
    index = Templates(templates, template_counts(docs, templates, text), threshold)

    def make():
        needles = [(b" " + p.encode() + b" ", label) for p, label in phrases.items()]

        def one(t: str) -> tuple:
            lower = t.encode("utf-8", "replace").lower()
            words = lower.translate(_SEPARATED).split()
            joined = b" " + b" ".join(words) + b" "
            starts, base = [], set()
            for needle, label in needles:
                at = joined.find(needle)
                while at >= 0:
                    starts.append(joined.count(b" ", 0, at))
                    base.add(label)
                    at = joined.find(needle, at + 1)
            labels, score = set(base), 1.0 if base else 0.0
            if not index.probes.isdisjoint(words):
                lines = [line.translate(_SEPARATED).split() for line in lower.split(b"\n")]
                for found in [index.wrapped(lines)] if wrapped else map(index.matches, lines):
                    for label, share in found.items():
                        labels.add(label)
                        score = max(score, share)
            edge = (min(starts), max(starts)) if starts else (None, None)
            return len(words), len(starts), *edge, ",".join(sorted(base)), ",".join(sorted(labels)), score

        def step(texts):
            import pyarrow as pa

            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            rows = [one(t) for t in texts]
            return [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]

        return step

    fields = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    keep = [F.col(id).cast("long").alias("doc_id")]
    return map_texts(docs, keep, F.col(text), make, fields, kept="doc_id long").withColumnRenamed("doc_id", id)
