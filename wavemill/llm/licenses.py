"""Licence scans with a positional rare-token index.

Licence notices are templates, rows of words with key phrases that must not miss. The index posts every word of
a template with its places. How rare a word is, its inverse document frequency, is counted over all texts of the
table. Of each template its rarest words are looked up in the text, so many that no place where enough of its
weight agrees can miss all but one of them; where postings of different words agree on where a template would
begin, the template is laid over the text there and compared word for word, weighted by rarity. It is found if
enough of that weight agrees and its key phrases stand there as they must.

Labels by phrase (the base) are found by consecutive words alone and stay whatever the method says.

Rows: NULL counts as empty; empty texts have no words and no labels; equal texts get equal labels; an empty table
gives an empty table. Columns called like a result are replaced, all others but the text stay.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavemill.llm.shared import raw_texts, slices

#: Weight of a template that has to agree.
LEAST_SCORE = 0.75

_KEEP = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

#: Base phrases and their labels (fixed values).
BASE = {(b"mit", b"license"): "mit", (b"apache", b"license"): "apache",
        (b"general", b"public", b"license"): "gpl"}

#: Notices as licensors publish them, with the phrases that tell them apart (fixed values).
TEMPLATES: list[tuple[str, str, tuple[str, ...]]] = [
    ("mit", "Released under the MIT License", ("mit license",)),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction",
     ("free of charge", "without restriction")),
    ("apache", "Licensed under the Apache License, Version 2.0", ("apache license", "version 2 0")),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License "
               "at http://www.apache.org/licenses/LICENSE-2.0", ("apache org licenses",)),
    ("gpl", "This work is licensed under the GNU General Public License, version 3",
     ("gnu general public license",)),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation", ("gnu general public license",)),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
     ("lesser general public license",)),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
     ("affero general public license",)),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met", ("source and binary forms",)),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted", ("with or without fee",)),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
     ("mozilla public license",)),
    ("cc-by", "Licensed under CC BY 4.0", ("cc by 4 0",)),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa",)),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License",
     ("creative commons attribution 4 0",)),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
     ("attribution noncommercial 4 0",)),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights",
     ("waived all copyright",)),
    ("unlicense", "This is free and unencumbered software released into the public domain", ("public domain",)),
    ("proprietary", "All rights reserved", ("all rights reserved",)),
]


def words_of(text: bytes) -> list[bytes]:
    """Runs of digits, ASCII letters in lower case, and non-ASCII characters."""
    return text.lower().translate(_KEEP).split()


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    phrases: tuple[tuple[bytes, ...], ...]


def templates() -> list[Template]:
    return [Template(label, tuple(words_of(text.encode())), tuple(tuple(p.encode().split()) for p in phrases))
            for label, text, phrases in TEMPLATES]


def places_of(words: list[bytes], phrase: tuple[bytes, ...]) -> list[int]:
    """Where a phrase's words stand one after the other."""
    out, at, n = [], -1, len(phrase)
    while True:
        try:
            at = words.index(phrase[-1], at + 1)
        except ValueError:
            return out
        if at >= n - 1 and tuple(words[at - n + 1:at + 1]) == phrase:
            out.append(at - n + 1)


class Index:
    """Postings of every template's rarest words, and the words' rarity."""

    def __init__(self, idf: dict[bytes, float]):
        self.idf, self.templates = idf, templates()
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.weight = [sum(idf[w] for w in t.words) for t in self.templates]
        self.agreeing: list[int] = []  # different words that agree wherever a template is found
        for t, template in enumerate(self.templates):
            chosen, enough = self.rarest(template, (1 - LEAST_SCORE) * self.weight[t] + 1e-9)
            self.agreeing.append(2 if enough else 1)
            for place, word in enumerate(template.words):
                if word in chosen:
                    self.postings[word].append((t, place))
        self.vocabulary = frozenset(self.postings)

    def rarest(self, template: Template, spare: float) -> tuple[set[bytes], bool]:
        """A template's rarest words, until all but any one of them weigh over ``spare``; whether they do."""
        times = Counter(template.words)
        chosen: set[bytes] = set()
        total = most = 0.0
        for word in sorted(times, key=lambda w: (-self.idf[w], w)):
            if total - most > spare:
                break
            chosen.add(word)
            total += times[word] * self.idf[word]
            most = max(most, times[word] * self.idf[word])
        return chosen, total - most > spare

    def scan(self, words: list[bytes]) -> dict[str, float]:
        """Labels found in a text, with the best score of each."""
        if self.vocabulary.isdisjoint(words):
            return {}
        begins: dict[tuple[int, int], set[bytes]] = defaultdict(set)
        for at, word in enumerate(words):
            if word in self.vocabulary:
                for t, place in self.postings[word]:
                    begins[t, at - place].add(word)
        found: dict[str, float] = {}
        for (t, begin), agreed in begins.items():
            template = self.templates[t]
            if len(agreed) < self.agreeing[t] or found.get(template.label) == 1.0:
                continue
            score = self.compare(words, template, begin) / self.weight[t]
            if score >= LEAST_SCORE and score > found.get(template.label, 0.0):
                laid = words[max(0, begin):begin + len(template.words)]
                if all(places_of(laid, p) for p in template.phrases):
                    found[template.label] = min(1.0, score)
        return found

    def compare(self, words: list[bytes], template: Template, begin: int) -> float:
        """Weight of the template's words that stand in their place if it begins at ``begin``."""
        n = len(words)
        return sum(self.idf[w] for i, w in enumerate(template.words) if 0 <= begin + i < n and words[begin + i] == w)


def rarity(df: DataFrame, text: str = "text") -> dict[bytes, float]:
    """Inverse document frequency of each licence word, over all texts."""
    vocabulary = frozenset(w for t in templates() for w in t.words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times: Counter[bytes] = Counter()
        n = 0
        for batch in slices(batches, text):
            for raw in raw_texts(batch.column(text)):
                times.update(vocabulary.intersection(words_of(raw)))
                n += 1
        yield pa.RecordBatch.from_pydict({"word": pa.array([*times, None], pa.binary()),
                                          "n": pa.array([*times.values(), n], pa.int64())})

    rows = df.select(text).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    seen = {None if r["word"] is None else bytes(r["word"]): r["n"] for r in rows}  # a row a licence word
    n = seen.get(None, 0)
    return {w: log((n + 1) / (seen.get(w, 0) + 0.5)) + 1e-3 for w in vocabulary}


def scanned(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with its text's word count, base phrases and labels in place of the text."""
    index = Index(rarity(df, text))
    added = [T.StructField("n_words", T.LongType()), T.StructField("base_places", T.ArrayType(T.LongType())),
             T.StructField("base_labels", T.ArrayType(T.StringType())), T.StructField("labels", T.ArrayType(T.StringType())),
             T.StructField("score", T.DoubleType())]
    kept = [f for f in df.schema if f.name != text and f.name not in {a.name for a in added}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            out = []
            for raw in raw_texts(batch.column(text)):
                words = words_of(raw)
                base = {p: places for p in BASE if (places := places_of(words, p))}
                found = index.scan(words)
                named = sorted({BASE[p] for p in base})
                out.append((len(words), sorted(i for places in base.values() for i in places), named,
                            sorted({*named, *found}), max(found.values(), default=1.0 if named else 0.0)))
            columns = [pa.array([o[i] for o in out], t) for i, t in enumerate(
                (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string()), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *columns],
                                             [f.name for f in [*kept, *added]])

    return df.mapInArrow(run, T.StructType([*kept, *added]))
