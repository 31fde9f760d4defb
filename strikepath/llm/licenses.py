"""License scans by a positional index of rare tokens.

Each licence template is a short text with phrases that must be present. A
template's anchors are its words of the highest inverse document frequency over
all scanned documents. The index has, for each anchor, its templates and
positions. In a file, positions of anchors minus positions in the template give
where the template would begin; places on which enough anchors agree are
candidates, and a candidate counts when its mandatory phrases stand there.

Phrases of the base set are templates of their own, found in the same way at
every place where their words stand consecutively. A template that is nothing but
its phrase has one anchor. The registered query has a base set of its own.

Defined results: a null or empty text has no words and no labels; repeated rows
each get a row; an empty input gives no row; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strikepath.llm.common import pick, slices, texts_of

SCANNED = "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, labels array<string>, score double"
#: Lower-cases A-Z and turns every other ASCII character but 0-9 and a-z into a space.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
ANCHORS = 6


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...]
    base: bool = False


# Public licence texts or their opening parts, and phrases that must occur in them.
TEMPLATES = (
    Template("mit", "the MIT license", ("the MIT license",), base=True),
    Template("apache-2", "Apache License Version 2", ("Apache License Version 2",), base=True),
    Template("cc-by-nc", "CC BY NC", ("CC BY NC",), base=True),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software",
        ("permission is hereby granted free of charge", "to deal in the software without restriction"),
    ),
    Template(
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may "
        "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        ("licensed under the apache license version 2 0",),
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        ("redistribution and use in source and binary forms", "with or without modification"),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        ("for any purpose with or without fee is hereby granted",),
    ),
    Template("gpl-3", "licensed under the GNU General Public License, version 3", ("gnu general public license version 3",)),
    Template(
        "gpl-3",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
        ("gnu general public license as published by the free software foundation", "either version 3 of the license"),
    ),
    Template("gpl-2", "licensed under the GNU General Public License, version 2", ("gnu general public license version 2",)),
    Template("lgpl", "licensed under the GNU Lesser General Public License", ("gnu lesser general public license",)),
    Template("agpl-3", "licensed under the GNU Affero General Public License, version 3", ("gnu affero general public license",)),
    Template(
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ("subject to the terms of the mozilla public license",),
    ),
    Template("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial license", ("creative commons attribution noncommercial",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software released into the public domain",)),
)

# The registered query's base phrase of this licence is longer; its name alone is a template of the method there.
QUERY_TEMPLATES = (
    Template("mit", "under the MIT license", ("under the MIT license",), base=True),
    *[replace(t, base=t.base and t.label != "mit") for t in TEMPLATES],
)


class Index:
    """Postings of the templates' anchors, given how many of ``documents`` hold each word."""

    def __init__(self, templates: tuple[Template, ...], frequency: dict[bytes, int], documents: int, anchors: int = ANCHORS):
        self.templates = templates
        self.words = [words_of(t.text) for t in templates]
        self.phrases = [[words_of(p) for p in t.phrases] for t in templates]
        self.need: list[int] = []
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        idf = lambda w: math.log((documents + 1) / (frequency.get(w, 0) + 1))
        for k, words in enumerate(self.words):
            # A phrase is verified whole at each place of its rarest word.
            rare = sorted(set(words), key=lambda w: (-idf(w), w))[: 1 if templates[k].base or self.phrases[k] == [words] else anchors]
            self.need.append(max(1, len(rare) // 2))
            for at, w in enumerate(words):
                if w in rare:
                    self.postings[w].append((k, at))

    def scan(self, words: list[bytes]) -> tuple[int, int, int | None, int | None, list[str], list[str], float]:
        """(words, base places, first, last, base labels, all labels, score) of one file."""
        postings = self.postings
        votes: Counter[tuple[int, int]] = Counter()
        if not postings.keys().isdisjoint(words):
            for i, w in enumerate(words):
                if w in postings:
                    votes.update((k, i - at) for k, at in postings[w])
        places, base, labels, score = [], set(), set(), 0.0
        for (k, start), n in votes.items():
            if n < self.need[k]:
                continue
            t, own = self.templates[k], self.words[k]
            if t.base:
                if start >= 0 and words[start : start + len(own)] == own:
                    places.append(start)
                    base.add(t.label)
                    score = 1.0
            elif all(self._stands(p, words, start, len(own)) for p in self.phrases[k]):
                labels.add(t.label)
                agree = sum(a == b for a, b in zip(words[max(0, start) : start + len(own)], own[max(0, -start) :], strict=False))
                score = max(score, agree / len(own))
        return len(words), len(places), min(places, default=None), max(places, default=None), sorted(base), sorted(base | labels), score

    @staticmethod
    def _stands(phrase: list[bytes], words: list[bytes], start: int, length: int, slack: int = 8) -> bool:
        """Whether the phrase's words stand consecutively near the template's place."""
        n = len(phrase)
        return any(words[i : i + n] == phrase for i in range(max(0, start - slack), max(0, start + length + slack)) if words[i : i + 1] == phrase[:1])


def _seen(vocabulary: frozenset[bytes]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, documents = Counter(), 0
        for batch in slices(batches):
            documents += batch.num_rows
            for text in texts_of(batch):
                n.update(vocabulary.intersection(words_of(text)))
        rows = [*n.items(), (b"", documents)]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.binary()), pa.array([c for _, c in rows], pa.int64())], names=["word", "n"])

    return run


def build_index(documents: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> Index:
    """Document frequencies over the whole table, for the words of the templates only: that many rows reach the driver."""
    vocabulary = frozenset(w for t in templates for w in words_of(t.text))
    counted = pick(documents, {"text": "string"}).mapInArrow(_seen(vocabulary), "word binary, n bigint")
    found = {bytes(r["word"]): r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return Index(templates, found, found.pop(b"", 0))


def _scan(index: Index) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    types = [pa.int64()] * 4 + [pa.list_(pa.string())] * 2 + [pa.float64()]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [index.scan(words_of(text)) for text in texts_of(batch)]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *names])

    return run


def scan(documents: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of whole texts."""
    documents = pick(documents, {"doc_id": "bigint", "text": "string"})
    return documents.mapInArrow(_scan(build_index(documents, templates)), SCANNED)
