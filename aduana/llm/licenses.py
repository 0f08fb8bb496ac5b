"""License scans by a positional rare-token index.

Templates (notices and phrases) are posted word by word with their positions. Of each text the words of a template
with the highest inverse document frequency are looked up; hits that agree on the relative position are a place
where the template may stand, and its mandatory key phrases are then verified there. Document frequencies are
counted over all documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from aduana.llm.common import text_of

#: Words of a template that are looked up in a text: its rarest ones that the text has.
RARE_WORDS = 5
#: Words that a copy of a notice may be shifted by insertions or deletions.
SLACK = 3
#: Share of a notice's words that must stand in place.
MIN_SHARE = 0.6

# Phrases whose every place counts, and their labels.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
# Notices of further licences: label, notice, mandatory key phrases.
NOTICES = [
    ("mit",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files, to deal in the Software without restriction",
     ["hereby granted free of charge", "deal in the software without restriction"]),
    ("mit", "Released under the MIT License", ["mit license"]),
    ("apache-2",
     "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License",
     ["apache license version 2 0", "in compliance with the license"]),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3",
     ["gnu general public license", "version 3"]),
    ("gpl",
     "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation",
     ["gnu general public license", "free software foundation"]),
    ("lgpl",
     "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
     "General Public License", ["gnu lesser general public license"]),
    ("agpl-3", "Licensed under the GNU Affero General Public License, version 3",
     ["gnu affero general public license"]),
    ("bsd",
     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("isc",
     "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted", ["distribute this software for any purpose with or without fee"]),
    ("mpl-2",
     "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
     ["mozilla public license"]),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ["cc by nc 4 0"]),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", ["cc by sa 4 0"]),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License",
     ["creative commons attribution 4 0 international license"]),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights to this work",
     ["waived all copyright and related"]),
    ("unlicense", "This is free and unencumbered software released into the public domain",
     ["unencumbered software released into the public domain"]),
]

# Of bytes: what isn't ASCII is part of a word, and only A-Z are lower-cased.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str) -> list[bytes]:
    return _WORD.findall(text.encode().lower())


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    #: Key phrases with their place in the template.
    keys: tuple[tuple[int, tuple[bytes, ...]], ...]
    exact: bool


def _within(words: tuple[bytes, ...], phrase: tuple[bytes, ...]) -> int:
    return next(i for i in range(len(words)) if words[i:i + len(phrase)] == phrase)


def templates(phrases=PHRASES, notices=NOTICES) -> list[Template]:
    made = [Template(label, w := tuple(words_of(phrase)), ((0, w),), True) for phrase, label in phrases]
    for label, notice, keys in notices:
        words = tuple(words_of(notice))
        parts = [tuple(words_of(k)) for k in keys]
        made.append(Template(label, words, tuple((_within(words, k), k) for k in parts), False))
    return made


class Index:
    def __init__(self, made: list[Template], idf: dict[bytes, float], rare: int = RARE_WORDS, slack: int = SLACK):
        self.templates, self.slack = made, slack
        self.vocabulary = {w for t in made for w in t.words}
        self.most = max((len(t.words) for t in made), default=0)
        self.rare = rare
        #: Words of the key phrases: without one of them a template can't be verified anywhere.
        self.mandatory = [{w for _, phrase in t.keys for w in phrase} for t in made]
        #: Of each template its words by falling idf, with their positions in it.
        self.posted: list[list[tuple[bytes, list[int]]]] = []
        for t in made:
            places = defaultdict(list)
            for i, w in enumerate(t.words):
                places[w].append(i)
            order = sorted(places, key=lambda w: (-idf.get(w, 0.0), w))
            self.posted.append([(w, places[w]) for w in order])

    def places(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, start, share of its words in place) of every verified place."""
        at: dict[bytes, list[int]] = {}
        vocabulary = self.vocabulary
        for i, w in enumerate(words):
            if w in vocabulary:
                at.setdefault(w, []).append(i)
        if not at:
            return []
        found = []
        for number, template in enumerate(self.templates):
            if not self.mandatory[number] <= at.keys():
                continue
            if template.exact:  # its rarest word leads to every place
                word, positions = self.posted[number][0]
                n = len(template.words)
                for start in sorted({i - positions[0] for i in at[word]}):
                    if start >= 0 and tuple(words[start:start + n]) == template.words:
                        found.append((number, start, 1.0))
                continue
            known = [(w, p) for w, p in self.posted[number] if w in at][:self.rare]
            votes: Counter[int] = Counter()
            for word, positions in known:
                for start in {i - p for i in at[word] for p in positions}:
                    votes[start] += 1
            needed = min(self.rare, len(self.posted[number]), max(2, len(known) // 2 + 1))
            for start, count in votes.items():
                around = [votes.get(start + k, 0) for k in range(-self.slack, self.slack + 1)]
                if count == max(around) and sum(around) >= needed:
                    share = self._verified(template, words, start)
                    if share is not None:
                        found.append((number, start, share))
        return found

    def _verified(self, template: Template, words: list[bytes], start: int) -> float | None:
        n = len(words)
        for place, phrase in template.keys:
            spots = range(max(0, start + place - self.slack), start + place + self.slack + 1)
            if not any(tuple(words[s:s + len(phrase)]) == phrase for s in spots):
                return None
        hit = 0
        for i, w in enumerate(template.words):
            low, high = max(0, start + i - self.slack), min(n, start + i + self.slack + 1)
            hit += any(words[j] == w for j in range(low, high))
        return hit / len(template.words)


def inverse_frequencies(docs: DataFrame, text_col: str, vocabulary: set[bytes]) -> dict[bytes, float]:
    """log((1 + documents) / (1 + documents with the word)) of the words of the templates, which bound what comes
    to the driver; counted over all rows, each task summing its own first."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        for batch in batches:
            total[b""] += batch.num_rows
            for text in batch.column(0):
                total.update(vocabulary.intersection(words_of(text_of(text.as_py()))))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["word", "n"]
        )

    rows = docs.select(text_col).mapInArrow(counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {bytes(r["word"]): r["n"] for r in rows.collect()}
    everything = found.pop(b"", 0)
    return {w: math.log((1 + everything) / (1 + found.get(w, 0))) for w in vocabulary}


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, notices=NOTICES,
    rare: int = RARE_WORDS, slack: int = SLACK, min_share: float = MIN_SHARE,
) -> DataFrame:
    """One row per document: id, n_words, places array of (label, exact, first_word, n_words, share).

    exact places are those of the phrases, all of them; the others are notices with their key phrases verified and
    at least `min_share` of their words in place. A null text is empty. Null ids stay, repeated rows are scanned
    alike, an empty table gives no row, other columns are not read. Equal frequencies are ordered by word. A text of
    any length is scanned whole by one task, which holds its words.
    """
    made = templates(phrases, notices)
    vocabulary = {w for t in made for w in t.words}
    index = Index(made, inverse_frequencies(docs, text_col, vocabulary), rare, slack)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([
            ("label", pa.string()), ("exact", pa.bool_()), ("first_word", pa.int64()), ("n_words", pa.int64()),
            ("share", pa.float64()),
        ]))
        for batch in batches:
            counts, places = [], []
            for text in batch.column(1):
                words = words_of(text_of(text.as_py()))
                counts.append(len(words))
                places.append([
                    {"label": made[t].label, "exact": made[t].exact, "first_word": start,
                     "n_words": len(made[t].words), "share": share}
                    for t, start, share in index.places(words) if share >= min_share
                ])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(places, kind)],
                names=[id_col, "n_words", "places"],
            )

    return docs.select(id_col, text_col).mapInArrow(
        scanned,
        f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_words long, places array<struct<label: string, "
        "exact: boolean, first_word: long, n_words: long, share: double>>",
    )


def op2_licenses(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Counts and places of the phrases, and all labels. The score is the share of words in place of the best
    place, 0 without any."""
    exact = F.filter("places", lambda p: p["exact"])
    starts = F.transform(exact, lambda p: p["first_word"])

    def labels(places):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    return scan(docs).select(
        "doc_id", "n_words", F.size(exact).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(exact).alias("base_labels"), labels("places").alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["share"])), F.lit(0.0)).alias("score"),
    )
