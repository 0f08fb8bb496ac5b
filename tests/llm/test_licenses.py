from __future__ import annotations

import re

import pytest

from aduana.llm.licenses import NOTICES, PHRASES, op2_licenses, scan
from tests.llm.cases import ODD, crowded, docs, table


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    places, labels = [], set()
    for phrase, label in PHRASES:
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


PLANTED = [
    (100, "Under the MIT license. under_the MIT-License, CC BY NC cc by\nnc cc by", None, None, 0),
    (101, "Apache License Version 2" * 3, None, None, 0),
    (102, "word " * 5000 + "Released under the MIT License" + " word" * 5000, None, None, 0),
    (103, "é Under the MIT license é", None, None, 0),
]


def test_phrases_by_brute_force(spark):
    for df in (table(spark, "documents"), crowded(docs(spark, ODD + PLANTED))):
        rows = df.collect()
        got = op2_licenses(spark, df).collect()
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels"]
        assert sorted([(r["doc_id"], *[r[c] for c in names]) for r in got], key=repr) == sorted(
            [(r["doc_id"], *brute(r["text"])) for r in rows], key=repr
        )
        for r in got:
            assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
            assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])
    assert op2_licenses(spark, docs(spark, [])).count() == 0


def _labels(spark, texts):
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    return {r["doc_id"]: set(filter(None, r["labels"].split(","))) for r in op2_licenses(spark, docs(spark, rows)).collect()}


def test_notices_are_found_among_text_and_edits(spark):
    filler = "the of and to is in this a for with " * 40
    texts = [f"{filler} {notice} {filler}" for _, notice, _ in NOTICES]
    found = _labels(spark, texts)
    for i, (label, _, _) in enumerate(NOTICES):
        assert label in found[i], label
    edits = _labels(spark, [
        NOTICES[0][1].replace("a copy of this", "any one copy of this fine"),  # words put in
        NOTICES[0][1].replace("hereby granted, free of charge", "granted"),  # a mandatory phrase broken
        "general public license gnu version 3 under this work is licensed the",  # the words without their order
        filler,
    ])
    assert edits[0] == {"mit"} and edits[1] == set() and edits[2] == set() and edits[3] == set()


@pytest.mark.parametrize("rare", [1, 5, 50])
def test_places_do_not_depend_on_how_many_words_are_looked_up(spark, rare):
    rows = [(i, f"and the {n} of this", None, None, 0) for i, (_, n, _) in enumerate(NOTICES)]
    found = scan(docs(spark, rows), rare=rare).collect()
    for r in found:
        exact = [p for p in r["places"] if not p["exact"] and p["label"] == NOTICES[r["doc_id"]][0]]
        assert rare == 1 or any(p["first_word"] == 2 and p["share"] == 1 for p in exact)
