from __future__ import annotations

import hashlib
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from aduana.llm.runs import _best, find_runs, looped, op12_runs, periodic_runs
from tests.llm.cases import ODD, SF, crowded, docs, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, periods=4, least=6):
    """Every period, word by word."""
    n, found = len(words), {}
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, periods * q):
                found.setdefault((i, j + q - i), q)  # smaller periods come first
            i = max(j, i) + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def of(words):
    return list(zip(*(x.tolist() for x in find_runs(np.array(words, np.int64), np.array([0, len(words)]))), strict=True))


def texts():
    """Pieces repeated a few times, so that there is something to find."""
    piece = st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 9))
    return st.lists(piece, max_size=8).map(lambda x: [w for words, times in x for w in words * times])


@settings(max_examples=400, deadline=None)
@given(texts())
def test_runs_are_those_of_brute_force(words):
    assert of(words) == brute(words)


@settings(max_examples=100, deadline=None)
@given(st.lists(texts(), max_size=6))
def test_texts_of_a_block_do_not_touch(parts):
    offsets = np.cumsum([0, *map(len, parts)])
    found = find_runs(np.array([w for p in parts for w in p], np.int64), offsets)
    wanted = [(s + o, n, q) for p, o in zip(parts, offsets.tolist(), strict=False) for s, n, q in brute(p)]
    assert list(zip(*(x.tolist() for x in found), strict=True)) == wanted


@pytest.mark.parametrize("make", [
    lambda n: np.zeros(n, np.int64),  # one word
    lambda n: np.arange(n) % 7 // 6,
    lambda n: np.arange(n) % (n // 5),
    lambda n: np.array([bin(i).count("1") % 2 for i in range(n)]),  # Thue-Morse: no run at all
    lambda n: np.repeat(np.arange(n // 8 + 1), 8)[:n] % 3,
    lambda n: np.where(np.arange(n) % 51 == 50, np.arange(n), 0),
])
def test_long_texts_take_about_n_log_n(make):
    small = make(600)
    assert of(small) == brute(small.tolist())
    words = make(400_000)
    began = time.perf_counter()
    find_runs(words, np.array([0, len(words)]))
    assert time.perf_counter() - began < 30


def expected(key, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return digest(key, words, brute(words))


def digest(key, words, runs):
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        key, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest(),
    )


LOOPS = [
    (100 + i, text, "en", "a", 1) for i, text in enumerate([
        "a " * 6, "a " * 5, "a b\t" * 4, "a b c " * 3, "x a b a b a b a b a y", "a a a a a a b a a a a a a b " * 5,
        "é ü\n" * 9 + "z", "one two " * 4 + "three " * 6, "    " * 8, "\x1c \x1d " * 8, "A a " * 7,
    ])
]


def test_rows_of_all_kinds(spark, tmp_path):
    """Texts of 200 words at most are checked by brute force; the long ones by their runs."""
    path = str(tmp_path)
    rows = [r for r in ODD if r[0] != 5] + LOOPS + [(i, " ".join(f"w{j % 50}" for j in range(i)), "en", "a", 1) for i in range(200, 290)]
    crowded(docs(spark, rows)).repartition(3).write.parquet(f"{path}/documents.parquet")
    got = sorted((tuple(r) for r in op12_runs(spark, path).collect()), key=repr)
    assert got == sorted((expected(r[0], r[1]) for r in rows), key=repr)
    assert periodic_runs(crowded(docs(spark, rows)).limit(0)).count() == 0


def test_long_text_and_general_form(spark):
    rows = [(1, "q r " * 300_000 + "end", "en", "a", 1), (2, "a b a b a b", "en", "a", 1)]
    got = {r["doc_id"]: r for r in periodic_runs(docs(spark, rows), periods=3).collect()}
    assert [tuple(x) for x in got[1]["runs"]] == [(0, 600_000, 2)] and got[1]["collapsed"] == "q r end"
    assert [tuple(x) for x in got[2]["runs"]] == [(0, 6, 2)] and got[2]["collapsed"] == "a b"


def test_ties_of_the_best_run():
    assert _best(np.array([8, 12, 6]), np.array([2, 3, 1])) == 2
    assert _best(np.array([8, 12]), np.array([2, 3])) == 0
    assert _best(np.array([]), np.array([])) is None


def test_given_table_by_brute_force(spark):
    rows = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    got = {r["doc_id"]: tuple(r) for r in op12_runs(spark, SF).collect()}
    assert set(got) == set(rows)
    edited = [k for k, t in rows.items() if looped(k, len(WORD.findall(t or ""))) is not None]
    assert edited
    for key, text in rows.items():
        if len(text or "") < 4000:
            assert got[key] == expected(key, text)
