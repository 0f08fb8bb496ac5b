from __future__ import annotations

import re
from collections import defaultdict

import time

import numpy as np
import pytest
import xxhash

from aduana.llm.components import components
from aduana.llm.simhash import (
    deduplicated, fingerprint, fingerprint_links, finer_masks, op7_simhash, pivot_links, reference_fingerprints,
)
from tests.llm.cases import ODD, crowded, docs, table


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [words] if len(words) < 3 else [words[i:i + 3] for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """{fingerprint: its component's smallest fingerprint}"""
    nodes = sorted(set(prints))
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("text", ["", " \n", "One", "one two", "One  two\tthree", "a b c d", "É b ç d e f\x0bg"])
def test_fingerprint(text):
    assert fingerprint(text) == brute_fingerprint(text)


def _expected(rows):
    prints = [(r["doc_id"], brute_fingerprint(r["text"])) for r in rows]
    of = brute_components([f for _, f in prints])
    smallest = defaultdict(lambda: None)
    for doc_id, f in prints:
        known = [x for x in (smallest[of[f]], doc_id) if x is not None]
        smallest[of[f]] = min(known) if known else None
    return sorted([(d, f"{f:016x}", smallest[of[f]]) for d, f in prints], key=repr)


def test_whole_table_and_odd_rows(spark):
    for df in (table(spark, "documents"), docs(spark)):
        got = sorted([tuple(r) for r in op7_simhash(spark, crowded(df)).collect()], key=repr)
        assert got == _expected(df.collect())
    assert op7_simhash(spark, docs(spark, [])).count() == 0


@pytest.mark.parametrize("rows", [4096, 3])
def test_links_join_what_brute_force_joins(spark, rows):
    """With tiny tables all of them are divided again and again."""
    draw = np.random.default_rng(3)
    prints = set()
    for _ in range(30):  # chains of fingerprints a bit or three apart
        at = int(draw.integers(0, 1 << 62))
        for _ in range(12):
            prints.add(at)
            for bit in draw.integers(0, 64, int(draw.integers(1, 4))):
                at ^= 1 << int(bit)
    signed = [p - (1 << 64) if p >= 1 << 63 else p for p in prints]
    fps = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = components(spark, fingerprint_links(spark, fps, table_rows=rows)).collect()
    got = defaultdict(set)
    for r in found:
        got[r["root"]].add(r["node"] % (1 << 64))
    expected = defaultdict(set)
    for n, r in brute_components(prints).items():
        expected[r].add(n)
    assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in expected.values() if len(v) > 1)


@pytest.mark.parametrize("mask", [0xFFFFFFFF, 0xFFFF00000000FFFF, (1 << 64) - 8, (1 << 64) - 1])
def test_finer_masks_lose_no_pair(mask):
    draw = np.random.default_rng(6)
    free = [i for i in range(64) if not mask >> i & 1]
    finer = finer_masks(mask, 2)
    for _ in range(200):
        changed = sum(1 << int(i) for i in draw.choice(free, min(2, len(free)), replace=False)) if free else 0
        assert any(not changed & m for m in finer)


def test_a_large_family_is_divided(spark):
    """100,000 fingerprints with two equal bands: one table, unless it is divided."""
    rows = spark.range(100_000).selectExpr("(xxhash64(id) & 4294967295) | (7L << 40) as fp").distinct()
    began = time.perf_counter()
    found = fingerprint_links(spark, rows).distinct().collect()
    assert time.perf_counter() - began < 120
    values = np.sort(np.array([r["fp"] for r in rows.collect()], np.int64).view(np.uint64))
    known = set(values.tolist())
    masks = [1 << i for i in range(32)] + [(1 << i) | (1 << j) for i in range(32) for j in range(i)]
    near = [(int(v), int(v) ^ m) for v in values[:2000] for m in masks if int(v) ^ m in known]
    of = brute_root([(r["a"], r["b"]) for r in found])
    assert near and all(of(a) == of(b) for a, b in near)
    assert all((r["a"] ^ r["b"]).bit_count() <= 2 for r in found)


def brute_root(links):
    root = {}

    def top(n):
        while root.get(n, n) != n:
            root[n] = root.get(root[n], root[n])
            n = root[n]
        return n

    for a, b in links:
        root[top(a)] = top(b)
    return top


def test_pivot_links_of_a_crowded_table():
    fps = np.unique(np.random.default_rng(5).integers(0, 1 << 12, 1500, np.uint64))
    links = pivot_links(fps, 2, reference_fingerprints())
    assert all((a ^ b).bit_count() <= 2 for a, b in links)
    assert len(links) == len(fps) - len(set(brute_components([int(x) for x in fps]).values()))


def test_components_of_long_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(1, i) for i in range(200, 400)]
    rows = spark.createDataFrame([*path, *star, (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(spark, rows).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 1: 1, **{i: 1 for i in range(200, 400)}}
    assert components(spark, rows.limit(0)).count() == 0


def test_one_row_of_each_group_stays(spark):
    df = crowded(docs(spark, [*ODD, (None, "only without id " * 5, "q", "a", 3), (None, "only without id " * 5, "r", "a", 3)]))
    kept = deduplicated(spark, df)
    assert kept.columns == df.columns
    expected = [x for x in {x[2] for x in _expected(df.collect())} if x is not None]
    texts = [r["text"] for r in kept.filter("doc_id is null").collect()]
    assert sorted(texts) == ["a text without an id " * 9, "only without id " * 5]  # no id is near them
    assert sorted(r["doc_id"] for r in kept.filter("doc_id is not null").collect()) == sorted(expected)
    assert deduplicated(spark, df.limit(0)).count() == 0
