from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from aduana.llm import exact
from tests.compare import connect
from tests.llm.cases import ODD, SF, crowded, docs, table


def lowered(text):
    return (text or "").translate(str.maketrans(exact.UPPER, exact.LOWER))


def expected(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[lowered(row[1])].append(row[0])
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        kept = False
        for i in ids:
            stays = i == keep and not kept
            kept |= stays
            out.append((i, keep, len(ids), stays, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    columns = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    return sorted([tuple(r[c] for c in columns) for r in df.collect()], key=repr)


COPIES = [
    (20, "Same Text", "en", "a", 1), (21, "sAME tEXT", "en", "a", 1), (22, "same text ", "en", "a", 1),
    (23, "ÉCOLE", "fr", "a", 1), (24, "école", "fr", "a", 1), (25, "École", "fr", "a", 1),
    (30, "twice", "en", "a", 1), (30, "TWICE", "en", "a", 1), (29, "twice", "en", "a", 1),
    (None, "nobody", "en", "a", 1), (None, "Nobody", "en", "a", 1), (None, "one", "en", "a", 1), (31, "ONE", "en", "a", 1),
    (32, "\x00@[`{", "en", "a", 1), (33, "\x00@[`{", "en", "a", 1), (34, "\x00`[@{", "en", "a", 1),
]


@pytest.mark.parametrize("range_rows, mark_bits", [(1 << 16, 25), (3, 15)])
def test_odd_rows_and_copies(spark, range_rows, mark_bits):
    """Few marks let texts of other fingerprints through, which must not change a group."""
    rows = ODD + COPIES + [(1000 + i, f"copy {i % 7}", "en", "a", 1) for i in range(200)]
    df = crowded(docs(spark, rows)).repartition(5)
    assert got(exact.exact_groups(spark, df, range_rows=range_rows, mark_bits=mark_bits)) == expected(rows)


def test_empty_table_and_whole_rows(spark):
    df = crowded(docs(spark, ODD + COPIES))
    assert exact.exact_groups(spark, df.limit(0)).count() == 0
    kept = exact.deduplicated(spark, df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"], lowered(r["text"])) for r in kept.collect() if r["doc_id"] is not None) == sorted(
        (r[0], t) for r in expected(ODD + COPIES) if r[3] and r[0] is not None
        for t in {lowered(x[1]) for x in ODD + COPIES} if hashlib.sha256(t.encode()).hexdigest() == r[4]
    )


def test_texts_of_one_fingerprint_are_told_apart(spark):
    """All texts of a length share a fingerprint; bytes decide."""
    rows = [(i, f"{'aAb'[i % 3]}{i % 4}", "en", "a", 1) for i in range(40)] + COPIES
    assert got(exact.exact_groups(spark, docs(spark, rows), range_rows=4, fingerprint=lambda t: len(t) << 58)) == expected(rows)


def test_whole_table_equals_sql(spark):
    result = exact.exact_groups(spark, table(spark, "documents"))
    sql = connect(SF).execute(exact.OP13_SQL)
    names = [c[0] for c in sql.description]
    assert sorted(map(tuple, result.select(*names).collect())) == sorted(sql.fetchall())


@pytest.mark.parametrize("skip", [0, 3, 17])
def test_filters_merge_without_loss(skip):
    rng = np.random.default_rng(skip)
    prefix = np.uint64(int(rng.integers(0, 1 << skip)) << (64 - skip) if skip else 0)
    low = np.uint64((1 << (64 - skip)) - 1)
    parts = []
    for n in (1, 700, 3000, 50):
        fps = rng.integers(0, 1 << 64, n, np.uint64)
        fps[::5] = fps[0]
        parts.append(prefix | (fps & low))
    parts[2][:40] = parts[1][:40]
    merger = exact._Merger()
    for part in parts:
        packed = exact.CountingQuotientFilter.counted(part, skip).to_bytes()
        merger.add(exact.CountingQuotientFilter.from_bytes(packed))
    fps, counts = merger.result().entries()
    assert [x.tolist() for x in np.unique(np.concatenate(parts), return_counts=True)] == [fps.tolist(), counts.tolist()]


def test_a_bounded_filter_is_handed_on(spark):
    fps = spark.range(1000).selectExpr("xxhash64(id % 300) as fp")
    found = exact.repeated(exact.partial_filters(fps, 2, filter_rows=64))
    assert sorted(r["count"] for r in found.collect()) == [3] * 200 + [4] * 100
