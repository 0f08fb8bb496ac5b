from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from aduana.llm import mixing
from aduana.llm.mixing import copies, each_row, mixed_documents, op3_mixing, pivotal, targets
from tests.llm.cases import LONG, ODD, crowded, docs, table


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """{source: target}: shares again and again until nothing is above its ceiling."""
    total = Counter()
    for source, size in sizes:
        total[source] += size
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, capped, left = {}, set(), sum(total.values())
    while True:
        open_ = [s for s in order if s not in capped]
        base = sum(weight[s] for s in open_)
        rest = left - sum(most * total[s] for s in capped)
        target = {s: most * total[s] if s in capped else rest * weight[s] / base for s in order}
        above = [s for s in open_ if target[s] > most * total[s]]
        if not above:
            return target, total
        capped.update(above)


@pytest.mark.parametrize("rows", [
    [("a", 10), ("b", 900), ("c", 5), (None, 40)],
    [("a", 0), ("b", 7)],
    [("é", 1), ("z", 1000), ("Z", 1), ("", 3), (None, 0)],
    [("a", 0)],
])
def test_targets(spark, rows):
    got = targets(spark, spark.createDataFrame(rows, "source string, size long")).collect()
    expected, total = brute_targets(rows)
    assert {r["source"] for r in got} == set(expected)
    for r in got:
        assert r["source_size"] == total[r["source"]]
        assert r["target"] == pytest.approx(expected[r["source"]])


def _check(df, rows, tolerance):
    documents = df.collect()
    expected, total = brute_targets([(r["source"], size_of(r["text"])) for r in documents])
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter(
        (r["doc_id"], size_of(r["text"])) for r in documents
    )
    sources = defaultdict(set)
    for r in documents:
        sources[r["doc_id"]].add(r["source"])
    taken = Counter()
    for r in rows:
        assert r["taken"] in (0, r["size"], 2 * r["size"], 3 * r["size"])
        if len(sources[r["doc_id"]]) == 1:
            source = next(iter(sources[r["doc_id"]]))
            assert r["source_size"] == total[source] and r["target"] == pytest.approx(expected[source])
            taken[source] += r["taken"]
            low, high = (expected[source] / total[source] // 1, -(-expected[source] / total[source] // 1)) if total[source] else (0, 0)
            assert low - 1e-6 <= r["taken"] / max(1, r["size"]) <= high + 1e-6 or not r["size"]
    for source in expected:
        largest = max((size_of(r["text"]) for r in documents if r["source"] == source), default=0)
        assert abs(taken[source] - expected[source]) <= max(1, tolerance * largest), source


@pytest.mark.parametrize("leaf", [10_000, 3])
def test_whole_table(spark, monkeypatch, leaf):
    """With tiny leaves the reduction tree has several levels."""
    monkeypatch.setattr(mixing, "LEAF", leaf)
    monkeypatch.setattr(mixing, "FAN", 2)
    df = table(spark, "documents")
    rows = op3_mixing(spark, df).collect()
    _check(df, rows, 1)
    again = op3_mixing(spark, df.repartition(5)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_large_source_is_met_closely(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "ab"[i % 3 == 0], int(s)) for i, s in enumerate(rng.lognormal(5, 1, 3000).astype(int) + 1)]
    got = each_row(copies(spark, spark.createDataFrame(rows, "doc_id long, source string, size long"))).collect()
    taken = Counter()
    for r in got:
        taken[r["source"]] += r["copies"] * r["size"]
    for r in got:
        assert abs(taken[r["source"]] - r["target"]) < 0.002 * r["target"]


def test_a_row_repeated_thousands_of_times(spark):
    """A third of a source's words are one row 5,000 times; each of them is drawn, so the target is met."""
    rng = np.random.default_rng(5)
    rows = [(i, "a", int(s)) for i, s in enumerate(rng.integers(20, 120, 12_000))]
    rows += [(10**6, "a", 70)] * 5000 + [(2 * 10**6 + i, "b", 40) for i in range(30_000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = each_row(copies(spark, df), most_at_once=300)
    taken = got.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("target").alias("target"), F.max("size").alias("most"),
        F.count("*").alias("n"), F.max("copies").alias("copies"),
    ).collect()
    for r in taken:
        assert abs(r["taken"] - r["target"]) <= r["most"] and r["copies"] <= 3
    assert {r["source"]: r["n"] for r in taken} == {"a": 17_000, "b": 30_000}
    texts = df.select("doc_id", F.array_join(F.array_repeat(F.lit("w"), F.col("size").cast("int")), " ").alias("text"), "source")
    mixed = mixed_documents(spark, texts).groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("n"))
    targets_ = {r["source"]: r["target"] for r in taken}
    assert all(abs(r["n"] - targets_[r["source"]]) < 0.02 * targets_[r["source"]] for r in mixed.collect())


def test_odd_rows(spark):
    df = crowded(docs(spark))
    rows = op3_mixing(spark, df).collect()
    assert len(rows) == len(ODD)
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in ODD)
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    equal = [r["taken"] for r in rows if r["doc_id"] == 5]
    assert abs(equal[0] - equal[1]) in (0, size_of(LONG))
    taken = Counter((r["doc_id"], r["size"]) for r in rows for _ in range(r["taken"] // max(1, r["size"])))
    mixed = mixed_documents(spark, df)
    assert mixed.columns == df.columns
    found = Counter((r["doc_id"], size_of(r["text"])) for r in mixed.collect())
    assert abs(found.pop((5, size_of(LONG)), 0) - taken.pop((5, size_of(LONG)), 0)) <= 2  # two equal rows, each drawn
    assert found == taken
    assert op3_mixing(spark, docs(spark, [])).count() == mixed_documents(spark, docs(spark, [])).count() == 0


def test_pivotal_keeps_mass_and_expectation():
    rng = np.random.default_rng(4)
    mass = np.sort(rng.integers(1, 50, 40))[::-1].astype(float)
    part = rng.random(40)
    mean = np.zeros(40)
    for seed in range(3000):
        p = part.copy()
        left = pivotal(mass, p, np.arange(40), seed)
        assert (mass * p).sum() == pytest.approx((mass * part).sum())
        assert all(x in (0, 1) for i, x in enumerate(p) if i != left)
        mean += p / 3000
    assert np.abs(mean - part).max() < 0.05
