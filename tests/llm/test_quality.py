from __future__ import annotations

import re
from collections import Counter

import numpy as np

from aduana.llm import logistic
from aduana.llm.quality import fitted, judged
from tests.llm.cases import crowded, docs, table

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
        len(covered),
    )


def test_counts_and_base_rule(spark):
    extra = [(20, "a b\r\na b\r\n\n \n \na b", None, None, 0), (21, "q w e r t y u i " * 2 + "o", None, None, 0)]
    for df in (table(spark, "documents"), crowded(docs(spark)), docs(spark, extra)):
        got = judged(df, None)
        texts = {r["doc_id"]: r["text"] for r in df.collect() if r["doc_id"] is not None}
        rows = got.collect()
        assert len(rows) == df.count()
        for r in rows:
            if r["doc_id"] is None:
                continue
            counts = brute(texts[r["doc_id"]])
            assert tuple(r[c] for c in NAMES) == counts
            failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
            assert (r["base_failed"], r["kept"], r["low_quality"]) == (failed, not failed, None)
    assert judged(docs(spark, []), None).count() == 0


def thue_morse(n, a, b):
    return "".join((a, b)[bin(i).count("1") % 2] for i in range(n))


def test_equal_is_equal_not_hashed_alike(spark):
    """A word of two letters and its complement, which every polynomial hash modulo 2^64 takes for equal."""
    one, two = thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a")
    window = "{} c d e f g h i"
    texts = [
        f"{one}\n{two}", f"{one}\n{two}\n{one}", f"{window.format(one)} x {window.format(two)}",
        f"{window.format(one)} x {window.format(two)} y {window.format(one)}", thue_morse(9000, "p ", "q "),
        thue_morse(3000, "p ", "q ") + "\n" + thue_morse(3000, "q ", "p "),
    ]
    rows = judged(docs(spark, [(i, t, None, None, 0) for i, t in enumerate(texts)]), None).collect()
    assert {r["doc_id"]: tuple(r[c] for c in NAMES) for r in rows} == {i: brute(t) for i, t in enumerate(texts)}


def test_windows_with_one_hash_are_told_apart(monkeypatch):
    from aduana.llm import quality

    numbers = np.random.default_rng(3).integers(0, 2, 400)
    rows = np.repeat([0, 1], 200)
    at = np.flatnonzero(rows[:-7] == rows[7:])
    wanted = quality._repeated_windows(numbers, at, rows[at])
    seen = Counter((rows[i], *numbers[i:i + 8]) for i in at.tolist())
    assert wanted.tolist() == [seen[(rows[i], *numbers[i:i + 8])] > 1 for i in at.tolist()]
    sums = np.concatenate([[0], np.cumsum(numbers)])
    monkeypatch.setattr(quality.SpanHash, "of", lambda self, a, b: (sums[b] - sums[a]).astype(np.uint64))
    monkeypatch.setattr(quality, "mixed", lambda h: h)
    assert quality._repeated_windows(numbers, at, rows[at]).tolist() == wanted.tolist()


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    df = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    train, held = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    rows = judged(df, fitted(df, train)).join(held, "doc_id").filter("not base_failed").collect()
    low = [r for r in rows if r["quality"] == 0]
    good = [r for r in rows if r["quality"] == 1]
    assert np.mean([r["kept"] for r in good]) > 0.99
    assert np.mean([not r["kept"] for r in low]) > 0.9


def test_model_is_the_same_again(spark):
    df, labels = table(spark, "documents"), table(spark, "labels")
    a, b = fitted(df, labels), fitted(df.repartition(7), labels.repartition(3))
    assert np.array_equal(a.weights, b.weights) and (a.bias, a.slope, a.offset) == (b.bias, b.slope, b.offset)


def test_labels_that_teach_nothing(spark):
    df = docs(spark)
    one = spark.createDataFrame([(1, 1), (None, 0), (3, None), (4, 0), (4, 1)], "doc_id long, quality int")
    assert fitted(df, one) is None
    assert fitted(df, one.limit(0)) is None


def test_stage_keeps_rows_as_they_are(spark):
    df = crowded(docs(spark))
    kept = judged(df, None, keep_columns=True)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {
        r["doc_id"] for r in judged(df, None).collect() if r["kept"]
    }


def test_calibration_and_fit_separate():
    rng = np.random.default_rng(0)
    labels = (np.arange(400) % 2 == 0).astype(int)
    scores = labels * 2.0 + rng.normal(0, 1, 400)
    a, b = logistic.calibrate(scores, labels)
    p = 1 / (1 + np.exp(-(a * scores + b)))
    for low in (0.2, 0.4, 0.6):
        chosen = (p >= low) & (p < low + 0.2)
        assert abs(p[chosen].mean() - labels[chosen].mean()) < 0.15
    weights, bias = logistic.fit(np.arange(400), labels, np.ones(400), labels, 2)
    assert weights[1] + bias > 0 > weights[0] + bias
