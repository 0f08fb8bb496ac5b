"""Quality rules: countable rules, and hashed word and character n-gram logistic regression on labelled rows.

Training sees a bounded sample of the labelled rows; rules and scores cover all rows and whole texts. Scoring
works on Arrow batches as byte arrays; n-grams are hashed by prefix sums. What the rules count as equal is compared
itself: lines as bytes, windows by the numbers of their words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from aduana.llm import logistic
from aduana.llm.common import Block, SpanHash, mixed, table, text_blocks

#: Labelled rows of each class that the model is fitted on and, as many again by half, calibrated on.
SAMPLE_PER_CLASS = 500
WIDTH_BITS = 16
WORD_GRAMS = (1, 2)
CHAR_GRAMS = (3, 4)
#: A text goes if its calibrated probability of low quality is above this.
REJECT_ABOVE = 0.9
MIN_WORDS = 20
WINDOW = 8
REPEATED_PERCENT = 30

# White space, and what counts as a symbol.
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def low_quality(self, scores: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (scores + self.bias) + self.offset, -35, 35)))


class _Words:
    def __init__(self, block: Block):
        inside = ~_WHITE[block.data]
        self.inside = inside
        self.starts, self.ends = block.spans(inside)
        self.rows = block.row_of(self.starts)
        self.first = np.searchsorted(self.starts, block.offsets)
        self.counts = np.diff(self.first)


def rules(block: Block, words: _Words) -> dict[str, np.ndarray]:
    """Counts of every row of a block; see `judged`."""
    data, rows = block.data, block.rows
    lead = (data & 0xC0) != 0x80
    counts = {
        "n_words": words.counts,
        "word_chars": block.per_row(words.inside & lead),
        "n_symbols": block.per_row(_SYMBOL[data]),
    }
    counts["n_dup_lines"] = np.array([_repeated_lines(block.text(i)) for i in range(rows)], np.int64)

    # Windows of words, and the words below any window that its row has twice.
    numbers = block.word_numbers()
    n = len(numbers) - WINDOW + 1
    covered = np.zeros(len(numbers) + 1, np.int64)
    if n > 0:
        at = np.flatnonzero(words.rows[:n] == words.rows[WINDOW - 1:])
        twice = at[_repeated_windows(numbers, at, words.rows[at])]
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + WINDOW, -1)
    counts["n_repeat_words"] = np.bincount(words.rows[np.cumsum(covered[:-1]) > 0], minlength=rows)
    return counts


def _repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier one."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def _repeated_windows(numbers: np.ndarray, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Which of the windows that start `at` another window of the row equals. Hashes bring windows together, the
    numbers of their words decide."""
    keys = SpanHash(mixed(numbers.astype(np.uint64))).of(at, at + WINDOW)
    keys = mixed(keys + rows.astype(np.uint64) * np.uint64(SpanHash.BASE))
    order = np.argsort(keys, kind="stable")
    same = np.flatnonzero(keys[order][1:] == keys[order][:-1])
    a, b = order[same], order[same + 1]
    inside = np.arange(WINDOW)
    equal = (rows[a] == rows[b]) & (numbers[at[a, None] + inside] == numbers[at[b, None] + inside]).all(1)
    if not equal.all():  # different windows with one hash: those that have company are named by their words
        some = np.union1d(a, b)
        windows = np.column_stack([rows[some], numbers[at[some, None] + inside]])
        _, name, size = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
        a = b = some[size[name.ravel()] > 1]
        equal = np.ones(len(a), bool)
    twice = np.zeros(len(at), bool)
    twice[a[equal]] = True
    twice[b[equal]] = True
    return twice


def grams(block: Block, words: _Words, spans: SpanHash) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, column) of every n-gram, one kind after the other. Characters are bytes of UTF-8."""
    shift = np.uint64(64 - WIDTH_BITS)
    hashes = spans.of(words.starts, words.ends)
    for n in WORD_GRAMS:
        last = len(hashes) - n + 1
        if last > 0:
            at = np.flatnonzero(words.rows[:last] == words.rows[n - 1:])
            h = hashes[at]
            for k in range(1, n):
                h = h * np.uint64(SpanHash.BASE) + hashes[at + k]
            yield words.rows[at], (mixed(h + np.uint64(n)) >> shift).astype(np.int64)
    data = block.data.astype(np.uint64)
    rows = np.repeat(np.arange(block.rows), np.diff(block.offsets))
    for n in CHAR_GRAMS:
        last = len(data) - n + 1
        if last > 0:
            h = np.full(last, n, np.uint64)
            for k in range(n):
                h = (h << np.uint64(8)) | data[k:k + last]
            kept = rows[:last] == rows[n - 1:]
            yield rows[:last][kept], ((h[kept] * np.uint64(SpanHash.BASE)) >> shift).astype(np.int64)


def scores(block: Block, words: _Words, spans: SpanHash, weights: np.ndarray) -> np.ndarray:
    """Sum over the kinds of n-grams of their mean weight in each row."""
    total = np.zeros(block.rows)
    for rows, columns in grams(block, words, spans):
        found = np.bincount(rows, minlength=block.rows)
        total += np.bincount(rows, weights[columns], block.rows) / np.maximum(found, 1)
    return total


def fitted(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    per_class: int = SAMPLE_PER_CLASS,
) -> Model | None:
    """The model of the labelled rows; None if a class has no row.

    The sample is bounded by `per_class`: of either class, the rows whose ids come first by hash. Rows without an
    id or a label, and ids that were labelled in both ways, teach nothing. Two thirds are fitted on; the rest
    calibrates.
    """
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(id_col).agg(
        F.min(label_col).alias("low"), F.max(label_col).alias("high")
    ).filter("low = high")
    order = [F.xxhash64(F.col(id_col)), F.col(id_col)]
    picked = [
        known.filter(F.col("low") == c).orderBy(*order).limit(per_class).select(id_col, F.col("low").alias("_label"))
        for c in (0, 1)
    ]
    # The limits prove the size of what is broadcast.
    sample = docs.select(id_col, text_col).join(F.broadcast(picked[0].unionByName(picked[1])), id_col)

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch.column(1)):
                words, spans = _Words(block), SpanHash(block.data)
                found: list[dict[int, float]] = [{} for _ in range(block.rows)]
                for rows, columns in grams(block, words, spans):
                    keys, counts = np.unique(rows * (1 << WIDTH_BITS) + columns, return_counts=True)
                    share = counts / np.maximum(np.bincount(rows, minlength=block.rows), 1)[keys >> WIDTH_BITS]
                    for key, value in zip(keys.tolist(), share.tolist(), strict=True):
                        row = found[key >> WIDTH_BITS]
                        column = key & ((1 << WIDTH_BITS) - 1)
                        row[column] = row.get(column, 0.0) + value
                of = slice(block.first, block.first + block.rows)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[of], batch.column(2)[of].cast(pa.int32()),
                    pa.array([np.array(sorted(f), np.int32).tobytes() for f in found], pa.binary()),
                    pa.array([np.array([f[c] for c in sorted(f)], np.float32).tobytes() for f in found], pa.binary()),
                ], names=[id_col, "label", "columns", "shares"])

    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, label int, columns binary, shares binary"
    # An id that several rows carry counts once, so no more rows than labels come to the driver.
    once = sample.mapInArrow(sparse, schema).groupBy(id_col, "label").agg(
        F.min(F.struct("columns", "shares")).alias("f")
    )
    rows = once.select(id_col, "label", "f.*").orderBy(id_col).collect()
    low = np.array([1 - r["label"] for r in rows], np.int64)
    held = np.arange(len(rows)) % 3 == 2
    if min(np.bincount(low, minlength=2)) == 0:
        return None

    def triples(keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        chosen = [rows[i] for i in np.flatnonzero(keep)]
        columns = [np.frombuffer(r["columns"], np.int32) for r in chosen]
        shares = [np.frombuffer(r["shares"], np.float32) for r in chosen]
        of = np.repeat(np.arange(len(chosen)), [len(c) for c in columns])
        return of, np.concatenate([np.zeros(0, np.int32), *columns]), np.concatenate([np.zeros(0), *shares])

    if min(np.bincount(low[~held], minlength=2)) == 0 or min(np.bincount(low[held], minlength=2)) == 0:
        held = np.ones(len(rows), bool)  # too few rows to set some aside
        used = held
    else:
        used = ~held
    weights, bias = logistic.fit(*triples(used), low[used], 1 << WIDTH_BITS)
    of, columns, shares = triples(held)
    z = np.bincount(of, shares * weights[columns], int(held.sum())) + bias
    slope, offset = logistic.calibrate(z, low[held])
    return Model(weights.astype(np.float32), bias, slope, offset)


def judged(
    docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
    reject_above: float = REJECT_ABOVE, keep_columns: bool = False,
) -> DataFrame:
    """Counts, rule and verdict of every row; with `keep_columns`, the kept rows of `docs` instead.

    n_words words (runs without ASCII white space); word_chars code points in them; n_symbols; n_dup_lines lines
    with a word that equal an earlier one; n_repeat_words words in windows of eight words that the text has twice
    or more; base_failed too few words or too many repeated; low_quality the model's calibrated probability
    (null without a model); kept. A null text is empty and fails for want of words. A text of any length is judged whole by
    one task, in some 60 bytes for each of its own. Null ids stay, repeated rows
    are judged alike, an empty table gives no row, other columns are not read.
    """
    weights = docs.sparkSession.sparkContext.broadcast(model.weights) if model else None  # 1 << WIDTH_BITS floats
    bias, slope, offset = (model.bias, model.slope, model.offset) if model else (0.0, 0.0, 0.0)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    text_at = docs.columns.index(text_col)

    def verdicts(block: Block) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray | None]:
        words, spans = _Words(block), SpanHash(block.data)
        counts = rules(block, words)
        n = counts["n_words"]
        failed = (n < MIN_WORDS) | (100 * counts["n_repeat_words"] > REPEATED_PERCENT * n)
        if weights is None:
            return counts, failed, None
        z = scores(block, words, spans, weights.value)
        return counts, failed, Model(weights.value, bias, slope, offset).low_quality(z)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch.column(1)):
                counts, failed, low = verdicts(block)
                kept = ~failed if low is None else ~failed & (low <= reject_above)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[block.first:block.first + block.rows],
                    *[pa.array(counts[c].astype(np.int64)) for c in names], pa.array(failed),
                    pa.nulls(block.rows, pa.float64()) if low is None else pa.array(low.astype(np.float64)),
                    pa.array(kept),
                ], names=[id_col, *names, "base_failed", "low_quality", "kept"])

    def only_kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for block in text_blocks(batch.column(text_at)):
                _, failed, low = verdicts(block)
                keep[block.first:block.first + block.rows] = ~failed & (True if low is None else low <= reject_above)
            yield batch.filter(pa.array(keep))

    if keep_columns:
        return docs.mapInArrow(only_kept, docs.schema)
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        judge,
        f"{id_col} {docs.schema[id_col].dataType.simpleString()}, {', '.join(f'{c} long' for c in names)}, "
        "base_failed boolean, low_quality double, kept boolean",
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judged(docs, fitted(docs, table(spark, sf_dir, "labels")))
