"""Document fingerprints by Order MinHash, and how alike neighbouring and edited texts are.

For each of several hash functions the few smallest occurrence-numbered k-mers of a text are put back into text
order and hashed as a tuple. Two texts share a tuple if they share these k-mers in the same order, so the share of
equal tuples falls with the edit distance, also when an edit only moves things.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from aduana.llm.common import mixed, text_of

KMER = 5  # code points
TUPLE = 2  # k-mers of a tuple
FUNCTIONS = 50  # tuples of a fingerprint; with 20 many texts that share half with another have none in common
SEED = 7
#: K-mers of a long text that are looked at together.
PIECE = 1 << 15

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class OrderMinHash:
    def __init__(self, kmer: int = KMER, tuple_size: int = TUPLE, functions: int = FUNCTIONS, seed: int = SEED):
        draw = np.random.default_rng(seed)
        self.kmer, self.size, self.functions = kmer, tuple_size, functions
        self.factor = (draw.integers(0, 1 << 32, functions, np.uint64) | np.uint64(1)).astype(np.uint32)
        self.weights = np.array([pow(int(_SPREAD), i + 1, 1 << 64) for i in range(kmer)], np.uint64)

    def numbered(self, text: str) -> np.ndarray:
        """64-bit hashes of the k-mers in text order, each with its number among equal ones. A text shorter than
        a k-mer is a single one; the empty text has none."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        n = max(len(points) - self.kmer + 1, min(1, len(points)))
        h = np.zeros(n, np.uint64)
        for start in range(0, n, PIECE):
            part = points[start:start + PIECE + self.kmer - 1].astype(np.uint64) + np.uint64(1)
            size = min(PIECE, n - start)
            if len(part) < self.kmer:
                part = np.concatenate([part, np.zeros(self.kmer - len(part), np.uint64)])
            for j in range(self.kmer):
                h[start:start + size] += part[j:j + size] * self.weights[j]
            h[start:start + size] = mixed(h[start:start + size])
        if n < 2:
            return h
        # Equal k-mers meet when sorted with their place in the low bits; numbers follow the places.
        place = (np.uint64(1) << np.uint64(n.bit_length())) - np.uint64(1)
        keys = h & ~place
        for start in range(0, n, PIECE):
            keys[start:start + PIECE] |= np.arange(start, min(start + PIECE, n), dtype=np.uint64)
        keys.sort()
        if all((keys[a + 1:a + PIECE + 1] ^ keys[a:a + PIECE][:len(keys) - a - 1] > place).all() for a in range(0, n, PIECE)):
            return h
        first = 0  # of the k-mers equal to the one before a piece
        for start in range(0, n, PIECE):
            part = keys[start:start + PIECE]
            new = np.ones(len(part), bool)
            new[1:] = part[1:] ^ part[:-1] > place
            if start:
                new[0] = part[0] ^ keys[start - 1] > place
            at = np.arange(start, start + len(part))
            firsts = np.maximum.accumulate(np.where(new, at, first))
            first = int(firsts[-1])
            places = (part & place).astype(np.int64)
            h[places] = mixed(h[places] + (at - firsts).astype(np.uint64) * _SPREAD)
        return h

    def _values(self, h: np.ndarray) -> np.ndarray:
        """What each function makes of each k-mer."""
        values = (h >> np.uint64(32)).astype(np.uint32)[None, :] * self.factor[:, None]
        values ^= values >> np.uint32(15)
        values *= np.uint32(0x2C1B3C6D)
        return values

    def _smallest(self, h: np.ndarray, size: int) -> np.ndarray:
        """Places of the smallest of each function, for a long text: piece by piece, only the smallest so far stay."""
        best = np.zeros((self.functions, 0), np.uint64)
        for start in range(0, len(h), PIECE):
            keys = self._values(h[start:start + PIECE]).astype(np.uint64) << np.uint64(32)
            keys |= np.arange(start, start + keys.shape[1], dtype=np.uint64)
            if keys.shape[1] > size:
                keys = np.partition(keys, size - 1, axis=1)[:, :size]
            best = np.sort(np.concatenate([best, keys], axis=1), axis=1)[:, :size]
        return (best & np.uint64(0xFFFFFFFF)).astype(np.int64)

    def signature(self, text: str) -> np.ndarray:
        """One 32-bit tuple hash for each function."""
        h = self.numbered(text)
        n = len(h)
        if not n:
            return np.zeros(self.functions, np.uint32)
        size = min(self.size, n)
        if n > PIECE:
            return self._folded(h, self._smallest(h, size))
        values = self._values(h)
        # Nearly always the smallest lie below this limit; a function with too few there looks at all.
        limit = min(1.0, (self.size + 8) / n)
        at = np.flatnonzero((values <= np.uint32(int(limit * 0xFFFFFFFF))).ravel())
        rows = at // n
        order = np.argsort((rows.astype(np.uint64) << np.uint64(32)) | values.ravel()[at], kind="stable")
        rows, places = rows[order], at[order] - rows[order] * n
        first = np.searchsorted(rows, np.arange(self.functions + 1))
        chosen = np.empty((self.functions, size), np.int64)
        enough = np.diff(first) >= size
        chosen[enough] = places[first[:-1][enough, None] + np.arange(size)]
        for i in np.flatnonzero(~enough):
            chosen[i] = np.argsort(values[i], kind="stable")[:size]
        return self._folded(h, chosen)

    def _folded(self, h: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """Tuples of the chosen places of each function, in text order, hashed."""
        chosen.sort(axis=1)
        folded = np.full(self.functions, chosen.shape[1], np.uint64)
        for j in range(chosen.shape[1]):
            folded = mixed(folded * _SPREAD + h[chosen[:, j]])
        return (folded >> np.uint64(32)).astype(np.uint32)

    def fingerprint(self, text: str) -> str:
        return self.signature(text).astype(">u4").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Share of equal tuples."""
    n = max(1, len(a) // 8)
    return sum(a[i:i + 8] == b[i:i + 8] for i in range(0, len(a), 8)) / n


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hasher: OrderMinHash | None = None
) -> DataFrame:
    """(id, n_chars, fingerprint) of every row; a null text is empty, other columns are not read."""
    hasher = hasher or OrderMinHash()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text_of(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(x) for x in texts], pa.int64()),
                pa.array([hasher.fingerprint(x) for x in texts], pa.string()),
            ], names=[id_col, "n_chars", "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(hashed, f"{id_col} {kind}, n_chars long, fingerprint string")


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the beginning of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def with_next(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    hasher: OrderMinHash | None = None, ranges: int | None = None,
) -> DataFrame:
    """Every row with its fingerprint, that of its edited text, and its likeness to that and to the next row.

    Next is the row with the next smaller id; the smallest is followed by the largest. Equal ids follow each other
    by text; rows with a null id come last. A single row follows itself; an empty table gives no row; a null text
    is empty. Ids are whole numbers. Texts of any length are hashed whole, in some 25 bytes a character. Other columns
    are not read, whatever their names.

    Rows are dealt out by ranges of ids whose upper ends are ids of the table, so that the row that follows a
    range's last one is known beforehand and sent along: texts are shuffled once, and no task sorts all of them.
    """
    hasher = hasher or OrderMinHash()
    ranges = ranges or 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    marks = [i / ranges for i in range(1, ranges)]
    found = docs.agg(F.percentile_approx(id_col, marks, 10 * ranges), F.max(id_col)).first()
    ends = np.array(sorted({*(found[0] or []), found[1]} - {None}), np.int64)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            prints = [hasher.fingerprint(text_of(x.as_py())) for x in texts]
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            values = ids.fill_null(0).to_numpy()
            at = np.where(known, np.searchsorted(ends, values), 0)
            copied = np.zeros(0, np.int64)
            if len(ends):
                copied = np.flatnonzero(known & (ends[np.minimum(at, len(ends) - 1)] == values))
            rows = np.concatenate([np.arange(batch.num_rows), copied])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([at, (at[copied] + 1) % max(1, len(ends))]), pa.int64()),
                pa.array(np.arange(len(rows)) >= batch.num_rows),
                ids.take(pa.array(rows)), texts.take(pa.array(rows)),
                pa.array([prints[i] for i in rows.tolist()], pa.string()),
            ], names=["part", "sent", "id", "text", "fingerprint"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = first = None
        done: list[tuple] = []

        def close(row: tuple, following: tuple) -> None:
            text = edited(row[3], following[3])
            mark = hasher.fingerprint(text)
            digest = hashlib.sha256(text.encode()).hexdigest()
            done.append((
                row[2], len(row[3]), digest, row[4], mark, likeness(row[4], mark), likeness(row[4], following[4])
            ))

        def flush() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            columns = list(zip(*done, strict=True)) or [[]] * len(kinds)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                row = (*row[:3], text_of(row[3]), row[4])
                if held is not None and held[0] != row[0]:
                    close(held, first)  # no row was sent along: there is no other range
                    held = first = None
                if held is not None:
                    close(held, row)
                    held = None if row[1] else row
                    if row[1]:
                        first = None
                elif not row[1]:
                    # After the row that was sent along, further ones are copies of it; they are passed over.
                    held = first = row
            yield flush()
            done = []
        if held is not None:
            close(held, first)
            yield flush()

    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    dealt = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        spread, "part long, sent boolean, id long, text string, fingerprint string"
    )
    placed = dealt.repartition(ranges, "part").sortWithinPartitions(
        "part", "sent", F.desc_nulls_last("id"), F.asc_nulls_first("text")
    )
    return placed.mapInArrow(
        compared,
        "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    ).withColumnRenamed("id", id_col)


def op6_fingerprints(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return with_next(spark, docs)
