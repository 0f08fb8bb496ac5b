"""Periodic runs of words: online dyadic square catching.

A run of period q that is four periods long or more has, for the power of two L with L <= q < 2L, a completed block
of L words that comes again q words later: a square. So every level L keeps a catcher for each completed block: when
a word is appended, the suffix of L words that it ends is compared with the block that the catcher before it holds.
A square that the block after next confirms at the same distance belongs to the same run; squares merge into runs
before anything else is done with them. The words of a block of documents are appended together: what one word does
at a level is one element of an array operation, so a text of n words costs about n steps at each of log n levels.

Suffixes are compared by hashes that are doubled from level to level. A reported run is compared word by word.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from aduana.llm.common import mixed, table, text_blocks, words_of

#: A run has at least so many periods, and so many words.
PERIODS, LEAST = 4, 6
#: Words that are compared at once where runs are extended.
COMPARED = 1 << 21
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _extended(words: np.ndarray, at: np.ndarray, period: np.ndarray, level: int, step: int) -> np.ndarray:
    """How many of the next `level` words, from `at` on in the direction of `step`, equal those a period later."""
    found = np.zeros(len(at), np.int64)
    ahead = step * np.arange(level)
    rows = max(1, COMPARED // level)
    for first in range(0, len(at), rows):
        place = at[first:first + rows, None] + ahead
        later = place + period[first:first + rows, None]
        same = (place >= 0) & (later < len(words))
        same &= words[np.where(same, place, 0)] == words[np.where(same, later, 0)]
        found[first:first + rows] = np.where(same.all(1), level, same.argmin(1))
    return found


def _not_primitive(suffix: np.ndarray, block: np.ndarray, period: np.ndarray, level: int) -> np.ndarray:
    """Squares whose period is a multiple of a smaller one: a run of that one covers them, and its level reports it."""
    smaller = np.zeros(len(block), bool)
    rest, factor = period.copy(), 2
    while (rest > 1).any():
        divides = rest % factor == 0
        if divides.any():
            i = np.flatnonzero(divides & ~smaller)
            shift, end = period[i] // factor, block[i] + period[i] - level
            smaller[i] = (suffix[block[i]] == suffix[block[i] + shift]) & (suffix[end] == suffix[end + shift])
            while divides.any():
                rest[divides] //= factor
                divides = rest % factor == 0
        factor += 1
        if factor * factor > int(rest.max(initial=1)):
            for prime in np.unique(rest[rest > 1]):  # what is left of each period is one prime
                i = np.flatnonzero((rest == prime) & ~smaller)
                shift, end = period[i] // prime, block[i] + period[i] - level
                smaller[i] = (suffix[block[i]] == suffix[block[i] + shift]) & (suffix[end] == suffix[end + shift])
            break
    return smaller


def find_runs(
    words: np.ndarray, offsets: np.ndarray, periods: int = PERIODS, least: int = LEAST
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start and period; words are numbers, texts begin at `offsets`.

    start counts over all texts. A run is maximal, its period the smallest it has, and its length at least `least`
    words and `periods` (3 or more) periods.
    """
    rows, counts = len(offsets) - 1, np.diff(offsets)
    # A word of its own ends every text, so that nothing is equal across an end.
    ends = offsets[1:] + np.arange(rows)
    text = np.zeros(len(words) + rows, np.int64)
    inner = np.ones(len(text), bool)
    inner[ends] = False
    text[inner], text[ends] = words, -1 - np.arange(rows)
    place = np.zeros(len(text), np.int64)
    place[inner] = np.arange(len(words))
    sizes, level = counts, 1
    suffix = mixed(text.view(np.uint64) + np.uint64(1))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while True:
        long_enough = sizes >= max(least, periods * level)
        if not long_enough.any():
            break
        if not long_enough.all():
            kept = np.repeat(long_enough, sizes + 1)
            text, place, suffix, sizes = text[kept], place[kept], suffix[kept], sizes[long_enough]
        found += _caught(text, place, suffix, level, periods, least)
        following = np.arange(len(text), dtype=np.uint64)  # beyond the last text: equal to nothing
        following[:-level] = suffix[level:]
        suffix = mixed(suffix * _FACTOR + following)
        level *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, length, period = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(start), bool)  # of one stretch of words, the smallest period
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[first], length[first], period[first]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _caught(
    text: np.ndarray, place: np.ndarray, suffix: np.ndarray, level: int, periods: int, least: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs with periods from `level` to twice that. suffix: hash of the `level` words from each place on."""
    n = len(text) - level + 1
    hits = np.zeros(len(text) + level, bool)
    catchers = suffix[0:max(0, n - level):level]
    hits[level:n] = suffix[level:n] == np.repeat(catchers, level)[:n - level]
    here = np.flatnonzero(hits)
    first = here[~hits[here - level]]
    last = here[~hits[here + level]]
    # Squares of one distance in blocks that follow each other are one stretch of equal words.
    first = first[np.lexsort((first, first % level))]
    last = last[np.lexsort((last, last % level))]
    block, period, equal = (first // level - 1) * level, level + first % level, last - first + level
    needed = np.maximum(least, periods * period) - period
    kept = equal + 2 * (level - 1) >= needed
    block, period, equal, needed = block[kept], period[kept], equal[kept], needed[kept]
    kept = ~_not_primitive(suffix, block, period, level)
    block, period, equal, needed = block[kept], period[kept], equal[kept], needed[kept]
    left = _extended(text, block - 1, period, level, -1)
    right = _extended(text, block + equal, period, level, 1)
    start, equal = block - left, equal + left + right
    kept = equal >= needed
    for s, e, q, least_equal in zip(*(x[kept].tolist() for x in (start, equal, period, needed)), strict=True):
        same = text[s:s + e] == text[s + q:s + q + e]
        if same.all():
            yield place[s:s + 1], np.array([e + q]), np.array([q])
            continue
        # Hashes were equal and words not: the stretches of equal words in it.
        edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
        for a, b in edges.reshape(-1, 2).tolist():
            if b - a >= least_equal:
                yield place[s + a:s + a + 1], np.array([b - a + q]), np.array([q])


Edit = Callable[[object, int], "np.ndarray | None"]


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", periods: int = PERIODS, least: int = LEAST,
    edit: Edit | None = None,
) -> DataFrame:
    """(id, n_words, runs, best, collapsed) of every row.

    Words are what stands between ASCII blanks, numbered from 0. runs are (start, length, period), by start and
    period; best is the place in them, from 0, of the one with the greatest length / period (then the smallest start,
    then the smallest period), null without a run. collapsed has the words that no run contains after its first
    period, joined by blanks. edit(id, n) may give the places that the n words of a text are taken from first.

    A null text has no word. A null id stays null; repeated rows are worked on alike and come back as often as they
    came; an empty table gives no row; other columns are not read, whatever their names. A text of any length is
    worked on whole by one task; a text of 10 million words takes that task some 1 GB.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", "n_words", "runs", "best", "collapsed"]

    def collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
            for part in text_blocks(texts):
                of = slice(part.first, part.first + part.rows)
                yield pa.RecordBatch.from_arrays([batch.column(0)[of], *one(batch.column(0)[of], texts[of])], names=names)

    def one(keys: pa.Array, texts: pa.Array) -> list[pa.Array]:
        flat, offsets = words_of(texts)
        source = np.arange(len(flat))
        if edit is not None:
            for row, key in enumerate(keys.to_pylist()):
                taken = edit(key, int(offsets[row + 1] - offsets[row]))
                if taken is not None:
                    source[offsets[row]:offsets[row + 1]] = offsets[row] + taken
        numbers = np.asarray(flat.dictionary_encode().indices).astype(np.int64)[source]
        start, length, period = find_runs(numbers, offsets, periods, least)
        row = np.searchsorted(offsets, start, "right") - 1
        bounds = np.searchsorted(row, np.arange(len(texts) + 1))
        covered = np.zeros(len(flat) + 1, np.int64)
        np.add.at(covered, start + period, 1)
        np.add.at(covered, start + length, -1)
        stays = np.cumsum(covered[:-1]) == 0
        sums = np.zeros(len(flat) + 1, np.int64)
        np.cumsum(stays, out=sums[1:])
        lists = pa.ListArray.from_arrays(
            pa.array(sums[offsets], pa.int32()), flat.take(pa.array(source[stays]))
        )
        found = pa.StructArray.from_arrays(
            [pa.array(x.astype(np.int64)) for x in (start - offsets[row], length, period)], ["start", "length", "period"]
        )
        best = [_best(length[a:b], period[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
        return [
            pa.array(np.diff(offsets)), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), found),
            pa.array(best, pa.int32()), pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string()),
        ]

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        collapsed,
        f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, best int, "
        "collapsed string",
    ).withColumnRenamed("id", id_col)


def _best(length: np.ndarray, period: np.ndarray) -> int | None:
    """Place of the greatest exact quotient; the first of equal ones, as runs come by start and period."""
    best = None
    for i, (n, q) in enumerate(zip(length.tolist(), period.tolist(), strict=True)):
        if best is None or n * best[2] > best[1] * q:
            best = (i, n, q)
    return best and best[0]


def looped(key: object, n: int) -> np.ndarray | None:
    """In a tenth of the ids, drawn by checksum, the words from one place on repeat what stands there."""
    if key is None or not n:
        return None
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic_runs(table(spark, sf_dir, "documents"), edit=looped)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return rows.withColumn("top", F.get("runs", "best")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
