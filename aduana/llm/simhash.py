"""SimHash near-duplicates: pivot distance tables over 64-bit fingerprints.

Every distinct fingerprint gets its Hamming distances to many reference fingerprints. By the triangle inequality
two fingerprints within r bits have coordinates that differ by at most r, so a pair with a larger difference in any
coordinate is discarded, and only survivors are verified. Coordinates alone would leave a share of all pairs that
does not fall with their number; so the tables are divided first: with r differing bits, at least two of r + 2
bands are equal in a linked pair, and every pair of bands is a table of its own, keyed by their bits. A table that is
still too large is divided again by parts of the other bits, of which one must be equal.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from aduana.llm.common import free_name, text_of, written
from aduana.llm.components import components

SHINGLE = 3
BITS = 2
SEED = 42
PIVOTS = 16
#: Rows of a table that are compared with each other at once; of more, one at a time meets the rest.
TILE = 512
#: Rows of a table that one task compares.
TABLE_ROWS = 4096


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit i is 1 if it is set in over half of the shingles' hashes; a text without words is zero."""
    import xxhash

    words = text.encode().lower().split()  # of bytes: both know only the ASCII letters and blanks
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-1]])[: len(words) - shingle + 1].tolist()
        hashes = [digest(joined[s:e], seed) for s, e in zip(starts, (ends[shingle - 1:] - 1).tolist(), strict=True)]
    ones = np.zeros(64, np.int64)
    values = np.array(hashes, ">u8")
    for first in range(0, len(values), 1 << 14):
        bits = np.unpackbits(values[first:first + (1 << 14)].view(np.uint8)).reshape(-1, 64)
        ones += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(values)).tobytes(), "big")


def with_fingerprint(
    docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED, name: str = "fp",
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns `keep` (all by default) and the fingerprint, as the signed long with its bits. A null text is
    empty: zero."""
    rows, keep = docs, docs.columns if keep is None else keep
    if keep != docs.columns:
        rows = docs.select(*dict.fromkeys([*keep, text_col]))
    text_at, places = rows.columns.index(text_col), [rows.columns.index(c) for c in keep]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text_of(x.as_py()), shingle, seed) for x in batch.column(text_at)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in places], pa.array(np.array(prints, np.uint64).view(np.int64))],
                names=[*keep, name],
            )

    return rows.mapInArrow(hashed, StructType([docs.schema[c] for c in keep] + [StructField(name, LongType())]))


def reference_fingerprints(pivots: int = PIVOTS, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, pivots, np.uint64) * np.uint64(2) + np.uint64(1)


def band_masks(bits: int) -> list[int]:
    """Masks of all pairs of bits + 2 bands that divide the 64 bits."""
    edges = [64 * i // (bits + 2) for i in range(bits + 3)]
    bands = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:], strict=False)]
    return [a | b for a, b in combinations(bands, 2)]


def pivot_links(fps: np.ndarray, bits: int, pivots: np.ndarray) -> list[tuple[int, int]]:
    """Links between distinct fingerprints of one table that join each of its components: not all pairs.

    Sorted by the distance to the first pivot, a fingerprint can be linked only with those up to `bits` further;
    the other coordinates discard most of these, and the exact distance decides.
    """
    table = np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)
    order = np.lexsort((fps, table[:, 0]))
    fps, table = fps[order], table[order]
    first = table[:, 0]
    reach = np.searchsorted(first, first + bits, "right")
    root = np.arange(len(fps))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = int(root[i])
        return i

    links = []
    for start in range(0, len(fps), TILE):
        stop = min(start + TILE, len(fps))
        for other in range(start, int(reach[stop - 1]), TILE):
            until = min(other + TILE, len(fps))
            near = np.ones((stop - start, until - other), bool)
            for p in range(table.shape[1]):
                near &= np.abs(table[start:stop, p, None] - table[None, other:until, p]) <= bits
                if p in (3, 7) and np.count_nonzero(near) < 64:
                    break
            i, j = np.nonzero(near)
            i, j = i + start, j + other
            kept = i < j
            i, j = i[kept], j[kept]
            kept = np.bitwise_count(fps[i] ^ fps[j]) <= bits
            for x, y in zip(i[kept].tolist(), j[kept].tolist(), strict=True):
                p, q = top(x), top(y)
                if p != q:
                    root[max(p, q)] = min(p, q)
                    links.append((x, y))
    return [(int(fps[x]), int(fps[y])) for x, y in links]


def finer_masks(mask: int, bits: int) -> list[int]:
    """The mask with each of bits + 1 parts of the bits it leaves out: fingerprints within `bits` that are equal under
    the mask are equal under one of these as well."""
    left = [i for i in range(64) if not mask >> i & 1]
    edges = [len(left) * i // (bits + 1) for i in range(bits + 2)]
    return [mask | sum(1 << i for i in left[lo:hi]) for lo, hi in zip(edges, edges[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprint_links(
    spark: SparkSession, fps: DataFrame, bits: int = BITS, pivots: int = PIVOTS, table_rows: int = TABLE_ROWS
) -> DataFrame:
    """(a, b) fingerprints within `bits`, enough of them that components are those of all such pairs.

    fps: distinct values in `fp`. Tables are keyed by the bits under a mask. A task reads them as a stream in the
    order of their keys; only tables with two rows or more do any work. The rows of a table with more than
    `table_rows` are handed back and dealt out again under finer masks, as often as it takes, so that a family of any
    size is compared by many tasks.
    """
    references = reference_fingerprints(pivots)
    masks = F.array(*[F.lit(_signed(m)) for m in band_masks(bits)])
    keyed = fps.select("fp", F.explode(masks).alias("mask"))

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = handed = None  # rows of the last key so far, and a key whose rows are handed back
        for batch in batches:
            rows = np.column_stack([batch["mask"].to_numpy(np.int64), batch["k"], batch["fp"]])
            if handed is not None:
                of = (rows[:, 0] == handed[0]) & (rows[:, 1] == handed[1])
                if of.any():
                    yield back(rows[of])
                    rows = rows[~of]
                if not len(rows):
                    continue
                handed = None
            if rest is not None:
                rows = np.concatenate([rest, rows])
            last = np.flatnonzero((rows[:, 0] != rows[-1, 0]) | (rows[:, 1] != rows[-1, 1]))
            end = int(last[-1]) + 1 if len(last) else 0
            yield from of_tables(rows[:end])
            rest = rows[end:]
            if len(rest) > table_rows:
                yield back(rest)
                handed, rest = rest[0, :2], None
        if rest is not None:
            yield from of_tables(rest)

    def back(rows: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"a": rows[:, 2], "b": rows[:, 2], "mask": rows[:, 0], "open": True})

    def of_tables(rows: np.ndarray) -> Iterator[pd.DataFrame]:
        if not len(rows):
            return
        found: list[tuple[int, int]] = []
        new = np.flatnonzero(np.any(rows[1:, :2] != rows[:-1, :2], axis=1)) + 1
        edges = np.concatenate([[0], new, [len(rows)]])
        sizes = np.diff(edges)
        for i in np.flatnonzero(sizes > 1):
            table = rows[edges[i]:edges[i + 1]]
            if len(table) > table_rows:
                yield back(table)
            else:
                found += pivot_links(table[:, 2].view(np.uint64), bits, references)
        pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        yield pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1], "mask": np.int64(0), "open": False})

    done: list[DataFrame] = []
    while True:
        tables = keyed.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("k"), "fp")
        result = written(spark, tables.repartition("mask", "k").sortWithinPartitions("mask", "k").mapInPandas(
            linked, "a long, b long, mask long, open boolean"
        ), "links")
        done.append(result.filter("not open").select("a", "b"))
        left = result.filter("open")
        coarse = [r["mask"] for r in left.select("mask").distinct().collect()]  # three times as many a round at most
        if not coarse:
            return reduce(DataFrame.unionByName, done)
        finer = [(m, _signed(f)) for m in coarse for f in finer_masks(m % (1 << 64), bits)]
        pairs = spark.createDataFrame(finer, "mask long, finer long")
        keyed = left.join(pairs, "mask").select(F.col("a").alias("fp"), F.col("finer").alias("mask")).distinct()


def near_duplicates(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    bits: int = BITS,
    seed: int = SEED,
) -> DataFrame:
    """(id, fp, component_id) of every row: component_id is the smallest id reachable over links of fingerprints
    that differ in at most `bits` bits.

    Null and blank texts share the fingerprint zero and are linked like any other. Rows with a null id belong to
    the component of their text; they name it only if no id does (null). Repeated rows come back as often as they
    came; an empty table gives no row; other columns are not read. Equal texts meet as one fingerprint with its
    smallest id, so the size of a group of copies matters to no task.
    """
    prints = written(spark, with_fingerprint(docs, text_col, shingle, seed, keep=[id_col]), "fingerprints")
    named = rooted(spark, prints.groupBy("fp").agg(F.min(id_col).alias("first")), bits)
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = named.join(smallest, "root").select("fp", "component_id")
    return prints.join(labels, "fp").select(id_col, "fp", "component_id")


def rooted(spark: SparkSession, classes: DataFrame, bits: int) -> DataFrame:
    """(fp, first, root) of distinct fingerprints: root is the smallest fingerprint of the component."""
    classes = written(spark, classes, "classes")
    linked = components(spark, fingerprint_links(spark, classes.select("fp"), bits)).withColumnRenamed("node", "fp")
    return classes.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def deduplicated(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shingle: int = SHINGLE, bits: int = BITS, seed: int = SEED,
) -> DataFrame:
    """One row of `docs` for each component of `near_duplicates`, with all its columns, whatever their names: the one
    with the smallest id, or any one if none has an id. Null and empty texts are one component with those linked to
    fingerprint zero; of rows that repeat the id and fingerprint one stays; texts of any length are read whole; an
    empty table stays empty."""
    mark, key = free_name(docs, "_simhash"), free_name(docs, "_simhash_key")
    rows = written(spark, with_fingerprint(docs, text_col, shingle, seed, mark), "fingerprints")
    named = rooted(spark, rows.groupBy(F.col(mark).alias("fp")).agg(F.min(id_col).alias("first")), bits)
    kept = named.groupBy("root").agg(
        F.min_by(F.struct("fp", "first"), F.struct(F.col("first").isNull(), "first", "fp")).alias("k")
    ).select(F.struct(F.col("k.fp").alias("f"), F.col("k.first").alias("i")).alias(key))
    # One key, in which nulls are equal: rows that repeat the id and the fingerprint have met in the join
    # already, and a fingerprint that very many rows share is dealt out by their ids.
    keyed = rows.withColumn(key, F.struct(F.col(mark).alias("f"), F.col(id_col).alias("i")))
    return keyed.join(kept, key, "left_semi").dropDuplicates([key]).select(*docs.columns)


def op7_simhash(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return near_duplicates(spark, docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
