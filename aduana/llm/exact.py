"""Exact dedup: counting quotient filters of text fingerprints, and byte verification of those that occur twice.

A task puts the fingerprints of its rows into a filter. Filters of one range of fingerprints are merged by their
sorted remainders, which loses nothing: quotient and remainder are the fingerprint. Only texts whose fingerprint has
a count above one are read again and compared byte by byte; equal ones are first put together inside each task, so
a text that very many rows share is sent once by every task.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from aduana.llm.common import Block, free_name, table, text_blocks, written

SEED = 42
#: Rows of the corpus for each range of fingerprints that one task merges.
RANGE_ROWS = 1 << 16
#: Fingerprints that a task holds before it hands its filter on.
FILTER_ROWS = 1 << 20
#: Bits of the map that marks repeated fingerprints by their first bits; it is broadcast, 4 MB whatever the corpus.
MARK_BITS = 25
#: Bytes of distinct repeated texts that a task holds before it hands them on.
HELD_BYTES = 32 << 20
# Fixed value: the letters that are lower-cased.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class CountingQuotientFilter:
    """Fingerprints of 64 bits with their counts; all share the first `skip` bits, which are not stored.

    The next `bits` bits are the quotient, the rest the remainder. Remainders stand in slots, run by run: `occupied`
    has a bit for each quotient that has a run, `run_end` a bit for each slot that ends one. Inside a run remainders
    ascend. A slot with `more` set has a counter, as its fingerprint came more than once.
    """

    __slots__ = ("prefix", "skip", "bits", "occupied", "run_end", "remainders", "more", "counters")
    _HEAD = struct.Struct("<QBBQQ")

    @classmethod
    def of(cls, fps: np.ndarray, counts: np.ndarray, skip: int) -> CountingQuotientFilter:
        """fps: distinct, ascending, and equal in their first `skip` bits."""
        made = cls()
        made.skip, made.bits = skip, max(1, min(32, len(fps).bit_length(), 63 - skip))
        made.prefix = int(fps[0]) >> (64 - skip) if skip and len(fps) else 0
        rest = np.uint64(64 - skip - made.bits)
        quotients = (fps >> rest).astype(np.int64) & ((1 << made.bits) - 1)
        made.occupied = np.zeros(1 << made.bits, bool)
        made.occupied[quotients] = True
        made.run_end = np.ones(len(fps), bool)
        made.run_end[:-1] = quotients[1:] != quotients[:-1]
        made.remainders = fps & np.uint64((1 << int(rest)) - 1)
        made.more = counts > 1
        made.counters = counts[made.more].astype(np.uint64)
        return made

    @classmethod
    def counted(cls, fps: np.ndarray, skip: int) -> CountingQuotientFilter:
        return cls.of(*np.unique(fps, return_counts=True), skip)

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """All fingerprints, ascending, and their counts."""
        runs = np.diff(np.flatnonzero(np.concatenate([[True], self.run_end])))
        quotients = np.repeat(np.flatnonzero(self.occupied).astype(np.uint64), runs)
        rest = 64 - self.skip - self.bits
        head = np.uint64((self.prefix << (64 - self.skip)) if self.skip else 0)
        counts = np.ones(len(self.remainders), np.uint64)
        counts[self.more] = self.counters
        return head | (quotients << np.uint64(rest)) | self.remainders, counts

    def merged(self, other: CountingQuotientFilter) -> CountingQuotientFilter:
        """Both are sorted by quotient and remainder, so this is a merge; counts of equal entries add up."""
        (a, m), (b, n) = self.entries(), other.entries()
        fps, counts = np.concatenate([a, b]), np.concatenate([m, n])
        order = np.argsort(fps, kind="stable")
        fps, counts = fps[order], counts[order]
        if not len(fps):
            return self
        first = np.flatnonzero(np.concatenate([[True], fps[1:] != fps[:-1]]))
        return self.of(fps[first], np.add.reduceat(counts, first), self.skip)

    def to_bytes(self) -> bytes:
        width = -(-(64 - self.skip - self.bits) // 8)
        return b"".join([
            self._HEAD.pack(self.prefix, self.skip, self.bits, len(self.remainders), len(self.counters)),
            np.packbits(self.occupied).tobytes(), np.packbits(self.run_end).tobytes(), np.packbits(self.more).tobytes(),
            self.remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes(),
            self.counters.astype("<u8").tobytes(),
        ])

    @classmethod
    def from_bytes(cls, data: bytes) -> CountingQuotientFilter:
        made = cls()
        made.prefix, made.skip, made.bits, n, counters = cls._HEAD.unpack_from(data)
        at = cls._HEAD.size

        def flags(count: int) -> np.ndarray:
            nonlocal at
            size = -(-count // 8)
            found = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=count).astype(bool)
            at += size
            return found

        made.occupied, made.run_end, made.more = flags(1 << made.bits), flags(n), flags(n)
        width = -(-(64 - made.skip - made.bits) // 8)
        slots = np.zeros((n, 8), np.uint8)
        slots[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
        made.remainders = slots.view("<u8").ravel().astype(np.uint64)
        made.counters = np.frombuffer(data, "<u8", counters, at + n * width).astype(np.uint64)
        return made


class _Merger:
    """Filters are merged like the digits of a binary counter, so that each entry is moved few times."""

    def __init__(self) -> None:
        self.held: list[tuple[int, CountingQuotientFilter]] = []

    def add(self, found: CountingQuotientFilter) -> None:
        rank = 0
        while self.held and self.held[-1][0] == rank:
            found = self.held.pop()[1].merged(found)
            rank += 1
        self.held.append((rank, found))

    def result(self) -> CountingQuotientFilter | None:
        found = None
        while self.held:
            more = self.held.pop()[1]
            found = more if found is None else more.merged(found)
        return found


def _lowered(block: Block) -> Block:
    """A-Z lower-cased; no byte of a longer code point is below 0x80."""
    data = block.data.copy()
    data[(data >= 0x41) & (data <= 0x5A)] += 0x20
    return Block(block.first, data, block.offsets)


def xxh64(text: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text, SEED)


def digests(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    fingerprint: Callable[[bytes], int] = xxh64,
) -> DataFrame:
    """(id, fp, sha, at) of every row: fingerprint and SHA-256 of its lower-cased text, and a number of its own."""
    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in map(_lowered, text_blocks(batch.column(1))):
                texts = [block.text(i) for i in range(block.rows)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[block.first:block.first + block.rows],
                    pa.array(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)),
                    pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                ], names=["id", "fp", "sha"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.mapInArrow(digested, f"id {kind}, fp long, sha binary")
    return written(spark, rows.withColumn("at", F.monotonically_increasing_id()), "digests")


def partial_filters(fps: DataFrame, skip: int, filter_rows: int = FILTER_ROWS) -> DataFrame:
    """(range, filter) of every task's rows of `fp`; a range is named by its first `skip` bits."""
    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        count = 0

        def flush() -> pa.RecordBatch:
            found = np.sort(np.concatenate([np.zeros(0, np.uint64), *held]))
            ranges = (found >> np.uint64(64 - skip)).astype(np.int64) if skip else np.zeros(len(found), np.int64)
            edges = np.concatenate([[0], np.flatnonzero(np.diff(ranges)) + 1, [len(found)]])
            parts = [found[a:b] for a, b in zip(edges, edges[1:], strict=False) if b > a]
            return pa.RecordBatch.from_arrays([
                pa.array([int(p[0]) >> (64 - skip) if skip else 0 for p in parts], pa.int64()),
                pa.array([CountingQuotientFilter.counted(p, skip).to_bytes() for p in parts], pa.binary()),
            ], names=["range", "filter"])

        for batch in batches:
            held.append(batch.column(0).to_numpy().view(np.uint64))
            count += batch.num_rows
            if count >= filter_rows:
                yield flush()
                held, count = [], 0
        yield flush()

    return fps.select("fp").mapInArrow(built, "range long, filter binary")


def repeated(filters: DataFrame) -> DataFrame:
    """(fp, count) of the fingerprints whose count is above one in the merged filters of their range."""
    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["fp", "count"]
        current, merger = None, _Merger()

        def close() -> pa.RecordBatch:
            found = merger.result()
            fps, counts = found.entries() if found else (np.zeros(0, np.uint64), np.zeros(0, np.uint64))
            twice = counts > 1
            columns = [pa.array(x[twice].view(np.int64)) for x in (fps, counts)]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for k in range(batch.num_rows):
                key = batch.column(0)[k].as_py()
                if key != current:
                    yield close()
                    current, merger = key, _Merger()
                merger.add(CountingQuotientFilter.from_bytes(batch.column(1)[k].as_py()))
        yield close()

    return filters.repartition("range").sortWithinPartitions("range").mapInArrow(merged, "fp long, count long")


def marks(fps: DataFrame, bits: int = MARK_BITS) -> np.ndarray:
    """A map of 2^bits bits with those set that begin a fingerprint of `fp`; as large for any number of them."""
    width = 1 << 15  # bits of one piece that Spark's bitmap functions build
    head = F.shiftrightunsigned("fp", 64 - bits)
    pieces = fps.groupBy(F.bitmap_bucket_number(head + 1).alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(head + 1)).alias("set")
    )
    found = np.zeros(1 << max(0, bits - 3), np.uint8)
    for row in pieces.collect():  # 2^bits / 32768 rows of 4 KB at most
        at = (row["piece"] - 1) * width // 8
        found[at:at + width // 8] = np.frombuffer(row["set"], np.uint8)[:len(found) - at]
    return found


def verified(
    docs: DataFrame, marked: np.ndarray, id_col: str = "doc_id", text_col: str = "text", bits: int = MARK_BITS,
    held_bytes: int = HELD_BYTES, fingerprint: Callable[[bytes], int] = xxh64,
) -> DataFrame:
    """(fp, sha, keep_id, group_size) of the texts that two rows or more have, compared as bytes.

    Texts whose mark is set are read; a mark set for another fingerprint costs one text sent in vain.
    """
    sent = docs.sparkSession.sparkContext.broadcast(marked)
    kind = docs.schema[id_col].dataType

    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        held: dict[bytes, list] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            columns = zip(*[(v[0], k, v[1], v[2]) for k, v in held.items()], strict=True) if held else [[]] * 4
            types = [pa.int64(), pa.binary(), to_arrow_type(kind), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["fp", "text", "id", "n"])

        for batch in batches:
            for block in map(_lowered, text_blocks(batch.column(1))):
                for i in range(block.rows):
                    text = block.text(i)
                    fp = fingerprint(text)
                    head = fp >> (64 - bits)
                    if not sent.value[head >> 3] >> (head & 7) & 1:
                        continue
                    key = batch.column(0)[block.first + i].as_py()
                    known = held.get(text)
                    if known is None:
                        held[text] = [fp - (1 << 64) if fp >> 63 else fp, key, 1]
                        size += len(text) + 200
                        continue
                    known[2] += 1
                    if key is not None and (known[1] is None or key > known[1]):
                        known[1] = key
                if size >= held_bytes:
                    yield flush()
                    held, size = {}, 0
        yield flush()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        copies, f"fp long, text binary, id {kind.simpleString()}, n long"
    )
    groups = rows.groupBy("fp", "text").agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size"))
    return groups.filter("group_size > 1").select("fp", F.unhex(F.sha2("text", 256)).alias("sha"), "keep_id", "group_size")


def exact_groups(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    range_rows: int = RANGE_ROWS, mark_bits: int = MARK_BITS, fingerprint: Callable[[bytes], int] = xxh64,
) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) of every row: texts are equal when they are after lower-casing A-Z.

    Of equal texts the row with the largest id stays, one of them if rows repeat that id; a null id stays only if
    the group has no other, and keep_id is then null. A null text is empty and equals other empty ones. Texts of any
    length are compared whole. Repeated rows come back as often as they came; an empty table gives no row; other
    columns are not read, whatever their names.
    """
    rows = digests(spark, docs, id_col, text_col, fingerprint)
    ranges = max(1, rows.count() // range_rows)
    found = written(spark, repeated(partial_filters(rows, (ranges - 1).bit_length())), "repeated")
    same_bytes = verified(docs, marks(found, mark_bits), id_col, text_col, mark_bits, fingerprint=fingerprint)
    classes = written(spark, same_bytes, "classes")
    named = classes.withColumnRenamed("fp", "_fp").withColumnRenamed("sha", "_sha")
    joined = rows.join(named, (F.col("fp") == F.col("_fp")) & (F.col("sha") == F.col("_sha")), "left")
    # Rows that repeat the id that stays: the first of them does. Nearly always there is none.
    same = F.col("id").eqNullSafe(F.col("keep_id"))
    ties = joined.filter(F.col("group_size").isNotNull() & same).groupBy("fp", "sha").agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("n")
    ).filter("n > 1").select(F.col("fp").alias("_f"), F.col("sha").alias("_s"), "first")
    single = F.col("group_size").isNull()
    chosen = joined.join(written(spark, ties, "ties"), (F.col("fp") == F.col("_f")) & (F.col("sha") == F.col("_s")), "left")
    return chosen.select(
        F.col("id").alias(id_col), F.when(single, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | (same & (F.col("first").isNull() | (F.col("at") == F.col("first"))))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def deduplicated(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of `docs`, with all its columns, for each group of `exact_groups`: the one that stays."""
    key = free_name(docs, "_exact")
    kept = exact_groups(spark, docs, id_col, text_col).filter("kept").select(
        F.struct(F.col(id_col).alias("i"), F.col("text_sha256").alias("s")).alias(key)
    )
    lowered = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)
    keyed = docs.withColumn(key, F.struct(F.col(id_col).alias("i"), F.sha2(lowered, 256).alias("s")))
    return keyed.join(kept, key, "left_semi").dropDuplicates([key]).select(*docs.columns)


OP13_SQL = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY x ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(x) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS x FROM documents)
WINDOW same AS (PARTITION BY x)
"""


def op13_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(spark, table(spark, sf_dir, "documents"))
