"""Helpers the operators share: tables, working copies, and byte blocks of Arrow text columns."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from aduana.session import fresh_path

#: Bytes of text that a task turns into numpy arrays at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20


def shipped(query: Callable) -> Callable:
    """The query with this package sent to the executors first, as `--py-files` would."""
    @wraps(query)
    def run(spark: SparkSession, *args):
        context = spark.sparkContext
        if not getattr(context, "_aduana_sent", False):
            root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
            name = os.path.join(tempfile.mkdtemp(prefix="aduana-package-"), "aduana_package")
            context.addPyFile(shutil.make_archive(name, "zip", root, "aduana"))
            context._aduana_sent = True
        return query(spark, *args)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """The same rows from a table in the shared folder, so that a lost executor costs no recomputation."""
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, or a longer one that no column of `df` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(value) -> str:
    return value if isinstance(value, str) else ""


class Block:
    """Whole texts of consecutive rows as one byte array; a null text is empty."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.data, self.offsets = first, data, offsets
        self.rows = len(offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()

    def word_numbers(self) -> np.ndarray:
        """A number for every word (run without ASCII white space) of the block; equal words have equal numbers."""
        buffers = [None, pa.py_buffer(np.ascontiguousarray(self.offsets, np.int64)), pa.py_buffer(self.data)]
        texts = pa.Array.from_buffers(pa.large_string(), self.rows, buffers)
        return np.asarray(words_of(texts)[0].dictionary_encode().indices).astype(np.int64)

    def row_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, positions, "right") - 1

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """How many set flags (one for each byte) each row has."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return np.diff(total[self.offsets])

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs of set flags; a run ends where its row does."""
        if not len(inside):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        before, after = np.zeros(len(inside), bool), np.zeros(len(inside), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = self.offsets[:-1][self.offsets[:-1] < len(inside)]
        before[edges] = False
        after[edges[edges > 0] - 1] = False
        return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield Block(first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, between ASCII white space, and where those of each text begin."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    real = np.asarray(pc.greater(pc.binary_length(flat), 0))
    sums = np.zeros(len(flat) + 1, np.int64)
    np.cumsum(real, out=sums[1:])
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.asarray(pc.list_value_length(lists)), out=bounds[1:])
    return flat.filter(pa.array(real)), sums[bounds]


def mixed(h: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit values of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class SpanHash:
    """64-bit hashes of any spans of an array, by one polynomial prefix sum over it."""

    BASE, INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
    BYTES = mixed(np.arange(1, 257, dtype=np.uint64))
    _powers: tuple[np.ndarray, np.ndarray] | None = None

    def __init__(self, values: np.ndarray):
        """values: bytes, or 64-bit hashes of the elements."""
        n = len(values)
        up, self.down = self.powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        terms = self.BYTES[values] if values.dtype == np.uint8 else values
        np.cumsum(terms * up[:n], out=self.sums[1:])

    @classmethod
    def powers(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if cls._powers is None or len(cls._powers[0]) < n:
            size = 1 << max(16, n.bit_length())
            made = []
            for factor in (cls.BASE, cls.INVERSE):
                p = np.ones(size, np.uint64)
                p[1:] = np.uint64(factor)
                np.cumprod(p, out=p)
                made.append(p)
            if size > 1 << 23:  # of a single huge text; not kept
                return made[0], made[1]
            cls._powers = (made[0], made[1])
        return cls._powers

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))
