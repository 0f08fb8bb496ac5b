"""Packing: Karmarkar-Karp multiway differencing of document pieces into windows of a fixed capacity.

A task reads its documents as a stream, cuts them, and packs the pieces of about `GROUP_WINDOWS` windows at a
time. Nothing is shuffled, a task holds one group, and a task that is repeated gives the same windows.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from aduana.llm.common import text_of

CAPACITY = 2048
#: Windows that are balanced against each other. Padding falls with it, a merge costs as much more.
GROUP_WINDOWS = 192
#: What is left of a document after its whole windows is cut to pieces of at most this share of a window, so
#: that a window holds enough pieces to be balanced.
PIECE_SHARE = 4
END_ID = 1
#: Characters of white space in a run from which on it is encoded apart.
LONG_RUN = 1000
BYTE_BPE = "byte_bpe_50k.tiktoken"

_encoders: dict[str, object] = {}


def encoder(path: str):
    """Byte-level BPE of a rank file. It gives the ids of the tokenizer file of the same vocabulary (the tests
    compare the two) in about a fifth of the time."""
    if path not in _encoders:
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encoders[path] = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL
        )
    return _encoders[path]


# Fixed value: the special token of the vocabulary.
SPECIAL = {"<|endoftext|>": 50256}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(BYTE_BPE)


# The white space of the pattern, and its runs that are too long for the pattern's backtracking.
_BLANK = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_LONG_RUN = re.compile(f"{_BLANK}{{{LONG_RUN}}}{_BLANK}*")
_SPECIAL = re.compile("|".join(map(re.escape, SPECIAL)))


def _ordinary(coder, text: str) -> list[int]:
    """Ids of a text without special tokens. The pattern takes a run of white space as one piece, but for its last
    character if something follows; so it is cut out there and encoded by itself, with the same ids."""
    found = _LONG_RUN.search(text)
    if found is None:
        return coder.encode_ordinary(text)
    ids, at = [], 0
    while found is not None:
        end = found.end() if found.end() == len(text) else found.end() - 1
        ids += coder.encode_ordinary(text[at:found.start()])
        ids += coder._encode_single_piece(text[found.start():end])
        at, found = end, _LONG_RUN.search(text, found.end())
    return ids + coder.encode_ordinary(text[at:])


def token_ids(text: str, tokenizer: str) -> list[int]:
    """Ids of a text of any length; the string of a special token is that token, as in the tokenizer file."""
    coder = encoder(tokenizer)
    if not any(x in text for x in SPECIAL):
        return _ordinary(coder, text)
    ids, at = [], 0
    for special in _SPECIAL.finditer(text):
        ids += [*_ordinary(coder, text[at:special.start()]), SPECIAL[special[0]]]
        at = special.end()
    return ids + _ordinary(coder, text[at:])


class _Partial:
    """A partial partition: sums of the windows in descending order less the smallest, and what each holds."""

    __slots__ = ("sums", "held")

    def __init__(self, sums: np.ndarray, held: list[list[int]]):
        self.sums, self.held = sums, held


def differenced(sizes: list[int], windows: int) -> list[list[int]]:
    """Items of each of `windows` windows by the largest differencing method.

    Every item starts as a partial partition with the item alone in one window. The two with the largest spread
    are merged, the fullest windows of one onto the emptiest of the other, until one partition is left. Only the
    windows above the smallest are kept in a partial partition, so that merging small ones stays cheap.
    """
    if not sizes:
        return [[] for _ in range(windows)]
    heap: list[tuple[int, int, _Partial]] = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        heap.append((-sizes[i], i, _Partial(np.array([sizes[i]], np.int64), [[i]])))
    heapq.heapify(heap)
    turn = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        merged = _merged(a, b, windows)
        spread = int(merged.sums[0]) if len(merged.sums) else 0
        heapq.heappush(heap, (-spread, turn, merged))
        turn += 1
    held = heap[0][2].held
    return held + [[] for _ in range(windows - len(held))]


def _merged(a: _Partial, b: _Partial, windows: int) -> _Partial:
    """`a` descending laid onto `b` ascending; sums beyond the kept ones are zero, that is, the smallest."""
    n, m = len(a.held), len(b.held)
    sums_a, sums_b = a.sums, b.sums
    if n + m <= windows:
        sums, held = np.concatenate([sums_a, sums_b]), a.held + b.held
    else:
        full_a = np.zeros(windows, np.int64)
        full_b = np.zeros(windows, np.int64)
        full_a[:n] = sums_a
        full_b[windows - m:] = sums_b[::-1]
        sums = full_a + full_b
        held_a = a.held + [[] for _ in range(windows - n)]
        held_b = [[] for _ in range(windows - m)] + b.held[::-1]
        held = [x + y if x and y else x or y for x, y in zip(held_a, held_b, strict=True)]
        sums = sums - sums.min()
    order = np.argsort(-sums, kind="stable")
    return _Partial(sums[order], [held[i] for i in order])


def balanced(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows with near-equal sums, none above `capacity`. Starts from the fewest that can do; where a window
    is too full, their number rises by what the overflow asks for, and by one at least."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        held = differenced(sizes, windows)
        most = max(sum(sizes[i] for i in w) for w in held)
        if most <= capacity:
            return [w for w in held if w]
        windows += max(1, (most - capacity) * windows // (2 * capacity))


def cuts(n: int, capacity: int, piece: int) -> Iterator[tuple[int, int]]:
    """(start, length): whole windows first, then pieces of at most `piece`."""
    start = 0
    while n - start >= capacity:
        yield start, capacity
        start += capacity
    while start < n:
        length = min(piece, n - start)
        yield start, length
        start += length


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    group_windows: int = GROUP_WINDOWS,
    tokenizer: str | None = None,
) -> DataFrame:
    """One row per piece: id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    A document is its token ids and `end_id`. A null text is empty, so such a document is `end_id` alone. A text of
    any length is encoded whole by one task, which holds its ids. A null id stays null; repeated rows are packed as
    often as they come; an empty table gives no piece; other columns are not read, whatever their names. Equal sums are broken by the order of the rows. Sequences are numbered by task and count.
    """
    path, piece = tokenizer or default_tokenizer(), max(1, capacity // PIECE_SHARE)
    schema = (
        f"{id_col} {docs.schema[id_col].dataType.simpleString()}, start long, length long, ids binary, "
        "doc_tokens long, sequence_id long, offset long"
    )
    kind = docs.schema[id_col].dataType

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        fields = [pa.array([], to_arrow_type(kind)).type, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 3]
        names = [id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        number = TaskContext.get().partitionId() << 40
        group: list[tuple] = []
        tokens = 0

        def flush() -> pa.RecordBatch:
            nonlocal number
            columns: list[list] = [[] for _ in names]
            small = [i for i, g in enumerate(group) if g[2] < capacity]
            windows = [[i] for i, g in enumerate(group) if g[2] == capacity]
            if small:
                windows += [[small[i] for i in w] for w in balanced([group[i][2] for i in small], capacity)]
            for window in windows:
                offset = 0
                for i in window:
                    for column, value in zip(columns, (*group[i], number, offset), strict=True):
                        column.append(value)
                    offset += group[i][2]
                number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, fields, strict=True)], names=names
            )

        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for k in range(batch.num_rows):
                ids = token_ids(text_of(texts[k].as_py()), path)
                ids.append(end_id)
                raw, total = np.array(ids, "<u4").tobytes(), len(ids)
                key = keys[k].as_py()
                for start, length in cuts(total, capacity, piece):
                    group.append((key, start, length, raw[4 * start:4 * (start + length)], total))
                tokens += total
                if tokens >= group_windows * capacity:
                    yield flush()
                    group, tokens = [], 0
        if group:
            yield flush()

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(packed, schema)


def op10_packing(docs: DataFrame) -> DataFrame:
    """The pieces without their ids, of which the checksum stays."""
    pieces = pack(docs)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
