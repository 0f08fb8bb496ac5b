"""Personal data: patterns, and a linear-chain conditional random field over word shapes.

The field is trained on a small labelled table and decoded by Viterbi in numpy batches: all lines of a block of
texts advance together, the longest first. Its spans are verified by kind and added to those of the patterns.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from aduana.llm.common import Block, SpanHash, text_blocks
from aduana.llm.pii_table import LABELLED

KINDS = ("email", "ip", "card", "phone", "name")
BASE_KINDS = KINDS[:4]

# The characters of the patterns.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each kind in turn. Every pattern is found in linear time: an address by
    its @ sign, four dotted numbers by their run."""
    found = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            end = m.end()
            found.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    for run in _DOTTED.finditer(text):
        numbers = run.group().split(".")
        place = run.start()
        for i in range(0, len(numbers) - 3, 4):
            four = numbers[i:i + 4]
            size = sum(map(len, four)) + 3
            if all(len(y := x.lstrip("0")) <= 3 and int(y or "0") <= 255 for x in four):
                found.append(("ip", place, place + size))
            place += size + 1
    for m in _CARD.finditer(text):
        digits = "".join(_DIGIT.findall(m.group()))
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_DIGIT.findall(m.group())) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found


# Classes of bytes that a word's shape counts.
_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "dot": b".", "at": b"@", "plus": b"+",
    "hyphen": b"-", "colon": b":", "bracket": b"()[]", "other": b"!\"#$%&*,/;<=>?\\^_`{|}~'",
}
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_CLASS = np.zeros(256, np.uint8)
for _i, _members in enumerate(_CLASSES.values(), 1):
    _CLASS[list(_members)] = _i
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_COUNT_STEPS = np.array([0, 1, 2, 3, 4, 5, 8, 12, 15, 16, 20])  # lower ends of the classes of digit counts
_LENGTH_STEPS = np.array([1, 2, 3, 4, 7, 11, 16, 24])


class Shapes:
    """Words of a block and their features: one column of feature numbers for each template."""

    def __init__(self, block: Block, lexicon: np.ndarray):
        data = block.data
        self.block = block
        self.starts, self.ends = block.spans(~_WHITE[data])
        n = len(self.starts)
        kinds = _CLASS[data]
        # Marks at the end of a word are a feature of their own.
        trimmed = self.ends.copy()
        for _ in range(2):
            trimmed -= (trimmed > self.starts + 1) & np.isin(data[trimmed - 1] if n else data[:0], list(b".,:;"))
        marked = (trimmed < self.ends).astype(np.int64)
        size = trimmed - self.starts
        counts = {}
        for i, name in enumerate(_CLASSES, 1):
            where = np.flatnonzero(kinds == i)
            counts[name] = np.searchsorted(where, trimmed) - np.searchsorted(where, self.starts)
        first = kinds[self.starts].astype(np.int64) if n else np.zeros(0, np.int64)
        last = kinds[trimmed - 1].astype(np.int64) if n else np.zeros(0, np.int64)
        digits = np.searchsorted(_COUNT_STEPS, counts["digit"], "right") - 1
        some = {k: (v > 0).astype(np.int64) for k, v in counts.items()}
        dots = np.minimum(counts["dot"], 4)
        length = np.searchsorted(_LENGTH_STEPS, size, "right") - 1
        capital = (first == 1).astype(np.int64) + ((counts["upper"] == size) & (size > 1))
        pure = (counts["digit"] == size).astype(np.int64)
        colons = np.minimum(counts["colon"], 3)
        # Words that the table has are known by name, without case; any other is number 0.
        hashes = SpanHash(_LOWER[data]).of(self.starts, trimmed)
        place = np.searchsorted(lexicon, hashes)
        place[place == len(lexicon)] = 0
        known = np.where(lexicon[place] == hashes, place + 1, 0) if len(lexicon) else np.zeros(n, np.int64)
        # Lines: a chain ends where a line or a text does.
        line = np.searchsorted(np.flatnonzero(data == 0x0A), self.starts) + block.row_of(self.starts)
        self.line_starts = np.flatnonzero(np.diff(line, prepend=-1)) if n else np.zeros(0, np.int64)
        edge = np.zeros(n, bool)
        edge[self.line_starts] = True

        def before(values: np.ndarray, none: int) -> np.ndarray:
            out = np.full(n, none, np.int64)
            out[1:] = values[:-1]
            out[edge] = none
            return out

        def after(values: np.ndarray, none: int) -> np.ndarray:
            out = np.full(n, none, np.int64)
            out[:-1] = np.where(edge[1:], none, values[1:])
            return out

        shape = digits * 5 + dots
        columns = [
            (shape, 55), (digits * 4 + 2 * some["plus"] + some["hyphen"], 44),
            (some["at"] * 5 + dots, 10), (colons * 11 + digits, 44), (capital * 8 + length, 24),
            (first * 10 + last, 100), (pure * 8 + length, 16),
            (some["bracket"] * 4 + some["other"] * 2 + marked, 8), (before(marked, 2), 3),
            (before(shape, 55), 56), (after(shape, 55), 56), (before(capital, 3), 4), (after(capital, 3), 4),
            (known, len(lexicon) + 1), (before(known, len(lexicon) + 1), len(lexicon) + 2),
            (after(known, len(lexicon) + 1), len(lexicon) + 2),
            (before(before(known, len(lexicon) + 1), len(lexicon) + 1), len(lexicon) + 2),
        ]
        base, made = 0, []
        for values, width in columns:
            made.append(values + base)
            base += width
        self.features, self.width = made, base


#: Labels: 0 is outside; every kind has one for the word that begins a span, and one for those that go on with it.
LABELS = 1 + 2 * len(KINDS)
#: Words of the longest span; no kind has a longer one.
MOST_WORDS = 24


class Field:
    """Weights of features by label, of transitions and of first labels."""

    def __init__(self, emission: np.ndarray, transition: np.ndarray, first: np.ndarray, lexicon: np.ndarray):
        self.emission, self.transition, self.first, self.lexicon = emission, transition, first, lexicon

    def scores(self, shapes: Shapes) -> np.ndarray:
        total = np.zeros((len(shapes.starts), self.emission.shape[1]), np.float32)
        for column in shapes.features:
            total += self.emission[column]
        return total

    def decode(self, shapes: Shapes) -> np.ndarray:
        """The best label of every word: lines advance together, one word a step."""
        scores = self.scores(shapes)
        n, k = scores.shape
        labels = np.zeros(n, np.int64)
        if not n:
            return labels
        starts = shapes.line_starts
        sizes = np.diff(np.append(starts, n))
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        back = np.zeros((n, k), np.int8)
        best = self.first + scores[starts]
        longest = int(sizes[0])
        active = np.searchsorted(-sizes, -np.arange(longest), "left")  # lines with more than t words
        for t in range(1, longest):
            a = active[t]
            paths = best[:a, :, None] + self.transition
            back[starts[:a] + t] = paths.argmax(1)
            best[:a] = paths.max(1) + scores[starts[:a] + t]
        state = best.argmax(1)
        for t in range(longest - 1, -1, -1):
            a = active[t]
            at = starts[:a] + t
            ending = sizes[:a] == t + 1
            if t + 1 < longest:
                state[:a] = np.where(ending, state[:a], back[np.minimum(at + 1, n - 1), state[:a]])
            labels[at] = state[:a]
        return labels


def _parsed(line: str) -> tuple[str, list[int]]:
    """The text of a line of the table, and the label of each of its words."""
    words: list[str] = []
    labels: list[int] = []
    for part in re.findall(r"\{[^}]*\}\S*|\S+", line):
        begins, text = 0, part
        if m := re.match(r"\{(\w+)\|([^}]*)\}(\S*)$", part):
            begins, text = 2 * KINDS.index(m[1]) + 1, m[2] + m[3]
        for i, word in enumerate(text.split()):
            words.append(word)
            labels.append(begins + (i > 0) if begins else 0)
    return " ".join(words), labels


def trained(table: list[str] = LABELLED, steps: int = 120, rate: float = 0.4, decay: float = 2e-3) -> Field:
    """Maximum likelihood by full-batch adaptive gradient steps; forward and backward sums over all lines at once."""
    pairs = [_parsed(line) for line in table]
    texts = [p[0].encode() for p in pairs]
    joined = b"\n".join(texts)
    data = np.frombuffer(joined, np.uint8)
    block = Block(0, data, np.array([0, len(data)], np.int64))
    # Words of a single line are unknown ones, as most words of a text will be.
    lines = Counter(
        w for t in texts for w in {w.lower().rstrip(b".,:;") or w.lower() for w in t.split()} if not _DIGIT.search(w.decode())
    )
    ordered = sorted(w for w, n in lines.items() if n > 1)
    sizes = np.array([len(w) for w in ordered], np.int64)
    ends = np.cumsum(sizes)
    lexicon = np.unique(SpanHash(np.frombuffer(b"".join(ordered), np.uint8)).of(ends - sizes, ends))
    shapes = Shapes(block, lexicon)
    gold = np.concatenate([p[1] for p in pairs])
    n, k = len(gold), LABELS
    starts = shapes.line_starts
    lengths = np.diff(np.append(starts, n))
    longest = int(lengths.max())
    emission, transition, first = np.zeros((shapes.width, k)), np.zeros((k, k)), np.zeros(k)
    sums = [np.full_like(x, 1e-6) for x in (emission, transition, first)]
    inner = np.setdiff1d(np.arange(n), starts)
    for _ in range(steps):
        scores = np.zeros((n, k))
        for column in shapes.features:
            scores += emission[column]
        forward, backward = np.zeros((n, k)), np.zeros((n, k))
        forward[starts] = first + scores[starts]
        for t in range(1, longest):
            at = starts[lengths > t] + t
            forward[at] = np.logaddexp.reduce(forward[at - 1][:, :, None] + transition, axis=1) + scores[at]
        for t in range(longest - 2, -1, -1):
            at = starts[lengths > t + 1] + t
            backward[at] = np.logaddexp.reduce(transition + (scores[at + 1] + backward[at + 1])[:, None, :], axis=2)
        whole = np.logaddexp.reduce(forward[starts + lengths - 1], axis=1)
        of = np.repeat(whole, lengths)
        one = np.exp(forward + backward - of[:, None])
        two = np.exp(
            forward[inner - 1][:, :, None] + transition + (scores[inner] + backward[inner])[:, None, :]
            - of[inner][:, None, None]
        )
        error = one.copy()
        error[np.arange(n), gold] -= 1
        slopes = [decay * emission, decay * transition + two.sum(0), decay * first + error[starts].sum(0)]
        for column in shapes.features:
            np.add.at(slopes[0], column, error)
        np.subtract.at(slopes[1], (gold[inner - 1], gold[inner]), 1)
        for x, slope, total in zip((emission, transition, first), slopes, sums, strict=True):
            total += slope**2
            x -= rate * slope / np.sqrt(total)
    return Field(
        emission.astype(np.float32), transition.astype(np.float32), first.astype(np.float32), lexicon
    )


def _plausible(kind: str, text: str) -> bool:
    """What a span of the field must show besides its shape."""
    digits = "".join(_DIGIT.findall(text))
    if kind == "email":
        return bool(re.search(r"\S@\S+\.\S|\bat\b.*\bdot\b", text))
    if kind == "ip":
        if ":" in text:
            return bool(re.fullmatch(r"[0-9A-Fa-f:.]+", text)) and 2 <= text.count(":") <= 7
        parts = text.split(".")
        return len(parts) == 4 and all(x.isascii() and x.isdigit() and len(x) <= 3 and int(x) <= 255 for x in parts)
    if kind == "card":
        return 12 <= len(digits) <= 19 and not re.search(r"[^0-9 -]", text) and luhn(digits)
    if kind == "phone":
        return 6 <= len(digits) <= 15 and not re.search(r"[^0-9 ()./+-]", text)
    words = text.split()
    return 2 <= len(words) <= 4 and len(set(words)) == len(words) and all(w.isalpha() and w[0].isupper() and w[1:].islower() for w in words)


_TRIM = {"name": " .,;:!?\"'()", "phone": " .,;:!?\"'/-"}


def method_spans(block: Block, field: Field) -> list[list[tuple[str, int, int]]]:
    """Verified spans of the field in each row, in code points; a span doesn't cross lines."""
    shapes = Shapes(block, field.lexicon)
    labels = field.decode(shapes)
    out: list[list[tuple[str, int, int]]] = [[] for _ in range(block.rows)]
    inside = np.flatnonzero(labels)
    if not len(inside):
        return out
    edge = np.zeros(len(labels), bool)
    edge[shapes.line_starts] = True
    kinds = (labels + 1) // 2
    # A span begins with its label, or where a word goes on with what the one before it isn't.
    begins = (labels % 2 == 1) | edge
    begins[1:] |= kinds[1:] != kinds[:-1]
    opens = inside[begins[inside]]
    stops = np.flatnonzero(begins | (labels == 0))
    following = np.append(stops, len(labels))[np.searchsorted(stops, opens, "right")]
    rows = block.row_of(shapes.starts[opens])
    leads = np.zeros(len(block.data) + 1, np.int64)
    np.cumsum((block.data & 0xC0) != 0x80, out=leads[1:])
    starts = leads[shapes.starts[opens]] - leads[block.offsets[rows]]
    for word, end, row, start in zip(opens.tolist(), following.tolist(), rows.tolist(), starts.tolist(), strict=True):
        if end - word > MOST_WORDS:
            continue
        kind = KINDS[int(kinds[word]) - 1]
        text = block.data[int(shapes.starts[word]):int(shapes.ends[end - 1])].tobytes().decode()
        marks = _TRIM.get(kind, " .,;!?\"'")
        cut = len(text) - len(text.lstrip(marks))
        text = text.strip(marks)
        if _plausible(kind, text):
            out[row].append((kind, start + cut, start + cut + len(text)))
    return out


def _clear_of(spans: list[tuple[str, int, int]], base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The spans that overlap none of `base`."""
    ordered = sorted((a, b) for _, a, b in base)
    firsts = [a for a, _ in ordered]
    reach = list(accumulate((b for _, b in ordered), max))
    kept = []
    for s in spans:
        before = bisect_left(firsts, s[2])  # those that begin before the span ends
        if not before or reach[before - 1] <= s[1]:
            kept.append(s)
    return kept


def _listed(spans: list[tuple[str, int, int]]) -> str:
    ordered = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def spans_of(block: Block, field: Field) -> Iterator[tuple[str, list, list]]:
    """(text, base spans, added spans) of each row. What the field adds doesn't overlap a base span."""
    digits = block.per_row((block.data >= 0x30) & (block.data <= 0x39))
    signs = block.per_row(block.data == 0x40)
    added = method_spans(block, field)
    for row in range(block.rows):
        text = block.text(row).decode()
        base = base_spans(text) if digits[row] or signs[row] else []
        yield text, base, _clear_of(added[row], base)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", field: Field | None = None) -> DataFrame:
    """(id, base, added) of every row: lists of kind:start:end in code points, end exclusive, by kind and start.

    A null text is empty and has none. Null ids stay, repeated rows are searched alike, an empty table gives no
    row, other columns are not read, whatever their names. Two labels with the same score: the one listed first. A
    text of any length is searched whole by one task, in steps that grow with its length; a line is one chain, so a
    single line of very many words costs a numpy step for each of them.
    """
    model = field or trained()

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch.column(1)):
                bases, mores = [], []
                for _, base, more in spans_of(block, model):
                    bases.append(_listed(base))
                    mores.append(_listed(more))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[block.first:block.first + block.rows], pa.array(bases, pa.string()),
                    pa.array(mores, pa.string()),
                ], names=[id_col, "base", "added"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        searched, f"{id_col} {kind}, base string, added string"
    )


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind, as `<EMAIL>`; spans that overlap become the first one's."""
    parts, end = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            parts += [text[end:a], f"<{kind.upper()}>"]
            end = b
        elif b > end:
            end = b
    return "".join([*parts, text[end:]])


def redact(
    docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars", field: Field | None = None
) -> DataFrame:
    """The rows of `docs` with personal data replaced; `chars_col` is then the new length.

    A null text stays null and keeps its length. All columns stay, whatever their names; null ids, repeated rows and
    texts of any length are like any others; an empty table stays empty. See `find` for what is replaced.
    """
    model = field or trained()
    names = docs.columns
    text_at = names.index(text_col)
    chars_at = names.index(chars_col) if chars_col in names else None

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str | None] = []
            for block in text_blocks(batch.column(text_at)):
                for text, base, more in spans_of(block, model):
                    texts.append(redacted(text, base + more) if base or more else text)
            valid = batch.column(text_at).is_valid().to_pylist()
            texts = [t if v else None for t, v in zip(texts, valid, strict=True)]
            columns = list(batch.columns)
            columns[text_at] = pa.array(texts, batch.schema.field(text_at).type)
            if chars_at is not None:
                kept = batch.column(chars_at).to_pylist()
                sizes = [k if t is None else len(t) for k, t in zip(kept, texts, strict=True)]
                columns[chars_at] = pa.array(sizes, batch.schema.field(chars_at).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(cleaned, docs.schema)


def op9_pii(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans."""
    entry = lambda c: F.filter(F.split(c, ","), lambda s: s != "")
    rows = find(docs).withColumns({"_b": entry("base"), "_a": entry("added")})
    kind = lambda s: F.substring_index(s, ":", 1)
    count = lambda k: F.size(F.filter("_b", lambda s: kind(s) == k)).cast("long").alias(f"n_{k}")
    order = F.array(*[F.lit(k) for k in KINDS])
    place = lambda s: F.struct(
        F.array_position(order, kind(s)).alias("k"), F.split(s, ":")[1].cast("long").alias("a"),
        F.split(s, ":")[2].cast("long").alias("b"), s.alias("s"),
    )
    merged = F.array_sort(F.transform(F.concat("_b", "_a"), place))
    return rows.select(
        "doc_id", *[count(k) for k in BASE_KINDS], F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
        F.when(F.col("added") == "", F.col("base")).otherwise(
            F.array_join(F.transform(merged, lambda x: x["s"]), ",")
        ).alias("spans"),
    )
