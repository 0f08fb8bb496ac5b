"""URL filter: rules on host and path, else logistic regression on hashed character n-grams of the two."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aduana.llm import logistic
from aduana.llm.common import SpanHash, text_blocks
from aduana.llm.urls_table import LABELLED

NGRAMS = (3, 4, 5)
WIDTH_BITS = 16
#: A url that no rule fits is blocked if its calibrated probability is above this.
BLOCK_ABOVE = 0.5

# Verdict, host and path of the rules.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Rule and verdict of the longest rule that fits, null without one. Of rules of one length the later stands."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, on, start in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == on) | host.endswith("." + on)) & path.startswith(start)
        rule, verdict = F.when(fits, on + start).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _split(url: str) -> tuple[str, str]:
    m = re.match(_URL, url)
    return ("", "") if not m else (m[1].translate(str.maketrans(_UPPER, _LOWER)), m[2])


def grams(hosts: pa.Array, paths: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, row, column) of blocks of rows. Host and path are told apart by a mark between them."""
    column = pc.binary_join_element_wise(hosts.cast(pa.large_string()), paths.cast(pa.large_string()), pa.scalar("\n", pa.large_string()))
    shift = np.uint64(64 - WIDTH_BITS)
    for block in text_blocks(column):
        data = block.data.astype(np.uint64)
        of = np.repeat(np.arange(block.rows), np.diff(block.offsets))
        rows, columns = [], []
        for n in NGRAMS:
            last = max(0, len(data) - n + 1)
            h = np.full(last, n, np.uint64)
            for k in range(n):
                h = (h << np.uint64(8)) | data[k:k + last]
            kept = of[:last] == of[n - 1:] if last else np.zeros(0, bool)
            rows.append(of[:last][kept])
            columns.append(((h[kept] * np.uint64(SpanHash.BASE)) >> shift).astype(np.int64))
        yield block.first, block.rows, np.concatenate(rows), np.concatenate(columns)


class Model:
    """Mean weight of a url's n-grams, as a calibrated probability that it is to be blocked."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float, offset: float):
        self.weights, self.bias, self.slope, self.offset = weights, bias, slope, offset

    def probabilities(self, hosts: pa.Array, paths: pa.Array) -> np.ndarray:
        out = np.zeros(len(hosts))
        for first, n, rows, columns in grams(hosts, paths):
            z = _means(rows, columns, n, self.weights) + self.bias
            out[first:first + n] = 1 / (1 + np.exp(-np.clip(self.slope * z + self.offset, -35, 35)))
        return out


def _means(rows: np.ndarray, columns: np.ndarray, n: int, weights: np.ndarray) -> np.ndarray:
    return np.bincount(rows, weights[columns], n) / np.maximum(np.bincount(rows, minlength=n), 1)


def trained(table: list[tuple[str, int]] = LABELLED) -> Model:
    """Fitted on all rows of the table; calibrated on the scores that four folds get from the others."""
    parts = [_split(url) for url, _ in table]
    labels = np.array([label for _, label in table])
    (_, n, rows, columns), = grams(pa.array([p[0] for p in parts]), pa.array([p[1] for p in parts]))
    share = (1 / np.maximum(np.bincount(rows, minlength=n), 1))[rows]

    def fit(keep: np.ndarray) -> tuple[np.ndarray, float]:
        place = np.cumsum(keep) - 1
        on = keep[rows]
        return logistic.fit(place[rows[on]], columns[on], share[on], labels[keep], 1 << WIDTH_BITS)

    fold, held = np.arange(n) % 4, np.zeros(n)
    for f in range(4):
        weights, bias = fit(fold != f)
        held[fold == f] = (_means(rows, columns, n, weights) + bias)[fold == f]
    slope, offset = logistic.calibrate(held, labels)
    weights, bias = fit(np.ones(n, bool))
    return Model(weights.astype(np.float32), bias, slope, offset)


def judged(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, model: Model | None = None,
    block_above: float = BLOCK_ABOVE,
) -> DataFrame:
    """(id, host, path, rule, verdict, probability) of every row; rule and probability exclude each other.

    Host and path of a null url, or of one without `://`, are empty; no rule fits an empty host. Null ids stay,
    repeated rows are judged alike, an empty table gives no row, other columns are not read, whatever their names. A
    url of any length is judged whole, in some 100 bytes for each of its own.
    """
    model = model or trained()
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    split = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, known = batch.column(1), batch.column(2), batch.column(4)
            open_ = pc.is_null(known)
            p = np.full(batch.num_rows, np.nan)
            at = np.flatnonzero(open_.to_numpy(zero_copy_only=False))
            p[at] = model.probabilities(hosts.take(pa.array(at)), paths.take(pa.array(at)))
            judged_ = pc.if_else(open_, pa.array(np.where(p > block_above, "block", "allow")), known)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], judged_, pa.array(p, from_pandas=True)],
                names=[id_col, "host", "path", "rule", "verdict", "probability"],
            )

    kind = pages.schema[id_col].dataType.simpleString()
    return split.select(id_col, "host", "path", rule.alias("rule"), verdict.alias("verdict")).mapInArrow(
        scored, f"{id_col} {kind}, host string, path string, rule string, verdict string, probability double"
    )


def op8_urls(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return judged(pages)
