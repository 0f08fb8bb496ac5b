from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from aduana.llm import packing, pii
from aduana.llm.common import written
from aduana.llm.quality import judged, fitted
from tests.llm.cases import ODD, SF, crowded, table
from tests.llm.cases import docs as odd_docs
from tests.llm.test_simhash import _expected


def test_each_stage_on_its_own_input(spark):
    docs = table(spark, "documents")
    columns, results = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        results.append(written(spark, stage(spark, results[-1], SF), "stage"))
    quality, unique, clean, mixed, pieces = results[1:]
    for df in (quality, unique, clean, mixed):
        assert df.columns == columns
    verdicts = {r["doc_id"]: r["kept"] for r in judged(docs, fitted(docs, table(spark, "labels"))).collect()}
    assert Counter(map(tuple, quality.collect())) == Counter(tuple(r) for r in docs.collect() if verdicts[r["doc_id"]])
    roots = {x[2] for x in _expected(quality.collect())}
    assert Counter(map(tuple, unique.collect())) == Counter(tuple(r) for r in quality.collect() if r["doc_id"] in roots)
    before = {r["doc_id"]: r["text"] for r in unique.collect()}
    for r in clean.collect():
        text = before[r["doc_id"]]
        assert r["n_chars"] == len(r["text"]) and not pii.base_spans(r["text"])
        if not re.search(r"[0-9@]", text):
            assert r["text"] == text or "<NAME>" in r["text"]
    kept = {r["doc_id"]: r for r in clean.collect()}
    times = Counter(r["doc_id"] for r in mixed.collect())
    assert set(times) <= set(kept) and max(times.values()) <= 3
    assert all(tuple(r) == tuple(kept[r["doc_id"]]) for r in mixed.collect())
    path, tokens = packing.default_tokenizer(), Counter()
    for r in pieces.collect():
        tokens[r["doc_id"]] += r["length"]
    for doc_id, n in times.items():
        assert tokens[doc_id] == n * (len(packing.token_ids(kept[doc_id]["text"], path)) + 1)


def test_stages_stand_odd_rows(spark):
    """Nulls, empty and very long texts, repeated rows and columns with clashing names through every stage."""
    long = "".join(f"Line {i} of a text that goes on for long, with word{i % 977}.\n" for i in range(9000))
    more = [(60, long, "en", "a", len(long)), (61, "fine words of a plain text, number " + "one two three four " * 9, None, None, None)]
    more += [(62, " ".join(f"w{i} of{i % 31}" for i in range(400)), "en", None, 0)] * 3 + [(63, " " * 1_200_000 + "x", "en", "b", 1)]
    docs = crowded(odd_docs(spark, [*ODD, *more, (None, more[1][1] + "again", "en", "a", 5)]))
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = written(spark, stage(spark, docs, SF), "stage")
        if name != "packing":
            assert out.columns == columns, name
        sizes.append(out.count())
        docs = out
    quality, unique, clean, mixed, pieces = sizes[1:]
    assert 0 < unique < quality < sizes[0] and clean == unique and pieces >= mixed > 0
    # Each stage by itself on rows that no stage before it has sorted out.
    docs = crowded(odd_docs(spark, [*ODD, *more]))
    counts = {name: written(spark, stage(spark, docs, SF), "stage") for name, stage in corpus_pipeline.STAGES}
    assert counts["pii"].count() == docs.count()
    assert counts["simhash"].filter("doc_id = 62 or doc_id = 5").count() == 2
    taken = {r["doc_id"] for r in counts["mixing"].select("doc_id").collect()}
    assert not taken & {2, 3, 4}
    tokens = counts["packing"].groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    found = {r["doc_id"]: r["n"] for r in tokens}
    assert found[2] == found[3] == 1 and found[63] > 1_000_000


def test_run_is_the_stages_in_turn(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
    ]
    assert rows.count() > 0 and zlib.crc32(b"") == 0
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5


def test_the_packed_table_holds_the_tokens(spark):
    """Whole sequences and whole documents can be rebuilt from the table that is written."""
    pieces = corpus_pipeline.sequences(spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in pii.redact(table(spark, "documents")).collect()}
    path, windows, documents = packing.default_tokenizer(), {}, {}
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        window = windows.setdefault(r["sequence_id"], [])
        assert r["offset"] == len(window) and zlib.crc32(r["ids"]) == r["ids_crc32"]
        window += np.frombuffer(r["ids"], "<u4").tolist()
        assert len(window) == r["offset"] + r["length"] <= packing.CAPACITY
        documents.setdefault(r["doc_id"], {})[r["start"]] = r["ids"]
    assert documents
    for doc_id, parts in documents.items():
        ids = np.frombuffer(b"".join(parts[k] for k in sorted(parts)), "<u4").tolist()
        assert ids == [*packing.token_ids(texts[doc_id], path), packing.END_ID]


def test_empty_documents(spark):
    docs = table(spark, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
