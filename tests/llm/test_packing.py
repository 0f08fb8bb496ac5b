from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings, strategies as st

from aduana.llm.packing import balanced, cuts, differenced, op10_packing, pack, token_ids, default_tokenizer
from tests.llm.cases import SF, crowded, docs, table


def _reference():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_those_of_the_tokenizer_file(spark):
    coder, path = _reference(), default_tokenizer()
    texts = [r[0] or "" for r in table(spark, "documents").select("text").collect()]
    texts += ["", " ", "a<|endoftext|>b", "  \n\n x", "É𝒳  y", "\r\n\t", "a" * 5000, "1234567890" * 9]
    expected = coder.encode_batch(texts, add_special_tokens=False)
    assert [token_ids(t, path) for t in texts] == [e.ids for e in expected]


def test_runs_of_white_space_of_any_length():
    """They are cut out of the text; the ids are those of the tokenizer file all the same."""
    coder, path = _reference(), default_tokenizer()
    blanks = [" ", "\n", "\t", " \n", "\r\n", " \u3000\x85", "\xa0"]
    texts = [a + (b * 1003)[:n] + z for b in blanks for n in (999, 1000, 1001, 1500)
             for a, z in (("", ""), ("word", "word"), ("x.", "'s"), ("9 ", "\x1c"), ("a", "<|endoftext|>b"), ("é", "\x1fé"))]
    texts.append(("a" + " " * 2000 + "\n") * 3 + "b" + "\n" * 1200 + " c")
    expected = coder.encode_batch(texts, add_special_tokens=False)
    assert [token_ids(t, path) for t in texts] == [e.ids for e in expected]
    for run in (" " * 2_000_000, "\n" * 2_000_000, "\t" * 2_000_000, " \n\t\u3000" * 500_000):
        assert token_ids(f"a{run}b", path) == coder.encode(f"a{run}b", add_special_tokens=False).ids


def _whole(rows, texts):
    """Every document's pieces join to its ids; every sequence is gapless and not too long."""
    path = default_tokenizer()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for doc_id, text in texts.items():
        ids = [*token_ids(text or "", path), 1]
        at = 0
        for r in sorted(pieces.pop(doc_id), key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            part = np.array(ids[at:at + r["length"]], "<u4").tobytes()
            assert zlib.crc32(part) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    assert not pieces
    filled = 0
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
        filled += at
    return filled / (2048 * len(sequences))


def test_pieces_and_sequences(spark):
    df = table(spark, "documents")
    rows = op10_packing(df).collect()
    share = _whole(rows, {r["doc_id"]: r["text"] for r in df.collect()})
    assert share > 0.95


def test_odd_rows(spark):
    df = docs(spark).filter("doc_id <> 5")
    rows = op10_packing(crowded(df)).collect()
    _whole(rows, {r["doc_id"]: r["text"] for r in df.collect()})
    assert pack(docs(spark)).filter("doc_id = 5 and start = 0").count() == 2
    assert pack(docs(spark)).filter("doc_id is null and start = 0").count() == 2
    assert op10_packing(docs(spark, [])).count() == 0


def test_ids_of_a_piece(spark):
    row = pack(docs(spark, [(1, "two words", None, None, 9)])).first()
    assert np.frombuffer(row["ids"], "<u4").tolist() == [*_reference().encode("two words").ids, 1]


@given(st.lists(st.integers(1, 512), max_size=60), st.integers(1, 9))
@settings(max_examples=60, deadline=None)
def test_differencing_keeps_every_item(sizes, windows):
    held = differenced(sizes, windows)
    assert len(held) == windows and sorted(i for w in held for i in w) == list(range(len(sizes)))
    capped = balanced(sizes, 512)
    assert sorted(i for w in capped for i in w) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in w) <= 512 for w in capped)


def test_differencing_is_balanced():
    sizes = [int(x) for x in np.random.default_rng(1).integers(20, 512, 300)]
    sums = [sum(sizes[i] for i in w) for w in differenced(sizes, 40)]
    assert max(sums) - min(sums) <= 20


def test_cuts():
    assert list(cuts(10, 4, 1)) == [(0, 4), (4, 4), (8, 1), (9, 1)]
    assert list(cuts(4, 4, 1)) == [(0, 4)]


def test_registered_query_reads_the_table(spark):
    from aduana.llm.queries import queries

    assert queries()["op10_packing"](spark, SF).select("doc_id").distinct().count() == table(spark, "documents").count()
