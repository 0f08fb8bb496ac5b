from __future__ import annotations

import hashlib
import subprocess
import sys

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from aduana.llm import fingerprints as fingerprints_module
from aduana.llm.common import mixed
from aduana.llm.fingerprints import OrderMinHash, edited, fingerprints, likeness, with_next
from tests.conftest import ROOT
from tests.llm.cases import ODD, crowded, docs, table

HASHER = OrderMinHash()


def brute_signature(text, hasher):
    """k-mers with their numbers, the smallest of each function, their order: one at a time."""
    k = hasher.kmer
    points = [ord(c) + 1 for c in text]
    if not points:
        return [0] * hasher.functions
    kmers = [points[i:i + k] for i in range(len(points) - k + 1)] or [points + [0] * (k - len(points))]
    seen: dict[tuple, int] = {}
    h = []
    for x in kmers:
        number = seen.get(tuple(x), 0)
        seen[tuple(x)] = number + 1
        value = sum(int(w) * p for w, p in zip(hasher.weights, x, strict=True)) % (1 << 64)
        value = int(mixed(np.array([value], np.uint64))[0])
        h.append((value, number))
    if any(n for n in seen.values() if n > 1):
        h = [int(mixed(np.array([(v + n * 0x9E3779B97F4A7C15) % (1 << 64)], np.uint64))[0]) for v, n in h]
    else:
        h = [v for v, _ in h]
    out = []
    for f in hasher.factor.tolist():
        def rank(i, f=f):
            x = (h[i] >> 32) * f % (1 << 32)
            return ((x ^ x >> 15) * 0x2C1B3C6D % (1 << 32), i)

        chosen = sorted(sorted(range(len(h)), key=rank)[:hasher.size])
        folded = len(chosen)
        for i in chosen:
            folded = int(mixed(np.array([(folded * 0x9E3779B97F4A7C15 + h[i]) % (1 << 64)], np.uint64))[0])
        out.append(folded >> 32)
    return out


@given(st.text(st.sampled_from("ab é𝒳"), max_size=60))
@settings(max_examples=80, deadline=None)
def test_signature_by_brute_force(text):
    assert HASHER.signature(text).tolist() == brute_signature(text, HASHER)


@pytest.mark.parametrize("piece", [1, 7, 64])
def test_long_texts_go_by_pieces(monkeypatch, piece):
    """The same signature whatever the pieces, repeated k-mers across them included."""
    rng = np.random.default_rng(piece)
    texts = ["abcde" * 40, "".join(rng.choice(list("ab é𝒳"), 300)), "".join(chr(200 + i) for i in range(150)), "abcd", "abcdef"]
    whole = [HASHER.signature(t).tolist() for t in texts]
    assert whole[:2] == [brute_signature(t, HASHER) for t in texts[:2]]
    monkeypatch.setattr(fingerprints_module, "PIECE", piece)
    assert [HASHER.signature(t).tolist() for t in texts] == whole


def test_memory_of_a_long_text_is_bounded():
    """4 million code points in a process of their own: far below a matrix of all functions and k-mers."""
    code = (
        "import resource, numpy as np\n"
        "from aduana.llm.fingerprints import OrderMinHash\n"
        "h = OrderMinHash(); h.signature('warm up ' * 9)\n"
        "text = np.random.default_rng(1).integers(97, 123, 4_000_000, np.uint8).tobytes().decode()\n"
        "a = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss; h.signature(text)\n"
        "print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - a)\n"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=ROOT)
    assert int(out.stdout) < 200_000  # KB


def test_order_and_edits_show():
    words = [f"w{i}x" for i in range(400)]
    text = " ".join(words)
    turned = " ".join(words[200:] + words[:200])
    changed = text.replace("w7x", "wqx")
    a = HASHER.fingerprint(text)
    assert likeness(a, HASHER.fingerprint(text)) == 1
    assert likeness(a, HASHER.fingerprint(changed)) > 0.8
    assert likeness(a, HASHER.fingerprint(turned)) < 0.8
    assert likeness(a, HASHER.fingerprint("nothing of the kind " * 40)) < 0.2


def _check(rows, got):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    by_id = {r["doc_id"]: r for r in got}
    for i, (doc_id, text) in enumerate(order):
        following = order[(i + 1) % len(order)][1] or ""
        text = text or ""
        changed = edited(text, following)
        half = len(text) // 2
        assert changed == text[:len(text) - half] + following[:half]
        r = by_id[doc_id]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["fingerprint"] == HASHER.fingerprint(text)
        assert r["edited_fingerprint"] == HASHER.fingerprint(changed)
        assert r["near_next"] == likeness(r["fingerprint"], HASHER.fingerprint(following))
        assert r["near_edited"] == likeness(r["fingerprint"], r["edited_fingerprint"])


def test_next_document_over_ranges(spark):
    df = table(spark, "documents")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    for ranges in (1, 5, 400):
        got = with_next(spark, df.repartition(6), ranges=ranges).collect()
        assert len(got) == len(rows)
        _check(rows, got)


def test_odd_rows(spark):
    unique = [r for i, r in enumerate(ODD) if r[0] is not None and r not in ODD[:i]]
    unique.append((None, "only one without id", None, None, 0))
    got = with_next(spark, crowded(docs(spark, unique)), ranges=4).collect()
    assert len(got) == len(unique)
    _check([r[:2] for r in unique], got)
    for ranges in (1, 3):
        assert with_next(spark, docs(spark), ranges=ranges).count() == len(ODD)
    assert with_next(spark, docs(spark, [])).count() == 0
    alone = with_next(spark, docs(spark, [(1, "abcd", None, None, 4)])).first()
    assert alone["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and alone["near_next"] == 1
    nameless = with_next(spark, docs(spark, [(None, "b", None, None, 1), (None, "a", None, None, 1)])).collect()
    assert len(nameless) == 2


def test_fingerprints_of_rows(spark):
    got = fingerprints(docs(spark)).collect()
    assert sorted(r["fingerprint"] for r in got) == sorted(HASHER.fingerprint(r[1] or "") for r in ODD)


def test_texts_that_share_half_are_seen(spark):
    """Too few tuples read 0 for many of them, as for unrelated texts."""
    texts = [r["text"] for r in table(spark, "documents").orderBy("doc_id").collect() if len(r["text"] or "") >= 400]
    near = np.array([
        likeness(HASHER.fingerprint(a), HASHER.fingerprint(edited(a, b))) for a, b in zip(texts, texts[1:], strict=False)
    ])
    assert len(near) >= 50 and np.mean(near == 0) <= 0.01 and np.mean(near <= 0.05) <= 0.1
