from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from aduana.llm.centroids import component_sums
from aduana.llm.trie import OP11_SQL, end_digests, op11_trie, rebuilt, trie
from tests.compare import connect
from tests.llm.cases import SF, crowded, table

ROWS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turns_by_conversation(rows):
    found = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            found[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(x, key=lambda t: (*t[:3], t[3][:64], digest(t[2:])))] for c, x in found.items()}


def digest(turn):
    return hashlib.sha256(f"{len(turn[0])}:{turn[0]}{turn[1]}".encode()).hexdigest()


def whole(rows):
    by = turns_by_conversation(rows)
    out = {}
    for c, own in by.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = by.get(base, [])[:h] + own[h:]
    return out


def nodes(conversations):
    members, children, ends = defaultdict(list), defaultdict(set), defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[:d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    sums = {}
    for key in sorted(members, key=len, reverse=True):
        saved = (len(members[key]) - 1) * len(key[-1][1].encode()) if key else 0
        below = [sums[k] for k in children[key]]
        sums[key] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    return sorted((
        min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]), *sums[k],
        hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest(),
    ) for k, m in members.items())


def got(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


ODD = [
    (5, 0, "user", "hi"), (5, 1, "assistant", "yo"), (5, None, "system", None), (6, 0, "user", "hi"), (6, 1, None, "yo"),
    (7, 3, "user", "a"), (7, 3, "user", "a"), (7, 3, "assistant", "b"), (None, 0, "user", "hi"), (None, None, None, None),
    (-7, 0, "user", "é𝒳"), (-5, 0, "user", "é𝒳"), (-5, 7, "user", "z"), (0, 0, None, None), (10, 0, "user", "x" * 300_000),
    (11, 0, "ab", "c"), (12, 0, "a", "bc"), (10, 5, "user", "x" * 299_999 + "y"), (13, 2, "user", ""), (14, 9, "", ""),
]


def family(seed=1, convs=60, most=14):
    rng = random.Random(seed)
    return [(c, t * 3, rng.choice(["user", "assistant"]), rng.choice(["ja", "no", "maybe so"]))
            for c in range(20, 20 + convs) for t in range(rng.randrange(most))]


def test_odd_rows(spark):
    df = crowded(spark.createDataFrame(ODD, ROWS))
    assert got(op11_trie(spark, df)) == nodes(whole(ODD))
    assert got(op11_trie(spark, df.limit(0))) == []


@pytest.mark.parametrize("segment, weight", [(4096, 20_000), (3, 40)])
def test_split_by_spark_and_in_tasks(spark, segment, weight):
    rows = family()
    turns, convs = rebuilt(spark, spark.createDataFrame(rows, ROWS).repartition(3))
    assert got(trie(spark, turns, convs, segment, weight)) == nodes(whole(rows))


def test_one_deep_conversation_and_copies(spark):
    rows = [(30, t, "user", f"t{t % 7}") for t in range(400)] + [
        (c, t, "user", "same") for c in range(100, 160) for t in range(12)]
    turns, convs = rebuilt(spark, spark.createDataFrame(rows, ROWS))
    assert got(trie(spark, turns, convs, segment=32, task_weight=5000)) == nodes(whole(rows))


def test_given_table(spark):
    rows = [tuple(r) for r in table(spark, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert got(op11_trie(spark, table(spark, "conversations"))) == nodes(whole(rows))


def test_sql_says_the_same():
    """The statement that the driver compares with, against the plain trie."""
    for folder in (SF, SF.replace("0.001", "0.01")):
        con = connect(folder)
        rows = con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
        assert sorted(con.execute(OP11_SQL).fetchall()) == nodes(whole(rows))


def test_digest_of_many_numbers(spark):
    ids = list(range(-50, 1000, 3))
    df = spark.createDataFrame([(1, 2, c) for c in ids] + [(1, 3, 9)], "node long, depth long, c long").repartition(4)
    found = {(r["conv_id"], r["depth"]): r["ends_sha256"] for r in end_digests(spark, df, chunk=7).collect()}
    assert found == {(1, 2): hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     (1, 3): hashlib.sha256(b"9").hexdigest()}


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_component_sums(shape):
    rng = np.random.default_rng(4)
    n = 300
    above = {"chain": lambda i: i - 1, "star": lambda i: 0, "random": lambda i: int(rng.integers(0, i))}[shape]
    parent = [-1] + [above(i) for i in range(1, n)]
    name, depth = [0], [0]
    heir = {}
    for i in range(1, n):  # the first child carries on the path of its parent
        name.append(name[parent[i]] if heir.setdefault(parent[i], i) == i else i)
        depth.append(depth[parent[i]] + 1)
    weight, own = np.ones(n, np.int64), rng.integers(0, 50, (n, 2))
    wanted = own.copy()
    for i in range(n - 1, 0, -1):
        weight[parent[i]] += weight[i]
        wanted[parent[i]] += wanted[i]
    name, depth = np.array(name), np.array(depth)
    order = np.lexsort((depth, name))
    above = np.array([name[p] if p >= 0 else 0 for p in parent])
    zero = np.zeros(n, np.int64)
    result = component_sums(zero, zero, name[order], depth[order], above[order], weight[order], own[order], own[order] * 0)
    assert (result == wanted[order]).all()
