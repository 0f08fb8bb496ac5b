"""Conversation prefix trie: a node for each distinct beginning, with sums over all that goes on from it.

Turns are hashed where they are read; what is dealt out afterwards are numbers. The beginning of d turns is named by
the sum of the hashes of (place, turn) over its turns, so that very long conversations are summed in segments like any
prefix sum. Node counts come from one grouping of these names; sums over subtrees by centroid decomposition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from aduana.llm.centroids import TASK_WEIGHT, subtree_sums
from aduana.llm.common import table, written

#: Turns of a conversation that are summed by one task.
SEGMENT_TURNS = 4096
#: Numbers that are joined to one text before the texts of a node are hashed.
CHUNK_IDS = 4096
#: Characters of a text that order turns of one number and role.
HEAD_CHARS = 64
# Fixed values of the contract: conversations of a family, and one more than the most turns taken from its first.
FAMILY, SHARED = 5, 9

_KEY = ["depth", "s1", "s2"]


def numbered_turns(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """(c, rank, d1, d2, bytes, own) of every turn: its place from 1 on, hash of role and text, bytes of the text, and
    how many turns the conversation has.

    Sorted in ranges, so that a conversation that has most of the rows is spread like any others.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)

    def number(first: int) -> Column:
        return F.conv(F.substring(F.col("digest"), first, 15), 16, 10).cast("long")

    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.left(text, F.lit(HEAD_CHARS)).alias("head"), digest.alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("row"),
    )
    order = ["c", F.asc_nulls_first("turn"), "role", "head", "digest", "row"]
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = written(spark, rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(
        "c", number(1).alias("d1"), number(16).alias("d2"), "bytes", F.monotonically_increasing_id().alias("at")
    ), "turns").withColumn("part", F.shiftrightunsigned("at", 33))
    # The part of a conversation in each range: the ranges before it give the place where it goes on.
    pieces = placed.groupBy("c", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("c")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        "c", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.sum("n").over(whole).alias("own"),
    )
    return placed.join(pieces, ["c", "part"]).select(
        "c", (F.col("at") - F.col("first") + F.col("before") + 1).alias("rank"), "d1", "d2", "bytes", "own"
    )


def rebuilt(spark: SparkSession, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (c, depth, d1, d2, bytes) and conversations (c, length): the first h turns of conversation c - c % 5, then
    the own turns after the first h; h is the checksum of c, modulo 9."""
    turns = written(spark, numbered_turns(spark, conversations), "numbered")
    own = turns.filter("rank = 1").select("c", "own")
    shared = (F.crc32(F.col("c").cast("string").cast("binary")) % SHARED).cast("long")
    first = own.select(F.col("c").alias("b"), F.col("own").alias("b_own"))
    convs = own.select("c", "own", shared.alias("h"), (F.col("c") - F.col("c") % FAMILY).alias("base")).join(
        first, F.col("base") == F.col("b"), "left"
    ).withColumn("taken", F.least("h", F.coalesce("b_own", F.lit(0)))).select(
        "c", "base", "taken", "h",
        (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"),
    )
    convs = written(spark, convs, "conversations")
    numbers = ["d1", "d2", "bytes"]
    kept = turns.join(convs.select("c", "taken", "h"), "c").filter("rank > h").select(
        "c", (F.col("rank") - F.col("h") + F.col("taken")).alias("depth"), *numbers
    )
    heads = turns.filter((F.col("c") % FAMILY == 0) & (F.col("rank") < SHARED)).withColumnRenamed("c", "b")
    given = convs.select("c", "base", "h").join(heads, F.expr("base = b and rank <= h")).select(
        "c", F.col("rank").alias("depth"), *numbers
    )
    return kept.unionByName(given), convs.select("c", "length")


def prefix_paths(spark: SparkSession, turns: DataFrame, convs: DataFrame, segment: int = SEGMENT_TURNS) -> DataFrame:
    """(c, depth, s1, s2, p1, p2, bytes, length) of every beginning of every conversation, that of no turn included:
    its name, that of the beginning before it, and the bytes of its last turn."""
    def term(seed: int) -> Column:
        return F.xxhash64(F.lit(seed), "d1", "d2", "depth").cast("decimal(20,0)")

    rows = turns.join(convs, "c").select(
        "c", "depth", "bytes", "length", term(1).alias("t1"), term(2).alias("t2"),
        F.floor((F.col("depth") - 1) / segment).alias("segment"),
    )
    running = Window.partitionBy("c", "segment").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({f"r{i}": F.sum(f"t{i}").over(running) for i in (1, 2)})
    before = Window.partitionBy("c").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.filter(F.col("length") > segment).groupBy("c", "segment").agg(
        F.sum("t1").alias("t1"), F.sum("t2").alias("t2")
    ).select("c", "segment", F.sum("t1").over(before).alias("b1"), F.sum("t2").over(before).alias("b2"))
    zero = F.lit(0).cast("decimal(30,0)")

    def name(i: int) -> Column:
        return (F.col(f"r{i}") + F.coalesce(f"b{i}", zero)).cast("decimal(38,0)")

    def earlier(i: int) -> Column:
        return (name(i) - F.col(f"t{i}")).cast("decimal(38,0)")

    below = local.join(carried, ["c", "segment"], "left").select(
        "c", "depth", name(1).alias("s1"), name(2).alias("s2"), earlier(1).alias("p1"), earlier(2).alias("p2"),
        "bytes", "length",
    )
    wide, none = F.lit(0).cast("decimal(38,0)"), F.lit(None).cast("decimal(38,0)")
    roots = convs.select(
        "c", F.lit(0).cast("long").alias("depth"), wide.alias("s1"), wide.alias("s2"), none.alias("p1"),
        none.alias("p2"), F.lit(0).cast("long").alias("bytes"), "length",
    )
    return written(spark, below.unionByName(roots), "paths")


def trie(
    spark: SparkSession, turns: DataFrame, convs: DataFrame, segment: int = SEGMENT_TURNS,
    task_weight: int = TASK_WEIGHT,
) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node.

    turns: (c, depth, d1, d2, bytes) with depths from 1 on without a gap, d1 and d2 the hash of the turn; convs:
    (c, length) of every conversation, one without turns included. See `op11_trie` for what the columns are.
    """
    paths = prefix_paths(spark, turns, convs, segment)
    nodes = paths.groupBy(*_KEY).agg(
        F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"),
        # Of every member, what it has from here on: more for a node than for what is below it.
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
    )
    nodes = written(spark, nodes, "nodes")
    up = nodes.select((F.col("depth") + 1).alias("d"), F.col("s1").alias("u1"), F.col("s2").alias("u2"),
                      F.col("conv_id").alias("parent_conv_id"))
    linked = nodes.join(up, F.expr("depth = d and p1 = u1 and p2 = u2"), "left").drop("d", "u1", "u2")
    linked = written(spark, linked, "linked")
    children = linked.filter("depth > 0").groupBy(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")
    ).agg(F.count(F.lit(1)).alias("n_children"))
    full = written(spark, linked.join(children, ["conv_id", "depth"], "left").select(
        *_KEY, "conv_id", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "weight",
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
    ), "full")
    # Every conversation that names a node, with the names of all nodes on its way.
    named = full.select(*_KEY, F.col("conv_id").alias("node"))
    ways = paths.select("c", *_KEY).join(full.select(F.col("conv_id").alias("c")).distinct(), "c", "left_semi")
    ways = written(spark, ways.join(named, _KEY).select(F.col("c").alias("path"), "depth", "node"), "ways")
    following = ways.select("path", (F.col("depth") - 1).alias("depth"), F.col("node").alias("child"))
    ways = written(spark, ways.join(following, ["path", "depth"], "left"), "ways")
    sums = subtree_sums(spark, full.select(
        F.col("conv_id").alias("path"), "depth", F.col("parent_conv_id").alias("parent"), "weight",
        (F.col("n_children") == 0).cast("long").alias("leaves"), "saved",
    ), ways, ["leaves", "saved"], task_weight)
    sums = sums.select(F.col("path").alias("conv_id"), "depth", F.col("leaves").alias("n_leaves"),
                       F.col("saved").alias("saved_tokens"))
    ends = paths.filter("depth = length").select("c", *_KEY).join(named, _KEY).select("node", "depth", "c")
    return full.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children").join(
        sums, ["conv_id", "depth"]
    ).join(end_digests(spark, ends), ["conv_id", "depth"], "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest()))
    )


def end_digests(spark: SparkSession, ends: DataFrame, chunk: int = CHUNK_IDS) -> DataFrame:
    """(conv_id, depth, ends_sha256) of (node, depth, c): digest of the numbers c of a node in their order.

    A digest is one task's; it gets the numbers already joined, `chunk` of them at a time.
    """
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        out: list[tuple] = []

        def close() -> None:
            if held:
                out.append((*key, held[0], ",".join(map(str, held))))
                held.clear()

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * 4
            out.clear()
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["conv_id", "depth", "first", "ids"]
            )

        for batch in batches:
            for node, depth, c in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if (node, depth) != key or len(held) >= chunk:
                    close()
                    key = (node, depth)
                held.append(c)
            yield batch_of()
        close()
        yield batch_of()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, hashlib.sha256()
        out: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * 3
            out.clear()
            types = [pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["conv_id", "depth", "ends_sha256"]
            )

        for batch in batches:
            for node, depth, _, ids in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if (node, depth) != key:
                    if key is not None:
                        out.append((*key, digest.hexdigest()))
                    key, digest = (node, depth), hashlib.sha256(ids.encode())
                else:
                    digest.update(f",{ids}".encode())
            yield batch_of()
        if key is not None:
            out.append((*key, digest.hexdigest()))
        yield batch_of()

    order = ["node", "depth", "c"]
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pieces = ends.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(
        joined, "conv_id long, depth long, first long, ids string"
    )
    return pieces.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first").mapInArrow(
        hashed, "conv_id long, depth long, ends_sha256 string"
    )


def op11_trie(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """Every node of the trie of the rebuilt conversations.

    conv_id the smallest member; depth; parent_conv_id that of the parent (root: null); n_convs members; n_children;
    n_leaves nodes without children in the subtree; saved_tokens the bytes that the subtree's nodes need not repeat;
    ends_sha256 digest of the members that end here.

    Turns come by number, null first; those of one number by role, the first characters of the text, and its hash. A
    null role or text is empty. Rows without a conv_id belong to no conversation and make none. Repeated rows are
    turns of their own. Texts of any length are hashed whole where they are read. An empty table has no node, not
    even a root; other columns are not read, whatever their names.
    """
    return trie(spark, *rebuilt(spark, conversations))


# Checksums by the table of the reversed polynomial; beginnings are named by the digests of their turns, side by side.
OP11_SQL = """
WITH steps AS (
    SELECT list(list_reduce([i, 1, 2, 3, 4, 5, 6, 7, 8], lambda a, b:
        CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END) ORDER BY i) AS step FROM range(256) r(i)
), ranked AS (
    SELECT conv_id AS c, sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
        strlen(coalesce(text, ''))::BIGINT AS bytes,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS rank
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT c, count(*) AS own, c - c % 5 AS base FROM ranked GROUP BY c
), convs AS (
    SELECT c, own, base, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(c::VARCHAR, ''),
        lambda x: ascii(x)::BIGINT), lambda a, b: xor(step[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % 9 AS h
    FROM own, steps
), lengths AS (
    SELECT a.c, a.base, a.h, least(a.h, coalesce(b.own, 0)) AS taken,
        least(a.h, coalesce(b.own, 0)) + greatest(a.own - a.h, 0) AS length
    FROM convs a LEFT JOIN own b ON b.c = a.base
), turns AS (
    SELECT c, rank - h + taken AS depth, digest, bytes FROM ranked JOIN lengths USING (c) WHERE rank > h
    UNION ALL
    SELECT l.c, r.rank, r.digest, r.bytes FROM lengths l JOIN ranked r ON r.c = l.base AND r.rank <= l.h
), paths AS (
    SELECT c, depth, string_agg(digest, '') OVER (PARTITION BY c ORDER BY depth) AS name, bytes FROM turns
    UNION ALL
    SELECT c, 0, '', 0 FROM lengths
), nodes AS (
    SELECT name, depth, min(c) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM paths GROUP BY name, depth
), children AS (
    SELECT left(name, 64 * (depth::INTEGER - 1)) AS name, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), rated AS (
    SELECT x.*, coalesce(k.n, 0) AS n_children, (n_convs - 1) * bytes AS saved FROM nodes x LEFT JOIN children k USING (name)
), sums AS (
    SELECT left(name, 64 * u.d::INTEGER) AS name, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves,
        sum(saved)::BIGINT AS saved_tokens
    FROM rated, unnest(range(0, depth + 1)) u(d) GROUP BY 1
), ends AS (
    SELECT name, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS digest FROM paths JOIN lengths USING (c)
    WHERE depth = length GROUP BY name
)
SELECT x.conv_id, x.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, x.n_convs, x.n_children, s.n_leaves, s.saved_tokens,
    coalesce(e.digest, sha256('')) AS ends_sha256
FROM rated x JOIN sums s USING (name) LEFT JOIN ends e USING (name)
LEFT JOIN nodes u ON x.depth > 0 AND u.name = left(x.name, 64 * (x.depth::INTEGER - 1))
"""


def op11_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_trie(spark, table(spark, sf_dir, "conversations"))
