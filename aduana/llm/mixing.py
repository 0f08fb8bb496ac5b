"""Mixing sources to target weights: whole copies of documents by pivotal dependent rounding.

Every document of a source should be taken target / source size times. The whole part of that is certain; the rest
is a probability that is rounded to 0 or 1. Documents are paired; words are moved at random from one to the other
until one of the two is whole, so that the expected copies of either stay and the words of the two together do not
change. What is left fractional in a bucket goes up a reduction tree to the next one, to one bucket per source.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from aduana.llm.common import free_name, written

# Weights of the sources, repeating, and the most often that a source is taken.
WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 20
#: Documents of a bucket of the first level, and buckets that meet in one of the next.
LEAF, FAN = 10_000, 32
#: Equal rows that one task writes out.
ROWS_AT_ONCE = 10_000
#: Fractional documents of each power-of-two size class that a bucket leaves to the level above, so that the large
#: ones are rounded against small ones until the end. The last one left is then small.
RESERVE = 4

_EPS = 1e-9


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(
    spark: SparkSession, sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST
) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Sources by code point, null last, get the weights in turn. A source whose part exceeds `most` times its size
    stops there, and the excess is shared again by weight, until none is above. Sources of no words get nothing.
    Each round asks Spark for two sums.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = _ranked(spark, totals)
    turn = F.lit(float(weights[0]))
    for i, weight in enumerate(weights[1:], 1):
        turn = F.when(F.col("rank") % len(weights) == i, float(weight)).otherwise(turn)
    parts = written(spark, ranked.withColumn("weight", turn).drop("rank"), "sources")
    whole = parts.agg(F.sum("source_size")).first()[0] or 0
    level, ceiling = 0.0, most * F.col("source_size")
    while True:
        # All sources that the level reached would fill up to here stay full, as the level only rises.
        full = F.col("weight") * level >= ceiling
        kept, weight = parts.agg(
            F.sum(F.when(full, ceiling).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))
        ).first()
        if not weight or (raised := (whole - kept) / weight) <= level * (1 + 1e-12):
            break
        level = raised
    share = F.least(F.col("weight") * level, ceiling.cast("double"))
    return parts.select("source", "source_size", share.cast("double").alias("target"))


def _ranked(spark: SparkSession, sources: DataFrame) -> DataFrame:
    """Distinct sources with their place in the order: sorted in ranges, the ranges then counted."""
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = sources.repartitionByRange(parts, F.asc_nulls_last("source")).sortWithinPartitions(
        F.asc_nulls_last("source")
    )
    # Each range is one task's; its place and count in it survive in the table.
    placed = written(spark, ordered.select(
        "source", "source_size", F.monotonically_increasing_id().alias("_at")
    ), "ranks").withColumn("_part", F.shiftrightunsigned("_at", 33))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return placed.join(starts, "_part").select(
        "source", "source_size", (F.col("_start") + F.col("_at") - F.shiftleft("_part", 33)).alias("rank")
    )


def _draw(seed: int, a: int, b: int) -> float:
    """A number in [0, 1) that depends on the pair alone."""
    x = (seed * 0x9E3779B97F4A7C15 + a * 0xBF58476D1CE4E5B9 + b * 0x94D049BB133111EB + 0x2545F4914F6CDD1D) % (1 << 64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> shift)) * factor % (1 << 64)
    return ((x ^ (x >> 31)) >> 11) / (1 << 53)


def pivotal(mass: np.ndarray, part: np.ndarray, draw: np.ndarray, seed: int) -> int:
    """Rounds the probabilities `part` in place, in the order given; returns the index of the one that is left
    fractional, or -1. `mass` are sizes; the sum of mass * part stays as it is."""
    left = -1
    for i in range(len(part)):
        if not _EPS < part[i] < 1 - _EPS:
            part[i] = round(part[i])
            continue
        if left < 0:
            left = i
            continue
        a, b = left, i
        # Words that can go from b to a, and from a to b, until one of them is whole.
        up = min((1 - part[a]) * mass[a], part[b] * mass[b])
        down = min(part[a] * mass[a], (1 - part[b]) * mass[b])
        moved = up if _draw(seed, int(draw[a]), int(draw[b])) * (up + down) < down else -down
        part[a] += moved / mass[a]
        part[b] -= moved / mass[b]
        whole_a, whole_b = (not _EPS < part[x] < 1 - _EPS for x in (a, b))
        for x, whole in ((a, whole_a), (b, whole_b)):
            if whole:
                part[x] = round(part[x])
        left = -1 if whole_a and whole_b else b if whole_a else a
    return left


def _reduced(table: pa.Table, seed: int, last: bool) -> pa.Table:
    """One bucket: its documents rounded but for the reserve and one more; at the root, all of them."""
    mass = table["mass"].to_numpy().astype(np.float64)
    part = np.array(table["part"].to_numpy(), np.float64)
    draw = table["draw"].to_numpy()
    order = np.lexsort((draw, -mass))
    open_ = order[(part[order] > _EPS) & (part[order] < 1 - _EPS)]
    part[(part <= _EPS) | (part >= 1 - _EPS)] = np.round(part[(part <= _EPS) | (part >= 1 - _EPS)])
    held = np.zeros(len(part), bool)
    if not last:
        # The reserve of a class is drawn by hash, whatever the sizes in it.
        by = open_[np.lexsort((draw[open_], np.frexp(mass[open_])[1]))]
        classes = np.frexp(mass[by])[1]
        starts = np.concatenate([[0], np.flatnonzero(np.diff(classes)) + 1]) if len(by) else np.zeros(0, np.int64)
        place = np.arange(len(by)) - np.repeat(starts, np.diff(np.append(starts, len(by))))
        held[by[place < RESERVE]] = True
    todo = open_[~held[open_]]
    chosen = part[todo]
    left = pivotal(mass[todo], chosen, draw[todo], seed)
    if left >= 0 and last:
        chosen[left] = float(chosen[left] >= 0.5)  # nearest, so that the words are
    part[todo] = chosen
    done = ~held
    if left >= 0 and not last:
        done[todo[left]] = False
    return table.set_column(table.schema.get_field_index("part"), "part", pa.array(part)).set_column(
        table.schema.get_field_index("done"), "done", pa.array(done)
    )


def _reducer(seed: int, last: bool):
    def reduce(bucket: pa.Table) -> pa.Table:
        return _reduced(bucket, seed, last)

    return reduce


def copies(
    spark: SparkSession, sizes: DataFrame, id_col: str = "doc_id", weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST, seed: int = SEED,
) -> DataFrame:
    """(id, source, size, source_size, target, copies, rows, more) of the distinct rows of (id, source, size).

    Rows that are equal in these are one unit of `rows` rows. Each of them is taken `copies` times, and `more` of them
    once more: of the extra copies that the rows of a unit should get together, the whole ones are certain and only
    what is left of one row is drawn. A null id is an id and a null source a source. Rows of no words are taken no
    time. Nothing depends on the order of rows or on partitions: buckets and draws follow from hashes of the unit.
    """
    units = sizes.groupBy(id_col, "source", "size").agg(F.count(F.lit(1)).alias("_rows"))
    goal = targets(spark, sizes, weights, most)
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    base = F.when(F.col("size") > 0, F.floor(share + F.lit(_EPS))).otherwise(0).cast("int")
    fraction = F.when(F.col("size") > 0, F.greatest(share - base, F.lit(0.0))).otherwise(0.0)
    # Sources are joined null-safe; a source with a large part of the rows is split by Spark.
    # Of the rows of a unit together, so many get one copy more for certain.
    together = fraction * F.col("_rows")
    certain = F.floor(together + F.lit(_EPS)).cast("long")
    rows = units.alias("u").join(goal.alias("g"), F.col("u.source").eqNullSafe(F.col("g.source"))).select(
        f"u.{id_col}", "u.source", "size", "source_size", "target", base.alias("base"), "_rows",
        certain.alias("certain"), F.greatest(together - certain, F.lit(0.0)).alias("part"),
        F.col("size").cast("long").alias("mass"),
        F.xxhash64(F.col(f"u.{id_col}"), F.col("u.source"), F.col("size")).alias("draw"),
        F.lit(False).alias("done"),
    )
    rows = written(spark, rows, "units")
    tally = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    most_units = tally.agg(F.max("n")).first()[0] or 0
    # As many buckets for every source: a power of the fan, so that buckets of a level meet whole in the next.
    levels = 0
    while LEAF * FAN**levels < most_units:
        levels += 1
    finished: list[DataFrame] = []
    rest = rows
    for level in range(levels, -1, -1):
        keyed = rest.withColumn("_bucket", F.pmod(F.xxhash64("draw", F.lit(seed)), F.lit(FAN**level)))
        reduced = keyed.groupBy("source", "_bucket").applyInArrow(
            _reducer(seed + level, level == 0), keyed.schema
        ).drop("_bucket")
        reduced = written(spark, reduced, "rounded")
        finished.append(reduced.filter("done") if level else reduced)
        rest = reduced.filter("not done")
    result = finished[0]
    for more in finished[1:]:
        result = result.unionByName(more)
    return result.select(
        id_col, "source", "size", "source_size", "target", "draw",
        F.col("base").alias("copies"), F.col("_rows").alias("rows"),
        F.when(F.col("base") < int(most), F.col("certain") + F.round("part").cast("long")).otherwise(0).alias("more"),
    )


def each_row(units: DataFrame, most_at_once: int = ROWS_AT_ONCE) -> DataFrame:
    """The rows of `copies`, one for each row of the table: with what each is taken. A unit of very many rows is
    written out by several tasks."""
    pieces = F.sequence(F.lit(0), F.floor((F.col("rows") - 1) / most_at_once))
    dealt = units.filter("rows > 1").withColumn("_piece", F.explode(pieces)).repartition("draw", "_piece")
    first = F.col("_piece") * most_at_once
    several = dealt.withColumn("_row", F.explode(F.sequence(first + 1, F.least(first + most_at_once, "rows"))))
    both = units.filter("rows = 1").withColumn("_row", F.lit(1).cast("long")).unionByName(several.drop("_piece"))
    return both.withColumn("copies", F.col("copies") + (F.col("_row") <= F.col("more")).cast("int")).drop("_row")


def sizes_of(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """(id, source, size) of every row, without its text."""
    return written(spark, docs.select(
        F.col(id_col), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")
    ), "sizes")


def mixed_documents(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS, most: int = MOST, seed: int = SEED,
) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it: none, once, or up to `most` times.

    See `copies` for ties and nulls. Which of several equal rows get one copy more is drawn for each of them by its
    place in the table, so that their number is met on average. All columns stay, whatever their names; texts of any
    length are counted and repeated whole. An empty table stays empty.
    """
    unit, times, more = free_name(docs, "_unit"), free_name(docs, "_times"), free_name(docs, "_more")
    found = copies(spark, sizes_of(spark, docs, id_col, text_col, source_col), id_col, weights, most, seed)
    taken = found.filter("copies > 0 or more > 0").select(
        F.struct(F.col(id_col).alias("i"), F.col("source").alias("s"), F.col("size").alias("n")).alias(unit),
        F.col("copies").alias(times), (F.col("more") / F.col("rows")).alias(more),
    )
    key = F.struct(
        F.col(id_col).alias("i"), F.col(source_col).alias("s"), word_count(F.col(text_col)).alias("n")
    )
    # Structs of nulls are equal to each other, so one key joins them all.
    place = free_name(docs, "_place")
    rows = docs.withColumn(place, F.monotonically_increasing_id()).withColumn(unit, key).join(taken, unit)
    draw = F.pmod(F.xxhash64(F.lit(seed), unit, place), F.lit(1 << 30)) / float(1 << 30)
    times_all = F.col(times) + (draw < F.col(more)).cast("int")
    return rows.withColumn(times, times_all).filter(F.col(times) > 0).withColumn(
        unit, F.explode(F.sequence(F.lit(1), times))
    ).select(*docs.columns)


def op3_mixing(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Words the mix takes of every document."""
    return each_row(copies(spark, sizes_of(spark, docs))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )
