"""Sums over all subtrees of a forest by centroid decomposition of its parent edges.

The centroid of a component is the lightest node that has half of the weight below it or more. It is taken out; what
hung on it falls apart into components of its own, and the total of all that was below it is added to each node on
the way from the centroid to the top of the component. Every component that is left has half the weight at most, so
a chain and a star of n nodes alike are done after log2(n) rounds.

Large components are split by Spark, a round at a time for all of them; one that has become small enough is finished
by a task, again level by level for all components that the task holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from aduana.llm.common import written

#: Weight of a component that one task may finish. A node weighs one or more, so it has as many nodes at most.
TASK_WEIGHT = 20_000
_TOP = ["top_path", "top_depth"]


def subtree_sums(
    spark: SparkSession, nodes: DataFrame, paths: DataFrame, values: list[str], task_weight: int = TASK_WEIGHT
) -> DataFrame:
    """(path, depth, *values): the values of every node summed over its subtree, its own included.

    nodes: (path, depth, parent, weight, *values). A node is named by a path from its root that runs through it and
    by its depth; parent is the path that names its parent, null for a root. weight is one or more for the node
    itself, and contains that of its subtree. Values are whole numbers. paths: (path, depth, node, child) has every
    node on every path that names one: the name it has, and that of the next node on the path.
    """
    # A root is the first top.
    roots = nodes.filter("parent is null").select(F.col("path").alias("r_path"), F.col("depth").alias("r_depth"))
    found = paths.join(roots, (F.col("node") == F.col("r_path")) & (F.col("depth") == F.col("r_depth")))
    of_path = found.select(F.col("path").alias("p"), F.col("r_path").alias(_TOP[0]), F.col("r_depth").alias(_TOP[1]))
    state = nodes.join(of_path, F.col("path") == F.col("p")).select(
        "path", "depth", "parent", *_TOP, "weight", *values, *[F.lit(0).cast("long").alias(f"got_{v}") for v in values]
    )
    small: list[DataFrame] = []
    done: list[DataFrame] = []
    while True:
        totals = state.groupBy(*_TOP).agg(F.max("weight").alias("total"))
        state = written(spark, state.join(totals, _TOP), "components")
        small.append(state.filter(F.col("total") <= task_weight).drop("total"))
        large = state.filter(F.col("total") > task_weight)
        centroids = written(spark, large.filter("2 * weight >= total").groupBy(*_TOP).agg(
            F.min(F.struct("weight", "path", "depth")).alias("c")
        ).select(*_TOP, F.col("c.path").alias("c_path"), F.col("c.depth").alias("c_depth")), "centroids")
        if centroids.isEmpty():
            break
        large, finished = _split(spark, large, centroids, paths, values)
        done.append(finished)
        state = large
    rest = _in_tasks(reduce(DataFrame.unionByName, small), values)
    return reduce(DataFrame.unionByName, done, rest)


def _split(
    spark: SparkSession, large: DataFrame, centroids: DataFrame, paths: DataFrame, values: list[str]
) -> tuple[DataFrame, DataFrame]:
    """What is left of the components without their centroids, and the centroids with their sums."""
    # Paths that run through a centroid, and the node under it that each of them goes on to.
    through = paths.alias("p").join(
        centroids.alias("c"), F.expr("p.node = c.c_path and p.depth = c.c_depth")
    ).select(F.col("p.path").alias("t_path"), *[F.col(f"c.{t}").alias(f"t_{t}") for t in _TOP], "c_depth", "child")
    moved = large.join(
        through, F.expr("path = t_path and top_path = t_top_path and top_depth = t_top_depth"), "left"
    ).withColumn("side", F.signum(F.coalesce(F.col("depth") - F.col("c_depth"), F.lit(-1))).cast("int"))
    moved = written(spark, moved.drop("t_path", "t_top_path", "t_top_depth"), "moved")
    # Totals of what was below each centroid.
    sums = moved.filter("side >= 0").groupBy(*_TOP).agg(
        F.max("weight").alias("s_weight"), *[F.sum(v).alias(f"s_{v}") for v in values]
    )
    sums = written(spark, centroids.join(sums, _TOP), "totals")
    # Nodes on the way from the centroid to the top.
    upward = paths.alias("p").join(
        sums.alias("s"), F.expr("p.path = s.c_path and p.depth < s.c_depth and p.depth >= s.top_depth")
    ).select(
        F.col("p.node").alias("u_path"), F.col("p.depth").alias("u_depth"), "s_weight", *[f"s_{v}" for v in values]
    )
    below = F.col("side") > 0
    left = moved.filter("side <> 0").join(upward, F.expr("path = u_path and depth = u_depth"), "left").select(
        "path", "depth", "parent",
        F.when(below, F.col("child")).otherwise(F.col("top_path")).alias("top_path"),
        F.when(below, F.col("c_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
        (F.col("weight") - F.coalesce("s_weight", F.lit(0))).alias("weight"), *values,
        *[(F.col(f"got_{v}") + F.coalesce(f"s_{v}", F.lit(0))).alias(f"got_{v}") for v in values],
    )
    finished = moved.filter("side = 0").join(sums.select(*_TOP, *[f"s_{v}" for v in values]), _TOP).select(
        "path", "depth", *[(F.col(f"got_{v}") + F.col(f"s_{v}")).alias(v) for v in values]
    )
    return left, finished


def _in_tasks(small: DataFrame, values: list[str]) -> DataFrame:
    """Components that one task may finish; it holds one, or several of together a batch."""
    names = ["path", "depth", *values]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = np.column_stack([c.fill_null(0).to_numpy(zero_copy_only=False) for c in batch.columns])
            rows = rows if rest is None else np.concatenate([rest, rows])
            if not len(rows):
                continue
            other = np.flatnonzero((rows[:, :2] != rows[-1, :2]).any(1))
            end = int(other[-1]) + 1 if len(other) else 0
            rest = rows[end:]
            yield of(rows[:end])
        if rest is not None:
            yield of(rest)

    def of(rows: np.ndarray) -> pa.RecordBatch:
        n = len(values)
        sums = component_sums(*rows[:, :6].T, rows[:, 6:6 + n], rows[:, 6 + n:])
        columns = [rows[:, 2], rows[:, 3], *sums.T]
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=names)

    rows = small.select(
        *_TOP, "path", "depth", "parent", "weight", *[F.col(v).cast("long") for v in values], *[f"got_{v}" for v in values]
    )
    rows = rows.repartition(*_TOP).sortWithinPartitions(*_TOP, "path", "depth")
    return rows.mapInArrow(summed, ", ".join(f"{c} long" for c in names))


def component_sums(
    top_path: np.ndarray, top_depth: np.ndarray, path: np.ndarray, depth: np.ndarray, parent_path: np.ndarray,
    weight: np.ndarray, own: np.ndarray, got: np.ndarray,
) -> np.ndarray:
    """Sums of whole components; rows come by component, path and depth. got: what each node has been given."""
    n = len(path)
    result = np.zeros_like(own)
    if not n:
        return result
    parent = _parents(top_path, top_depth, path, depth, parent_path)
    weight, got, alive = weight.copy(), got.copy(), np.ones(n, bool)
    component = np.cumsum(np.concatenate([[0], (top_path[1:] != top_path[:-1]) | (top_depth[1:] != top_depth[:-1])]))
    while alive.any():
        here = np.flatnonzero(alive)
        _, of = np.unique(component[here], return_inverse=True)
        total = np.zeros(of.max() + 1, np.int64)
        np.maximum.at(total, of, weight[here])
        heavy = np.flatnonzero(2 * weight[here] >= total[of])
        heavy = heavy[np.lexsort((weight[here][heavy], of[heavy]))]
        centroid = here[heavy[np.unique(of[heavy], return_index=True)[1]]]
        # The top of every new component, found by doubling the steps upward.
        taken = np.zeros(n + 1, bool)
        taken[centroid] = True
        ends = np.concatenate([~alive, [True]]) | taken  # place n, that is -1, is above all
        jump = np.arange(n)
        jump[here] = np.where(ends[parent[here]] | taken[here], here, parent[here])
        while (jump[jump[here]] != jump[here]).any():
            jump[here] = jump[jump[here]]
        totals = np.zeros((n + 1, own.shape[1]), np.int64)
        np.add.at(totals, jump[here], own[here])
        tops = here[(jump[here] == here) & taken[parent[here]]]
        np.add.at(totals, parent[tops], totals[tops])
        result[centroid] = got[centroid] + totals[centroid]
        # On the way from each centroid to the top of its component.
        lost, given, at = weight[centroid], totals[centroid], parent[centroid]
        while True:
            inside = np.concatenate([alive, [False]])[at]
            if not inside.any():
                break
            lost, given, at = lost[inside], given[inside], at[inside]
            got[at] += given
            weight[at] -= lost
            at = parent[at]
        alive[centroid] = False
        component = jump
    return result


def _parents(
    top_path: np.ndarray, top_depth: np.ndarray, path: np.ndarray, depth: np.ndarray, parent_path: np.ndarray
) -> np.ndarray:
    """Row of every node's parent; -1 for the top of a component. Nodes of one path follow each other in depth."""
    new = np.ones(len(path), bool)
    changed = np.ones(len(path), bool)
    changed[1:] = (top_path[1:] != top_path[:-1]) | (top_depth[1:] != top_depth[:-1])
    new[1:] = changed[1:] | (path[1:] != path[:-1])
    parent = np.arange(len(path)) - 1
    first = np.flatnonzero(new)
    component = np.cumsum(changed) - 1
    _, rank = np.unique(np.concatenate([path[first], parent_path[first]]), return_inverse=True)
    width = int(rank.max()) + 1
    known = component[first] * width + rank[:len(first)]  # ascending, as the rows are
    at = np.searchsorted(known, component[first] * width + rank[len(first):])
    start = first[np.minimum(at, len(first) - 1)]
    top = (path[first] == top_path[first]) & (depth[first] == top_depth[first])
    parent[first] = np.where(top, -1, start + depth[first] - 1 - depth[start])
    return parent
