"""Latest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "_rank"


def latest_by_key(
    df: DataFrame,
    keys: list[str],
    order: list[str | Column],
    tiebreak: list[str] | None = None,
) -> DataFrame:
    """Keep the row that comes first when `order` is sorted descending, one per key.

    Rows equal in `order` are told apart by `tiebreak` (default: all remaining columns), so a
    repeated run keeps the same row. The rank filter makes Spark cut each key to one row inside
    every map task before the shuffle, so a key that holds a third of the table reaches its
    reducer as one row per map task.
    """
    named = {o for o in order if isinstance(o, str)}
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in named and c not in keys]
    ranked_by = [F.col(o).desc() if isinstance(o, str) else o for o in order]
    ranked_by += [F.col(c).desc() for c in tiebreak]
    window = Window.partitionBy(*keys).orderBy(*ranked_by)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)
