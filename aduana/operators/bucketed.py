"""Tables bucketed by their key, merged without moving the rows they hold.

The files of a table are its buckets. A merge deals out the batch alone, into as many parts as the table has buckets;
each task then joins one bucket with its part of the batch and writes the bucket of the next snapshot. What a merge
shuffles therefore depends on the batch, not on the table.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aduana.operators.sinks import add_new_columns, move_table, snapshot_path, table_exists

_HERE, _NEW = "_here", "_new"


def _write(df: DataFrame, name: str, location: str, keys: list[str], buckets: int) -> None:
    df.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", location).saveAsTable(name)


def create_bucketed(spark: SparkSession, df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> None:
    """A table in `buckets` files below `path`, dealt out by all of `keys`. A bucket is one task's in a merge: choose
    their number so that each stays at some hundred megabytes."""
    _write(df.repartition(buckets, *keys), name, snapshot_path(path), keys, buckets)


def buckets_of(spark: SparkSession, name: str) -> tuple[int, list[str]]:
    """Number of buckets of a table, and the columns that deal rows out."""
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if "Num Buckets" not in about:
        raise ValueError(f"{name} is not bucketed")
    return int(about["Num Buckets"]), [c.strip(" `") for c in about["Bucket Columns"].strip("[]").split(",")]


def merged_in_buckets(target: DataFrame, source: DataFrame, keys: list[str], null_safe: bool = True) -> DataFrame:
    """Target after the upsert: one full join on the bare keys, which is what keeps buckets in place.

    `source` holds one row per key. Columns it lacks keep their old value; those the target lacks are new. Keys with a
    null equal no other in this join. They are few, and merged apart: with `null_safe` a null matches a null, without
    it such rows are inserted each time.
    """
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    full = _joined(target.filter(whole), source.filter(whole), keys, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    old, new = target.filter(~whole), source.filter(~whole)
    if not null_safe:
        return full.unionByName(old, allowMissingColumns=True).unionByName(new, allowMissingColumns=True)
    matches = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    return full.unionByName(_joined(old, new, keys, matches))


def _joined(target: DataFrame, source: DataFrame, keys: list[str], matches: list[Column]) -> DataFrame:
    t, s = target.withColumn(_HERE, F.lit(True)).alias("t"), source.withColumn(_NEW, F.lit(True)).alias("s")
    both = t.join(s, reduce(lambda a, b: a & b, matches), "full")
    of_source, of_target = set(source.columns), set(target.columns)

    def column(name: str) -> Column:
        if name not in of_source:
            return F.col(f"t.{name}")
        if name not in of_target:
            return F.col(f"s.{name}")
        return F.when(F.col(f"s.{_NEW}"), F.col(f"s.{name}")).otherwise(F.col(f"t.{name}")).alias(name)

    return both.select(*map(column, [*target.columns, *[c for c in source.columns if c not in of_target]]))


def upsert_bucketed(
    spark: SparkSession, name: str, source: DataFrame, keys: list[str], path: str, buckets: int, null_safe: bool = True
) -> str:
    """Upsert `source`, one row per key, into the bucketed table `name` kept below `path`; returns `created` or
    `updated`. The table keeps the buckets it was made with. Its next snapshot is written beside it, and then the
    table pointed there; earlier ones stay until `sinks.remove_old_snapshots`."""
    if not table_exists(spark, name):
        create_bucketed(spark, source, name, path, keys, buckets)
        return "created"
    number, columns = buckets_of(spark, name)
    if columns != keys:
        raise ValueError(f"{name} is bucketed by {columns}, not by {keys}")
    add_new_columns(spark, name, source.schema)
    location, aside = snapshot_path(path), f"{name}_{uuid.uuid4().hex[:12]}"
    rows = merged_in_buckets(spark.table(name), source, keys, null_safe)
    # The files are written as those of a table with the same buckets, whose entry then goes; they stay.
    _write(rows.select(*spark.table(name).columns), aside, location, keys, number)
    move_table(spark, name, location)
    spark.sql(f"DROP TABLE {aside}")
    return "updated"
