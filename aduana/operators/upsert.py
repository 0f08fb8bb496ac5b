"""Keyed upserts without a transactional table format.

The pure forms (`merged`, `accumulated`) take and return DataFrames. `upsert_table` applies the
same merge to a catalog table and never overwrites files its own plan reads: an unpartitioned
table gets a new snapshot folder and the catalog entry is pointed at it; a partitioned table has
only the touched partitions rebuilt, into a folder of their own, and their entries pointed there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField

from aduana.operators.dedup import latest_by_key
from aduana.operators.sinks import (
    FEW_PARTITIONS,
    MANY_ROWS,
    add_new_columns,
    columns_of,
    create_table,
    move_table,
    quoted,
    snapshot_path,
    table_exists,
    write_files,
)
from aduana.session import delete_path, fresh_path


# Fixed value: how Spark names the folder of a null.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _matches(left: str, right: str, keys: list[str], null_safe: bool) -> Column:
    pairs = [(F.col(f"{left}.{k}"), F.col(f"{right}.{k}")) for k in keys]
    return reduce(lambda a, b: a & b, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def merged(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    null_safe: bool = True,
    newer_by: str | None = None,
) -> DataFrame:
    """Target after the upsert: source rows replace target rows of the same key, others are added.

    `source` holds one row per key. Target columns the source lacks keep their old value on a
    matched row. With `null_safe` a null in the key matches a null, so a reload does not add the
    row again; without it such rows are inserted each time. With `newer_by` an older source row
    does not replace a newer target row.
    """
    extra = [c for c in target.columns if c not in source.columns]
    if extra:
        old = target.select(*keys, *extra).alias("t")
        source = (
            source.alias("s")
            .join(old, _matches("s", "t", keys, null_safe), "left")
            .select("s.*", *[F.col(f"t.{c}").alias(c) for c in extra])
        )
    if newer_by is not None:
        if not null_safe:
            # Rows with a null in the key equal no other row; they pass the choice by.
            whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
            both = merged(target.filter(whole), source.filter(whole), keys, True, newer_by)
            return both.unionByName(target.filter(~whole)).unionByName(source.filter(~whole), allowMissingColumns=True)
        both = target.withColumn("_from_source", F.lit(0)).unionByName(
            source.withColumn("_from_source", F.lit(1)), allowMissingColumns=True
        )
        return latest_by_key(both, keys, [newer_by, "_from_source"]).drop("_from_source")
    kept = target.alias("t").join(
        source.select(*keys).alias("s"), _matches("t", "s", keys, null_safe), "left_anti"
    )
    return kept.unionByName(source, allowMissingColumns=True)


def accumulated(
    target: DataFrame, source: DataFrame, keys: list[str], totals: list[str], latest_by: str
) -> DataFrame:
    """Upsert that adds up `totals` and takes every other column from the latest row."""
    columns = target.columns
    others = [c for c in columns if c not in keys and c not in totals]
    both = target.unionByName(source.select(*columns))
    newest = F.max_by(F.struct(*others), F.struct(latest_by, *[c for c in others if c != latest_by]))
    rows = both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in totals], newest.alias("_newest"))
    return rows.select(
        *[F.col(c) if c in keys or c in totals else F.col(f"_newest.{c}").alias(c) for c in columns]
    )


def staged(spark: SparkSession, df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write `df` once to the shared folder and read it back: later uses start from the files."""
    path = fresh_path(spark, label)
    write_files(df, path, partition_by)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def staged_counted(
    spark: SparkSession, df: DataFrame, label: str, latest: str, partition_by: list[str] | None = None
) -> tuple[DataFrame, dict]:
    """`staged`, with what passes by on the way: `records`, the largest `latest`, and the set of `partitions`. Nothing
    is read a second time for them."""
    seen = Observation()
    metrics = progress_of(latest)
    if partition_by:  # as many as the folders of the table
        metrics.append(F.collect_set(F.struct(*partition_by)).alias("partitions"))
    written = staged(spark, _as_stored(df, partition_by or []).observe(seen, *metrics), label)
    found = seen.get
    return written, found | {"partitions": {tuple(r) for r in found.get("partitions", [])}}


def progress_of(latest: str) -> list[Column]:
    """Number of rows and the largest `latest`."""
    return [F.count(F.lit(1)).alias("records"), F.max(latest).alias("latest")]


def _as_stored(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Empty text cannot name a partition folder; it is stored, and so must be matched, as null."""
    texts = [f.name for f in df.schema.fields if f.name in partition_by and isinstance(f.dataType, StringType)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in texts}) if texts else df


def replace_rows(spark: SparkSession, name: str, rows: DataFrame, path: str) -> None:
    """New snapshot of an unpartitioned table; `rows` may read from the table itself."""
    location = snapshot_path(path)
    write_files(rows.select(*columns_of(spark, name)), location)
    move_table(spark, name, location)


def replace_partitions(
    spark: SparkSession, name: str, rows: DataFrame, path: str, partition_by: list[str], touched: set[tuple],
    gather: bool = True,
) -> None:
    """Whole partitions of a table from `rows`, which may read from the table itself.

    They are written to a new folder first. Then the entries of the touched partitions are pointed there, or
    dropped where no row is left, and only then are the old folders deleted. No data is moved, and readers see
    either files or the others of a partition. After an interruption the same upsert brings the table to the
    same rows: what was swapped is merged with itself.
    """
    location = snapshot_path(path)
    ordered = rows.select(*columns_of(spark, name))
    write_files(ordered, location, partition_by, gather=gather)
    new = folders_below(spark, location, [ordered.schema[c] for c in partition_by])
    old = partition_folders(spark, name, partition_by, touched | set(new))
    for values in sorted(touched | set(new), key=repr):
        spec = ", ".join(f"`{c}` = {_literal(v)}" for c, v in zip(partition_by, values, strict=True))
        if values not in new:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
        elif values in old:
            spark.sql(f"ALTER TABLE {name} PARTITION ({spec}) SET LOCATION {quoted(new[values])}")
        else:
            spark.sql(f"ALTER TABLE {name} ADD PARTITION ({spec}) LOCATION {quoted(new[values])}")
    spark.catalog.refreshTable(name)
    for values, place in old.items():
        if values in touched and place != new.get(values):
            delete_path(spark, place)


def folders_below(spark: SparkSession, location: str, partition_by: list[StructField]) -> dict[tuple, str]:
    """Folders of the partitions that were written to `location`, from the listing of its files: no row is read."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.parquet").load(location)
    folders = files.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("_folder")).distinct()
    values = []
    for i, field in enumerate(partition_by):
        named = F.element_at(F.split("_folder", "/"), i - len(partition_by))
        # Folder names are escaped by percent signs only; a plus sign stands for itself.
        text = F.url_decode(F.replace(F.substring_index(named, "=", -1), F.lit("+"), F.lit("%2B")))
        values.append(F.nullif(text, F.lit(NULL_FOLDER)).cast(field.dataType).alias(f"_value{i}"))
    return {tuple(r)[1:]: r["_folder"] for r in folders.select("_folder", *values).collect()}


def partition_folders(
    spark: SparkSession, name: str, partition_by: list[str], wanted: set[tuple]
) -> dict[tuple, str]:
    """Folders of those of the wanted partitions that the table has."""
    found = {}
    for values in wanted:
        spec = ", ".join(f"`{c}` = {_literal(v)}" for c, v in zip(partition_by, values, strict=True))
        try:
            # Collected as it is: a filter on it would be a job for every partition.
            rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION ({spec})").collect()
            found[values] = next(r["data_type"] for r in rows if r["col_name"] == "Location")
        except AnalysisException as error:
            if "PARTITION" not in str(error.getCondition()):
                raise
    return found


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return str(value) if isinstance(value, int) else quoted(str(value))


def _partition_values(df: DataFrame) -> set[tuple]:
    """Distinct partition values, which are table metadata and as few as the table's folders."""
    return {tuple(row) for row in df.distinct().collect()}


def _of_partitions(df: DataFrame, values: set[tuple], partition_by: list[str]) -> DataFrame:
    """Rows of the given partitions. One literal filter per column prunes the scan; with several
    partition columns the combinations are matched exactly as well."""
    for position, column in enumerate(partition_by):
        wanted = {v[position] for v in values}
        some = F.col(column).isin([v for v in wanted if v is not None])
        df = df.filter(some | F.col(column).isNull() if None in wanted else some)
    if len(partition_by) == 1 or not values:
        return df
    listed = df.sparkSession.createDataFrame(sorted(values, key=repr), df.select(*partition_by).schema)
    return df.alias("t").join(listed.alias("p"), _matches("t", "p", partition_by, True), "left_semi")


def _beside_partitions(df: DataFrame, values: set[tuple], partition_by: list[str]) -> DataFrame:
    """Rows of all other partitions. With one partition column the scan leaves the given ones out."""
    if not values:
        return df
    if len(partition_by) == 1:
        column = F.col(partition_by[0])
        known = [v for (v,) in values if v is not None]
        given = F.coalesce(column.isin(known), F.lit(False)) if known else F.lit(False)
        return df.filter(~given & column.isNotNull() if (None,) in values else ~given)
    listed = df.sparkSession.createDataFrame(sorted(values, key=repr), df.select(*partition_by).schema)
    return df.alias("t").join(listed.alias("p"), _matches("t", "p", partition_by, True), "left_anti")


def upsert_table(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    keys: list[str],
    path: str,
    partition_by: list[str] | None = None,
    null_safe: bool = True,
    newer_by: str | None = None,
    partitions: set[tuple] | None = None,
    gather: bool = True,
) -> str:
    """Upsert `source` into the table `name` kept below `path`; returns `created` or `updated`.

    `source` holds one row per key and should be cheap to read again (see `staged`): the
    partitioned path uses it to find the partitions as well as the rows. A partition that loses
    its last row leaves the catalog, and its files go. `partitions` are those of the source, if known.
    `gather=False` saves the shuffle of the first write (see `worth_gathering`); later ones find out for themselves.
    """
    partition_by = partition_by or []
    source = _as_stored(source, partition_by)
    if not table_exists(spark, name):
        create_table(spark, source, name, path, partition_by, gather)
        return "created"

    add_new_columns(spark, name, source.schema)
    target = spark.table(name)
    if not partition_by:
        replace_rows(spark, name, merged(target, source, keys, null_safe, newer_by), path)
        return "updated"

    touched = _partition_values(source.select(*partition_by)) if partitions is None else set(partitions)
    if not set(partition_by) <= set(keys):
        # A key may have moved: the partition that holds its old row is rebuilt as well. Touched ones are anyhow.
        others = _beside_partitions(target, touched, partition_by).select(*keys, *partition_by)
        if not others.isEmpty():
            moved = others.alias("t").join(
                source.select(*keys).alias("s"), _matches("t", "s", keys, null_safe), "left_semi"
            )
            touched |= _partition_values(moved.select(*partition_by))
    old = _of_partitions(target, touched, partition_by)
    rebuilt = merged(old, source, keys, null_safe, newer_by)
    few = len(touched) <= FEW_PARTITIONS and old.count() >= MANY_ROWS
    replace_partitions(spark, name, rebuilt, path, partition_by, touched, gather=not few)
    return "updated"
