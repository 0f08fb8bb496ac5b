"""File inventory and change detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aduana.functions.codes import file_stem, table_name, table_of_file

CONTROL_SCHEMA = (
    "originator string, table_name string, input_file_name string, "
    "last_ingestion_timestamp timestamp, "
    "modified timestamp COMMENT 'time of the version that was loaded', "
    "size bigint COMMENT 'size of the version that was loaded'"
)


def file_inventory(spark: SparkSession, path: str, source: str, glob: str | None = None) -> DataFrame:
    """One row per file below `path`. Only the listing is read: `content` is pruned."""
    return binary_files(spark, path, glob).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("table_name"),
        F.col("length").alias("size"),
        "modificationTime",
        F.lit(source).alias("container_name"),
    )


def binary_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Whole files as rows: path, modificationTime, length, content."""
    reader = spark.read.format("binaryFile")
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path)


def with_target(inventory: DataFrame, numbered: bool) -> DataFrame:
    """Name of the raw table a file belongs to; `numbered` files (`socios3.zip`) share one."""
    name = table_of_file("table_name") if numbered else table_name(file_stem("table_name"))
    return inventory.withColumn("target_table", name)


def excluding_prefixes(inventory: DataFrame, *prefixes: str) -> DataFrame:
    """Leave out files another path loads, such as the fact files of the stream."""
    matches = F.lit(False)
    for prefix in prefixes:
        matches = matches | F.col("table_name").startswith(prefix)
    return inventory.filter(~matches)


def new_or_changed(modified: str | Column, last: str | Column) -> Column:
    modified = F.col(modified) if isinstance(modified, str) else modified
    last = F.col(last) if isinstance(last, str) else last
    return last.isNull() | (modified > last)


def changed_files(inventory: DataFrame, control: DataFrame, originator: str) -> DataFrame:
    """Files never loaded, or modified after their last load.

    By time alone a file that is replaced while its table loads, or by an older one, is not noticed: see
    `unseen_versions`.
    """
    loads = control.filter(F.col("originator") == originator).groupBy("table_name").agg(
        F.max("last_ingestion_timestamp").alias("last_ingestion_timestamp")
    )
    return (
        inventory.filter(F.col("container_name") == originator)
        .join(loads, "table_name", "left")
        .filter(new_or_changed("modificationTime", "last_ingestion_timestamp"))
        .drop("last_ingestion_timestamp")
    )


def unseen_versions(inventory: DataFrame, control: DataFrame, originator: str) -> DataFrame:
    """Files of which this version has not been loaded. A version is what the listing says: time and size.

    The control keeps the version that was listed before the load, so a file that is replaced during the load is
    unseen again. Control rows from before versions were kept go by `new_or_changed`.
    """
    newest = F.max_by(
        F.struct("last_ingestion_timestamp", "modified", "size"), F.struct("last_ingestion_timestamp", "modified", "size")
    )
    kept = control.filter(F.col("originator") == originator).groupBy("table_name").agg(newest.alias("_kept"))
    same = F.when(
        F.col("_kept.modified").isNull(), ~new_or_changed("modificationTime", F.col("_kept.last_ingestion_timestamp"))
    ).otherwise(
        (F.col("_kept.modified") == F.col("modificationTime")) & F.col("_kept.size").eqNullSafe(F.col("size"))
    )
    return (
        inventory.filter(F.col("container_name") == originator)
        .join(kept, "table_name", "left")
        .filter(F.col("_kept").isNull() | ~same)
        .drop("_kept")
    )


def control_rows(files: DataFrame) -> DataFrame:
    """Control rows of files that have been loaded completely, in the version that was listed."""
    return files.select(
        F.col("container_name").alias("originator"),
        "table_name",
        F.col("path").alias("input_file_name"),
        F.current_timestamp().alias("last_ingestion_timestamp"),
        F.col("modificationTime").alias("modified"),
        "size",
    )
