"""Writing and registering tables.

Files are always written to a folder of their own first and the catalog entry is pointed at them
afterwards, so a failed write never takes an existing table with it.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType


#: Rows and partitions of a write that is not gathered: at least so many rows, in at most so many partitions.
MANY_ROWS, FEW_PARTITIONS = 4_000_000, 8


def quoted(text: str) -> str:
    """A text as a literal of SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def columns_of(spark: SparkSession, name: str) -> list[str]:
    return spark.table(name).columns


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def snapshot_path(path: str) -> str:
    return f"{path.rstrip('/')}/snapshot-{uuid.uuid4().hex}"


def spread(df: DataFrame, partition_by: list[str] | None) -> DataFrame:
    """Gather rows of a table partition into few files and split partitions that are too large.

    The rebalance hint lets adaptive execution cut a hot partition by size, so one state or
    month with a third of the rows does not become one task.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def worth_gathering(df: DataFrame, partition_by: list[str] | None) -> bool:
    """Whether a write of `df` needs the shuffle that gathers partitions. Where many rows go to few partitions, each
    task fills files of a good size by itself. Reads the partition columns; `df` must be cheap to read again."""
    if not partition_by:
        return True
    return df.count() < MANY_ROWS or df.select(*partition_by).distinct().limit(FEW_PARTITIONS + 1).count() > FEW_PARTITIONS


def write_files(
    df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "error", gather: bool = True
) -> None:
    """`gather=False` saves the shuffle where every task writes to one partition anyway."""
    writer = (spread(df, partition_by) if gather else df).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_files(
    df: DataFrame, path: str, partition_by: list[str] | None = None, gather: bool = True
) -> None:
    write_files(df, path, partition_by, mode="append", gather=gather)


def read_widened(spark: SparkSession, path: str) -> DataFrame:
    """Read files whose later loads brought further columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def _column_ddl(schema: StructType) -> str:
    def one(field) -> str:
        comment = field.metadata.get("comment")
        note = f" COMMENT '{comment}'" if comment else ""
        return f"`{field.name}` {field.dataType.simpleString()}{note}"

    return ", ".join(one(f) for f in schema.fields)


def register(
    spark: SparkSession, name: str, schema: StructType, location: str, partition_by: list[str] | None = None
) -> None:
    """Catalog entry for Parquet files that are already there."""
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {name} ({_column_ddl(schema)}) USING parquet{parts} LOCATION '{location}'")
    if partition_by:
        spark.catalog.recoverPartitions(name)


def create_table(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    path: str,
    partition_by: list[str] | None = None,
    gather: bool = True,
) -> None:
    location = snapshot_path(path)
    write_files(df, location, partition_by, gather=gather)
    register(spark, name, df.schema, location, partition_by)


def _sorts(order: list[str]) -> list[Column]:
    return [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in order]


def in_order(df: DataFrame, order: list[str], ranges: int | None = None) -> DataFrame:
    """Rows dealt out in ranges of `order` and sorted inside, so that the files written from them follow each other
    and a filter on its first columns reads few of them. A minus sign before a column stands for descending. No task
    sees all rows; `ranges` is up to Spark by default.
    Rows equal in `order` stay together: add a key where very many are.
    """
    columns = _sorts(order)
    dealt = df.repartitionByRange(ranges, *columns) if ranges else df.repartitionByRange(*columns)
    return dealt.sortWithinPartitions(*columns)


def overlapping_files(df: DataFrame, order: list[str]) -> DataFrame:
    """(file, first, last) of the files of a scan whose rows don't all come after those of the files before them.

    Ranks stand for the values, so that any order, descending and with nulls, is compared like whole numbers.
    """
    place = Window.orderBy(*_sorts(order))  # of the ends of files, not of rows
    ends = df.select("*", F.col("_metadata.file_path").alias("_file"))
    ends = ends.withColumn("_at", F.monotonically_increasing_id())
    first = ends.groupBy("_file").agg(F.min("_at").alias("_a"), F.max("_at").alias("_b"))
    kept = ends.join(first, "_file").filter("_at = _a or _at = _b").withColumn("_rank", F.dense_rank().over(place))
    spans = kept.groupBy("_file").agg(F.min("_rank").alias("first"), F.max("_rank").alias("last"))
    before = Window.orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    return spans.withColumn("_before", F.max("last").over(before)).filter("first < _before").select(
        F.col("_file").alias("file"), "first", "last"
    )


def save_table(
    spark: SparkSession, df: DataFrame, name: str, path: str, partition_by: list[str] | None = None,
    order: list[str] | None = None,
) -> None:
    """Replace a whole table, schema included, with files in `order` if it is given. Earlier snapshots stay until `remove_old_snapshots`, as
    others may still read them. The name is missing for the moment between the two catalog calls; a
    reader that needs it all the time goes by `replace_rows`, which keeps the schema.
    """
    location = snapshot_path(path)
    write_files(in_order(df, order) if order else df, location, partition_by)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    register(spark, name, df.schema, location, partition_by)


def remove_old_snapshots(spark: SparkSession, name: str, path: str) -> list[str]:
    """Delete the snapshot folders below `path` that neither the table nor one of its partitions uses;
    returns them. Call it when no reader of an earlier state is left."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    used = {table_location(spark, name)}
    if any(r["col_name"] == "# Partition Information" for r in spark.sql(f"DESCRIBE TABLE {name}").collect()):
        for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
            pairs = [p.split("=", 1) for p in row["partition"].split("/")]
            none = "__HIVE_DEFAULT_PARTITION__"
            values = [f"`{k}` = " + ("NULL" if v == none else quoted(unquote(v))) for k, v in pairs]
            place = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION ({', '.join(values)})").collect()
            used.add(next(r["data_type"] for r in place if r["col_name"] == "Location"))
    gone = []
    for status in files.listStatus(root):
        folder = status.getPath()
        mark = f"/{folder.getName()}"
        if folder.getName().startswith("snapshot-") and not any(mark + "/" in u + "/" for u in used):
            files.delete(folder, True)
            gone.append(folder.getName())
    return gone


def move_table(spark: SparkSession, name: str, location: str) -> None:
    """Point an unpartitioned table at other files of the same schema."""
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    spark.catalog.refreshTable(name)


def add_new_columns(spark: SparkSession, name: str, schema: StructType) -> None:
    known = {c.lower() for c in columns_of(spark, name)}
    added = StructType([f for f in schema.fields if f.name.lower() not in known])
    if added.fields:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_column_ddl(added)})")


def create_or_append(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    path: str,
    partition_by: list[str] | None = None,
    gather: bool = True,
) -> str:
    """First write creates the table with its partitioning; later writes append, and columns the
    table does not have yet are added to it."""
    if not table_exists(spark, name):
        create_table(spark, df, name, path, partition_by, gather)
        return "created"
    add_new_columns(spark, name, df.schema)
    empty = spark.table(name).limit(0)
    rows = empty.unionByName(df, allowMissingColumns=True).select(*empty.columns)
    (spread(rows, partition_by) if gather else rows).write.insertInto(name)
    return "appended"


def create_empty(
    spark: SparkSession, name: str, path: str, schema: str, partition_by: list[str] | None = None
) -> None:
    """Empty table with a typed schema (a DDL string, comments allowed); kept when it exists."""
    if not table_exists(spark, name):
        create_table(spark, spark.createDataFrame([], schema), name, path, partition_by)


def copy_table(spark: SparkSession, source: str, name: str, path: str) -> None:
    save_table(spark, spark.table(source), name, path)
