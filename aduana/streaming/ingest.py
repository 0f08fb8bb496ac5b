"""File streams that load what is new and stop.

The checkpoint remembers which files were read, so a rerun adds nothing and an interrupted run
continues where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from aduana.operators.lineage import LINEAGE, LOAD_DATE, with_lineage
from aduana.operators.sinks import add_new_columns, ensure_database, register, table_exists, write_files
from aduana.sources.delimited import HEADERED, headered
from aduana.sources.inventory import binary_files
from aduana.sources.opening import files_by_header

# File name pattern of each fact table.
FACT_FILES = {
    "exp": "EXP_[0-9][0-9][0-9][0-9].csv",
    "exp_mun": "EXP_[0-9][0-9][0-9][0-9]_MUN.csv",
    "imp": "IMP_[0-9][0-9][0-9][0-9].csv",
    "imp_mun": "IMP_[0-9][0-9][0-9][0-9]_MUN.csv",
}

#: Files of a micro-batch, whose names the driver gets.
FILES_PER_BATCH = 200
LEDGER_SCHEMA = "batch bigint, path string, modified timestamp, size bigint, reason string"
#: Partition column of the raw fact tables: the micro-batch that brought the rows.
BATCH = "_batch"


def file_stream(
    spark: SparkSession,
    folder: str,
    glob: str,
    schema: StructType | str,
    file_format: str = "csv",
    max_files: int | None = None,
) -> DataFrame:
    """Unbounded scan of the files in `folder` that match `glob`, those already there included."""
    reader = spark.readStream.format(file_format).schema(schema).option("pathGlobFilter", glob)
    if file_format == "csv":
        reader = reader.options(**HEADERED)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def append_once(
    stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None
) -> StreamingQuery:
    """Append everything that is new to Parquet files and wait for the end."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    query.awaitTermination()
    return query


def file_versions(spark: SparkSession, folder: str, glob: str, max_files: int = FILES_PER_BATCH) -> DataFrame:
    """Unbounded list (path, modified, size) of the files in `folder` that match `glob`; their content is not read."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return _versions(file_stream(spark, folder, glob, schema, "binaryFile", max_files))


def _versions(files: DataFrame) -> DataFrame:
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def by_header(
    spark: SparkSession, paths: list[str], expected: list[str]
) -> tuple[list[DataFrame], list[tuple[str, str]]]:
    """Scans of headered files with the expected columns first, by name, and the refused files with reasons.

    Columns may stand in any order. Further ones are kept under their names. A file that lacks an expected
    column, or names one twice, is refused. Files with one header are one scan. All headers are read by one job.
    """
    groups, refused = files_by_header(spark, paths) if paths else ({}, [])
    for header, members in list(groups.items()):
        names = [c.strip().upper() for c in header]
        absent = [c for c in expected if c.upper() not in names]
        if absent:
            refused += [(p, f"columns absent or named twice: {absent}") for p in groups.pop(header)]
    scans = []
    for header, members in groups.items():
        found = {c.strip().upper(): c for c in header}
        more = [c for c in header if c.strip().upper() not in {e.upper() for e in expected}]
        scan = with_lineage(headered(spark, members, list(header)))
        columns = [F.col(f"`{found[c.upper()]}`").alias(c) for c in expected]
        scans.append(scan.select(*columns, *[F.col(f"`{c}`").alias(c.strip()) for c in more], *LINEAGE))
    return scans, refused


def ingest_facts(
    spark: SparkSession, folder: str, table: str, schema: StructType, database: str, base_path: str,
    glob: str | None = None, max_files: int = FILES_PER_BATCH,
) -> None:
    """Load the new files of one fact table into the raw table `database.table`, by the names in their headers.

    The stream hands on file names; its checkpoint remembers which were read. The rows of a batch are a
    folder of their own, written again when a batch is repeated after a failure. Refused files are entered, with
    the version and the reason, into the ledger `database.table_refused`. One that is put right under its own name is
    of another version then: it is taken in beside the stream, once, and its entry closed.
    """
    name, path = f"{database}.{table}", f"{base_path}/{table}"
    expected = [f.name for f in schema.fields]
    glob = glob or FACT_FILES[table]

    def land(files: DataFrame, batch_id: int) -> None:
        # As many names as a batch may have files.
        listed = {r["path"]: r for r in files.collect()}
        scans, refused = by_header(spark, sorted(listed), expected)
        ensure_database(spark, database)
        if scans:
            rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
            _put(spark, rows, name, path, batch_id, [LOAD_DATE])
        # Entered last: what is taken in again is closed only when its rows are there.
        entries = [(batch_id, p, listed[p]["modified"], listed[p]["size"], reason) for p, reason in refused]
        if batch_id < 0:
            told = dict(refused)
            entries += [(batch_id, p, r["modified"], r["size"], None) for p, r in listed.items() if p not in told]
        if entries:
            _put(spark, spark.createDataFrame(entries, LEDGER_SCHEMA), f"{name}_refused", f"{path}_refused", batch_id, [])

    apply_batches(file_versions(spark, folder, glob, max_files), f"{base_path}/_checkpoint/{table}", land)
    while table_exists(spark, f"{name}_refused"):
        ledger = spark.table(f"{name}_refused")
        mended = mended_files(ledger, _versions(binary_files(spark, folder, glob)))
        chosen = mended.orderBy("path").limit(max_files).collect()
        if not chosen:
            break
        # Below all batches so far, and the same again after an interruption.
        batch_id = min(0, ledger.agg(F.min("batch")).first()[0]) - 1
        land(spark.createDataFrame(chosen, mended.schema), batch_id)


def latest_entries(ledger: DataFrame) -> DataFrame:
    """(path, modified, size, reason) of the last entry of each file: a file is refused by the stream once, and looked
    at again in batches that count down from -1. The reason is null if it was taken in."""
    entry = F.struct("modified", "size", "reason")
    return ledger.groupBy("path").agg(F.min_by(entry, "batch").alias("e")).select("path", "e.*")


def refused_files(ledger: DataFrame) -> DataFrame:
    """The files that are still refused."""
    return latest_entries(ledger).filter("reason is not null")


def mended_files(ledger: DataFrame, files: DataFrame) -> DataFrame:
    """(path, modified, size) of the files that are refused in another version than the one that is there now."""
    refused = refused_files(ledger).select(
        F.col("path").alias("_path"), F.col("modified").alias("_modified"), F.col("size").alias("_size")
    )
    same = F.col("modified").eqNullSafe(F.col("_modified")) & F.col("size").eqNullSafe(F.col("_size"))
    return files.join(refused, F.col("path") == F.col("_path")).filter(~same).select("path", "modified", "size")


def _put(spark: SparkSession, rows: DataFrame, name: str, path: str, batch_id: int, partition_by: list[str]) -> None:
    """The rows as partition `_batch` of the table, replacing what an interrupted run left there."""
    place = f"{path}/{BATCH}={batch_id}"
    write_files(rows, place, partition_by, mode="overwrite", gather=False)
    if table_exists(spark, name):
        add_new_columns(spark, name, StructType([f for f in rows.schema.fields if f.name not in partition_by]))
        spark.catalog.recoverPartitions(name)
        spark.catalog.refreshTable(name)
    else:
        register(spark, name, StructType([*rows.schema.fields, StructField(BATCH, LongType())]), path, [BATCH, *partition_by])


def apply_batches(
    stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """Hand each micro-batch to `apply`, which must give the same result when a batch is repeated
    after a failure; a keyed upsert does."""
    query = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
