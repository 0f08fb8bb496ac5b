"""Raw tables to typed, keyed tables, incrementally."""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from aduana.operators.dedup import latest_by_key
from aduana.operators.lineage import LOAD_DATE, LOADED_AT
from aduana.operators.mapping import TYPED_AT, apply_spec, missing_columns
from aduana.operators.sinks import create_empty, ensure_database, path_exists, save_table, table_exists, worth_gathering
from aduana.operators.spec import TableSpec
from aduana.operators.upsert import progress_of, replace_rows, staged_counted, upsert_table
from aduana.operators.watermark import CONTROL_SCHEMA, advance_watermark, latest_entries, moment, new_rows

# How late a load may commit rows under an earlier load time.
LATE = dt.timedelta(hours=1)
#: Tables that a run works on side by side.
TABLES_AT_ONCE = 4
#: Partition column of the logs of the last loads.
LOAD_MARK = "_load"
REPORT_SCHEMA = "table_name string, status string, records bigint, missing_columns string, message string"


def _load_one(
    spark: SparkSession,
    spec: TableSpec,
    bronze: str,
    silver: str,
    base_path: str,
    watermark: dt.datetime | None,
    overlap: dt.timedelta,
) -> tuple[tuple, tuple | None]:
    """Report row of a table, and what its control row has to learn: latest load time and records."""
    source = f"{bronze}.{spec.name}"
    if not table_exists(spark, source):
        return (spec.name, "failed", 0, None, f"{source} does not exist"), None
    target = f"{silver}.{spec.name}"
    raw = spark.table(source)
    absent = ", ".join(missing_columns(raw, spec)) or None
    fresh = new_rows(raw, watermark, overlap=overlap, date_col=LOAD_DATE)
    typed = apply_spec(fresh, spec, stamp=False)

    def latest_of(rows: DataFrame) -> DataFrame:
        return latest_by_key(rows, spec.keys, [LOADED_AT]).withColumn(TYPED_AT, F.current_timestamp())

    place = f"{base_path}/{spec.name}"
    log = f"{base_path}/_seen/{spec.name}"
    if not table_exists(spark, target):
        if fresh.isEmpty():
            return (spec.name, "unchanged", 0, absent, None), None
        counted = Observation()
        latest = latest_of(typed).observe(counted, *progress_of(LOADED_AT))
        gather = worth_gathering(typed, spec.partition_by)
        status = upsert_table(spark, target, latest, spec.keys, place, spec.partition_by, gather=gather)
        found, loaded = counted.get, spark.table(target)
    else:
        # What the overlap reads again is in the typed table, with the load time it came with.
        seen = seen_rows(spark, log, spark.table(target), [*spec.keys, LOADED_AT], watermark, overlap)
        latest = latest_of(unseen_rows(spark, typed, seen, spec.keys, spec.name))
        # Written once: the merge starts from these files, and all counts come from this write.
        loaded, found = staged_counted(spark, latest, spec.name, LOADED_AT, spec.partition_by)
        if not found["records"]:
            return (spec.name, "unchanged", 0, absent, None), None
        status = upsert_table(
            spark, target, loaded, spec.keys, place, spec.partition_by, partitions=found["partitions"]
        )
    log_seen(spark, log, loaded, spec.keys, found["latest"], overlap)
    return (spec.name, status, found["records"], absent, None), (found["latest"], found["records"])


def log_seen(
    spark: SparkSession, log: str, loaded: DataFrame, keys: list[str], latest: dt.datetime, overlap: dt.timedelta
) -> None:
    """Keep the keys and load times that a later run may read again: those of the last `overlap` of a load. The folder
    of a load is named by its latest load time, so a run reads the last loads only."""
    kept = loaded.filter(F.col(LOADED_AT) > moment(latest - overlap, loaded.schema[LOADED_AT].dataType))
    columns = kept.select(*keys, LOADED_AT)
    columns.write.mode("overwrite").parquet(f"{log}/{LOAD_MARK}={_mark(latest)}-{uuid.uuid4().hex[:8]}")


def _mark(moment_: dt.datetime) -> str:
    """Sorts as the moments do."""
    return moment_.strftime("%Y%m%d%H%M%S%f")


def seen_rows(
    spark: SparkSession, log: str, target: DataFrame, columns: list[str], watermark: dt.datetime, overlap: dt.timedelta
) -> DataFrame:
    """Rows (keys and load time) of the target that were loaded in the last `overlap` before the watermark: from the
    log of the last loads; from the table itself where it has none. A run with a longer overlap than the ones before
    it may merge rows again that the log no longer has, which changes nothing but their count."""
    if watermark is None or not path_exists(spark, log):
        return new_rows(target, watermark, overlap=overlap).select(*columns)
    schema = StructType([target.schema[c] for c in columns] + [StructField(LOAD_MARK, StringType())])
    logged = spark.read.schema(schema).parquet(log)
    return new_rows(logged.filter(F.col(LOAD_MARK) > _mark(watermark - overlap)), watermark, overlap=overlap).select(*columns)


def unseen_rows(spark: SparkSession, rows: DataFrame, seen: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Rows that came in after every row of their key in `seen` (keys and load time).

    Rows loaded after all of `seen` pass as they are. Of the others, which an overlap reads again, only keys and load
    times are compared; whole rows are looked up for those that are new among them, commonly none.
    """
    last = seen.agg(F.max(LOADED_AT)).first()[0]
    at = F.col(LOADED_AT)
    bound = moment(last, rows.schema[LOADED_AT].dataType) if last is not None else None
    again = rows if bound is None else rows.filter(at.isNull() | (at <= bound))
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in keys]
    older = F.col(f"n.{LOADED_AT}").isNull() | (F.col(f"n.{LOADED_AT}") <= F.col(f"o.{LOADED_AT}"))
    pairs = again.select(*keys, LOADED_AT).alias("n").join(seen.alias("o"), reduce(lambda x, y: x & y, [*same, older]), "left_anti")
    # Written, so that their number is known before whole rows are dealt out for them.
    late, found = staged_counted(spark, pairs, f"late-{label}", LOADED_AT)
    after = rows.limit(0) if bound is None else rows.filter(at > bound)
    if not found["records"]:
        return after
    match = [*same, F.col(f"n.{LOADED_AT}").eqNullSafe(F.col(f"o.{LOADED_AT}"))]
    return after.unionByName(again.alias("n").join(late.alias("o"), reduce(lambda x, y: x & y, match), "left_semi"))


def run_silver(
    spark: SparkSession,
    specs: list[TableSpec],
    bronze: str,
    silver: str,
    base_path: str,
    control: str,
    control_path: str,
    execution_id: str,
    overlap: dt.timedelta = LATE,
    at_once: int = TABLES_AT_ONCE,
) -> DataFrame:
    """Bring every table of `specs` up to date; returns one report row per table.

    A table that is missing or fails is reported and the run goes on. A run reads the last `overlap`
    before the watermark again, for rows that were committed late under an earlier load time; only
    those that the typed table has not seen count as new.

    `at_once` tables are worked on side by side, each in a scheduler pool of its own name; with
    `spark.scheduler.mode` FAIR these share the cluster evenly. All control rows are written at the end, once: a run
    that dies before merges the same rows again. One run at a time: control rows of two would overwrite each other.
    """
    ensure_database(spark, silver)
    ensure_database(spark, control.split(".")[0])
    create_empty(spark, control, control_path, CONTROL_SCHEMA)
    watermarks = {
        r["table_name"]: r["last_ingestion_timestamp"]
        for r in latest_entries(spark.table(control), "last_ingestion_timestamp", "last_ingestion_timestamp").collect()
    }

    def load(spec: TableSpec) -> tuple[tuple, tuple | None]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", spec.name)
        try:
            return _load_one(spark, spec, bronze, silver, base_path, watermarks.get(spec.name), overlap)
        except Exception as error:  # noqa: BLE001 - recorded per table
            return (spec.name, "failed", 0, None, str(error)), None

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        # Each thread gets properties of its own: those of the caller, and the pool of its table.
        waiting = [pool.submit(inheritable_thread_target(spark)(load), spec) for spec in specs]
        results = [w.result() for w in waiting]
    updates = [
        (report[0], max(filter(None, (found[0], watermarks.get(report[0])))), found[1], execution_id)
        for report, found in results if found
    ]
    if updates:
        update = spark.createDataFrame(
            updates, "table_name string, last_ingestion_timestamp timestamp, records_processed bigint, execution_id string"
        ).withColumn("last_update", F.current_timestamp())
        replace_rows(spark, control, advance_watermark(spark.table(control), update), control_path)
    return spark.createDataFrame([report for report, _ in results], REPORT_SCHEMA)


def run_totals(report: DataFrame) -> DataFrame:
    """Tables and records per outcome of a run."""
    return report.groupBy("status").agg(
        F.count(F.lit(1)).alias("tables"),
        F.sum("records").alias("records"),
        F.array_join(F.array_sort(F.collect_list("table_name")), ", ").alias("names"),
    )


def load_bridge_table(
    spark: SparkSession, bronze: str, silver: str, base_path: str, table: str = "corr_ncm_cnae"
) -> None:
    """The typed bridge: the raw one without the repetitions a reload adds. Needs the raw bridge."""
    ensure_database(spark, silver)
    pairs = latest_by_key(spark.table(f"{bronze}.{table}"), ["NCM", "CNAE"], [LOADED_AT])
    save_table(spark, pairs, f"{silver}.{table}", f"{base_path}/{table}")
