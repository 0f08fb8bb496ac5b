"""Incremental reading by load time, with a small keyed control table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, TimestampNTZType

from aduana.operators.lineage import LOADED_AT
from aduana.operators.upsert import accumulated

CONTROL_SCHEMA = (
    "table_name string COMMENT 'typed table', "
    "last_ingestion_timestamp timestamp COMMENT 'latest load time read', "
    "last_update timestamp COMMENT 'when this row was written', "
    "records_processed bigint COMMENT 'rows processed over all runs', "
    "execution_id string COMMENT 'run that wrote this row'"
)


def latest_entries(control: DataFrame, value: str, *tiebreak: str) -> DataFrame:
    """(table_name, value, last_update) of the row of each table that was written last."""
    newest = F.max_by(value, F.struct("last_update", *tiebreak)).alias(value)
    return control.groupBy("table_name").agg(newest, F.max("last_update").alias("last_update"))


def last_watermark(control: DataFrame, table: str) -> dt.datetime | None:
    """Latest processed load time of one table, None before the first run (not a DataFrame)."""
    own = control.filter(F.col("table_name") == table)
    row = latest_entries(own, "last_ingestion_timestamp", "last_ingestion_timestamp").first()
    return row["last_ingestion_timestamp"] if row else None


def moment(value: dt.datetime, as_type: DataType) -> Column:
    """Literal of the type it is compared with: a wall-clock time stays one."""
    if isinstance(as_type, TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


def new_rows(
    df: DataFrame,
    last: dt.datetime | None,
    ts_col: str = LOADED_AT,
    overlap: dt.timedelta = dt.timedelta(0),
    date_col: str | None = None,
) -> DataFrame:
    """Rows loaded after `last`; everything when there is no `last`.

    `overlap` reads that much again, for rows that were committed late under an earlier load
    time; the keyed upsert makes the repetition harmless. Where the table is partitioned by load
    date, naming `date_col` prunes whole partitions.
    """
    if last is None:
        return df
    since = last - overlap
    rows = df.filter(F.col(ts_col) > moment(since, df.schema[ts_col].dataType))
    if date_col is not None and date_col in df.columns:
        # A day earlier than the timestamp says, as the session time zone may shift the date.
        rows = rows.filter(F.col(date_col) >= F.lit((since - dt.timedelta(days=1)).date()))
    return rows


def batch_progress(
    batch: DataFrame, by: list[str], ts_col: str = LOADED_AT
) -> DataFrame:
    """Row count and latest load time of a batch in one pass, per group of `by`."""
    return batch.groupBy(*by).agg(
        F.max(ts_col).alias("last_ingestion_timestamp"),
        F.count(F.lit(1)).alias("records_processed"),
    )


def advance_watermark(control: DataFrame, updates: DataFrame) -> DataFrame:
    """Control table after a run: counts add up, everything else comes from the latest update."""
    return accumulated(control, updates, ["table_name"], ["records_processed"], "last_update")
