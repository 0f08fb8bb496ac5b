"""Keyed upsert from a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from aduana.operators.dedup import latest_by_key
from aduana.operators.upsert import staged, upsert_table
from aduana.streaming.ingest import apply_batches


def upsert_stream(
    stream: DataFrame,
    name: str,
    keys: list[str],
    order: list[str],
    path: str,
    checkpoint: str,
    partition_by: list[str] | None = None,
) -> None:
    """Upsert every micro-batch of `stream` into table `name`.

    A batch is reduced to the latest row per key first, and a row of an earlier file does not
    replace a newer one, so neither the order of the files nor a repeated batch matters.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        latest = staged(spark, latest_by_key(batch, keys, order), f"batch-{batch_id}")
        upsert_table(spark, name, latest, keys, path, partition_by, newer_by=order[0])

    apply_batches(stream, checkpoint, apply)
