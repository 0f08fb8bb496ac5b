"""The one lineage contract of raw and typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LOAD_DATE = "_ingestion_date"
LOADED_AT = "_ingestion_timestamp"
SOURCE = "_source_path"
LINEAGE = [LOAD_DATE, LOADED_AT, SOURCE]


def with_lineage(df: DataFrame, source: Column | None = None) -> DataFrame:
    """Add load date, load time and source file.

    On a file scan the source is the scan's own `_metadata.file_path`; it has to be asked for
    before any operator that hides the metadata column.
    """
    origin = source if source is not None else F.col("_metadata.file_path")
    return df.select(
        "*",
        F.current_date().alias(LOAD_DATE),
        F.current_timestamp().alias(LOADED_AT),
        origin.alias(SOURCE),
    )
