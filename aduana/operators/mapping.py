"""Raw text tables to typed tables, from a TableSpec, in a single projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aduana.functions.typing import parsed
from aduana.operators.lineage import LINEAGE
from aduana.operators.spec import TableSpec

TYPED_AT = "_silver_insert_ts"


def missing_columns(df: DataFrame, spec: TableSpec) -> list[str]:
    """Source columns the spec asks for and `df` lacks (not a DataFrame)."""
    present = {c.lower() for c in df.columns}
    return [rule.source for rule in spec.columns if rule.source.lower() not in present]


def apply_spec(df: DataFrame, spec: TableSpec, stamp: bool = True) -> DataFrame:
    """Trim, convert and rename as the spec says; absent columns are skipped.

    Lineage columns pass through under their own names, and the typing time is added.
    """
    absent = set(missing_columns(df, spec))
    chosen = []
    for rule in spec.columns:
        if rule.source in absent:
            continue
        value = F.col(rule.source)
        if rule.trim:
            value = F.trim(value)
        chosen.append(parsed(value, rule.type_name).alias(rule.target))
    chosen += [F.col(c) for c in LINEAGE if c in df.columns]
    if stamp:
        chosen.append(F.current_timestamp().alias(TYPED_AT))
    return df.select(*chosen)


def all_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def name_columns(df: DataFrame, names: list[str] | None) -> DataFrame:
    """Positional names for a headerless table; left unchanged when the counts disagree."""
    if not names or len(names) != len(df.columns):
        return df
    return df.toDF(*names)

