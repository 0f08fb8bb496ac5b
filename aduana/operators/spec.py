"""Declarative table specs: which raw column becomes which typed column, and what the key is."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class ColumnRule:
    source: str
    target: str
    type_name: str = "string"
    trim: bool = False


@dataclass(frozen=True)
class TableSpec:
    name: str
    keys: list[str]
    columns: list[ColumnRule]
    partition_by: list[str] = field(default_factory=list)
    description: str = ""

    def raw_schema(self) -> T.StructType:
        """Schema of the raw file: every column is text."""
        return T.StructType([T.StructField(c.source, T.StringType()) for c in self.columns])


def same_name(*sources: str, type_name: str = "string", trim: bool = False) -> list[ColumnRule]:
    """Columns that keep their name, in lower case."""
    return [ColumnRule(s, s.lower(), type_name, trim) for s in sources]


def renamed(names: dict[str, str], type_name: str = "string", trim: bool = False) -> list[ColumnRule]:
    return [ColumnRule(s, t, type_name, trim) for s, t in names.items()]
