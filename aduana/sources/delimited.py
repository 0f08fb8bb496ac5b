"""Delimited text. Every column is read as text; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The dialect of the published files.
SEPARATOR = ";"
QUOTE = '"'
ENCODING = "ISO-8859-1"

def text_schema(names: list[str]) -> str:
    return ", ".join(f"`{n}` string" for n in names)


HEADERED = {"header": "true", "sep": SEPARATOR, "encoding": ENCODING}
HEADERLESS = {
    "header": "false",
    "sep": SEPARATOR,
    "quote": QUOTE,
    "escape": QUOTE,
    "encoding": ENCODING,
}


def headered(spark: SparkSession, paths: str | list[str], names: list[str] | None = None) -> DataFrame:
    """Scan with a header line; files read together must share that header. With `names` the header is
    not looked up first, but a file whose header differs fails the scan."""
    reader = spark.read.options(**HEADERED)
    return (reader.schema(text_schema(names)).option("enforceSchema", "false") if names else reader).csv(paths)


def headerless(spark: SparkSession, paths: str | list[str], names: list[str] | None = None) -> DataFrame:
    """Scan without header. With `names` the columns are positional and no file is opened to
    count them; without, they are called _c0, _c1 and so on."""
    reader = spark.read.options(**HEADERLESS)
    return (reader.schema(text_schema(names)) if names else reader).csv(paths)


def parsed_lines(lines: DataFrame, names: list[str], line: str = "line", keep: list[str] | None = None) -> DataFrame:
    """Columns of headerless delimited lines held in a text column, parsed inside the executors."""
    options = {"sep": SEPARATOR, "quote": QUOTE, "escape": QUOTE}
    row: Column = F.from_csv(line, text_schema(names), options)
    kept = keep if keep is not None else [c for c in lines.columns if c != line]
    return lines.select(*kept, row.alias("_row")).select(*kept, "_row.*")


BAD = "_bad_line"


def flagged_lines(lines: DataFrame, names: list[str], line: str = "line") -> DataFrame:
    """`parsed_lines` with all other columns kept, and `_bad_line`: the line if it does not have as many fields
    as there are names, else null."""
    options = {"sep": SEPARATOR, "quote": QUOTE, "escape": QUOTE, "columnNameOfCorruptRecord": BAD}
    row = F.from_csv(line, f"{text_schema(names)}, {BAD} string", options)
    return lines.select("*", row.alias("_row")).select(*lines.columns, "_row.*")


def field_count(line: Column) -> Column:
    """Fields of a line: separators outside quotes, and one."""
    plain = F.regexp_replace(line, f'{QUOTE}[^{QUOTE}]*{QUOTE}', "")
    return F.length(plain) - F.length(F.replace(plain, F.lit(SEPARATOR), F.lit(""))) + 1
