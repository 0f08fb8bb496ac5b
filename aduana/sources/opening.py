"""Files that a task opens itself, to read a part of them: a directory, a member, a first line."""

from __future__ import annotations

import csv
import sys
import urllib.parse
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from aduana.sources.delimited import ENCODING, QUOTE, SEPARATOR

# The functions below travel with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes that are read at once while the end of a first line is looked for.
HEAD_BYTES = 1 << 16


def located(path: str):
    """File system of a path of a listing, and the path in it; a name is taken as it stands."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    if scheme == "s3a":
        path = "s3:" + rest
    return fs.FileSystem.from_uri(urllib.parse.quote(path, safe=":/@"))


def opened(path: str):
    """Seekable stream of a file."""
    filesystem, inner = located(path)
    return filesystem.open_input_file(inner)


def tasks_can_open(paths: list[str]) -> bool:
    """Whether Arrow knows the file systems of all paths; if not, only Spark's own readers reach them."""
    for place in {p.split("/")[0] + "//" + urllib.parse.urlsplit(p).netloc for p in paths}:
        try:
            located(f"{place}/x")
        except Exception:  # noqa: BLE001 - whatever keeps Arrow from it
            return False
    return True


def _head(path: str, encoding: str) -> str:
    """The first line that is not blank, without its end; empty if there is none."""
    rest: list[bytes] = []
    with opened(path) as stream:
        while chunk := stream.read(HEAD_BYTES):
            lines = chunk.replace(b"\r", b"\n").split(b"\n")
            lines[0] = b"".join([*rest, lines[0]])
            for line in lines[:-1]:
                if line.strip():
                    return line.decode(encoding)
            rest = [*rest, chunk] if len(lines) == 1 else [lines[-1]]
    line = b"".join(rest)
    return line.decode(encoding) if line.strip() else ""


def first_lines(spark: SparkSession, paths: list[str], encoding: str = ENCODING) -> DataFrame:
    """(path, line, error) of each file: its first line that is not blank, or why it could not be read. One job reads
    the beginnings of all files."""
    if not tasks_can_open(paths):
        # One scan of the text; of the blocks that a file is read in, only the first one counts.
        # A scan has names in the form of a URI, a listing as they are.
        plain = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        lines = spark.read.text(paths).select(
            F.decode(F.col("value").cast("binary"), encoding).alias("value"), plain.alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
        ).filter((F.col("block") == 0) & F.col("value").rlike(r"\S"))
        heads = lines.groupBy("path").agg(F.min_by("value", "at").alias("line"))
        listed = spark.createDataFrame([(p,) for p in paths], "path string")
        return listed.join(heads, "path", "left").select(
            "path", F.coalesce("line", F.lit("")).alias("line"), F.lit(None).cast("string").alias("error")
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                try:
                    found.append((path, _head(path, encoding), None))
                except Exception as error:  # noqa: BLE001 - told per file
                    found.append((path, None, f"{type(error).__name__}: {error}"))
            columns = zip(*found, strict=True) if found else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["path", "line", "error"])

    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    spread = listed.repartition(max(1, min(len(paths), spark.sparkContext.defaultParallelism)))
    return spread.mapInArrow(read, "path string, line string, error string")


def header_names(line: str) -> list[str]:
    """The names a header line gives, as Spark has them: an empty one is `_c` and its place, one that comes twice gets
    its place at the end."""
    names = next(csv.reader([line], delimiter=SEPARATOR, quotechar=QUOTE), [])
    lowered = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if lowered.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def files_by_header(
    spark: SparkSession, paths: list[str]
) -> tuple[dict[tuple[str, ...], list[str]], list[tuple[str, str]]]:
    """Files of each header, grouped on Spark, and those that could not be read with the reason. The number of jobs
    doesn't depend on the number of files."""
    grouped = first_lines(spark, paths).groupBy("line", "error").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    groups: dict[tuple[str, ...], list[str]] = {}
    failed = []
    for row in grouped.collect():  # one row for each header, with the names of files the driver listed
        if row["error"] is not None:
            failed += [(p, row["error"]) for p in row["paths"]]
        else:
            groups.setdefault(tuple(header_names(row["line"])), []).extend(row["paths"])
    return {h: sorted(groups[h]) for h in sorted(groups)}, sorted(failed)
