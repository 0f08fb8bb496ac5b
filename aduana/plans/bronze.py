"""Landing files to raw text tables with lineage, loading only files that are new or changed."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from aduana.operators.lineage import LINEAGE, LOAD_DATE, with_lineage
from aduana.operators.mapping import all_text
from aduana.operators.sinks import add_new_columns, create_empty, create_or_append, ensure_database
from aduana.operators.upsert import staged, upsert_table
from aduana.plans.register_tables import POSITIONS
from aduana.sources.archives import archive_blocks, is_archive, lines_of
from aduana.sources.bridge import bridge_pairs, bridge_rows
from aduana.sources.delimited import BAD, field_count, flagged_lines, headered, parsed_lines
from aduana.sources.inventory import (
    CONTROL_SCHEMA,
    binary_files,
    control_rows,
    excluding_prefixes,
    file_inventory,
    unseen_versions,
    with_target,
)
from aduana.sources.opening import files_by_header

TRADE, REGISTER = "BALANCE", "CNPJ"
CONTROL_KEYS = ["originator", "table_name"]
FACT_PREFIXES = ("EXP_", "IMP_")
REPORT_SCHEMA = "target_table string, status string, files int, message string"


def ensure_control(spark: SparkSession, name: str, path: str) -> None:
    """The control table; one from before versions were kept gets their columns."""
    ensure_database(spark, name.split(".")[0])
    create_empty(spark, name, path, CONTROL_SCHEMA)
    add_new_columns(spark, name, StructType.fromDDL(CONTROL_SCHEMA))


def _append(spark: SparkSession, rows: DataFrame, database: str, base_path: str, table: str) -> str:
    """Append a load. It has one load date, so there is nothing to gather before writing."""
    return create_or_append(
        spark, rows, f"{database}.{table}", f"{base_path}/{table}", [LOAD_DATE], gather=False
    )


Failures = list[tuple[Row, str]]


def _per_table(
    spark: SparkSession,
    changed: DataFrame,
    control: str,
    control_path: str,
    load: Callable[[str, list[Row]], tuple[list[Row], Failures, str | None]],
) -> DataFrame:
    """Load the changed files table by table; neither a table nor a file that fails stops the others.

    `load` returns the files that are in, those that are not with their error, and a remark. The list of
    files is metadata the driver needs to name the scans. Control rows are written only for files that are
    in, in the version that was listed before the load, so that the others and those replaced meanwhile are loaded
    the next time. The report has a row for what was loaded of a table, and one for
    each file that was not.
    """
    by_table = defaultdict(list)
    for file in changed.collect():
        by_table[file["target_table"]].append(file)
    report = []
    for table, files in sorted(by_table.items()):
        try:
            done, failures, remark = load(table, files)
            if done:
                rows = spark.createDataFrame(done, changed.schema)
                upsert_table(spark, control, control_rows(rows), CONTROL_KEYS, control_path)
                report.append((table, "loaded", len(done), remark))
            report += [(table, "failed", 1, f"{file['path']}: {error}") for file, error in failures]
        except Exception as error:  # noqa: BLE001 - recorded per table
            report.append((table, "failed", len(files), str(error)))
    return spark.createDataFrame(report, REPORT_SCHEMA)


def load_dimensions(
    spark: SparkSession, landing: str, database: str, base_path: str, control: str, control_path: str
) -> DataFrame:
    """Headered CSV dimensions; the fact files are left to the stream. Returns a report."""
    ensure_database(spark, database)
    ensure_control(spark, control, control_path)
    inventory = excluding_prefixes(file_inventory(spark, landing, TRADE), *FACT_PREFIXES)
    changed = with_target(
        unseen_versions(inventory, spark.table(control), TRADE), numbered=False
    ).filter(F.lower("table_name").endswith(".csv"))

    def append(table: str, files: list[Row]) -> None:
        # Files with one header are one scan.
        by_header, failed = files_by_header(spark, [f["path"] for f in files])
        if failed:
            raise ValueError(f"{failed[0][0]}: {failed[0][1]}")
        rows = None
        for header, paths in by_header.items():
            scan = with_lineage(headered(spark, paths, list(header)))
            rows = scan if rows is None else rows.unionByName(scan, allowMissingColumns=True)
        _append(spark, rows, database, base_path, table)

    def load(table: str, files: list[Row]) -> tuple[list[Row], Failures, str | None]:
        try:
            append(table, files)
            return files, [], None
        except Exception:  # noqa: BLE001 - found out file by file
            done, failures = [], []
            for file in files:
                try:
                    append(table, [file])
                    done.append(file)
                except Exception as error:  # noqa: BLE001 - recorded per file
                    failures.append((file, str(error)))
            return done, failures, None

    return _per_table(spark, changed, control, control_path, load)


def all_text_scan(spark: SparkSession, path: str) -> DataFrame:
    """Headered scan as text. A CSV scan without a schema reads text only."""
    scan = headered(spark, path)
    return scan if all(t == "string" for _, t in scan.dtypes) else all_text(scan)


def register_rows(lines: DataFrame, names: list[str] | None) -> tuple[DataFrame, str | None]:
    """(path, member, line) to columns, and a remark on members of another width.

    A member gets the positional names if every line of it has as many fields as there are names; another
    one keeps all its fields as _c0, _c1, ... The widths are found in the executors; a member is a file of
    its own, so their list is metadata.
    """
    listed, some_fit = None, False
    if names:
        fits = flagged_lines(lines, names).groupBy("path", "member").agg(F.every(F.col(BAD).isNull()).alias("fits"))
        members = [tuple(r) for r in fits.collect()]
        odd = [m[:2] for m in members if not m[2]]
        if not odd:
            return parsed_lines(lines, names, keep=["path", "member"]), None
        some_fit = len(odd) < len(members)
        listed = lines.sparkSession.createDataFrame(sorted(odd), "path string, member string")
    others = lines.join(listed, ["path", "member"], "left_semi") if some_fit else lines
    widths = others.groupBy("path", "member").agg(F.max(field_count(F.col("line"))).alias("n")).collect()
    # Parsed as wide as the widest of them; what a member doesn't have stays null.
    rows = parsed_lines(others, [f"_c{i}" for i in range(max((r["n"] for r in widths), default=1))], keep=["path", "member"])
    if some_fit:
        fitting = lines.join(listed, ["path", "member"], "left_anti")
        rows = parsed_lines(fitting, names, keep=["path", "member"]).unionByName(rows, allowMissingColumns=True)
    told = [f"{r['path']}/{r['member']} has {r['n']} columns" for r in sorted(widths)] if names else []
    return rows, "; ".join(told) or None


def load_register(
    spark: SparkSession, landing: str, database: str, base_path: str, control: str, control_path: str
) -> DataFrame:
    """Zipped headerless CSVs; numbered archives of one table load together. Returns a report."""
    ensure_database(spark, database)
    ensure_control(spark, control, control_path)
    changed = with_target(
        unseen_versions(file_inventory(spark, landing, REGISTER), spark.table(control), REGISTER), numbered=True
    ).filter(is_archive())

    def load(table: str, files: list[Row]) -> tuple[list[Row], Failures, str | None]:
        # Unpacked once; the errors, the widths and the rows all start from these blocks.
        blocks = staged(spark, archive_blocks(binary_files(spark, [f["path"] for f in files])), table)
        errors = {r["path"]: r["error"] for r in blocks.filter("error is not null").collect()}
        done = [f for f in files if f["path"] not in errors]
        if done:
            good = blocks.filter(F.col("path").isin(*[f["path"] for f in done])) if errors else blocks
            parsed, remark = register_rows(lines_of(good), POSITIONS.get(table))
            source = F.concat_ws("/", F.col("path"), F.element_at(F.split("member", "/"), -1))
            data = [c for c in parsed.columns if c not in ("path", "member")]
            loaded = with_lineage(parsed, source).select(*data, *LINEAGE)
            _append(spark, loaded, database, base_path, table)
        else:
            remark = None
        return done, [(f, errors[f["path"]]) for f in files if f["path"] in errors], remark

    return _per_table(spark, changed, control, control_path, load)


def load_bridge(
    spark: SparkSession, rows: DataFrame, database: str, base_path: str, table: str = "corr_ncm_cnae"
) -> str:
    """The bridge rows to pairs. Rows may name their file in a column `origem`."""
    ensure_database(spark, database)
    names = [c for c in rows.columns if c != "origem"]
    origin = F.col("origem") if "origem" in rows.columns else F.lit(None).cast("string")
    sourced = rows.select(*[F.col(f"`{c}`") for c in names], origin.alias("_c_origem"))
    pairs = bridge_pairs(bridge_rows(sourced, keep=["_c_origem"]))
    return _append(spark, with_lineage(pairs, F.col("_c_origem")).drop("_c_origem"), database, base_path, table)
