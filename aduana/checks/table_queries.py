"""Reading, typing and writing operators as queries over the Parquet test tables.

Queries that need files or tables write them below the shared folder under names of their own.
"""

from __future__ import annotations

import datetime as dt
import uuid
import urllib.parse
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from aduana.checks import binding as b
from aduana.functions import codes, measures
from aduana.functions.typing import parsed
from aduana.operators import sinks
from aduana.operators.lineage import LOADED_AT, SOURCE, with_lineage
from aduana.operators.mapping import all_text, apply_spec, name_columns
from aduana.operators.spec import TableSpec, renamed, same_name
from aduana.operators.watermark import moment
from aduana.plans import bronze
from aduana.plans.audit import frequent_keys
from aduana.plans.silver import run_silver
from aduana.session import fresh_path
from aduana.sources.archives import archive_lines
from aduana.sources.bridge import bridge_file, bridge_pairs
from aduana.sources.delimited import HEADERED, HEADERLESS, headered, headerless, parsed_lines
from aduana.sources.inventory import binary_files, changed_files, excluding_prefixes, unseen_versions, with_target
from aduana.streaming.ingest import ingest_facts, refused_files

LOAD_CUT = dt.datetime(2024, 1, 28)


def _name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"


ORDER_SPEC = TableSpec("pedidos", ["o_orderkey"], [
    *renamed({"O_ORDERKEY": "pedido", "O_CUSTKEY": "cliente"}, "bigint"),
    *renamed({"O_ORDERSTATUS": "situacao", "O_ORDERPRIORITY": "prioridade"}, trim=True),
    *renamed({"O_TOTALPRICE": "valor"}, "double"),
    *renamed({"O_ORDERDATE": "data"}, "date"),
    *same_name("O_COMMENT"),
])


def _raw_orders(s: SparkSession, d: str) -> DataFrame:
    """Orders as a file would carry them: padded text, decimal commas, unusable values."""
    key = F.col("o_orderkey")
    price = F.replace(F.format_string("%.2f", "o_totalprice"), F.lit("."), F.lit(","))
    return b.read(s, d, "orders").select(
        key.cast("string").alias("O_ORDERKEY"),
        F.when(key % 11 == 0, "x").otherwise(F.col("o_custkey").cast("string")).alias("O_CUSTKEY"),
        F.concat(F.lit(" "), "o_orderstatus", F.lit("  ")).alias("O_ORDERSTATUS"),
        F.concat("o_orderpriority", F.lit(" ")).alias("O_ORDERPRIORITY"),
        F.when(key % 13 == 0, "").otherwise(price).alias("O_TOTALPRICE"),
        F.when(key % 7 == 0, "00000000").otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("O_ORDERDATE"),
    )


def typed_mapping(s: SparkSession, d: str) -> DataFrame:
    """The column O_COMMENT of the spec is absent and skipped."""
    return apply_spec(_raw_orders(s, d), ORDER_SPEC, stamp=False)


def delimited_headered(s: SparkSession, d: str) -> DataFrame:
    path = fresh_path(s, "headered")
    _raw_orders(s, d).write.options(**HEADERED).csv(path)
    return apply_spec(headered(s, path), ORDER_SPEC, stamp=False)


PART_NAMES = ["chave", "nome", "marca"]


def _part_lines(s: SparkSession, d: str) -> DataFrame:
    """Accents, separators and quotes inside a field."""
    name = F.concat("p_name", F.lit('; "ação" '), "p_type")
    return b.read(s, d, "part").select(F.col("p_partkey").cast("string"), name, "p_brand")


def delimited_headerless(s: SparkSession, d: str) -> DataFrame:
    path = fresh_path(s, "headerless")
    _part_lines(s, d).write.options(**HEADERLESS).csv(path)
    return headerless(s, path, PART_NAMES)


def positional_names(s: SparkSession, d: str) -> DataFrame:
    """Three columns take three names; against four names they would stay as they are."""
    path = fresh_path(s, "positional")
    _part_lines(s, d).write.options(**HEADERLESS).csv(path)
    unnamed = all_text(headerless(s, path))
    return name_columns(name_columns(unnamed, [*PART_NAMES, "outro"]), PART_NAMES)


def bridge_from_file(s: SparkSession, d: str) -> DataFrame:
    path = fresh_path(s, "bridge")
    b.bridge_source(s, d).write.options(**HEADERLESS).csv(path)
    return bridge_pairs(bridge_file(s, path).drop("origem"))


def _opener(folder: str):
    """Writes a file of the shared folder from a task. Spark itself writes no archives."""
    from pyarrow import fs

    scheme, _, rest = folder.partition(":")
    if scheme == "file":
        folder = "/" + rest.lstrip("/")
    if folder.startswith("/"):
        filesystem, inner = fs.LocalFileSystem(), folder
    else:
        filesystem, inner = fs.FileSystem.from_uri(urllib.parse.quote(folder, safe=":/"))
    filesystem.create_dir(inner)
    return lambda name: filesystem.open_output_stream(f"{inner}/{name}")


def _write_archives(lines: DataFrame, folder: str, names: dict[int, str], broken: str | None = None) -> None:
    """An archive per partition and kind, of rows (kind, value); a repeated task writes the same files again.

    `names` are file names by kind, with a place for the number of the partition.
    """
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened, number, count = _opener(folder), TaskContext.get().partitionId(), 0
        files = {k: opened(name.format(number)) for k, name in names.items()}
        archives = {k: zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) for k, f in files.items()}
        members = {k: a.open("partes.csv", "w", force_zip64=True) for k, a in archives.items()}
        for batch in batches:
            for kind, line in zip(batch["kind"], batch["value"], strict=True):
                members[kind].write((line + "\n").encode("ISO-8859-1"))
                count += 1
        for part in (members, archives, files):
            for x in part.values():
                x.close()
        if broken and number == 0:
            with opened(broken) as f:
                f.write(b"broken")
        yield pd.DataFrame({"n": [count]})

    lines.select("kind", "value").mapInPandas(write, "n long").agg(F.sum("n")).collect()


def _quoted(*columns: Column) -> Column:
    row = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(columns)])
    return F.to_csv(row, {"sep": ";", "quote": '"', "escape": '"'})


def archive_expand(s: SparkSession, d: str) -> DataFrame:
    """Archives whose names hold a blank and an accent."""
    folder, parts = fresh_path(s, "archives"), _part_lines(s, d)
    text = _quoted(*[F.col(c) for c in parts.columns])
    _write_archives(parts.select(F.lit(0).alias("kind"), text.alias("value")), folder, {0: "Peças {}.zip"})
    return parsed_lines(archive_lines(binary_files(s, folder)), PART_NAMES, keep=[])


def binary_scan(s: SparkSession, d: str) -> DataFrame:
    """Whole files as rows: their keys, and whether all of a file is there."""
    path = fresh_path(s, "binary")
    b.read(s, d, "part").select(F.col("p_partkey").cast("string").alias("value")).write.text(path)
    files = binary_files(s, path, "*.txt")
    content = F.col("content").cast("string")
    return files.select(
        F.explode(F.split(F.rtrim(content), "\n")).alias("chave"),
        (F.col("length") == F.octet_length(content)).alias("completo"),
    ).filter("chave <> ''")


def _landing(s: SparkSession) -> tuple[str, str, tuple[str, str]]:
    """A database for raw tables, the folder for them, and the name and path of the control table."""
    tag, root = uuid.uuid4().hex[:12], fresh_path(s, "landing")
    sinks.ensure_database(s, f"raw_{tag}", f"{root}/db")
    return f"raw_{tag}", root, (f"raw_{tag}.controle", f"{root}/controle")


def _statuses(report: DataFrame) -> str:
    return ", ".join(sorted({r["status"] for r in report.collect()}))


def dimension_load(s: SparkSession, d: str) -> DataFrame:
    """Nations from two files of one table with different headers."""
    database, root, control = _landing(s)
    nation = all_text(b.read(s, d, "nation"))
    odd = F.col("n_nationkey").cast("int") % 2 == 1
    for name, rows in (
        ("NACAO", nation.filter(~odd).select("n_nationkey", "n_name")),
        ("NACAO.2", nation.filter(odd).select("n_name", "n_regionkey", "n_nationkey")),
    ):
        text = [rows.columns, *[list(r) for r in rows.collect()]]  # 25 nations
        with _opener(f"{root}/files")(f"{name}.csv") as f:
            f.write("\n".join(";".join(x) for x in [[c.upper() for c in text[0]], *text[1:]]).encode("ISO-8859-1"))
    report = bronze.load_dimensions(s, f"{root}/files", database, f"{root}/raw", *control)
    return s.table(f"{database}.nacao").select(
        "N_NATIONKEY", "N_NAME", "N_REGIONKEY", F.lit(_statuses(report)).alias("status")
    )


def register_load(s: SparkSession, d: str) -> DataFrame:
    """Parts as archives of two widths, and one archive that cannot be read."""
    database, root, control = _landing(s)
    rows, key = _part_lines(s, d), F.col("p_partkey")
    key, name, brand = (F.col(c) for c in rows.columns)
    even = key.cast("bigint") % 2 == 0
    lines = rows.select(
        F.when(even, 0).otherwise(1).alias("kind"),
        F.when(even, _quoted(key, name)).otherwise(_quoted(key, name, brand)).alias("value"),
    )
    _write_archives(lines, f"{root}/files", {0: "Motivos{}0.zip", 1: "Motivos {}1.zip"}, "Motivos2.zip")
    report = bronze.load_register(s, f"{root}/files", database, f"{root}/raw", *control)
    return s.table(f"{database}.motivos").select(
        "codigo_motivo", "descricao_motivo", "_c0", "_c1", "_c2", F.lit(_statuses(report)).alias("status")
    )


def stream_csv_facts(s: SparkSession, d: str) -> DataFrame:
    """Line items as fact files: some with their columns in another order and a further one."""
    database, root, _ = _landing(s)
    lines = b.read(s, d, "lineitem")
    facts = lines.select(
        F.year("l_shipdate").cast("string").alias("CO_ANO"),
        F.lpad(F.month("l_shipdate").cast("string"), 2, "0").alias("CO_MES"),
        F.lpad(F.col("l_partkey").cast("string"), 8, "0").alias("CO_NCM"),
        F.col("l_quantity").cast("bigint").cast("string").alias("KG_LIQUIDO"),
        F.floor(F.col("l_extendedprice") * 100 + 0.5).cast("string").alias("VL_FOB"),
        F.col("l_linestatus").alias("SITUACAO"), "l_returnflag",
    )
    names = ["CO_ANO", "CO_MES", "CO_NCM", "KG_LIQUIDO", "VL_FOB"]
    facts.filter("l_returnflag <> 'N'").select(*names).write.options(**HEADERED).csv(f"{root}/a")
    facts.filter("l_returnflag = 'N'").select("SITUACAO", *names[::-1]).write.options(**HEADERED).csv(f"{root}/b")
    schema = StructType([StructField(n, StringType()) for n in names])
    for folder in ("a", "b", "b"):  # the last run finds nothing new
        ingest_facts(s, f"{root}/{folder}", f"exp_{folder}", schema, database, f"{root}/raw", glob="*.csv")
    return s.table(f"{database}.exp_a").select(*names).unionByName(
        s.table(f"{database}.exp_b").select(*names, "SITUACAO"), allowMissingColumns=True
    )


def _write_files(lines: DataFrame, folder: str, header: list[str]) -> None:
    """A headered file for each partition, under the same name each time."""
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = 0
        with _opener(folder)(f"EXP_{TaskContext.get().partitionId():04}.csv") as f:
            f.write((";".join(header) + "\n").encode("ISO-8859-1"))
            for batch in batches:
                f.write("".join(x + "\n" for x in batch["value"]).encode("ISO-8859-1"))
                count += len(batch)
        yield pd.DataFrame({"n": [count]})

    lines.select("value").mapInPandas(write, "n long").agg(F.sum("n")).collect()


def stream_readmitted(s: SparkSession, d: str) -> DataFrame:
    """Line items as fact files that all lack a column at first; put right under their own names, they are loaded, and
    once only."""
    database, root, _ = _landing(s)
    names = ["CO_NCM", "KG_LIQUIDO", "VL_FOB"]
    facts = b.read(s, d, "lineitem").select(
        F.lpad(F.col("l_partkey").cast("string"), 8, "0").alias("CO_NCM"),
        F.col("l_quantity").cast("bigint").cast("string").alias("KG_LIQUIDO"),
        F.floor(F.col("l_extendedprice") * 100 + 0.5).cast("string").alias("VL_FOB"), "l_orderkey",
    ).repartition(4, "l_orderkey")
    schema = StructType([StructField(n, StringType()) for n in names])
    for header in (names[:2], names, names):
        _write_files(facts.select(F.concat_ws(";", *header).alias("value")), f"{root}/in", header)
        for _ in range(2):
            ingest_facts(s, f"{root}/in", "exp", schema, database, f"{root}/raw", glob="*.csv")
    left = refused_files(s.table(f"{database}.exp_refused")).count()
    return s.table(f"{database}.exp").select(*names, F.lit(left).cast("long").alias("recusados"))


def table_place(s: SparkSession, d: str) -> DataFrame:
    """Whether a table lies below the folder it was made in."""
    name, path = _name("placed"), fresh_path(s, "placed")
    sinks.save_table(s, b.read(s, d, "region").select("r_regionkey"), name, path)
    return s.table(name).select("r_regionkey", F.lit(path.split(":")[-1] in sinks.table_location(s, name)).alias("na_pasta"))


def ordered_files(s: SparkSession, d: str) -> DataFrame:
    """Orders as a table in descending value, in several files: how many of these overlap."""
    name, path, order = _name("ordered"), fresh_path(s, "ordered"), ["-o_totalprice", "o_orderkey"]
    orders = b.read(s, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    sinks.save_table(s, sinks.in_order(orders, order, ranges=4), name, path)
    files = s.table(name).select(F.col("_metadata.file_path")).distinct().count()
    overlaps = sinks.overlapping_files(s.table(name), order).count()
    return s.table(name).withColumns({"varios": F.lit(files > 1), "sobrepostos": F.lit(overlaps).cast("long")})


def lineage_columns(s: SparkSession, d: str) -> DataFrame:
    """Clock columns are only tested for presence, the source for its file name."""
    return with_lineage(b.read(s, d, "orders")).select(
        "o_orderkey",
        (F.col("_ingestion_date") == F.col(LOADED_AT).cast("date")).alias("mesma_data"),
        F.col(SOURCE).contains("orders.parquet").alias("origem"),
    )


def _event_files(events: DataFrame) -> DataFrame:
    number = (F.col("user_id") % 1000).cast("string")
    return events.groupBy(F.concat(F.initcap("event_type"), number, F.lit(".zip")).alias("table_name")).agg(
        F.max("ts").alias("modificationTime"), F.count(F.lit(1)).alias("size")
    ).select(
        F.concat(F.lit("/landing/"), "table_name").alias("path"), "table_name", "size", "modificationTime",
        F.lit("CNPJ").alias("container_name"),
    )


def changed_event_files(s: SparkSession, d: str) -> DataFrame:
    """Events as the files of a landing folder: loaded up to the cut, without the signup files,
    and with the error files left to somebody else."""
    events = b.read(s, d, "events")
    before = events.filter((F.col("ts") <= moment(LOAD_CUT, events.schema["ts"].dataType)) & (F.col("event_type") != "signup"))
    control = _event_files(before).select(
        F.col("container_name").alias("originator"), "table_name", F.col("path").alias("input_file_name"),
        F.col("modificationTime").alias("last_ingestion_timestamp"),
    )
    inventory = excluding_prefixes(_event_files(events), "Error")
    return with_target(changed_files(inventory, control, "CNPJ"), numbered=True)


def unseen_event_files(s: SparkSession, d: str) -> DataFrame:
    """Events as the files of a landing folder, in the versions of two listings: some loaded in the version that is
    there, some in a newer or smaller one, some by a control that kept no versions, some never."""
    events = b.read(s, d, "events")
    earlier = _event_files(events.filter((F.col("user_id") % 7 > 0) | (F.col("event_type") != "click")))
    number = F.regexp_extract("table_name", "([0-9]+)", 1).cast("int") % 5
    control = earlier.filter(number < 4).select(
        F.col("container_name").alias("originator"), "table_name", F.col("path").alias("input_file_name"),
        F.lit(LOAD_CUT).alias("last_ingestion_timestamp"),
        F.when(number == 1, F.col("modificationTime") + F.expr("interval 1 day")).when(
            number < 3, F.col("modificationTime")).cast("timestamp").alias("modified"),
        F.when(number == 2, F.col("size") - 1).when(number < 3, F.col("size")).alias("size"),
    )
    inventory = _event_files(events).withColumn("modificationTime", F.col("modificationTime").cast("timestamp"))
    return with_target(unseen_versions(inventory, control, "CNPJ"), numbered=True).select("path", "size", "target_table")


def frequent_users(s: SparkSession, d: str) -> DataFrame:
    return frequent_keys(b.read(s, d, "events"), "user_id", 0.008)


def append_partitioned(s: SparkSession, d: str) -> DataFrame:
    events, path = b.read(s, d, "events"), fresh_path(s, "appended")
    for kept in ("event_type <> 'view'", "event_type = 'view'"):
        sinks.append_files(events.filter(kept), path, ["event_type"])
    return s.read.parquet(path)


def append_widened(s: SparkSession, d: str) -> DataFrame:
    """The second load brings a column the first one did not have."""
    events, path = b.read(s, d, "events"), fresh_path(s, "widened")
    sinks.append_files(events.filter("event_type <> 'view'").drop("props"), path)
    sinks.append_files(events.filter("event_type = 'view'"), path)
    return sinks.read_widened(s, path)


def create_or_append(s: SparkSession, d: str) -> DataFrame:
    events, name, path = b.read(s, d, "events"), _name("appended"), fresh_path(s, "create-or-append")
    sinks.create_or_append(s, events.filter("event_type <> 'view'").drop("props"), name, path, ["event_type"])
    sinks.create_or_append(s, events.filter("event_type = 'view'"), name, path, ["event_type"])
    return s.table(name)


def replace_and_copy(s: SparkSession, d: str) -> DataFrame:
    """A table is replaced under another schema, then copied."""
    name, path = _name("saved"), fresh_path(s, "saved")
    sinks.save_table(s, b.read(s, d, "customer").select("c_custkey"), name, path)
    sinks.save_table(s, b.read(s, d, "orders").select("o_orderkey", "o_custkey"), name, path, None)
    sinks.copy_table(s, name, f"{name}_copy", fresh_path(s, "copy"))
    return s.table(f"{name}_copy")


LINE_SPEC_COLUMNS = [
    *same_name("l_orderkey", type_name="bigint"),
    *same_name("l_linenumber", type_name="int"),
    *same_name("l_shipdate", type_name="date"),
    *same_name("l_partkey", "l_suppkey", type_name="bigint"),
    *same_name("l_quantity", "l_extendedprice", "l_discount", "l_tax", type_name="double"),
    *same_name("l_returnflag", "l_linestatus"),
]
RUNS = [("l_shipdate < '19990101'", dt.datetime(2024, 1, 1, 12)), ("l_shipdate >= '19990101'", dt.datetime(2024, 2, 1, 12))]


def _two_runs(s: SparkSession, d: str) -> tuple[str, list[DataFrame]]:
    """Two raw loads of line items, each followed by a run of the typed layer."""
    tag, root = uuid.uuid4().hex[:12], fresh_path(s, "two-runs")
    raw_db, typed_db = f"raw_{tag}", f"typed_{tag}"
    for database in (raw_db, typed_db):
        sinks.ensure_database(s, database, f"{root}/{database}")
    spec = TableSpec("linhas", ["l_orderkey", "l_linenumber"], LINE_SPEC_COLUMNS, ["l_returnflag"])
    absent = TableSpec("ausente", ["l_orderkey"], LINE_SPEC_COLUMNS)
    raw = b.read(s, d, "lineitem").withColumn("l_shipdate", F.date_format("l_shipdate", "yyyyMMdd"))
    reports = []
    for number, (load, loaded_at) in enumerate(RUNS, 1):
        rows = all_text(raw.filter(load)).select(
            "*",
            F.lit(loaded_at.date()).alias("_ingestion_date"),
            F.lit(loaded_at).alias(LOADED_AT),
            F.lit(f"load-{number}").alias(SOURCE),
        )
        sinks.create_or_append(s, rows, f"{raw_db}.linhas", f"{root}/raw", ["_ingestion_date"], gather=False)
        report = run_silver(
            s, [spec, absent], raw_db, typed_db, f"{root}/typed", f"{typed_db}.controle", f"{root}/control",
            f"run-{number}",
        )
        reports.append(report.withColumn("execucao", F.lit(f"run-{number}")))
    return typed_db, reports


def silver_incremental(s: SparkSession, d: str) -> DataFrame:
    database, _ = _two_runs(s, d)
    return s.table(f"{database}.linhas").select(*[rule.target for rule in LINE_SPEC_COLUMNS])


def silver_report(s: SparkSession, d: str) -> DataFrame:
    _, reports = _two_runs(s, d)
    return reports[0].unionByName(reports[1]).select("execucao", "table_name", "status", "records")


def silver_control(s: SparkSession, d: str) -> DataFrame:
    database, _ = _two_runs(s, d)
    return s.table(f"{database}.controle").select(
        "table_name", F.unix_date(F.col("last_ingestion_timestamp").cast("date")).alias("dia"),
        "records_processed", "execution_id",
    )


def scalar_codes(s: SparkSession, d: str) -> DataFrame:
    """Text functions over customers: padding, cutting, digits, punctuation, names, flags."""
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    listed = F.concat(F.lit(" 12.3-"), F.col("c_custkey").cast("string"), F.lit("x "))
    file = F.concat(segment, F.col("c_custkey").cast("string"), F.lit(".csv.zip"))
    kind = F.col("c_custkey") % 5
    flag = F.when(kind == 0, " 2").when(kind == 1, "02").when(kind == 2, "021").when(kind == 3, "002").otherwise("x")
    return b.read(s, d, "customer").select(
        "c_custkey",
        F.trim(listed).alias("aparado"),
        codes.product_key("c_custkey").alias("produto"),
        codes.class_of_activity(F.col("c_custkey") * 97).alias("classe"),
        codes.division_of_class(codes.class_key("c_nationkey")).alias("divisao"),
        codes.without_punctuation(F.trim(listed)).alias("sem_pontuacao"),
        codes.leading_digits(codes.without_punctuation(F.trim(listed))).alias("digitos"),
        codes.leading_digits(F.when(kind == 0, "7a").otherwise(name)).alias("sem_digitos"),
        codes.joined_id(segment, F.when(F.col("c_nationkey") > 5, name), "c_nationkey").alias("identificador"),
        F.concat_ws("-", segment, "c_nationkey").alias("unido"),
        segment.startswith("AUTO").alias("prefixo"),
        codes.file_stem(file).alias("arquivo"),
        codes.table_of_file(file).alias("tabela"),
        codes.flag_is(flag, 2).alias("ativa"),
        F.size(F.split(name, "0")).alias("partes"),
        F.coalesce(F.nullif(segment, F.lit("BUILDING")), F.lit("nenhum")).alias("preenchido"),
    )


def scalar_numbers(s: SparkSession, d: str) -> DataFrame:
    """Calendar and arithmetic functions over orders."""
    key, price, opened = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderdate").cast("date")
    text = F.when(key % 5 == 0, "abc").otherwise(F.replace(F.format_string("%.2f", price), F.lit("."), F.lit(",")))
    age = measures.mean_years(measures.days_since(opened, b.AS_OF), F.lit(1), 365.25, 4)
    return b.read(s, d, "orders").select(
        "o_orderkey",
        measures.month_start(F.year(opened), F.month(opened)).alias("mes"),
        parsed(F.date_format(opened, "yyyyMMdd"), "date").alias("data"),
        parsed(text, "double").alias("valor"),
        parsed(key.cast("string"), "int").alias("inteiro"),
        parsed(F.concat(key.cast("string"), F.when(key % 2 == 0, ".9").otherwise("")), "bigint").alias("longo"),
        measures.days_since(opened, b.AS_OF).alias("dias"),
        measures.mean_years(measures.days_since(opened, b.AS_OF), F.lit(1), 365.25, 2).alias("anos"),
        measures.maturity_band(age * 4).alias("faixa"),
        measures.ratio(price, key % 4, 2).alias("razao"),
        measures.percent(key, F.col("o_custkey") % 9, 2).alias("percentual"),
        measures.percent_change(key, F.col("o_custkey"), 2).alias("variacao"),
        F.unix_millis(measures.from_epoch_ms(key * 1000)).alias("milissegundos"),
    )


QUERIES = {
    "typed_mapping": typed_mapping,
    "delimited_headered": delimited_headered,
    "delimited_headerless": delimited_headerless,
    "positional_names": positional_names,
    "archive_expand": archive_expand,
    "binary_scan": binary_scan,
    "dimension_load": dimension_load,
    "register_load": register_load,
    "stream_csv_facts": stream_csv_facts,
    "table_place": table_place,
    "ordered_files": ordered_files,
    "bridge_from_file": bridge_from_file,
    "lineage_columns": lineage_columns,
    "changed_files": changed_event_files,
    "unseen_versions": unseen_event_files,
    "stream_readmitted": stream_readmitted,
    "hot_keys": frequent_users,
    "append_partitioned": append_partitioned,
    "append_widened": append_widened,
    "create_or_append": create_or_append,
    "replace_and_copy": replace_and_copy,
    "silver_incremental": silver_incremental,
    "silver_report": silver_report,
    "silver_control": silver_control,
    "scalar_codes": scalar_codes,
    "scalar_numbers": scalar_numbers,
}
