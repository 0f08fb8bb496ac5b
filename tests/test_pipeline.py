"""Landing files to dashboards on small files in the published layouts."""

from __future__ import annotations

import datetime as dt
import os
import shutil
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from aduana.operators.lineage import LINEAGE
from aduana.operators.spec import TableSpec
from aduana.plans import bronze, gold, silver
from aduana.plans.register_tables import POSITIONS, REGISTER_TABLES
from aduana.plans.trade_tables import FACTS, TRADE_TABLES
from aduana.sources.bridge import bridge_file, bridge_rows
from aduana.sources.archives import archive_blocks
from aduana.sources.inventory import binary_files, file_inventory
from aduana.streaming.ingest import FACT_FILES, ingest_facts, refused_files
from tests.conftest import rows

NATIONAL = "CO_ANO;CO_MES;CO_NCM;CO_UNID;CO_PAIS;SG_UF_NCM;CO_VIA;CO_URF;QT_ESTAT;KG_LIQUIDO;VL_FOB"
MUNICIPAL = "CO_ANO;CO_MES;SH4;CO_PAIS;SG_UF_MUN;CO_MUN;KG_LIQUIDO;VL_FOB"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode("ISO-8859-1"))


def write_zip(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as archive:
        for name, text in members.items():
            archive.writestr(name, text.encode("ISO-8859-1"))


def site(basic, order, status="02", opened="20100115", activity="0111301", uf="SP", hq="1"):
    values = {
        "cnpj_basico": basic, "cnpj_ordem": order, "cnpj_dv": "99", "identificador_matriz_filial": hq,
        "nome_fantasia": " LOJA ", "situacao_cadastral": status, "data_situacao_cadastral": "00000000",
        "data_inicio_atividade": opened, "cnae_fiscal_principal": activity, "uf": uf, "municipio": "7107",
    }
    return ";".join(f'"{values.get(c, "")}"' for c in POSITIONS["estabelecimentos"])


class Lake:
    """Paths and database names of one test's pipeline."""

    def __init__(self, root, tag):
        self.root = root
        self.landing = root / "landing"
        self.bronze, self.silver, self.gold = f"bronze_{tag}", f"silver_{tag}", f"gold_{tag}"
        self.raw_control, self.control = f"meta_{tag}.raw", f"meta_{tag}.typed"

    def path(self, name):
        return str(self.root / name)

    def folder(self, name):
        return str(self.landing / name)

    def load_dimensions(self, spark):
        return bronze.load_dimensions(
            spark, self.folder("trade"), self.bronze, self.path("bronze"), self.raw_control, self.path("raw_control")
        )

    def load_register(self, spark):
        return bronze.load_register(
            spark, self.folder("register"), self.bronze, self.path("bronze"), self.raw_control, self.path("raw_control")
        )

    def load_facts(self, spark):
        for spec in FACTS:
            ingest_facts(
                spark, self.folder("trade"), spec.name, spec.raw_schema(), self.bronze, self.path("bronze")
            )

    def run_silver(self, spark, specs, run):
        return silver.run_silver(
            spark, specs, self.bronze, self.silver, self.path("silver"), self.control, self.path("typed_control"), run
        )


@pytest.fixture(scope="module")
def lake(tmp_path_factory):
    lake = Lake(tmp_path_factory.mktemp("lake"), "main")
    trade, register = lake.landing / "trade", lake.landing / "register"
    write(trade / "PAIS.csv", "CO_PAIS;CO_PAIS_ISON3;CO_PAIS_ISOA3;NO_PAIS;NO_PAIS_ING;NO_PAIS_ESP\n"
          "023;276;DEU;Alemanha ;Germany;Alemania\n160;156;CHN;China;China;China\n")
    write(trade / "PAIS_BLOCO.csv", "CO_PAIS;CO_BLOCO;NO_BLOCO;NO_BLOCO_ING;NO_BLOCO_ESP\n"
          "023;22;União Europeia;EU;UE\n023;53;Europa;Europe;Europa\n")
    write(trade / "VIA.csv", "CO_VIA;NO_VIA\n01;MARITIMA\n")
    write(trade / "UF.csv", "CO_UF;SG_UF;NO_UF;NO_REGIAO\n41;SP;São Paulo;REGIAO SUDESTE\n45;RS;Rio Grande do Sul;REGIAO SUL\n")
    write(trade / "NCM.csv", "CO_NCM;NO_NCM_POR;NO_NCM_ING;CO_UNID;CO_SH6;CO_FAT_AGREG;CO_CUCI_ITEM;CO_ISIC_CLASSE\n"
          "12019000;Soja;Soy;10;120190;01;22220;0111\n09011110;Café;Coffee;10;090111;01;07111;0127\n")
    write(trade / "NCM_FAT_AGREG.csv", "CO_FAT_AGREG;NO_FAT_AGREG;NO_FAT_AGREG_GP\n01;PRODUTOS BASICOS;BASICOS\n")
    write(trade / "LEIA.txt", "not a table\n")
    write(trade / "EXP_2023.csv", NATIONAL + "\n2023;01;12019000;10;160;SP;01;0817800;1;100;1000\n"
          "2023;02;12019000;10;160;SP;01;0817800;1;x;500\n2023;01;09011110;10;023;RS;09;0817800;1;50;300\n")
    write(trade / "IMP_2023.csv", NATIONAL + ";VL_FRETE;VL_SEGURO\n2023;01;12019000;10;023;SP;01;0817800;1;10;200;5;1\n")
    write(trade / "EXP_2023_MUN.csv", MUNICIPAL + "\n" + "2023;01;1201;160;SP;3550308;100;1000\n" * 2
          + "2023;02;1201;160;SP;3550308;100;1000\n")
    write(trade / "IMP_2023_MUN.csv", MUNICIPAL + "\n2023;01;1201;023;SP;3550308;10;200\n")
    write_zip(register / "Cnaes.zip", {"F.CNAECSV": '"0111301";"Cultivo de arroz"\n"0111302";"Cultivo de milho "\n"1112700";"Vinho"\n'})
    write_zip(register / "Empresas0.zip", {
        "K1.EMPRECSV": '"00000001";"ALFA; ""A"" LTDA ";"2062";"49";"1000,50";"01";""\n',
        "K2.EMPRECSV": '"00000002";"BETA";"2062";"49";"0,00";"05";""\n',
    })
    write_zip(register / "Empresas1.zip", {"K3.EMPRECSV": '"00000003";"GAMA SÃO";"2062";"49";"abc";"3";""\n'})
    write_zip(register / "Estabelecimentos0.zip", {"E.ESTABELE": "\n".join([
        site("00000001", "0001"), site("00000001", "0002", uf="RS", hq="2", opened="20200101"),
        site("00000002", "0001", activity="0111302"), site("00000003", "0001", status="08"),
    ]) + "\n"})
    write_zip(register / "Municipios.zip", {"F.MUNICCSV": '"7107";"SAO PAULO"\n'})
    write_zip(register / "Motivos.zip", {"F.MOTICSV": '"01";"EXTINCAO";"surplus"\n'})
    write(register / "layout.pdf", "not an archive")
    write(lake.landing / "bridge" / "corr.csv", 'Correlação;;\nNCM;Descrição;CNAE\n12019000;Soja;"0111-3; 4711-3"\n'
          '9011110;Café;abc\n27090010;Óleo;\n1;x;""\n')
    return lake


@pytest.fixture(scope="module")
def loaded(spark, lake):
    reports = {
        "dimensions": lake.load_dimensions(spark).collect(),
        "register": lake.load_register(spark).collect(),
    }
    lake.load_facts(spark)
    for _ in range(2):  # loaded twice
        bronze.load_bridge(spark, bridge_file(spark, lake.folder("bridge")), lake.bronze, lake.path("bronze"))
    reports["silver"] = lake.run_silver(spark, TRADE_TABLES + REGISTER_TABLES, "run-1").collect()
    silver.load_bridge_table(spark, lake.bronze, lake.silver, lake.path("silver"))
    return reports


def test_reports(loaded):
    assert {r["target_table"]: r["status"] for r in loaded["dimensions"]} == {
        t: "loaded" for t in ("ncm", "ncm_fat_agreg", "pais", "pais_bloco", "uf", "via")
    }
    register = {r["target_table"]: (r["status"], r["files"]) for r in loaded["register"]}
    assert register["empresas"] == ("loaded", 2) and "layout" not in register
    states = {r["table_name"]: r["status"] for r in loaded["silver"]}
    assert states["exp"] == "created" and states["urf"] == "failed" and states["motivos"] == "failed"
    absent = {r["table_name"]: r["missing_columns"] for r in loaded["silver"]}
    assert "CO_PPE" in absent["ncm"] and absent["pais"] is None


def test_run_totals(spark, loaded):
    totals = silver.run_totals(spark.createDataFrame(loaded["silver"], silver.REPORT_SCHEMA))
    by_status = {r["status"]: r["tables"] for r in totals.collect()}
    assert sum(by_status.values()) == 32 and by_status["created"] == 14


def test_bronze_is_text_with_lineage(spark, lake, loaded):
    raw = spark.table(f"{lake.bronze}.empresas")
    assert set(raw.columns) == {*POSITIONS["empresas"], *LINEAGE}
    assert rows(raw, "cnpj_basico", "razao_social", "capital_social") == [
        ("00000001", 'ALFA; "A" LTDA ', "1000,50"), ("00000002", "BETA", "0,00"), ("00000003", "GAMA SÃO", "abc"),
    ]
    sources = {r[0].rsplit("/", 2)[-2] + "/" + r[0].rsplit("/", 1)[-1] for r in raw.select("_source_path").collect()}
    assert sources == {"Empresas0.zip/K1.EMPRECSV", "Empresas0.zip/K2.EMPRECSV", "Empresas1.zip/K3.EMPRECSV"}


def test_wrong_column_count_keeps_positions(spark, lake, loaded):
    assert set(spark.table(f"{lake.bronze}.motivos").columns) == {"_c0", "_c1", "_c2", *LINEAGE}


def test_each_stream_reads_its_own_files(spark, lake, loaded):
    counts = {name: spark.table(f"{lake.bronze}.{name}").count() for name in FACT_FILES}
    assert counts == {"exp": 3, "exp_mun": 3, "imp": 1, "imp_mun": 1}


def test_silver_types_and_latest_rows(spark, lake, loaded):
    exp = spark.table(f"{lake.silver}.exp")
    assert rows(exp, "ano", "mes", "co_ncm", "kg_liquido", "vl_fob") == [
        (2023, 1, "09011110", 50, 300), (2023, 1, "12019000", 100, 1000), (2023, 2, "12019000", None, 500),
    ]
    assert spark.table(f"{lake.silver}.exp_mun").count() == 2
    companies = spark.table(f"{lake.silver}.empresas").select("cnpj_basico", F.col("capital_social").cast("string"))
    assert rows(companies) == [("00000001", "1000.50"), ("00000002", "0.00"), ("00000003", None)]
    sites = spark.table(f"{lake.silver}.estabelecimentos")
    assert rows(sites.filter("cnpj_ordem = '0002'"), "nome_fantasia", "data_inicio_atividade", "data_situacao_cadastral", "uf") == [
        ("LOJA", dt.date(2020, 1, 1), None, "RS")
    ]


def test_bridge_is_exploded_and_loaded_once(spark, lake, loaded):
    raw = spark.table(f"{lake.bronze}.corr_ncm_cnae")
    assert raw.count() == 6 and raw.filter("_source_path like '%/corr.csv'").count() == 6
    assert rows(spark.table(f"{lake.silver}.corr_ncm_cnae"), "NCM", "CNAE") == [
        ("12019000", "01113"), ("12019000", "47113"), ("9011110", None),
    ]


def test_inventory_and_binary_scan(spark, lake, loaded):
    files = file_inventory(spark, lake.folder("register"), "CNPJ", "*.zip")
    assert files.columns == ["path", "table_name", "size", "modificationTime", "container_name"]
    assert "content" not in files._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]
    assert rows(files, "table_name")[:2] == [("Cnaes.zip",), ("Empresas0.zip",)]
    content = binary_files(spark, lake.folder("register"), "Motivos.zip").first()
    assert bytes(content["content"][:2]) == b"PK" and content["length"] == len(content["content"])


def test_bridge_keeps_codes_of_any_form(spark, tmp_path):
    write(tmp_path / "corr.csv", "Correlação;;\nNCM;Descrição;CNAE\n 12019000;Soja;0111-3\n\"'9\";x;1\nA1;y;2\n;z;3\nB;;\n")
    got = bridge_file(spark, str(tmp_path / "corr.csv"))
    assert rows(got, "NCM", "CNAE") == sorted([(" 12019000", "0111-3"), ("'9", "1"), ("A1", "2"), (None, "3")], key=repr)


def test_bridge_rows_take_three_named_columns(spark):
    df = spark.createDataFrame([("x", "1", "d", "0111-3")], "`Unnamed: 0` string, a string, `b c` string, d string")
    assert bridge_rows(df).columns == ["NCM", "NCM_DESC", "CNAE"] and rows(bridge_rows(df)) == [("1", "d", "0111-3")]
    with pytest.raises(ValueError, match="three|3"):
        bridge_rows(df.withColumn("e", F.lit("4")))


def test_fact_table_without_files_is_reported(spark, tmp_path):
    lake = Lake(tmp_path, "none")
    write(lake.landing / "trade" / "VIA.csv", "CO_VIA;NO_VIA\n01;MARITIMA\n")
    lake.load_facts(spark)
    report = lake.run_silver(spark, FACTS, "run-1")
    assert {r["status"] for r in report.collect()} == {"failed"}


def test_control_tables(spark, lake, loaded):
    raw = spark.table(lake.raw_control)
    assert raw.filter("originator = 'BALANCE'").count() == 6
    typed = spark.table(lake.control).filter("table_name = 'exp'").first()
    assert typed["records_processed"] == 3 and typed["execution_id"] == "run-1"


def test_second_run_adds_nothing(spark, lake, loaded):
    assert lake.load_dimensions(spark).count() == 0 and lake.load_register(spark).count() == 0
    lake.load_facts(spark)
    report = lake.run_silver(spark, TRADE_TABLES, "run-2")
    assert {r["status"] for r in report.collect()} == {"unchanged", "failed"}
    assert spark.table(f"{lake.bronze}.exp").count() == 3


def test_dashboards_read_the_facts_twice(spark, lake, loaded):
    """Only the two shared sums read them, and no dashboard table does."""
    for name, df in gold.dashboards(spark, lake.silver, dt.date(2024, 1, 1)).items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert f"{lake.silver}.exp" not in plan and "/silver/exp/" not in plan and "/silver/imp/" not in plan, name


def test_gold(spark, lake, loaded):
    for name in ("ncm_isic", "ncm_cuci"):
        assert not spark.catalog.tableExists(f"{lake.silver}.{name}")
    names = gold.build_gold(spark, lake.silver, lake.gold, lake.path("gold"), dt.date(2024, 1, 1))
    assert names == gold.DASHBOARD_TABLES + gold.AUDIT_TABLES

    def table(name):
        return spark.table(f"{lake.gold}.{name}")

    assert rows(table("view_painel1_vol_exp_imp_saldo")) == [
        (dt.date(2023, 1, 1), 1300, 200, 1100), (dt.date(2023, 2, 1), 500, None, None),
    ]
    assert rows(table("view_painel3_comercio_bloco"), "NO_BLOCO", "co_ncm", "valor_fob", "tipo_operacao") == [
        ("Europa", "09011110", 300, "EXPORTACAO"), ("Europa", "12019000", 200, "IMPORTACAO"),
        ("União Europeia", "09011110", 300, "EXPORTACAO"), ("União Europeia", "12019000", 200, "IMPORTACAO"),
        (None, "12019000", 1500, "EXPORTACAO"),
    ]
    assert rows(table("view_painel4_empresas_uf"), "codigo_cnae", "uf", "total_empresas", "total_matrizes") == [
        ("01113", "RS", 1, 0), ("01113", "SP", 2, 2),
    ]
    assert rows(table("view_painel5_oportunidades"), "desc_ncm", "total_exportado", "qtd_empresas_habilitadas") == [
        ("Soja", 1500, 2)
    ]
    assert rows(table("view_painel4_perfil_porte"), "codigo_porte", "total_empresas") == [("01", 2), ("05", 1)]
    from aduana.operators.sinks import overlapping_files

    for name, order in gold.ORDERS.items():
        assert overlapping_files(table(name), order).count() == 0, name
    # built again over the same paths
    gold.build_gold(spark, lake.silver, lake.gold, lake.path("gold"), dt.date(2024, 1, 1))
    assert table("dim_ncm").count() == 2


def test_changed_and_new_files(spark, tmp_path):
    lake = Lake(tmp_path, "inc")
    trade = lake.landing / "trade"
    write(trade / "VIA.csv", "CO_VIA;NO_VIA\n01;MARITIMA\n02;FLUVIAL\n")
    write(trade / "URF.csv", "CO_URF;NO_URF\n1;A\n")
    specs = [s for s in TRADE_TABLES if s.name in ("via", "urf")]
    lake.load_dimensions(spark)
    lake.run_silver(spark, specs, "run-1")

    time.sleep(1.1)
    write(trade / "VIA.csv", "CO_VIA;NO_VIA;NO_VIA_ING\n02;FLUVIAL;RIVER\n03;AEREA;AIR\n")
    os.utime(trade / "VIA.csv")
    assert rows(lake.load_dimensions(spark), "target_table") == [("via",)]
    raw = spark.table(f"{lake.bronze}.via")
    assert raw.count() == 4 and "NO_VIA_ING" in raw.columns  # history kept, schema widened
    wide = TableSpec("via", ["co_via"], [*specs[0].columns, type(specs[0].columns[0])("NO_VIA_ING", "no_via_ing")])
    report = lake.run_silver(spark, [wide], "run-2")
    assert rows(report, "status", "records") == [("updated", 2)]
    assert rows(spark.table(f"{lake.silver}.via"), "co_via", "no_via", "no_via_ing") == [
        ("01", "MARITIMA", None), ("02", "FLUVIAL", "RIVER"), ("03", "AEREA", "AIR"),
    ]
    control = spark.table(lake.control).filter("table_name = 'via'").first()
    assert control["records_processed"] == 4 and control["execution_id"] == "run-2"


def test_failed_archive_is_retried(spark, tmp_path):
    lake = Lake(tmp_path, "retry")
    register = lake.landing / "register"
    write_zip(register / "Paises.zip", {"F.PAISCSV": '"105";"BRASIL"\n'})
    register.joinpath("Socios0.zip").write_bytes(b"broken")
    first = {r["target_table"]: r["status"] for r in lake.load_register(spark).collect()}
    assert first == {"paises": "loaded", "socios": "failed"}
    shutil.copy(register / "Paises.zip", register / "ignored.tmp")
    again = {r["target_table"]: r["status"] for r in lake.load_register(spark).collect()}
    assert again == {"socios": "failed"}


def test_good_archives_load_beside_broken_and_odd_ones(spark, tmp_path):
    lake = Lake(tmp_path, "isolated")
    register = lake.landing / "register"
    write_zip(register / "Motivos 0.zip", {"A": '"01";"X; ""y"""\n"02";"Z"\n'})
    write_zip(register / "Motivos1.zip", {"B": '"03";"a;b";"extra"\n"04"\n', "C": '"05";"ok"\n'})
    register.joinpath("Motivos2.zip").write_bytes(b"broken")
    report = lake.load_register(spark).collect()
    assert {(r["status"], r["files"]) for r in report} == {("loaded", 2), ("failed", 1)}
    assert "Motivos1.zip/B has 3 columns" in next(r["message"] for r in report if r["status"] == "loaded")
    assert "Motivos2.zip" in next(r["message"] for r in report if r["status"] == "failed")
    assert rows(spark.table(f"{lake.bronze}.motivos"), "codigo_motivo", "descricao_motivo", "_c0", "_c1", "_c2") == sorted([
        ("01", 'X; "y"', None, None, None), ("02", "Z", None, None, None), ("05", "ok", None, None, None),
        (None, None, "03", "a;b", "extra"), (None, None, "04", None, None),
    ], key=repr)
    write_zip(register / "Motivos2.zip", {"D": '"06";"late"\n'})
    again = lake.load_register(spark).collect()
    assert [(r["status"], r["files"]) for r in again] == [("loaded", 1)]
    assert spark.table(f"{lake.bronze}.motivos").count() == 6


def test_archives_above_the_limit_of_a_scan(spark, tmp_path):
    """A local one is streamed whatever its size; on a file system that only Spark knows it fails alone."""
    lake = Lake(tmp_path, "large")
    register = lake.landing / "register"
    text = "".join(f'"{i:05}";"{i * 7919 % 100003} {i * 104729 % 1299709}"\n' for i in range(2000))
    write_zip(register / "Motivos 0.zip", {"A": text})
    write_zip(register / "Motivos1.zip", {"B": '"01";"X"\n'})
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.large.link./in", f"file://{register}")
    limit = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(limit, "2000")
    try:
        assert (register / "Motivos 0.zip").stat().st_size > 2000
        report = lake.load_register(spark).collect()
        assert [(r["status"], r["files"]) for r in report] == [("loaded", 2)]
        assert spark.table(f"{lake.bronze}.motivos").count() == 2001
        blocks = archive_blocks(binary_files(spark, "viewfs://large/in")).collect()
    finally:
        spark.conf.unset(limit)
    assert [b["block"] for b in blocks if b["error"] is None] == ['"01";"X"']
    assert [b["path"].endswith("Motivos 0.zip") for b in blocks if b["error"]] == [True]


def test_fact_files_are_read_by_their_header(spark, tmp_path):
    lake = Lake(tmp_path, "header")
    trade = lake.landing / "trade"
    names = NATIONAL.split(";")
    write(trade / "EXP_2021.csv", ";".join(reversed(names)) + "\n" + ";".join(f"r{n}" for n in reversed(names)) + "\n")
    write(trade / "EXP_2022.csv", f"CO_NOVO;{NATIONAL}\n" + ";".join(["novo", *[f"n{n}" for n in names]]) + "\n")
    write(trade / "EXP_2023.csv", ";".join(names[:-1]) + "\n" + ";".join("x" * (len(names) - 1)) + "\n")
    write(trade / "EXP_2024.csv", f"{NATIONAL};VL_FOB\n" + ";".join("y" * (len(names) + 1)) + "\n")
    exp = [s for s in FACTS if s.name == "exp"][0]
    for _ in range(2):
        ingest_facts(spark, lake.folder("trade"), "exp", exp.raw_schema(), lake.bronze, lake.path("bronze"))
    got = {r["_source_path"][-8:-4]: r.asDict() for r in spark.table(f"{lake.bronze}.exp").collect()}
    assert set(got) == {"2021", "2022"}
    assert all(got["2021"][n] == f"r{n}" and got["2022"][n] == f"n{n}" for n in names)
    assert got["2022"]["CO_NOVO"] == "novo" and got["2021"]["CO_NOVO"] is None
    refused = {r["path"][-8:-4]: r["reason"] for r in spark.table(f"{lake.bronze}.exp_refused").collect()}
    assert set(refused) == {"2023", "2024"} and "VL_FOB" in refused["2023"] and "VL_FOB" in refused["2024"]


def test_a_refused_file_that_is_put_right_is_loaded_once(spark, tmp_path):
    lake = Lake(tmp_path, "mended")
    trade, names = lake.landing / "trade", NATIONAL.split(";")
    exp = [s for s in FACTS if s.name == "exp"][0]

    def good(n):
        return NATIONAL + "\n" + ";".join([str(n), *["x"] * (len(names) - 1)]) + "\n"

    def ingest(max_files=200):
        ingest_facts(spark, lake.folder("trade"), "exp", exp.raw_schema(), lake.bronze, lake.path("bronze"), max_files=max_files)
        ledger = spark.table(f"{lake.bronze}.exp_refused")
        loaded = spark.table(f"{lake.bronze}.exp") if spark.catalog.tableExists(f"{lake.bronze}.exp") else None
        return [r[0] for r in rows(loaded, "CO_ANO")] if loaded else [], sorted(
            r["path"][-8:-4] for r in refused_files(ledger).collect()
        )

    for year in (2020, 2021, 2022):
        write(trade / f"EXP_{year}.csv", "CO_ANO;CO_MES\n1;2\n")
    assert ingest() == ([], ["2020", "2021", "2022"])
    write(trade / "EXP_2020.csv", good(2020))
    write(trade / "EXP_2021.csv", "CO_ANO;CO_MES;CO_NCM\n1;2;3\n")  # another version, refused again
    for _ in range(2):
        assert ingest() == (["2020"], ["2021", "2022"])
    before = spark.table(f"{lake.bronze}.exp_refused").count()
    write(trade / "EXP_2021.csv", good(2021))
    write(trade / "EXP_2022.csv", good(2022))
    write(trade / "EXP_2023.csv", good(2023))  # new, by the stream
    for _ in range(2):
        assert ingest(max_files=1) == (["2020", "2021", "2022", "2023"], [])
    assert spark.table(f"{lake.bronze}.exp_refused").count() == before + 2
    # Interrupted after its rows were written: the same batch is written again, in place.
    spark.sql(f"ALTER TABLE {lake.bronze}.exp_refused DROP PARTITION (_batch = -3)")
    shutil.rmtree(lake.path("bronze") + "/exp_refused/_batch=-3")
    assert ingest() == (["2020", "2021", "2022", "2023"], [])


def test_a_file_replaced_while_its_table_loads_is_loaded_again(spark, tmp_path, monkeypatch):
    lake = Lake(tmp_path, "race")
    via = lake.landing / "trade" / "VIA.csv"
    write(via, "CO_VIA;NO_VIA\n01;OLD\n")
    write(lake.landing / "trade" / "URF.csv", "CO_URF;NO_URF\n1;A\n")
    landed = bronze._append

    def replaced_afterwards(*args):
        status = landed(*args)
        if args[-1] == "via" and "NEW" not in via.read_text():
            write(via, "CO_VIA;NO_VIA\n01;NEW\n02;TWO\n")  # between the listing and the control row
        return status

    monkeypatch.setattr(bronze, "_append", replaced_afterwards)
    assert rows(lake.load_dimensions(spark), "target_table") == [("urf",), ("via",)]
    assert rows(lake.load_dimensions(spark), "target_table") == [("via",)]
    assert lake.load_dimensions(spark).count() == 0
    assert rows(spark.table(f"{lake.bronze}.via"), "NO_VIA") == [("NEW",), ("OLD",), ("TWO",)]
    os.utime(via, (1_600_000_000, 1_600_000_000))  # an older file is another version as well
    assert rows(lake.load_dimensions(spark), "target_table") == [("via",)]


def test_control_from_before_versions_were_kept(spark, tmp_path):
    from aduana.operators.sinks import create_table, ensure_database

    lake = Lake(tmp_path, "before")
    write(lake.landing / "trade" / "VIA.csv", "CO_VIA;NO_VIA\n01;A\n")
    write(lake.landing / "trade" / "URF.csv", "CO_URF;NO_URF\n1;A\n")
    ensure_database(spark, lake.raw_control.split(".")[0], lake.path("db"))
    old = [("BALANCE", "VIA.csv", "x", dt.datetime(2100, 1, 1)), ("BALANCE", "URF.csv", "x", dt.datetime(2000, 1, 1))]
    create_table(spark, spark.createDataFrame(
        old, "originator string, table_name string, input_file_name string, last_ingestion_timestamp timestamp"
    ), lake.raw_control, lake.path("raw_control"))
    assert rows(lake.load_dimensions(spark), "target_table") == [("urf",)]
    assert lake.load_dimensions(spark).count() == 0


def test_rows_committed_late_are_read(spark, tmp_path):
    lake = Lake(tmp_path, "late")
    spec = [s for s in TRADE_TABLES if s.name == "via"][0]

    def load(minute, *lines):
        from aduana.operators.sinks import create_or_append

        rows_ = spark.createDataFrame(lines, "CO_VIA string, NO_VIA string").select(
            "*", F.lit(dt.date(2024, 1, 1)).alias("_ingestion_date"),
            F.lit(dt.datetime(2024, 1, 1, 12, minute)).alias("_ingestion_timestamp"), F.lit("f").alias("_source_path"),
        )
        create_or_append(spark, rows_, f"{lake.bronze}.via", lake.path("bronze/via"), ["_ingestion_date"])
        return rows(lake.run_silver(spark, [spec], f"run-{minute}"), "status", "records")

    spark.sql(f"CREATE DATABASE IF NOT EXISTS {lake.bronze} LOCATION '{lake.path('db')}'")
    assert load(30, ("01", "MAR"), ("02", "RIO")) == [("created", 2)]
    assert load(20, ("03", "AR"), ("01", "OLD")) == [("updated", 1)]  # late, and older than what is there
    assert rows(spark.table(f"{lake.silver}.via"), "co_via", "no_via") == [("01", "MAR"), ("02", "RIO"), ("03", "AR")]
    assert rows(lake.run_silver(spark, [spec], "again"), "status") == [("unchanged",)]
    assert spark.table(lake.control).first()["last_ingestion_timestamp"] == dt.datetime(2024, 1, 1, 12, 30)


def test_new_fact_file_adds_only_its_rows(spark, tmp_path):
    lake = Lake(tmp_path, "facts")
    trade = lake.landing / "trade"
    line = "2023;01;12019000;10;160;SP;01;0817800;1;100;{}\n"
    for name, header in (("EXP_2022.csv", NATIONAL), ("IMP_2022.csv", NATIONAL + ";VL_FRETE;VL_SEGURO"),
                         ("EXP_2022_MUN.csv", MUNICIPAL), ("IMP_2022_MUN.csv", MUNICIPAL)):
        write(trade / name, header + "\n")
    write(trade / "EXP_2023.csv", NATIONAL + "\n" + line.format(1))
    exp = [s for s in FACTS if s.name == "exp"][0]

    def ingest():
        ingest_facts(spark, lake.folder("trade"), "exp", exp.raw_schema(), lake.bronze, lake.path("bronze"))
        return rows(spark.table(f"{lake.bronze}.exp"), "VL_FOB")

    assert ingest() == [("1",)]
    write(trade / "EXP_2024.csv", NATIONAL + "\n" + line.format(2))
    assert ingest() == [("1",), ("2",)]
    assert ingest() == [("1",), ("2",)]
