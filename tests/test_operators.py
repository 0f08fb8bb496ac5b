"""Operators on rows written out by hand, one test per rule."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from aduana.functions import codes, measures
from aduana.functions.typing import parsed
from aduana.operators import sinks
from aduana.operators.dedup import latest_by_key
from aduana.operators.flows import tag_flows
from aduana.operators.mapping import apply_spec, missing_columns, name_columns
from aduana.plans.audit import frequent_keys
from aduana.operators.spec import ColumnRule, TableSpec
from aduana.operators.topk import explicit_top, refilled_top
from aduana.operators.upsert import accumulated, merged, upsert_table
from aduana.operators.watermark import CONTROL_SCHEMA, last_watermark, new_rows
from aduana.plans import audit, company, geo, trade
from aduana.plans.trade_tables import TRADE_TABLES
from aduana.sources.bridge import bridge_pairs, distinct_pairs, keyed_pairs
from tests.conftest import rows

AS_OF = dt.date(2024, 1, 1)
TRADE = "fluxo string, ano int, mes int, co_ncm string, co_pais string, sigla_uf_ncm string, co_via string, kg_liquido bigint, vl_fob bigint"


def facts(spark, *lines):
    """Lines of (flow, year, month, product, country, state, value)."""
    return spark.createDataFrame(
        [(f, y, m, p, c, s, "01", 10, v) for f, y, m, p, c, s, v in lines], TRADE
    )


def one(spark, expression, **values):
    names = list(values)
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} string" for n in names))
    return df.select(expression.alias("x")).first()["x"]


# --- typing -------------------------------------------------------------------------------------

@pytest.mark.parametrize("text, kind, value", [
    ("12", "int", 12), ("x", "int", None), ("", "bigint", None), (" 7", "bigint", 7),
    ("20240229", "date", dt.date(2024, 2, 29)), ("00000000", "date", None), ("0", "date", None), ("", "date", None),
    ("7.9", "int", 7), ("-7.9", "bigint", -7), ("9223372036854775807", "bigint", 9223372036854775807),
    ("9223372036854775807.5", "bigint", 9223372036854775807), ("1e3", "int", 1000), ("7.x", "int", None),
    ("1000,50", "double", 1000.5), ("1000.50", "double", 1000.5), ("abc", "double", None), (" a ", "string", " a "),
])
def test_parsed_never_fails(spark, text, kind, value):
    assert one(spark, parsed(F.col("t"), kind), t=text) == value


def test_decimal_comma_is_read_before_the_cast(spark):
    assert str(one(spark, parsed(F.col("t"), "decimal(18,2)"), t="1000,50")) == "1000.50"
    assert one(spark, parsed(F.col("t"), "decimal(18,2)"), t="x") is None


def test_apply_spec(spark):
    spec = TableSpec("t", ["a"], [ColumnRule("A", "a", trim=True), ColumnRule("B", "b", "int"), ColumnRule("C", "c")])
    df = spark.createDataFrame([(" x ", "7", "f")], "a string, B string, _source_path string")
    assert missing_columns(df, spec) == ["C"]
    typed = apply_spec(df, spec)
    assert typed.columns == ["a", "b", "_source_path", "_silver_insert_ts"]
    assert rows(typed, "a", "b", "_source_path") == [("x", 7, "f")]


def test_specs_are_consistent():
    assert len(TRADE_TABLES) == 22
    for spec in TRADE_TABLES:
        targets = [c.target for c in spec.columns]
        assert len(set(targets)) == len(targets) and set(spec.keys) <= set(targets)


def test_name_columns_needs_the_right_count(spark):
    df = spark.createDataFrame([("1", "2")], "_c0 string, _c1 string")
    assert name_columns(df, ["a", "b"]).columns == ["a", "b"]
    assert name_columns(df, ["a"]).columns == ["_c0", "_c1"]
    assert name_columns(df, None).columns == ["_c0", "_c1"]


# --- codes and measures ---------------------------------------------------------------------------

def test_class_keeps_leading_zero(spark):
    assert one(spark, codes.class_of_activity("c"), c="111301") == "01113"
    assert one(spark, codes.class_of_activity("c"), c="4711301") == "47113"
    assert one(spark, codes.class_key("c"), c="1113") == "01113"


def test_flags_compare_as_text(spark):
    for text, expected in [
        ("2", True), ("02", True), (" 2", True), ("002", True), ("x", False), ("20", False), ("021", False), ("", False),
    ]:
        assert one(spark, codes.flag_is("f", 2), f=text) is expected
    assert one(spark, codes.flag_is("f", 2), f=None) is None


@pytest.mark.parametrize("years, label", [
    (20.0, "Setor Maduro (20+ anos)"), (19.999, "Setor Estabelecido (10-20 anos)"), (10.0, "Setor Estabelecido (10-20 anos)"),
    (9.999, "Setor Emergente (5-10 anos)"), (5.0, "Setor Emergente (5-10 anos)"), (4.999, "Setor Novo (< 5 anos)"),
])
def test_maturity_bands(spark, years, label):
    assert one(spark, measures.maturity_band(F.lit(years)), x="") == label


def test_ratios_of_zero_are_null(spark):
    df = spark.createDataFrame([(1, 0), (5, 2)], "a bigint, b bigint")
    assert rows(df.select(measures.ratio("a", "b", 2), measures.percent_change("a", "b"))) == [(2.5, 150.0), (None, None)]


def test_weighted_mean_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1.5, 0), (2.5, 0)], "m double, n bigint")
    assert df.agg(measures.weighted_mean("m", "n")).first()[0] is None


# --- dedup and upsert -------------------------------------------------------------------------------

def test_latest_by_key_is_deterministic(spark):
    data = [("k", 1, "a"), ("k", 2, "b"), ("k", 2, "c"), (None, 1, "n"), (None, 3, "m")]
    for order in (data, data[::-1], data[2:] + data[:2]):
        df = spark.createDataFrame(order, "k string, t int, v string").repartition(3)
        assert rows(latest_by_key(df, ["k"], ["t"])) == [("k", 2, "c"), (None, 3, "m")]


def test_latest_by_key_with_a_hot_key(spark):
    df = spark.range(0, 50_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("t")
    )
    latest = latest_by_key(df, ["k"], ["t"])
    assert latest.count() == 33_334 and latest.filter("k = 'hot'").first()["t"] == 49_998


def test_merged_null_keys(spark):
    target = spark.createDataFrame([(None, 1, "old"), (1, None, "old")], "a int, b int, v string")
    source = spark.createDataFrame([(None, 1, "new"), (2, 2, "new")], "a int, b int, v string")
    once = merged(target, source, ["a", "b"])
    assert rows(once) == [(1, None, "old"), (2, 2, "new"), (None, 1, "new")]
    assert rows(merged(once, source, ["a", "b"])) == rows(once)
    assert merged(target, source, ["a", "b"], null_safe=False).count() == 4


def test_merged_keeps_columns_the_source_lacks(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, extra string")
    source = spark.createDataFrame([(1, "A"), (3, "C")], "k int, v string")
    assert rows(merged(target, source, ["k"])) == [(1, "A", "x"), (2, "b", "y"), (3, "C", None)]


def test_merged_out_of_order(spark):
    target = spark.createDataFrame([(1, 5, "new"), (2, 1, "old")], "k int, t int, v string")
    source = spark.createDataFrame([(1, 4, "late"), (2, 1, "same"), (3, 0, "x")], "k int, t int, v string")
    assert rows(merged(target, source, ["k"], newer_by="t")) == [(1, 5, "new"), (2, 1, "same"), (3, 0, "x")]


def test_two_loads_equal_one(spark):
    rng = random.Random(7)
    loads = [[(rng.randrange(40), t * 100 + i, rng.random()) for i in range(60)] for t in range(2)]
    schema = "k int, t int, v double"

    def latest(lines):
        return latest_by_key(spark.createDataFrame(lines, schema), ["k"], ["t"])

    assert rows(merged(latest(loads[0]), latest(loads[1]), ["k"])) == rows(latest(loads[0] + loads[1]))


def test_accumulated(spark):
    schema = "table_name string, last_ingestion_timestamp int, last_update int, records_processed bigint, execution_id string"
    target = spark.createDataFrame([("a", 1, 1, 10, "r1"), ("b", 1, 1, 5, "r1")], schema)
    update = spark.createDataFrame([("a", 3, 2, 7, "r2"), ("c", 3, 2, 1, "r2")], schema)
    result = accumulated(target, update, ["table_name"], ["records_processed"], "last_update")
    assert rows(result) == [("a", 3, 2, 17, "r2"), ("b", 1, 1, 5, "r1"), ("c", 3, 2, 1, "r2")]


PARTITIONED = "k int, uf string, v string"


def test_upsert_table_moves_rows_between_partitions(spark, tmp_path):
    def up(*lines):
        return upsert_table(
            spark, "moved", spark.createDataFrame(list(lines), PARTITIONED), ["k"], str(tmp_path / "t"), ["uf"]
        )

    assert up((1, "SP", "a"), (2, "RJ", "b"), (3, None, "c"), (4, "MG", "d")) == "created"
    assert up((2, "SP", "B"), (3, "", "C"), (5, "RS", "e")) == "updated"  # RJ becomes empty
    now = [(1, "SP", "a"), (2, "SP", "B"), (3, None, "C"), (4, "MG", "d"), (5, "RS", "e")]
    assert rows(spark.table("moved"), "k", "uf", "v") == now
    up((2, "SP", "B"), (3, None, "C"))
    assert rows(spark.table("moved"), "k", "uf", "v") == now
    up((3, "RJ", "x"), (2, "RJ", "y"))  # the null partition becomes empty, RJ returns
    assert rows(spark.table("moved"), "k", "uf", "v") == [
        (1, "SP", "a"), (2, "RJ", "y"), (3, "RJ", "x"), (4, "MG", "d"), (5, "RS", "e")
    ]


def test_upsert_table_rewrites_only_touched_partitions(spark, tmp_path):
    schema = "ano int, mes int, k int, v string"

    def up(*lines):
        upsert_table(spark, "months", spark.createDataFrame(list(lines), schema), ["ano", "mes", "k"],
                     str(tmp_path / "m"), ["ano", "mes"])

    up((2023, 1, 1, "a"), (2023, 2, 1, "b"), (2024, 1, 1, "c"))
    before = {f for f in spark.table("months").inputFiles()}
    up((2023, 2, 1, "B"), (2023, 2, 2, "new"))
    after = {f for f in spark.table("months").inputFiles()}
    assert {f for f in before if "mes=2" not in f} <= after
    assert rows(spark.table("months"), "ano", "mes", "k", "v") == [
        (2023, 1, 1, "a"), (2023, 2, 1, "B"), (2023, 2, 2, "new"), (2024, 1, 1, "c")
    ]


def test_save_table_replaces_schema_and_location(spark, tmp_path):
    path = str(tmp_path / "s")
    sinks.save_table(spark, spark.createDataFrame([(1,)], "a int"), "saved", path)
    first = sinks.table_location(spark, "saved")
    sinks.save_table(spark, spark.createDataFrame([("x", 2)], "b string, c int"), "saved", path)
    assert spark.table("saved").columns == ["b", "c"] and sinks.table_location(spark, "saved") != first
    assert sinks.path_exists(spark, path) and not sinks.path_exists(spark, path + "-none")


def test_empty_table_keeps_comments(spark, tmp_path):
    sinks.create_empty(spark, "control_c", str(tmp_path / "c"), CONTROL_SCHEMA)
    sinks.create_empty(spark, "control_c", str(tmp_path / "c"), CONTROL_SCHEMA)
    assert spark.table("control_c").schema["records_processed"].metadata["comment"].startswith("rows")


# --- watermark --------------------------------------------------------------------------------------

def test_watermark_and_overlap(spark):
    day = [dt.datetime(2024, 1, d) for d in range(1, 5)]
    control = spark.createDataFrame(
        [("t", day[1], day[2], 5, "r1"), ("t", day[0], day[1], 5, "r0"), ("u", day[3], day[3], 1, "r1")], CONTROL_SCHEMA
    )
    assert last_watermark(control, "t") == day[1] and last_watermark(control, "new") is None
    df = spark.createDataFrame([(d, d.date()) for d in day], "_ingestion_timestamp timestamp, _ingestion_date date")
    assert new_rows(df, None).count() == 4 and new_rows(df, day[1]).count() == 2
    assert new_rows(df, day[1], overlap=dt.timedelta(hours=1), date_col="_ingestion_date").count() == 3


# --- trade ------------------------------------------------------------------------------------------

def test_one_sided_months_and_products(spark):
    df = facts(spark, ("EXP", 2023, 1, "A", "1", "SP", 100), ("IMP", 2023, 2, "B", "1", "SP", 30), ("EXP", 2023, 3, "A", "1", "SP", 50),
               ("IMP", 2023, 3, "A", "1", "SP", 20))
    d = [dt.date(2023, m, 1) for m in (1, 2, 3)]
    assert rows(trade.monthly_balance(df)) == [(d[0], 100, None, None), (d[1], None, 30, None), (d[2], 50, 20, 30)]
    assert rows(trade.date_dim(df), "DATA") == [(x,) for x in d]
    prices = trade.product_price(df)
    assert rows(prices, "CO_NCM", "VL_FOB_EXP", "PRECO_MEDIO_IMP") == [("A", 150, 2.0), ("B", 0, 3.0)]
    balance = geo.state_balance(df, explicit_top(spark, ["A", "B"]), spark.createDataFrame([], "sg_uf string, no_uf string, no_regiao string"))
    assert rows(balance, "co_ncm", "VL_FOB_EXP", "VL_FOB_IMP", "SALDO_COMERCIAL", "no_uf") == [
        ("A", 150.0, 20.0, 130.0, None), ("B", None, 30.0, -30.0, None)
    ]


def test_change_skips_months_without_trade(spark):
    df = facts(spark, ("EXP", 2022, 12, "A", "1", "SP", 100), ("EXP", 2023, 3, "A", "1", "SP", 150), ("EXP", 2023, 4, "A", "1", "SP", 0),
               ("EXP", 2023, 5, "A", "1", "SP", 10), ("IMP", 2023, 3, "A", "1", "SP", 7))
    assert rows(trade.product_mom(df), "DATA", "VAR_PERC_MES_EXP", "VL_FOB_IMP") == [
        (dt.date(2022, 12, 1), 0.0, 0), (dt.date(2023, 3, 1), 50.0, 7), (dt.date(2023, 4, 1), -100.0, 0), (dt.date(2023, 5, 1), 0.0, 0),
    ]


def test_share_of_all_years_or_of_the_year(spark):
    df = facts(spark, *[(f, y, 1, p, "1", "SP", v) for f in ("EXP", "IMP") for y, p, v in [(2022, "A", 60), (2022, "B", 20), (2023, "A", 20)]])
    ncm = spark.createDataFrame([("A", "1"), ("B", "2")], "co_ncm string, co_fat_agreg string")
    names = spark.createDataFrame([("1", "PRODUTOS BASICOS"), ("2", "X")], "co_fat_agreg string, no_fat_agreg string")
    columns = ("ANO", "NO_FAT_AGREG", "PERC_TOTAL_EXP")
    assert rows(trade.factor_share(df, ncm, names), *columns) == [(2022, "BASICOS", 60.0), (2022, "X", 20.0), (2023, "BASICOS", 20.0)]
    assert rows(trade.factor_share(df, ncm, names, ["ANO"]), *columns) == [(2022, "BASICOS", 75.0), (2022, "X", 25.0), (2023, "BASICOS", 100.0)]


def literal_top(values, per_list=5, total=10):
    """The list as one would choose it by hand."""
    by_e = sorted(values, key=lambda r: (-r[1], -r[2], r[0]))
    by_i = sorted(values, key=lambda r: (-r[2], -r[1], r[0]))
    chosen = {r[0]: "EXPORTAÇÃO" for r in by_e[:per_list]}
    for r in by_i[:per_list]:
        chosen.setdefault(r[0], "IMPORTAÇÃO")
    for ranking, origin in ((by_e, "EXPORTAÇÃO_EXTRA"), (by_i, "IMPORTAÇÃO_EXTRA")):
        for r in ranking:
            if len(chosen) < total:
                chosen.setdefault(r[0], origin)
    return sorted(chosen.items())


@pytest.mark.parametrize("n", [0, 1, 4, 5, 7, 10, 12, 200])
def test_refilled_top_equals_the_literal_procedure(spark, n):
    rng = random.Random(n)
    values = [(f"p{i:03d}", rng.randrange(20), rng.randrange(20)) for i in range(n)]
    df = spark.createDataFrame(values, "CO_NCM string, VL_FOB_EXP bigint, VL_FOB_IMP bigint").repartition(3)
    assert rows(refilled_top(df)) == literal_top(values)
    same = [(c, e, e) for c, e, _ in values]
    df = spark.createDataFrame(same, "CO_NCM string, VL_FOB_EXP bigint, VL_FOB_IMP bigint")
    assert rows(refilled_top(df)) == literal_top(same)
    assert rows(refilled_top(df, per_list=3, total=4)) == literal_top(same, 3, 4)


# --- geography --------------------------------------------------------------------------------------

def test_country_in_two_blocs_and_in_none(spark):
    df = facts(spark, ("EXP", 2023, 1, "A", "1", "SP", 10), ("EXP", 2023, 1, "A", "2", "SP", 5), ("IMP", 2023, 1, "A", "1", "SP", 3),
               ("EXP", 2023, 1, "Z", "1", "SP", 99))
    blocs = spark.createDataFrame([("1", "X"), ("1", "Y")], "co_pais string, no_bloco string")
    assert rows(geo.bloc_trade(df, explicit_top(spark, ["A"]), blocs)) == [
        ("X", "A", 10, "EXPORTACAO"), ("X", "A", 3, "IMPORTACAO"), ("Y", "A", 10, "EXPORTACAO"), ("Y", "A", 3, "IMPORTACAO"),
        (None, "A", 5, "EXPORTACAO"),
    ]


def test_countries_are_ranked_only_on_request(spark):
    df = facts(spark, *[("EXP", 2023, 1, "A", str(c), "SP", c) for c in range(15)])
    countries = spark.createDataFrame([(str(c), f"c{c}") for c in range(14)], "co_pais string, no_pais string")
    top = explicit_top(spark, ["A"])
    assert geo.country_trade(df, top, countries, "v").count() == 15
    best = geo.country_trade(df, top, countries, "v", k=3).collect()
    assert [(r["no_pais"], r["v"]) for r in best] == [(None, 14), ("c13", 13), ("c12", 12)]


# --- bridge and companies -----------------------------------------------------------------------------

BRIDGE = [("1", "a", "0111-3; 4711-3"), ("2", "b", "abc"), ("3", "c", ""), ("4", "d", None), ("5", "e", "47.11-3 x;0111-3;0111-3")]


def test_bridge_pairs(spark):
    pairs = bridge_pairs(spark.createDataFrame(BRIDGE, "NCM string, NCM_DESC string, CNAE string"))
    assert rows(pairs, "NCM", "CNAE") == [
        ("1", "01113"), ("1", "47113"), ("2", None), ("3", None), ("5", "01113"), ("5", "01113"), ("5", "47113")
    ]
    assert distinct_pairs(pairs.union(pairs)).count() == 6
    assert rows(keyed_pairs(pairs)) == [
        ("00000001", "01113"), ("00000001", "47113"), ("00000005", "01113"), ("00000005", "47113")
    ]


SITE = "cnpj_basico string, cnpj_ordem string, identificador_matriz_filial string, situacao_cadastral string, data_inicio_atividade date, cnae_fiscal_principal string, uf string"


def company_data(spark):
    d = dt.date
    sites = spark.createDataFrame([
        ("A", "1", "1", "02", d(2014, 1, 1), "111301", "SP"), ("A", "2", "2", "2", d(2018, 1, 1), "0111302", "SP"),
        ("A", "3", "2", "02", d(2020, 1, 1), "0111301", "RJ"), ("B", "1", "1", "02", d(1994, 1, 1), "4711301", "SP"),
        ("C", "1", "1", "08", d(2000, 1, 1), "0111301", "SP"), ("D", "1", "01", "02", None, "0111301", "SP"),
        ("E", "1", "1", "02", d(2023, 1, 1), "0111301", None), ("F", "1", "1", "x", d(2023, 1, 1), "0111301", "SP"),
        ("G", "1", "1", "02", d(2023, 1, 1), "9999999", "SP"),
    ], SITE)
    companies = spark.createDataFrame([("A", "1"), ("B", "05"), ("C", "01"), ("D", "01"), ("E", "01")], "cnpj_basico string, porte_empresa string")
    bridge = spark.createDataFrame([("00000001", "01113"), ("00000001", "47113"), ("00000002", "01113"), ("00000009", "99999")], "co_ncm string, classe string")
    df = facts(spark, ("EXP", 2023, 1, "00000001", "1", "SP", 100), ("EXP", 2023, 1, "00000002", "1", "SP", 10),
               ("IMP", 2023, 1, "00000002", "1", "SP", 7), ("EXP", 2023, 1, "00000009", "1", "SP", 500))
    return sites, companies, bridge, explicit_top(spark, ["00000001", "00000002"]), df


def test_company_fact(spark):
    sites, companies, bridge, top, df = company_data(spark)
    fact = company.company_fact(sites, companies, bridge, top, df, AS_OF)
    years = lambda *days: round(sum(days) / len(days) / 365.25, 2)
    age = [(AS_OF - dt.date(y, 1, 1)).days for y in (2014, 2018, 2020, 1994)]
    assert rows(fact, "codigo_cnae", "uf", "codigo_porte", "qtd_empresas", "qtd_matrizes", "longevidade_media_anos",
                "longevidade_max_anos", "volume_exportacao", "operacoes_exportacao", "volume_importacao") == [
        ("01113", "RJ", "01", 1, 0, years(age[2]), years(age[2]), 0, 0, 0),
        ("01113", "SP", "01", 2, 2, years(age[0], age[1]), years(age[0]), 110, 2, 7),
        ("47113", "SP", "05", 1, 1, years(age[3]), years(age[3]), 100, 1, 0),
    ]


def test_opportunities(spark):
    sites, _, bridge, top, df = company_data(spark)
    ncm = spark.createDataFrame([("00000001", "um")], "co_ncm string, no_ncm_por string")
    found = company.opportunities(df.filter("fluxo = 'EXP'"), top, bridge, sites, ncm, AS_OF)
    assert rows(found, "desc_ncm", "total_exportado", "qtd_empresas_habilitadas") == [("um", 100, 4), (None, 10, 3)]


def test_totals_per_class_repeat_trade_for_each_size(spark):
    fact = spark.createDataFrame(
        [("01113", "SP", "01", 2, 1, 4.0, 100, 1), ("01113", "SP", "05", 2, 1, 6.0, 100, 1), ("01113", "ZZ", "05", 4, 0, None, 0, 0)],
        "codigo_cnae string, uf string, codigo_porte string, qtd_empresas bigint, qtd_matrizes bigint, longevidade_media_anos double, volume_exportacao bigint, volume_importacao bigint",
    )
    classes = company.class_dim(spark.createDataFrame([("111301", "b"), ("0111302", "a")], "codigo_cnae string, descricao_cnae string"))
    assert rows(classes) == [("01113", "a", "01", 2)]
    assert rows(company.class_age(fact, classes), "total_empresas", "volume_exportacao_total", "longevidade_media_anos") == [(8, 200, 2.5)]
    states = spark.createDataFrame([("SP", "São Paulo", "SUDESTE", "41")], "sg_uf string, no_uf string, no_regiao string, co_uf string")
    assert rows(company.companies_by_state(fact, states), "uf", "total_empresas", "longevidade_media") == [("SP", 4, 5.0)]


def test_ranking_leaves_out_the_undeclared_region(spark):
    fact = spark.createDataFrame(
        [(f"{i:05d}", uf, "01", 50 - i // 2, 1, 1.0) for i in range(12) for uf in ("SP", "ND")],
        "codigo_cnae string, uf string, codigo_porte string, qtd_empresas bigint, qtd_matrizes bigint, longevidade_media_anos double",
    )
    states = spark.createDataFrame([("SP", "a", "S", "1"), ("ND", "b", company.UNDECLARED_REGION, "2")], "sg_uf string, no_uf string, no_regiao string, co_uf string")
    classes = spark.createDataFrame([(f"{i:05d}", "x", "00") for i in range(12)], "codigo_cnae string, descricao_cnae string, cnae_divisao string")
    ranked = company.top_classes_by_region(fact, states, classes)
    assert rows(ranked, "no_regiao", "ranking", "codigo_cnae") == sorted([("S", i + 1, f"{i:05d}") for i in range(10)], key=repr)


def test_coverage_distinct_and_weighted(spark):
    df = facts(spark, ("EXP", 2023, 1, "1", "1", "SP", 600), ("EXP", 2023, 1, "2", "1", "SP", 400), ("EXP", 2022, 1, "2", "1", "SP", 9999))
    pairs = spark.createDataFrame([("1", "a"), ("1", "b"), ("7", "c")], "NCM string, CNAE string")
    once = audit.bridge_value_coverage(df, pairs)
    assert rows(once, "perc_fob_com_match_ncm", "perc_fob_sem_match_ncm") == [(60.0, 40.0)]
    assert audit.meets_target(once).first()["aprovado"] is False
    assert rows(audit.bridge_value_coverage(df, pairs, weighted=True), "perc_fob_com_match_ncm") == [(75.0,)]
    assert rows(audit.bridge_code_coverage(df, pairs), "Metrica", "Valor") == [
        ("Cobertura de Produtos (NCMs)", 50.0), ("Média de CNAEs por Produto", 1.5)
    ]


def test_tagged_flows(spark):
    a = spark.createDataFrame([(1, "x")], "v int, other string")
    assert rows(tag_flows(a, a, ["v"])) == [("EXP", 1), ("IMP", 1)]


# --- hot keys ---------------------------------------------------------------------------------------

def test_frequent_keys(spark):
    from aduana.plans.audit import frequent_keys

    sites = spark.range(0, 9000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 500).alias("k")
    )
    assert rows(frequent_keys(sites, "k", 0.2)) == [(7,)]


def test_reports_agree_when_one_product_holds_most_rows(spark):
    rng = random.Random(3)
    lines = [
        ("EXP" if rng.random() < 0.6 else "IMP", 2023, rng.randrange(1, 13), "00000001" if rng.random() < 0.7 else f"{rng.randrange(2, 60):08d}",
         str(rng.randrange(4)), rng.choice(["SP", "RJ"]), rng.randrange(1000))
        for _ in range(3000)
    ]
    df = facts(spark, *lines).repartition(8)
    expected = Counter()
    for flow, _, _, product, country, _, value in lines:
        if flow == "EXP" and product == "00000001":
            expected[country] += value
    countries = spark.createDataFrame([(str(c), str(c)) for c in range(4)], "co_pais string, no_pais string")
    got = geo.country_trade(df.filter("fluxo = 'EXP'"), explicit_top(spark, ["00000001"]), countries, "v")
    assert {r["no_pais"]: r["v"] for r in got.collect()} == dict(expected)


def test_archives_of_any_name_and_broken_ones(spark, tmp_path):
    import zipfile

    from aduana.sources.archives import archive_blocks, archive_lines, lines_of
    from aduana.sources.inventory import binary_files

    for name in ("T 1.zip", "Situação0.zip", "T%20[2].zip"):
        with zipfile.ZipFile(tmp_path / name, "w") as archive:
            archive.writestr("a.csv", "1;x\r\n\r\n1;ação\rz\n".encode("ISO-8859-1"))
            archive.writestr("b.csv", "2;z" * 900_000)
            archive.writestr("folder/", "")
    expected = [("a.csv", "1;x"), ("a.csv", "1;ação"), ("a.csv", "z"), ("b.csv", "2;z" * 900_000)]
    lines = archive_lines(binary_files(spark, str(tmp_path)))
    assert rows(lines, "member", "line") == sorted(expected * 3, key=repr)
    (tmp_path / "broken.zip").write_bytes(b"PK no")
    blocks = archive_blocks(binary_files(spark, str(tmp_path)))
    assert blocks.filter("error is not null").count() == 1
    assert lines_of(blocks).count() == 12
    with pytest.raises(Exception, match="broken.zip"):
        archive_lines(binary_files(spark, str(tmp_path))).collect()


# --- partitions by location -----------------------------------------------------------------------

def _moved_table(spark, tmp_path, name):
    from aduana.operators.upsert import staged, upsert_table

    first = spark.createDataFrame([(1, "a b", 1), (2, "a b", 1), (3, "c'ç", 1), (4, None, 1)], "k int, p string, v int")
    second = spark.createDataFrame([(1, "c'ç", 2), (2, "c'ç", 2), (4, "x=y", 2), (5, "", 2)], "k int, p string, v int")
    path = str(tmp_path / "table")
    upsert_table(spark, name, staged(spark, first, "first"), ["k"], path, ["p"])
    return lambda: upsert_table(spark, name, staged(spark, second, "second"), ["k"], path, ["p"]), path


MOVED = [(1, "c'ç", 2), (2, "c'ç", 2), (3, "c'ç", 1), (4, "x=y", 2), (5, None, 2)]


def test_moved_rows_are_there_once_after_a_repair(spark, tmp_path):
    upsert, path = _moved_table(spark, tmp_path, "moved_rows")
    for _ in range(2):
        upsert()
        assert rows(spark.table("moved_rows"), "k", "p", "v") == sorted(MOVED, key=repr)
        spark.catalog.recoverPartitions("moved_rows")
        assert rows(spark.table("moved_rows"), "k", "p", "v") == sorted(MOVED, key=repr)
    from aduana.operators.sinks import remove_old_snapshots

    remove_old_snapshots(spark, "moved_rows", path)
    spark.catalog.refreshTable("moved_rows")
    assert rows(spark.table("moved_rows"), "k", "p", "v") == sorted(MOVED, key=repr)


@pytest.mark.parametrize("calls", range(6))
def test_interrupted_swap_is_repeated(spark, tmp_path, monkeypatch, calls):
    """The swap breaks off after some catalog calls; the same upsert then brings the table right."""
    name = f"interrupted_{calls}"
    upsert, _ = _moved_table(spark, tmp_path, name)
    session, left = type(spark), [calls]
    plain = session.sql

    def failing(self, text, *args, **kwargs):
        if text.startswith("ALTER TABLE"):
            if not left[0]:
                raise RuntimeError("lost")
            left[0] -= 1
        return plain(self, text, *args, **kwargs)

    monkeypatch.setattr(session, "sql", failing)
    try:
        upsert()
    except RuntimeError:
        pass
    monkeypatch.undo()
    spark.catalog.refreshTable(name)
    upsert()
    assert rows(spark.table(name), "k", "p", "v") == sorted(MOVED, key=repr)


def test_null_keys_with_newer_by(spark):
    target = spark.createDataFrame([(None, 1), (1, 5)], "k int, t int")
    source = spark.createDataFrame([(None, 2), (1, 4), (2, 1)], "k int, t int")
    assert rows(merged(target, source, ["k"], newer_by="t")) == sorted([(None, 2), (1, 5), (2, 1)], key=repr)
    assert rows(merged(target, source, ["k"], null_safe=False, newer_by="t")) == sorted(
        [(None, 1), (None, 2), (1, 5), (2, 1)], key=repr
    )


def test_old_snapshots_go(spark, tmp_path):
    from aduana.operators.sinks import remove_old_snapshots, save_table

    path = str(tmp_path / "snapshots")
    for n in (1, 2, 3):
        save_table(spark, spark.range(n), "snapshots_of", path)
    assert len(remove_old_snapshots(spark, "snapshots_of", path)) == 2
    assert spark.table("snapshots_of").count() == 3


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from aduana import session

    conf = SimpleNamespace(get=lambda *a: None)
    for master, local in (("local[4]", True), ("local", True), ("yarn", False), ("local-cluster[2,1,512]", False)):
        fake = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))
        if local:
            assert session.shared_folder(fake)
        else:
            with pytest.raises(ValueError, match="spark.checkpoint.dir"):
                session.shared_folder(fake)


def test_working_copies_are_deleted(spark):
    import os

    from aduana.operators.upsert import staged
    from aduana.session import _made, clean_up

    staged(spark, spark.range(1), "gone")
    staged(spark, spark.range(1), "kept")
    gone, kept = (p.removeprefix("file:") for p in _made[-2:])
    assert os.path.exists(gone)
    clean_up(spark, keep=tuple(_made[:-2]) + (_made[-1],))
    assert not os.path.exists(gone) and os.path.exists(kept)
