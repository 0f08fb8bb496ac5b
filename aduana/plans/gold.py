"""Typed tables to the dashboard tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from aduana.operators.flows import EXPORT, IMPORT, of_flow, summed, tag_flows
from aduana.operators.sinks import ensure_database, save_table
from aduana.operators.topk import refilled_top
from aduana.operators.upsert import staged
from aduana.plans import audit, company, geo, trade as t
from aduana.sources.bridge import distinct_pairs, keyed_pairs
from aduana.sources.tables import size_dim

FACT_COLUMNS = ["ano", "mes", "co_ncm", "co_pais", "sigla_uf_ncm", "co_via", "kg_liquido", "vl_fob"]
WRITTEN_AT = "_gold_insert_ts"

# Names of the dashboard tables, in the order in which they are built.
DASHBOARD_TABLES = [
    "dim_ncm",
    "dim_data",
    "view_painel1_vol_exp_imp_saldo",
    "view_painel1_pct_exp_imp",
    "view_painel1_pct_fat_agreg",
    "view_painel2_ncm_fob_preco_med",
    "view_painel2_ncm_var_mes",
    "view_painel3_rank_exportacao_pais",
    "view_painel3_rank_importacao_pais",
    "view_painel3_comercio_bloco",
    "view_painel3_saldo_comercial_uf",
    "view_painel3_volume_exp",
    "view_painel3_volume_imp",
    "view_painel4_dim_ncm_top10",
    "view_painel4_bridge_top10",
    "view_painel4_empresas_uf",
    "view_painel4_perfil_porte",
    "view_painel4_cnaes_por_regiao",
    "view_painel4_longevidade_cnae",
    "view_painel5_oportunidades",
]
#: Order of the files of a table: what its reports ask for first, and a key to tell equals apart.
#: A minus sign stands for descending.
ORDERS = {
    "view_painel2_ncm_var_mes": ["CO_NCM", "DATA"],
    "view_painel3_rank_exportacao_pais": ["-valor_exportado", "produto_ncm", "no_pais"],
    "view_painel3_rank_importacao_pais": ["-valor_importado", "produto_ncm", "no_pais"],
    "view_painel4_dim_ncm_top10": ["co_ncm"],
    "view_painel4_empresas_uf": ["-total_empresas", "codigo_cnae", "uf"],
    "view_painel4_perfil_porte": ["codigo_cnae", "codigo_porte"],
    "view_painel4_cnaes_por_regiao": ["no_regiao", "ranking"],
    "view_painel4_longevidade_cnae": ["-longevidade_media_anos", "codigo_cnae"],
    "view_painel5_oportunidades": ["-total_exportado", "desc_ncm"],
}
AUDIT_TABLES = ["auditoria_bridge_codigos", "auditoria_bridge_valor"]


def dashboards(
    spark: SparkSession,
    silver: str,
    as_of: dt.date,
    top: DataFrame | None = None,
    audit_from: int = 2023,
) -> dict[str, DataFrame]:
    """The dashboard tables by name. `top` replaces the computed list of products.

    The facts are read twice: summed by month and product, which gives the top products among other
    things, and then those of the top products by country, state and route. What several tables share
    is written once to the shared folder.
    """
    def table(name: str) -> DataFrame:
        return spark.table(f"{silver}.{name}")

    trade = tag_flows(table("exp"), table("imp"), FACT_COLUMNS)
    months = staged(spark, summed(trade, ["ano", "mes", "co_ncm"]), "months")
    exports = of_flow(months, EXPORT)
    ncm, uf, via, pais = table("ncm"), table("uf"), table("via"), table("pais")
    sites = table("estabelecimentos")
    pairs = distinct_pairs(table("corr_ncm_cnae"))
    bridge = keyed_pairs(pairs)
    classes = company.class_dim(table("cnaes"))

    prices = staged(spark, t.product_price(months), "prices")
    top = staged(spark, refilled_top(prices) if top is None else top, "top")
    located = staged(
        spark, summed(geo.only_top(trade, top), ["co_ncm", "co_pais", "sigla_uf_ncm", "co_via"]), "located"
    )
    sent, received = of_flow(located, EXPORT), of_flow(located, IMPORT)
    fact = staged(
        spark,
        company.company_fact(sites, table("empresas"), bridge, top, located, as_of).withColumn(
            WRITTEN_AT, F.current_timestamp()
        ),
        "company-fact",
    )
    built = [
        t.product_dim(ncm),
        t.date_dim(months),
        t.monthly_balance(months),
        t.yearly_totals(months),
        t.factor_share(months, ncm, table("ncm_fat_agreg")),
        prices,
        t.product_mom(months),
        geo.country_trade(sent, top, pais, "valor_exportado"),
        geo.country_trade(received, top, pais, "valor_importado"),
        geo.bloc_trade(located, top, table("pais_bloco")),
        geo.state_balance(located, top, uf),
        geo.route_volume(sent, top, via, "exp"),
        geo.route_volume(received, top, via, "imp"),
        company.top_product_dim(top, ncm),
        company.top_bridge(bridge, top),
        company.companies_by_state(fact, uf),
        company.size_profile(fact, size_dim(spark)),
        company.top_classes_by_region(fact, uf, classes),
        company.class_age(fact, classes),
        company.opportunities(exports, top, bridge, sites, ncm, as_of),
    ]
    audits = [
        audit.bridge_code_coverage(exports, pairs),
        audit.bridge_value_coverage(exports, pairs, audit_from),
    ]
    return dict(zip(DASHBOARD_TABLES + AUDIT_TABLES, built + audits, strict=True))


def build_gold(
    spark: SparkSession,
    silver: str,
    gold: str,
    base_path: str,
    as_of: dt.date,
    top: DataFrame | None = None,
    audit_from: int = 2023,
) -> list[str]:
    """Write and register every dashboard table; returns their names."""
    ensure_database(spark, gold)
    tables = dashboards(spark, silver, as_of, top, audit_from)
    for name, df in tables.items():
        save_table(spark, df, f"{gold}.{name}", f"{base_path}/{name}", order=ORDERS.get(name))
    return list(tables)
