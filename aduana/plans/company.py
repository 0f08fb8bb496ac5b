"""Company reports: activity classes, the company fact, profiles, rankings, opportunities.

Products reach activities through the bridge, given as distinct `(co_ncm, classe)` pairs under
normalised keys (`sources.bridge.keyed_pairs`). Facts and register are summed to a small key
before they meet the bridge or each other, so neither a hot product, a hot class nor a company
with very many sites reaches a single task row by row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from aduana.functions.codes import (
    class_of_activity,
    division_of_class,
    flag_is,
    joined_id,
    padded,
    product_key,
)
from aduana.functions.measures import days_since, maturity_band, mean_years, rounded, weighted_mean
from aduana.functions.typing import parsed
from aduana.operators.flows import EXPORT, FACTS, IMPORT, flow_rows, flow_sum
from aduana.plans.geo import only_top

ACTIVE = 2
HEADQUARTERS = 1
SIZE_WIDTH = 2
# Fixed value: region label of undeclared origin, left out of the regional ranking.
UNDECLARED_REGION = "REGIÃO NÃO DECLARADA"

TRADE_MEASURES = [
    "volume_exportacao", "kg_exportacao", "operacoes_exportacao",
    "volume_importacao", "kg_importacao", "operacoes_importacao",
]


def class_dim(activities: DataFrame) -> DataFrame:
    """Five-character classes with the description of their lowest activity code."""
    codes = (
        activities.filter(F.col("codigo_cnae").isNotNull())
        .groupBy("codigo_cnae")
        .agg(F.min("descricao_cnae").alias("descricao_cnae"))
        .select("codigo_cnae", "descricao_cnae", class_of_activity("codigo_cnae").alias("classe"))
    )
    return codes.groupBy("classe").agg(
        F.min_by("descricao_cnae", "codigo_cnae").alias("descricao_cnae"),
        F.count(F.lit(1)).alias("qtd_subclasses"),
    ).select(
        F.col("classe").alias("codigo_cnae"),
        "descricao_cnae",
        division_of_class("classe").alias("cnae_divisao"),
        "qtd_subclasses",
    )


def state_dim(states: DataFrame) -> DataFrame:
    return states.select("sg_uf", "no_uf", "no_regiao", "co_uf").distinct()


def product_labels(ncm: DataFrame) -> DataFrame:
    return ncm.select("co_ncm", "no_ncm_por", "no_ncm_ing", "co_sh6", "co_fat_agreg").distinct()


def _active_sites(sites: DataFrame) -> DataFrame:
    return sites.filter(flag_is("situacao_cadastral", ACTIVE)).withColumn(
        "classe", class_of_activity("cnae_fiscal_principal")
    )


def _padded(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, product_key(column))


def _top_pairs(bridge: DataFrame, top: DataFrame) -> DataFrame:
    return only_top(bridge, _padded(top, "CO_NCM"))


def _in_classes(sites: DataFrame, pairs: DataFrame) -> DataFrame:
    """Sites of the classes in `pairs`, whose keys are five digits (`keyed_pairs`): at most 100,000 of
    them are broadcast, and the sites, which crowd in a few classes, are not shuffled by them."""
    return sites.join(F.broadcast(pairs.select("classe").distinct()), "classe", "left_semi")


def _class_state_trade(trade: DataFrame, top: DataFrame, pairs: DataFrame) -> DataFrame:
    """Trade of the top products per class and state; value counts once per class of a product."""
    counted = FACTS if FACTS in trade.columns else None
    measures = [
        measure
        for flow in (EXPORT, IMPORT)
        for measure in (flow_sum("vl_fob", flow), flow_sum("kg_liquido", flow), flow_rows(flow, counted))
    ]
    per_product = (
        only_top(trade, top)
        .groupBy(product_key("co_ncm").alias("co_ncm"), F.col("sigla_uf_ncm").alias("uf"))
        .agg(*[measure.alias(name) for name, measure in zip(TRADE_MEASURES, measures)])
    )
    return per_product.join(pairs, "co_ncm").groupBy("classe", "uf").agg(
        *[F.sum(m).alias(m) for m in TRADE_MEASURES]
    )


def company_fact(
    sites: DataFrame,
    companies: DataFrame,
    bridge: DataFrame,
    top: DataFrame,
    trade: DataFrame,
    as_of: dt.date,
    days_per_year: float = 365.25,
    digits: int = 2,
) -> DataFrame:
    """Active companies of the top products' activities, per class, state and size.

    Ages are means over sites. Trade figures belong to the class and state and repeat for every
    size, so they must not be added up over sizes.
    """
    pairs = _top_pairs(bridge, top)
    days = days_since("data_inicio_atividade", as_of)
    located = F.col("uf").isNotNull() & F.col("cnae_fiscal_principal").isNotNull()
    per_company = (
        _in_classes(_active_sites(sites).filter(located), pairs)
        .groupBy("cnpj_basico", "classe", "uf")
        .agg(
            F.sum(days).alias("dias"),
            F.count(days).alias("n"),
            F.min(days).alias("menor"),
            F.max(days).alias("maior"),
            F.bool_or(flag_is("identificador_matriz_filial", HEADQUARTERS)).alias("matriz"),
        )
    )
    sizes = companies.select("cnpj_basico", padded("porte_empresa", SIZE_WIDTH).alias("codigo_porte"))
    # Already partitioned by company, so one row per company costs no further shuffle here.
    per_size = (
        per_company.join(sizes, "cnpj_basico")
        .groupBy("cnpj_basico", "classe", "uf", "codigo_porte")
        .agg(
            F.sum("dias").alias("dias"),
            F.sum("n").alias("n"),
            F.min("menor").alias("menor"),
            F.max("maior").alias("maior"),
            F.bool_or("matriz").alias("matriz"),
        )
    )
    fact = per_size.groupBy("classe", "uf", "codigo_porte").agg(
        F.count(F.lit(1)).alias("qtd_empresas"),
        F.count_if("matriz").alias("qtd_matrizes"),
        mean_years(F.sum("dias"), F.sum("n"), days_per_year, digits).alias("longevidade_media_anos"),
        mean_years(F.min("menor"), F.lit(1), days_per_year, digits).alias("longevidade_min_anos"),
        mean_years(F.max("maior"), F.lit(1), days_per_year, digits).alias("longevidade_max_anos"),
    )
    volumes = _class_state_trade(trade, top, pairs)
    return fact.join(volumes, ["classe", "uf"], "left").select(
        F.col("classe").alias("codigo_cnae"),
        "uf",
        "codigo_porte",
        "qtd_empresas",
        "qtd_matrizes",
        "longevidade_media_anos",
        "longevidade_min_anos",
        "longevidade_max_anos",
        *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in TRADE_MEASURES],
    )


def top_product_dim(top: DataFrame, ncm: DataFrame) -> DataFrame:
    """The top products with their description; products without one stay."""
    labels = only_top(ncm, top).select("co_ncm", "no_ncm_por").distinct()
    return (
        top.select(F.col("CO_NCM").alias("co_ncm"))
        .join(labels, "co_ncm", "left")
        .select("co_ncm", F.col("no_ncm_por").alias("descricao_ncm"))
    )


def top_bridge(bridge: DataFrame, top: DataFrame) -> DataFrame:
    return _top_pairs(bridge, top).select("co_ncm", F.col("classe").alias("codigo_cnae")).distinct()


def _company_totals():
    return [F.sum("qtd_empresas").alias("total_empresas"), F.sum("qtd_matrizes").alias("total_matrizes")]


def _mean_age():
    return weighted_mean("longevidade_media_anos", "qtd_empresas")


def companies_by_state(fact: DataFrame, states: DataFrame, digits: int = 2) -> DataFrame:
    """A company with sites in two states counts in both."""
    names = state_dim(states).select(F.col("sg_uf").alias("uf"), "no_uf", "no_regiao")
    return fact.join(names, "uf").groupBy("codigo_cnae", "uf", "no_uf", "no_regiao").agg(
        *_company_totals(), rounded(_mean_age(), digits).alias("longevidade_media")
    )


def size_profile(fact: DataFrame, sizes: DataFrame) -> DataFrame:
    return fact.join(sizes, "codigo_porte").groupBy("codigo_cnae", "codigo_porte", "descricao_porte").agg(
        *_company_totals()
    )


def top_classes_by_region(
    fact: DataFrame, states: DataFrame, classes: DataFrame, k: int = 10, digits: int = 2
) -> DataFrame:
    """The `k` classes with most companies in each declared region, ties by class."""
    regions = state_dim(states).select(F.col("sg_uf").alias("uf"), "no_regiao").filter(
        F.col("no_regiao").isNotNull() & (F.col("no_regiao") != UNDECLARED_REGION)
    )
    labels = classes.select("codigo_cnae", F.col("descricao_cnae").alias("nome_classe_cnae"), "cnae_divisao")
    totals = (
        fact.join(regions, "uf")
        .join(labels, "codigo_cnae")
        .groupBy("codigo_cnae", "nome_classe_cnae", "cnae_divisao", "no_regiao")
        .agg(*_company_totals(), rounded(_mean_age(), digits).alias("longevidade_media"))
    )
    best = Window.partitionBy("no_regiao").orderBy(F.desc("total_empresas"), "codigo_cnae")
    return totals.withColumn("ranking", F.row_number().over(best)).filter(F.col("ranking") <= k)


def class_age(fact: DataFrame, classes: DataFrame, digits: int = 2) -> DataFrame:
    """Mean company age per class with its maturity band. The trade totals add up the repeated
    figures of the company fact, as the report always has."""
    labels = classes.select("codigo_cnae", F.col("descricao_cnae").alias("nome_classe_cnae"), "cnae_divisao")
    return (
        fact.join(labels, "codigo_cnae")
        .groupBy("codigo_cnae", "nome_classe_cnae", "cnae_divisao")
        .agg(
            _mean_age().alias("media"),
            *_company_totals(),
            F.sum("volume_exportacao").alias("volume_exportacao_total"),
            F.sum("volume_importacao").alias("volume_importacao_total"),
        )
        .select(
            "codigo_cnae",
            "nome_classe_cnae",
            "cnae_divisao",
            rounded(F.col("media"), digits).alias("longevidade_media_anos"),
            "total_empresas",
            "total_matrizes",
            maturity_band(F.col("media")).alias("classificacao_maturidade"),
            "volume_exportacao_total",
            "volume_importacao_total",
        )
    )


def company_dim(sites: DataFrame, companies: DataFrame, cities: DataFrame) -> DataFrame:
    """Every site with its company and city. Row by row, so nothing can be summed beforehand; a
    company that holds very many sites is split by adaptive execution."""
    company = companies.select("cnpj_basico", "razao_social", "porte_empresa", "capital_social")
    city = cities.select(
        F.col("codigo_municipio").alias("_municipio"), F.col("descricao_municipio").alias("_cidade")
    )
    site = sites.select(
        "cnpj_basico", "cnpj_ordem", "cnpj_dv", "nome_fantasia", "cnae_fiscal_principal", "uf",
        "municipio", "situacao_cadastral", "data_inicio_atividade",
    )
    rows = site.join(company, "cnpj_basico", "left")
    return rows.join(city, F.col("municipio") == F.col("_municipio"), "left").select(
        "cnpj_basico",
        "cnpj_ordem",
        "cnpj_dv",
        joined_id("cnpj_basico", "cnpj_ordem", "cnpj_dv").alias("cnpj_completo"),
        "razao_social",
        "nome_fantasia",
        F.col("cnae_fiscal_principal").try_cast("int").alias("co_cnae"),
        "uf",
        F.col("_cidade").alias("municipio"),
        "porte_empresa",
        parsed(F.col("capital_social").cast("string"), "double").alias("capital_social"),
        F.col("situacao_cadastral").try_cast("int").alias("situacao_cadastral"),
        "data_inicio_atividade",
    )


def product_dim_wide(ncm: DataFrame, isic: DataFrame, cuci: DataFrame) -> DataFrame:
    """Products with their industry class and trade classification group."""
    return (
        ncm.select("co_ncm", "no_ncm_por", "co_isic_classe", "co_cuci_item")
        .join(isic.select("co_isic_classe", "no_isic_classe", "no_isic_secao"), "co_isic_classe", "left")
        .join(cuci.select("co_cuci_item", "no_cuci_grupo"), "co_cuci_item", "left")
        .select("co_ncm", "no_ncm_por", "co_isic_classe", "no_isic_classe", "no_isic_secao", "no_cuci_grupo")
    )


def opportunities(
    exports: DataFrame,
    top: DataFrame,
    bridge: DataFrame,
    sites: DataFrame,
    ncm: DataFrame,
    as_of: dt.date,
    days_per_year: float = 365,
    digits: int = 1,
) -> DataFrame:
    """Top products by export value with the active companies able to make them.

    Sites are summed per class and company before the bridge spreads them over products.
    """
    top = _padded(top, "CO_NCM")
    values = only_top(_padded(exports, "co_ncm"), top).groupBy("co_ncm").agg(
        F.sum("vl_fob").alias("total_exportado")
    )
    pairs = _top_pairs(bridge, top)
    days = days_since("data_inicio_atividade", as_of)
    per_company = (
        _in_classes(_active_sites(sites), pairs)
        .groupBy("classe", "cnpj_basico")
        .agg(F.sum(days).alias("dias"), F.count(days).alias("n"))
    )
    per_product = (
        per_company.join(pairs, "classe")
        .groupBy("co_ncm", "cnpj_basico")
        .agg(F.sum("dias").alias("dias"), F.sum("n").alias("n"))
        .groupBy("co_ncm")
        .agg(
            F.count("cnpj_basico").alias("qtd_empresas_habilitadas"),
            mean_years(F.sum("dias"), F.sum("n"), days_per_year, digits).alias("longevidade_media_anos"),
        )
    )
    labels = only_top(_padded(ncm, "co_ncm"), top).select("co_ncm", F.col("no_ncm_por").alias("desc_ncm"))
    return values.join(per_product, "co_ncm").join(labels, "co_ncm", "left").select(
        "desc_ncm", "total_exportado", "qtd_empresas_habilitadas", "longevidade_media_anos"
    )
