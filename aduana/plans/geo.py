"""Trade of the top products by country, bloc, state and transport route.

Every report keeps only the top products first and adds names last. No join here carries a
broadcast hint: the computed top list brings its own, as its length is fixed, and Spark
broadcasts any other list or name table only when it knows it to be small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aduana.operators.flows import EXPORT, FLOW, IMPORT, flow_sum

# Flow labels of the bloc report.
OPERATION = {EXPORT: "EXPORTACAO", IMPORT: "IMPORTACAO"}


def only_top(facts: DataFrame, top: DataFrame) -> DataFrame:
    """Facts of the chosen products."""
    return facts.join(top.select(F.col("CO_NCM").alias("co_ncm")), "co_ncm", "left_semi")


def country_trade(
    facts: DataFrame, top: DataFrame, countries: DataFrame, value: str, k: int | None = None
) -> DataFrame:
    """Value per country and top product. All rows by default; `k` keeps the largest."""
    totals = only_top(facts, top).groupBy("co_pais", "co_ncm").agg(F.sum("vl_fob").alias(value))
    named = totals.join(countries.select("co_pais", "no_pais"), "co_pais", "left").select(
        "no_pais", F.col("co_ncm").alias("produto_ncm"), value
    )
    if k is None:
        return named
    return named.orderBy(F.desc_nulls_last(value), "produto_ncm", "no_pais").limit(k)


def bloc_trade(trade: DataFrame, top: DataFrame, blocs: DataFrame) -> DataFrame:
    """Value per bloc, top product and flow. A country in several blocs counts in each of them,
    so the rows do not add up to the total; a country in none counts under a null bloc.

    Facts are summed per country before the blocs multiply them.
    """
    per_country = (
        only_top(trade, top).groupBy(FLOW, "co_pais", "co_ncm").agg(F.sum("vl_fob").alias("vl_fob"))
    )
    operation = F.when(F.col(FLOW) == EXPORT, OPERATION[EXPORT]).otherwise(OPERATION[IMPORT])
    return (
        per_country.join(blocs.select("co_pais", F.col("no_bloco").alias("NO_BLOCO")), "co_pais", "left")
        .groupBy("NO_BLOCO", "co_ncm", FLOW)
        .agg(F.sum("vl_fob").alias("valor_fob"))
        .select("NO_BLOCO", "co_ncm", "valor_fob", operation.alias("tipo_operacao"))
    )


def state_balance(trade: DataFrame, top: DataFrame, states: DataFrame) -> DataFrame:
    """Exports, imports and balance per state and top product; a missing flow is null in its own
    column and zero in the balance."""
    totals = only_top(trade, top).groupBy("sigla_uf_ncm", "co_ncm").agg(
        flow_sum("vl_fob", EXPORT).alias("e"), flow_sum("vl_fob", IMPORT).alias("i")
    )
    balance = F.coalesce(F.col("e"), F.lit(0)) - F.coalesce(F.col("i"), F.lit(0))
    names = states.select(F.col("sg_uf").alias("sigla_uf_ncm"), "no_uf", "no_regiao")
    return totals.join(names, "sigla_uf_ncm", "left").select(
        "sigla_uf_ncm",
        "co_ncm",
        "no_uf",
        "no_regiao",
        F.col("e").cast("double").alias("VL_FOB_EXP"),
        F.col("i").cast("double").alias("VL_FOB_IMP"),
        balance.cast("double").alias("SALDO_COMERCIAL"),
    )


def route_volume(facts: DataFrame, top: DataFrame, routes: DataFrame, suffix: str) -> DataFrame:
    """Weight and value per transport route and top product, columns `kg_<suffix>`, `vl_fob_<suffix>`."""
    totals = only_top(facts, top).groupBy("co_via", "co_ncm").agg(
        F.sum("kg_liquido").cast("double").alias(f"kg_{suffix}"),
        F.sum("vl_fob").cast("double").alias(f"vl_fob_{suffix}"),
    )
    return totals.join(routes.select("co_via", F.col("no_via").alias("NO_VIA")), "co_via", "left")
