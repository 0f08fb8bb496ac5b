"""Trade reports: balance, industrialisation share, prices, month-over-month change, top products.

`trade` is the tagged fact table of `operators.flows`: fluxo, ano, mes, co_ncm, vl_fob,
kg_liquido and whatever else a report needs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from aduana.functions.measures import month_start, percent, percent_change, ratio
from aduana.operators.flows import EXPORT, IMPORT, flow_rows, flow_sum, of_flow


def product_dim(ncm: DataFrame) -> DataFrame:
    return ncm.select(F.col("co_ncm").alias("CO_NCM"), F.col("no_ncm_por").alias("NO_NCM_POR")).distinct()


def date_dim(trade: DataFrame, flow: str | None = None) -> DataFrame:
    """Months with trade in either flow, or in the one named."""
    months = (of_flow(trade, flow) if flow else trade).select(F.col("ano").alias("ANO"), F.col("mes").alias("MES")).distinct()
    return months.withColumn("DATA", month_start("ANO", "MES"))


def monthly_balance(trade: DataFrame) -> DataFrame:
    """Exports, imports and their difference per month; null where a flow is missing."""
    return (
        trade.groupBy("ano", "mes")
        .agg(flow_sum("vl_fob", EXPORT).alias("VL_FOB_EXP"), flow_sum("vl_fob", IMPORT).alias("VL_FOB_IMP"))
        .select(
            month_start("ano", "mes").alias("DATA"),
            "VL_FOB_EXP",
            "VL_FOB_IMP",
            (F.col("VL_FOB_EXP") - F.col("VL_FOB_IMP")).alias("VL_SALDO_COMERCIAL"),
        )
    )


def yearly_totals(trade: DataFrame) -> DataFrame:
    return trade.groupBy(F.col("ano").alias("ANO")).agg(
        flow_sum("vl_fob", EXPORT).alias("VL_FOB_EXP"), flow_sum("vl_fob", IMPORT).alias("VL_FOB_IMP")
    )


def _total_of(rows: DataFrame, within: list[str] | None) -> Callable[[str], Column]:
    """Total of a column: a small window within groups, else a field of one scalar subquery.

    The subquery adds up every measure, used or not, so that it asks for the very aggregate the
    report itself needs and Spark computes that once.
    """
    if within:
        return lambda value: F.sum(value).over(Window.partitionBy(*within))
    measures = [c for c in rows.columns if c not in ("ANO", "no_fat_agreg")]
    totals = rows.agg(F.struct(*[F.sum(c).alias(c) for c in measures])).scalar()
    return lambda value: totals.getField(value)


def factor_share(
    trade: DataFrame, ncm: DataFrame, factors: DataFrame, within: list[str] | None = None
) -> DataFrame:
    """Value per year and industrialisation factor with its percentage of the total.

    `within=None` relates each row to all years together; `within=["ANO"]` to its own year.
    Facts are reduced to one row per year and product before the product table is joined.
    """
    per_product = trade.groupBy("ano", "co_ncm").agg(
        flow_sum("vl_fob", EXPORT).alias("e"),
        flow_sum("vl_fob", IMPORT).alias("i"),
        flow_rows(EXPORT).alias("ne"),
        flow_rows(IMPORT).alias("ni"),
    )
    factor_of = ncm.select("co_ncm", "co_fat_agreg").join(
        factors.select("co_fat_agreg", "no_fat_agreg"), "co_fat_agreg"
    )
    per_factor = (
        per_product.join(factor_of.select("co_ncm", "no_fat_agreg"), "co_ncm")
        .groupBy(F.col("ano").alias("ANO"), "no_fat_agreg")
        .agg(
            F.sum("e").alias("VL_FOB_EXP"),
            F.sum("i").alias("VL_FOB_IMP"),
            F.sum("ne").alias("ne"),
            F.sum("ni").alias("ni"),
        )
    )
    label = F.trim(F.regexp_replace("no_fat_agreg", "PRODUTOS", ""))
    total = _total_of(per_factor, within)
    return (
        per_factor.withColumn("PERC_TOTAL_EXP", percent("VL_FOB_EXP", total("VL_FOB_EXP")))
        .withColumn("PERC_TOTAL_IMP", percent("VL_FOB_IMP", total("VL_FOB_IMP")))
        .filter((F.col("ne") > 0) & (F.col("ni") > 0))
        .select(
            "ANO", label.alias("NO_FAT_AGREG"), "VL_FOB_EXP", "PERC_TOTAL_EXP", "VL_FOB_IMP", "PERC_TOTAL_IMP"
        )
    )


def product_price(trade: DataFrame) -> DataFrame:
    """Value, weight and mean price per product and flow; a missing flow counts as zero."""
    totals = trade.groupBy(F.col("co_ncm").alias("CO_NCM")).agg(
        flow_sum("vl_fob", EXPORT).alias("VL_FOB_EXP"),
        flow_sum("kg_liquido", EXPORT).alias("KG_LIQUIDO_EXP"),
        flow_sum("vl_fob", IMPORT).alias("VL_FOB_IMP"),
        flow_sum("kg_liquido", IMPORT).alias("KG_LIQUIDO_IMP"),
    )
    columns = [F.col("CO_NCM")]
    for flow in (EXPORT, IMPORT):
        value, weight = f"VL_FOB_{flow}", f"KG_LIQUIDO_{flow}"
        price = ratio(value, weight, 2)
        columns += [
            F.coalesce(F.col(value), F.lit(0)).alias(value),
            F.coalesce(F.col(weight), F.lit(0)).alias(weight),
            F.coalesce(price, F.lit(0.0)).alias(f"PRECO_MEDIO_{flow}"),
        ]
    return totals.select(*columns)


def product_month(trade: DataFrame) -> DataFrame:
    """Value per month, product and flow; null where a flow is missing."""
    return trade.groupBy("ano", "mes", F.col("co_ncm").alias("CO_NCM")).agg(
        flow_sum("vl_fob", EXPORT).alias("VL_FOB_EXP"), flow_sum("vl_fob", IMPORT).alias("VL_FOB_IMP")
    )


def product_mom(trade: DataFrame) -> DataFrame:
    """Change against the product's previous traded month; a month without trade is skipped.

    The window sees at most one row per product and month, whatever the size of the facts.
    """
    by_product = Window.partitionBy("CO_NCM").orderBy("ano", "mes")
    columns = [month_start("ano", "mes").alias("DATA"), F.col("CO_NCM")]
    for flow in (EXPORT, IMPORT):
        value = f"VL_FOB_{flow}"
        change = percent_change(value, F.lag(value).over(by_product))
        columns += [
            F.coalesce(F.col(value), F.lit(0)).alias(value),
            F.coalesce(change, F.lit(0.0)).alias(f"VAR_PERC_MES_{flow}"),
        ]
    return product_month(trade).select(*columns)
