"""Quality of the product-to-activity bridge."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aduana.functions.codes import product_key
from aduana.functions.measures import percent

# Metric names and remarks of the coverage report.
CODE_COVERAGE = ("Cobertura de Produtos (NCMs)", "Alta")
COMPLEXITY = ("Média de CNAEs por Produto", "Complexidade N:N")
BILLION = 1_000_000_000
TARGET_PERCENT = 60


def _bridge_counts(pairs: DataFrame) -> DataFrame:
    return pairs.select(product_key("NCM").alias("chave"))


def frequent_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """Keys that hold at least `share` of the rows, at most 1 / share of them; reads the key column only."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.filter(F.col("n") >= total * F.lit(share)).select(key)


def bridge_code_coverage(exports: DataFrame, pairs: DataFrame) -> DataFrame:
    """Percentage of exported product codes the bridge knows, and mean activities per code.

    Both code lists are folded into one aggregate instead of being joined.
    """
    traded = exports.select(product_key("co_ncm").alias("chave"), F.lit(True).alias("exp"), F.lit(0).alias("n"))
    known = _bridge_counts(pairs).select("chave", F.lit(False).alias("exp"), F.lit(1).alias("n"))
    per_code = traded.unionByName(known).groupBy("chave").agg(
        F.bool_or("exp").alias("exp"), F.sum("n").alias("n")
    )
    totals = per_code.agg(
        F.count_if("exp").alias("codes"),
        F.count_if(F.col("exp") & (F.col("n") > 0)).alias("mapped"),
        F.avg(F.when(F.col("n") > 0, F.col("n"))).alias("activities"),
    )
    metrics = F.array(
        F.struct(F.lit(CODE_COVERAGE[0]).alias("Metrica"), percent("mapped", "codes").alias("Valor"),
                 F.lit(CODE_COVERAGE[1]).alias("Status")),
        F.struct(F.lit(COMPLEXITY[0]).alias("Metrica"), F.round("activities", 2).alias("Valor"),
                 F.lit(COMPLEXITY[1]).alias("Status")),
    )
    return totals.select(F.inline(metrics))


def bridge_value_coverage(
    exports: DataFrame, pairs: DataFrame, from_year: int = 2023, weighted: bool = False
) -> DataFrame:
    """Share of export value whose product the bridge knows, one row.

    By default every product counts once. With `weighted` a product counts once per bridge row,
    which is what a plain join with the bridge gives; the repetition is a multiplication here.
    """
    values = (
        exports.filter(F.col("ano") >= from_year)
        .groupBy(product_key("co_ncm").alias("chave"))
        .agg(F.sum("vl_fob").alias("vl_fob"))
    )
    rows = _bridge_counts(pairs).groupBy("chave").agg(F.count(F.lit(1)).alias("n"))
    times = F.col("n") if weighted else F.lit(1)
    totals = values.join(rows, "chave", "left").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("vl_fob") * times).otherwise(0)).alias("com"),
        F.sum(F.when(F.col("n").isNull(), F.col("vl_fob")).otherwise(0)).alias("sem"),
    )
    whole = F.col("com") + F.col("sem")
    return totals.select(
        percent("com", whole).alias("perc_fob_com_match_ncm"),
        percent("sem", whole).alias("perc_fob_sem_match_ncm"),
        (F.col("com") / BILLION).alias("vl_fob_com_match_bilhoes"),
        (F.col("sem") / BILLION).alias("vl_fob_sem_match_bilhoes"),
    )


def meets_target(coverage: DataFrame, target: float = TARGET_PERCENT) -> DataFrame:
    return coverage.withColumn("aprovado", F.col("perc_fob_com_match_ncm") > target)
