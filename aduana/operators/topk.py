"""Two-list top-k with refill."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# How a product came onto the list.
ORIGIN = {
    "exp": "EXPORTAÇÃO",
    "imp": "IMPORTAÇÃO",
    "exp_extra": "EXPORTAÇÃO_EXTRA",
    "imp_extra": "IMPORTAÇÃO_EXTRA",
}


def refilled_top(
    values: DataFrame,
    key: str = "CO_NCM",
    first: str = "VL_FOB_EXP",
    second: str = "VL_FOB_IMP",
    per_list: int = 5,
    total: int = 10,
) -> DataFrame:
    """The `per_list` best of each list, then the next best of the first list, then of the
    second, until `total` are chosen. Returns `key` and `origem`.

    Only the best `total` rows of each list can ever be chosen: every row that is passed over
    belongs to the `total` already counted. Both heads come from a sort with limit, so the
    ranking below sees at most 2 * total rows. Equal values are ordered by the other list's
    value and then by the key; asking for both columns on both sides also lets Spark compute the
    aggregate below once for the two sorts.
    """
    def head(main: str, other: str, rank: str) -> DataFrame:
        best = [F.desc_nulls_last(main), F.desc_nulls_last(other), F.asc(key)]
        rows = values.select(key, first, second).orderBy(*best).limit(total)
        return rows.select(key, F.row_number().over(Window.orderBy(*best)).alias(rank))

    heads = head(first, second, "r1").unionByName(head(second, first, "r2"), allowMissingColumns=True)
    ranks = heads.groupBy(key).agg(F.min("r1").alias("r1"), F.min("r2").alias("r2"))

    r1, r2 = F.col("r1"), F.col("r2")
    stage = (
        F.when(r1 <= per_list, 0)
        .when(r2 <= per_list, 1)
        .when(r1.isNotNull(), 2)
        .otherwise(3)
    )
    labels = F.array(*[F.lit(ORIGIN[o]) for o in ("exp", "imp", "exp_extra", "imp_extra")])
    return (
        ranks.withColumn("stage", stage)
        .orderBy("stage", F.when(F.col("stage").isin(0, 2), r1).otherwise(r2))
        .limit(total)
        .select(key, F.get(labels, F.col("stage")).alias("origem"))
    )


def explicit_top(spark, codes: list[str], key: str = "CO_NCM") -> DataFrame:
    """A hand-picked list in place of the computed one."""
    return spark.createDataFrame([(c, "LISTA") for c in codes], f"{key} string, origem string")
