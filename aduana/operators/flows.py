"""Two flows side by side without a full outer join.

The trade facts arrive as an export and an import table of the same shape. A report that sets
one beside the other is a full outer join of two aggregates; tagging the rows and summing
conditionally gives the same rows from one aggregate and one shuffle. A sum without a matching
row stays null, exactly where the outer join would leave a null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

FLOW = "fluxo"
EXPORT = "EXP"
IMPORT = "IMP"


def tag_flows(exports: DataFrame, imports: DataFrame, columns: list[str]) -> DataFrame:
    """One fact table with a flow column, from the export and the import table."""
    tagged = [
        df.select(F.lit(flow).alias(FLOW), *[F.col(c).alias(c) for c in columns])
        for flow, df in ((EXPORT, exports), (IMPORT, imports))
    ]
    return tagged[0].unionByName(tagged[1])


def of_flow(trade: DataFrame, flow: str) -> DataFrame:
    return trade.filter(F.col(FLOW) == flow)


def flow_sum(column: str, flow: str) -> Column:
    return F.sum(F.when(F.col(FLOW) == flow, F.col(column)))


def flow_rows(flow: str, rows: str | None = None) -> Column:
    """Facts of a flow; `rows` is the column that counts them where they come summed already."""
    if rows is None:
        return F.count_if(F.col(FLOW) == flow)
    return F.coalesce(flow_sum(rows, flow), F.lit(0)).cast("bigint")


#: Facts behind a row of `summed`.
FACTS = "_facts"


def summed(trade: DataFrame, by: list[str]) -> DataFrame:
    """Facts summed by flow and `by`: reports over fewer keys give the same from these rows."""
    return trade.groupBy(FLOW, *by).agg(
        F.sum("kg_liquido").alias("kg_liquido"), F.sum("vl_fob").alias("vl_fob"), F.count(F.lit(1)).alias(FACTS)
    )
