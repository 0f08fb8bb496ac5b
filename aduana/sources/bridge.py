"""The product-to-activity bridge: one row per product with a list of activities, to pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from aduana.functions.codes import class_key, leading_digits, product_key, without_punctuation
from aduana.sources.delimited import headerless

# The three column names of the source rows, in order.
BRIDGE_COLUMNS = ["NCM", "NCM_DESC", "CNAE"]
ACTIVITY_SEPARATOR = ";"


def bridge_file(spark: SparkSession, path: str) -> DataFrame:
    """Bridge rows of delimited files, with their file in `origem`.

    Above the rows stand a title, whose other fields are empty, and the heading: the row that names the
    activity column. Any other row is kept, whatever its code looks like.
    """
    rows = headerless(spark, path, BRIDGE_COLUMNS).select("*", F.col("_metadata.file_path").alias("origem"))
    heading = F.upper(F.trim("NCM")).eqNullSafe("NCM") & F.upper(F.trim("CNAE")).eqNullSafe("CNAE")
    title = F.col("NCM").rlike(r"^\D*$") & F.col("NCM_DESC").isNull() & F.col("CNAE").isNull()
    return rows.filter(~heading & ~F.coalesce(title, F.lit(False)))


def bridge_rows(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Impose the three names in order; columns without a name go. Columns in `keep` stay as they are.
    Raises ValueError unless three columns have a name."""
    keep = keep or []
    named = [c for c in df.columns if c.strip() and "Unnamed" not in c and not c.startswith("_c")]
    if len(named) != len(BRIDGE_COLUMNS):
        raise ValueError(f"the bridge needs {len(BRIDGE_COLUMNS)} named columns, not {named}")
    three = [F.col(f"`{c}`").cast("string").alias(n) for c, n in zip(named, BRIDGE_COLUMNS, strict=True)]
    return df.select(*three, *keep)


def bridge_pairs(rows: DataFrame) -> DataFrame:
    """One row per product and activity. A missing list gives no row; an entry that does not
    begin with a digit gives a row without activity."""
    others = [c for c in rows.columns if c != "CNAE"]
    entry = without_punctuation(F.trim(F.col("CNAE")))
    return (
        rows.select(*others, F.explode(F.split("CNAE", ACTIVITY_SEPARATOR)).alias("CNAE"))
        .withColumn("CNAE", leading_digits(entry))
    )


def distinct_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs without the repetitions a reload leaves behind."""
    return pairs.select("NCM", "CNAE").distinct()


def keyed_pairs(pairs: DataFrame) -> DataFrame:
    """Distinct (co_ncm, classe) pairs under normalised keys, ready for equi-joins."""
    return (
        pairs.filter(F.col("CNAE").isNotNull())
        .select(product_key("NCM").alias("co_ncm"), class_key("CNAE").alias("classe"))
        .distinct()
    )
