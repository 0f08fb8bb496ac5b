"""Small inline relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def inline(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


# Size classes of the company register.
SIZE_CLASSES = [
    ("00", "Não Informado"),
    ("01", "Microempresa"),
    ("03", "Empresa de Pequeno Porte"),
    ("05", "Demais"),
]


def size_dim(spark: SparkSession) -> DataFrame:
    return inline(spark, SIZE_CLASSES, "codigo_porte string, descricao_porte string")
