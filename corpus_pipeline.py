"""A corpus from raw documents to packed sequences: each stage calls one operator of `aduana.llm`.

A stage takes (spark, docs, sf_dir) and returns what it keeps of all of its predecessor's rows, with the columns of
`documents`; the last returns the packed pieces with their token ids. After each stage the rows are a Parquet table.

All stages but the last keep all columns of their input, whatever their names. Empty tables stay empty, and a text of
any length is worked on whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from aduana.llm import mixing, packing, pii, quality, simhash
from aduana.llm.common import shipped, table, written


@shipped
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the model trained on the labelled ones among them reject go.

    A null or empty text has too few words and goes. A null id teaches nothing and is judged by its text; rows that
    repeat one another are judged alike. Without labels of both classes the rules decide alone.
    """
    model = quality.fitted(docs, table(spark, sf_dir, "labels"))
    return quality.judged(docs, model, keep_columns=True)


@shipped
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays: the one with the smallest id.

    Null and empty texts share a fingerprint and are one group. A null id stays only in a group without an id. Of
    rows that repeat an id and a fingerprint one stays.
    """
    return simhash.deduplicated(spark, docs, shingle=simhash.SHINGLE, bits=simhash.BITS)


@shipped
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars is then that of the new text.

    A null text stays null, with its n_chars. Null ids and repeated rows are like any others.
    """
    return pii.redact(docs)


@shipped
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them.

    A null source is a source, a null id an id. A text without words, null or empty, is taken no time. Rows that are
    equal in id, source and size are drawn one by one.
    """
    return mixing.mixed_documents(spark, docs)


@shipped
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences: their token ids, and the checksum of these.

    A null or empty text is the end mark alone. A null id stays null; repeated rows are packed as often as they come.
    """
    pieces = packing.pack(docs)
    at = pieces.columns.index("ids") + 1
    return pieces.select(*pieces.columns[:at], F.crc32("ids").alias("ids_crc32"), *pieces.columns[at:])


STAGES = [
    ("quality", quality_rules),
    ("simhash", near_duplicates),
    ("pii", personal_data),
    ("mixing", source_mix),
    ("packing", packed),
]

#: No stage but the counts of the first can be said in SQL; the tests compare with brute force.
ORACLE_SQL = None


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of the last stage: every piece with its token ids (little-endian unsigned 32-bit)."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of `sequences`, whose table it writes, with the checksums in place of the ids."""
    return sequences(spark, sf_dir).drop("ids")
