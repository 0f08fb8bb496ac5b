"""The Parquet test tables in the roles the operators expect.

Line items are the trade facts, parts the products, orders the company sites and customers the
companies. Country, state and route need lookups in other tables, and only those a query wants
are made.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from aduana.operators.flows import EXPORT, FLOW, IMPORT
from aduana.plans.geo import only_top
from aduana.sources.bridge import bridge_pairs, distinct_pairs, keyed_pairs

AS_OF = dt.date(2002, 1, 1)
STATUS = {EXPORT: "O", IMPORT: "F"}


_schemas: dict[str, StructType] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; its schema is read from the file footers once per process, not once per use."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def code(c: str | Column, width: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.lpad(c.cast("string"), width, "0")


def moved(key: Column, of, to) -> Column:
    """The key of a lookup row that no fact is to match: the row stays, under a key of its own."""
    return F.when(key == of, to).otherwise(key)


def state_code(nation: Column) -> Column:
    return F.concat(F.lit("U"), code(nation, 2))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem")


def _fact_columns() -> list[Column]:
    return [
        F.year("l_shipdate").cast("int").alias("ano"),
        F.month("l_shipdate").cast("int").alias("mes"),
        code("l_partkey", 8).alias("co_ncm"),
        F.col("l_returnflag").alias("co_urf"),
        F.col("l_quantity").cast("bigint").alias("kg_liquido"),
        F.floor(F.col("l_extendedprice") * 100 + 0.5).cast("bigint").alias("vl_fob"),
    ]


def _flow() -> Column:
    return F.when(F.col("l_linestatus") == STATUS[EXPORT], EXPORT).otherwise(IMPORT).alias(FLOW)


def trade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both flows from a single scan, without the columns that need a lookup."""
    return _lines(spark, sf_dir).select(_flow(), *_fact_columns())


def _with_order(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.col("o_orderpriority").alias("co_via")
    )
    return rows.join(orders, "l_orderkey", "left")


def _with_customer(spark: SparkSession, sf_dir: str, rows: DataFrame, country: str, state: str) -> DataFrame:
    nation = F.col("c_nationkey")
    customers = read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), code(nation, 3).alias(country), state_code(nation).alias(state)
    )
    return _with_order(spark, sf_dir, rows).join(customers, "o_custkey", "left")


def _with_supplier(spark: SparkSession, sf_dir: str, rows: DataFrame, country: str, state: str) -> DataFrame:
    nation = F.col("s_nationkey")
    suppliers = read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), code(nation, 3).alias(country), state_code(nation).alias(state)
    )
    return rows.join(suppliers, "l_suppkey", "left")


def facts(spark: SparkSession, sf_dir: str, flow: str, lookup: str | None = None) -> DataFrame:
    """One flow, if asked for with one looked-up column: co_pais or co_via.

    Goods go to the customer's country when exported and come from the supplier's country when
    imported. Codes are computed before the tables are joined, so that a filter on products passes
    below the lookup to the scan.
    """
    rows = _lines(spark, sf_dir).filter(F.col("l_linestatus") == STATUS[flow]).select(
        "l_orderkey", "l_suppkey", *_fact_columns()
    )
    if lookup == "co_via":
        return _with_order(spark, sf_dir, rows)
    if lookup == "co_pais":
        with_party = _with_customer if flow == EXPORT else _with_supplier
        return with_party(spark, sf_dir, rows, "co_pais", "_uf")
    return rows


def located_trade(spark: SparkSession, sf_dir: str, top: DataFrame) -> DataFrame:
    """Both flows of the top products, from a single scan, with country and state: the country is
    the customer's for exports and the supplier's for imports, the state the other way round.

    Which party counts depends on the row, so the choice sits above the lookups and would hold a
    later filter on products up there; it is made here, before them.
    """
    rows = only_top(_lines(spark, sf_dir).select("l_orderkey", "l_suppkey", _flow(), *_fact_columns()), top)
    rows = _with_customer(spark, sf_dir, rows, "c_pais", "c_uf")
    rows = _with_supplier(spark, sf_dir, rows, "s_pais", "s_uf")
    exported = F.col(FLOW) == EXPORT
    return rows.withColumns({
        "co_pais": F.when(exported, F.col("c_pais")).otherwise(F.col("s_pais")),
        "sigla_uf_ncm": F.when(exported, F.col("s_uf")).otherwise(F.col("c_uf")),
    })


def ncm(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = code("p_partkey", 8)
    return read(spark, sf_dir, "part").select(
        key.alias("co_ncm"),
        F.col("p_name").alias("no_ncm_por"),
        F.upper("p_name").alias("no_ncm_ing"),
        F.substring(key, 1, 6).alias("co_sh6"),
        F.col("p_type").alias("co_fat_agreg"),
        F.col("p_brand").alias("co_cuci_item"),
        code("p_size", 4).alias("co_isic_classe"),
    )


def factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_type").distinct().select(
        F.col("p_type").alias("co_fat_agreg"), F.concat(F.lit("PRODUTOS "), "p_type").alias("no_fat_agreg")
    )


def isic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_size").distinct().select(
        code(moved(F.col("p_size"), 50, 9950), 4).alias("co_isic_classe"),
        F.concat(F.lit("Classe "), F.col("p_size").cast("string")).alias("no_isic_classe"),
        F.concat(F.lit("Seção "), (F.col("p_size") % 5).cast("string")).alias("no_isic_secao"),
    )


def cuci(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_brand").distinct().select(
        F.col("p_brand").alias("co_cuci_item"), F.concat(F.lit("Grupo "), "p_brand").alias("no_cuci_grupo")
    )


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation 13 has another key: a fact country without a name."""
    return read(spark, sf_dir, "nation").select(
        code(moved(F.col("n_nationkey"), 13, 913), 3).alias("co_pais"), F.col("n_name").alias("no_pais")
    )


def blocs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region as bloc, a second bloc for even nations; nation 13 has another key."""
    nation = read(spark, sf_dir, "nation")
    region = read(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    key = code(moved(F.col("n_nationkey"), 13, 913), 3).alias("co_pais")
    first = nation.join(region, "n_regionkey").select(key, F.col("r_name").alias("no_bloco"))
    second = nation.filter("n_nationkey % 2 = 0").select(key, F.lit("BLOCO PAR").alias("no_bloco"))
    return first.unionByName(second)


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation 24 has another key: a fact state without a name. One region counts as undeclared."""
    region = read(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    label = F.when(F.col("n_regionkey") == 4, "REGIÃO NÃO DECLARADA").otherwise(F.col("r_name"))
    return read(spark, sf_dir, "nation").join(region, "n_regionkey").select(
        state_code(moved(F.col("n_nationkey"), 24, 99)).alias("sg_uf"),
        F.col("n_name").alias("no_uf"),
        label.alias("no_regiao"),
        F.col("n_nationkey").cast("string").alias("co_uf"),
    )


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One priority has another key: a fact route without a name."""
    names = read(spark, sf_dir, "orders")
    return names.select("o_orderpriority").distinct().select(
        moved(F.col("o_orderpriority"), "5-LOW", "9-LOW").alias("co_via"), F.expr("substring(o_orderpriority, 3)").alias("no_via")
    )


def _class_code(index: Column) -> Column:
    return code(F.lit(1113) + index * 3877, 5)


def bridge_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the bridge file: unpadded product, description, `;`-separated activity classes.

    Lists are punctuated; some are missing, empty or hold no code.
    """
    def entry(index: Column) -> Column:
        digits = _class_code(index)
        return F.concat(F.substring(digits, 1, 4), F.lit("-"), F.substring(digits, 5, 1))

    size = F.col("p_size")
    listed = F.concat(entry(size % 25), F.lit("; "), entry((size * 7 + 3) % 25))
    activities = (
        F.when(size % 10 == 0, F.lit(None).cast("string"))
        .when(size % 10 == 9, "abc")
        .when(size % 10 == 8, "")
        .otherwise(listed)
    )
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("NCM"), F.col("p_name").alias("NCM_DESC"), activities.alias("CNAE")
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_pairs(bridge_pairs(bridge_source(spark, sf_dir)))


def bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_pairs(bridge_pairs(bridge_source(spark, sf_dir)))


def _activity(order_key: Column) -> Column:
    """Seven-digit activity of a site, written as a number: leading zeros are lost."""
    index = order_key % 50
    five = F.lit(1113) + (index % 25) * 3877
    return (five * 100 + F.when(index < 25, 1).otherwise(2)).cast("string")


def activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = read(spark, sf_dir, "orders").select(_activity(F.col("o_orderkey")).alias("codigo_cnae"))
    return codes.distinct().select(
        "codigo_cnae", F.concat(F.lit("Atividade "), code("codigo_cnae", 7)).alias("descricao_cnae")
    )


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    size = (
        F.when(segment == "AUTOMOBILE", "00")
        .when(segment == "BUILDING", "01")
        .when(segment == "FURNITURE", "03")
        .when(segment == "HOUSEHOLD", "05")
        .otherwise("5")
    )
    return read(spark, sf_dir, "customer").select(
        code("c_custkey", 8).alias("cnpj_basico"),
        F.col("c_name").alias("razao_social"),
        size.alias("porte_empresa"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("capital_social"),
    )


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as company sites: companies have sites in several states, some without a state."""
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    flag = (
        F.when(status == "O", "02")
        .when((status == "P") & (key % 2 == 0), "2")
        .otherwise("08")
    )
    state = F.when(key % 101 != 0, state_code((F.col("o_custkey") + key) % 25))
    return read(spark, sf_dir, "orders").select(
        code("o_custkey", 8).alias("cnpj_basico"),
        code("o_orderkey", 12).alias("cnpj_ordem"),
        code(key % 97, 2).alias("cnpj_dv"),
        F.when(key % 3 == 0, "1").otherwise("2").alias("identificador_matriz_filial"),
        F.concat(F.lit("Loja "), key.cast("string")).alias("nome_fantasia"),
        flag.alias("situacao_cadastral"),
        F.col("o_orderdate").cast("date").alias("data_inicio_atividade"),
        _activity(key).alias("cnae_fiscal_principal"),
        state.alias("uf"),
        code(F.col("o_custkey") % 25, 4).alias("municipio"),
    )


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "nation").select(
        code(moved(F.col("n_nationkey"), 13, 9913), 4).alias("codigo_municipio"),
        F.concat(F.lit("Cidade "), "n_name").alias("descricao_municipio"),
    )
