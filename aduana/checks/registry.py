"""Every operator as a query over the Parquet test tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from aduana.checks import binding as b, table_queries
from aduana.operators.dedup import latest_by_key
from aduana.operators.flows import EXPORT, IMPORT
from aduana.operators.topk import refilled_top
from aduana.operators.bucketed import upsert_bucketed
from aduana.operators.upsert import accumulated, merged, staged, upsert_table
from aduana.operators.watermark import batch_progress, latest_entries, moment, new_rows
from aduana.plans import audit, company, geo, trade as t
from aduana.session import fresh_path
from aduana.sources.bridge import bridge_pairs
from aduana.sources.tables import size_dim
from aduana.streaming.ingest import append_once, file_stream
from aduana.streaming.upsert import upsert_stream

Query = Callable[[SparkSession, str], DataFrame]

LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_CUT = dt.datetime(1999, 1, 1)
EVENT_CUT = dt.datetime(2024, 1, 15)


def top10(spark: SparkSession, d: str) -> DataFrame:
    return refilled_top(t.product_price(b.trade(spark, d)))


def _country(flow: str, value: str) -> Query:
    return lambda s, d: geo.country_trade(
        b.facts(s, d, flow, "co_pais"), top10(s, d), b.countries(s, d), value
    )


def _route(flow: str) -> Query:
    return lambda s, d: geo.route_volume(
        b.facts(s, d, flow, "co_via"), top10(s, d), b.routes(s, d), flow.lower()
    )


def bloc_trade(s: SparkSession, d: str) -> DataFrame:
    top = top10(s, d)
    return geo.bloc_trade(b.located_trade(s, d, top), top, b.blocs(s, d))


def state_balance(s: SparkSession, d: str) -> DataFrame:
    top = top10(s, d)
    return geo.state_balance(b.located_trade(s, d, top), top, b.states(s, d))


def company_fact(s: SparkSession, d: str) -> DataFrame:
    top = top10(s, d)
    return company.company_fact(
        b.sites(s, d), b.companies(s, d), b.bridge(s, d), top, b.located_trade(s, d, top), b.AS_OF
    )


def _lines(s: SparkSession, d: str) -> DataFrame:
    rows = b.read(s, d, "lineitem")
    return rows.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


def _latest_lines(rows: DataFrame) -> DataFrame:
    tiebreak = [
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus",
    ]
    return latest_by_key(rows, LINE_KEYS, ["l_shipdate"], tiebreak)


def _two_loads(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Line items of two loads: shipped before the cut, and since then."""
    lines, cut = _lines(s, d), F.lit(LINE_CUT.date())
    return (
        _latest_lines(lines.filter(F.col("l_shipdate") < cut)),
        _latest_lines(lines.filter(F.col("l_shipdate") >= cut)),
    )


def upsert_scd1(s: SparkSession, d: str) -> DataFrame:
    target, source = _two_loads(s, d)
    return merged(target, source, LINE_KEYS)


def upsert_table_scd1(s: SparkSession, d: str) -> DataFrame:
    """The same through a table partitioned by a column that is not part of the key."""
    name, path = f"lines_{uuid.uuid4().hex[:12]}", fresh_path(s, "lines")
    for load in _two_loads(s, d):
        upsert_table(s, name, staged(s, load, "load"), LINE_KEYS, path, ["l_returnflag"])
    return s.table(name)


def upsert_in_buckets(s: SparkSession, d: str) -> DataFrame:
    """The same through a table of eight buckets."""
    name, path = f"lines_{uuid.uuid4().hex[:12]}", fresh_path(s, "buckets")
    for load in _two_loads(s, d):
        upsert_bucketed(s, name, load, LINE_KEYS, path, buckets=8)
    return s.table(name)


def upsert_newer_only(s: SparkSession, d: str) -> DataFrame:
    """The older load arrives last and must not replace newer rows."""
    older, newer = _two_loads(s, d)
    return merged(newer, older, LINE_KEYS, newer_by="l_shipdate")


def latest_control(s: SparkSession, d: str) -> DataFrame:
    """Events as control rows: the latest one of every table."""
    control = b.read(s, d, "events").select(
        F.col("event_type").alias("table_name"), F.col("event_id").alias("execucao"), F.col("ts").alias("last_update")
    )
    return latest_entries(control, "execucao", "execucao")


def _event_control(events: DataFrame, run: str) -> DataFrame:
    return batch_progress(events, ["event_type"], "ts").select(
        F.col("event_type").alias("table_name"),
        "last_ingestion_timestamp",
        F.col("last_ingestion_timestamp").alias("last_update"),
        "records_processed",
        F.lit(run).alias("execution_id"),
    )


def upsert_accumulate(s: SparkSession, d: str) -> DataFrame:
    events = b.read(s, d, "events")
    cut = moment(EVENT_CUT, events.schema["ts"].dataType)
    before, after = (
        _event_control(events.filter(keep), run)
        for keep, run in ((F.col("ts") <= cut, "run-1"), (F.col("ts") > cut, "run-2"))
    )
    return accumulated(before, after, ["table_name"], ["records_processed"], "last_update")


def incremental_filter(s: SparkSession, d: str) -> DataFrame:
    return new_rows(b.read(s, d, "events"), EVENT_CUT, "ts")


def watermark_advance(s: SparkSession, d: str) -> DataFrame:
    fresh = incremental_filter(s, d)
    return batch_progress(fresh, ["event_type"], "ts").withColumnRenamed("event_type", "table_name")


def _table_stream(s: SparkSession, d: str, name: str) -> DataFrame:
    """A table as a stream, be it a file or a folder of part files."""
    path = f"{d}/{name}.parquet"
    place = s._jvm.org.apache.hadoop.fs.Path(path)
    folder = place.getFileSystem(s._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory()
    where, glob = (path, "*.parquet") if folder else (d, f"{name}.parquet")
    return file_stream(s, where, glob, b.read(s, d, name).schema, "parquet")


def stream_upsert(s: SparkSession, d: str) -> DataFrame:
    stream = _table_stream(s, d, "lineitem").withColumn(
        "l_shipdate", F.col("l_shipdate").cast("date")
    )
    order = [
        "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus",
    ]
    name = f"stream_{uuid.uuid4().hex[:12]}"
    upsert_stream(
        stream, name, LINE_KEYS, order, fresh_path(s, "stream-table"), fresh_path(s, "stream-checkpoint"),
    )
    return s.table(name)


def stream_once(s: SparkSession, d: str) -> DataFrame:
    path, checkpoint = fresh_path(s, "events"), fresh_path(s, "events-checkpoint")
    for _ in range(2):  # the second run finds nothing new
        append_once(_table_stream(s, d, "events"), path, checkpoint)
    return s.read.schema(b.read(s, d, "events").schema).parquet(path)


def queries() -> dict[str, Query]:
    return {
        "monthly_balance": lambda s, d: t.monthly_balance(b.trade(s, d)),
        "yearly_totals": lambda s, d: t.yearly_totals(b.trade(s, d)),
        "factor_share": lambda s, d: t.factor_share(b.trade(s, d), b.ncm(s, d), b.factors(s, d)),
        "factor_share_within_year": lambda s, d: t.factor_share(
            b.trade(s, d), b.ncm(s, d), b.factors(s, d), within=["ANO"]
        ),
        "product_price": lambda s, d: t.product_price(b.trade(s, d)),
        "product_mom": lambda s, d: t.product_mom(b.trade(s, d)),
        "top10_refill": top10,
        "date_dim": lambda s, d: t.date_dim(b.trade(s, d)),
        "product_dim": lambda s, d: t.product_dim(b.ncm(s, d)),
        "country_exports": _country(EXPORT, "valor_exportado"),
        "country_imports": _country(IMPORT, "valor_importado"),
        "bloc_trade": bloc_trade,
        "state_balance": state_balance,
        "route_exports": _route(EXPORT),
        "route_imports": _route(IMPORT),
        "class_dim": lambda s, d: company.class_dim(b.activities(s, d)),
        "company_fact": company_fact,
        "top_product_dim": lambda s, d: company.top_product_dim(top10(s, d), b.ncm(s, d)),
        "top_bridge": lambda s, d: company.top_bridge(b.bridge(s, d), top10(s, d)),
        "companies_by_state": lambda s, d: company.companies_by_state(company_fact(s, d), b.states(s, d)),
        "size_profile": lambda s, d: company.size_profile(company_fact(s, d), size_dim(s)),
        "top_classes_by_region": lambda s, d: company.top_classes_by_region(
            company_fact(s, d), b.states(s, d), company.class_dim(b.activities(s, d))
        ),
        "class_age": lambda s, d: company.class_age(company_fact(s, d), company.class_dim(b.activities(s, d))),
        "company_dim": lambda s, d: company.company_dim(b.sites(s, d), b.companies(s, d), b.cities(s, d)),
        "product_dim_wide": lambda s, d: company.product_dim_wide(b.ncm(s, d), b.isic(s, d), b.cuci(s, d)),
        "opportunities": lambda s, d: company.opportunities(
            b.facts(s, d, EXPORT), top10(s, d), b.bridge(s, d), b.sites(s, d), b.ncm(s, d), b.AS_OF
        ),
        "bridge_code_coverage": lambda s, d: audit.bridge_code_coverage(b.facts(s, d, EXPORT), b.pairs(s, d)),
        "bridge_value_coverage": lambda s, d: audit.bridge_value_coverage(
            b.facts(s, d, EXPORT), b.pairs(s, d), from_year=1999
        ),
        "bridge_value_coverage_weighted": lambda s, d: audit.bridge_value_coverage(
            b.facts(s, d, EXPORT), b.pairs(s, d), from_year=1999, weighted=True
        ),
        "state_dim": lambda s, d: company.state_dim(b.states(s, d)),
        "product_labels": lambda s, d: company.product_labels(b.ncm(s, d)),
        "bridge_explode": lambda s, d: bridge_pairs(b.bridge_source(s, d)),
        "dedup_latest": lambda s, d: _latest_lines(_lines(s, d)),
        "upsert_scd1": upsert_scd1,
        "upsert_table_scd1": upsert_table_scd1,
        "upsert_bucketed": upsert_in_buckets,
        "upsert_accumulate": upsert_accumulate,
        "incremental_filter": incremental_filter,
        "watermark_advance": watermark_advance,
        "stream_once": stream_once,
        "stream_upsert": stream_upsert,
        "upsert_newer_only": upsert_newer_only,
        "latest_control": latest_control,
        "country_exports_top": lambda s, d: geo.country_trade(
            b.facts(s, d, EXPORT, "co_pais"), top10(s, d), b.countries(s, d), "valor_exportado", k=10
        ),
        **table_queries.QUERIES,
    }
