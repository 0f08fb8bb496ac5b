"""What Spark makes of the queries: pushed filters, pruned columns, no hot spot."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from aduana.checks import binding as b
from aduana.checks.registry import queries
from aduana.operators.dedup import latest_by_key

SF = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def plan_of(spark, name):
    return physical(queries()[name](spark, SF))


def test_monthly_balance_reads_three_columns_and_shuffles_once(spark):
    plan = plan_of(spark, "monthly_balance")
    assert re.search(r"ReadSchema: struct<l_extendedprice:double,l_linestatus:string,l_shipdate:[a-z_]+>", plan)
    assert plan.count("Exchange ") == 1 and "Join" not in plan


def test_flow_filter_reaches_the_scan(spark):
    assert "EqualTo(l_linestatus,O)" in plan_of(spark, "country_exports")


@pytest.mark.parametrize("name", ["country_exports", "bloc_trade", "state_balance", "route_exports", "company_fact"])
def test_top_products_are_chosen_before_the_lookups(spark, name):
    """A semi join on products sits right on the fact scan, below every lookup."""
    lines = optimized(queries()[name](spark, SF)).splitlines()

    def on_the_facts(start):
        scan = next(i for i in range(start + 1, len(lines)) if "Relation" in lines[i])
        return "l_partkey" in lines[scan] and not any("Join" in line or "Aggregate" in line for line in lines[start + 1:scan])

    semis = [i for i, line in enumerate(lines) if "Join LeftSemi, (co_ncm" in line and on_the_facts(i)]
    lookups = [i for i, line in enumerate(lines) if re.search(r"Join \w+, \(\(?(l_|o_)", line)]
    assert semis and lookups and max(lookups) < max(semis)


def test_only_lookups_that_are_needed(spark):
    plan = plan_of(spark, "country_imports")
    assert "orders.parquet" not in plan and "customer.parquet" not in plan


def test_latest_row_is_chosen_before_the_shuffle(spark):
    plan = physical(latest_by_key(b.read(spark, SF, "lineitem"), ["l_orderkey"], ["l_shipdate"]))
    partial, final = (m.start() for m in re.finditer("WindowGroupLimit", plan[plan.index("Window"):]))
    text = plan[plan.index("Window"):]
    assert "Final" in text[partial:final] and "Exchange" in text[partial:final] and "Partial" in text[final:]


@pytest.mark.parametrize("name", ["company_fact", "opportunities"])
def test_sites_are_not_shuffled_by_class(spark, name):
    """Even where Spark thinks nothing small enough to broadcast: classes are few and crowded."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64")
    try:
        plan = plan_of(spark, name)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    semi = re.findall(r"(\w+Join) \[classe#\d+\], \[classe#\d+\], LeftSemi", plan)
    assert semi and set(semi) == {"BroadcastHashJoin"}


def test_month_dimension_of_one_flow(spark):
    from aduana.plans import trade

    both = trade.date_dim(b.trade(spark, SF)).count()
    assert 0 < trade.date_dim(b.trade(spark, SF), "EXP").count() <= both


def test_stream_queries_read_folders_of_part_files(spark, tmp_path):
    for name in ("events", "lineitem"):
        b.read(spark, SF, name).repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name in ("stream_once", "stream_upsert"):
        whole, parts = queries()[name](spark, SF), queries()[name](spark, str(tmp_path))
        assert whole.count() == parts.count() > 0 and whole.exceptAll(parts).isEmpty()


def test_region_ranking_is_limited_per_group(spark):
    assert "WindowGroupLimit" in plan_of(spark, "top_classes_by_region")


def test_no_unbounded_single_partition(spark):
    """Rankings see at most the rows of a limit; totals are partial sums."""
    for name in ("factor_share", "top10_refill", "bridge_value_coverage", "bridge_code_coverage"):
        plan = plan_of(spark, name)
        for match in re.finditer(r"Exchange SinglePartition.*\n(.*)", plan):
            assert "partial_" in match.group(1) or "Limit" in match.group(1), match.group(0)


@pytest.mark.parametrize("name", ["top10_refill", "product_mom", "yearly_totals", "product_price"])
def test_facts_are_scanned_once(spark, name):
    df = queries()[name](spark, SF)
    df.collect()
    final = physical(df).split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan.*lineitem\.parquet", final)) == 1


def test_no_python_in_the_reports(spark):
    for name in ("company_fact", "opportunities", "product_mom", "bloc_trade", "bridge_explode", "dedup_latest"):
        assert "Python" not in plan_of(spark, name) and "InPandas" not in plan_of(spark, name)


def test_no_cartesian_product(spark):
    for name, query in queries().items():
        if name.startswith(("stream", "silver", "upsert_table", "append", "create", "replace", "delimited", "positional", "archive")):
            continue
        plan = physical(query(spark, SF))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_partition_filter_of_incremental_reading(spark, tmp_path):
    import datetime as dt

    from aduana.operators.watermark import new_rows

    path = str(tmp_path / "raw")
    spark.range(10).select(
        F.col("id"), F.expr("timestamp '2024-01-01' + make_dt_interval(cast(id as int))").alias("_ingestion_timestamp"),
    ).withColumn("_ingestion_date", F.col("_ingestion_timestamp").cast("date")).write.partitionBy("_ingestion_date").parquet(path)
    fresh = new_rows(spark.read.parquet(path), dt.datetime(2024, 1, 8), date_col="_ingestion_date")
    assert fresh.count() == 2
    assert re.search(r"PartitionFilters: \[.*_ingestion_date.* >= 2024-01-07", physical(fresh))


def test_ordered_files_follow_each_other(spark, tmp_path):
    from aduana.operators.sinks import in_order, overlapping_files

    order = ["-o_totalprice", "o_orderkey"]
    orders = b.read(spark, SF, "orders").select("o_orderkey", F.expr("if(o_orderkey % 9 = 0, null, o_totalprice)").alias("o_totalprice"))
    in_order(orders, order, 5).write.parquet(f"{tmp_path}/sorted")
    orders.repartition(5).write.parquet(f"{tmp_path}/mixed")
    scan = spark.read.parquet(f"{tmp_path}/sorted")
    assert scan.select(F.input_file_name()).distinct().count() == 5
    assert overlapping_files(scan, order).count() == 0
    assert overlapping_files(spark.read.parquet(f"{tmp_path}/mixed"), order).count() > 0
    plan = physical(in_order(orders, order))
    assert "rangepartitioning" in plan and "SinglePartition" not in plan
    # A filter on the leading column finds its rows in one or two of the files.
    wanted = scan.orderBy(F.desc("o_totalprice")).limit(20).select("o_totalprice").collect()
    found = scan.filter(F.col("o_totalprice") >= wanted[-1][0]).select(F.input_file_name()).distinct().count()
    assert found == 1
