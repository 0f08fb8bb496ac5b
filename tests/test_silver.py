"""The typed layer: what it reads again, how many jobs it runs, tables side by side."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from aduana.operators import sinks, upsert
from aduana.operators.sinks import create_or_append, ensure_database, write_files
from aduana.operators.spec import TableSpec, same_name
from aduana.operators.upsert import folders_below, staged_counted
from aduana.plans import silver
from aduana.session import fresh_path
from tests.conftest import rows
from tests.test_archives import jobs_of

RULES = [*same_name("K"), *same_name("UF"), *same_name("V", type_name="bigint")]
NOON = dt.datetime(2024, 1, 1, 12)


class Layer:
    def __init__(self, spark, root, tag):
        self.spark, self.root = spark, root
        self.raw, self.typed, self.control = f"raw_{tag}", f"typed_{tag}", f"typed_{tag}.controle"
        for name in (self.raw, self.typed):
            ensure_database(spark, name, f"{root}/{name}")

    def load(self, table, at, lines):
        df = self.spark.createDataFrame(lines, "K string, UF string, V string").select(
            "*", F.lit(at.date()).alias("_ingestion_date"), F.lit(at).alias("_ingestion_timestamp"), F.lit("f").alias("_source_path")
        )
        create_or_append(self.spark, df, f"{self.raw}.{table}", f"{self.root}/raw/{table}", ["_ingestion_date"])

    def run(self, specs, run="run", **more):
        return silver.run_silver(
            self.spark, specs, self.raw, self.typed, f"{self.root}/typed", self.control, f"{self.root}/control", run, **more
        )


def spec(name, partitioned=True):
    return TableSpec(name, ["k"], RULES, ["uf"] if partitioned else [])


def test_counts_come_from_the_write(spark):
    df = spark.createDataFrame([(1, "a", NOON), (2, "b", None), (3, "", NOON)], "k int, p string, t timestamp")
    n, (written, found) = jobs_of(spark, "counted", lambda: staged_counted(spark, df, "x", "t", ["p"]))
    assert n <= 2 and found == {"records": 3, "latest": NOON, "partitions": {("a",), ("b",), (None,)}}
    assert rows(written, "k", "p") == [(1, "a"), (2, "b"), (3, None)]
    _, found = staged_counted(spark, df.limit(0), "x", "t", ["p"])
    assert found == {"records": 0, "latest": None, "partitions": set()}


def test_the_overlap_check_reads_the_last_loads_only(spark, tmp_path):
    layer = Layer(spark, tmp_path, "pruned")
    for day in range(4):
        layer.load("a", NOON + dt.timedelta(days=day), [(f"{day}-{i}", "SP", str(i)) for i in range(3)])
        assert rows(layer.run([spec("a")]), "status", "records") == [("updated" if day else "created", 3)]
    watermark = NOON + dt.timedelta(days=3)
    log, target = f"{tmp_path}/typed/_seen/a", spark.table(f"{layer.typed}.a")
    seen = silver.seen_rows(spark, log, target, ["k", "_ingestion_timestamp"], watermark, silver.LATE)
    assert rows(seen, "k") == [("3-0",), ("3-1",), ("3-2",)]
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_load", plan) and "/typed/a/" not in plan
    list_files = seen.select(F.input_file_name().alias("f")).distinct().collect()
    assert {re.search(r"_load=(\d{8})", r["f"])[1] for r in list_files} == {"20240104"}
    # Late rows, of which one is there already; and a table that has no log.
    layer.load("a", watermark - dt.timedelta(minutes=5), [("late", "SP", "9")])
    assert rows(layer.run([spec("a")]), "status", "records") == [("updated", 1)]
    assert rows(layer.run([spec("a")]), "status", "records") == [("unchanged", 0)]
    for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(log).select("path").limit(1).collect():
        assert "_load=" in r["path"]
    import shutil

    shutil.rmtree(log)
    assert rows(layer.run([spec("a")]), "status", "records") == [("unchanged", 0)]


def test_jobs_of_a_load_do_not_grow_with_the_table(spark, tmp_path):
    layer = Layer(spark, tmp_path, "jobs")
    layer.load("a", NOON, [(f"{i}", f"U{i % 9}", "1") for i in range(900)])
    layer.run([spec("a")])
    counts = []
    for day, lines in ((1, [("1", "U1", "2")]), (2, [(f"{i}", f"U{i % 9}", "3") for i in range(700)])):
        layer.load("a", NOON + dt.timedelta(days=day), lines)
        counts.append(jobs_of(spark, f"load-{day}", lambda: layer.run([spec("a")], at_once=1))[0])
    assert counts[1] <= counts[0] + 2  # the plans of larger tables may take a stage apart
    assert spark.table(f"{layer.typed}.a").filter("v = 3").count() == 700


@pytest.mark.parametrize("at_once", [1, 3])
def test_tables_side_by_side_are_as_in_series(spark, tmp_path, at_once):
    layer = Layer(spark, tmp_path, f"side_{at_once}")
    names = ["a", "b", "c", "d", "e"]
    for day in range(2):
        for i, name in enumerate(names):
            if (name, day) != ("d", 1):
                layer.load(name, NOON + dt.timedelta(days=day), [(f"{day}{j}", f"U{j % 2}", "x" if name == "e" else str(i)) for j in range(4)])
        specs = [spec(n, n != "b") for n in names]
        specs[2] = TableSpec("c", ["absent_key"], RULES) if day else specs[2]
        report = layer.run([*specs, spec("none")], f"run-{day}", at_once=at_once)
        got = {r["table_name"]: (r["status"], r["records"]) for r in report.collect()}
        new = "updated" if day else "created"
        assert [r["table_name"] for r in report.collect()] == [*names, "none"]
        assert got == {
            "a": (new, 4), "b": (new, 4), "c": ("failed", 0) if day else (new, 4),
            "d": ("unchanged", 0) if day else (new, 4), "e": (new, 4), "none": ("failed", 0),
        }
    control = {r["table_name"]: r for r in spark.table(layer.control).collect()}
    assert {k: (r["records_processed"], r["execution_id"], r["last_ingestion_timestamp"].day) for k, r in control.items()} == {
        "a": (8, "run-1", 2), "b": (8, "run-1", 2), "c": (4, "run-0", 1), "d": (4, "run-0", 1), "e": (8, "run-1", 2),
    }
    assert spark.table(f"{layer.typed}.b").count() == 8


def test_every_table_has_a_pool_of_its_own(spark, tmp_path, monkeypatch):
    layer = Layer(spark, tmp_path, "pools")
    pools = {}

    def seen(spark_, spec_, *rest):
        pools[spec_.name] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        return (spec_.name, "unchanged", 0, None, None), None

    monkeypatch.setattr(silver, "_load_one", seen)
    layer.run([spec(n) for n in "abcdef"], at_once=3)
    assert pools == {n: n for n in "abcdef"}
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_folders_of_a_write_from_the_listing(spark):
    """Values of any sort come back from folder names, without reading a row."""
    df = spark.createDataFrame([
        (1, "a+b c/d%e=f:g", dt.date(2024, 1, 2), 1), (2, None, None, 2), (3, "ação '\"#?", dt.date(2024, 1, 3), None),
        (4, "100%", dt.date(1, 1, 1), -5),
    ], "v int, s string, d date, n int")
    parts = ["s", "d", "n"]
    path = fresh_path(spark, "a b+c")
    write_files(df, path, parts)
    found = folders_below(spark, path, [df.schema[c] for c in parts])
    assert set(found) == {(r.s, r.d, r.n) for r in df.collect()}
    for values, folder in found.items():
        assert spark.read.parquet(folder).first()["v"] == next(
            r.v for r in df.collect() if (r.s, r.d, r.n) == values
        )
    empty = fresh_path(spark, "empty")
    write_files(df.limit(0), empty, parts)
    assert folders_below(spark, empty, [df.schema[c] for c in parts]) == {}


def test_rows_read_again_are_not_dealt_out_whole(spark):
    """What an overlap reads again is told by keys and load times; whole rows follow only where some are new."""
    def at(minutes):
        return NOON + dt.timedelta(minutes=minutes)

    schema = "k string, v int, _ingestion_timestamp timestamp"
    rows_ = [("a", 1, at(0)), ("b", 2, at(0)), (None, 3, at(0)), ("c", 4, at(90))]
    seen = spark.createDataFrame([("a", at(0)), ("b", at(0)), (None, at(0))], "k string, _ingestion_timestamp timestamp")
    known = spark.createDataFrame(rows_, schema)
    plan = silver.unseen_rows(spark, known, seen, ["k"], "t")
    assert rows(plan, "k", "v") == [("c", 4)]
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "Exchange" not in text
    # Under an earlier load time: a key that has a newer row, one that is unknown, one newer than the row that was seen.
    older = spark.createDataFrame([("a", 5, at(-5)), ("d", 6, at(-5)), ("d", 7, at(-9)), ("c", 8, at(-5))], schema)
    late = silver.unseen_rows(spark, known.unionByName(older), seen, ["k"], "t")
    assert rows(late, "k", "v") == [("c", 4), ("c", 8), ("d", 6), ("d", 7)]
    newer = seen.filter("k = 'b'").withColumn("_ingestion_timestamp", F.lit(at(-30))).unionByName(seen.filter("k = 'a' or k is null"))
    assert rows(silver.unseen_rows(spark, known, newer, ["k"], "t"), "k", "v") == [("b", 2), ("c", 4)]
    # Nothing seen, and no load time.
    assert silver.unseen_rows(spark, known, seen.limit(0), ["k"], "t").count() == 4
    untimed = spark.createDataFrame([("a", 1, None), ("x", 2, None)], schema)
    assert rows(silver.unseen_rows(spark, untimed, seen.limit(0), ["k"], "t"), "k", "v") == [("a", 1), ("x", 2)]
    gone = untimed.filter("k = 'a'").select("k", "_ingestion_timestamp")
    assert rows(silver.unseen_rows(spark, untimed, gone, ["k"], "t"), "k", "v") == [("x", 2)]


def test_many_rows_of_few_partitions_are_written_as_they_are(spark, tmp_path, monkeypatch):
    few = spark.range(100).selectExpr("id", "cast(id % 3 as string) p", "cast(nullif(id % 40, 7) as string) q")
    assert sinks.worth_gathering(few, ["p"]) and sinks.worth_gathering(few, None)
    monkeypatch.setattr(sinks, "MANY_ROWS", 100)
    monkeypatch.setattr(upsert, "MANY_ROWS", 100)
    assert not sinks.worth_gathering(few, ["p"]) and sinks.worth_gathering(few, ["q"])
    gathered = []

    def written(df, path, partition_by=None, mode="error", gather=True):
        if partition_by:
            gathered.append(gather)
        write_files(df, path, partition_by, mode, gather)

    monkeypatch.setattr(sinks, "write_files", written)
    monkeypatch.setattr(upsert, "write_files", written)
    layer = Layer(spark, tmp_path, "few")
    layer.load("a", NOON, [(f"{i}", f"U{i % 3}", "1") for i in range(120)])
    layer.load("b", NOON, [(f"{i}", f"U{i % 30}", "1") for i in range(120)])
    del gathered[:]
    layer.run([spec("a"), spec("b")], at_once=1)
    assert gathered == [False, True]
    for name in "ab":
        layer.load(name, NOON + dt.timedelta(days=1), [(f"{i}", f"U{(i + 1) % 4}" if i else "", "2") for i in range(100)])
    del gathered[:]
    assert rows(layer.run([spec("a"), spec("b")], at_once=1), "status", "records") == [("updated", 100)] * 2
    assert gathered == [False, True]
    for name in "ab":
        got = spark.table(f"{layer.typed}.{name}")
        assert got.count() == 120 and got.filter("v = 2").count() == 100 and got.filter("uf is null").count() == 1


def test_moved_keys_are_looked_for_in_other_partitions(spark, tmp_path):
    path, name = str(tmp_path / "t"), "moved_beside"
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "c")], "k int, p string")
    for values, left in (({("a",)}, [2, 3, 4]), ({(None,)}, [1, 2, 4]), ({("a",), (None,)}, [2, 4]), (set(), [1, 2, 3, 4])):
        assert [k for (k,) in rows(upsert._beside_partitions(old, values, ["p"]), "k")] == left
    two = old.withColumn("q", F.col("k") % 2)
    assert rows(upsert._beside_partitions(two, {("a", 1), (None, 1), ("b", 1)}, ["p", "q"]), "k") == [(2,), (4,)]
    upsert.upsert_table(spark, name, old, ["k"], path, ["p"])
    plan = upsert._beside_partitions(spark.table(name), {("a",), ("b",), ("c",), (None,)}, ["p"])
    assert plan.isEmpty()
    assert "PartitionFilters: []" not in plan._jdf.queryExecution().executedPlan().toString()
    upsert.upsert_table(spark, name, spark.createDataFrame([(4, "a"), (3, "b")], "k int, p string"), ["k"], path, ["p"])
    assert rows(spark.table(name), "k", "p") == [(1, "a"), (2, "b"), (3, "b"), (4, "a")]
