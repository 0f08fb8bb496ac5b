"""Archives by members and files by their first lines."""

from __future__ import annotations

import random
import zipfile

import pytest
from pyspark.sql import functions as F

from aduana.plans import bronze
from aduana.sources.archives import archive_blocks, archive_lines, archive_members
from aduana.sources.inventory import binary_files
from aduana.sources.opening import files_by_header, first_lines, header_names
from aduana.streaming.ingest import by_header
from tests.conftest import rows


def write_zip(path, members, method=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", method) as archive:
        for name, text in members.items():
            archive.writestr(name, text.encode("ISO-8859-1"))


def jobs_of(spark, group, work):
    """How many jobs `work` runs."""
    context = spark.sparkContext
    context.setJobGroup(group, group)
    try:
        result = work()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return len(context.statusTracker().getJobIdsForGroup(group)), result


def text(n, seed):
    rng = random.Random(seed)
    return "".join(f'"{i}";"{rng.random()}"\n' for i in range(n))


def test_every_member_has_a_task_of_its_own(spark, tmp_path):
    members = {f"M{i}.CSV": text(300 + i, i) for i in range(10)}
    write_zip(tmp_path / "ten.zip", members)
    blocks = archive_blocks(binary_files(spark, str(tmp_path)))
    placed = blocks.withColumn("task", F.spark_partition_id()).groupBy("member").agg(
        F.collect_set("task").alias("tasks")
    ).collect()
    tasks = [tuple(r["tasks"]) for r in placed]
    assert len(tasks) == 10 and all(len(t) == 1 for t in tasks) and len(set(tasks)) == 10
    got = {r["member"]: r["block"] for r in blocks.collect()}
    assert got == {k: v.rstrip("\n") for k, v in members.items()}


def test_directories_are_read_by_one_job(spark, tmp_path):
    for i in range(6):
        write_zip(tmp_path / f"a{i}.zip", {f"M{j}": text(5, j) for j in range(3)})
    with zipfile.ZipFile(tmp_path / "folders.zip", "w") as archive:
        archive.mkdir("empty")
    (tmp_path / "broken.zip").write_bytes(b"PK")
    n, found = jobs_of(spark, "directories", lambda: archive_members(binary_files(spark, str(tmp_path))).collect())
    assert n == 1 and len(found) == 19
    assert [r["path"].rsplit("/", 1)[1] for r in found if r["error"]] == ["broken.zip"]


@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA])
def test_members_of_every_kind(spark, tmp_path, method):
    members = {"é a.csv": text(20_000, 1), "empty": "", "line": "x" * 3_000_000, "cr": "a\r\nb\rc\n\n", "zeros": "0\n" * 2_000_000}
    write_zip(tmp_path / "Peças 1.zip", members, method)
    got = archive_lines(binary_files(spark, str(tmp_path))).groupBy("member").agg(
        F.count("*").alias("n"), F.max(F.length("line")).alias("most")
    )
    expected = {}
    for name, value in members.items():
        lines = [x for x in value.replace("\r\n", "\n").replace("\r", "\n").split("\n") if x]
        if lines:
            expected[name] = (len(lines), max(map(len, lines)))
    assert {r["member"]: (r["n"], r["most"]) for r in got.collect()} == expected


def test_a_damaged_member_is_told(spark, tmp_path):
    write_zip(tmp_path / "a.zip", {"one": text(5000, 1), "two": text(5000, 2), "three": text(10, 3)})
    data = bytearray((tmp_path / "a.zip").read_bytes())
    with zipfile.ZipFile(tmp_path / "a.zip") as archive:
        place = archive.getinfo("two").header_offset
        after = archive.getinfo("three").header_offset
    data[(place + after) // 2] ^= 0x55
    (tmp_path / "a.zip").write_bytes(bytes(data))
    blocks = archive_blocks(binary_files(spark, str(tmp_path))).collect()
    assert {b["member"] for b in blocks if b["error"]} == {"two"}
    assert {b["member"] for b in blocks if not b["error"]} >= {"one", "three"}
    spark.sql(f"CREATE DATABASE IF NOT EXISTS raw_damaged LOCATION '{tmp_path}/db'")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "Motivos0.zip").write_bytes(bytes(data))
    write_zip(tmp_path / "in" / "Motivos1.zip", {"A": '"01";"X"\n'})
    report = bronze.load_register(
        spark, str(tmp_path / "in"), "raw_damaged", str(tmp_path / "raw"), "raw_damaged.controle", str(tmp_path / "control")
    )
    assert rows(report, "status", "files") == [("failed", 1), ("loaded", 1)]
    assert rows(spark.table("raw_damaged.motivos"), "codigo_motivo") == [("01",)]


def test_headers_of_many_files_take_a_fixed_number_of_jobs(spark, tmp_path):
    def folder(name, n):
        (tmp_path / name).mkdir()
        paths = []
        for i in range(n):
            path = tmp_path / name / f"EXP_{1000 + i}.csv"
            header = ("A;B;C", "C;B;A", "B;A", "\n\nA;B;C;D")[i % 4]
            path.write_text(header + "\n" + ";".join("x" * (1 + header.count(";"))) + "\n")
            paths.append(f"file://{path}")
        return paths

    few, many = folder("few", 8), folder("many", 200)
    counts = []
    for name, paths in (("few", few), ("many", many)):
        n, (scans, refused) = jobs_of(spark, f"headers-{name}", lambda p=paths: by_header(spark, p, ["A", "B", "C"]))
        counts.append(n)
        assert len(scans) == 3 and len(refused) == len(paths) // 4
        assert sum(s.count() for s in scans) == 3 * len(paths) // 4
    # Beyond 32 paths Spark lists the files of each scan by a job of its own; there is a scan for each header.
    assert counts[0] <= 3 and counts[1] <= counts[0] + 3


def test_first_lines_on_any_file_system(spark, tmp_path):
    (tmp_path / "in").mkdir()
    long = "é;" * 90_000 + "z"
    files = {"a+%é.csv": "A;B\nx;y\n", "b.csv": "\r\n \r\nB;\"A;c\"\r\n1;2\r\n", "c.csv": "", "d d.csv": long, "e.csv": "A;B"}
    for name, value in files.items():
        (tmp_path / "in" / name).write_bytes(value.encode("ISO-8859-1"))
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.heads.link./in", f"file://{tmp_path}/in")
    wanted = {"a+%é.csv": "A;B", "b.csv": 'B;"A;c"', "c.csv": "", "d d.csv": long, "e.csv": "A;B"}
    for root in (f"file://{tmp_path}/in", "viewfs://heads/in"):
        paths = [f"{root}/{name}" for name in files]
        got = {r["path"].rsplit("/", 1)[1]: (r["line"], r["error"]) for r in first_lines(spark, paths).collect()}
        assert got == {k: (v, None) for k, v in wanted.items()}
    groups, failed = files_by_header(spark, [f"file://{tmp_path}/in/e.csv", f"file://{tmp_path}/in/none.csv"])
    assert list(groups) == [("A", "B")] and len(failed) == 1 and "none.csv" in failed[0][0]


def test_names_are_those_spark_gives(spark, tmp_path):
    for i, line in enumerate(["A;B;C", "A;;C", "A;a;B", '"x;y";Z', "A"]):
        path = tmp_path / f"{i}.csv"
        path.write_text(line + "\n")
        assert header_names(line) == spark.read.options(header=True, sep=";").csv(str(path)).columns
