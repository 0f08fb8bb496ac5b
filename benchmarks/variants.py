"""Times the plain way of asking a question against the way the operators ask it.

Prints one JSON line per pair; BENCH_SF_DIR and BENCH_CPUS as in bench.py.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window, functions as F  # noqa: E402

from aduana.checks import binding as b, registry  # noqa: E402
from aduana.functions.measures import month_start, percent  # noqa: E402
from aduana.operators.flows import EXPORT, IMPORT  # noqa: E402
from aduana.operators.upsert import merged, staged, upsert_table  # noqa: E402
from aduana.plans import company, trade as t  # noqa: E402
from aduana.session import build_session, fresh_path  # noqa: E402

RUNS = 5


def monthly_by_outer_join(s, d):
    sides = [
        b.facts(s, d, flow).groupBy("ano", "mes").agg(F.sum("vl_fob").alias(f"VL_FOB_{flow}"))
        for flow in (EXPORT, IMPORT)
    ]
    both = sides[0].join(sides[1], ["ano", "mes"], "full_outer")
    return both.withColumn("VL_SALDO_COMERCIAL", F.col("VL_FOB_EXP") - F.col("VL_FOB_IMP")).withColumn(
        "DATA", month_start("ano", "mes")
    )


def blocs_filtered_last(s, d):
    every = b.read(s, d, "part").select(b.code("p_partkey", 8).alias("CO_NCM"))
    facts = b.located_trade(s, d, every)
    totals = facts.join(b.blocs(s, d), "co_pais", "left").groupBy("no_bloco", "co_ncm", "fluxo").agg(F.sum("vl_fob"))
    top = registry.top10(s, d).select(F.col("CO_NCM").alias("co_ncm"))
    return totals.join(top, "co_ncm")


def share_by_window(s, d):
    rows = t.factor_share(b.trade(s, d), b.ncm(s, d), b.factors(s, d), within=["ANO"])
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.withColumn("PERC_TOTAL_EXP", percent("VL_FOB_EXP", F.sum("VL_FOB_EXP").over(whole)))


def companies_by_count_distinct(s, d):
    sites = company._active_sites(b.sites(s, d))
    flag = F.col("identificador_matriz_filial") == "1"
    return sites.join(b.companies(s, d), "cnpj_basico").groupBy("classe", "uf", "porte_empresa").agg(
        F.count_distinct("cnpj_basico"), F.count_distinct(F.when(flag, F.col("cnpj_basico")))
    )


def companies_by_two_levels(s, d):
    sites = company._active_sites(b.sites(s, d))
    flag = F.col("identificador_matriz_filial") == "1"
    per_company = sites.groupBy("cnpj_basico", "classe", "uf").agg(F.bool_or(flag).alias("matriz"))
    return per_company.join(b.companies(s, d), "cnpj_basico").groupBy("classe", "uf", "porte_empresa").agg(
        F.count(F.lit(1)), F.count_if("matriz")
    )


class MonthlyUpsert:
    """One changed month against a table partitioned by month."""

    def __init__(self, s, d):
        self.path, self.name = fresh_path(s, "bench-upsert"), f"bench_{uuid.uuid4().hex[:12]}"
        self.keys = ["ano", "mes", "l_orderkey", "l_linenumber"]
        lines = registry._latest_lines(registry._lines(s, d)).withColumns(
            {"ano": F.year("l_shipdate"), "mes": F.month("l_shipdate")}
        )
        upsert_table(s, self.name, lines, self.keys, self.path, ["ano", "mes"])
        self.batch = staged(s, s.table(self.name).filter("ano = 1998 AND mes = 5"), "bench-batch")

    def full_rewrite(self, s, d):
        merged(s.table(self.name), self.batch, self.keys).write.partitionBy("ano", "mes").parquet(
            fresh_path(s, "bench-rewrite")
        )

    def touched_partitions(self, s, d):
        upsert_table(s, self.name, self.batch, self.keys, self.path, ["ano", "mes"])


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "variants", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    upsert = MonthlyUpsert(spark, sf_dir)
    pairs = [
        ("monthly_balance", "outer join", monthly_by_outer_join, "tagged union", queries["monthly_balance"]),
        ("bloc_trade", "filter after aggregate", blocs_filtered_last, "filter before", queries["bloc_trade"]),
        ("factor_share", "window", share_by_window, "scalar subquery", queries["factor_share"]),
        ("companies per class, state and size", "two count distinct", companies_by_count_distinct, "two-level", companies_by_two_levels),
        ("upsert of one month", "full rewrite", upsert.full_rewrite, "touched partitions", upsert.touched_partitions),
    ]

    def median(query) -> float:
        seconds = []
        for _ in range(RUNS + 1):
            began = time.perf_counter()
            df = query(spark, sf_dir)
            if df is not None:
                df.write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - began)
        return round(statistics.median(seconds[1:]), 3)

    for name, plain_label, plain, ours_label, ours in pairs:
        print(json.dumps({"query": name, plain_label: median(plain), ours_label: median(ours)}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
