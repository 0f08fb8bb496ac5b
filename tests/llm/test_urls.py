from __future__ import annotations

import numpy as np
import pyarrow as pa

from aduana.llm.urls import RULES, _split, judged, op8_urls, trained
from aduana.llm.urls_table import LABELLED
from tests.llm.cases import crowded, table

ODD = [
    (1, "http://A.Example.ORG/es/x"), (2, "http://example.org/en/12?x"), (3, "https://notexample.org/es/"),
    (4, "http://org/"), (5, "http://x.org"), (6, "http://x.com/fr/#a"), (7, "//x.com/de/"), (8, None), (9, ""),
    (10, "a://b.com/de/://c.org/"), (11, "http://x.com/FR/"), (12, "http://ÉÀ.com/de/é"), (None, "http://x.com/de/"),
    (13, "http://a\nb.org/p\nq?r"), (14, "://"), (15, "http://example.org?/es/"), (1, "http://A.Example.ORG/es/x"),
    (16, "http://x.com/" + "a" * 100_000), (17, "http://user@x.org:80/es/"),
]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:end], rest[end:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    return host, path, best and best[1] + best[2], best and best[0]


def test_rules_by_brute_force(spark):
    for df in (table(spark, "pages"), crowded(spark.createDataFrame(ODD, "page_id long, url string"))):
        model = trained()
        rows = op8_urls(spark, df).collect()
        got = sorted([(r["page_id"], r["host"], r["path"], r["rule"]) for r in rows], key=repr)
        assert got == sorted([(r["page_id"], *brute(r["url"])[:3]) for r in df.collect()], key=repr)
        by_place = {(r["host"], r["path"]): r for r in rows}
        for r in df.collect():
            host, path, rule, verdict = brute(r["url"])
            found = by_place[(host, path)]
            if rule is None:
                p = model.probabilities(pa.array([host]), pa.array([path]))[0]
                verdict = "block" if p > 0.5 else "allow"
                assert abs(found["probability"] - p) < 1e-9
            assert found["verdict"] == verdict
    assert op8_urls(spark, table(spark, "pages").limit(0)).count() == 0


def test_other_rules(spark):
    df = spark.createDataFrame([(1, "http://a.net/x/y")], "page_id long, url string")
    rules = [("allow", "net", "/"), ("block", "net", "/x/"), ("allow", "a.net", "/x/y")]
    assert judged(df, rules=rules).first()["verdict"] == "allow"
    assert judged(df, rules=rules[:2]).first()["verdict"] == "block"


def test_held_out_accuracy():
    right = 0
    for fold in range(6):
        model = trained([x for i, x in enumerate(LABELLED) if i % 6 != fold])
        held = LABELLED[fold::6]
        parts = [_split(url) for url, _ in held]
        p = model.probabilities(pa.array([x[0] for x in parts]), pa.array([x[1] for x in parts]))
        right += int(((p > 0.5) == np.array([label for _, label in held])).sum())
    assert right / len(LABELLED) > 0.9
