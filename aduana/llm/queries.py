"""The operators over the given tables: name -> (spark, folder) -> DataFrame, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aduana.llm.chat import op1_chat
from aduana.llm.common import shipped, table
from aduana.llm.exact import OP13_SQL, op13_exact
from aduana.llm.fingerprints import op6_fingerprints
from aduana.llm.licenses import op2_licenses
from aduana.llm.mixing import op3_mixing
from aduana.llm.packing import op10_packing
from aduana.llm.pii import op9_pii
from aduana.llm.quality import op5_quality
from aduana.llm.runs import op12_runs
from aduana.llm.simhash import op7_simhash
from aduana.llm.trie import OP11_SQL, op11_query
from aduana.llm.urls import op8_urls
from aduana.llm.warc import OP4_SQL, op4_warc

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "op1_chat": lambda s, d: op1_chat(s, table(s, d, "conversations")),
        "op2_licenses": lambda s, d: op2_licenses(s, table(s, d, "documents")),
        "op3_mixing": lambda s, d: op3_mixing(s, table(s, d, "documents")),
        "op4_warc": lambda s, d: op4_warc(s, table(s, d, "pages")),
        "op5_quality": op5_quality,
        "op6_fingerprints": lambda s, d: op6_fingerprints(s, table(s, d, "documents")),
        "op7_simhash": lambda s, d: op7_simhash(s, table(s, d, "documents")),
        "op8_urls": lambda s, d: op8_urls(s, table(s, d, "pages")),
        "op9_pii": lambda s, d: op9_pii(s, table(s, d, "documents")),
        "op10_packing": lambda s, d: op10_packing(table(s, d, "documents")),
        "op11_trie": op11_query,
        "op12_runs": op12_runs,
        "op13_exact": op13_exact,
    }
    return {name: shipped(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return {"op4_warc": OP4_SQL, "op11_trie": OP11_SQL, "op13_exact": OP13_SQL}
