"""WARC archives: writing pages with revisits, and reading them back by boundary-chain verification.

Both directions use Spark's text source, so archives live in any store that Spark reaches and large ones are split.
Reading takes every place of the magic line as a candidate record. A candidate names its successor by its length;
only what the chain from the start of the file reaches is a record, the rest is payload. A chain is first
shortened to its exits inside a block, so that pointers jump over blocks, in as many rounds as the logarithm of
their number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from aduana.llm.common import written
from aduana.session import fresh_path

# Fixed values of the format.
MAGIC = "WARC/1.0\r\n"
BREAK = "\r\n"
RECORD_ID = "urn:x-page:"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
BASE32HEX, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Payloads of fewer bytes are always written whole.
MIN_REVISIT_BYTES = 0
RECORDS_PER_FILE = 100_000


def sha1_base32(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 15, 15 and 10 hex digits are 12, 12 and 8 of base 32."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, at, n), 16, 32), n * 4 // 5, "0") for at, n in ((1, 15), (16, 15), (31, 10))]
    return F.translate(F.concat(*parts), BASE32HEX, BASE32)


def _bytes(c: Column) -> Column:
    return F.octet_length(c)


def with_types(
    spark: SparkSession, pages: DataFrame, id_col: str, url_col: str, html_col: str, min_bytes: int
) -> DataFrame:
    """(id, url, payload, bytes, digest, refers_to): refers_to is null for a response."""
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"),
        _bytes(payload).cast("long").alias("bytes"), sha1_base32(payload.cast("binary")).alias("digest"),
    )
    # Counted in the map tasks first; only payloads that repeat are joined, without any text. As a table its size
    # is known when the join is planned, so Spark broadcasts it only if it is small.
    repeated = rows.filter(F.col("bytes") >= min_bytes).groupBy("digest", "bytes").agg(
        F.count(F.lit(1)).alias("n"), F.max("id").alias("last")
    ).filter("n > 1").drop("n")
    marked = rows.join(written(spark, repeated, "repeated"), ["digest", "bytes"], "left")
    # A page without id can't be named and refers to nothing if no page of its payload has one.
    other = F.col("last").isNotNull() & ~F.col("id").eqNullSafe(F.col("last"))
    return marked.select(
        "id", "url", "payload", "bytes", "digest", F.when(other, F.col("last")).alias("refers_to")
    )


def record(id_: Column, url: Column, payload: Column, bytes_: Column, digest: Column, refers_to: Column) -> Column:
    """The whole record as a string but for its last line feed. The block of a response is the HTTP head and the
    payload, that of a revisit the head alone, which still states the length of the payload."""
    def line(name: str, *value: Column | str) -> Column:
        return F.concat(F.lit(f"{name}: "), *[v if isinstance(v, Column) else F.lit(v) for v in value], F.lit(BREAK))

    head = F.concat(
        F.lit("HTTP/1.1 200 OK" + BREAK), line("Content-Type", "text/html; charset=utf-8"),
        line("Content-Length", bytes_.cast("string")), F.lit(BREAK),
    )
    revisit = refers_to.isNotNull()
    block_bytes = _bytes(head) + F.when(revisit, 0).otherwise(bytes_)
    name = F.concat(F.lit(f"<{RECORD_ID}"), F.coalesce(id_.cast("string"), F.lit("")), F.lit(">"))
    plain_url = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7F]", "")  # nothing ends the line early
    return F.concat(
        F.lit(MAGIC), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", name), line("WARC-Date", "1970-01-01T00:00:00Z"),
        line("WARC-Target-URI", plain_url), line("WARC-Payload-Digest", "sha1:", digest),
        F.when(revisit, F.concat(
            line("WARC-Refers-To", F.concat(F.lit(f"<{RECORD_ID}"), refers_to.cast("string"), F.lit(">"))),
            line("WARC-Profile", PROFILE),
        )).otherwise(""),
        line("Content-Type", "application/http; msgtype=response"),
        line("Content-Length", block_bytes.cast("string")), F.lit(BREAK),
        head, F.when(revisit, "").otherwise(payload), F.lit(BREAK + "\r"),
    )


def write_archives(
    spark: SparkSession, pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
    html_col: str = "html", min_bytes: int = MIN_REVISIT_BYTES, records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """One record per row in the archives of a new folder.

    Of rows with equal payloads of at least `min_bytes` bytes the one with the largest id is the response, others
    revisit it; rows that tie for the largest are all responses, and so are all rows if none of them has an id. A
    null payload is empty. Control characters and blanks of a url go; a null url is empty. An empty table gives an
    empty folder; other columns are not read.
    """
    rows = with_types(spark, pages, id_col, url_col, html_col, min_bytes)
    text = rows.select(record(*[F.col(c) for c in ("id", "url", "payload", "bytes", "digest", "refers_to")]).alias("value"))
    text.write.option("lineSep", "\n").option("maxRecordsPerFile", records_per_file).text(path)


def _header(header: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(header, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1), F.lit(""))


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """The text between two places of the magic, with its file and block. Rows of a block keep their order."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("file_bytes"), F.monotonically_increasing_id().alias("at"), "value",
    )


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """One row per chunk: its offset, that of its successor, and the record it is if nothing is missing.

    offset is the place of the magic before the chunk. next is null if the chunk has no header that states a
    length. whole says that the chunk is exactly as long as its header states.
    """
    header = F.substring_index("value", BREAK * 2, 1)
    header_bytes = _bytes(header) + 4
    length = F.try_to_number(_header(F.col("header"), "Content-Length"), F.lit("9" * 18)).cast("long")
    scanned = _chunks(spark, path).withColumn("bytes", _bytes("value").cast("long")).withColumn("header", header)
    scanned = scanned.withColumn("header_bytes", header_bytes.cast("long")).withColumn(
        "length", F.when(F.col("header_bytes") <= F.col("bytes"), length)
    )
    whole = F.col("bytes") == F.col("header_bytes") + F.col("length") + 4
    block = F.substring(F.col("value").cast("binary"), F.col("header_bytes").cast("int") + 1, F.col("length").cast("int"))
    parsed = scanned.withColumn("whole", F.coalesce(whole, F.lit(False))).select(
        "file", "block", "file_bytes", "at", "bytes", "header_bytes", "length", "whole",
        F.when(F.col("whole"), F.struct(*_record_columns(F.col("header"), block))).alias("record"),
    )
    placed = written(spark, parsed, "chunks")
    # Offsets: sums over the chunks of a block, and over the blocks of a file, which are few and without text.
    of_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    of_block = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    size = F.lit(len(MAGIC))
    starts = placed.groupBy("file", "block").agg(F.sum(F.col("bytes") + size).alias("n")).select(
        "file", "block", F.coalesce(F.sum("n").over(of_file), F.lit(0)).alias("start")
    )
    before = F.coalesce(F.sum(F.col("bytes") + size).over(of_block), F.lit(0))
    rows = placed.withColumn("before", before).join(starts, ["file", "block"])
    offset = F.col("start") + F.col("before") - size
    return rows.withColumn("offset", offset).withColumn(
        "next", F.when(F.col("offset") >= 0, F.col("offset") + size + F.col("header_bytes") + F.col("length") + 4)
    ).select("file", "block", "file_bytes", "offset", "next", "bytes", "whole", "record")


def _record_columns(header: Column, block: Column) -> list[Column]:
    """What a record says; bytes and digest of a response are those of its real payload."""
    head = F.substring_index(block.cast("string"), BREAK * 2, 1)
    payload = F.substring(block, _bytes(head) + 5, F.lit(2**31 - 1))
    revisit = _header(header, "WARC-Type") == "revisit"
    named = F.regexp_extract(F.coalesce(_header(header, "WARC-Record-ID"), F.lit("")), RECORD_ID + "([^>]*)", 1)
    refers = F.regexp_extract(F.coalesce(_header(header, "WARC-Refers-To"), F.lit("")), RECORD_ID + "([^>]*)", 1)
    stated = F.regexp_replace(F.coalesce(_header(header, "WARC-Payload-Digest"), F.lit("")), "^sha1:", "")
    return [
        F.nullif(named, F.lit("")).alias("id"), _header(header, "WARC-Type").alias("type"),
        _header(header, "WARC-Target-URI").alias("url"),
        F.when(revisit, _header(head, "Content-Length").cast("long")).otherwise(_bytes(payload).cast("long")).alias("payload_bytes"),
        F.when(revisit, stated).otherwise(sha1_base32(payload)).alias("payload_digest"),
        stated.alias("stated_digest"), F.nullif(refers, F.lit("")).alias("refers_to"),
    ]


def _exits(rows: pa.Table) -> pa.Table:
    """Of one block: where the chain of each candidate leaves it."""
    offsets, following, at = _chain(rows)
    exits = np.where(at >= 0, 0, following)
    for i in range(len(offsets) - 1, -1, -1):  # a successor lies further on
        if at[i] >= 0:
            exits[i] = exits[at[i]]
    n = len(offsets)
    return pa.table({
        "file": pa.array([rows["file"][0].as_py()] * n, pa.string()) if n else pa.array([], pa.string()),
        "offset": pa.array(offsets), "exit": pa.array(exits),
    })


def _chain(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidates by offset: their successors' offsets, and places in the block or -1."""
    known = rows.filter(pc.is_valid(rows["next"]))
    offsets, following = known["offset"].to_numpy(), known["next"].to_numpy()
    order = np.argsort(offsets)
    offsets, following = offsets[order], following[order]
    at = np.searchsorted(offsets, following)
    found = at < len(offsets)
    found[found] = offsets[at[found]] == following[found]
    return offsets, following, np.where(found, at, -1)


def _reached(left: pa.Table, right: pa.Table) -> pa.Table:
    """Of one block: the candidates on the chains that enter it at the offsets of the right table."""
    offsets, _, at = _chain(left)
    on = np.zeros(len(offsets), bool)
    for entry in right["offset"].to_pylist():
        i = int(np.searchsorted(offsets, entry))
        if i == len(offsets) or offsets[i] != entry:
            continue
        while i >= 0 and not on[i]:
            on[i] = True
            i = int(at[i])
    return left.filter(pc.is_in(left["offset"], pa.array(offsets[on], pa.int64())))


def chained(spark: SparkSession, found: DataFrame) -> DataFrame:
    """The candidates that the chain from the start of their file reaches."""
    blocks = found.select("file", "block").distinct()
    most = blocks.groupBy("file").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    entries = found.filter("offset = 0").select("file", "offset")
    if most > 1:
        jumps = written(spark, found.groupBy("file", "block").applyInArrow(
            _exits, "file string, offset long, exit long"
        ), "exits")
        # Only where a chain may enter a block matters from here on: a few rows for each block.
        doors = jumps.select("file", F.col("exit").alias("offset")).distinct().unionByName(entries).distinct()
        jumps = written(spark, jumps.join(doors, ["file", "offset"]), "doors")
        reach, span = entries, 1
        while span < most:
            step = jumps.select("file", "offset", "exit")
            reach = reach.unionByName(reach.join(step, ["file", "offset"]).select("file", F.col("exit").alias("offset")))
            reach = written(spark, reach.distinct(), "reached")
            further = jumps.select("file", F.col("offset").alias("exit"), F.col("exit").alias("far"))
            jumps = written(spark, jumps.join(further, ["file", "exit"]).select(
                "file", "offset", F.col("far").alias("exit")
            ), "jumps")
            span *= 2
        entries = reach
    place = found.select("file", "block", "offset")
    entries = written(spark, entries.join(place, ["file", "offset"]).select("file", "block", "offset"), "entries")
    return found.groupBy("file", "block").cogroup(entries.groupBy("file", "block")).applyInArrow(_reached, found.schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(id, type, url, payload_bytes, payload_digest, stated_digest, refers_to) of every record below `path`.

    Ids are text. Raises ValueError if the chain of a file does not end where the file does: what follows the break
    would be lost. An empty folder gives no row.
    """
    found = written(spark, candidates(spark, path), "candidates")
    records = written(spark, chained(spark, found), "records")
    ends = records.groupBy("file").agg(F.max("next").alias("end"))
    files = found.filter("file_bytes > 0").groupBy("file").agg(F.max("file_bytes").alias("file_bytes"))
    broken = files.join(ends, "file", "left").filter("not (end <=> file_bytes)").select("file").first()
    if broken:
        raise ValueError(f"the records of {broken[0]} do not end where the file does")
    whole = records.filter("whole").select("record.*")
    split = records.filter("not whole").select("file", "offset", "next")
    if split.isEmpty():
        return whole
    return whole.unionByName(_assembled(spark, path, found, written(spark, split, "split")))


def _assembled(spark: SparkSession, path: str, found: DataFrame, split: DataFrame) -> DataFrame:
    """Records with the magic inside, put together from their chunks. Only blocks that hold such chunks are read
    again, and only these chunks are moved; a record's chunks meet as its bytes must."""
    # The last such record that has begun is carried forward, inside blocks and then over the blocks of a file.
    marks = split.select("file", "offset", F.struct(F.col("offset").alias("of"), F.col("next").alias("until")).alias("s"))
    marked = found.select("file", "block", "offset").join(marks, ["file", "offset"], "left")
    order = Window.partitionBy("file", "block")
    here = F.max("s").over(order.orderBy("offset").rowsBetween(Window.unboundedPreceding, 0))  # starts ascend
    of_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = marked.groupBy("file", "block").agg(F.max("s").alias("s")).select(
        "file", "block", F.max("s").over(of_file).alias("before")
    )
    inside = marked.withColumn("here", here).join(carried, ["file", "block"]).select(
        "file", "block", F.col("offset").alias("piece"), F.coalesce("here", "before").alias("s")
    ).filter("piece < s.until").select("file", "block", "piece", "s.of")
    inside = written(spark, inside, "inside")
    first = found.groupBy("file", "block").agg(F.min("offset").alias("first"))
    size = F.lit(len(MAGIC))
    blocks = inside.select("file", "block").distinct().join(first, ["file", "block"])
    again = _chunks(spark, path).join(blocks, ["file", "block"])
    before = F.coalesce(
        F.sum(F.octet_length("value") + size).over(
            order.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        ), F.lit(0),
    )
    texts = again.withColumn("piece", F.col("first") + before).select("file", "piece", "value")
    joined = texts.join(inside.select("file", "piece", "of"), ["file", "piece"]).groupBy("file", "of").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "value"))), lambda x: x["value"]), MAGIC)
        .alias("value")
    )
    header = F.substring_index("value", BREAK * 2, 1)
    length = _header(F.col("header"), "Content-Length").cast("int")
    block = F.substring(F.col("value").cast("binary"), _bytes("header") + 5, length)
    return joined.withColumn("header", header).select(*_record_columns(F.col("header"), block))


def op4_warc(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Archives of all pages, read back."""
    path = fresh_path(spark, "warc")
    write_archives(spark, pages, path)
    kind = pages.schema["page_id"].dataType
    return read_archives(spark, path).select(
        F.col("id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), F.col("refers_to").cast(kind).alias("refers_to"),
    )


OP4_SQL = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
    SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
        list_aggregate(list_transform(range(0, 8), lambda i: list_aggregate(list_transform(range(0, 4), lambda j:
            substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + ((('0x' || substr(hex, 1 + 5 * i::INT, 5))::BIGINT >> (15 - 5 * j::INT)) & 31)::INT, 1)
        ), 'string_agg', '')), 'string_agg', '') AS payload_digest
    FROM p
), m AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM d
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN last IS NOT NULL AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN last IS NOT NULL AND page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM m
"""
