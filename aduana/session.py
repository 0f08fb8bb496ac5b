"""Spark session defaults and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution picks partition counts, turns a shuffled join into a broadcast join once the
# small side's real size is known, and splits hot partitions. Nothing here is tied to a data size.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "aduana", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; `conf` uses double underscores for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_fallback_root: str | None = None
_made: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in `spark.checkpoint.dir`.

    A local session, whose executors are the driver, may do without: a temporary folder is made.
    """
    global _fallback_root
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors reach")
    if _fallback_root is None:
        _fallback_root = tempfile.mkdtemp(prefix="aduana-")
    return _fallback_root


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    _made.append(f"{shared_folder(spark)}/aduana/{label}-{uuid.uuid4().hex}")
    return _made[-1]


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def clean_up(spark: SparkSession, keep: tuple[str, ...] = ()) -> int:
    """Delete the working copies this process made, but for those below a path in `keep`; returns
    how many. Call it when no DataFrame or table that reads them is needed any more."""
    gone = [p for p in _made if not any(p.startswith(k) for k in keep)]
    for path in gone:
        delete_path(spark, path)
        _made.remove(path)
    return len(gone)
