"""Session settings and lineage cutting."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

#: Settings that matter for these jobs on any cluster.  Shuffle partition
#: counts are left to AQE coalescing from a generous initial number.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call-site capture per column expression dominates the time to build wide plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "concordat", master: str | None = None, **extra: str) -> SparkSession:
    """Create a session with the settings above; ``extra`` wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Bytes of Parquet that one task of a scan or shuffle is meant to stand for.  Rows of
#: these tables take some forty times as much in a sort as in their files.
TASK_BYTES = 4 << 20
_LOWERED = {"spark.sql.files.maxPartitionBytes": TASK_BYTES, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 2 * TASK_BYTES}


def fit_tasks(spark: SparkSession, paths: Iterable[str]) -> None:
    """Size the session's tasks to the files a job reads, so that more input makes more tasks, not larger ones.

    Settings are tightened only: a session with more partitions or smaller splits keeps them.
    """
    path_of, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    files = [path_of(p) for p in paths]
    total = sum(p.getFileSystem(conf).getContentSummary(p).getLength() for p in files if p.getFileSystem(conf).exists(p))
    name = "spark.sql.shuffle.partitions"
    spark.conf.set(name, str(max(int(spark.conf.get(name)), -(-total // TASK_BYTES))))
    for name, most in _LOWERED.items():
        if _bytes(spark.conf.get(name)) > most:
            spark.conf.set(name, f"{most}b")


def _bytes(text: str) -> int:
    """Bytes of a size setting."""
    number, unit = re.fullmatch(r"(\d+)\s*([bkmgtp]?)b?", text.strip().lower()).groups()
    return int(number) << 10 * "bkmgtp".index(unit or "b")


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for shared intermediate results: the one that ``spark.checkpoint.dir`` names.

    Where it is unset a private folder stands in, but only on a local master: on
    a cluster every executor would write to its own disk, so this raises.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    named = named or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    master = spark.sparkContext.master
    if not re.match(r"local(\[|$)", master):
        raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
    return _private_folder()


@lru_cache
def _private_folder() -> str:
    return tempfile.mkdtemp(prefix="concordat-ckpt-")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Used where one intermediate result feeds many branches, so that the
    branches share one computation and survive executor loss.  The files of a
    session are deleted when Python exits.
    """
    return materialize_union([df])


def materialize_union(parts: Iterable[DataFrame]) -> DataFrame:
    """The rows of all ``parts``, written one after the other to one folder as by :func:`materialize`.

    The driver holds the plan of one part at a time, and only scans one folder
    afterwards.  The parts have one schema, and come from an iterator where
    building them all at once would be too much.
    """
    path = None
    for df in parts:
        if path is None:
            spark, schema = df.sparkSession, df.schema
            path = f"{checkpoint_dir(spark).rstrip('/')}/concordat-{uuid.uuid4().hex}"
            _written.append((spark, path))
        df.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


_written: list[tuple[SparkSession, str]] = []


@atexit.register
def remove_materialized() -> None:
    """Delete what :func:`materialize` wrote; a session that has ended leaves its files to its folder's owner."""
    while _written:
        spark, path = _written.pop()
        with contextlib.suppress(Exception):
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
