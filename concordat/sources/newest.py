"""Newest attributes of every person, kept as a table that each run advances.

Partition ``flux_id`` of the state holds, for every person of that run and of all
earlier ones, the attributes of the newest snapshot that has the person, with its run
as ``source_run``.  A run reads its own snapshot partition and the partition before
it, never the history, and writes its own partition whole; running it again changes
nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.functions import run_date
from concordat.operators.common import first_row
from concordat.operators.lookups import ATTRIBUTES, historical_lookup
from concordat.sources.state import PARTITION, table_exists, write_snapshot


def _table(spark: SparkSession, path: str) -> DataFrame:
    """A table partitioned by run; runs keep their leading zeros."""
    columns = ("person_id", "source_run", *ATTRIBUTES)
    return spark.read.schema(", ".join(f"{c} string" for c in (*columns, PARTITION))).parquet(path)


def _snapshots(spark: SparkSession, path: str) -> DataFrame:
    columns = ", ".join(f"{c} string" for c in ("person_id", *ATTRIBUTES, PARTITION))
    return spark.read.schema(columns + ", seq long").parquet(path)


def runs_of(spark: SparkSession, path: str) -> list[str]:
    """Runs that the state holds, by date; one row per run for the driver."""
    if not table_exists(spark, path):
        return []
    day = run_date(F.col(PARTITION))
    found = _table(spark, path).select(PARTITION).distinct().where(day.isNotNull()).orderBy(day)
    return [r[0] for r in found.collect()]


def _before(spark: SparkSession, runs: list[str], run: str) -> str | None:
    """The last of ``runs`` before ``run``."""
    order = {r: f"{r[4:]}{r[2:4]}{r[:2]}" for r in (*runs, run)}
    earlier = [r for r in runs if order[r] < order[run]]
    return max(earlier, key=order.__getitem__, default=None)


def bootstrap(spark: SparkSession, snapshots: str, state: str, run: str) -> None:
    """Start the state at ``run`` from all snapshots up to it, the only time the history is read."""
    rows = _snapshots(spark, snapshots).where(run_date(F.col(PARTITION)) <= run_date(F.lit(run)))
    newest = historical_lookup(rows).withColumnRenamed(PARTITION, "source_run")
    write_snapshot(newest.withColumn(PARTITION, F.lit(run)), state)


def merged(spark: SparkSession, snapshots: str, state: str, run: str, before: str | None) -> DataFrame:
    """The partition of ``run``: its own persons, and those of the partition ``before`` that it lacks."""
    rows = _snapshots(spark, snapshots).where((F.col(PARTITION) == run) & (F.coalesce("person_id", F.lit("")) != ""))
    own = first_row(rows.select("person_id", "seq", *ATTRIBUTES), ["person_id"], [F.col("seq")]).drop("seq").withColumn("source_run", F.lit(run))
    if before is None:
        return own.withColumn(PARTITION, F.lit(run))
    old = _table(spark, state).where(F.col(PARTITION) == before).drop(PARTITION)
    kept = old.join(own.select("person_id"), "person_id", "left_anti")
    return own.unionByName(kept).withColumn(PARTITION, F.lit(run))


def advance(spark: SparkSession, snapshots: str, state: str, run: str) -> list[str]:
    """Bring the state to ``run``; returns the runs written.

    A run that comes late is entered in its place, and the later partitions are advanced again, in order,
    each from the one before it.
    """
    runs = runs_of(spark, state)
    order = lambda r: f"{r[4:]}{r[2:4]}{r[:2]}"
    again = [run, *[r for r in runs if order(r) > order(run)]]
    for r in again:
        before = _before(spark, sorted({*runs, run}, key=order), r)
        write_snapshot(merged(spark, snapshots, state, r, before), state)
    return again


def newest_before(spark: SparkSession, state: str, current: str) -> DataFrame:
    """``(person_id, flux_id, attributes)`` as of the last run before ``current``, from one partition."""
    last = _before(spark, runs_of(spark, state), current)
    rows = _table(spark, state).where(F.lit(False) if last is None else F.col(PARTITION) == last)
    return rows.select("person_id", F.col("source_run").alias(PARTITION), *ATTRIBUTES)
