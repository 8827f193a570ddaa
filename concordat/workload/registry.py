"""Registration of queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from concordat.session import fit_tasks
from concordat.workload import frames

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Frames:
    """Frames of one data folder, built on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.plans: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        return frames.raw(self.spark, self.sf_dir, name, self.plans)


def query(key: str, sql: str | None = None):
    """Register ``fn(frames) -> DataFrame`` under ``key`` with its SQL twin."""

    def wrap(fn: Callable[[Frames], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            fit_tasks(spark, (f"{sf_dir}/{t}.parquet" for t in frames.TABLES))
            return fn(Frames(spark, sf_dir))

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return wrap
