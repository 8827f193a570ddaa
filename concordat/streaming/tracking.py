"""Incremental tracking: every arriving snapshot updates the tracking table.

Arrivals are Parquet folders ``(flux_id, kind, kpep, motif)`` where kind is
FOUND or ELIGIBLE.  The stream only decides which files are new; the update is
one pass over all runs of a batch, written as whole run partitions, so a
replayed batch leaves the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.functions import run_date
from concordat.operators.common import lookup_join
from concordat.session import materialize
from concordat.sources import state

ARRIVAL = T.StructType(
    [
        T.StructField("flux_id", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("kpep", T.StringType()),
        T.StructField("motif", T.StringType()),
    ]
)
EMPTY = "flux_id string, kpep string, date_found date, motif string"


def tracking_table(spark: SparkSession, path: str) -> DataFrame:
    """Current tracking rows; empty before the first run."""
    if not state.table_exists(spark, path):
        return spark.createDataFrame([], EMPTY)
    return spark.read.schema(EMPTY).parquet(path).select("flux_id", "kpep", "date_found", "motif")


def apply_arrivals(batch: DataFrame, path: str, today: str) -> None:
    """Update the table with one batch of arrivals.

    A key found in a run dates the open rows of that run and of earlier ones,
    whichever arrives first: rows that come late are dated by the later runs
    that the table already knows.  So the table does not depend on how the files
    of a run fall into batches.

    All runs of the batch are one pass: arrivals and table rows meet by run and
    key, the last day a key was found is a maximum per key, and every row up to
    that day is dated.  A dated row of the table proves that its key was found on
    that run's day or later.  Runs whose rows changed are written whole, once.
    """
    new = batch.select(
        "flux_id", F.when(F.col("kind") == "FOUND", F.btrim("kpep")).otherwise(F.col("kpep")).alias("kpep"),
        (F.col("kind") == "FOUND").alias("found"), F.when(F.col("kind") == "ELIGIBLE", F.col("motif")).alias("m1"),
    ).where("NOT found OR kpep <> ''")
    new = new.groupBy("flux_id", "kpep").agg(F.bool_or("found").alias("found"), F.max("m1").alias("m1"), F.lit(True).alias("arrived"))
    old = tracking_table(batch.sparkSession, path).select("flux_id", "kpep", F.col("date_found").alias("d0"), F.col("motif").alias("m0"))
    rows = old.join(new, ["flux_id", "kpep"], "full_outer").withColumn("day", run_date(F.col("flux_id")))
    proof = F.when(F.coalesce("found", F.lit(False)) | F.col("d0").isNotNull(), F.col("day"))
    last = rows.groupBy("kpep").agg(F.max(proof).alias("last")).where("last IS NOT NULL")
    dated = lookup_join(rows, last, ["kpep"]).select(
        "flux_id", "kpep", F.coalesce("d0", F.when(F.col("day") <= F.col("last"), F.lit(today).cast("date"))).alias("date_found"),
        F.greatest("m0", "m1").alias("motif"), (F.coalesce("arrived", F.lit(False)) | (F.col("d0").isNull() & (F.col("day") <= F.col("last")))).alias("changed"),
    )
    # Reading and rewriting the same folder: fix the rows before the write.
    dated = materialize(dated)
    runs = dated.where("changed").select("flux_id").distinct()
    state.write_snapshot(dated.drop("changed").join(runs, "flux_id", "left_semi"), path)


def incremental_tracking(spark: SparkSession, arrivals: str, table: str, checkpoint: str, today: str, files_per_batch: int = 100) -> None:
    """Process everything that has arrived, then stop."""
    stream = spark.readStream.schema(ARRIVAL).option("maxFilesPerTrigger", files_per_batch).parquet(arrivals)
    query = (
        stream.writeStream.foreachBatch(lambda df, _: apply_arrivals(df, table, today))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
