"""Tables that change run by run: reloads, ledgers, tracking, history.

State lives in Parquet folders partitioned by ``flux_id``.  A run rewrites
whole partitions, so running it again changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.functions import run_date
from concordat.operators.common import first_row, lookup_join

PARTITION = "flux_id"
# Key sets tried in order when loading.
LOAD_KEYS = (("realm_id",), ("idkpep", "realm_id"), ("email", "realm_id"))


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when the folder holds data."""
    try:
        return bool(spark.read.parquet(path).columns)
    except Exception as exc:  # noqa: BLE001
        if type(exc).__name__ == "AnalysisException":
            return False
        raise


def write_snapshot(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write per-run detail rows, partitioned by run."""
    writer = df.write.mode(mode).partitionBy(PARTITION).option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer.option("header", "true").option("sep", ";").csv(path)
    else:
        writer.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a state table; columns added by later runs are NULL in earlier ones."""
    df = spark.read.option("mergeSchema", "true").parquet(path)
    return df.withColumn(PARTITION, F.lpad(F.col(PARTITION).cast("string"), 8, "0"))


def replace_flux(df: DataFrame, path: str, flux_id: str, stamp: str) -> None:
    """Replace the rows of one run, stamped with the run and the load time."""
    out = df.withColumn(PARTITION, F.lit(flux_id)).withColumn("date_import", F.lit(stamp).cast("timestamp_ntz"))
    write_snapshot(out, path)


def reconcile_load(source: DataFrame, prepared: DataFrame, before: DataFrame, stored: DataFrame) -> DataFrame:
    """Per run: source, prepared, deleted and stored rows, the gap, and a verdict."""
    def count(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(PARTITION).agg(F.count("*").alias(name))

    out = count(source, "source_rows")
    for df, name in ((prepared, "prepared_rows"), (before, "deleted_rows"), (stored, "stored_rows")):
        out = out.join(count(df, name), PARTITION, "full_outer")
    n = {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("source_rows", "prepared_rows", "deleted_rows", "stored_rows")}
    status = F.when(n["prepared_rows"] == 0, "SKIPPED").when(n["stored_rows"] == n["prepared_rows"], "OK").otherwise("WARN")
    return out.select(PARTITION, *[c.alias(k) for k, c in n.items()], (n["prepared_rows"] - n["stored_rows"]).alias("gap"), status.alias("status"))


def evolve_schema(df: DataFrame, target: Sequence[str], conformance: Sequence[str] = ()) -> tuple[list[str], DataFrame]:
    """Columns to add to the target, and the rows projected onto the grown schema."""
    added = [c for c in df.columns if c not in target] + [c for c in conformance if c not in target and c not in df.columns]
    final = [*target, *added]
    cols = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in final]
    return added, df.select(*cols)


def dedupe_load(df: DataFrame, order: str = "seq") -> DataFrame:
    """First row per key, with the first key set whose columns all exist."""
    for keys in LOAD_KEYS:
        if set(keys) <= set(df.columns):
            return first_row(df, list(keys), [F.col(order)])
    return df


def append_history(df: DataFrame, path: str) -> None:
    """Append the rows of a run to the cumulative history."""
    write_snapshot(df, path, mode="append")


def store_kpi_payload(values: DataFrame, path: str, stamp: str) -> None:
    """Store one JSON document per run from ``(flux_id, path, value)`` rows."""
    doc = values.groupBy(PARTITION).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("path", "value"))))).alias("payload"))
    write_snapshot(doc.withColumn("date_import", F.lit(stamp).cast("timestamp_ntz")), path)


# ---- tracking ------------------------------------------------------------------------


def upsert_tracking(tracking: DataFrame, found: DataFrame, eligible: DataFrame, flux_id: str, today: str) -> DataFrame:
    """Tracking rows of one run after its control.

    Found keys are inserted with today's date, or date an open row; a date is
    never overwritten.  Eligible keys are inserted with their reason.  When a
    key comes with and without a reason, the reason wins, of several reasons
    the last in order.  So the parts of a run may arrive in any order.
    """
    old = tracking.where(F.col(PARTITION) == flux_id).select("kpep", F.col("date_found").alias("d0"), F.col("motif").alias("m0"))
    hit = found.select(F.btrim(F.col(found.columns[0])).alias("kpep")).where("kpep <> ''").distinct().withColumn("hit", F.lit(True))
    want = eligible.groupBy("kpep").agg(F.max("motif").alias("m1"))
    rows = old.join(hit, "kpep", "full_outer").join(want, "kpep", "full_outer")
    day = F.coalesce("d0", F.when(F.col("hit"), F.lit(today).cast("date")))
    return rows.select(
        F.lit(flux_id).alias(PARTITION), "kpep", day.alias("date_found"),
        F.greatest("m0", "m1").alias("motif"),
    )


def resolve_tracking(tracking: DataFrame, found: DataFrame, today: str) -> DataFrame:
    """Date open keys that are present now; dated keys stay as they are."""
    hit = found.select(F.btrim(F.col(found.columns[0])).alias("kpep")).where("kpep <> ''").distinct().withColumn("hit", F.lit(True))
    rows = lookup_join(tracking, hit, ["kpep"])
    day = F.when(F.col("date_found").isNull() & F.col("hit"), F.lit(today).cast("date")).otherwise(F.col("date_found"))
    return rows.select(PARTITION, "kpep", day.alias("date_found"), "motif")


def pending_window(tracking: DataFrame, today: str) -> DataFrame:
    """Open keys and the inclusive window from the oldest open run to today (one row)."""
    now = F.lit(today).cast("date")
    pending = tracking.where("date_found is null").agg(F.count("*").alias("pending"), F.min(run_date(F.col(PARTITION))).alias("oldest"))
    return pending.select("pending", F.least(F.coalesce("oldest", now), now).alias("window_start"), now.alias("window_end"))


# ---- documents of nested values ---------------------------------------------------------


def _leaves(value, path: str, sep: str) -> Iterator[tuple[str, str | None]]:
    """Paths and texts of the leaves below a parsed value."""
    stack = [(path, value)]
    while stack:
        path, value = stack.pop()
        if isinstance(value, dict):
            stack += [(f"{path}{sep}{k}" if path else k, v) for k, v in reversed(value.items())]
        elif isinstance(value, list) and any(isinstance(v, dict | list) for v in value):
            stack += [(f"{path} [{i}]", v) for i, v in reversed(list(enumerate(value)))]
        elif isinstance(value, list):
            yield path, ", ".join("" if v is None else _plain(v) for v in value)
        else:
            yield path, None if value is None else _plain(value)


def _plain(value) -> str:
    """A plain value as its JSON text; numbers keep theirs."""
    return str(value).lower() if isinstance(value, bool) else value


def _parsed(text: str):
    """A document with numbers as their text; anything else is one value."""
    if text.lstrip()[:1] not in ("{", "["):
        return text
    try:
        return json.loads(text, parse_int=str, parse_float=str, parse_constant=str)
    except (ValueError, RecursionError):
        return text


def flatten_payload(docs: DataFrame, payload: str, keys: Sequence[str], sep: str = " › ") -> DataFrame:
    """Leaves of nested JSON documents as ``(path, value)`` rows, however deep.

    Lists of plain values are joined, lists of objects are numbered.  A text that is
    no document is one leaf with an empty path.  Each document is parsed once, in
    Arrow batches: no plan of fixed depth can walk documents of unknown depth, and
    a depth found first would be a job on the driver.  Texts inside a document that
    look like JSON stay texts.
    """
    kept = [f for f in docs.select(*keys).schema.fields]
    schema = T.StructType([*kept, T.StructField("path", T.StringType()), T.StructField("value", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, *leaf) for i, text in enumerate(batch.column(payload).to_pylist()) for leaf in _leaves(None if text is None else _parsed(text), "", sep)]
            at, paths, values = (list(x) for x in zip(*found, strict=True)) if found else ([], [], [])
            columns = [batch.column(k).take(pa.array(at, pa.int64())) for k in keys]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(paths, pa.string()), pa.array(values, pa.string())], [*keys, "path", "value"])

    return docs.select(*keys, payload).mapInArrow(run, schema)
