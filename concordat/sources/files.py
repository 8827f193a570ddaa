"""Snapshot files: delimited text with unknown separator, encoding, preamble and parts."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concordat.functions import run_date

SEPARATORS = ("\t", ";", ",")
ENCODINGS = ("utf-8", "iso-8859-1")

_BOM = "\ufeff"
# Columns of a numbered line.
_FILE, _NO, _FIRST_SPLIT = "__file", "__no", "__first_split"


def _numbered(spark: SparkSession, path: str | Sequence[str], **options: str) -> DataFrame:
    """Undecoded lines with their file and a number that grows inside a file.

    The number is the scan's own row number, so it costs no shuffle; a file's head
    is its lowest numbers in the split that starts at byte 0.  Two uses of one
    returned frame number alike: they share the list of files and its splits.
    """
    lines = spark.read.options(**options).text(path)
    return lines.select(
        "value", F.col("_metadata.file_path").alias(_FILE), (F.col("_metadata.file_block_start") == 0).alias(_FIRST_SPLIT), F.monotonically_increasing_id().alias(_NO)
    )


def _head_lines(lines: DataFrame, count: int) -> DataFrame:
    """The first ``count`` lines of every file that are not blank, with their place ``k``.

    Blank means nothing but white space, separators left out; the rank is pruned before its shuffle.
    """
    first = Window.partitionBy(_FILE).orderBy(_NO)
    filled = lines.where(F.col(_FIRST_SPLIT) & (F.trim("value") != ""))
    return filled.withColumn("k", F.row_number().over(first)).where(F.col("k") <= count)


def _decoded(value: Column, encoding: Column | str) -> Column:
    """Text of an undecoded line, without a byte order mark."""
    raw = value.cast("binary")
    if isinstance(encoding, str):
        text = F.decode(raw, encoding)
    else:
        text = F.when(encoding == ENCODINGS[0], F.decode(raw, ENCODINGS[0])).otherwise(F.decode(raw, ENCODINGS[1]))
    return F.regexp_replace(text, f"^{_BOM}", "")


def file_formats(lines: DataFrame, preamble: int = 0) -> DataFrame:
    """Separator, encoding, header line and files of every format found among numbered lines.

    One plan over all files: a file is UTF-8 unless one of its lines does not decode, and its header is
    the line after ``preamble`` lines that are not blank.  One row per format, not per file.
    """
    coded = lines.groupBy(_FILE).agg(F.bool_and(F.is_valid_utf8("value")).alias("utf8"))
    head = _head_lines(lines, preamble + 1).where(F.col("k") == preamble + 1).select(_FILE, "value")
    files = coded.join(head, _FILE, "left").withColumn("encoding", F.when(F.col("utf8"), ENCODINGS[0]).otherwise(ENCODINGS[1]))
    header = F.coalesce(_decoded(F.col("value"), F.col("encoding")), F.lit(""))
    files = files.withColumn("header", header)
    sep = F.lit(SEPARATORS[-1])
    for s in reversed(SEPARATORS):
        sep = F.when(F.contains("header", F.lit(s)), s).otherwise(sep)
    return files.withColumn("sep", sep).groupBy("sep", "encoding", "header").agg(F.array_sort(F.collect_list(_FILE)).alias("files"))


def header_names(header: str, sep: str) -> list[str]:
    """Column names of a header line; blank ones are numbered and repeated ones get their place."""
    cells = next(csv.reader([header], delimiter=sep), [])
    names = [c.strip().strip('"') for c in cells]
    low = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if low.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def _schema(names: Sequence[str]) -> str:
    return ", ".join(f"`{n.replace('`', '``')}` string" for n in names)


def probe_format(spark: SparkSession, path: str, preamble: int = 0) -> tuple[str, str]:
    """Separator and encoding of an extract whose files agree: the ones of its first file.

    A single file that is not UTF-8 makes the whole extract ISO-8859-1.
    """
    found = file_formats(_numbered(spark, path), preamble).collect()
    if not found:
        return SEPARATORS[-1], ENCODINGS[0]
    return min(found, key=lambda r: r["files"][0])["sep"], max((r["encoding"] for r in found), key=ENCODINGS.index)


def read_csv_snapshot(
    spark: SparkSession, path: str, sep: str | None = None, encoding: str | None = None, preamble: int = 0
) -> DataFrame:
    """Read delimited text with every column as a string.

    ``preamble`` lines before the header, and the header, are dropped at the head
    of every file and nowhere else: a row equal to one of them stays.  Files are
    split over tasks as ever.  No row is judged by an empty field; blank lines are
    no rows and no preamble.
    """
    if preamble == 0:
        if sep is None or encoding is None:
            found = probe_format(spark, path)
            sep, encoding = sep or found[0], encoding or found[1]
        reader = spark.read.option("sep", sep).option("encoding", encoding).option("quote", '"').option("escape", '"')
        return _drop_bom(reader.option("header", "true").option("inferSchema", "false").csv(path))
    lines = _numbered(spark, path)
    found = file_formats(lines, preamble).collect()
    if not found:
        raise ValueError(f"no lines in {path}")
    first = min(found, key=lambda r: r["files"][0])
    sep = sep or first["sep"]
    encoding = encoding or max((r["encoding"] for r in found), key=ENCODINGS.index)
    names = header_names(first["header"], sep)
    heads = _head_lines(lines, preamble + 1).select(_NO)
    body = lines.join(heads, _NO, "left_anti").where(F.trim("value") != "")
    parsed = F.from_csv(_decoded(F.col("value"), encoding), F.lit(_schema(names)), {"sep": sep, "quote": '"', "escape": '"'})
    return body.select(parsed.alias("r")).select("r.*")


def _drop_bom(df: DataFrame) -> DataFrame:
    first = df.columns[0]
    clean = first.lstrip(_BOM).strip('"')
    return df.withColumnRenamed(first, clean) if clean != first else df


def read_wrapped_csv(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Read lines that are quoted as a whole, with inner quotes doubled.

    The header is the first line of the first file by name; where another file
    begins with it, it is dropped too.  Files are split over tasks as ever, and a
    row elsewhere that resembles the header stays.
    """
    lines = _numbered(spark, path)
    heads = _head_lines(lines, 1)
    head = heads.agg(F.min_by("value", _FILE).alias("value")).collect()[0][0]
    if head is None:
        raise ValueError(f"no lines in {path}")
    unwrap = r'^\ufeff?"|"\s*$'
    body = lines.join(F.broadcast(heads.where(F.col("value") == head).select(_NO)), _NO, "left_anti")  # a number per file
    inner = F.regexp_replace(F.regexp_replace("value", unwrap, ""), '""', '"')
    names = [n.strip().strip('"') for n in re.sub(unwrap, "", head).replace('""', '"').split(sep)]
    plain = body.select(inner.alias("value")).where("value <> ''")
    return plain.select(F.from_csv("value", F.lit(_schema(names)), {"sep": sep, "quote": '"'}).alias("r")).select("r.*")


def union_parts(spark: SparkSession, folder: str, pattern: str, exclude: str | None = None) -> DataFrame:
    """All parts of one extract in a folder, optionally without files of a given name part.

    Parts may differ in separator, encoding and columns; absent columns are NULL.
    One job looks at all files and hands the driver one row per format; reading is
    one scan per format, over the folder, with the files of other formats pruned.
    """
    lines = _numbered(spark, folder, pathGlobFilter=pattern)
    if exclude is not None:
        name = F.regexp_extract(F.url_decode(F.col(_FILE)), r"([^/]+)$", 1)
        lines = lines.where(~F.contains(name, F.lit(exclude)))
    formats = sorted(file_formats(lines).collect(), key=lambda r: r["files"][0])
    if not formats:
        raise FileNotFoundError(f"no part matches {pattern} in {folder}")
    out = None
    for f in formats:
        reader = spark.read.option("pathGlobFilter", pattern).option("sep", f["sep"]).option("encoding", f["encoding"])
        reader = reader.option("header", "true").option("escape", '"').schema(_schema(header_names(f["header"], f["sep"])))
        part = reader.csv(folder)
        if len(formats) > 1 or exclude is not None:
            part = part.where(F.col("_metadata.file_path").isin(f["files"]))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def tag_source_file(df: DataFrame) -> DataFrame:
    """Keep the file name, the run id in its prefix and the run date on every row."""
    path = F.url_decode(F.col("_metadata.file_path"))
    # A data set may be one file or a folder of parts: the dated name wins.
    dated = F.regexp_extract(path, r"[/=](\d{8}_[^/]+)", 1)
    name = F.when(dated != "", dated).otherwise(F.regexp_extract(path, r"([^/]+)/?$", 1))
    tagged = df.select("*", name.alias("source_file"))
    run = F.regexp_extract("source_file", r"^(\d{8})", 1)
    return tagged.withColumn("flux_id", run).withColumn("flux_date", run_date(F.col("flux_id")))
