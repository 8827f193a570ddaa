"""Cell grids: long tables ``(file, sheet, row, col, value)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.functions import squeeze
from concordat.operators.common import lookup_join

SHEET = ("file", "sheet")


def lines_to_cells(df: DataFrame, key: str, text: str, sep: str = r"[ \t]+") -> DataFrame:
    """Cells of whole texts: one row per line, one column per word."""
    lines = df.select(F.col(key).cast("string").alias("file"), F.lit("texte").alias("sheet"), F.posexplode(F.split(text, "\n")).alias("row", "line"))
    cells = lines.select(*SHEET, (F.col("row") + 1).alias("row"), F.posexplode(F.split("line", sep)).alias("col", "value"))
    return cells.where("value <> ''").select(*SHEET, "row", (F.col("col") + 1).alias("col"), "value")


def marker_rows(cells: DataFrame, marker: str) -> DataFrame:
    """First row of each sheet holding a cell equal to the marker, whatever its case."""
    hit = F.lower(squeeze(F.col("value"))) == marker.strip().lower()
    return cells.where(hit).groupBy(*SHEET).agg(F.min("row").alias("marker_row"))


def extract_block(cells: DataFrame, marker: str) -> DataFrame:
    """Rows of the table starting under a marker row and ending at the first empty row.

    An empty row leaves a gap in the row numbers, so the block is the run of
    consecutive rows after the marker, up to the first row whose predecessor is
    missing.  No sheet is ordered: a row and its successor meet in one aggregate
    by row number, whose partial sums spread a sheet of any size over all tasks,
    and the first gap is a minimum per sheet.
    """
    marked = lookup_join(cells, marker_rows(cells, marker), list(SHEET), "inner")
    below = marked.where(F.col("row") > F.col("marker_row"))
    # The marker row counts as a predecessor only.
    seen = F.explode(F.array(F.struct(F.col("row").alias("at"), (F.col("row") > F.col("marker_row")).alias("here")), F.struct((F.col("row") + 1).alias("at"), F.lit(False).alias("here"))))
    rows = marked.where(F.col("row") >= F.col("marker_row")).select(*SHEET, seen.alias("s")).select(*SHEET, "s.at", "s.here")
    met = rows.groupBy(*SHEET, "at").agg(F.bool_or("here").alias("here"), F.bool_and("here").alias("alone"))
    ends = met.where("here and alone").groupBy(*SHEET).agg(F.min("at").alias("end_row"))
    block = lookup_join(below, ends, list(SHEET))
    return block.where(F.col("end_row").isNull() | (F.col("row") < F.col("end_row"))).drop("marker_row", "end_row")


def extract_scalar(cells: DataFrame, patterns: Mapping[str, str], near: Sequence[int] = (0, -1, 1, -2, 2)) -> DataFrame:
    """Number belonging to each label: in the label's text, to its right, or in a near row.

    ``patterns`` maps a key to a regular expression on the lower-case cell.
    Only the first label of a sheet counts per key.  Candidates are numeric
    cells of the five nearest rows, reached by an equi-join on the row.
    """
    text = F.lower(squeeze(F.col("value")))
    keys = F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(k)) for k, p in patterns.items()]))
    ending = F.regexp_replace(F.regexp_extract("value", "(?s):\\s*(\\d[\\d\\s ]*)\\s*$", 1), "[\\s ]", "").try_cast("double")
    labels = cells.select(*SHEET, "row", "col", ending.alias("inside"), F.explode(keys).alias("key"))
    first = labels.groupBy(*SHEET, "key").agg(F.min(F.struct("row", "col", "inside")).alias("l"))
    first = first.select(*SHEET, "key", F.col("l.row").alias("l_row"), F.col("l.col").alias("l_col"), F.col("l.inside").alias("inside"))
    reach = F.explode(F.array(*[F.struct(F.lit(i).alias("rank"), (F.col("l_row") + d).alias("row")) for i, d in enumerate(near)]))
    wanted = first.select(*SHEET, "key", "l_row", "l_col", "inside", reach.alias("r")).select("*", "r.rank", "r.row").drop("r")
    numbers = cells.select(*SHEET, "row", "col", F.col("value").try_cast("double").alias("n")).where("n > 0")
    near_numbers = wanted.join(numbers, [*SHEET, "row"]).where((F.col("row") != F.col("l_row")) | (F.col("col") > F.col("l_col")))
    best = near_numbers.groupBy(*SHEET, "key").agg(F.min(F.struct("rank", "col", "n")).alias("b"))
    out = first.join(best.select(*SHEET, "key", F.col("b.n").alias("beside")), [*SHEET, "key"], "left")
    return out.select(*SHEET, "key", F.coalesce("inside", "beside").alias("value")).where("value is not null")
