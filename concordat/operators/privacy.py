"""Pseudonyms for structured columns, redaction of free text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.functions import squeeze
from concordat.operators.common import lookup_join
from concordat.session import materialize

# Patterns of personal data in free text.
EMAIL = r"\b[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}\b"
PHONE = r"\b(?:\+33[\s.\-]?[1-9](?:[\s.\-]?\d{2}){4}|0[1-9](?:[\s.\-]?\d{2}){4})\b"
NIR = r"\b[12][\s.]?\d{2}[\s.]?\d{2}[\s.]?\d{2,3}[\s.]?\d{3}[\s.]?\d{3}[\s.]?\d{2}\b"
LAST_NAME = r"(Nom)([A-ZÀÉÈÊËÏÎÔÙÛÜ]+)(?=Prénom|KPEP|Adresse|\s|$)"
FIRST_NAME = r"(Prénom)([A-ZÀÉÈÊËÏÎÔÙÛÜ][a-zàéèêëïîôùûü]{1,30}(?:-[A-ZÀÉÈÊËÏÎÔÙÛÜ][a-zàéèêëïîôùûü]{1,30})*)"
KPEP = r"(KPEP)(\d{10,20})"
MIN_NAME = 3
#: Widths of grams; characters cut into grams in one go.
_SHORT, _LONG, _FLUSH = 3, 8, 1 << 20
#: The table of bits that marks grams: bits for each gram, its least and largest size and its blocks, as powers of two.
_PER_GRAM, _LEAST, _MOST, _BLOCK = 4, 20, 28, 19
_SPECIAL = r"([\\.\[\]{}()*+?^$|\-])"


def surrogate(value: Column, key: str, mark: str) -> Column:
    """Stable stand-in of a value: keyed hash of its stripped lower-case form."""
    clean = F.lower(squeeze(value))
    return F.concat(F.lit(mark + "-"), F.sha2(F.concat(F.lit(key), clean), 256))


def pseudonymize_columns(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Replace the values of columns consistently; blanks stay as they are.

    Stateless: equal values get equal surrogates on any node and in any run.
    """
    out = df
    for name in columns:
        filled = F.coalesce(squeeze(F.col(name)), F.lit("")) != ""
        out = out.withColumn(name, F.when(filled, surrogate(F.col(name), key, "P")).otherwise(F.col(name)))
    return out


def redact_text(text: Column) -> Column:
    """Whole text without e-mails, telephone numbers, national ids and labelled names or keys."""
    out = F.regexp_replace(text, EMAIL, "[EMAIL]")
    out = F.regexp_replace(out, PHONE, "[TEL]")
    out = F.regexp_replace(out, NIR, "[NIR]")
    out = F.regexp_replace(out, LAST_NAME, "$1[NOM]")
    out = F.regexp_replace(out, FIRST_NAME, "$1[PRENOM]")
    return F.regexp_replace(out, KPEP, "$1[CLE]")


def _grams(codes: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of the substrings of a fixed width at every place."""
    n = max(len(codes) - width + 1, 0)
    h = np.full(n, width, np.uint64)
    for i in range(width):
        h = h * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + n]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def _pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, lengths and code points of pieces of about ``_FLUSH`` characters; a longer text is dealt so that no gram is lost."""
    rows, parts, size = [], [], 0

    def piece() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4").astype(np.uint64)
        return np.array(rows), np.array([len(p) for p in parts]), codes

    for row, text in enumerate(texts):
        for lo in range(0, len(text or ""), _FLUSH):
            rows.append(row)
            parts.append(text[lo : lo + _FLUSH + _LONG - 1])
            size += len(parts[-1])
            if size >= _FLUSH:
                yield piece()
                rows, parts, size = [], [], 0
    if rows:
        yield piece()


def _placed(codes: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of pieces that lie one after the other, and which piece each lies in."""
    grams = _grams(codes, width)
    owner = np.repeat(np.arange(len(lengths)), lengths)[: len(grams)]
    inside = np.arange(width, len(grams) + width) <= np.cumsum(lengths)[owner]
    return grams[inside], owner[inside]


def _unlike(rows: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of a row and a gram."""
    order = np.lexsort((grams, rows))
    rows, grams = rows[order], grams[order]
    first = np.concatenate(([True], (rows[1:] != rows[:-1]) | (grams[1:] != grams[:-1]))) if len(rows) else np.zeros(0, bool)
    return rows[first], grams[first]


def _name_grams(names: DataFrame) -> DataFrame:
    """``(name, gram)``: all grams of each name, of eight characters if it is that long, else of three."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, lengths, codes in _pieces(batch.column("name").to_pylist()):
                found = []
                for width, there in ((_SHORT, lengths < _LONG), (_LONG, lengths >= _LONG)):
                    grams, owner = _placed(codes[np.repeat(there, lengths)], lengths[there], width)
                    found.append((rows[there][owner], grams))
                at, grams = _unlike(*(np.concatenate(x) for x in zip(*found, strict=True)))
                yield pa.RecordBatch.from_arrays([batch.column("name").take(pa.array(at)), pa.array(grams.view(np.int64))], ["name", "gram"])

    return names.select("name").mapInArrow(run, "name string, gram long")


def _in_block(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two places of each gram in its block of the table of bits."""
    last = np.uint64((1 << _BLOCK) - 1)
    return (grams & last).view(np.int64), (grams >> np.uint64(_BLOCK) & last).view(np.int64)


def _has(bits: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Places of the grams that the table may mark; marked ones are always found."""
    block = (grams >> np.uint64(64 + _BLOCK - 3 - (len(bits).bit_length() - 1)) << np.uint64(_BLOCK)).view(np.int64)
    there = np.arange(len(grams))
    for place in _in_block(grams):
        at = block[there] | place[there]
        there = there[(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)]
    return there


def _bits(grams: DataFrame, count: int) -> np.ndarray:
    """A table that marks every ``gram`` twice, with at least 16 bits for each of about ``count`` of them (128 kB to 32 MB).

    The leading bits of a gram name its block.  A block is filled in one group, and the driver gets one row a block.
    """
    size = min(max(count.bit_length() + _PER_GRAM, _LEAST), _MOST)

    def fill(table: pa.Table) -> pa.Table:
        marks = np.zeros(1 << _BLOCK, bool)
        for place in _in_block(table.column("gram").to_numpy().view(np.uint64)):
            marks[place] = True
        cells = np.packbits(marks, bitorder="little").tobytes()
        return pa.table([table.column("block")[:1], pa.array([cells], pa.binary())], names=["block", "cells"])

    block = F.shiftrightunsigned("gram", 64 - (size - _BLOCK)).cast("int")
    filled = grams.select(block.alias("block"), "gram").groupBy("block").applyInArrow(fill, "block int, cells binary").collect()
    cells, width = np.zeros(1 << (size - 3), np.uint8), 1 << (_BLOCK - 3)
    for r in filled:
        cells[r["block"] * width : (r["block"] + 1) * width] = np.frombuffer(bytes(r["cells"]), np.uint8)
    return cells


def _marked_pieces(bits: np.ndarray, widths: Sequence[int], texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct pairs of a row and a gram that the table of bits marks, piece by piece."""
    for rows, lengths, codes in _pieces(texts):
        found = []
        for width in widths:
            grams, owner = _placed(codes, lengths, width)
            there = _has(bits, grams)
            found.append((rows[owner[there]], grams[there]))
        yield _unlike(*(np.concatenate(x) for x in zip(*found, strict=True)))


def _marks(parts: DataFrame) -> tuple[np.ndarray, list[int]]:
    """The table of bits of the grams of ``(name, gram)``, and the widths they have."""
    long = F.length("name") >= _LONG
    seen = parts.agg(F.approx_count_distinct("gram").alias("n"), F.max(~long).alias("short"), F.max(long).alias("long")).first()
    widths = [w for w, there in ((_SHORT, seen["short"]), (_LONG, seen["long"])) if there]
    return _bits(parts.select("gram").distinct(), seen["n"]), widths or [_LONG]


def _marked_grams(low: DataFrame, bits: np.ndarray, widths: Sequence[int], text_id: str) -> DataFrame:
    """``(text_id, gram)`` for the grams of each text that the table of bits marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, grams in _marked_pieces(bits, widths, batch.column("__low").to_pylist()):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(grams.view(np.int64))], [text_id, "gram"])

    schema = T.StructType([low.schema[text_id], T.StructField("gram", T.LongType())])
    return low.select(text_id, "__low").mapInArrow(run, schema)


def _gram_counts(low: DataFrame, bits: np.ndarray, widths: Sequence[int]) -> DataFrame:
    """``(gram, n)``: in how many texts a marked gram lies, counted piece by piece before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, grams in _marked_pieces(bits, widths, batch.column("__low").to_pylist()):
                found, n = np.unique(grams, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], ["gram", "n"])

    return low.select("__low").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def name_keys(low: DataFrame, names: DataFrame, text_id: str) -> DataFrame:
    """``(name, gram)``: the gram of each name that the fewest texts hold.

    A name with a gram that no text holds occurs nowhere and has no key.
    """
    parts = materialize(_name_grams(names))
    counts = _gram_counts(low, *_marks(parts))
    rated = lookup_join(parts, counts, ["gram"])
    best = rated.groupBy("name").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("k"))
    return best.where("k.n > 0").select("name", F.col("k.gram").alias("gram"))


def known_name_candidates(low: DataFrame, names: DataFrame, text_id: str) -> DataFrame:
    """``(text_id, name)`` for the texts that hold the rarest gram of a name."""
    keys = materialize(name_keys(low, names, text_id))
    marked = _marked_grams(low, *_marks(keys), text_id)
    return marked.join(keys, "gram").select(text_id, "name")


def _spread(df: DataFrame) -> DataFrame:
    """Deal a table of a few files over all cores; a table with more scan tasks than cores stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def known_name_hits(texts: DataFrame, names: DataFrame, text_id: str, text: str) -> DataFrame:
    """Known names occurring in each text, as ``(text_id, names)`` with the longest first.

    A name is looked up by its rarest gram (:func:`name_keys`): one pass counts the grams of names over all texts, a
    second hands on only ids of texts with the rarest gram of some name.  Grams are hashes, and the table of bits that
    tells whose they are grows with the names, so that more names do not let more of each text through.  The text is joined back for those, and the
    whole name is then checked.  How the sides are joined is left to adaptive execution.
    """
    clean = names.select(F.explode(F.array(*names.columns)).alias("name")).select(squeeze(F.col("name")).alias("name"))
    clean = clean.where(F.length("name") >= MIN_NAME).select(F.lower("name").alias("name")).distinct()
    low = _spread(texts.select(text_id, F.lower(text).alias("__low")))
    rows = lookup_join(known_name_candidates(low, clean, text_id), low, [text_id], "inner")
    checked = rows.where(F.contains("__low", "name")).select(text_id, "name").distinct()
    order = lambda a, b: F.when(F.length(a) > F.length(b), -1).when(F.length(a) < F.length(b), 1).when(a < b, -1).when(a > b, 1).otherwise(0)
    return checked.groupBy(text_id).agg(F.array_sort(F.collect_set("name"), order).alias("names"))


def redact_known_names(texts: DataFrame, names: DataFrame, text_id: str, text: str, key: str) -> DataFrame:
    """Replace known names in whole texts, longest first, whatever their case.

    One pass per text with the names that occur in it; every occurrence is
    replaced by the surrogate of the name.
    """
    hits = known_name_hits(texts, names, text_id, text)
    rows = texts.join(hits, text_id, "left")
    quoted = F.transform("names", lambda n: F.regexp_replace(n, _SPECIAL, r"\\$1"))
    pattern = F.concat(F.lit("(?iu)"), F.array_join(quoted, "|"))
    rows = rows.withColumn("__p", F.when(F.col("names").isNotNull(), pattern))
    pieces = F.split(F.col(text), F.col("__p"), -1)
    marks = F.transform(F.regexp_extract_all(F.col(text), F.col("__p"), F.lit(0)), lambda m: surrogate(m, key, "P"))
    joined = F.array_join(F.zip_with(pieces, marks, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return rows.withColumn(text, F.when(F.col("__p").isNull(), F.col(text)).otherwise(joined)).drop("names", "__p")


def redaction_stats(texts: DataFrame, text: str) -> DataFrame:
    """Matches and distinct values per class of personal data."""
    classes = {"emails": (EMAIL, 0), "telephones": (PHONE, 0), "nir": (NIR, 0), "kpep": (KPEP, 2)}

    def found(name: str, pattern: str, group: int) -> Column:
        values = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(group))
        return F.transform(values, lambda v: F.struct(F.lit(name).alias("kind"), F.lower(v).alias("value")))

    cells = F.flatten(F.array(*[found(name, p, g) for name, (p, g) in classes.items()]))
    pairs = texts.select(F.inline(cells)).groupBy("kind", "value").agg(F.count("*").alias("n"))
    return pairs.groupBy("kind").agg(F.count("*").alias("unique_values"), F.sum("n").cast("bigint").alias("matches"))
