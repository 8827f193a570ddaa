"""Byte-level BPE encoding and decoding with a local rank file."""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: The end of a non-blank run: every match of the pattern ends there at the latest.
EDGE = re.compile(r"(?<=\S)(?=[ \t\n\r])")
#: Characters after which the next edge cuts a text, and blanks in a row that skip the pattern.
CHUNK = 1 << 16
BLANKS = 1 << 12
#: Unicode white space, as the pattern's library has it.
LONG_GAP = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % BLANKS)

_codecs: dict[tuple[str, str], object] = {}


def codec(path: str, pattern: str):
    """The worker's tiktoken encoding for a rank file, without special tokens."""
    if (path, pattern) not in _codecs:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _codecs[path, pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _codecs[path, pattern]


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """Cut a text at safe boundaries: behind a non-blank character and before a blank one.

    No match of the byte-level pattern goes on from a non-blank into a blank, and none looks back,
    so the parts encode as the whole does.  A part is longer than ``size`` only if it has no blank.
    """
    at = 0
    while len(text) - at > size:
        edge = EDGE.search(text, at + size)
        if not edge:
            break
        yield text[at : edge.start()]
        at = edge.start()
    yield text[at:]


def encode_text(enc, text: str) -> list[int]:
    """Ids of a whole text.

    A run of blanks matches but for its last character when text follows, and whole at the end of
    the text.  Very long runs would exhaust the pattern's stack, so they are encoded as that match.
    """
    if len(text) <= CHUNK:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    at = 0
    for gap in LONG_GAP.finditer(text):
        end = gap.end() if gap.end() == len(text) else gap.end() - 1
        for part in chunks(text[at : gap.start()]):
            ids += enc.encode_ordinary(part)
        ids += enc._encode_single_piece(text[gap.start() : end])
        at = end
    for part in chunks(text[at:]):
        ids += enc.encode_ordinary(part)
    return ids


def _with(docs: DataFrame, column: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in docs.schema.fields if f.name != column] + [T.StructField(column, kind)])


def _put(batch: pa.RecordBatch, column: str, values: pa.Array) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n != column]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + [values], kept + [column])


def encode(docs: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids``, the token ids of ``text`` as little-endian unsigned 32-bit integers.

    ``ranks`` is a rank file that every worker can open, ``pattern`` splits a text before merging.
    Null and empty texts have no ids (an empty value).  All columns and rows are kept as they are; a
    column that is already called ``ids`` is replaced.  Texts of any length are encoded whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = codec(ranks, pattern)
        for batch in batches:
            found = [array("I", encode_text(enc, t) if t else []).tobytes() for t in batch.column(text).to_pylist()]
            yield _put(batch, ids, pa.array(found, pa.binary()))

    return docs.mapInArrow(run, _with(docs, ids, T.BinaryType()))


def decode(encoded: DataFrame, ranks: str, pattern: str, ids: str = "ids", data: str = "data") -> DataFrame:
    """Add ``data``, the raw bytes behind ``ids``; bytes that are no UTF-8 stay as they are.

    Null ids give empty bytes.  An id without a rank raises.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = codec(ranks, pattern)
        for batch in batches:
            found = [enc.decode_bytes(array("I", x or b"").tolist()) for x in batch.column(ids).to_pylist()]
            yield _put(batch, data, pa.array(found, pa.binary()))

    return encoded.mapInArrow(run, _with(encoded, data, T.BinaryType()))
