"""Tables of fixed size that tasks fill and Spark merges: counters by hash, and sets of bits.

A table has ``CELLS`` unsigned 32-bit cells (8 MB) however large the input is, so the driver and
every worker can hold it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from concordat.llm.wordvec import from_planes, planes

BITS = 21
CELLS, BLOCK = 1 << BITS, 1 << 16
_SCHEMA = "block int, at binary, cells binary"


def _packed(cells: np.ndarray) -> tuple[bytes | None, bytes]:
    """A block: filled places and their values if they are few, else all values."""
    at = np.flatnonzero(cells)
    return (planes(at.astype("<u2")), planes(cells[at])) if len(at) < BLOCK // 4 else (None, planes(cells))


def _put(total: np.ndarray, at: bytes | None, cells: bytes, how: Callable) -> None:
    where = slice(None) if at is None else from_planes(at, "<u2")
    total[where] = how(total[where], from_planes(cells, "<u4"))


def tables(df: DataFrame, fill: Callable[[Iterator[pa.RecordBatch], np.ndarray], None]) -> DataFrame:
    """Blocks of the tables of all tasks: ``fill`` puts a task's batches into its table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, "<u4")
        fill(batches, cells)
        for b in range(CELLS // BLOCK):
            at, values = _packed(cells[b * BLOCK : (b + 1) * BLOCK])
            if values:
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([at], pa.binary()), pa.array([values])], ["block", "at", "cells"])

    return df.mapInArrow(run, _SCHEMA)


def merged(parts: DataFrame, how: Callable = np.add) -> np.ndarray:
    """The merged table; the driver gets one block of fixed size for each part of the table."""

    def run(table: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK, "<u4")
        for at, cells in zip(table.column("at"), table.column("cells"), strict=True):
            _put(total, at.as_py(), cells.as_py(), how)
        at, values = _packed(total)
        columns = [table.column("block")[:1].cast(pa.int32()), pa.array([at], pa.binary()), pa.array([values], pa.binary())]
        return pa.table(columns, names=["block", "at", "cells"])

    cells = np.zeros(CELLS, "<u4")
    for r in parts.groupBy("block").applyInArrow(run, _SCHEMA).collect():
        _put(cells[r["block"] * BLOCK : (r["block"] + 1) * BLOCK], None if r["at"] is None else bytes(r["at"]), bytes(r["cells"]), how)
    return cells


def add_bits(cells: np.ndarray, keys: np.ndarray) -> None:
    """Mark 64-bit keys in a table of bits."""
    at = keys >> np.uint64(64 - BITS - 5)
    np.bitwise_or.at(cells, (at >> np.uint64(5)).astype(np.int64), np.uint32(1) << (at & np.uint64(31)).astype(np.uint32))


def has_bits(cells: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether keys may have been marked; marked ones always are."""
    at = keys >> np.uint64(64 - BITS - 5)
    return (cells[(at >> np.uint64(5)).astype(np.int64)] >> (at & np.uint64(31)).astype(np.uint32)) & 1 > 0
