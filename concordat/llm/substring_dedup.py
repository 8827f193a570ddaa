"""Substring dedup: remove passages that an earlier document holds too."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.llm.shared import slot_column
from concordat.llm.wordvec import LAST, from_planes, pack_places, planes, prime_from, slots_of, unpack_places, window_hashes, word_hashes

WINDOW = 50
#: Text bytes that a task hashes at once, and text bytes to a bucket of window hashes.
FLUSH, BUCKET = 4 << 20, 4 << 20
#: What hashing tasks send to buckets, and buckets to the slots of documents.
_SHIPPED = "bucket int, hashes binary, ids binary, ties binary, counts binary, steps binary, known boolean"
_FOUND = "slot int, ids binary, ties binary, counts binary, steps binary"


def _hash_tasks(bits: int, window: int):
    """Task that hashes every window and sends each bucket what it has for it.

    Of a window that several documents of one flush hold, only the smallest document's is sent;
    the others are known to be repeated at once, so a very common passage costs one entry a flush.
    """

    def flush(rows: list[tuple[int, bytes]]) -> Iterator[tuple]:
        rows.sort(key=lambda r: r[0])
        ids = np.array([r[0] for r in rows], "<i8")
        ties = np.array([zlib.crc32(r[1]) for r in rows], "<u4")
        words, bounds = word_hashes([r[1] for r in rows])
        hashes, counts = window_hashes(words, bounds, window)
        if not len(hashes):
            return
        row = np.repeat(np.arange(len(rows), dtype=np.int32), counts)
        start = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
        owner = ids[row[order]]
        repeated = np.zeros(len(hashes), bool)
        repeated[order] = owner > owner[np.flatnonzero(new)][np.cumsum(new) - 1]
        if repeated.any():
            yield (int(hashes[0]) & ((1 << bits) - 1), b"", *pack_places(ids, ties, row[repeated], start[repeated]), True)
        hashes, row, start = hashes[~repeated], row[~repeated], start[~repeated]
        bucket = (hashes >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint32)
        order = np.argsort(bucket, kind="stable")
        hashes, row, start = hashes[order], row[order], start[order]
        found, first = np.unique(bucket[order], return_index=True)
        spare = bits // 8  # leading bytes that the bucket tells
        for b, lo, hi in zip(found.tolist(), first, np.append(first, len(hashes))[1:], strict=True):
            kept = planes(hashes[lo:hi])[: (8 - spare) * (hi - lo)]
            yield (b, kept, *pack_places(ids, ties, row[lo:hi], start[lo:hi]), False)

    kinds = [pa.int32()] + [pa.binary()] * 5 + [pa.bool_()]
    names = ["bucket", "hashes", "ids", "ties", "counts", "steps", "known"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0

        def out() -> pa.RecordBatch:
            columns = list(zip(*flush(rows), strict=True)) or [()] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    data = (text or "").encode()
                    rows.append((LAST if doc_id is None else doc_id, data))
                    held += len(data)
                    if held >= FLUSH:
                        yield out()
                        rows, held = [], 0
        yield out()

    return run


def _bucket_task(bits: int, slots: int):
    """Task that counts the window hashes of one bucket and finds the repeated windows."""

    def run(table: pa.Table) -> pa.Table:
        spare = bits // 8
        ids, ties, starts, fresh, hashes, own = [], [], [], [], [], []
        for r in table.to_pylist():
            doc_ids, doc_ties, row, start = unpack_places(r["ids"], r["ties"], r["counts"], r["steps"])
            ids.append(doc_ids[row])
            ties.append(doc_ties[row])
            starts.append(start)
            fresh.append(np.full(len(row), not r["known"]))
            if not r["known"]:
                hashes.append(from_planes(r["hashes"] + bytes(spare * len(row)), "<u8"))
        ids, ties, starts, fresh = (np.concatenate(x) for x in (ids, ties, starts, fresh))
        repeated = ~fresh
        if hashes:
            keys, own = np.concatenate(hashes), ids[fresh]
            order = np.argsort(keys)
            ranked, owner = keys[order], own[order]
            first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
            least = np.minimum.reduceat(owner, first)
            later = np.zeros(len(keys), bool)
            later[order] = owner > np.repeat(least, np.diff(np.append(first, len(keys))))
            repeated[np.flatnonzero(fresh)[later]] = True
        ids, ties, starts = ids[repeated], ties[repeated], starts[repeated]
        slot = slots_of(ids, ties, slots)
        order = np.lexsort((starts, ties, ids, slot))
        ids, ties, starts, slot = ids[order], ties[order], starts[order], slot[order]
        row = np.cumsum(np.concatenate(([0], (ids[1:] != ids[:-1]) | (ties[1:] != ties[:-1]))))[: len(ids)]
        doc = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))[: len(ids)]
        found, at = np.unique(slot, return_index=True)
        out = []
        for s, lo, hi in zip(found.tolist(), at, np.append(at, len(slot))[1:], strict=True):
            out.append((s, *pack_places(ids[doc], ties[doc], row[lo:hi], starts[lo:hi])))
        columns = list(zip(*out, strict=True)) or [()] * 5
        kinds = [pa.int32()] + [pa.binary()] * 4
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["slot", "ids", "ties", "counts", "steps"])

    return run


def removed_words(n_words: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which words the windows at ``starts`` cover; overlapping windows merge into one interval."""
    steps = np.zeros(n_words + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.subtract.at(steps, starts + window, 1)
    return np.cumsum(steps[:-1]) > 0


def _apply_task(window: int, kind: T.StructType):
    """Task that removes the found windows from the texts of one slot."""

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        starts: dict[tuple[int, int], list[np.ndarray]] = {}
        for r in found.to_pylist():
            ids, ties, row, start = unpack_places(r["ids"], r["ties"], r["counts"], r["steps"])
            for k, part in enumerate(np.split(start, np.flatnonzero(np.diff(row)) + 1)):
                starts.setdefault((int(ids[k]), int(ties[k])), []).append(part)
        texts, totals, gone = [], [], []
        whole = pc.struct_field(docs.column("row"), "text").to_pylist()
        for doc_id, text in zip(docs.column("key").to_pylist(), whole, strict=True):
            data = (text or "").encode()
            words = data.split()
            totals.append(len(words))
            at = starts.get((doc_id, zlib.crc32(data)))
            if at:
                kept = ~removed_words(len(words), np.concatenate(at), window)
                words = list(compress(words, kept.tolist()))
            texts.append(b" ".join(words).decode())
            gone.append(totals[-1] - len(words))
        columns = [docs.column("row"), pa.array(texts, pa.string()), pa.array(totals, pa.int64()), pa.array(gone, pa.int64())]
        return pa.table(columns, names=kind.names)

    return run


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Find and remove repeated windows of ``window`` words.

    Returns one row per row of ``docs``: ``row`` (the whole input row), ``kept_text`` (the words that
    are left, joined by single blanks), ``n_words`` and ``n_removed``.

    A window is that many consecutive words of one document.  It is repeated if its words also
    start in a document with a smaller id; all windows are judged on the input, and every word that
    a repeated window covers goes.  Of documents with the same id neither is smaller; a null id is
    larger than every other.  Null and empty texts have no words, and texts shorter than a window
    lose none.  Extra columns are passed on inside ``row``.

    Every window is hashed by a rolling hash; the hashes are dealt out to buckets by their leading
    bits, and each bucket counts its own.  Number of buckets and slots follow the bytes of text.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(6, int(size // BUCKET).bit_length())
    slots = prime_from(max(64, int(size // BUCKET)))
    shipped = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_hash_tasks(bits, window), _SHIPPED)
    found = shipped.groupBy("bucket").applyInArrow(_bucket_task(bits, slots), _FOUND)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(int(LAST)))
    keyed = docs.select(F.struct("*").alias("row"), key.alias("key"), slot_column(key, docs["text"], slots).alias("slot"))
    kind = T.StructType(
        [keyed.schema["row"], T.StructField("kept_text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
    )
    return keyed.groupBy("slot").cogroup(found.groupBy("slot")).applyInArrow(_apply_task(window, kind), kind)


def clean(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated windows taken out of ``text``, all columns as they are.

    A text that loses nothing stays unchanged; what is left of another is words and single blanks.
    ``n_chars``, where there is one, is counted anew.
    """
    found = dedup(docs, window)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("row.text"))
    given = {"text": text.alias("text"), "n_chars": F.length(text).cast("long").alias("n_chars")}
    return found.select(*[given.get(c, F.col("row").getField(c).alias(c)) for c in docs.columns])
