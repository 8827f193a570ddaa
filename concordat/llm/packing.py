"""Packing documents into fixed-length training sequences by reciprocal-capacity classes."""

from __future__ import annotations

import os
import re
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)
#: A blank after white space: there the blank does not start a new match of the vocabulary's pattern.
DOUBLE_GAP = re.compile(r"\s ")
#: Words kept with their ids in one worker; beyond that the memory is emptied.
REMEMBERED = 600_000


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    A blank that follows a non-blank always starts a new match of the byte-level pattern, so a
    text's ids are the ids of its blank-led words one after the other; each worker encodes a word
    once and remembers it.  New words are encoded together: only the first token of a blank-led
    word starts with a blank, which tells the words' ids apart.  Texts with a blank after other
    white space are encoded whole.  Strings of special tokens inside a text are ordinary text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        blank = self.tokenizer.id_to_token(self._ids(" ")[0])
        led = [t for t, i in self.tokenizer.get_vocab().items() if t.startswith(blank)]
        self.leads = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.leads[[self.tokenizer.token_to_id(t) for t in led]] = True
        self.words: dict[str, bytes] = {}

    def _ids(self, text: str) -> list[int]:
        # Without offsets, which nothing here needs.
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _learn(self, new: list[str]) -> None:
        alone = [w for w in new if not w or w[-1].isspace()]
        self.words.update((w, array("I", self._ids(" " + w)).tobytes()) for w in alone)
        together = [w for w in new if w and not w[-1].isspace()]
        if together:
            ids = np.array(self._ids(" " + " ".join(together)), "<u4")
            at = (4 * np.flatnonzero(self.leads[ids])).tolist() + [4 * len(ids)]
            data = ids.tobytes()
            self.words.update((w, data[lo:hi]) for w, lo, hi in zip(together, at[:-1], at[1:], strict=True))

    def __call__(self, texts: list[str | None]) -> Iterator[bytes]:
        if len(self.words) > REMEMBERED:
            self.words = {}
        for lo in range(0, len(texts), 64):
            part = [t or "" for t in texts[lo : lo + 64]]
            split = [None if DOUBLE_GAP.search(t) else t.split(" ") for t in part]
            known, new = self.words.__contains__, set()
            for s in split:
                if s:
                    new.update(filterfalse(known, s[1:]))
            self._learn(list(new))
            for text, s in zip(part, split, strict=True):
                if s is None:
                    yield array("I", self._ids(text)).tobytes()
                else:
                    yield array("I", self._ids(s[0])).tobytes() + b"".join(map(self.words.__getitem__, s[1:]))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Packer:
    """The bins of one task.

    Full sequences of a document come first; its rest of ``n`` tokens is of class ``k`` where it
    takes more than a ``k + 1``-th of the capacity and at most a ``k``-th, and a bin of class ``k`` is
    complete with ``k`` rests.  What such a bin has left at its end is kept for a whole rest that fits
    it within ``slack`` tokens; only when more than ``ENDS`` bins wait for one, or a task ends, are
    rests cut to fill them.  Of each bin at most one rest is cut.
    """

    #: Complete bins that wait for a rest that fits their end.
    ENDS = 256

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.sequence = capacity, first_sequence
        self.slack = capacity // 64
        self.open: dict[int, list[tuple]] = {}
        # Room, order of arrival, pieces.
        self.ends: list[tuple[int, int, list[tuple]]] = []
        self.arrived = 0
        self.done: list[tuple] = []

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, total, ids in pieces:
            n = len(ids) // 4
            self.done.append((doc_id, start, n, total, self.sequence, offset, ids))
            offset += n
        self.sequence += 1

    def _complete(self, pieces: list[tuple]) -> None:
        room = self.capacity - sum(len(x[3]) for x in pieces) // 4
        if room <= self.slack:
            self._close(pieces)
        else:
            self.arrived += 1
            insort(self.ends, (room, self.arrived, pieces))

    def _place(self, piece: tuple) -> None:
        n = len(piece[3]) // 4
        i = bisect_left(self.ends, (n,))
        if i < len(self.ends) and self.ends[i][0] <= n + self.slack:
            self._close([*self.ends.pop(i)[2], piece])
            return
        k = self.capacity // n
        waiting = self.open.setdefault(k, [])
        waiting.append(piece)
        if len(waiting) == k:
            self._complete(self.open.pop(k))

    def _fill(self) -> None:
        """Fill the largest end with a rest that waits in a class, or else with one of the next bin."""
        room, _, pieces = self.ends.pop()
        if self.open:
            k = min(self.open)
            filler = self.open[k].pop()
            if not self.open[k]:
                del self.open[k]
        else:
            filler, *others = self.ends.pop()[2]
            for piece in others:
                self._place(piece)
        doc_id, start, total, ids = filler
        self._complete([*pieces, (doc_id, start, total, ids[: 4 * room])])
        if len(ids) > 4 * room:
            self._place((doc_id, start + room, total, ids[4 * room :]))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total = len(ids) // 4
        full = total - total % self.capacity
        for at in range(0, full, self.capacity):
            self._close([(doc_id, at, total, ids[4 * at : 4 * (at + self.capacity)])])
        if full < total:
            self._place((doc_id, full, total, ids[4 * full :]))
        while len(self.ends) > self.ENDS:
            self._fill()

    def finish(self) -> None:
        """Lay what is in incomplete bins, and in those with an end to fill, end to end and cut it at the capacity."""
        room, pieces = self.capacity, []
        left = [x for end in self.ends for x in end[2]] + [x for k in sorted(self.open) for x in self.open[k]]
        for doc_id, start, total, ids in left:
            while ids:
                part = ids[: 4 * room]
                pieces.append((doc_id, start, total, part))
                room, start, ids = room - len(part) // 4, start + len(part) // 4, ids[4 * room :]
                if room <= self.slack:
                    self._close(pieces)
                    room, pieces = self.capacity, []
        if pieces:
            self._close(pieces)
        self.open, self.ends = {}, []

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.done, strict=True)) or [()] * len(PIECES)
        self.done = []
        kinds = [pa.int64()] * 6 + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], PIECES.names)


def pack(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 0) -> DataFrame:
    """Pack documents into sequences of at most ``capacity`` tokens; one row per piece.

    ``vocabulary`` is a tokenizer file that every worker can open.  A document's ids end with
    ``end_id``; they may be cut anywhere, and each lies in exactly one piece.  ``ids`` are
    little-endian unsigned 32-bit integers.

    Lengths fall into reciprocal-capacity classes, and every task fills the bins of each class with
    a fixed number of documents, so there is no shuffle and no state beyond one open bin per class
    and :attr:`Packer.ENDS` bins whose ends are still to be filled.
    Sequence ids start at ``2**32`` times the task's partition, so they never meet and a repeated
    task gives the same rows.

    Null texts count as empty: such a document is the end id alone.  Null ids stay null.  Repeated
    rows are packed once each.  No rows give no rows.  Other columns are not looked at.
    """
    names = [f.name for f in docs.schema.fields if f.name in ("doc_id", "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = array("I", [end_id]).tobytes()
        packer = Packer(capacity, TaskContext.get().partitionId() << 32)
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for doc_id, ids in zip(doc_ids, encoder(vocabulary)(batch.column("text").to_pylist()), strict=True):
                packer.add(doc_id, ids + end)
                if len(packer.done) >= 20_000:
                    yield packer.take()
            yield packer.take()
        packer.finish()
        yield packer.take()
        # The worker lives on for other tasks, which need its memory.
        encoder(vocabulary).words = {}

    return docs.select(*names).mapInArrow(run, PIECES)
