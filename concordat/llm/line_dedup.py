"""Line dedup: an exact set-similarity join of lines over the whole corpus."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.llm import sketch
from concordat.llm.shared import saved, slot_column
from concordat.llm.wordvec import LAST, U64, from_planes, mix, pack_places, planes, prime_from, slots_of, unpack_places, word_hashes

SIMILARITY = 0.8
FLUSH, BUCKET = 5 << 20, 4 << 20
#: Bits of a token; the others of 64 number the lines of a chunk.
TOKEN_BITS, CHUNK = 49, 1 << 15
#: Pairs that are looked at in one go, and pairs of two runs from which on they are found by pieces of their parities.
PAIRS, LARGE = 1 << 16, 1 << 16
#: Partners that one token's list gives a line at first, nearest first.
NEAREST = 2
_PARTS = ("ids", "ties", "counts", "lines", "tokens", "sigs", "bits0", "bits1", "sizes", "ranks", "wide")
#: Sets up to this size have a parity of 64 bits, larger ones of 128; the second join has these words.
WIDE, WORDS = 64, 8
_SHIPPED = "bucket int, firsts boolean, " + ", ".join(f"{c} binary" for c in _PARTS)
_PLACES = "slot int, ids binary, ties binary, counts binary, steps binary"
_NAMES = ["a_id", "a_tie", "a_line", "b_id", "b_tie", "b_line"]
_FOUND = _PLACES + ", " + ", ".join(f"{c} long" for c in _NAMES) + ", more boolean"


@dataclass
class Lines:
    """Lines with words of a flush, earlier ones first, without those whose set came before."""

    ids: np.ndarray
    ties: np.ndarray
    row: np.ndarray
    line: np.ndarray
    sig: np.ndarray
    sig2: np.ndarray
    tokens: np.ndarray
    bounds: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)


def _sets(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct tokens of lines whose words are ``hashes``, and their numbers."""
    tokens, sizes = [], [np.zeros(1, np.int64)]
    for lo in range(0, len(bounds) - 1, CHUNK):
        ends = bounds[lo : lo + CHUNK + 1]
        line = np.repeat(np.arange(len(ends) - 1, dtype=U64), np.diff(ends))
        both = (line << U64(TOKEN_BITS)) | (hashes[ends[0] : ends[-1]] >> U64(64 - TOKEN_BITS))
        both.sort()
        both = both[np.concatenate(([True], both[1:] != both[:-1]))[: len(both)]]
        sizes.append(np.bincount((both >> U64(TOKEN_BITS)).astype(np.int64), minlength=len(ends) - 1))
        tokens.append(both & U64((1 << TOKEN_BITS) - 1))
    return np.concatenate(tokens) if tokens else np.zeros(0, U64), np.cumsum(np.concatenate(sizes))


def _picked(values: np.ndarray, bounds: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of some of the groups that ``bounds`` cut."""
    sizes = np.diff(bounds)
    return values[np.repeat(which, sizes)], np.concatenate(([0], np.cumsum(sizes[which])))


def _first_lines(rows: list[tuple[int, int, bytes]], among: np.ndarray | None = None) -> Lines:
    """``among``: only lines with a token of this table of bits."""
    rows.sort(key=lambda r: r[:2])
    lines, row, number = [], [], []
    for k, (_, _, data) in enumerate(rows):
        for i, line in enumerate(data.split(b"\n")):
            if line and not line.isspace():
                lines.append(line)
                row.append(k)
                number.append(i)
    hashes, bounds = word_hashes(lines)
    ids, ties = np.array([r[0] for r in rows], "<i8"), np.array([r[1] for r in rows], "<u4")
    row, number = np.array(row, np.int64), np.array(number, np.int64)
    if among is not None and lines:
        named = np.logical_or.reduceat(sketch.has_bits(among, _key(hashes)), bounds[:-1])
        (hashes, bounds), row, number = _picked(hashes, bounds, named), row[named], number[named]
    tokens, bounds = _sets(hashes, bounds)
    if not len(row):
        return Lines(ids, ties, row, number, tokens, tokens, tokens, bounds)
    mixed = mix(tokens)
    sig = np.add.reduceat(mixed, bounds[:-1])
    sig2 = mix(np.add.reduceat(mix(mixed + U64(0x632BE59BD9B4E019)), bounds[:-1]))
    sig = mix(sig ^ (sig2 * U64(0x9E3779B97F4A7C15)))
    order = np.lexsort((sig2, sig))
    new = np.concatenate(([True], (sig[order][1:] != sig[order][:-1]) | (sig2[order][1:] != sig2[order][:-1])))
    first = np.zeros(len(row), bool)
    first[order[new]] = True
    return Lines(ids, ties, row[first], number[first], sig[first], sig2[first], *_picked(tokens, bounds, first))


def _key(hashes: np.ndarray) -> np.ndarray:
    """Tokens of word hashes as 64-bit keys of a table of bits."""
    return (hashes >> U64(64 - TOKEN_BITS)) << U64(64 - TOKEN_BITS)


def _flushes(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Documents of about ``FLUSH`` bytes at a time: id, checksum, text."""
    rows, held = [], 0
    for batch in batches:
        for lo in range(0, batch.num_rows, 500):
            part = batch.slice(lo, 500)
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                data = (text or "").encode()
                rows.append((LAST if doc_id is None else doc_id, zlib.crc32(data), data))
                held += len(data)
                if held >= FLUSH:
                    yield rows
                    rows, held = [], 0
    yield rows


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> U64(TOKEN_BITS - sketch.BITS)).astype(np.int64)


def rarity(docs: DataFrame) -> np.ndarray:
    """How often the tokens of each cell occur, over all documents.

    A cell that counts one holds a token of one line only.
    """

    def fill(batches: Iterator[pa.RecordBatch], cells: np.ndarray) -> None:
        for rows in _flushes(batches):
            hashes, _ = word_hashes([r[2] for r in rows])
            at, counts = np.unique(_cells(hashes >> U64(64 - TOKEN_BITS)), return_counts=True)
            cells[at] += counts.astype("<u4")

    return sketch.merged(sketch.tables(docs, fill))


def required(a, b, similarity: float = SIMILARITY):
    """Least overlap of sets of ``a`` and ``b`` tokens that reaches the similarity."""
    return np.ceil(similarity / (1 + similarity) * (a + b) - 1e-9)


def _prefixes(tokens: np.ndarray, bounds: np.ndarray, seen: np.ndarray, similarity: float) -> tuple[np.ndarray, ...]:
    """Tokens ordered by rarity within each line, their lines and ranks, and which are in a prefix.

    A token that is counted once is in no other line and finds nothing.
    """
    sizes = np.diff(bounds)
    of, counts = np.repeat(np.arange(len(sizes)), sizes), seen[_cells(tokens)]
    order = np.argsort((of.astype(U64) << U64(32)) | counts, kind="stable")
    rank = np.arange(len(tokens)) - np.repeat(bounds[:-1], sizes)
    n = sizes[of]
    return tokens[order], of, rank, (rank < n - np.ceil(similarity * n - 1e-9) + 1) & (counts[order] > 1)


def _shipping_task(bits: int, counted, similarity: float, among=None):
    """Task that sends every line's set to its bucket, and its prefix tokens to theirs.

    ``among``: only the prefix tokens in this table of bits, and no sets.
    """
    kinds = [pa.int32(), pa.bool_()] + [pa.binary()] * len(_PARTS)

    def dealt(lines: Lines, which: np.ndarray, bucket: np.ndarray, firsts: bool, **values: np.ndarray) -> Iterator[tuple]:
        order = np.argsort(bucket, kind="stable")
        which, bucket = which[order], bucket[order]
        found, at = np.unique(bucket, return_index=True)
        for b, lo, hi in zip(found.tolist(), at, np.append(at, len(bucket))[1:], strict=True):
            row = lines.row[which[lo:hi]]
            ids, ties, counts, _ = pack_places(lines.ids, lines.ties, row, row)
            fields = {"ids": ids, "ties": ties, "counts": counts, "lines": planes(lines.line[which[lo:hi]].astype("<u4"))}
            fields |= {k: v[order[lo:hi]].tobytes() if k == "wide" else planes(v[order[lo:hi]]) for k, v in values.items()}
            yield (b, firsts, *[fields.get(c) for c in _PARTS])

    def flush(lines: Lines, seen: np.ndarray) -> Iterator[tuple]:
        if among is None:
            place = (lines.sig >> U64(64 - bits)).astype(np.int64)
            yield from dealt(lines, np.arange(len(lines.row)), place, True, sigs=lines.sig, bits0=lines.sig2)
        sizes = lines.sizes
        tokens, of, rank, used = _prefixes(lines.tokens, lines.bounds, seen, similarity)
        if among is not None:
            used &= sketch.has_bits(among.value, tokens << U64(64 - TOKEN_BITS))
        one = U64(1) << (lines.tokens & U64(63))
        upper = ((lines.tokens >> U64(6)) & U64(1) == 1) & (sizes[of] > WIDE)
        bits0 = np.bitwise_xor.reduceat(np.where(upper, U64(0), one), lines.bounds[:-1])
        bits1 = np.bitwise_xor.reduceat(np.where(upper, one, U64(0)), lines.bounds[:-1])
        which = of[used]
        values = {"tokens": tokens[used], "sigs": lines.sig[which].astype("<u4"), "bits0": bits0[which], "bits1": bits1[which]}
        values |= {"sizes": sizes[which].astype("<u4"), "ranks": rank[used].astype("<u4")}
        if among is not None:
            place = (lines.tokens >> U64(6)) % U64(WORDS)
            words = [np.bitwise_xor.reduceat(np.where(place == U64(w), one, U64(0)), lines.bounds[:-1]) for w in range(WORDS)]
            values["wide"] = np.stack(words, axis=1)[which].view(f"V{8 * WORDS}").ravel()
        yield from dealt(lines, which, (tokens[used] >> U64(TOKEN_BITS - bits)).astype(np.int64), False, **values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _flushes(batches):
            lines = _first_lines(rows, among.value if among is not None else None)
            if len(lines.row):
                columns = list(zip(*flush(lines, counted.value), strict=True)) or [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["bucket", "firsts", *_PARTS])

    return run


def _joined(parts: list[dict], name: str, kind: str) -> np.ndarray:
    return np.concatenate([from_planes(p[name] or b"", kind) for p in parts])


def _places(parts: list[dict]) -> tuple[np.ndarray, ...]:
    ids, ties = [], []
    for p in parts:
        n = from_planes(p["counts"], "<u4").astype(np.int64)
        ids.append(np.repeat(from_planes(p["ids"], "<i8"), n))
        ties.append(np.repeat(from_planes(p["ties"], "<u4"), n))
    return np.concatenate(ids), np.concatenate(ties), _joined(parts, "lines", "<u4").astype(np.int64)


def _slots(ids: np.ndarray, ties: np.ndarray, lines: np.ndarray, slots: int) -> list[tuple]:
    """Places by slot of their document."""
    slot = slots_of(ids, ties, slots)
    order = np.lexsort((lines, ties, ids, slot))
    ids, ties, lines, slot = ids[order], ties[order], lines[order], slot[order]
    row = np.cumsum(np.concatenate(([0], (ids[1:] != ids[:-1]) | (ties[1:] != ties[:-1]))))[: len(ids)]
    doc = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))[: len(ids)]
    found, at = np.unique(slot, return_index=True)
    return [
        (s, *pack_places(ids[doc], ties[doc], row[lo:hi], lines[lo:hi]))
        for s, lo, hi in zip(found.tolist(), at, np.append(at, len(slot))[1:], strict=True)
    ]


def _first_places(parts: list[dict], slots: int) -> list[tuple]:
    """The first line of each token set."""
    ids, ties, lines = _places(parts)
    sig, sig2 = _joined(parts, "sigs", "<u8"), _joined(parts, "bits0", "<u8")
    order = np.lexsort((lines, ties, ids, sig2, sig))
    new = np.concatenate(([True], (sig[order][1:] != sig[order][:-1]) | (sig2[order][1:] != sig2[order][:-1])))
    kept = order[new]
    return _slots(ids[kept], ties[kept], lines[kept], slots)


def _nearest(b: np.ndarray, a: np.ndarray, apart: np.ndarray, more: np.ndarray, nearest: int | None) -> tuple[np.ndarray, ...]:
    """The nearest partners of each line, and whether there were more."""
    order = np.lexsort((a, apart, b))
    b, a, apart, more = b[order], a[order], apart[order], more[order]
    same = np.concatenate(([False], (b[1:] == b[:-1]) & (a[1:] == a[:-1])))[: len(b)]
    b, a, apart, more = b[~same], a[~same], apart[~same], more[~same]
    if nearest is None or not len(b):
        return b, a, apart, more
    first = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1])))
    counts = np.diff(np.append(first, len(b)))
    rank = np.arange(len(b)) - np.repeat(first, counts)
    more = np.repeat(np.logical_or.reduceat(more, first) | (counts > nearest), counts)
    kept = rank < nearest
    return b[kept], a[kept], apart[kept], more[kept]


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of ranges and all the places in them."""
    n = hi - lo
    of = np.repeat(np.arange(len(n)), n)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(n) - n - lo, n)


def _pieces(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of items whose sizes add up to about ``most``, of one item at least."""
    total, at = np.cumsum(sizes), 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
        yield slice(at, end)
        at = end


def _run_pairs(token: np.ndarray, size: np.ndarray, rank: np.ndarray, similarity: float) -> tuple[np.ndarray, ...]:
    """Runs of entries of one token, size and rank, and which of them the length and positional filters let meet.

    Returns the bounds of the runs, the two runs of each pair, and in how many tokens their sets may
    differ.  Whole runs are ruled out, so that a long list of lines that cannot be similar is not
    walked.  Unlike sets of one size that may not differ at all never meet.
    """
    bounds = np.append(np.flatnonzero(np.concatenate(([True], (token[1:] != token[:-1]) | (size[1:] != size[:-1]) | (rank[1:] != rank[:-1])))), len(token))
    first = bounds[:-1]
    token, size, rest = token[first], size[first], size[first] - rank[first]
    found, left, step = [], np.arange(len(first)), 0
    # Runs of a token are sorted by size, so one that is too short for its partner is too short for all further ones.
    while len(left):
        right = left + step
        differ = size[left] + size[right] - 2 * required(size[left], size[right], similarity).astype(np.int64)
        good = (2 * np.minimum(rest[left], rest[right]) >= size[left] + size[right] - differ) & (differ >= (step == 0))
        found.append((left[good], right[good], differ[good]))
        step += 1
        left = left[left + step < len(first)]
        left = left[(token[left] == token[left + step]) & (size[left] >= similarity * size[left + step] - 1e-9)]
    return bounds, *[np.concatenate(x) for x in zip(*found, strict=True)]


def _met(bounds: np.ndarray, left: np.ndarray, right: np.ndarray, differ: np.ndarray, bits: np.ndarray, narrow: np.ndarray) -> Iterator[tuple]:
    """Pairs of entries of two runs, and in how many tokens they may differ.

    Two long runs meet by pieces of their parities: parities that differ in at most ``d`` bits agree
    in one of ``d + 1`` pieces.  A pair that agrees in several comes with the first of them.
    """
    n = np.diff(bounds)
    large = (n[left] * n[right] > LARGE) & (differ <= 8) & narrow[bounds[left]] & narrow[bounds[right]]
    small = ~large
    for some in _pieces(n[left[small]], PAIRS):
        x, y, d = left[small][some], right[small][some], differ[small][some]
        of, i = _ranges(bounds[x], bounds[x + 1])
        lo, hi = np.where(x[of] == y[of], i + 1, bounds[y[of]]), bounds[y[of] + 1]
        for part in _pieces(hi - lo, PAIRS):
            at, j = _ranges(lo[part], hi[part])
            yield i[part][at], j, d[of[part][at]]
    for x, y, d in zip(left[large].tolist(), right[large].tolist(), differ[large].tolist(), strict=True):
        own, other = np.arange(bounds[x], bounds[x + 1]), np.arange(bounds[y], bounds[y + 1])
        edges = [64 * k // (d + 1) for k in range(d + 2)]
        masks = [U64((1 << hi) - (1 << lo)) for lo, hi in zip(edges[:-1], edges[1:], strict=True)]
        for k, mask in enumerate(masks):
            order = other[np.argsort(bits[other] & mask, kind="stable")]
            values = bits[order] & mask
            lo, hi = np.searchsorted(values, bits[own] & mask, "left"), np.searchsorted(values, bits[own] & mask, "right")
            for part in _pieces(hi - lo, PAIRS):
                at, j = _ranges(lo[part], hi[part])
                i, j = own[part][at], order[j]
                apart = bits[i] ^ bits[j]
                good = np.logical_and.reduce([i < j if x == y else np.ones(len(i), bool)] + [apart & earlier != 0 for earlier in masks[:k]])
                yield i[good], j[good], np.full(int(good.sum()), d)


def _candidates(parts: list[dict], similarity: float, nearest: int | None, doubtful: np.ndarray | None) -> list[np.ndarray]:
    """Pairs of lines that share a prefix token and pass the length, positional and parity filters.

    A wide parity is folded to 64 bits to meet a narrow one.  ``doubtful``: only pairs whose later
    line is in this table of bits.
    """
    ids, ties, lines = _places(parts)
    token, sig = _joined(parts, "tokens", "<u8"), _joined(parts, "sigs", "<u4")
    bits0, bits1 = _joined(parts, "bits0", "<u8"), _joined(parts, "bits1", "<u8")
    size, rank = _joined(parts, "sizes", "<u4").astype(np.int64), _joined(parts, "ranks", "<u4").astype(np.int64)
    # Equal sets, told by a 32-bit hash, the parity and the size, are one: the first of them.
    order = np.lexsort((lines, ties, ids, sig, bits0, rank, size, token))
    same = np.logical_and.reduce([x[order][1:] == x[order][:-1] for x in (token, size, bits0, bits1, sig)])
    kept = order[np.concatenate(([True], ~same))]
    ids, ties, lines, token, bits0, bits1, size, rank = (x[kept] for x in (ids, ties, lines, token, bits0, bits1, size, rank))
    wide = size > WIDE
    words = np.frombuffer(b"".join(p["wide"] for p in parts), "<u8").reshape(-1, WORDS)[kept] if doubtful is not None else None
    wanted = sketch.has_bits(doubtful, _line_keys(_doc_keys(ids, ties), lines)) if doubtful is not None else None
    when = np.empty(len(kept), np.int64)
    when[np.lexsort((lines, ties, ids))] = np.arange(len(kept))
    none = np.zeros(0, np.int64)
    held = [none, none, none, np.zeros(0, bool)]
    fresh: list[list[np.ndarray]] = []
    waiting = 0
    bounds, *runs = _run_pairs(token, size, rank, similarity)
    for left, right, differ in _met(bounds, *runs, bits0, ~wide):
        apart0, apart1 = bits0[left] ^ bits0[right], bits1[left] ^ bits1[right]
        apart0 = np.where(wide[left] == wide[right], apart0, apart0 ^ apart1)
        apart1 = np.where(wide[left] & wide[right], apart1, U64(0))
        apart = np.bitwise_count(apart0).astype(np.int64) + np.bitwise_count(apart1)
        good = apart <= differ
        left, right, apart, differ = left[good], right[good], apart[good], differ[good]
        later = when[left] > when[right]
        x, y = np.where(later, left, right), np.where(later, right, left)
        if wanted is not None:
            apart = np.bitwise_count(words[x] ^ words[y]).sum(axis=1)
            good = wanted[x] & (apart <= differ)
            x, y, apart = x[good], y[good], apart[good]
        fresh.append([x, y, apart, np.zeros(len(x), bool)])
        waiting += len(x)
        if waiting > 200_000:
            held = list(_nearest(*[np.concatenate([h, *[f[k] for f in fresh]]) for k, h in enumerate(held)], nearest))
            fresh, waiting = [], 0
    b, a, _, more = _nearest(*[np.concatenate([h, *[f[k] for f in fresh]]) for k, h in enumerate(held)], nearest)
    return [x[k].astype(np.int64) for k in (a, b) for x in (ids, ties, lines)] + [more]


def _bucket_task(slots: int, similarity: float, nearest: int | None, doubtful=None):
    kinds = [pa.int32()] + [pa.binary()] * 4 + [pa.int64()] * 6 + [pa.bool_()]
    names = ["slot", "ids", "ties", "counts", "steps", *_NAMES, "more"]

    def run(table: pa.Table) -> pa.Table:
        parts = table.to_pylist()
        firsts, others = [p for p in parts if p["firsts"]], [p for p in parts if not p["firsts"]]
        places = list(zip(*_first_places(firsts, slots), strict=True)) if firsts else [()] * 5
        pairs = _candidates(others, similarity, nearest, doubtful.value if doubtful is not None else None) if others else [()] * 7
        n, m = len(places[0]), len(pairs[0])
        columns = [pa.concat_arrays([pa.array(c, k), pa.nulls(m, k)]) for c, k in zip(places, kinds[:5], strict=True)]
        columns += [pa.concat_arrays([pa.nulls(n, k), pa.array(c, k)]) for c, k in zip(pairs, kinds[5:], strict=True)]
        return pa.table(columns, names=names)

    return run


def _doc_keys(ids: np.ndarray, ties: np.ndarray) -> np.ndarray:
    return mix(mix(ids.astype("<i8").view(U64)) + ties.astype(U64))


def _line_keys(docs: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """64-bit keys of lines, from their document's key and their number."""
    return mix(docs + (lines.astype(U64) + U64(1)) * U64(0x9E3779B97F4A7C15))


def _sets_task(wanted):
    """Task that sends the token sets of the lines that a pair names; others are not looked into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _flushes(batches):
            docs = _doc_keys(np.array([r[0] for r in rows], "<i8"), np.array([r[1] for r in rows], np.int64))
            lines, keys = [], []
            for k in np.flatnonzero(sketch.has_bits(wanted.value, docs)).tolist():
                parts = rows[k][2].split(b"\n")
                own = _line_keys(docs[k], np.arange(len(parts)))
                for i in np.flatnonzero(sketch.has_bits(wanted.value, own)).tolist():
                    lines.append(parts[i])
                    keys.append(own[i])
            tokens, bounds = _sets(*word_hashes(lines))
            sets = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(tokens.view("<i8")))
            yield pa.RecordBatch.from_arrays([pa.array(np.array(keys, U64).view("<i8")), sets], ["line", "tokens"])

    return run


def _keyed():
    """Task that adds the keys of both lines to pairs of places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for x in ("a", "b"):
                ids, ties, lines = (np.asarray(batch.column(f"{x}_{c}")) for c in ("id", "tie", "line"))
                keys.append(pa.array(_line_keys(_doc_keys(ids, ties), lines).view("<i8")))
            yield pa.RecordBatch.from_arrays([*batch.columns, *keys], [*batch.schema.names, "a", "b"])

    return run


def _verified(docs: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """Pairs with ``alike``: whether the Jaccard similarity of the whole sets is high enough."""

    def mark(batches: Iterator[pa.RecordBatch], cells: np.ndarray) -> None:
        for batch in batches:
            for x in ("a", "b"):
                ids, ties, lines = (np.asarray(batch.column(f"{x}_{c}")) for c in ("id", "tie", "line"))
                docs = _doc_keys(ids, ties)
                sketch.add_bits(cells, docs)
                sketch.add_bits(cells, _line_keys(docs, lines))

    spark = docs.sparkSession
    wanted = spark.sparkContext.broadcast(sketch.merged(sketch.tables(pairs, mark), np.bitwise_or))
    sets = docs.mapInArrow(_sets_task(wanted), "line long, tokens array<long>").groupBy("line").agg(F.first("tokens").alias("tokens"))
    keyed = pairs.mapInArrow(_keyed(), ", ".join(f"{n} long" for n in _NAMES) + ", more boolean, a long, b long")
    whole = keyed.join(sets.select(F.col("line").alias("a"), F.col("tokens").alias("a_set")), "a").join(
        sets.select(F.col("line").alias("b"), F.col("tokens").alias("b_set")), "b"
    )
    shared = F.size(F.array_intersect("a_set", "b_set"))
    alike = shared >= (F.size("a_set") + F.size("b_set") - shared) * similarity - 1e-9
    return whole.withColumn("alike", alike).drop("a", "a_set")


def _slot_rows(slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties, lines = (np.asarray(batch.column(c)) for c in ("b_id", "b_tie", "b_line"))
            rows = _slots(ids, ties.astype("<u4"), lines, slots)
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int32()] + [pa.binary()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["slot", "ids", "ties", "counts", "steps"])

    return run


def _apply_task(kind: T.StructType):
    """Task that drops lines from the texts of one slot."""

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        kept: dict[tuple[int, int], set[int]] = {}
        gone: dict[tuple[int, int], set[int]] = {}
        for r in found.to_pylist():
            ids, ties, row, line = unpack_places(r["ids"], r["ties"], r["counts"], r["steps"])
            into = kept if r["first"] else gone
            for k, part in enumerate(np.split(line, np.flatnonzero(np.diff(row)) + 1)):
                into.setdefault((int(ids[k]), int(ties[k])), set()).update(part.tolist())
        texts, totals, removed = [], [], []
        whole = pc.struct_field(docs.column("row"), "text").to_pylist()
        for doc_id, text in zip(docs.column("key").to_pylist(), whole, strict=True):
            data = (text or "").encode()
            place = (doc_id, zlib.crc32(data))
            left = kept.get(place, set()) - gone.get(place, set())
            lines = data.split(b"\n")
            filled = [bool(x) and not x.isspace() for x in lines]
            texts.append(b"\n".join(x for i, x in enumerate(lines) if not filled[i] or i in left).decode())
            totals.append(sum(filled))
            removed.append(totals[-1] - len(left))
        columns = [docs.column("row"), pa.array(texts, pa.string()), pa.array(totals, pa.int64()), pa.array(removed, pa.int64())]
        return pa.table(columns, names=kind.names)

    return run


def _joined_again(docs: DataFrame, doubtful: DataFrame, counted, bits: int, slots: int, similarity: float) -> DataFrame:
    """Lines of ``doubtful`` that any of all their candidates confirms.

    Only the lists of these lines' prefix tokens are made again, this time with every pair that ends
    in one of them and with a parity of 512 bits, which hardly lets an unlike pair through.
    """

    def mark(batches: Iterator[pa.RecordBatch], cells: np.ndarray) -> None:
        for batch in batches:
            sets = batch.column("b_set")
            tokens = np.asarray(sets.flatten()).view(U64)
            ordered, _, _, used = _prefixes(tokens, np.asarray(sets.offsets).astype(np.int64) - sets.offsets[0].as_py(), counted.value, similarity)
            sketch.add_bits(cells, ordered[used] << U64(64 - TOKEN_BITS))

    spark = docs.sparkSession
    def name(batches: Iterator[pa.RecordBatch], cells: np.ndarray) -> None:
        for batch in batches:
            ids, ties, lines = (np.asarray(batch.column(f"b_{c}")) for c in ("id", "tie", "line"))
            sketch.add_bits(cells, _line_keys(_doc_keys(ids, ties), lines))

    among = spark.sparkContext.broadcast(sketch.merged(sketch.tables(doubtful.select("b_set"), mark), np.bitwise_or))
    wanted = spark.sparkContext.broadcast(sketch.merged(sketch.tables(doubtful.select("b_id", "b_tie", "b_line"), name), np.bitwise_or))
    shipped = docs.mapInArrow(_shipping_task(bits, counted, similarity, among), _SHIPPED)
    every = shipped.groupBy("bucket").applyInArrow(_bucket_task(slots, similarity, None, wanted), _FOUND)
    later = ["b_id", "b_tie", "b_line"]
    pairs = every.join(doubtful.select(*later), later, "left_semi").select(*_NAMES, "more").distinct()
    return _verified(docs, saved(pairs), similarity).where("alike").select(*later)


def dedup(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Remove every line that is similar to an earlier one, over the whole corpus.

    Returns one row per row of ``docs``: ``row`` (the whole input row), ``kept_text``, ``n_lines``
    (lines with a word) and ``n_removed``.

    A line is a set of words (runs of other than ASCII white space, unchanged).  It goes if the
    Jaccard similarity with an earlier line of any document, itself removed or not, is at least
    ``similarity``; earlier means a smaller id, then an earlier line.  Lines without words always
    stay.  A null id is larger than every other; documents of equal id are ordered by a checksum of
    the text, and repeated rows are treated alike.  Null texts have no lines.  Extra columns are
    passed on inside ``row``.

    Tokens are ordered by rarity (counters of fixed size over all lines, then by hash).  Lines meet
    at tokens of their prefixes, if no filter rules the pair out: length, position of the token, or
    a 128-bit parity of the sets, which never differs in more bits than the sets do in tokens.  Each
    list names a line's nearest partners first; pairs are verified on the whole sets.  Lines that
    none of these confirms and that had more partners are joined again with all of them.
    """
    spark = docs.sparkSession
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits, slots = max(6, int(size // BUCKET).bit_length()), prime_from(max(64, int(size // BUCKET)))
    counted = spark.sparkContext.broadcast(rarity(thin))
    shipped = thin.mapInArrow(_shipping_task(bits, counted, similarity), _SHIPPED)
    found = saved(shipped.groupBy("bucket").applyInArrow(_bucket_task(slots, similarity, NEAREST), _FOUND))
    later = ["b_id", "b_tie", "b_line"]
    pairs = found.where("b_id is not null").groupBy(*_NAMES).agg(F.max("more").alias("more"))
    judged = saved(_verified(thin, pairs, similarity))
    gone = judged.where("alike").select(*later)
    doubtful = judged.groupBy(*later).agg(F.max("more").alias("more"), F.max("alike").alias("alike"), F.first("b_set").alias("b_set"))
    doubtful = saved(doubtful.where("more and not alike").drop("more", "alike"))
    if doubtful.limit(1).count():
        gone = gone.unionByName(_joined_again(thin, doubtful, counted, bits, slots, similarity))
    places = (
        found.where("slot is not null")
        .select("slot", "ids", "ties", "counts", "steps", F.lit(True).alias("first"))
        .unionByName(gone.distinct().mapInArrow(_slot_rows(slots), _PLACES).withColumn("first", F.lit(False)))
    )
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(int(LAST)))
    keyed = docs.select(F.struct("*").alias("row"), key.alias("key"), slot_column(key, docs["text"], slots).alias("slot"))
    kind = T.StructType(
        [keyed.schema["row"], T.StructField("kept_text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())]
    )
    return keyed.groupBy("slot").cogroup(places.groupBy("slot")).applyInArrow(_apply_task(kind), kind)


def clean(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with similar later lines taken out of ``text``, all columns as they are.

    A text that loses nothing stays unchanged, null included; ``n_chars``, where there is one, is
    counted anew.  A document that loses all its lines stays, with an empty text.
    """
    found = dedup(docs, similarity)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("row.text"))
    given = {"text": text.alias("text"), "n_chars": F.length(text).cast("long").alias("n_chars")}
    return found.select(*[given.get(c, F.col("row").getField(c).alias(c)) for c in docs.columns])
