"""Collocations: frequent phrases counted by direct-address tiles of frequency-ranked ids, level by level."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordat.llm import sketch
from concordat.llm.wordvec import U64, from_planes, mix, planes
from concordat.session import materialize

#: Units of a level that get a rank as their id, and rows or columns of a tile.
RANK_BITS, TILE_BITS = 17, 10
RANKS, TILE = 1 << RANK_BITS, 1 << TILE_BITS
#: Pairs of one flush in a tile from which it is counted densely, dense tiles of a task, sparse cells of a task.
DENSE, DENSE_TILES, SPARSE = TILE * TILE // 16, 4, 1_500_000
FLUSH, WORDS_KEPT, LONGEST_RANKED = 2_000_000, 150_000, 64
#: Ids that are no ranks start here; keys that are no tile places at half of it.
_OTHER, _HASHED = np.int64(1 << 62), np.int64(1 << 61)
_CUTS = b".,;:!?\n\x0b\x0c\r"
_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_PLAIN = bytes.maketrans(_UPPER + _CUTS + b"\t", _LOWER + b"\n" * len(_CUTS) + b" ")
#: What stands for the end of a piece, for nothing, and for a word that no frequent phrase holds.
_END, _NONE, _RARE = -1, -2, -3


def _flushes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """Texts of one language after the other, in lower case, with a line feed at every cut.

    A flush has about ``FLUSH`` bytes; a longer text is dealt at cuts.
    """
    waiting: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
            text = text.as_py().translate(_PLAIN)
            while len(text) > 2 * FLUSH and (at := text.find(b"\n", FLUSH)) >= 0:
                yield lang, text[:at]
                text = text[at:]
            waiting.setdefault(lang, []).append(text)
            size += len(text) + 1
            if size > FLUSH:
                yield from ((k, b"\n".join(v)) for k, v in waiting.items())
                waiting, size = {}, 0
    yield from ((k, b"\n".join(v)) for k, v in waiting.items())


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, found in counts.items():
            words = pa.array(list(found), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), words, pa.array(list(found.values()), pa.int64())], ["lang", "word", "n"])

    for lang, data in _flushes(batches):
        counts.setdefault(lang, Counter()).update(data.split())
        if sum(map(len, counts.values())) > WORDS_KEPT:
            yield from rows()
            counts.clear()
    yield from rows()


def _word_id(lang: str, word: bytes) -> int:
    """Id of a word without a rank."""
    return (xxhash.xxh64_intdigest(lang.encode() + b"\0" + word) >> 2) | int(_HASHED) | int(_OTHER)


def keys_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Keys of pairs of ids: the place in the table of all pairs of ranks, else a hash."""
    keys = (a << np.int64(RANK_BITS)) | b
    other = np.flatnonzero((a >= RANKS) | (b >= RANKS))
    if len(other):
        hashed = mix(mix(a[other].view(U64)) * U64(0x9E3779B97F4A7C15) + b[other].view(U64))
        keys[other] = (hashed >> U64(2)).view(np.int64) | _HASHED
    return keys


def unpacked(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of pairs as they come out of :class:`Tiles`."""
    place = b == _END
    return np.where(place, a >> np.int64(RANK_BITS), a), np.where(place, a & np.int64(RANKS - 1), b)


class Units:
    """The frequent units of a level: ranks of the most frequent by their keys, and bits that mark all if there are more."""

    def __init__(self, by_rank: np.ndarray, bits: np.ndarray | None):
        order = np.argsort(by_rank)
        self.keys, self.ranks, self.bits = by_rank[order], order.astype(np.int64), bits

    def ids(self, keys: np.ndarray) -> np.ndarray:
        """Ids of keys, below zero for those that are not frequent."""
        out = np.full(len(keys), _RARE, np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[at] == keys
            out[hit] = self.ranks[at[hit]]
        if self.bits is not None:
            rest = np.flatnonzero(out < 0)
            there = rest[sketch.has_bits(self.bits, mix(keys[rest].view(U64)))]
            out[there] = keys[there] | _OTHER
        return out


def squeeze(ids: np.ndarray) -> np.ndarray:
    """Ids without those that have no frequent neighbour, and with one end between two runs."""
    there = np.concatenate(([False], ids >= 0, [False]))
    kept = there[1:-1] & (there[:-2] | there[2:])
    ids = np.where(kept, ids, _END)
    return ids[kept | np.concatenate(([False], kept[:-1]))]


def _rows(ids: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array([planes(x) for x in ids], pa.binary())], ["ids"])


def _encode(names: dict[str, dict[bytes, int]], bits: np.ndarray | None):
    """Texts as ids of frequent words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, data in _flushes(batches):
            known = names.get(lang, {})
            tokens = data.replace(b"\n", b" \n ").split(b" ")
            ids = np.fromiter(map(known.get, tokens, repeat(_RARE)), np.int64, len(tokens))
            if bits is not None:
                missing = np.flatnonzero(ids == _RARE)
                unlike = list({tokens[i] for i in missing})
                of = np.array([_word_id(lang, w) for w in unlike], np.int64)
                frequent = sketch.has_bits(bits, mix(of.view(U64))) if len(of) else np.zeros(0, bool)
                more = dict(zip(unlike, np.where(frequent, of, _RARE).tolist(), strict=True))
                ids[missing] = [more[tokens[i]] for i in missing]
            del tokens
            ids = squeeze(ids[ids != _NONE])
            if len(ids):
                yield from _rows([np.append(ids, _END)])

    return run


def _recode(units: Units):
    """Ids of units as ids of the units one word longer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("ids"):
                ids = from_planes(data.as_py(), "<i8")
                a, b = ids[:-1], ids[1:]
                at = np.flatnonzero((a >= 0) & (b >= 0))
                longer = np.full(len(a), _END, np.int64)
                longer[at] = units.ids(keys_of(a[at], b[at]))
                longer = squeeze(longer)
                if len(longer):
                    yield from _rows([np.append(longer, _END)])

    return run


class Tiles:
    """Counts of pairs in one task.

    The table of all pairs of ranks is cut into tiles of 1024 by 1024.  Pairs of a tile that many pairs of a flush
    fall into are counted by their place in it; all others are sorted and counted as coordinates.  A pair of ranks
    is its place in the whole table, with the end as its second number, so that it is kept and sorted as one.
    """

    def __init__(self):
        self.dense: dict[int, np.ndarray] = {}
        self.sparse: list[tuple[np.ndarray, np.ndarray]] = []
        self.others: list[tuple[np.ndarray, ...]] = []
        self.cells = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        width = RANK_BITS - TILE_BITS
        ranked = (a < RANKS) & (b < RANKS)
        tile = np.where(ranked, (a >> TILE_BITS) << width | (b >> TILE_BITS), 1 << (2 * width))
        sizes = np.bincount(tile, minlength=(1 << (2 * width)) + 1)[:-1]
        left = np.ones(len(a), bool)
        for t in np.flatnonzero(sizes >= DENSE).tolist():
            if t in self.dense or len(self.dense) < DENSE_TILES:
                here = tile == t
                place = (a[here] & (TILE - 1)) << TILE_BITS | (b[here] & (TILE - 1))
                counts = np.bincount(place, minlength=TILE * TILE)
                if t in self.dense:
                    self.dense[t] += counts
                else:
                    self.dense[t] = counts
                left &= ~here
        del tile
        a, b = a[left], b[left]
        plain = (a < RANKS) & (b < RANKS)
        self._keep(*np.unique(a[plain] << np.int64(RANK_BITS) | b[plain], return_counts=True))
        a, b = a[~plain], b[~plain]
        if len(a):
            self.others.append(_added(a, b, np.ones(len(a), np.int64)))
            self.cells += len(self.others[-1][0])

    def _keep(self, places: np.ndarray, n: np.ndarray) -> None:
        if len(places):
            self.sparse.append((places, n))
            self.cells += len(places)

    def _merge(self) -> None:
        if self.sparse:
            places, n = (np.concatenate(x) for x in zip(*self.sparse, strict=True))
            self.sparse = []
            order = np.argsort(places)
            places, n = places[order], n[order]
            del order
            first = np.flatnonzero(np.concatenate(([True], places[1:] != places[:-1])))
            self.sparse = [(places[first], np.add.reduceat(n, first))]
        if self.others:
            self.others = [_added(*(np.concatenate(x) for x in zip(*self.others, strict=True)))]
        self.cells = sum(len(x[0]) for x in self.sparse + self.others)

    def full(self) -> bool:
        """Whether the cells should go, after equal ones have been added up."""
        if self.cells > SPARSE:
            self._merge()
        return self.cells > SPARSE // 2

    def take(self) -> Iterator[pa.RecordBatch]:
        width = RANK_BITS - TILE_BITS
        while self.dense:
            t, counts = self.dense.popitem()
            place = np.flatnonzero(counts)
            a = (t >> width << TILE_BITS) + (place >> TILE_BITS)
            self._keep(a << RANK_BITS | ((t & ((1 << width) - 1)) << TILE_BITS) + (place & (TILE - 1)), counts[place])
        self._merge()
        # A pair of ranks travels as its place in the table: one number for two, and small.
        rows = [(places, np.broadcast_to(np.int64(_END), len(places)), n) for places, n in self.sparse] + self.others
        for columns in rows:
            for lo in range(0, len(columns[0]), 100_000):
                part = slice(lo, lo + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x[part])) for x in columns], ["a", "b", "n"])
        self.__init__()


def _added(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Unlike pairs with the sums of their counts."""
    order = np.lexsort((b, a))
    a, b, n = a[order], b[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
    return a[first], b[first], np.add.reduceat(n, first)


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tiles = Tiles()
    for batch in batches:
        for data in batch.column("ids"):
            ids = from_planes(data.as_py(), "<i8")
            at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
            tiles.add(ids[at], ids[at + 1])
            if tiles.full():
                yield from tiles.take()
    yield from tiles.take()


def _marked(keys: DataFrame) -> np.ndarray:
    """Bits of fixed size that mark all ``key``."""

    def put(batches: Iterator[pa.RecordBatch], cells: np.ndarray) -> None:
        for batch in batches:
            sketch.add_bits(cells, mix(batch.column("key").to_numpy().view(U64)))

    return sketch.merged(sketch.tables(keys, put), np.bitwise_or)


def _frequent_words(docs: DataFrame, least: int):
    """Frequent words with their ids, and what tasks need to encode texts."""
    counts = docs.mapInArrow(_count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("f"))
    counts = materialize(counts)
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = counts.where(F.col("f") >= least)
    top = frequent.where(F.octet_length("word") <= LONGEST_RANKED).orderBy(F.desc("f"), "lang", "word").limit(RANKS).select("lang", "word")
    names: dict[str, dict[bytes, int]] = {}
    for rank, row in enumerate(top.collect()):
        names.setdefault(row["lang"], {b"\n": _END, b"": _NONE})[row["word"].encode()] = rank

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("lang").to_pylist(), batch.column("word").cast(pa.binary()).to_pylist(), strict=True)
            ids = [names.get(lang, {}).get(word, -1) for lang, word in pairs]
            keys = [_word_id(lang.as_py(), word.as_py().encode()) if i < 0 else i for i, lang, word in zip(ids, batch.column("lang"), batch.column("word"), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *(batch.column(c) for c in ("lang", "word", "f"))], ["id", "lang", "word", "f"])

    words = materialize(frequent.mapInArrow(give, "id long, lang string, word string, f long"))
    without = words.where(F.col("id") >= int(_OTHER)).select(F.col("id").alias("key"))
    bits = _marked(without) if without.take(1) else None
    kept = words.join(totals, "lang").select("id", "lang", "n", "f", F.col("word").alias("text"), F.col("word").alias("last"), F.array("f").alias("head"), F.array("f").alias("tail"))
    return materialize(kept), names, bits


def _frequent_pairs(ids: DataFrame, least: int) -> tuple[DataFrame, Units]:
    """Frequent pairs of neighbouring units with the id of the longer unit, and what tasks need to recode."""

    def add_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = unpacked(*(batch.column(c).to_numpy() for c in ("a", "b")))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), batch.column("f"), pa.array(keys_of(a, b))], ["a", "b", "f", "key"])

    counts = ids.mapInArrow(_count_pairs, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    pairs = materialize(counts.mapInArrow(add_key, "a long, b long, f long, key long"))
    top = [r["key"] for r in pairs.orderBy(F.desc("f"), "key").limit(RANKS).select("key").collect()]
    bits = _marked(pairs.select("key")) if len(top) == RANKS else None
    units = Units(np.array(top, np.int64), bits)

    def add_id(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = units.ids(batch.column("key").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(found), *(batch.column(c) for c in ("a", "b", "f"))], ["id", "a", "b", "f"])

    return pairs.mapInArrow(add_id, "id long, a long, b long, f long"), units


def _longer(pairs: DataFrame, units: DataFrame) -> DataFrame:
    """Phrases of pairs: text, counts of all heads and tails."""
    left = units.select(F.col("id").alias("a"), "lang", "n", "text", "head")
    right = units.select(F.col("id").alias("b"), "last", "tail")
    both = pairs.join(left, "a").join(right, "b")
    one = F.array("f")
    return both.select("id", "lang", "n", "f", F.concat("text", F.lit(" "), "last").alias("text"), "last", F.concat("head", one).alias("head"), F.concat("tail", one).alias("tail"))


def _scored(phrases: DataFrame, size: int) -> DataFrame:
    """Phrases of ``size`` words with the counts and the score of their lowest-scoring cut, exactly."""
    cuts = [F.struct(F.col("head")[k - 1].alias("l"), F.col("tail")[size - k - 1].alias("r"), F.lit(k).alias("k")) for k in range(1, size)]
    score = "(CAST(1000 AS DECIMAL(4,0)) * CAST(f AS DECIMAL(17,0)) * CAST(n AS DECIMAL(17,0))) div (CAST(cut.l AS DECIMAL(19,0)) * CAST(cut.r AS DECIMAL(19,0)))"
    least = F.expr(f"array_min(transform(cuts, cut -> named_struct('score', {score}, 'k', cut.k, 'l', cut.l, 'r', cut.r)))")
    found = phrases.withColumn("cuts", F.array(*cuts)).withColumn("least", least)
    return found.select("lang", F.col("text").alias("phrase"), F.col("f").alias("a"), "least.l", "least.r", "n", "least.score")


def mine(docs: DataFrame, longest: int = 5, least: int = 100, most: int = 2000) -> DataFrame:
    """The ``most`` best phrases of two to ``longest`` words of each language.

    Returns ``lang, rank, phrase, a, l, r, n, score``.  Words are lower-cased (A-Z) and lie in pieces between
    marks and line ends.  A phrase found ``a >= least`` times is cut where its score ``1000 * a * n / (l * r)``
    is lowest; it goes if a longer phrase holds it each time.  Counts are exact and over all documents.

    Words get ids by frequency; neighbours are counted in tiles of the table of all pairs of ids, added up in
    Spark, and frequent pairs, ranked in their turn, are the units of the next level: texts are read twice, then
    only runs of frequent units.  Tasks hold ranks of the 131 072 most frequent units of a level; further units
    are named by hashes of 62 bits, found by a table of bits of fixed size, and counted as coordinates, so no
    number of units is dropped.

    Null texts are empty, null languages ``und``.  Repeated rows count each time.  No rows give no rows.  Other
    columns, null ids too, are not looked at.  A text of any length is dealt at marks.
    """
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    units, names, bits = _frequent_words(texts, least)
    ids = materialize(texts.mapInArrow(_encode(names, bits), "ids binary"))
    found = None
    for size in range(2, longest + 1):
        pairs, table = _frequent_pairs(ids, least)
        pairs = materialize(pairs)
        if size > 2:
            found = _kept(units, pairs, size - 1, found)
        units = materialize(_longer(pairs, units))
        if size < longest:
            ids = materialize(ids.mapInArrow(_recode(table), "ids binary"))
    scored = _scored(units, longest)
    found = scored if found is None else found.unionByName(scored)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long")
    return found.withColumn("rank", rank).where(F.col("rank") <= most).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _kept(units: DataFrame, pairs: DataFrame, size: int, found: DataFrame | None) -> DataFrame:
    """``found`` and the phrases of ``size`` words that no phrase one word longer holds each time.

    If a longer phrase holds one each time, so does one that is one word longer.
    """
    inside = pairs.select(F.explode(F.array("a", "b")).alias("id"), "f").groupBy("id").agg(F.max("f").alias("held"))
    free = units.join(inside, "id", "left").where((F.coalesce("held", F.lit(0)) < F.col("f"))).drop("held")
    scored = _scored(free, size)
    return scored if found is None else found.unionByName(scored)
