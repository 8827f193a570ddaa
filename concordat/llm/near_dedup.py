"""MinHash near-dedup: consistent weighted sampling over weighted shingles, banded and verified."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.llm import sketch
from concordat.llm.shared import saved
from concordat.llm.wordvec import LAST, U64, mix, window_hashes, word_hashes

SHINGLE, SIMILARITY = 5, 0.8
#: Bands of samples.  Texts of similarity 0.8 share no band with a chance of 0.512 ** BANDS missed: 0.0008.
BANDS, ROWS = 10, 3
#: What the rarest shingle weighs more than the commonest.  Copies make their own shingles common, so a
#: wide range would let every edit of a much-copied text outweigh what it shares with the others.
RARITY_SHARE = 0.125
FLUSH, CHUNK, TOKEN_BITS = 3 << 20, 1 << 15, 49
#: Bins of the one-permutation sketch that rules out pairs before texts are fetched, and its slack in
#: standard deviations.
BINS, DEVIATIONS = 128, 4
#: Of 30 four-bit samples, those that texts of similarity 0.8 share with a chance of all but 0.00005.
AGREE = 16
#: Contested texts that share a shingle meet by it if they are at most this many.  Others can be alike only by
#: shingles that more of them have, which bounds what they share.
FEW = 64

_TABLE = 1 << 16
_random = np.random.default_rng(20100914)
_R = _random.gamma(2.0, 1.0, _TABLE).astype("<f4")
_LOG_C = np.log(_random.gamma(2.0, 1.0, _TABLE)).astype("<f4")
_BETA = _random.random(_TABLE).astype("<f4")
_SALTS = _random.integers(1, 2**63, BANDS * ROWS, dtype=U64) * U64(2) + U64(1)


@dataclass
class Shingles:
    """Distinct shingles of texts, sorted within each text, and how often each occurs."""

    tokens: np.ndarray
    times: np.ndarray
    bounds: np.ndarray

    @property
    def of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def shingles(texts: list[bytes]) -> Shingles:
    """Five-word shingles; a text of one to four words is one shingle, a blank one has none."""
    tokens, times, sizes = [], [], []
    for lo in range(0, len(texts), CHUNK):
        part = texts[lo : lo + CHUNK]
        words, bounds = word_hashes(part)
        found, counts = window_hashes(words, bounds, SHINGLE)
        short = np.flatnonzero((np.diff(bounds) > 0) & (counts == 0))
        whole = np.array([mix(np.cumsum(mix(words[bounds[i] : bounds[i + 1]])))[-1] for i in short], U64)
        of = np.concatenate((np.repeat(np.arange(len(part)), counts), short)).astype(U64)
        both = (of << U64(TOKEN_BITS)) | (np.concatenate((found, whole)) >> U64(64 - TOKEN_BITS))
        both.sort()
        first = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1]))[: len(both)])
        times.append(np.diff(np.append(first, len(both))))
        both = both[first]
        sizes.append(np.bincount((both >> U64(TOKEN_BITS)).astype(np.int64), minlength=len(part)))
        tokens.append(both & U64((1 << TOKEN_BITS) - 1))
    if not tokens:
        return Shingles(np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(1, np.int64))
    return Shingles(np.concatenate(tokens), np.concatenate(times), np.concatenate(([0], np.cumsum(np.concatenate(sizes)))))


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> U64(TOKEN_BITS - sketch.BITS)).astype(np.int64)


def _flushes(batches: Iterator[pa.RecordBatch], size: int = FLUSH) -> Iterator[tuple[list[int], list[bytes]]]:
    ids, texts, held = [], [], 0
    for batch in batches:
        for lo in range(0, batch.num_rows, 500):
            part = batch.slice(lo, 500)
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                ids.append(LAST if doc_id is None else doc_id)
                texts.append((text or "").encode())
                held += len(texts[-1])
                if held >= size:
                    yield ids, texts
                    ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def frequencies(docs: DataFrame) -> np.ndarray:
    """How many documents hold the shingles of each cell; all documents count, copies too."""

    def fill(batches: Iterator[pa.RecordBatch], cells: np.ndarray) -> None:
        for _, texts in _flushes(batches):
            at, counts = np.unique(_cells(shingles(texts).tokens), return_counts=True)
            cells[at] += counts.astype("<u4")

    return sketch.merged(sketch.tables(docs, fill))


def weights(found: Shingles, counted: np.ndarray, n_docs: int) -> np.ndarray:
    """TF-IDF weights: occurrences times an inverse document frequency scaled to a narrow range."""
    often = np.maximum(counted[_cells(found.tokens)], 1)
    rarity = np.log1p(n_docs / often) / np.log1p(max(n_docs, 1))
    return (found.times * (1 + RARITY_SHARE * rarity)).astype("<f4")


def samples(found: Shingles, weight: np.ndarray) -> np.ndarray:
    """Consistent weighted samples: one row for each text with shingles, one column for each draw.

    A shingle's draws (two of a gamma distribution, one uniform) come from tables indexed by its
    salted hash; of equal draws the smaller hash wins.  Two texts share a sample with a chance of
    their weighted Jaccard similarity.
    """
    filled = np.flatnonzero(np.diff(found.bounds))
    starts, sizes = found.bounds[:-1][filled], np.diff(found.bounds)[filled]
    out = np.zeros((len(filled), len(_SALTS)), U64)
    if not len(filled):
        return out
    logs = np.log(weight)
    for k, salt in enumerate(_SALTS):
        at = ((found.tokens * salt) >> U64(48)).astype(np.intp)
        r = _R[at]
        level = np.floor(logs / r + _BETA[at])
        rank = _LOG_C[at] - r * (level - _BETA[at] + 1)
        hit = np.flatnonzero(rank == np.repeat(np.minimum.reduceat(rank, starts), sizes))
        first = hit[np.searchsorted(hit, starts)]
        out[:, k] = mix(found.tokens[first] ^ (level[first].astype(np.int64).view(U64) * U64(0xD6E8FEB86659FD93)) ^ salt)
    return out


def bins(found: Shingles) -> np.ndarray:
    """One-permutation sketch of all occurrences: the smallest of each bin, as 16 bits, 0 where there is none.

    The second and later occurrences of a shingle are elements of their own, so that the share of
    equal bins estimates the Jaccard similarity of the multisets.
    """
    out = np.zeros((len(found.bounds) - 1, BINS), "<u2")
    if len(found.tokens):
        of, value = found.of, found.tokens
        more = found.times - 1
        if more.any():
            nth = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
            again = mix(np.repeat(value, more) ^ mix(nth.astype(U64))) >> U64(64 - TOKEN_BITS)
            of, value = np.concatenate((of, np.repeat(of, more))), np.concatenate((value, again))
            order = np.lexsort((value, of))
            of, value = of[order], value[order]
        place = of * BINS + (value >> U64(TOKEN_BITS - 7)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        out.reshape(-1)[place[first]] = ((mix(value[first]) >> U64(48)) | U64(1)).astype("<u2")
    return out


def least_share(similarity: float) -> float:
    """Share of equal bins below which texts are not of this weighted similarity.

    Rarity may weigh what texts share up to ``1 + RARITY_SHARE`` times what they do not, so their
    occurrences can be a little less alike; the sketch's own error comes below that.
    """
    alike = similarity / (similarity + (1 - similarity) * (1 + RARITY_SHARE))
    return alike - DEVIATIONS * (alike * (1 - alike) / BINS) ** 0.5


def _node(data: bytes) -> bytes:
    return hashlib.md5(data).digest()


def _signature_task(counted, n_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _flushes(batches):
            found = shingles(texts)
            drawn = samples(found, weights(found, counted.value, n_docs))
            filled = np.diff(found.bounds) > 0
            keys = np.zeros((len(texts), BANDS), U64)
            nibbles = np.zeros((len(texts), 2), U64)
            if len(drawn):
                keys[filled] = np.stack(
                    [mix(mix(mix(drawn[:, b * ROWS] + U64(b)) ^ drawn[:, b * ROWS + 1]) ^ drawn[:, b * ROWS + 2]) for b in range(BANDS)], axis=1
                )
                for half in (0, 1):
                    for j in range(15):
                        nibbles[filled, half] |= (drawn[:, half * 15 + j] & U64(15)) << U64(4 * j)
            ends = np.concatenate(([0], np.cumsum(np.where(filled, BANDS, 0)))).astype(np.int32)
            bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[filled].ravel().view("<i8")))
            sketches = pa.array([x.tobytes() for x in bins(found)], pa.binary())
            columns = [pa.array(ids, pa.int64()), pa.array([_node(t) for t in texts], pa.binary()), bands, sketches]
            columns += [pa.array(nibbles[:, k].copy().view("<i8")) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "bands", "sketch", "n0", "n1"])

    return run


def _likely(pairs: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """Pairs that the one-permutation sketches do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, BINS) for c in ("x", "y"))
            same = ((x == y) & (x > 0)).sum(axis=1)
            either = ((x > 0) | (y > 0)).sum(axis=1)
            yield batch.select(["a", "b"]).filter(pa.array(same >= least_share(similarity) * either))

    both = pairs.join(sketches.select(F.col("node").alias("a"), F.col("sketch").alias("x")), "a").join(
        sketches.select(F.col("node").alias("b"), F.col("sketch").alias("y")), "b"
    )
    return both.select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


def similarities(left: list[bytes], right: list[bytes], counted: np.ndarray, n_docs: int) -> np.ndarray:
    """Weighted Jaccard similarity of each pair of texts; of two blank ones 1."""
    out = np.zeros(len(left))
    for lo in range(0, len(left), 256):
        a, b = shingles(left[lo : lo + 256]), shingles(right[lo : lo + 256])
        wa, wb = (weights(x, counted, n_docs).astype(float) for x in (a, b))
        ka, kb = ((x.of.astype(U64) << U64(TOKEN_BITS)) | x.tokens for x in (a, b))
        at = np.minimum(np.searchsorted(kb, ka), max(len(kb) - 1, 0))
        hit = np.flatnonzero(kb[at] == ka) if len(kb) else np.zeros(0, np.int64)
        n = len(a.bounds) - 1
        shared = np.bincount(a.of[hit], np.minimum(wa[hit], wb[at[hit]]), n)
        every = np.bincount(a.of, wa, n) + np.bincount(b.of, wb, n) - shared
        out[lo : lo + 256] = np.where(every > 0, shared / np.where(every > 0, every, 1), 1.0)
    return out


def _links(docs: DataFrame, pairs: DataFrame, sketches: DataFrame, counted, n_docs: int, similarity: float) -> DataFrame:
    """Pairs of nodes whose texts' weighted Jaccard similarity is high enough."""
    spark = docs.sparkSession
    likely = saved(_likely(pairs, sketches, similarity))

    def mark(batches: Iterator[pa.RecordBatch], cells: np.ndarray) -> None:
        for batch in batches:
            for name in ("a", "b"):
                sketch.add_bits(cells, np.frombuffer(b"".join(x[:8] for x in batch.column(name).to_pylist()), "<u8"))

    wanted = spark.sparkContext.broadcast(sketch.merged(sketch.tables(likely, mark), np.bitwise_or))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _flushes(batches):
            nodes = {_node(t): t for t in texts}
            keys = np.frombuffer(b"".join(n[:8] for n in nodes), "<u8")
            kept = [x for x, there in zip(nodes.items(), sketch.has_bits(wanted.value, keys).tolist(), strict=True) if there]
            columns = [pa.array([x[k] for x in kept], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "data"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                left, right = (part.column(c).to_pylist() for c in ("x", "y"))
                alike = similarities(left, right, counted.value, n_docs) >= similarity - 1e-6
                yield part.select(["a", "b"]).filter(pa.array(alike))

    texts = docs.mapInArrow(named, "node binary, data binary").groupBy("node").agg(F.first("data").alias("data"))
    both = likely.join(texts.select(F.col("node").alias("a"), F.col("data").alias("x")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("data").alias("y")), "b"
    )
    return saved(both.select("a", "b", "x", "y").mapInArrow(compare, "a binary, b binary"))


def _strength(docs: DataFrame, contested: DataFrame, counted, n_docs: int, few: int = FEW) -> tuple[DataFrame, DataFrame]:
    """What contested nodes can share: weights by node, and lists of the nodes that share a rare shingle.

    Of each node: ``key``, ``able``, the weight of shingles that other contested nodes have too,
    ``single``, the rest, and ``low``, the weight of shingles that at most ``few`` contested nodes
    have, single ones included.  ``keys``: the nodes of each such shingle, equal lists once.
    """

    def mark(batches: Iterator[pa.RecordBatch], cells: np.ndarray) -> None:
        for batch in batches:
            sketch.add_bits(cells, np.frombuffer(b"".join(x[:8] for x in batch.column("node").to_pylist()), "<u8"))

    wanted = docs.sparkSession.sparkContext.broadcast(sketch.merged(sketch.tables(contested, mark), np.bitwise_or))

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _flushes(batches):
            nodes = {_node(t): t for t in texts}
            keys = np.frombuffer(b"".join(n[:8] for n in nodes), "<u8")
            kept = [x for x, there in zip(nodes.items(), sketch.has_bits(wanted.value, keys).tolist(), strict=True) if there]
            found = shingles([t for _, t in kept])
            weight = weights(found, counted.value, n_docs)
            ends = pa.array(found.bounds.astype(np.int32))
            columns = [pa.array([n for n, _ in kept], pa.binary()), pa.array([int.from_bytes(n[:8], "little", signed=True) for n, _ in kept], pa.int64())]
            columns += [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (found.tokens.view("<i8"), weight)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "key", "tokens", "weights"])

    rows = docs.mapInArrow(weighed, "node binary, key long, tokens array<long>, weights array<float>")
    rows = saved(rows.groupBy("node").agg(*[F.first(c).alias(c) for c in ("key", "tokens", "weights")]))
    each = rows.select("key", F.explode(F.arrays_zip("tokens", "weights")).alias("x")).select("key", F.col("x.tokens").alias("token"), F.col("x.weights").alias("w"))
    rare = saved(each.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("key"), F.max("w").alias("w")).where(F.col("n") <= few))
    single = rare.where("n = 1").groupBy("key").agg(F.sum("w").alias("single"))
    shared = saved(each.join(rare.where("n > 1").select("token"), "token"))
    low = shared.groupBy("key").agg(F.sum("w").alias("low"))
    total = F.aggregate("weights", F.lit(0.0), lambda a, w: a + w)
    own, rest = (F.coalesce(c, F.lit(0.0)) for c in ("single", "low"))
    whole = rows.select("node", "key", total.alias("total")).join(single, "key", "left").join(low, "key", "left")
    lists = shared.groupBy("token").agg(F.sort_array(F.collect_list("key")).alias("keys")).select("keys").distinct()
    return whole.select("node", "key", own.alias("single"), (F.col("total") - own).alias("able"), (own + rest).alias("low")), lists


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` of every node that has a link; equal roots are one component.

    Every node takes the smallest root among its neighbours' and then its root's root, until
    nothing changes; the number of rounds follows the logarithm of the longest chain.
    """
    both = saved(links.select("a", "b").union(links.select("b", "a")).distinct())
    roots = saved(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("root")))
    while True:
        near = both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        stepped = roots.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jumped = stepped.join(roots.select(F.col("node").alias("root"), F.col("root").alias("up")), "root", "left")
        fresh = saved(jumped.select("node", "old", F.least("root", F.coalesce("up", "root")).alias("root")))
        if not fresh.where("root != old").limit(1).count():
            return fresh.select("node", "root")
        roots = fresh.select("node", "root")


def _contested(placed: DataFrame, roots: DataFrame) -> DataFrame:
    """Places in buckets that hold several components: with ``root``, and ``main``, the bucket's largest."""
    rooted = saved(placed.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    sizes = rooted.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("band").agg(F.max(F.struct("n", "root")).alias("x"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    return saved(rooted.join(saved(main.select("band", F.col("x.root").alias("main"))), "band"))


def _agreement(x: str, y: str):
    """Four-bit samples that two packed halves share, of 15."""
    apart = F.col(x).bitwiseXOR(F.col(y))
    apart = apart.bitwiseOR(F.shiftrightunsigned(apart, 1))
    apart = apart.bitwiseOR(F.shiftrightunsigned(apart, 2))
    return 15 - F.bit_count(apart.bitwiseAND(F.lit(0x0111111111111111)))


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id``, ``node`` (digest of the text), ``class_id`` and ``class_node`` of every document.

    Documents are one class if a chain of links joins their texts: equal texts, or a weighted
    Jaccard similarity of at least ``similarity`` over TF-IDF weighted five-word shingles.
    ``class_id`` is the smallest id of the class, ``class_node`` the text of that document.

    Every text is sampled by consistent weighted sampling, and the samples are banded.  In each band
    bucket all texts are first compared with one of them, never with each other, and those that are
    left with the one in its middle.  What then still lies in another component than most of its
    bucket meets the rest of it in two ways: texts that share a shingle of at most ``FEW`` of them
    meet by it, and others only if samples and the weights of their rare and common shingles leave
    it possible.  Every pair that is not ruled out is verified on the whole texts.

    Null texts are empty; blank texts have no shingles and are linked only by equality.  A null id
    is larger than every other and stays null.  Repeated rows are one text.  No rows give no rows;
    other columns are not looked at.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n_docs = docs.count()
    counted = spark.sparkContext.broadcast(frequencies(docs))
    rows = saved(docs.mapInArrow(_signature_task(counted, n_docs), "doc_id long, node binary, bands array<long>, sketch binary, n0 long, n1 long"))
    firsts = {c: F.first(c).alias(c) for c in ("bands", "sketch", "n0", "n1")}
    nodes = saved(rows.groupBy("node").agg(F.min("doc_id").alias("least_id"), *firsts.values()))
    placed = nodes.select("node", "least_id", "n0", "n1", F.explode("bands").alias("band"))
    hubs = saved(
        placed.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("least_id", "node")).alias("hub")).where("n > 1").select("band", F.col("hub.node").alias("b"))
    )
    pairs = placed.select(F.col("node").alias("a"), "band").join(hubs, "band").where("a != b").select("a", "b").distinct()
    links = _links(docs, pairs, nodes, counted, n_docs, similarity)
    roots = components(links)

    shared = placed.join(hubs.select("band"), "band").select("node", "band", "n0", "n1")
    contested = _contested(shared, roots)
    strength, lists = _strength(docs, contested.select("node").distinct(), counted, n_docs)
    # Texts with too much of their own are alike to no other.
    fit = saved(strength.where(F.col("able") >= similarity * (F.col("able") + F.col("single")) - 1e-3))
    contested = saved(contested.join(fit, "node"))
    # The text with the least of its own stands in the middle of a bucket: most others are linked to it.
    middle = contested.groupBy("band").agg(F.min(F.struct((F.col("low") / (F.col("able") + F.col("single"))).alias("share"), "node", "root")).alias("x"))
    middle = saved(middle.select("band", F.col("x.node").alias("b"), F.col("x.root").alias("b_root")))
    spokes = contested.join(middle, "band").where("root != b_root").select(F.col("node").alias("a"), "b").distinct()
    links = links.unionByName(_links(docs, spokes, nodes, counted, n_docs, similarity))
    roots = components(links)
    contested = _contested(contested.drop("root", "main"), roots)
    known = ("node", "root", "n0", "n1", "able", "single", "low")
    outside = contested.where("root != main").select("band", *[F.col(c).alias(f"a_{c}") for c in known])
    agree = _agreement("n0", "a_n0") + _agreement("n1", "a_n1") >= AGREE
    # Two texts that share no rare shingle share at most what the one with fewer common ones has of them,
    # and all of one's common ones and both texts' rare ones lie in their union.
    mine, other = F.col("able") + F.col("single") - F.col("low"), F.col("a_able") + F.col("a_single") - F.col("a_low")
    possible = F.least(mine, other) >= similarity * (F.greatest(mine, other) + F.col("low") + F.col("a_low")) - 1e-3
    rest = contested.join(outside, "band").where((F.col("root") != F.col("a_root")) & possible & agree).select("a_node", "node")
    # Texts that share a rare one meet by it; what only one of them has lies in their union too.
    lists = lists.select(F.posexplode("keys").alias("at", "a_key"), "keys").select("a_key", F.explode(F.slice("keys", F.col("at") + 2, FEW)).alias("key"))
    least = F.least("able", "a_able") >= similarity * (F.greatest("able", "a_able") + F.col("single") + F.col("a_single")) - 1e-3
    still = saved(contested.select("key", *known).distinct())
    met = lists.distinct().join(still, "key").join(still.select(*[F.col(c).alias(f"a_{c}") for c in ("key", *known)]), "a_key")
    rest = rest.unionByName(met.where((F.col("root") != F.col("a_root")) & least & agree).select("a_node", "node"))
    again = rest.select(F.least("a_node", "node").alias("a"), F.greatest("a_node", "node").alias("b")).distinct()
    more = _links(docs, again, nodes, counted, n_docs, similarity)
    if more.limit(1).count():
        roots = components(links.unionByName(more))

    rooted = nodes.join(roots, "node", "left").select("node", "least_id", F.coalesce("root", "node").alias("root"))
    best = rooted.groupBy("root").agg(F.min(F.struct("least_id", "node")).alias("x"))
    named = rooted.join(best, "root").select("node", F.col("x.least_id").alias("class_id"), F.col("x.node").alias("class_node"))
    return rows.select("doc_id", "node").join(saved(named), "node").select(
        F.nullif("doc_id", F.lit(int(LAST))).alias("doc_id"), "node", F.nullif("class_id", F.lit(int(LAST))).alias("class_id"), "class_node"
    )


def keep_first(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class of near copies, the one with the smallest id; columns stay as they are.

    Copies are told apart by text and id together, so that those of one text spread over the tasks;
    repeated rows of that text and id are one.
    """
    found = classes(docs, similarity).where("node = class_node")
    kept = saved(found.select(F.col("class_node").alias("key"), F.coalesce("class_id", F.lit(int(LAST))).alias("id")).distinct())
    digest = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    keyed = docs.select(F.struct("*").alias("row"), digest.alias("key"), F.coalesce(F.col("doc_id").cast("long"), F.lit(int(LAST))).alias("id"))
    first = keyed.join(kept, ["key", "id"], "left_semi").groupBy("key", "id").agg(F.first("row").alias("row"))
    return first.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
