"""A Merkle manifest of a dataset: leaf positions by bitmap ranks, levels by keyed slot arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordat.llm.shared import ranked
from concordat.session import materialize

#: Children of a node, and levels that one group of a round reduces.
FANOUT, LEVELS = 16, 3
SPAN_BITS = 4 * LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PROOF = "array<struct<before: string, after: string>>"
_STEP = pa.struct([("before", pa.string()), ("after", pa.string())])
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """The text with A-Z in lower case and all else as it is."""
    return F.translate(text, _UPPER, _LOWER)


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row: each field is ``-`` if null, else its UTF-8 byte count, ``:`` and its text."""
    texts = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda digest, s: F.sha2(F.concat(s["before"], digest, s["after"]), 256))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def _directory(words: DataFrame) -> DataFrame:
    """Bitmap words with the number of leaves of their group that stand before them.

    Popcounts are summed up in blocks of 2**16, 2**32 and 2**48 ids; each window orders at most
    65 536 blocks inside the next larger one, however many leaves a group has.
    """

    def before(keys: list[str], order: str) -> Column:
        return F.coalesce(F.sum("leaves").over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    blocks = [("word", 6), ("b16", 16), ("b32", 32), ("b48", 48)]
    for name, bits in blocks[1:]:
        words = words.withColumn(name, F.shiftright("word", bits - 6))
    words = words.withColumn("rank", before(["group", "kind", "b16"], "word"))
    for (name, _), (wider, _) in zip(blocks[1:], [*blocks[2:], ("kind", 0)], strict=True):
        keys = ["group", "kind", *([wider] if wider != "kind" else [])]
        sums = words.groupBy("group", "kind", name, *keys[2:]).agg(F.sum("leaves").alias("leaves"))
        sums = sums.select("group", "kind", name, before(keys, name).alias("add"))
        words = words.join(sums, ["group", "kind", name]).withColumn("rank", F.col("rank") + F.col("add")).drop("add")
    kinds = words.groupBy("group").agg(F.sum("leaves").alias("n"), F.coalesce(F.sum(F.when(F.col("kind") == 0, F.col("leaves"))), F.lit(0)).alias("unnamed"))
    words = words.join(kinds, "group")
    return words.select("group", "kind", "word", "bits", "extra", "n", (F.col("rank") + F.when(F.col("kind") == 1, F.col("unnamed")).otherwise(0)).alias("rank"))


def positions(leaves: DataFrame) -> DataFrame:
    """Position ``pos`` of every leaf among the ``n`` leaves of its group, by id, without sorting leaves.

    ``leaves`` has ``group``, ``doc_id``, ``digest`` and ``shown``.  Per group the ids make a bitmap,
    kept as its words of 64 ids that are not empty; tasks merge their words by a bitwise or.  A leaf's
    position is the directory's count before its word plus the set bits below its own.  Null ids
    come first, by digest.  Rows of one id follow each other by digest.
    """
    null_at = F.conv(F.substring("digest", 1, 15), 16, 10).cast("long")
    # Equal rows are one row with a count until the end.
    rows = leaves.groupBy("group", "doc_id", "digest", "shown").agg(F.count("*").alias("copies"))
    rows = rows.withColumns({"kind": F.col("doc_id").isNotNull().cast("int"), "at": F.coalesce("doc_id", null_at)})
    rows = materialize(rows.withColumns({"word": F.shiftright("at", 6), "bit": F.col("at").bitwiseAND(63).cast("int")}))
    ids = rows.groupBy("group", "kind", "word", "bit").agg(F.sum("copies").alias("leaves"))
    words = ids.groupBy("group", "kind", "word").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"),
        F.sum("leaves").alias("leaves"),
        F.collect_list(F.when(F.col("leaves") > 1, F.struct("bit", (F.col("leaves") - 1).alias("more")))).alias("extra"),
    )
    rows = rows.join(_directory(words), ["group", "kind", "word"])
    below = F.bit_count(F.col("bits").bitwiseAND(F.expr("~shiftleft(-1L, bit)"))).cast("long")
    more = F.aggregate("extra", F.lit(0).cast("long"), lambda s, x: s + F.when(x["bit"] < F.col("bit"), x["more"]).otherwise(0))
    rows = rows.withColumn("first", F.col("rank") + below + more)
    repeated = F.exists("extra", lambda x: x["bit"] == F.col("bit"))
    same = Window.partitionBy("group", "kind", "word", "bit").orderBy("digest", "shown").rowsBetween(Window.unboundedPreceding, -1)
    among = rows.where(repeated).withColumn("first", F.col("first") + F.coalesce(F.sum("copies").over(same), F.lit(0)))
    placed = rows.where(~repeated).unionByName(among)
    return placed.select("group", "n", F.explode(F.sequence("first", F.col("first") + F.col("copies") - 1)).alias("pos"), "digest", "doc_id", "shown")


def _levels(n: int) -> int:
    """Levels that a group of a round reduces if its tree has ``n`` nodes."""
    levels = 0
    while n > 1 and levels < LEVELS:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def _reduce(table: pa.Table) -> tuple[list[list[str]], int]:
    """All levels over the slot array of one group, and the number of nodes in the whole tree."""
    slots: list = [None] * table.num_rows
    for pos, digest in zip(table.column("pos").to_pylist(), table.column("digest").to_pylist(), strict=True):
        slots[pos & ((1 << SPAN_BITS) - 1)] = digest
    n, rows = table.column("n")[0].as_py(), [slots]
    for _ in range(_levels(n)):
        low = rows[-1]
        rows.append([hashlib.sha256("".join(low[i : i + FANOUT]).encode()).hexdigest() for i in range(0, len(low), FANOUT)])
    return rows, n


def _climb(nodes: DataFrame) -> DataFrame:
    """The nodes some levels up."""

    def run(table: pa.Table) -> pa.Table:
        rows, n = _reduce(table)
        group, pos = table.column("group")[0].as_py(), table.column("pos")[0].as_py()
        up = -(-n // FANOUT ** _levels(n))
        return pa.table({"group": [group], "n": pa.array([up], pa.int64()), "pos": pa.array([pos >> SPAN_BITS], pa.int64()), "digest": rows[-1]})

    chunks = nodes.select("group", "n", "pos", "digest", F.shiftright("pos", SPAN_BITS).alias("chunk"))
    return chunks.groupBy("group", "chunk").applyInArrow(run, "group string, n long, pos long, digest string")


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """Tables of nodes, the last with one node for each group."""
    rounds = [nodes]
    while (nodes.agg(F.max("n")).first()[0] or 1) > 1:
        nodes = materialize(_climb(nodes))
        rounds.append(nodes)
    return rounds


def _expand(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """Nodes with their proofs, from the proofs (and subroots) of the nodes some levels above."""
    kept = [f for f in nodes.schema.fields if f.name != "n"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", subroot string, proof {_PROOF}"

    def run(low: pa.Table, high: pa.Table) -> pa.Table:
        rows, _ = _reduce(low)
        top = [(s["before"], s["after"]) for s in high.column("proof")[0].as_py()]

        def step(level: int, i: int) -> tuple[str, str]:
            run, first = rows[level], i - i % FANOUT
            return "".join(run[first:i]), "".join(run[i + 1 : first + FANOUT])

        # Steps above a node are shared by all leaves below it.
        shared = [top]
        for level in range(len(rows) - 2, 0, -1):
            shared = [[step(level, i), *shared[i // FANOUT]] for i in range(len(rows[level]))]
        proofs = []
        for pos in low.column("pos").to_pylist():
            i = pos & ((1 << SPAN_BITS) - 1)
            proofs.append([step(0, i), *shared[i // FANOUT]] if len(rows) > 1 else top)
        ends = [0]
        for p in proofs:
            ends.append(ends[-1] + len(p))
        flat = pa.StructArray.from_arrays([pa.array([s[k] for p in proofs for s in p], pa.string()) for k in (0, 1)], fields=list(_STEP))
        columns = [low.column(f.name) for f in kept]
        columns += [pa.array([high.column("subroot")[0].as_py()] * low.num_rows, pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)]
        return pa.table(columns, names=[f.name for f in kept] + ["subroot", "proof"])

    low = nodes.withColumn("chunk", F.shiftright("pos", SPAN_BITS)).groupBy("group", "chunk")
    high = above.select("group", F.col("pos").alias("chunk"), "subroot", "proof").groupBy("group", "chunk")
    return low.cogroup(high).applyInArrow(run, schema)


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, shown: Column | None = None) -> DataFrame:
    """Merkle manifest of ``docs``, grouped by ``source`` and ordered by ``doc_id``; one row per row.

    Returns ``doc_id, leaf, shown, subroot, root, proof``.  A leaf digests ``fields``.  While several
    nodes remain, every 16 consecutive ones become their digest; the subroots of the sources, null
    first and then by UTF-8 bytes, give the root in the same way.  ``proof`` holds, from the leaf to
    the root, the siblings left and right of the path.  ``shown`` is a digest to carry along beside
    the leaf, by default the leaf.

    Positions come from bitmap ranks (:func:`positions`); then groups of 4096 places reduce three levels
    at once in a slot array, so a hot source spreads over tasks and a task holds 4096 digests and their
    proofs.  The number of rounds is the logarithm of the largest source to the base 4096.

    Null ids come first in their source, by leaf.  Null sources are one source; null fields count as
    ``-``.  Repeated rows are leaves of their own, next to each other; rows of one id with unlike
    fields are ordered by leaf, in one task for each such id.  No rows give no rows.  Other columns
    are not looked at.
    """
    group = F.coalesce(F.concat(F.lit("1"), F.col("source").cast("string")), F.lit("0"))
    leaf = leaf_digest([F.col(c) for c in fields])
    leaves = docs.select(group.alias("group"), F.col("doc_id").cast("long").alias("doc_id"), leaf.alias("digest"), (leaf if shown is None else shown).alias("shown"))
    places = _rounds(materialize(positions(leaves)))
    named = ranked(places[-1].select("group", "digest"), "group", F.col("group").asc())
    tops = named.select(F.lit("").alias("group"), F.col("of").alias("n"), F.col("rank").alias("pos"), "digest", F.col("group").alias("name"))
    tops = _rounds(materialize(tops))
    last = tops[-1].select("digest").take(1)
    root = last[0]["digest"] if last else ""
    above = tops[-1].select("group", "pos", F.lit("").alias("subroot"), F.array().cast(_PROOF).alias("proof"))
    if len(tops) == 1:  # one source: its subroot is the root
        above = tops[0].select(F.col("name").alias("group"), F.lit(0).cast("long").alias("pos"), F.col("digest").alias("subroot"), F.array().cast(_PROOF).alias("proof"))
    else:
        for nodes in reversed(tops[:-1]):
            above = _expand(nodes, above)
        above = above.select(F.col("name").alias("group"), F.lit(0).cast("long").alias("pos"), F.col("digest").alias("subroot"), "proof")
    if len(places) == 1:  # every source has one leaf
        found = places[0].join(above.drop("pos"), "group")
    else:
        for nodes in reversed(places[:-1]):
            above = _expand(nodes, above)
        found = above
    return found.select("doc_id", F.col("digest").alias("leaf"), "shown", "subroot", F.lit(root).alias("root"), "proof")
