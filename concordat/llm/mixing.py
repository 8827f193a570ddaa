"""Mixing sources to target weights: whole copies for certain, the rest by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordat.llm.shared import WORD, ranked
from concordat.session import materialize

#: Rows of a source among which one task looks for the end of the sample.
NEAR_END = 20_000
#: Bits of a sampling key, bits of it that tell equal rows apart, and bits that a round looks at.
KEY_BITS, TIE_BITS, ROUND_BITS = 63, 15, 12
#: Parts into which the rows of a source are dealt where they meet its settings.
SALTS = 32


def _settle(rows: DataFrame, settings: DataFrame) -> DataFrame:
    """Join each row with the settings of its source; a hot source is dealt over ``SALTS`` parts."""
    salted = settings.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.col("row_no"), F.lit(SALTS)).cast("int")).join(salted, ["source_key", "salt"]).drop("salt")


def targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """Add ``target`` to ``source_size`` and ``weight``: shares by weight of ``share`` times all sizes.

    No target exceeds ``most`` times its source's size; the excess is shared out again by weight until
    none is above.  Each round caps further sources and sums up the rest, two numbers for the driver.
    """
    total, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    goal = share * (total or 0)
    level = goal / weights if weights else 0.0
    top = F.col("source_size") * F.lit(float(most))
    while weights:
        above = top <= F.lit(level) * F.col("weight")
        capped, rest = sources.agg(F.sum(F.when(above, top)), F.sum(F.when(~above, F.col("weight")))).first()
        if not rest or (goal - (capped or 0.0)) / rest == level:
            break
        level = (goal - (capped or 0.0)) / rest
    return sources.withColumn("target", F.least(top, F.lit(level) * F.col("weight")).cast("double"))


def _key() -> Column:
    """Place of a document in Pareto order: random odds divided by inclusion odds, as a number of 48 bits.

    The sample ends near a quotient of 1, which is the middle of the numbers.  Fifteen more bits put
    equal rows into some order.
    """
    chance = (F.shiftrightunsigned("mark", 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    odds = chance / (1 - chance) * (1 - F.col("part")) / F.col("part")
    place = F.least(F.floor(odds / (1 + odds) * F.lit(float(1 << 48))), F.lit((1 << 48) - 1))
    tie = F.xxhash64("row_no").bitwiseAND((1 << TIE_BITS) - 1)
    return F.when(F.col("part") > 0, place * F.lit(1 << TIE_BITS) + tie)


def _ends(planned: DataFrame) -> DataFrame:
    """Per source, the stretch of keys (its leading ``bits`` are ``prefix``) in which the sample ends.

    ``rest`` words are to be taken inside the stretch; all documents with smaller keys are in.  Rounds
    look at twelve more bits of the key, as histograms, while a stretch holds more than ``NEAR_END`` rows.
    """
    ends = planned.groupBy("source_key").agg(
        (F.max("target") - F.sum(F.col("whole") * F.col("size"))).alias("rest"), F.count("key").alias("rows")
    )
    ends = materialize(ends.select("source_key", F.lit(0).alias("bits"), F.lit(0).cast("long").alias("prefix"), "rest", "rows"))
    for bits in range(ROUND_BITS, KEY_BITS, ROUND_BITS):
        wide = F.col("rows") > NEAR_END
        if (ends.agg(F.max("rows")).first()[0] or 0) <= NEAR_END:
            break
        inside = _settle(planned.where("key IS NOT NULL"), ends.where(wide)).where(f"shiftright(key, {KEY_BITS} - bits) = prefix")
        cells = inside.groupBy("source_key", F.expr(f"shiftright(key, {KEY_BITS - bits})").alias("cell"), "rest").agg(
            F.sum("size").alias("words"), F.count("*").alias("rows")
        )
        upto = Window.partitionBy("source_key").orderBy("cell")
        cells = cells.withColumn("upto", F.sum("words").over(upto))
        # The first cell that reaches the rest, or the last of all.
        reach = F.struct((F.col("upto") < F.col("rest")).alias("short"), F.when(F.col("upto") < F.col("rest"), -F.col("cell")).otherwise(F.col("cell")).alias("cell"))
        found = cells.groupBy("source_key").agg(F.min_by(F.struct("cell", "rows", (F.col("rest") - F.col("upto") + F.col("words")).alias("rest")), reach).alias("x"))
        new = found.select("source_key", F.lit(bits).alias("bits"), F.col("x.cell").alias("prefix"), F.col("x.rest").alias("rest"), F.col("x.rows").alias("rows"))
        ends = materialize(ends.where(~wide).unionByName(new))
    return ends.drop("rows")


def fill(sizes: np.ndarray, rest: float, changes: int = 8) -> np.ndarray:
    """Which of the documents, in order, to take so that their sizes come near ``rest``.

    Documents are taken in order while they fit; one that does not fit is passed over.  At the end up to
    ``changes`` single documents are taken or left, each time the one that brings the sum nearest.
    """
    upto = np.cumsum(sizes)
    taken = upto <= rest
    gap = rest - (upto[taken][-1] if taken.any() else 0)
    for i in np.flatnonzero(~taken & (sizes <= gap)):
        if sizes[i] <= gap:
            taken[i] = True
            gap -= sizes[i]
    for _ in range(changes if len(sizes) else 0):
        after = np.abs(gap - np.where(taken, -sizes, sizes))
        best = int(np.argmin(after))
        if after[best] >= abs(gap):
            break
        gap += sizes[best] if taken[best] else -sizes[best]
        taken[best] = not taken[best]
    return taken


def _last_stretch(rows: DataFrame) -> DataFrame:
    """Decide on the rows of the stretches in which the samples end."""

    def run(table: pa.Table) -> pa.Table:
        order = np.lexsort([table.column(c).to_numpy() for c in ("mark", "key")])
        sizes = table.column("size").to_numpy()[order]
        more = np.zeros(len(order), np.int64)
        more[order] = fill(sizes, table.column("rest")[0].as_py())
        return table.append_column("more", pa.array(more))

    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes) + ", more long"
    return rows.groupBy("source_key").applyInArrow(run, schema)


def plan(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2, appeal: Column | None = None) -> DataFrame:
    """How many copies of each document a mix takes; one row per row of ``docs``.

    Returns ``doc_id, source, mark, size, source_size, target, copies``.  ``size`` is the number of words.
    Sources in code point order, null last, weigh ``weights``, repeating, and share ``share`` times all words
    (:func:`targets`).  A document expects ``target / source_size`` copies, times its ``appeal`` over the
    source's mean appeal if one is given (a positive number for each row), and ``most`` at most.  The whole
    part is certain.  The other part is its inclusion probability for one more copy: documents are ranked by
    random odds divided by inclusion odds, and the first are taken until the words of the source come to its
    target.  Random numbers are hashes of id, source and text, so reruns agree.

    Everything up to the end of the sample is a sum by source; where a source's sample ends is found in
    histograms of twelve bits of the rank, and only ``NEAR_END`` rows about it are ordered, in one task.

    Null texts have no words and are taken for nothing.  Null ids and sources are kept.  Repeated rows are
    rows of their own, with equal ranks that a row number parts.  No rows give no rows.  Other columns are not
    looked at.
    """
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    weight = F.lit(1.0) if appeal is None else appeal.cast("double")
    base = docs.select(F.col("doc_id"), F.col("source"), F.xxhash64("doc_id", "source", "text").alias("mark"), words.alias("size"), weight.alias("appeal"))
    source_key = F.coalesce(F.concat(F.lit("0"), F.col("source").cast("string")), F.lit("1"))
    base = materialize(base.withColumns({"source_key": source_key, "row_no": F.monotonically_increasing_id()}))
    sums = base.groupBy("source_key").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("appeal")).alias("appeals"))
    sources = ranked(sums, "source_key", F.col("source_key").asc())
    cycle = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = targets(materialize(sources.select("source_key", "source_size", "appeals", cycle.cast("double").alias("weight"))), share, most)
    expected = F.when(F.col("appeals") > 0, F.least(F.lit(float(most)), F.col("target") * F.col("appeal") / F.col("appeals"))).otherwise(0.0)
    planned = _settle(base.drop("source"), sources.drop("weight")).withColumn("expected", expected)
    planned = planned.withColumns({"whole": F.floor("expected"), "part": F.col("expected") - F.floor("expected")}).withColumn("key", _key())
    named = F.when(F.col("source_key") != "1", F.expr("substr(source_key, 2)")).alias("source")
    planned = materialize(planned.select("doc_id", "source_key", "mark", "row_no", "size", "source_size", "target", "whole", "key"))
    decided = _settle(planned, _ends(planned))
    ahead = F.expr(f"shiftright(key, {KEY_BITS} - bits)")
    # No key: the source's share is a whole number of copies.
    clear = decided.where(F.col("key").isNull() | (ahead != F.col("prefix"))).withColumn("more", F.coalesce((ahead < F.col("prefix")).cast("long"), F.lit(0)))
    taken = clear.unionByName(_last_stretch(decided.where(ahead == F.col("prefix"))))
    return taken.select("doc_id", named, "mark", "size", "source_size", "target", (F.col("whole") + F.col("more")).alias("copies"))


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as :func:`plan` says.

    Rows of equal id, source and text stand in for each other.
    """
    counts = plan(docs, **settings).groupBy("mark").agg(F.sum("copies").cast("int").alias("copies")).where("copies > 0")
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64("doc_id", "source", "text").alias("mark")).dropDuplicates(["mark"])
    return rows.join(counts, "mark").select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
