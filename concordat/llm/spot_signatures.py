"""Document fingerprints: chains of content words that follow common-word anchors.

Everything here is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Common words of four languages that anchor a chain.
ANCHORS = (
    "the", "of", "and", "to", "in", "is", "was", "that",
    "der", "die", "das", "und", "ist", "den", "nicht", "mit",
    "le", "la", "les", "et", "est", "des", "un", "une",
    "el", "los", "las", "y", "es", "del", "para", "una",
)
#: Content words in a chain.
CHAIN = 3
#: Documents that one part of the id order holds about, and parts at most.
PART_ROWS, PARTS = 64, 4096


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _numbered(found: Column) -> Column:
    """Signatures with their repeats told apart, so that sets compare as multisets do.

    In the sorted array every run of equal values starts where the value before differs; the first
    of a run stays as it is, the next ones are hashed with their number in the run.
    """

    def runs(values: Column) -> Column:
        differs = lambda i: (i == 0) | (F.get(values, i) != F.get(values, i - 1))
        starts = F.filter(F.transform(values, lambda v, i: F.when(differs(i), i)), lambda i: i.isNotNull())

        def one(at: Column, k: Column, all_starts: Column) -> Column:
            length = F.coalesce(F.get(all_starts, k + 1), F.size(values)) - at
            return F.transform(
                F.sequence(F.lit(0), length - 1), lambda o: F.when(o == 0, F.get(values, at)).otherwise(F.hash(F.get(values, at), o))
            )

        return _let(starts, lambda ss: F.flatten(F.transform(ss, lambda at, k: one(at, k, ss))))

    return F.sort_array(F.array_distinct(_let(F.sort_array(found), runs)))


def _run_chains(cs: Column, lo: Column, hi: Column) -> Column:
    """Chains of the content words that are anchors in the run from ``lo`` to before ``hi``; a short run has none."""

    def chains(hs: Column) -> Column:
        def one(h: Column, i: Column) -> Column:
            below = lambda *steps: h <= F.least(*[F.get(hs, i + k) for k in steps])
            whole = (i >= 2) & below(-1, -2) | (i >= 1) & (i + 1 < F.size(hs)) & below(-1, 1) | (i + 2 < F.size(hs)) & below(1, 2)
            return F.when(whole, F.hash(F.get(cs, lo + i), F.slice(cs, lo + i + 2, F.lit(CHAIN))))

        return F.filter(F.transform(hs, one), lambda x: x.isNotNull())

    words = F.slice(cs, lo + 1, hi - lo)
    return F.when(hi - lo > CHAIN, _let(F.transform(words, lambda w: F.hash(w)), chains)).otherwise(F.array().cast("array<int>"))


def signatures(text: Column) -> Column:
    """Sorted distinct 32-bit signatures of a text; null and blank texts have none.

    A chain that occurs again counts again, as a signature of its own.

    Words are runs of letters and digits in lower case, and each is an anchor or a content word.
    The chain of an anchor is the next ``CHAIN`` content words, as many as there are; the start of
    the text counts as an anchor.  In a run of more than ``CHAIN`` content words between two anchors,
    a word whose hash is the least of any ``CHAIN`` neighbours in the run is an anchor too, so that
    every content word lies in a chain, in whatever language.  A text without words that is not blank is its own signature.
    """
    plain = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(F.lower(plain), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def chains(ws: Column) -> Column:
        content = F.filter(ws, lambda w: ~w.isin(*ANCHORS))
        anchors = F.filter(F.transform(ws, lambda w, i: F.when(w.isin(*ANCHORS), i)), lambda i: i.isNotNull())

        def hashed(cs: Column) -> Column:
            # The a-th word is the j-th anchor, so a - j content words stand before it.
            found = F.transform(anchors, lambda a, j: F.hash(F.get(ws, a), F.slice(cs, a - j + 1, F.lit(CHAIN))))
            start = F.array(F.hash(F.lit(""), F.slice(cs, F.lit(1), F.lit(CHAIN))))
            los = F.concat(F.array(F.lit(0)), F.transform(anchors, lambda a, j: a - j))
            runs = _let(los, lambda ls: F.flatten(F.transform(ls, lambda lo, k: _run_chains(cs, lo, F.coalesce(F.get(ls, k + 1), F.size(cs))))))
            return F.when(F.size(cs) == 0, found).otherwise(F.concat(found, start, runs))

        return _let(content, hashed)

    found = _numbered(_let(words, chains))
    alone = F.when(F.length(F.trim(plain)) > 0, F.array(F.hash(plain))).otherwise(F.array().cast("array<int>"))
    return F.when(F.size(found) > 0, found).otherwise(alone)


def as_text(found: Column) -> Column:
    """Fingerprint string: eight hexadecimal digits for each signature."""
    return F.array_join(F.transform(found, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature sets; two empty sets are alike."""
    shared = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - shared
    return F.when(every == 0, F.lit(1.0)).otherwise(shared / every)


def _parts(docs: DataFrame) -> Column:
    """Number of the part of the id order that a document lies in, by quantiles of the ids.

    The driver gets at most ``PARTS`` ids.  Parts are found in two steps of few comparisons.
    """
    n = docs.count()
    wanted = min(PARTS, max(1, n // PART_ROWS))
    row = docs.agg(F.percentile_approx("doc_id", [i / wanted for i in range(1, wanted)] or [0.5], 4 * PARTS)).first()
    bounds = sorted(set(row[0] or []))
    step = max(1, int(len(bounds) ** 0.5))
    rows = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    below = lambda values: F.size(F.filter(values, lambda x: x <= F.col("doc_id")))
    coarse = F.array(*[F.lit(r[0]).cast("long") for r in rows]).cast("array<bigint>")
    fine = F.array(*[F.array(*[F.lit(x).cast("long") for x in r]) for r in rows]).cast("array<array<bigint>>")
    at = below(coarse)
    inside = F.coalesce(below(F.get(fine, at - 1)), F.lit(0))
    part = at * (step + 1) + inside
    # Documents without an id come last, in order of their text's hash.
    return F.when(F.col("doc_id").isNull(), -1 - F.pmod(F.xxhash64("text"), F.lit(PARTS)).cast("int")).otherwise(part)


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and ``found`` (signatures) of each document and of the next one.

    The next document is the one of the next smaller id, of equal ids the next smaller text; after
    the last comes the first.  A table of one row is its own next.  Null ids come last.

    Parts of the id order are sorted side by side.  Only the last row of a part has its next one in
    another part; for it the head of the next part is added to the part as a ghost row.  There are
    at most ``PARTS`` heads for ids (as many again for null ids), and texts are shuffled once.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    own = own.withColumn("part", _parts(own))
    key = F.struct(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), F.xxhash64("text").alias("tie"))
    heads = own.groupBy("part").agg(F.max(key).alias("head"))
    ahead = Window.partitionBy(F.lit(0)).orderBy(F.col("part").desc())
    heads = heads.select("part", F.lead("head").over(ahead).alias("next"), F.first("head").over(ahead).alias("top"))
    wanted = heads.select(F.col("part").alias("to_part"), F.coalesce("next", "top").alias("head"))
    of_head = own.select(key.alias("head"), "text").join(F.broadcast(wanted), "head")
    ghosts = of_head.groupBy("to_part").agg(F.max("text").alias("text"))
    found = signatures(F.col("text")).alias("found")
    rows = own.select("part", "doc_id", "text", found, F.lit(0).alias("ghost")).unionByName(
        ghosts.select(F.col("to_part").alias("part"), F.lit(None).cast("long").alias("doc_id"), "text", found, F.lit(1).alias("ghost"))
    )
    down = Window.partitionBy("part").orderBy("ghost", F.col("doc_id").desc_nulls_last(), F.xxhash64("text").desc())
    return rows.select(
        "doc_id", "text", "found", "ghost", F.lead("text").over(down).alias("next_text"), F.lead("found").over(down).alias("next_found")
    ).where("ghost = 0").drop("ghost")


def fingerprint(docs: DataFrame) -> DataFrame:
    """Fingerprint every document and its edited text.

    The edited text has the last third of the code points (rounded down) replaced by the first as
    many of the next document, or all of it.  Returns ``doc_id``, ``n_chars``, ``edited``,
    ``found``, ``edited_found``, ``next_found`` (signature sets), ``near_edited`` and ``near_next``.

    Null texts count as empty; repeated rows are documents of their own; no rows give no rows.
    Other columns are not looked at.
    """
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - third), F.substr("next_text", F.lit(1), third))
    df = with_next(docs).withColumn("edited", edited).withColumn("edited_found", signatures(F.col("edited")))
    return df.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        "edited",
        "found",
        "edited_found",
        "next_found",
        likeness(F.col("found"), F.col("edited_found")).alias("near_edited"),
        likeness(F.col("found"), F.col("next_found")).alias("near_next"),
    )


def matches(fingerprints: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs of different signature sets whose Jaccard similarity is at least ``threshold``.

    ``fingerprints`` has a column ``found``; equal sets are one.  Sets are partitioned by length so
    that a match lies in the same partition or the next one; a set looks for shorter ones in its own
    partition and the one below.  A pair is found at a shared signature of both prefixes, rarest
    first, and pruned by length before the whole sets are compared.  Returns ``a``, ``b``,
    ``likeness`` with ``a`` the shorter set, ties by value.  Empty sets match nothing.
    """
    sets = fingerprints.select("found").where(F.size("found") > 0).distinct()
    counts = sets.select(F.explode("found").alias("sig")).groupBy("sig").count()
    ranked = (
        sets.select("found", F.explode("found").alias("sig"))
        .join(counts, "sig")
        .groupBy("found")
        .agg(F.sort_array(F.collect_list(F.struct("count", "sig"))).alias("ranked"))
    )
    size = F.size("found")
    prefix = size - F.ceil(size * threshold - 1e-9).cast("int") + 1
    base = -F.log(F.lit(threshold))
    listed = ranked.select(
        "found",
        size.alias("size"),
        F.floor(F.log(size.cast("double")) / base + 1e-9).cast("int").alias("part"),
        F.explode(F.slice("ranked", F.lit(1), prefix)).alias("x"),
    ).select("found", "size", "part", F.col("x.sig").alias("sig"))
    short = listed.select("sig", "part", F.col("found").alias("a"), F.col("size").alias("na"))
    long = listed.select("sig", F.explode(F.array(F.col("part"), F.col("part") - 1)).alias("part"), F.col("found").alias("b"), F.col("size").alias("nb"))
    near = (F.col("na") >= F.col("nb") * threshold - 1e-9) & (
        (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.array_join("a", ",") < F.array_join("b", ",")))
    )
    pairs = short.join(long, ["sig", "part"]).where(near).select("a", "b").distinct()
    return pairs.withColumn("likeness", likeness(F.col("a"), F.col("b"))).where(F.col("likeness") >= threshold - 1e-9)
