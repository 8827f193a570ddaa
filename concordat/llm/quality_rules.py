"""Quality rules: weak supervision over rules that vote or abstain.

Everything here is DataFrame expressions, the estimation of the rules' accuracies included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.llm.shared import saved, words_of

BLANK = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
GOOD, BAD, ABSTAIN = 1, 0, 2
#: Rules: condition for good, condition for bad; neither abstains.  Nearly every text passes most of them, the bad
#: ones too, so passing tells nothing and those rules vote against a text or abstain.
RULES: dict[str, tuple[str, str]] = {
    "symbols": ("n_symbols * 50 <= n_words", "n_symbols * 10 > n_words"),
    "repeats": ("false", "n_repeat_words * 10 > n_words"),
    "duplicate_lines": ("false", "n_dup_lines * 10 > n_lines * 3"),
    "word_length": ("false", "word_chars < n_words * 2 or word_chars > n_words * 14"),
    "capitals": ("false", "n_letters >= 20 and n_capitals * 2 > n_letters"),
    "shouting": ("false", "n_marks * 5 > n_words"),
    "lettered_words": ("false", "n_lettered * 10 < n_words * 7"),
}
#: Start of the estimation and bounds that keep a rule better than chance.
PRIOR, ACCURACY, LEAST, MOST, PSEUDO, ROUNDS = 0.8, 0.8, 0.55, 0.999, 10.0, 30


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words covered by windows that are found twice or more in one text, the first included.

    Windows are compared by 64-bit hashes.  The count of distinct hashes tells most texts apart
    at once; only a text with a repeat sorts its windows by hash.
    """
    starts = F.sequence(F.lit(1), F.size(words) - (window - 1))
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    found = F.transform(F.array(hashes), lambda h: F.transform(starts, lambda i: F.xxhash64(F.slice(h, i, F.lit(window)))))[0]

    def positions(hs: Column) -> Column:
        pairs = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = lambda p, i, step: F.coalesce(F.get(p, i + step)["h"] == F.get(p, i)["h"], F.lit(False))
        kept = F.transform(
            F.array(pairs),
            lambda p: F.filter(F.transform(p, lambda x, i: F.when(same(p, i, -1) | same(p, i, 1), x["i"])), lambda i: i.isNotNull()),
        )[0]
        return F.sort_array(kept)

    def covered(at: Column) -> Column:
        each = F.transform(at, lambda p, i: F.least(F.coalesce(F.get(at, i + 1) - p, F.lit(window)), F.lit(window)))
        return F.aggregate(each, F.lit(0), lambda a, x: a + x)

    counted = F.transform(
        F.array(found),
        lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0)).otherwise(
            F.transform(F.array(positions(hs)), covered)[0]
        ),
    )[0]
    return F.when(F.size(words) <= window, F.lit(0)).otherwise(counted).cast("long")


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts that the rules and the base use, over the whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select("doc_id", text.alias("text")).withColumn("words", words_of(F.col("text")))
    lines = F.filter(F.split(F.col("text"), "\n"), lambda x: F.length(F.translate(x, BLANK, "")) > 0)
    df = df.withColumn("lines", lines)
    return df.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate(F.col("text"), BLANK, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate(F.col("text"), SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("words")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        _count(F.col("text"), r"\p{L}+").cast("long").alias("n_letters"),
        _count(F.col("text"), r"\p{Lu}+").cast("long").alias("n_capitals"),
        (F.length("text") - F.length(F.translate(F.col("text"), "!?", ""))).cast("long").alias("n_marks"),
        F.size(F.filter("words", lambda w: w.rlike(r"\p{L}"))).cast("long").alias("n_lettered"),
    )


def _votes() -> Column:
    """All votes of a row as one number to the base of three."""
    code = F.lit(0)
    for good, bad in RULES.values():
        vote = F.when(F.expr(bad), F.lit(BAD)).when(F.expr(good), F.lit(GOOD)).otherwise(F.lit(ABSTAIN))
        code = code * 3 + vote
    return code


def _vote(code: Column, rule: int) -> Column:
    return F.floor(code / F.lit(3 ** (len(RULES) - 1 - rule))).cast("int") % 3


def _posterior(code: Column, state: Column) -> Column:
    """Probability of good text, from prior and accuracies: [prior, good accuracies, bad accuracies]."""
    odds = F.log(F.get(state, F.lit(0)) / (1 - F.get(state, F.lit(0))))
    for r in range(len(RULES)):
        good, bad = F.get(state, F.lit(1 + r)), F.get(state, F.lit(1 + len(RULES) + r))
        odds = odds + F.when(_vote(code, r) == GOOD, F.log(good / (1 - bad))).when(_vote(code, r) == BAD, F.log((1 - good) / bad)).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def _estimate(patterns: Column) -> Column:
    """Expectation-maximisation over the counted vote patterns, as one expression."""
    n_rules = len(RULES)
    start = F.array(*[F.lit(x) for x in [PRIOR] + [ACCURACY] * (2 * n_rules)])

    def total(weighted: Column, weight) -> Column:
        return F.aggregate(weighted, F.lit(0.0), lambda a, x: a + weight(x))

    def better(weighted: Column) -> Column:
        """The state that makes the posterior-weighted counts likeliest."""
        good = total(weighted, lambda x: x["n"] * x["p"])
        every = total(weighted, lambda x: x["n"])
        state = [(good + PSEUDO * PRIOR) / (every + PSEUDO)]
        for mine, share in ((GOOD, lambda x: x["p"]), (BAD, lambda x: 1 - x["p"])):
            for r in range(n_rules):
                voted = total(weighted, lambda x, r=r, s=share: F.when(_vote(x["code"], r) != ABSTAIN, x["n"] * s(x)).otherwise(0.0))
                right = total(weighted, lambda x, r=r, s=share, m=mine: F.when(_vote(x["code"], r) == m, x["n"] * s(x)).otherwise(0.0))
                state.append((right + PSEUDO * ACCURACY) / (voted + PSEUDO))
        return F.array(*[F.least(F.greatest(s, F.lit(LEAST)), F.lit(MOST)) for s in state])

    def step(state: Column) -> Column:
        weighted = F.transform(patterns, lambda x: F.struct(x["code"].alias("code"), x["n"].alias("n"), _posterior(x["code"], state).alias("p")))
        return F.transform(F.array(weighted), better)[0]

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda state, _: step(state))


def judge(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Judge every document by the rules; returns its counts, ``base_failed``, ``quality`` and ``kept``.

    Each rule votes good or bad or abstains.  The vote patterns of all documents are counted (at
    most three to the number of rules), expectation-maximisation over these counts estimates each
    rule's accuracy on good and on bad text, and a document's ``quality`` is the posterior of good
    text given its votes.  ``kept`` is false where ``base_failed`` is true, else ``quality`` decides.

    Null texts have no words and fail the base.  Null ids and repeated rows are judged row by row.
    No rows give no rows.  Other columns are not looked at.
    """
    counted = saved(statistics(docs).withColumn("code", _votes()))
    patterns = counted.groupBy("code").agg(F.count(F.lit(1)).cast("double").alias("n"))
    # One row of at most 3 ** len(RULES) patterns.
    listed = patterns.agg(F.sort_array(F.collect_list(F.struct("code", "n"))).alias("patterns")).withColumn("state", _estimate(F.col("patterns")))
    quality = listed.select("state", F.explode("patterns").alias("x")).select(
        F.col("x.code").alias("code"), _posterior(F.col("x.code"), F.col("state")).alias("quality")
    )
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    return (
        counted.join(F.broadcast(quality), "code")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("quality") >= threshold))
        .drop("code")
    )
