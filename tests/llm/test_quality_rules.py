import math
import random
import re
from collections import Counter

from concordat.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = [False] * len(words)
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            covered[i : i + 8] = [True] * 8
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), sum(covered),
    )


def posterior(codes):
    """The estimation once more, in plain Python over all documents."""
    n = len(q.RULES)
    votes = [[code // 3 ** (n - 1 - r) % 3 for r in range(n)] for code in codes]
    prior, good, bad = q.PRIOR, [q.ACCURACY] * n, [q.ACCURACY] * n

    def chance(v):
        odds = math.log(prior / (1 - prior))
        for r, x in enumerate(v):
            odds += math.log(good[r] / (1 - bad[r])) if x == 1 else math.log((1 - good[r]) / bad[r]) if x == 0 else 0.0
        return 1 / (1 + math.exp(-odds))

    clip = lambda x: min(max(x, q.LEAST), q.MOST)
    for _ in range(q.ROUNDS):
        p = [chance(v) for v in votes]
        new_prior = clip((sum(p) + q.PSEUDO * q.PRIOR) / (len(p) + q.PSEUDO))
        rate = lambda r, mine, share: clip(
            (sum(share(x) for v, x in zip(votes, p) if v[r] == mine) + q.PSEUDO * q.ACCURACY)
            / (sum(share(x) for v, x in zip(votes, p) if v[r] != 2) + q.PSEUDO)
        )
        new_good = [rate(r, 1, lambda x: x) for r in range(n)]
        new_bad = [rate(r, 0, lambda x: 1 - x) for r in range(n)]
        prior, good, bad = new_prior, new_good, new_bad
    return [chance(v) for v in votes]


def corpus(prose):
    draw = random.Random(1)
    rows = [(i, prose(i, draw.randrange(25, 120), 5000) + ".") for i in range(60)]
    rows += [(100 + i, " ".join(w + "***" for w in prose(i, 60, 5000).split())) for i in range(8)]
    rows += [(200 + i, (prose(i, 12).upper() + "!! ") * 6) for i in range(6)]
    return rows


def test_counts_and_posterior(docs, prose):
    rows = corpus(prose)
    code = {r.doc_id: r.code for r in q.statistics(docs(*rows)).withColumn("code", q._votes()).collect()}
    want = dict(zip(code, posterior(list(code.values()))))
    for r in q.judge(docs(*rows)).collect():
        text = dict(rows)[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(text)
        assert abs(r.quality - want[r.doc_id]) < 1e-6
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and want[r.doc_id] >= 0.5)
        assert r.kept == (r.doc_id < 100)


def test_edges(clashing):
    eight = "a b c d e f g h"
    rows = [
        (None, eight), (1, None), (2, ""), (3, " \n\t"), (4, eight + " " + eight), (5, "x " * 9), (6, "l\nl\n\nl"), (7, "é日 ü"), (8, "a\x0bb\x0cc\x1fd"),
        (9, " ".join(f"q{k % 4000}" for k in range(12000))), (9, "twice"), (9, "twice"),
    ]
    found = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in q.judge(clashing(*rows)).collect())
    assert found == sorted((str(i), *counts(t)) for i, t in rows)


def test_rejects_symbols_among_many_clean_texts(docs, prose):
    """The verdict goes beyond the base: one in twelve texts is full of symbols, none of them fails the base."""
    rows = [(i, prose(i, 40 + i % 50, 5000)) for i in range(330)] + [(1000 + i, prose(i, 60, 5000).replace(" ", " *#")) for i in range(30)]
    found = q.judge(docs(*rows)).collect()
    assert not any(r.base_failed for r in found) and {r.doc_id for r in found if not r.kept} == {i for i, _ in rows if i >= 1000}


def test_empty_table(docs):
    assert q.judge(docs()).count() == 0
