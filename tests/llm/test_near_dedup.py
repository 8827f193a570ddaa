import math
import random
from collections import Counter, defaultdict

import numpy as np

from concordat.llm import near_dedup as n


def grams(text):
    w = (text or "").encode().split()
    return Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) > 4 else Counter([tuple(w)] if w else [])


def brute(rows, t=0.8):
    """Class by class: all pairs of texts, smallest id of each component."""
    texts = sorted({x or "" for _, x in rows})
    found = {x: grams(x) for x in texts}
    often = Counter(g for _, x in rows for g in found[x or ""])
    size = len(rows)
    weight = {x: {g: c * (1 + n.RARITY_SHARE * math.log1p(size / often[g]) / math.log1p(size)) for g, c in found[x].items()} for x in texts}
    root = {x: x for x in texts}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(texts):
        for b in texts[i + 1 :]:
            shared = sum(min(weight[a][g], weight[b][g]) for g in weight[a].keys() & weight[b].keys())
            every = sum(weight[a].values()) + sum(weight[b].values()) - shared
            if every and shared / every >= t - 1e-6:
                root[top(a)] = top(b)
    least = defaultdict(lambda: math.inf)
    for i, x in rows:
        r = top(x or "")
        least[r] = min(least[r], math.inf if i is None else i)
    return sorted(((i, None if least[top(x or "")] == math.inf else least[top(x or "")]) for i, x in rows), key=str)


def edit(text, n_edits, draw):
    words = text.split()
    for _ in range(n_edits):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return " ".join(words)


def got(df):
    return sorted(((r.doc_id, r.class_id) for r in df.collect()), key=str)


def test_against_all_pairs(docs, prose):
    draw = random.Random(1)
    rows = []
    for g in range(12):
        base = prose(g, 150, 5000)
        rows += [(1000 * g + k, edit(base, draw.choice((0, 1, 1, 2, 3, 12)), draw)) for k in range(9)]
    rows += [(90000 + k, prose(500 + k, 60, 5000)) for k in range(20)]
    assert got(n.classes(docs(*rows).repartition(4))) == brute(rows)


def test_a_large_group_in_several_components(docs, prose):
    """Copies edited too much for the text in the middle, some alike by edits that a few or many of them share."""
    draw = random.Random(4)
    base = prose(11, 120, 10**6).split()
    drafts = [list(base) for _ in range(4)]
    for g, draft in enumerate(drafts[1:]):
        for k in range(6 + g):
            draft[13 * k + g] = f"draft{g}-{k}"
    rows = []
    for k in range(160):
        words = list(drafts[0] if k < 100 else drafts[1 + k % 3])
        for _ in range(draw.choice((0, 1, 2, 3, 5))):
            words[draw.randrange(120)] = f"edit{draw.randrange(40)}"
        rows.append((k, " ".join(words)))
    want = brute(rows)
    assert got(n.classes(docs(*rows).repartition(4))) == want and len({c for _, c in want}) > 3


def test_a_chain_of_edits(docs, prose):
    """Neighbours are alike, the ends are not: one class all the same."""
    draw = random.Random(2)
    chain = [prose(3, 300, 5000)]
    for _ in range(14):
        chain.append(edit(chain[-1], 4, draw))
    rows = list(enumerate(chain))
    assert got(n.classes(docs(*rows))) == brute(rows) and len({c for _, c in brute(rows)}) == 1


def test_looped_passages(docs, prose):
    """What texts repeat counts as often as it occurs: alike by their loops, or unlike by what is looped."""
    loops = [" ".join([prose(20 + g, 12, 10**6)] * 40) for g in range(6)]
    rows = [(10 * g + k, f"{loop} {prose(100 + 10 * g + k, 45, 10**6)}") for g, loop in enumerate(loops) for k in range(2)]
    own = prose(7, 60, 10**6)
    rows += [(900 + k, own + " " + " ".join([prose(300, 8, 10**6)] * times)) for k, times in enumerate((2, 30))]
    want = brute(rows)
    assert got(n.classes(docs(*rows).repartition(3))) == want and len({c for _, c in want}) == 8


def test_sketch_estimates_weighted_similarity(prose):
    loop, counted = " ".join([prose(1, 12, 10**6)] * 40), np.zeros(n.sketch.CELLS, "<u4")
    left, right = ([f"{loop} {prose(seed + k, 45, 10**6)}".encode() for k in range(40)] for seed in (100, 200))
    x, y = n.bins(n.shingles(left)), n.bins(n.shingles(right))
    share = ((x == y) & (x > 0)).sum(axis=1) / ((x > 0) | (y > 0)).sum(axis=1)
    want = n.similarities(left, right, counted, 10)
    assert (want >= 0.8).all() and (share >= n.least_share(0.8)).all() and abs((share - want).mean()) < 0.02


def test_samples_estimate_the_similarity(prose):
    a = prose(1, 3000, 10**6).encode()
    b = b" ".join(a.split()[:2400] + prose(2, 600, 10**6).encode().split())
    counted = np.zeros(n.sketch.CELLS, "<u4")
    found = n.shingles([a, b])
    drawn = n.samples(found, n.weights(found, counted, 10))
    want = n.similarities([a], [b], counted, 10)[0]
    assert abs((drawn[0] == drawn[1]).mean() - want) < 0.25 and abs(want - 0.66) < 0.02


def test_edges(clashing, docs, prose):
    long = prose(5, 20000, 10**6)
    rows = [
        (None, "a b c d e f"), (None, "a b c d e f"), (1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "one two"), (6, "one  two"), (7, long), (8, long + " x"),
        (9, "a b c d e f"), (9, "a b c d e f"), (9, "other"),
    ]
    assert got(n.classes(clashing(*rows))) == brute(rows)
    assert n.classes(docs()).count() == 0
    df = clashing(*rows)
    kept = n.keep_first(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, None), (3, " \n"), (4, "one two"), (7, long), (9, "a b c d e f"), (9, "other")]
