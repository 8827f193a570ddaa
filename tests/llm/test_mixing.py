import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from concordat.llm import mixing

SCHEMA = "doc_id long, source string, text string"


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Reshare the excess by weight until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    goal, capped = share * sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in capped]
        left = goal - sum(most * sizes[s] for s in capped)
        target = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        above = {s for s in rest if target[s] > most * sizes[s]}
        if not above:
            return target | {s: most * sizes[s] for s in capped}
        capped |= above


def corpus(seed=1, per_source=(1, 5, 60, 200, 400, 90, 30)):
    draw = random.Random(seed)
    rows = []
    for k, n in enumerate(per_source):
        for _ in range(n):
            words = min(2000, int(draw.paretovariate(1.1) * 20))
            rows.append((len(rows), None if k == 3 else f"s{k}", " \t".join("w" * draw.randrange(1, 4) for _ in range(words))))
    return rows


def collected(df, **kw):
    return [(r.doc_id, r.source, r["size"], r.source_size, r.target, r.copies) for r in mixing.plan(df, **kw).collect()]


def check(rows, found, near):
    sizes = defaultdict(int)
    for _, s, t in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want, taken = brute_targets(sizes), defaultdict(int)
    assert sorted(map(str, (r[:2] for r in found))) == sorted(map(str, (r[:2] for r in rows)))
    for _, s, size, source_size, target, copies in found:
        assert source_size == sizes[s] and target == pytest.approx(want[s])
        ratio = target / source_size if source_size else 0
        assert int(ratio) <= copies <= 2 and copies <= int(ratio) + 1
        taken[s] += copies * size
    for s, target in want.items():
        assert abs(taken[s] - target) <= near(s), (s, taken[s], target)


def test_targets_and_taken(spark):
    rows = corpus()
    found = collected(spark.createDataFrame(rows, SCHEMA).repartition(6))
    largest = defaultdict(int)
    for _, s, size, *_ in found:
        largest[s] = max(largest[s], size)
    check(rows, found, lambda s: largest[s] / 2)
    again = collected(spark.createDataFrame(rows[::-1], SCHEMA).repartition(2))
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_rounds_end_at_the_same_place(spark, monkeypatch):
    """With short stretches the sample is the start of the Pareto order, but for its end."""
    rows = [(i, "a" if i % 4 else "b", "w " * (1 + i % 7)) for i in range(6000)]
    df = spark.createDataFrame(rows, SCHEMA)
    plain = collected(df)
    monkeypatch.setattr(mixing, "NEAR_END", 40)
    found = collected(df)
    check(rows, found, lambda s: 8)
    assert len(set(found) ^ set(plain)) <= 2 * 2 * 2 * 8
    ranks = {(r.doc_id): (r.mark, r.copies) for r in mixing.plan(df).where("source = 'a'").collect()}
    target, size = next((t, n) for _, s, _, n, t, _ in found if s == "a")
    part = target / size - int(target / size)
    if part:
        odds = {}
        for i, (mark, _) in ranks.items():
            u = (((mark & (2**64 - 1)) >> 11) + 0.5) / 2**53
            odds[i] = u / (1 - u) / (part / (1 - part))
        more = {i for i, (_, c) in ranks.items() if c > int(target / size)}
        first = sorted(odds, key=odds.get)[: len(more)]
        assert len(more ^ set(first)) <= 16


def test_appeal(spark):
    rows = [(i, "a" if i % 2 else "b", "w " * 10) for i in range(4000)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = mixing.plan(df, weights=(1, 5), share=0.7, appeal=F.when(F.col("doc_id") % 4 < 2, 3.0).otherwise(1.0)).collect()
    by = defaultdict(list)
    for r in found:
        by[r.source, r.doc_id % 4 < 2].append(r.copies)
    liked, other = np.mean(by["a", True]), np.mean(by["a", False])
    a = [r for r in found if r.source == "a"]
    assert sum(r.copies * r["size"] for r in a) == pytest.approx(a[0].target, abs=5)
    assert liked / other == pytest.approx(3, rel=0.2)


def test_mixed_copies_rows(spark):
    rows = corpus(3, (40, 40, 40)) + [(0, "s0", None)] * 2
    df = spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit("x")).withColumn("mark", F.lit(1))
    want = defaultdict(int)
    for r in mixing.plan(df).collect():
        want[r.doc_id, r["size"]] += r.copies
    got = defaultdict(int)
    for r in mixing.mixed(df).collect():
        assert r.row == "x"
        got[r.doc_id, len((r.text or "").split())] += 1
    assert got == {k: v for k, v in want.items() if v}


def test_edges(spark, monkeypatch):
    assert collected(spark.createDataFrame([], SCHEMA)) == []
    monkeypatch.setattr(mixing, "NEAR_END", 64)
    rows = [(1, "a", "same text here")] * 3000 + [(2, "b", "w " * 30_000), (None, "b", "x y"), (3, "c", "z")]
    found = collected(spark.createDataFrame(rows, SCHEMA))
    check(rows, found, lambda s: {"a": 3, "b": 15_001, "c": 1}[s])
    for r in collected(spark.createDataFrame([(1, "a", None), (None, None, "")], SCHEMA)):
        assert r[2:] == (0, 0, 0.0, 0)


def test_fill():
    draw = random.Random(4)
    for _ in range(50):
        sizes = np.array([draw.randrange(1, 50) for _ in range(draw.randrange(1, 40))])
        rest = draw.random() * sizes.sum()
        assert abs(sizes[mixing.fill(sizes, rest)].sum() - rest) <= sizes.min() / 2 + 25
    assert not mixing.fill(np.array([5, 5]), 0.0).any() and mixing.fill(np.array([5, 5]), 11.0).all()
    assert len(mixing.fill(np.array([], np.int64), 3.0)) == 0
