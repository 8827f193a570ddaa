import random

from pyspark.sql import functions as F

from concordat.llm import spot_signatures as s


def edited(rows):
    """Edited texts by sorting everything; equal ids are told apart by nothing here."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1] or ""
        t = t or ""
        out[i] = t[: len(t) - len(t) // 3] + nxt[: len(t) // 3]
    return out


def test_edited_texts_and_likeness(clashing, prose, monkeypatch):
    monkeypatch.setattr(s, "PART_ROWS", 4)
    draw = random.Random(4)
    rows = [(draw.randrange(-(10**6), 10**6), " the ".join(prose(i * 9 + k, 4, 3000) for k in range(draw.randrange(1, 30)))) for i in range(70)]
    rows = list(dict(rows).items()) + [(10**12, None), (10**12 + 1, "é" * 9), (-(10**13), "short")]
    want = edited(rows)
    found = s.fingerprint(clashing(*rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.edited == want[r.doc_id] and r.n_chars == len(dict(rows)[r.doc_id] or "")
        a, b, c = set(r.found), set(r.edited_found), set(r.next_found)
        for value, x in ((r.near_edited, b), (r.near_next, c)):
            assert abs(value - (len(a & x) / len(a | x) if a | x else 1.0)) < 1e-9
    assert sum(r.near_edited for r in found) / len(found) > 0.3 > 0.1 > sum(r.near_next for r in found) / len(found)


def test_signatures(docs):
    rows = [(1, "The cat sat on the mat"), (2, "the CAT, sat on: the mat!"), (3, "the cat sat on the rug"), (4, ""), (5, None), (6, "***"), (7, "the the")]
    found = {r.doc_id: r.found for r in docs(*rows).selectExpr("doc_id", "text").withColumn("found", s.signatures(F.col("text"))).collect()}
    assert found[1] == found[2] and len(found[1]) == 3 and set(found[1]) & set(found[3])
    assert found[4] == found[5] == [] and len(found[6]) == 1 and found[7]


def test_every_word_counts(docs, prose):
    """Texts without an anchor, and with few: a change of any word shows, and leaves the rest alike."""
    texts = [prose(1, 40, 10**6), prose(2, 5, 10**6), prose(3, 20, 10**6) + " the " + prose(4, 20, 10**6), "слово " * 7 + prose(5, 9, 10**6)]
    rows = []
    for t, text in enumerate(texts):
        words = text.split()
        rows += [(1000 * t + k, " ".join(words[:k] + ["changed"] + words[k + 1 :])) for k in range(len(words))] + [(1000 * t + 999, text)]
    found = {r.doc_id: set(r.found) for r in docs(*rows).select("doc_id", s.signatures(F.col("text")).alias("found")).collect()}
    for i, _ in rows:
        whole = found[i // 1000 * 1000 + 999]
        assert i % 1000 == 999 or found[i] != whole
        assert i // 1000 not in (0, 2) or len(found[i] & whole) > 0.4 * len(found[i] | whole)
    pair = s.fingerprint(docs((1, texts[0]), (2, " ".join(texts[0].split()[:3]) + " " + prose(9, 37, 10**6)))).collect()
    assert all(0.3 < r.near_edited < 1 and r.near_next < 0.3 for r in pair)


def test_edges(docs):
    assert s.fingerprint(docs()).count() == 0
    one = s.fingerprint(docs((3, "abcdef"))).first()
    assert one.edited == "abcdab" and one.near_next == 1.0
    same = s.fingerprint(docs((None, "a b c"), (None, "a b c"), (1, "x"), (1, "x"), (1, "y y y"))).collect()
    assert len(same) == 5


def test_matches_against_all_pairs(spark):
    draw = random.Random(8)
    base = [draw.sample(range(300), 20) for _ in range(12)]
    sets = {tuple(sorted(set(draw.choice(base)[: draw.randrange(12, 21)]) | {draw.randrange(300, 330)})) for _ in range(120)}
    df = spark.createDataFrame([(list(x),) for x in sets] + [([],)], "found array<int>")
    got = {tuple(sorted((tuple(r.a), tuple(r.b)))) for r in s.matches(df).collect()}
    want = {tuple(sorted((a, b))) for a in sets for b in sets if a < b and len(set(a) & set(b)) >= 0.8 * len(set(a) | set(b))}
    assert got == want and want
