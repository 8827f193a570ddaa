import random
import re
from collections import Counter

import numpy as np
import pytest

from concordat.llm import phrases, sketch

SCHEMA = "doc_id long, lang string, text string"


def words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [p for piece in re.split(r"[.,;:!?\x0A-\x0D]", text) if (p := re.findall(r"[^\x20\x09]+", piece))]


def brute(rows, longest=5, least=100, most=2000):
    out = []
    for lang in {r[1] or "und" for r in rows}:
        f, n = Counter(), 0
        for _, its, text in rows:
            if (its or "und") == lang:
                for p in words(text):
                    n += len(p)
                    f.update(tuple(p[i : i + k]) for k in range(1, longest + 1) for i in range(len(p) - k + 1))
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        held = {(q[i : i + k], a) for q, a in cand.items() for k in range(2, len(q)) for i in range(len(q) - k + 1)}
        scored = []
        for p, a in cand.items():
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if (p, a) not in held:
                scored.append((-score, -a, " ".join(p).encode(), " ".join(p), f[p[:k]], f[p[k:]]))
        for rank, (score, a, _, phrase, left, right) in enumerate(sorted(scored)[:most], 1):
            out.append((lang, rank, phrase, -a, left, right, n, -score))
    return sorted(out)


def mined(df, **kw):
    return sorted(tuple(r) for r in phrases.mine(df, **kw).collect())


def corpus(seed=1, docs=150):
    draw = random.Random(seed)
    said = ["in the end of the day", "New York City", "de facto standard", "Über den Wolken", "a a a a a a"]
    rows = []
    for i in range(docs):
        text = ""
        for _ in range(draw.randrange(0, 60)):
            text += draw.choice(said) if draw.random() < 0.2 else f"{draw.choice('VW')}{int(draw.paretovariate(0.7)) % 60}"
            text += draw.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", " ", ":", " ! "])
        rows.append((i, draw.choice(["en", "de", None]), text))
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert mined(df, least=5) == brute(rows, least=5)
    assert mined(df, least=8, longest=3, most=7) == brute(rows, least=8, longest=3, most=7)
    assert mined(df, least=20, longest=2) == brute(rows, least=20, longest=2)


def test_units_without_ranks(spark, monkeypatch):
    """More frequent words and pairs than there are ranks."""
    rows = corpus(2)
    monkeypatch.setattr(phrases, "RANKS", 6)
    assert mined(spark.createDataFrame(rows, SCHEMA).repartition(3), least=5) == brute(rows, least=5)


def test_edges(spark):
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    assert mined(spark.createDataFrame([(None, None, None), (1, "en", ""), (1, "en", " .\t;")], SCHEMA)) == []
    rows = [(1, None, "A b c"), (1, None, "A b c"), (None, "und", "a B c"), (2, "x", "a\0b \0 \0 a\0b \0"), (3, "x", "y" * 100_000 + " z. " + "y" * 100_000 + " z")]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("word", "n", "f", "id", "ids", "a", "b", "rank", "phrase"):
        df = df.selectExpr("*", f"'x' AS {name}")
    assert mined(df, least=2) == brute(rows, least=2)


def test_very_long_text(spark):
    text = "one two. " * 1_200_000
    got = mined(spark.createDataFrame([(1, "en", text)], SCHEMA))
    assert got == [("en", 1, "one two", 1_200_000, 1_200_000, 1_200_000, 2_400_000, 2000)]


def test_exact_beyond_64_bits(spark):
    units = spark.createDataFrame([(1, "en", 9 * 10**15, 8 * 10**15, "a b", "b", [8 * 10**15 + 3, 8 * 10**15], [8 * 10**15 + 1, 8 * 10**15])], "id long, lang string, n long, f long, text string, last string, head array<long>, tail array<long>")
    got = phrases._scored(units, 2).first()
    assert got.score == 1000 * 8 * 10**15 * 9 * 10**15 // ((8 * 10**15 + 3) * (8 * 10**15 + 1))


@pytest.mark.parametrize("spread", [50, 3000, 10**6])
def test_tiles(spread):
    draw = np.random.default_rng(spread)
    tiles, want = phrases.Tiles(), Counter()
    for _ in range(3):
        a = np.minimum(draw.geometric(1 / spread, 200_000) - 1, 10**12)
        b = np.minimum(draw.geometric(1 / spread, 200_000) - 1, 10**12)
        a[:10] += 1 << 62
        tiles.add(a, b)
        want.update(zip(a.tolist(), b.tolist(), strict=True))
    got = Counter()
    for batch in tiles.take():
        a, b = phrases.unpacked(batch.column("a").to_numpy(), batch.column("b").to_numpy())
        got.update(dict(zip(zip(a.tolist(), b.tolist(), strict=True), batch.column("n").to_pylist(), strict=True)))
    assert got == want and not tiles.sparse


def test_a_pair_of_ranks_is_kept_as_two_numbers():
    draw = np.random.default_rng(7)
    tiles = phrases.Tiles()
    tiles.add(*draw.integers(0, phrases.RANKS, (2, 300_000)))
    assert tiles.cells > 290_000 and sum(x.nbytes for part in tiles.sparse for x in part) <= 16 * tiles.cells


def test_units():
    draw = np.random.default_rng(1)
    a, b = draw.integers(0, 2 * phrases.RANKS, (2, 5000))
    keys = np.unique(phrases.keys_of(a, b))
    assert len(keys) == len(set(zip(a.tolist(), b.tolist(), strict=True)))
    cells = np.zeros(sketch.CELLS, "<u4")
    sketch.add_bits(cells, phrases.mix(keys[:3000].view(np.uint64)))
    ids = phrases.Units(draw.permutation(keys[:1000]), cells).ids(keys)
    assert sorted(ids[:1000]) == list(range(1000)) and (ids[1000:3000] >= 1 << 62).all() and (ids[3000:] < 0).mean() > 0.99
