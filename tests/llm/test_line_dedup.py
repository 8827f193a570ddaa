import random

import numpy as np

from concordat.llm import line_dedup

BLANK = "".join(map(chr, (9, 10, 11, 12, 13, 32)))


def brute(rows, t=0.8):
    """Kept texts by comparing every line with all earlier ones; repeated rows are alike."""
    key = lambda r: (2**63 if r[0] is None else r[0])
    earlier, out = [], {}
    for i, text in sorted(set(rows), key=key):
        kept, removed, total = [], 0, 0
        for line in (text or "").split("\n"):
            s = frozenset(line.encode().split())
            if not s:
                kept.append(line)
                continue
            total += 1
            if any(len(s & e) >= t * len(s | e) - 1e-9 for e in earlier):
                removed += 1
            else:
                kept.append(line)
            earlier.append(s)
        out[i, text] = ("\n".join(kept), total, removed)
    return sorted(((i, *out[i, x]) for i, x in rows), key=str)


def got(df):
    return sorted(((r.row["doc_id"], r.kept_text, r.n_lines, r.n_removed) for r in df.collect()), key=str)


def corpus(seed, n):
    draw = random.Random(seed)
    base = [[f"w{int(draw.paretovariate(0.6)) % 700}" for _ in range(draw.choice((1, 2, 3, 4, 5, 9, 20, 60)))] for _ in range(40)]
    rows = []
    for i in range(n):
        lines = []
        for _ in range(draw.randrange(6)):
            line = list(draw.choice(base))
            for _ in range(draw.randrange(3)):
                line[draw.randrange(len(line))] = f"w{draw.randrange(900)}"
            draw.shuffle(line)
            lines.append(" ".join(line))
            if draw.random() < 0.2:
                lines.append(" ")
        rows.append((i, "\n".join(lines)))
    return rows


def test_against_brute_force(docs):
    rows = corpus(5, 150)
    assert got(line_dedup.dedup(docs(*rows).repartition(5))) == brute(rows)


def test_exact_when_the_nearest_do_not_confirm(docs, monkeypatch):
    """With a single nearest partner the second join has to find the others."""
    monkeypatch.setattr(line_dedup, "NEAREST", 1)
    rows = corpus(6, 80)
    assert got(line_dedup.dedup(docs(*rows))) == brute(rows)


def test_exact_by_pieces_of_parities(docs, monkeypatch):
    """All pairs of runs meet by pieces of their parities."""
    monkeypatch.setattr(line_dedup, "LARGE", 0)
    rows = corpus(7, 120)
    assert got(line_dedup.dedup(docs(*rows).repartition(3))) == brute(rows)


def entries(spark, rows):
    """What the lists of one bucket hold, over a single flush."""
    lines = line_dedup._first_lines([(i, 0, t.encode()) for i, t in rows])
    counted = np.bincount(line_dedup._cells(lines.tokens), minlength=1 << line_dedup.sketch.BITS).astype("<u4")
    tokens, of, rank, used = line_dedup._prefixes(lines.tokens, lines.bounds, counted, 0.8)
    return tokens[used], lines.sizes[of[used]], rank[used]


def test_long_lists_are_not_walked(spark):
    """Of 50 000 lines of one template that cannot be similar, no two meet."""
    rows = [(i, f"u{i} posted by admin in news today") for i in range(50_000)]
    token, size, rank = entries(spark, rows)
    order = np.lexsort((rank, size, token))
    bounds, left, right, _ = line_dedup._run_pairs(token[order], size[order], rank[order], 0.8)
    assert len(token) >= 50_000 and int((np.diff(bounds)[left] * np.diff(bounds)[right]).sum()) < 10_000


def test_pieces_of_parities_find_all():
    draw = np.random.default_rng(4)
    base = draw.integers(0, 1 << 62, 30).astype("u8")
    bits = base[draw.integers(0, 30, 600)]
    for _ in range(3):
        bits ^= np.where(draw.random(600) < 0.7, np.uint64(1) << draw.integers(0, 64, 600).astype("u8"), np.uint64(0))
    bounds = np.array([0, 350, 600])
    for runs in ((0, 0), (0, 1), (1, 1)):
        for d in (0, 1, 4, 8):
            one = [np.array([x]) for x in (*runs, d)]
            near = lambda i, j: {p for p in zip(i.tolist(), j.tolist()) if int(bits[p[0]] ^ bits[p[1]]).bit_count() <= d}  # noqa: B023, E731
            found = []
            for large in (0, 1 << 40):
                line_dedup.LARGE, kept = large, line_dedup.LARGE
                met = [x for i, j, _ in line_dedup._met(bounds, *one, bits, np.ones(600, bool)) for x in near(i, j)]
                line_dedup.LARGE = kept
                assert len(met) == len(set(met))
                found.append(set(met))
            assert found[0] == found[1] and (d == 0 or found[0])


def test_edges(clashing):
    long = " ".join(f"t{k}" for k in range(5000))
    rows = [
        (None, "a b c d\nx"), (3, "a b c d e\n\nq"), (4, None), (5, ""), (6, "\n \n"), (7, long), (8, long + " more"), (9, "a b c d e"), (9, "a b c d e"),
        (10, "b a a c d d e q"), (-5, "x"),
    ]
    assert got(line_dedup.dedup(clashing(*rows))) == brute(rows)


def test_empty_table_and_clean(docs, clashing):
    assert line_dedup.dedup(docs()).count() == 0
    df = clashing((1, "same line here\nown"), (2, "same line here"), (3, None), (4, "other words\n\n"))
    found = {r.doc_id: r for r in line_dedup.clean(df).collect()}
    assert line_dedup.clean(df).columns == df.columns
    assert [found[i].text for i in (1, 2, 3, 4)] == ["same line here\nown", "", None, "other words\n\n"]
    assert found[2].n_chars == 0
