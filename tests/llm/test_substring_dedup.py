import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from concordat.llm import substring_dedup
from concordat.llm.shared import slot_column
from concordat.llm.wordvec import LAST, slots_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    """Kept words by plain counting; null ids are larger than all others."""
    key = lambda i: float("inf") if i is None else i
    first = {}
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, ws in words:
        for k in range(len(ws) - window + 1):
            w = tuple(ws[k : k + window])
            first[w] = min(first.get(w, key(i)), key(i))
    out = []
    for i, ws in words:
        gone = [False] * len(ws)
        for k in range(len(ws) - window + 1):
            if key(i) > first[tuple(ws[k : k + window])]:
                gone[k : k + window] = [True] * window
        out.append((i, len(ws), sum(gone), " ".join(w for w, g in zip(ws, gone) if not g)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.row["doc_id"], r.n_words, r.n_removed, r.kept_text) for r in df.collect()), key=str)


def test_against_brute_force(docs, prose):
    draw = random.Random(3)
    passages = [prose(900 + k, 12, 5000) for k in range(6)]
    rows = []
    for i in range(60):
        parts = [prose(i, draw.randrange(0, 40), 5000)] + [draw.choice(passages) for _ in range(draw.randrange(3))] + [prose(1000 + i, 9, 5000)]
        draw.shuffle(parts)
        rows.append((i * 7 - 50, "\n".join(parts) if i % 3 else "  ".join(parts)))
    assert got(substring_dedup.dedup(docs(*rows), 10)) == brute(rows, 10)


def test_edges(clashing, prose):
    long = prose(1, 3000)
    rows = [
        (None, long), (None, "a b c"), (5, long), (5, long), (2, "x " + long), (9, None), (10, ""), (11, " \t\n"), (12, "one two"),
        (13, "na " * 120), (14, "na " * 60), (2**62, "na " * 70),
    ]
    assert got(substring_dedup.dedup(clashing(*rows))) == brute(rows, 50)


def test_within_one_document_nothing_goes(docs, prose):
    twice = prose(4, 60) + " "
    assert got(substring_dedup.dedup(docs((1, twice + twice)), 50))[0][2] == 0


def test_copies_in_several_tasks(docs, prose):
    rows = [(i, prose(7, 80)) for i in range(40)] + [(100 + i, prose(i, 60)) for i in range(20)]
    assert got(substring_dedup.dedup(docs(*rows).repartition(7))) == brute(rows, 50)


def test_empty_table_and_clean(docs, clashing, prose):
    assert substring_dedup.dedup(docs()).count() == 0
    same = prose(8, 55)
    df = clashing((1, same + "\n\nand  more"), (2, same), (3, None))
    found = {r.doc_id: r for r in substring_dedup.clean(df).collect()}
    assert substring_dedup.clean(df).columns == df.columns
    assert (found[1].text, found[2].text, found[2].n_chars, found[3].text) == (same + "\n\nand  more", "", 0, None)


def test_rows_of_one_id_are_spread(spark, docs):
    """Rows without an id, or of one id, do not share a slot, and both sides name the same one."""
    texts = [f"text {k} é" if k else None for k in range(400)]
    df = docs(*[(None, t) for t in texts], *[(-7, t) for t in texts])
    key = F.coalesce("doc_id", F.lit(int(LAST)))
    rows = df.select(key.alias("key"), F.coalesce("text", F.lit("")).alias("text"), slot_column(key, df["text"], 101).alias("slot")).collect()
    assert len({r.slot for r in rows if r.key != -7}) > 80 < len({r.slot for r in rows if r.key == -7})
    ids, ties = np.array([r.key for r in rows]), np.array([zlib.crc32(r.text.encode()) for r in rows], "<u4")
    assert slots_of(ids, ties, 101).tolist() == [r.slot for r in rows]
