import random
from array import array
from collections import defaultdict

from pyspark.sql import Row
from tokenizers import Tokenizer

from concordat.llm import packing
from concordat.llm.queries import VOCABULARY


def plain():
    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return t


def check(rows, capacity=1024):
    """Every id of every document once and in order, sequences gapless and not too long."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = array("I", bytes(r.ids)).tolist()
        assert len(ids) == r.length
        docs[r.doc_id].append((r.start, ids, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert 0 < at <= capacity
    return docs, sequences


def test_whole_documents(docs, prose):
    tokenizer = plain()
    draw = random.Random(2)
    texts = [prose(i, draw.randrange(0, 900), 5000) + draw.choice(("", " ", "  x", "\n", " a\n b")) for i in range(120)]
    texts += ["<|endoftext|>", None, "", "y" * 5000, " lead", "a \n b"]
    rows = packing.pack(docs(*enumerate(texts)).repartition(3), VOCABULARY).collect()
    found, sequences = check(rows)
    for i, text in enumerate(texts):
        want = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        got = [x for _, ids, _ in sorted(found[i]) for x in ids]
        assert got == want and {n for *_, n in found[i]} == {len(want)}
    total = sum(r.length for r in rows)
    assert len(sequences) * 1024 < 1.05 * total + 3 * 1024


def packed(lengths):
    packer = packing.Packer(1024, 0)
    for i, n in enumerate(lengths):
        packer.add(i, array("I", range(n)).tobytes())
        assert len(packer.ends) <= packer.ENDS
    packer.finish()
    rows = packer.take().to_pylist()
    docs, sequences = check([Row(**r) for r in rows])
    for i, n in enumerate(lengths):
        assert [x for _, ids, _ in sorted(docs[i]) for x in ids] == list(range(n))
    return rows, sequences


def test_pieces_and_padding():
    """Few cuts and little padding, whatever the lengths are."""
    draw = random.Random(9)
    kinds = {
        "even": lambda: draw.randrange(1, 2500),
        "short": lambda: 1 + int(draw.expovariate(1 / 80)),
        "tail": lambda: min(200_000, int(20 * draw.paretovariate(0.9))),
        "halves": lambda: draw.randrange(513, 800),
        "equal": lambda: 700,
        "tiny": lambda: 1,
    }
    for name, length in kinds.items():
        lengths = [length() for _ in range(3000)]
        rows, sequences = packed(lengths)
        least = sum(-(-n // 1024) for n in lengths)
        assert len(sequences) * 1024 < 1.02 * sum(lengths) + 1024, name
        assert len(rows) < (1.3 if name not in ("halves", "equal") else 1.7) * least, (name, len(rows), least)


def test_classes():
    """A bin of a class holds its fixed number of rests."""
    for n, k in ((1024, 1), (512, 2), (341, 3), (256, 4), (16, 64)):
        rows, sequences = packed([n] * 10 * k)
        assert {len(x) for x in sequences.values()} == {k} and len(rows) == 10 * k


def test_edges(clashing, docs):
    assert packing.pack(docs(), VOCABULARY).count() == 0
    found, _ = check(packing.pack(clashing((None, "a"), (1, None), (2, "b"), (2, "b")), VOCABULARY).collect())
    assert sorted(map(str, found)) == ["1", "2", "None"] and len(found[2]) == 2 and found[1][0][1] == [0]
