import base64

import public_tokenizers
import pytest
import tiktoken

from concordat.llm import byte_bpe
from concordat.llm.queries import RANKS

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def plain():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(value):
    return [int.from_bytes(value[i : i + 4], "little") for i in range(0, len(value), 4)]


def test_round_trip_and_library(clashing, plain):
    texts = ["", None, "Hello world's end", "a  b\t\n c", "é ü 日本語 　x", "<|endoftext|>", " lead", "trail  ", "x\x1c y\x85z", "1 2,3 !!!"]
    found = byte_bpe.decode(byte_bpe.encode(clashing(*enumerate(texts)), RANKS, PATTERN), RANKS, PATTERN).collect()
    assert len(found) == len(texts)
    for r in found:
        assert ids(r["ids"]) == plain.encode_ordinary(texts[r.doc_id] or "")
        assert bytes(r["data"]) == (texts[r.doc_id] or "").encode()


@pytest.mark.parametrize(
    "text", ["word, and 'tis it's. " * 500, "a" * 3000, "ab \n  c " * 400, " " * 500 + "b", "x" + "\n" * 300, "!\x1c?\x1d " * 300, " " * 900]
)
def test_chunks_encode_as_the_whole(text, plain, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CHUNK", 64)
    monkeypatch.setattr(byte_bpe, "LONG_GAP", byte_bpe.re.compile(byte_bpe.LONG_GAP.pattern.replace(str(byte_bpe.BLANKS), "20")))
    monkeypatch.setattr(byte_bpe.chunks, "__defaults__", (64,))
    assert byte_bpe.encode_text(plain, text) == plain.encode_ordinary(text)


def test_very_long_blanks(docs):
    text = "a" + " " * 2_000_000 + "b"
    row = byte_bpe.decode(byte_bpe.encode(docs((1, text)), RANKS, PATTERN), RANKS, PATTERN).first()
    assert bytes(row["data"]) == text.encode()


def test_empty_table(docs):
    assert byte_bpe.encode(docs(), RANKS, PATTERN).count() == 0
