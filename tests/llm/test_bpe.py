import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from cases import CLASHING, documents
from wickline.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PARTS = ["'s", "'t", "'re", "'ll", "'", "''", " ", "  ", "\n", "\t", "\r\n", "a", "hello", "World", "1", "23", "²", "½", "é",
         "中文", "🙂", "👩‍👩‍👧", "!", "...", "$$$", "\x1c", "\x85", "\xa0", "　", "<|endoftext|>", "aaaaaaaaaaaaaaa",
         "'S", "\0", "١٢", "Ⅷ", "́", "𐍈"]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids(library):
    pick = random.Random(1)
    texts = ["".join(pick.choice(PARTS) for _ in range(pick.randrange(40))) for _ in range(5000)]
    texts += ["", "a" * 5000, " " * 3000 + "x", "\n" * 100, "ab" * 40_000]
    coder = bpe.coder(PATH)
    got = coder.encode(texts)
    assert got == library.encode_ordinary_batch(texts)
    assert [coder.decode(ids) for ids in got] == [t.encode() for t in texts]


def test_ranks_out_of_merge_order(tmp_path):
    """A token may rank below its own parts; then one pair at a time is merged."""
    pick = random.Random(2)
    for case in range(40):
        tokens = [bytes([b]) for b in range(256)]
        more = {bytes(pick.choice(b"abc") for _ in range(pick.randrange(2, 6))) for _ in range(25)}
        tokens += sorted(more, key=lambda t: pick.random())
        path = tmp_path / f"{case}.tiktoken"
        path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens)))
        coder = bpe.Coder(str(path))
        library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                    mergeable_ranks={t: i for i, t in enumerate(tokens)})
        texts = ["".join(pick.choice("abc") for _ in range(pick.randrange(1, 30))) for _ in range(100)]
        assert coder.encode(texts) == library.encode_ordinary_batch(texts)


def test_rows(spark, library):
    rows = [(1, "Hello world's"), (1, "Hello world's"), (None, None), (2, ""), (3, "é" * 50_000 + " end")]
    got = bpe.encoded(documents(spark, rows, CLASHING), "doc_id", "text", PATH).collect()
    want = []
    for doc, text in rows:
        ids = library.encode_ordinary(text or "")
        want.append((doc, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.encoded(documents(spark, []), "doc_id", "text", PATH).count() == 0


def thue_morse(bits, a="a", b="b"):
    return "".join(a if bin(i).count("1") % 2 == 0 else b for i in range(1 << bits))


def test_words_of_one_polynomial_hash(library):
    """Such a word and its complement collide under every polynomial modulo 2^64."""
    texts = [thue_morse(10) + " " + thue_morse(10, "b", "a"), thue_morse(12) + thue_morse(12, "b", "a"), thue_morse(10)]
    got = bpe.coder(PATH).encode(texts)
    assert got == library.encode_ordinary_batch(texts)
    assert [bpe.coder(PATH).decode(ids) for ids in got] == [t.encode() for t in texts]


def test_pieces_aretold_apart_by_their_bytes():
    data = np.frombuffer(b"oneonetwoonethree", np.uint8)
    starts, ends = np.array([0, 3, 6, 9, 12]), np.array([3, 6, 9, 12, 17])
    word, first = bpe.told_apart(data, starts, ends, np.zeros(5, np.uint64))
    found = [data[starts[k]:ends[k]].tobytes() for k in first]
    assert [found[k] for k in word] == [b"one", b"one", b"two", b"one", b"three"]
