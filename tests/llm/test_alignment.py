import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cases import CLASHING, documents, prose
from pyspark.sql import functions as F
from wickline.llm import alignment

A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups")


@pytest.fixture(scope="module")
def tools():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A_FILE)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B_FILE)


def parts(tools, text):
    """[(id, bytes)] of both sides, or nothing."""
    a, b = tools
    if not text:
        return [], []
    letters = alignment.byte_letters()
    left = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        right.append((i, bytes.fromhex(piece[3:5]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if b"".join(x for _, x in left) != whole or b"".join(x for _, x in right) != whole:
        return [], []
    return left, right


def aligned(tools, rows):
    held = []
    for doc, text in rows:
        left, right = parts(tools, text)
        spans = []
        for side in (left, right):
            at = 0
            spans.append([])
            for i, x in side:
                spans[-1].append((i, at, at + len(x)))
                at += len(x)
        links = [(i, j) for i, s, e in spans[0] for j, t, f in spans[1] if max(s, t) < min(e, f)]
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, last = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if last < e <= cut) for side in spans))
            last = cut
        held.append((doc, left, right, groups, links))
    return held


def brute(tools, rows):
    held = aligned(tools, rows)
    counts = Counter(x for *_, links in held for x in links)
    most = defaultdict(int)
    for (i, j), n in counts.items():
        most[j] = max(most[j], n)
    out = []
    for doc, left, right, groups, links in held:
        shown = ";".join(groups)
        out.append((doc, len(left), len(right), len(groups), len(links), sum(counts[x] == most[x[1]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(shown.encode()).hexdigest() if shown else "", shown))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


AWKWARD = [None, "", " ", "  two  blanks ", "\n\n", "\t", "a", "<s> <unk> </s> <|endoftext|>", "▁ low line", "naïve café ﬁ",
           "日本語のテキスト", "😀👩‍👩‍👧 flags 🇩🇪", "\u0000\u0001", " x y", "x" * 3000, "0123456789 3.14", "end ", "é",
           "﻿bom", "don't we'll I'M"]


def test_against_brute_force(spark, tools, monkeypatch):
    rows = list(enumerate(AWKWARD)) + [(100 + i, prose(i, 40)) for i in range(20)]
    rows += [(300, "the same text, twice"), (300, "the same text, twice"), (301, "the same text, twice"), (None, "no id")]
    df = documents(spark, rows, [*CLASHING, "pair", "slice", "n_a", "place"]).repartition(3)
    got = alignment.alignments(df, "doc_id", "text", A_FILE, B_FILE, detail=True)
    assert found(got) == brute(tools, rows)


def test_slices_do_not_matter(tools):
    pick = random.Random(4)
    texts = [*AWKWARD, *["".join(pick.choice("ab é\n日<>▁x") for _ in range(pick.randrange(60))) for _ in range(60)]]
    aligner = alignment.aligner(A_FILE, B_FILE)

    def cut(texts):
        raw = [(t or "").encode() for t in texts]
        return aligner.slice(np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw])), True)

    whole, single = cut(texts), [cut([t]) for t in texts]
    assert whole["groups"] == [";".join(groups) for _, _, _, groups, _ in aligned(tools, list(enumerate(texts)))]
    assert whole["groups"] == [s["groups"][0] for s in single]
    total = Counter()
    for s in single:
        total.update(dict(zip(s["pairs"].tolist(), s["counts"].tolist())))
    assert dict(total) == dict(zip(whole["pairs"].tolist(), whole["counts"].tolist()))


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 39)), st.sets(st.integers(1, 39)))
def test_groups_are_cut_where_both_end(a, b):
    cuts = [np.array(sorted(x | {40})) for x in (a, b)]
    groups = alignment.aligned_groups(*(np.diff(c, prepend=0) for c in cuts))
    common = np.array(sorted((a & b) | {40}))
    assert groups.count == len(common)
    assert groups.of_a.tolist() == np.searchsorted(common, cuts[0]).tolist()
    assert groups.of_b.tolist() == np.searchsorted(common, cuts[1]).tolist()
    starts = [np.append(0, c[:-1]) for c in cuts]
    want = [(i, j) for i in range(len(cuts[0])) for j in range(len(cuts[1]))
            if max(starts[0][i], starts[1][j]) < min(cuts[0][i], cuts[1][j])]
    assert list(zip(groups.link_a.tolist(), groups.link_b.tolist())) == want


def test_equal_hashes_of_different_groups(monkeypatch):
    """Groups are told apart by their links, whatever their hashes."""
    monkeypatch.setattr(alignment, "mix", lambda x: np.zeros_like(x))
    codes, edges = np.array([1, 2, 1, 2, 3, 1]), np.array([0, 2, 4, 5, 6])
    first, kind = alignment._kinds(codes, edges)
    groups = [codes[edges[k]:edges[k + 1]].tolist() for k in first]
    assert [groups[k] for k in kind] == [[1, 2], [1, 2], [3], [1]]


def test_numbers_survive_packing():
    for values in (np.zeros(0, np.int64), np.array([0, 255, 256, 2**32 - 1])):
        assert alignment._unpacked(alignment._packed(values)).tolist() == values.tolist()


def test_empty_table(spark):
    docs = documents(spark, [(1, "one")]).where(F.lit(False))
    assert alignment.alignments(docs, "doc_id", "text", A_FILE, B_FILE).count() == 0
