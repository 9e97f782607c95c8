import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cases import CLASHING, documents
from pyspark.sql import functions as F
from wickline.llm import spelling


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[a-zÀ-ÿ]+", lower(text or "")):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1:]
            if len(run) >= 5:
                counts[run] += 1
    return grouped({w: n for w, n in counts.items() if n >= 3})


def grouped(counts):
    form, rows = {}, {}
    for w, n in counts.items():
        others = sorted((-m, v) for v, m in counts.items() if near(v, w))
        if others and -others[0][0] >= 2 * n:
            form[w] = others[0][1]
        rows[w] = len(others)
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, rows[w], counts[form[w]] if w in form else None))
    return sorted(out)


@pytest.fixture(scope="module")
def spark_words(spark):
    return lambda counts: spark.createDataFrame(list(counts.items()), "word string, n bigint")


def found(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_against_brute_force(spark):
    pick = random.Random(3)
    words = ["".join(pick.choice("abeéß") for _ in range(pick.randrange(3, 8))) for _ in range(150)]
    rows = [(i if i % 7 else None, " ".join(pick.choice(words) if pick.random() < 0.9 else pick.choice(words).upper()
                                            for _ in range(60))) for i in range(40)]
    rows += [(90, None), (91, ""), (92, "12 -- ?"), (93, "×÷×÷× " * 4), rows[0], rows[0]]
    assert found(spelling.spelling_variants(documents(spark, rows, CLASHING), "doc_id", "text")) == brute(rows)


def test_one_hot_word_and_long_words(spark):
    long = "abcdefghij" * 3000
    rows = [(i, f"common {'common ' * 300}commonn commonly {long} {long[:-1]}x") for i in range(12)]
    assert found(spelling.spelling_variants(documents(spark, rows), "doc_id", "text")) == brute(rows)


def test_chain_of_forms(spark):
    counts = {"aaaaa": 1, "aaaab": 2, "aaabb": 4, "aabbb": 8, "abbbb": 16, "bbbbb": 32, "bbbbbb": 64, "zzzzz": 9}
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert found(spelling.variants(words)) == grouped(counts)


@settings(max_examples=4, deadline=None)
@given(st.sets(st.text("abñ", min_size=5, max_size=8), min_size=2, max_size=30))
def test_no_pair_is_lost(spark_words, words):
    counts = {w: 1 + sum(map(ord, w)) % 5 for w in words}
    assert found(spelling.variants(spark_words(counts))) == grouped(counts)


def test_empty_table(spark):
    docs = documents(spark, [(1, "one")]).where(F.lit(False))
    assert spelling.spelling_variants(docs, "doc_id", "text").count() == 0


def test_signatures_are_small(spark):
    """The alphabet is dealt into parts of about equal weight, every letter once."""
    words = spark.createDataFrame([("eeeee",), ("abcde",), ("fghij",)], "word string")
    parts = spelling.alphabet_parts(words, 3)
    assert sorted("".join(parts)) == sorted("abcdefghij") and "e" in parts and len(parts) == 3
