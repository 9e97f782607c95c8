import math
import random
import re
import time
from collections import Counter
from itertools import accumulate

from cases import CLASHING, documents
from pyspark.sql import functions as F
from wickline.llm import secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    return found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]


def entropy(window):
    return math.log2(len(window)) - sum(c * math.log2(c) for c in Counter(window).values()) / len(window)


def harmless(text):
    """Places that no window may touch: character by character, without regular expressions for paths."""
    gone, spans = set(), []
    for m in re.finditer(secrets.LONG, text):
        run, before = m[0], text[max(0, m.start() - 8):m.start()]
        if re.search(secrets.UUID, run) or re.search(secrets.DIGEST, run) or re.search(
                secrets.DIGEST_BEFORE, before if m.start() >= 8 else text[:m.start()]):
            gone |= set(range(m.start(), m.end()))
            spans.append((m.start(), " " * len(run)))
            continue
        rooted = run.startswith("/")
        parts = run[rooted:].split("/")
        good = next((i for i, x in enumerate(parts) if not wordlike(x)), len(parts))
        size = 0
        if "/" in run and min(good, len(parts) - 1) >= 2:
            size = rooted + sum(len(x) + 1 for x in parts[:good])
            size -= good == len(parts)
        gone |= set(range(m.start(), m.start() + size))
        spans.append((m.start(), " " * size + run[size:]))
    out = list(text)
    for start, value in spans:
        out[start:start + len(value)] = value
    for m in re.finditer("(?i:example|placeholder|changeme|x{4,}|abcdefghij|0123456789)", "".join(out), re.A):
        gone |= set(range(m.start(), m.end()))
    return gone


def wordlike(segment):
    word = "(?:[A-Z]?[a-z]{2,}+|[A-Z]{2,}+|[0-9]++)"
    return re.fullmatch(f"{word}(?:[_-]?{word})*+", segment) is not None


def added(text):
    out, w = [], secrets.WINDOW
    gone = harmless(text)
    clear = "".join(" " if i in gone else c for i, c in enumerate(text))
    for rank, one in enumerate(secrets.RUNS):
        for m in re.finditer(one.runs, clear):
            if all(re.search(t, m[0]) for t in one.tests):
                hot = [i for i in range(len(m[0]) - w + 1) if entropy(m[0][i : i + w]) >= one.bits - 1e-9]
                if hot:
                    out.append((m.start() + hot[0], m.start() + hot[-1] + w, rank))
    outer = [a for a in out if not any(
        b[2] != a[2] and b[0] <= a[0] and a[1] <= b[1] and (b[1] - b[0] > a[1] - a[0] or b[2] < a[2]) for b in out)]
    return [(a, secrets.KINDS.index(secrets.RUNS[k].kind), e) for a, e, k in outer
            if not any(x <= a and e <= y for x, _, y in base(text))]


def listed(found):
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def check(spark, texts):
    rows = list(enumerate(texts))
    got = secrets.scanned(documents(spark, rows, [*CLASHING, "base", "_body", "_masked", "_base"]), "text").collect()
    assert len(got) == len(texts) and all(r._body == r._masked == r._base == "own" for r in got)
    for r in got:
        text = texts[r.doc_id] or ""
        assert r.base == listed(base(text)), text
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == j for _, k, _ in base(text)) for j in range(3)]
        assert r.spans == listed(base(text) + added(text)), text


def test_against_python(spark):
    pick = random.Random(3)
    parts = ["password", "API_KEY", "apikey", "Token", "secret", ":", "=", " = ", "'", '"', "abcdefghijkl", "short",
             "AKIA", "AKIAABCDEFGHIJKLMN", "deadbeefdeadbeef", "0123456789abcde", "é", "🙂", "\n", " ", "token=secret=",
             "password: token: abcdefghijklmnopq", "Zx9", "aB3dE5gH7jK9lM1nO3pQ5", "ſecret=aaaaaaaaaaaaaa", "-", "/"]
    check(spark, ["".join(pick.choice(parts) for _ in range(pick.randrange(12))) for _ in range(600)])


def test_entropy(spark):
    pick = random.Random(4)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    texts = ["".join(pick.choice(b64) for _ in range(n)) for n in (19, 20, 21, 40, 400)]
    texts += ["x " + "".join(pick.choice("0123456789ABCDEF") for _ in range(n)) + " y" for n in (20, 64)]
    texts += ["aA1" * 30, "Aa1" * 10 + texts[3], "a8098c1a-f86e-11da-bd1a-00112444be1e", "thtionerwherblenttionandmore"]
    check(spark, texts)
    found = secrets.scanned(documents(spark, list(enumerate(texts))), "text").collect()
    assert any("entropy_base64" in r.spans for r in found) and any("entropy_hex" in r.spans for r in found)
    assert all(not r.spans for r in found if "-f86e-" in r.text or r.text == "aA1" * 30)


def test_awkward_rows(spark):
    check(spark, [None, "", " ", "x" * 300_000, "token=" + "q" * 100_000])
    assert secrets.scanned(documents(spark, []), "text").count() == 0
    twice = documents(spark, [(None, "AKIAABCDEFGHIJKLMN")] * 2)
    assert [r.spans for r in secrets.scanned(twice, "text").collect()] == ["access:0:18"] * 2


def test_no_python_in_the_plan(spark):
    plan = secrets.scanned(documents(spark, [(1, "a")]), "text")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def spans_of(spark, texts):
    rows = secrets.scanned(documents(spark, list(enumerate(texts))), "text").collect()
    return [r.spans for r in sorted(rows, key=lambda r: r.doc_id)]


B64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def test_long_keys_with_slashes_are_found(spark):
    pick = random.Random(5)
    texts = ["x " + "".join(pick.choice(B64) for _ in range(n)) + " y" for n in (128, 256, 512, 1024) for _ in range(25)]
    assert sum("entropy_base64" in s for s in spans_of(spark, texts)) == len(texts)
    # a placeholder inside hides only the windows that touch it
    long = "".join(pick.choice(B64[:62]) for _ in range(200))
    for word in ("example", "xxxx", "0123456789"):
        found = spans_of(spark, [long[:100] + word + long[100:]])[0]
        ends = [tuple(map(int, x.split(":")[1:])) for x in found.split(",") if x.startswith("entropy_base64")]
        assert len(ends) == 2 and ends[0][0] < 20 and ends[0][1] <= 100 and 100 + len(word) <= ends[1][0]


def test_keys_glued_to_names_are_found(spark):
    pick = random.Random(6)
    upper = ["".join(pick.choice("0123456789ABCDEF") for _ in range(40)) for _ in range(40)]
    seeds = ["".join(pick.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(40)) for _ in range(40)]
    texts = [f"{name}{x}" for x in upper for name in ("key=", "id_", "ID=", "a-")]
    for text, found in zip(texts, spans_of(spark, texts)):
        assert "entropy_hex" in found, text
    # by chance, no window of one in several thousand seeds of 40 characters reaches 3.5 bits
    assert sum("entropy_base32:" in s for s in spans_of(spark, [f"ID={x}" for x in seeds])) >= 39


def test_what_is_no_secret_by_runs(spark):
    texts = ["/usr/local/share/Python3/site-packages/numpy/Core2", "src/main/java/com/acme/FooBarTest2/Quick17",
             "id=a8098C1A-f86e-11da-bd1a-00112444be1e", "thtionerwherblenttionandmore", "aA1" * 30, "x" * 300_000 + "A1",
             "sha256-47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU=", "A1b" + "Ab" * 60_000, "", None]
    assert spans_of(spark, texts) == [""] * len(texts)
    key = "q8Zt1Lw7Vx3Rk9Pd5Ns2Hf6Jc4Gb0"
    assert spans_of(spark, ["/usr/local/share/" + key])[0].startswith("entropy_base64:")
    assert spans_of(spark, ["AKIAABCDEFGHIJKLMN"]) == ["access:0:18"]


def test_harmless_places_against_python(spark):
    pick = random.Random(12)
    parts = ["/usr", "/local", "share/", "Core2", "a8098c1a-f86e-11da-bd1a-00112444be1e", "sha256-", "sha512=", "SHA1_", "=",
             " ", "q8Zt1Lw7Vx3Rk9Pd5Ns2Hf6Jc4Gb0", "9F3A77C0D1E2B4A6958877665544332211FFEEDD", "example", "xxxxx", "/", "-", "_",
             "+", "0123456789", "Ab", "A", "b", "GEZDGNBVGY3TQOJQGEZDGNBVGY3TQOJQ", "é"]
    check(spark, ["".join(pick.choice(parts) for _ in range(pick.randrange(1, 14))) for _ in range(800)])


def test_running_results(spark):
    """Sums and maxima over blocks are those of one pass."""
    pick = random.Random(13)
    rows = [([pick.randrange(100) for _ in range(n)],) for n in (0, 1, 127, 128, 129, 1000)]
    df = spark.createDataFrame(rows, "v array<int>")
    got = df.select("v", secrets._running(F.col("v"), "int", lambda a, b: a + b).alias("s"),
                    secrets._running(F.col("v"), "int", F.greatest).alias("m")).collect()
    for r in got:
        assert r.s == list(accumulate(r.v)) and r.m == list(accumulate(r.v, max))


def test_matches_cost_linear_time(spark):
    """Four times the matches of one text take a few times as long, not sixteen."""
    pick = random.Random(14)

    def seconds(n):
        text = " ".join("".join(pick.choice("0123456789abcdef") for _ in range(24)) for _ in range(n))
        began = time.monotonic()
        row = secrets.scanned(documents(spark, [(1, text)]), "text").collect()[0]
        assert row.n_hex >= n * 0.99
        return time.monotonic() - began

    seconds(100)
    small, large = seconds(4000), seconds(16000)
    assert large < 9 * small + 5
