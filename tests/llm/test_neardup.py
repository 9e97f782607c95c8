import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
from cases import CLASHING, documents, prose
from wickline.llm import neardup
from wickline.llm.common import word_hashes

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    holders, parent = defaultdict(list), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, own in enumerate(sets):
        shared = Counter(j for s in own for j in holders[s])
        for j, n in shared.items():
            if 100 * n >= 75 * (len(own) + len(sets[j]) - n):
                parent[find(i)] = find(j)
        for s in own:
            holders[s].append(i)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), least.get(find(i)) if sets[i] else r[0]) for i, r in enumerate(rows)), key=str)


def check(spark, rows, **options):
    got = neardup.near_duplicates(documents(spark, rows, CLASHING), "doc_id", "text", **options)
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=str) == brute(rows)


def edited(pick, text, changes):
    words = text.split()
    for _ in range(changes):
        words[pick.randrange(len(words))] = f"x{pick.randrange(10**6)}"
    return " ".join(words)


def families(seed, count, first):
    """Sets at and around the threshold."""
    pick, rows = random.Random(seed), []
    for family in range(count):
        base = prose(1000 * seed + family, pick.choice([8, 30, 60, 120]))
        rows += [(first + len(rows), edited(pick, base, pick.randrange(0, 4))) for _ in range(pick.randrange(1, 8))]
    return rows


def chain():
    """Windows sliding over one text: neighbours link, distant ones do not; all are one component."""
    words = prose(3, 400).split()
    rows = [(5000 + i, " ".join(words[3 * i : 3 * i + 60])) for i in range(110)]
    random.Random(2).shuffle(rows)
    return rows


def passage():
    """A passage that many documents share links nothing; a few are copies with one word more."""
    shared = prose(7, 60)
    rows = [(6000 + i, f"{prose(100 + i, 25)} {shared}") for i in range(120)]
    return rows + [(6200 + i, f"{rows[i][1]} end") for i in range(10)]


def crowd():
    """Many near copies and exact copies of one text, and outliers beyond the threshold."""
    pick, base = random.Random(4), prose(9, 80)
    rows = [(7000 + i, edited(pick, base, pick.randrange(0, 3))) for i in range(300)]
    return rows + [(8000 + i, edited(pick, base, 9)) for i in range(20)] + [(9000 + i, base) for i in range(50)]


def awkward():
    text = prose(5, 40)
    return [(None, text), (None, text), (1, None), (2, ""), (2, " \t\n"), (3, "One"), (4, "one"), (5, "one two"),
            (6, text.upper()), (6, text.upper()), (7, "a b c d e"), (8, "a b c d"), (9, prose(6, 30_000)),
            (10, prose(6, 30_000) + " more"), (None, prose(8, 10)), (11, "é b c d e f"), (12, "É b c d e f")]


def test_against_brute_force(spark):
    check(spark, families(1, 25, 100) + chain() + passage() + crowd() + awkward())


def test_small_filters_change_nothing(spark):
    """Filters too small for the frequent shingles, and parts that know nothing."""
    check(spark, families(2, 20, 0) + passage(), filter_bits=(9, 9, 9))


def test_nothing(spark):
    check(spark, [])


def test_components(spark):
    pick = random.Random(6)
    links = [(pick.randrange(300), pick.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    got = dict(map(tuple, neardup.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    parent = {}
    for a, b in links:
        for x in (a, b):
            parent.setdefault(x, x)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    own = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in parent if x not in own}


def test_stage_keeps_one_of_each_group(spark):
    text = prose(1, 40)
    rows = [(3, text), (2, text + " end"), (2, text + " end"), (9, prose(2, 30)), (4, None), (4, None), (5, "")]
    docs = documents(spark, rows)
    kept = neardup.stage(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == [
        (2, text + " end"), (4, ""), (4, ""), (5, ""), (9, prose(2, 30))]


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "jaccard_join", "decontamination", "bpe"]


def test_words_of_one_polynomial_hash(spark):
    words = ["".join("ab"[(bin(i).count("1") + k) % 2] for i in range(1024)) for k in (0, 1)]
    rows = [(1, words[0]), (2, words[1]), (3, " ".join([words[0]] * 2)), (4, " ".join([words[1]] * 2))]
    check(spark, rows)


def test_word_hashes_read_every_byte():
    pick = random.Random(8)
    words = sorted({bytes(pick.randrange(97, 100) for _ in range(pick.randrange(1, 30))) for _ in range(4000)})
    words += [bytes(n) for n in range(1, 40)]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    whole = word_hashes(data, starts, ends)
    assert len(set(whole.tolist())) == len(words)
    alone = [word_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0] for w in words]
    assert whole.tolist() == [int(h) for h in alone]


def template(count, shared, size, first):
    """Documents of ``size`` words' shingles, of which all share the same ``shared``."""
    body = " ".join(f"t{i}" for i in range(shared))
    return [(first + d, body + "".join(f" d{d}x{i}" for i in range(size - shared))) for d in range(count)]


def test_templates_below_the_threshold(spark):
    """Classes of size and place that cannot be similar are not paired at all."""
    rows = template(400, 88, 104, 0) + template(30, 95, 104, 1000) + families(9, 3, 2000)
    check(spark, rows)


def test_classes_of_groups_are_paired_not_their_members(spark):
    index = spark.createDataFrame([(1, 16, 100, i) for i in range(50)] + [(2, 0, 100, 0), (2, 0, 100, 1)],
                                  "shingle bigint, place int, n bigint, leader bigint")
    nodes = spark.createDataFrame([(i, i, i) for i in range(50)], "leader bigint, node bigint, component bigint")
    assert [tuple(r) for r in neardup._cross_pairs(index, nodes).collect()] == [(0, 1)]
