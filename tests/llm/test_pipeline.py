"""The pipeline against plain Python, stage by stage on what the stage before kept."""

import base64
import hashlib
import importlib
import re
from collections import defaultdict
from itertools import groupby

import public_tokenizers
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from test_neardup import LOWER, brute
from wickline.llm import contamination, lines, toxicity
from wickline.llm.common import table

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def bound_sides(places):
    """{(line, side): whether the usual neighbour stands there, and so on outwards}."""
    usual = {}
    for key, found in places.items():
        total = sum(len(s) for s in found.values())
        best = [n for n, s in found.items() if 2 * len(s) > total and len(set(s) - {None}) >= lines.MIN_SITES]
        usual[key] = best
    bound = {key: bool(best) for key, best in usual.items()}
    for _ in range(lines.HOPS):
        bound = {(line, side): bool(usual[line, side]) and bound.get((usual[line, side][0], side), True)
                 for line, side in usual}
    return bound


def without_boilerplate(docs):
    sites, places = defaultdict(set), defaultdict(lambda: defaultdict(list))
    bare = [[(i, x.strip(lines.BLANKS)) for i, x in enumerate(text.split("\n")) if x.strip(lines.BLANKS)]
            for _, text, _ in docs]
    for own, (_, _, source) in zip(bare, docs):
        for _, line in own:
            sites[line] |= {source} - {None}
    wide = {line for line, s in sites.items() if len(s) >= lines.MIN_SITES}
    for own, (_, _, source) in zip(bare, docs):
        for k, (_, line) in enumerate(own):
            if line in wide:
                places[line, 0][own[k - 1][1] if k else None].append(source)
                places[line, 1][own[k + 1][1] if k + 1 < len(own) else None].append(source)
    bound = bound_sides(places)
    out = []
    for own, (doc, text, source) in zip(bare, docs):
        gone = {i for i, line in own if line in wide}
        slim = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
        total = copied = 0
        for inside, run in groupby(own, lambda x: x[1] in wide):
            if inside:
                run = [line for _, line in run]
                size = sum(len(x.encode()) for x in run)
                total += size
                copied += size * (bound[run[0], 0] and bound[run[-1], 1])
        little = len(slim.encode()) * lines.MIN_KEPT < len(text.encode())
        copy = not any(c.isalpha() or c.isnumeric() for c in slim) or 2 * copied > total
        out.append((doc, text if little and copy else slim, source))
    return out


def words(text):
    return WORD.findall(text.encode().translate(LOWER))


def uncontaminated(docs, items):
    windows = set()
    for item in items:
        own = words(item)
        n = min(13, len(own))
        windows |= {tuple(own[i : i + n]) for i in range(len(own) - n + 1) if n}
    sizes = {len(w) for w in windows}
    out = []
    for doc in docs:
        own = words(doc[1])
        hit = {p for n in sizes for i in range(len(own) - n + 1) if tuple(own[i : i + n]) in windows
               for p in range(i, i + n)}
        if not hit or 20 * len(hit) < len(own):
            out.append(doc)
    return out


def test_pipeline(spark):
    docs = table(spark, FOLDER, "documents")
    judged = toxicity.toxicity(docs, "doc_id", "text", table(spark, FOLDER, "labels"), "doc_id", "toxic")
    toxic = {r.doc_id for r in judged.where("predicted = 1").collect()}
    rows = [(r.doc_id, r.text or "", r.source) for r in docs.collect() if r.doc_id not in toxic]
    rows = without_boilerplate(rows)
    kept = {doc for doc, n, component in brute([(d, t) for d, t, _ in rows]) if n == 0 or doc == component}
    rows = [r for r in rows if r[0] in kept]
    rows = uncontaminated(rows, [r.text or "" for r in table(spark, FOLDER, "benchmark").collect()])
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for doc, text, _ in rows:
        ids = library.encode_ordinary(text)
        want.append((doc, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    assert 0 < len(want) < docs.count()
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(want)


def test_stages_keep_the_columns(spark):
    docs = table(spark, FOLDER, "documents").limit(0)
    for _, function in corpus_pipeline.STAGES[:-1]:
        assert function(spark, docs, FOLDER).columns == docs.columns


def test_entry_without_the_operators(monkeypatch):
    """The other queries stay when the subpackage is gone."""
    monkeypatch.setattr("importlib.util.find_spec", lambda name: None)
    from wickline.registry import book

    with monkeypatch.context() as patched:
        patched.setattr(book, "QUERIES", {k: v for k, v in book.QUERIES.items() if not (k.startswith("op") and k[2].isdigit()) and k != "pipeline"})
        patched.setattr(book, "CHECKS", {})
        again = importlib.reload(entry)
        assert "daily_indicators" in again.queries() and not any(k.startswith("op1") for k in again.queries())
    monkeypatch.undo()
    assert "op1_quality" in importlib.reload(entry).queries()


def test_contamination_rule_of_the_stage():
    assert (contamination.WINDOW, contamination.SHARE) == (13, 20)
