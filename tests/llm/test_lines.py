from cases import CLASHING, documents
from wickline.llm import lines, neardup


def slim(spark, rows, **options):
    got = lines.without_widespread_lines(documents(spark, rows, CLASHING), "doc_id", "text", "source", **options)
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_widespread, r.n_removed) for r in got.collect()), key=str)


def own(i):
    return f"own line {i} " + "z" * 80


def test_threshold_is_exact(spark):
    rows = []
    for sites in range(1, 9):
        rows += [(100 * sites + s, f"{own((sites, s))}\n  line on {sites} sites\t", f"s{s}") for s in range(sites)]
    for doc, text, n, wide, removed in slim(spark, rows):
        sites = doc // 100
        assert n == 2 and wide == removed == (sites >= lines.MIN_SITES)
        assert text == own((sites, doc % 100)) + ("" if sites >= lines.MIN_SITES else f"\n  line on {sites} sites\t")


def test_every_threshold_against_counts(spark):
    rows = [(s, "\n".join([own(s)] + [f"line {k}" for k in range(40) if s < k]), f"s{s}") for s in range(40)]
    for least in (1, 3, 17, 36):
        for doc, text, _, wide, _ in slim(spark, rows, min_sites=least, min_kept=10**6):
            # line k is on sites 0 .. k-1; a document's own line is on one
            assert wide == sum(doc < k and k >= least for k in range(40)) + (least <= 1)


def test_awkward_rows(spark):
    rows = [(i, f"{own(i)}\n\n \nfooter", f"s{i}") for i in range(6)]
    rows += [(None, f"{own(9)}\nfooter", None), (7, None, "s7"), (8, "", "s8"), (9, "footer\nfooter", "s9")]
    rows += [(1, f"{own(1)}\n\n \nfooter", "s1")] * 2
    got = slim(spark, rows)
    assert len(got) == len(rows)
    assert (None, own(9), 2, 1, 1) in got
    assert (7, None, 0, 0, 0) in got and (8, "", 1, 0, 0) in got
    # all lines of this one are widespread: it is left as it is
    assert (9, "footer\nfooter", 2, 2, 0) in got
    assert got.count((1, f"{own(1)}\n\n ", 4, 1, 1)) == 3


def test_null_sites_do_not_spread(spark):
    rows = [(i, f"{own(i)}\nnowhere", None) for i in range(20)]
    assert all(r[3] == 0 for r in slim(spark, rows))


def test_one_line_in_most_documents(spark):
    rows = [(i, f"{own(i)}\ncommon", f"s{i % 30}") for i in range(3000)]
    assert all(r[4] == 1 and r[1] == own(r[0]) for r in slim(spark, rows))


def test_long_text(spark):
    many = "\n".join(own(k) if k % 2 else "footer" for k in range(20_000))
    rows = [(i, f"{own(i)}\nfooter", f"s{i}") for i in range(6)] + [(99, many, "s0")]
    got = {r[0]: r for r in slim(spark, rows)}
    assert got[99][1:] == ("\n".join(own(k) for k in range(20_000) if k % 2), 20_000, 10_000, 10_000)


def test_empty(spark):
    assert slim(spark, []) == []


def test_no_python_in_the_plan(spark):
    df = lines.without_widespread_lines(documents(spark, [(1, "a", "b")]), "doc_id", "text", "source")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_short_documents_lose_a_planted_passage(spark):
    """A passage of 60 words in documents with few words of their own, at every place, on 5 and more sites."""
    passage = " ".join(f"passage{k}" for k in range(60))
    rows, want = [], {}
    for i in range(24):
        mine = [f"just {i}", f"words of {i}"]
        at = i % 3
        rows.append((i, "\n".join([*mine[:at], f" {passage}\t", "", *mine[at:]]), f"s{i % 6}"))
        want[i] = "\n".join([*mine[:at], "", *mine[at:]])
    for doc, text, n, wide, removed in slim(spark, rows):
        assert (text, n, wide, removed) == (want[doc], 4, 1, 1)


def test_short_documents_lose_header_and_footer(spark):
    head, foot = "header " * 20, ["footer " * 20, "imprint " * 20]
    rows = [(i, "\n".join([head, f"text {i}", *foot]), f"s{i % 7}") for i in range(21)]
    rows += [(100 + i, "\n".join([foot[1], f"text {i} after it"]), f"s{i}") for i in range(3)]
    for doc, text, _, wide, removed in slim(spark, rows):
        assert (text, removed) == (f"text {doc}" if doc < 100 else f"text {doc - 100} after it", wide)


def test_copies_keep_their_lines(spark):
    """Whole copies, copies with a changed line, with a line more, and with a footer."""
    lines_ = [f"line {k} of the text that is copied" for k in range(8)]
    rows = [(i, "\n".join(lines_), f"s{i % 6}") for i in range(6)]
    for i in range(6, 30):
        changed = [*lines_]
        changed[i % 8] = f"line {i % 8} of the text changed by {i}"
        rows.append((i, "\n".join(changed), f"s{i % 6}"))
    rows.append((30, "\n".join([*lines_, "a line more"]), "s1"))
    rows += [(40 + i, f"{own(40 + i)}\nfooter", f"s{i}") for i in range(6)]
    rows.append((50, "\n".join([lines_[0], "changed line", *lines_[2:], "footer"]), "s2"))
    texts = {r[0]: r[1] for r in rows}
    for doc, text, _, wide, removed in slim(spark, rows):
        if 40 <= doc < 50:
            assert (text, wide, removed) == (own(doc), 1, 1)
        else:
            assert (text, removed) == (texts[doc], 0) and wide >= 7


def test_own_columns_of_any_name_stay(spark):
    from pyspark.sql import functions as F

    names = ["_doc", "_text_key", "_hits", "_gone", "_parts", "_slim", "text_key", "__doc", "_listed"]
    docs = documents(spark, [(i, f"{own(i)}\nfooter", f"s{i}") for i in range(6)])
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.lit(i))
    got = lines.without_widespread_lines(docs, "doc_id", "text", "source")
    assert got.columns == [*docs.columns, "n_lines", "n_widespread", "n_removed"]
    assert {tuple(r) for r in got.select(*names).collect()} == {tuple(range(len(names)))}
    for stage in (lines.stage, neardup.stage):
        kept = stage(spark, docs, "")
        assert kept.columns == docs.columns
        assert {tuple(r) for r in kept.select(*names).collect()} == {tuple(range(len(names)))}
