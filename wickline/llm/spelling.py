"""Spelling variants: PartEnum signatures over letter multisets, an equi-join of them, and a check of each pair.

A word is the binary vector of its letter multiset. One replaced letter changes two places of it, one
inserted or deleted letter changes one. The letters are partitioned into a few parts; vectors at distance d
differ in at most d parts, so they agree on all the others. Signatures enumerate which d parts are left out.

The first level of the partition are the two halves of the word: one edit leaves a half as it is, which is
part of the signature, and the multiset is that of the other half. Signatures are equal only for words of
one length (d = 2), or of lengths one apart (d = 1). So buckets stay small, and no pair is lost.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.llm.common import table
from wickline.session import staged

RUN = r"[a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DROP = 97
MIN_LENGTH = 5
MIN_COUNT = 3
DOMINANCE = 2
# Parts of the alphabet for words of one length and of lengths one apart.
SAME_PARTS, NEXT_PARTS = 4, 2


def written_words(df: DataFrame, doc: str, text: str, drop: int = DROP) -> DataFrame:
    """(word): every run of letters of every text, A-Z in lower case, longer than ``MIN_LENGTH`` or as long.

    Of a run whose crc32 with its document is divisible by ``drop``, one letter is deleted. NULL texts
    have no runs; a NULL document counts as an empty id.
    """
    body = F.translate(F.col(text), UPPER, LOWER)
    runs = df.select(F.coalesce(F.col(doc).cast("string"), F.lit("")).alias("_id"),
                     F.explode(F.regexp_extract_all(body, F.lit(RUN), F.lit(0))).alias("_run"))
    runs = runs.where(F.char_length("_run") >= MIN_LENGTH).withColumn(
        "_h", F.crc32(F.concat_ws(":", "_id", "_run").cast("binary")))
    at = F.pmod(F.col("_h"), F.char_length("_run")).cast("int")
    less = F.concat(F.substr("_run", F.lit(1), at), F.substr("_run", at + 2))
    return runs.select(F.when(F.col("_h") % drop == 0, less).otherwise(F.col("_run")).alias("word")).where(
        F.char_length("word") >= MIN_LENGTH)


def alphabet_parts(words: DataFrame, parts: int) -> list[str]:
    """The letters of ``words`` in ``parts`` parts of about equal weight; the alphabet bounds what is collected."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").agg(
        F.count("*").alias("n"))
    loads, out = [0] * parts, [""] * parts
    for letter, n in sorted(((r["letter"], r["n"]) for r in letters.collect()), key=lambda r: (-r[1], r[0])):
        lightest = loads.index(min(loads))
        loads[lightest] += n
        out[lightest] += letter
    return out


def _signatures(length: Column, parts: list[str], distance: int) -> Column:
    """array<bigint>: the signatures of ``word`` for pairs whose shorter word has ``length`` letters.

    Of such a pair at one edit, either the first ``length`` / 2 letters are the same, or the last others.
    """
    word = F.col("word")
    head = F.floor(length / 2).cast("int")
    size = F.char_length(word)
    tail = length - head
    sides = ((F.substr(word, F.lit(1), head), F.substr(word, head + 1)),
             (F.substr(word, size - tail + 1), F.substr(word, F.lit(1), size - tail)))
    out = []
    for side, (same, rest) in enumerate(sides):
        ordered = F.array_join(F.sort_array(F.split(rest, "")), "")
        held = []
        for part in parts:
            others = "".join(p for p in parts if p != part)
            held.append(F.translate(ordered, others, "") if others else ordered)
        for left_out in combinations(range(len(parts)), distance):
            number = side * 1000 + sum(1 << i for i in left_out)
            out.append(F.xxhash64(F.lit(number), length, same, *[h for i, h in enumerate(held) if i not in left_out]))
    return F.array(*out)


def near_words(words: DataFrame, same_parts: int = SAME_PARTS, next_parts: int = NEXT_PARTS) -> DataFrame:
    """(a, n_a, b, n_b): the pairs of distinct ``words`` (word, n) that differ by one letter inserted, deleted
    or replaced; each pair once."""
    size = F.char_length("word")
    whole, half = alphabet_parts(words, same_parts), alphabet_parts(words, next_parts)
    kinds = {"same": (size, whole, 2), "shorter": (size, half, 1), "longer": (size - 1, half, 1)}

    def rows(kind: str) -> DataFrame:
        # Staged, so that the joins know the size of the signatures, not of the words.
        signed = words.select("word", "n", _signatures(*kinds[kind]).alias("_keys"))
        return staged(signed.select(F.explode("_keys").alias("key"), "word", "n"), kind)

    def sides(a: DataFrame, b: DataFrame) -> DataFrame:
        return a.withColumnsRenamed({"word": "a", "n": "n_a"}).join(b.withColumnsRenamed({"word": "b", "n": "n_b"}), "key")

    same = rows("same")
    met = sides(same, same).where("a < b").unionByName(sides(rows("shorter"), rows("longer"))).where(
        F.levenshtein("a", "b", 1) == 1)
    return met.select("a", "n_a", "b", "n_b").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: the end of their chain, by pointer jumping; staged.

    Each step doubles the way; forms are ever more frequent, so a chain ends and has few links.
    """
    links = staged(forms.select("word", F.col("form").alias("root")), "links")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = staged(links.join(further, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "jump")
        if moved.where("_moved").isEmpty():
            return links
        links = moved.select("word", "root")


def variants(words: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each row of ``words`` (word, n), which is staged.

    ``form`` is the near word of largest n (ties: the smallest in code-point order) if its n is at least
    ``dominance`` times the word's, else NULL; ``root`` the last word on the way along forms. An empty
    table gives no rows.
    """
    pairs = staged(near_words(words), "pairs")
    both = pairs.selectExpr("a AS word", "b AS other", "n_b AS m").unionByName(
        pairs.selectExpr("b AS word", "a AS other", "n_a AS m"))
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), F.col("other"))).alias("best"))
    leads = -F.col("best.less") >= dominance * F.col("n")
    formed = staged(words.join(best, "word", "left").select(
        "word", F.when(leads, F.col("best.other")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(leads, -F.col("best.less")).alias("form_n")), "formed")
    ends = roots(formed.where("form IS NOT NULL"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(df: DataFrame, doc: str, text: str, min_count: int = MIN_COUNT) -> DataFrame:
    """The words of all texts that occur at least ``min_count`` times, with their spelling variants.

    See ``written_words`` and ``variants``. Only ``doc`` and ``text`` are read: nulls elsewhere and extra
    columns, whatever their names, play no part; repeated rows count as often as they occur.
    """
    rows = df.select(F.col(doc).alias("_doc"), F.col(text).alias("_text"))
    counts = written_words(rows, "_doc", "_text").groupBy("word").agg(F.count("*").alias("n"))
    return variants(staged(counts.where(F.col("n") >= min_count), "words"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents"), "doc_id", "text")


# One letter replaced: equal but for a blank at one place. One letter inserted: equal to the longer word
# without one of its letters. CRC-32 is a fold over the bytes, from a table of the reflected polynomial.
CHECK = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::UBIGINT, range(8)::UBIGINT[]),
      lambda c, s: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS v
    FROM range(256) r(i))),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS tagged, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) AS run
    FROM documents) WHERE length(run) >= {MIN_LENGTH} GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(4294967295::UBIGINT, list_reduce(
      list_prepend(4294967295::UBIGINT, list_transform(range(1, 2 * strlen(tagged) + 1, 2),
        lambda p: ('0x' || substr(hex(encode(tagged)), p::INT, 2))::UBIGINT)),
      lambda c, b: xor(c >> 8, t[((xor(c, b) & 255) + 1)::BIGINT])))::BIGINT AS h
  FROM runs, crc_table),
cut AS (
  SELECT n, CASE WHEN h % {DROP} = 0
    THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word
  FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= {MIN_LENGTH} GROUP BY word
  HAVING sum(n) >= {MIN_COUNT}),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
holes AS (SELECT word, n, i, substr(word, 1, i - 1) AS l, substr(word, i + 1) AS r FROM places),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM holes a JOIN holes b USING (i, l, r) WHERE a.word <> b.word
  UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON w.word = l || r
  UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON w.word = l || r),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS other, max(m) AS m FROM near GROUP BY word),
formed AS (
  SELECT w.word, CASE WHEN m >= {DOMINANCE} * n THEN other END AS form, n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN m >= {DOMINANCE} * n THEN m END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.root FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""
