"""Line deduplication across sites by distinct-site spread, in DataFrame functions alone.

One HyperLogLog sketch of the sites per line hash, merged by the aggregation. Lines whose estimate
is clearly above the threshold are boilerplate, clearly below are not; the lines in between get
exact distinct counts, so the decision is the exact one (the margin is many standard errors wide).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.llm.common import table, text_key, unused
from wickline.operators.keys import join_null_safe
from wickline.session import staged

MIN_SITES = 5
# Half-width of the band that is counted exactly, as a share of the threshold. The standard error
# of a sketch of 2^12 registers is 1.6 %.
MARGIN = 0.25
SKETCH_BITS = 12
# Documents of which removal would leave less than one part in this many of the bytes are tested for
# looking like copies, which are the business of document deduplication; those keep their lines.
MIN_KEPT = 2
BLANKS = " \t\r"
# Lines that are followed outwards from a line, to tell a block of boilerplate from a copied text.
HOPS = 3
WORD = r"[\p{L}\p{N}]"

_LINE = ["_h1", "_h2"]


def _lines(df: DataFrame, text: str, *keep: Column) -> DataFrame:
    """(keep..., _pos, _h1, _h2) of every line that is not blank; 128 bits tell lines apart."""
    rows = df.select(*keep, F.posexplode(F.split(F.col(text), "\n")).alias("_pos", "_line"))
    rows = rows.withColumn("_line", F.btrim("_line", F.lit(BLANKS))).where(F.col("_line") != "")
    return rows.withColumns({
        "_h1": F.xxhash64("_line"), "_h2": F.xxhash64("_line", F.lit(1))}).drop("_line")


def _lines_between(df: DataFrame, text: str, *keep: Column) -> DataFrame:
    """``_lines`` with ``_at`` (place among the lines that are not blank), ``_size`` in bytes, and the hashes
    ``_before`` and ``_after`` of the lines next to it that are not blank; NULL at the ends of the text."""
    places = F.transform(F.split(F.col(text), "\n"), lambda x, i: F.struct(
        i.alias("pos"), F.btrim(x, F.lit(BLANKS)).alias("line")))
    rows = df.select(*keep, F.filter(places, lambda x: x["line"] != "").alias("_full"))
    rows = rows.withColumn("_hashes", F.transform("_full", lambda x: F.xxhash64(x["line"])))
    # The shifted arrays are zipped, so that a long text costs no look-up by place.
    zipped = F.arrays_zip(
        F.col("_full").alias("full"),
        F.concat(F.array(F.lit(None).cast("bigint")), F.col("_hashes")).alias("before"),
        F.slice("_hashes", 2, F.size("_hashes")).alias("after"))
    rows = rows.select(*[c for c in rows.columns if c not in ("_full", "_hashes")],
                       F.posexplode(zipped).alias("_at", "_one")).where("_one.full IS NOT NULL")
    line = F.col("_one")["full"]["line"]
    return rows.withColumns({
        "_pos": F.col("_one")["full"]["pos"], "_h1": F.xxhash64(line), "_h2": F.xxhash64(line, F.lit(1)),
        "_size": F.octet_length(line), "_before": F.col("_one")["before"], "_after": F.col("_one")["after"],
    }).drop("_one")


def _bound(hits: DataFrame, min_sites: int) -> DataFrame:
    """(_h1, _h2, _bound_before, _bound_after) per line of ``hits``; staged.

    A side is bound when one and the same neighbour (a line, or the end of the text) stands there in more
    than half of the line's places, and on at least ``min_sites`` sites, and the neighbour's side is bound
    too, as far as ``HOPS`` neighbours.
    """
    sides = hits.select(*_LINE, "_site", F.explode(F.array(
        F.struct(F.lit(True).alias("first"), F.col("_before").alias("next")),
        F.struct(F.lit(False).alias("first"), F.col("_after").alias("next")))).alias("_side"))
    sides = sides.select(*_LINE, "_site", "_side.first", "_side.next")
    # Rows of one frequent line meet only in counts: by site and neighbour, by neighbour, by line.
    by_site = sides.groupBy(*_LINE, "first", "next", "_site").agg(F.count("*").alias("n"))
    by_next = by_site.groupBy(*_LINE, "first", "next").agg(
        F.sum("n").alias("n"), F.count("_site").alias("sites"))
    # (place count, neighbour) of the neighbour met most; ``next`` is NULL at the ends of the text.
    usual = F.max(F.when(F.col("sites") >= min_sites, F.struct("n", "next")))
    by_side = by_next.groupBy(*_LINE, "first").agg(usual.alias("usual"), F.sum("n").alias("total"))
    by_side = staged(by_side.select(
        *_LINE, "first", F.coalesce(F.col("usual.n") * 2 > F.col("total"), F.lit(False)).alias("bound"),
        F.col("usual.next").alias("next")), "sides")
    # A line inside a block of boilerplate has the block around it: its side is bound only if the usual
    # neighbour's is, and so on.
    far = by_side
    for _ in range(HOPS):
        ends = far.groupBy(F.col("_h1").alias("next"), "first").agg(F.bool_and("bound").alias("_further"))
        far = by_side.join(ends, ["next", "first"], "left").select(
            *_LINE, "first", (F.col("bound") & F.coalesce("_further", F.lit(True))).alias("bound"))
    return staged(far.groupBy(*_LINE).agg(
        F.bool_or(F.col("first") & F.col("bound")).alias("_bound_before"),
        F.bool_or(~F.col("first") & F.col("bound")).alias("_bound_after")), "bound")


def _bound_bytes(hits: Column) -> Column:
    """Bytes of the runs of widespread lines whose both ends are bound; ``hits`` is sorted by place."""
    start = F.struct(F.lit(0).cast("bigint").alias("done"), F.lit(0).cast("bigint").alias("run"),
                     F.lit(False).alias("whole"), F.lit(-2).alias("at"), F.lit(False).alias("after"))

    def closed(s: Column) -> Column:
        return s["done"] + F.when(s["whole"] & s["after"], s["run"]).otherwise(0)

    def step(s: Column, hit: Column) -> Column:
        goes_on = hit["at"] == s["at"] + 1
        size = hit["size"].cast("bigint")
        return F.struct(
            F.when(goes_on, s["done"]).otherwise(closed(s)).alias("done"),
            F.when(goes_on, s["run"] + size).otherwise(size).alias("run"),
            F.when(goes_on, s["whole"]).otherwise(hit["before"]).alias("whole"),
            hit["at"].alias("at"), hit["after"].alias("after"))

    return F.aggregate(hits, start, step, closed)


def widespread_lines(
    df: DataFrame, text: str, site: str, min_sites: int = MIN_SITES, margin: float = MARGIN
) -> DataFrame:
    """Hashes of the lines found on at least ``min_sites`` distinct sites; staged. NULL sites do not count."""
    lines = _lines(df.where(F.col(site).isNotNull()), text, F.col(site).alias("_site"))
    sketches = lines.groupBy(*_LINE).agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("_site", F.lit(SKETCH_BITS))).alias("_sites"))
    likely = staged(sketches.where(F.col("_sites") >= min_sites * (1 - margin)), "spread")
    sure = F.col("_sites") >= min_sites * (1 + margin)
    # Rows of one line first shrink to its distinct sites, before and after the shuffle.
    near = lines.join(likely.where(~sure).select(*_LINE), _LINE, "left_semi")
    exact = near.groupBy(*_LINE, "_site").agg(F.lit(1).alias("_one")).groupBy(*_LINE).agg(
        F.count("*").alias("_sites"))
    found = likely.where(sure).select(*_LINE).unionByName(
        exact.where(F.col("_sites") >= min_sites).select(*_LINE))
    return staged(found, "widespread")


def without_widespread_lines(
    df: DataFrame, doc: str, text: str, site: str, min_sites: int = MIN_SITES, min_kept: int = MIN_KEPT
) -> DataFrame:
    """``df`` with boilerplate lines taken out of ``text``, and three counts added.

    ``n_lines``: lines of the text, blank ones too (0 for NULL); ``n_widespread``: those on at least
    ``min_sites`` sites; ``n_removed``: those taken out, which is ``n_widespread`` or 0. Lines are
    compared without blanks at their ends; blank lines stay. NULL texts stay NULL, NULL documents and
    repeated rows are treated as rows of their own text, NULL sites spread nothing. An empty table
    gives no rows. All other columns are kept. The rows of one frequent line
    meet only in sketches, in counts and in sets of sites.

    A document keeps all its lines if less than one part in ``min_kept`` of its bytes would be left, and it
    looks like a copy of a document that spread as a whole: no word would be left, or more than half of the
    bytes of its widespread lines are in runs that are bound at both ends, as ``_bound`` says. Boilerplate
    stands among other lines in each document; the lines of a copy have the same ones around them elsewhere.
    Texts are not compared: of equal texts with half or more of their bytes their own, all lose the lines
    that are boilerplate in them. Every other document loses its widespread lines.

    The columns ``n_lines``, ``n_widespread`` and ``n_removed`` of ``df``, if there are any, are replaced.
    """
    boiler = widespread_lines(df, text, site, min_sites)
    d, k, h, g, p, s = unused(df, "_doc", "_text_key", "_hits", "_gone", "_parts", "_slim")
    keyed = df.withColumns({d: F.col(doc), k: text_key(F.col(text))})
    hits = staged(_lines_between(
        keyed, text, F.col(d), F.col(k), F.col(site).alias("_site")
    ).join(boiler, _LINE, "left_semi"), "hits")
    placed = hits.join(_bound(hits, min_sites), _LINE)
    gone = placed.groupBy(d, k).agg(F.collect_set(F.struct(
        F.col("_at").alias("at"), F.col("_pos").alias("pos"), F.col("_size").alias("size"),
        F.col("_bound_before").alias("before"), F.col("_bound_after").alias("after"))).alias(h))
    gone = gone.withColumn(h, F.array_sort(h)).withColumn(g, F.col(h)["pos"])
    marked = join_null_safe(keyed, gone, [d, k], "left")
    marked = marked.withColumn(p, F.split(F.col(text), "\n"))
    places = F.array_except(F.sequence(F.lit(0), F.size(p) - 1), g)
    slim = F.array_join(F.transform(places, lambda i: F.get(F.col(p), i)), "\n")
    marked = marked.withColumn(s, F.when(F.col(g).isNotNull(), slim))
    little = F.octet_length(s) * min_kept < F.octet_length(text)
    wide = F.aggregate(h, F.lit(0).cast("bigint"), lambda n, hit: n + hit["size"])
    copy = ~F.col(s).rlike(WORD) | (_bound_bytes(F.col(h)) * 2 > wide)
    removes = F.col(g).isNotNull() & ~F.when(little, copy).otherwise(False)
    spread = F.when(F.col(g).isNull(), 0).otherwise(F.size(g))
    return marked.withColumns({
        "n_lines": F.when(F.col(text).isNull(), 0).otherwise(F.size(p)).cast("bigint"),
        "n_widespread": spread.cast("bigint"),
        "n_removed": F.when(removes, F.size(g)).otherwise(0).cast("bigint"),
        text: F.when(removes, F.col(s)).otherwise(F.col(text)),
    }).drop(d, k, g, h, p, s)


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    columns = docs.columns
    slim = without_widespread_lines(docs, "doc_id", "text", "source")
    return slim.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*columns)


def query(spark: SparkSession, folder: str) -> DataFrame:
    slim = without_widespread_lines(table(spark, folder, "documents"), "doc_id", "text", "source")
    return slim.select("doc_id", "n_lines", "n_widespread", "n_removed",
                       F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def _far_side(hop: int) -> str:
    """A side is bound as far as one neighbour more: so is the usual neighbour's, if that is widespread."""
    return f"""
far{hop} AS (
  SELECT s.bare, s.ahead, s.next, s.bound AND coalesce(f.bound, true) AS bound
  FROM sides s LEFT JOIN far{hop - 1} f ON f.bare = s.next AND f.ahead = s.ahead),"""


CHECK = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, source, text FROM documents),
pieces AS (
  SELECT rid, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM docs WHERE text IS NOT NULL),
trimmed AS (SELECT *, trim(line, concat(' ', chr(9), chr(13))) AS bare FROM pieces),
wide AS (
  SELECT bare FROM trimmed WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT source) >= {MIN_SITES}),
marked AS (SELECT t.*, bare IN (FROM wide) AS gone FROM trimmed t),
inked AS (
  SELECT rid, source, pos, bare, gone, row_number() OVER w AS place, lag(bare) OVER w AS before, lead(bare) OVER w AS after
  FROM marked WHERE bare <> '' WINDOW w AS (PARTITION BY rid ORDER BY pos)),
hits AS (FROM inked WHERE gone),
ends AS (
  SELECT bare, true AS ahead, before AS next, source FROM hits
  UNION ALL SELECT bare, false, after, source FROM hits),
nexts AS (SELECT bare, ahead, next, count(*) AS n, count(DISTINCT source) AS sites FROM ends GROUP BY ALL),
totals AS (SELECT bare, ahead, sum(n) AS total FROM nexts GROUP BY ALL),
sides AS (
  SELECT t.bare, t.ahead, n.next, n.n IS NOT NULL AS bound FROM totals t LEFT JOIN nexts n
  ON n.bare = t.bare AND n.ahead = t.ahead AND n.sites >= {MIN_SITES} AND 2 * n.n > t.total),
far0 AS (FROM sides),{"".join(_far_side(i) for i in range(1, HOPS + 1))}
bound AS (
  SELECT bare, bool_or(ahead AND bound) AS before, bool_or(NOT ahead AND bound) AS after FROM far{HOPS} GROUP BY bare),
runs AS (
  SELECT rid, place - row_number() OVER (PARTITION BY rid ORDER BY place) AS run, place, strlen(h.bare) AS size,
    b.before, b.after
  FROM hits h JOIN bound b ON b.bare = h.bare),
whole AS (
  SELECT rid, sum(size) AS size, CASE WHEN first(before ORDER BY place) AND last(after ORDER BY place)
    THEN sum(size) ELSE 0 END AS copied
  FROM runs GROUP BY rid, run),
shares AS (SELECT rid, sum(size) AS size, sum(copied) AS copied FROM whole GROUP BY rid),
rebuilt AS (
  SELECT rid, count(*) AS n_lines, count(*) FILTER (gone) AS n_widespread,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS slim
  FROM marked GROUP BY rid),
judged AS (
  SELECT d.doc_id, d.text, r.*, n_widespread > 0 AND NOT (strlen(slim) * {MIN_KEPT} < strlen(d.text)
    AND (NOT regexp_matches(slim, '{WORD}') OR 2 * copied > size)) AS removes
  FROM docs d LEFT JOIN rebuilt r USING (rid) LEFT JOIN shares USING (rid))
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_widespread, 0)::BIGINT AS n_widespread,
  CASE WHEN removes THEN n_widespread ELSE 0 END::BIGINT AS n_removed,
  sha256(CASE WHEN removes THEN slim ELSE text END) AS text_sha256
FROM judged
"""
