"""Secret scan: three patterns, and sliding-window Shannon entropy over candidate strings.

Everything is a column expression. Positions come from the pieces between the matches of a pattern:
a match starts after all earlier pieces and matches. A window's entropy is kept up by incremental
counts: one character enters, one leaves, and the sum of c * log2(c) changes by two table entries.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.llm.common import table, unused

ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
# The length rules of these two are in the pattern: a run is taken whole, from its first place.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LENGTH = 12

WINDOW = 20
# Entropy per character is summed in integers, so that adding and removing cancel exactly.
UNITS = 1_000_000
# The characters of all classes lie within FIRST and the SLOTS after it. Their counts, at most WINDOW each,
# are packed into 64-bit words of PACKED counts.
FIRST, SLOTS = ord("+"), ord("z") - ord("+") + 1
COUNT_BITS, PACKED = 5, 12
# Arrays are added up in blocks of this many elements, so that no step copies more.
BLOCK = 128


@dataclass(frozen=True)
class CharacterClass:
    """A class of characters, the tests that its runs must meet (words lack them), and the bits per character
    from which a window counts as random."""

    kind: str
    letters: str
    tests: tuple[str, ...]
    bits: float

    @property
    def runs(self) -> str:
        return "|".join(f"[{x}]{{{WINDOW},}}" for x in self.letters.split())


# Each class has its own maximal runs, so a name glued to a key does not choose the class of the key. Several
# classes may have a run at one place: the first kind that fits counts.
RUNS = (
    CharacterClass("entropy_hex", "0-9A-Fa-f", ("[0-9]", "[A-Fa-f]"), 3.1),
    CharacterClass("entropy_base32", "A-Z0-9 a-z0-9", ("[0-9]", "[A-Za-z]", "[G-Zg-z]"), 3.5),
    CharacterClass("entropy_base64", "A-Za-z0-9+/_-", ("[0-9]", "[a-z]", "[A-Z]"), 3.9),
)
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64", "entropy_base32")
# What is known not to be secret: windows that touch it are left out, and no others. A long run is harmless
# as a whole if it is a UUID or a named digest; of a path, its leading segments that are made of words are.
LONG = rf"[A-Za-z0-9+/_-]{{{WINDOW},}}"
UUID = r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$"
DIGEST = r"^(?i:sha(1|256|384|512))[_-]"
DIGEST_BEFORE = r"(^|[^A-Za-z0-9+/_-])(?i:sha(1|256|384|512))=$"
PLACEHOLDER = r"(?i)example|placeholder|changeme|x{4,}|abcdefghij|0123456789"
# A segment is no sequence of words and numbers: empty, a plus, a sign at an end or two together, a small
# letter alone, a capital that begins no word.
NO_WORDS = (r"^$|[+]|^[_-]|[_-]$|[_-][_-]|(^|[^a-z])[a-z]([^a-z]|$)|(^|[^A-Z])[A-Z]([^A-Za-z]|$)")
SEGMENTS = 2


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` made once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(values: Column, kind: str, join: Callable[[Column, Column], Column]) -> Column:
    """The running ``join`` of an array, block by block: results inside the blocks, then what is before each."""
    none = F.array().cast(f"array<{kind}>")
    zero = F.lit(0).cast(kind)

    def inside(block: Column) -> Column:
        def step(s: Column, v: Column) -> Column:
            return _with(join(s["last"], v), lambda x: F.struct(
                x.alias("last"), F.concat(s["all"], F.array(x)).alias("all")))

        return F.aggregate(block, F.struct(zero.alias("last"), none.alias("all")), step, lambda s: s["all"])

    def blocks(array: Column) -> Column:
        count = F.ceil(F.size(array) / BLOCK).cast("int")
        starts = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
        cut = F.transform(starts, lambda b: inside(F.slice(array, b * BLOCK + 1, F.lit(BLOCK))))
        return _with(cut, joined)

    def joined(parts: Column) -> Column:
        ends = inside(F.transform(parts, lambda p: F.element_at(p, -1)))
        before = F.concat(F.array(zero), ends)
        return F.flatten(F.transform(
            F.arrays_zip(parts.alias("part"), F.slice(before, 1, F.size(parts)).alias("before")),
            lambda z: F.transform(z["part"], lambda x: join(z["before"], x))))

    return _with(values, blocks)


def _matches(text: Column, pattern: str, good: Column | None = None) -> Column:
    """array<struct<start, end, value>> of the matches in code points, ``end`` exclusive.

    ``good``: which matches stay, as an array of booleans by match. A match starts after all earlier pieces
    and matches.
    """
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    steps = F.transform(F.arrays_zip(
        values.alias("value"), F.slice(pieces, 1, F.size(values)).alias("gap"),
        (F.transform(values, lambda _: F.lit(True)) if good is None else good).alias("good")),
        lambda m: F.struct(F.char_length(m["gap"]).alias("gap"), F.char_length(m["value"]).alias("size"),
                           m["value"].alias("value"), m["good"].alias("good")))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def placed(found: Column) -> Column:
        ends = _running(F.transform(found, lambda m: m["gap"] + m["size"]), "int", lambda a, b: a + b)
        return F.transform(
            F.filter(F.arrays_zip(found.alias("m"), ends.alias("end")), lambda z: z["m"]["good"]),
            lambda z: F.struct((z["end"] - z["m"]["size"]).alias("start"), z["end"].alias("end"),
                               z["m"]["value"].alias("value")))

    return F.when(text.rlike(pattern), _with(steps, placed)).otherwise(none)


def _entropy_span(value: Column, bits: float, window: int = WINDOW) -> Column:
    """struct<first, last>: first and last window (by start, from 0) with at least ``bits`` per character.

    -1 and -1 if there is none. ``value`` is ASCII within the classes' characters, at least ``window`` long.
    One character enters and one leaves at each place; only their two counts change.
    """
    terms = [round(UNITS * c * math.log2(c)) if c > 1 else 0 for c in range(window + 1)]
    grows = F.array(*[F.lit(terms[c + 1] - terms[c]) for c in range(window)])
    falls = F.array(*[F.lit(0)] + [F.lit(terms[c - 1] - terms[c]) for c in range(1, window + 1)])
    most = math.floor(UNITS * window * (math.log2(window) - bits))
    words = -(-SLOTS // PACKED)
    codes = F.transform(F.split(value, ""), lambda c: F.ascii(c) - FIRST)
    start = F.struct(
        F.array_repeat(F.lit(0).cast("bigint"), words).alias("counts"), F.lit(0).alias("sum"),
        F.lit(-1).alias("first"), F.lit(-1).alias("last"))

    def count(counts: Column, code: Column) -> Column:
        word = F.get(counts, F.floor(code / PACKED).cast("int"))
        return F.call_function("shiftright", word, F.pmod(code, F.lit(PACKED)) * COUNT_BITS).bitwiseAND(
            F.lit((1 << COUNT_BITS) - 1)).cast("int")

    def one(code: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(code, F.lit(PACKED)) * COUNT_BITS)

    def step(state: Column, place: Column) -> Column:
        # place: struct<i, enter, leave>; leave is -1 while the window fills.
        left = F.when(place["leave"] >= 0, F.get(falls, count(state["counts"], place["leave"]))).otherwise(0)
        held = count(state["counts"], place["enter"]) - F.when(place["leave"] == place["enter"], 1).otherwise(0)
        total = state["sum"] + left + F.get(grows, held)
        counts = F.transform(state["counts"], lambda c, k: c + F.when(
            k == place["enter_word"], place["enter_one"]).otherwise(0) - F.when(
            k == place["leave_word"], place["leave_one"]).otherwise(0))
        hot = (place["i"] >= window - 1) & (total <= most)
        begin = place["i"] - (window - 1)
        return F.struct(
            counts.alias("counts"), total.alias("sum"),
            F.when(hot & (state["first"] < 0), begin).otherwise(state["first"]).alias("first"),
            F.when(hot, begin).otherwise(state["last"]).alias("last"))

    # Zipped, not looked up by place: inside a lambda the codes would be built anew for each place.
    leaves = F.slice(F.concat(F.array_repeat(F.lit(-1), window), codes), 1, F.char_length(value))
    places = F.transform(F.arrays_zip(codes.alias("enter"), leaves.alias("leave")), lambda p, i: F.struct(
        i.alias("i"), p["enter"].alias("enter"), p["leave"].alias("leave"),
        F.floor(p["enter"] / PACKED).cast("int").alias("enter_word"), one(p["enter"]).alias("enter_one"),
        F.floor(p["leave"] / PACKED).cast("int").alias("leave_word"), one(p["leave"]).alias("leave_one")))
    return F.aggregate(places, start, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))


def _blanks(text: Column) -> Column:
    return F.repeat(F.lit(" "), F.char_length(text))


def _without_path(run: Column) -> Column:
    """``run`` with blanks for its leading segments that are made of words, if ``SEGMENTS`` end with a slash."""
    rooted = run.startswith("/")
    segments = F.split(F.when(rooted, F.substr(run, F.lit(2))).otherwise(run), "/")

    def masked(parts: Column) -> Column:
        at = F.array_position(F.transform(parts, lambda x: x.rlike(NO_WORDS)), True).cast("int")
        good = F.when(at > 0, at - 1).otherwise(F.size(parts))
        ended = F.least(good, F.size(parts) - 1)
        size = F.aggregate(F.slice(parts, 1, ended), F.lit(0), lambda n, x: n + F.char_length(x) + 1)
        size = size + rooted.cast("int") + F.when(
            good == F.size(parts), F.char_length(F.element_at(parts, -1))).otherwise(0)
        return F.when(ended >= SEGMENTS, F.concat(
            F.repeat(F.lit(" "), size), F.substr(run, size + 1))).otherwise(run)

    return F.when(run.contains("/"), _with(segments, masked)).otherwise(run)


def _put(text: Column, pattern: str, use: Callable[[Column, Column], Column]) -> Column:
    """``text`` with ``use(match, piece before it)`` in the place of each match."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), values.alias("match"))
    put = F.transform(pairs, lambda p: F.concat(
        p["gap"], F.when(p["match"].isNull(), "").otherwise(use(p["match"], p["gap"]))))
    return F.when(text.rlike(pattern), F.array_join(put, "")).otherwise(text)


def _masked(text: Column) -> Column:
    """``text`` with as many blanks in place of what is known to be harmless."""
    def run(value: Column, before: Column) -> Column:
        whole = value.rlike(UUID) | value.rlike(DIGEST) | before.rlike(DIGEST_BEFORE)
        return F.when(whole, _blanks(value)).otherwise(_without_path(value))

    return _put(_put(text, LONG, run), PLACEHOLDER, lambda value, _: _blanks(value))


def _run_spans(text: Column, k: int, window: int) -> Column:
    """Entropy spans of the runs of class number ``k``: struct<start, kind, end>."""
    one = RUNS[k]
    number = KINDS.index(one.kind)

    def fits(m: Column) -> Column:
        test = F.char_length(m["value"]) >= window
        for pattern in one.tests:
            test = test & m["value"].rlike(pattern)
        return test

    windows = F.transform(F.filter(_matches(text, one.runs), fits), lambda m: F.struct(
        m["start"].alias("start"), _entropy_span(m["value"], one.bits, window).alias("hot")))
    return F.transform(F.filter(windows, lambda m: m["hot"]["first"] >= 0), lambda m: F.struct(
        (m["start"] + m["hot"]["first"]).alias("start"), F.lit(number).alias("kind"),
        (m["start"] + m["hot"]["last"] + window).alias("end")))


_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _spans(found: Column, kind: str) -> Column:
    number = KINDS.index(kind)
    return F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end")))


def _outermost(spans: Column) -> Column:
    """Entropy spans that are not inside one of another class that is longer, or as long and earlier in ``RUNS``.

    Sorted by start, longer and earlier classes first, a span is inside another if one before it ends no sooner.
    """
    rank = F.array(*[F.lit([c.kind for c in RUNS].index(k) if k in [c.kind for c in RUNS] else -1) for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("back"), F.get(rank, s["kind"]).alias("rank"),
        s["kind"].alias("kind"))))

    def kept(rows: Column) -> Column:
        until = _running(F.transform(rows, lambda r: -r["back"]), "int", F.greatest)
        before = F.slice(F.concat(F.array(F.lit(0)), until), 1, F.size(rows))
        return F.transform(
            F.filter(F.arrays_zip(rows.alias("r"), before.alias("until")), lambda z: z["until"] < -z["r"]["back"]),
            lambda z: F.struct(z["r"]["start"].alias("start"), z["r"]["kind"].alias("kind"),
                               (-z["r"]["back"]).alias("end")))

    return _with(ordered, kept)


def _outside(added: Column, base: Column) -> Column:
    """The spans of ``added`` that are inside none of ``base``."""
    def marked(spans: Column, own: int) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(own).alias("own"), s["kind"].alias("kind"), s["end"].alias("end")))

    def kept(rows: Column) -> Column:
        until = _running(F.transform(rows, lambda r: F.when(r["own"] == 0, r["end"]).otherwise(0)), "int", F.greatest)
        return F.transform(
            F.filter(F.arrays_zip(rows.alias("r"), until.alias("until")),
                     lambda z: (z["r"]["own"] == 1) & (z["until"] < z["r"]["end"])),
            lambda z: F.struct(z["r"]["start"].alias("start"), z["r"]["kind"].alias("kind"), z["r"]["end"].alias("end")))

    return _with(F.array_sort(F.concat(marked(base, 0), marked(added, 1))), kept)


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scanned(df: DataFrame, text: str, window: int = WINDOW) -> DataFrame:
    """``df`` with ``n_assign``, ``n_access``, ``n_hex``, ``base`` and ``spans`` added; own columns of these
    names are replaced, all others are kept whatever their names.

    ``base`` and ``spans`` are comma-joined ``kind:start:end`` in code points, by start, then kind; ``base`` has
    the three patterns, ``spans`` the added entropy spans too. Windows of ``window`` characters slide over the
    maximal runs of each class in ``RUNS``; an entropy span goes from the first to the last window of a run
    whose entropy reaches the bound of the class. Windows that touch something harmless (a UUID, a named
    digest, the leading segments of a path, a placeholder) are left out, and so are spans inside a base span
    or inside a span of another class (see ``_outermost``). NULL and empty texts have no spans; an empty
    table gives no rows; repeated rows and NULLs elsewhere change nothing. Texts are scanned whole, in time
    about linear in their length. Each row is its own work: nothing is shuffled.
    """
    body, assign, access, hexa, base, masked, added = unused(
        df, "_body", "_assign", "_access", "_hex", "_base", "_masked", "_added")
    b = F.col(body)
    rows = df.withColumn(body, F.coalesce(F.col(text), F.lit("")))
    long_enough = F.transform(F.regexp_extract_all(b, F.lit(ASSIGN), F.lit(2)), lambda v: F.char_length(v) >= ASSIGN_LENGTH)
    rows = rows.withColumns({
        assign: _matches(b, ASSIGN, long_enough), access: _matches(b, ACCESS), hexa: _matches(b, HEX),
        masked: F.when(b.rlike(LONG), _masked(b))})
    rows = rows.withColumn(base, F.concat(
        _spans(F.col(assign), "assign"), _spans(F.col(access), "access"), _spans(F.col(hexa), "hex")))
    none = F.array().cast(_SPAN)
    found = F.concat(*[F.coalesce(_run_spans(F.col(masked), k, window), none) for k in range(len(RUNS))])
    rows = rows.withColumn(added, F.when(F.col(masked).isNotNull(), found).otherwise(none))
    fresh = F.when(F.size(added) > 0, _outside(_outermost(F.col(added)), F.col(base))).otherwise(none)
    return rows.withColumns({
        "n_assign": F.size(assign).cast("bigint"), "n_access": F.size(access).cast("bigint"),
        "n_hex": F.size(hexa).cast("bigint"), "spans": _listed(F.concat(F.col(base), fresh)),
        "base": _listed(F.col(base)),
    }).drop(body, assign, access, hexa, base, masked, added)


def query(spark: SparkSession, folder: str) -> DataFrame:
    found = scanned(table(spark, folder, "documents").select("doc_id", "text"), "text")
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _found(kind: str, pattern: str, keep: str = "true") -> str:
    """Matches of a pattern with their places: each starts after all earlier pieces and matches."""
    return f"""
  SELECT rid, '{kind}' AS kind, value, start, start + length(value) AS stop FROM (
    SELECT rid, vs[i] AS value, gs[i] AS long_part,
      list_sum(list_transform(pieces[1:i], lambda p: length(p))) +
      coalesce(list_sum(list_transform(vs[1:i - 1], lambda p: length(p))), 0) AS start
    FROM (SELECT rid, regexp_extract_all(t, {_quoted(pattern)}) AS vs,
                 regexp_extract_all(t, {_quoted(pattern)}, {2 if kind == 'assign' else 0}) AS gs,
                 string_split_regex(t, {_quoted(pattern)}) AS pieces FROM docs), unnest(range(1, len(vs) + 1)) u(i))
  WHERE {keep}"""


_ORDER = "list_position(['" + "', '".join(KINDS) + "'], kind)"
_RANK = "list_position(['" + "', '".join(c.kind for c in RUNS) + "'], kind)"


def _islands(k: int) -> str:
    """Maximal runs of one alphabet of class ``k`` among the characters that are not masked."""
    one = RUNS[k]
    tests = " AND ".join(f"regexp_matches(value, '{t}')" for t in one.tests)
    return " UNION ALL ".join(f"""
  SELECT rid, '{one.kind}' AS kind, {one.bits} AS bits, min(pos) AS start, string_agg(c, '' ORDER BY pos) AS value
  FROM (SELECT rid, pos, c, pos - row_number() OVER (PARTITION BY rid ORDER BY pos) AS island
        FROM letters WHERE regexp_matches(c, '^[{letters}]$'))
  GROUP BY rid, island HAVING count(*) >= {WINDOW} AND {tests}""" for letters in one.letters.split())


# Character by character: the masked runs are taken apart, and every window is counted anew.
CHECK = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
base AS ({_found('assign', ASSIGN, f'length(long_part) >= {ASSIGN_LENGTH}')}
  UNION ALL {_found('access', ACCESS)} UNION ALL {_found('hex', HEX)}),
long_runs AS ({_found('long', LONG)}),
cut AS (
  SELECT l.rid, l.start, value, value[1] = '/' AS rooted,
    string_split(CASE WHEN value[1] = '/' THEN substr(value, 2) ELSE value END, '/') AS parts,
    regexp_matches(value, {_quoted(UUID)}) OR regexp_matches(value, {_quoted(DIGEST)}) OR regexp_matches(
      substr(t, greatest(l.start - 7, 1)::BIGINT, least(l.start, 8)::BIGINT), {_quoted(DIGEST_BEFORE)}) AS whole
  FROM long_runs l JOIN docs USING (rid)),
judged AS (
  SELECT *, coalesce(nullif(list_position(list_transform(parts, lambda x: regexp_matches(x, {_quoted(NO_WORDS)})), true), 0),
    len(parts) + 1) - 1 AS good FROM cut),
sized AS (
  SELECT *, CASE WHEN whole THEN length(value) WHEN len(parts) > 1 AND least(good, len(parts) - 1) >= {SEGMENTS}
    THEN rooted::INT + list_sum(list_transform(parts[1:least(good, len(parts) - 1)], lambda x: length(x) + 1))
      + CASE WHEN good = len(parts) THEN length(parts[-1]) ELSE 0 END ELSE 0 END AS hidden
  FROM judged),
places AS (
  SELECT rid, start + i - 1 AS pos, value[i] AS c, i <= hidden AS hidden
  FROM sized, unnest(range(1, length(value) + 1)) u(i)),
clear AS (
  SELECT rid, start, repeat(' ', hidden::INT) || substr(value, hidden::BIGINT + 1) AS value FROM sized),
holders AS (
  SELECT rid, start + coalesce(list_sum(list_transform(pieces[1:i], lambda p: length(p))), 0)
      + coalesce(list_sum(list_transform(vs[1:i - 1], lambda p: length(p))), 0) AS first, length(vs[i]) AS size
  FROM (SELECT rid, start, regexp_extract_all(value, {_quoted(PLACEHOLDER)}) AS vs,
          string_split_regex(value, {_quoted(PLACEHOLDER)}) AS pieces FROM clear), unnest(range(1, len(vs) + 1)) u(i)),
letters AS (
  SELECT rid, pos, c FROM places p WHERE NOT hidden AND NOT EXISTS (
    FROM holders h WHERE h.rid = p.rid AND p.pos >= h.first AND p.pos < h.first + h.size)),
islands AS ({" UNION ALL ".join(_islands(k) for k in range(len(RUNS)))}),
counts AS (
  SELECT rid, kind, bits, start, w, value[w + k] AS c, count(*) AS n
  FROM islands, unnest(range(0, length(value) - {WINDOW} + 1)) a(w), unnest(range(1, {WINDOW} + 1)) b(k) GROUP BY ALL),
windows AS (
  SELECT rid, kind, bits, start, w, sum(round({UNITS} * n * log2(n))) AS total FROM counts GROUP BY ALL),
hot AS (
  SELECT rid, kind, start + min(w) AS first, start + max(w) + {WINDOW} AS stop FROM windows
  WHERE total <= floor({UNITS} * {WINDOW} * (log2({WINDOW}) - bits)) GROUP BY rid, kind, bits, start),
fresh AS (
  SELECT rid, kind, first AS start, stop FROM hot h WHERE NOT EXISTS (
    FROM base b WHERE b.rid = h.rid AND b.start <= h.first AND h.stop <= b.stop)
  AND NOT EXISTS (
    FROM hot o WHERE o.rid = h.rid AND o.kind <> h.kind AND o.first <= h.first AND h.stop <= o.stop
      AND (o.stop - o.first > h.stop - h.first OR {_RANK.replace('kind)', 'o.kind)')} < {_RANK.replace('kind)', 'h.kind)')}))),
totals AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, {_ORDER}) AS base FROM base GROUP BY rid),
every AS (
  SELECT rid, string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, {_ORDER}) AS spans
  FROM (SELECT rid, kind, start, stop FROM base UNION ALL FROM fresh) GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN totals USING (rid) LEFT JOIN every USING (rid)
"""
