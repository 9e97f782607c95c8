"""Near-duplicate join on word shingles: grouped prefix join.

Shingles have one global order: rare first, by classes of their document frequency, then by hash. Two
sets of the asked similarity share a shingle among the first few of both. Documents with the same
first few and the same size are one group; groups that share a shingle are filtered by size and place,
expanded, and their members verified on the whole sets.

Links are found in two rounds, so that the members of a large family are not all paired. First every
group meets one group only, the leader with which it shares most; verified links form components. Then
shingles that still hold several components pair the members of different components, and only those.
Equal sets are one node throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.llm.common import (
    LOWER, gram_hashes, map_arrow, mix, prepared, signed, sliced, spans, table, text_key, unused, utf8, without, word_hashes,
)
from wickline.operators.keys import join_null_safe
from wickline.session import staged

SHINGLE = 5
PERCENT = 75

# Frequency classes: a shingle's class is the number of these that its document frequency reaches.
FREQUENT = (2, 16, 128)
# Bits of the three class filters, whatever the corpus: 20 MB. Each part of the hash space keeps the
# most frequent shingles that fit; any class gives a valid order, the filters only make it a good one.
FILTER_BITS = (27, 24, 24)
KEY_SHARE = 8
# Shingles are counted in parts of the hash space of about so many, by 24 more bits of their hash.
PART_SHINGLES = 1 << 17
MOST_PARTS = 1 << 16
COUNT_BYTES = 4 << 20

INK = np.ones(256, bool)
INK[[9, 10, 11, 12, 13, 32]] = False
_OTHER = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """The distinct shingles of every text, sorted. Fewer words than a shingle make one, none make none.

    Shingles are told apart by 64 bits: by hashes of their words, mixed again.
    """
    data, offsets = utf8(column)
    data = LOWER[data]
    starts, ends, first = spans(data, offsets, INK)
    words = word_hashes(data, starts, ends)
    grams = gram_hashes(words, SHINGLE)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        out.append(np.unique(grams[a : b - SHINGLE + 1]) if b - a >= SHINGLE else gram_hashes(words[a:b], b - a)
                   if b > a else np.zeros(0, np.uint64))
    return out


def _signature(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that do not depend on an order."""
    with np.errstate(over="ignore"):
        sums = np.array([mix(shingles).sum(dtype=np.uint64), mix(shingles ^ _OTHER).sum(dtype=np.uint64)])
    return tuple(signed(sums).tolist())


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = shingle_sets(batch.column(2))
        signs = [_signature(s) for s in sets]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
            pa.array([s[0] for s in signs], pa.int64()), pa.array([s[1] for s in signs], pa.int64())],
            names=["_doc", "_key", "n", "s1", "s2"])


@dataclass
class Classes:
    """Frequency class of any shingle."""

    part_bits: int
    known: np.ndarray  # parts of which every shingle of frequency 2 is in the first filter
    filters: list[np.ndarray]

    def of(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(class, whether the shingle certainly occurs in one document only)."""
        found = np.zeros(len(shingles), np.int8)
        keys = shingles >> np.uint64(40 - self.part_bits)
        for bits in self.filters:
            held = np.ones(len(shingles), bool)
            for place in _places(keys, 8 * len(bits) >> self.part_bits):
                held &= (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0
            found += held
        part = (shingles >> np.uint64(64 - self.part_bits)).astype(np.int64)
        return found, (found == 0) & self.known[part]


def _places(keys: np.ndarray, stretch: int) -> tuple[np.ndarray, np.ndarray]:
    """The two filter bits of a key (part and 24 more bits of a shingle); a part has ``stretch`` bits of its own."""
    base = (keys >> np.uint64(24)).astype(np.int64) * stretch
    spread = mix(keys)
    low = np.uint64(stretch - 1)
    return base + (spread & low).astype(np.int64), base + (spread >> np.uint64(32) & low).astype(np.int64)


def frequency_classes(docs: DataFrame, shingles: int, filter_bits: tuple[int, ...] = FILTER_BITS) -> Classes:
    """Count every shingle of every document and keep the frequent ones in filters of fixed size.

    A task sends each part of the hash space one sorted list, three bytes a shingle; a shingle is listed
    at most as often as the highest class asks, however often the task sees it.
    """
    parts = 64
    while parts < MOST_PARTS and parts * PART_SHINGLES < shingles:
        parts *= 2
    part_bits = parts.bit_length() - 1
    most = FREQUENT[-1]

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, COUNT_BYTES):
            held = [s for batch in part.to_batches(max_chunksize=256) for s in shingle_sets(batch.column(2))]
            keys = np.sort(np.concatenate(held) >> np.uint64(40 - part_bits)) if held else np.zeros(0, np.uint64)
            keys = keys[np.append(np.ones(min(most, len(keys)), bool), keys[most:] != keys[:-most])]
            edges = np.searchsorted(keys, np.arange(parts + 1, dtype=np.uint64) << np.uint64(24))
            low = (keys & np.uint64(0xFFFFFF)).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]
            some = np.flatnonzero(np.diff(edges))
            yield pa.RecordBatch.from_arrays([
                pa.array(some, pa.int32()), pa.array([low[edges[i] : edges[i + 1]].tobytes() for i in some], pa.binary())],
                names=["part", "listed"])

    def stretch(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        raw = np.frombuffer(b"".join(group.column("listed").to_pylist()), np.uint8).reshape(-1, 3)
        keys = np.zeros((len(raw), 4), np.uint8)
        keys[:, :3] = raw
        keys, counts = np.unique(keys.view("<u4").ravel(), return_counts=True)
        keys = keys.astype(np.uint64) | np.uint64(part) << np.uint64(24)
        out, least = {}, 0
        for k, asked in enumerate(FREQUENT):
            size = 1 << (filter_bits[k] - part_bits)
            least = max(least, asked)
            room = size // KEY_SHARE
            if (counts >= least).sum() > room:
                least = int(np.sort(counts)[-room]) + 1
            bits = np.zeros(size, np.uint8)
            for place in _places(keys[counts >= least], size):
                bits[place & (size - 1)] = 1
            out[f"f{k}"] = [np.packbits(bits, bitorder="little").tobytes()]
            if k == 0:
                out["known"] = [least == asked]
        return pa.table({"part": pa.array([part], pa.int32()), **out})

    counted = map_arrow(docs, lists, "part int, listed binary").groupBy("part").applyInArrow(
        stretch, "part int, f0 binary, known boolean, f1 binary, f2 binary")
    filters = [np.zeros((1 << bits) // 8, np.uint8) for bits in filter_bits]
    known = np.ones(parts, bool)
    for row in staged(counted, "frequencies").collect():
        known[row["part"]] = row["known"]
        for k, bits in enumerate(filters):
            own = len(bits) // parts
            bits[row["part"] * own : (row["part"] + 1) * own] = np.frombuffer(row[f"f{k}"], np.uint8)
    return Classes(part_bits, known, filters)


def _prefixes(shared) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes: Classes = shared.value
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            out: list[tuple] = []
            sets = shingle_sets(batch.column(2))
            sizes = np.array([len(s) for s in sets])
            edges = np.append(0, np.cumsum(sizes))
            every = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
            kind, single = classes.of(every)
            singles = np.append(0, np.cumsum(single))
            singles = singles[edges[1:]] - singles[edges[:-1]]
            # Of a set that shares PERCENT, at most the rest may come before the first common shingle.
            first = sizes - -(-PERCENT * sizes // 100) + 1
            for i in np.flatnonzero((sizes > 0) & (singles < first)).tolist():
                own = sets[i]
                sign = _signature(own)
                if sign in seen:
                    continue
                seen.add(sign)
                if len(seen) > 1 << 18:
                    seen.clear()
                a, b, p = int(edges[i]), int(edges[i + 1]), int(first[i])
                order = np.argsort(kind[a:b], kind="stable")[:p]
                lead = own[order]
                shown = np.flatnonzero(~single[a:b][order])
                with np.errstate(over="ignore"):
                    group = mix(np.array([(mix(lead) * (2 * np.arange(p, dtype=np.uint64) + 1)).sum(dtype=np.uint64)]))
                out.append((*sign, len(own), int(signed(group)[0]), signed(lead[shown]).tolist(), shown.tolist(),
                            own.tobytes()))
            columns = list(zip(*out)) if out else [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()),
                     pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=["s1", "s2", "n", "prefix", "shingles", "places", "whole"])

    return run


def _verified(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that are similar enough, staged."""
    sets = members.select("node", "whole")
    met = pairs.join(sets.withColumnsRenamed({"node": "b", "whole": "y"}), "b").join(
        sets.withColumnsRenamed({"node": "a", "whole": "x"}), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= PERCENT * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).filter(pa.array(keep, pa.bool_())) for i in (0, 1)], names=["a", "b"])

    return staged(map_arrow(met.select("a", "b", "x", "y"), run, "a bigint, b bigint"), "links")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): the least node reachable; staged.

    Alternating stars: every node's larger neighbours, then its smaller ones, are linked to the least of
    its neighbourhood, until only stars are left. A step is one aggregate and one join on the node.
    """
    def least(edges: DataFrame) -> DataFrame:
        return staged(edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")

    edges = staged(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where(
        "a <> b").distinct(), "edges")
    while True:
        both = edges.selectExpr("a AS u", "b AS v").unionByName(edges.selectExpr("b AS u", "a AS v"))
        large = both.join(least(both), "u").where("v > u").selectExpr("m AS a", "v AS b").where("a <> b").distinct()
        large = staged(large, "large-star")
        down = large.selectExpr("b AS u", "a AS v")
        lows = least(down)
        small = down.join(lows, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(
            lows.selectExpr("m AS a", "u AS b")).where("a <> b").distinct()
        small = staged(small, "small-star")
        if small.exceptAll(edges).isEmpty() and edges.exceptAll(small).isEmpty():
            break
        edges = small
    stars = edges.selectExpr("b AS node", "a AS component")
    return staged(stars.unionByName(edges.selectExpr("a AS node", "a AS component").distinct()), "components")


def _far_apart(nx: str, ny: str) -> str:
    return f"100 * least({nx}, {ny}) < {PERCENT} * greatest({nx}, {ny})"


def _cross_pairs(index: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs of nodes of different components whose groups share a shingle, filtered by size and place.

    The groups that hold a shingle are counted by size and place first. Only classes of them that may
    hold similar sets are paired, and only the groups of such classes are expanded to their members.
    """
    ranges = nodes.groupBy("leader").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    held = index.join(staged(ranges, "ranges"), "leader")
    open_ones = held.groupBy("shingle").agg(
        F.min("low").alias("least"), F.max("high").alias("most")).where("least < most").select("shingle")
    held = staged(held.join(staged(open_ones, "open"), "shingle", "left_semi"), "open-rows")
    classes = staged(held.groupBy("shingle", "n", "place").agg(
        F.min("low").alias("low"), F.max("high").alias("high")), "classes")
    x, y = (classes.selectExpr("shingle", f"n AS n{c}", f"place AS p{c}", f"low AS low{c}", f"high AS high{c}")
            for c in "ab")
    # Within a class both orders are one pair; classes all of one component have nothing to find.
    met = staged(x.join(y, "shingle").where(
        f"(na < nb OR na = nb AND pa <= pb) AND NOT ({_far_apart('na', 'nb')}) "
        f"AND {100 + PERCENT} * least(na - pa, nb - pb) >= {PERCENT} * (na + nb) "
        "AND least(lowa, lowb) < greatest(higha, highb)").select("shingle", "na", "pa", "nb", "pb"), "class-pairs")
    sides = [held.selectExpr("shingle", f"n AS n{c}", f"place AS p{c}", f"leader AS leader{c}", f"low AS low{c}",
                             f"high AS high{c}") for c in "ab"]
    groups = met.join(sides[0], ["shingle", "na", "pa"]).join(sides[1], ["shingle", "nb", "pb"]).where(
        "(na < nb OR pa < pb OR leadera <= leaderb) AND least(lowa, lowb) < greatest(higha, highb)").select(
        F.least("leadera", "leaderb").alias("leadera"), F.greatest("leadera", "leaderb").alias("leaderb")).distinct()
    members = [nodes.selectExpr(f"leader AS leader{c}", f"node AS {c}", f"component AS c{c}") for c in "ab"]
    pairs = groups.join(members[0], "leadera").join(members[1], "leaderb").where(
        "ca <> cb AND (leadera <> leaderb OR a < b)")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, doc: str, text: str, filter_bits: tuple[int, ...] = FILTER_BITS
) -> DataFrame:
    """Per document: (doc, n_shingles, component_id, text_key, group).

    Two documents link when 100 * |intersection| >= ``PERCENT`` * |union| of their shingle sets;
    ``component_id`` is the smallest id reachable by links, ``group`` names the component. NULL texts and
    texts without words have no shingles, link with nothing and are a group of their own id. Repeated
    rows and equal texts are linked. NULL ids take part and are smaller than no id; a component of NULL
    ids only has the id NULL. An empty table gives no rows; extra columns play no part.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc).alias("_doc"), text_key(F.col(text)).alias("_key"), F.col(text).alias("_text"))
    kind = rows.schema["_doc"].dataType.simpleString()
    base = staged(map_arrow(rows, _described, f"_doc {kind}, _key bigint, n bigint, s1 bigint, s2 bigint"), "sets")
    total = base.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shared = spark.sparkContext.broadcast(frequency_classes(rows, total, filter_bits))
    found = map_arrow(rows, _prefixes(shared), "s1 bigint, s2 bigint, n bigint, prefix bigint, "
                      "shingles array<bigint>, places array<int>, whole binary")
    members = staged(found.withColumn("node", F.monotonically_increasing_id()), "members")

    nodes = members.groupBy("s1", "s2", "n", "prefix").agg(F.min("node").alias("node"))
    nodes = staged(nodes, "nodes")
    groups = staged(nodes.groupBy("prefix", "n").agg(F.min("node").alias("leader")), "groups")
    nodes = staged(nodes.join(groups, ["prefix", "n"]), "grouped")
    index = members.join(groups.select(F.col("leader").alias("node")), "node", "left_semi").select(
        F.col("node").alias("leader"), "n", F.explode(F.arrays_zip("shingles", "places")).alias("s")).select(
        F.col("s.shingles").alias("shingle"), F.col("s.places").alias("place"), "n", "leader")
    index = staged(index, "index")

    # First round: the leader of a shingle and size band, and of the band above. It is the group in
    # which the fewest rarer shingles come before this one, so the one with the fewest changes.
    band = F.floor(F.log(100 / PERCENT, F.col("n").cast("double"))).cast("int")
    banded = index.select("shingle", "place", "leader", band.alias("band"))
    heads = banded.groupBy("shingle", "band").agg(F.min(F.struct("place", "leader")).alias("head"))
    heads = staged(heads.select("shingle", "band", F.col("head.leader").alias("head")), "heads")
    asked = banded.select("shingle", "leader", F.explode(F.array("band", F.col("band") + 1)).alias("band"))
    votes = asked.join(heads, ["shingle", "band"]).where("leader <> head").groupBy(
        "leader", "head").agg(F.count("*").alias("votes"))
    best = votes.groupBy("leader").agg(F.max(F.struct("votes", "head")).alias("best"))
    first = best.select(F.col("leader").alias("b"), F.col("best.head").alias("a"))
    inside = nodes.where("node <> leader").selectExpr("node AS b", "leader AS a")
    links = _verified(staged(first.unionByName(inside), "first-pairs"), members)
    labels = components(links)
    nodes = staged(nodes.join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node")), "labelled")

    # Second round: what the components leave open, within groups and across them.
    pairs = staged(_cross_pairs(index, nodes), "cross-pairs")
    more = _verified(pairs, members)
    named = nodes.select("node", "component")
    joined = more.join(named.withColumnsRenamed({"node": "a", "component": "x"}), "a").join(
        named.withColumnsRenamed({"node": "b", "component": "y"}), "b").selectExpr("x AS a", "y AS b")
    merged = components(joined).selectExpr("node AS component", "component AS merged")
    nodes = nodes.join(merged, "component", "left").select(
        "s1", "s2", F.coalesce("merged", "component").alias("group"))

    classes = base.where("n > 0").groupBy("s1", "s2").agg(F.min("_doc").alias("least"))
    classes = staged(classes.join(staged(nodes, "node-groups"), ["s1", "s2"], "left").withColumn(
        "group", F.coalesce(F.concat(F.lit("c"), F.col("group")), F.concat_ws("_", "s1", "s2"))), "classes")
    smallest = classes.groupBy("group").agg(F.min("least").alias("component_id"))
    classes = staged(classes.select("s1", "s2", "group").join(smallest, "group"), "class-components")
    linked = base.where("n > 0").join(classes, ["s1", "s2"]).select("_doc", "_key", "n", "component_id", "group")
    alone = base.where("n = 0").select("_doc", "_key", "n", F.col("_doc").alias("component_id"),
                                       F.lit(None).cast("string").alias("group"))
    return linked.unionByName(alone).select(
        F.col("_doc").alias(doc), F.col("n").alias("n_shingles"), "component_id", F.col("_key").alias("text_key"), "group")


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """``docs`` with one document of each group: that of the smallest id. Texts without words all stay."""
    prepared(spark)
    judged = staged(near_duplicates(docs, "doc_id", "text"), "judged").where("group IS NOT NULL")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    kept = staged(judged.groupBy("group").agg(F.min(order).alias("kept")).select(
        F.col("kept.doc_id").alias("doc_id"), F.col("kept.text_key").alias("text_key")), "kept")
    gone = join_null_safe(judged.select("doc_id", "text_key").distinct(), kept, ["doc_id", "text_key"], "left_anti")
    rest = without(docs, gone)
    # A repeated row of a kept document has its id and text: the repeats are few, and go by id and text.
    again = staged(judged.groupBy("doc_id", "text_key").count().where("count > 1").select(
        "doc_id", "text_key"), "repeated")
    if again.isEmpty():
        return rest
    [key] = unused(docs, "text_key")
    keyed = rest.withColumn(key, text_key(F.col("text")))
    again = again.withColumnRenamed("text_key", key)
    once = join_null_safe(keyed, again, ["doc_id", key], "left_semi").dropDuplicates(["doc_id", key])
    return join_null_safe(keyed, again, ["doc_id", key], "left_anti").unionByName(once).select(*docs.columns)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), "doc_id", "text").select(
        "doc_id", "n_shingles", "component_id")


CHECK = f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT DISTINCT rid, array_to_string(w[i:i + least({SHINGLE}, len(w)) - 1], ' ') AS s
  FROM docs, unnest(range(1, greatest(len(w) - {SHINGLE} + 1, 1) + 1)) u(i) WHERE len(w) > 0),
sizes AS (SELECT rid, count(*) AS n FROM sets GROUP BY rid),
met AS (
  SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.rid <> b.rid GROUP BY ALL),
links AS (
  SELECT x, y FROM met JOIN sizes p ON p.rid = x JOIN sizes q ON q.rid = y
  WHERE 100 * c >= {PERCENT} * (p.n + q.n - c)),
reach AS (
  SELECT rid AS a, rid AS b FROM sizes
  UNION
  SELECT reach.a, links.y FROM reach JOIN links ON links.x = reach.b),
least_ids AS (SELECT a AS rid, min(doc_id) AS component_id FROM reach JOIN docs ON docs.rid = reach.b GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles,
  CASE WHEN n IS NULL THEN doc_id ELSE component_id END AS component_id
FROM docs LEFT JOIN sizes USING (rid) LEFT JOIN least_ids USING (rid)
"""
