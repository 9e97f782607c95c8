"""Alignment of two tokenizers over the same texts, by pointer jumping.

Both token sequences cut one string of bytes. Every token points to the token that reaches farthest right
among those it overlaps; doubling the pointers leads each token to the last token of its group, the terminal
that labels the group. All documents of a slice are aligned at once, vectorised over their tokens.

How often a pair of ids is linked is counted over the corpus. A slice sends each of its pairs once. What its
documents need of the counts comes back to the slice, which was staged as indexes of distinct groups: few
words make most of a text, so a group costs little more than a byte.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.llm import bpe
from wickline.llm.common import map_arrow, mix, prepared, sliced, table, utf8, word_hashes
from wickline.session import staged

# Bytes of text encoded and aligned together. Bounds the memory of a task, whatever the texts; a longer
# single text is taken whole.
SLICE_BYTES = 4 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves, the
    others in order from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Merges(bpe.Ranks):
    """The merges of a byte-level BPE file, in place of a rank file: only the pairs listed there are merged."""

    def __init__(self, path: str):
        with open(path) as file:
            model = json.load(file)["model"]
        letter = byte_letters()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ids = {bytes(letter[c] for c in token): i for token, i in model["vocab"].items()}
        self.token = [b""] * (max(self.ids.values()) + 1)
        for token, i in self.ids.items():
            self.token[i] = token
        self.byte = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        left, right, made = (np.array([model["vocab"][x] for x in side], np.int64) for side in (
            [a for a, _ in pairs], [b for _, b in pairs], [a + b for a, b in pairs]))
        if (np.diff(made) <= 0).any() or model.get("ignore_merges"):
            raise ValueError("token ids must be in the order of the merges")
        self.upsets = np.zeros(len(self.token), bool)
        for part in (left, right):
            self.upsets[part[part > made]] = True
        self._store(left, right, made.astype(np.int32))


class ByteLevel:
    """A byte-level BPE file, encoded by replaying its merges over the distinct pieces of a slice. Special
    tokens are plain text."""

    def __init__(self, path: str):
        self.coder = bpe.Coder(Merges(path))
        self.coder.lone = self.coder.lone[:0]
        self.token = self.coder.ranks.token

    def flat(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, offsets of each text's ids); a text begins with a space."""
        return self.coder.flat(data, offsets)


class Pieces:
    """A piece model, which puts the space before a text itself.

    Where no piece has a space after another sign and texts are not normalized, a space always begins a
    piece. Then the stretches from space to space are encoded each for itself, every distinct one once.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece.sentencepiece_model_pb2 import ModelProto

        self.model = SentencePieceProcessor(model_file=path)
        shape = ModelProto.FromString(self.model.serialized_model_proto())
        self.token = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.token.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i)
                              else piece.replace("▁", " ").encode())
        how = shape.normalizer_spec
        self.space = self.model.piece_to_id("▁")
        self.apart = (how.name == "identity" and how.add_dummy_prefix and not how.remove_extra_whitespaces
                      and not any(" " in token.lstrip(b" ").decode(errors="replace") for token in self.token))

    def _ids(self, whole: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of strings that begin with a space, which the model adds itself."""
        found = self.model.encode([w[1:] for w in whole], num_threads=1)
        found = [ids if len(w) > 1 else [self.space] for w, ids in zip(whole, found)]
        sizes = np.array([len(ids) for ids in found], np.int64)
        return np.fromiter((i for ids in found for i in ids), np.int64, int(sizes.sum())), np.append(0, np.cumsum(sizes))

    def flat(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, offsets of each text's ids, whether the bytes of each text's tokens are the text's)."""
        blank = data == 32
        starts = offsets[:-1]
        if self.apart and len(data):
            begins = blank.copy()
            begins[1:] &= ~blank[:-1]
            begins[offsets[:-1]] = True
            starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))[: len(starts)]
        word, first = bpe.told_apart(data, starts, ends, word_hashes(data, starts, ends))
        raw = [data[a:b].tobytes() for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        ids, edges = self._ids([r.decode() for r in raw])
        listed = ids.tolist()
        good = np.array([b"".join(map(self.token.__getitem__, listed[a:b])) == r
                         for r, a, b in zip(raw, edges[:-1].tolist(), edges[1:].tolist())], bool)
        sizes = np.diff(edges)[word]
        until = np.append(0, np.cumsum(sizes))
        every = ids[np.repeat(edges[:-1][word] - until[:-1], sizes) + np.arange(until[-1])]
        text = np.searchsorted(starts, offsets)
        text_edges = until[text]
        right = np.append(0, np.cumsum(~good[word]))[text]
        right = right[1:] == right[:-1]
        for i in np.flatnonzero(~right).tolist():
            own = every[text_edges[i] : text_edges[i + 1]].tolist()
            right[i] = b"".join(map(self.token.__getitem__, own)) == data[offsets[i] : offsets[i + 1]].tobytes()
        return every, text_edges, right


@dataclass
class Groups:
    """Groups of the tokens of some documents, and the links between overlapping tokens."""

    of_a: np.ndarray  # group of each A token
    of_b: np.ndarray
    link_a: np.ndarray  # index of the A token of each link, ascending
    link_b: np.ndarray

    @property
    def count(self) -> int:
        return int(self.of_b[-1]) + 1 if len(self.of_b) else 0


def aligned_groups(a_sizes: np.ndarray, b_sizes: np.ndarray) -> Groups:
    """Align two cuts of one string of bytes, given the bytes of every token; none is empty."""
    a_end, b_end = np.cumsum(a_sizes), np.cumsum(b_sizes)
    n_a, n_b = len(a_end), len(b_end)
    # The token of the other side that holds a token's last byte reaches farthest right.
    over_a = np.searchsorted(b_end, a_end)
    over_b = np.searchsorted(a_end, b_end)
    own = np.arange(n_b) + n_a
    farther = a_end[over_b] > b_end if n_b else np.zeros(0, bool)
    points = np.concatenate([over_a + n_a, np.where(farther, over_b, own)])
    while True:
        further = points[points]
        if np.array_equal(further, points):
            break
        points = further
    number = np.cumsum(points[n_a:] == own) - 1
    first = np.searchsorted(b_end, a_end - a_sizes, "right")
    counts = over_a - first + 1
    ends = np.cumsum(counts)
    link_a = np.repeat(np.arange(n_a), counts)
    link_b = np.arange(len(link_a)) - np.repeat(ends - counts - first, counts)
    return Groups(number[points[:n_a] - n_a], number[points[n_a:] - n_a], link_a, link_b)


def _last(groups: np.ndarray) -> np.ndarray:
    return np.append(groups[1:] != groups[:-1], True)[: len(groups)]


def _ordered(groups: Groups, a: np.ndarray, b: np.ndarray, ids: int) -> np.ndarray:
    """The tokens group by group, A before B, as id + ``ids`` * sign after it (0 ``,``  1 ``|``  2 ``;``)."""
    of_a, of_b = groups.of_a, groups.of_b
    before_b = np.searchsorted(of_b, of_a)
    until_a = np.searchsorted(of_a, of_b, "right")
    out = np.empty(len(a) + len(b), np.int64)
    out[np.arange(len(a)) + before_b] = a + ids * _last(of_a)
    out[np.arange(len(b)) + until_a] = b + 2 * ids * _last(of_b)
    return out


def _packed(values: np.ndarray) -> bytes:
    """32-bit numbers, compressed plane by plane."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpacked(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    raw = pa.decompress(blob[8:], 4 * n, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, n).T).view("<u4").ravel().astype(np.int64)


def _sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive ``edges``."""
    running = np.append(0, np.cumsum(values))
    return running[edges[1:]] - running[edges[:-1]]


def _kinds(codes: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first group of each kind, kind of each group): groups are of one kind if their links are the same.

    Kinds are found by a hash and compared by their links; the most frequent kind comes first.
    """
    if len(edges) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = np.diff(edges)
    place = np.arange(len(codes)) - np.repeat(edges[:-1], sizes)
    with np.errstate(over="ignore"):
        mixed = mix(codes.view(np.uint64) + mix(place.astype(np.uint64) * _STEP))
        hashes = mix(np.add.reduceat(mixed, edges[:-1]) + sizes.astype(np.uint64))
    _, first, kind, counts = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    # A group that has the hash of another and not its links is a kind of its own.
    model = first[kind]
    same = sizes == sizes[model]
    there = np.minimum(np.repeat(edges[:-1][model], sizes) + place, len(codes) - 1)
    same &= np.add.reduceat(codes != codes[there], edges[:-1]) == 0
    odd = np.flatnonzero(~same)
    kind[odd] = len(first) + np.arange(len(odd))
    first = np.append(first, odd)
    counts = np.append(counts, np.ones(len(odd), np.int64))
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return first[order], rank[kind]


def _spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a space before each."""
    n = len(offsets) - 1
    out = np.full(len(data) + n, 32, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))] = data
    return out, offsets + np.arange(n + 1)


class Aligner:
    """Two tokenizers, with the bytes of their tokens."""

    def __init__(self, a, b):
        self.a, self.b = a, b
        self.a_size = np.array([len(t) for t in a.token], np.int64)
        self.b_size = np.array([len(t) for t in b.token], np.int64)
        self.ids = max(len(a.token), len(b.token))
        self.shown = [str(i).encode() + sign for sign in (b",", b"|", b";") for i in range(self.ids)]

    def tokens(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """(A ids, their number per text, B ids, their number) of the texts; none for empty texts and where the
        bytes of the tokens are not those of space + text."""
        some = np.flatnonzero(np.diff(offsets))
        data, offsets, _ = bpe.repaired(data, offsets)
        data, offsets = _spaced(data, np.append(offsets[some], len(data)))
        a, a_edges = self.a.flat(data, offsets)
        b, b_edges, good = self.b.flat(data, offsets)
        out = []
        for ids, edges in ((a, a_edges), (b, b_edges)):
            counts = np.zeros(len(good), np.int64) + np.diff(edges)
            out += [ids[np.repeat(good, counts)].astype(np.int64), np.where(good, counts, 0)]
        return out[0], out[1], out[2], out[3], some

    def slice(self, data: np.ndarray, offsets: np.ndarray, detail: bool = False) -> dict:
        """Everything about one slice of texts (UTF-8 bytes and offsets), ready to be stored: see ``_SLICE``."""
        a, some_a, b, some_b, some = self.tokens(data, offsets)
        n_a, n_b = np.zeros((2, len(offsets) - 1), np.int64)
        n_a[some], n_b[some] = some_a, some_b
        groups = aligned_groups(self.a_size[a], self.b_size[b])
        a_edges, b_edges = np.append(0, np.cumsum(n_a)), np.append(0, np.cumsum(n_b))
        group_edges = np.append(groups.of_b, groups.count)[b_edges]
        link_edges = np.searchsorted(groups.link_a, a_edges)
        codes = (a[groups.link_a] << 32) | b[groups.link_b]
        edges = np.searchsorted(groups.of_a[groups.link_a], np.arange(groups.count + 1))
        first, kind = _kinds(codes, edges)
        # The ids of a kind are shown once; a text is the kinds of its groups.
        shown = _ordered(groups, a, b, self.ids)
        begin = np.searchsorted(groups.of_a, first) + np.searchsorted(groups.of_b, first)
        end = np.searchsorted(groups.of_a, first, "right") + np.searchsorted(groups.of_b, first, "right")
        named = [b"".join(map(self.shown.__getitem__, shown[s:e].tolist())) for s, e in zip(begin.tolist(), end.tolist())]
        digests, listed = [], []
        for s, e in zip(group_edges[:-1].tolist(), group_edges[1:].tolist()):
            row = b"".join(map(named.__getitem__, kind[s:e].tolist()))[:-1]
            digests.append(hashlib.sha256(row).hexdigest() if e > s else "")
            if detail:
                listed.append(row.decode())
        sizes = (edges[1:] - edges[:-1])[first]
        inner = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        pairs, place = np.unique(codes[np.repeat(edges[:-1][first], sizes) + inner], return_inverse=True)
        often = np.repeat(np.bincount(kind, minlength=len(first)), sizes)
        counts = np.bincount(place, weights=often, minlength=len(pairs)).astype(np.int64)
        return {"n_a": n_a, "n_b": n_b, "n_groups": np.diff(group_edges), "n_links": np.diff(link_edges),
                "groups_sha256": digests, "groups": listed if detail else [None] * len(n_a), "pairs": pairs,
                "counts": counts, "kinds": _packed(kind), "sizes": _packed(sizes), "places": _packed(place)}


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_file: str, b_file: str) -> Aligner:
    """One per worker process and pair of files: paths there, or names of files added with ``addFile``."""
    if (a_file, b_file) not in _aligners:
        a, b = (f if "/" in f else SparkFiles.get(f) for f in (a_file, b_file))
        _aligners[a_file, b_file] = Aligner(ByteLevel(a), Pieces(b))
    return _aligners[a_file, b_file]


_COUNTED = ("n_a", "n_b", "n_groups", "n_links")
#: A slice of documents. ``pairs`` (A id << 32 | B id) are its distinct linked pairs and ``counts`` their
#: links; ``kinds`` the kind of each group, ``sizes`` the links of each kind, ``places`` their pairs' places.
_SLICE = ("slice bigint, doc array<{kind}>, n_pairs int, " + ", ".join(f"{c} array<bigint>" for c in _COUNTED)
          + ", groups_sha256 array<string>, groups array<string>, pairs array<bigint>, counts array<bigint>"
          + ", kinds binary, sizes binary, places binary")


def linked_slices(
    df: DataFrame, doc: str, text: str, a_file: str, b_file: str, detail: bool = False
) -> DataFrame:
    """Encode and align all texts; one row per slice, staged (``_SLICE``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for part in sliced(batches, SLICE_BYTES):
            column = part.column("_text").combine_chunks()
            column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
            out = aligner(a_file, b_file).slice(*utf8(column), detail)
            doc_type = pa.list_(part.schema.field("_doc").type)
            columns = {"slice": pa.array([number], pa.int64()),
                       "doc": pa.array([part.column("_doc").to_pylist()], doc_type),
                       "n_pairs": pa.array([len(out["pairs"])], pa.int32())}
            columns |= {c: pa.array([out[c]], pa.list_(pa.int64())) for c in (*_COUNTED, "pairs", "counts")}
            columns |= {c: pa.array([out[c]], pa.list_(pa.string())) for c in ("groups_sha256", "groups")}
            columns |= {c: pa.array([out[c]], pa.binary()) for c in ("kinds", "sizes", "places")}
            names = [f.split()[0] for f in _SLICE.split(", ")]
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)
            number += 1

    rows = df.select(F.col(doc).alias("_doc"), F.col(text).alias("_text"))
    kind = rows.schema["_doc"].dataType.simpleString()
    return staged(map_arrow(rows, run, _SLICE.format(kind=kind)), "slices")


def pair_counts(slices: DataFrame) -> DataFrame:
    """(pair, n, best) of every pair linked in the corpus; staged. ``best``: no A id has more links with the B id."""
    each = slices.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p")).select("p.pairs", "p.counts")
    counts = staged(each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("n")), "pair-counts")
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    most = counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("most"))
    return staged(counts.withColumn("b", b_id).join(most, "b").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def alignments(
    df: DataFrame, doc: str, text: str, a_file: str, b_file: str, detail: bool = False
) -> DataFrame:
    """Per row: (doc, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), with ``detail`` also
    ``groups``, which is ``a1,a2|b1;a3|b2,b3``: the ids of each group of tokens.

    A group ends where tokens of both sides end. Links are the pairs of overlapping tokens; ``count_sum``
    adds up how often the pair of ids is linked in the corpus, ``n_best`` are the links of which no other A id
    is linked more often with the B id. NULL and empty texts, and those that a tokenizer alters, have no
    tokens: zeros and empty strings. Repeated rows count as often as they occur; extra columns, whatever
    their names, and NULLs in them play no part. An empty table gives no rows.
    """
    prepared(df.sparkSession)
    slices = linked_slices(df, doc, text, a_file, b_file, detail)
    asked = slices.select(F.col("slice").alias("asked"), F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(pair_counts(slices), "pair").select("asked", "place", "n", "best")
    doc_kind = slices.schema["doc"].dataType.elementType.simpleString()
    schema = (f"`{doc}` {doc_kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
              "count_sum bigint, groups_sha256 string" + (", groups string" if detail else ""))

    def run(part: pa.Table, found: pa.Table) -> pa.Table:
        row = {c: part.column(c).combine_chunks() for c in part.schema.names}
        pairs = row["n_pairs"][0].as_py()
        n, best = np.zeros(pairs, np.int64), np.zeros(pairs, np.int64)
        place = found.column("place").to_numpy()
        n[place], best[place] = found.column("n").to_numpy(), found.column("best").to_numpy().astype(np.int64)
        kinds, sizes, places = (_unpacked(row[c][0].as_py()) for c in ("kinds", "sizes", "places"))
        edges = np.append(0, np.cumsum(sizes))
        groups = np.append(0, np.cumsum(row["n_groups"][0].values.to_numpy()))
        columns = {doc: row["doc"][0].values} | {c: row[c][0].values for c in (*_COUNTED, "groups_sha256")}
        for name, values in (("count_sum", n), ("n_best", best)):
            columns[name] = pa.array(_sums(_sums(values[places], edges)[kinds], groups), pa.int64())
        if detail:
            columns["groups"] = row["groups"][0].values
        return pa.table([columns[c] for c in names], names=names)

    names = [doc, *_COUNTED, "n_best", "count_sum", "groups_sha256"] + (["groups"] if detail else [])
    return slices.drop("pairs", "counts").groupBy("slice").cogroup(answers.groupBy("asked")).applyInArrow(run, schema)


def query(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return alignments(table(spark, folder, "documents"), "doc_id", "text",
                      public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
