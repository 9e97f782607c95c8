"""Byte-level BPE by replaying all merges over the distinct words of a slice of the corpus.

Texts are split by the pre-tokenizer's pattern, vectorised over code points. The distinct pieces of
some megabytes of text are then encoded together: an inverted index from merge ranks to the positions
of their token pairs applies the merges in rank order, all occurrences at once, and only the pairs
next to a merge are looked up again. Documents are put together from their pieces.

Equal pairs of a word are merged together, as long as the token they make is in no pair of a lower
rank; the few tokens that are merge one at a time, leftmost first. So the result is that of merging
one lowest pair at a time.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from wickline.llm.common import map_arrow, prepared, sliced, table, utf8, word_hashes

# Bytes of text whose pieces are encoded together. Bounds the memory of a task, whatever the texts;
# a longer single text is still taken whole.
SLICE_BYTES = 3 << 20
# Ranks that share an entry of the inverted index. Inside an entry, each word takes its lowest.
BAND = 512
NEVER = np.int32(2**31 - 1)

LETTER, NUMBER, SPACE, OTHER = range(4)
# The contractions that the pattern takes before anything else.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def _distinct(places: np.ndarray) -> np.ndarray:
    places.sort()
    return places[np.append(True, places[1:] != places[:-1])] if len(places) else places


class Ranks:
    """A rank file: token bytes to id, and the merge that a pair of ids makes."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ids = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.token = [b""] * (max(self.ids.values()) + 1)
        for token, rank in self.ids.items():
            self.token[rank] = token
        self.byte = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        left, right, made = [], [], []
        # Tokens that are part of a token of lower rank.
        self.upsets = np.zeros(len(self.token), bool)
        for token, rank in self.ids.items():
            for cut in range(1, len(token)):
                a, b = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if a is not None and b is not None:
                    self.upsets[[part for part in (a, b) if part > rank]] = True
                    left.append(a)
                    right.append(b)
                    made.append(rank)
        self._store(np.array(left, np.int64), np.array(right, np.int64), np.array(made, np.int32))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _store(self, left: np.ndarray, right: np.ndarray, made: np.ndarray) -> None:
        """Open addressing with linear probes, at most a quarter full."""
        self.bits = max(4, int(np.ceil(np.log2(4 * len(made) + 1))))
        keys = (left << 32) | right
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.made = np.full(1 << self.bits, NEVER, np.int32)
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[at[todo]] == -1
            self.keys[at[todo[free]]] = keys[todo[free]]
            won = self.keys[at[todo]] == keys[todo]
            self.made[at[todo[won]]] = made[todo[won]]
            todo = todo[~won]
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair makes, ``NEVER`` if it makes none."""
        keys = (left.astype(np.int64) << 32) | right
        at = self._slot(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, self.made[at], NEVER)
        todo = np.flatnonzero((seen != keys) & (seen != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            seen = self.keys[at[todo]]
            hit = seen == keys[todo]
            out[todo[hit]] = self.made[at[todo[hit]]]
            todo = todo[~hit & (seen != -1)]
        return out

    def replay(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Encode words (bytes and offsets): (ids, offsets of each word's ids)."""
        n = len(data)
        if n == 0:
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        token = self.byte[data]
        word = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        ends = offsets[1:][np.diff(offsets) > 0] - 1
        begins = offsets[:-1][np.diff(offsets) > 0]
        after[ends], before[begins] = n, -1
        rank = np.full(n, NEVER, np.int32)
        rank[:-1] = self.merged(token[:-1], token[1:])
        rank[ends] = NEVER
        alive = np.ones(n, bool)
        index: dict[int, list[np.ndarray]] = {}
        todo: list[int] = []

        def enter(places: np.ndarray) -> None:
            places = places[rank[places] != NEVER]
            bands = rank[places] // BAND
            order = np.argsort(bands, kind="stable")
            places, bands = places[order], bands[order]
            cuts = np.flatnonzero(np.diff(bands)) + 1
            for one, band in zip(np.split(places, cuts), bands[np.append(0, cuts)] if len(bands) else ()):
                if int(band) not in index:
                    index[int(band)] = []
                    heapq.heappush(todo, int(band))
                index[int(band)].append(one)

        enter(np.arange(n))
        while todo:
            band = heapq.heappop(todo)
            here = _distinct(np.concatenate(index.pop(band)))
            here = here[rank[here] // BAND == band]
            while len(here):
                ranks, words = rank[here], word[here]
                first = np.append(True, words[1:] != words[:-1])
                low = np.minimum.reduceat(ranks, np.flatnonzero(first))
                chosen = ranks == low[np.cumsum(first) - 1]
                left, words = here[chosen], words[chosen]
                again = np.append(False, words[1:] == words[:-1])
                left = left[~(again & self.upsets[rank[left]])]
                # Overlapping occurrences: every second one of a chain, from the left.
                chained = np.append(False, after[left[:-1]] == left[1:])
                order = np.arange(len(left))
                left = left[(order - np.maximum.accumulate(np.where(chained, 0, order))) % 2 == 0]
                right = after[left]
                token[left] = rank[left]
                alive[right] = False
                rank[right] = NEVER
                follow = after[right]
                after[left] = follow
                inner = follow < n
                before[follow[inner]] = left[inner]
                rank[left] = NEVER
                rank[left[inner]] = self.merged(token[left[inner]], token[follow[inner]])
                lead = before[left]
                ahead = lead >= 0
                rank[lead[ahead]] = self.merged(token[lead[ahead]], token[left[ahead]])
                touched = np.concatenate([left, lead[ahead]])
                own = rank[touched] // BAND == band
                enter(touched[~own])
                here = _distinct(np.concatenate([here, touched[own]]))
                here = here[rank[here] // BAND == band]
                if todo and todo[0] < band:
                    enter(here)
                    break
        counts = np.bincount(word[alive], minlength=len(offsets) - 1)
        return token[alive], np.append(0, np.cumsum(counts))


def _classes() -> np.ndarray:
    """Class of every code point, asked from the pattern's own classes."""
    every = "".join(map(chr, [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]))
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, name in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for run in regex.finditer(name, every):
            a, b = ord(every[run.start()]), ord(every[run.end() - 1])
            out[a : b + 1] = kind
    return out


def pieces(points: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Starts of the pattern's matches, as positions of code points. Every point belongs to a match.

    ``offsets`` bound the texts. A run of letters, of numbers or of other signs is a match with one
    blank before it. A run of white space gives up its last sign when something follows: a blank
    joins what follows, another sign stands alone. An apostrophe that begins a match takes the
    letters of a contraction with it.
    """
    n = len(points)
    if n == 0:
        return np.zeros(0, np.int64)
    kind = classes[points]
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    change = border[:-1].copy()
    change[1:] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(change)
    run_kind = kind[run]
    run_end = np.append(run[1:], n)
    blank = run_kind == SPACE
    # The last sign of white space that something follows in the same text.
    gives = blank & ~border[run_end]
    last = run_end[gives] - 1
    starts = np.zeros(n, bool)
    starts[run] = True
    starts[last] = True
    joins = points[last] == 32
    starts[last[joins] + 1] = False
    quote = run[(run_kind == OTHER) & (run_end - run == 1)]
    quote = quote[(points[quote] == 39) & starts[quote]]
    for text in CONTRACTIONS:
        fits = quote + len(text) < n
        for i, letter in enumerate(text, 1):
            at = np.minimum(quote + i, n - 1)
            fits &= (points[at] == ord(letter)) & ~border[at]
        taken = quote[fits]
        starts[taken + 1] = False
        rest = taken + 1 + len(text)
        rest = rest[rest < n]
        starts[rest] = True
        quote = quote[~fits]
    return np.flatnonzero(starts)


def repaired(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, str]:
    """The texts as one string; bytes that are not UTF-8 become replacement characters."""
    raw = data.tobytes()
    try:
        return data, offsets, raw.decode()
    except UnicodeDecodeError:
        rows = [raw[a:b].decode(errors="replace").encode() for a, b in zip(offsets[:-1], offsets[1:])]
        raw = b"".join(rows)
        return np.frombuffer(raw, np.uint8), np.append(0, np.cumsum([len(r) for r in rows])), raw.decode()


def told_apart(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(word of each piece, first piece of each word). Pieces of one hash are one word if their bytes are equal;
    the others of that hash are words of their own."""
    _, first, word = np.unique(hashes, return_index=True, return_inverse=True)
    if not len(starts):
        return word, first
    sizes, model = ends - starts, first[word]
    edges = np.cumsum(sizes) - sizes
    inner = np.arange(int(sizes.sum())) - np.repeat(edges, sizes)
    there = np.minimum(np.repeat(starts[model], sizes) + inner, len(data) - 1)
    here = np.repeat(starts, sizes) + inner
    odd = np.flatnonzero((sizes != sizes[model]) | (np.add.reduceat(data[here] != data[there], edges) > 0))
    word[odd] = len(first) + np.arange(len(odd))
    return word, np.append(first, odd)


class Coder:
    """Encodes and decodes whole texts with one rank file."""

    def __init__(self, ranks: str | Ranks):
        self.ranks = Ranks(ranks) if isinstance(ranks, str) else ranks
        self.classes = _classes()
        # Tokens that merging does not reach: a piece that is one of them is taken whole.
        raw = np.frombuffer(b"".join(self.ranks.token), np.uint8)
        bounds = np.append(0, np.cumsum([len(t) for t in self.ranks.token]))
        lone = np.flatnonzero(np.diff(self.ranks.replay(raw, bounds)[1]) > 1)
        hashes = word_hashes(raw, bounds[lone], bounds[lone + 1])
        order = np.argsort(hashes)
        self.lone, self.lone_hashes = lone[order].astype(np.int32), hashes[order]
        self.shown = [str(i).encode() for i in range(len(self.ranks.token))]

    def words(self, data: np.ndarray, offsets: np.ndarray):
        """(ids and offsets of the distinct pieces, index of each piece's word, first piece of each text)."""
        data, offsets, text = repaired(data, offsets)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        begins = pieces(points, np.searchsorted(lead, offsets), self.classes)
        starts = lead[begins]
        ends = np.append(starts[1:], len(data))
        hashes = word_hashes(data, starts, ends)
        word, first = told_apart(data, starts, ends, hashes)
        sizes = ends[first] - starts[first]
        bounds = np.append(0, np.cumsum(sizes))
        own = data[np.repeat(starts[first] - bounds[:-1], sizes) + np.arange(bounds[-1])]
        ids, edges = self._whole(own, bounds, hashes[first], *self.ranks.replay(own, bounds))
        return ids, edges, word, np.searchsorted(starts, offsets)

    def _whole(
        self, data: np.ndarray, bounds: np.ndarray, hashes: np.ndarray, ids: np.ndarray, edges: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Put the tokens that merging does not reach in the place of their words' ids."""
        if not len(self.lone):
            return ids, edges
        at = np.minimum(np.searchsorted(self.lone_hashes, hashes), len(self.lone) - 1)
        hit = self.lone_hashes[at] == hashes
        for i in np.flatnonzero(hit).tolist():
            hit[i] = data[bounds[i] : bounds[i + 1]].tobytes() == self.ranks.token[self.lone[at[i]]]
        if not hit.any():
            return ids, edges
        counts = np.diff(edges)
        kept = np.repeat(~hit, counts)
        word = np.concatenate([np.repeat(np.arange(len(hashes)), counts)[kept], np.flatnonzero(hit)])
        ids = np.concatenate([ids[kept], self.lone[at[hit]]])[np.argsort(word, kind="stable")]
        return ids, np.append(0, np.cumsum(np.where(hit, 1, counts)))

    def flat(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, offsets of each text's ids)."""
        ids, bounds, word, first = self.words(data, offsets)
        sizes = np.diff(bounds)[word]
        ends = np.append(0, np.cumsum(sizes))
        return ids[np.repeat(bounds[:-1][word] - ends[:-1], sizes) + np.arange(ends[-1])], ends[first]

    def encode(self, texts: list[str]) -> list[list[int]]:
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        ids, edges = self.flat(data, np.append(0, np.cumsum([len(r) for r in raw])).astype(np.int64))
        return [ids[a:b].tolist() for a, b in zip(edges[:-1], edges[1:])]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.ranks.token.__getitem__, ids))

    def digests(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[int], list[str], list[str]]:
        """Per text: number of ids, SHA-256 of the ids in decimal, SHA-256 of the decoded bytes."""
        ids, edges = self.flat(data, offsets)
        listed, decoded = [], []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            own = ids[a:b].tolist()
            listed.append(hashlib.sha256(b" ".join(map(self.shown.__getitem__, own))).hexdigest())
            decoded.append(hashlib.sha256(self.decode(own)).hexdigest())
        return np.diff(edges).tolist(), listed, decoded


_coders: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    """One coder per worker process and rank file."""
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def encoded(df: DataFrame, doc: str, text: str, rank_file: str) -> DataFrame:
    """Encode and decode every text whole: (doc, n_tokens, ids_sha256, decoded_sha256).

    ``rank_file`` is read by every worker: a path that exists there, or the name of a file added with
    ``addFile``. Special tokens are ordinary text. NULL and empty texts have no tokens and the digest
    of nothing. Rows are independent: nulls elsewhere, repeated rows and extra columns change nothing;
    an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for part in sliced(batches, SLICE_BYTES):
            own = own or coder(rank_file if "/" in rank_file else SparkFiles.get(rank_file))
            column = part.column("_text").combine_chunks()
            column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
            totals, listed, decoded = own.digests(*utf8(column))
            yield pa.RecordBatch.from_arrays([
                part.column("_doc").combine_chunks(), pa.array(totals, pa.int64()),
                pa.array(listed, pa.string()), pa.array(decoded, pa.string())],
                names=[doc, "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = df.select(df[doc].alias("_doc"), df[text].alias("_text"))
    kind = rows.schema["_doc"].dataType.simpleString()
    return map_arrow(rows, run, f"`{doc}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    import public_tokenizers

    prepared(spark)
    return encoded(docs, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.tiktoken"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return stage(spark, table(spark, folder, "documents"), folder)
