"""Byte-level BPE: encoding by a rank queue on a hierarchical bitmap, and decoding.

Texts are cut by a pattern, each match is merged on its own. The matches not seen before in
a task share one queue: a bucket per merge rank holds linked-list positions, bitmaps over
the buckets find the lowest rank by find-first-set, and entries that a neighbouring merge
has made stale are skipped. A full bucket is merged as arrays, a small one entry by entry.
The work per match grows with its length times a logarithm, so a match of a million
characters is no special case.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatrace.llm.common import ships_by_value, small_batches, text_slices, worker_memory

#: Bytes of text encoded together.
TEXT_BLOCK = 1 << 20
#: Matches up to this length are remembered, by a worker in two generations of about this
#: many bytes each; a match with its ids takes about so many.
REMEMBERED_LENGTH = 64
REMEMBERED_BYTES = 24 << 20
ENTRY_BYTES = 240
#: Positions of a rank from which they are merged as arrays.
MANY = 48
#: Ranks are grouped by this many bits at each level of the bitmap.
LEVEL_BITS = 6


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file with a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class RankQueue:
    """Buckets of positions by rank, and a hierarchy of bitmaps over the filled ones."""

    def __init__(self, ranks: int) -> None:
        self.buckets: dict[int, list[int]] = {}
        self.levels: list[list[int]] = []
        while True:
            ranks = ((ranks - 1) >> LEVEL_BITS) + 1
            self.levels.append([0] * ranks)
            if ranks == 1:
                break

    def open(self, rank: int, positions: list[int]) -> None:
        """Fill the bucket of a rank that has none."""
        self.buckets[rank] = positions
        for level in self.levels:
            word = rank >> LEVEL_BITS
            before = level[word]
            level[word] = before | 1 << (rank & 63)
            if before:
                return
            rank = word

    def take(self) -> tuple[int, list[int]] | None:
        """The lowest filled rank and its positions in order, found by find-first-set."""
        rank = 0
        for level in reversed(self.levels):
            bits = level[rank]
            if not bits:
                return None
            rank = rank << LEVEL_BITS | (bits & -bits).bit_length() - 1
        at = rank
        for level in self.levels:
            word = at >> LEVEL_BITS
            level[word] &= ~(1 << (at & 63))
            if level[word]:
                break
            at = word
        positions = self.buckets.pop(rank)
        positions.sort()
        return rank, positions


class Vocabulary:
    """Ranks of the tokens, and what every pair of tokens merges into.

    A token's rank is its id. ``keys`` holds left * size + right of all pairs that merge,
    sorted, and ``ranks_of`` their ranks. ``plain`` marks the ranks whose tokens form no pair
    of a lower rank: however many of them are merged at once, none has to wait for another.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.size = size = max(ranks.values()) + 1
        found: dict[int, int] = {}
        rank_of = ranks.get
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left = rank_of(token[:cut])
                if left is not None:
                    right = rank_of(token[cut:])
                    if right is not None:
                        found[left * size + right] = rank
        keys = np.fromiter(found.keys(), np.int64, len(found))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.ranks_of = np.append(np.fromiter(found.values(), np.int64, len(found))[order], -1)
        plain = np.ones(size, bool)
        plain[(self.keys // size)[:-1][self.ranks_of[:-1] < (self.keys // size)[:-1]]] = False
        plain[(self.keys % size)[:-1][self.ranks_of[:-1] < (self.keys % size)[:-1]]] = False
        self.plain = plain.tolist()
        self.byte_ids = np.array([rank_of(bytes((b,)), -1) for b in range(256)], np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of tokens, -1 where it does not merge."""
        key = left * self.size + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks_of[at], -1)


def _grouped(positions: np.ndarray, ranks: np.ndarray) -> Iterator[tuple[int, list[int]]]:
    """Positions by rank, those without one left out."""
    order = np.argsort(ranks, kind="stable")
    order = order[np.searchsorted(ranks[order], 0) :]
    ranks = ranks[order]
    begins = np.flatnonzero(np.concatenate(([True], ranks[1:] != ranks[:-1]))) if len(ranks) else ranks
    found, stops = positions[order].tolist(), [*begins[1:].tolist(), len(order)]
    for rank, begin, stop in zip(ranks[begins].tolist(), begins.tolist(), stops):
        yield rank, found[begin:stop]


class Merger:
    """Pieces joined in one buffer, merged in one queue; links never cross pieces.

    A part starts at its position; the next one of its piece starts at ``follow``, the one
    before at ``back``; ``current`` is the rank of the pair that starts here. Single entries
    are taken from the arrays, many from numpy views of the same memory.
    """

    def __init__(self, pieces: list[bytes], words: Vocabulary) -> None:
        self.words = words
        self.buffer = b"".join(pieces)
        size = len(self.buffer)
        self.ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        tokens = words.byte_ids[np.frombuffer(self.buffer, np.uint8)]
        if (tokens < 0).any():
            raise ValueError("the vocabulary has no token for some byte of the text")
        current = np.full(size, -1, np.int64)
        current[:-1] = words.merged(tokens[:-1], tokens[1:])
        current[self.ends - 1] = -1
        self.follow = array("q", np.arange(1, size + 1).tobytes())
        self.back = array("q", np.arange(-1, size - 1).tobytes())
        self.token, self.current = array("q", tokens.tobytes()), array("q", current.tobytes())
        self.first, self.last = bytearray(size), bytearray(size)
        self.views = [np.frombuffer(x, np.int64) for x in (self.follow, self.back, self.token, self.current)]
        self.flags = [np.frombuffer(x, np.uint8) for x in (self.first, self.last)]
        self.flags[0][np.append(0, self.ends[:-1])] = 1
        self.flags[1][self.ends - 1] = 1
        self.queue = RankQueue(words.size)
        for rank, positions in _grouped(np.arange(size), current):
            self.queue.open(rank, positions)

    def run(self) -> tuple[np.ndarray, np.ndarray]:
        """All token ids, and where those of each piece end."""
        plain = self.words.plain
        while (entry := self.queue.take()) is not None:
            rank, positions = entry
            if len(positions) >= MANY and plain[rank]:
                self._merge_many(rank, positions)
            else:
                self._merge_each(rank, positions)
        # merged-away positions have no token
        token = self.views[2]
        there = token >= 0
        return token[there], np.cumsum(there)[self.ends - 1]

    def _add(self, rank: int, positions: list[int]) -> None:
        if rank in self.queue.buckets:
            self.queue.buckets[rank] += positions
        else:
            self.queue.open(rank, positions)

    def _merge_many(self, rank: int, positions: list[int]) -> None:
        """All positions of a plain rank at once, stale ones skipped."""
        follow, back, token, current = self.views
        first, last = self.flags
        at = np.array(positions, np.int64)
        at.sort()
        at = at[current[at] == rank]
        if not len(at):
            return
        at = at[np.concatenate(([True], at[1:] != at[:-1]))]
        # of pairs that overlap in a row, every other one, from the left
        chained = np.concatenate(([False], at[1:] == follow[at[:-1]]))
        if chained.any():
            number = np.arange(len(at))
            opens = np.maximum.accumulate(np.where(chained, 0, number))
            at = at[(number - opens) % 2 == 0]
        gone = follow[at]
        end = follow[gone]
        token[at], token[gone], current[gone] = rank, -1, -1
        follow[at] = end
        last[at] = last[gone]
        inner = last[at] == 0
        back[end[inner]] = at[inner]
        right = np.full(len(at), -1)
        right[inner] = self.words.merged(token[at[inner]], token[end[inner]])
        current[at] = right
        open_left = at[first[at] == 0]
        before = back[open_left]
        left = self.words.merged(token[before], token[open_left])
        current[before] = left
        for new, found in _grouped(np.concatenate([at, before]), np.concatenate([right, left])):
            self._add(new, found)

    def _merge_each(self, rank: int, positions: list[int]) -> None:
        """Positions one by one; a lower rank that comes up goes first."""
        follow, back, token, current = self.follow, self.back, self.token, self.current
        first, last, buffer, rank_of = self.first, self.last, self.buffer, self.words.ranks.get
        lowest = rank
        for done, i in enumerate(positions, 1):
            if current[i] != rank:
                continue  # stale
            j = follow[i]
            end = follow[j]
            follow[i] = end
            token[i] = rank
            token[j] = current[j] = -1
            if last[j]:
                last[i] = 1
                current[i] = -1
            else:
                back[end] = i
                current[i] = new = rank_of(buffer[i : follow[end]], -1)
                if new >= 0:
                    self._add(new, [i])
                    if new < lowest:
                        lowest = new
            if not first[i]:
                before = back[i]
                current[before] = new = rank_of(buffer[before:end], -1)
                if new >= 0:
                    self._add(new, [before])
                    if new < lowest:
                        lowest = new
            if lowest < rank:
                if rest := positions[done:]:
                    self.queue.open(rank, rest)
                return


def merge(pieces: list[bytes], words: Vocabulary) -> list[bytes]:
    """Token ids of each piece, as little-endian unsigned 32-bit integers."""
    if not any(pieces):
        return [b""] * len(pieces)
    ids, ends = Merger(pieces, words).run()
    data = ids.astype("<u4").tobytes()
    stops = (4 * ends).tolist()
    return [data[a:b] for a, b in zip([0, *stops], stops)]


class Encoder:
    """Token ids of texts; remembers the matches it has merged, within a bound.

    Matches are remembered in two generations. When the young one is full it becomes the
    old one, whose matches come back when they are met again, so that common ones stay.
    """

    def __init__(self, words: Vocabulary, pattern: str) -> None:
        self.words = words
        self.find = regex.compile(pattern).findall
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self.find(text) for text in texts]
        if self.size > REMEMBERED_BYTES:
            self.old, self.young, self.size = self.young, {}, 0
        young, old, rank_of = self.young, self.old, self.words.ranks.get
        open_pieces, raw, long_pieces = [], [], []
        for piece in set(chain.from_iterable(cut)).difference(young):
            ids = old.get(piece)
            if ids is None:
                data = piece.encode("utf-8", "replace")
                rank = rank_of(data)
                if rank is None:
                    open_pieces.append(piece)
                    raw.append(data)
                    continue
                ids = rank.to_bytes(4, "little")
            young[piece] = ids
            self.size += ENTRY_BYTES
        for piece, ids in zip(open_pieces, merge(raw, self.words)):
            young[piece] = ids
            if len(piece) > REMEMBERED_LENGTH:
                long_pieces.append(piece)
            else:
                self.size += ENTRY_BYTES
        out = [b"".join(map(young.__getitem__, pieces)) for pieces in cut]
        for piece in long_pieces:
            del young[piece]
        return out


class Ranks(NamedTuple):
    """A vocabulary and a digest that tells it from others."""

    ranks: dict[bytes, int]
    digest: str


def shared_ranks(spark: SparkSession, path: str):
    """The vocabulary as a broadcast: read on the driver, its size does not depend on data."""
    small_batches(spark)
    ranks = read_ranks(path)
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(Ranks(ranks, hashlib.sha256(file.read()).hexdigest()))


def encoder_of(shared: Ranks, pattern: str) -> Encoder:
    """The worker's encoder: a task goes on with the matches that earlier ones have met."""
    kept, key = worker_memory(), (shared.digest, pattern)
    if kept.get("bpe", (None,))[0] != key:
        kept["bpe"] = key, Encoder(Vocabulary(shared.ranks), pattern)
    return kept["bpe"][1]


def text_blocks(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch with about TEXT_BLOCK bytes each, and their texts."""
    for begin, stop in text_slices(batch.column(column), TEXT_BLOCK):
        part = batch.slice(begin, stop - begin)
        yield part, [text or "" for text in part.column(column).to_pylist()]


def _encoded(batches: Iterator[pa.RecordBatch], shared: Ranks, pattern: str) -> Iterator[pa.RecordBatch]:
    encoder = encoder_of(shared, pattern)
    for batch in batches:
        for part, texts in text_blocks(batch):
            ids = pa.array(encoder.encode(texts), pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), ids], names=["doc_id", "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], shared: Ranks) -> Iterator[pa.RecordBatch]:
    token = {rank: data for data, rank in shared.ranks.items()}.__getitem__
    for batch in batches:
        for begin, stop in text_slices(batch.column("ids"), TEXT_BLOCK):
            part = batch.slice(begin, stop - begin)
            ids = (np.frombuffer(x.as_buffer() or b"", "<u4").tolist() for x in part.column("ids"))
            yield part.append_column("decoded", pa.array([b"".join(map(token, x)) for x in ids], pa.binary()))


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and ids (unsigned 32-bit little-endian) of every row of ``docs``.

    ``docs`` needs doc_id and text; other columns are not read. Null and empty texts have no
    ids; rows that repeat a doc_id are encoded each; a null doc_id stays null.
    """
    shared = shared_ranks(docs.sparkSession, ranks_path)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lambda batches: _encoded(batches, shared.value, pattern), "doc_id long, ids binary"
    )


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, ids and the bytes (``decoded``) that the ids stand for; null ids decode to none."""
    shared = shared_ranks(encoded.sparkSession, ranks_path)
    return encoded.select("doc_id", "ids").mapInArrow(
        lambda batches: _decoded(batches, shared.value), "doc_id long, ids binary, decoded binary"
    )


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``decode(encode(docs))`` with both steps in the same task."""
    shared = shared_ranks(docs.sparkSession, ranks_path)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lambda batches: _decoded(_encoded(batches, shared.value, pattern), shared.value),
        "doc_id long, ids binary, decoded binary",
    )


def round_trip_digest(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row of ``docs``."""
    return round_trip(docs, ranks_path, pattern).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


ships_by_value(__name__)
