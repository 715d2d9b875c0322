"""Where windows of a fixed length occur in a document with a smaller id: the frame that
suffix-array dedup (bytes) and suffix-automaton dedup (words) share.

Documents are dealt to chunks once; all passes below read that same shuffle.

1. Every window has an anchor: its k-gram with the smallest hash. Equal windows have equal
   anchors. A chunk sends 32-bit residues of its distinct anchors to their buckets, and is
   told which of them other chunks have too, a bit for each.
2. Windows in a row with one anchor form a fragment. A chunk sends the hashes of its distinct
   fragments with a repeated anchor, each with the smallest doc_id that has it, and learns
   the smallest doc_id of all chunks.
3. Where an anchor has several different fragments, the chunk of a fragment's smallest doc_id
   is asked for its text. The bucket solves these: which windows of a fragment occur in a
   fragment of a still smaller doc_id.
4. The chunk marks the windows of its documents.

Copies collapse within a chunk before anything is sent, so a passage that a third of all
documents share costs a row per chunk. At its edges every document differs: an anchor with
very many different fragments is crowded, and its windows are dealt out one by one, by the
hash of the whole window, so that no bucket gathers them. Nothing is capped or sampled.

A document must fit a task's memory some twenty-fold. Hashes have 64 bits; the residues of
the first pass only ever add candidates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatrace.llm.arrays import BYTE_CODE, Hasher, Powers, mixed, word_hashes
from seatrace.llm.common import ships_by_value, shuffle_partitions

U64 = np.uint64
#: Text of a chunk, and of what is hashed at a time.
CHUNK_BYTES = 8 << 20
BLOCK_BYTES = 1 << 20
#: An anchor with more fragments than this, beyond one for each chunk, is dealt out by window.
CROWDED_FRAGMENTS = 2000
POSITION_BITS = 24
POSITION = U64((1 << POSITION_BITS) - 1)

#: (fragments, their smallest doc_ids, their groups, window) -> for each fragment, which of
#: its windows a fragment of its group with a smaller doc_id holds. Fragments come by group
#: and doc_id; groups share an anchor.
Solver = Callable[[list[bytes], np.ndarray, np.ndarray, int], list[np.ndarray]]


@dataclass(frozen=True)
class Task:
    """What a symbol is, how long a window and its anchors are, and how groups are solved."""

    words: bool
    window: int
    gram: int
    buckets: int
    solve: Solver
    whole_characters: bool = False


class Block(NamedTuple):
    """Some documents of a chunk as one sequence of symbols, and their runs of windows."""

    data: np.ndarray  # bytes
    starts: np.ndarray  # of each symbol, in data
    ends: np.ndarray
    bounds: np.ndarray  # of each document, in symbols
    hasher: Hasher
    first: np.ndarray  # first window of each run
    last: np.ndarray
    anchor: np.ndarray  # uniform 64-bit key
    document: np.ndarray  # of each run, within the block


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


def read_block(texts: list[bytes], task: Task, powers: Powers) -> Block:
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    if task.words:
        data = np.frombuffer(b"\n".join(texts), np.uint8)
        starts, ends, codes = word_hashes(data, powers)
        begins = np.concatenate(([0], np.cumsum(sizes + 1)))
        bounds = np.searchsorted(starts, begins)
    else:
        data = np.frombuffer(b"".join(texts), np.uint8)
        starts = ends = np.empty(0, np.int64)
        codes = BYTE_CODE[data]
        bounds = np.concatenate(([0], np.cumsum(sizes)))
    hasher = Hasher(codes, powers)
    none = np.empty(0, np.int64)
    if len(codes) < task.window:
        return Block(data, starts, ends, bounds, hasher, none, none, none.astype(U64), none)
    grams = hasher.grams(task.gram)
    first, last, at = [], [], []
    # parts of a long sequence overlap by a window, so positions fit their bits
    part = (1 << POSITION_BITS) - task.window
    for begin in range(0, len(codes) - task.window + 1, part):
        end = min(len(codes), begin + part + task.window - 1)
        own = grams[begin : end - task.gram + 1]
        keyed = (own & ~POSITION) | np.arange(len(own), dtype=U64)
        chosen = (_sliding_min(keyed, task.window - task.gram + 1) & POSITION).astype(np.int64)
        edge = np.zeros(len(chosen) + 1, np.int32)
        low = np.clip(bounds[:-1] - begin, 0, len(chosen))
        high = np.clip(bounds[1:] - task.window + 1 - begin, 0, len(chosen))
        whole = high > low
        np.add.at(edge, low[whole], 1)
        np.add.at(edge, high[whole], -1)
        windows = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
        if not len(windows):
            continue
        picked = chosen[windows]
        new = np.concatenate(([True], picked[1:] != picked[:-1]))
        first.append(windows[new] + begin)
        last.append(windows[np.concatenate((new[1:], [True]))] + begin)
        at.append(picked[new] + begin)
    if not first:
        return Block(data, starts, ends, bounds, hasher, none, none, none.astype(U64), none)
    first, last, at = map(np.concatenate, (first, last, at))
    anchor = mixed(grams[at] + U64(1))
    document = np.searchsorted(bounds, first, side="right") - 1
    return Block(data, starts, ends, bounds, hasher, first, last, anchor, document)


def _documents(table: pa.Table) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Texts, ids (null: 0) and whether the id is known."""
    known = table.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
    ids = table.column("doc_id").fill_null(0).to_numpy().astype(np.int64)
    return table.column("text").to_pylist(), ids, known


def _blocks(table: pa.Table, task: Task) -> Iterator[tuple[Block, np.ndarray, np.ndarray, slice]]:
    """Blocks of a chunk with their documents' ids, whether each run counts, and which rows."""
    powers = Powers()
    texts, ids, known = _documents(table)
    begin, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= BLOCK_BYTES or i == len(texts) - 1:
            rows = slice(begin, i + 1)
            block = read_block(texts[rows], task, powers)
            yield block, ids[rows], known[rows][block.document], rows
            begin, size = i + 1, 0


def _key(anchor: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 32-bit residue of an anchor."""
    return (anchor % U64(buckets)).astype(np.int64), (anchor // U64(buckets)).astype(np.uint32)


def _split(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal values of a sorted array."""
    if len(bucket):
        edges = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            yield int(bucket[a]), slice(a, b)


def _rows_of(names: str, **kinds: str) -> tuple[str, pa.Schema]:
    """A schema of binary columns, or of the kinds named, for Spark and for Arrow."""
    arrow = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    columns = [(name, kinds.get(name, "binary")) for name in names.split()]
    return ", ".join(f"{n} {k}" for n, k in columns), pa.schema([(n, arrow[k]) for n, k in columns])


#: Rows between chunks and buckets; binary columns are packed arrays.
ANCHORS, ANCHORS_ARROW = _rows_of("bucket chunk residues many more", bucket="long", chunk="long")
SHARED, SHARED_ARROW = _rows_of("bucket chunk shared crowded", bucket="long", chunk="long")
FRAGMENTS, FRAGMENTS_ARROW = _rows_of(
    "bucket chunk crowded ids residues docs several", bucket="long", chunk="long", crowded="boolean"
)
#: ids are fragments with their docs, or with masks if these are there; windows stand alone.
ANSWERS, ANSWERS_ARROW = _rows_of(
    "chunk ids docs masks wanted windows anchors window_docs", chunk="long"
)
TEXTS, TEXTS_ARROW = _rows_of("bucket chunk ids residues docs sizes data", bucket="long", chunk="long")


def _packed_ids(ids: np.ndarray) -> bytes:
    """doc_ids in 32 bits where they fit; a leading byte tells."""
    if len(ids) and 0 <= ids.min() and ids.max() < 1 << 32:
        return b"\4" + ids.astype(np.uint32).tobytes()
    return b"\10" + ids.tobytes()


def _unpacked_ids(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint32 if data[:1] == b"\4" else np.int64, offset=1).astype(np.int64)


def _bits(data: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=count).astype(bool)


def _residues(
    found: list[np.ndarray], fragments: list[np.ndarray], task: Task
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Sorted distinct residues of a chunk's anchors by bucket, and how many fragments each
    has beyond one."""
    _, at = np.unique(np.concatenate([np.empty(0, U64), *fragments]), return_index=True)
    anchors, counts = np.unique(np.concatenate([np.empty(0, U64), *found])[at], return_counts=True)
    bucket, residue = _key(anchors, task.buckets)
    order = np.lexsort((residue, bucket))
    residue, counts = residue[order], counts[order]
    for b, part in _split(bucket[order]):
        own, first = np.unique(residue[part], return_index=True)
        yield b, own, np.add.reduceat(counts[part], first) - 1


def _fragments(block: Block, run: np.ndarray, task: Task) -> np.ndarray:
    return block.hasher.spans(block.first[run], block.last[run] + task.window)


def _send_anchors(key: tuple, table: pa.Table, task: Task) -> pa.Table:
    found, fragments = [], []
    for block, _, use, _ in _blocks(table, task):
        found.append(block.anchor[use])
        fragments.append(_fragments(block, use, task))
    rows = []
    for b, residues, more in _residues(found, fragments, task):
        many = np.flatnonzero(more)
        rows.append(
            {
                "bucket": b, "chunk": key[0].as_py(), "residues": residues.tobytes(),
                "many": many.astype(np.uint32).tobytes(), "more": more[many].astype(np.uint32).tobytes(),
            }
        )
    return pa.Table.from_pylist(rows, schema=ANCHORS_ARROW)


def _share_anchors(key: tuple, table: pa.Table) -> pa.Table:
    """For each chunk, which of its residues some other chunk has as well, in their order."""
    sent = [np.frombuffer(x, np.uint32) for x in table.column("residues").to_pylist()]
    values, counts = np.unique(np.concatenate(sent), return_counts=True)
    beyond = np.zeros(len(values), np.int64)
    for residues, many, more in zip(sent, *(table.column(x).to_pylist() for x in ("many", "more"))):
        where = np.searchsorted(values, residues[np.frombuffer(many, np.uint32)])
        beyond[where] += np.frombuffer(more, np.uint32)
    crowded = values[beyond > CROWDED_FRAGMENTS]
    # an anchor of one chunk is shared if it is crowded, so that its chunk learns of it
    shared = values[(counts > 1) | (beyond > CROWDED_FRAGMENTS)]
    rows = []
    for chunk, residues in zip(table.column("chunk").to_pylist(), sent):
        own = np.isin(residues, shared, assume_unique=True)
        if own.any():
            crowd = np.isin(residues, crowded, assume_unique=True)
            rows.append(
                {
                    "bucket": key[0].as_py(), "chunk": chunk, "shared": np.packbits(own).tobytes(),
                    "crowded": np.packbits(crowd).tobytes() if crowd.any() else b"",
                }
            )
    return pa.Table.from_pylist(rows, schema=SHARED_ARROW)


def _member(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Positions of ``x`` in sorted distinct values, -1 where it is not there."""
    if not len(sorted_values):
        return np.full(len(x), -1)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return np.where(sorted_values[at] == x, at, -1)


def _shared_keys(
    found: list[np.ndarray], fragments: list[np.ndarray], shared: pa.Table, task: Task
) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of the chunk's anchors that other chunks have, and whether each is crowded."""
    told = {row["bucket"]: row for row in shared.to_pylist()}
    keys, crowded = [np.empty(0, U64)], [np.empty(0, bool)]
    for bucket, residues, _ in _residues(found, fragments, task):
        if row := told.get(bucket):
            own = _bits(row["shared"], len(residues))
            keys.append(residues[own].astype(U64) * U64(task.buckets) + U64(bucket))
            crowd = _bits(row["crowded"], len(residues)) if row["crowded"] else np.zeros(len(own), bool)
            crowded.append(crowd[own])
    keys, crowded = np.concatenate(keys), np.concatenate(crowded)
    order = np.argsort(keys)
    return keys[order], crowded[order]


def _windows(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Run and position of every window of the runs."""
    count = last - first + 1
    run = np.repeat(np.arange(len(first)), count)
    return run, np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count) + first[run]


def _send_fragments(key: tuple, table: pa.Table, shared: pa.Table, task: Task) -> pa.Table:
    """Hashes of the chunk's fragments, and of single windows where an anchor is crowded."""
    plain, single = [], []
    for block, ids, run, crowd in _candidates(table, shared, task):
        own = run[~crowd]
        plain.append(
            (
                _fragments(block, own, task),
                block.anchor[own],
                ids[block.document[own]],
            )
        )
        own = run[crowd]
        which, window = _windows(block.first[own], block.last[own])
        single.append(
            (
                block.hasher.spans(window, window + task.window),
                block.anchor[own][which],
                ids[block.document[own]][which],
            )
        )
    rows = _fragment_rows(plain, False, task, key[0].as_py())
    rows += _fragment_rows(single, True, task, key[0].as_py())
    return pa.Table.from_pylist(rows, schema=FRAGMENTS_ARROW)


def _candidates(
    table: pa.Table, shared: pa.Table, task: Task
) -> list[tuple[Block, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks, their ids, the runs whose anchor another document has, and which are crowded."""
    read = list(_blocks(table, task))
    found = [block.anchor[use] for block, _, use, _ in read]
    fragments = [_fragments(block, use, task) for block, _, use, _ in read]
    keys, crowded = _shared_keys(found, fragments, shared, task)
    owners = np.concatenate([np.empty(0, np.int64), *(ids[b.document[use]] for b, ids, use, _ in read)])
    anchors = np.concatenate([np.empty(0, U64), *found])
    local, _, several, _ = _collapsed(anchors, owners)
    local = local[several]
    out = []
    for block, ids, use, _ in read:
        bucket, residue = _key(block.anchor, task.buckets)
        at = _member(keys, residue.astype(U64) * U64(task.buckets) + bucket.astype(U64))
        run = np.flatnonzero(use & ((at >= 0) | (_member(local, block.anchor) >= 0)))
        at = at[run]
        crowd = (at >= 0) & crowded[np.maximum(at, 0)] if len(crowded) else np.zeros(len(run), bool)
        out.append((block, ids, run, crowd))
    return out


def _fragment_rows(found: list[tuple], crowded: bool, task: Task, chunk: int) -> list[dict]:
    """A fragment goes to the bucket of its anchor; a single window to that of its own hash."""
    hashes, anchors, docs = (np.concatenate([np.empty(0, k), *x]) for k, x in zip((U64, U64, np.int64), zip(*found)))
    ids, smallest, several, at = _collapsed(hashes, docs)
    anchors = anchors[at]
    bucket, residue = _key(anchors, task.buckets)
    if crowded:
        bucket = (ids % U64(task.buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return [
        {
            "bucket": b, "chunk": chunk, "crowded": crowded, "ids": ids[order[part]].tobytes(),
            # a chunk finds crowded windows by their anchor again
            "residues": (anchors if crowded else residue)[order[part]].tobytes(),
            "docs": _packed_ids(smallest[order[part]]),
            "several": np.packbits(several[order[part]]).tobytes(),
        }
        for b, part in _split(bucket[order])
    ]


def _collapsed(fragment: np.ndarray, docs: np.ndarray):
    """For sorted distinct fragments: smallest doc_id, whether other ids have it, a position."""
    order = np.lexsort((docs, fragment))
    f, d = fragment[order], docs[order]
    edges = np.flatnonzero(np.append(True, f[1:] != f[:-1])[: len(f)])
    ends = np.append(edges[1:], len(f))[: len(edges)] - 1
    return f[edges], d[edges], d[edges] != d[ends], order[edges]


def _answer(key: tuple, table: pa.Table) -> pa.Table:
    """For each chunk in one row: the smallest doc_id of each fragment and single window of
    which it has a greater one; and what text is wanted, as the chunk has the smallest."""
    rows = table.to_pylist()
    out = {row["chunk"]: {"chunk": row["chunk"]} | dict.fromkeys(ANSWERS_ARROW.names[1:], b"") for row in rows}
    _answer_fragments([row for row in rows if not row["crowded"]], out)
    _answer_windows([row for row in rows if row["crowded"]], out)
    told = [x for x in out.values() if x["ids"] or x["wanted"] or x["windows"]]
    return pa.Table.from_pylist(told, schema=ANSWERS_ARROW)


def _least(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple]]:
    """Distinct ids, their smallest doc_ids, a position of each; and for each row its ids,
    their places among the distinct, and where another doc_id than the smallest has them."""
    own = [np.frombuffer(row["ids"], U64) for row in rows]
    held = [_unpacked_ids(row["docs"]) for row in rows]
    distinct, smallest, _, at = _collapsed(np.concatenate(own), np.concatenate(held))
    parts = []
    for row, ids, docs in zip(rows, own, held):
        where = np.searchsorted(distinct, ids)
        parts.append((ids, where, docs, (smallest[where] < docs) | _bits(row["several"], len(ids))))
    return distinct, smallest, at, parts


def _answer_fragments(rows: list[dict], out: dict[int, dict]) -> None:
    if not rows:
        return
    distinct, smallest, at, parts = _least(rows)
    anchors = np.concatenate([np.frombuffer(row["residues"], np.uint32) for row in rows])[at]
    _, group, size = np.unique(anchors, return_inverse=True, return_counts=True)
    solved = size[group] > 1  # anchors with several fragments
    for row, (ids, where, docs, greater) in zip(rows, parts):
        wanted = solved[where] & (smallest[where] == docs)
        if greater.any():
            out[row["chunk"]] |= {
                "ids": ids[greater].tobytes(), "docs": _packed_ids(smallest[where][greater])
            }
        out[row["chunk"]]["wanted"] = ids[wanted].tobytes()


def _answer_windows(rows: list[dict], out: dict[int, dict]) -> None:
    """Equal single windows have equal hashes: there is nothing to solve."""
    if not rows:
        return
    _, smallest, _, parts = _least(rows)
    for row, (ids, where, _, greater) in zip(rows, parts):
        if greater.any():
            out[row["chunk"]] |= {
                "windows": ids[greater].tobytes(),
                "anchors": np.unique(np.frombuffer(row["residues"], U64)[greater]).tobytes(),
                "window_docs": _packed_ids(smallest[where][greater]),
            }


def _send_texts(key: tuple, table: pa.Table, wanted: pa.Table, task: Task) -> pa.Table:
    """Texts of the fragments asked for, from the smallest of the chunk's documents with it."""
    asked = [np.frombuffer(x, U64) for x in wanted.column("wanted").to_pylist()]
    asked = np.unique(np.concatenate([np.empty(0, U64), *asked]))
    if not len(asked):
        return pa.Table.from_pylist([], schema=TEXTS_ARROW)
    hashes, anchors, docs, texts = [], [], [], []
    for block, ids, use, _ in _blocks(table, task):
        end = block.last + task.window
        fragment = block.hasher.spans(block.first, end)
        run = np.flatnonzero((_member(asked, fragment) >= 0) & use)
        owner = ids[block.document[run]]
        f, d, _, at = _collapsed(fragment[run], owner)
        run = run[at]
        low, high = block.first[run], end[run]
        if task.words:
            low, high = block.starts[low], block.ends[high - 1]
        hashes.append(f)
        docs.append(d)
        anchors.append(block.anchor[run])
        texts += [block.data[a:b].tobytes() for a, b in zip(low.tolist(), high.tolist())]
    ids, smallest, _, at = _collapsed(np.concatenate(hashes), np.concatenate(docs))
    bucket, residue = _key(np.concatenate(anchors)[at], task.buckets)
    order = np.argsort(bucket, kind="stable")
    rows = []
    for b, part in _split(bucket[order]):
        chosen = order[part]
        parts = [texts[i] for i in at[chosen].tolist()]
        rows.append(
            {
                "bucket": b, "chunk": key[0].as_py(), "ids": ids[chosen].tobytes(),
                "residues": residue[chosen].tobytes(), "docs": _packed_ids(smallest[chosen]),
                "sizes": np.fromiter(map(len, parts), np.int32, len(parts)).tobytes(), "data": b"".join(parts),
            }
        )
    return pa.Table.from_pylist(rows, schema=TEXTS_ARROW)


#: Windows of a fragment as bits; a run has at most as many windows as a window has symbols.
MASK_BYTES = 8
EMPTY = bytes(MASK_BYTES)


def _solve(key: tuple, table: pa.Table, task: Task) -> pa.Table:
    """For each chunk, the fragments with windows that a smaller document's fragment holds."""
    rows = table.to_pylist()
    own = [np.frombuffer(row["ids"], U64) for row in rows]
    residues = np.concatenate([np.frombuffer(row["residues"], np.uint32) for row in rows])
    docs = np.concatenate([_unpacked_ids(row["docs"]) for row in rows])
    sizes = [np.frombuffer(row["sizes"], np.int32) for row in rows]
    ends = [np.cumsum(x) for x in sizes]
    row_of = np.repeat(np.arange(len(rows)), [len(x) for x in own])
    end, size = np.concatenate(ends), np.concatenate(sizes)
    masks: list[bytes] = [EMPTY] * len(docs)
    order = np.lexsort((docs, residues))
    batch: list[np.ndarray] = []
    symbols = 0

    def solved() -> None:
        where = np.concatenate(batch)
        texts = [
            rows[r]["data"][e - n : e]
            for r, e, n in zip(row_of[where].tolist(), end[where].tolist(), size[where].tolist())
        ]
        group = np.repeat(np.arange(len(batch)), [len(x) for x in batch])
        for w, bits in zip(where.tolist(), task.solve(texts, docs[where], group, task.window)):
            if bits.any():
                masks[w] = np.packbits(bits, bitorder="little").tobytes().ljust(MASK_BYTES, b"\0")

    for _, part in _split(residues[order].astype(np.int64)):
        batch.append(order[part])
        symbols += int(size[order[part]].sum())
        if symbols >= BLOCK_BYTES:
            solved()
            batch, symbols = [], 0
    if batch:
        solved()
    out, begin = [], 0
    for row, ids in zip(rows, own):
        mine = masks[begin : begin + len(ids)]
        marked = np.array([mask != EMPTY for mask in mine], bool)
        if marked.any():
            out.append(
                dict.fromkeys(ANSWERS_ARROW.names, b"")
                | {
                    "chunk": row["chunk"], "ids": ids[marked].tobytes(),
                    "docs": _packed_ids(docs[begin : begin + len(ids)][marked]),
                    "masks": b"".join(mask for mask in mine if mask != EMPTY),
                }
            )
        begin += len(ids)
    return pa.Table.from_pylist(out, schema=ANSWERS_ARROW)


def _found(rows: list[dict], ids: str, docs: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted ids with their smallest doc_ids and what sorted them."""
    found = np.concatenate([np.empty(0, U64), *(np.frombuffer(row[ids], U64) for row in rows)])
    smallest = [_unpacked_ids(row[docs]) for row in rows if row[docs]]
    order = np.argsort(found)
    return found[order], np.concatenate([np.empty(0, np.int64), *smallest])[order], order


def _mark(key: tuple, table: pa.Table, found: pa.Table, task: Task) -> pa.Table:
    """The chunk's documents with what stays of each."""
    rows = found.to_pylist()
    ids, smallest, _ = _found([row for row in rows if not row["masks"]], "ids", "docs")
    masked = [row for row in rows if row["masks"]]
    mask_ids, mask_docs, order = _found(masked, "ids", "docs")
    masks = np.concatenate([np.empty(0, "<u8"), *(np.frombuffer(row["masks"], "<u8") for row in masked)])[order]
    window_ids, window_smallest, _ = _found(rows, "windows", "window_docs")
    crowd = np.unique(np.concatenate([np.empty(0, U64), *(np.frombuffer(row["anchors"], U64) for row in rows)]))
    counts: dict[str, list] = {"n": [], "n_removed": [], "n_spans": [], "kept": []}
    for block, docs, use, _ in _blocks(table, task):
        n = block.bounds[-1]
        marked = [np.empty(0, np.int64)]
        if (len(ids) or len(mask_ids)) and len(block.first):
            fragment = block.hasher.spans(block.first, block.last + task.window)
            own = docs[block.document]
            at = _member(ids, fragment)
            if len(ids):  # a smaller document has the fragment as a whole
                run = np.flatnonzero((at >= 0) & use & (own > smallest[np.maximum(at, 0)]))
                marked.append(_windows(block.first[run], block.last[run])[1])
            at = _member(mask_ids, fragment)
            if len(mask_ids):
                run = np.flatnonzero((at >= 0) & use & (own == mask_docs[np.maximum(at, 0)]))
                which, window = _windows(block.first[run], block.last[run])
                offset = (window - block.first[run][which]).astype(np.uint64)
                marked.append(window[(masks[at[run][which]] >> offset) & U64(1) == 1])
        if len(window_ids) and len(block.first):
            run = np.flatnonzero((_member(crowd, block.anchor) >= 0) & use)
            which, window = _windows(block.first[run], block.last[run])
            at = _member(window_ids, block.hasher.spans(window, window + task.window))
            own = docs[block.document[run]][which]
            marked.append(window[(at >= 0) & (own > window_smallest[np.maximum(at, 0)])])
        edge = np.zeros(n + 1, np.int32)
        for windows in marked:  # each window is in one run, so no position comes twice
            edge[windows] += 1
            edge[windows + task.window] -= 1
        gone = np.cumsum(edge[:-1]) > 0
        if task.whole_characters and gone.any():
            lead = np.flatnonzero((block.data & 0xC0) != 0x80)
            touched = np.logical_or.reduceat(gone, lead)
            gone = np.repeat(touched, np.diff(np.append(lead, n)))
        _count(block, gone, task, counts)
    arrays = {name: pa.array(counts[name], pa.binary() if name == "kept" else pa.int64()) for name in counts}
    out = table.drop_columns(["chunk", "text"])
    for name, array in arrays.items():
        out = out.append_column(name, array)
    return out


def _count(block: Block, gone: np.ndarray, task: Task, counts: dict[str, list]) -> None:
    data = block.data.tobytes()
    for a, b in zip(block.bounds[:-1].tolist(), block.bounds[1:].tolist()):
        part = gone[a:b]
        removed = int(part.sum())
        counts["n"].append(b - a)
        counts["n_removed"].append(removed)
        counts["n_spans"].append(int(part[:1].sum() + (part[1:] & ~part[:-1]).sum()) if removed else 0)
        if task.words:
            spans = zip(block.starts[a:b][~part].tolist(), block.ends[a:b][~part].tolist())
            counts["kept"].append(b" ".join([data[s:e] for s, e in spans]))
        else:
            counts["kept"].append(block.data[a:b][~part].tobytes() if removed else data[a:b])


def without_repeats(
    docs: DataFrame,
    words: bool,
    window: int,
    gram: int,
    solve: Solver,
    carry: list[Column] | None = None,
    whole_characters: bool = False,
) -> DataFrame:
    """doc_id, ``carry`` columns (in the struct ``_rest``), n, n_removed, n_spans and kept.

    ``kept`` is what stays, as bytes; with ``whole_characters`` a character goes if any of
    its bytes does. Null texts are empty. Rows with a null doc_id are kept
    whole and are no one's source; rows that repeat a doc_id do not remove each other.
    """
    if not gram <= window <= 8 * MASK_BYTES:
        raise ValueError("windows have at most 64 symbols and anchors fit into them")
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    size = docs.select(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(shuffle_partitions(spark), -(-size // CHUNK_BYTES))
    task = Task(words, window, gram, parts, solve, whole_characters)
    rest = F.struct(*carry) if carry else F.lit(0)
    doc_id = F.col("doc_id").cast("long")
    texts = docs.select(
        # by row: neither a null nor a repeated doc_id gathers in one chunk
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).alias("chunk"),
        doc_id.alias("doc_id"),
        rest.alias("_rest"),
        text.alias("text"),
    )
    anchors = texts.groupBy("chunk").applyInArrow(
        lambda key, table: _send_anchors(key, table, task), ANCHORS
    )
    shared = anchors.groupBy("bucket").applyInArrow(_share_anchors, SHARED)
    fragments = (
        texts.groupBy("chunk")
        .cogroup(shared.groupBy("chunk"))
        .applyInArrow(lambda key, a, b: _send_fragments(key, a, b, task), FRAGMENTS)
    )
    answers = fragments.groupBy("bucket").applyInArrow(_answer, ANSWERS)
    solved = (
        texts.groupBy("chunk")
        .cogroup(answers.filter("length(wanted) > 0").groupBy("chunk"))
        .applyInArrow(lambda key, a, b: _send_texts(key, a, b, task), TEXTS)
        .groupBy("bucket")
        .applyInArrow(lambda key, table: _solve(key, table, task), ANSWERS)
    )
    found = answers.filter("length(ids) > 0 or length(windows) > 0").union(solved)
    result = texts.drop("chunk", "text").schema.add("n", "long").add("n_removed", "long")
    result = result.add("n_spans", "long").add("kept", "binary")
    return (
        texts.groupBy("chunk")
        .cogroup(found.groupBy("chunk"))
        .applyInArrow(lambda key, a, b: _mark(key, a, b, task), result)
    )


ships_by_value(__name__)
