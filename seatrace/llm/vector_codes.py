"""Product-quantisation codes of integer vectors, fitted by dual-tree Lloyd rounds.

Vectors are cut into parts; every part position has a codebook. Packed blocks of vectors
hold, for each part position, a balanced tree over the block's parts, with bounding boxes
and sums of components per node. A round builds a small tree over the codebook's entries
and walks both trees together: an entry node whose least distance from a part node exceeds
the greatest distance of another one is pruned. Where one entry is left, the whole part
node goes to it by its cached sum; leaves that stay uncertain are decided part by part in
whole numbers. A round sends back one row per entry and block, whatever the table's size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatrace.llm.common import checkpointed, ships_by_value

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Vectors of a block and parts in a leaf of its trees, at most.
BLOCK_ROWS = 4096
LEAF = 16
#: Components up to this size keep squared distances of 512 of them within 63 bits.
LARGEST = 1 << 26
#: Pairs of a part and an entry whose distances are computed together.
PAIRS = 1 << 18

#: A block: ids and labels of its vectors, and per part position their order and their parts.
BLOCK = "dim int, vec_ids array<bigint>, labels array<{label}>, `order` binary, parts binary"
SUM = "dim int, part int, entry int, n long, sums array<long>"
SUM_ARROW = pa.schema(
    [("dim", pa.int32()), ("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))]
)
#: Codebooks by dimension of the vectors: (parts, entries, components of a part).
Codebooks = dict[int, np.ndarray]


def integers(x: Column) -> Column:
    return F.transform(x.cast("array<double>"), lambda c: F.floor(F.lit(SCALE) * c))


def usable(x: Column, parts: int) -> Column:
    """Whether a vector is finite throughout and can be cut into ``parts`` parts."""
    finite = F.forall(x, lambda c: F.coalesce((F.abs(c) < float("inf")) & ~F.isnan(c), F.lit(False)))
    return F.coalesce((F.size(x) > 0) & (F.size(x) % parts == 0) & finite, F.lit(False))


class Tree:
    """Balanced tree over rows of integers, level by level; nodes are ranges of ``order``."""

    def __init__(self, points: np.ndarray, leaf: int, order: np.ndarray | None = None) -> None:
        n = len(points)
        depth = max(0, int(np.ceil(np.log2(max(1, n / leaf)))))
        self.bounds = [np.arange((1 << level) + 1) * n >> level for level in range(depth + 1)]
        self.order = self._ordered(points, depth) if order is None else order
        self.points = points[self.order] if order is None else points
        begins = self.bounds[-1][:-1]
        low = [np.minimum.reduceat(self.points, begins, axis=0)]
        high = [np.maximum.reduceat(self.points, begins, axis=0)]
        for _ in range(depth):
            low.append(np.minimum(low[-1][::2], low[-1][1::2]))
            high.append(np.maximum(high[-1][::2], high[-1][1::2]))
        self.low, self.high = low[::-1], high[::-1]
        running = np.zeros((n + 1, points.shape[1]), np.int64)
        np.cumsum(self.points, axis=0, out=running[1:])
        self.sums = [np.diff(running[bounds], axis=0) for bounds in self.bounds]

    def _ordered(self, points: np.ndarray, depth: int) -> np.ndarray:
        """Rows so that every node is split at the median of its widest component."""
        order = np.arange(len(points))
        for level in range(depth):
            begins, sizes = self.bounds[level][:-1], np.diff(self.bounds[level])
            here = points[order]
            width = np.maximum.reduceat(here, begins, axis=0) - np.minimum.reduceat(here, begins, axis=0)
            node = np.repeat(np.arange(len(sizes)), sizes)
            key = here[np.arange(len(here)), width.argmax(axis=1)[node]]
            order = order[np.lexsort((key, node))]
        return order


def _distance_bounds(low_a, high_a, low_b, high_b) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance between the points of two boxes, row by row."""
    gap = np.maximum(0, np.maximum(low_b - high_a, low_a - high_b))
    reach = np.maximum(high_b - low_a, high_a - low_b)
    return (gap * gap).sum(axis=1), (reach * reach).sum(axis=1)


def assign(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entry of each part in tree order (ties to the lower number), parts and sums per entry."""
    size, width = entries.shape
    chosen = np.zeros(len(tree.points), np.int64)
    counts, sums = np.zeros(size, np.int64), np.zeros((size, width), np.int64)
    # of equal entries only the first can be chosen
    _, first = np.unique(entries, axis=0, return_index=True)
    first = np.sort(first)
    book = Tree(entries[first], 1)
    number = first[book.order]
    part = entry = np.zeros(1, np.int64)
    entry_level, part_depth, entry_depth = 0, len(tree.bounds) - 1, len(book.bounds) - 1

    def pruned(level: int, part: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs whose entry node may hold the nearest entry of some part of the part node."""
        least, most = _distance_bounds(
            tree.low[level][part], tree.high[level][part],
            book.low[entry_level][entry], book.high[entry_level][entry],
        )
        best = np.full(len(tree.low[level]), np.iinfo(np.int64).max)
        np.minimum.at(best, part, most)
        near = least <= best[part]
        return part[near], entry[near]

    for level in range(part_depth + 1):
        # the entry tree goes down with the part tree, and wholly before the leaves
        while entry_level < (entry_depth if level == part_depth else min(level, entry_depth)):
            entry_level += 1
            part, entry = np.repeat(part, 2), np.stack([2 * entry, 2 * entry + 1], axis=1).ravel()
            filled = np.diff(book.bounds[entry_level])[entry] > 0
            part, entry = pruned(level, part[filled], entry[filled])
        part, entry = pruned(level, part, entry)
        if entry_level == entry_depth:
            left = np.bincount(part, minlength=len(tree.low[level]))
            alone = left[part] == 1
            bounds = tree.bounds[level]
            for node, place in zip(part[alone].tolist(), number[book.bounds[-1][entry[alone]]].tolist()):
                a, b = bounds[node], bounds[node + 1]
                chosen[a:b] = place
                counts[place] += b - a
                sums[place] += tree.sums[level][node]
            part, entry = part[~alone], entry[~alone]
        if level < part_depth:
            part, entry = np.stack([2 * part, 2 * part + 1], axis=1).ravel(), np.repeat(entry, 2)
    if len(part):
        _decide(tree, entries, part, number[book.bounds[-1][entry]], chosen, counts, sums)
    return chosen, counts, sums


def _decide(tree, entries, part, number, chosen, counts, sums) -> None:
    """Parts of uncertain leaves by their distances, in whole numbers, to the entries left."""
    order = np.lexsort((number, part))
    part, number = part[order], number[order]
    opens = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    left = np.diff(np.append(opens, len(part)))
    bounds = tree.bounds[-1]
    # leaves with as many entries left are one array: (leaf, place in it, entry left)
    for n in np.unique(left).tolist():
        group = opens[left == n]
        step = max(1, PAIRS // (LEAF * n))
        for at in range(0, len(group), step):
            rows = group[at : at + step]
            leaves = part[rows]
            candidates = number[rows[:, None] + np.arange(n)]
            place = bounds[leaves][:, None] + np.arange(int(np.diff(bounds)[leaves].max()))
            there = place < bounds[leaves + 1][:, None]
            points = tree.points[np.minimum(place, len(tree.points) - 1)]
            between = points[:, :, None, :] - entries[candidates][:, None, :, :]
            nearest = np.einsum("lpnk,lpnk->lpn", between, between).argmin(axis=2)
            found = np.take_along_axis(candidates, nearest, axis=1)[there]
            place = place[there]
            chosen[place] = found
            counts += np.bincount(found, minlength=len(counts))
            np.add.at(sums, found, tree.points[place])


def _pack_batches(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Blocks of one dimension each, every part position in the order of its tree."""
    for batch in batches:
        sizes = batch.column("v").value_lengths().to_numpy(zero_copy_only=False)
        for dim in np.unique(sizes).tolist():
            rows = batch.take(pa.array(np.flatnonzero(sizes == dim)))
            for at in range(0, rows.num_rows, BLOCK_ROWS):
                yield _block(rows.slice(at, BLOCK_ROWS), dim, parts)


def _block(rows: pa.RecordBatch, dim: int, parts: int) -> pa.RecordBatch:
    vectors = rows.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    if int(np.abs(vectors).max()) > LARGEST:
        raise ValueError(f"components beyond {LARGEST / SCALE} are not supported")
    width = dim // parts
    trees = [Tree(vectors[:, k * width : (k + 1) * width], LEAF) for k in range(parts)]

    def one_list(name: str) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows.column(name))

    return pa.RecordBatch.from_arrays(
        [
            pa.array([dim], pa.int32()),
            one_list("vec_id"),
            one_list("label"),
            pa.array([np.stack([t.order for t in trees]).astype("<i4").tobytes()], pa.binary()),
            pa.array([np.stack([t.points for t in trees]).astype("<i4").tobytes()], pa.binary()),
        ],
        names=["dim", "vec_ids", "labels", "order", "parts"],
    )


def _trees(batch: pa.RecordBatch, at: int, parts: int) -> tuple[int, Iterator[Tree]]:
    """The dimension of a block and the trees of its part positions."""
    dim = batch.column("dim")[at].as_py()
    order = np.frombuffer(batch.column("order")[at].as_buffer(), "<i4").reshape(parts, -1)
    points = np.frombuffer(batch.column("parts")[at].as_buffer(), "<i4").reshape(parts, -1, dim // parts)
    return dim, (Tree(points[k].astype(np.int64), LEAF, order[k]) for k in range(parts))


def _sum_batches(batches: Iterator[pa.RecordBatch], books: Codebooks, parts: int) -> Iterator[pa.RecordBatch]:
    """Count and sum of the parts of each entry, over all blocks of the task."""
    total: dict[tuple[int, int], list[np.ndarray]] = {}
    for batch in batches:
        for at in range(batch.num_rows):
            dim, trees = _trees(batch, at, parts)
            for k, tree in enumerate(trees):
                _, counts, sums = assign(tree, books[dim][k])
                before = total.setdefault((dim, k), [0, 0])
                before[0], before[1] = before[0] + counts, before[1] + sums
    out = [
        {"dim": dim, "part": k, "entry": e, "n": int(counts[e]), "sums": sums[e].tolist()}
        for (dim, k), (counts, sums) in total.items()
        for e in np.flatnonzero(counts).tolist()
    ]
    yield pa.RecordBatch.from_pylist(out, schema=SUM_ARROW)


def _code_batches(batches: Iterator[pa.RecordBatch], books: Codebooks, parts: int) -> Iterator[pa.RecordBatch]:
    """Code, with a byte for each part, and error of every vector."""
    for batch in batches:
        for at in range(batch.num_rows):
            dim, trees = _trees(batch, at, parts)
            ids, labels = batch.column("vec_ids")[at].values, batch.column("labels")[at].values
            codes = np.zeros((len(ids), parts), np.uint8)
            error = np.zeros(len(ids), np.int64)
            for k, tree in enumerate(trees):
                chosen, _, _ = assign(tree, books[dim][k])
                between = tree.points - books[dim][k][chosen]
                codes[tree.order, k] = chosen
                error[tree.order] += (between * between).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    labels,
                    pa.array([dim] * len(ids), pa.int32()),
                    pa.array([c.tobytes() for c in codes], pa.binary()),
                    pa.array(error),
                ],
                names=["vec_id", "label", "dim", "code", "error"],
            )


def first_entries(kept: DataFrame, parts: int, entries: int) -> Codebooks:
    """Codebooks from the rows with the smallest vec_id of each dimension; nulls come last."""
    order = Window.partitionBy(F.size("v")).orderBy(F.col("vec_id").asc_nulls_last(), "v")
    smallest = kept.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= entries)
    found: dict[int, list] = {}
    # a fixed number of rows per dimension reaches the driver
    for row in smallest.orderBy("place").select("v").collect():
        found.setdefault(len(row["v"]), []).append(row["v"])
    return {
        dim: np.array(rows, np.int64).reshape(len(rows), parts, dim // parts).transpose(1, 0, 2)
        for dim, rows in found.items()
    }


def next_entries(books: Codebooks, sums: list) -> Codebooks:
    """Entries replaced by the floor of their parts' mean; unused ones stay."""
    moved = {dim: book.copy() for dim, book in books.items()}
    for row in sums:
        moved[row["dim"]][row["part"], row["entry"], row["at"]] = row["value"] // row["n"]
    return moved


def vector_codes(
    embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, Codebooks]:
    """vec_id, label, dim, ``code`` (a byte for each part) and ``error`` of the usable rows,
    and the codebooks.

    ``embeddings`` needs vec_id, embedding and label; other columns are not read. Components
    become floor(4096 * x) and must not exceed 16384. Rows whose vector is null, empty, holds
    null or non-finite components or cannot be cut into ``parts`` equal parts go. Vectors of
    another dimension have codebooks of their own (a few dimensions are expected: a
    codebook of each is on the driver). Null vec_ids come after all others when the first
    entries are chosen; rows that repeat a vec_id are coded each, and chosen by their vectors.
    With fewer rows than ``entries``, codebooks are as small. An empty table has none.
    """
    x = F.col("embedding").cast("array<double>")
    kept = checkpointed(
        embeddings.select(
            F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"), x.alias("x")
        )
        .filter(usable(F.col("x"), parts))
        .select("vec_id", "label", integers(F.col("x")).alias("v"))
    )
    label = kept.schema["label"].dataType.simpleString()
    blocks = checkpointed(
        kept.mapInArrow(lambda batches: _pack_batches(batches, parts), BLOCK.format(label=label))
    )
    books = first_entries(kept, parts, entries)
    for _ in range(rounds):
        # codebooks travel with the task; what comes back is one row per entry
        now = books
        sums = (
            blocks.mapInArrow(lambda batches: _sum_batches(batches, now, parts), SUM)
            .select("dim", "part", "entry", "n", F.posexplode("sums").alias("at", "value"))
            .groupBy("dim", "part", "entry", "at")
            .agg(F.sum("n").alias("n"), F.sum("value").alias("value"))
        )
        books = next_entries(books, sums.collect())
    final = books
    coded = blocks.mapInArrow(
        lambda batches: _code_batches(batches, final, parts),
        f"vec_id long, label {label}, dim int, code binary, error long",
    )
    return coded, books


def codebook_digest(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def codes_digest(coded: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, code in hex digits, error, label_error and codebooks_sha256 of coded rows."""
    coded = checkpointed(coded)
    per_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    per_label = per_label.select(F.col("label").alias("_label"), "label_error")
    digest = F.lit(None).cast("string")
    for dim, book in books.items():
        digest = F.when(F.col("dim") == dim, codebook_digest(book)).otherwise(digest)
    return coded.join(per_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        digest.alias("codebooks_sha256"),
    )


ships_by_value(__name__)
