"""Exact top-k search by distributed histogram selection.

All scores of a query are counted in a histogram; the bin that holds the k-th highest score
becomes the range of the next histogram, until a bin is one value wide. That value is the
query's threshold. One more pass keeps what reaches it, and ties go to the smaller id.
Scores are computed block against block and never stored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatrace.llm.common import checkpointed, ships_by_value

SCALE = 256
BINS = 256
#: Rows of a packed block, and the scores computed at a time.
CANDIDATE_ROWS = 4096
QUERY_ROWS = 1024
SCORES = 1 << 20
#: Packed queries up to this many bytes are broadcast; more are joined by shuffle.
BROADCAST_BYTES = 64 << 20
#: Integers up to this size are exact as doubles.
EXACT = float(1 << 53)

BLOCK = "vectors binary, ids binary, n int, dim int, norm double"


def quantised(embeddings: DataFrame) -> DataFrame:
    """vec_id and v, the components as floor(SCALE * x), where all components are finite.

    Null ids, null, empty and partly null or non-finite vectors take no part.
    """
    x = F.col("embedding").cast("array<double>")
    return (
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
        .filter(F.col("vec_id").isNotNull() & (F.size("x") > 0))
        .filter(F.forall("x", lambda c: F.coalesce((F.abs(c) < float("inf")) & ~F.isnan(c), F.lit(False))))
        .select("vec_id", F.transform("x", lambda c: F.floor(F.lit(SCALE) * c)).alias("v"))
    )


def _packed(table: pa.Table | pa.RecordBatch, extra: list[str]) -> list[dict]:
    """Blocks of one dimension each, in row order."""
    column = table.column("v")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes)))
    others = {name: table.column(name).to_numpy().astype(np.int64) for name in ["vec_id", *extra]}
    blocks = []
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        v = np.stack([flat[begins[r] : begins[r] + dim] for r in rows])
        square = v.astype(np.float64)
        blocks.append(
            {
                "vectors": v.tobytes(),
                "ids": others["vec_id"][rows].tobytes(),
                "n": len(rows),
                "dim": int(dim),
                "norm": float(np.sqrt((square * square).sum(axis=1).max())),
            }
            | {name: others[name][rows].tobytes() for name in extra}
        )
    return blocks


def _pack_batches(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, CANDIDATE_ROWS):
            found = _packed(batch.slice(at, CANDIDATE_ROWS), [])
            yield pa.RecordBatch.from_pylist(found, schema=schema)


BLOCK_ARROW = pa.schema(
    [("vectors", pa.binary()), ("ids", pa.binary()), ("n", pa.int32()), ("dim", pa.int32()), ("norm", pa.float64())]
)


def candidate_blocks(vectors: DataFrame) -> DataFrame:
    """Vectors packed where they are, without a shuffle."""
    schema = BLOCK_ARROW
    return vectors.mapInArrow(lambda batches: _pack_batches(batches, schema), BLOCK)


def query_blocks(queries: DataFrame, blocks: int) -> DataFrame:
    """Queries with their range packed by ``block``; a block has one row per dimension."""
    schema = BLOCK_ARROW.append(pa.field("lo", pa.binary())).append(pa.field("block", pa.int64()))

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        found = _packed(table, ["lo"])
        return pa.Table.from_pylist([b | {"block": key[0].as_py()} for b in found], schema=schema)

    return (
        queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
        .groupBy("block")
        .applyInArrow(pack, BLOCK + ", lo binary, block long")
    )


def _pairs(candidates: DataFrame, queries: DataFrame, blocks: int, small: bool) -> DataFrame:
    """Each candidate block beside each query block of its dimension: an equi-join on the
    number of the query block, which every candidate block is laid out over."""
    out = candidates.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"))
    renamed = queries.select(
        F.col("block").cast("int").alias("q_block"), F.col("dim").alias("q_dim"),
        F.col("vectors").alias("q_vectors"), F.col("ids").alias("q_ids"), F.col("lo").alias("q_lo"),
    )
    right = F.broadcast(renamed) if small else renamed
    return out.join(right, (F.col("b") == F.col("q_block")) & (F.col("dim") == F.col("q_dim"))).select(
        "vectors", "ids", "dim", "q_vectors", "q_ids", "q_lo"
    )


def _scores(row: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Query ids, their lo, candidate ids, scores and a mask of pairs that count, in parts."""
    dim = row["dim"]
    c = np.frombuffer(row["vectors"], np.int64).reshape(-1, dim)
    q = np.frombuffer(row["q_vectors"], np.int64).reshape(-1, dim)
    ids, q_ids = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["q_ids"], np.int64)
    lo = np.frombuffer(row["q_lo"], np.int64)
    exact = float(np.abs(c).max()) * float(np.abs(q).max()) * dim < EXACT
    kind = np.float64 if exact else np.int64
    c, q = c.astype(kind).T, q.astype(kind)
    step = max(1, SCORES // len(ids))
    for at in range(0, len(q), step):
        part = slice(at, at + step)
        scores = (q[part] @ c).astype(np.int64)
        yield q_ids[part], lo[part], ids, scores, q_ids[part][:, None] != ids[None, :]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def _histograms(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(query_id, bin, n): scores per bin of ``width`` from lo on; one more bin holds all above."""
    held: dict[int, np.ndarray] = {}

    def flushed() -> pa.RecordBatch:
        ids = np.fromiter(held, np.int64, len(held))
        counts = np.stack(list(held.values()))
        where = np.nonzero(counts)
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[where[0]]), pa.array(where[1].astype(np.int32)), pa.array(counts[where])],
            names=["query_id", "bin", "n"],
        )

    for row in _rows(batches):
        for q_ids, lo, _, scores, counts_in in _scores(row):
            bins = np.clip((scores - lo[:, None]) // width, -1, BINS)
            use = counts_in & (bins >= 0)
            flat = bins + np.arange(len(q_ids))[:, None] * (BINS + 1)
            counts = np.bincount(flat[use], minlength=len(q_ids) * (BINS + 1)).reshape(len(q_ids), -1)
            for i, query in enumerate(q_ids.tolist()):
                held[query] = held[query] + counts[i] if query in held else counts[i]
        if len(held) > 8 * QUERY_ROWS:
            yield flushed()
    if held:
        yield flushed()


def _reaching(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(query_id, vec_id, score) that reach lo; of ties no more than can be in the result."""
    for row in _rows(batches):
        for q_ids, lo, ids, scores, counts_in in _scores(row):
            order = np.argsort(ids, kind="stable")
            scores, counts_in = scores[:, order], counts_in[:, order]
            tied = counts_in & (scores == lo[:, None])
            tied &= np.cumsum(tied, axis=1) <= k
            at = np.nonzero((counts_in & (scores > lo[:, None])) | tied)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q_ids[at[0]]), pa.array(ids[order][at[1]]), pa.array(scores[at])],
                names=["query_id", "vec_id", "score"],
            )


def top_k(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best candidates of each query.

    Queries are the vectors whose id is divisible by ``every``; candidates are all vectors
    of the same dimension but those with the query's own id, so rows that repeat an id are
    no candidates of each other. A repeated query id is one query, by its smallest vector;
    repeated candidates are candidates each. A query without candidates has no rows.
    """
    vectors = checkpointed(quantised(embeddings))
    asked = vectors.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = checkpointed(asked)
    blocks = max(1, -(-asked.count() // QUERY_ROWS))
    candidates = checkpointed(candidate_blocks(vectors))
    bounds = candidates.agg(F.max("norm").alias("norm"), F.max("dim").alias("dim")).first()
    most = int((bounds["norm"] or 0.0) ** 2 * (1 + 1e-9)) + 1
    small = blocks * QUERY_ROWS * 8 * ((bounds["dim"] or 0) + 2) <= BROADCAST_BYTES

    # the k-th score lies in [lo, lo + span), or there are fewer than k and lo stays the lowest
    state = asked.withColumn("lo", F.lit(-most).cast("long"))
    span = 2 * most + 1
    while span > 1:
        width = -(-span // BINS)
        state = _narrowed(state, candidates, blocks, small, k, width)
        span = width
    final = _pairs(candidates, query_blocks(state, blocks), blocks, small).mapInArrow(
        lambda batches: _reaching(batches, k), "query_id long, vec_id long, score long"
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return final.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )


def _narrowed(
    state: DataFrame, candidates: DataFrame, blocks: int, small: bool, k: int, width: int
) -> DataFrame:
    """``state`` with lo moved to the bin of the k-th highest score."""
    counted = (
        _pairs(candidates, query_blocks(state, blocks), blocks, small)
        .mapInArrow(lambda batches: _histograms(batches, width), "query_id long, bin int, n long")
        .groupBy("query_id", "bin")
        .agg(F.sum("n").alias("n"))
    )
    down = Window.partitionBy("query_id").orderBy(F.col("bin").desc())
    reached = counted.withColumn("so_far", F.sum("n").over(down))
    chosen = (
        reached.filter(F.col("so_far") >= k).groupBy("query_id").agg(F.max("bin").alias("bin"))
    )
    # fewer than k candidates: everything counts, and lo stays
    moved = F.col("lo") + F.coalesce(F.col("bin"), F.lit(0)).cast("long") * width
    return checkpointed(
        state.join(chosen, F.col("vec_id") == F.col("query_id"), "left").select(
            "vec_id", "v", moved.alias("lo")
        )
    )


ships_by_value(__name__)
