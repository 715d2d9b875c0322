"""Near-duplicate embeddings by int8 tile products with rigorous error bounds.

Equal vectors are one node. Each node's unit vector is rounded to int8 once, together with
the length of what rounding lost; that length bounds how far the product of two codes can
be from the cosine. Nodes are dealt to tiles, and every two tiles meet in one task that
multiplies their codes. Pairs that are surely below the threshold cost nothing more, pairs
surely above it are counted, and the rows of pairs that the bound leaves open come back in
full precision, pair of tiles by pair of tiles. No pair of vectors is ever a row: tasks
return sums per node, and one tree of edges for each group of nodes that they have joined.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatrace.llm.common import checkpointed, ships_by_value
from seatrace.llm.components import Groups, components

THRESHOLD = 0.9
#: Bytes of codes in a tile, and the fewest rows worth a tile of their own.
TILE_BYTES = 8 << 20
TILE_ROWS = 256
#: Rows of a tile multiplied at a time.
BLOCK = 1024
#: More than double arithmetic can be off in a cosine or in a bound.
ROUNDING = 1e-9
#: Products of int8 codes up to this dimension are exact as 32-bit floats.
EXACT_DIM = (1 << 24) // (127 * 127)

CODE = "x binary, codes binary, scale double, loss double"
TILE = "dim int, tile int, nodes binary, codes binary, scales binary, losses binary, copies binary"
TILE_ARROW = pa.schema(
    [("dim", pa.int32()), ("tile", pa.int32())]
    + [(name, pa.binary()) for name in ("nodes", "codes", "scales", "losses", "copies")]
)
#: What a pair of tiles finds: links of a node, an edge of a tree, or a node with open pairs.
FOUND = "dim int, lo int, hi int, kind string, node long, other long, links long"
FOUND_ARROW = pa.schema(
    [("dim", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32()), ("kind", pa.string())]
    + [(name, pa.int64()) for name in ("node", "other", "links")]
)


def usable(x: Column) -> Column:
    """Whether a vector has a direction: finite throughout and not zero."""
    finite = F.forall(x, lambda c: F.coalesce((F.abs(c) < float("inf")) & ~F.isnan(c), F.lit(False)))
    return F.coalesce((F.size(x) > 0) & finite & F.exists(x, lambda c: c != 0), F.lit(False))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors, int8 codes, scale per row and a bound on |unit - scale * code|."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    lost = unit - codes * scale[:, None]
    return unit, codes, scale, np.sqrt((lost * lost).sum(axis=1)) + ROUNDING


def _code_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("x")
        sizes = column.value_lengths().to_numpy(zero_copy_only=False)
        flat = column.flatten().to_numpy(zero_copy_only=False)
        begins = np.concatenate(([0], np.cumsum(sizes)))
        for dim in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == dim)
            unit, codes, scale, loss = quantise(np.stack([flat[begins[r] : begins[r] + dim] for r in rows]))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.drop_columns(["x"]).take(pa.array(rows)).columns,
                    pa.array([v.tobytes() for v in unit], pa.binary()),
                    pa.array([c.tobytes() for c in codes], pa.binary()),
                    pa.array(scale),
                    pa.array(loss),
                ],
                names=[*(n for n in batch.schema.names if n != "x"), "x", "codes", "scale", "loss"],
            )


def _pack(key: tuple, table: pa.Table) -> pa.Table:
    """The nodes of one dimension and tile as one row."""
    table = table.sort_by("node")
    numbers = {
        name: table.column(name).to_numpy().astype(kind).tobytes()
        for name, kind in (("node", np.int64), ("scale", float), ("loss", float), ("copies", np.int64))
    }
    row = {
        "dim": key[0].as_py(), "tile": key[1].as_py(), "nodes": numbers["node"],
        "codes": b"".join(table.column("codes").to_pylist()), "scales": numbers["scale"],
        "losses": numbers["loss"], "copies": numbers["copies"],
    }
    return pa.Table.from_pylist([row], schema=TILE_ARROW)


class Side:
    """The nodes of one tile in one task."""

    def __init__(self, nodes, codes, scales, losses, copies) -> None:
        self.nodes, self.scales, self.losses, self.copies = nodes, scales, losses, copies
        self.codes = codes.astype(np.float32 if codes.shape[1] <= EXACT_DIM else np.float64)

    @classmethod
    def of(cls, row: dict) -> Side:
        codes = np.frombuffer(row["codes"], np.int8).reshape(-1, row["dim"])
        return cls(
            np.frombuffer(row["nodes"], np.int64), codes, np.frombuffer(row["scales"], np.float64),
            np.frombuffer(row["losses"], np.float64), np.frombuffer(row["copies"], np.int64),
        )


def near_pairs(one: Side, two: Side, same: bool, threshold: float) -> Iterator[tuple[np.ndarray, ...]]:
    """(i, j, sure) of the pairs that may reach the threshold, block by block.

    For unit vectors u, v with codes p, q, scales s, t and losses d, e:
    |u.v - s t p.q| <= d + e + d e. ``sure`` pairs reach the threshold whatever was lost.
    """
    for at in range(0, len(one.nodes), BLOCK):
        rows = slice(at, at + BLOCK)
        most = one.losses[rows].max()
        floor = (threshold - 1e-5 - most - two.losses * (1 + most)) / two.scales
        for to in range(at if same else 0, len(two.nodes), BLOCK):
            columns = slice(to, to + BLOCK)
            product = one.codes[rows] @ two.codes[columns].T
            scaled = product * one.scales[rows, None].astype(product.dtype)
            i, j = np.nonzero(scaled >= floor[columns].astype(product.dtype))
            if same and at == to:
                i, j = i[i < j], j[i < j]
            if not len(i):
                continue
            dot = product[i, j].astype(np.float64)
            i, j = i + at, j + to
            near = dot * (one.scales[i] * two.scales[j])
            off = one.losses[i] + two.losses[j] + one.losses[i] * two.losses[j] + ROUNDING
            may = near + off >= threshold
            yield i[may], j[may], (near - off >= threshold)[may]


def _found(key: dict, kind: str, node: np.ndarray, other=None, links=None) -> pa.Table:
    def filled(values) -> pa.Array:
        return pa.nulls(len(node), pa.int64()) if values is None else pa.array(values, pa.int64())

    columns = [pa.array([key[name]] * len(node), pa.int32()) for name in ("dim", "lo", "hi")]
    columns += [pa.array([kind] * len(node), pa.string()), filled(node), filled(other), filled(links)]
    return pa.Table.from_arrays(columns, schema=FOUND_ARROW)


def _summary(key: dict, one: Side, two: Side, same: bool, pairs, opened: bool) -> pa.Table:
    """Links per node, trees of joined nodes and, if ``opened``, nodes with open pairs."""
    shift = 0 if same else len(one.nodes)
    nodes = one.nodes if same else np.concatenate([one.nodes, two.nodes])
    copies = one.copies if same else np.concatenate([one.copies, two.copies])
    links = np.zeros(len(nodes), np.int64)
    groups, is_open = Groups(len(nodes)), np.zeros(len(nodes), bool)
    for i, j, sure in pairs:
        j = j + shift
        if opened:
            is_open[i[~sure]] = is_open[j[~sure]] = True
        i, j = i[sure], j[sure]
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        groups.join(i, j)
    u, v = groups.edges()
    linked = np.flatnonzero(links)
    return pa.concat_tables(
        [
            _found(key, "links", nodes[linked], links=links[linked]),
            _found(key, "edge", nodes[u], other=nodes[v]),
            _found(key, "open", nodes[is_open]),
        ]
    )


def _meet(key: tuple, table: pa.Table, threshold: float) -> pa.Table:
    """What two tiles, or a tile with itself, find by their codes."""
    names = dict(zip(("dim", "lo", "hi"), (k.as_py() for k in key)))
    rows = sorted(table.to_pylist(), key=lambda row: row["tile"])
    same = names["lo"] == names["hi"]
    if not same and len(rows) < 2:  # the other tile has nothing of this dimension
        return FOUND_ARROW.empty_table()
    one, two = Side.of(rows[0]), Side.of(rows[-1])
    return _summary(names, one, two, same, near_pairs(one, two, same, threshold), True)


def _recompute(key: tuple, table: pa.Table, threshold: float) -> pa.Table:
    """The open pairs of two tiles in full precision; what the codes decided stays decided."""
    names = dict(zip(("dim", "lo", "hi"), (k.as_py() for k in key)))
    same = names["lo"] == names["hi"]
    table = table.sort_by("node")
    tiles = table.column("tile").to_numpy()
    sides, full = [], []
    for tile in (names["lo"], names["hi"]):
        part = table.filter(pa.array(tiles == tile))
        codes = np.frombuffer(b"".join(part.column("codes").to_pylist()), np.int8)
        full.append(np.frombuffer(b"".join(part.column("x").to_pylist()), np.float64).reshape(-1, names["dim"]))
        sides.append(
            Side(
                part.column("node").to_numpy(), codes.reshape(-1, names["dim"]),
                *(part.column(name).to_numpy() for name in ("scale", "loss", "copies")),
            )
        )

    def decided() -> Iterator[tuple[np.ndarray, ...]]:
        for i, j, sure in near_pairs(*sides, same, threshold):
            i, j = i[~sure], j[~sure]
            for at in range(0, len(i), BLOCK * 16):
                a, b = i[at : at + BLOCK * 16], j[at : at + BLOCK * 16]
                cosine = np.einsum("ij,ij->i", full[0][a], full[1][b])
                hit = cosine >= threshold
                yield a[hit], b[hit], np.ones(int(hit.sum()), bool)

    return _summary(names, *sides, same, decided(), False)


def tile_count(nodes: int, dim: int, cores: int) -> int:
    """Tiles that hold at most ``TILE_BYTES``, and enough for every core to have pairs."""
    by_size = -(-nodes * dim // TILE_BYTES)
    for_cores = min(-(-nodes // TILE_ROWS), math.isqrt(4 * cores) + 1)
    return max(1, by_size, for_cores)


def near_vectors(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``embeddings``.

    Two rows are linked if the cosine of their vectors, in double precision, is at least
    ``threshold`` (over 0). ``n_links`` counts the other rows linked directly;
    ``component_id`` is the smallest vec_id reachable, and ``kept`` whether it is the row's own.

    ``embeddings`` needs vec_id and embedding; other columns are not read. Vectors that are
    null, empty, zero or hold null or non-finite components link with nothing, nor do those
    of different dimensions with each other. Rows that repeat a vec_id are rows of their own,
    so both are kept or neither. A null vec_id takes part, but is a component_id only where
    all are null.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x")
    ).withColumn("x", F.when(usable(F.col("x")), F.col("x")))
    distinct = checkpointed(
        rows.filter("x is not null")
        .groupBy("x")
        .agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    )
    size = distinct.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("dim")).first()
    tiles = tile_count(size["n"], size["dim"] or 0, spark.sparkContext.defaultParallelism)
    place = F.row_number().over(Window.partitionBy("tile").orderBy("x")) - 1
    nodes = (
        distinct.withColumn("tile", F.pmod(F.xxhash64("x"), F.lit(tiles)).cast("int"))
        .withColumn("node", F.shiftleft(F.col("tile").cast("long"), 32) + place)
        .withColumn("dim", F.size("x"))
    )
    key = checkpointed(nodes)
    coded = checkpointed(
        key.select("node", "tile", "dim", "copies", "x").mapInArrow(
            _code_batches, f"node long, tile int, dim int, copies long, {CODE}"
        )
    )
    packed = checkpointed(coded.drop("x").groupBy("dim", "tile").applyInArrow(_pack, TILE))
    met = (
        packed.withColumn("beside", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
        .withColumns({"lo": F.least("tile", "beside"), "hi": F.greatest("tile", "beside")})
        .drop("beside")
        .groupBy("dim", "lo", "hi")
        .applyInArrow(lambda key, table: _meet(key, table, threshold), FOUND)
    )
    by_codes = checkpointed(met)
    opened = by_codes.filter("kind = 'open'").select("dim", "lo", "hi", "node").join(
        coded.drop("dim"), "node"
    )
    in_full = checkpointed(
        opened.groupBy("dim", "lo", "hi").applyInArrow(lambda key, table: _recompute(key, table, threshold), FOUND)
    )
    found = by_codes.union(in_full)
    links = found.filter("kind = 'links'").groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.filter("kind = 'edge'").select(F.col("node").alias("u"), F.col("other").alias("v")))
    member = (
        key.join(links, "node", "left")
        .join(roots, "node", "left")
        .select("x", "first", "copies", "links", F.coalesce("root", "node").alias("root"))
        .filter("copies > 1 or links is not null")
    )
    smallest = member.groupBy("root").agg(F.min("first").alias("component"))
    classes = checkpointed(
        member.join(smallest, "root").select(
            F.col("x").alias("_x"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("_links"), "component"
        )
    )
    known = rows.join(classes, F.col("x") == F.col("_x"), "left")
    component = F.when(F.col("_x").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return known.select(
        "vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


ships_by_value(__name__)
