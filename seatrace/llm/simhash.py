"""Near-duplicates by SimHash, joined by meet-in-the-middle ball hashing.

Two fingerprints at distance d <= 2h have a middle fingerprint within h of both. Every
distinct fingerprint therefore emits all variants within h, the variants are shuffled, and
fingerprints that meet at a variant are linked. A variant has at most as many distinct
fingerprints around it as there are variants, so no group grows with the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatrace.llm.common import checkpointed, ships_by_value
from seatrace.llm.components import components

BITS = 64
SEED = 42
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Shingles whose bits are counted at a time.
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash; zero for a text without words."""
    # bytes.split() separates at exactly the six blanks of the word rule
    found = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(shingle, len(found))
    spans = zip(starts[: len(found) - size + 1].tolist(), ends[size - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = hashes[at : at + BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    value = int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _fingerprint_batches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(values, pa.int64())], names=["doc_id", "fp"]
        )


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp) for every row of ``docs``."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda batches: _fingerprint_batches(batches, shingle), "doc_id long, fp long"
    )


def variants(fp: Column, within: int) -> Column:
    """Array of all fingerprints that differ from ``fp`` in at most ``within`` bits."""
    masks = [0]
    for size in range(1, within + 1):
        masks += [sum(1 << bit for bit in bits) for bits in combinations(range(BITS), size)]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    return F.array(*[fp.bitwiseXOR(F.lit(m).cast("long")) for m in signed])


def links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """(u, v) edges that connect all of ``distinct`` (fp) within ``radius`` bits.

    Fingerprints that meet at a variant differ pairwise in at most ``radius`` bits, so an
    edge from each to the smallest of them keeps every connection without all pairs.
    """
    if radius % 2 or radius < 0:
        raise ValueError("radius must be even, so that both sides reach the middle")
    met = distinct.select("fp", F.explode(variants(F.col("fp"), radius // 2)).alias("variant"))
    first = F.min("fp").over(Window.partitionBy("variant"))
    return (
        met.select(F.col("fp").alias("u"), first.alias("v"))
        .filter("u != v")
        .filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)
        .distinct()
    )


def simhash_classes(docs: DataFrame, radius: int = 2, shingle: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row of ``docs``.

    ``docs`` needs doc_id and text; other columns are not read. Null, empty and wordless
    texts have fingerprint zero. Rows that repeat a doc_id are returned as often as they
    come. A null doc_id takes part, but is never a component_id unless all are null.
    """
    made = checkpointed(fingerprints(docs, shingle))
    distinct = made.groupBy("fp").agg(F.min("doc_id").alias("first"))
    rooted = distinct.join(
        components(links(distinct, radius)), F.col("fp") == F.col("node"), "left"
    ).select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = checkpointed(rooted.join(smallest, "root").select("fp", "component_id"))
    return made.join(classes, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


ships_by_value(__name__)
