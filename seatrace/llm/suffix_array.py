"""Suffix-array dedup by bucket-pointer refinement.

The fragments that share an anchor are suffix-sorted to the depth of a window. Buckets start
as q-grams of eight bytes. A bucket's identifier is the place where it begins in the suffix
array; a bucket is refined by sorting its suffixes on the identifiers at the later offset
that its depth reaches, and the refined identifiers serve the next, deeper round.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatrace.llm.common import quoted, ships_by_value
from seatrace.llm.repeats import without_repeats

WINDOW = 50
#: Length of the anchors: longer ones repeat less by chance, shorter ones are fewer.
GRAM = 20
Q = 8


def bucket_pointers(data: np.ndarray, room: np.ndarray, depth: int) -> np.ndarray:
    """Identifiers of the suffixes with at least ``depth`` symbols of room: equal if and only
    if their first ``depth`` bytes are equal, and in their order. Others have -1.

    ``room`` is how many symbols each suffix may use. ``depth`` is at least Q.
    """
    n = len(data)
    pointer = np.full(n, -1, np.int64)
    active = np.flatnonzero(room >= Q)
    if not len(active):
        return pointer
    grams = np.ndarray((n - Q + 1,), ">u8", data.tobytes(), 0, (1,))[active].astype(np.uint64)
    order = np.argsort(grams)
    pointer[active[order]] = _bucket_starts(grams[order])
    reached = Q
    while reached < depth:
        ahead = min(reached, depth - reached)  # the last round may overlap the one before
        wanted = np.flatnonzero(room >= reached + ahead)
        shared = np.bincount(pointer[wanted], minlength=n) > 1
        active = wanted[shared[pointer[wanted]]]
        if not len(active):
            break
        bucket = pointer[active]
        key = bucket * (n + 1) + pointer[active + ahead]
        order = np.argsort(key)
        starts = _bucket_starts(key[order])
        first = _bucket_starts(bucket[order])
        pointer[active[order]] = bucket[order] + starts - first
        reached += ahead
    pointer[room < depth] = -1
    return pointer


def _bucket_starts(sorted_keys: np.ndarray) -> np.ndarray:
    """For each place, where its run of equal keys begins."""
    new = np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))
    return np.maximum.accumulate(np.where(new, np.arange(len(sorted_keys)), 0))


def windows_in_smaller(
    texts: list[bytes], docs: np.ndarray, group: np.ndarray, window: int
) -> list[np.ndarray]:
    """For each text: which of its windows also start in a text with a smaller doc_id."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(texts)), sizes)
    room = ends[text] - np.arange(len(data))
    pointer = bucket_pointers(data, room, window)
    at = np.flatnonzero(room >= window)
    order = np.argsort(pointer[at], kind="stable")
    sorted_pointer, owner = pointer[at][order], docs[text[at]][order]
    edges = np.flatnonzero(np.concatenate(([True], sorted_pointer[1:] != sorted_pointer[:-1])))
    least = np.repeat(np.minimum.reduceat(owner, edges), np.diff(np.append(edges, len(owner))))
    held = np.zeros(len(data), bool)
    held[at[order]] = least < owner
    begins = ends - sizes
    return [held[b : e - window + 1] for b, e in zip(begins.tolist(), ends.tolist())]


def dedup_bytes(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (bytes) of every row of ``docs``.

    A byte goes if a string of ``window`` bytes that covers it also starts in a document with
    a smaller doc_id; strings are judged on the input. Null texts are empty; texts shorter
    than a window stay. Rows with a null doc_id stay whole and are no one's source.
    """
    found = without_repeats(docs, False, window, min(GRAM, window), windows_in_smaller)
    return found.drop("_rest").withColumnRenamed("n", "n_bytes")


def dedup_bytes_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of ``docs``."""
    return dedup_bytes(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def drop_repeated_text(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the repeated strings of their texts.

    A character goes if any of its bytes does, so texts stay valid. A null text stays null,
    and a text that is repeated as a whole becomes empty. Rows that repeat a doc_id remove
    nothing from each other; rows with a null doc_id stay as they are. Columns of any name
    pass through.
    """
    others = [F.lit(0) if c == "text" else docs[quoted(c)] for c in docs.columns]
    rest = [F.col("text").isNull().alias("null"), *[x.alias(f"c{i}") for i, x in enumerate(others)]]
    found = without_repeats(
        docs, False, window, min(GRAM, window), windows_in_smaller, rest, whole_characters=True
    )
    text = F.when(~F.col("_rest.null"), F.col("kept").cast("string"))
    return found.select(
        *[text.alias(c) if c == "text" else F.col(f"_rest.c{i}").alias(c) for i, c in enumerate(docs.columns)]
    )


ships_by_value(__name__)
