"""Tokens per document in flat token files that have no index.

A file is a run of 16-bit token ids in which a separator ends each document. Blocks are
searched for separators at once; what a block cannot know (how many documents began before
it, how long the first one already is) follows from running sums and a running maximum over
the blocks of its file.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seatrace.llm.bpe import shared_ranks, text_blocks
from seatrace.llm.common import checkpointed, ships_by_value, small_batches
from seatrace.session import work_dir

#: Tokens of a block, and blocks whose running sums are taken together.
BLOCK_TOKENS = 1 << 18
SPAN_BLOCKS = 1 << 10


def _files(
    batches: Iterator[pa.RecordBatch], ranks: dict[bytes, int], pattern: str, separator: int
) -> Iterator[pa.RecordBatch]:
    """Rows (kind, file, number, data): blocks of tokens, and lists of the documents' ids."""
    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    file = TaskContext.get().partitionId()
    held, tokens, blocks, documents = [], 0, 0, 0

    def row(kind: str, number: int, data: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"kind": [kind], "file": [file], "number": [number], "data": [data]})

    for batch in batches:
        for part, texts in text_blocks(batch):
            for ids in encoding.encode_ordinary_batch(texts, num_threads=1):
                held.append(np.array([*ids, separator], "<u2"))
                tokens += len(held[-1])
            if part.num_rows:
                known = part.column(0)
                pairs = np.stack([known.fill_null(0).to_numpy(), known.is_valid().to_numpy(zero_copy_only=False)], axis=1)
                yield row("documents", documents, pairs.astype("<i8").tobytes())
                documents += part.num_rows
            while tokens >= BLOCK_TOKENS:
                flat = np.concatenate(held)
                yield row("tokens", blocks, flat[:BLOCK_TOKENS].tobytes())
                held, tokens, blocks = [flat[BLOCK_TOKENS:]], tokens - BLOCK_TOKENS, blocks + 1
    if tokens:
        yield row("tokens", blocks, np.concatenate(held).tobytes())


def write_token_files(
    docs: DataFrame, path: str, ranks_path: str, pattern: str, separator: int
) -> None:
    """Encode ``docs`` into flat token files, one per task, cut into blocks at ``path``.

    ``separator`` must not be an id of the vocabulary and must fit 16 bits. A null or empty
    text is a separator alone. A null doc_id is written as such.
    """
    ranks = shared_ranks(docs.sparkSession, ranks_path)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows.mapInArrow(
        lambda batches: _files(batches, ranks.value.ranks, pattern, separator),
        "kind string, file long, number long, data binary",
    ).write.option("compression", "zstd").partitionBy("kind").parquet(path)


def _of_kind(spark: SparkSession, path: str, kind: str) -> DataFrame:
    # the kind is a folder, so only its files are opened; without rows there is none
    rows = spark.read.schema("kind string, file long, number long, data binary").parquet(path)
    return rows.filter(F.col("kind") == kind).drop("kind")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """(file, number, data) of the token files at ``path``."""
    return _of_kind(spark, path, "tokens")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(file, ordinal, doc_id): which documents were written, in order."""
    rows = _of_kind(spark, path, "documents")
    return rows.mapInArrow(_listed, "file long, ordinal long, doc_id long")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, number, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
            ids, known = np.frombuffer(data, "<i8").reshape(-1, 2).T
            yield pa.RecordBatch.from_pydict(
                {
                    "file": pa.array(np.full(len(ids), file)),
                    "ordinal": pa.array(np.arange(number, number + len(ids))),
                    "doc_id": pa.array(ids, mask=known == 0),
                }
            )


def _scanned(batches: Iterator[pa.RecordBatch], separator: int) -> Iterator[pa.RecordBatch]:
    """(file, number, size, ends): tokens of a block and where its separators are."""
    for batch in batches:
        blocks = [np.frombuffer(x.as_py() or b"", "<u2") for x in batch.column("data")]
        ends = [np.flatnonzero(block == separator) for block in blocks]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("file"),
                batch.column("number"),
                pa.array([len(block) for block in blocks], pa.int64()),
                pa.array(ends, pa.list_(pa.int64())),
            ],
            names=["file", "number", "size", "ends"],
        )


def count_tokens(blocks: DataFrame, separator: int) -> DataFrame:
    """(file, ordinal, n_tokens) of every document in ``blocks`` (file, number, data).

    Separators are not counted. Tokens after the last separator of a file are a document of
    their own. Null and empty blocks hold nothing; repeated blocks are read as they come, and
    blocks with a null file or number are ignored. The scan is taken in two levels, within
    spans of SPAN_BLOCKS blocks and then over the spans of a file.
    """
    scanned = checkpointed(
        blocks.select(F.col("file").cast("long"), F.col("number").cast("long"), "data")
        .filter("file is not null and number is not null")
        .mapInArrow(
            lambda batches: _scanned(batches, separator),
            "file long, number long, size long, ends array<long>",
        )
        .withColumn("span", F.floor(F.col("number") / SPAN_BLOCKS))
    )
    within = Window.partitionBy("file", "span").orderBy("number")
    local = scanned.withColumns(
        {
            "begin": F.sum("size").over(within) - F.col("size"),
            "index": F.sum(F.size("ends")).over(within) - F.size("ends"),
        }
    ).withColumn("last", F.col("begin") + F.array_max("ends"))
    known = local.withColumn(
        "previous", F.max("last").over(within.rowsBetween(Window.unboundedPreceding, -1))
    )
    spans = local.groupBy("file", "span").agg(
        F.sum("size").alias("span_size"),
        F.sum(F.size("ends")).alias("span_ends"),
        F.max("last").alias("span_last"),
    )
    over_file = Window.partitionBy("file").orderBy("span")
    placed = spans.withColumns(
        {
            "span_begin": F.sum("span_size").over(over_file) - F.col("span_size"),
            "span_index": F.sum("span_ends").over(over_file) - F.col("span_ends"),
        }
    ).withColumn("absolute", F.col("span_begin") + F.col("span_last"))
    placed = placed.withColumn(
        "span_previous",
        F.coalesce(
            F.max("absolute").over(over_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1)
        ),
    ).select("file", "span", "span_begin", "span_index", "span_previous")
    joined = known.join(placed, ["file", "span"]).select(
        "file",
        (F.col("span_index") + F.col("index")).alias("index"),
        (F.col("span_begin") + F.col("begin")).alias("begin"),
        F.coalesce(F.col("span_begin") + F.col("previous"), F.col("span_previous")).alias("previous"),
        "ends",
    )
    ended = joined.select("file", "index", "begin", "previous", F.posexplode("ends").alias("i", "end"),
                          "ends").select(
        "file",
        (F.col("index") + F.col("i")).alias("ordinal"),
        (F.col("begin") + F.col("end")
         - F.when(F.col("i") == 0, F.col("previous")).otherwise(F.col("begin") + F.get("ends", F.col("i") - 1))
         - 1).alias("n_tokens"),
    )
    totals = placed.groupBy("file").agg(F.max("span").alias("span"))
    rest = (
        spans.join(placed, ["file", "span"])
        .join(totals, ["file", "span"])
        .select(
            "file",
            (F.col("span_index") + F.col("span_ends")).alias("ordinal"),
            (F.col("span_begin") + F.col("span_size")
             - F.coalesce(F.col("span_begin") + F.col("span_last"), F.col("span_previous")) - 1).alias("n_tokens"),
        )
        .filter("n_tokens > 0")
    )
    return ended.union(rest)


def document_tokens(docs: DataFrame, ranks_path: str, pattern: str, separator: int) -> DataFrame:
    """doc_id and n_tokens of every row of ``docs``, counted in token files written for it.

    A null doc_id stays null; null and empty texts have no tokens; rows that repeat a doc_id
    are counted each.
    """
    spark = docs.sparkSession
    small_batches(spark)
    path = f"{work_dir(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(docs, path, ranks_path, pattern, separator)
    counts = count_tokens(read_blocks(spark, path), separator)
    return counts.join(read_documents(spark, path), ["file", "ordinal"]).select("doc_id", "n_tokens")


ships_by_value(__name__)
