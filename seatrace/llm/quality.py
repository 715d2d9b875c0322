"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its own features and those of the lines around it weigh for
either, and neighbouring lines tend to agree. The score of a document is the mean of the
lines' marginal probabilities of being good, weighted by length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatrace.llm.arrays import Powers, mixed, word_hashes
from seatrace.llm.common import quoted, ships_by_value, small_batches, text_slices

#: Labelled documents that a fit uses at most, those with the smallest hash of doc_id, and
#: lines of each: a document of more lines is learned from as many, evenly spread, with the
#: lines around them. The model has a few dozen weights; more would not change it much.
FIT_DOCUMENTS = 3000
FIT_LINES = 2000
ROUNDS = 150
LEARNING_RATE = 0.1
#: Weights have a normal prior of this precision, which counts less the more documents there are.
PRIOR = 1.0
#: Bytes of text whose features are computed together.
TEXT_BLOCK = 1 << 20

LINE_FEED = 10
FEATURES = (
    "empty", "log_length", "word_length", "upper", "digits", "exclamations", "symbols", "bars",
    "stops", "commas", "other_marks", "same_as_previous_word", "distinct_words", "repeated_line",
    "high_bytes", "open_end",
)


def _flags(characters: bytes) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[list(characters)] = 1
    return table


UPPER, DIGITS, BARS = _flags(bytes(range(65, 91))), _flags(b"0123456789"), _flags(b"|")
EXCLAMATIONS, SYMBOLS = _flags(b"!?"), _flags(b"#*$%&<>@=~^_{}[]\\+/")
STOPS, COMMAS, OTHERS = _flags(b".:;"), _flags(b","), _flags(b"\"'()-`")
HIGH = _flags(bytes(range(128, 256)))


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return total[ends] - total[starts]


def line_features(texts: list[bytes], powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (lines by FEATURES with those of the line before and after), lengths in bytes
    and the number of lines of each text. An empty text is one empty line."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    breaks = np.flatnonzero(data == LINE_FEED)
    starts = np.concatenate(([0], breaks + 1))
    ends = np.concatenate((breaks, [len(data)]))
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.concatenate(([0], np.cumsum(sizes + 1)))
    document = np.searchsorted(begins, starts, side="right") - 1
    n_lines = np.bincount(document, minlength=len(texts))

    word_start, word_end, hashes = word_hashes(data, powers)
    line = np.searchsorted(starts, word_start, side="right") - 1
    n_words = np.bincount(line, minlength=len(starts))
    letters = np.bincount(line, weights=word_end - word_start, minlength=len(starts))
    words = np.maximum(n_words, 1)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    order = np.lexsort((hashes, line))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (line[order][1:] != line[order][:-1])
    distinct = np.bincount(line[order][new], minlength=len(starts))

    first_word = np.searchsorted(line, np.arange(len(starts)))
    position = (np.arange(len(line)) - first_word[line]).astype(np.uint64)
    in_order = mixed(hashes + position * np.uint64(0x632BE59BD9B4E019))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(in_order)))
    line_hash = sums[first_word + n_words] - sums[first_word]
    order = np.lexsort((np.arange(len(starts)), line_hash, document))
    repeated = np.zeros(len(starts), bool)
    same = (line_hash[order][1:] == line_hash[order][:-1]) & (document[order][1:] == document[order][:-1])
    repeated[order[1:]] = same
    repeated &= n_words > 0

    length = ends - starts
    size = np.maximum(length, 1)

    def per(table: np.ndarray, over: np.ndarray) -> np.ndarray:
        return _sums(table[data], starts, ends) / over

    final = data[np.maximum(ends - 1, 0)] if len(data) else np.zeros(len(starts), np.uint8)
    closed = np.isin(final, list(b".!?:;\"')")) & (n_words > 0)
    own = np.stack(
        [
            n_words == 0,
            np.log1p(length) / 6,
            np.minimum(letters / words, 30) / 10,
            per(UPPER, size) * 2,
            per(DIGITS, size) * 4,
            np.minimum(per(EXCLAMATIONS, words), 2),
            np.minimum(per(SYMBOLS, words), 3),
            np.minimum(per(BARS, words), 2),
            np.minimum(per(STOPS, words), 2),
            np.minimum(per(COMMAS, words), 2),
            np.minimum(per(OTHERS, words), 2),
            np.bincount(line[again], minlength=len(starts)) / words * 2,
            distinct / words,
            repeated,
            per(HIGH, size),
            ~closed,
        ],
        axis=1,
    ).astype(np.float64)
    around = np.zeros((len(own) + 2, own.shape[1]))
    around[1:-1] = own
    starts_document = np.concatenate(([True], document[1:] != document[:-1]))
    before = np.where(starts_document[:, None], own, around[:-2])
    after = np.where(np.concatenate((starts_document[1:], [True]))[:, None], own, around[2:])
    return np.concatenate([own, before, after], axis=1), length, n_lines


@dataclass(frozen=True)
class Model:
    """Weights of the features for a good line, and transitions between bad (0) and good (1)."""

    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    moves: np.ndarray


def _padded(values: np.ndarray, n_lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(documents, lines) of ``values`` and a mask of what is there."""
    width = int(n_lines.max())
    there = np.arange(width)[None, :] < n_lines[:, None]
    out = np.zeros((len(n_lines), width))
    out[there] = values
    return out, there


def _forward_backward(emission: np.ndarray, there: np.ndarray, moves: np.ndarray):
    """Log messages and log partition of binary chains; a bad line's emission is 0."""
    documents, width = emission.shape
    potential = np.stack([np.zeros_like(emission), emission], axis=2)
    ahead = np.zeros((documents, width, 2))
    ahead[:, 0] = potential[:, 0]
    for t in range(1, width):
        message = np.logaddexp(
            ahead[:, t - 1, :1] + moves[0], ahead[:, t - 1, 1:] + moves[1]
        )
        ahead[:, t] = np.where(there[:, t, None], message + potential[:, t], ahead[:, t - 1])
    total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
    behind = np.zeros((documents, width, 2))
    for t in range(width - 2, -1, -1):
        onward = potential[:, t + 1] + behind[:, t + 1]
        message = np.logaddexp(moves[:, 0] + onward[:, :1], moves[:, 1] + onward[:, 1:])
        behind[:, t] = np.where(there[:, t + 1, None], message, 0.0)
    return ahead, behind, potential, total


def marginals(emission: np.ndarray, there: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Probability that each line is good."""
    ahead, behind, _, total = _forward_backward(emission, there, moves)
    return np.exp(np.minimum(ahead[:, :, 1] + behind[:, :, 1] - total[:, None], 0.0)) * there


def fit_lines(features: np.ndarray, n_lines: np.ndarray, good: np.ndarray) -> Model:
    """Maximise the chains' mean log-likelihood per line; every line has its document's label.

    A document counts as one, however many lines it has, and labels keep their share, so a
    text that tells nothing is judged as most are.
    """
    center, scale = features.mean(axis=0), features.std(axis=0) + 1e-3
    x = (features - center) / scale
    # chains of similar length are padded together
    order = np.argsort(n_lines, kind="stable")
    begins = np.concatenate(([0], np.cumsum(n_lines)))
    groups = []
    for chosen in np.array_split(order, max(1, len(order) // 250)):
        rows = np.concatenate([np.arange(begins[d], begins[d + 1]) for d in chosen])
        groups.append((x[rows], n_lines[chosen], good[chosen].astype(np.float64)))
    weights, bias, moves = np.zeros(x.shape[1]), 0.0, np.zeros((2, 2))
    theta = np.concatenate([weights, [bias], moves.ravel()])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, ROUNDS + 1):
        gradient = np.zeros_like(theta)
        for rows, lengths, label in groups:
            emission, there = _padded(rows @ theta[:-5] + theta[-5], lengths)
            moves = theta[-4:].reshape(2, 2)
            ahead, behind, potential, total = _forward_backward(emission, there, moves)
            balance = 1 / np.maximum(lengths, 1)
            p = np.exp(np.minimum(ahead[:, :, 1] + behind[:, :, 1] - total[:, None], 0.0))
            push = ((label[:, None] - p) * balance[:, None])[there]
            gradient[:-5] += push @ rows
            gradient[-5] += push.sum()
            pair = (
                ahead[:, :-1, :, None] + moves[None, None]
                + (potential[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
            )
            expected = (np.exp(np.minimum(pair, 0.0)) * there[:, 1:, None, None]).sum(axis=1)
            seen = np.zeros((len(lengths), 2, 2))
            seen[np.arange(len(lengths)), label.astype(int), label.astype(int)] = lengths - 1
            gradient[-4:] += ((seen - expected) * balance[:, None, None]).sum(axis=0).ravel()
        gradient = (gradient - PRIOR * theta) / len(n_lines)
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        theta = theta + LEARNING_RATE * (first / (1 - 0.9**step)) / (
            np.sqrt(second / (1 - 0.99**step)) + 1e-8
        )
    return Model(center, scale, theta[:-5], float(theta[-5]), theta[-4:].reshape(2, 2))


def score_texts(texts: list[bytes], model: Model | None, powers: Powers) -> np.ndarray:
    """Length-weighted mean marginal of each text; without a model, 0.5."""
    if model is None:
        return np.full(len(texts), 0.5)
    features, length, n_lines = line_features(texts, powers)
    emission = ((features - model.center) / model.scale) @ model.weights + model.bias
    begins = np.concatenate(([0], np.cumsum(n_lines)))
    out = np.zeros(len(texts))
    # chains of similar length are padded together
    order = np.argsort(n_lines, kind="stable")
    for chosen in np.split(order, np.flatnonzero(np.diff(np.ceil(np.log2(n_lines[order])))) + 1):
        rows = np.concatenate([np.arange(begins[d], begins[d + 1]) for d in chosen])
        padded, there = _padded(emission[rows], n_lines[chosen])
        good = marginals(padded, there, model.moves)
        weight, _ = _padded(length[rows] + 1.0, n_lines[chosen])
        out[chosen] = (good * weight).sum(axis=1) / weight.sum(axis=1)
    return np.clip(out, 0.0, 1.0)


def _blocks(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of a batch with about TEXT_BLOCK bytes each, and their texts."""
    for begin, stop in text_slices(batch.column(column), TEXT_BLOCK):
        part = batch.slice(begin, stop - begin)
        yield part, [text or b"" for text in part.column(column).cast(pa.binary()).to_pylist()]


def _thinned(lines: np.ndarray) -> np.ndarray:
    """At most FIT_LINES lines of a document, evenly spread."""
    if len(lines) <= FIT_LINES:
        return lines
    return lines[np.arange(FIT_LINES) * len(lines) // FIT_LINES]


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in batches:
        for part, texts in _blocks(batch):
            features, _, n_lines = line_features(texts, powers)
            rows = [_thinned(x) for x in np.split(features.astype("<f4"), np.cumsum(n_lines)[:-1])]
            yield pa.RecordBatch.from_arrays(
                [part.column("quality"), pa.array([r.tobytes() for r in rows], pa.binary())],
                names=["quality", "features"],
            )


def _scored(batches: Iterator[pa.RecordBatch], model: Model | None) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in batches:
        for part, texts in _blocks(batch):
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(score_texts(texts, model, powers))],
                names=[*part.schema.names[:-1], "score"],
            )


def _kept(batches: Iterator[pa.RecordBatch], model: Model | None, column: str) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in batches:
        for part, texts in _blocks(batch, column):
            yield part.filter(pa.array(score_texts(texts, model, powers) >= 0.5))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, documents: int = FIT_DOCUMENTS) -> Model | None:
    """A model from at most ``documents`` labelled documents that are not held out.

    Ids labelled both good and bad, null ids or labels, and labels without a document are left
    out; a labelled id that several rows have counts once, with the smallest text. At most
    ``documents`` times FIT_LINES lines reach the driver. None if no label is left or only one
    kind.
    """
    small_batches(docs.sparkSession)
    ids = docs.select(F.col("doc_id").cast("long").alias("_doc"))
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("quality"))
        .dropna()
        .filter(~held_out(F.col("_id")))
        .groupBy("_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("_most"))
        .filter("quality = _most")
        .join(ids, F.col("_doc") == F.col("_id"), "left_semi")
        .orderBy(F.xxhash64("_id"))
        .limit(documents)
        .select("_id", "quality")
    )
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("_doc"), "text")
        .join(F.broadcast(usable), F.col("_doc") == F.col("_id"))
        .groupBy("_id", "quality")
        .agg(F.min("text").alias("text"))
        .select("quality", "text")
        .mapInArrow(_featured, "quality int, features binary")
        .collect()
    )
    good = np.array([row["quality"] > 0 for row in rows], bool)
    if not good.any() or good.all():
        return None
    # one order whatever the order of arrival, so that a rerun gives the same model
    rows.sort(key=lambda row: (row["quality"], bytes(row["features"])))
    good = np.array([row["quality"] > 0 for row in rows], bool)
    width = 3 * len(FEATURES)
    chains = [np.frombuffer(row["features"], "<f4").reshape(-1, width) for row in rows]
    n_lines = np.array([len(chain) for chain in chains])
    return fit_lines(np.concatenate(chains).astype(np.float64), n_lines, good)


def with_score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of every row of ``docs``; null and empty texts are one empty line."""
    # the model travels with the task: a few hundred numbers, whatever the data
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lambda batches: _scored(batches, model), "doc_id long, score double"
    )


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``."""
    return with_score(docs, fit(docs, labels)).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are predicted good, with their columns as they are.

    Each row is judged on its own, so rows that repeat a doc_id or a text all stay or each
    goes by its text; null and empty texts are one empty line.
    """
    model = fit(docs, labels)
    text = f"c{docs.columns.index('text')}"
    # each text goes to Python once, and comes back only if it stays
    numbered = docs.select(*[docs[quoted(c)].alias(f"c{i}") for i, c in enumerate(docs.columns)])
    kept = numbered.mapInArrow(lambda batches: _kept(batches, model, text), numbered.schema)
    return kept.toDF(*docs.columns)


ships_by_value(__name__)
