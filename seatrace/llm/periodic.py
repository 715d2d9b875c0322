"""Periodic runs of words, detected on a grammar that Re-Pair builds for every document.

Re-Pair replaces the most frequent pair of neighbouring symbols by a new nonterminal until
no pair comes twice. What is left of a document is cut into halves again and again, so that
every stretch of words crosses the boundary of exactly one node: a nonterminal, or a half of
what is left. The runs that cross a node's boundary are computed once, on the node's first
occurrence, and translated to all positions at which it was derived; of intervals with the
same period, those inside another one are cut-off views of the same run and go.

The documents of a block share the work but no symbol, so each has a grammar of its own.
"""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatrace.llm.arrays import BASE, Hasher, Powers, mixed
from seatrace.llm.common import ships_by_value, small_batches, text_slices

#: A run is at least this long, and at least this many times its period.
SHORTEST = 6
REPEATS = 4
#: Bytes of text whose grammars are built together, and word pairs compared at a time.
TEXT_BLOCK = 1 << 20
PAIRS = 1 << 21
#: What stands between documents, and in place of a symbol that was merged into another.
BREAK, GONE = -2, -1

RUN = "struct<start:bigint,length:bigint,period:bigint>"
RUN_ARROW = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


@dataclass(frozen=True)
class Grammar:
    """Nonterminals by the positions at which they were derived, and what they leave.

    ``derived[k]`` are the positions of nonterminal k, which spans ``length[k]`` words and
    whose first part spans ``first[k]``; ``top`` are the positions of the symbols left.
    """

    derived: list[list[int]]
    first: list[int]
    length: list[int]
    top: np.ndarray


def re_pair(symbols: np.ndarray, shortest: int = SHORTEST) -> Grammar:
    """Grammar of ``symbols`` (0 and up; BREAK ends a document and also stands in front).

    Pairs are taken by their number of occurrences, equal ones in the order in which they
    came up, which keeps nonterminals balanced. Nonterminals of fewer than ``shortest``
    words are left out of the result.
    """
    size = len(symbols)
    seq = array("q", symbols.astype(np.int64).tobytes())
    follow = array("q", np.arange(1, size + 1, dtype=np.int64).tobytes())
    back = array("q", np.arange(-1, size - 1, dtype=np.int64).tobytes())
    symbol = first_free = int(symbols.max()) + 1 if size else 0
    spans: list[int] = []
    derived, firsts, lengths = [], [], []

    whole = np.flatnonzero((symbols[:-1] >= 0) & (symbols[1:] >= 0))
    key = symbols[whole] * first_free + symbols[whole + 1]
    order = np.argsort(key, kind="stable")
    key, whole = key[order], whole[order]
    opens = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    counts = np.diff(np.append(opens, len(key)))
    again = counts > 1
    buckets: defaultdict[int, list] = defaultdict(list)
    for at, n in zip(opens[again].tolist(), counts[again].tolist()):
        buckets[n].append((int(key[at]) // first_free, int(key[at]) % first_free, whole[at : at + n].tolist()))

    for count in range(max(buckets, default=1), 1, -1):
        for a, b, places in _drain(buckets, count):
            found, taken = [], -1
            for i in places:
                if seq[i] == a and i != taken:
                    j = follow[i]
                    if seq[j] == b:
                        found.append(i)
                        taken = j if a == b else -1
            if len(found) < count:  # some went into other nonterminals since
                if len(found) > 1:
                    # places skipped as overlapping may be free of overlap by then
                    rest = found if a != b else [i for i in places if seq[i] == seq[follow[i]] == a]
                    buckets[len(found)].append((a, b, rest))
                continue
            span_a = spans[a - first_free] if a >= first_free else 1
            span_b = spans[b - first_free] if b >= first_free else 1
            spans.append(span_a + span_b)
            if span_a + span_b >= shortest:
                derived.append(found)
                firsts.append(span_a)
                lengths.append(span_a + span_b)
            new = defaultdict(list)
            for i in found:
                j = follow[i]
                after, before = follow[j], back[i]
                seq[i], seq[j] = symbol, GONE
                follow[i] = after
                back[after] = i
                left, right = seq[before], seq[after]
                if left >= 0:
                    new[2 * left].append(before)
                if right >= 0:
                    new[2 * right + 1].append(i)
            for side, places_of in new.items():
                if len(places_of) > 1:
                    pair = (symbol, side >> 1) if side & 1 else (side >> 1, symbol)
                    buckets[min(len(places_of), count)].append((*pair, places_of))
            symbol += 1
    left = np.frombuffer(seq, np.int64) if size else np.zeros(0, np.int64)
    return Grammar(derived, firsts, lengths, np.flatnonzero(left != GONE))


def _drain(buckets: dict[int, list], count: int) -> Iterator[tuple[int, int, list[int]]]:
    """Pairs of a bucket in order, those included that are added on the way."""
    at = 0
    while at < len(buckets.get(count, ())):
        yield buckets[count][at]
        buckets[count][at] = None
        at += 1
    buckets.pop(count, None)


def _halves(top: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(start, boundary, end) of all halvings of the symbols at ``top`` of each document."""
    low, high = np.searchsorted(top, begins), np.searchsorted(top, ends)
    nodes = []
    while len(low):
        low, high = low[high - low > 1], high[high - low > 1]
        # a node shorter than the shortest run has none
        long = top[high] - top[low] >= SHORTEST
        low, high = low[long], high[long]
        middle = (low + high) // 2
        nodes.append(np.stack([top[low], top[middle], top[high]], axis=1))
        low, high = np.concatenate([low, middle]), np.concatenate([middle, high])
    return np.concatenate(nodes) if nodes else np.zeros((0, 3), np.int64)


def _squares(symbols: np.ndarray, hasher: Hasher, nodes: np.ndarray, forward: bool) -> tuple[np.ndarray, np.ndarray]:
    """(node, q) where a square of period q starts (``forward``) or ends at the boundary."""
    start, middle, end = nodes.T
    room = np.minimum((end - middle if forward else middle - start) // 2, (end - start) // REPEATS)
    found = []
    cuts = np.flatnonzero(np.diff(np.cumsum(room) // PAIRS, prepend=0))
    for part in np.split(np.arange(len(nodes)), cuts):
        n = room[part]
        node = np.repeat(part, n)
        q = np.arange(len(node)) - np.repeat(np.cumsum(n) - n, n) + 1
        base = middle[node] if forward else middle[node] - 2 * q
        # the first and the last word of both halves, then the halves as a whole
        same = symbols[base] == symbols[base + q]
        node, q, base = node[same], q[same], base[same]
        same = symbols[base + q - 1] == symbols[base + 2 * q - 1]
        node, q, base = node[same], q[same], base[same]
        same = hasher.spans(base, base + q) == hasher.spans(base + q, base + 2 * q)
        found.append(np.stack([node[same], q[same]], axis=1))
    both = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    return both[:, 0], both[:, 1]


def crossing_runs(symbols: np.ndarray, hasher: Hasher, nodes: np.ndarray) -> np.ndarray:
    """(node, start, end, period) of the runs that cross the boundary of a node or touch it.

    A run of four periods has two of them on one side of a boundary, so a square ends there.
    Squares are found by hash; every run is then measured on the symbols themselves.
    """
    out = []
    for forward in (True, False):
        node, q = _squares(symbols, hasher, nodes, forward)
        cuts = np.flatnonzero(np.diff(node)) + 1
        for at, periods in zip(node[np.append(0, cuts)].tolist() if len(node) else [], np.split(q, cuts)):
            start, middle, end = nodes[at].tolist()
            while len(periods):
                period = int(periods[0])
                inside = middle if forward else middle - 2 * period
                a, b = _stretch(symbols, start, end, period, inside)
                if b - inside < 2 * period:  # the hashes of different words met
                    periods = periods[1:]
                    continue
                if b - a >= max(SHORTEST, REPEATS * period):
                    out.append((at, a, b, period))
                # multiples of the period whose square lies in this run are this run
                covered = middle + 2 * periods <= b if forward else middle - 2 * periods >= a
                periods = periods[~(covered & (periods % period == 0))]
    return np.array(out, np.int64).reshape(-1, 4)


def _stretch(symbols: np.ndarray, start: int, end: int, period: int, inside: int) -> tuple[int, int]:
    """The longest stretch of [start, end) with this period that holds position ``inside``."""
    low = high = inside
    step = max(64, 4 * period)
    while low > start:
        a = max(start, low - step)
        differ = np.flatnonzero(symbols[a:low] != symbols[a + period : low + period])
        if len(differ):
            low = a + int(differ[-1]) + 1
            break
        low, step = a, 2 * step
    step = max(64, 4 * period)
    last = end - period
    while high < last:
        b = min(last, high + step)
        differ = np.flatnonzero(symbols[high:b] != symbols[high + period : b + period])
        if len(differ):
            high += int(differ[0])
            break
        high, step = b, 2 * step
    return low, high + period


def document_runs(symbols: np.ndarray, begins: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """(document, start, end, period) of every maximal run, by document, start and period.

    Document k has the symbols from ``begins[k]`` to ``ends[k]``; starts count within it.
    """
    grammar = re_pair(symbols)
    first = np.fromiter((places[0] for places in grammar.derived), np.int64, len(grammar.derived))
    length = np.array(grammar.length, np.int64)
    rules = np.stack([first, first + np.array(grammar.first, np.int64), first + length], axis=1).reshape(-1, 3)
    nodes = np.concatenate([rules, _halves(grammar.top, begins, ends)])
    codes = mixed((symbols + 3).astype(np.uint64) * BASE)
    runs = crossing_runs(symbols, Hasher(codes, powers), nodes)

    spread = [runs[runs[:, 0] >= len(rules), 1:]]
    for node, a, b, period in runs[runs[:, 0] < len(rules)].tolist():
        places = np.array(grammar.derived[node], np.int64) - first[node]
        spread.append(np.stack([a + places, b + places, np.full(len(places), period)], axis=1))
    start, end, period = np.concatenate(spread).T
    document = np.searchsorted(begins, start, side="right") - 1
    order = np.lexsort((-end, start, period, document))
    document, start, end, period = (x[order] for x in (document, start, end, period))
    opens = np.concatenate(([True], (document[1:] != document[:-1]) | (period[1:] != period[:-1])))
    lift = np.cumsum(opens[: len(start)]) * (len(symbols) + 1)
    reach = np.maximum.accumulate(end + lift) if len(end) else end
    own = np.ones(len(start), bool)
    own[1:] = (end + lift)[1:] > reach[:-1]
    document, start, end, period = (x[own] for x in (document, start, end, period))
    order = np.lexsort((period, start, document))
    shift = begins[document]
    return np.stack([document, start - shift, end - shift, period], axis=1)[order]


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with a periodic end, for a tenth of the doc_ids; a null doc_id has none."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % period] for i in range(n - a)]


def text_runs(texts: list[list[bytes]], powers: Powers) -> list[tuple[np.ndarray, bytes]]:
    """Runs (start, length, period) of each list of words, and the words kept, joined."""
    numbers: list[np.ndarray] = []
    offset = 0
    for words in texts:
        index: defaultdict[bytes, int] = defaultdict()
        index.default_factory = index.__len__
        numbers.append(np.fromiter(map(index.__getitem__, words), np.int64, len(words)) + offset)
        offset += len(index)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 1)
    begins = ends - sizes
    symbols = np.full(int(sizes.sum()) + len(texts) + 1, BREAK, np.int64)
    for begin, found in zip(begins.tolist(), numbers):
        symbols[begin : begin + len(found)] = found
    runs = document_runs(symbols, begins, ends, powers)
    change = np.zeros(len(symbols) + 1, np.int64)
    shift = begins[runs[:, 0]]
    np.add.at(change, runs[:, 1] + runs[:, 3] + shift, 1)
    np.add.at(change, runs[:, 2] + shift, -1)
    dropped = np.cumsum(change) > 0
    per_text = np.split(runs, np.searchsorted(runs[:, 0], np.arange(1, len(texts))))
    out = []
    for words, begin, found in zip(texts, begins.tolist(), per_text):
        if len(found):
            gone = dropped[begin : begin + len(words)].tolist()
            words = [w for w, g in zip(words, gone) if not g]
        spans = np.stack([found[:, 1], found[:, 2] - found[:, 1], found[:, 3]], axis=1)
        out.append((spans, b" ".join(words)))
    return out


def _run_batches(batches: Iterator[pa.RecordBatch], plant: bool) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for begin, stop in text_slices(batch.column(1), TEXT_BLOCK):
            # bytes.split() separates at exactly the six blanks of the word rule
            texts = [(t.as_py() or b"").split() for t in batch.column(1)[begin:stop]]
            if plant:
                texts = [planted(words, i) for words, i in zip(texts, ids[begin:stop])]
            found = text_runs(texts, powers)
            spans = np.concatenate([runs for runs, _ in found])
            offsets = np.cumsum([0, *(len(runs) for runs, _ in found)])
            runs = pa.StructArray.from_arrays([pa.array(c) for c in spans.T], fields=list(RUN_ARROW))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[begin:stop],
                    pa.array([len(words) for words in texts], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs),
                    pa.array([kept for _, kept in found], pa.binary()),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )


def periodic_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """doc_id, n_words, ``runs`` (start, length, period) and ``collapsed`` text of every row.

    A run is a stretch of words with smallest period q, at least ``REPEATS`` * q and
    ``SHORTEST`` words long, that neither neighbour extends; runs come by start, then
    period. ``collapsed`` holds the words that no run contains after its first period,
    joined by one space. ``plant`` gives a tenth of the documents a periodic end first.

    ``docs`` needs doc_id and text; other columns are not read. Null, empty and blank texts
    have no words, no runs and an empty collapsed text. Rows that repeat a doc_id are each
    judged on their own; a null doc_id stays null and gets nothing planted. A document must
    fit a task's memory some twenty-fold.
    """
    small_batches(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")
    ).mapInArrow(
        lambda batches: _run_batches(batches, plant),
        f"doc_id long, n_words long, runs array<{RUN}>, collapsed binary",
    )


def _longest(runs: Column) -> Column:
    """The run with the greatest length; of ties the one with smallest start, then period."""
    keys = F.transform(
        runs, lambda r: F.struct(-r["length"], r["start"], r["period"], r.alias("run"))
    )
    return F.array_min(keys)["run"]


def runs_digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run and digests of a result of ``periodic_runs``."""
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", _longest(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


ships_by_value(__name__)
