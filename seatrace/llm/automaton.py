"""Substring dedup by suffix automata of reference shards.

A shard holds the fragments that share an anchor. The automaton of the documents with the
smallest ids meets the next document as a stream of words: its matching statistics give, at
every word, the longest match that ends there, and a match of a window's length or more marks
the window. The document then joins the automaton. An automaton of all documents would not
fit any executor, and every document against every shard would be quadratic, so a shard's
automaton and the fragments that can match it meet in the same task instead.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatrace.llm.common import ships_by_value
from seatrace.llm.repeats import without_repeats

WINDOW = 50
#: Words of an anchor.
GRAM = 8


class SuffixAutomaton:
    """All substrings of the sequences added, with suffix links and longest lengths."""

    def __init__(self) -> None:
        self.move: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def add(self, sequence: list) -> None:
        state = 0
        for symbol in sequence:
            state = self._extended(state, symbol)

    def _extended(self, last: int, symbol) -> int:
        move, link, length = self.move, self.link, self.length
        known = move[last].get(symbol)
        if known is not None:  # of an earlier sequence
            if length[known] == length[last] + 1:
                return known
            return self._cloned(last, symbol, known)
        state = len(move)
        move.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and symbol not in move[at]:
            move[at][symbol] = state
            at = link[at]
        if at >= 0:
            target = move[at][symbol]
            link[state] = target if length[target] == length[at] + 1 else self._cloned(at, symbol, target)
        return state

    def _cloned(self, at: int, symbol, target: int) -> int:
        """Split ``target`` so that a state of the length just after ``at`` exists."""
        move, link, length = self.move, self.link, self.length
        clone = len(move)
        move.append(dict(move[target]))
        link.append(link[target])
        length.append(length[at] + 1)
        link[target] = clone
        while at >= 0 and move[at].get(symbol) == target:
            move[at][symbol] = clone
            at = link[at]
        return clone

    def matches(self, sequence: list) -> list[int]:
        """At each symbol, the length of the longest substring that ends there."""
        move, link, length = self.move, self.link, self.length
        state, size, out = 0, 0, []
        for symbol in sequence:
            while state and symbol not in move[state]:
                state = link[state]
                size = length[state]
            target = move[state].get(symbol)
            if target is not None:
                state, size = target, size + 1
            out.append(size)
        return out


def windows_in_smaller(
    texts: list[bytes], docs: np.ndarray, group: np.ndarray, window: int
) -> list[np.ndarray]:
    """For each text: which of its windows also start in a text of its group with a smaller
    doc_id. Within a group, texts come by doc_id."""
    out: list[np.ndarray] = []
    automaton, shard, waiting, owner = SuffixAutomaton(), -1, [], None
    for text, doc, g in zip(texts, docs.tolist(), group.tolist()):
        if g != shard:
            automaton, shard, waiting, owner = SuffixAutomaton(), g, [], doc
        elif doc != owner:
            for earlier in waiting:  # texts of one document do not mark each other
                automaton.add(earlier)
            waiting, owner = [], doc
        words = text.split()
        longest = np.array(automaton.matches(words)[window - 1 :], np.int64)
        out.append(longest >= window)
        waiting.append(words)
    return out


def dedup_words(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, n_spans and kept (bytes) of every row of ``docs``.

    A word goes if ``window`` consecutive words that cover it also start in a document with a
    smaller doc_id; windows are judged on the input. ``kept`` joins the other words by one
    space. Null texts have no words; shorter texts stay. Rows with a null doc_id stay whole
    and are no one's source.
    """
    found = without_repeats(docs, True, window, min(GRAM, window), windows_in_smaller)
    return found.drop("_rest").withColumnRenamed("n", "n_words")


def dedup_words_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of ``docs``."""
    return dedup_words(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


ships_by_value(__name__)
