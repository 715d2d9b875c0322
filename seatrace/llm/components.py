"""Connected components of an undirected graph whose nodes are longs, or of one in a task."""

from __future__ import annotations

import itertools
import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatrace.llm.common import checkpointed, ships_by_value, stored
from seatrace.session import work_dir


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the smallest node reachable.

    Each round takes the smallest root among the neighbours and then follows the root's own
    root, so a path shortens by half. A hub's edges meet only in a join, which adaptive
    execution splits, and in a minimum that is taken before the shuffle. Null ends are
    ignored; an empty graph gives no rows. Each round's roots are stored in place of those two
    rounds before; the rows returned are read from the last ones.
    """
    known = edges.select("u", "v").dropna()
    both = checkpointed(known.union(known.select("v", "u")).distinct())
    labels = checkpointed(both.select(F.col("u").alias("node")).distinct().withColumn("root", F.col("node")))
    folder = f"{work_dir(edges.sparkSession)}/components-{uuid.uuid4().hex}"
    for number in itertools.count():
        around = (
            both.join(labels, F.col("v") == F.col("node"))
            .groupBy("u")
            .agg(F.min("root").alias("near"))
        )
        hooked = labels.join(around, F.col("node") == F.col("u")).select(
            "node", F.col("root").alias("before"), F.least("root", "near").alias("hook")
        )
        ahead = hooked.select(F.col("node").alias("at"), F.col("hook").alias("root"))
        moved = stored(
            hooked.join(ahead, F.col("hook") == F.col("at")).select("node", "root", "before"),
            f"{folder}/{number % 2}",
        )
        labels = moved.select("node", "root")
        if moved.filter("root != before").isEmpty():
            return labels


class Groups:
    """Connected groups of numbered members, joined pair by pair."""

    def __init__(self, members: int) -> None:
        self.label = np.arange(members)

    def join(self, u: np.ndarray, v: np.ndarray) -> None:
        while True:
            a, b = self.label[u], self.label[v]
            apart = a != b
            if not apart.any():
                return
            u, v = u[apart], v[apart]
            parent = np.arange(len(self.label))
            np.minimum.at(parent, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
            while (parent[parent] != parent).any():
                parent = parent[parent]
            self.label = parent[self.label]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """A binary tree over each group, so that no member has many edges."""
        order = np.argsort(self.label, kind="stable")
        label = self.label[order]
        opens = np.flatnonzero(np.concatenate(([True], label[1:] != label[:-1])))
        sizes = np.diff(np.append(opens, len(order)))
        begin = np.repeat(opens, sizes)
        rank = np.arange(len(order)) - begin
        child = rank > 0
        return order[child], order[(begin + (rank - 1) // 2)[child]]


ships_by_value(__name__)
