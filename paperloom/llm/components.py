"""Connected components by alternating star rewriting, and their in-task counterpart on arrays."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.session import durable


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct nodes of the links (a, b) and the smallest node that each is connected with."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = places[: len(a)], places[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        while True:
            jumped = root[root]
            if np.array_equal(jumped, root):
                break
            root = jumped
        if np.array_equal(before, root):
            return nodes, nodes[root]


def connected(links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link; `links` has the columns a and b of type long.

    Each round links a node's larger neighbours to its smallest one (large star) and then its smaller ones likewise
    (small star), until every node is linked to its component's smallest node. Minima are combined before the shuffle and
    nothing is collected per node, and the minima are joined by a column that no shuffle has dealt out yet, so that the
    rows of a node with very many links can be split. Rounds grow with the logarithm of the
    number of links; each is checkpointed.
    """
    down = lambda frame: frame.where("a <> b").selectExpr("greatest(a, b) as a", "least(a, b) as b").distinct()
    edges = durable(down(links))
    state = None
    while True:
        # A sum of hashes of distinct rows: the same sum again means that nothing has changed.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            return edges.selectExpr("a as node", "b as root")
        state = now
        both = edges.unionByName(edges.selectExpr("b as a", "a as b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a ^ 1L as k", "least(a, m) as m")
        large = down(both.where("b > a").selectExpr("a ^ 1L as k", "b").join(least, "k").selectExpr("b as a", "m as b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.selectExpr("a ^ 1L as k", "b").join(least.selectExpr("a ^ 1L as k", "m"), "k")
        small = small.selectExpr("b as a", "m as b").unionByName(least.selectExpr("a", "m as b"))
        edges = durable(down(small))
