"""Burkhard-Keller trees over bit fingerprints, many trees at a time.

A child hangs under its parent by their integer Hamming distance. By the triangle inequality a
search at distance d from a node follows only the edges d - radius .. d + radius. All trees of a
task are built and searched level by level on arrays, so a task with a million two-node trees
costs no more per node than one with a thousand-node tree.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def hamming(words: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between rows ``a`` and rows ``b`` of ``words`` (n x w, uint64)."""
    return np.bitwise_count(words[a] ^ words[b]).sum(axis=1, dtype=np.int64)


@dataclass(frozen=True)
class Forest:
    words: np.ndarray
    edges: np.ndarray  # parent * width + distance, sorted
    children: np.ndarray  # node at the lower end of each edge
    width: int


def build(words: np.ndarray, tree: np.ndarray) -> tuple[Forest, np.ndarray]:
    """Trees of the rows with equal ``tree`` number; also the root of each row's tree.

    The first row of a tree is its root. On every level, the first of the rows that meet at
    one edge becomes the child there and the others go on below it.
    """
    width = words.shape[1] * 64 + 1
    _, first, of = np.unique(tree, return_index=True, return_inverse=True)
    roots = first[of]
    edge_keys, nodes = [], []
    waiting = np.flatnonzero(roots != np.arange(len(tree)))
    at = roots[waiting]
    while len(waiting):
        keys = at * width + hamming(words, waiting, at)
        taken, lead, of = np.unique(keys, return_index=True, return_inverse=True)
        child = waiting[lead]
        edge_keys.append(taken)
        nodes.append(child)
        below = child[of]
        on = below != waiting
        waiting, at = waiting[on], below[on]
    if not nodes:
        empty = np.empty(0, np.int64)
        return Forest(words, empty, empty, width), roots
    keys, children = np.concatenate(edge_keys), np.concatenate(nodes)
    order = np.argsort(keys, kind="stable")
    return Forest(words, keys[order], children[order], width), roots


def search(forest: Forest, queries: np.ndarray, roots: np.ndarray, radius: int):
    """Yields (query row, found row) arrays, level by level, for all rows within ``radius``."""
    node = roots
    while len(queries):
        distance = hamming(forest.words, queries, node)
        near = distance <= radius
        yield queries[near], node[near]
        base = node * forest.width
        low = np.searchsorted(forest.edges, base + np.maximum(distance - radius, 0), "left")
        high = np.searchsorted(forest.edges, base + np.minimum(distance + radius, forest.width - 1), "right")
        count = high - low
        total = int(count.sum())
        step = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
        queries = np.repeat(queries, count)
        node = forest.children[np.repeat(low, count) + step]


class Groups:
    """Union of rows into groups; every group is named by its smallest row."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.label[self.label]
                if np.array_equal(up, self.label):
                    break
                self.label = up


def forest_links(words: np.ndarray, tree: np.ndarray, asks: np.ndarray, is_node: np.ndarray, radius: int, pairs_at_once: int = 1 << 20) -> np.ndarray:
    """Group label per row: rows are linked when one asks, the other is a node, and both are near.

    Rows with ``is_node`` make up the trees, rows with ``asks`` search the tree of their own
    ``tree`` number. Only labels are kept, so memory follows the rows and not the links.
    """
    n = len(tree)
    groups = Groups(n)
    node_rows = np.flatnonzero(is_node)
    if not len(node_rows):
        return groups.label
    forest, own_root = build(words[node_rows], tree[node_rows])
    trees, first, size = np.unique(tree[node_rows], return_index=True, return_counts=True)
    query_rows = np.flatnonzero(asks)
    place = np.searchsorted(trees, tree[query_rows])
    place[place == len(trees)] = 0
    known = trees[place] == tree[query_rows]
    query_rows, place = query_rows[known], place[known]
    # Rows that are nodes keep their node number; other rows are appended for the search.
    number = np.full(n, -1)
    number[node_rows] = np.arange(len(node_rows))
    extra = np.flatnonzero((number < 0) & asks)
    number[extra] = len(node_rows) + np.arange(len(extra))
    row_of = np.concatenate([node_rows, extra])
    wide = Forest(words[row_of], forest.edges, forest.children, forest.width)
    root = own_root[first][place]
    budget = np.cumsum(size[place])
    start = 0
    while start < len(query_rows):
        done = budget[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(budget, done + pairs_at_once, "right")))
        for asked, found in search(wide, number[query_rows[start:stop]], root[start:stop], radius):
            groups.join(row_of[asked], row_of[found])
        start = stop
    return groups.label
