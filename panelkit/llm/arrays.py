"""Array helpers for work inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def spread(by: np.ndarray, first: np.ndarray, kids: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry of ``of`` all its children: (position of the entry, child)."""
    per = kids[of]
    rep = np.repeat(np.arange(len(of)), per)
    return rep, by[first[of][rep] + np.arange(len(rep)) - np.repeat(np.cumsum(per) - per, per)]


def runs(weights: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of about ``limit`` weight (one heavy element is a range of its own)."""
    total = np.concatenate([[0], np.cumsum(weights)])
    s = 0
    while s < len(weights):
        e = max(s + 1, int(np.searchsorted(total, total[s] + limit, "right")) - 1)
        yield s, min(e, len(weights))
        s = e


def forest(i, j, score, n_nodes: int) -> np.ndarray:
    """Indices of pairs that span the components of the pair graph, high scores first (Boruvka rounds)."""
    label, keep, alive = np.arange(n_nodes), [], np.argsort(-score, kind="stable")
    while len(alive):
        a, b = label[i[alive]], label[j[alive]]
        alive, a, b = alive[a != b], a[a != b], b[a != b]
        if not len(alive):
            break
        best = np.full(n_nodes, len(alive))
        pos = np.arange(len(alive))
        np.minimum.at(best, a, pos)
        np.minimum.at(best, b, pos)
        chosen = np.unique(best[best < len(alive)])
        keep.append(alive[chosen])
        # every component points over its best pair; the pair both chose is the root
        hook = np.arange(n_nodes)
        own = np.flatnonzero(best < len(alive))
        ca, cb = a[best[own]], b[best[own]]
        hook[own] = np.where(ca == own, cb, ca)
        two = (hook[hook[own]] == own) & (own < hook[own])
        hook[own[two]] = own[two]
        while True:
            nxt = hook[hook]
            if np.array_equal(nxt, hook):
                break
            hook = nxt
        label = hook[label]
    return np.concatenate(keep) if keep else np.zeros(0, np.int64)
