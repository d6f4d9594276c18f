"""A trie of globally ordered sets, and the Jaccard links it finds.

Each set is a rising array of element numbers; what all sets of a group order the same way can be stored in one trie.
Runs without a branch are one edge. A probe goes down level by level: all sets below an edge share the overlap counted
on the way to it, and an edge is left when even the elements that remain, on the shorter side, can't reach the overlap
that the smallest set below it needs.
"""

from __future__ import annotations

import numpy as np


class Trie:
    """sets: rising arrays of codes below n_codes; sizes: the sets' full sizes (with elements that no other set has)."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray, n_codes: int):
        keys = [s.astype(">u4").tobytes() for s in sets]
        self.order = sorted(range(len(sets)), key=keys.__getitem__)
        self.rank = np.empty(len(sets), dtype=np.int64)
        self.rank[self.order] = np.arange(len(sets))
        ordered = [sets[i] for i in self.order]
        self.sizes = np.asarray(sizes, dtype=np.int64)[self.order]
        self.lengths = np.array([len(s) for s in ordered], dtype=np.int64)
        self.n_codes = n_codes
        common = np.zeros(len(sets) + 1, dtype=np.int64)  # of a set and the one before it
        for i in range(1, len(ordered)):
            a, b = ordered[i - 1], ordered[i]
            n = min(len(a), len(b))
            differ = a[:n] != b[:n]
            k = int(differ.argmax()) if n else 0
            common[i] = k if n and differ[k] else n
        nodes: list[tuple] = []  # lo, hi, end, last code, first token, tokens
        tokens: list[np.ndarray] = []
        self.levels: list[np.ndarray] = []
        level, held = [(0, len(ordered), 0, -1)], 0
        while level:
            below, now = [], []
            for lo, hi, depth, parent in level:
                end = int(common[lo + 1 : hi].min()) if hi - lo > 1 else len(ordered[lo])
                edge = ordered[lo][depth:end]
                at = len(nodes)
                nodes.append((lo, hi, end, int(edge[-1]) if len(edge) else -1, held, len(edge), parent))
                tokens.append(edge)
                held += len(edge)
                now.append(at)
                start = lo
                while start < hi and self.lengths[start] == end:
                    start += 1
                if start < hi:
                    cuts = [start, *(start + 1 + np.flatnonzero(common[start + 1 : hi] == end)).tolist(), hi]
                    below += [(a, b, end, at) for a, b in zip(cuts, cuts[1:], strict=False)]
            self.levels.append(np.array(now, dtype=np.int64))
            level = below
        self.lo, self.hi, self.end, self.last, self.first, self.count, self.parent = (np.array(x, dtype=np.int64) for x in zip(*nodes, strict=True))
        self.tokens = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
        self.least = np.array([self.sizes[a:b].min() for a, b in zip(self.lo, self.hi, strict=True)])
        self.most = np.array([self.sizes[a:b].max() for a, b in zip(self.lo, self.hi, strict=True)])
        self.longest = np.array([self.lengths[a:b].max() for a, b in zip(self.lo, self.hi, strict=True)])

    def probe(self, codes: np.ndarray, size: int, skip: np.ndarray, num: int, den: int) -> np.ndarray:
        """Numbers of the sets with intersection / union >= num / den, leaving out those for which `skip` holds."""
        member = np.zeros(self.n_codes + 1, dtype=bool)
        member[codes] = True
        skipped = np.r_[0, np.cumsum(skip[self.order])]
        overlap = np.zeros(len(self.lo), dtype=np.int64)
        alive = np.zeros(len(self.lo), dtype=bool)
        found = []
        for depth, nodes in enumerate(self.levels):
            if depth:
                nodes = nodes[alive[self.parent[nodes]]]
            # Jaccard bounds the sizes, and nothing is sought below an edge whose sets are all to be left out.
            nodes = nodes[(self.most[nodes] * den >= size * num) & (self.least[nodes] * num <= size * den) & (skipped[self.hi[nodes]] - skipped[self.lo[nodes]] < self.hi[nodes] - self.lo[nodes])]
            if not len(nodes):
                break
            count = self.count[nodes]
            ends = np.cumsum(count)
            at = np.arange(ends[-1]) + np.repeat(self.first[nodes] - (ends - count), count)
            hits = np.r_[0, np.cumsum(member[self.tokens[at]])]
            seen = hits[ends] - hits[ends - count] + (overlap[self.parent[nodes]] if depth else 0)
            overlap[nodes] = seen
            left = np.where(self.last[nodes] >= 0, len(codes) - np.searchsorted(codes, self.last[nodes], "right"), len(codes))
            most = seen + np.minimum(left, self.longest[nodes] - self.end[nodes])
            going = (den + num) * most >= num * (size + self.least[nodes])
            nodes, seen = nodes[going], seen[going]
            alive[nodes] = True
            for node, own in zip(nodes.tolist(), seen.tolist(), strict=True):
                i = int(self.lo[node])
                while i < self.hi[node] and self.lengths[i] == self.end[node]:
                    if (den + num) * own >= num * (size + self.sizes[i]):
                        found.append(i)
                    i += 1
        hit = np.array([self.order[i] for i in found], dtype=np.int64)
        return hit[~skip[hit]] if len(hit) else hit


def coded(keys: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Keys as numbers from 0 in the same order."""
    every = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
    return every, [np.searchsorted(every, k) for k in keys]


def self_links(keys: list[np.ndarray], sizes: list[int], num: int, den: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Components of the sets under links, and links that span them.

    A set whose component is the largest need not probe: the sets outside it do, against all that is not yet with them.
    """
    every, sets = coded(keys)
    sizes_ = np.asarray(sizes, dtype=np.int64)
    trie = Trie(sets, sizes_, len(every))
    comp = np.arange(len(sets))
    probed = np.zeros(len(sets), dtype=bool)
    links: list[tuple[int, int]] = []
    while True:
        largest = np.bincount(comp).argmax()
        open_ = np.flatnonzero(~probed & (comp != largest))
        if not len(open_):
            return comp, links
        x = int(open_[0])
        probed[x] = True
        for y in trie.probe(sets[x], int(sizes_[x]), comp == comp[x], num, den).tolist():
            if comp[y] != comp[x]:
                links.append((x, y))
                comp[comp == comp[y]] = comp[x]


def cross_links(keys: list[np.ndarray], sizes: list[int], comp: list, probes: list[tuple[np.ndarray, int, object]], num: int, den: int) -> list[tuple[int, int]]:
    """Links (probe, set) of the probes (keys, size, component) with sets of other components."""
    every, sets = coded(keys)
    trie = Trie(sets, np.asarray(sizes), len(every))
    number = {c: k for k, c in enumerate(dict.fromkeys(comp))}
    of = np.array([number[c] for c in comp])
    links = []
    for p, (own, size, c) in enumerate(probes):
        at = np.searchsorted(every, own)
        at = at[(at < len(every)) & (every[np.minimum(at, len(every) - 1)] == own)]
        links += [(p, y) for y in trie.probe(at, size, of == number.get(c, -1), num, den).tolist()]
    return links
