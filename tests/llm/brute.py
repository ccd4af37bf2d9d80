"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, size=4):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1)))


def jaccard_components(docs, percent=85):
    """{id: (set size, component)} of {id: text}."""
    sets = {i: shingles(t) for i, t in docs.items()}
    ids = sorted(i for i in sets if sets[i])
    links = []
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                links.append((a, b))
    comp = components(docs, links)
    return {i: (len(sets[i]), comp[i]) for i in docs}


def without_repeats(docs, window=50):
    """{id: (words, removed, kept text)} of {id: text}."""
    w = {i: words(t) for i, t in docs.items()}
    first = {}
    for i in sorted(w):
        for k in range(len(w[i]) - window + 1):
            first.setdefault(tuple(w[i][k:k + window]), i)
    out = {}
    for i, x in w.items():
        gone = set()
        for k in range(len(x) - window + 1):
            if first[tuple(x[k:k + window])] < i:
                gone.update(range(k, k + window))
        out[i] = (len(x), len(gone), " ".join(t for k, t in enumerate(x) if k not in gone))
    return out


KINDS = {
    "assign": (re.compile(r"((?:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                          re.I | re.A), lambda m: len(m[2]) >= 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
}


def base_secrets(text):
    out = []
    for rank, (kind, (pattern, ok)) in enumerate(KINDS.items()):
        out += [(m.start(), rank, kind, m.end()) for m in pattern.finditer(text or "") if ok(m)]
    return [(k, s, e) for s, _, k, e in sorted(out)]


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """{source: target}: share the excess again and again until no target is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    goal, out, free = share * sum(sizes.values()), {}, set(order)
    while free:
        level = (goal - sum(out.values())) / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > cap * sizes[s]}
        if not over:
            out.update((s, level * w[s]) for s in free)
            break
        out.update((s, cap * sizes[s]) for s in over)
        free -= over
    return out


def vector_links(vectors, threshold=0.95):
    """{id: (links, component)} of {id: vector or None}."""
    import numpy as np

    unit = {}
    for i, v in vectors.items():
        if v is None or not len(v) or any(x is None for x in v):
            continue
        a = np.array(v, float)
        if np.isfinite(a).all() and np.abs(a).max() > 0:
            unit[i] = a / np.linalg.norm(a)
    n, links = defaultdict(int), []
    for a in unit:
        for b in unit:
            if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                links.append((a, b))
                n[a] += 1
                n[b] += 1
    comp = components(vectors, links)
    return {i: (n[i], comp[i]) for i in vectors}
