"""Plain versions of the operators, for small fixtures."""

import collections
import hashlib
import re

import numpy as np


def word_list(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def repeats(texts, length=400):
    """(n_bytes, n_removed, n_spans, kept_sha256) of each text."""
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[p : p + length] for b in data for p in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 2, dtype=np.int8)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[1 + p : 1 + p + length] = 1
        kept = bytes(x for x, g in zip(b, gone[1:]) if not g)
        out.append((len(b), int(gone.sum()), int((np.diff(gone) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def groups(n, links):
    """Root of each of n nodes, any one of its component."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    return [find(i) for i in range(n)]


def shingle_set(text):
    words = word_list((text or "").encode().lower().decode())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near_groups(rows):
    """[(doc_id, n_shingles, component_id)] of rows (doc_id, text)."""
    sets = [shingle_set(t) for _, t in rows]
    holders = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    links = []
    for i, s in enumerate(sets):
        common = collections.Counter(j for x in s for j in holders[x] if j > i)
        links += [(i, j) for j, c in common.items() if 100 * c >= 75 * (len(s) + len(sets[j]) - c)]
    root = groups(len(rows), links)
    low = {}
    for r, (d, _) in zip(root, rows):
        if d is not None:
            low[r] = min(low.get(r, d), d)
    return [(d, len(s), low.get(r)) for r, s, (d, _) in zip(root, sets, rows)]


def base_spans(text):
    text, found = text or "", []
    for kind, pattern, group, least in (
        ("assign", r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
        ("access", r"AKIA[A-Z0-9]+", 0, 20),
        ("hex", r"[0-9a-f]+", 0, 24),
    ):
        found += [(m.start(), m.end(), kind) for m in re.finditer(pattern, text) if len(m.group(group)) >= least]
    order = ("assign", "access", "hex")
    return sorted(found, key=lambda s: (s[0], order.index(s[2])))


def targets(sizes, weights=(5, 2, 1), epochs=3):
    """Target of each source: the excess of sources above `epochs` times their size goes to the others, until none is."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    names = [s for s in names if sizes[s]]
    out, free, left = {s: 0.0 for s in sizes}, set(names), sum(sizes.values())
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > epochs * sizes[s]]
        if not over:
            return out | share
        for s in over:
            out[s] = float(epochs * sizes[s])
            left -= epochs * sizes[s]
        free -= set(over)
    return out
