"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib

import xxhash


def words(text):
    return (text or "").encode().split()


def kept(docs, width=50):
    """doc_id -> (n_words, n_removed, kept_sha256) by comparing every window."""
    first = {}
    for doc_id, text in docs:
        w = words(text)
        for i in range(len(w) - width + 1):
            key = tuple(w[i : i + width])
            if doc_id is not None:
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in docs:
        w = words(text)
        gone = set()
        for i in range(len(w) - width + 1):
            if doc_id is not None and first[tuple(w[i : i + width])] < doc_id:
                gone.update(range(i, i + width))
        left = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(left).hexdigest()))
    return out


def simhash(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(docs, radius=3):
    """(doc_id, fingerprint, smallest reachable doc_id), comparing all pairs of fingerprints."""
    prints = [simhash(t) for _, t in docs]
    distinct = sorted(set(prints))
    up = {p: p for p in distinct}

    def root(p):
        while up[p] != p:
            p = up[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= radius:
                up[root(a)] = root(b)
    least = {}
    for (doc_id, _), p in zip(docs, prints, strict=True):
        if doc_id is not None:
            least[root(p)] = min(least.get(root(p), doc_id), doc_id)
    return [(d, f"{p:016x}", least.get(root(p))) for (d, _), p in zip(docs, prints, strict=True)]
