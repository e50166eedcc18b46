"""Closed-syncmer sketches in plain Python."""

from __future__ import annotations

import re
import struct

import xxhash


def _long(value: int, seed: int) -> int:
    return xxhash.xxh64_intdigest(struct.pack("<q", value), seed & (1 << 64) - 1)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _hash(values) -> int:
    seed = 42
    for v in values:
        seed = _long(v, seed)
    return _signed(seed)


def sketch(text: str, kmer: int = 3) -> list[tuple[int, int]]:
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    h = [_signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in words]
    if not h:
        return []
    if len(h) < kmer:
        return [(_hash(h), 1)]
    found = {}
    for i in range(len(h) - kmer + 1):
        k = h[i : i + kmer]
        if min(k[0], k[-1]) <= min(k[1:-1]):
            found.setdefault(_hash(k), i + 1)
    return sorted(found.items())


def written(marks) -> str:
    return " ".join(f"{h & (1 << 64) - 1:016x}@{p}" for h, p in marks)


def likeness(a, b, tolerance) -> float:
    a, b = dict(a), dict(b)
    both = {*a, *b}
    if not both:
        return 1.0
    return sum(h in a and h in b and abs(a[h] - b[h]) <= tolerance for h in both) / len(both)


def rows(docs):
    """(doc_id, n_chars, edited text, fingerprint, edited fingerprint, near_edited, near_next) of (doc_id, text)."""
    order = sorted(docs, key=lambda d: -d[0])
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        own, changed, following = sketch(text), sketch(edited), sketch(after)
        tolerance = max(16.0, len(text) / 6 * 0.125)
        out.append(
            (doc_id, len(text), edited, written(own), written(changed), likeness(own, changed, tolerance), likeness(own, following, tolerance))
        )
    return out
