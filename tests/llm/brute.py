"""Plain versions of what the operators compute, for small inputs."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np


def covered(texts: list[str | None], length: int = 200) -> list[tuple[int, int, int, str]]:
    """Per text: bytes, bytes removed, maximal removed runs, digest of the rest."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def jaccard_classes(rows: list[tuple[int, str | None]], words: int = 5, threshold: float = 0.8) -> dict[int, tuple[int, int, int]]:
    """``doc_id -> class id, links, copies`` by comparing all pairs."""
    groups = defaultdict(list)
    for i, text in rows:
        parts = (text or "").split()
        if parts:
            groups[frozenset(tuple(parts[k : k + words]) for k in range(max(1, len(parts) - words + 1)))].append(i)
    sets, n = list(groups), len(groups)
    links = [[j for j in range(n) if j != i and len(s & sets[j]) >= threshold * len(s | sets[j])] for i, s in enumerate(sets)]
    label = list(range(n))
    for _ in range(n):
        new = [min([label[i], *[label[j] for j in links[i]]]) for i in range(n)]
        if new == label:
            break
        label = new
    least = defaultdict(lambda: 1 << 62)
    for i, s in enumerate(sets):
        least[label[i]] = min(least[label[i]], *groups[s], 1 << 62)
    return {d: (least[label[i]], len(links[i]), len(groups[s])) for i, s in enumerate(sets) for d in groups[s]}
