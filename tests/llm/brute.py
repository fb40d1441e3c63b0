"""Plain single-process versions of the operators, for comparison."""

from __future__ import annotations

import hashlib
import re

SPACE = r"[^\x20\x09-\x0D]+"


def words(text: str | None) -> list[str]:
    return re.findall(SPACE, text or "")


def shingles(text: str | None, k: int) -> set[tuple[str, ...]]:
    own = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words(text)]
    if not own:
        return set()
    return {tuple(own[i:i + k]) for i in range(max(1, len(own) - k + 1))}


def jaccard_components(docs: list[tuple[int, str | None]], k: int, num: int, den: int) -> dict[int, tuple[int, int, int]]:
    sets = [(d, shingles(t, k)) for d, t in docs]
    parent = list(range(len(sets)))
    links = [0] * len(sets)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i + 1, len(sets)):
            b = sets[j][1]
            if a and b and den * len(a & b) >= num * len(a | b):
                links[i] += 1
                links[j] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least: dict[int, int] = {}
    for i, (d, _) in enumerate(sets):
        least[root(i)] = min(d, least.get(root(i), d))
    return {d: (len(s), least[root(i)], links[i]) for i, (d, s) in enumerate(sets)}


def substring_dedup(docs: list[tuple[int, str | None]], width: int) -> dict[int, tuple[int, int, str]]:
    seen, out = set(), {}
    for d, t in sorted(docs, key=lambda x: x[0]):
        own = words(t)
        gone = [False] * len(own)
        for i in range(len(own) - width + 1):
            w = tuple(own[i:i + width])
            if w in seen:
                gone[i:i + width] = [True] * width
            seen.add(w)
        kept = " ".join(w for w, g in zip(own, gone, strict=True) if not g)
        out[d] = len(own), sum(gone), hashlib.sha256(kept.encode()).hexdigest()
    return out
