"""Plain versions of what the operators must return, on small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import xxhash

_GAP = re.compile(r"[\x20\x09-\x0d]+")


def words(text: str | None) -> list[str]:
    return [w for w in _GAP.split(text or "") if w]


class Union:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, a):
        while self.up[a] != a:
            self.up[a] = self.up[self.up[a]]
            a = self.up[a]
        return a

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def near_duplicates(docs: dict[int, str | None], k: int, share: tuple[int, int]) -> dict[int, tuple[int, int]]:
    """id: (shingles, component), every pair compared."""
    sets = {}
    for i, text in docs.items():
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    u, ids = Union(docs), sorted(docs)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            n = len(sets[a] & sets[b])
            if n and share[1] * n >= share[0] * (len(sets[a]) + len(sets[b]) - n):
                u.join(a, b)
    return {i: (len(sets[i]), u.find(i)) for i in ids}


def without_repeats(texts: list[str | None], window: int) -> list[tuple[int, int, list[str]]]:
    """(words, removed, kept words) of each text."""
    split = [words(t) for t in texts]
    seen = Counter(tuple(w[j : j + window]) for w in split for j in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if seen[tuple(w[j : j + window])] > 1:
                gone[j : j + window] = [True] * window
        out.append((len(w), sum(gone), [x for x, g in zip(w, gone) if not g]))
    return out


def similar_vectors(rows: list[tuple], threshold: float) -> list[tuple[int, int]]:
    """(links, component) of each (id, vector, label), every pair compared."""

    def norm(v):
        if v is None or any(c is None or not math.isfinite(c) for c in v) or not any(v):
            return None
        return math.sqrt(sum(c * c for c in v))

    u, links = Union([r[0] for r in rows]), [0] * len(rows)
    for x, (a, v, la) in enumerate(rows):
        for y in range(x):
            b, w, lb = rows[y]
            n, m = norm(v), norm(w)
            if la is not None and la == lb and n and m and len(v) == len(w):
                if sum(p * q for p, q in zip(v, w)) >= threshold * n * m:
                    links[x] += 1
                    links[y] += 1
                    u.join(a, b)
    return [(n, u.find(r[0])) for n, r in zip(links, rows)]


def _xx(*parts) -> int:
    """Spark's xxhash64 of strings and longs: each value's hash seeds the next."""
    seed = 42
    for p in parts:
        data = p.encode() if isinstance(p, str) else p.to_bytes(8, "little", signed=True)
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def units(text: str | None) -> list[str]:
    """Words in pieces of four code points."""
    return [w[i : i + 4] for w in words(text) for i in range(0, len(w), 4)]


def anchors(text: str | None, k: int = 5, s: int = 2) -> list[tuple[int, int]]:
    """(position, hash) of the closed syncmers of a text's units."""
    h = [_xx(w) for w in units(text)]
    if len(h) < k:
        return [(0, _xx(*h))] if h else []
    inner = [_xx(*h[i : i + s]) for i in range(len(h) - s + 1)]
    out = []
    for i in range(len(h) - k + 1):
        own = inner[i : i + k - s + 1]
        if min(own) in (own[0], own[-1]):
            out.append((i, _xx(*h[i : i + k])))
    return out


def neighbours(docs: list[tuple[int, str | None]]) -> dict[int, tuple]:
    """id: what ``op9`` returns, for unique ids."""
    rows = sorted(docs, key=lambda r: -r[0])
    out = {}

    def like(a, b):
        x, y = {h for _, h in a}, {h for _, h in b}
        return 1.0 if not x and not y else len(x & y) / max(len(x), len(y))

    for i, (key, text) in enumerate(rows):
        own, other = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + other[:half]
        a, b, c = anchors(own), anchors(edited), anchors(other)
        shown = [" ".join(f"{p}:{h % (1 << 64):X}" for p, h in x) for x in (a, b)]
        out[key] = (len(own), hashlib.sha256(edited.encode()).hexdigest(), *shown, like(a, b), like(a, c))
    return out
