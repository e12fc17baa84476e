"""Each operator's result by the shortest Python that says what it is, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

Rows = list[tuple]


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def windows(items, width: int) -> list:
    return [tuple(items[i : i + width]) for i in range(len(items) - width + 1)]


def cover(n: int, starts, width: int) -> list[bool]:
    out = [False] * n
    for i in starts:
        out[i : i + width] = [True] * width
    return out


def substrings(docs: Rows, width: int = 35) -> Rows:
    counts = Counter(w for _, t in docs for w in windows(words(t), width))
    out = []
    for doc_id, text in docs:
        own = words(text)
        gone = cover(len(own), [i for i, w in enumerate(windows(own, width)) if counts[w] > 1], width)
        left = [w for w, g in zip(own, gone) if not g]
        out.append((doc_id, len(own), sum(gone), sha(" ".join(left).encode())))
    return out


def suffixes(docs: Rows, width: int = 200) -> Rows:
    raw = [(d, (t or "").encode()) for d, t in docs]
    counts = Counter(x[i : i + width] for _, x in raw for i in range(len(x) - width + 1))
    out = []
    for doc_id, x in raw:
        gone = cover(len(x), [i for i in range(len(x) - width + 1) if counts[x[i : i + width]] > 1], width)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(x), sum(gone), spans, sha(bytes(b for b, g in zip(x, gone) if not g))))
    return out


def base_rules(docs: Rows) -> Rows:
    out = []
    for doc_id, text in docs:
        text = text or ""
        own, seen, repeated_lines = words(text), set(), 0
        for line in text.split("\n"):
            if words(line):
                repeated_lines += line in seen
                seen.add(line)
        counts = Counter(windows(own, 5))
        n = sum(cover(len(own), [i for i, w in enumerate(windows(own, 5)) if counts[w] > 1], 5))
        symbols = sum(c in "#*$%&|<>" for c in text)
        failed = len(own) < 10 or 100 * n > 20 * len(own)
        out.append((doc_id, len(own), sum(map(len, own)), symbols, repeated_lines, n, failed))
    return out


def contamination(docs: Rows, items: Rows, width: int = 10) -> Rows:
    def split(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))

    holders = defaultdict(set)
    for item, text in items:
        own = split(text)
        for w in windows(own, min(width, len(own))) if own else []:
            holders[w].add(str(item))
    out = []
    for doc_id, text in docs:
        own, hit, found = split(text), set(), set()
        for size in {len(w) for w in holders}:
            for i, w in enumerate(windows(own, size)):
                if w in holders:
                    hit.update(range(i, i + size))
                    found |= holders[w]
        out.append((doc_id, len(own), len(hit), sorted(found)))
    return out


def near_duplicates(docs: Rows, width: int = 3, percent: int = 85) -> Rows:
    sets = []
    for _, text in docs:
        own = words(lower(text))
        sets.append(set(windows(own, min(width, len(own)))) if own else set())
    root = list(range(len(docs)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (doc_id, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [(d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(docs)]


def secret_spans(text: str | None) -> list[tuple[int, int, str, int]]:
    """(start, kind's place, kind, end) of the base kinds, leftmost and without overlap per kind."""
    assign = r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?i:passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    kinds = [("assign", re.compile(assign, re.A), 2, 12), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18)]
    kinds.append(("hex", re.compile("[0-9a-f]+"), 0, 16))
    return sorted(
        (m.start(), k, name, m.end())
        for k, (name, pattern, group, least) in enumerate(kinds)
        for m in pattern.finditer(text or "")
        if len(m[group]) >= least
    )


def gram_losses(docs: list[tuple[str | None, bool]], order: int = 4, strength: float = 4.0):
    """A function from bytes to (target loss, background loss) sums."""
    counts = [[Counter(), Counter()] for _ in range(order + 1)]
    for text, target in docs:
        raw = (text or "").encode()
        padded = bytes(order - 1) + raw
        for i in range(len(raw)):
            gram = padded[i : i + order]
            for n in range(1, order + 1):
                for k in (0, 1) if target else (1,):
                    counts[n][k][gram[order - n :]] += 1
    totals = [[Counter(), Counter()] for _ in range(order + 1)]
    for n in range(1, order + 1):
        for k in (0, 1):
            for gram, c in counts[n][k].items():
                totals[n][k][gram[:-1]] += c

    sizes = [sum(counts[order][k].values()) for k in (0, 1)]
    weights = [min(sizes) / size if min(sizes) else 1.0 for size in sizes]

    def probability(gram: bytes, k: int) -> float:
        p = 1 / 256
        for n in range(1, order + 1):
            end = gram[order - n :]
            p = (weights[k] * counts[n][k][end] + strength * p) / (weights[k] * totals[n][k][end[:-1]] + strength)
        return p

    def loss(text: str | None) -> tuple[float, float]:
        import math

        raw = (text or "").encode()
        padded = bytes(order - 1) + raw
        sums = [0.0, 0.0]
        for i in range(len(raw)):
            for k in (0, 1):
                sums[k] -= math.log(probability(padded[i : i + order], k))
        return sums[0], sums[1]

    return loss


def runs(own: list, exponent: int, length: int) -> list[tuple[int, int, int]]:
    """(start, length, period) by the definition: least period, no neighbour extends it."""
    found = []
    for period in range(1, len(own) // exponent + 1):
        start = 0
        while start + period < len(own):
            stop = start
            while stop + period < len(own) and own[stop] == own[stop + period]:
                stop += 1
            size = stop - start + period
            if size >= max(length, exponent * period):
                part = own[start : start + size]
                if not any(part[p:] == part[:-p] for p in range(1, period)):
                    found.append((start, size, period))
            start = stop + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def greatest_run(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    from fractions import Fraction

    return min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def collapsed(own: list[str], found: list[tuple[int, int, int]]) -> list[str]:
    return [w for i, w in enumerate(own) if not any(s + p <= i < s + n for s, n, p in found)]
