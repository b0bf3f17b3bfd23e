"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text: str | None, k: int) -> set[tuple[str, ...]]:
    w = WORD.findall(lower(text or ""))
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}


def components(rows: list[tuple[int, str | None]], k: int, percent: int) -> dict[int, int]:
    """Least id reachable, for rows with ids."""
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = sorted((top(i), top(j)))
                root[q] = p
    return {i: top(i) for i in root}


def removed(rows: list[tuple[int | None, str | None]], words: int = 13) -> list[list[str]]:
    """Kept words of each row."""
    seen: dict[tuple, int] = {}
    texts = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in texts:
        if i is not None:
            for p in range(len(w) - words + 1):
                k = tuple(w[p : p + words])
                seen[k] = min(i, seen.get(k, i))
    out = []
    for i, w in texts:
        gone = set()
        if i is not None:
            for p in range(len(w) - words + 1):
                if seen[tuple(w[p : p + words])] < i:
                    gone.update(range(p, p + words))
        out.append([x for n, x in enumerate(w) if n not in gone])
    return out


def statistics(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    t = text or ""
    w = WORD.findall(t)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    rep = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep)


def line_dedup(rows: list[tuple[int, str | None, str | None]], ratio: float, least: int) -> list[str | None]:
    """Texts of (id, host, text) rows without boilerplate."""
    key = lambda x: x.strip(" \t\r")
    pages, n = Counter(h for _, h, _ in rows), Counter()
    for _, h, t in rows:
        n.update({(h, key(x)) for x in (t or "").split("\n") if key(x)})
    bad = {k for k, c in n.items() if c >= least and c > ratio * pages[k[0]]}
    return [None if t is None else "\n".join(x for x in t.split("\n") if (h, key(x)) not in bad) for _, h, t in rows]


def segments(s: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments by their definition: take the best, then left and right of it."""

    def find(lo: int, hi: int) -> list[tuple[int, int, float]]:
        best = None
        for a in range(lo, hi):
            total = 0.0
            for b in range(a, hi):
                total += s[b]
                if total > 1e-12 and (best is None or total > best[2] + 1e-9):
                    best = (a, b + 1, total)
        return [] if best is None else find(lo, best[0]) + [best] + find(best[1], hi)

    return find(0, len(s))
