"""Plain-Python versions of problems 4 to 8, written from the statement alone, one row at a time."""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict

from tests.brute import number

ALNUM = re.compile(r"[^\W_]+")


def shingles(text, width=3):
    w = ALNUM.findall((text or "").lower())
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def similar_pairs(rows, limit=0.6, width=3):
    """rows: [(id, text)]."""
    sets = {i: s for i, t in rows if (s := shingles(t, width))}
    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    common = defaultdict(int)
    for ids in where.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1 :]:
                common[min(a, b), max(a, b)] += 1
    return {(a, b) for (a, b), n in common.items() if n / (len(sets[a]) + len(sets[b]) - n) >= limit}


def oversized_chars(text, limit=1000):
    return text is not None and len(text.strip(" \t\r\n")) > limit


def oversized_tokens(text, limit=98):
    return text is not None and len(re.findall(r"[^ \t\r\n]+", text)) > limit


def best_items(rows, ties, n=5):
    """rows: [(run, disease cell, pmid cell, rank cell)], ties: [(pmid cell, best_rank cell)]."""
    low = {}
    for p, r in ties:
        p, r = number(p), number(r)
        if p is not None and r is not None:
            low[p] = min(low.get(p, r), r)
    groups = defaultdict(dict)
    for run, d, p, r in rows:
        d, p, r = number(d), number(p), number(r)
        if None not in (d, p, r):
            g = groups[run, d]
            g[p] = min(g.get(p, r), r)
    out = set()
    for (run, d), g in groups.items():
        for p in sorted(g, key=lambda p: (g[p], low.get(p, float("inf")), p))[:n]:
            out.add((run, d, p))
    return out


INVISIBLE = dict.fromkeys([0xAD, 0x180E, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])


def latin_words(text):
    t = unicodedata.normalize("NFKD", text or "")
    t = "".join(c for c in t if unicodedata.category(c)[0] != "M").translate(INVISIBLE).lower()
    return re.findall(r"[a-z0-9]+", t)


def leaks(docs, items, n=12):
    """{(doc_id, item_id)}."""
    index = defaultdict(set)
    sizes = set()
    for i, t in items:
        w = latin_words(t)
        k = min(n, len(w))
        if k:
            sizes.add(k)
            for j in range(len(w) - k + 1):
                index[tuple(w[j : j + k])].add(i)
    out = set()
    for d, t in docs:
        w = latin_words(t)
        for k in sizes:
            for j in range(len(w) - k + 1):
                for i in index.get(tuple(w[j : j + k]), ()):
                    out.add((d, i))
    return out
