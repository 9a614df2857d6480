"""Plain-Python versions of problems 1 to 3, written from the statement alone, one row at a time."""

from __future__ import annotations

import json
import re


def number(cell):
    m = re.search(r"[0-9]+", cell or "")
    return int(m.group()) if m else None


def packed_values(cell, field):
    if cell is None or not cell.strip():
        return []
    s = cell.strip()
    if s.startswith("[") and s.endswith("]"):
        depth = 0
        inside_quotes = False
        whole = True
        for i, ch in enumerate(s):
            if ch == '"':
                inside_quotes = not inside_quotes
            if not inside_quotes:
                if ch == "[":
                    depth += 1
                if ch == "]":
                    depth -= 1
                if depth == 0 and i < len(s) - 1:
                    whole = False
        if whole:
            s = s[1:-1]
    seps = "|;｜；\t\n\r" + ("+" if field == "query_categories" else "")

    def cut(separators):
        parts, cur, q = [], "", False
        for ch in s:
            if ch == '"':
                q = not q
            if ch in separators and not q:
                parts.append(cur)
                cur = ""
            else:
                cur += ch
        return [*parts, cur]

    parts = cut(seps)
    if len(parts) == 1:
        parts = cut(",")
    out = []
    for p in parts:
        p = p.strip()
        if len(p) >= 2 and p[0] == '"' and p[-1] == '"':
            p = p[1:-1].replace('""', '"').strip()
        if p:
            out.append(p)
    return out


def path_sections(paths):
    """[(section_no, parent_no)] of one article."""
    norm = [tuple(" ".join((e or "").split()).lower() for e in p or []) for p in paths]
    out = []
    for i, p in enumerate(norm):
        best = (0, 0)
        for j in range(i):
            if 0 < len(norm[j]) < len(p) and p[: len(norm[j])] == norm[j]:
                best = max(best, (len(norm[j]), j + 1))
        out.append((i + 1, best[1]))
    return out


def record_sections(record):
    try:
        rec = json.loads(record)
    except ValueError:
        return []
    out = []

    def entries(secs):
        if isinstance(secs, str):
            try:
                secs = json.loads(secs)
            except ValueError:
                return []
        return [secs] if isinstance(secs, dict) else secs if isinstance(secs, list) else []

    def visit(node, parent):
        if isinstance(node, dict):
            out.append((len(out) + 1, parent))
            me = len(out)
            for child in entries(node.get("secs")):
                visit(child, me)

    body = rec.get("article", {}).get("body") if isinstance(rec, dict) and isinstance(rec.get("article"), dict) else None
    if isinstance(body, dict):
        for s in entries(body.get("secs")):
            visit(s, 0)
    return out


def orphan_reason(t, targets):
    """targets: [(begin, end or None)] of the reference's number; None if one is in force at t."""
    if not targets:
        return "missing"
    if any(b <= t and (e is None or e > t) for b, e in targets):
        return None
    return "late" if all(b > t for b, _ in targets) else "deleted"
