"""JSON documents as flat arrays: one vectorised pass from bytes to tokens with parent links, without an object per value.

A block holds many documents in one byte buffer.  Quotes that are not escaped give the strings, the other brackets,
colons and commas the structure; depth is a running sum, and the container of a token is the last opening bracket one
level up, found by one sort over (document, level, place) and a running maximum.  So nesting of any depth costs no
recursion and no loop over levels.  The grammar is checked pairwise on neighbouring tokens; documents that break it
have no tokens left.  Members (`get`), list entries (`items`) and texts (`texts`) are looked up for whole arrays of
tokens at once, and their owners carry the keys.
"""

from __future__ import annotations

import json
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
_SCALAR = r"^(?:true|false|null|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)$"
STRING, SCALAR = ord('"'), ord("v")
OBJECT, ARRAY, OBJECT_END, ARRAY_END, COLON, COMMA = map(ord, "{[}]:,")


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_STRUCTURE, _BLANK, _ESCAPES, _HEX = _table(b"{}[]:,"), _table(b" \t\r\n"), _table(b'"\\/bfnrtu'), _table(b"0123456789abcdefABCDEF")


def slices(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """Pieces of a byte buffer as a binary array."""
    size = np.maximum(end - begin, 0)
    offsets = np.r_[0, np.cumsum(size)]
    at = np.repeat(begin - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at])])


class Documents:
    """Tokens of a block of JSON documents.

    kind, begin, end: bracket or sort of each token and its bytes (of strings without the quotes); doc: its document;
    up: its container token, -1 at the top; key: the token of a member's name, -1 elsewhere; value: tokens that begin
    a value.  valid: documents that are JSON; only those have tokens.
    """

    def __init__(self, texts: list[bytes]):
        self.data = data = np.frombuffer(b"".join(texts), np.uint8)
        n_docs = len(texts)
        size = np.fromiter(map(len, texts), np.int64, n_docs)
        self.first = first = np.r_[0, np.cumsum(size)]
        bad = np.zeros(n_docs, bool)
        doc_at = np.repeat(np.arange(n_docs, dtype=np.int32), size)

        slash = np.flatnonzero(data == 92)
        run_start = np.r_[True, (np.diff(slash) > 1) | (doc_at[slash[1:]] != doc_at[slash[:-1]])] if len(slash) else np.zeros(0, bool)
        run_first = slash[np.maximum.accumulate(np.where(run_start, np.arange(len(slash)), 0))] if len(slash) else slash
        escaping = slash[(slash - run_first) % 2 == 0]
        quote = data == STRING
        after = escaping + 1
        after = after[(after < len(data))]
        after = after[doc_at[after] == doc_at[after - 1]]
        quote[after[quote[after]]] = False
        q = np.flatnonzero(quote)
        base = np.searchsorted(q, first)
        place = np.arange(len(q)) - base[doc_at[q]]
        bad |= np.diff(base) % 2 == 1
        opens = place % 2 == 0
        before = np.cumsum(quote, dtype=np.int32) - base[:-1].astype(np.int32)[doc_at]
        inside = (before & 1).astype(bool)  # from the opening quote to before the closing one
        bad[doc_at[np.flatnonzero(inside & (data < 32))]] = True

        esc = escaping[inside[escaping]]
        nxt = data[np.minimum(esc + 1, len(data) - 1)] if len(esc) else esc
        if len(esc):
            bad[doc_at[esc[~_ESCAPES[nxt]]]] = True
            u = esc[nxt == ord("u")]
            if len(u):
                four = data[np.minimum(u[:, None] + np.arange(2, 6), len(data) - 1)]
                bad[doc_at[u[~_HEX[four].all(axis=1)]]] = True

        mark = np.flatnonzero(_STRUCTURE[data] & ~inside)
        other = ~inside & ~_STRUCTURE[data] & ~_BLANK[data] & (data != STRING)
        edge = np.diff(np.r_[False, other, False].astype(np.int8))
        edge_doc = np.flatnonzero(other[1:] & other[:-1] & (doc_at[1:] != doc_at[:-1])) + 1 if len(data) > 1 else np.zeros(0, np.int64)
        s_begin = np.sort(np.r_[np.flatnonzero(edge == 1), edge_doc])
        s_end = np.sort(np.r_[np.flatnonzero(edge == -1), edge_doc])
        if len(s_begin):
            coded = slices(data, s_begin, s_end).dictionary_encode()
            fine = pc.match_substring_regex(coded.dictionary, _SCALAR).to_numpy(zero_copy_only=False)
            bad[doc_at[s_begin[~fine[coded.indices.to_numpy(zero_copy_only=False)]]]] = True
        whole = ~bad[doc_at[q]]
        q_begin, q_end = q[whole & opens], q[whole & ~opens]

        begin = np.r_[mark, s_begin, q_begin]
        end = np.r_[mark + 1, s_end, q_end]
        kind = np.r_[data[mark], np.full(len(s_begin), SCALAR, np.uint8), np.full(len(q_begin), STRING, np.uint8)]
        keep = ~bad[doc_at[begin]]
        begin, end, kind = begin[keep], end[keep], kind[keep]
        order = np.argsort(begin, kind="stable")
        begin, end, kind = begin[order], end[order], kind[order]
        doc = doc_at[begin].astype(np.int64)

        open_, close = (kind == OBJECT) | (kind == ARRAY), (kind == OBJECT_END) | (kind == ARRAY_END)
        step = open_.astype(np.int64) - close
        depth = np.cumsum(step)  # after the token
        starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, np.int64)
        offset = np.zeros(n_docs, np.int64)
        offset[doc[starts]] = np.r_[0, depth][starts]
        depth -= offset[doc]
        bad[doc[depth < 0]] = True
        lasts = np.r_[starts[1:], len(doc)] - 1 if len(doc) else starts
        bad[doc[lasts[depth[lasts] != 0]]] = True
        # an opening bracket serves the level it opens; any other token asks for its own level
        level = np.where(close, depth + 1, np.where(open_, depth, depth))
        asks = np.where(open_, depth - 1, level)
        n = len(kind)
        opener = np.flatnonzero(open_)
        rows_doc = np.r_[doc[opener], doc]
        rows_level = np.r_[depth[opener], asks]
        rows_at = np.r_[opener * 2 + 1, np.arange(n) * 2]
        by = np.lexsort((rows_at, rows_level, rows_doc))
        serves = np.where(by < len(opener), np.arange(len(by)), -1)
        latest = np.maximum.accumulate(serves) if len(by) else serves
        got = np.where(latest >= 0, by[np.maximum(latest, 0)], -1)
        asking = by >= len(opener)
        who = by[asking] - len(opener)
        found = got[asking]
        up = np.full(n, -1, np.int64)
        if n:
            token = np.where(found >= 0, opener[np.maximum(found, 0)] if len(opener) else -1, -1)
            same = (token >= 0) & (doc[token] == doc[who]) & (depth[token] == asks[who]) & (asks[who] > 0)
            up[who] = np.where(same, token, -1)
        holder = np.where(up >= 0, kind[np.maximum(up, 0)], 0) if n else kind

        prev = np.r_[0, kind[:-1]].astype(np.uint8) if n else kind
        if n:
            prev[starts] = 0
        is_key = (kind == STRING) & (holder == OBJECT) & ((prev == OBJECT) | (prev == COMMA))
        prev_key = np.r_[False, is_key[:-1]] if n else is_key
        ends = ((prev == STRING) & ~prev_key) | (prev == SCALAR) | (prev == OBJECT_END) | (prev == ARRAY_END)
        value = ((kind == STRING) & ~is_key) | (kind == SCALAR) | open_
        right = np.zeros(n, bool)
        right |= value & (holder == 0) & (prev == 0)
        right |= value & (holder == OBJECT) & (prev == COLON)
        right |= value & (holder == ARRAY) & ((prev == ARRAY) | (prev == COMMA))
        right |= is_key | ((kind == COLON) & prev_key) | ((kind == COMMA) & (holder != 0) & ends)
        right |= (kind == OBJECT_END) & (holder == OBJECT) & ((prev == OBJECT) | ends)
        right |= (kind == ARRAY_END) & (holder == ARRAY) & ((prev == ARRAY) | ends)
        bad[doc[~right]] = True
        has = np.zeros(n_docs, bool)
        has[doc] = True
        self.valid = has & ~bad

        alive = self.valid[doc]
        new = np.cumsum(alive) - 1
        self.kind, self.begin, self.end, self.doc, self.value = kind[alive], begin[alive], end[alive], doc[alive], value[alive]
        self.begin = self.begin + (self.kind == STRING)
        up = up[alive]
        self.up = np.where(up >= 0, new[np.maximum(up, 0)], -1) if len(up) else up
        holder = holder[alive]
        self.key = np.where(self.value & (holder == OBJECT), np.arange(len(self.kind)) - 2, -1)
        self.escaped = esc

    @cached_property
    def roots(self) -> np.ndarray:
        """The top token of every document, -1 where it is not valid."""
        out = np.full(len(self.valid), -1, np.int64)
        top = np.flatnonzero(self.value & (self.up < 0))
        out[self.doc[top]] = top
        return out

    def _has_escape(self, tokens: np.ndarray) -> np.ndarray:
        lo = np.searchsorted(self.escaped, self.begin[tokens])
        return (lo < len(self.escaped)) & (self.escaped[np.minimum(lo, len(self.escaped) - 1)] < self.end[tokens]) if len(self.escaped) else np.zeros(len(tokens), bool)

    def strings(self, tokens: np.ndarray) -> list[str]:
        """Texts of string and scalar tokens."""
        out = [b.decode("utf-8", "replace") for b in slices(self.data, self.begin[tokens], self.end[tokens]).to_pylist()]
        for i in np.flatnonzero(self._has_escape(tokens) & (self.kind[tokens] == STRING)):
            out[i] = json.loads(f'"{out[i]}"', strict=False).encode("utf-8", "surrogatepass").decode("utf-8", "replace")
        return out

    def members(self, name: str) -> tuple[np.ndarray, np.ndarray]:
        """(object token, value token) of all members of that name, sorted by object; of repeated members the last."""
        have = np.flatnonzero(self.key >= 0)
        k = self.key[have]
        want = np.frombuffer(name.encode(), np.uint8)
        hit = self.end[k] - self.begin[k] == len(want)
        near = np.flatnonzero(hit)
        if len(near):
            hit[near] = (self.data[self.begin[k[near]][:, None] + np.arange(len(want))] == want).all(axis=1)
        odd = np.flatnonzero(self._has_escape(k))
        if len(odd):
            hit[odd] = [t == name for t in self.strings(k[odd])]
        token = have[hit]
        owner = self.up[token]
        order = np.lexsort((token, owner))
        owner, token = owner[order], token[order]
        last = np.r_[owner[1:] != owner[:-1], True] if len(owner) else np.zeros(0, bool)
        return owner[last], token[last]

    def get(self, objects: np.ndarray, name: str) -> np.ndarray:
        """Value token of that member of each object; -1 where there is none or the token is no object."""
        owner, token = self.members(name)
        if not len(owner):
            return np.full(len(objects), -1, np.int64)
        at = np.minimum(np.searchsorted(owner, objects), len(owner) - 1)
        return np.where((objects >= 0) & (owner[at] == objects), token[at], -1)

    @cached_property
    def _entries(self) -> tuple[np.ndarray, np.ndarray]:
        inner = np.flatnonzero(self.value & (self.up >= 0))
        inner = inner[self.kind[self.up[inner]] == ARRAY]
        order = np.lexsort((inner, self.up[inner]))
        return self.up[inner][order], inner[order]

    def items(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row in `tokens`, entry token): entries of an array, else the value itself; -1 and null have none."""
        up, entry = self._entries
        rows = np.arange(len(tokens))
        there = tokens >= 0
        arr = there.copy()
        arr[there] = self.kind[tokens[there]] == ARRAY
        lo, hi = np.searchsorted(up, tokens[arr]), np.searchsorted(up, tokens[arr], side="right")
        n = hi - lo
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        single = there & ~arr
        if single.any():
            t = tokens[single]
            single[single] = (self.kind[t] != SCALAR) | (self.data[self.begin[t]] != ord("n"))
        row = np.r_[np.repeat(rows[arr], n), rows[single]]
        token = np.r_[entry[at], tokens[single]]
        order = np.argsort(row, kind="stable")
        return row[order], token[order]

    def texts(self, tokens: np.ndarray, prefer: tuple[str, ...] = ("text", "value", "p", "title", "caption")) -> list[str | None]:
        """Texts of values of uneven shape: strings and numbers as they stand, the texts of a list joined by line breaks,
        of an object the first of the preferred members that has a text; null for true, false, null and anything else."""
        out: list[str | None] = [None] * len(tokens)
        if not len(tokens):
            return out
        there = np.flatnonzero(tokens >= 0)
        kind = self.kind[tokens[there]]
        plain = there[(kind == STRING) | (kind == SCALAR)]
        for i, t, k in zip(plain, self.strings(tokens[plain]), self.kind[tokens[plain]]):
            if k == STRING or t[0] not in "tfn":
                out[i] = t
        nested = there[(kind == OBJECT) | (kind == ARRAY)]
        if len(nested):
            made = self._nested_texts(tokens[nested], prefer)
            for i in nested:
                out[i] = made[int(tokens[i])]
        return out

    def _nested_texts(self, tokens: np.ndarray, prefer: tuple[str, ...]) -> dict[int, str | None]:
        """Texts of brackets, innermost first: whatever lies under a bracket comes behind it."""
        cover = np.zeros(len(self.kind) + 1, np.int64)
        opened = np.isin(self.kind, (OBJECT, ARRAY))
        closer = np.full(len(self.kind), -1, np.int64)
        shut = np.flatnonzero(np.isin(self.kind, (OBJECT_END, ARRAY_END)))
        closer[self.up[shut]] = shut
        np.add.at(cover, tokens, 1)
        np.add.at(cover, closer[tokens], -1)
        under = np.cumsum(cover[:-1]) > 0
        brackets = np.flatnonzero(opened & under)
        inner = np.flatnonzero(self.value & (self.up >= 0) & under)
        plain = inner[~opened[inner]]
        known: dict[int, str | None] = {}
        for i, t, k in zip(plain.tolist(), self.strings(plain), self.kind[plain]):
            known[i] = t if k == STRING or t[0] not in "tfn" else None
        lists: dict[int, list[int]] = {}
        for i in inner[self.kind[self.up[inner]] == ARRAY].tolist():
            lists.setdefault(int(self.up[i]), []).append(i)
        named = [dict(zip(brackets.tolist(), self.get(brackets, p).tolist())) for p in prefer]
        for b in brackets[::-1].tolist():
            if self.kind[b] == ARRAY:
                known[b] = "\n".join(t for i in lists.get(b, ()) if (t := known[i])) or None
            else:
                known[b] = next((t for m in named if m[b] >= 0 and (t := known[m[b]]) is not None), None)
        return known


def blocks(texts: list[bytes], size: int = BLOCK_BYTES):
    """(begin, end) of runs of documents of about `size` bytes; a longer one is a block of its own."""
    begin = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > size:
            yield begin, i
            begin, total = i, 0
        total += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def spliced(texts: list[bytes], begins: list[list[int]], ends: list[list[int]], news: list[list[bytes]]) -> list[bytes]:
    """Documents with byte ranges replaced."""
    out = []
    for text, b, e, new in zip(texts, begins, ends, news):
        parts, at = [], 0
        for lo, hi, t in zip(b, e, new):
            parts += [text[at:lo], t]
            at = hi
        out.append(b"".join([*parts, text[at:]]))
    return out
