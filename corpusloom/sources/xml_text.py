"""XML documents as flat arrays in document order, and the running text of any part of them.

One pass over the parser's events numbers the elements and keeps for each its name, attributes, parent, the last element
below it and the range of text fragments inside it.  Everything else is a walk over such a range: whatever lies below
element i is i+1 .. last[i], and a subtree is left out by going on behind its last element.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Iterator
from xml.parsers import expat

# Subtrees whose text is no running text, elements that stand apart from their neighbours, subtrees with
# metadata of other articles, and the names of sections.
NO_RUNNING_TEXT = frozenset(
    [
        "back", "caption", "fig", "fig-group", "fn", "fn-group", "graphic", "inline-graphic", "media", "ref", "ref-list", "reference-list",
        "supplementary-material", "supplementary-material-group", "table", "table-wrap", "table-wrap-group",
    ]
)
APART = frozenset(["disp-quote", "list", "list-item", "p"])
FOREIGN_METADATA = frozenset(["article", "back", "ref", "ref-list", "related-article", "related-object", "sub-article", "supplementary-material"])
SECTION = frozenset(["sec", "abstract-sec", "abstract-section"])

_TEXT, _APART, _CROSS = 0, 1, 2
NONE = -1


def _plain_name(name: str) -> str:
    return name.rpartition("}")[2].lower()


class Document:
    """Elements 0, 1, ... in document order; NONE stands for an element that is not there."""

    def __init__(self) -> None:
        self.name: list[str] = []
        self.attrs: list[dict[str, str]] = []
        self.up: list[int] = []
        self.last: list[int] = []
        self.first_fragment: list[int] = []
        self.stop_fragment: list[int] = []
        self.fragments: list[str] = []
        self.sorts: list[int] = []

    def below(self, i: int, closed: Collection[str] = ()) -> Iterator[int]:
        """Elements below i; subtrees of closed names are left out whole."""
        j, end = i + 1, self.last[i] if i >= 0 else NONE
        while j <= end:
            if self.name[j] in closed:
                j = self.last[j] + 1
            else:
                yield j
                j += 1

    def named(self, i: int, names: Collection[str], closed: Collection[str] = FOREIGN_METADATA) -> Iterator[int]:
        return (j for j in self.below(i, closed) if self.name[j] in names)

    def children(self, i: int) -> Iterator[int]:
        j, end = i + 1, self.last[i] if i >= 0 else NONE
        while j <= end:
            yield j
            j = self.last[j] + 1

    def along(self, i: int, path: str) -> list[int]:
        """Elements reached by a path of child names."""
        level = [i] if i >= 0 else []
        for step in path.split("/"):
            level = [c for p in level for c in self.children(p) if self.name[c] == step]
        return level

    def at(self, i: int, path: str) -> int:
        return next(iter(self.along(i, path)), NONE)

    def attr(self, i: int, name: str) -> str:
        """Value of the attribute with that local name, stripped; "" if there is none."""
        return self.attrs[i].get(name, "").strip() if i >= 0 else ""

    def plain(self, i: int) -> str:
        """All text inside an element, blanks collapsed."""
        if i < 0:
            return ""
        span = range(self.first_fragment[i], self.stop_fragment[i])
        return " ".join("".join(self.fragments[k] for k in span if self.sorts[k] == _TEXT).split())

    def running(self, i: int, left_out: Collection[str] = NO_RUNNING_TEXT) -> str:
        """Text inside an element without the subtrees left out; blanks collapsed.

        Where two fragments meet without a blank, one is put between two letters, and around cross references also
        between letters and digits.
        """
        if i < 0:
            return ""
        kept = bytearray(b"\x01") * (self.stop_fragment[i] - self.first_fragment[i])
        base, j = self.first_fragment[i], i + 1
        while j <= self.last[i]:
            if self.name[j] in left_out:
                lo, hi = self.first_fragment[j] - base, self.stop_fragment[j] - base
                kept[lo:hi] = bytes(hi - lo)
                j = self.last[j]
            j += 1
        out: list[str] = []
        before, cross = "", False
        for k, keep in enumerate(kept, base):
            if not keep:
                continue
            if self.sorts[k] == _CROSS:
                cross = True
                continue
            text = self.fragments[k]
            if before and ((before.isalpha() and text[0].isalpha()) or (cross and before.isalnum() and text[0].isalnum())):
                out.append(" ")
            out.append(text)
            before, cross = text[-1], False
        return " ".join("".join(out).split())


def parse(content: bytes | str) -> Document:
    """ValueError if the content is not well-formed."""
    d = Document()
    open_: list[int] = []

    def put(text: str, sort: int) -> None:
        d.fragments.append(text)
        d.sorts.append(sort)

    def start(name: str, attrs: dict[str, str]) -> None:
        name = _plain_name(name)
        if name in APART:
            put(" ", _APART)
        if name == "xref":
            put("", _CROSS)
        d.name.append(name)
        # of attributes that differ in their name space only, the first counts
        d.attrs.append({_plain_name(k): v for k, v in reversed(attrs.items())})
        d.up.append(open_[-1] if open_ else NONE)
        d.last.append(NONE)
        d.first_fragment.append(len(d.fragments))
        d.stop_fragment.append(NONE)
        open_.append(len(d.name) - 1)

    def end(_: str) -> None:
        i = open_.pop()
        d.last[i], d.stop_fragment[i] = len(d.name) - 1, len(d.fragments)
        if d.name[i] == "xref":
            put("", _CROSS)
        if d.name[i] in APART:
            put(" ", _APART)

    def skipped(name: str, _: bool) -> None:
        raise ValueError(f"not well-formed XML: undefined entity {name}")

    reader = expat.ParserCreate(namespace_separator="}")
    reader.buffer_text = True
    reader.StartElementHandler, reader.EndElementHandler, reader.SkippedEntityHandler = start, end, skipped
    reader.CharacterDataHandler = lambda text: put(text, _TEXT)
    try:
        reader.Parse(content, True)
    except expat.ExpatError as e:
        raise ValueError(f"not well-formed XML: {e}") from e
    return d


def running_text(document: Document, i: int = 0) -> str:
    return document.running(i)


def distinct(values: Iterable[str]) -> list[str]:
    """Values that are not empty, in order of first occurrence."""
    return list(dict.fromkeys(filter(None, values)))
