"""Splitting oversized texts at natural boundaries: structure-tree packing.

A text is parsed into a tree: sections by heading level, in them paragraphs, fenced code, tables, HTML elements as they
nest and list items with the lists below them; a paragraph's parts are lines, sentences, words and tokens. Sizes are summed
from the leaves up. A node within the limit stays whole and merges with its siblings while they fit together; only
a node over the limit is descended into. Sizes are tokens of a public tokenizer, and every finished piece is counted exactly.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame

from verbarium.llm import tokens
from verbarium.operators.lookup import spread
from verbarium.shipping import ship

_HEADING = re.compile(r"(#{1,6})[ \t]")
_FENCE = re.compile(r"[ \t]{0,3}(`{3,}|~{3,})")
_ITEM = re.compile(r"([ \t]*)(?:[-*+•]|\d+[.)])[ \t]")
_ROW = re.compile(r"[ \t]*\|")
_BLANK = re.compile(r"[ \t\r]*\n?$")
_TAG = re.compile(r"<(/?)(article|aside|blockquote|body|div|dl|footer|h[1-6]|header|html|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul)\b[^<>]*?(/?)>", re.I)
_OPENS = re.compile(r"[ \t]*<(?:article|aside|blockquote|body|div|dl|footer|h[1-6]|header|html|li|main|nav|ol|p|pre|section|table|ul)\b[^<>]*>", re.I)
#: What a leaf is cut at, coarse to fine: the ends of these matches.
_LINES = re.compile(r"(?<=\n)(?=[^\n])")
_GAPS = re.compile(r"\n(?:[ \t\r]*\n)+")
_SENTENCES = re.compile(r"(?<=[.!?…。！？])[\"'”’)\]]*[ \t]+(?=\S)")
_CELLS = re.compile(r"(?<=\|)(?=[^\n|])")
_WORDS = re.compile(r"(?<=[ \t])(?=[^ \t])")
_PARTS = {"text": [_GAPS, _LINES, _SENTENCES, _WORDS], "code": [_GAPS, _LINES, _WORDS], "table": [_LINES, _CELLS, _WORDS]}
#: Where every scan of the tokenizer's pattern has a boundary: before a space between a letter or digit and a letter.
_SYNC = re.compile(r"(?<=[^\W_]) (?=[^\W\d_])")


@dataclass
class Node:
    """The stretch [a, b) of a text; children tile it. A leaf's kind says what it may be cut at."""

    a: int
    b: int
    kind: str = "text"
    children: list[Node] = field(default_factory=list)


def _html(text: str, a: int, b: int) -> Node | None:
    """The element that opens at ``a`` and closes by ``b``, with the elements inside; None if it does not close."""
    stack: list[tuple[str, Node]] = []
    for m in _TAG.finditer(text, a, b):
        closes, name, alone = m[1], m[2].lower(), m[3]
        if alone:
            continue
        if not closes:
            if not stack and m.start() > a and text[a : m.start()].strip():
                return None
            stack.append((name, Node(m.start() if stack else a, m.end(), "code" if name == "pre" else "text")))
            continue
        if name not in [n for n, _ in stack]:
            continue
        while stack:  # what is left open inside ends here too
            own, node = stack.pop()
            node.b = m.end()
            if node.children:
                node.children = _tiled(node.a, node.b, node.children)
            if stack:
                stack[-1][1].children.append(node)
            if own == name:
                break
        if not stack:
            return node
    return None


def _tiled(a: int, b: int, nodes: list[Node]) -> list[Node]:
    """``nodes`` with leaves for the stretches between them."""
    out, at = [], a
    for n in nodes:
        if n.a > at:
            out.append(Node(at, n.a))
        out.append(n)
        at = n.b
    return out + ([Node(at, b)] if at < b else [])


def _listed(text: str, lines: list[tuple[int, int]], i: int) -> tuple[Node, int]:
    """The list that starts with line ``i``, items below the items they are indented under, and the line after it."""
    top = Node(lines[i][0], lines[i][1], "list")
    stack: list[tuple[int, Node]] = [(-1, top)]
    while i < len(lines):
        x, y = lines[i]
        blank = _BLANK.match(text, x, y)
        m = _ITEM.match(text, x, y)
        indent = len(text[x:y]) - len(text[x:y].lstrip(" \t"))
        if m:
            while stack[-1][0] >= indent:
                stack.pop()
            item = Node(x, y, "item")
            stack[-1][1].children.append(item)
            stack.append((indent, item))
        elif blank:
            after = next((k for k in range(i + 1, len(lines)) if not _BLANK.match(text, *lines[k])), len(lines))
            inside = after < len(lines) and (_ITEM.match(text, *lines[after]) or text[lines[after][0]] in " \t")
            if not inside:
                break
        elif indent == 0 and _BLANK.match(text, *lines[i - 1]):
            break
        for _, n in stack:
            n.b = y
        i += 1

    def close(n: Node) -> None:
        for c, follower in zip(n.children, [*n.children[1:], None]):
            c.b = follower.a if follower else n.b
            close(c)
        if n.children:
            n.children = _tiled(n.a, n.b, n.children)

    close(top)
    return top, i


def parse(text: str) -> Node:
    """The tree of a text of Markdown, HTML or plain paragraphs."""
    lines, at = [], 0
    for line in text.splitlines(keepends=True) if "\r" not in text and "\x0b" not in text else re.findall(r"[^\n]*\n|[^\n]+", text):
        lines.append((at, at + len(line)))
        at += len(line)
    root = Node(0, len(text), "section")
    sections: list[tuple[int, Node]] = [(0, root)]

    def enter(level: int, x: int, y: int) -> None:
        while sections[-1][0] >= level:
            sections.pop()
        sections.append((level, Node(x, y, "section", [Node(x, y, "heading")])))
        sections[-2][1].children.append(sections[-1][1])

    i = 0
    while i < len(lines):
        x, y = lines[i]
        here = sections[-1][1].children
        if _BLANK.match(text, x, y):
            i += 1
            if here:
                while i < len(lines) and _BLANK.match(text, *lines[i]):
                    i += 1
                _grown(here[-1], lines[i - 1][1])
            continue
        if m := _HEADING.match(text, x, y):
            enter(len(m[1]), x, y)
            i += 1
        elif m := _FENCE.match(text, x, y):
            end = next((k for k in range(i + 1, len(lines)) if text[lines[k][0] : lines[k][1]].strip().startswith(m[1]) and not text[lines[k][0] : lines[k][1]].strip(" \t\r\n`~")), len(lines) - 1)
            here.append(Node(x, lines[end][1], "code"))
            i = end + 1
        elif _OPENS.match(text, x, y) and (element := _html(text, x, len(text))):
            k = bisect_left(lines, (element.b, 0))
            element.b, i = (lines[k - 1][1], k) if k else (y, i + 1)
            if element.children:
                element.children[-1] = _grown(element.children[-1], element.b)
            here.append(element)
        elif _ITEM.match(text, x, y):
            node, i = _listed(text, lines, i)
            here.append(node)
        elif _ROW.match(text, x, y):
            k = i
            while k < len(lines) and _ROW.match(text, *lines[k]):
                k += 1
            here.append(Node(x, lines[k - 1][1], "table"))
            i = k
        else:
            k = i + 1
            while k < len(lines) and not any(p.match(text, *lines[k]) for p in (_BLANK, _HEADING, _FENCE, _ITEM, _ROW, _OPENS)):
                k += 1
            body, alone = text[x:y].strip(), k == i + 1
            under = text[lines[i + 1][0] : lines[i + 1][1]].strip() if not alone else ""
            before = i == 0 or _BLANK.match(text, *lines[i - 1])
            if under and set(under) <= {"="} or len(under) > 2 and set(under) <= {"-"}:
                enter(1 if under[0] == "=" else 2, x, lines[i + 1][1])
                k = i + 2
            elif alone and before and k < len(lines) and _BLANK.match(text, *lines[k]) and len(body) <= 60 and body[-1] not in ".!?:;,…。！？":
                enter(7, x, y)  # a short line between blank ones
            else:
                here.append(Node(x, lines[k - 1][1]))
            i = k
    _grown(root, len(text))

    def close(n: Node) -> None:
        if n.kind != "section":
            return
        for c, follower in zip(n.children, [*n.children[1:], None]):
            _grown(c, follower.a if follower else n.b)
            close(c)
        n.children = _tiled(n.a, n.b, n.children)

    close(root)
    return root


def _grown(n: Node, b: int) -> Node:
    """Ends a node, and what ends with it, at ``b``."""
    while True:
        n.b = max(n.b, b)
        if not n.children:
            return n
        n = n.children[-1]


class _Text:
    """A text with the places of its tokens."""

    def __init__(self, text: str, enc) -> None:
        self.text, self.enc = text, enc
        self.ids = tokens.encode(enc, text)
        self.starts = tokens.places(enc, self.ids)
        self._tree: Node | None = None
        self._sync: list[int] | None = None

    @property
    def tree(self) -> Node:
        if self._tree is None:
            self._tree = parse(self.text)
        return self._tree

    def size(self, a: int, b: int) -> int:
        """Tokens of the whole text that start in [a, b), and one for the token the cut may split."""
        return bisect_left(self.starts, b) - bisect_left(self.starts, a) + (a > 0)

    def count(self, a: int, b: int) -> int:
        """Tokens of ``text[a:b]`` on its own: only what lies before the first and after the last boundary that any scan has is encoded anew."""
        if self._sync is None:
            self._sync = [m.start() for m in _SYNC.finditer(self.text)]
        i, j = bisect_right(self._sync, a), bisect_left(self._sync, b) - 1
        if i >= j:
            return len(tokens.encode(self.enc, self.text[a:b]))
        p, q = self._sync[i], self._sync[j]
        inner = bisect_left(self.starts, q) - bisect_left(self.starts, p)
        return len(tokens.encode(self.enc, self.text[a:p])) + inner + len(tokens.encode(self.enc, self.text[q:b]))


def _cuts(t: _Text, node: Node, level: int) -> tuple[list[int], int]:
    """Cut points inside a leaf at the coarsest level from ``level`` that has any, and that level."""
    levels = _PARTS.get(node.kind, _PARTS["text"])
    while level < len(levels):
        cuts = [m.end() for m in levels[level].finditer(t.text, node.a, node.b) if node.a < m.end() < node.b]
        if cuts:
            return cuts, level
        level += 1
    return [], level


def _pack(t: _Text, node: Node, a: int, b: int, limit: int, level: int = 0) -> Iterator[tuple[int, int]]:
    """Consecutive spans that tile the part of ``node`` in [a, b), each within the limit."""
    todo: list[tuple[Node, int]] = [(Node(max(a, node.a), min(b, node.b), node.kind, node.children), level)]
    while todo:
        n, level = todo.pop()
        if level < 0 or t.size(n.a, n.b) <= limit:
            yield n.a, n.b
            continue
        if n.children:
            parts = [Node(max(c.a, n.a), min(c.b, n.b), c.kind, c.children) for c in n.children if c.b > n.a and c.a < n.b]
            if len(parts) == 1:
                todo.append((parts[0], 0))
                continue
            below = 0
        else:
            cuts, below = _cuts(t, n, level)
            parts = [Node(x, y, n.kind) for x, y in zip([n.a, *cuts], [*cuts, n.b])]
            if not cuts:  # one word over the limit: cut between tokens, at whole characters
                at, out = n.a, []
                while at < n.b:
                    k = bisect_left(t.starts, at) + max(1, limit - 1)
                    to = min(n.b, t.starts[k]) if k < len(t.starts) else n.b
                    to = to if to > at else min(n.b, at + 1)
                    out.append((Node(at, to), -1))
                    at = to
                todo += reversed(out)
                continue
        out, i = [], 0
        while i < len(parts):  # merge siblings while they fit
            k = i + 1
            while k < len(parts) and t.size(parts[i].a, parts[k].b) <= limit:
                k += 1
            whole = k > i + 1 or t.size(parts[i].a, parts[i].b) <= limit
            out.append((Node(parts[i].a, parts[k - 1].b), -1) if whole else (parts[i], below))
            i = k
        todo += reversed(out)


def _is_heading(text: str) -> bool:
    bare = text.strip()
    return bare != "" and "\n" not in bare and (bare.startswith("#") or bare[-1] not in ".!?:;,…。！？")


def _breaks(t: _Text, cuts: list[int], limit: int) -> bool:
    """Whether a cut goes through code or a table that fits."""
    todo = [t.tree]
    while todo:
        n = todo.pop()
        if any(n.a < c < n.b for c in cuts):
            if n.kind in ("code", "table") and t.size(n.a, n.b) <= limit:
                return True
            todo += n.children
    return False


def _without_runts(t: _Text, spans: Iterator[tuple[int, int]], limit: int) -> list[tuple[int, int]]:
    """Joins a span of under an eighth of the limit to the one before, where both fit.

    A heading that stands alone goes with what follows it: the two are packed anew, by lines, sentences or words,
    unless that would break code or a table that fits.
    """
    todo, out = list(spans)[::-1], []
    while todo:
        a, b = todo.pop()
        small = 8 * t.size(a, b) < limit
        if small and todo and _is_heading(t.text[a:b]):
            both = Node(a, todo[-1][1])
            anew = (list(_pack(t, both, a, both.b, limit, level)) for level in (1, 2, 3))
            if after := next((x for x in anew if x[0][1] > b and not _breaks(t, [y for _, y in x[:-1]], limit)), None):
                out.append(after[0])
                todo.pop()
                todo += after[:0:-1]
                continue
        if small and out and t.size(out[-1][0], b) <= limit:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _tail(t: _Text, a: int, b: int, n: int) -> int:
    """Where the last ``n`` tokens of the piece [a, b) start; at least as many, if a character is not to be split."""
    if n <= 0:
        return b
    k = bisect_left(t.starts, b) - n
    while k > 0 and t.starts[k] > a:
        if t.count(t.starts[k], b) >= n:
            return t.starts[k]
        k -= 1
    return a


def split_text(text: str | None, max_tokens: int, overlap: int, enc) -> list[tuple[int, int, int, int]]:
    """Pieces ``(start, fresh, end, n_tokens)`` in characters: ``text[start:end]``, of which up to ``fresh`` repeats.

    Null texts and texts within the limit have none. The parts from ``fresh`` on put together are the text.
    """
    return [] if text is None else _split(_Text(text, enc), max_tokens, overlap)


def _split(t: _Text, max_tokens: int, overlap: int) -> list[tuple[int, int, int, int]]:
    if max_tokens < 1 or len(t.ids) <= max_tokens:
        return []
    overlap = max(0, min(overlap, max_tokens - 1))
    out: list[tuple[int, int, int, int]] = []
    todo = [(0, len(t.text), max(1, max_tokens - overlap))]
    while todo:
        a, b, limit = todo.pop()
        spans = _without_runts(t, _pack(t, t.tree, a, b, limit), limit)
        if len(spans) > 1:
            todo += [(x, y, limit) for x, y in reversed(spans)]
            continue
        start = a if not out else _tail(t, out[-1][0], out[-1][2], overlap)
        n = t.count(start, b)
        if n > max_tokens:
            mine = t.size(a, b)
            less = max(1, min(limit, mine) - (n - max_tokens))
            if less < min(mine, limit):
                todo.append((a, b, less))
                continue
        while n > max_tokens and start < a:  # it cannot be cut further: repeat less
            start += 1
            n = t.count(start, b)
        if n > max_tokens and b - a > 1:  # one token of the text, but several on its own
            todo += [((a + b) // 2, b, limit), (a, (a + b) // 2, limit)]
            continue
        out.append((start, a, b, n))
    return out


def split_oversized(documents: DataFrame, doc_id: str, text: str, profiles: DataFrame, ranks: str = tokens.RANKS, max_profiles: int = 1000) -> DataFrame:
    """Numbered pieces of the texts longer than a profile's limit.

    Columns: ``doc_id, profile, piece_no`` (from 1), ``start, fresh, end`` (characters; up to ``fresh`` the
    piece repeats the one before), ``n_tokens`` and ``piece``. ``profiles`` has ``profile, max_tokens,
    overlap_tokens`` and at most ``max_profiles`` rows, else an error is raised; rows without a positive limit
    give nothing, a null overlap is 0. An overlap is the last ``overlap_tokens`` tokens of the piece before, a
    few more where a character would be split, fewer where they would not fit. Null, empty and fitting texts
    give no rows. Repeated documents repeat their pieces. The work is one narrow pass: nothing is shuffled.
    """
    rows = profiles.select("profile", "max_tokens", "overlap_tokens").distinct().limit(max_profiles + 1).collect()
    if len(rows) > max_profiles:
        raise ValueError(f"more than {max_profiles} profiles")
    limits = [(r.profile, int(r.max_tokens), int(r.overlap_tokens or 0)) for r in rows if r.max_tokens and r.max_tokens > 0]
    ship(documents.sparkSession)
    least = min((most for _, most, _ in limits), default=0)
    key_type = documents.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = tokens.encoding(ranks)
        for batch in batches:
            out = []
            for key, body in zip(batch["k"], batch["t"]):
                if 4 * len(body) <= least:  # a token has at least one byte, a character at most four
                    continue
                whole = _Text(body, enc)
                for name, most, overlap in limits:
                    out += [(key, name, i, s, f, e, n, body[s:e]) for i, (s, f, e, n) in enumerate(_split(whole, most, overlap), 1)]
                if len(out) > 5000:
                    yield pd.DataFrame(out, columns=cols)
                    out = []
            yield pd.DataFrame(out, columns=cols)

    cols = [doc_id, "profile", "piece_no", "start", "fresh", "end", "n_tokens", "piece"]
    schema = f"`{doc_id}` {key_type}, profile string, piece_no int, start int, fresh int, `end` int, n_tokens int, piece string"
    source = documents.select(documents[doc_id].alias("k"), documents[text].alias("t")).filter("t is not null and k is not null")
    return spread(source).mapInPandas(run, schema)
