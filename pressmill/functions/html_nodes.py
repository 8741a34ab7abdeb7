"""Small tolerant HTML reader used inside Arrow tasks.

Spark's ``xpath`` functions refuse real pages (unclosed tags, bare ampersands), so
this helper flattens one page into nodes and texts in document order. Nothing here
recurses: badly closed pages nest thousands of levels deep.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from typing import NamedTuple


class Step(NamedTuple):
    """One selector step. ``axis`` is "//" or "/"; ``how`` is "=" or "^=" (prefix)."""

    axis: str
    tags: tuple[str, ...] = ()
    attr: str = ""
    how: str = "="
    value: str = ""


_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCK = frozenset(
    "p div h1 h2 h3 h4 h5 h6 ul ol dl table form section article header footer nav pre "
    "blockquote hr address aside main".split()
)
_SELF_CLOSING = frozenset("li td th tr dt dd option".split())
_HIDDEN = frozenset("script style noscript template title".split())
_EMPHASIS = {"em": "_", "i": "_", "u": "_", "b": "**", "strong": "**"}
_BOGUS = re.compile(r"<!\[[^>]*>?")
_SPACES = re.compile(r"[ \t\n\r\f\v]+")
_LOOSE = re.compile(r"[\t\n\r\f\v]|  ")


def _squeezed(text: str) -> str:
    """Runs of whitespace as one space; most texts have none to change."""
    return _SPACES.sub(" ", text) if _LOOSE.search(text) else text


class Page(HTMLParser):
    """Nodes by number, with their parents, and an event list in document order.

    An event is ``(node, text)``; text is None where the node opens or closes.
    ``span[node]`` is the node's range of events.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.attrs, self.parent, self.span = [""], [{}], [0], [[0, 0]]
        self.events: list[tuple[int, str | None]] = []
        self._tagged: dict[str, list[int]] = {}
        self._open = [0]
        self._unclosed: dict[str, int] = {}
        self._joins = False
        # A bogus declaration ends at the next bracket; the parser refuses some.
        self.feed(_BOGUS.sub("", html) if "<![" in html else html)
        self.close()
        while self._open:
            self._end_innermost()

    def _end_innermost(self) -> None:
        node = self._open.pop()
        if node:
            self._unclosed[self.tag[node]] -= 1
        self.events.append((node, None))
        self.span[node][1] = len(self.events)

    def handle_starttag(self, tag, attrs):
        self._joins = False
        innermost = self.tag[self._open[-1]]
        if (innermost == "p" and tag in _BLOCK) or (innermost == tag and tag in _SELF_CLOSING):
            self._end_innermost()
        node = len(self.tag)
        self.tag.append(tag)
        self.attrs.append({k: v or "" for k, v in attrs})
        self.parent.append(self._open[-1])
        self.span.append([len(self.events), 0])
        self._tagged.setdefault(tag, []).append(node)
        self.events.append((node, None))
        self._open.append(node)
        self._unclosed[tag] = self._unclosed.get(tag, 0) + 1
        if tag in _VOID:
            self._end_innermost()

    def handle_endtag(self, tag):
        self._joins = False
        if self._unclosed.get(tag):
            while self.tag[self._open[-1]] != tag:
                self._end_innermost()
            self._end_innermost()

    def handle_comment(self, data):
        self._joins = False

    def handle_data(self, data):
        node = self._open[-1]
        if self._joins:
            data = self.events.pop()[1] + data
        self.events.append((node, data))
        self._joins = True

    # -- selecting ---------------------------------------------------------

    def _fits(self, node: int, step: Step) -> bool:
        if node == 0 or (step.tags and self.tag[node] not in step.tags):
            return False
        if not step.attr:
            return True
        have = self.attrs[node].get(step.attr)
        if have is None:
            return False
        return have == step.value if step.how == "=" else have.startswith(step.value)

    def _fitting(self, step: Step) -> list[int]:
        """Nodes that one step describes, in document order."""
        if len(step.tags) == 1:
            nodes = self._tagged.get(step.tags[0], [])
        elif step.tags:
            nodes = sorted(n for tag in step.tags for n in self._tagged.get(tag, ()))
        else:
            nodes = range(1, len(self.tag))
        return [n for n in nodes if self._fits(n, step)]

    def _below(self, nodes: list[int], tops: list[int]) -> list[int]:
        """Those of ``nodes`` inside any of ``tops``. Spans nest, so the last end of the
        tops passed so far says it."""
        out, k, end = [], 0, 0
        for n in nodes:
            while k < len(tops) and tops[k] < n:
                end = max(end, self.span[tops[k]][1])
                k += 1
            if self.span[n][0] < end:
                out.append(n)
        return out

    def _at_path(self, steps: tuple[Step, ...]) -> list[int]:
        """Nodes where the path of steps ends: one pass for each step, from the top."""
        here = self._fitting(steps[0])
        for step in steps[1:]:
            if not here:
                break
            nodes = self._fitting(step)
            if step.axis == "/":
                above = set(here)
                here = [n for n in nodes if self.parent[n] in above]
            else:
                here = self._below(nodes, here)
        return here

    def find(self, *paths: tuple[Step, ...]) -> list[int]:
        """Nodes matching any path, in document order."""
        return sorted({n for path in paths for n in self._at_path(path)})

    def texts(self, *paths: tuple[Step, ...]) -> list[str]:
        """Texts directly inside matching nodes, in document order."""
        wanted = set(self.find(*paths))
        return [text for node, text in self.events if text is not None and node in wanted]

    def values(self, attr: str, *paths: tuple[Step, ...]) -> list[str]:
        return [self.attrs[n][attr] for n in self.find(*paths) if attr in self.attrs[n]]

    def nearest(self, node: int, tag: str) -> int | None:
        """Closest ancestor with ``tag``."""
        node = self.parent[node]
        while node and self.tag[node] != tag:
            node = self.parent[node]
        return node or None

    # -- reading -----------------------------------------------------------

    def plain_text(self, node: int) -> str:
        """Text of a node. Blocks are separated by a blank line; emphasis,
        headings and list items keep their light marks."""
        out: list[str] = []
        hidden_until = -1
        first, last = self.span[node]
        for at in range(first, last):
            n, text = self.events[at]
            if at < hidden_until:
                continue
            tag = self.tag[n]
            if text is not None:
                out.append(_squeezed(text))
                continue
            opens = self.span[n][0] == at
            if opens and tag in _HIDDEN:
                hidden_until = self.span[n][1]
            elif tag in _EMPHASIS:
                out.append(_EMPHASIS[tag])
            elif tag == "br":
                out.append("\n" if opens else "")
            elif tag == "li":
                out.append("\n* " if opens else "\n")
            elif tag in _BLOCK:
                out.append("\n\n")
                if opens and len(tag) == 2 and tag[1].isdigit():
                    out.append("#" * int(tag[1]) + " ")
        text = re.sub(r" *\n *", "\n", "".join(out))
        return re.sub(r"\n{3,}", "\n\n", text).strip() + "\n\n"

    def blocks(self) -> list[tuple[str, int]]:
        """Texts between the borders of blocks, whitespace squeezed, with the number of their
        characters that stand inside links. Inline marks don't divide a text."""
        out: list[tuple[str, int]] = []
        parts: list[str] = []
        linked = depth = 0
        hidden_until = -1

        def end() -> None:
            nonlocal linked
            text = _squeezed("".join(parts)).strip()
            if text:
                out.append((text, min(linked, len(text))))
            parts.clear()
            linked = 0

        for at, (n, text) in enumerate(self.events):
            if at < hidden_until:
                continue
            tag = self.tag[n]
            if text is not None:
                parts.append(text)
                linked += len(text.strip()) if depth else 0
            elif tag in _HIDDEN:
                hidden_until = max(hidden_until, self.span[n][1])
            elif tag == "a":
                depth += 1 if self.span[n][0] == at else -1
            elif tag in _BLOCK or tag in _SELF_CLOSING or tag == "br" or not n:
                end()
        end()
        return out

    def main_node(self) -> int:
        """The node holding most of the prose.

        Every paragraph adds to its parent, and half to the parent above: one
        point, one per comma, one per hundred characters up to three. Links in a
        node lower its score.
        """
        # Running sums over the events, so that nested nodes cost nothing extra.
        total, linked, commas, depth = [0], [0], [0], 0
        for at, (n, text) in enumerate(self.events):
            if text is None and self.tag[n] == "a":
                depth += 1 if self.span[n][0] == at else -1
            shown = text.strip() if text and self.tag[n] not in _HIDDEN else ""
            total.append(total[-1] + len(shown))
            linked.append(linked[-1] + (len(shown) if depth else 0))
            commas.append(commas[-1] + shown.count(","))
        points: dict[int, float] = {}
        for tag in ("p", "pre", "td"):
            for n in self._tagged.get(tag, ()):
                first, last = self.span[n]
                size = total[last] - total[first]
                if size < 25:
                    continue
                gain = 1 + commas[last] - commas[first] + min(size // 100, 3)
                above = self.parent[n]
                points[above] = points.get(above, 0) + gain
                if above:
                    higher = self.parent[above]
                    points[higher] = points.get(higher, 0) + gain / 2

        def score(n: int) -> float:
            first, last = self.span[n]
            size = total[last] - total[first]
            return points[n] * (1 - (linked[last] - linked[first]) / size) if size else 0.0

        return max(sorted(points), key=score, default=0)
