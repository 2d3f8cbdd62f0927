"""Block trees of HTML pages: a tolerant reader in linear time."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

# Elements by their role in the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe noembed noframes xmp title textarea svg math object audio video canvas".split())
BLOCK = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form frameset h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol optgroup option p pre search"
    " section select summary table tbody td tfoot th thead tr ul".split()
)
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote address figcaption center summary".split())
# An element that is opened ends these open ones, up to the nearest of the second set.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}), "option": ({"option"}, {"select", "optgroup"}),
}
# Elements nested deeper than this add no node of their own; their text stays.
DEEPEST = 150

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
SIMPLE = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)>")
TAG_END = re.compile(r"""(?>[^"'>]+|"[^"]*"|'[^']*')*+>""")
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE | re.ASCII) for tag in RAW}


@dataclass(slots=True)
class Node:
    """An element with its children, or a block of text (tag "#")."""

    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list["Node"] = field(default_factory=list)
    text: str = ""


def tokens(html: str) -> Iterator[tuple[str, str, dict]]:
    """("text", characters), ("open", tag, attributes) and ("close", tag), markup left out.

    Comments, declarations and the insides of raw elements give nothing but a title's text, as
    ("title", characters). A quote that never ends is read as an ordinary character.
    """
    at, end, quotes = 0, len(html), True
    while at < end:
        mark = html.find("<", at)
        if mark < 0:
            yield "text", html[at:], {}
            return
        if mark > at:
            yield "text", html[at:mark], {}
        simple = SIMPLE.match(html, mark)
        if simple and (tag := simple[2].lower()) not in RAW:
            at = simple.end()
            yield "close" if simple[1] else "open", tag, {}
            continue
        following = html[mark + 1 : mark + 2]
        if following in "!?" and following:
            if html.startswith("<!--", mark):
                close = html.find("-->", mark + 2 if html.startswith("<!-->", mark) else mark + 4)
                at = close + 3 if close >= 0 else end
            else:
                close = html.find(">", mark)
                at = close + 1 if close >= 0 else end
            continue
        closing = following == "/"
        name = NAME.match(html, mark + 1 + closing)
        if not name:
            if closing:
                close = html.find(">", mark)
                at = close + 1 if close >= 0 else end
            else:
                yield "text", "<", {}
                at = mark + 1
            continue
        tag = name.group().lower()
        found = TAG_END.match(html, name.end()) if quotes else None
        if found is None:
            quotes, close = False, html.find(">", name.end())
            if close < 0:
                return
            at = close + 1
        else:
            at = found.end()
        if closing:
            yield "close", tag, {}
            continue
        inside = html[name.end() : at - 1]
        attributes = {}
        if "=" in inside or inside.strip(" /"):
            for key, *values in ATTRIBUTE.findall(inside):
                attributes.setdefault(key.lower(), unescape("".join(values)))
        if tag in RAW and not (tag == "svg" and inside.endswith("/")):
            close = RAW_END[tag].search(html, at)
            if tag == "title":
                yield "title", html[at : close.start() if close else end], {}
            if not close:
                return
            tail = html.find(">", close.end())
            at = tail + 1 if tail >= 0 else end
            continue
        yield "open", tag, attributes


def flat(text: str) -> str:
    """Character references decoded, white space as single spaces, ends trimmed."""
    return " ".join((unescape(text) if "&" in text else text).split())


def tree(html: str, is_node=lambda tag, attributes: False) -> tuple[Node, str]:
    """(root, title) of a page. Block elements, and those that ``is_node`` names, become nodes;
    other elements belong to the text around them. Each stretch of text without a block's edge in
    it becomes one "#" node; a line break is white space within it."""
    root = Node("html")
    stack, held, title = [root], [], ""
    deeper: list[str] = []

    def flush() -> None:
        if held:
            text = flat("".join(held))
            held.clear()
            if text:
                stack[-1].children.append(Node("#", text=text))

    def close_to(place: int) -> None:
        flush()
        del stack[place:]

    for kind, value, attributes in tokens(html):
        if kind == "text":
            held.append(value)
        elif kind == "title":
            title = title or flat(value)
        elif kind == "open":
            if value == "br":
                held.append(" ")
            block = value in BLOCK
            if value in VOID:
                if value == "hr":
                    flush()
                continue
            if value in ("html", "body"):
                flush()
                if value == "body":
                    root.attributes = root.attributes or attributes
                continue
            if not block and not is_node(value, attributes):
                if deeper and value == deeper[0]:
                    deeper.append(value)
                continue
            flush()
            if len(stack) > DEEPEST:
                deeper.append(value)
                continue
            if block and stack[-1].tag in TEXTUAL and stack[-1].tag != "blockquote" and stack[-1].tag != "center":
                stack.pop()
            ended, until = ENDS.get(value, ((), ()))
            if ended:
                for place in range(len(stack) - 1, 0, -1):
                    if stack[place].tag in ended:
                        close_to(place)
                        break
                    if stack[place].tag in until:
                        break
            node = Node(value, attributes)
            stack[-1].children.append(node)
            stack.append(node)
        else:
            if value in ("html", "body"):
                flush()
                continue
            if deeper:
                if value in BLOCK:
                    flush()
                if value == deeper[-1]:
                    deeper.pop()
                continue
            if value in BLOCK:
                flush()
            for place in range(len(stack) - 1, 0, -1):
                if stack[place].tag == value:
                    close_to(place)
                    break
    flush()
    return root, title
