"""A small lenient document tree on the standard library's HTML tokenizer.

Plain markup is read by one pattern, as the tokenizer takes several times as long; a page
that holds anything else anywhere goes through the tokenizer whole.
"""

from __future__ import annotations

import html.parser
import re
from collections.abc import Callable, Iterator
from html import unescape
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Open elements that a start tag ends, up to the element that bounds the search.
CLOSES = {
    "li": ({"li"}, {"ul", "ol"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
    "p": ({"p"}, {"div", "td", "body"}),
    "option": ({"option"}, {"select"}),
}
#: What ends elements of raw text. Content of the others below is text in some releases of the
#: tokenizer and markup in others, and in the first two references are read by all.
_RAW_END = {tag: re.compile(rf"</\s*{tag}", re.I) for tag in ("script", "style")}
READ_TEXT = frozenset("textarea title".split())
TEXT_ONLY = READ_TEXT | frozenset("iframe noembed noframes plaintext xmp".split())
_SPACE = re.compile(r"\s+")
_NAME, _BLANK = "[a-zA-Z][a-zA-Z0-9]*+", r"[ \t\r\n\f]"
_VALUE = r"""(?:"[^"]*+"|'[^']*+')"""
#: What is plain, each form in a group: text, end tag, start tag with its attributes and slash, comment or doctype.
_PLAIN = re.compile(
    rf"([^<]++)|</({_NAME})>|<({_NAME})((?:{_BLANK}++[a-zA-Z_:][-a-zA-Z0-9_:.]*+={_VALUE})*+){_BLANK}*+(/?)>"
    r"|(<!--(?!-?>)(?:[^-]|-(?!-))*+-->|<!(?i:doctype)[ ][^<>\[\]]*+>)"
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-a-zA-Z0-9_:.]*+)=(?:"([^"]*+)"|'([^']*+)')""")
#: How the tokenizer at hand reads references in attributes.
_unescape_value = getattr(html.parser, "_unescape_attrvalue", unescape)


def clean(text: str) -> str:
    return _SPACE.sub(" ", text.replace("\xa0", " ")).strip()


class Node:
    """An element; children are elements and strings in order. ``nodes`` are all elements of
    the document in order, of which those from ``start`` to ``end`` stand below this one."""

    __slots__ = ("tag", "attrs", "children", "parent", "nodes", "start", "end")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent
        self.nodes = [] if parent is None else parent.nodes
        if parent is not None:
            self.nodes.append(self)
        self.start = self.end = len(self.nodes)

    def walk(self) -> list[Node]:
        """Elements below, in document order."""
        return self.nodes[self.start : self.end]

    def _fitting(self, tag: str | None = None, cls: str | None = None, id_end: str | None = None, test: Callable[[Node], bool] | None = None) -> Iterator[Node]:
        for n in self.walk():
            if (
                (tag is None or n.tag == tag)
                and (cls is None or (cls in (own := n.attrs.get("class", "")) and cls in own.split()))
                and (id_end is None or n.attrs.get("id", "").endswith(id_end))
                and (test is None or test(n))
            ):
                yield n

    def all(self, *args, **kwargs) -> list[Node]:
        """Elements below by tag, class, end of their id and a test."""
        return list(self._fitting(*args, **kwargs))

    def first(self, *args, **kwargs) -> Node | None:
        return next(self._fitting(*args, **kwargs), None)

    def elements(self, tag: str) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node) and c.tag == tag]

    def text(self, without: str | None = None) -> str:
        parts, stack = [], [self]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                parts.append(item)
            elif without is None or without not in item.attrs.get("class", "").split():
                stack += reversed(item.children)
        return "".join(parts)

    def above(self, tag: str) -> Node | None:
        node = self.parent
        while node is not None and node.tag != tag:
            node = node.parent
        return node


class _Tree:
    """Elements as their tags come; what ends an element unsaid is in CLOSES."""

    def __init__(self):
        self.root = Node("#root", {}, None)
        self.open = [self.root]

    def begin(self, tag: str, attrs: dict[str, str]) -> None:
        open_ = self.open
        if tag in CLOSES:
            ends, within = CLOSES[tag]
            for i in range(len(open_) - 1, 0, -1):
                if open_[i].tag in within:
                    break
                if open_[i].tag in ends:
                    del open_[i:]
        node = Node(tag, attrs, open_[-1])
        open_[-1].children.append(node)
        if tag not in VOID:
            open_.append(node)

    def begin_and_end(self, tag: str, attrs: dict[str, str]) -> None:
        self.begin(tag, attrs)
        if tag not in VOID and self.open[-1].tag == tag:
            self.open.pop()

    def end(self, tag: str) -> None:
        open_ = self.open
        for i in range(len(open_) - 1, 0, -1):
            if open_[i].tag == tag:
                del open_[i:]
                return

    def say(self, text: str) -> None:
        self.open[-1].children.append(text)

    def finished(self) -> Node:
        """The root, once every element knows where those below it end."""
        nodes = self.root.nodes
        self.root.end = len(nodes)
        for node in reversed(nodes):
            if node.end > node.parent.end:
                node.parent.end = node.end
        return self.root


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tree = _Tree()

    def handle_starttag(self, tag, attrs):
        self.tree.begin(tag, {k: v or "" for k, v in attrs})

    def handle_startendtag(self, tag, attrs):
        self.tree.begin_and_end(tag, {k: v or "" for k, v in attrs})

    def handle_endtag(self, tag):
        self.tree.end(tag)

    def handle_data(self, data):
        self.tree.say(data)

    def unknown_decl(self, data):
        if data.startswith("CDATA["):
            self.handle_data(data[6:])


def _tokenized(page: str) -> Node:
    builder = _Builder()
    builder.feed(page)
    builder.close()
    return builder.tree.finished()


def _plain(page: str) -> Node | None:
    """The tree of a page of plain markup; null where it holds anything else."""
    tree = _Tree()
    begin, end, say = tree.begin, tree.end, tree.say
    token, at, inside = _PLAIN.scanner(page).match, 0, None
    while found := token():
        text, ended, tag, attrs, slash, _ = found.groups()
        at = found.end()
        if text is not None:
            if "&" in text:
                if inside and inside not in READ_TEXT:
                    return None
                text = unescape(text)
            say(text)
        elif ended is not None:
            ended = ended.lower()
            if inside and ended != inside:
                return None
            inside = None
            end(ended)
        elif inside:
            return None
        elif tag is not None:
            tag = tag.lower()
            own = {}
            if attrs:
                for name, double, single in _ATTRIBUTE.findall(attrs):
                    value = double or single
                    own[name.lower()] = _unescape_value(value) if "&" in value else value
            if slash:
                if tag in TEXT_ONLY or tag in _RAW_END:
                    return None
                tree.begin_and_end(tag, own)
                continue
            begin(tag, own)
            if tag in TEXT_ONLY:
                inside = tag
            elif tag in _RAW_END:
                last = _RAW_END[tag].search(page, at)
                if last is None or last[0].lower() != f"</{tag}" or page.find("<!--", at, last.start()) >= 0:
                    return None
                if last.start() > at:
                    say(page[at : last.start()])
                # The end tag comes next, whole or not plain.
                inside, token = tag, _PLAIN.scanner(page, last.start()).match
    return tree.finished() if at == len(page) and inside is None else None


def parse(page: str) -> Node:
    root = _plain(page)
    return _tokenized(page) if root is None else root


def fragment_text(page: str) -> str:
    return clean(parse(page).text())
