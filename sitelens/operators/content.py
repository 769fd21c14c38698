"""Main-content extraction by CSS selector cascade, as a
``mapInArrow`` job over the pages table.

Spark has no HTML tree; the selector profiles need one, so each task parses
its own pages with the standard library parser into a light node tree and
evaluates the few selector forms the profiles use (``tag``, ``#id``,
``.class``, ``tag#id``, ``tag.class``, ``[attr="v"]``, ``tag[attr*="v"]``).
Tree building follows the lenient parser the behaviour comes from: unclosed
elements nest, an end tag closes the nearest open element of its name, a
stray end tag is ignored.

Profiles:
* ``crawl``: first selector of ``vocab.CRAWL_CONTENT_SELECTORS`` matching
  anything; its first match; text of p/h1-h4/li/td (blank-joined, each
  followed by a blank), skipping an element whose own or parent's class list
  holds nav/menu/footer/copyright.  Nested matches are emitted once (the
  outermost), see ``repeat_nested``.  Nothing collected -> p/h1/h2/h3/li of
  the whole document.
* ``dom``: first of main/article/[role=main]/#content/.content/.main-content,
  else body; nav/header/footer/.nav/.menu/.sidebar/.widget/script/style/
  noscript removed; text squashed to single blanks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from sitelens import vocab

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
        "track", "wbr"}
RAW_TEXT = {"script", "style"}
BLOCK = {"address", "article", "aside", "blockquote", "br", "dd", "div", "dl", "dt", "fieldset", "figcaption",
         "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "main", "nav",
         "ol", "p", "pre", "section", "table", "td", "th", "tr", "ul"}


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    @property
    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#document", {}, None)
        self.cur = self.root

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.cur)
        self.cur.children.append(node)
        if tag not in VOID:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        self.cur.children.append(Node(tag, {k: (v or "") for k, v in attrs}, self.cur))

    def handle_endtag(self, tag):
        n = self.cur
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.cur = n.parent

    def handle_data(self, data):
        self.cur.children.append(data)


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


def walk(node: Node) -> Iterator[Node]:
    stack = list(reversed([c for c in node.children if isinstance(c, Node)]))
    while stack:
        n = stack.pop()
        yield n
        stack.extend(reversed([c for c in n.children if isinstance(c, Node)]))


_SEL = re.compile(r'^(?P<tag>[a-z0-9]+)?(?:#(?P<id>[\w-]+))?(?:\.(?P<cls>[\w-]+))?'
                  r'(?:\[(?P<attr>[\w-]+)(?P<op>\*?=)"(?P<val>[^"]*)"\])?$')


def matcher(selector: str):
    m = _SEL.match(selector)
    if not m:
        raise ValueError(f"unsupported selector {selector!r}")
    tag, id_, cls, attr, op, val = m.group("tag", "id", "cls", "attr", "op", "val")

    def ok(n: Node) -> bool:
        if tag and n.tag != tag:
            return False
        if id_ and n.attrs.get("id") != id_:
            return False
        if cls and cls not in n.classes:
            return False
        if attr:
            if attr not in n.attrs:
                return False
            v = n.attrs[attr]
            if op == "=" and v != val:
                return False
            if op == "*=" and val not in v:
                return False
        return True
    return ok


def select_one(root: Node, selector: str) -> Node | None:
    ok = matcher(selector)
    return next((n for n in walk(root) if ok(n)), None)


def strings(node: Node) -> Iterator[str]:
    """Text pieces below a node in document order, on an explicit stack."""
    todo = node.children[::-1]
    while todo:
        c = todo.pop()
        if isinstance(c, str):
            yield c
        elif c.tag not in RAW_TEXT:
            todo.extend(c.children[::-1])


def get_text(node: Node) -> str:
    """Text pieces stripped, blanks skipped, joined by one blank."""
    return " ".join(s.strip() for s in strings(node) if s.strip())


def crawl_content(root: Node, repeat_nested: bool = False) -> str:
    tags = set(vocab.CRAWL_CONTENT_TAGS)
    skip = set(vocab.CRAWL_SKIP_CLASSES)
    out: list[str] = []
    for sel in vocab.CRAWL_CONTENT_SELECTORS:
        found = select_one(root, sel)
        if found is None:
            continue
        todo = found.children[::-1]
        while todo:
            c = todo.pop()
            if not isinstance(c, Node):
                continue
            parent_cls = c.parent.classes if c.parent is not None else []
            if c.tag in tags and not (skip & set(c.classes + parent_cls)):
                out.append(get_text(c) + " ")
                if not repeat_nested:
                    continue
            todo.extend(c.children[::-1])
        break
    text = "".join(out)
    if not text:
        fb = set(vocab.CRAWL_FALLBACK_TAGS)
        text = " ".join(get_text(n) for n in walk(root) if n.tag in fb)
    return text


def _removed(n: Node, checks) -> bool:
    return any(ok(n) for ok in checks)


def dom_content(root: Node) -> str:
    main = None
    for sel in vocab.DOM_MAIN_SELECTORS:
        main = select_one(root, sel)
        if main is not None:
            break
    if main is None:
        main = select_one(root, "body") or root
    checks = [matcher(s) for s in vocab.DOM_REMOVE_SELECTORS]
    parts: list[str] = []

    todo = main.children[::-1]
    while todo:
        c = todo.pop()
        if isinstance(c, str):
            parts.append(c)
        elif not _removed(c, checks) and c.tag not in RAW_TEXT:
            edge = [" "] if c.tag in BLOCK else []
            todo.extend(edge + c.children[::-1] + edge)
    return " ".join("".join(parts).split())


def page_title(root: Node) -> str | None:
    t = select_one(root, "title")
    if t is None:
        return None
    s = "".join(c for c in t.children if isinstance(c, str))
    return s if s else None


CONTENT_SCHEMA = "entity string, page_id bigint, url string, title string, content string, dom_content string"


#: Pages that a task holds as parsed trees and extracted texts at once.
PAGES_AT_ONCE = 100


def main_content(pages: DataFrame, repeat_nested: bool = False) -> DataFrame:
    """pages(entity, page_id, url, html) -> CONTENT_SCHEMA, one row per page.

    A batch is worked off, and its results handed back, a few pages at a time: besides
    the batch itself a task holds no more than those, however many rows a batch has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = pa.string()
        for batch in batches:
            for start in range(0, batch.num_rows, PAGES_AT_ONCE):
                some = batch.slice(start, PAGES_AT_ONCE)
                titles, crawl, dom = [], [], []
                for h in some.column("html"):
                    root = parse(h.as_py())
                    titles.append(page_title(root))
                    crawl.append(crawl_content(root, repeat_nested))
                    dom.append(dom_content(root))
                yield pa.RecordBatch.from_arrays(
                    [some.column("entity").cast(text), some.column("page_id").cast(pa.int64()), some.column("url").cast(text),
                     pa.array(titles, text), pa.array(crawl, text), pa.array(dom, text)],
                    names=["entity", "page_id", "url", "title", "content", "dom_content"])

    return pages.select("entity", "page_id", "url", "html").mapInArrow(run, CONTENT_SCHEMA)
