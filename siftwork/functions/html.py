"""Pages to texts, links and posts, with the standard library's HTML parser.

Parsing is Python work: whole pages go through one Arrow function and come back as posts or
fields; what can be told by a regular expression (links, flags) is a column expression.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwork.schema import POST

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style"))
#: Signs of multiplication in operators, and how they are written.
OPERATORS = {"·": " \\cdot ", "⋅": " \\cdot ", "•": " \\cdot ", "*": " \\cdot ", "×": " \\times "}


class Node:
    """An element or, with name None, a text."""

    __slots__ = ("name", "attrs", "children", "text")

    def __init__(self, name: str | None, attrs: dict[str, str] | None = None, text: str = ""):
        self.name, self.attrs, self.children, self.text = name, attrs or {}, [], text

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(reversed(n.children))

    def find(self, name: str, test: Callable[[Node], bool] = lambda n: True) -> Node | None:
        return next((n for n in self.walk() if n.name == name and n is not self and test(n)), None)

    def find_all(self, name: str, test: Callable[[Node], bool] = lambda n: True) -> list[Node]:
        return [n for n in self.walk() if n.name == name and n is not self and test(n)]

    def has_class(self, word: str) -> bool:
        return word in self.attrs.get("class", "").split()

    def strings(self) -> list[str]:
        return [n.text for n in self.walk() if n.name is None]

    def get_text(self, separator: str = "", strip: bool = False) -> str:
        parts = [s.strip() for s in self.strings()] if strip else self.strings()
        return separator.join(p for p in parts if p or not strip)


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("[document]")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in ("li", "p", "tr", "td", "th", "option", "dt", "dd") and self.open[-1].name == tag:
            self.open.pop()
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].name == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(Node(None, text=data))


def parse(page: str) -> Node:
    tree = _Tree()
    tree.feed(page)
    tree.close()
    return tree.root


def visible_text(node: Node, separator: str = "\n") -> str:
    """Texts of a subtree, stripped, without scripts, styles and smiley images."""
    out, stack = [], [node]
    while stack:
        n = stack.pop()
        if n.name is None:
            if t := n.text.strip():
                out.append(t)
        elif n.name not in RAW and not n.has_class("smilies"):
            stack.extend(reversed(n.children))
    return separator.join(out)


def math_scripts(node: Node) -> None:
    """Formula scripts become texts between dollars, display ones on lines of their own."""
    for n in node.walk():
        for i, c in enumerate(n.children):
            kind = c.attrs.get("type", "") if c.name == "script" else ""
            if "mode=display" in kind:
                n.children[i] = Node(None, text=f"\n$$\n{c.get_text()}\n$$\n")
            elif "math/tex" in kind:
                n.children[i] = Node(None, text=f"${c.get_text()}$")


def mathml(node: Node) -> str:
    """LaTeX of a MathML tree: rows joined, fractions, powers, operators; other elements by their text."""
    if node.name is None:
        return node.text.strip()
    if node.name in ("math", "mrow"):
        return "".join(map(mathml, node.children))
    if node.name in ("mfrac", "msup"):
        first, second = ([mathml(c) for c in node.children if c.name or c.text.strip()] + ["", ""])[:2]
        return f"\\frac{{{first}}}{{{second}}}" if node.name == "mfrac" else f"{first}^{{{second}}}"
    text = node.get_text().strip()
    return OPERATORS.get(text, text) if node.name == "mo" else text


def _under(node: Node, *path: tuple[str, str]) -> Node | None:
    """First descendant along (tag, class) steps; an empty part fits all."""
    found = [node]
    for tag, word in path:
        found = [m for n in found for m in n.walk() if m is not n and m.name is not None and (not tag or m.name == tag) and (not word or m.has_class(word))]
    return found[0] if found else None


def board_posts(root: Node) -> list[dict]:
    """Posts of a bulletin-board page: author by the known places, else unknown; the machine-readable time; content; image flag."""
    out = []
    for post in root.find_all("div", lambda n: n.has_class("post")):
        author = _under(post, ("p", "author"), ("span", "responsive-hide"), ("strong", ""), ("a", "")) or _under(post, ("", "avatar-container"), ("a", "username")) or _under(post, ("a", "username"))
        time = post.find("time", lambda n: "datetime" in n.attrs)
        body = post.find("div", lambda n: n.has_class("content"))
        images = body is not None and body.find("img", lambda n: n.has_class("postimage")) is not None
        if body is not None:
            math_scripts(body)
        out.append({"index": len(out), "author": author.get_text(strip=True) if author else "unknown", "date": time.attrs["datetime"] if time else None, "content": visible_text(body) if body else "", "contains_images": images})
    return out


_STAMP = re.compile(r"\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2}")
_IMAGE = re.compile(r"https?://\S+\.(?:jpg|jpeg|png|gif|webp)", re.I)


def table_posts(root: Node) -> list[dict]:
    """Posts of a page that is a table of author and content; the header row says ``Autor``.  The date is left as it stands on the first line."""
    for table in root.find_all("table"):
        head = table.find("tr")
        if head is not None and "Autor" in head.get_text():
            break
    else:
        return []
    out = []
    for row in table.find_all("tr"):
        cells = row.find_all("td")
        if len(cells) != 2 or not any(c.get_text(strip=True) for c in cells):
            continue
        link = cells[0].find("a", lambda n: "/forum/uzytkownik" in n.attrs.get("href", ""))
        names = cells[0].get_text(" ", strip=True).split()
        lines = cells[1].get_text("\n").strip().split("\n")
        dated = bool(lines) and _STAMP.match(lines[0].strip())
        content = re.sub(r"\n{3,}", "\n\n", "\n".join(lines[1:] if dated else lines).strip())
        images = _IMAGE.search(content) is not None
        if content or images:
            out.append({"index": len(out), "author": link.get_text(strip=True) if link else names[0] if names else "unknown", "date": lines[0].strip() if dated else "", "content": content, "contains_images": images})
    return out


def problem_page(root: Node) -> dict:
    """title, segments (texts between rules), contains_images and the address of the next problem of a problem page."""
    body = root.find("body")
    if body is None:
        return {"title": "", "segments": [], "contains_images": False, "next_href": None}
    for n in body.walk():
        n.children = [Node(None, text=f" ${mathml(c)}$ ") if c.name == "math" else c for c in n.children]
    bold = (b.get_text(strip=True) for b in body.find_all("b"))
    title = next((t for t in bold if re.match(r"Zadanie\s+\d+", t)), "")
    segments: list[list[str]] = [[]]
    for c in body.children:
        if c.name == "hr":
            segments.append([])
        else:
            segments[-1] += [x for line in c.get_text("\n").splitlines() if (x := line.strip())]
    link = body.find("a", lambda n: "następne zadanie" in n.get_text().lower() and "href" in n.attrs)
    return {"title": title, "segments": ["\n".join(s) for s in segments], "contains_images": body.find("img") is not None, "next_href": link.attrs["href"] if link else None}


def topic_title(root: Node) -> str:
    for tag in ("h2", "h1"):
        if (n := root.find(tag, lambda n: n.has_class("topic-title"))) is not None:
            return n.get_text(strip=True)
    return ""


_PAGE = T.StructType([T.StructField("title", T.StringType()), T.StructField("posts", T.ArrayType(POST))])
_PROBLEM = T.StructType([T.StructField("title", T.StringType()), T.StructField("segments", T.ArrayType(T.StringType())), T.StructField("contains_images", T.BooleanType()), T.StructField("next_href", T.StringType())])


@F.pandas_udf(T.StringType())
def html_text(pages: pd.Series) -> pd.Series:
    """A page's visible text, formula scripts as dollars."""

    def one(page):
        if page is None:
            return None
        root = parse(page)
        math_scripts(root)
        return visible_text(root)

    return pages.map(one)


@F.pandas_udf(_PAGE)
def board_page(pages: pd.Series) -> pd.DataFrame:
    """title and posts of a bulletin-board page; no posts where it isn't one."""
    roots = [parse(p or "") for p in pages]
    return pd.DataFrame({"title": [topic_title(r) for r in roots], "posts": [board_posts(r) for r in roots]})


@F.pandas_udf(_PAGE)
def table_page(pages: pd.Series) -> pd.DataFrame:
    roots = [parse(p or "") for p in pages]
    heads = [r.find("h2") for r in roots]
    return pd.DataFrame({"title": [h.get_text(strip=True) if h else "" for h in heads], "posts": [table_posts(r) for r in roots]})


@F.pandas_udf(_PROBLEM)
def problem_fields(pages: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([problem_page(parse(p or "")) for p in pages], columns=["title", "segments", "contains_images", "next_href"])


def _unescaped(c: Column) -> Column:
    for entity, sign in (("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(sign))
    return c


def links(page: Column) -> Column:
    """Addresses of a page's links, in quotes of either kind or none."""
    found = F.regexp_extract_all(page, F.lit(r"""(?i)<a\s[^>]*?\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""), F.lit(1))
    return F.transform(found, lambda h: _unescaped(F.regexp_replace(h, r"""^["']|["']$""", "")))


def next_page(page: Column) -> Column:
    """Address of the link to the next page; null without one."""
    found = F.regexp_extract(page, r"""(?i)<a\s(?=[^>]*\brel\s*=\s*["']?next\b)[^>]*?\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return F.nullif(_unescaped(F.regexp_replace(found, r"""^["']|["']$""", "")), F.lit(""))


def has_post_image(page: Column) -> Column:
    return F.regexp_like(page, F.lit(r"(?i)<img\b[^>]*postimage"))


def sitemap_locations(xml: Column, part: str = "viewforum.php") -> Column:
    """Locations of a sitemap that hold ``part``."""
    return F.filter(F.xpath(xml, F.lit("//*[local-name()='loc']/text()")), lambda u: F.contains(u, F.lit(part)))


def latin2(content: Column) -> Column:
    """Text of bytes in ISO-8859-2, which the engine can't decode by itself: as ISO-8859-1, then the upper half exchanged."""
    upper = bytes(range(160, 256))
    return F.translate(F.decode(content, "ISO-8859-1"), upper.decode("iso-8859-1"), upper.decode("iso-8859-2"))
