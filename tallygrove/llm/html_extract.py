"""Main text of web pages, by container paths that the pages of a host agree on.

Each page's containers are scored by how much of the page's content they hold
and how little else.  A container is named by its path of tags and classes
without numbers.  Every container with content votes: Spark adds up the scores
per host and path; the winning path of the host then says where the text of
each page is, and a page that lacks it uses its own best container.  Work and
memory are linear in the page, however deep its elements lie.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrove.llm.shared import host_of, in_pieces, look_up, map_texts, staged, text_of, type_of

_MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|</?[a-zA-Z](?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*>|</?[a-zA-Z][^<>]*(?:>|\Z|(?=<))",
    re.DOTALL,
)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CONTAINERS = frozenset("article main section div body td blockquote html".split())
# A start tag on the left ends an open element on the right.
_ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
_NOISE_TAGS = _RAW.union("nav footer aside button select dialog menu search head noscript template svg".split())
_NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
_NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus disclaimer footer header login menu modal nav navbar navigation newsletter notice pagination popup promo "
    "promotion recommended related replies respond share sharing sidebar signup social sponsor sponsored subscribe "
    "teaser toolbar topbar widget".split()
)
# Compounds written as one word.
_NOISE_WORDS |= frozenset(
    "advertise advertorial commentarea commentbody commentbox commentform commentlist commentsection commentwrap "
    "cookiebanner cookiebar cookieconsent cookienotice footerwrap footers navbars newsletters promobox promos sidebars "
    "sponsors".split()
)
_ANYWHERE = frozenset(
    w
    for w in _NOISE_WORDS
    if w.startswith(("advert", "breadcrumb", "comment", "cookie", "footer", "navbar", "newsletter", "promo", "sidebar", "sponsor"))
)
# These often hold more text than the article does.
_REMARK_WORDS = frozenset("disqus replies respond".split()).union(w for w in _NOISE_WORDS if w.startswith("comment"))
# What holds the article; these and a headline are looked for below noise.
_LANDMARKS = frozenset("article main".split())
# Names such as "content-with-sidebar" tell of a layout, and "post-header" of a headline.
_LAYOUT_WORDS = frozenset("with without has no".split())
_CONTENT_WORDS = frozenset("article content entry post story".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_NUMBERS = re.compile(r"[0-9]+")
# Characters of a path; the front of a longer one is named by its hash.
PATH_CHARS = 240


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    name: str
    link: bool
    hidden: bool = False  # noise by tag, role or style
    named: bool = False  # noise by name, or a form
    remarks: bool = False
    headline: bool = False
    inside: bool = False  # below an article or main
    heading: bool = False  # a heading or below one
    noise: bool = False
    soft: bool = False
    content: int = 0
    visible: int = 0


@dataclass
class Page:
    """Elements in order of their start, and blocks of text with the element they are in."""

    nodes: list[Node] = field(default_factory=list)
    blocks: list[tuple[int, str, int, bool]] = field(default_factory=list)  # node, text, link chars, heading


def _noisy_name(name: str) -> bool:
    """Whether a class or id names something beside the article."""
    words = [w.lower() for w in _WORDS.findall(name)]
    if not words or _LAYOUT_WORDS.intersection(words) or _headline(words):
        return False
    ends = {words[0], words[-1]}
    # The plain words of page furniture count anywhere in a name, the others at its ends.
    return bool(_NOISE_WORDS & ends) or bool(_ANYWHERE.intersection(words))


def _headline(words: list[str]) -> bool:
    return words[-1] == "header" and bool(_CONTENT_WORDS.intersection(words[:-1]))


def _names(attributes: dict[str, str]) -> list[str]:
    return [*attributes.get("class", "").split(), attributes.get("id", "")]


def _hidden(tag: str, attributes: dict[str, str]) -> bool:
    if tag in _NOISE_TAGS or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    return attributes.get("role", "") in _NOISE_ROLES or bool(
        re.search(r"display\s*:\s*none", attributes.get("style", ""))
    )


def _named(tag: str, attributes: dict[str, str]) -> bool:
    if tag == "form":
        return True
    return tag not in ("html", "body", "main") and any(map(_noisy_name, _names(attributes)))


def parse(html: str) -> Page:
    """One pass over the markup; text is gathered up to the next block tag."""
    page = Page()
    nodes = page.nodes
    nodes.append(Node("html", -1, "", False))
    stack = [0]
    # Places on the stack of the open elements of each tag.
    opened: dict[str, list[int]] = defaultdict(list)
    buffer: list[str] = []
    link_chars = 0
    at = 0

    def flush() -> None:
        nonlocal link_chars
        text = " ".join("".join(buffer).split())
        if text:
            page.blocks.append((stack[-1], text, link_chars, nodes[stack[-1]].heading))
        buffer.clear()
        link_chars = 0

    def pop_to(tag: str) -> None:
        while True:
            gone = nodes[stack.pop()].tag
            opened[gone].pop()
            if gone == tag:
                return

    while at < len(html):
        m = _MARKUP.search(html, at)
        text = html[at : m.start()] if m else html[at:]
        if text:
            plain = unescape(text)
            if nodes[stack[-1]].link:
                link_chars += len(plain.strip())
            buffer.append(plain)
        if not m:
            break
        at = m.end()
        name = _NAME.match(m[0])
        if not name:
            continue
        tag, close = name[1].lower(), m[0][1] == "/"
        if close:
            if opened[tag]:
                if tag in _BLOCKS:
                    flush()
                pop_to(tag)
            elif tag == "p":
                flush()
            continue
        if tag == "br" or tag in _VOID:
            if tag == "hr":
                flush()
            buffer.append(" ")
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.IGNORECASE).search(html, at)
            stop = html.find(">", end.start()) if end else -1
            at = stop + 1 if stop >= 0 else len(html)
            continue
        if tag in _BLOCKS:
            flush()
            if opened["p"]:
                pop_to("p")
        ends, scope = _ENDS.get(tag, ()), _SCOPE.get(tag, ())
        inner = max((opened[t][-1] for t in ends if opened[t]), default=-1)
        if inner > max((opened[t][-1] for t in scope if opened[t]), default=-1):
            pop_to(nodes[stack[inner]].tag)
        if tag in ("html", "body") and opened[tag]:
            continue
        up = nodes[stack[-1]]
        attributes = {}
        for a in _ATTRIBUTE.finditer(m[0], name.end()):
            attributes.setdefault(a[1].lower(), unescape((a[2] or "").strip("\"'")))
        inside = up.inside or up.tag in _LANDMARKS
        heading = up.heading or tag in _HEADINGS
        outer = tag == "header" and not inside
        label, remarks, headline = tag, False, tag == "header"
        if attributes:
            label = ".".join([tag, *sorted(_NUMBERS.sub("", c).lower() for c in attributes.get("class", "").split())])
            hidden = outer or _hidden(tag, attributes)
            named = not hidden and _named(tag, attributes)
            words = [[w.lower() for w in _WORDS.findall(x)] or [""] for x in _names(attributes)]
            remarks = named and any(_REMARK_WORDS.intersection(w) for w in words)
            headline = headline or any(map(_headline, words))
        else:
            hidden = outer or tag in _NOISE_TAGS
            named = tag == "form"
        nodes.append(Node(tag, stack[-1], label, up.link or tag == "a", hidden, named, remarks, headline, inside, heading))
        opened[tag].append(len(stack))
        stack.append(len(nodes) - 1)
    flush()
    judge(page)
    return page


def judge(page: Page) -> None:
    """Set ``noise`` and ``soft``; a name, or a form, does not hide the article.

    Weighed without names, an element that they call noise is kept if it holds
    an article, main or h1 while none of its kind is in sight, or most of the
    page's text and no article beside it is in sight.  Readers' remarks are
    kept only if nothing else is.
    """
    nodes = page.nodes
    _spread(nodes)
    if not any(n.named for n in nodes):
        return
    shut = [n.hidden for n in nodes]
    for i, n in enumerate(nodes[1:], 1):
        shut[i] |= shut[n.parent]
    text = [0] * len(nodes)
    own: dict[int, int] = defaultdict(int)
    for i, block, links, _ in page.blocks:
        if not shut[i]:
            own[i] += max(0, len(block) - links)
            text[i] = own[i]
    landmark = [n.tag in _LANDMARKS and not s for n, s in zip(nodes, shut, strict=True)]
    title = [n.tag == "h1" and not s for n, s in zip(nodes, shut, strict=True)]
    for i in range(len(nodes) - 1, 0, -1):
        up = nodes[i].parent
        text[up] += text[i]
        # An empty landmark holds no article.
        landmark[i] &= text[i] > 0
        title[i] &= text[i] > 0
        landmark[up] |= landmark[i]
        title[up] |= title[i]
    if text[0]:
        _lift(nodes, own, text, landmark, title)
        _spread(nodes)


def _lift(nodes: list[Node], own: dict[int, int], text: list[int], landmark: list[bool], title: list[bool]) -> None:
    """Clear ``named`` where it hides the article, from the outer elements to the inner.

    What is in sight only grows, and each rule only gets stricter with it, so
    an element that stays noise once does so for good: each is looked at once,
    when all around it is in sight.
    """
    below: list[list[int]] = [[] for _ in nodes]
    for i, n in enumerate(nodes[1:], 1):
        below[n.parent].append(i)
    sight = [False] * len(nodes)
    # Ancestors of the largest element looked at so far, and articles in sight among them.
    above = [False] * len(nodes)
    clean = clean_above = 0
    titled = False

    def show(root: int) -> list[int]:
        """Bring an element into sight; what is noise by name below it."""
        nonlocal clean, clean_above, titled
        edge, todo = [], [root]
        while todo:
            i = todo.pop()
            n = nodes[i]
            if n.hidden:
                continue
            if n.named:
                edge.append(i)
                continue
            k = i if own.get(i) else -1
            while k >= 0 and not sight[k]:
                sight[k] = True
                titled |= nodes[k].tag == "h1"
                if nodes[k].tag in _LANDMARKS:
                    clean += 1
                    clean_above += above[k]
                k = nodes[k].parent
            todo.extend(below[i])
        return edge

    edge = show(0)
    while edge:
        lifted = []
        # Elements that do not hold each other: one at most holds over half of the text.
        for i in edge:
            n, large = nodes[i], 2 * text[i] > text[0]
            if large:
                k = n.parent
                while k >= 0 and not above[k]:
                    above[k] = True
                    clean_above += sight[k] and nodes[k].tag in _LANDMARKS
                    k = nodes[k].parent
            if n.remarks and sight[0]:
                continue
            if (landmark[i] and not clean) or (title[i] and not titled) or (large and clean == clean_above):
                lifted.append(i)
        for i in lifted:
            nodes[i].named = False
        edge = [j for i in lifted for j in show(i)]


def _spread(nodes: list[Node]) -> None:
    """Noise and headlines reach down to all that is below."""
    for i, n in enumerate(nodes):
        up = nodes[n.parent] if i else Node("", -1, "", False)
        n.noise = up.noise or n.hidden or n.named
        n.soft = up.soft or (n.headline and not n.noise)


def _kept(node: Node, heading: bool) -> bool:
    return not node.noise and (heading or not node.soft)


def weigh(page: Page) -> None:
    """Content and visible characters below each element; children follow their parents."""
    for i, text, links, heading in page.blocks:
        node = page.nodes[i]
        node.visible += len(text)
        if _kept(node, heading):
            node.content += max(0, len(text) - links)
    for node in reversed(page.nodes[1:]):
        up = page.nodes[node.parent]
        up.content += node.content
        up.visible += node.visible


def _path(up: str, name: str) -> str:
    """The path one element further down."""
    path = f"{up}/{name}" if up else name
    if len(path) <= PATH_CHARS:
        return path
    return "#" + blake2b(path.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def paths(page: Page) -> list[str]:
    """Generalised path of each element; html and body are left out."""
    out: list[str] = []
    # Elements of equal path share one text.
    known: dict[tuple[str, str], str] = {}
    for i, node in enumerate(page.nodes):
        up = out[node.parent] if i else ""
        if node.tag in ("html", "body"):
            out.append(up)
            continue
        path = known.get((up, node.name))
        if path is None:
            path = known[up, node.name] = _path(up, node.name)
        out.append(path)
    return out


def candidates(page: Page) -> list[tuple[float, int]]:
    """All containers of a weighed page that hold content: (score, element), in page order.

    The score is the harmonic mean of the share of the page's content that the
    container holds and the share of content in what it shows.
    """
    whole = page.nodes[0].content
    found = []
    for i, node in enumerate(page.nodes):
        if node.content and node.tag in _CONTAINERS and not node.noise:
            share, purity = node.content / whole, node.content / node.visible
            found.append((2 * share * purity / (share + purity), i))
    return found


def text_in(page: Page, roots: set[int]) -> str:
    """Blocks below the roots without noise, in page order, one per line."""
    below = [False] * len(page.nodes)
    for i, node in enumerate(page.nodes):
        below[i] = i in roots or (i > 0 and below[node.parent])
    return "\n".join(t for i, t, _, heading in page.blocks if below[i] and _kept(page.nodes[i], heading))


def _content(page: Page, roots: set[int]) -> int:
    """Content below the roots; what lies below two of them counts once."""
    below = [False] * len(page.nodes)
    total = 0
    for i, node in enumerate(page.nodes):
        above = i > 0 and below[node.parent]
        below[i] = above or i in roots
        total += node.content if below[i] and not above else 0
    return total


def extract(html: str, path: str | None) -> str:
    """The text below the elements with the path, else below the page's best container.

    The path must hold half of what the best container does at least: on a host
    with several templates it may be a teaser's here.
    """
    page = parse(html)
    weigh(page)
    # The page's own best holds a quarter of its content at least; of equal ones the inner counts.
    large = (c for c in candidates(page) if 4 * page.nodes[c[1]].content >= page.nodes[0].content)
    best = max(large, default=None)
    if path is not None:
        named = paths(page)
        hits = {i for i, n in enumerate(page.nodes) if named[i] == path and n.tag in _CONTAINERS and not n.noise}
        enough = best is None or 2 * _content(page, hits) >= page.nodes[best[1]].content
        text = text_in(page, hits) if hits and enough else ""
        if text:
            return text
    return text_in(page, {best[1]} if best else {0})


def host_paths(pages: DataFrame) -> DataFrame:
    """``host`` and the winning ``path``, from (host, html) rows.

    Votes are added up within each batch before they are shuffled, then by
    Spark, so a host with a third of the pages is a few rows per task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in in_pieces(batches, 1):
            votes: dict[tuple[str, str], float] = defaultdict(float)
            for host, html in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                page = parse(html)
                weigh(page)
                named = paths(page)
                best: dict[str, float] = defaultdict(float)
                for score, i in candidates(page):
                    best[named[i]] = max(best[named[i]], score)
                for path, score in best.items():
                    votes[host, path] += score
            hosts, names = [k[0] for k in votes], [k[1] for k in votes]
            scores = [round(v * 1e6) for v in votes.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(names, pa.string()), pa.array(scores, pa.int64())],
                ["host", "path", "votes"],
            )

    votes = map_texts(pages.select("host", "html"), run, "host string, path string, votes bigint")
    added = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    return added.groupBy("host").agg(F.max_by("path", F.struct("votes", F.length("path"), "path")).alias("path"))


def extract_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: id, url, text.

    Null html counts as empty; a page without text gives an empty one.  Pages
    whose URL has no host share one empty host.  The text of a page depends on
    the page and its host's path; equal rows give equal texts.
    """
    rows = pages.select(
        pages[id_col].alias("id"), pages[url_col].alias("url"), text_of(pages, html_col).alias("html"),
        host_of(pages[url_col].cast("string")).alias("host"),
    )
    winners = staged(host_paths(rows), "host_paths")
    placed = look_up(rows, winners, ["host"], "id", "left").select("id", "url", "html", "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in in_pieces(batches, 2):
            both = zip(piece.column(2).to_pylist(), piece.column(3).to_pylist(), strict=True)
            texts = pa.array([extract(html, path) for html, path in both], pa.string())
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), texts], ["id", "url", "text"])

    return map_texts(placed, run, f"id {type_of(pages, id_col)}, url {type_of(pages, url_col)}, text string")
