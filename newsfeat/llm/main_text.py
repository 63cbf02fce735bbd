"""Main text of web pages by tree scoring.

A page becomes a tree of elements whose running text is divided into blocks.
What is never part of an article goes first: scripts, styles, controls, menus,
footers, side bars, and elements whose role names such a part.  Elements of
which a whole class or id names an advert, notice, side bar, reader comments or
the like go too, however much they hold, unless they stand around the page's
first ``h1``, its ``main`` or its first ``article``.  If nothing is left then,
the page is made of such elements, and those of the name that holds the most text
come back.  A form goes unless the best container stands in it.

Each paragraph and list item passes points for its length and commas,
discounted by its share of link text, to its ancestors, less to each higher one;
an ``article`` or ``main`` element starts with some.  From the best container
the enclosing ``article`` or ``main`` is taken, or else the lowest element with
half of the points; it is kept with its siblings, and those of the elements it
stands in, that score well or hold text rather than links.

The work is linear in the length of the page, whatever its nesting: open elements are
found by their tags' depths, and sums go from each element to its parent once.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements without an end tag, and elements whose content is not markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
#: Elements that divide running text into blocks.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary "
                  "table tbody td tfoot th thead tr ul".split())
#: A new one ends an open one of the same group.
SAME_LEVEL = {**dict.fromkeys(("li",), ("li",)), **dict.fromkeys(("dd", "dt"), ("dd", "dt")),
              **dict.fromkeys(("td", "th"), ("td", "th")), "tr": ("tr", "td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol dl table body html div section article main".split())
PARAGRAPH = frozenset("p pre td th blockquote li dd dt caption figcaption summary".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())

#: What is left out.
NEVER = frozenset("script style noscript template textarea title head nav footer aside button select option optgroup "
                  "datalist label legend input iframe object embed svg canvas audio video menu dialog noembed noframes "
                  "xmp".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
#: Words of class and id names, and words that may stand beside them: a name
#: counts if it has one of the first and no others (``cookie-notice`` does,
#: ``has-sidebar`` and ``post-comments-off`` do not).
NAMES = re.compile(r"ads?\d*|advert\w*|adsense|banner|breadcrumbs?|comments?|commentlist|cookies?|consent|disqus|foot|"
                   r"footer|gdpr|header|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|pager|pagination|"
                   r"popup|promo\w*|related|replies|reply|respond|share|sharing|sidebar|social|sponsor\w*|subscribe|toolbar")
BESIDE = re.compile(r"area|articles|bar|block|body|bottom|box|buttons?|container|count|div|feed|google|gpt|icons|inner|"
                    r"items?|left|links?|list|main|module|outer|panel|posts|primary|readers?|right|secondary|section|signup|"
                    r"site|slot|stories|thread|top|unit|users?|widgets?|wrap|wrapper|zone|the|[\dx]+")
#: Names of reader comments: they may hold an ``article`` for each remark.
REMARKS = frozenset("comment comments commentlist disqus replies reply respond".split())
#: Not left out because of a name: they hold the article or its heading.
NAMED_ANYWAY = frozenset("html body main article h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*)")
_ATTRIBUTES = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_ATTRIBUTE = re.compile(r"""([A-Za-z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")


class _Element:
    __slots__ = ("tag", "parent", "out", "word", "depth", "in_article", "place", "score", "points", "plain", "chars",
                 "link_chars", "reads", "first", "holds", "kept")

    def __init__(self, tag: str, parent: _Element | None, out: bool, word: str = "", place: int = -1):
        self.tag, self.parent, self.out, self.word, self.place = tag, parent, out, word, place
        self.depth = parent.depth + 1 if parent else 0
        self.in_article = tag in ("article", "main") or parent is not None and parent.in_article
        self.score = self.points = 0.0
        self.plain = self.chars = self.link_chars = 0
        self.reads = self.kept = False
        self.first = -1  # number of its first block
        self.holds = ""  # which of the page's first h1, main and article stand in a named element


class _Text:
    __slots__ = ("owner", "text", "link_chars")

    def __init__(self, owner: _Element, text: str, link_chars: int):
        self.owner, self.text, self.link_chars = owner, text, link_chars


def _named(values: str) -> str:
    """The first word of ``NAMES`` that a whole class or id name consists of."""
    for name in values.split():
        words = [w for w in re.split(r"[_-]+", name) if w]
        found = [w for w in words if NAMES.fullmatch(w)]
        if found and all(w in found or BESIDE.fullmatch(w) for w in words):
            return found[0]
    return ""


def _left_out(tag: str, attributes: str, parent: _Element) -> tuple[bool, str]:
    """Whether an element is left out whatever it holds, and its name's word."""
    if tag in NEVER or tag == "header" and not parent.in_article:
        return True, ""
    if not attributes.strip(" /\t\n"):
        return False, "form" if tag == "form" else ""
    values = {k.lower(): v.strip("\"'").lower() for k, v in _ATTRIBUTE.findall(attributes)}
    if "hidden" in values or values.get("aria-hidden") == "true" or values.get("role") in ROLES:
        return True, ""
    if "display:none" in values.get("style", "").replace(" ", ""):
        return True, ""
    if tag in NAMED_ANYWAY:
        return False, ""
    if tag == "form":
        return False, "form"
    word = _named(f"{values.get('class', '')} {values.get('id', '')}")
    return False, "" if word == "header" and parent.in_article else word


class _Page:
    """A page read without the elements at the places ``drop``: its blocks of
    running text in order, its elements in the order of their tags, and the
    named ones among them."""

    def __init__(self, page: str, drop: frozenset[int] = frozenset()):
        self.blocks: list[_Text] = []
        self.root = _Element("", None, False)
        self.elements = [self.root]
        self.named: list[_Element] = []
        self._stack = [self.root]
        self._open: dict[str, list[int]] = {}  # depths of the open elements of a tag
        self._scopes: list[int] = []
        self._owners = [self.root]  # open elements that divide text
        self._buffer: list[str] = []
        self._linked = self._links = 0
        self._plain = 0
        self._marks = {"h1", "main", "article"}
        self._read(page, drop)
        self._close(1)
        self._flush()

    def _flush(self) -> None:
        if self._buffer:
            text = " ".join(html.unescape("".join(self._buffer)).split())
            self._buffer.clear()
            if text:
                self.blocks.append(_Text(self._owners[-1], text, min(self._linked, len(text))))
        self._linked = 0

    def _close(self, depth: int) -> None:
        """Ends the open elements from ``depth`` on."""
        gone = self._stack[depth:]
        if any(e.tag in BLOCK for e in gone):
            self._flush()
        for e in reversed(gone):
            self._open[e.tag].pop()
            if e.tag in SCOPE:
                self._scopes.pop()
            if e.tag in BLOCK:
                self._owners.pop()
            if e.word:
                e.plain = self._plain - e.plain
            self._links -= e.tag == "a"
        del self._stack[depth:]

    def _push(self, e: _Element) -> None:
        self._open.setdefault(e.tag, []).append(len(self._stack))
        if e.tag in SCOPE:
            self._scopes.append(len(self._stack))
        if e.tag in BLOCK:
            self._owners.append(e)
        self._stack.append(e)
        self.elements.append(e)
        self._links += e.tag == "a"
        if e.word:
            e.plain = self._plain
            self.named.append(e)
        if e.tag in self._marks and not e.out:
            self._marks.discard(e.tag)
            for x in self._stack:
                if x.word:
                    x.holds += f" {e.tag}"

    def _inner(self, *tags: str) -> int:
        """Depth of the innermost open element of ``tags`` in the innermost
        list, table or section; 0 without."""
        depth = max((self._open[t][-1] for t in tags if self._open.get(t)), default=0)
        return depth if not self._scopes or depth > self._scopes[-1] else 0

    def _text(self, text: str) -> None:
        if not self._stack[-1].out:
            self._buffer.append(text)
            if self._links:
                self._linked += len(text)
            else:
                self._plain += len(text.strip())

    def _read(self, page: str, drop: frozenset[int]) -> None:
        at, n = 0, len(page)
        raw_ends: dict[str, re.Pattern] = {}
        while at < n:
            mark = page.find("<", at)
            if mark < 0:
                mark = n
            if mark > at:
                self._text(page[at:mark])
            if mark == n:
                break
            tag = _TAG.match(page, mark)
            if not tag:
                if page.startswith("<!--", mark):
                    end = page.find("-->", mark + 4)
                    at = n if end < 0 else end + 3
                elif page.startswith(("<!", "<?"), mark):
                    end = page.find(">", mark)
                    at = n if end < 0 else end + 1
                else:  # a sign, not a tag
                    if not self._stack[-1].out:
                        self._buffer.append("<")
                    at = mark + 1
                continue
            name = tag[2].lower()
            rest = _ATTRIBUTES.match(page, tag.end())
            end = rest.end() if rest else page.find(">", tag.end()) + 1
            if not end:
                break
            attributes = page[tag.end():end - 1]
            at = end
            if tag[1]:
                depth = self._open[name][-1] if self._open.get(name) else 0
                if depth and name not in SCOPE and name not in BLOCK and self._scopes and depth < self._scopes[-1]:
                    depth = 0  # an inline element does not end a list, table or section
                if depth:
                    self._close(depth)
                continue
            if name == "br":
                if not self._stack[-1].out:
                    self._buffer.append(" ")
                continue
            if name in BLOCK and (depth := self._inner("p")):  # a block ends an open paragraph
                self._close(depth)
            if name in SAME_LEVEL and (depth := self._inner(*SAME_LEVEL[name])):
                self._close(depth)
            if name in BLOCK:
                self._flush()
            if name in VOID:
                continue
            parent = self._stack[-1]
            out, word = (True, "") if parent.out else _left_out(name, attributes, parent)
            out = out or mark in drop
            if out and not parent.out and name not in BLOCK:
                self._buffer.append(" ")
            if name in RAW:
                end_tag = raw_ends.setdefault(name, re.compile(f"</{name}", re.I))
                stop = end_tag.search(page, at)
                if not stop:
                    break
                at = page.find(">", stop.end()) + 1 or n
                continue
            if not attributes.endswith("/") or name in BLOCK:
                self._push(_Element(name, parent, out, "" if out else word, mark))

    def best(self) -> _Element | None:
        """Scores the elements and returns the best container; ``None`` if no
        element has points."""
        for number, b in enumerate(self.blocks):
            points = 0.0
            if b.owner.tag not in HEADING:
                points = 1 + b.text.count(",") + min(len(b.text) / 100, 3)
                points *= 1 - b.link_chars / len(b.text)
            own = b.owner
            own.chars += len(b.text)
            own.link_chars += b.link_chars
            own.points += points
            own.reads |= b.text.endswith((".", "!", "?"))
            own.first = number if own.first < 0 else own.first
            e = own.parent if own.tag in PARAGRAPH else own
            for part in (1, 1 / 2, 1 / 4, 1 / 6, 1 / 8):
                if e is None:
                    break
                e.score += points * part
                e = e.parent
        for e in reversed(self.elements[1:]):
            up = e.parent
            up.chars, up.link_chars, up.points = up.chars + e.chars, up.link_chars + e.link_chars, up.points + e.points
            up.reads |= e.reads
            if e.first >= 0:
                up.first = e.first if up.first < 0 else min(up.first, e.first)
        found = None
        for e in self.elements:
            if e.chars:
                e.score += 25.0 if e.tag in ("article", "main") else 0.0
                e.score *= 1 - e.link_chars / e.chars
                # of equal ones the first to begin, and of those the innermost
                if e.score > 0 and (found is None or (e.score, -e.first, e.depth) > (found.score, -found.first, found.depth)):
                    found = e
        return found

    def linked_article(self) -> _Element | None:
        """The first article or main element with text, for pages whose text is
        all links."""
        return next((e for e in self.elements if e.tag in ("article", "main") and e.chars), None)


def _stands(e: _Element) -> bool:
    """Whether a named element is kept for what stands in it."""
    held = e.holds.split()
    return "h1" in held or "main" in held or "article" in held and e.word not in REMARKS


def parsed(page: str) -> tuple[_Page, _Element | None]:
    """A page without what its names, roles and forms leave out, and its best
    container.  At most a reading for each restored name, two for the rest."""
    whole = _Page(page)
    named = [e for e in whole.named if e.word != "form" and not _stands(e)]
    forms = [e for e in whole.named if e.word == "form" and not _stands(e)]
    held: dict[str, int] = {}
    for e in named:
        held[e.word] = held.get(e.word, 0) + e.plain
    tree, best = whole, None
    for back in ["", *sorted(held, key=lambda w: (-held[w], w))]:
        named = [e for e in named if e.word != back]
        drop = frozenset(e.place for e in named)
        tree = _Page(page, drop) if drop else whole
        best = tree.best()
        if best is not None or tree.linked_article() is not None:
            break
    around, e = set(), best
    while e is not None:
        around.add(e.place)
        e = e.parent
    if best is not None and (gone := {e.place for e in forms} - around):
        tree = _Page(page, drop | gone)
        best = tree.best()
    return tree, best


def _enclosing(best: _Element) -> _Element:
    """The nearest ``article`` around ``best``, else the nearest ``main``, else
    the lowest element around it with half of the page's points."""
    around = [best]
    while around[-1].parent is not None:
        around.append(around[-1].parent)
    for tag in ("article", "main"):
        for e in around:
            if e.tag == tag:
                return e
    return next(e for e in around if e.points >= 0.5 * around[-1].points)


def main_text(page: str) -> str:
    """The main text of a page: its blocks with single spaces, joined by two
    line feeds; empty if there is none."""
    tree, best = parsed(page)
    best = best or tree.linked_article()
    if best is None:
        return ""
    least = max(10.0, 0.2 * best.score)
    base = _enclosing(best)
    marked = base.tag in ("article", "main")
    below: dict[int, list[_Element]] = {}
    for e in tree.elements[1:]:
        if e.chars:
            below.setdefault(id(e.parent), []).append(e)
    base.kept = True
    loose = set()
    e = base
    while e.parent is not None:
        for s in below[id(e.parent)]:
            if s is e:
                continue
            dense = s.link_chars >= 0.25 * s.chars
            text = s.reads or s.chars > 80 or s.tag in ("h1", "h2") or e is base and not marked
            if text and not dense and not s.word or e is base and s.score >= least:
                s.kept = True
        e = e.parent
        loose.add(id(e))
    for e in tree.elements[1:]:
        e.kept |= e.parent.kept

    def free(b: _Text) -> bool:
        """Text that stands beside elements, directly in one that holds the article."""
        return id(b.owner) in loose and b.link_chars < 0.25 * len(b.text) and (
            not marked and b.owner is base.parent or b.text.endswith((".", "!", "?")) or len(b.text) > 80)

    return "\n\n".join(b.text for b in tree.blocks if b.owner.kept or free(b))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(p or "") for p in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_page"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], names=["page", "url", "text", "n_chars"])


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id_col, url_col, text, n_chars)``, a row for each row of ``pages``,
    without a shuffle.  Defined results: a null or empty page, and one without
    running text, has an empty text; ids and urls, null or repeated, are passed
    through; an empty table gives no rows; other columns are not read."""
    one = pages.select(F.col(id_col).cast("long").alias("_page"), F.col(url_col).cast("string").alias("url"),
                       F.col(html_col).alias("html"))
    return one.mapInArrow(_extracted, "page long, url string, text string, n_chars long") \
        .withColumnsRenamed({"page": id_col, "url": url_col})
