"""Main text of web pages by paths that the pages of a host agree on.

Each page is read once for its container elements: every container's text is scored (words in paragraphs count
for it; words in links, lists, forms, navigation and the like against it), and the best container, or one around it
whose further text is of the article too, names a path,
the generalised tags and classes from the root down to it. Hosts vote: the paths of a host's pages are counted
with their scores, the winner becomes the host's path, and each page is extracted again at that path; a page that lacks
it uses its own best container. Inside the container, elements that hold menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles or reader comments are left out; of a header inside an article the headings stay, and
paragraphs and the like inside an article go by their class only if one of its words is that of adverts, comments and such (MARKED).
A class word that has other meanings too (WEAK) counts inside an article only where links outnumber the words of paragraphs.

Tokens are those of HTML, read in time linear in the page: comments also end at --!>, and <!--> is one; a declaration that the page ends
in is no text, a tag that it ends in is; character references are decoded in each run of text alone. What stands outside <body> belongs to it.

Votes are counts by host and path, summed before the shuffle, so a hot host is a few rows; a page's container scores
stay in its task.

Defined results: null or empty html, or a page without text, gives the empty text; a null url is a host of its own;
rows with equal page_id are pages each; an empty table gives an empty result; further columns are ignored. <br> separates words
within a block. An element that is never closed ends with its parent.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

SLICE_BYTES = 2 << 20
#: Containers below this depth share the path of the one above them.
DEEPEST = 64

# Element names as HTML defines them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg select".split())
DROPPED = frozenset("nav header footer aside form button menu dialog head option".split())
IN_HEAD = RAW | {"base", "link", "meta", "basefont", "bgsound", "noframes"}
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset("article main section div td body html".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What a class or id marks inside an article or main only if it says so outright: not by words like side or legal.
PARAGRAPHS = frozenset("p pre blockquote".split())
PROSE = HEADINGS | frozenset("p pre blockquote li dd dt figcaption caption span em strong b i u a code".split())
CLOSES_P = BLOCKS - {"body", "html"}
ENDS_OPTION = CLOSES_P | {"option", "optgroup"}
# Words in class or id that mark what is no part of the article.
_BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumbs?|header|masthead|footer|sidebar|side|widget|related|recommend\w*|"
    r"share|sharing|social|cookies?|consent|notices?|gdpr|popup|modal|newsletter|subscri\w*|signup|login|search|form|comments?|disqus|replies|reply|pagination|pager|tags|copyright|legal|skip)(?:$|[\s_-])",
    re.I,
)
_OUTRIGHT = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|cookies?|newsletter|subscri\w*|share|sharing|social|comments?|disqus|breadcrumbs?|pagination|pager)(?:$|[\s_-])", re.I)
#: Whole words of a class by which a paragraph or the like inside an article goes.
_MARKED = re.compile(r"(?:^|(?<=\s))(?:ads?|advert(?:s|isements?)?|adsense|sponsored|promo|comments?|newsletter|disqus)(?!\S)", re.I)
#: Words of _BOILERPLATE that an article's own parts may bear.
_WEAK = re.compile(r"(?:^|(?<=[\s_-]))(?:header|masthead|side|related|search|form|replies|reply|tags|copyright|legal|skip)(?=$|[\s_-])", re.I)
_HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\s*(?:!\s*important\s*)?(?:;|$)", re.I)
#: Class names that tell how a page is laid out, not what an element is: has-sidebar, no-header.
_LAYOUT = re.compile(r"(?:^|(?<=\s))(?:has|have|no|not|is|with|without|layout|hide|show)[_-]\S*", re.I)
#: A marked element that holds at least this part of a page's words is a wrapper of the page, and its mark does not count.
WRAPS = 0.8
_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
# attributes as HTML reads them: a quote opens a value only behind an equals sign
_ATTRIBUTES = r"(?:\s|/|=?[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)?+)*+"
_DECLARED = r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?:[!?]|/(?![a-zA-Z]))[^>]*(?:>|\Z)"
_TOKEN = re.compile(rf"{_DECLARED}|<(/?)([a-zA-Z][^\s/>]*)({_ATTRIBUTES})>|[^<]+|<", re.S)
#: The same behind a tag that the page ends in, which is text: tags end before the next <, so that no place is read twice.
_LATE_TOKEN = re.compile(rf"{_DECLARED}|<(/?)([a-zA-Z][^\s/><]*+)({_ATTRIBUTES.replace('[^', '[^<')})>|[^<]+|<", re.S)
_TAG = re.compile("</?[a-zA-Z]")
_ATTRIBUTE = re.compile(r"(=?[^\s=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"'][^\s>]*)))?")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in RAW}
_SPACE = re.compile(r"\s+")


class Element:
    __slots__ = ("tag", "path", "out", "score", "link", "seen", "hard", "marks", "weak", "article", "heads")

    def __init__(self, tag: str, path: str, out: bool, link: bool, seen: int = 0):
        self.tag, self.path, self.out, self.link, self.score, self.seen = tag, path, out, link, 0.0, seen
        self.hard, self.marks = out, ()
        #: Of marks, those by words that have other meanings.
        self.weak: tuple[int, ...] = ()
        #: Whether it lies in an article or main, and in a header there, of which only headings are text.
        self.article = self.heads = False


def _generalised(tag: str, names: str) -> str:
    """tag with its first class, digits cut, so that pages of one template share it."""
    first = names.split()[:1]
    return f"{tag}.{re.sub(r'[0-9]+', '#', first[0].lower())}" if first else tag


def _opened(tag: str, attributes: str, parent: Element, place: int, wrappers: frozenset[int]) -> Element:
    """The element at place of its page; class and id do not mark those at wrappers."""
    names = marks = ""
    heads = parent.heads and tag not in HEADINGS or tag == "header" and parent.article
    out, marked = parent.hard or tag in DROPPED and not heads, parent.marks
    if attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key == "class":
                names = value
            if key in ("class", "id"):
                marks += " " + value
            elif key == "role":
                out = out or value.lower() in _ROLES
            elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and _HIDDEN.search(value):
                out = True
    weak = False
    if marks and tag not in ("body", "html", "article", "main") and place not in wrappers:
        marks = _LAYOUT.sub("", marks)
        telling = _MARKED if parent.article and tag in PROSE else _OUTRIGHT if parent.article and tag == "header" else _BOILERPLATE
        if telling.search(marks):
            marked = (*marked, place)
            weak = parent.article and not telling.search(_WEAK.sub("", marks))
    path = parent.path
    if tag in CONTAINERS and path.count("/") < DEEPEST:
        path = f"{path or ('' if tag in ('html', 'body') else '/body')}/{_generalised(tag, names)}"
    child = Element(tag, path, out or bool(marked) or heads, parent.link or tag == "a")
    child.hard, child.marks, child.weak = out, marked, (*parent.weak, place) if weak else parent.weak
    child.article, child.heads = parent.article or tag in ("article", "main"), heads
    return child


class Page:
    """One reading of a page. scores: by container path. Blocks of kept text are recorded with the containers around them."""

    def __init__(self, source: str):
        wrappers = self._read(source, frozenset())
        if wrappers:
            self._read(source, wrappers)

    def _read(self, source: str, wrappers: frozenset[int]) -> frozenset[int]:
        """The marked elements that wrap the page, or that an article's own words fill, by place in the source."""
        total, held = 0, {}
        told: dict[int, int] = {}  # words of paragraphs less those of links, of elements that weak words mark; two or more count
        self.scores: dict[str, float] = {}
        self.blocks: list[tuple[str, str]] = []
        #: Of each block: words, words of them in links, and whether it is a paragraph or heading.
        self.kinds: list[tuple[int, int, bool]] = []
        linked = 0
        root = Element("", "", False, False)
        stack, text = [root], []

        def flush() -> None:
            nonlocal linked
            if text:
                words = _SPACE.sub(" ", "".join(text)).strip()
                text.clear()
                if words:
                    top = stack[-1]
                    self.blocks.append((top.path or "/body", words))
                    n = words.count(" ") + 1
                    paragraph = any(e.tag in ("p", "pre", "blockquote", "h1", "h2", "h3") for e in stack[-3:])
                    self.kinds.append((n, linked, paragraph))
                    value = n if paragraph else 0.25 * n
                    path, weight = top.path or "/body", 1.0
                    while path:  # a container is credited for text directly in it most
                        self.scores[path] = self.scores.get(path, 0.0) + value * weight
                        path, weight = path.rpartition("/")[0], weight * 0.7
                linked = 0

        def close(tag: str) -> None:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    if tag in BLOCKS or any(e.tag in BLOCKS for e in stack[i:]):
                        flush()
                    del stack[i:]
                    return
                if stack[i].tag in ("body", "td", "article", "main") and tag not in BLOCKS:
                    return

        at, token = 0, _TOKEN
        while m := token.match(source, at):
            at = m.end()
            name = m[2]
            if name is None:
                piece = m[0]
                if piece.startswith(("<!", "<?", "</")):
                    continue
                if piece == "<" and _TAG.match(source, at - 1):
                    token = _LATE_TOKEN
                piece = html.unescape(piece)
                if stack[-1].tag == "head" and piece.strip():
                    stack.pop()
                top = stack[-1]
                if not top.out:
                    text.append(piece)
                    if top.link:
                        linked += len(piece.split())
                if not top.hard and not top.link:
                    n = len(piece.split())
                    total += n
                    for place in top.marks:
                        held[place] = held.get(place, 0) + n
                if top.weak and not top.hard:
                    n = len(piece.split()) * (-1 if top.link else any(e.tag in PARAGRAPHS for e in stack[-4:]))
                    for place in top.weak:
                        told[place] = told.get(place, 0) + n
                continue
            tag, closing = name.lower(), bool(m[1])
            # end tags that HTML lets be omitted
            if not closing and (stack[-1].tag == "head" and tag not in IN_HEAD or stack[-1].tag == "option" and tag in ENDS_OPTION):
                stack.pop()
            if tag in RAW:
                if not closing and not m[3].endswith("/"):
                    end = _RAW_END[tag].search(source, at)
                    at = end.end() if end else len(source)
                continue
            if closing:
                if tag == "p" and all(e.tag != "p" for e in stack):
                    flush()
                close(tag)
            elif tag in VOID:
                if tag == "hr":
                    flush()
                elif tag == "br":
                    text.append(" ")
            else:
                if tag in CLOSES_P:
                    flush()
                    self._end_paragraph(stack)
                    if tag in ("li", "dt", "dd", "tr", "td", "th"):
                        self._end_item(stack, tag)
                child = _opened(tag, m[3], stack[-1], m.start(), wrappers)
                if child.out and not stack[-1].out:
                    flush()
                stack.append(child)
        flush()
        return frozenset(place for place, n in held.items() if n >= WRAPS * total > 0 or told.get(place, 0) > 1)

    @staticmethod
    def _end_paragraph(stack: list[Element]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == "p":
                del stack[i:]
                return
            if stack[i].tag in BLOCKS:
                return

    @staticmethod
    def _end_item(stack: list[Element], tag: str) -> None:
        same = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, (tag,))
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in same:
                del stack[i:]
                return
            if stack[i].tag in ("ul", "ol", "dl", "table", "tr" if tag in ("td", "th") else "table"):
                return

    def best(self) -> str:
        return max(self.scores, key=lambda p: (self.scores[p], -len(p), p)) if self.scores else ""

    def main(self) -> str:
        """The best container, or the outermost one around it whose further text is paragraphs and headings that are not mostly links; of a body, only text directly in it counts so."""
        path = at = self.best()
        while at:
            at = at.rpartition("/")[0]
            words = links = said = 0
            for (p, _), (n, linked, paragraph) in zip(self.blocks, self.kinds):
                if (p == at or p.startswith(at + "/")) and not (p == path or p.startswith(path + "/")):
                    words, links, said = words + n, links + linked, said + n * (paragraph and (p == at or not self._body(at)))
            if links > words / 3 or 2 * said < words or self._body(at) and said < words:
                break
            if words:
                path = at
        return path

    @staticmethod
    def _body(path: str) -> bool:
        return path.rpartition("/")[2].partition(".")[0] in ("", "html", "body")

    def text(self, path: str) -> str:
        """Blocks at path or below it, one a line."""
        return "\n".join(t for p, t in self.blocks if p == path or p.startswith(path + "/"))


def host(url):
    """The host of a url without port or a leading www., in lower case."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), r"^www\.", "")


def votes(pages: DataFrame) -> DataFrame:
    """host and path: the container path that the pages of each host agree on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "html", SLICE_BYTES):
            found: dict[tuple[str, str], list[float]] = {}
            for name, source in zip(batch.column("host").to_pylist(), common.texts(batch.column("html"))):
                page = Page(source)
                path = page.main()
                if path:
                    at = found.setdefault((name, path), [0, 0.0])
                    at[0] += 1
                    at[1] += page.scores[path]
            if found:
                keys, values = zip(*found.items())
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys]), pa.array([v[0] for v in values], pa.int64()), pa.array([v[1] for v in values])], names=["host", "path", "pages", "score"])

    cast = pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(run, "host string, path string, pages bigint, score double")
    counted = cast.groupBy("host", "path").agg(F.sum("pages").alias("pages"), F.sum(F.round("score").cast("bigint")).alias("score"))
    first = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("pages"), F.desc("score"), F.length("path"), "path"))
    return counted.withColumn("place", first).where("place = 1").select("host", "path")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "html", SLICE_BYTES):
            found = []
            for path, source in zip(batch.column("path").to_pylist(), common.texts(batch.column("html"))):
                page = Page(source)
                found.append((page.text(path) if path else "") or page.text(page.main()))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    agreed = common.cut(votes(pages), "paths").withColumnRenamed("host", "_host")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html").withColumn("_at", host(F.col("url")))
    rows = rows.join(agreed, F.col("_at") == F.col("_host"), "left").select("page_id", "url", "html", "path")
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
