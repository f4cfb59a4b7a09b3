"""Main text of web pages through ratios of their tag paths.

A page is read into blocks: the text between two block-level tags, with the path of open block elements from the
root down to it. A step of a path is an element with its class and id; a region (a div, section, article, cell) is
a step of its own, so two columns are two paths. For each path, text outside links and punctuation
are added up and divided by the number of its blocks; their product is the ratio of the path. Ratios are smoothed
over the tree of paths, a step weighing ``DECAY``, in one pass up and one down. They are fused with how much text
a path has and with what the page says of the regions it lies in: marked articles weigh more, regions named as
menus, notes, adverts, forms or comments little. So marks help, but a teaser that is marked as an article does not
win against a story that isn't, nor does a class name hide one.

The path of the largest value gives the content subtree: its region, or the region above that has over ``GAIN`` more
text, text of paths with lesser ratios counting less. All blocks of that subtree are content, linked headings, lists
and table cells too, but for the regions in it that are something else.

Defined cases: null html and pages without content give an empty text; rows that repeat a
page are returned each; an empty table gives no rows; other columns are not looked at. Unclosed
elements end where their parent ends; an unclosed comment, script or style runs to the end; work grows with the
length of the page however deep its elements lie.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm.common import map_batches, read_table, texts_of

DECAY = 0.3  # weight of a ratio one step away in the tree of paths
GAIN = 0.35  # more text that a region above must have to be the content
INSIDE, NAMED = 3.0, 0.05  # weights of paths in a marked article, and in a region named as something else
LEAST = 250  # characters outside links of a path in such a region that may yet be the content

MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<attributes>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(?P<odd>/?[A-Za-z])[^>]*+(?:>|\Z)|<[!?][^>]*+(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|itemprop)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=\s|/|$)""", re.I)
NAME_PARTS = re.compile(r"[a-z]+", re.I)

# Elements whose content is no text of the page.
UNREAD = {"script", "style", "template", "noscript", "textarea", "title", "iframe", "object", "svg", "math", "canvas",
          "audio", "video", "select", "datalist", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"html", "head", "body", "address", "article", "aside", "blockquote", "button", "caption", "center", "dd", "details", "dialog",
         "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5",
         "h6", "header", "hgroup", "hr", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search",
         "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
# An element that a start tag closes, as long as none of the second set is open in between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}
# Elements that a content subtree may start at; a cell only where it holds other blocks.
REGIONS = {"", "html", "body", "center", "div", "section", "article", "main", "td"}
# Regions that are not the article.
OUTSIDE_TAGS = {"head", "nav", "footer", "aside", "menu", "dialog", "button", "search", "dir"}
DOUBTFUL_TAGS = {"form", "fieldset"}  # some pages are one form
OUTSIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog",
                 "menu", "menubar", "toolbar", "tablist", "status"}
# Names of regions that are not the article; a class or id says so with one of them, alone or with words of place.
OUTSIDE_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "bottom", "breadcrumb", "breadcrumbs",
    "comment", "comments", "commentlist", "consent", "cookie", "cookies", "copyright", "disqus", "footer", "gdpr", "header", "imprint",
    "login", "masthead", "menu", "menus", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification",
    "pager", "pagination", "popup", "promo", "promoted", "promotion", "recommended", "related", "replies", "respond", "share",
    "sharing", "sidebar", "sidebars", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription",
    "tagcloud", "teaser", "toolbar", "topbar", "trending", "widget", "widgets"}
PLACE_NAMES = {"area", "bar", "block", "bottom", "box", "buttons", "container", "global", "inner", "left", "links", "list", "main", "outer",
               "page", "primary", "right", "row", "secondary", "section", "site", "slot", "top", "wrap", "wrapper"}
INSIDE_TAGS = {"article", "main"}
INSIDE_ROLES = {"article", "main"}
INSIDE_NAMES = {"articlebody", "entrycontent", "postcontent", "articlecontent", "articletext", "storybody", "postbody", "maincontent"}
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")


class Element:
    """An open element: its path, its parent, and what it says of itself."""

    __slots__ = ("tag", "path", "parent", "outside", "named", "inside", "hidden", "text")

    def __init__(self, tag, path, parent=None, outside=False, named=False, inside=False, hidden=False):
        self.tag, self.path, self.parent = tag, path, parent
        self.outside = outside  # it or one above is no part of any article
        self.named = named  # it is something else by its name
        self.inside, self.hidden = inside, hidden
        self.text = 0.0  # weighed text in it, but for named regions below it


class Path:
    """A node of the tree of paths, with what its blocks add up to."""

    __slots__ = ("parent", "region", "length", "linked", "marks", "count", "weight", "smooth")

    def __init__(self, parent, region, weight):
        self.parent, self.region, self.weight = parent, region, weight
        self.length = self.linked = self.marks = self.count = 0
        self.smooth = 0.0

    def ratio(self) -> float:
        return self.length / self.count * (1 + self.marks / self.count) if self.count else 0.0


def names_outside(word: str) -> bool:
    """Whether a class or id is the name of a region that is not the article."""
    parts = {p.lower() for p in NAME_PARTS.findall(word)}
    return not parts.isdisjoint(OUTSIDE_NAMES) and parts <= OUTSIDE_NAMES | PLACE_NAMES


def region(tag: str, attributes: str, parent: Element) -> tuple[bool, bool, bool, bool, str]:
    """Whether an element is outside any article, named as something else, a marked article, hidden; and its class and id."""
    outside, named, inside, hidden, key = tag in OUTSIDE_TAGS, tag in DOUBTFUL_TAGS, tag in INSIDE_TAGS, False, ""
    if tag == "header":
        outside = not parent.inside
    if attributes and not attributes.isspace():
        for m in ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name == "hidden" or name == "aria-hidden" and value == "true":
                hidden = True
            elif name == "role":
                outside |= value.strip() in OUTSIDE_ROLES
                inside |= value.strip() in INSIDE_ROLES
            elif name in ("class", "id"):
                key += f" {name}={value}"
                if tag not in ("html", "body"):
                    words = [w for w in value.split() if not (parent.inside and w == "header")]
                    named |= any(map(names_outside, words))
                    inside |= any(re.sub(r"[^a-z]", "", w) in INSIDE_NAMES for w in words)
            elif name == "itemprop":
                inside |= value == "articlebody"
    return outside, named, inside, hidden, key


def blocks_of(page: str) -> tuple[list[tuple[Element, str, int]], list[Element], list[Path]]:
    """(element, text, characters in links) of each block with text, in page order; all elements and paths, parents first."""
    top_path = Path(None, None, 1.0)
    root = Element("", top_path)
    top_path.region = root
    stack, found, parts = [root], [], []
    elements, paths, known = [root], [top_path], {}
    open_tags: dict[str, int] = defaultdict(int)
    links = linked = at = 0

    def close_block():
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text and not stack[-1].hidden:
                found.append((stack[-1], text, min(linked, len(text))))
            parts.clear()
        linked = 0

    def add(text: str):
        nonlocal linked
        if text:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            if links:
                linked += len(text.strip())

    def close(tags, unless):
        if not any(open_tags[t] for t in tags):
            return False
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                for element in stack[k:]:
                    open_tags[element.tag] -= 1
                del stack[k:]
                return True
            if stack[k].tag in unless:
                return False
        return False

    position = 0
    while m := MARKUP.search(page, position):
        add(page[at:m.start()])
        at = position = m.end()
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if m["end"]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in BLOCK:
                close_block()
                close({tag}, ())
            continue
        if tag in UNREAD:
            if not m["attributes"].rstrip().endswith("/") or tag not in ("svg", "math", "object"):
                ending = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                at = position = ending.end() if ending else len(page)
            continue
        if tag == "a":
            links = 1
        elif tag == "br":
            parts.append(" ")
        elif tag in BLOCK:
            close_block()
            close({"p"}, {"td", "th", "table", "button", "object"})
            if tag in CLOSES:
                while close(*CLOSES[tag]):
                    pass
            if tag in VOID:
                continue
            parent = stack[-1]
            outside, named, inside, hidden, key = region(tag, m["attributes"], parent)
            element = Element(tag, None, parent, parent.outside or outside, named, parent.inside or inside, parent.hidden or hidden)
            step = (parent.path, tag + key + f" {outside}")
            path = None if tag in REGIONS else known.get(step)
            if path is None:
                weight = parent.path.weight * (NAMED if named and parent.path.weight >= 1 else 1.0)
                path = Path(parent.path, element if tag in REGIONS else parent.path.region, weight)
                paths.append(path)
                if tag not in REGIONS:
                    known[step] = path
            element.path = path
            elements.append(element)
            stack.append(element)
            open_tags[tag] += 1
    add(page[at:])
    close_block()
    return found, elements, paths


def smoothed(paths: list[Path]) -> None:
    """Sum of all ratios, each weighed by ``DECAY`` for every step to its path: once up the tree, once down."""
    for path in paths:
        path.smooth = path.ratio()
    for path in reversed(paths):
        if path.parent is not None:
            path.parent.smooth += DECAY * path.smooth
    for path in paths:
        if path.parent is not None:
            path.smooth += DECAY * (path.parent.smooth - DECAY * path.smooth)


def best_path(blocks: list[tuple[Element, str, int]], paths: list[Path]) -> Path | None:
    """The path of the largest fused value; none if there is no text outside links."""
    inside: set[Path] = set()
    for element, text, linked in blocks:
        path = element.path
        path.length += len(text) - linked
        path.linked += linked
        path.marks += len(PUNCTUATION.findall(text)) if len(text) > linked else 0
        path.count += 1
        if element.inside:
            inside.add(path)
    smoothed(paths)

    def value(path: Path) -> float:
        if path.weight < 1 and path.length < LEAST:
            return 0.0
        alone = path.length / (path.length + path.linked) if path.length else 0.0
        return math.sqrt(path.smooth) * path.length * alone * path.weight * (INSIDE if path in inside else 1.0)

    best = max((p for p in paths if p.length), key=value, default=None)
    return best if best is not None and value(best) > 0 else None


def content_root(best: Path, blocks: list[tuple[Element, str, int]], elements: list[Element]) -> Element:
    """The region of the best path, or the one above it that has far more text of like paths."""
    for element, text, linked in blocks:
        element.text += (len(text) - linked) * min(1.0, math.sqrt(element.path.smooth / best.smooth))
    for element in reversed(elements):
        if element.parent is not None and not element.named:
            element.parent.text += element.text
    root = best.region
    if root.tag == "td" and best.parent is not None and root.path is best:  # text that stands in cells themselves
        root = root.parent
        while root.tag not in REGIONS or root.tag == "td":
            root = root.parent
    top, held, missing = root, root.text, 0.0
    while top.parent is not None:
        missing += top.text if top.named else 0.0  # a named region above the content does not count for what it says
        top = top.parent
        if top.tag in REGIONS and top.text + missing > (1 + GAIN) * held:
            root, held = top, top.text + missing
    return root


def main_text(page: str) -> str:
    blocks, elements, paths = blocks_of(page)
    blocks = [b for b in blocks if not b[0].outside]
    best = best_path(blocks, paths)
    if best is None:
        return ""
    root = content_root(best, blocks, elements)
    content = {root}
    for element in elements:  # parents come first
        if element.parent in content and not element.named:
            content.add(element)
    # What encloses the best path is content, whatever its name.
    return "\n".join(text for element, text, _ in blocks if element in content)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def run(batches):
        for batch in batches:
            texts = [main_text(page) for page in texts_of(batch["html"])]
            yield {"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": list(map(len, texts))}

    return map_batches(pages.select("page_id", "url", "html"), run, "page_id bigint, url string, text string, n_chars bigint")


def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract(read_table(spark, folder, "pages"))
