"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text, each with its root-to-leaf tag path. Per
path, text length and punctuation per block are added up; paths inside
containers that name themselves navigation, advert, form and the like weigh
nothing, unless they hold nearly all text. The ratios are smoothed over the
page (a block borrows from those beside it), fused, and thresholded; an
<article> or <main> that holds nearly all of the selected weight, else the
container of all selected paths, is the article, and all its blocks are kept,
short ones and headings too.

Defined cases: a null or empty page, and one without content, give an empty
text; broken markup never fails (open tags end with their parent, a cut-off
tag or reference at the end is read as text); long pages are read whole; equal
pages give equal texts; other columns are not read.
"""

import html as entities
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>", re.S)
ATTR = re.compile(r"(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Content of these is no markup and no text.
RAW = ("script", "style", "textarea", "title")
#: Content of these is markup whose text is not shown; one without an end tag ends with its parent.
HIDDEN = frozenset({"noscript", "template", "iframe", "object", "svg", "canvas", "select"})
#: Elements without an end, elements that begin a block, elements beside the content.
VOID = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"})
BLOCK = frozenset(
    {"address", "article", "aside", "blockquote", "body", "button", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "frameset", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "label", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
)
BESIDE = frozenset({"nav", "header", "footer", "aside", "button", "dialog", "menu", "head"})
#: Some site frameworks put a whole page into these.
FORMS = frozenset({"form", "fieldset", "label"})
#: Whole class, id or role names that mark what is beside the content; a part of a longer name (``has-sidebar``) says nothing.
BESIDE_NAME = re.compile(
    r"(?:^|\s)(?:(?:site|page|main|top|left|right|primary|secondary|post|article|global|social|cookie|user|email|reader|privacy|popular|recent|latest)[_-]+)?(?:ads?|adsbygoogle|advert\w*|alerts?|banner\w*|breadcrumbs?|bylinks?|comments?|commentlist|consent|cookies?|copyright|disclaimer|disqus|dialog|footer|form|gdpr|header|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|overlay|popular(?=[_-]posts)|pagination|pager|popup|promos?|promoted|recommended|related|replies|respond|search|share|sharing|sidebar|side|signup|skip|social|sponsor\w*|subscribe|tags|toolbar|topbar|widgets?|complementary|contentinfo)(?:[_-]+(?:\d+|area|bar|block|box|container|content|inner|links?|list|menu|nav|section|widgets?|wrap|wrapper|posts|articles|stories|signup|slot|thread|left|right|buttons|bottom|top))*(?=$|\s)",
    re.I,
)
CONTENT = frozenset({"article", "main"})
#: How a block is beside the content, added up: not, by the name of a container, in a form, by its element.
INSIDE, NAMED, FORMED, OUTSIDE = 0, 1, 2, 4
#: Forms, then named containers are content where all else is less than this share of the text.
LEFT_SHARE = 0.1
PUNCTUATION = frozenset(".,;:!?。、，；：！？…")
#: Share of the largest fused ratio from which a path is content, and blocks smoothed over.
THRESHOLD, SPREAD = 0.15, 1.0
#: Ends an open element of the same kind without an end tag.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


class Paths:
    """Tag paths of a page as a tree: a path is a number, 0 the empty one. A
    path is met after the one above it, so its number is the larger, and a
    page costs its size however deeply it is nested."""

    def __init__(self):
        self.above, self.tag, self.depth = [0], [""], [0]
        self.known: dict[tuple[int, str], int] = {}

    def below(self, path: int, tag: str, label: str) -> int:
        new = self.known.setdefault((path, f"{tag}.{label}"), len(self.tag))
        if new == len(self.tag):
            self.above.append(path)
            self.tag.append(tag)
            self.depth.append(self.depth[path] + 1)
        return new


def blocks(page: str) -> tuple[Paths, list[tuple[int, int, str]]]:
    """The tag paths, and (path, how it is beside the content, text) of each block in page order."""
    paths, out = Paths(), []
    #: Open elements: tag, path of block elements, beside the content, text not shown.
    opened: list[tuple[str, int, int, bool]] = []
    count: Counter = Counter()
    parts: list[str] = []
    # Past the last ">" no tag ends, so none is sought there.
    at, n, stop = 0, len(page), page.rfind(">") + 1

    def flush():
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        if text:
            _, path, beside, _ = opened[-1] if opened else ("", 0, INSIDE, False)
            out.append((path, beside, text))

    def close(to: int):
        while len(opened) > to:
            count[opened.pop()[0]] -= 1

    while at < n:
        m = TAG.search(page, at, stop)
        hidden = bool(opened) and opened[-1][3]
        if m is None:
            parts.append("" if hidden else page[at:].partition("<!--")[0])
            break
        parts.append("" if hidden else page[at : m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                break
            continue
        if m["end"]:
            if not count[name]:
                continue
            for k in range(len(opened) - 1, -1, -1):
                if opened[k][0] == name:
                    if name in BLOCK and not opened[k][3]:
                        # Text stands before what is hidden, so it is not of the hidden element's blocks.
                        while opened[-1][3]:
                            close(len(opened) - 1)
                        flush()
                    close(k)
                    break
                if name not in BLOCK and name not in HIDDEN and opened[k][0] in BLOCK:
                    break
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if hidden:
            if name not in VOID and not m["attrs"].endswith("/"):
                opened.append((name, opened[-1][1], opened[-1][2], True))
                count[name] += 1
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in BLOCK:
            flush()
            while opened and opened[-1][0] not in BLOCK:
                close(len(opened) - 1)
            if opened and opened[-1][0] in CLOSES.get(name, {"p"}):
                close(len(opened) - 1)
        if name in VOID or m["attrs"].endswith("/") and name not in BLOCK:
            continue
        label = " ".join(x for g in ATTR.findall(m["attrs"]) for x in g if x)
        off = name in BESIDE and not (name == "header" and any(count[c] for c in CONTENT))
        named = bool(label and name not in ("html", "body") and BESIDE_NAME.search(label))
        _, path, beside, _ = opened[-1] if opened else ("", 0, INSIDE, False)
        if name in CONTENT and beside < OUTSIDE and (name == "main" or not named):
            beside = INSIDE
        beside |= (OUTSIDE if off else 0) | (NAMED if named and name not in CONTENT else 0) | (FORMED if name in FORMS else 0)
        opened.append((name, paths.below(path, name, label) if name in BLOCK else path, beside, name in HIDDEN))
        count[name] += 1
    flush()
    return paths, out


def main_text(page: str) -> str:
    """Text of the article of a page, blocks joined by line breaks."""
    paths, found = blocks(page)
    length = [sum(len(t) for _, beside, t in found if beside == how) for how in range(OUTSIDE)]
    kept = {INSIDE}
    for more in ({INSIDE, FORMED}, set(range(OUTSIDE))):
        if sum(length[how] for how in kept) < LEFT_SHARE * sum(length[how] for how in more):
            kept = more
    found = [(p, t) for p, beside, t in found if beside in kept]
    if not found:
        return ""
    at = np.array([p for p, _ in found])
    size = np.array([len(t) for _, t in found], float)
    marks = np.array([sum(map(t.count, PUNCTUATION)) for _, t in found], float)
    many = len(paths.tag)
    number = np.bincount(at, minlength=many).clip(1)
    ratios = [(np.bincount(at, x, many) / number)[at] for x in (size, marks)]
    kernel = np.exp(-0.5 * (np.arange(-3, 4) / SPREAD) ** 2)
    kernel /= kernel.sum()
    length, marks = (np.convolve(np.pad(x, 3, "edge"), kernel, "valid") for x in ratios)
    fused = length * (1 + marks)
    chosen = fused >= THRESHOLD * fused.max()
    weight = np.bincount(at[chosen], size[chosen], many)
    for p in range(many - 1, 0, -1):
        weight[paths.above[p]] += weight[p]
    def deepest(share: float) -> int:
        """The deepest container that holds this share of the chosen text, and not only one block of it."""
        root = max((int(p) for p in np.flatnonzero(weight >= share * weight[0])), key=lambda p: paths.depth[p])
        return paths.above[root] if paths.tag[root] in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "pre", "blockquote", "td", "dd") else root

    # An article or main element that holds nearly all of it, else whatever holds all of it.
    root, p = deepest(1), deepest(0.9)
    while p:
        if paths.tag[p] in CONTENT:
            root = p
        p = paths.above[p]
    inside = [False] * many
    for p in range(many):
        inside[p] = p == root or p > 0 and inside[paths.above[p]]
    return "\n".join(t for p, t in found if inside[p])


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: id, url, text, n_chars (code points)."""

    def run(batches):
        for b in batches:
            texts = [main_text(t or "") for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names)

    names = [id_col, url_col, "text", "n_chars"]
    fields = f"{id_col} {pages.schema[id_col].dataType.simpleString()}, {url_col} string, text string, n_chars long"
    return pages.select(F.col(id_col), F.col(url_col).cast("string"), F.col(html_col).cast("string")).mapInArrow(run, fields)
