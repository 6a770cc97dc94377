"""Reading tags, attributes and text out of raw HTML with native expressions."""

from pyspark.sql import Column, functions as F

from .rx import as_col, blank_to_null, grab, grab_all, sub
from .text import decode_entities, html_to_line, squeeze

#: A value in double quotes, single quotes or bare; groups 1-3.
_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def attribute(tag, name: str) -> Column:
    """Attribute of a tag's source text; NULL when absent or empty."""
    p = rf"(?is)[\s\"']{name}{_VALUE}"
    return decode_entities(F.coalesce(grab(tag, p, 1), grab(tag, p, 2), grab(tag, p, 3)))


def open_tags(html, name: str, need: str = "") -> Column:
    """Source of every opening tag; ``need`` is a regex its attributes must match."""
    look = rf"(?=[^>]*{need})" if need else ""
    return grab_all(html, rf"(?is)(<{name}\b{look}[^>]*>)")


def first_tag(html, name: str, need: str = "") -> Column:
    return F.get(open_tags(html, name, need), F.lit(0))


def inner(html, name: str, need: str = "") -> Column:
    """Content of the first such element, up to its first closing tag: for elements that hold none of their name."""
    look = rf"(?=[^>]*{need})" if need else ""
    return grab(html, rf"(?is)<{name}\b{look}[^>]*>(.*?)</{name}\s*>")


def inner_all(html, name: str, need: str = "") -> Column:
    """The same of every element, left to right; see ``contents`` for nested ones."""
    look = rf"(?=[^>]*{need})" if need else ""
    return grab_all(html, rf"(?is)<{name}\b{look}[^>]*>(.*?)</{name}\s*>")


def held(value, body) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(steps) -> Column:
    """Sums of an array of int up to each place.

    Summed in blocks of about the square root of the length, then the blocks'
    totals are added: one growing array would be copied at every step.
    """

    def last(sums):
        return F.coalesce(F.try_element_at(sums, F.lit(-1)), F.lit(0))

    def block(part):
        return F.aggregate(part, F.array().cast("array<int>"), lambda sums, x: F.array_append(sums, last(sums) + x))

    def blocks(part):
        width = F.greatest(F.ceil(F.sqrt(F.size(part))).cast("int"), F.lit(1))
        return F.transform(F.sequence(F.lit(1), F.greatest(F.size(part), F.lit(1)), width), lambda at: block(F.slice(part, at, width)))

    def joined(parts):
        before = F.aggregate(parts, F.array(F.lit(0)).cast("array<int>"), lambda sums, p: F.array_append(sums, last(sums) + last(p)))
        return held(before, lambda b: F.flatten(F.transform(parts, lambda p, i: F.transform(p, lambda x: x + F.get(b, i)))))

    return held(steps, lambda s: held(blocks(s), joined))


def elements(html, name: str, need: str = "") -> Column:
    """Every such element, nested ones too: array of (place, depth, content) in page order.

    The page is cut before each opening and closing tag of the name and depths
    are summed over the tags. Tags of one level take turns, opening and
    closing, so sorted by (level, place) each opening tag stands before its
    partner. ``content`` is the source between the two; an element that is never
    closed runs to the end of the page, a stray closing tag closes nothing.
    ``place`` counts the tags of the name from 1, ``depth`` is 1 for an outermost
    element where tags balance; after k stray closing tags it is k less. An
    empty page has no element; NULL stays NULL.
    """
    opening, closing = rf"(?i)^<{name}(?=[\s/>])", rf"(?i)^</{name}(?=[\s/>])"
    wanted = rf"(?is)^<{name}(?=[\s/>])(?=[^>]*{need})"

    def tags(steps, depths):
        each = F.transform(steps, lambda s, i: F.struct((F.get(depths, i) + F.when(s < 0, 1).otherwise(0)).alias("level"), i.alias("at"), s.alias("step")))
        return F.array_sort(F.filter(each, lambda t: t["step"] != 0))

    def paired(pieces, ordered):
        def pair(tag, i):
            after = F.get(ordered, i + 1)
            until = F.when(after["level"] == tag["level"], after["at"]).otherwise(F.size(pieces))
            return F.struct(tag["at"].alias("at"), tag["level"].alias("level"), until.alias("until"), tag["step"].alias("step"))

        pairs = F.array_sort(F.filter(F.transform(ordered, pair), lambda t: (t["step"] > 0) & F.get(pieces, t["at"]).rlike(wanted)))
        # The first piece has no tag unless the page begins with one.
        lead = F.when(F.get(pieces, F.lit(0)).rlike(rf"(?i)^</?{name}(?=[\s/>])"), 1).otherwise(0)

        def read(t):
            source = F.array_join(F.slice(pieces, t["at"] + 1, t["until"] - t["at"]), "")
            return F.struct((t["at"] + lead).alias("place"), t["level"].alias("depth"), F.regexp_replace(source, "^<[^>]*>?", "").alias("content"))

        return F.transform(pairs, read)

    def cut(pieces):
        steps = F.transform(pieces, lambda p: F.when(p.rlike(opening), 1).when(p.rlike(closing), -1).otherwise(0))
        ordered = held(steps, lambda s: held(running(s), lambda depths: tags(s, depths)))
        return held(ordered, lambda tags_in_order: paired(pieces, tags_in_order))

    return held(F.split(as_col(html), rf"(?i)(?=</?{name}[\s/>])"), cut)


def contents(html, name: str, need: str = "") -> Column:
    """Content of every such element, nested ones too."""
    return F.transform(elements(html, name, need), lambda e: e["content"])


def without_scripts(html) -> Column:
    """Scripts, styles and comments removed; what stands in ``noscript`` or ``template`` stays."""
    return sub(html, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->", " ")


def without_code(html) -> Column:
    """Scripts, styles, comments and elements that are not shown removed."""
    return sub(html, r"(?is)<(script|style|noscript|template)\b[^>]*>.*?</\1\s*>|<!--.*?-->", " ")


def page_text(html) -> Column:
    """Visible text of a page on one line."""
    return html_to_line(without_code(html))


def page_lines(html) -> Column:
    """Visible text, one line per element."""
    t = decode_entities(sub(without_code(html), "<[^>]+>", "\n"))
    return F.array_join(F.filter(F.transform(F.split(t, "\n"), squeeze), lambda x: x != ""), "\n")


def links(html) -> Column:
    """Non-empty href of every anchor, in page order, also in ``noscript`` and ``template``."""
    hrefs = F.transform(open_tags(without_scripts(html), "a", r"\shref\s*="), lambda t: F.trim(attribute(t, "href")))
    return F.filter(hrefs, lambda h: h.isNotNull() & (h != ""))


def cut_at(html, mark: str) -> Column:
    """The text cut before each match of ``mark``; what stands before the first is dropped."""
    pieces = F.split(F.regexp_replace(as_col(html), f"(?is)(?={mark})", "\u0001"), "\u0001")
    return F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))


def clean(c) -> Column:
    return blank_to_null(html_to_line(c))
