"""Listing cards whose form is data: tags, classes and attributes to look for."""

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.html import attribute, clean, contents, held, inner_all, open_tags
from ..functions.rx import as_col, blank_to_null, present
from ..functions.urls import resolve


@dataclass(frozen=True)
class Step:
    """An element by tag name, a class it has, an attribute it has and a text in that attribute's value."""

    tag: str
    has_class: str = ""
    attribute: str = ""
    value: str = ""

    @property
    def need(self) -> str:
        """Regex that the attributes of the opening tag match."""
        named = rf"\sclass\s*=\s*(?:\"[^\"]*(?<![\w-])|'[^']*(?<![\w-])|)(?:{re.escape(self.has_class)})(?![\w-])" if self.has_class else ""
        held = rf"\s{re.escape(self.attribute)}\s*=\s*[\"']?[^\"'>]*{re.escape(self.value)}" if self.attribute else ""
        return f"{named})(?=[^>]*{held}" if named and held else named or held


#: Elements that HTML does not let stand inside one of their own name: their first closing tag is theirs.
NEVER_NESTED = ("a", "p", "h1", "h2", "h3", "h4", "h5", "h6")


def _inside(scopes, step: Step) -> Column:
    read = inner_all if step.tag in NEVER_NESTED else contents
    return F.flatten(F.transform(scopes, lambda s: read(s, step.tag, step.need)))


@dataclass(frozen=True)
class Pick:
    """The elements at the end of a path of steps, each inside the one before: their text, or the first of some attributes that is there."""

    path: tuple[Step, ...]
    attributes: tuple[str, ...] = ()

    def all(self, html) -> Column:
        """Values that are not blank, in page order; where elements stand inside each other, a value once for each."""
        scopes = F.array(as_col(html))
        for step in self.path[:-1]:
            scopes = _inside(scopes, step)
        last = self.path[-1]
        if self.attributes:
            tags = F.flatten(F.transform(scopes, lambda s: open_tags(s, last.tag, last.need)))
            found = F.transform(tags, lambda t: F.coalesce(*[blank_to_null(F.trim(attribute(t, a))) for a in self.attributes]))
        else:
            found = F.transform(_inside(scopes, last), clean)
        return F.filter(found, lambda v: v.isNotNull())


@dataclass(frozen=True)
class CardLayout:
    """Where a shop's listing keeps its cards and their parts.

    Of ``cards`` the first step that a page has counts; of the picks of a part
    the first with a value. ``sku`` may prefer a value that looks like a SKU.
    ``suffix``: the last value is put behind a name that does not contain it.
    """

    cards: tuple[Step, ...]
    url: tuple[Pick, ...]
    image: tuple[Pick, ...]
    name: tuple[Pick, ...]
    sku: tuple[Pick, ...] = ()
    sku_like: bool = False
    suffix: Pick | None = None


def _details(kind: str, name: str) -> Pick:
    return Pick((Step("div", "ProductThumbnailDetails"), Step("p", f"ProductThumbnailParagraph{kind}"), Step(name)))


# The classes and attributes that the listings use.
THUMBNAILS = CardLayout(
    cards=(Step("div", "ProductThumbnail"),),
    url=(Pick((Step("a", "", "href", "iteminformation.aspx"),), ("href",)),),
    image=(Pick((Step("img", "ProductThumbnailImg"),), ("data-src", "src")),),
    name=(_details("Description", "a"),),
    sku=(_details("SkuName", "a"), Pick((Step("div", "ProductThumbnailDetails"), Step("h3")))),
)
STYLES = CardLayout(
    cards=(Step("div", "", "class", "style_thumbs"), Step("div", "", "stylename")),
    url=(Pick((Step("a", "pageLoc"),), ("href",)),),
    image=(Pick((Step("img"),), ("src", "lazyload", "data-src")),),
    name=(Pick((Step("div", "stylename"),)),),
    sku=(Pick((Step("div", "stylenumber"),)),),
    sku_like=True,
    suffix=Pick((Step("div", "stylenumber"),)),
)
ITEMS = CardLayout(
    cards=(Step("li", "product-item"),),
    url=(Pick((Step("a", "product-item-link"),), ("href",)),),
    image=(Pick((Step("img", "product-image-photo"),), ("src", "data-src")), Pick((Step("a", "mainImage"), Step("img")), ("src", "data-src"))),
    name=(Pick((Step("strong", "product-item-name"), Step("a", "product-item-link"))), Pick((Step("a", "product-item-link"),))),
)


def looks_like_sku(text) -> Column:
    """At most 12 characters with a digit, or a dash and a letter."""
    t = as_col(text)
    return ((F.length(t) <= 12) & t.rlike(r"\d")) | (t.contains("-") & t.rlike(r"\p{L}"))


def _first(html, picks) -> Column:
    return F.coalesce(F.lit(None).cast("string"), *[F.get(p.all(html), F.lit(0)) for p in picks])


def _with_suffix(both) -> Column:
    name, extra = both["name"], both["extra"]
    known = F.coalesce(name, F.lit(""))
    return F.when(extra.isNull() | known.contains(extra), name).otherwise(F.trim(F.concat(known, F.lit(" "), extra)))


def card_parts(card, base_url, layout: CardLayout) -> Column:
    """Struct of a card's sku, name, url and image; parts that are not there are NULL."""
    url, image, name = (_first(card, p) for p in (layout.url, layout.image, layout.name))
    sku = _first(card, layout.sku)
    if layout.sku_like:
        sku = F.coalesce(*[held(p.all(card), lambda found: F.coalesce(F.get(F.filter(found, looks_like_sku), F.lit(0)), F.get(found, F.lit(0)))) for p in layout.sku])
    if layout.suffix:
        both = F.struct(name.alias("name"), F.try_element_at(layout.suffix.all(card), F.lit(-1)).alias("extra"))
        name = held(both, _with_suffix)

    def absolute(link):
        return held(link, lambda to: F.when(to.isNotNull(), resolve(base_url, to)))

    return F.struct(sku.alias("sku"), name.alias("name"), absolute(url).alias("url"), absolute(image).alias("image"))


def laid_out_cards(pages: DataFrame, layout: CardLayout, url: str = "url", html: str = "html") -> DataFrame:
    """One row per card that has a URL, with its place among the page's cards; NULL and empty pages have none.

    Cards are whole elements, so what stands between two cards is not part of one.
    """
    rest = [c for c in pages.columns if c != html]
    cards = F.coalesce(*[held(contents(html, s.tag, s.need), lambda c: F.when(F.size(c) > 0, c)) for s in layout.cards])
    rows = pages.select(*rest, F.posexplode(cards).alias("pos", "__card"))
    rows = rows.withColumn("__parts", card_parts("__card", url, layout))
    rows = rows.select(*rest, "pos", *[F.col(f"__parts.{p}").alias(f"card_{p}") for p in ("sku", "name", "url", "image")])
    return rows.filter(present("card_url").isNotNull())
