"""Product facts from landed pages."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.html import attribute, clean, contents, cut_at, first_tag, inner, inner_all, page_lines, without_code
from ..functions.rx import as_col, blank_to_null, first_present, grab, grab_all, present, strip
from ..functions.text import html_to_line, squeeze
from ..functions.urls import absolute_image, first_srcset, resolve
from ..spec.lines import caps_sections, map_first, map_last


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, html) as landed."""
    return spark.read.parquet(path).select("page_id", "url", "html")


# --- A7 listing cards -----------------------------------------------------


@dataclass(frozen=True)
class CardForm:
    """Where a shop's listing page keeps the parts of a card.

    ``mark`` matches the card's opening tag; classes are regexes.
    """

    mark: str = r"<[a-z]+\b[^>]*\bdata-pid\s*="
    sku_attribute: str = "data-pid"
    name_class: str = "product-name"
    image_class: str = "tile-image"
    price_class: str = "value"


TILE = CardForm()
#: Shop systems that mark a card with a class: item or card blocks with title and price classes.
ITEM = CardForm(r"<(?:li|div|article)\b[^>]*class\s*=\s*[\"'][^\"']*\bproduct(?:-item|-card|-tile)?\b", "data-sku", "(?:product-?(?:item-?)?(?:name|title)|card-?title|woocommerce-loop-product__title)", "", "(?:price|amount)")


def card_structs(html, base_url, form: CardForm = TILE) -> Column:
    """Array of card structs; a card reaches to the start of the next one."""

    def of_class(name):
        return rf"class\s*=\s*[\"'][^\"']*\b{name}" if name else ""

    def read(card):
        head = grab(card, r"(?is)^(<[^>]*>)")
        label = attribute(head, "aria-label")
        named = clean(grab(card, rf"(?is)<([a-z0-9]+)\b(?=[^>]*{of_class(form.name_class)})[^>]*>(.*?)</\1", 2))
        name = F.when(F.lower(label) == "compare", None).otherwise(label)
        link = attribute(first_tag(card, "a", r"\shref\s*="), "href")
        image = F.coalesce(first_tag(card, "img", of_class(form.image_class)), first_tag(card, "img"))
        src = F.coalesce(attribute(image, "src"), attribute(image, "data-src"), first_srcset(attribute(image, "srcset")))
        sales = F.coalesce(grab(card, rf"(?is)<span\b[^>]*{of_class('sales')}[^>]*>(.*)$"), card)
        tag = first_tag(sales, "span", of_class(form.price_class))
        amount = F.coalesce(attribute(tag, "content"), clean(inner(sales, "span", of_class(form.price_class))))
        return F.struct(
            F.trim(attribute(head, form.sku_attribute)).alias("sku"),
            first_present(name, named).alias("name"),
            F.when(link.isNotNull(), resolve(base_url, link)).alias("url"),
            absolute_image(src).alias("image"),
            amount.alias("price"),
        )

    return F.transform(cut_at(html, form.mark), read)


def listing_cards(pages: DataFrame, url: str = "url", html: str = "html", form: CardForm = TILE, need_sku: bool = True) -> DataFrame:
    """One row per card with its position; rows need a URL, and a SKU unless one is generated later."""
    rest = [c for c in pages.columns if c != html]
    rows = pages.select(*rest, F.posexplode(card_structs(html, url, form)).alias("pos", "card"))
    rows = rows.select(*rest, "pos", *[F.col(f"card.{f}").alias(f"card_{f}") for f in ("sku", "name", "url", "image", "price")])
    rows = rows.filter(present("card_url").isNotNull())
    return rows.filter(present("card_sku").isNotNull()) if need_sku else rows


# --- A8/A9 embedded JSON --------------------------------------------------


def json_value(c) -> Column:
    """The text if it is valid JSON."""
    return F.when(F.try_parse_json(as_col(c)).isNotNull(), as_col(c))


def shop_meta(html) -> Column:
    """Object assigned to ``var meta``."""
    return json_value(grab(html, r"(?s)var\s+meta\s*=\s*(\{.*?\});"))


def ld_products(html) -> Column:
    """JSON-LD objects of type Product, from an object, a list or ``@graph``."""
    blocks = F.filter(F.transform(inner_all(html, "script", r"type\s*=\s*[\"']application/ld\+json"), lambda b: json_value(strip(b))), lambda b: b.isNotNull())

    def members(b):
        graph = F.get_json_object(b, "$['@graph']")
        return F.when(b.startswith("["), F.from_json(b, "array<string>")).when(graph.isNotNull(), F.from_json(graph, "array<string>")).otherwise(F.array(b))

    def is_product(m):
        kind = F.get_json_object(m, "$['@type']")
        return (kind == "Product") | kind.contains('"Product"')

    return F.filter(F.flatten(F.transform(blocks, members)), is_product)


def embedded_product(html) -> Column:
    """Shop object, else the first JSON-LD product."""
    return F.coalesce(shop_meta(html), F.get(ld_products(html), F.lit(0)))


def balanced_json(c, marker: str) -> Column:
    """The source text of the JSON object after a marker; NULL if there is none or it does not close.

    One fold over escapes, quotes, brackets and what lies between them keeps
    the depth outside strings; the text is cut, never written anew, so numbers
    keep their digits.
    """
    c = as_col(c)
    rest = F.substring(c, F.locate(marker, c), F.length(c))
    start = F.when(F.locate(marker, c) > 0, F.locate("{", rest))
    rest = F.when(start > 0, F.substring(rest, start, F.length(rest)))
    parts = F.regexp_extract_all(rest, F.lit(r'(?s)(\\.|["{}\[\]\\]|[^"{}\[\]\\]++)'), F.lit(1))
    zero = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("text"), F.lit(0).alias("at"), F.lit(0).alias("end"))

    def step(s, p):
        text = s["text"] != (p == '"')
        depth = s["depth"] + F.when(text, 0).when(p.isin("{", "["), 1).when(p.isin("}", "]"), -1).otherwise(0)
        at = s["at"] + F.length(p)
        end = F.when((s["end"] == 0) & (depth == 0), at).otherwise(s["end"])
        return F.struct(depth.alias("depth"), text.alias("text"), at.alias("at"), end.alias("end"))

    end = F.aggregate(parts, zero, step)["end"]
    found = F.when(end > 0, F.substring(rest, F.lit(1), end))
    return F.when(F.get_json_object(found, "$").isNotNull(), found)


# JSON keys of metric sizes, English and Dutch.
CM_KEYS = {"W": ("width(?:_cm)?", "breedte"), "D": ("depth(?:_cm)?", "diepte"), "H": ("height(?:_cm)?", "hoogte"), "L": ("length(?:_cm)?", "lengte")}


def source_facts(html) -> dict[str, Column]:
    """Family, description and metric sizes read from raw page source."""
    family = F.coalesce(
        grab(html, r'(?i)"family_id"\s*:\s*"?(\w+)"?'),
        grab(html, r'(?i)"familyId"\s*:\s*"?(\w+)"?'),
        grab(html, r'(?i)data-family-id="([^"]+)"'),
        grab(html, r'(?i)"product_family_id"\s*:\s*"?(\w+)"?'),
    )

    def long_enough(raw):
        t = F.trim(F.regexp_replace(F.from_json(F.concat(F.lit('{"v":"'), raw, F.lit('"}')), "v string")["v"], "<[^>]+>", " "))
        return F.when(F.length(t) > 20, t)

    described = F.coalesce(*[long_enough(grab(html, rf'(?i)"{k}"\s*:\s*"([^"\\]*+(?:\\.[^"\\]*+)*+)"')) for k in ("description", "short_description")])
    sizes = {axis: F.coalesce(*[grab(html, rf'(?i)"{k}"\s*:\s*([\d.]+)') for k in keys]) for axis, keys in CM_KEYS.items()}
    text = F.concat_ws(";", *[F.concat(F.lit(f"{a}="), v) for a, v in sizes.items()])
    return {"family_id": family, "description": described, "sizes_cm": blank_to_null(text)}


# --- N14 label/value pairs ------------------------------------------------


def row_pairs(html) -> Column:
    """(label, value) of two-cell table rows, dt/dd pairs and label/data columns."""

    def pairs(regex):
        found = grab_all(html, regex, 0)
        return F.transform(found, lambda m: F.struct(html_to_line(F.regexp_extract(m, regex, 1)).alias("label"), html_to_line(F.regexp_extract(m, regex, 2)).alias("value")))

    every = F.concat(
        pairs(r"(?is)<tr[^>]*>\s*<t[hd][^>]*>(.*?)</t[hd]>\s*<t[hd][^>]*>(.*?)</t[hd]>"),
        pairs(r"(?is)<dt[^>]*>(.*?)</dt>\s*<dd[^>]*>(.*?)</dd>"),
        pairs(r"(?is)<[a-z]+[^>]*class\s*=\s*[\"'][^\"']*\blabel\b[^>]*>(.*?)</[a-z]+>\s*<[a-z]+[^>]*class\s*=\s*[\"'][^\"']*\bdata\b[^>]*>(.*?)</[a-z]+>"),
    )
    return F.filter(every, lambda p: (p["label"] != "") & (p["value"] != ""))


def pair_table(pages: DataFrame, ids, html: str = "html") -> DataFrame:
    """N14/P2 as a long table (ids, pos, label, value)."""
    ids = [ids] if isinstance(ids, str) else list(ids)
    return pages.select(*ids, F.posexplode(row_pairs(html)).alias("pos", "p")).select(*ids, "pos", "p.label", "p.value")


def two_cell_text(html) -> Column:
    """Rows with exactly two cells as "label: value" lines."""
    rows = F.transform(contents(html, "tr"), lambda r: F.transform(inner_all(r, "td"), html_to_line))
    lines = F.transform(F.filter(rows, lambda c: F.size(c) == 2), lambda c: F.concat(c[0], F.lit(": "), c[1]))
    return blank_to_null(F.array_join(lines, "\n"))


def strong_value(html, label: str) -> Column:
    """Paragraph text after a bold label."""
    paras = F.filter(inner_all(html, "p"), lambda p: F.lower(F.coalesce(clean(inner(p, "strong")), F.lit(""))).contains(label.lower()))
    rest = F.transform(paras, lambda p: F.regexp_replace(html_to_line(F.regexp_replace(p, r"(?is)<strong\b[^>]*>.*?</strong\s*>", "")), r"^[:\s]+", ""))
    return F.get(F.filter(rest, lambda v: v != ""), F.lit(0))


# --- N15 sections ---------------------------------------------------------


def section_map(html, heading: str = "h[2-6]|summary|button") -> Column:
    """Heading text -> text below it, first heading of a name wins."""
    mark = rf"<(?:{heading})\b[^>]*>"
    blocks = cut_at(without_code(html), mark)
    entries = F.transform(
        blocks,
        lambda b: F.struct(
            F.upper(html_to_line(F.regexp_extract(b, rf"(?is)^<({heading})\b[^>]*>(.*?)</\1\s*>", 2))).alias("key"),
            html_to_line(F.regexp_extract(b, rf"(?is)^<({heading})\b[^>]*>.*?</\1\s*>(.*)$", 2)).alias("value"),
        ),
    )
    return map_first(F.filter(entries, lambda e: e["key"] != ""))


def bullet_facts(html) -> dict[str, Column]:
    """N15: "Key: value" bullets (key of 2-40 characters) become extras, the rest materials."""
    items = F.filter(F.transform(contents(html, "li"), html_to_line), lambda x: x != "")
    keyed = r"^([^:]{2,40}):\s*(.+)$"
    pairs = F.transform(F.filter(items, lambda x: x.rlike(keyed)), lambda x: F.struct(F.initcap(F.trim(F.regexp_extract(x, keyed, 1))).alias("key"), F.trim(F.regexp_extract(x, keyed, 2)).alias("value")))
    rest = F.filter(items, lambda x: ~x.rlike(keyed))
    return {"extras": map_last(pairs), "materials": blank_to_null(F.array_join(rest, " | "))}


# --- N16/N17 --------------------------------------------------------------

# Bold labels and the attribute they name.
BOLD_LABELS = {"BASE": "Base", "LUMENS": "Lumens", "TEMPERATURE": "Color Temp", "VOLTAGE": "Input Voltage", "WATTAGE": "Wattage", "ASSOCIATED COLLECTION": "Associated Collection"}


def bold_facts(html) -> dict[str, Column]:
    """Bold-label paragraphs to a map; paragraphs without one are the description."""
    paras = inner_all(html, "p")
    bold = r"(?is)<strong\b[^>]*>(.*?)</strong\s*>"
    names = F.create_map(*[F.lit(x) for kv in BOLD_LABELS.items() for x in kv])

    def entry(p):
        raw = F.upper(F.regexp_replace(html_to_line(F.regexp_extract(p, bold, 1)), r":+$", ""))
        return F.struct(F.coalesce(F.try_element_at(names, raw), F.initcap(raw)).alias("key"), html_to_line(F.regexp_replace(p, bold, "")).alias("value"))

    facts = F.transform(F.filter(paras, lambda p: p.rlike(bold)), entry)
    plain = F.filter(F.transform(F.filter(paras, lambda p: ~p.rlike(bold)), html_to_line), lambda x: x != "")
    return {"facts": map_last(facts), "description": blank_to_null(F.array_join(plain, " "))}


def technical_specs(html, max_chars: int | None = None) -> dict[str, Column]:
    """ALL-CAPS sections of the technical part of a page to lighting attributes; ``max_chars`` cuts mounting and shade."""
    text = page_lines(html)
    part = F.coalesce(
        grab(text, r"(?is)Technical Specs\s*(.*?)(?=\s*Downloads\b)"),
        grab(text, r"(?is)Technical Specs\s*(.*?)(?=\s*(?:Join the trade|Resources|More from))"),
    )
    s = caps_sections(part)

    def sec(*names):
        return F.coalesce(*[F.try_element_at(s, F.lit(n)) for n in names])

    def line(*names):
        return blank_to_null(squeeze(sec(*names)))

    def first(*names):
        return blank_to_null(F.trim(F.substring_index(sec(*names), "\n", 1)))

    def capped(c):
        return F.substring(c, 1, max_chars) if max_chars else c

    heights = sec("OVERALL HEIGHT")
    weight = sec("WEIGHT (CANOPY AND LIGHTS)", "WEIGHT (CANOPY & LIGHTS)", "WEIGHT")
    return {
        "dimension": F.coalesce(sec("DIMENSIONS"), sec("DIMENSIONS (LIGHTS)"), sec("DIMENSIONS (CANOPY)")),
        "lamping": F.replace(sec("LAMPING"), F.lit("\n"), F.lit(" | ")),
        "lumens": first("LUMENS"),
        "color_temp": first("COLOR TEMP", "COLOR TEMPERATURE"),
        "input_voltage": first("INPUT VOLTAGE", "VOLTAGE"),
        "mounting": capped(line("MOUNTING")),
        "cord_length": line("CORD LENGTH", "CORD"),
        "drop_rod": line("DROP ROD"),
        "oah_max": grab(heights, r"(?i)OAH\s*max[:\s]*([\d.]+)"),
        "oah_min": grab(heights, r"(?i)OAH\s*min[:\s]*([\d.]+)"),
        "weight": F.coalesce(grab(weight, r"(?i)([\d.]+)\s*(?:lbs?|pounds?)"), grab(weight, r"(\d+(?:\.\d+)?)")),
        "material": line("MATERIAL", "MATERIALS"),
        "canopy": line("CANOPY"),
        "socket": line("SOCKET", "SOCKET TYPE"),
        "wattage": F.coalesce(grab(sec("WATTAGE"), r"(?i)(\d+\s*W(?:att)?)"), line("WATTAGE")),
        "shade": capped(line("SHADE DIMENSIONS", "SHADE")),
        "backplate": line("BACKPLATE", "WALL PLATE"),
    }


def download_links(html) -> Column:
    """Map of link text -> href for spec documents."""
    anchors = grab_all(html, r"(?is)(<a\b[^>]*>.*?</a\s*>)")
    entries = F.transform(anchors, lambda a: F.struct(html_to_line(a).alias("key"), attribute(a, "href").alias("value")))
    wanted = F.filter(entries, lambda e: (e["key"] != "") & F.lower(e["value"]).rlike(r"\.(?:pdf|step|dwg|skp|rfa)"))
    return map_last(wanted)
