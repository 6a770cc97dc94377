"""Text cleaning."""

import json
from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

from .rx import as_col, blank_to_null, grab, lines_of, present, strip, sub

# Section words that end a product description, in the order they are tried.
STOP_MARKERS = (
    "dimensions",
    "specifications",
    "materials",
    "shipping",
    "delivery",
    "return policy",
    "care instructions",
)

# Keys that end a pipe-separated attribute value.
BOUNDARY_KEYS = (
    "extra info",
    "lamp holder qty",
    "lamp holder quantity",
    "light bulbs included",
    "light bulbs",
    "bulbs included",
    "voltage",
    "plug type",
    "fabric composition shade",
    "shade dimensions",
    "shade dimension",
    "indoor/outdoor",
    "indoor outdoor",
    "dimmable",
    "ip rating",
    "cord length",
    "cable length",
    "switch type",
    "switch",
    "power source",
    "color temperature",
    "colour temperature",
    "number of lights",
    "number of light sources",
    "max wattage",
    "max weight load",
    "max weight load kg",
    "light source included",
)

#: Named references: those of HTML 4, and the apostrophe; a hard blank is read as a blank.
ENTITIES = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'", "nbsp": " "}

SKU_TOKEN = r"\b[A-Z0-9]++(?:-[A-Z0-9]++)+\b"


def squeeze(c) -> Column:
    """K1: every run of Unicode blanks (NBSP too) becomes one space."""
    return F.trim(F.regexp_replace(as_col(c), r"(?U)\s+", " "))


def squeeze_keep_lines(c) -> Column:
    """K2: squeeze blanks inside lines, keep single newlines."""
    c = sub(c, r"\r\n?", "\n")
    c = sub(c, r"[ \t\x{00A0}]+", " ")
    return strip(sub(c, r" *\n[ \n]*", "\n"))


def drop_controls(c, replacement: str = "") -> Column:
    """K3: control characters removed, or turned into ``replacement``."""
    return F.trim(sub(c, r"[\x00-\x1f\x7f]", replacement))


def plain_words(c) -> Column:
    """K4: lower case, ASCII punctuation removed, blanks squeezed."""
    return squeeze(sub(F.lower(as_col(c)), r"\p{Punct}", ""))


def decode_entities(c) -> Column:
    """Named (HTML 4) and all numeric references, natively and in one pass; others stay as they are.

    The text is cut at "&" and each part decoded; the input expression is used once.
    """
    named = F.from_json(F.lit(json.dumps(ENTITIES)), "map<string,string>")

    def letter(code):
        bad = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
        return F.when(bad, "\ufffd").otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))

    def reference(p):
        decimal = F.regexp_extract(p, r"^#([0-9]{1,7});", 1).try_cast("int")
        hexadecimal = F.conv(F.nullif(F.regexp_extract(p, r"^#[xX]([0-9A-Fa-f]{1,6});", 1), F.lit("")), 16, 10).cast("int")
        numeric = F.get(F.transform(F.array(F.coalesce(decimal, hexadecimal)), letter), F.lit(0))
        return F.coalesce(numeric, F.try_element_at(named, F.regexp_extract(p, r"^([A-Za-z][A-Za-z0-9]{1,8});", 1)))

    def part(p, i):
        rest = F.substring(p, F.instr(p, ";") + 1, F.length(p))
        return F.when(i == 0, p).otherwise(F.coalesce(F.concat(reference(p), rest), F.concat(F.lit("&"), p)))

    return F.array_join(F.transform(F.split(as_col(c), "&"), part), "")


def decode_entities_full(c) -> Column:
    """Every HTML reference; one Arrow batch function for what the native chain cannot finish."""

    def unescape(s):
        import html

        return s.map(html.unescape, na_action="ignore")

    return F.pandas_udf(unescape, "string")(as_col(c))


def drop_tags(c, replacement: str = " ") -> Column:
    return sub(c, r"<[^>]+>", replacement)


def html_to_text(c) -> Column:
    """K5: line breaks and list items survive, other tags vanish, at most one blank line."""
    c = sub(c, r"(?i)<br\s*/?>", "\n")
    c = sub(c, r"(?i)<li[^>]*>", "- ")
    c = sub(c, r"(?i)</(?:p|div|li|tr|h[1-6])>", "\n")
    c = decode_entities(drop_tags(c, ""))
    return strip(sub(c, r"\n{3,}", "\n\n"))


def html_to_line(c) -> Column:
    """K5, flat form: tags become spaces."""
    return squeeze(decode_entities(drop_tags(c, " ")))


def description_until_marker(c, max_chars: int | None = None) -> Column:
    """K6: cut at the first listed marker that starts after position 50, and after ``max_chars`` if given.

    The order of STOP_MARKERS decides, not the position in the text.
    """
    c = as_col(c)
    low = F.lower(c)
    cuts = [F.when(F.locate(m, low) > 51, F.substring(c, F.lit(1), F.locate(m, low) - 1)) for m in STOP_MARKERS]
    whole = squeeze(F.coalesce(*cuts, c))
    return F.substring(whole, 1, max_chars) if max_chars else whole


def plain_quotes(c) -> Column:
    """K7: curly, prime and mis-decoded inch and foot marks become ASCII."""
    c = F.replace(as_col(c), F.lit("â€³"), F.lit('"'))
    c = F.replace(c, F.lit("Ã—"), F.lit("x"))
    c = sub(c, r'â\s*"', '"')
    c = F.translate(c, "″“”ʺ＂〝〞′‘’", '"""""""\'\'\'')
    return F.replace(F.replace(c, F.lit("''"), F.lit('"')), F.lit('""'), F.lit('"'))


def unwrap_quoted(c) -> Column:
    """K7, cell form: one enclosing pair of quotes dropped, doubled quotes halved, lines unified."""
    c = as_col(c)
    inner = F.when(c.rlike(r'(?s)^".*"$'), F.substring(c, F.lit(2), F.length(c) - 2)).otherwise(c)
    return strip(sub(F.replace(inner, F.lit('""'), F.lit('"')), r"\r\n?", "\n"))


def ascii_digits(c) -> Column:
    """K8: Bengali digits to ASCII."""
    return F.translate(as_col(c), "০১২৩৪৫৬৭৮৯", "0123456789")


def drop_parentheses(c) -> Column:
    return sub(c, r"\s*\([^)]*\)", "")


def drop_size_prefix(c) -> Column:
    return sub(c, r"(?im)^\s*(?:Large|Small|Medium|XL|X-Large)\s*[-–]\s*", "")


def first_size_block(c) -> Column:
    parts = F.split(as_col(c), r"(?i)\n\s*(?:Other Standard Sizes|[23456]\s*Seat\s*[-–])\s*", 2)
    return F.get(parts, F.lit(0))


def cut_at_boundary(c, keys=BOUNDARY_KEYS) -> Column:
    """Keep the parts of a pipe list that stand before the first boundary key."""
    parts = F.split(F.trim(as_col(c)), r" \| ")
    is_stop = F.transform(
        parts,
        lambda p: p.contains(":") & F.lower(F.trim(F.substring_index(p, ":", 1))).isin(*keys),
    )
    stop = F.array_position(is_stop, True)
    kept = F.when(stop > 0, F.slice(parts, 1, (stop - 1).cast("int"))).otherwise(parts)
    return F.array_join(kept, " | ")


def name_from_title(c) -> Column:
    """The part before " - ", or NULL where the title has none."""
    c = as_col(c)
    return F.when(c.contains(" - "), F.trim(F.substring_index(c, " - ", 1)))


def name_without_skus(c) -> Column:
    """SKU tokens removed; NULL when no letter is left."""
    rest = squeeze(sub(c, SKU_TOKEN, " "))
    return F.when(rest.rlike("[A-Za-z]"), rest)


def name_line(c) -> Column:
    """K12, block form: first line that is neither a SKU line nor one bare code."""
    keep = F.filter(
        F.transform(lines_of(c), squeeze),
        lambda x: ~x.rlike(r"(?i)\bsku\b") & ~x.rlike(r"^[A-Z0-9\-_/]{3,}$"),
    )
    return F.get(keep, F.lit(0))


def polyester_share(c) -> Column:
    """The vectorised extract."""
    return grab(c, r"(\d+%\s*Polyester)")


def zero_to_null(c) -> Column:
    """Opt-in blanking of numeric zero on top of the null rule."""
    v = present(c)
    return F.when(~v.isin("0", "0.0"), v)


def cap(c, n: int) -> Column:
    return F.substring(as_col(c), 1, n)


def clean_label(c) -> Column:
    """Lower case, colons dropped, blanks squeezed."""
    return squeeze(F.replace(F.lower(as_col(c)), F.lit(":"), F.lit("")))


def first_paragraph(paragraphs) -> Column:
    """First paragraph that talks of neither finish nor size."""
    keep = F.filter(as_col(paragraphs), lambda p: ~F.lower(p).rlike("finish|dimension|overall"))
    return F.get(keep, F.lit(0))


def description_lines(html) -> Column:
    """Description lines that name no measure, joined by a space."""
    parts = F.transform(F.split(as_col(html), r"(?i)<br\s*/?>|</p>"), lambda x: html_to_line(x))
    keep = F.filter(parts, lambda x: (x != "") & ~F.lower(x).rlike("height|width|depth|weight|diameter"))
    return blank_to_null(F.array_join(keep, " "))
