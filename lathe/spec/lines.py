"""Line and section reading (K60-K66, H7/H8/H11 inside one text, A10).

A text is one row, so its sections are cut inside the row: headings are
marked with one regex pass and the text is split at the marks. No shuffle,
no fold, and the whole text is read.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.html import contents
from ..functions.rx import as_col, blank_to_null, grab, let, like, lines_of, strip
from ..functions.text import drop_tags, html_to_line, squeeze, unwrap_quoted
from ..operators.filters import looks_feet, looks_inch
from ..operators.projection import widen

START, BODY = "\u0001", "\u0002"

# Labels whose value must be in inches, and those where feet will do.
DIMENSION_LABELS = (
    "Height",
    "O/A Height",
    "Overall Height",
    "Fixture Height",
    "Min. Custom Height",
    "Max Custom Height",
    "Min Custom Height",
    "Width",
    "Depth",
    "Extension",
    "Projection",
    "Diameter",
    "Overall",
    "Backplate",
    "Canopy",
    "Shade Details",
    "Shade",
    "Length",
    "Drop",
    "Backplate Width",
    "Backplate Height",
    "Backplate Depth",
    "Overall Width",
    "Overall Depth",
    "Overall Length",
    "Chain Length",
)
FEET_OK = ("Chain Length",)

# Spec labels and the standard column they fill.
LABEL_MAP = {
    "width": "Width",
    "w": "Width",
    "depth": "Depth",
    "d": "Depth",
    "height": "Height",
    "h": "Height",
    "length": "Length",
    "l": "Length",
    "diameter": "Diameter",
    "dia": "Diameter",
    "weight": "Weight",
    "wt": "Weight",
    "seat width": "Seat Width",
    "sw": "Seat Width",
    "seat depth": "Seat Depth",
    "sd": "Seat Depth",
    "seat height": "Seat Height",
    "sh": "Seat Height",
    "arm height": "Arm Height",
    "ah": "Arm Height",
    "arm width": "Arm Width",
    "aw": "Arm Width",
}
STANDARD_FIELDS = tuple(dict.fromkeys(LABEL_MAP.values()))

# Keys of a pipe list and the attribute they start; "_skip" ends a value.
PIPE_KEYS = {
    "Finish": ("finish", "general info", "general_info"),
    "Weight": ("weight", "max weight load", "max weight load lbs", "max_weight_load"),
    "Fabric": ("fabric", "fabric composition", "fabric_composition", "material composition"),
    "Wattage": ("wattage", "max wattage", "max_wattage"),
    "Socket": ("socket", "lamp holder", "lamp_holder", "lampholder"),
}

# Spec-sheet attributes and the key words that may carry them, in priority order.
SHEET_KEYS = {
    "material": ("MATERIAL", "BODY MATERIAL", "FRAME MATERIAL", "STRUCTURE"),
    "finish": ("FINISH", "COLOR", "COLOUR", "POWDER COAT"),
    "shade": ("SHADE", "DIFFUSER", "GLASS", "LENS", "GLOBE"),
    "bulb_type": ("BULB TYPE", "LAMP TYPE", "LIGHT SOURCE", "LAMP INCLUDED"),
    "country": ("COUNTRY", "ORIGIN", "MADE IN", "COUNTRY OF ORIGIN"),
    "listing_mark": ("UL", "ETL", "LISTED", "CERTIFICATION", "RATED FOR"),
    "collection": ("COLLECTION", "SERIES", "LINE"),
    "designer": ("DESIGNER", "DESIGNED BY", "ARCHITECT"),
}


def either(words) -> str:
    """Regex alternation, longest word first so that none hides another."""
    import re

    return "|".join(re.escape(w) for w in sorted(words, key=len, reverse=True))


def label_pairs(c) -> Column:
    """Array of (label, value) of "Label: value" lines; blank and self-naming values skipped.

    A rating table cell inside the text comes first.
    """
    t = unwrap_quoted(c)
    cell = squeeze(drop_tags(F.regexp_extract(t, r'(?is)<td[^>]*data-label-key="[^"]*"[^>]*>(\s*Rating:.*?)</td>', 1), ""))
    rated = F.when(cell != "", F.array(cell)).otherwise(F.array().cast("array<string>"))
    lines = F.concat(rated, F.filter(lines_of(t), lambda x: x.contains(":") & ~x.contains("data-label-key")))
    pairs = F.transform(lines, lambda x: F.struct(squeeze(F.substring_index(x, ":", 1)).alias("label"), squeeze(F.regexp_extract(x, r"(?s)^[^:]*:(.*)$", 1)).alias("value")))
    return F.filter(pairs, lambda p: (p["label"] != "") & (p["value"] != "") & (F.lower(p["label"]) != F.lower(p["value"])))


def label_table(df: DataFrame, ids, text_col: str) -> DataFrame:
    """K60 as a long table (ids, pos, label, value)."""
    ids = [ids] if isinstance(ids, str) else list(ids)
    return df.select(*ids, F.posexplode(label_pairs(text_col)).alias("pos", "p")).select(*ids, "pos", "p.label", "p.value")


def acceptable(label, value, dimension_labels=DIMENSION_LABELS, feet_ok=FEET_OK) -> Column:
    """May this value stand for this label? 0 = best, 1 = second choice, NULL = no."""
    label, value = as_col(label), as_col(value)
    sized = label.isin(*dimension_labels)
    return F.when(~sized, F.lit(0)).when(looks_inch(value), F.lit(0)).when(label.isin(*feet_ok) & looks_feet(value), F.lit(1))


def final_values(long: DataFrame, ids) -> DataFrame:
    """One value per (ids, label): inch values for dimensions, else the first."""
    ids = [ids] if isinstance(ids, str) else list(ids)
    ranked = long.withColumn("__rank", acceptable("label", "value")).filter(F.col("__rank").isNotNull())
    return ranked.groupBy(*ids, "label").agg(F.min_by("value", F.struct("__rank", "pos")).alias("value"))


def standard_attributes(long: DataFrame, ids) -> DataFrame:
    """Labels to the 11 standard columns, last one wins."""
    m = F.create_map(*[F.lit(x) for kv in LABEL_MAP.items() for x in kv])
    mapped = long.withColumn("__t", F.try_element_at(m, F.lower(F.trim("label")))).filter(F.col("__t").isNotNull())
    return widen(mapped, ids, "__t", "value", list(STANDARD_FIELDS), "pos", last=True)


def table_attributes(pages: DataFrame, ids, html: str) -> DataFrame:
    """K62 for tables: the first two cells of each row are label and value; rows of one cell go, an empty value counts."""
    ids = [ids] if isinstance(ids, str) else list(ids)
    rows = F.transform(contents(html, "tr"), lambda r: F.transform(contents(r, "(?:td|th)"), lambda c: squeeze(html_to_line(c))))
    pairs = F.transform(F.filter(rows, lambda c: F.size(c) >= 2), lambda c: F.struct(c[0].alias("label"), c[1].alias("value")))
    return standard_attributes(pages.select(*ids, F.posexplode(pairs).alias("pos", "p")).select(*ids, "pos", "p.label", "p.value"), ids)


def marked_blocks(c, mark: str) -> Column:
    """Array of (name, body): the text cut where ``mark`` matches; group 1 is the name."""
    cut = F.regexp_replace(as_col(c), mark, START + "$1" + BODY)
    blocks = F.filter(F.split(cut, START), lambda b: b.contains(BODY))
    return F.transform(blocks, lambda b: F.struct(F.lower(squeeze(F.substring_index(b, BODY, 1))).alias("name"), F.substring_index(b, BODY, -1).alias("body")))


def section_text(body) -> Column:
    """Inline text and the lines below it, as one text."""
    body = as_col(body)
    inline = strip(F.substring_index(body, "\n", 1))
    below = F.when(body.contains("\n"), strip(F.regexp_extract(body, r"(?s)^[^\n]*\n(.*)$", 1)))
    return F.concat_ws("\n", blank_to_null(inline), blank_to_null(below))


def sections(c, headings) -> dict[str, Column]:
    """Heading -> text; a repeated heading keeps its last text."""
    blocks = marked_blocks(c, rf"(?im)^[ \t]*({either(headings)})[ \t]*:?[ \t]*")
    out = {}
    for h in headings:
        mine = F.filter(blocks, lambda b: b["name"] == h.lower())
        out[h] = blank_to_null(section_text(F.try_element_at(mine, F.lit(-1))["body"]))
    return out


def caps_sections(c) -> Column:
    """Map of ALL-CAPS header -> text; a header glued to its number is split from it."""
    glued = F.regexp_replace(as_col(c), r"(?m)^([A-Z][A-Z \t()/&]+?)[ \t]*(?=\d)", "$1\n")
    blocks = marked_blocks(glued, r"(?m)^[ \t]*([A-Z][A-Z \t()/&]+)[ \t]*$\n?")
    entries = F.transform(blocks, lambda b: F.struct(F.upper(b["name"]).alias("key"), strip(b["body"]).alias("value")))
    return map_last(entries)


def map_first(entries) -> Column:
    """Map of (key, value) entries, first value per key."""

    def firsts(e):
        return let(F.transform(e, lambda x: x["key"]), lambda keys: F.filter(e, lambda x, i: F.array_position(keys, x["key"]) == i + 1))

    return F.map_from_entries(let(entries, firsts))


def map_last(entries) -> Column:
    return map_first(F.reverse(as_col(entries)))


def pipe_attributes(c) -> dict[str, Column]:
    """Attributes of a pipe list; unknown parts continue a value, boundary keys end it."""
    from ..functions.text import BOUNDARY_KEYS
    from .attrs import PIPE_CLEANERS

    known = [w for words in PIPE_KEYS.values() for w in words]
    mark = rf"(?i)(?:^|\|)\s*({either([*known, *BOUNDARY_KEYS])})\s*:\s*"
    blocks = marked_blocks(c, mark)
    out = {}
    for target, words in PIPE_KEYS.items():
        bodies = F.transform(F.filter(blocks, lambda b: b["name"].isin(*words)), lambda b: F.regexp_replace(strip(b["body"]), r"^\|\s*|\s*\|$", ""))
        cleaned = F.transform(bodies, lambda b: PIPE_CLEANERS[target](b))
        out[target] = F.try_element_at(F.filter(cleaned, lambda v: v.isNotNull() & (v != "")), F.lit(-1))
    return out


def block_after(c, label: str, known_labels) -> Column:
    """Text on the label's line, else the lines below it up to the next known label."""

    def below_of(below):
        stop = F.array_position(F.transform(below, like(rf"(?i)^(?:{either(known_labels)}):?$")), True)
        return let(stop, lambda at: F.when(at > 0, F.slice(below, F.lit(1), (at - 1).cast("int"))).otherwise(below))

    def read(lines, at):
        own = F.trim(F.regexp_replace(F.get(lines, (at - 1).cast("int")), rf"(?i)^{either([label])}\s*:?\s*", ""))
        below = F.slice(lines, (at + 1).cast("int"), F.greatest(F.size(lines) - at, F.lit(0)).cast("int"))
        text = let(own, lambda o: F.when(o != "", o).otherwise(F.array_join(let(below, below_of), " ")))
        return F.when(at > 0, let(text, blank_to_null))

    def found(lines):
        opens = F.transform(lines, like(rf"(?i)^{either([label])}(?:\s*:|\s|$)"))
        return let(F.array_position(opens, True), lambda at: read(lines, at))

    return let(lines_of(c), found)


def block_lines(c, label: str, known_labels) -> Column:
    """K65, multi-line form: inline value and all lines until a known label, newline-joined."""
    known = F.lower(F.lit(label))
    blocks = marked_blocks(c, rf"(?im)^[ \t]*({either([label, *known_labels])})[ \t]*(?::[ \t]*|$)")
    first = F.get(F.filter(blocks, lambda b: b["name"] == known), F.lit(0))
    return blank_to_null(F.array_join(lines_of(first["body"]), "\n"))


def line_after(c, keyword: str, digit: bool = False) -> Column:
    """H8: first line after the keyword's line, optionally one with a digit."""

    def read(lines, at):
        below = F.slice(lines, (at + 1).cast("int"), F.greatest(F.size(lines) - at, F.lit(0)).cast("int"))
        if digit:
            below = F.filter(below, like(r"\d"))
        return F.when(at > 0, F.get(below, F.lit(0)))

    def found(lines):
        return let(F.array_position(F.transform(lines, lambda x: F.lower(x).contains(keyword.lower())), True), lambda at: read(lines, at))

    return let(lines_of(c), found)


def sheet_attributes(c, raw_chars: int | None = None) -> dict[str, Column]:
    """A10: spec-sheet attributes; keys match as substrings in priority order.

    A repeated key keeps its first place and its last value.
    """
    lines = F.filter(lines_of(c), lambda x: x.contains(":"))
    pairs = F.transform(lines, lambda x: F.struct(F.upper(F.trim(F.substring_index(x, ":", 1))).alias("key"), F.trim(F.regexp_extract(x, r"(?s)^[^:]*:(.*)$", 1)).alias("value")))
    pairs = F.filter(pairs, lambda p: (p["key"] != "") & (p["value"] != ""))

    def hit(pairs, word):
        key = F.get(F.filter(pairs, lambda p: p["key"].contains(word)), F.lit(0))["key"]
        return let(key, lambda k: F.try_element_at(F.filter(pairs, lambda p: p["key"] == k), F.lit(-1))["value"])

    # One struct of all attributes: the lines are cut once, whatever is read from it.
    found = let(pairs, lambda ps: F.struct(*[F.coalesce(*[hit(ps, w) for w in words]).alias(target) for target, words in SHEET_KEYS.items()]))
    out = {target: found[target] for target in SHEET_KEYS}
    raw = F.substring(as_col(c), 1, raw_chars) if raw_chars else as_col(c)
    out["raw_text"] = F.replace(raw, F.lit("\n"), F.lit(" | "))
    return out


def ordered_line_rules(c) -> dict[str, Column]:
    """One catalogue's spec block, read line by line by ordered rules."""
    lines = F.transform(lines_of(c), squeeze)
    # Which line a rule owns, in order.
    owners = {
        "weight": r"(?i)^(?=.*weight)(?=.*\(lb)",
        "dimension": r"(?i)^(?=.*dimension)(?=.*\(in)",
        "seat_height": r"(?i)^(?=.*seat height)(?=.*\(in)",
        "seat_depth": r"(?i)^(?=.*seat depth)(?=.*\(in)",
        "arm_height": r"(?i)^(?=.*arm height)(?=.*\(in)",
        "cushion_count": r"(?i)number of cushions",
        "cushion_type": r"(?i)standard cushion",
        "construction": r"(?i)kd construction",
        "content": r"(?i)^content",
        "color": r"(?i)^color",
    }

    def owner(line):
        first = F.lit(None).cast("string")
        for name, p in reversed(owners.items()):
            first = F.when(like(p)(line), F.lit(name)).otherwise(first)
        return F.struct(first.alias("owner"), line.alias("line"))

    def picked(owned):
        """The line each rule reads: its first one, of the cushion rules the last."""
        mine = {name: F.filter(owned, lambda o: o["owner"] == name) for name in owners}
        return F.struct(*[F.try_element_at(m, F.lit(-1 if name.startswith("cushion") else 1))["line"].alias(name) for name, m in mine.items()])

    def read(pick):
        def after(name, word):
            line = pick[name]
            return blank_to_null(F.trim(F.coalesce(grab(line, r"(?s):(.*)$"), F.regexp_replace(line, f"(?i){word}", ""))))

        out = {
            "weight": grab(pick["weight"], r"(?i)weight\s*\(lb\).*?([0-9]+(?:\.[0-9]+)?)"),
            "dimension": F.regexp_replace(F.translate(after("dimension", r"dimensions?\s*\(in\)\s*"), "”“", '""'), r'\s*"$', ""),
            "construction": after("construction", "kd construction"),
            "content": after("content", "content"),
            "color": after("color", "color"),
        }
        for f in ("seat_height", "seat_depth", "arm_height"):
            out[f] = grab(pick[f], r"(\d+(?:\.\d+)?)")
        count = F.coalesce(grab(pick["cushion_count"], r"(\d+)"), F.trim(grab(pick["cushion_count"], r"(?s):(.*)$")))
        out["cushion"] = blank_to_null(F.concat_ws(", ", count, after("cushion_type", "standard cushion")))
        return F.struct(*[v.alias(f) for f, v in out.items()])

    # Each line is looked at once; all fields come from one struct.
    found = let(let(F.transform(lines, owner), picked), read)
    fields = ("weight", "dimension", "construction", "content", "color", "seat_height", "seat_depth", "arm_height", "cushion")
    return {f: found[f] for f in fields}
