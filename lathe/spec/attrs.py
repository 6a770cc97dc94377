"""Attributes read from spec text (K68-K77): seats, weight, yardage, lighting, finish, rugs.

Each reader is one native expression; patterns are fixed values of the
notations they read.
"""

from pyspark.sql import Column, functions as F

from ..functions.numbers import NUM, fraction_text, number_or_raw, number_text, whole_number_text
from ..functions.rx import as_col, blank_to_null, first_of, grab, grab_all, has, let, like, lines_of, present, sub
from ..functions.text import html_to_line, squeeze
from .lines import block_after, line_after, map_first, map_last

N = rf"({NUM})"

# Measure names beyond the standard columns.
SUBFIELD_WORDS = (
    "Seat Depth",
    "Seat Height",
    "Seat Width",
    "Arm Height",
    "Arm Width",
    "Arm Depth",
    "Width Between Arms",
    "Interior Depth",
    "Interior Width",
    "Exterior Depth",
    "Exterior Width",
    "Back Height",
    "Back Width",
    "Base Height",
    "Leg Height",
    "Leg Diameter",
    "Leg Dia",
    "Top Thickness",
    "Top Thick",
    "Thickness",
    "Height to Apron",
    "Clearance",
    "Footrest Height",
    "Footrest",
    "Stretcher Height",
    "Cushion Height",
    "Cushion Depth",
    "Rail Height",
    "Spring Height",
)

# Labels that end a measure block.
MEASURE_LABELS = (
    "overall",
    "item weight",
    "cord",
    "canopy",
    "shade",
    "shade details",
    "shade top",
    "shade bottom",
    "shade height",
    "seat height",
    "seat width",
    "seat depth",
    "arm height",
    "arm width",
    "arm length",
)


# --- K68 seats and arms ---------------------------------------------------

ABBREVIATIONS = {"seat_width": "SW", "seat_depth": "SD", "seat_height": "SH", "arm_height": "AH", "arm_width": "AW"}


def seat_by_abbreviation(c, field: str) -> Column:
    """``19.3" SW``, ``SW 19.3``: the value may stand on either side."""
    a = ABBREVIATIONS[field]
    return F.coalesce(grab(c, rf"(?i)([\d.]+)\s*[\"'″]?\s*(?:in)?\s*{a}(?![a-zA-Z])"), grab(c, rf"(?i)(?<![a-zA-Z]){a}\s*[:.]?\s*{N}"))


def seat_by_letters(c) -> dict[str, Column]:
    """Seat line ``H 18 D 20 W 22``; the last one of a letter wins."""
    toks = grab_all(F.upper(as_col(c)), r"([HDW]\s*\d+\.?\d*)")
    return {f: grab(F.try_element_at(F.filter(toks, like(f"^{a}")), F.lit(-1)), r"(\d+\.?\d*)") for f, a in (("seat_height", "H"), ("seat_depth", "D"), ("seat_width", "W"))}


def labelled_measure(c, label: str) -> Column:
    """``Seat Height: 18`` and friends."""
    words = label.replace(" ", r"\s+")
    return grab(c, rf"(?i){words}[:\s]*{N}")


def measure_map(c) -> Column:
    """Map of every named measure in the text, title case, first value wins."""
    words = "|".join(w.replace(" ", r"\s*") for w in SUBFIELD_WORDS)
    toks = grab_all(c, rf"(?i)((?:{words})\s*:?\s*{NUM})")
    entries = F.transform(toks, lambda t: F.struct(F.initcap(squeeze(F.regexp_extract(t, r"(?s)^([^\d:]*)", 1))).alias("key"), whole_number_text(F.regexp_extract(t, rf"{N}$", 1)).alias("value")))
    return map_first(entries)


def seat_size(c) -> dict[str, Column]:
    """``Seat Size: a x b``."""
    p = rf"(?i)Seat Size[^:|]*:\s*{N}\s*[*xX×]\s*{N}"
    return {"seat_width": grab(c, p, 1), "seat_depth": grab(c, p, 2)}


# --- K69 weight -----------------------------------------------------------


def weight_lb_only(c) -> Column:
    """Pounds preferred; a value in kg alone is dropped."""
    c = F.trim(as_col(c))
    metric = has(c, r"(?i)\bKG\b") & ~has(c, r"(?i)\bLBS\b")
    return F.when(~metric, F.coalesce(grab(c, r"(?i)LBS\s*:\s*([\d.]+)"), grab(c, r"(?i)([\d.]+)\s*lbs"), grab(c, r"([\d.]+)"), blank_to_null(c)))


def weight_lb_or_number(c) -> Column:
    return F.coalesce(grab(c, r"(?i)([\d.]+)\s*(?:lbs?\.?|pounds?)"), grab(c, r"([\d.]+)"))


def weight_lb_strict(c) -> Column:
    """First amount in pounds: "312 lbs (390 lbs packed)" is 312."""
    return grab(c, r"(?i)(\d+\.?\d*)\s*lbs?")


def weight_of_product(c) -> Column:
    """Product weight line decides, even when it names no pounds."""
    line = grab(c, r"(?i)(?:Total\s+)?Product\s*weight\*?\s*:\s*([^\n]+)")
    return F.when(line.isNotNull(), grab(line, r"(?i)([\d.]+)\s*lbs")).otherwise(grab(c, r"(?i)weight\*?\s*:\s*([\d.]+)\s*lbs"))


def weight_with_unit(c) -> Column:
    """"52 lb"; the misspelt unit "ib" counts as lb."""
    t = squeeze(c)
    hit = F.coalesce(grab(t, rf"(?i)\bWeight\b\s*[:\-]?\s*({NUM}\s*(?:lbs|lb|ib)\b)"), grab(t, rf"(?i)\b({NUM}\s*(?:lbs|lb|ib)\b)"))
    unit = F.lower(grab(hit, "(?i)([a-z]+)$"))
    return F.concat(grab(hit, N), F.lit(" "), F.when(unit == "ib", "lb").otherwise(unit))


def weight_any_unit(c) -> Column:
    t = squeeze(c)
    p = rf"(?i)\b{N}\s*(lbs|lb|kg)\b"
    return F.concat(grab(t, p, 1), F.lit(" "), F.lower(grab(t, p, 2)))


def weight_in_pipe_part(c) -> Column:
    return grab(grab(c, r"(?i)(Weight[^|]*)"), N)


def weight_without_unit(c) -> Column:
    return blank_to_null(squeeze(sub(c, r"(?i)\b(?:lbs|lb|ib)\b", "")))


def weight_number_or_raw(c) -> Column:
    return number_or_raw(c)


def weight_item_or_fixture(c) -> Column:
    return F.coalesce(grab(c, rf"(?i)(?:item\s*)?weight\s*[:\-\s]*{N}"), grab(c, rf"(?i)\bfixture\s*weight\b[^0-9]*{N}"))


def mentions_weight(c) -> Column:
    return has(c, r"(?i)\b(?:lbs|lb|ibs|ib|kg|kgs)\b")


def weight_by_kind(c) -> Column:
    """Net, else carton, else gross."""
    kinds = [sub(grab(c, rf"(?im){k} weight[^:\n]*:\s*([^\n]*?)\s*$"), r"(?i)\s*[li]b\s*$", "") for k in ("net", "carton", "gross")]
    return F.coalesce(*kinds)


# --- K70 yardage ----------------------------------------------------------


def com_col(c) -> dict[str, Column]:
    """COM yards and COL square feet in any of the three written forms; cushion counts."""
    c = as_col(c)
    both = r"(?i)COM\s*/\s*COL\s*\w*\s*[:\-]\s*([\d.]+)\s*yds?\s*/\s*([\d.]+)"
    com_part = grab(c, r"(?is)COM\b\s*\w*\s*[:\-]?(.*?)(?=\bCOL\b|\z)")
    col_part = grab(c, r"(?is)COL\b(?:\s*\w+\s*[:\-])?\s*(.*)")
    return {
        "com": F.when(has(c, both), grab(c, both, 1)).otherwise(grab(com_part, r"(?i)([\d.]+)\s*yds?")),
        "col": F.when(has(c, both), grab(c, both, 2)).otherwise(grab(col_part, r"(?i)([\d.]+)\s*sq\s*ft")),
        "cushion": blank_to_null(F.array_join(grab_all(c, r"(?i)(\d+)\s+\w+\s+Cushion"), ",")),
    }


def com_col_cot(c) -> dict[str, Column]:
    """``COM 4 Yds COL 72 Sq Ft COT 8.5 Yds``."""
    return {k.lower(): number_text(grab(c, rf"(?i)\b{k}\s*[:\s]\s*{N}"), 4) for k in ("COM", "COL", "COT")}


def upholstery(c) -> dict[str, Column]:
    """``COM: … COL: … CUSHION: …`` in any order."""
    t = squeeze(c)
    part = {k: grab(t, rf"(?i)\b{k}\s*:\s*(.+?)(?=\s*\b(?:COM|COL|CUSHION)\s*:|$)") for k in ("COM", "COL", "CUSHION")}
    return {"com": grab(part["COM"], N), "col": grab(part["COL"], N), "cushion": squeeze(part["CUSHION"])}


def com_lines(html) -> dict[str, Column]:
    """First line starts with yards, first ``sqft`` amount is leather."""
    lines = lines_of(sub(sub(html, r"(?i)<br\s*/?>", "\n"), "<[^>]+>", ""))
    return {"com": grab(F.get(lines, F.lit(0)), r"^([\d.]+)"), "col": grab(F.get(F.filter(lines, like(r"(?i)[\d.]+\s*sqft")), F.lit(0)), r"(?i)([\d.]+)\s*sqft")}


def com_line_text(c) -> Column:
    """Text after a line's COM:, else after any COM."""
    return F.trim(F.coalesce(grab(c, r"(?im)^[ \t]*COM:([^\n]*)"), grab(c, r"(?i)\bCOM\b\s*[:\-]?\s*([^\n]+)")))


def com_near_yards(c) -> Column:
    return grab(squeeze(c), rf"(?i)\bCOM\b[^0-9]{{0,15}}{N}\s*(?:yds|yd)\b")


def com_or_requirement(c) -> dict[str, Column]:
    t = squeeze(c)
    return {"com": grab(t, rf"(?i)(?:\bCOM\b[^0-9]*|Upholstery Requirements[^0-9]*){N}"), "col": grab(t, rf"(?i)\bCOL\b[^0-9]*{N}")}


def base_block(dimensions, specs) -> Column:
    t = F.concat_ws(" | ", present(dimensions), present(specs))
    return F.trim(grab(t, r"(?i)(Base[^|]+)"))


# --- K71 lighting ---------------------------------------------------------


def semicolon_details(c) -> dict[str, Column]:
    """Cushion, seat, socket and wattage of a ``;`` separated detail text."""
    out = {k: F.trim(grab(c, rf"(?i){w}[^:]*:\s*([^;]+)")) for k, w in (("cushion", "Cushion"), ("seat_depth", r"Seat\s*Depth"), ("seat_width", r"Seat\s*Width"), ("seat_height", r"Seat\s*Height"))}
    out["socket"] = F.trim(F.coalesce(grab(c, r"(?i)(?<![A-Za-z])([A-Za-z]++\s*-?\s*\d+\s*Socket)"), grab(c, r"(?i)Socket[^:]*:\s*([^;/]+)")))
    out["wattage"] = F.concat(grab(c, r"(?i)(\d+)\s*(?:Max\s*)?(?:Wattage|Watts|Watt|W)\b"), F.lit(" Max Wattage"))
    return out


def electrical(c) -> dict[str, Column]:
    """``1 x E26 40W - 75W Max - LED``: socket before the first watts, wattage up to LED."""
    t = sub(F.trim(as_col(c)), r"(?i)^\d+\s*x\s*", "")
    watts = grab(t, r"(?is)(\d+\.?\d*W.*)$")
    to_led = grab(watts, r"(?is)^(.*?)\s*-?\s*LED\b")
    return {"socket": blank_to_null(F.trim(grab(t, r"(?is)^(.*?)\d+\.?\d*W"))), "wattage": F.trim(F.coalesce(to_led, grab(watts, r"(?i)^(\d+\.?\d*W)")))}


def pipe_socket_wattage(c) -> dict[str, Column]:
    parts = F.transform(F.split(as_col(c), r"\|"), lambda p: F.trim(p))
    sockets = F.transform(
        parts,
        lambda p: F.when(p.rlike(r"(?i)E\d+(?:/\d+)?\s*BASE"), p)
        .when(p.rlike(r"(?i)E\d+(?:/\d+)?\s*SOCKET"), F.regexp_extract(p, r"(?i)(E\d+(?:/\d+)?)", 1))
        .when(p.rlike(r"(?i)G[\d.]+\s*BULBS?"), p),
    )

    def first(pattern):
        hits = F.transform(parts, lambda p: F.regexp_extract(p, pattern, 1))
        return F.trim(F.get(F.filter(hits, lambda h: h != ""), F.lit(0)))

    return {
        "socket": blank_to_null(F.array_join(F.filter(sockets, lambda s: s.isNotNull()), ", ")),
        "wattage": F.coalesce(first(r"(?i)(\d+\s*X\s*\d+\s*W?)\b"), first(r"(?i)\b(\d+\s*W)\b")),
    }


def socket_code(c) -> Column:
    code = r"\b([EG](?:U)?\d+[a-z]?)\b"
    return F.coalesce(
        grab(grab(c, r"(?i)Light\s*source\s*:\s*([^\n]+)"), f"(?i){code}"),
        grab(grab(c, r"(?i)Lamping\s*:\s*([^\n]+)"), f"(?i){code}"),
        grab(c, rf"(?i){code}\s+(?:medium\s+|candelabra\s+|bi-?pin\s+)?base"),
    )


def socket_type_count(c) -> Column:
    kind = sub(grab(c, r"(?i)\bsocket\s*type(?:/integrated\s*led)?\s*:\s*([A-Za-z0-9\-_/]+)"), ",+$", "")
    return blank_to_null(F.concat_ws(", ", kind, grab(c, r"(?i)\bnumber\s*of\s*sockets\s*:\s*([0-9]+)")))


def max_wattage_line(c) -> Column:
    w = F.coalesce(grab(c, rf"(?i)\bmax\.?\s*wattage\s*(?:per\s*socket)?\s*:\s*{N}\s*W\b"), grab(c, rf"(?i)\bmax\s*wattage\b[^0-9]*{N}\s*W\b"))
    e = grab(c, rf"(?i)\benergy\s*efficiency\s*:\s*{N}\s*CFM\s*/\s*Watt\b")
    return blank_to_null(F.concat_ws(", ", F.concat(w, F.lit("W")), F.concat(e, F.lit(" CFM/Watt"))))


def clean_wattage(v) -> Column:
    t = F.trim(sub(F.trim(as_col(v)), r"(?i)^max\s*wattage\s*:\s*", ""))
    return F.coalesce(F.concat(grab(t, r"(?i)([\d.]+)\s*(?:watt|w)\b"), F.lit(" Watt")), t)


def clean_socket(v) -> Column:
    return F.trim(sub(F.trim(as_col(v)), r"(?i)^lamp\s*holder\s*:\s*", ""))


def watts_max(c) -> Column:
    t = squeeze(c)
    return F.coalesce(grab(t, rf"(?i)\b{N}\s*w\s*max\b"), grab(t, rf"(?i)\bw\s*max\s*{N}\b"))


def max_wattage_label(c) -> Column:
    return grab(c, r"(?i)Max Wattage:\s*(\d+W)")


def lighting_lines(c) -> dict[str, Column]:
    """Label line, value line."""
    return {
        "finish": line_after(c, "Finish"),
        "color_temperature": line_after(c, "Color Temperature", digit=True),
        "socket_type": F.coalesce(line_after(c, "Socket Type"), line_after(c, "Socket")),
        "wattage": F.coalesce(line_after(c, "Watts per Socket/Item", digit=True), line_after(c, "Wattage", digit=True)),
    }


def illumination(c) -> dict[str, Column]:
    bases = F.array_join(F.filter(F.array(*[F.when(has(c, rf"(?i)\b{b}\b"), F.lit(b)) for b in ("LED", "GU10", "MR16")]), lambda b: b.isNotNull()), ", ")
    return {"wattage": grab(c, rf"(?i){N}\s*w"), "color_temperature": grab(c, r"(\d{3,5})\s*K"), "base": blank_to_null(bases)}


# --- K72 shade ------------------------------------------------------------


def shade_phrase(c) -> Column:
    t = grab(squeeze(c), r"(?i)(?:round\s+silk|silk|oval|rectangular)?\s*shade,?\s*(.+)")
    t = sub(t, r"(?i),?\s*(?:white|oyster|cream|ivory|black)(?:/(?:white|oyster|cream|ivory|black))?\s*$", "")
    return blank_to_null(sub(F.trim(sub(t, r"(?i)\s*View\s+this.*$", "")), r",+\s*$", ""))


def shade_three_part(c, numbers: int | None = None) -> Column:
    """Top, bottom and height numbers; else the numbers of the shade block, the first ``numbers`` if given."""
    parts = [grab(block_after(c, f"Shade {w}", MEASURE_LABELS), N) for w in ("Top", "Bottom", "Height")]
    block = F.coalesce(block_after(c, "Shade Details", MEASURE_LABELS), block_after(c, "Shade", MEASURE_LABELS))
    found = grab_all(block, N)
    nums = F.array_join(F.slice(found, 1, numbers) if numbers else found, ", ")
    return F.coalesce(blank_to_null(F.concat_ws(", ", *parts)), blank_to_null(nums))


# Fixture measures that include the shade.
WITH_SHADE_KEYS = (
    "Fixture Width with Shade",
    "Length / Height with Shade",
    "Length / Height without Shade",
    "Projection with Shade",
    "Fixture Width W/ Shade",
    "Fixture Width W/o Shade",
    "Projection W/ Shade",
)


def shade_measures(c) -> Column:
    vals = F.array(*[F.trim(F.replace(grab(c, rf"(?im){k}\s*:\s*([^\n|]+)"), F.lit('"'), F.lit(""))) for k in WITH_SHADE_KEYS])
    return blank_to_null(F.array_join(F.array_distinct(F.filter(vals, lambda v: v.isNotNull())), ", "))


def shade_pipe(dimensions, specs) -> Column:
    t = F.concat_ws(" | ", present(dimensions), present(specs))
    return F.trim(grab(t, r"(?i)Shade\s*:?\s*([^|]+)"))


def shade_line(c) -> Column:
    t = F.trim(grab(c, r"(?s)Shade:\s*([^\n]*)"))
    return blank_to_null(F.trim(sub(t, r"(?i)\s*(?:Ivory Silk|White Silk|Linen|Shade is not included|Estimated lead-time).*", "")))


def semicolon_parts(c) -> dict[str, Column]:
    return {k: F.trim(grab(c, rf"(?i){w}[^:]*:\s*([^;]+)")) for k, w in (("shade", "Shade"), ("finish", "Finish"), ("base", "Base"))}


# --- K73/K74 canopy, plates, heights --------------------------------------


def line_number(c, label: str) -> Column:
    """Number on the line that starts with the label."""
    return grab(c, rf"(?im)^\s*{label}\s*:\s*{N}")


def canopy_marked(c) -> Column:
    return grab(grab(squeeze(c), r"(?i)(Canopy[^|]*)"), rf"{N}\s*[\"″]")


def canopy_parts(c) -> Column:
    """Stem diameter, canopy sizes and the measured lines of a CANOPY section."""
    c = as_col(c)
    stem = F.concat(grab(c, r'(?i)(\d+/\d+)\s*"\s*(?:diameter\s+)?(?:stem|rod)'), F.lit('"'))
    named = F.trim(grab(c, r"(?i)Canopy\s+dimensions?\s*:\s*([^\n]+)"))
    shapes = F.transform(grab_all(c, r"(?i)(?:Round|Square)\s+Canopy\s*:\s*([^\n]+)"), lambda x: F.trim(x))
    body = grab(c, r"(?ms)^\s*(?i:CANOPY)\s*$\n(.*?)(?=^\s*[A-Z][A-Z\s]{3,}$|\z)")
    lines = F.filter(lines_of(F.coalesce(body, F.lit(""))), like(r'\d+(?:\.\d+)?\s*"|Ø'))
    every = F.concat(F.array(stem, named), shapes, lines)
    return blank_to_null(F.array_join(F.array_distinct(F.filter(every, lambda v: v.isNotNull())), ", "))


def canopy_diameter(c) -> Column:
    keys = ("Canopy/Base Diameter", "Canopy / Base Diameter", "Canopy Diameter", "Base Diameter")
    return F.trim(F.replace(F.coalesce(*[grab(c, rf"(?im){k}\s*:\s*([^\n|]+)") for k in keys]), F.lit('"'), F.lit("")))


def canopy_dia_height(c) -> Column:
    """K73: "CANOPY DIA:" and "CANOPY H:" of a text in capitals, joined; a part that is not there is left out."""
    return blank_to_null(F.concat_ws(", ", *[grab(c, rf"(?i)CANOPY\s*{p}:\s*([\d\-.]+)") for p in ("DIA", "H")]))


def height_precedence(c, overall) -> Column:
    """Current, else minimum, else overall height."""
    return F.coalesce(line_number(c, r"current\s+height"), line_number(c, r"min(?:imum)?\s+height"), as_col(overall))


def overall_height(c) -> Column:
    """Value before OAH."""
    return fraction_text(grab(squeeze(c), r"(?i)\b(\d+(?:\.\d+)?(?:\s*[¼½¾])?(?:\s+\d/\d)?|\d+/\d)\s*oah\b"), 2, "raw")


# --- K75 materials and finish ---------------------------------------------


def materials_block(c) -> Column:
    return F.trim(grab(c, r"(?i)Materials\s*:?\s*([^|]+)"))


def finish_options(c) -> Column:
    """Options under the finish headers: glass, then metal, then the others.

    A section ends at the next ALL-CAPS header or at prose.
    """
    head = r"(?i:(?:GLASS\s+|METAL\s+|CANOPY\s+)?FINISH(?:ES)?)"
    lines = lines_of(c)
    seed = F.struct(F.lit("").alias("bucket"), F.array().cast("array<struct<bucket:string,line:string>>").alias("items"))

    def step(acc, x):
        header = x.rlike(f"^{head}$")
        kind = F.when(F.upper(x).contains("GLASS"), "1").when(F.upper(x).contains("METAL"), "2").otherwise("3")
        prose = (F.length(x) > 60) | x.rlike(r"(?i)^(?:When|This|If|Please|Pendant|Rectangular|See)\b")
        ends = (x.rlike(r"^[A-Z][A-Z\s]+$") & (F.length(x) > 3)) | prose
        take = ~header & ~ends & (acc["bucket"] != "")
        return F.struct(
            F.when(header, kind).when(ends, F.lit("")).otherwise(acc["bucket"]).alias("bucket"),
            F.when(take, F.concat(acc["items"], F.array(F.struct(acc["bucket"].alias("bucket"), x.alias("line"))))).otherwise(acc["items"]).alias("items"),
        )

    items = F.aggregate(lines, seed, step)["items"]

    def gather(all_items):
        return F.concat(*[F.transform(F.filter(all_items, lambda i: i["bucket"] == b), lambda i: i["line"]) for b in ("1", "2", "3")])

    return blank_to_null(F.array_join(let(items, gather), ", "))


def clean_finish(v) -> Column:
    return F.trim(sub(F.trim(as_col(v)), r"(?i)^general\s*info\s*:\s*", ""))


def clean_fabric(v) -> Column:
    t = F.trim(sub(F.trim(as_col(v)), r"(?i)^fabric\s*composition\s*:\s*", ""))
    return F.trim(sub(t, r"(?i)^fabric\s*:\s*", ""))


def bulleted_finishes(html) -> Column:
    """Bullets between "Finish(es):" and the next section word."""
    t = sub(sub(html, r"(?i)<br\s*/?>|</p>|</li>", "\n"), "<[^>]+>", "")
    section = grab(t, r"(?is)Finishes?:(.*?)(?:Configurations|Sizes?|Finishes?:|\z)")
    bullets = F.filter(lines_of(section), lambda x: x.startswith("•"))
    return blank_to_null(F.array_join(F.transform(bullets, lambda x: F.trim(F.regexp_replace(F.substring(x, F.lit(2), F.length(x)), r"\s*\(.*?\)", ""))), ", "))


def paragraph_field(html, field: str) -> Column:
    """Paragraph naming the field, else its table row."""
    word = r"\b(?:Finish|Finishes)\b" if field.lower() == "finish" else rf"\b{field}s?\b"
    paras = F.transform(grab_all(html, r"(?is)<p[^>]*>(.*?)</p>"), html_to_line)
    hit = F.get(F.filter(paras, like(f"(?i){word}")), F.lit(0))
    row = grab(html, rf"(?is)<th[^>]*>[^<]*{word}[^<]*</th>\s*<td[^>]*>(.*?)</td>")
    return F.coalesce(F.trim(sub(hit, rf"(?i){word}\s*[:\-]?\s*", "")), html_to_line(row))


def finish_after_break(html) -> Column:
    return F.trim(grab(html, r"(?i)<br\s*/?>\s*Finish:\s*([^<\n\r]+)"))


def construction_table(c) -> dict[str, Column]:
    """``key: value`` lines; base and seat parts are appended."""
    lines = F.filter(lines_of(c), lambda x: x.contains(":"))

    def values(words):
        mine = F.filter(lines, lambda x: F.lower(F.substring_index(x, ":", 1)).rlike(words))
        return F.transform(mine, lambda x: F.trim(F.regexp_extract(x, r"(?s)^[^:]*:(.*)$", 1)))

    return {
        "finish": F.try_element_at(values("material finish"), F.lit(-1)),
        "base": blank_to_null(F.array_join(values("base / legs|base finish"), ", ")),
        "seat": blank_to_null(F.array_join(values("seat construction|seat cushion|cover fabric"), ", ")),
        "cushion": F.try_element_at(values("back cushion"), F.lit(-1)),
        "wattage": F.try_element_at(values("max bulb wattage"), F.lit(-1)),
    }


def pipe_lines(c) -> dict[str, Column]:
    """Cushion, socket and wattage parts of a pipe list, kept whole."""
    parts = F.filter(F.transform(F.split(as_col(c), r"\|"), lambda p: F.trim(p)), lambda p: p != "")
    return {
        "cushion": F.trim(sub(grab(c, r"(?i)(Cushion[^|]+)"), r"(?i)^Cushion(?:\s*Fill)?\s*:\s*", "")),
        "socket": F.get(F.filter(parts, like("(?i)socket")), F.lit(0)),
        "wattage": F.get(F.filter(parts, like("(?i)watt")), F.lit(0)),
    }


# --- K76 pipe lists by label ----------------------------------------------


def pipe_pairs(c) -> Column:
    """Array of (label, value) of a pipe list."""
    parts = F.filter(F.transform(F.split(as_col(c), r"\|"), lambda p: F.trim(p)), lambda p: p.contains(":"))
    return F.transform(parts, lambda p: F.struct(F.trim(F.substring_index(p, ":", 1)).alias("label"), F.trim(F.regexp_extract(p, r"(?s)^[^:]*:(.*)$", 1)).alias("value")))


# Label patterns of the pipe list and the fields they fill; earlier patterns first.
PIPE_LABELS = {
    "weight": ("ITEM WEIGHT",),
    "seat_depth": ("^SEAT DEPTH",),
    "seat_width": ("^SEAT WIDTH",),
    "seat_height": ("^SEAT HEIGHT",),
    "arm_width": ("SEAT ARM WIDTH", "^ARM WIDTH"),
    "arm_length": ("SEAT ARM LENGTH", "^ARM LENGTH"),
    "arm_height": ("SEAT ARM HEIGHT", "^ARM HEIGHT"),
    "com": ("NUMBER OF YARDS TO RECOVER", "^COM"),
}


def pipe_fields(c) -> dict[str, Column]:
    def read(pairs):
        def last(pattern):
            return F.try_element_at(F.filter(pairs, lambda p: F.upper(p["label"]).rlike(pattern)), F.lit(-1))["value"]

        out = {f: first_of(*[let(last(p), number_or_raw) for p in pats]) for f, pats in PIPE_LABELS.items()}
        return F.struct(*[v.alias(f) for f, v in out.items()], last("SHADE INCLUDED").alias("shade"))

    # The list is cut once; all fields come from one struct.
    found = let(pipe_pairs(c), read)
    return {f: found[f] for f in (*PIPE_LABELS, "shade")}


def pipe_map(c) -> Column:
    """All labels of a pipe list as a map, last value wins (unknown keys become columns)."""
    return map_last(F.transform(pipe_pairs(c), lambda p: F.struct(p["label"].alias("key"), p["value"].alias("value"))))


def pipe_value(c, label: str) -> Column:
    return F.trim(grab(c, rf"(?i)(?:^|\|\s*){label}\s*:\s*(.*?)(?=\s*\||$)"))


# --- K77 rugs -------------------------------------------------------------

RUG_FIELDS = {"construction": "construction", "material": "material", "pile height": "pile_height", "backing": "backing", "country of origin": "country_of_origin"}


def pile_height(c) -> Column:
    return F.trim(F.replace(as_col(c), F.lit('"'), F.lit("")))


def rug_fields(c) -> dict[str, Column]:
    """Rug attributes of ``label: value`` lines, last one wins."""
    out = {}
    for label, f in RUG_FIELDS.items():
        line = F.try_element_at(F.filter(lines_of(c), like(rf"(?i)^{label}\s*:")), F.lit(-1))
        v = blank_to_null(F.trim(F.regexp_extract(line, r"(?s)^[^:]*:(.*)$", 1)))
        out[f] = pile_height(v) if f == "pile_height" else v
    return out


#: Cleaner per attribute of the pipe list.
PIPE_CLEANERS = {"Finish": clean_finish, "Weight": weight_lb_only, "Fabric": clean_fabric, "Wattage": clean_wattage, "Socket": clean_socket}
