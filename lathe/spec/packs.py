"""Dimension grammars (K67): how each catalogue writes its measures.

``PACKS`` maps the inventory code to a function that lists reading steps.
Patterns, labels and field orders are fixed values of those notations.
"""

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import fraction_text, inline_vulgar, kg_to_lb, mm_to_inch, number_text, spell_super_sub, spell_vulgar
from ..functions.rx import as_col, blank_to_null, grab, grab_all, grab_last, has, like, lines_of, sub
from ..functions.text import drop_parentheses, drop_size_prefix, drop_tags, first_size_block, plain_quotes, squeeze
from ..functions.urls import percent_decode
from .reader import Reader, array_pick

PACKS: dict = {}

N = r"(\d+(?:\.\d+)?)"
ND = r"([\d.]+)"
NF = r"(\d+(?:\s+\d+/\d+)?)"
X = r"\s*[xX×]\s*"

WDHL = {"width": "W", "depth": "D", "height": "H", "length": "L"}
SEAT_ARM = {"seat_height": r"Seat\s*Height", "seat_depth": r"Seat\s*Depth", "seat_width": r"Seat\s*Width", "arm_height": r"Arm\s*Height"}
DIA_WORD = r"(?:DIAMETER|DIAM|DIA)"


def pack(code: str):
    def add(fn):
        PACKS[code] = fn
        return fn

    return add


def extract_dimensions(df: DataFrame, text_col: str, code: str, out: str = "dims") -> DataFrame:
    """Adds a struct of FIELDS read from ``text_col`` by grammar ``code``."""
    r = Reader(df, as_col(text_col))
    PACKS[code](r)
    return r.finish(out)


def extract_by_vendor(df: DataFrame, text_col: str, pack_col: str, codes, out: str = "dims") -> DataFrame:
    """Rows of several grammars in one pass over the input; a row of another or no grammar stays, with NULL dimensions."""
    names, codes = df.columns, list(codes)
    for i, c in enumerate(codes):
        own = df.withColumn("__spec", F.when(F.col(pack_col) == c, as_col(text_col)))
        df = extract_dimensions(own, "__spec", c, f"__d{i}").drop("__spec")
    mine = F.coalesce(*[F.when(F.col(pack_col) == c, F.col(f"__d{i}")) for i, c in enumerate(codes)])
    return df.select(*[F.col(f"`{n}`") for n in names if n != out], mine.alias(out))


def extractor(pattern):
    return lambda x: F.regexp_extract(x, pattern, 1)


def with_quote(v):
    return F.concat(v, F.lit('"'))


# --- suffix notation: 26"W ------------------------------------------------


@pack("generic")
def _(r):
    num = r"""(\d[\d\s/]*)\s*["']?\s*"""
    r.take("width", num + r"[Ww](?:idth)?")
    r.take("depth", num + r"[Dd](?:epth|iam)?")
    r.take("height", num + r"[Hh](?:eight|t)?")
    r.take("length", num + r"[Ll](?:ength|en)?")
    r.take("diameter", r"[Dd]ia(?:meter)?\s*:?\s*(\d[\d\s/]*)")
    r.take("weight", r"[Ww]eight\s*:?\s*([\d\s/]+)\s*(?:lbs?|kg)?")
    r.each(lambda v: fraction_text(F.trim(v), 2, "raw"))


@pack("INT")
def _(r):
    r.rewrite(lambda t: F.when(~F.upper(t).contains("MULTIPLE"), F.replace(F.trim(t), F.lit("''"), F.lit('"'))))
    end = r"(?:\s|x|;|$)"
    r.take("weight", r"(?i)(?:Weight\s*[:=]?\s*)?([\d.]+)\s*(?:lbs?|ibs?|ib|kg)")
    r.take("diameter", rf'(?i){NF}\s*"?\s*DIA', rf'(?i)DIA\s*{NF}\s*"?')
    for f, label in (("height", "H"), ("width", "W"), ("depth", "D(?![Ii][Aa])")):
        r.take(f, rf'{NF}\s*"?\s*{label}{end}')
    span = r"(\d+(?:\s+\d+/\d+)?(?:\s*-\s*\d+(?:\s+\d+/\d+)?)?)"
    for f, label in (("seat_depth", "SD"), ("seat_height", "SH"), ("arm_height", "AH")):
        r.take(f, rf"{label}\s*[:=]?\s*{span}")
    r.each(lambda v: fraction_text(v, 2, "raw", keep_range=True))


@pack("ZUO")
def _(r):
    r.rewrite(plain_quotes)
    r.take("diameter", rf"(?i){ND}\s*[\"']?\s*Dia")
    for f, a in WDHL.items():
        r.take(f, rf"{ND}\s*[\"']?\s*{a}(?![A-Za-z])")


@pack("SU")
def _(r):
    r.rewrite(plain_quotes)
    for f, a in (("height", "H"), ("width", "W"), ("depth", "D")):
        r.take(f, rf'(?i){N}\s*"?\s*{a}\b')
    r.take("diameter", rf'(?i){N}\s*"?\s*(?:Diameter|Dia)\b', rf'{N}\s*"?\s*Ø')
    r.take("length", rf'(?i){N}\s*"?\s*(?:L|Length)\b')
    r.settle()
    free = r.get("length").isNull() & r.get("width").isNull()
    pair = r"([\d.'\"]+)\s*[xX]\s*([\d.'\"]+)"
    r.put("length", grab(r.t, pair, 1), when=free)
    r.put("width", grab(r.t, pair, 2), when=free)


@pack("PAL")
def _(r):
    r.rewrite(plain_quotes)
    num = r'(?i)(\d+(?:\.\d+)?(?:\s*\d+/\d+)?)\s*(?:"|in)?\s*'
    r.take("depth", num + r"(?:L|DP|D)\b")
    r.take("width", num + r"W\b")
    r.take("height", num + r"H\b")
    r.take("diameter", num + r"(?:Diameter|Dia)\b")
    r.each(with_quote)


@pack("ALM")
def _(r):
    r.rewrite(plain_quotes)
    num = r'(?i)(\d+\.?\d*)\s*"?\s*'
    r.take("diameter", num + "DIA")
    for f, a in WDHL.items():
        r.take(f, num + rf"{a}\b")


@pack("HON")
def _(r):
    r.rewrite(lambda t: F.upper(F.translate(t, "\"'’”‘“", "")))
    for f, a in {**WDHL, "diameter": "(?:DIAM|DIA)", "weight": "(?:WEIGHT|WEIGTH|LBS?|IBS?)"}.items():
        r.take(f, rf"{ND}\s*{a}\b")


@pack("QUA")
def _(r):
    r.take("weight", rf"(?i){N}\s*(?:lbs|ibs|kg)")
    for f, a, word in (("width", "W", "width"), ("height", "H", "height"), ("depth", "D(?!IA)", "depth")):
        r.take(f, rf'(?i){N}\s*[″"]\s*{a}', rf"(?i)(?:Standard\s+)?{word}:\s*{N}")
    r.take("diameter", rf'(?i){N}\s*[″"]\s*DIA')


@pack("VER")
def _(r):
    mark = '\\s*["″]?\\s*'
    for f, a in (("length", "L"), ("width", "W"), ("height", "H"), ("depth", "D")):
        r.take(f, rf"(?i){N}{mark}{a}(?:[^a-zA-Z]|$)", rf'(?i)\b{a}\s+{N}\s*["″]')
    r.take("diameter", rf"(?i){N}{mark}Dia")
    r.take("weight", rf"(?i){N}\s*(?:lbs?|ibs?)")


@pack("WAW")
def _(r):
    r.rewrite(lambda t: F.translate(t, "″’", "\"'"))
    num = r'(?i)(\d+\.?\d*)\s*"?\s*'
    r.take("width", num + "W")
    r.take("depth", num + "(?:D(?!IAM)|DEPTH)")
    r.take("height", num + "H")
    r.take("diameter", num + "DIA")
    # "35 lbs" is a weight: the surveyed rule reads lengths from the dimension field alone, where no weight stands.
    r.take("length", num + r"L(?!BS?\b)", r"(?i)\bL(?:ENGTH)?[:\s]+(\d+\.?\d*)")


@pack("UM")
def _(r):
    num = r"(\d+\.?\d*)\s*"
    r.take("diameter", rf"(?i){num}Dia")
    r.settle()
    round_one = r.get("diameter").isNotNull()
    end = r"(?:\s|$|\()"
    r.put("height", grab(r.t, num + r"[Hh](?:\s|$|\(|[xX×])"), when=round_one)
    for f, a in (("depth", "[Dd]"), ("width", "[Ww]"), ("height", "[Hh]"), ("length", "[Ll]")):
        r.put(f, grab(r.t, num + a + end), when=~round_one)


@pack("REM")
def _(r):
    lines = r.stage(lines_of(r.t))
    head = F.get(F.filter(lines, lambda x: x.rlike(r'(?i)^"?\s*overall\s*:')), F.lit(0))
    r.t = r.stage(grab(head, r"(?s):\s*(.*)$"))
    num = r'(?i)(\d+(?:\.\d+)?)\s*"?\s*'
    for f, a in (("height", "h"), ("width", "w"), ("depth", "d")):
        r.take(f, num + rf"{a}\.?\b")
    r.take("diameter", num + r"(?:diameter|dia)\b")
    r.take("depth", num + r"(?:depth|deep)\b")
    for f, word in (("depth", "depth"), ("diameter", "diameter")):
        r.put(f, grab(F.get(F.filter(lines, like(rf"(?i)^{word}\s*:\s*\d")), F.lit(0)), N))


# --- all labelled pairs, first or last wins -------------------------------


@pack("JBI")
def _(r):
    r.rewrite(lambda t: F.translate(t, "‘’‚‛“”„‟\"' ", ""))
    r.tokens(
        r"[\d.]+\s*[A-Za-z.]+",
        {"diameter": rf"(?i)[\d\s]{DIA_WORD}\.*$", "width": r"(?i)[\d\s]W\.*$", "depth": r"(?i)[\d\s]D\.*$", "length": r"(?i)[\d\s]L\.*$", "height": r"(?i)[\d\s](?:H|OAH)\.*$"},
        number=ND,
        pick="last",
    )


@pack("VH")
def _(r):
    r.rewrite(F.upper)
    labels = {f: rf"[\d ]{a}$" for f, a in WDHL.items()} | {"diameter": "DIA"}
    r.tokens(r"\d+(?:\.\d+)? *(?:DIAMETER|DIAM|DIA|W|D|H|L)\b", labels, pick="last")


@pack("HOL")
def _(r):
    labels = {f: rf"(?i)[\d\s]{a}$" for f, a in WDHL.items()} | {"diameter": "(?i)dia", "weight": "(?i)(?:weight|lb)"}
    r.tokens(r"(?i)\d+\.?\d*\s*(?:diameter|dia|weight|lbs|lb|w|h|l|d\b)", labels, pick="last")


@pack("CAR")
def _(r):
    r.rewrite(squeeze)
    r.scope(r"(?i)Dimensions\s*in\s*Inches\s*:\s*(.+)")
    r.clean((r"×", "X"), (r"\s*[xX]\s*", " X "))
    labels = {f: rf"(?i)[\d\s]{a}$" for f, a in WDHL.items()} | {"diameter": "(?i)DIA"}
    r.tokens(r"(?i)\d+(?:\.\d+)?\s*(?:DIAMETER|DIA|W|D|H|L)\b", labels, pick="last")


@pack("CUR")
def _(r):
    r.rewrite(F.lower)
    labels = {f: rf'["\s]{a.lower()}\.*$' for f, a in WDHL.items()} | {"diameter": r'["\s]dia\.*$'}
    r.tokens(r'[\d.]+\s*"\s*[a-z.]+', labels, number=ND, pick="last")


@pack("CRL")
def _(r):
    r.rewrite(F.upper)
    labels = {"width": r"[\d\s]W$", "depth": r"[\d\s]D$", "height": r"[\d\s]H$", "diameter": "DIA$"}
    r.tokens(r"[\d.]+\s*(?:W|DIA|D|H)\b", labels, number=ND)


@pack("SUN")
def _(r):
    overall = grab_last(r.t, r"(?im)overall dimensions[^:\n]*:\s*([^\n]*)")
    table = r.t
    r.t = r.stage(F.coalesce(overall, F.when(~table.contains(":"), table)))
    labels = {f: rf"(?i)[\d.\s]{a}$" for f, a in WDHL.items()} | {"diameter": "(?i)DIA"}
    r.tokens(r"(?i)[\d.]+\s*[WDHLIA]+", labels, number=ND)
    for f, word in SEAT_ARM.items():
        r.put(f, blank_to_null(sub(grab_last(table, rf"(?im){word}[^:\n]*:\s*([^\n]*?)\s*$"), r"(?i)\s*in\s*$", "")))
    for kind in ("net", "carton", "gross"):
        r.put("weight", sub(grab(table, rf"(?im){kind} weight[^:\n]*:\s*([^\n]*?)\s*$"), r"(?i)\s*[li]b\s*$", ""))


@pack("TRO")
def _(r):
    r.rewrite(lambda t: drop_tags(percent_decode(t), "\n"))
    lines = r.stage(lines_of(r.t))
    sized = r"(?i)\d+\.?\d*\s*(?:W|D|Diam|Dia|H)\b"
    r.t = r.stage(F.get(F.filter(lines, lambda x: x.rlike(sized)), F.lit(0)))
    labels = {"width": r"(?i)[\d\s]W$", "depth": r"(?i)[\d\s]D$", "height": r"(?i)[\d\s]H$", "diameter": r"(?i)DIAM?$"}
    r.tokens(r"(?i)[\d.]+\s*(?:Diam|Dia|W|D|H)\b", labels, number=ND)
    for f in ("seat_height", "arm_height"):
        word = SEAT_ARM[f]
        mine = F.filter(F.filter(lines, lambda x: ~x.rlike(sized)), like(f"(?i){word}"))
        r.put(f, grab(F.get(mine, F.lit(0)), ND))


@pack("SS")
def _(r):
    r.clean((r"[’”]", '"'))
    lab = r"(?:Diam\.?|Dia\.?|Ø|H|W|D)"
    labels = {"height": "(?i)H", "width": "(?i)W", "depth": r"(?i)D(?!ia)", "diameter": "(?i)(?:Dia|Ø)"}
    toks = r.tokens(rf'(?i){lab}\s*[:.]?\s*\d+(?:\.\d+)?\s*"?|\d+(?:\.\d+)?\s*"?\s*{lab}', labels)
    bare = F.size(toks) == 0
    nums = r.stage(grab_all(r.t, N))
    r.settle()
    r.by_count(nums, {3: ("width", "height", "depth"), 2: ("width", "height"), 1: ("height",)}, when=bare)
    r.each(with_quote)


@pack("AF")
def _(r):
    r.rewrite(squeeze)
    parts = F.filter(F.split(r.t, r"\s*\|\s*|\n|;|•"), lambda p: ~F.lower(p).contains("center to center"))
    words = r"Total (?:Length|Width|Height|Depth|Diameter)|Bar Width|Base Width|Breadth|Length|Width|Height|Depth|Diameter|Base|Weight|Projection"
    pairs = rf"(?i)(?:{words})\s*[-:]\s*[-\d]*\.?\d+"
    compact = r'(?i)[-+]?\d*\.?\d+\s*(?:inches|inch|in|")?\s*(?:DIAM|Dia|Length|Width|Depth|Height|Diameter|Projection|Base|Weight|L|W|D|H)\b'
    toks = r.stage(F.flatten(F.transform(parts, lambda p: F.concat(grab_all(p, pairs, 0), grab_all(p, compact, 0)))))
    end = r'(?:\s*[-:].*)?$'
    r.assign(
        toks,
        {
            "weight": "(?i)weight",
            "width": rf'(?i)(?:^|[\d\s"])(?:w|width|total width|breadth|bar width){end}',
            "depth": rf'(?i)(?:^|[\d\s"])(?:d|depth|total depth){end}',
            "height": rf'(?i)(?:^|[\d\s"])(?:h|height|total height){end}',
            "diameter": rf"(?i)(?:diam|dia|diameter){end}",
            "length": rf'(?i)(?:^|[\d\s"])(?:l|length|total length){end}',
        },
        number=r"(\d*\.?\d+)",
    )
    # "Base Width" is no width: it is removed by reading width only from other tokens.
    r.values["width"] = grab(array_pick(F.filter(toks, lambda x: x.rlike(rf'(?i)(?:^|[\d\s"])(?:w|width|total width|breadth|bar width){end}') & ~x.rlike("(?i)base width")), "first"), r"(\d*\.?\d+)")
    r.each(lambda v: F.when(v.startswith("."), F.concat(F.lit("0"), v)).otherwise(v))


# --- prefix notation: W: 26 -----------------------------------------------


@pack("EI")
def _(r):
    r.take("diameter", rf"[ØøΦφ]\s*{ND}")
    for f, a in {**WDHL, "seat_depth": "SD", "seat_height": "SH", "seat_width": "SW", "arm_height": "AH"}.items():
        r.take(f, rf"(?<![A-Za-z]){a}\.\s*{ND}")
    r.each(lambda v: number_text(sub(v, r"\.+$", ""), 2))
    r.put("shade", shade_numbers(r.t))


def shade_numbers(c):
    """Inch-marked numbers after the word shade, joined by commas."""
    block = grab(c, r"(?s)[Ss]hade[:\s]*(.*?)(?:\n[A-Z]|\z)")
    return blank_to_null(F.array_join(grab_all(block, r'(\d+(?:\.\d+)?)\s*[″"]'), ","))


@pack("CHA")
def _(r):
    r.rewrite(F.upper)
    r.tokens(r"[WDH]\s*\d+\.?\d*", {"width": "^W", "depth": "^D", "height": "^H"}, number=r"(\d+\.?\d*)", pick="last")


@pack("PF")
def _(r):
    r.t = r.stage(F.get(F.filter(lines_of(r.t), lambda x: x.rlike(r"(?i)\b(?:inch|inches)\b|\"")), F.lit(0)))
    r.clean((r"[×X]", "x"), (r"(?i)\bDIAMETER\b|\bDIA\b\.?", "DIA"))
    r.tokens(
        r"(?i)\b(?:DIA|L|P|D|W|H)\b\s*:?\s*\d+(?:[.,]\d+)?",
        {"length": "(?i)^L", "depth": r"(?i)^[PD](?!IA)", "width": "(?i)^W", "height": "(?i)^H", "diameter": "(?i)^DIA"},
        number=r"(\d+(?:[.,]\d+)?)",
        pick="last",
    )


@pack("TFP")
def _(r):
    r.rewrite(lambda t: squeeze(plain_quotes(t)))
    for f, word in (("length", "L(?:ength)?"), ("width", "W(?:idth)?"), ("depth", "D(?:epth)?"), ("diameter", r"DIA\.?"), ("height", "H(?:eight)?")):
        r.take(f, rf"(?i)\b{word}\s*{N}")


@pack("ST")
def _(r):
    for f, a in (("height", "H"), ("width", "W"), ("depth", "D")):
        r.take(f, rf"(?<!\bS){a}\s*{ND}")
    r.take("diameter", rf"Ø\s*{ND}")
    r.take("length", rf"L\s*{ND}")
    r.take("seat_height", rf"SH\s*{ND}")
    r.take("seat_depth", rf"SD\s*{ND}")


@pack("BRC")
def _(r):
    r.rewrite(squeeze)
    for f, a, word in (("width", "W", "WIDTH"), ("depth", "D", "DEPTH"), ("height", "H", "HEIGHT")):
        r.take(f, rf"(?i){a}\s*:?\s*{N}", rf"(?i){word}\s*:?\s*{N}")
    r.take("diameter", rf"(?i)DIA(?:M(?:ETER)?)?\s*:?\s*{N}")
    r.take("arm_height", rf"(?i)ARM HEIGHT\s*:?\s*{N}")
    r.take("seat_height", rf"(?i)SEAT HEIGHT\s*:?\s*{N}")


@pack("HIC")
def _(r):
    for f, a in (("width", "W"), ("depth", "D"), ("height", "H")):
        r.take(f, rf"(?i){a}\s*{ND}")
    r.take("diameter", rf"(?i){ND}\s*dia")
    r.take("height", rf"(?i){ND}\s*h", override=True)


@pack("MCL")
def _(r):
    for f, a, word in (("width", "W", "Width"), ("height", "H", "Height"), ("depth", "D", "Depth")):
        r.take(f, rf"(?i)(?:{a}|{word})[\s:]*{N}", rf"(?i){N}\s*{a}")
    r.take("diameter", rf"(?i)(?:Diam\.?|Dia\.?|Diameter)[\s:]*{N}")
    r.take("weight", rf"(?i)Weight[\s:]*{N}")


@pack("MBL")
def _(r):
    r.rewrite(lambda t: F.translate(sub(t, "[×X]", "x"), "″\"’'", ""))
    r.clean((r"(?i)\b(?:Overall Dimensions|Overall|Dimensions)\s*[:\-]?\s*", ""))
    parts = r.stage(F.split(r.t, r"[x\n\r]"))
    for f, a, word in (("width", "W", "W(?:idth)?"), ("depth", "D", "D(?:epth)?"), ("height", "H", "H(?:eight)?"), ("diameter", "(?:Diameter|Dia)", "(?:Diameter|Dia)")):
        either = rf"(?i)\d+(?:\.\d+)?\s*{a}\b|\b{word}[:\-]?\s*\d+(?:\.\d+)?"
        mine = F.filter(parts, like(either))
        r.put(f, grab(F.regexp_extract(F.get(mine, F.lit(0)), either, 0), N))
    for f in ("width", "depth", "height", "diameter"):
        r.take(f, rf"(?i)\b{f}\b\s*[:\-]?\s*{N}")


@pack("SBV")
def _(r):
    num = r"([\d\-.]+)"
    r.take("diameter", rf"(?i)DIA:\s*{num}")
    for f, a in (("height", "H"), ("width", "W"), ("depth", "D")):
        r.take(f, rf"(?i)\b{a}:\s*{num}")
    r.take("weight", rf"(?i)(?:WEIGHT|IBS|IB|LBS|LB)[^\d]*{num}")


@pack("ART")
def _(r):
    r.rewrite(squeeze)
    for f, word in (("weight", "Weight"), ("width", "Width"), ("depth", "Depth"), ("diameter", "Diameter"), ("length", "Length"), ("height", "Height"), ("arm_height", "Arm Height"), ("seat_height", "Seat Height")):
        r.take(f, rf"(?i){word}\s*[:\-]?\s*{ND}")
    r.each(lambda v: grab(v, N))


@pack("CEN")
def _(r):
    r.rewrite(lambda t: drop_tags(sub(t, r"(?i)</?p>", "\n"), ""))
    for f, word in (("weight", "WEIGHT"), ("height", "HEIGHT"), ("width", "WIDTH"), ("depth", "DEPTH"), ("diameter", "DIAMETER"), ("seat_height", "Seat Height"), ("arm_height", "Arm Height")):
        firsts = F.transform(lines_of(r.t), extractor(rf"(?i){word}:?\s*{ND}"))
        r.put(f, F.try_element_at(F.filter(firsts, lambda v: v != ""), F.lit(-1)))


# --- tables: label: value -------------------------------------------------


@pack("COL")
def _(r):
    lines = r.stage(F.transform(lines_of(r.t, r"\n|\|"), lambda x: F.upper(x)))
    kinds = ("SHADE", "WEIGHT", "WIDTH", "HEIGHT", "DEPTH", "DIAMETER", "LENGTH")

    def of_kind(k):
        before = kinds[: kinds.index(k)]

        def mine(x):
            hit = x.contains(k)
            for b in before:
                hit = hit & ~x.contains(b)
            return hit

        return F.filter(lines, mine)

    def inches(x):
        return F.coalesce(grab(x, r'(\d+\.?\d*)"'), number_text(mm_to_inch(grab(x, r"(\d+\.?\d*)\s*MM")), 0))

    def pounds(x):
        return F.coalesce(grab(x, r"(\d+\.?\d*)\s*LBS"), number_text(kg_to_lb(grab(x, r"(\d+\.?\d*)\s*KG")), 0))

    for k in kinds[1:]:
        vals = F.filter(F.transform(of_kind(k), pounds if k == "WEIGHT" else inches), lambda v: v.isNotNull())
        r.put(k.lower(), F.try_element_at(vals, F.lit(-1)))
    r.put("shade", blank_to_null(F.array_join(F.transform(of_kind("SHADE"), inches), ", ")))


@pack("REJ")
def _(r):
    r.rewrite(lambda t: F.trim(sub(F.translate(t, "″”“’–—", "\"\"\"'--"), r"[ \t]+", " ")))
    num = r"(\d+(?:\.\d+)?(?:\s+\d+/\d+)?(?:-\d+/\d+)?)"
    keyed = {
        "width": ("Width", "Fixture Width", "Fixture Width with Shade", "Fixture Width W/ Shade"),
        "height": ("Height", "Length/Height", "Length / Height", "Length / Height with Shade", "Length/Height W/ Shade"),
        "depth": ("Depth", "Projection", "Projection with Shade", "Projection W/ Shade"),
        "diameter": ("Overall Diameter", "Diameter", "Canopy/Base Diameter", "Canopy Diameter", "Base Diameter"),
        "length": ("Length", "Overall Length"),
        "arm_width": ("Arm Width", "Width with Arms"),
    }
    for f, names in keyed.items():
        r.take(f, *[rf"(?i)\b{k}\b\s*:\s*{num}" for k in names])
    for f, word in SEAT_ARM.items():
        r.take(f, rf"(?i)\b{word}\b\s*[:\-\s]*{num}")
    r.each(lambda v: fraction_text(v, 4))
    r.put("weight", F.coalesce(grab(r.t, rf"(?i)(?:item\s*)?weight\s*[:\-\s]*{N}"), grab(r.t, rf"(?i)\bfixture\s*weight\b[^0-9]*{N}")))


@pack("JAN")
def _(r):
    lines = r.stage(lines_of(r.t))
    keys = {
        "weight": "WEIGHT",
        "width": "W|WIDTH",
        "diameter": "DIAM",
        "depth": "D|DEPTH",
        "length": "L|LENGTH",
        "height": "H|HEIGHT",
        "seat_height": "SH|SEAT HEIGHT",
        "arm_height": "AH|ARM HEIGHT",
    }
    for f, k in keys.items():
        row = F.try_element_at(F.filter(lines, like(rf"(?i)^(?:{k})\s*:")), F.lit(-1))
        r.put(f, grab(row, rf":[^\d]*{N}"))


@pack("CRLT")
def _(r):
    lines = r.stage(lines_of(r.t))

    def value_of(label):
        row = F.try_element_at(F.filter(lines, lambda x: F.upper(F.substring_index(x, ":", 1)).rlike(label)), F.lit(-1))
        return F.trim(grab(row, r"(?s):(.*)$"))

    outside = r.stage(value_of("OUTSIDE"))
    r.t = r.stage(F.upper(outside))
    r.tokens(r"[\d.]+\s*(?:W|DIA|D|H)\b", {"width": r"[\d\s]W$", "depth": r"[\d\s]D$", "height": r"[\d\s]H$", "diameter": "DIA$"}, number=ND)
    for f, label in (("weight", "WEIGHT"), ("seat_height", r"^\s*SEAT\s*$"), ("arm_height", r"^\s*ARM\s*$")):
        v = value_of(label)
        r.put(f, F.coalesce(F.replace(grab(v, r"([\d.,]+)"), F.lit(","), F.lit("")), v))


@pack("ROW")
def _(r):
    r.t = r.stage(F.get(F.filter(lines_of(r.t), lambda x: x.rlike(r"(?i)dimension") & x.rlike(r"(?i)\(in")), F.lit(0)))
    whole = r.t
    r.t = r.stage(F.coalesce(grab(whole, r"(?s):\s*(.*)$"), sub(whole, r"(?i)dimensions?\s*\(in\)\s*", "")))
    r.tokens(
        r"\b(?:DIA|Dia|L|W|D|H)\s*\d+(?:\.\d+)?",
        {"width": "^W", "depth": r"^D(?![Ii])", "height": "^H", "diameter": "^D[Ii]", "length": "^L"},
        pick="last",
    )


@pack("BD")
def _(r):
    """Section blocks ("Overall", "Seat", "Arm") with abbreviations inside."""
    lines = r.stage(lines_of(r.t))

    def in_section(name):
        block = F.get(F.filter(lines, lambda x: x.rlike(rf"(?i)^{name}\s*\|")), F.lit(0))
        return r.stage(block)

    overall, seat, arm = in_section("overall"), in_section("seat"), in_section("arm")
    for f, a in WDHL.items():
        r.put(f, grab(overall, rf"(?i)\b{a}\s*:\s*{N}"))
    r.put("diameter", grab(F.try_element_at(grab_all(overall, rf"(?i)\bD\s*:\s*{N}", 0), F.lit(2)), N))
    for f, a in (("seat_width", "W"), ("seat_depth", "D"), ("seat_height", "H")):
        r.put(f, grab(seat, rf"(?i)\b{a}\s*:\s*{N}"))
    for f, a in (("arm_width", "W"), ("arm_height", "H")):
        r.put(f, grab(arm, rf"(?i)\b{a}\s*:\s*{N}"))


@pack("DWR")
def _(r):
    """Bullets whose label is the text before the last colon, parentheses dropped."""
    lines = r.stage(F.filter(lines_of(r.t), lambda x: x.contains(":")))
    labels = r.stage(F.transform(lines, lambda x: std_label(sub(F.regexp_extract(x, r"(?s)^(.*):[^:]*$", 1), r"\s*\(.*?\)", ""))))
    values = r.stage(F.transform(lines, lambda x: F.regexp_extract(spell_vulgar(F.regexp_extract(x, r":([^:]*)$", 1)), r"(\d+(?:\.\d+)?(?:\s+\d+/\d+)?)", 1)))
    for f in ("seat_width", "seat_depth", "seat_height", "arm_height", "weight", "width", "depth", "height", "diameter"):
        at = F.array_position(F.reverse(labels), f)
        r.put(f, F.when(at > 0, fraction_text(F.get(F.reverse(values), (at - 1).cast("int")), 3)))


def std_label(c):
    """Standard field of a measure label: first contained word in fixed order, else NULL."""
    low = F.lower(as_col(c))
    pick = F.when(F.trim(low) == "weight", F.lit("weight"))
    for word in ("seat width", "seat depth", "seat height", "arm height"):
        pick = pick.when(low.contains(word), F.lit(word.replace(" ", "_")))
    pick = pick.when(low.contains("weight capacity"), F.lit("weight_capacity"))
    for word in ("width", "depth", "height", "diameter"):
        pick = pick.when(low.contains(word), F.lit(word))
    return pick


def section_field(section, abbrev):
    """Column name for an abbreviation inside a section, NULL when either is unknown."""
    s, a = F.lower(F.trim(as_col(section))), F.lower(F.trim(as_col(abbrev)))
    prefix = F.when(s == "overall", F.lit("")).when(s.isin("seat", "arm", "back"), F.concat(F.initcap(s), F.lit(" ")))
    suffix = F.when(a == "w", F.lit("Width")).when(a == "d", F.lit("Depth")).when(a == "h", F.lit("Height")).when(a == "l", F.lit("Length"))
    return F.concat(prefix, suffix)


@pack("GB")
def _(r):
    """One labelled value per line; only digits, points and commas count, first comma part."""
    for f, word in (("width", "Width"), ("depth", "Depth"), ("height", "Height"), ("length", "Length"), ("diameter", "Diameter"), ("weight", "Weight")):
        r.put(f, blank_to_null(first_before_comma(grab(r.t, rf"(?im)^\s*{word}\s*:\s*([^\n]*)"))))


def first_before_comma(c):
    return F.trim(F.substring_index(sub(c, r"[^0-9.,]+", ""), ",", 1))


@pack("SUT")
def _(r):
    for f, word in (("width", "Width"), ("depth", "Depth"), ("height", "Height"), ("length", "Length"), ("diameter", "Diameter"), ("seat_height", "Seat Height"), ("arm_height", "Arm Height")):
        r.put(f, number_before_unit(grab(r.t, rf"(?i)(?:^|\|)\s*{word}\s*:\s*([^|]*)")))


def number_before_unit(c):
    """First number standing before "in" or a slash."""
    return grab(F.regexp_extract(as_col(c), r"(?is)^(.*?)(?:in|/|\z)", 1), N)


@pack("PAH")
def _(r):
    for f, word in (("width", "Width"), ("depth", "Depth"), ("height", "Height"), ("length", "Length"), ("diameter", "Diameter")):
        r.put(f, blank_to_null(inch_value_text(grab(r.t, rf"(?im)^\s*{word}\s*:\s*([^\n]*)"))))


def inch_value_text(c):
    """Fraction text kept, marks and the word Dia. removed."""
    return F.trim(sub(sub(c, "[″′]", ""), r"(?i)\s*Dia\.?", ""))


# --- unlabelled by position -----------------------------------------------


@pack("PHC")
def _(r):
    r.rewrite(lambda t: sub(F.translate(F.lower(t), "\"'", ""), r"\(.*?\)", ""))
    nums = r.stage(grab_all(r.t, r"(\d+\.?\d*)"))
    for i, f in enumerate(("width", "depth", "height")):
        r.put(f, blank_to_null(F.get(nums, F.lit(i))))


@pack("CHE")
def _(r):
    parts = F.split(squeeze(F.replace(r.t, F.lit("×"), F.lit("x"))), r"\s*x\s*")
    parts = r.stage(F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != ""))
    labelled = r.stage(F.exists(parts, lambda p: p.rlike(r"(?i)^(?:h|w|d|l)")))
    starts = {"diameter": "^dia", "height": "^h", "width": "^w", "length": "^l", "depth": r"^d(?!ia)"}
    for f, s in starts.items():
        r.put(f, grab(F.get(F.filter(parts, like(f"(?i){s}")), F.lit(0)), N))
    nums = F.filter(F.transform(parts, lambda p: F.regexp_extract(p, N, 1)), lambda v: v != "")
    r.by_count(nums, {1: ("length",), 2: ("length", "width"), 3: ("length", "width", "depth")}, when=~labelled)


@pack("LIA")
def _(r):
    r.clean((r"(?i)\s*inch\s*$", ""), (r"(?i)([\d.]+)\s*(?:kg|lbs?|ibs?)\b", ""), (r"^[\sxX]+|[\sxX]+$", ""))
    lead = r"(?i)^Diam(?:eter|\.)?\s*([\d.]+)\s*[xX]?\s*([\d.]+)?"
    r.put("diameter", grab(r.t, lead, 1))
    r.put("height", grab(r.t, lead, 2))
    r.settle()
    led = has(r.t, r"(?i)^Diam(?:eter|\.)?\s*[\d.]+")
    labelled = has(r.t, r"(?i)[\d.]+\s*(?:DIAMETER|DIAM|DIA|D|W|HT|H)\b")
    parts = r.stage(F.split(r.t, X))
    for f, lab in (("diameter", "DIA|DIAM|DIAMETER"), ("depth", "D|DEPTH"), ("width", "W|WIDTH"), ("height", "H|HEIGHT|HT")):
        mine = F.filter(parts, like(rf"(?i)^\s*[\d.]+\s*(?:{lab})(?![a-zA-Z])"))
        r.put(f, grab(F.try_element_at(mine, F.lit(-1)), ND), when=~led & labelled)
    nums = r.stage(grab_all(r.t, r"(\d+\.?\d*)"))
    r.by_count(nums, {3: ("width", "depth", "height"), 2: ("width", "height"), 1: ("width",)}, when=~led & ~labelled, at_least=3)


# --- cascades of whole shapes ---------------------------------------------


def labelled_shape(labels: str, num: str = ND, mark: str = r'["\s]*', sep: str = r"\s*x\s*", tail: str = "") -> str:
    """Pattern of a run such as ``W x D x H`` from its labels."""
    return "(?i)" + sep.join(num + mark + lab for lab in labels.split()) + tail


LETTER = {"W": "width", "D": "depth", "H": "height", "L": "length"}


def shape_fields(labels: str) -> tuple:
    return tuple(LETTER[x] for x in labels.split())


@pack("DSH")
def _(r):
    r.rewrite(lambda t: plain_quotes(inline_vulgar(first_size_block(t))))
    r.rewrite(drop_size_prefix)
    r.clean(
        (r'(?i)([\d.]+)\s*&\s*[\d.]+(["\s]*H)', "$1$2"),
        (r"(?i)\bDiam(?:eter)?\b", "DIA"),
        (r'(?i)([\d.]+)"(?:\s*,?\s*[\d.]+")*\s*or\s*[\d.]+"\s*H', '$1" H'),
        (r'(?i)([\d.]+)(?:/[\d.]+)+"\s*H', '$1" H'),
        (r"(?i)([\d.]+)\s*OAH\b", '$1" H'),
        (r'(?i)([\d.]+)-[\d.]+(["\s]*DIA)', "$1$2"),
    )
    r.rewrite(drop_parentheses)
    m = r'["\s]*'
    r.take("diameter", rf"(?i){ND}{m}DIA")
    r.take("depth", rf"(?i)DIA\s*x\s*{ND}{m}D\b")
    r.take("height", rf"(?i)DIA(?:\s*x\s*[\d.]+{m}D)?\s*x\s*{ND}{m}H(?!\s*x|\w)")
    for labels in ("W D H", "W L H", "L D H", "L W H", "H L D", "D W H", "W H D"):
        r.shape(shape_fields(labels), labelled_shape(labels), override=True)
    r.shape(("width", "depth", "height"), labelled_shape("W W H"), override=True)
    r.shape(("width", "length", "height"), rf'(?i)W\s*{ND}"\s*x\s*L\s*{ND}"\s*x\s*H\s*{ND}"', override=True)
    r.settle()
    r.shape(("width", "height"), labelled_shape("W H", tail=r"(?!\s*x)"), unless=("width", "height"))
    r.settle()
    r.shape(("height", "diameter"), rf"(?i){ND}{m}H\s*x\s*{ND}{m}DIA", unless=("diameter", "height"))
    r.settle()
    r.shape(("height", "depth"), labelled_shape("H D", tail=r"(?!\s*x|\w)"), unless=("height", "depth"))
    r.shape(("width", "length", "depth"), labelled_shape("W L T", tail=r"\b"), override=True)
    r.settle()
    r.shape(("width", "height", "depth"), rf"(?i){ND}{m}x\s*{ND}{m}x\s*{ND}{m}D\b", unless=("width", "height"))
    r.take("height", rf"(?i){ND}{m}H\b")
    r.take("length", rf"(?i)Length\s*[:\-]?\s*{ND}")
    r.take("weight", rf"(?i)Weight\s*[:\-]?\s*(?:approx\.?\s*)?{ND}")
    r.take("seat_height", rf"(?i)Seat\s*Height\s*[:\-]?\s*{ND}", rf"(?i)Seat\s*[:\-]\s*{ND}{m}H", rf"(?i){ND}{m}Seat\s*Height")
    r.take("seat_depth", rf"(?i)Seat\s*[:\-]\s*[\d.]+{m}H\s*x\s*{ND}{m}D")
    r.take("seat_width", rf"(?i)Seat\s*Width\s*[:\-]?\s*{ND}")
    r.take("arm_height", rf"(?i)Arm\s*Height\s*[:\-]?\s*{ND}", rf"(?i)Arm\s*[:\-]\s*{ND}{m}H")


@pack("HEN")
def _(r):
    r.rewrite(plain_quotes)
    r.clean((r"\n", " "), (r'(\d)\s*"\s*', '$1" '), (r"\s+", " "))
    mark = r'"?\s*'
    runs = ("W H D", "W D H", "W H L", "L W H", "D W H", "W H", "W D", "W L", "H D", "H L", "D L")
    shapes = [(shape_fields(s), labelled_shape(s, mark=mark, sep=X)) for s in runs]
    dia = rf"(?i){ND}{mark}(?:diameter|dia){X}{ND}"
    shapes += [(("diameter", "height"), dia + mark + "H"), (("diameter", "depth"), dia + mark + "D"), (("diameter", "height"), dia + '"')]
    matched = r.cascade(*shapes)
    r.settle()
    nums = r.stage(grab_all(r.t, rf'{ND}"'))
    r.by_count(nums, {3: ("width", "height", "depth"), 2: ("width", "height")}, when=~matched, at_least=3)
    one = (F.size(nums) == 1) & ~matched
    hint = r.stage(
        F.when(has(r.t, "(?i)dia"), "diameter")
        .when(has(r.t, r"(?i)W\b"), "width")
        .when(has(r.t, r"(?i)H\b"), "height")
        .when(has(r.t, r"(?i)D\b"), "depth")
        .when(has(r.t, r"(?i)L\b"), "length")
        .otherwise("width")
    )
    for f in ("diameter", "width", "height", "depth", "length"):
        r.put(f, F.get(nums, F.lit(0)), when=one & (hint == f))


@pack("AK")
def _(r):
    r.rewrite(squeeze)
    num = r"((?:\d+(?:\.\d+)?(?:\s*(?:¼|½|¾))?(?:\s+\d/\d)?|\d+/\d))"
    r.cascade(
        (("diameter", "height"), rf"(?i)\b{num}\s*dia\s*x\s*{num}\s*h\b"),
        (("width", "depth", "height"), rf"(?i)\b{num}\s*x\s*{num}\s*x\s*{num}\s*h\b"),
        (("diameter", "depth"), rf"(?i)\b{num}\s*dia\s*x\s*{num}\s*d\b"),
        (("height", "diameter"), rf"(?i)\b{num}\s*h\s*x\s*{num}\s*dia\b"),
        (("diameter", "height"), rf"(?i)\b{num}\s*dia\s*x\s*{num}(?:\b|$)"),
        pick="last",
    )
    r.each(lambda v: fraction_text(v, 2, "raw"))


@pack("NC")
def _(r):
    num = r"(\d+\.?\d*)"
    r.consume("diameter", rf"(?i){num}\s*(?:DIAM|DIA)\b", rf"(?i)Diameter[:\s]*{num}")
    m = r"\s*[\"']?\s*"
    matched = r.cascade(
        (("width", "depth", "height"), labelled_shape("W D H", num, m, X)),
        (("width", "depth", "height"), labelled_shape("W D", num, m, X) + X + num),
    )
    for f, a in (("width", "W"), ("depth", "D"), ("height", "H")):
        alone = ~matched & r.get("diameter").isNull() if f == "depth" else ~matched
        r.put(f, grab(r.t, rf"(?i){num}{m}{a}\b"), when=alone)


@pack("BEN")
def _(r):
    r.rewrite(plain_quotes)
    r.rewrite(lambda t: sub(t, r"(?i)COM-?\s*[0-9.]+\s*(?:yards?)?", ""))
    num = r"([0-9.]+)"
    r.take("seat_height", rf'(?i)\(?{num}"?\s*H?\s*to\s+seat', rf'(?i)Seat\s+Height[:\s]*{num}"?')
    r.settle()
    r.clean((r'(?i)\(?[0-9.]+"?\s*H?\s*to\s+seat\)?', ""), (r'(?i)Seat\s+Height[:\s]*[0-9.]+"?', ""))
    run = rf'{num}"?\s*x\s*{num}"?\s*x\s*{num}"?\s*([HhDd])?'
    tail_is_depth = F.upper(F.regexp_extract(r.t, run, 4)) == "D"
    text = "string"
    seed = F.struct(
        grab(r.t, run, 1).alias("l"),
        grab(r.t, run, 2).alias("w"),
        F.when(~tail_is_depth, grab(r.t, run, 3)).alias("h"),
        F.when(tail_is_depth, grab(r.t, run, 3)).alias("d"),
        F.lit(None).cast(text).alias("o"),
    )
    toks = grab_all(r.t, r'([0-9.]+\s*"?\s*[A-Za-z]*)')

    def step(acc, tok):
        lab = F.upper(F.regexp_extract(tok, "([A-Za-z]*)$", 1))
        value = F.regexp_extract(tok, r"([0-9.]+)", 1)
        kind = (
            F.when(lab.contains("H") & acc["h"].isNull(), "h")
            .when(lab.contains("W") & acc["w"].isNull(), "w")
            .when(lab.contains("L") & acc["l"].isNull(), "l")
            .when(lab.contains("DIA"), "o")
            .when(lab.contains("D") & acc["d"].isNull(), "d")
        )
        return F.struct(*[F.when(kind == k, value).otherwise(acc[k]).alias(k) for k in ("l", "w", "h", "d", "o")])

    found = r.stage(F.aggregate(toks, seed, step))
    for f, k in (("length", "l"), ("width", "w"), ("height", "h"), ("depth", "d"), ("diameter", "o")):
        r.put(f, found[k])
    r.put("length", grab_last(r.t, r"([0-9]+\.?[0-9]*)"))
    r.each(lambda v: blank_to_null(sub(v, r"[^\d.]+", "")))


@pack("PB")
def _(r):
    r.rewrite(lambda t: F.replace(plain_quotes(t), F.lit("×"), F.lit("x")))
    parts = r.stage(F.filter(F.transform(F.split(r.t, r"\||<br>|;|\n"), squeeze), lambda p: p != ""))
    owned = {"seat_height": "seat height", "seat_depth": "seat depth", "arm_height": "arm height", "weight": r"\b(?:weight|lbs|ibs|lb|kg)\b"}
    for f, w in owned.items():
        mine = F.filter(parts, like(f"(?i){w}"))
        r.put(f, grab(F.try_element_at(mine, F.lit(-1)), N))
    r.put("seat_height", grab(r.t, rf'(?i)\bseat\s*{N}\s*"?\s*h\b'))
    rest = r.stage(F.filter(parts, lambda p: ~F.lower(p).rlike("|".join(owned.values()))))

    def first_in_parts(*pats):
        vals = F.transform(rest, lambda p: F.coalesce(*[grab(p, x) for x in pats]))
        return F.get(F.filter(vals, lambda v: v.isNotNull()), F.lit(0))

    num = rf'(?i){N}\s*"?\s*'
    r.put("height", first_in_parts(num + r"oah\b", num + r"h\b", rf"(?i)^(?=.*overall height|.*height$).*?{N}"))
    r.put("diameter", first_in_parts(num + r"dia\.?\b", rf"(?i)^(?=.*diameter|.*\bdia\b).*?{N}"))
    r.put("width", first_in_parts(num + r"w\b"))
    r.put("depth", first_in_parts(num + r"d\b", rf"(?i)^(?=.*projection).*?{N}"))
    shades = F.flatten(F.transform(F.filter(rest, lambda p: F.lower(p).contains("shade")), lambda p: grab_all(p, N)))
    r.put("shade", blank_to_null(F.array_join(F.array_distinct(shades), ",")))


@pack("WA")
def _(r):
    variant = r"(?:Waist-shaped|Oval|Round|Square|Circular)\s*:"
    lead = r"(?:Rectangular|Standard|First)\s*:\s*"
    r.rewrite(lambda t: spell_vulgar(spell_super_sub(plain_quotes(F.trim(t)))))
    r.rewrite(
        lambda t: F.when(
            has(t, f"(?i){variant}"),
            F.coalesce(grab(t, rf"(?is){lead}(.*?)(?:{variant}|\z)"), F.regexp_extract(t, rf"(?is)^(.*?){variant}", 1)),
        ).otherwise(t)
    )
    r.clean((f"(?i)^{lead}", ""), (r"(?i)OVERALL\s*:\s*", ""), (r"(?i)\([^)]*(?:cm|mm|m)[^)]*\)", ""))
    num = r"(\d+(?:\s+\d+/\d+)?(?:\.\d+)?)"
    unit = r"""\s*(?:"|in(?:ches)?|'|)"""
    for f, word in SEAT_ARM.items():
        side = r"\s*(?:front|rear|back)?" if f == "seat_width" else ""
        r.consume(f, rf"(?i){word}{side}\s*[:\s]*{num}{unit}")
    r.consume("seat_height", rf"(?i)H\s*\(\s*seat\s*\)\s*[:\s]*{num}{unit}", unless=("seat_height",))
    for f, a in (("seat_height", "SH"), ("seat_depth", "SD"), ("seat_width", "SW"), ("arm_height", "AH")):
        r.consume(f, rf'(?i){N}\s*"\s*{a}\b', rf'(?i)\b{a}\s*[:\s]\s*{N}\s*(?:"|in)?', unless=(f,))
    r.consume("weight", rf"(?i){N}\s*(?:ibs|ib|lbs?|pounds?)\b", rf"(?i)weight\s*[:\s]*{N}")
    r.consume("diameter", rf"(?i)(?:Diameter|Diam\.?|Dia\.?)\s*[:\s]*{num}{unit}", rf'(?i){N}\s*(?:"|in)\s*(?:Diameter|Diam\.?|DIA)\b')
    mark = r"""\s*(?:"|in(?:ches)?|')\s*"""
    labels = {"width": "W", "depth": "D", "height": "(?:H|OAH)", "length": "L"}
    for f, a in labels.items():
        r.take(f, rf"(?i){num}{mark}{a}\b")
    r.settle()
    compact = F.coalesce(*[r.get(f) for f in labels]).isNotNull()
    gap = r"\s*(?:\([^)]*\)\s*)?[:\s]*"
    words = {"width": r"(?:width|\bW\b)", "depth": r"(?:depth|\bD\b)", "height": r"(?:height|OAH|\bH\b)", "length": r"(?:length|\bL\b)"}
    for f, w in words.items():
        r.put(f, grab(r.t, rf"(?i)(?<!\bSEAT\s)(?<!\bARM\s){w}{gap}{num}"), when=~compact)
    r.each(lambda v: fraction_text(v, 4, "raw"))


@pack("SB")
def _(r):
    lines = F.filter(F.transform(F.split(r.t, r"(?i)<br\s*/?>|\n|\|"), lambda x: plain_quotes(F.trim(drop_tags(spell_vulgar(x), "")))), lambda x: x != "")
    named = r"(?i)(?:Seat\s+Height|Seat\s+Depth|Arm\s+Height)"
    lines = r.stage(F.flatten(F.transform(lines, lambda x: F.when(x.rlike(named), F.split(x, r",\s*")).otherwise(F.array(x)))))
    # A line is owned by the first of these words it holds.
    kinds = (("weight", r"(?i)Weight\s*[:\s]*(?:approx\.?\s*)?([\d,.]+)\s*(?:lbs?|kg|ibs?)"),) + tuple(
        (f, rf"(?i){SEAT_ARM[f].replace('*', '+')}\s*[:\s]*([^\n,|]+)") for f in ("seat_height", "seat_depth", "arm_height")
    )
    for i, (f, p) in enumerate(kinds):
        earlier = [q for _, q in kinds[:i]]

        mine = lines
        for q in earlier:
            mine = F.filter(mine, lambda x: ~like(q)(x))
        raw = grab(F.try_element_at(F.filter(mine, like(p)), F.lit(-1)), p)
        r.put(f, F.replace(raw, F.lit(","), F.lit("")) if f == "weight" else plain_measure(raw))
    sized = F.filter(lines, lambda x: ~F.lower(x).rlike("weight|seat height|seat depth|arm height") & x.rlike(r"\d") & (x.contains('"') | x.rlike(r"(?i)\d\s*in")))
    r.t = r.stage(F.get(sized, F.lit(0)))
    r.clean((r"×", "x"), (r"(?i)(\d)\s*in\.?\s*", '$1" '), (r"(?i)^[A-Za-z]+\s*:\s*", ""), (r"(?i)^Overall[^:]*:\s*", ""), (r'^[^"\d]*:\s*', ""))
    r.consume("diameter", r'(?i)([\d\s/]+)"\s*DIA(?:METER)?', r'(?i)DIA(?:METER)?\s*[:\s]*([\d\s/]+)"?')
    r.clean((r"^\s*x\s*", ""), (r"\s*x\s*$", ""))
    before = r.stage(grab_all(r.t, r'(?i)\b([LWHDM]\s+[\d\s/.]+")'))
    after = r.stage(grab_all(r.t, r'(?i)([\d\s/.]+"\s*[LWHDM]\b)'))
    every = r.stage(grab_all(r.t, r'(?i)([\d\s/.]+"(?:\s*[LWHDM]\b)?)'))
    lead = (F.size(before) > 0) & (F.size(before) >= F.size(after))
    for f, a in (("length", "L"), ("width", "W"), ("depth", "D"), ("height", "H")):
        pre = F.try_element_at(F.filter(before, like(f"(?i)^{a}")), F.lit(-1))
        post = F.try_element_at(F.filter(after, like(f"(?i){a}$")), F.lit(-1))
        r.put(f, plain_measure(sub(F.when(lead, pre).otherwise(post), "[A-Za-z]", "")))
    r.settle()
    loose = F.when(lead, F.array().cast("array<string>")).otherwise(F.filter(every, lambda x: ~x.rlike("[A-Za-z]")))
    loose = r.stage(F.filter(F.transform(loose, plain_measure), lambda v: v.isNotNull()))
    any_label = r.stage(F.coalesce(*[r.get(f) for f in ("length", "width", "depth", "height")]).isNotNull())
    slots = r.stage(F.filter(F.array(*[F.when(r.get(f).isNull(), F.lit(f)) for f in ("width", "depth", "height")]), lambda s: s.isNotNull()))
    for f in ("width", "depth", "height"):
        at = F.array_position(slots, f)
        r.put(f, F.when(any_label & (at > 0), F.get(loose, (at - 1).cast("int"))))
    r.settle()
    r.by_count(
        loose,
        {1: ("length",), 2: ("length", "width"), 3: ("length", "width", "height"), 4: ("length", "width", "depth", "height")},
        when=~any_label,
        at_least=4,
    )


def plain_measure(c):
    """Number or mixed fraction at the start of a value, two decimals."""
    s = F.trim(F.translate(as_col(c), "\"'", ""))
    return F.coalesce(fraction_text(grab(s, r"^(\d+\s+\d+/\d+)"), 2), grab(s, r"^(\d+(?:\.\d+)?)"))


@pack("EIcm")
def _(r):
    """Metric axes (``W=80;D=40``) or ``a x b x c cm`` given in inches."""
    axes = {f: grab(r.t, rf"(?i)(?:^|[;,\s]){a}\s*=\s*{N}") for f, a in WDHL.items()}
    seen = sum((v.isNotNull().cast("int") for v in axes.values()), F.lit(0))
    enough = r.stage(seen >= 2)
    for f, v in axes.items():
        r.put(f, number_text(v.try_cast("double") / 2.54, 2), when=enough)
    run = rf"{ND}{X}{ND}{X}{ND}\s*cm"
    for i, f in enumerate(("width", "depth", "height"), start=1):
        r.put(f, number_text(grab(r.t, run, i).try_cast("double") / 2.54, 2), when=~enough)


