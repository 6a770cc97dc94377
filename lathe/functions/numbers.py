"""Numbers, fractions, units and money.

Numbers stay text in the raw layer ("26.75"); ``to_decimal`` gives the typed
clean-layer value. Rounding is half-even throughout.
"""

from pyspark.sql import Column, functions as F

from .rx import as_col, blank_to_null, grab, grab_all, grab_last, has, let, lines_of, present, strip, sub
from .text import squeeze

NUM = r"\d+(?:\.\d+)?"

# Vulgar fraction characters and what they spell.
VULGAR = (
    ("¼", "1/4"),
    ("½", "1/2"),
    ("¾", "3/4"),
    ("⅐", "1/7"),
    ("⅑", "1/9"),
    ("⅒", "1/10"),
    ("⅓", "1/3"),
    ("⅔", "2/3"),
    ("⅕", "1/5"),
    ("⅖", "2/5"),
    ("⅗", "3/5"),
    ("⅘", "4/5"),
    ("⅙", "1/6"),
    ("⅚", "5/6"),
    ("⅛", "1/8"),
    ("⅜", "3/8"),
    ("⅝", "5/8"),
    ("⅞", "7/8"),
)
VULGAR_CHARS = "".join(ch for ch, _ in VULGAR)

# Unit factors.
LB_PER_KG = 2.20462
MM_PER_INCH = 25.4
CM_PER_INCH = 2.54
GRAMS_PER_LB = 453.592


def number_text(x, scale: int = 4) -> Column:
    """Decimal text without trailing zeros; half-even at ``scale``."""
    rounded = F.bround(as_col(x).try_cast("double"), scale).try_cast(f"decimal(24,{scale})").cast("string")
    if scale == 0:
        return rounded
    return F.rtrim(sub(rounded, r"(\.\d*?)0+$", "$1"), F.lit("."))


def to_decimal(c, scale: int = 4) -> Column:
    """Typed value beside the raw text, NULL where it is no number."""
    return as_col(c).try_cast(f"decimal(16,{scale})")


def first_number(c) -> Column:
    """K20."""
    return grab(c, rf"({NUM})")


def number_or_raw(c) -> Column:
    """First number, else the stripped text."""
    return F.coalesce(first_number(c), strip(c))


def whole_number_text(c) -> Column:
    """K20: "5.0" becomes "5"; text without a number is kept."""
    n = first_number(c)
    return F.coalesce(F.when(n.rlike(r"\.0+$"), sub(n, r"\.0+$", "")).otherwise(n), as_col(c))


def spell_vulgar(c) -> Column:
    """Every vulgar fraction spelled " n/d"."""
    c = as_col(c)
    for ch, plain in VULGAR:
        c = F.replace(c, F.lit(ch), F.lit(" " + plain))
    return sub(c, r"  +", " ")


def spell_super_sub(c) -> Column:
    """super/subscript fractions to plain "w n/d"."""
    c = sub(c, r"(\d)(?=[⁰¹²³⁴⁵⁶⁷⁸⁹]+⁄[₀₁₂₃₄₅₆₇₈₉])", "$1 ")
    return F.translate(c, "⁰¹²³⁴⁵⁶⁷⁸⁹₀₁₂₃₄₅₆₇₈₉⁄", "01234567890123456789/")


def fraction_value(c) -> Column:
    """Double value of ``n``, ``n/d`` or ``w n/d`` (also ``w-n/d``), else NULL."""
    mixed = r"^(\d+)(?:\s+|\s*-\s*)(\d+)\s*/\s*(\d+)$"
    plain = r"^(\d+)\s*/\s*(\d+)$"

    def read(s):
        def part(p, g):
            return grab(s, p, g).try_cast("double")

        return F.coalesce(
            grab(s, rf"^({NUM})$").try_cast("double"),
            part(mixed, 1) + part(mixed, 2) / F.nullif(part(mixed, 3), F.lit(0.0)),
            part(plain, 1) / F.nullif(part(plain, 2), F.lit(0.0)),
        )

    return let(F.trim(spell_vulgar(c)), read)


def fraction_text(c, scale: int = 4, on_fail: str = "null", keep_range: bool = False) -> Column:
    """Mixed fractions to decimal text.

    ``on_fail``: ``null`` or ``raw`` for text that is no number.
    ``keep_range``: "23-25" passes through unchanged.
    The numerator is never split: "13/16" is 0.8125.
    """
    def read(raw):
        value = number_text(fraction_value(raw), scale)
        if keep_range:
            value = F.when(raw.rlike(r"^\d+\s*-\s*\d+$"), raw).otherwise(value)
        if on_fail == "raw":
            return F.when(~raw.rlike(r"^[-–—]?$"), F.coalesce(value, raw))
        return value

    return let(F.trim(sub(c, r"[\"'″′”’]|(?i)\b(?:inches|inch)\b", "")), read)


def inline_vulgar(c) -> Column:
    """Fractions inside longer text become decimals in place (13 ⅜" -> 13.375")."""
    c = as_col(c)
    for ch, plain in VULGAR:
        n, d = plain.split("/")
        dec = f"{int(n) / int(d):.4f}".rstrip("0")
        c = sub(c, rf"(\d+)\s*{ch}", "$1" + dec[1:])
        c = F.replace(c, F.lit(ch), F.lit(dec))
    return c


def kg_to_lb(x) -> Column:
    return F.bround(as_col(x).try_cast("double") * LB_PER_KG, 0)


def mm_to_inch(x) -> Column:
    return F.bround(as_col(x).try_cast("double") / MM_PER_INCH, 0)


def grams_to_lb(x) -> Column:
    return as_col(x).try_cast("double") / GRAMS_PER_LB


def cm_to_inch(x) -> Column:
    return F.bround(as_col(x).try_cast("double") / CM_PER_INCH, 2)


def cm_text_to_inch(c) -> Column:
    """K25: "31,5 x 40 cm" to "12.4 x 15.75 inch"; NULL if any part has no number."""
    s = F.trim(as_col(c))
    s = F.when(has(s, r"(?i)[?|]") & has(s, r"(?i)structure"), F.coalesce(F.trim(grab(s, r"(?i)structure\s*-\s*([^?|]+)")), s)).otherwise(s)
    round_shape = has(s, r"(?i)^diam(?:eter|\.)?")
    s = sub(s, r"(?i)^diam(?:eter|\.)?\s*", "")
    s = sub(s, r"(?i)^[lw]x[pd]x[ht]+\s*", "")
    s = F.trim(sub(F.replace(s, F.lit(","), F.lit(".")), r"(?i)\s*cm\s*", ""))
    parts = F.filter(F.transform(F.split(s, r"\s*[xX]\s*"), lambda x: F.trim(x)), lambda p: p != "")
    inches = F.transform(parts, lambda p: number_text(F.regexp_extract(F.substring_index(p, "/", 1), r"\d+\.?\d*", 0).try_cast("double") / CM_PER_INCH, 2))
    ok = ~F.exists(inches, lambda v: v.isNull()) & (F.size(inches) > 0)
    return F.when(ok, F.concat(F.when(round_shape, F.lit("Diam. ")).otherwise(F.lit("")), F.array_join(inches, " x "), F.lit(" inch")))


def prefer_inch(c) -> Column:
    """The last number tied to inches, else the first number; decimal comma kept."""
    inch = grab_last(c, r"(?i)(\d+(?:[.,]\d+)?)\s*(?:\"|\binc?h(?:es)?\b)")
    return F.coalesce(inch, number_keep_comma(c))


def number_keep_comma(c) -> Column:
    return grab(squeeze(c), r"(\d+(?:[.,]\d+)?)")


def inch_line(c) -> Column:
    """First line that speaks of inches."""
    return F.get(F.filter(lines_of(c), lambda x: x.rlike(r"(?i)\b(?:inch|inches)\b|\"")), F.lit(0))


def price_text(c) -> Column:
    """K27."""
    return grab(F.replace(as_col(c), F.lit(","), F.lit("")), r"(\d+\.?\d*)")


def price_whole(c) -> Column:
    """Truncated amount; text that is no amount is kept."""
    s = F.trim(sub(c, r"[$,]", ""))
    return F.coalesce(s.try_cast("double").try_cast("bigint").cast("string"), s)


def price_two_places(c) -> Column:
    """Two decimals, text kept when it is no number."""
    s = present(c)
    return F.coalesce(F.bround(s.try_cast("double"), 2).try_cast("decimal(16,2)").cast("string"), s)


def price_with_symbol(c) -> Column:
    """First amount with its currency sign, else the text as it is."""
    s = F.trim(as_col(c))
    return F.coalesce(F.replace(grab(s, r"([€£$]\s*[\d,]+(?:\.\d+)?)"), F.lit(" "), F.lit("")), s)


def price_first_dollar(c) -> Column:
    """Amount after the first dollar sign ("Tier 1 – $16,650")."""
    return F.replace(grab(F.replace(as_col(c), F.lit("~"), F.lit("")), r"\$\s*([\d,]+(?:\.\d+)?)"), F.lit(","), F.lit(""))


def price_without_msrp(c) -> Column:
    """The list price once any MSRP amount is taken out."""
    s = sub(F.trim(as_col(c)), r"(?i)MSRP\s*\$?\s*[\d,]+", "")
    s = F.coalesce(F.trim(grab(s, r"(\$\s*[\d,]+(?:\.\d+)?)")), F.trim(s))
    return F.trim(sub(sub(s, r"(?i)\bUSD\b", ""), r"\s{2,}", " "))


def cents_heuristic(x) -> Column:
    """Amounts of 1000 and more are cents."""
    v = as_col(x).try_cast("double")
    return F.when(v >= 1000, v / 100).otherwise(v)


def count_from_text(c) -> Column:
    """K31: "1,234 associated members" to 1234."""
    return F.replace(grab(c, r"([\d,]*\d)"), F.lit(","), F.lit("")).try_cast("int")


def typed_number(c) -> Column:
    """K32, text form: whole numbers without a point, non-numbers unchanged."""
    s = F.trim(as_col(c))
    v = s.try_cast("double")
    whole = v.try_cast("bigint")
    return F.when(v.isNull(), s).when(v == whole.cast("double"), whole.cast("string")).otherwise(v.cast("string"))


def nth_numbers(c, n: int, pattern: str = rf"({NUM})") -> list[Column]:
    """The first ``n`` numbers by position."""
    nums = grab_all(c, pattern)
    return [blank_to_null(F.get(nums, F.lit(i))) for i in range(n)]
