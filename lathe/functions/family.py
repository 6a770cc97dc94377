"""Product family id rules (K57): one column expression per rule."""

from pyspark.sql import Column, DataFrame, functions as F

from .rx import as_col, blank_to_null, cut_before, sub
from .text import squeeze

# Trailing words that name a colour or finish, not the family.
COLOUR_WORDS = (
    "Black", "White", "Gray", "Grey", "Brown", "Beige", "Ivory", "Walnut", "Natural", "Gold", "Silver", "Bronze",
    "Chrome", "Blue", "Green", "Red", "Pink", "Orange", "Yellow", "Purple", "Teal", "Cream", "Taupe", "Rust",
    "Charcoal", "Navy", "Brass", "Copper", "Nickel", "Oak", "Ash", "Mahogany", "Espresso", "Cognac", "Caramel",
    "Tan", "Sand", "Sage", "Olive", "Moss", "Slate", "Smoke", "Pewter", "Antique", "Multicolor", "Clear", "Frosted",
    "Matte", "Glossy",
)


def _head(c, pattern: str) -> Column:
    return F.trim(F.get(F.split(as_col(c), pattern, 2), F.lit(0)))


def before_spaced_dash(c) -> Column:
    return F.trim(cut_before(c, " - "))


def before_mark(c) -> Column:
    return _head(c, r"[,._\-]")


def before_mark_or_at(c) -> Column:
    return _head(c, r"[,._\-@]")


def drop_last_comma_part(c) -> Column:
    parts = F.filter(F.transform(F.split(as_col(c), ","), lambda x: F.trim(x)), lambda p: p != "")
    keep = F.greatest(F.size(parts) - 1, F.lit(1))
    return F.array_join(F.slice(parts, F.lit(1), keep), ", ")


def before_any_dash(c) -> Column:
    return _head(c, r"\s*[-–—]\s*")


def before_dash_blank(c) -> Column:
    return _head(c, r"\s*-\s+")


def bracket_comma_dash(c) -> Column:
    c = F.trim(as_col(c))
    return F.trim(F.when(c.contains("("), cut_before(c, "(")).when(c.contains(","), cut_before(c, ",")).otherwise(cut_before(c, " - ")))


def strip_variant_marks(c) -> Column:
    c = F.trim(as_col(c))
    for dash in ("–", "—", " - "):
        c = F.trim(cut_before(c, dash))
    for tail in (r"\s*\(.*?\)\s*", r"_\S+$", r"\.\d+$", r"\s*#\d+$"):
        c = F.trim(sub(c, tail, ""))
    return c


def without_trailing_colours(c) -> Column:
    words = F.split(squeeze(c), " ")
    links = ("&", "and", "-")

    def rstrip_words(arr, pool):
        # Length of the leading part that ends with the last word outside the pool.
        keep = F.array_max(F.transform(arr, lambda w, i: F.when(w.isin(*pool), F.lit(0)).otherwise(i + 1)))
        return F.when(keep > 0, F.slice(arr, F.lit(1), keep)).otherwise(F.array().cast("array<string>"))

    return F.array_join(rstrip_words(rstrip_words(words, COLOUR_WORDS), links), " ")


def sku_prefix(c) -> Column:
    c = as_col(c)
    return F.trim(F.when(c.contains("-"), cut_before(c, "-")).otherwise(cut_before(F.trim(c), " ")))


def first_three_words(c) -> Column:
    words = F.filter(F.split(F.replace(squeeze(c), F.lit(","), F.lit(" ")), " "), lambda w: w != "")
    return F.array_join(F.slice(words, 1, 3), " ")


def first_token(c) -> Column:
    return _head(F.trim(as_col(c)), r"[\s\-._]+")


def first_word(c) -> Column:
    return cut_before(squeeze(c), " ")


def before_in(c) -> Column:
    return F.trim(cut_before(c, " in "))


def comma_or_light_suffix(c) -> Column:
    c = F.trim(as_col(c))
    cleaned = F.trim(sub(c, r"(?i)\s+CHANDELIER.*$", ""))
    cleaned = F.trim(sub(cleaned, r"(?i)[-\s]+\w*[-]?LIGHT\s*$", ""))
    return F.when(c.contains(","), F.trim(cut_before(c, ","))).otherwise(F.coalesce(blank_to_null(cleaned), c))


def comma_or_dash(c) -> Column:
    c = as_col(c)
    return F.trim(F.when(c.contains(","), cut_before(c, ",")).otherwise(cut_before(c, "-")))


def without_size_words(c) -> Column:
    c = sub(c, r"(?i)\b(?:Side|Coffee|End|Accent)\s+(?:Table|Desk)?\b", "")
    c = sub(c, r"\d+[WwHhDd]\s*[xX×]\s*\d+[WwHhDd].*", "")
    return F.trim(sub(c, r"\(.*?\)", ""))


def name_itself(c) -> Column:
    return F.trim(as_col(c))


def en_dash_then_spaced_dash(c) -> Column:
    c = as_col(c)
    return F.trim(F.when(c.contains("–"), cut_before(c, "–")).otherwise(cut_before(c, " - ")))


def title_separators(c) -> Column:
    c = as_col(c)
    return F.when(c.contains("–"), F.trim(cut_before(c, "–"))).when(c.contains(" - "), F.trim(cut_before(c, " - "))).when(c.contains("|"), F.trim(cut_before(c, "|"))).otherwise(c)


def before_bare_dash(c) -> Column:
    return F.trim(cut_before(F.trim(as_col(c)), "-"))


def before_comma(c) -> Column:
    return F.trim(cut_before(c, ","))


RULES = {
    "R1": before_spaced_dash,
    "R2": before_mark,
    "R2g": before_mark_or_at,
    "R3": drop_last_comma_part,
    "R4": before_any_dash,
    "R4b": before_dash_blank,
    "R5": bracket_comma_dash,
    "R6": strip_variant_marks,
    "R7": without_trailing_colours,
    "R8": sku_prefix,
    "R9": first_three_words,
    "R10": first_token,
    "R10w": first_word,
    "R11": before_in,
    "R12": comma_or_light_suffix,
    "R13": comma_or_dash,
    "R14": without_size_words,
    "R15": name_itself,
    "R16": en_dash_then_spaced_dash,
    "R17": title_separators,
    "R18": before_bare_dash,
    "R19": before_comma,
}


def family_id(name, rule: str = "R2g") -> Column:
    return blank_to_null(RULES[rule](name))


def family_by_policy(df: DataFrame, policy: DataFrame, vendor_col: str, name_col: str, out: str = "family_id") -> DataFrame:
    """Rule chosen per vendor from ``policy(vendor, rule)``; vendors without one use R2g.

    The join is left to the optimizer, which broadcasts the policy only below
    its size threshold. Every branch is a literal expression.
    """
    p = policy.select(F.col("vendor").alias("_vendor"), F.col("rule").alias("_rule"))
    joined = df.join(p, F.col(vendor_col) == F.col("_vendor"), "left")
    pick = F.when(F.lit(False), F.lit(None).cast("string"))
    for rule in RULES:
        pick = pick.when(F.col("_rule") == rule, family_id(name_col, rule))
    return joined.withColumn(out, pick.otherwise(family_id(name_col))).drop("_vendor", "_rule")
