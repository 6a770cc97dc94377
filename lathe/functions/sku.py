"""SKU text and generated SKUs."""

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from .rx import as_col, blank_to_null, grab, grab_all, present, sub
from .text import SKU_TOKEN, squeeze


@dataclass(frozen=True)
class SkuPolicy:
    """How one vendor builds a SKU from its name, the category and a serial number."""

    keep: str = "[^A-Za-z]"  # characters removed from both names
    vendor_len: int = 3
    category_len: int = 2
    pad: str = "X"  # '' leaves short codes short
    empty_vendor: str = ""
    empty_category: str = ""
    separator: str = ""
    digits: int = 0  # zero fill; 0 = plain number


STANDARD = SkuPolicy(digits=3)
PLAIN = SkuPolicy()
ALNUM = SkuPolicy(keep="[^A-Za-z0-9]")
FALLBACK = SkuPolicy(pad="", empty_vendor="VEN", empty_category="CA")
DASHLESS = SkuPolicy(keep="-", pad="")
SPACELESS = SkuPolicy(keep="[ -]", pad="")
HYPHENATED = SkuPolicy(keep="$^", pad="", separator="-")
TWO_DIGITS = SkuPolicy(digits=2)


def zero_fill(n, width: int) -> Column:
    """Like zfill: longer numbers are never cut (``lpad`` would)."""
    s = as_col(n).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def _code(c, keep: str, size: int, pad: str, empty: str) -> Column:
    code = F.substring(F.upper(sub(F.coalesce(as_col(c), F.lit("")), keep, "")), 1, size)
    if pad:
        return F.rpad(code, size, pad)
    return F.when(code == "", F.lit(empty)).otherwise(code)


def generated_sku(vendor, category, index, policy: SkuPolicy = STANDARD) -> Column:
    """K50. An index such as "5.0" counts as 5, a missing one as 0."""
    i = F.coalesce(F.regexp_replace(present(as_col(index).cast("string")), r"\.0$", ""), F.lit("0"))
    if policy.digits:
        i = zero_fill(i, policy.digits)
    v = _code(vendor, policy.keep, policy.vendor_len, policy.pad, policy.empty_vendor)
    c = _code(category, policy.keep, policy.category_len, policy.pad, policy.empty_category)
    return F.concat(v, F.lit(policy.separator), c, F.lit(policy.separator), i)


def sku_or_generated(page_sku, slug_sku, generated) -> Column:
    """Page, then URL slug, then generated; "missing" never survives."""
    def known(c):
        s = present(c)
        return F.when(F.lower(s) != "missing", s)

    return F.coalesce(known(page_sku), known(slug_sku), as_col(generated))


def sku_token(c) -> Column:
    """Blanks out, hyphenated token preferred, trailing ``p`` dropped."""
    t = sub(c, r"(?U)\s+", "")
    token = F.coalesce(grab(t, r"(?<![A-Za-z0-9])([A-Za-z0-9]++(?:[-_][A-Za-z0-9]++)+)"), sub(t, r"[^A-Za-z0-9\-_]", ""))
    return blank_to_null(sub(token, r"(?i)[-_]?p$", ""))


def sku_capitalised(c) -> Column:
    """Only the prefix before the first dash is re-cased."""
    c = as_col(c)
    head = F.substring_index(c, "-", 1)
    return F.concat(F.upper(F.substring(head, 1, 1)), F.lower(F.substring(head, F.lit(2), F.length(head))), F.substring(c, F.length(head) + 1, F.length(c)))


def sku_two_segments(c) -> Column:
    """K54."""
    s = sub(F.trim(as_col(c)), r"^[,;/|]+|[,;/|]+$", "")
    parts = F.split(s, r"[-\s,/|]+")
    a, b = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    return F.coalesce(grab(s, r"^([A-Za-z0-9]+-[A-Za-z0-9]+)"), F.when((a != "") & (b != ""), F.concat(a, F.lit("-"), b)), s)


def _tidy(c) -> Column:
    t = F.trim(sub(squeeze(c), r"[.,;:)\]]+$", ""))
    return F.when(F.length(t) > 1, t)


def sku_from_labels(c) -> Column:
    """Value after a SKU label, label kinds in fixed order."""
    return F.trim(
        F.coalesce(
            grab(c, r"(?i)(?:SKU|Item #?|Product #?|Model #?|Item No\.?|Style #?)\s*:?\s*([A-Z0-9\-_]{3,30})"),
            grab(c, r"""(?i)(?:sku|item_id|product_id)\s*["']?\s*:\s*["']?([A-Z0-9\-_]{3,30})"""),
        )
    )


def sku_from_item_line(c) -> Column:
    """Item numbers that may hold blanks and slashes."""
    t = squeeze(F.translate(as_col(c), "·•", "  "))
    body = r"([A-Z0-9][A-Z0-9/\-\s]*[A-Z0-9])"
    return F.coalesce(_tidy(grab(t, rf"(?i)Item\s*no\.?\s*[:\-]?\s*{body}")), _tidy(grab(t, rf"(?i)SKU\s*[:#]?\s*{body}")))


def sku_from_html(c) -> Column:
    """The JSON ``sku`` key first, then an item number line."""
    return F.coalesce(_tidy(grab(c, r'(?i)"sku"\s*:\s*"([^"]+)"')), sku_from_item_line(c))


def sku_tokens(c) -> Column:
    """Every dashed token with a digit, upper case, first occurrence kept."""
    return F.array_distinct(F.filter(grab_all(F.upper(as_col(c)), f"({SKU_TOKEN})"), lambda t: t.rlike(r"\d")))


def sku_tokens_labelled(c) -> Column:
    """Tokens after a SKU label; failing that, any code with a digit."""
    c = as_col(c)
    labelled = grab_all(c, r"(?i)\bSKU\b\s*[:#]?\s*([A-Z0-9][A-Z0-9\-_/]{2,})")
    loose = F.filter(grab_all(F.upper(c), r"\b([A-Z0-9][A-Z0-9\-_/]{2,})\b"), lambda t: t.rlike(r"\d"))
    return F.when(F.size(labelled) > 0, labelled).otherwise(loose)


def sku_tokens_safe(tokens, name) -> Column:
    """Tokens that are not part of the product name."""
    n = F.upper(F.trim(F.coalesce(as_col(name), F.lit(""))))
    up = F.transform(as_col(tokens), lambda t: F.upper(F.trim(t)))
    return F.array_distinct(F.filter(up, lambda t: (t != "") & t.rlike(r"\d") & ~((n != "") & n.contains(t))))


def looks_like_sku(c) -> Column:
    """D12."""
    t = F.trim(as_col(c))
    return F.coalesce(((F.length(t) <= 12) & t.rlike(r"\d")) | (t.contains("-") & t.rlike("[A-Za-z]")), F.lit(False))
