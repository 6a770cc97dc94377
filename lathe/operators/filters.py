"""Row and value predicates."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.rx import as_col, is_blank, lines_of, present
from ..functions.urls import valid_url

# Phrases of pages that block a reader.
BLOCK_SIGNALS = (
    "verify you are human",
    "are you human",
    "access denied",
    "unusual traffic",
    "403 forbidden",
    "captcha",
    "cloudflare",
    "bot detection",
    "please enable javascript",
    "checking your browser",
    "ddos protection",
    "ray id",
)

# Words of shop notices that are no product detail.
NOTICE_WORDS = (
    "PAYMENT",
    "SHIPPING",
    "VISA",
    "MASTERCARD",
    "AMERICAN EXPRESS",
    "DISCOVER",
    "APPLE PAY",
    "White Glove",
    "Standard Delivery",
    "RETURNS",
)


def with_url(df: DataFrame, url: str) -> DataFrame:
    """D1."""
    return df.filter(valid_url(url))


def with_key(df: DataFrame, key: str) -> DataFrame:
    """D2."""
    return df.filter(~is_blank(key))


def unfilled(df: DataFrame, column: str) -> DataFrame:
    """D3."""
    return df.filter(is_blank(column))


def type_matches(product_type, type_filter) -> Column:
    """Only where the category configures a filter."""
    f = as_col(type_filter)
    return f.isNull() | F.coalesce(F.lower(as_col(product_type)).contains(F.lower(f)), F.lit(False))


def by_category_type(df: DataFrame, category_dim: DataFrame, category: str, product_type: str) -> DataFrame:
    """D5 against the configured categories."""
    dim = category_dim.select(F.col("category").alias("__c"), F.col("type_filter").alias("__f"))
    joined = df.join(dim, F.col(category) == F.col("__c"), "left")
    return joined.filter(type_matches(product_type, "__f")).drop("__c", "__f")


def complete(df: DataFrame, *columns: str) -> DataFrame:
    """D6."""
    for c in columns:
        df = df.filter(~is_blank(c))
    return df


def is_blocked(html) -> Column:
    """D8."""
    return F.lower(as_col(html)).rlike("|".join(BLOCK_SIGNALS))


def valid_finish(c, bad_words=()) -> Column:
    """D10."""
    v = F.trim(as_col(c))
    ok = (v != "") & ~v.rlike(r"[\d/]") & (F.length(v) <= 25) & (F.size(F.split(v, r"\s+")) <= 3)
    ok = ok & ~F.upper(v).startswith("STR") & ~F.lower(v).contains("select")
    for w in bad_words:
        ok = ok & ~F.lower(v).contains(w)
    return F.coalesce(ok, F.lit(False))


def dimension_line(c) -> Column:
    """Starts with a digit or with a bed size."""
    return F.coalesce(as_col(c).rlike(r"(?i)^(?:\d|(?:queen|king|ca\s*king|twin|full|standard)\s*:)"), F.lit(False))


def dimension_like(c) -> Column:
    """Any sign of a measure, but no product line."""
    t = F.lower(as_col(c))
    signs = r"""\d+(?:\.\d+)?\s*["”]?\s*[hwd]\b|\boah\b|diameter|\bdia\.?\b|seat height|seat depth|arm height|projection|shade"""
    return F.coalesce(~t.contains("product") & t.rlike(signs), F.lit(False))


def size_lines(c, n: int | None = None) -> Column:
    """Lines with a number and a size letter, the first n if given."""
    hits = F.filter(lines_of(c), lambda x: x.rlike(r"\d") & x.rlike(r"(?i)\b[HWD]\b|Dia|Ø"))
    return F.slice(hits, 1, n) if n else hits


def first_n(arr, n: int) -> Column:
    """I4."""
    return F.slice(as_col(arr), 1, n)


def looks_inch(c) -> Column:
    """D13."""
    v = F.lower(as_col(c))
    return v.contains('"') | v.contains(" inch") | v.contains(" in.") | v.contains(" in ")


def looks_feet(c) -> Column:
    v = F.lower(as_col(c))
    return v.contains("'") | v.contains(" ft") | v.contains("feet")


def product_details(parts, noise=NOTICE_WORDS) -> Column:
    """Detail parts that mention no shop notice."""

    def clean(p):
        hit = F.lit(False)
        for w in noise:
            hit = hit | F.upper(p).contains(w.upper())
        return ~hit

    return F.filter(as_col(parts), clean)


def status_of(found: str) -> Column:
    """Row status after a left join with details."""
    return F.when(present(found).isNull(), F.lit("failed")).otherwise(F.lit("success"))
