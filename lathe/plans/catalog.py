"""End-to-end flows: listing to standard catalogue, collections, and site audit."""

from pyspark.sql import DataFrame, functions as F

from ..functions.family import family_id
from ..functions.rx import present
from ..functions.sku import generated_sku
from ..operators.audit import full_audit, site_findings
from ..operators.dedup import demo_then_scope, keep_first, keep_first_in_category
from ..operators.filters import type_matches
from ..operators.joins import enrich, pending
from ..operators.ordered import running_index
from ..operators.projection import CATALOG_COLUMNS, exact_columns
from ..session import stored
from ..spec.packs import extract_dimensions

FIELD_OF = {
    "Weight": "weight",
    "Width": "width",
    "Depth": "depth",
    "Diameter": "diameter",
    "Length": "length",
    "Height": "height",
    "Seat Width": "seat_width",
    "Seat Depth": "seat_depth",
    "Seat Height": "seat_height",
    "Arm Height": "arm_height",
    "Arm Width": "arm_width",
}


def standard_catalogue(listing: DataFrame, pack: str, order: str = "ord", rule: str = "R1") -> DataFrame:
    """Re-parse flow: de-duplicate by URL, number inside the category, read the spec text, standard columns.

    Numbering scans its input several times, so the unique rows are stored first.
    ``listing``: ord, Category, Manufacturer, Product URL, Product Name, SKU, Specifications, …
    """
    unique = stored(keep_first(listing, "Product URL", order), "unique")
    numbered = running_index(unique, order, ["Category"], "Index")
    read = extract_dimensions(numbered, "Specifications", pack)
    named = read.withColumns(
        {
            "Source": F.col("`Product URL`"),
            "Product Family Id": family_id("`Product Name`", rule),
            "SKU": F.coalesce(present("SKU"), generated_sku("Manufacturer", "Category", "Index")),
            **{c: F.col(f"dims.{f}") for c, f in FIELD_OF.items()},
        }
    )
    return exact_columns(named, ["Category", "Index", *CATALOG_COLUMNS])


def two_stage(listing: DataFrame, done: DataFrame, detail: DataFrame, url: str, category: str, order: str, detail_wins) -> DataFrame:
    """Two-stage flow: de-duplicate in the category, skip what is done, enrich with details."""
    fresh = pending(keep_first_in_category(listing, category, url, order), done, url)
    return enrich(fresh, detail, url, detail_wins)


def collection_flow(products: DataFrame, category_dim: DataFrame, limit: int | None = None, demo: bool = False) -> DataFrame:
    """Collection flow: type filter, de-duplication by scope and order, optional demo limit; rows without SKU and handle go.

    ``products``: category, handle, sku, product_type, ord. The configuration is broadcast: its size is not
    known to Spark, and a join on the category would put each category's rows into one task.
    """
    dim = category_dim.select("category", F.col("ord").alias("category_ord"), "dedup_scope", "type_filter")
    rows = products.join(F.broadcast(dim), "category").filter(type_matches("product_type", "type_filter")).drop("type_filter")
    keyed = rows.withColumn("key", F.coalesce(F.concat(F.lit("s:"), present("sku")), F.concat(F.lit("h:"), present("handle"))))
    return demo_then_scope(keyed.filter(F.col("key").isNotNull()), "category", "key", "dedup_scope", ["category_ord", "ord"], limit, demo).drop("key")


def site_audit(urls: DataFrame, pages: DataFrame, url: str, site: str, order: str) -> DataFrame:
    """Audit flow: page metrics, site findings, one complete record per asked URL."""
    return full_audit(urls, pages, site_findings(pages, site, order), url, site)


