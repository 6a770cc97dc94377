"""Page audit: metadata, images, links, trackers, scores, keywords."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.html import attribute, contents, first_tag, inner_all, links, open_tags, page_text
from ..functions.rx import as_col, grab, is_blank, strip, sub
from ..functions.text import decode_entities, html_to_line, plain_words
from ..functions.urls import host, resolve, with_scheme
from .ordered import top_n
from .report import keyword_pages, sorted_set

# Tracker labels and the source patterns that reveal them, in report order.
TRACKERS = {
    "Google Tag Manager": [r"googletagmanager\.com/gtm\.js", r"GTM-[A-Z0-9]+", r"(?s)<noscript>.*googletagmanager\.com/ns\.html\?id=GTM-"],
    "Google Analytics 4": [r"gtag\(\s*'config'\s*,\s*'G-(?=[A-Z0-9]+)", r"G-[A-Z0-9]{6,}", r"googletagmanager\.com/gtag/js\?id=G-"],
    "Google Analytics (UA)": [r"UA-\d{4,}-\d+", r"analytics\.js"],
    "Google Ads (AW)": [r"AW-\d{6,}", r"googletagmanager\.com/gtag/js\?id=AW-"],
    "Meta Pixel": [r"connect\.facebook\.net/.*/fbevents\.js", r"fbq\('init'", r"fbq\('track'"],
    "TikTok Pixel": [r"analytics\.tiktok\.com/i18n/pixel/events\.js", r"ttq\s*=\s*window\.ttq", r"ttq\.track\("],
    "LinkedIn Insight": [r"snap\.licdn\.com/li\.lms-analytics/insight\.min\.js", r"linkedin_partner_id"],
    "Hotjar": [r"static\.hotjar\.com/c/hotjar-", r"hotjar\.com", r"hj\('trigger'"],
    "Microsoft Clarity": [r"clarity/ms\.js", r"clarity\("],
    "HubSpot": [r"js\.hs-analytics\.net", r"hs-scripts\.com"],
    "Segment": [r"cdn\.segment\.com/analytics", r"analytics\.load\("],
}

# Keyword groups by whole word.
KEYWORD_GROUPS = {
    "residential": ("Residential", "Res A/C", "HAC Residential", "Residential AC"),
    "commercial": ("Commercial", "Comm A/C", "Commercial AC", "Commercial HVAC"),
    "industrial": ("Industrial", "Ind A/C", "Industrial AC", "Industrial HVAC"),
}

# Keywords by substring of the cleaned text, with their spellings.
SITE_KEYWORDS = {
    "Home Services": ("home services", "home service"),
    "HVAC": ("hvac",),
    "PET": ("pet",),
    "NURSING": ("nursing",),
    "DOG": ("dog",),
    "CAT": ("cat",),
    "Air Condition": ("air condition",),
    "Heating": ("heating",),
    "Ventilation": ("ventilation",),
    "plumbers": ("plumber", "plumbers", "plumber service", "plumbers service"),
    "electric": ("electric",),
    "pest control": ("pest control",),
    "roofing": ("roofing",),
    "carpet cleaning": ("carpet cleaning",),
}

# Words that make a short text an address candidate.
STREET_WORDS = ("Street", "St.", "Road", "Rd.", "Ave", "Avenue", "Suite", "City", "State")

# Fixed values: (status, has trackers) -> service to offer.
SERVICES = {
    ("Poor", False): "Comprehensive SEO Overhaul + Digital Marketing",
    ("Poor", True): "Comprehensive SEO Overhaul + Digital Marketing",
    ("Fair", False): "SEO Optimization Package",
    ("Fair", True): "SEO + Analytics Review",
    ("Good", False): "Digital Marketing Setup",
    ("Good", True): "Advanced Growth Strategy",
    ("Excellent", False): "Digital Marketing & Growth",
    ("Excellent", True): "Premium Growth & Analytics",
}


def title(html) -> Column:
    """N1."""
    return F.coalesce(strip(decode_entities(grab(html, r"(?is)<title[^>]*>(.*?)</title>"))), F.lit(""))


def meta_description(html) -> Column:
    """N1."""
    tag = first_tag(html, "meta", r"\sname\s*=\s*[\"']?description[\"'\s>]")
    return F.coalesce(strip(attribute(tag, "content")), F.lit(""))


def image_counts(html) -> tuple[Column, Column]:
    """Images and those without an alternative text."""
    tags = open_tags(html, "img")
    return F.size(tags), F.size(F.filter(tags, lambda t: is_blank(attribute(t, "alt"))))


def coverage_label(total, missing) -> Column:
    """N2."""
    total, missing = as_col(total), as_col(missing)
    pct = (total - missing) / F.nullif(total, F.lit(0)) * 100
    shown = F.bround(pct, 0).cast("int").cast("string")
    return (
        F.when(total == 0, "No images found")
        .when(pct == 100, "Excellent (100%)")
        .when(pct >= 80, F.concat(F.lit("Good ("), shown, F.lit("%)")))
        .otherwise(F.concat(F.lit("Poor ("), shown, F.lit("%)")))
    )


def internal_link_count(html, page_url) -> Column:
    """Links that resolve to the page's own host."""
    own = host(page_url)
    return F.size(F.filter(links(html), lambda h: host(resolve(page_url, h)) == own))


def trackers(html) -> Column:
    """Array of labels in fixed order."""
    hits = [F.when(as_col(html).rlike("(?i)" + "|(?i)".join(pats)), F.lit(label)) for label, pats in TRACKERS.items()]
    return F.filter(F.array(*hits), lambda x: x.isNotNull())


def meta_quality(title_text, description) -> Column:
    """N5."""
    t, d = F.length(as_col(title_text)), F.length(as_col(description))
    return F.when((t == 0) & (d == 0), "Poor (missing title & description)").when(t.between(30, 65) & d.between(70, 170), "Good").otherwise("Weak (length issues or missing)")


def image_grade(total, missing) -> Column:
    """N6."""
    total, missing = as_col(total), as_col(missing)
    pct = (total - missing) / F.nullif(total, F.lit(0)) * 100
    return F.when(total == 0, "No images").when(pct == 100, "Excellent").when(pct >= 80, "Good").when(pct >= 50, "Needs improvement").otherwise("Poor")


def overall_status(meta, image, link_count) -> Column:
    """N7."""
    meta, image, n = as_col(meta), as_col(image), as_col(link_count)
    score = (
        F.when(meta.contains("Good"), 3).otherwise(1)
        + F.when(image == "Excellent", 3).when(image == "No images", 2).when(image == "Good", 1).otherwise(0)
        + F.when(n >= 20, 3).when(n >= 10, 2).otherwise(1)
    )
    return F.when(score >= 7, "Excellent").when(score >= 5, "Good").when(score >= 3, "Fair").otherwise("Poor")


def suggestion(status, has_trackers) -> Column:
    """N8."""
    pick = F.when(F.lit(False), F.lit(None).cast("string"))
    for (s, flag), offer in SERVICES.items():
        pick = pick.when((as_col(status) == s) & (as_col(has_trackers) == F.lit(flag)), offer)
    return pick.otherwise("SEO + Digital Marketing Consultation")


def group_pattern(words) -> str:
    return r"(?i)\b(?:" + "|".join(w.replace("/", r"\/") for w in words) + r")\b"


def keyword_groups(text) -> dict[str, Column]:
    """One flag per group."""
    return {g: as_col(text).rlike(group_pattern(words)) for g, words in KEYWORD_GROUPS.items()}


def keyword_found(text, keyword: str) -> Column:
    """Substring of the cleaned text, any spelling."""
    t = plain_words(text)
    hit = F.lit(False)
    for w in SITE_KEYWORDS[keyword]:
        hit = hit | t.contains(w)
    return hit


def site_keywords(pages: DataFrame, site: str, order: str, url: str = "url", html: str = "html", keywords=SITE_KEYWORDS) -> DataFrame:
    """N10 with G10: per site and keyword, Yes or No and the first page in ``order`` that has it, else "".

    Columns ``<keyword>`` and ``<keyword> Source``. The text of a page is what it
    shows without its title, cleaned. The hits of a task are combined before the
    shuffle, so a site with most of the pages costs one row a task. Pages
    without html have no keyword; a NULL site is a site of its own.
    """
    shown = sub(html, r"(?is)<title\b[^>]*>.*?</title\s*>", " ")
    clean = pages.select(site, order, url, plain_words(page_text(shown)).alias("__text"))

    def has(words):
        hit = F.lit(False)
        for w in words:
            hit = hit | F.coalesce(F.col("__text").contains(w), F.lit(False))
        return hit

    flags = clean.select(site, order, url, *[has(words).alias(k) for k, words in keywords.items()])
    found = keyword_pages(flags, site, order, url, keywords, last=False)
    return found.withColumnsRenamed({f"{k}_found": k for k in keywords} | {f"{k}_source": f"{k} Source" for k in keywords})


def address_candidates(html, shorter_than: int | None = None) -> Column:
    """Address elements, and texts of an element with a street word, those shorter than ``shorter_than`` if given."""
    own = F.transform(inner_all(html, "address"), html_to_line)
    # Paragraphs hold no paragraphs; the others nest.
    short = F.flatten(F.array(*[F.transform(found, html_to_line) for found in (inner_all(html, "p"), contents(html, "div"), contents(html, "span"))]))
    words = "|".join(w.replace(".", r"\.") for w in STREET_WORDS)
    short = F.filter(short, lambda x: x.rlike(words) & (F.length(x) < shorter_than if shorter_than else F.lit(True)))
    return F.array_distinct(F.filter(F.concat(own, short), lambda x: x != ""))


# Fixed values (N13): columns of the audit table.
AUDIT_COLUMNS = (
    "url", "final_url", "http_status", "meta_title", "meta_description", "title_length", "description_length",
    "total_images", "images_missing_alt", "alt_tag_coverage", "internal_links_count", "trackers_found",
    "meta_quality", "image_seo_status", "overall_seo_status", "suggestion", "residential_found",
    "residential_source", "commercial_found", "commercial_source", "industrial_found", "industrial_source",
    "found_keywords_list", "address", "notes",
)


def page_metrics(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """N1-N8 of each landed page, staged so nothing is computed twice."""
    total, missing = image_counts(html)
    step = pages.select(
        F.col(url).alias("final_url"),
        title(html).alias("meta_title"),
        meta_description(html).alias("meta_description"),
        total.alias("total_images"),
        missing.alias("images_missing_alt"),
        internal_link_count(html, url).alias("internal_links_count"),
        trackers(html).alias("__trackers"),
    )
    step = step.withColumns(
        {
            "http_status": F.lit(200),
            "title_length": F.length("meta_title"),
            "description_length": F.length("meta_description"),
            "alt_tag_coverage": coverage_label("total_images", "images_missing_alt"),
            "trackers_found": F.array_join("__trackers", ", "),
            "meta_quality": meta_quality("meta_title", "meta_description"),
            "image_seo_status": image_grade("total_images", "images_missing_alt"),
        }
    )
    step = step.withColumn("overall_seo_status", overall_status("meta_quality", "image_seo_status", "internal_links_count"))
    return step.withColumn("suggestion", suggestion("overall_seo_status", F.size("__trackers") > 0)).drop("__trackers")


def site_findings(pages: DataFrame, site: str, order: str, url: str = "url", html: str = "html", last: bool = True) -> DataFrame:
    """N9/N11 over the pages of each site: keyword flags with source page, keyword list, addresses."""
    base = pages.select(site, order, url, html).withColumn("__text", page_text(html))
    flags = base.withColumns(keyword_groups("__text"))
    found = keyword_pages(flags, site, order, url, KEYWORD_GROUPS, last)
    listed = F.array_join(F.filter(F.array(*[F.when(F.col(f"{g}_found") == "Yes", F.initcap(F.lit(g))) for g in KEYWORD_GROUPS]), lambda x: x.isNotNull()), ", ")
    spots = base.select(site, F.explode(address_candidates(html, shorter_than=200)).alias("__a"))
    addresses = sorted_set(spots, site, "__a", "address", " ; ").withColumnRenamed(site, "__site")
    joined = found.withColumn("found_keywords_list", listed).join(addresses, F.col(site).eqNullSafe(F.col("__site")), "left").drop("__site")
    return joined.withColumn("address", F.coalesce("address", F.lit("")))


def full_audit(urls: DataFrame, pages: DataFrame, findings: DataFrame, url: str, site: str, landed=("html",)) -> DataFrame:
    """One complete record per input URL; unreachable and invalid ones keep defaults.

    ``findings`` has one row per ``site``, the host of the URL.
    """
    asked = urls.select(F.col(url).alias("url"), with_scheme(url).alias("__u")).withColumn("__site", host("__u"))
    # A page that landed twice counts once; without a landing order any one of equal URLs, the same each time.
    metrics = page_metrics(top_n(pages, 1, list(landed), ["url"])).withColumn("__pu", F.col("final_url"))
    found = findings.withColumnRenamed(site, "__fsite")
    joined = asked.join(metrics, F.col("__u") == F.col("__pu"), "left").join(found, F.col("__site") == F.col("__fsite"), "left")
    state = F.when(F.col("__u").isNull(), "Invalid URL").when(F.col("final_url").isNull(), "Unreachable")
    label = {"alt_tag_coverage": state, "meta_quality": state, "image_seo_status": F.when(state.isNotNull(), "N/A")}
    label["overall_seo_status"] = F.when(F.col("__u").isNull(), "Invalid").when(F.col("final_url").isNull(), "Unreachable")
    label["suggestion"] = F.when(state.isNotNull(), "Review Manually")
    counts = ("title_length", "description_length", "total_images", "images_missing_alt", "internal_links_count")
    cols = []
    for c in AUDIT_COLUMNS:
        if c in ("url", "http_status"):
            cols.append(F.col(c))
        elif c == "notes":
            cols.append(F.when(F.col("__u").isNull(), "Empty or invalid URL").when(F.col("final_url").isNull(), "Request failed").otherwise("").alias(c))
        elif c in label:
            cols.append(F.coalesce(label[c], F.col(c)).alias(c))
        elif c in counts:
            cols.append(F.coalesce(F.col(c), F.lit(0)).alias(c))
        elif c in [f"{g}_found" for g in KEYWORD_GROUPS]:
            cols.append(F.when(state.isNull(), F.coalesce(F.col(c), F.lit("No"))).otherwise("No").alias(c))
        elif c in ("found_keywords_list", "address") or c.endswith("_source"):
            cols.append(F.when(state.isNull(), F.coalesce(F.col(c), F.lit(""))).otherwise("").alias(c))
        else:
            cols.append(F.coalesce(F.col(c), F.lit("")).alias(c))
    return joined.select(*cols)
