"""URL and image helpers."""

from pyspark.sql import Column, functions as F

from .rx import as_col, blank_to_null, grab, has, strip, sub

# Query keys that only track a visitor.
TRACKING_KEYS = ("miniprofileurn", "lipi", "trk", "trkinfo", "originalreferer")


def with_scheme(c, scheme: str = "http") -> Column:
    """K40."""
    u = strip(as_col(c))
    return F.when(u == "", None).when(has(u, "(?i)^https?://"), u).otherwise(F.concat(F.lit(f"{scheme}://"), u))


def host(c) -> Column:
    """Host with port, lower case; NULL for relative links."""
    return F.lower(grab(c, r"^(?i:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#]*)"))


def domain(c) -> Column:
    """Host without any "www."."""
    return F.replace(host(c), F.lit("www."), F.lit(""))


def path(c) -> Column:
    return F.regexp_extract(as_col(c), r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def drop_fragment(c) -> Column:
    return F.substring_index(as_col(c), "#", 1)


def squeeze_dots(p) -> Column:
    """Resolve "." and ".." segments of an absolute path natively."""
    segs = F.split(as_col(p), "/")
    empty = F.array().cast("array<string>")
    folded = F.aggregate(
        segs,
        empty,
        lambda acc, s: F.when(s == ".", acc)
        .when((s == "..") & (F.size(acc) > 1), F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == "..", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    tail = F.when(as_col(p).rlike(r"/\.{1,2}$"), F.lit("/")).otherwise(F.lit(""))
    return F.regexp_replace(F.concat(F.array_join(folded, "/"), tail), r"//+$", "/")


def resolve(base, link) -> Column:
    """K42, first half: absolute form of ``link`` seen on page ``base``."""
    base, link = as_col(base), strip(as_col(link))
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*:)", 1)
    origin = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(path(base), r"^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    bare = F.regexp_extract(link, r"^([^?#]*)", 1)
    rest = F.regexp_extract(link, r"^[^?#]*(.*)$", 1)
    rooted = F.when(bare.startswith("/"), bare).otherwise(F.concat(folder, bare))
    clean = F.when(rooted.contains("/."), squeeze_dots(rooted)).otherwise(rooted)
    return (
        F.when(has(link, r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link == "", drop_fragment(base))
        .when(link.startswith("#"), F.concat(drop_fragment(base), link))
        .when(link.startswith("?"), F.concat(F.regexp_extract(base, r"^([^?#]*)", 1), link))
        .otherwise(F.concat(origin, clean, rest))
    )


def canonical(base, link) -> Column:
    """Resolved, no fragment, no trailing slash."""
    return F.rtrim(drop_fragment(resolve(base, link)), F.lit("/"))


def _split(c):
    c = as_col(c)
    body = drop_fragment(c)
    head = F.substring_index(body, "?", 1)
    query = F.when(body.contains("?"), F.substring(body, F.length(head) + 2, F.length(body)))
    params = F.filter(F.split(query, "&"), lambda p: p != "")
    return head, F.coalesce(params, F.array().cast("array<string>"))


def _join(head, params) -> Column:
    return F.when(F.size(params) > 0, F.concat(head, F.lit("?"), F.array_join(params, "&"))).otherwise(head)


def _key(p) -> Column:
    return F.lower(F.substring_index(p, "=", 1))


def drop_params(c, keys=TRACKING_KEYS) -> Column:
    """K43."""
    head, params = _split(c)
    return F.rtrim(_join(head, F.filter(params, lambda p: ~_key(p).isin(*[k.lower() for k in keys]))), F.lit("/"))


def set_param(c, key: str, value) -> Column:
    """Replaced where the key stands, appended where it is new."""
    head, params = _split(c)
    new = F.concat(F.lit(f"{key}="), as_col(value).cast("string") if not isinstance(value, (int, str)) else F.lit(str(value)))
    hit = F.exists(params, lambda p: F.substring_index(p, "=", 1) == key)
    swapped = F.transform(params, lambda p: F.when(F.substring_index(p, "=", 1) == key, new).otherwise(p))
    frag = F.regexp_extract(as_col(c), r"(#.*)$", 1)
    return F.concat(_join(head, F.when(hit, F.array_distinct(swapped)).otherwise(F.concat(params, F.array(new)))), frag)


def set_variant(c, variant) -> Column:
    """K44, variant form: old variant keys of any case go, the new one is last."""
    head, params = _split(c)
    kept = F.filter(params, lambda p: _key(p) != "variant")
    return _join(head, F.concat(kept, F.array(F.concat(F.lit("variant="), as_col(variant).cast("string")))))


def base_only(c) -> Column:
    """Scheme, host and path."""
    return F.rtrim(sub(c, r"[?#].*$", ""), F.lit("/"))


def last_segment(c) -> Column:
    """Slug after the last slash (after the last ``#`` when there is one)."""
    tail = F.rtrim(F.trim(F.substring_index(as_col(c), "#", -1)), F.lit("/"))
    return blank_to_null(F.trim(F.substring_index(tail, "/", -1)))


def segment_after(c, marker: str = "collections", default: str = "unknown") -> Column:
    """The path segment that follows ``marker``."""
    segs = F.split(F.rtrim(as_col(c), F.lit("/")), "/")
    at = F.array_position(segs, marker)
    return F.coalesce(F.when(at > 0, F.get(segs, at.cast("int"))), F.lit(default))


def category_path(c, base: str) -> Column:
    """What is left of a category link once site and query are gone."""
    return F.rtrim(F.substring_index(F.replace(as_col(c), F.lit(base + "/"), F.lit("")), "?", 1), F.lit("/"))


def first_image(*candidates) -> Column:
    """First source that is a full http URL."""
    return F.coalesce(*[F.when(as_col(c).startswith("http"), as_col(c)) for c in candidates])


def real_images(urls) -> Column:
    """Placeholders and inline data removed from an array of sources."""
    return F.filter(as_col(urls), lambda u: ~(u.startswith("data:") | F.lower(u).contains("1px.png") | F.lower(u).contains("banner")))


def absolute_image(c, site: str = "") -> Column:
    """K48."""
    u = F.trim(as_col(c))
    return F.when(u.startswith("//"), F.concat(F.lit("https:"), u)).when(u.startswith("/"), F.concat(F.lit(site), u)).otherwise(blank_to_null(u))


def image_full_size(c) -> Column:
    """Size suffix, query and width limits cut."""
    u = sub(c, r"_\d+x(\.\w+)(?=\?|$)", "$1")
    return F.substring_index(F.substring_index(u, "?", 1), "&width", 1)


def media_root(c) -> Column:
    """Everything after the media id cut."""
    return F.coalesce(grab(c, r"^(https://[^/]+/media/[^/]+)"), as_col(c))


def background_image(style) -> Column:
    """K49."""
    return grab(style, r"""(?i)background(?:-image)?\s*:\s*[^;]*?url\(\s*["']?([^"')]+)["']?\s*\)""")


def percent_decode(c) -> Column:
    return F.try_url_decode(as_col(c))


def srcset_entries(c) -> Column:
    """Array of (width, first-wins tiebreak, url) from a srcset."""
    entries = F.filter(F.transform(F.split(as_col(c), r",\s+|,(?=https?:|//|/)"), lambda x: F.trim(x)), lambda e: e != "")
    return F.transform(
        entries,
        lambda e, i: F.struct(
            F.coalesce(F.regexp_extract(e, r"\s(\d+)w$", 1).try_cast("int"), F.lit(0)).alias("width"),
            (-i).alias("order"),
            F.substring_index(e, " ", 1).alias("url"),
        ),
    )


def widest_srcset(c) -> Column:
    """Source of the largest width; first one wins a tie."""
    return F.array_max(srcset_entries(c))["url"]


def first_srcset(c) -> Column:
    return F.get(srcset_entries(c), F.lit(0))["url"]


def valid_url(c) -> Column:
    """D1."""
    return F.coalesce(as_col(c).rlike(r"^https?://"), F.lit(False))
