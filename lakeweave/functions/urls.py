"""URL functions, Column to Column, from one pattern for a URL's parts (never raises on bad input)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeweave.functions.text import any_of, col, strip

# --- Fixed values: path words, extensions and media types that decide results. -----------------------------

PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
FILE_EXTENSIONS = (".pdf", ".doc", ".docx", ".xls", ".xlsx", ".html", ".htm", ".xml")
SKIP_SEGMENTS = (
    r"(?i)/(delivery|dostavka|shipping|payment|oplata|payments|order|zakaz|cart|korzina|checkout|login|register|auth|account|profile|contacts"
    r"|kontakty|about|o-nas|o-kompanii|company|vakansii|careers|news|novosti|blog|faq|help|support|sitemap|privacy|policy|terms|agreement|offer"
    r"|oferta|return|vozvrat|garantiya|guarantee|warranty|reviews|otzyvy|partners|partnery|reklama|advertising|subscribe|podpiska|compare"
    r"|sravnenie|wishlist|favorites|izbranno|leasing|lizzing|insurance|strahovanie|financial|finansy|requisites|rekvizity|feedback|obratna"
    r"|filter__[^/]*)(\.[a-z]{2,5})?(/|$|\?)"
)
SKIP_MEDIA = r"(?i)/(upload|medialibrary|bitrix|assets|static|images|img|media|fonts|css|js)/"
MEDIA_EXTENSIONS = r"(?i)\.(png|jpg|jpeg|gif|svg|webp|ico|mp4|mp3|wav|woff2?|ttf|eot|css|js)(\?|$)"
SKIP_PREFIXES = (
    r"(?i)^/(news|novosti|forum|interactive|board|board_el|classified|obyavleniya|gallery|galereya|video|press|misc|map|rss|feed|story|top_forum"
    r"|company|companies|kompanii|rassylka|subscribe|quotation|chesnok|vacancy|vakansii|wiki|dict|link|exhibition|expo)/"
)
PRODUCT_PATH = r"(?i)/(catalog|katalog|products|product|cable|group-|series|seriya|model|item|tovar|produk|oborudovanie|equipment)/"
EDITORIAL_PATH = r"(?i)/(article|articles|story|blog|press|interview|obzor|info|question|gosts|services|solutions|view)/"
SITEMAP_SKIP = r"(?i)\.(pdf|doc|docx|xls|xlsx|png|jpg|jpeg|gif|svg|webp|mp4|mp3)$"
MEDIA_TYPES = {
    "md": "text/markdown", "markdown": "text/markdown", "txt": "text/plain", "html": "text/html", "htm": "text/html", "xml": "text/xml", "csv": "text/csv", "json": "application/json", "pdf": "application/pdf",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
}
CAPTCHA = (("recaptcha", r"(?i)google\.com/recaptcha|class=[\"']g-recaptcha[\"']"), ("yandex_smartcaptcha", r"(?i)smartcaptcha\.yandexcloud|id=[\"']smartcaptcha[\"']"), ("captcha", r"(?i)class=[\"'][^\"']*(captcha-container|challenge-platform)"))


def part(url: Column | str, i: int) -> Column:
    """1 scheme, 2 authority, 3 path, 4 query, 5 fragment."""
    return F.regexp_extract(F.coalesce(col(url), F.lit("")), PARTS, i)


def scheme(url: Column | str) -> Column:
    return F.lower(part(url, 1))


def authority(url: Column | str) -> Column:
    return part(url, 2)


def path(url: Column | str) -> Column:
    return part(url, 3)


def domain(url: Column | str) -> Column:
    """Authority in lower case without any 'www.'."""
    return F.replace(F.lower(authority(url)), F.lit("www."), F.lit(""))


def canonical(url: Column | str) -> Column:
    """Lower-case scheme and host, no default port, path at least '/', query kept, fragment dropped; null if not http(s) or with credentials."""
    url = col(url)
    sch, auth, p, q = scheme(url), authority(url), path(url), part(url, 4)
    host, port = F.lower(F.regexp_extract(auth, r"^(\[[^\]]*\]|[^:]*)(?::(\d*))?$", 1)), F.regexp_extract(auth, r"^(\[[^\]]*\]|[^:]*)(?::(\d*))?$", 2)
    default = ((sch == "http") & (port == "80")) | ((sch == "https") & (port == "443")) | (port == "")
    sound = sch.isin("http", "https") & (host != "") & ~auth.contains("@")
    built = F.concat(sch, F.lit("://"), host, F.when(default, "").otherwise(F.concat(F.lit(":"), port)), F.when(p == "", "/").otherwise(p), F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))
    return F.when(sound, built)


def resolve(base: Column, href: Column) -> Column:
    """An href against its page: absolute, scheme-relative, root-relative, query-only or relative; fragment dropped."""
    href = F.regexp_replace(strip(href), "#.*$", "")
    root = F.concat(part(base, 1), F.lit("://"), authority(base))
    folder = F.regexp_replace(F.when(path(base) == "", "/").otherwise(path(base)), r"[^/]*$", "")
    joined = (
        F.when(href == "", F.concat(root, path(base)))
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(part(base, 1), F.lit(":"), href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href.startswith("?"), F.concat(root, path(base), href))
        .otherwise(F.concat(root, folder, href))
    )
    for _ in range(4):  # a/./b and a/../b
        joined = F.regexp_replace(F.regexp_replace(joined, r"/\./", "/"), r"(?<=[^/:]|://[^/]{1,255})/(?!\.\./)[^/?#]+/\.\./", "/")
    return joined


def anchors(html: Column | str, most: int = 1000) -> Column:
    """The first href of each anchor, at most ``most``."""
    found = F.regexp_extract_all(F.coalesce(col(html), F.lit("")), F.lit(r"""(?is)<a\b[^>]*?\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)"""), F.lit(1))
    return F.slice(F.transform(found, lambda h: F.regexp_replace(h, "^[\"']|[\"']$", "")), 1, most)


def is_file_link(url: Column | str) -> Column:
    low = F.lower(col(url))
    return any_of([low.endswith(e) | low.contains(f"{e}?") for e in FILE_EXTENSIONS])


def is_product(url: Column | str) -> Column:
    """No operational section, media folder or media file."""
    p = path(url)
    return ~(p.rlike(SKIP_SEGMENTS) | p.rlike(SKIP_MEDIA) | p.rlike(MEDIA_EXTENSIONS))


def is_content(url: Column | str) -> Column:
    return ~path(url).rlike(SKIP_PREFIXES) & is_product(url)


def is_under(root: Column | str, url: Column | str) -> Column:
    prefix = F.regexp_replace(path(root), "/+$", "")
    return (prefix == "") | path(url).startswith(prefix)


def is_listing(url: Column | str) -> Column:
    """Pages that are likely to list others."""
    p = F.lower(path(url))
    name = F.element_at(F.split(F.regexp_replace(p, "/+$", ""), "/"), -1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    underscores = F.length(stem) - F.length(F.replace(stem, F.lit("_"), F.lit("")))
    special = (F.length(stem) > 60) | ((underscores >= 3) & (F.regexp_count(stem, F.lit(r"\d+")) >= 2))
    return col(url).contains("page=") | p.endswith("/") | ~name.contains(".") | ~special


def candidate_score(url: Column | str, base_terms=(), terms=(), domains=(), negative=()) -> Column:
    """Additive score of a candidate source."""
    low, host = F.lower(col(url)), domain(url)
    points = lambda test, n: F.when(test, n).otherwise(0)
    total = points(low.rlike(r"\.(pdf|docx?|xlsx?)(\?|$)"), 30)
    if base_terms:
        total += points(any_of([low.contains(t) for t in base_terms]), 10)
    for t in terms:
        total += points(low.contains(t), 8)
    for d in domains:
        total += points(host.contains(d), 12)
    if negative:
        total -= points(any_of([low.contains(t) for t in negative]), 30)
    return total


def document_id(root: Column | str, url: Column | str) -> Column:
    """The path below the root as an id; ids of over 200 bytes are cut and end in 12 digits of their SHA-1."""
    p = F.regexp_replace(F.regexp_replace(path(url), "^/+|/+$", ""), r"(?i)\.(php|html?|aspx?|jsp)$", "")
    base = F.regexp_replace(path(root), "^/+|/+$", "")
    rest = F.when((base != "") & p.startswith(base), F.regexp_replace(F.substr(p, F.length(base) + 1), "^/+|/+$", "")).otherwise(p)
    doc = F.regexp_replace(F.regexp_replace(F.replace(rest, F.lit("/"), F.lit("__")), r"(?U)[^\w\-]", "_"), "^_+|_+$", "")
    doc = F.when(doc == "", F.lit("index")).otherwise(doc)
    cut = F.regexp_replace(F.substring(doc, 1, 187), r"(?<=^.{101,186})_[^_]*$", "")
    return F.when(F.octet_length(doc) > 200, F.concat(cut, F.lit("_"), F.substring(F.sha1(doc), 1, 12))).otherwise(doc)


def priority(url: Column | str) -> Column:
    """0 product, 1 neutral, 2 editorial."""
    p = path(url)
    return F.when(p.rlike(PRODUCT_PATH), 0).when(p.rlike(EDITORIAL_PATH), 2).otherwise(1)


def discovery_filename(url: Column | str) -> Column:
    """domain__slug.json."""
    p = F.regexp_replace(path(url), "^/+|/+$", "")
    slug = F.regexp_replace(F.regexp_replace(p, r"(?U)[^\w\-]", "_"), "^_+|_+$", "")
    return F.concat(F.replace(authority(url), F.lit("www."), F.lit("")), F.when(p != "", F.concat(F.lit("__"), slug)).otherwise(""), F.lit(".json"))


def media_type(filename: Column | str) -> Column:
    """By extension, empty if unknown."""
    ext = F.lower(F.regexp_extract(col(filename), r"\.([^./]*)$", 1))
    table = F.create_map(*[F.lit(x) for kv in MEDIA_TYPES.items() for x in kv])
    return F.coalesce(F.try_element_at(table, ext), F.lit(""))


def redact(text: Column | str) -> Column:
    """URLs in a text without credentials, query and fragment."""
    return F.regexp_replace(F.regexp_replace(col(text), r"(https?://)[^\s\"'<>/?#]*@", "$1"), r"(https?://[^\s\"'<>?#]+)[?#][^\s\"'<>]*", "$1")


def captcha(html: Column | str) -> Column:
    """The kind of challenge, if the page shows little else."""
    html = col(html)
    body = strip(F.regexp_replace(F.regexp_extract(html, r"(?is)<body[^>]*>(.*)</body>", 1), "<[^>]+>", ""))
    little = html.rlike(r"(?is)<body[^>]*>.*</body>") & (F.length(body) < 500)
    return F.coalesce(*[F.when(html.rlike(p) & little, F.lit(name)) for name, p in CAPTCHA])


def decode_redirect(href: Column | str) -> Column:
    """The target of a search result's link, empty if none."""
    href = F.coalesce(col(href), F.lit(""))
    q = lambda key: F.try_url_decode(F.regexp_extract(href, rf"[?&]{key}=([^&#]*)", 1))
    web = lambda c: F.when(c.rlike("^https?://"), c)
    return F.when(href.startswith("/url?"), F.coalesce(q("q"), F.lit(""))).otherwise(F.coalesce(web(q("url")), web(q("q")), web(q("target")), web(href), F.lit("")))
