"""Discovery of resources: literal URIs, sitemaps, link graphs, mined text, merged source lists. Fetched bodies are tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeweave.functions import text as T
from lakeweave.functions import urls as U

#: How URLs and bare domains look in text, and domains that are never sources.
URL_IN_TEXT = r"https?://[^\s\"'<>)\]]+"
DOMAIN_IN_TEXT = r"(?i)\b((?:[a-z0-9\-]+\.)+(?:com|org|net|ru|de|eu))\b"
DENIED = ("google.com", "youtube.com", "wikipedia.org", "github.com", "t.me", "vk.com")


def first_seen(rows: DataFrame, key: str, order: str = "pos") -> DataFrame:
    """Order-preserving distinct: each key's first row, pre-aggregated, so that a key that many rows share is no burden."""
    others = [c for c in rows.columns if c != key]
    first = rows.groupBy(key).agg(F.min_by(F.struct(*others), order).alias("r_"))
    return first.select(*(F.col(c) if c == key else F.col(f"r_.{c}").alias(c) for c in rows.columns))


def numbered(rows: DataFrame, order: str) -> DataFrame:
    """A column pos from 0 in the order of a column of distinct values: a range sort, counts by partition and their sums,
    so that no task holds all rows."""
    from lakeweave.sources.scratch import settled

    part = F.spark_partition_id()
    cut = settled(rows.repartitionByRange(order).sortWithinPartitions(order).select("*", part.alias("part_"), F.monotonically_increasing_id().alias("at_")), "numbered")
    sizes = cut.groupBy("part_").agg(F.count(F.lit(1)).alias("n_"), F.min("at_").alias("low_"))
    # One row for each partition: few enough for one window.
    starts = sizes.select("part_", "low_", F.coalesce(F.sum("n_").over(Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start_"))
    return cut.join(starts, "part_").select("*", (F.col("start_") + F.col("at_") - F.col("low_")).alias("pos")).drop("part_", "at_", "low_", "start_")


def manual_resources(uris: DataFrame, limit: int = 100) -> DataFrame:
    """A1: rows (pos, uri) without fragments; other schemes than file, http, https and none, or credentials, raise an error."""
    clean = F.regexp_replace(F.trim("uri"), "#.*$", "")
    bad = ~U.scheme(clean).isin("", "file", "http", "https") | U.authority(clean).contains("@")
    checked = F.when(bad, F.raise_error(F.concat(F.lit("refused URI: "), U.redact(F.col("uri")))).cast("string")).otherwise(clean)
    return first_seen(uris.select("pos", checked.alias("uri")), "uri").orderBy("pos").limit(limit)


def sitemap_locations(bodies: DataFrame) -> DataFrame:
    """(url, kind, loc) of sitemap bodies (url, body): entity declarations are refused."""
    safe = bodies.where(~F.col("body").rlike(r"(?i)<!(DOCTYPE|ENTITY)") & F.col("body").rlike(r"(?s)^\s*(<\?xml.*?\?>)?\s*<"))
    kind = F.when(F.col("body").rlike(r"<(\w+:)?sitemapindex[\s>]"), "index").otherwise("urlset")
    found = F.regexp_extract_all("body", F.lit(r"(?s)<(?:\w+:)?loc>\s*(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?\s*</(?:\w+:)?loc>"), F.lit(1))
    plain = lambda c: F.replace(F.replace(F.replace(c, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), F.lit("&amp;"), F.lit("&"))
    return safe.select("url", kind.alias("kind"), F.posexplode(F.transform(found, plain)).alias("pos", "loc"))


def robots_sitemaps(robots: DataFrame) -> DataFrame:
    """Sitemap lines of robots.txt bodies (url, body)."""
    return robots.select("url", F.explode(F.regexp_extract_all("body", F.lit(r"(?im)^\s*sitemap:\s*(\S+)\s*$"), F.lit(1))).alias("loc"))


def sitemap_pages(web: DataFrame, starts: list[str], max_sitemaps: int = 20, limit: int | None = None, same_origin: bool = True) -> DataFrame:
    """A2, A3: pages of sitemaps and of the sitemaps that their indexes name, over a table of fetched bodies (url, body). The driver holds the
    frontier only, of at most ``max_sitemaps`` URLs."""
    spark, seen, frontier, pages = web.sparkSession, [], list(dict.fromkeys(starts)), []
    while frontier and len(seen) < max_sitemaps:
        now = frontier[: max_sitemaps - len(seen)]
        seen += now
        ordered = spark.createDataFrame(list(enumerate(now)), "turn int, url string")
        found = sitemap_locations(web.join(F.broadcast(ordered.select("url")), "url")).join(ordered, "url")
        if same_origin:
            found = found.where((U.scheme("loc") == U.scheme("url")) & (F.lower(U.authority("loc")) == F.lower(U.authority("url"))))
        depth = len(pages)
        pages.append(found.where("kind = 'urlset'").select(F.lit(depth).alias("depth"), "turn", "pos", F.col("loc").alias("uri")))
        more = found.where("kind = 'index'").orderBy("turn", "pos").limit(10 * max_sitemaps).select("loc").collect()
        frontier = [u for u in dict.fromkeys(r.loc for r in more) if u not in seen]
    if not pages:
        return spark.createDataFrame([], "uri string")
    union = pages[0]
    for p in pages[1:]:
        union = union.unionByName(p)
    first = union.groupBy("uri").agg(F.min(F.struct("depth", "turn", "pos")).alias("at")).orderBy("at").select("uri")
    return first.limit(limit) if limit is not None else first


def sitemap_urls(web: DataFrame, starts: list[str], max_sitemaps: int = 20) -> DataFrame:
    """A3: the sorted set of URLs in sitemaps of any origin."""
    return sitemap_pages(web, starts, max_sitemaps, same_origin=False).select("uri").distinct().orderBy("uri")


def sitemap_starts(web: DataFrame, root: str) -> list[str]:
    """A2: the sitemaps that a site's robots.txt names, or else its /sitemap.xml."""
    base = root.rstrip("/")
    named = robots_sitemaps(web.where(F.col("url") == f"{base}/robots.txt")).limit(100).collect()
    return [r.loc for r in named] or [f"{base}/sitemap.xml"]


def unpacked(artifacts: DataFrame, max_bytes: int = 50 << 20) -> DataFrame:
    """A2: bodies (url, body) of sitemap files (url, content), gzip or plain; what is broken or larger than max_bytes is dropped."""
    import zlib

    import pandas as pd

    def inflate(frames):
        for pdf in frames:
            out = []
            for url, content in zip(pdf["url"], pdf["content"], strict=True):
                if content is not None and content[:2] == b"\x1f\x8b":
                    unzip = zlib.decompressobj(31)
                    try:
                        content = unzip.decompress(content, max_bytes + 1)
                    except zlib.error:
                        continue
                    if not unzip.eof:
                        continue
                if content is not None and len(content) <= max_bytes:
                    out.append((url, bytes(content).decode("utf-8", "replace")))
            yield pd.DataFrame(out, columns=["url", "body"])

    return artifacts.select("url", "content").mapInPandas(inflate, "url string, body string")


def filter_pages(urls: DataFrame, root: str, *tests: Column) -> DataFrame:
    """A4: same domain, no documents and media; further tests on column url."""
    kept = urls.where((U.domain("url") == U.domain(F.lit(root))) & ~U.path("url").rlike(U.SITEMAP_SKIP))
    for t in tests:
        kept = kept.where(t)
    return kept


@dataclass
class CrawlPolicy:
    max_pages: int = 100
    max_depth: int = 3
    max_links: int = 1000
    domains: tuple[str, ...] = ()
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    disallowed: tuple[str, ...] = field(default=())  # path prefixes of robots.txt


def glob_pattern(glob: str) -> str:
    import fnmatch

    return fnmatch.translate(glob).replace(r"\Z", "$").replace(r"\z", "$")


def crawl(web: DataFrame, seeds: list[str] | DataFrame, policy: CrawlPolicy) -> tuple[DataFrame, DataFrame]:
    """A5: breadth-first over the link graph of a table of fetched pages (url, body), a level at a time. Returns the pages in
    crawl order (depth, pos, url) and counts of what was left out and why; ``include`` leaves pages out of the result, not of
    the traversal. Levels are tables; only their sizes reach the driver. seeds: URLs, or a table (pos, url) of them."""
    from lakeweave.sources.scratch import settled

    spark = web.sparkSession
    # Settled once: every level is joined with it.
    pages = settled(web.select(U.canonical("url").alias("url"), "body").where("url IS NOT NULL").dropDuplicates(["url"]), "crawl-pages")
    given = seeds if isinstance(seeds, DataFrame) else spark.createDataFrame(list(enumerate(seeds)), "pos long, url string")
    level = first_seen(given.select(F.col("pos").cast("long").alias("pos"), U.canonical("url").alias("url")).where("url IS NOT NULL"), "url")
    hosts = [h.lower() for h in policy.domains]
    seen, out, left, done = level.select("url").limit(0), [], [], 0
    for depth in range(policy.max_depth + 1):
        reason = F.when(F.lit(bool(hosts)) & ~F.lower(U.authority("url")).isin(*(hosts or [""])), "domain")
        for prefix in policy.disallowed:
            reason = F.coalesce(reason, F.when(U.path("url").startswith(prefix), F.lit("robots")))
        for g in policy.exclude:
            reason = F.coalesce(reason, F.when(F.col("url").rlike(glob_pattern(g)), F.lit("exclude")))
        fresh = level.join(seen, "url", "left_anti").withColumn("reason", reason)
        left.append(fresh.where("reason IS NOT NULL").select("reason"))
        fetched = settled(fresh.where("reason IS NULL").orderBy("pos").limit(policy.max_pages - done).join(pages, "url", "left"), "crawl-level")
        wanted = T.any_of([F.col("url").rlike(glob_pattern(g)) for g in policy.include]) if policy.include else F.lit(True)
        there = fetched.where("body IS NOT NULL").withColumn("wanted", wanted)
        out.append(there.where("wanted").select(F.lit(depth).alias("depth"), "pos", "url"))
        left.append(there.where("NOT wanted").select(F.lit("include").alias("reason")))
        left.append(fetched.where("body IS NULL").select(F.lit("missing").alias("reason")))
        got = fetched.count()
        done += got
        seen = settled(seen.union(fresh.select("url")).distinct(), "crawl-seen")
        if not got or done >= policy.max_pages:
            break
        links = there.select(F.col("pos").alias("parent"), F.col("url").alias("base"), F.posexplode(U.anchors("body", policy.max_links)).alias("place", "href"))
        left.append(there.where(F.size(U.anchors("body", policy.max_links + 1)) > policy.max_links).select(F.lit("links truncated").alias("reason")))
        # Resolved in a projection of its own: within one expression it would be repeated for each part of the URL.
        found = links.select("parent", "place", U.resolve(F.col("base"), F.col("href")).alias("raw")).select("parent", "place", U.canonical("raw").alias("url")).where("url IS NOT NULL")
        first = found.groupBy("url").agg(F.min(F.struct("parent", "place")).alias("at"))
        level = settled(numbered(first, "at").select("pos", "url"), "crawl-links")
    both = lambda dfs: dfs[0] if len(dfs) == 1 else dfs[0].unionByName(both(dfs[1:]))
    return both(out), both(left).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


#: Files that a crawl for files takes, and those that it takes on a weak score as well.
FILE_URL_IN_TEXT = r"(?i)(https?://[^\s\"'<>]+\.(?:pdf|docx?|xlsx?|html?|xml)(?:\?[^\s\"'<>]*)?)"
ANCHOR = r"""(?is)<a\b[^>]*?\bhref\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>]+)[^>]*>.*?</a>"""
WEAK_EXTENSIONS = r"(?i)\.(pdf|doc|docx|xls|xlsx|xml|html|htm)(\?|$)"


def file_links(pages: DataFrame, terms: tuple[str, ...] = (), anti_terms: tuple[str, ...] = (), least: int = 1) -> DataFrame:
    """URLs of files that pages (url, body) link to or spell out, with the texts of all their anchors. A URL and its texts
    have to score ``least``, or with a weak extension not below 0; without terms all stay. Sorted by URL."""
    tags = pages.select("url", F.explode(F.regexp_extract_all("body", F.lit(ANCHOR), F.lit(0))).alias("tag"))
    href = F.regexp_replace(F.regexp_extract("tag", r"""(?is)\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", 1), "^[\"']|[\"']$", "")
    said = T.strip(F.regexp_replace(F.regexp_replace("tag", "<[^>]+>", " "), r"\s+", " "))
    linked = tags.select(U.resolve(F.col("url"), href).alias("file"), F.col("url").alias("page"), said.alias("said"))
    linked = linked.where(F.col("file").rlike("^https?://") & U.is_file_link("file"))
    spelled = pages.select(F.explode(F.regexp_extract_all("body", F.lit(FILE_URL_IN_TEXT), F.lit(1))).alias("file"), F.col("url").alias("page"), F.lit("").alias("said"))
    texts = F.array_join(F.array_sort(F.filter(F.collect_set("said"), lambda t: t != "")), " ")
    found = linked.unionByName(spelled).groupBy("file").agg(texts.alias("anchor_text"), F.count_distinct("page").alias("pages"))
    if not terms:
        return found.orderBy("file")
    score = T.term_score(F.concat("file", F.lit(" "), "anchor_text"), terms, anti_terms)
    scored = found.withColumn("score", score)
    return scored.where((F.col("score") >= least) | ((F.col("score") >= 0) & F.col("file").rlike(WEAK_EXTENSIONS))).orderBy("file")


def catalogue(web: DataFrame, root: str, state: str, levels: int = 50, skip_leaves: bool = True) -> DataFrame:
    """Pages below the root's path that a crawl of the fetched pages (url, body) reaches. ``state`` is a folder of tables,
    one for each level of the crawl: (url, fresh), where fresh pages are those whose links come next. A crawl that was cut off goes on
    at the last whole level; leaf pages (not listings) are found but not opened."""
    from lakeweave.sources.scratch import settled

    spark = web.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(state).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = lambda n: fs.exists(hadoop(f"{state}/level={n}/_SUCCESS"))
    start = next((n for n in range(levels, -1, -1) if done(n)), -1)
    table = lambda n: spark.read.schema("url string, fresh boolean").parquet(f"{state}/level={n}")
    if start < 0:
        spark.createDataFrame([(root,)], "raw string").select(U.canonical("raw").alias("url"), F.lit(True).alias("fresh")).write.mode("overwrite").parquet(f"{state}/level=0")
        start = 0
    # Settled once: every level is joined with it.
    pages = settled(web.select(U.canonical("url").alias("url"), "body").where("url IS NOT NULL").dropDuplicates(["url"]), "crawl-pages")
    for n in range(start, levels):
        known = table(n)
        opened = known.where("fresh")
        if n and skip_leaves:
            opened = opened.where(U.is_listing("url"))
        links = opened.join(pages, "url").select(F.explode(U.anchors("body")).alias("href"), F.col("url").alias("base"))
        found = links.select(U.resolve(F.col("base"), F.col("href")).alias("raw")).distinct().select(U.canonical("raw").alias("url")).where("url IS NOT NULL").distinct()
        found = found.where((U.domain("url") == U.domain(F.lit(root))) & U.is_under(F.lit(root), "url") & U.is_content("url"))
        new = found.join(known, "url", "left_anti").withColumn("fresh", F.lit(True))
        known.select("url", F.lit(False).alias("fresh")).unionByName(new).write.mode("overwrite").parquet(f"{state}/level={n + 1}")
        if table(n + 1).where("fresh").isEmpty():
            break
    return table(next(n for n in range(levels, -1, -1) if done(n))).select("url")


def mined_sources(texts: DataFrame) -> DataFrame:
    """URLs and bare domains in texts (text), sorted and distinct, without denied domains."""
    whole = texts.select(F.explode(F.regexp_extract_all("text", F.lit(URL_IN_TEXT), F.lit(0))).alias("raw")).select(F.regexp_replace(F.regexp_replace(F.regexp_replace("raw", "[.,;]+$", ""), "[?#].*$", ""), "/+$", "").alias("url"))
    bare = texts.select(F.explode(F.regexp_extract_all("text", F.lit(DOMAIN_IN_TEXT), F.lit(1))).alias("d")).select(F.lower("d").alias("d")).where(~F.col("d").isin(*DENIED)).select(F.concat(F.lit("https://"), "d").alias("url"))
    return whole.where(U.authority("url") != "").union(bare).distinct().orderBy("url")


def search_grid(terms: DataFrame, results: DataFrame, domain: str, pages: int = 3, budget: int = 50) -> DataFrame:
    """Result URLs of the domain for terms (pos, term) and their first pages, over an offline table of results (term, page, href).
    The budget counts queries; a term's queries stop at its first page without results."""
    filled = results.where(F.col("page") < pages).groupBy("term", "page").agg(F.count(F.lit(1)).alias("n"))
    empty = terms.join(filled, "term", "left").groupBy("pos", "term").agg(F.array_min(F.array_except(F.sequence(F.lit(0), F.lit(pages)), F.collect_set("page"))).alias("stop"))
    asked = empty.select("term", "pos", F.explode(F.sequence(F.lit(0), F.least(F.col("stop"), F.lit(pages - 1)))).alias("page"))
    asked = asked.orderBy("pos", "page").limit(budget)
    found = results.join(asked, ["term", "page"]).select(U.decode_redirect("href").alias("url")).where(U.domain("url") == domain.replace("www.", ""))
    return found.distinct().orderBy("url")


def merged_urls(*parts: DataFrame) -> DataFrame:
    """Union of URL sets, in priority order."""
    union = parts[0].select("url")
    for p in parts[1:]:
        union = union.union(p.select("url"))
    return union.distinct().orderBy(U.priority("url"), "url")


def merged_sources(candidates: DataFrame, approved: DataFrame) -> DataFrame:
    """Candidates and approved sources by URL; an approved row's status wins."""
    both = candidates.alias("c").join(approved.alias("a"), "url", "full")
    return both.select("url", F.coalesce("a.status", "c.status").alias("status"), F.coalesce("a.score", "c.score").alias("score"))


def approved_urls(sources: DataFrame) -> DataFrame:
    """Approved http(s) URLs by priority (999999 if it isn't a number)."""
    rows = sources.where((F.col("status") == "approved") & U.scheme("url").isin("http", "https"))
    return rows.orderBy(F.coalesce(F.expr("try_cast(priority AS INT)"), F.lit(999999)), "url").select("url")


def profile(raw: dict) -> dict:
    """A checked profile: unknown keys and wrong types are refused."""
    kinds = {"schema_version": int, "queries": list, "priority_terms": list, "priority_domains": list, "crawl": dict, "metadata": dict, "name": str}
    for key, value in raw.items():
        if key not in kinds or not isinstance(value, kinds[key]):
            raise ValueError(f"bad profile setting: {key}")
        if kinds[key] is list and not all(isinstance(x, str) and x.strip() for x in value):
            raise ValueError(f"bad profile list: {key}")
    if raw.get("schema_version") != 1:
        raise ValueError("unknown profile version")
    return {"queries": [], "priority_terms": [], "priority_domains": [], "crawl": {}, "metadata": {}} | raw
