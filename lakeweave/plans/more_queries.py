"""Further queries over the driver's tables: discovery, scalar functions, logs, editable state, files and streams.

The tables hold no Cyrillic text, documents with standards or sitemaps, so some inputs are built from their rows by a
rule that the SQL repeats; what is computed from them is the operator's own result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweave.functions import text as T
from lakeweave.functions import urls as U
from lakeweave.operators import chunking as K
from lakeweave.operators import quality as Q
from lakeweave.operators import state as S
from lakeweave.plans.queries import _AUTH, _DOMAIN, _ELEMENTS, _HREFS, _LINES, _NORM, _PATH, _STRIP, _TOKENS, conversation_elements, line_chunks, query, table
from lakeweave.sources import discovery as D
from lakeweave.sources import files
from lakeweave.sources.scratch import fresh_path
from lakeweave.streaming import queue

# --- Discovery ---------------------------------------------------------------------------------------------


@query("SELECT min(page_id) AS pos, regexp_replace(trim(url), '#.*$', '') AS uri FROM pages GROUP BY 2")
def a1_manual_resources(spark, sf_dir):
    uris = table(spark, sf_dir, "pages").select(F.col("page_id").alias("pos"), F.col("url").alias("uri"))
    return D.manual_resources(uris, limit=2**31 - 1)


def _sitemaps(spark, sf_dir) -> DataFrame:
    """An index of ten sitemaps, which list the pages by the last digit of their ids."""
    lists = table(spark, sf_dir, "pages").groupBy((F.col("page_id") % 10).alias("n")).agg(F.expr("listagg('<url><loc>' || replace(url, '&', '&amp;') || '</loc></url>') WITHIN GROUP (ORDER BY page_id)").alias("locs"))
    maps = lists.select(F.format_string("http://maps.org/%d.xml", "n").alias("url"), F.concat(F.lit("<?xml version='1.0'?><urlset>"), "locs", F.lit("</urlset>")).alias("body"))
    index = "<sitemapindex>" + "".join(f"<sitemap><loc>http://maps.org/{n}.xml</loc></sitemap>" for n in range(10)) + "</sitemapindex>"
    robots = "User-agent: *\nDisallow: /x\nSitemap: http://maps.org/index.xml\n"
    return maps.unionByName(spark.createDataFrame([("http://maps.org/index.xml", index), ("http://maps.org/robots.txt", robots)], "url string, body string"))


@query("SELECT DISTINCT url AS uri FROM pages")
def a2_sitemap_pages(spark, sf_dir):
    web = _sitemaps(spark, sf_dir)
    return D.sitemap_pages(web, D.sitemap_starts(web, "http://maps.org/"), same_origin=False)


@query("SELECT uri, CAST(row_number() OVER (ORDER BY uri) AS INT) AS place FROM (SELECT DISTINCT url AS uri FROM pages WHERE page_id % 10 < 4)")
def a3_sitemap_urls(spark, sf_dir):
    """The index and four of its sitemaps are what five files allow."""
    from pyspark.sql.window import Window

    return D.sitemap_urls(_sitemaps(spark, sf_dir), ["http://maps.org/index.xml"], 5).withColumn("place", F.row_number().over(Window.orderBy("uri")))


@query(f"SELECT page_id, url FROM pages WHERE {_DOMAIN.format('url')} = (SELECT min({_DOMAIN.format('url')}) FROM pages) AND NOT regexp_matches({_PATH.format('url')}, '{U.SITEMAP_SKIP}')")
def a4_filtered_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    root = pages.agg(F.min(U.domain("url"))).first()[0]
    return D.filter_pages(pages, f"http://{root}/")


@query(
    """WITH RECURSIVE r AS (SELECT CAST(1 AS BIGINT) AS k, 0 AS depth UNION ALL
SELECT c.k, r.depth + 1 FROM r, LATERAL (SELECT unnest([2 * r.k, 2 * r.k + 1]) AS k) c WHERE c.k <= (SELECT max(c_custkey) FROM customer) AND c.k % 10 <> 7 AND r.depth < 8)
SELECT k, depth FROM r WHERE k % 5 <> 0"""
)
def a5_crawl(spark, sf_dir):
    """Each customer's page links to those of twice its number and one more, and back; pages that end in 7 are excluded, and
    those that end in 0 or 5 are crawled but not included."""
    k = F.col("c_custkey")
    link = lambda c: F.concat(F.lit('<a href="/c/'), c.cast("string"), F.lit('">x</a>'))
    web = table(spark, sf_dir, "customer").select(F.concat(F.lit("http://s.org/c/"), k.cast("string")).alias("url"), F.concat(link(2 * k), link(2 * k + 1), link(F.floor(k / 2))).alias("body"))
    got, _ = D.crawl(web, ["http://s.org/c/1"], D.CrawlPolicy(max_pages=2**31 - 1, max_depth=8, exclude=("*7",), include=("*[1234689]",)))
    return got.select(F.regexp_extract("url", r"(\d+)$", 1).cast("long").alias("k"), "depth")


@query(
    rf"""WITH p AS (SELECT page_id, url, lower({_PATH.format("url")}) AS p FROM pages),
n AS (SELECT *, regexp_extract(regexp_replace(p, '/+$', ''), '[^/]*$', 0) AS name FROM p),
s AS (SELECT *, regexp_replace(name, '\.[^.]*$', '') AS stem FROM n)
SELECT page_id, contains(url, 'page=') OR ends_with(p, '/') OR NOT contains(name, '.')
  OR NOT (length(stem) > 60 OR (length(stem) - length(replace(stem, '_', '')) >= 3 AND len(regexp_extract_all(stem, '\d+')) >= 2)) AS listing FROM s"""
)
def a11_listing_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.is_listing("url").alias("listing"))


@query(
    """WITH asked AS (SELECT term, page FROM (SELECT term, pos, page, row_number() OVER (ORDER BY pos, page) AS n
  FROM (VALUES ('click', 0), ('error', 1), ('purchase', 2), ('signup', 3), ('view', 4)) t(term, pos), (SELECT unnest(range(0, 3)) AS page) WHERE term <> 'error' OR page < 2) WHERE n <= 8)
SELECT DISTINCT 'https://shop.org/item/' || user_id || '?k=' || event_id % 7 AS url FROM events JOIN asked ON event_type = term AND event_id % 5 = page WHERE NOT (event_type = 'error' AND event_id % 5 >= 1) AND user_id % 3 <> 0"""
)
def a12_search_grid(spark, sf_dir):
    """Five terms with three pages each and eight queries; 'error' has no second page, and a third of the hits is on other sites."""
    events = table(spark, sf_dir, "events")
    page = (F.col("event_id") % 5).cast("int")
    site = F.when(F.col("user_id") % 3 == 0, "other.org").otherwise("shop.org")
    href = F.concat(F.lit("/url?q=https%3A%2F%2F"), site, F.lit("%2Fitem%2F"), F.col("user_id").cast("string"), F.lit("%3Fk%3D"), (F.col("event_id") % 7).cast("string"), F.lit("&sa=U"))
    results = events.where(~((F.col("event_type") == "error") & (page >= 1))).select(F.col("event_type").alias("term"), page.alias("page"), href.alias("href"))
    terms = spark.createDataFrame([(i, t) for i, t in enumerate(("click", "error", "purchase", "signup", "view"))], "pos int, term string")
    return D.search_grid(terms, results, "shop.org", pages=3, budget=8)


@query(
    """SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'https://a.org/' || user_id WHEN 1 THEN 'https://a.org/x y' WHEN 2 THEN 'http://b.org/' || user_id WHEN 3 THEN '' ELSE 'https://c.org/z' END AS target FROM events"""
)
def a13_decoded_redirects(spark, sf_dir):
    user = F.col("user_id").cast("string")
    href = (
        F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("/url?sa=t&q=https%3A%2F%2Fa.org%2F"), user, F.lit("&x=1")))
        .when(F.col("event_id") % 5 == 1, F.lit("https://s.org/r?url=https%3A%2F%2Fa.org%2Fx+y"))
        .when(F.col("event_id") % 5 == 2, F.concat(F.lit("http://b.org/"), user))
        .when(F.col("event_id") % 5 == 3, F.lit("/search?page=2"))
        .otherwise(F.lit("https://s.org/r?id=1&target=https%3A%2F%2Fc.org%2Fz"))
    )
    return table(spark, sf_dir, "events").select("event_id", U.decode_redirect(href).alias("target"))


_DENIED = ", ".join(f"'{d}'" for d in D.DENIED)


@query(
    rf"""WITH t AS (SELECT html AS x FROM pages UNION ALL SELECT text FROM documents UNION ALL SELECT 'see ' || url || ', and (' || url || ').' FROM pages),
w AS (SELECT regexp_replace(regexp_replace(regexp_replace(u, '[.,;]+$', ''), '[?#].*$', ''), '/+$', '') AS url FROM (SELECT unnest(regexp_extract_all(x, 'https?://[^\s"''<>)\]]+')) AS u FROM t)),
b AS (SELECT lower(d) AS d FROM (SELECT unnest(regexp_extract_all(x, '(?i)\b((?:[a-z0-9\-]+\.)+(?:com|org|net|ru|de|eu))\b', 1)) AS d FROM t))
SELECT url FROM w WHERE {_AUTH.format("url")} <> '' UNION SELECT 'https://' || d FROM b WHERE d NOT IN ({_DENIED})"""
)
def a14_mined_sources(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    said = pages.select(F.concat(F.lit("see "), "url", F.lit(", and ("), "url", F.lit(").")).alias("text"))
    return D.mined_sources(pages.select(F.col("html").alias("text")).unionByName(table(spark, sf_dir, "documents").select("text")).unionByName(said))


@query(
    """WITH c AS (SELECT 'http://s.org/' || c_custkey AS url, 'candidate' AS status, c_custkey % 90 AS score FROM customer),
a AS (SELECT 'http://s.org/' || s_suppkey * 3 AS url, 'approved' AS status, CAST(100 AS BIGINT) AS score FROM supplier)
SELECT url, coalesce(a.status, c.status) AS status, CAST(coalesce(a.score, c.score) AS BIGINT) AS score FROM c FULL JOIN a USING (url)"""
)
def a22_merged_sources(spark, sf_dir):
    site = lambda c: F.concat(F.lit("http://s.org/"), c.cast("string")).alias("url")
    found = table(spark, sf_dir, "customer").select(site(F.col("c_custkey")), F.lit("candidate").alias("status"), (F.col("c_custkey") % 90).cast("long").alias("score"))
    approved = table(spark, sf_dir, "supplier").select(site(F.col("s_suppkey") * 3), F.lit("approved").alias("status"), F.lit(100).cast("long").alias("score"))
    return D.merged_sources(found, approved)


@query(
    """WITH s AS (SELECT CASE p_partkey % 4 WHEN 0 THEN 'ftp' ELSE 'https' END || '://s.org/' || p_partkey AS url, CASE WHEN p_size % 2 = 0 THEN 'approved' ELSE 'candidate' END AS status, CASE WHEN p_partkey % 3 = 0 THEN 'soon' ELSE CAST(p_size AS VARCHAR) END AS priority FROM part)
SELECT url, CAST(row_number() OVER (ORDER BY coalesce(TRY_CAST(priority AS INT), 999999), url) AS INT) AS place FROM s WHERE status = 'approved' AND regexp_matches(url, '^https?:')"""
)
def a23_approved_urls(spark, sf_dir):
    from pyspark.sql.window import Window

    k = F.col("p_partkey")
    url = F.concat(F.when(k % 4 == 0, "ftp").otherwise("https"), F.lit("://s.org/"), k.cast("string"))
    priority = F.when(k % 3 == 0, "soon").otherwise(F.col("p_size").cast("string"))
    sources = table(spark, sf_dir, "part").select(url.alias("url"), F.when(F.col("p_size") % 2 == 0, "approved").otherwise("candidate").alias("status"), priority.alias("priority"))
    got = D.approved_urls(sources).withColumn("read", F.monotonically_increasing_id())
    return got.select("url", F.row_number().over(Window.orderBy("read")).alias("place"))


# --- Files and text ----------------------------------------------------------------------------------------


@query(
    rf"""WITH p AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array({_NORM.format("replace(text, '. ', '.' || chr(13) || chr(10) || chr(10))")}, '\n\s*\n'), lambda x: {_STRIP.format("x")}), lambda x: x <> '') AS ps FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS uri, CAST(i - 1 AS INT) AS pos, ps[i] AS text, 'text' AS kind FROM p, LATERAL (SELECT unnest(range(1, len(ps) + 1)) AS i)"""
)
def x1_text_blocks(spark, sf_dir):
    """Sentences end in an empty line with a carriage return here; the bytes begin with a mark of their order."""
    body = F.concat(F.lit("﻿"), F.replace("text", F.lit(". "), F.lit(".\r\n\n")))
    return files.text_blocks(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("uri"), F.encode(body, "UTF-8").alias("content")))


@query(
    """WITH a AS (SELECT page_id, ['a.pdf', 'b.DOCX', 'c.xlsx', 'd.html', 'e.md', 'f.bin', ''][1 + page_id % 7] AS f, ['', 'text/html; charset=utf-8', 'application/pdf'][1 + page_id % 3] AS m FROM pages),
e AS (SELECT *, lower(regexp_extract(CASE WHEN f <> '' THEN f ELSE 'z.txt' END, '\\.([^.]*)$', 1)) AS x, trim(string_split(m, ';')[1]) AS t FROM a)
SELECT page_id, CASE WHEN t = 'application/pdf' OR x = 'pdf' THEN 'pdf' WHEN x = 'docx' THEN 'docx' WHEN x = 'xlsx' THEN 'xlsx' WHEN t = 'text/html' OR x = 'html' THEN 'html-xml' WHEN x IN ('md', 'txt') THEN 'text' END AS extractor FROM e"""
)
def x10_extractor_routes(spark, sf_dir):
    pick = lambda options: F.element_at(F.array(*map(F.lit, options)), (1 + F.col("page_id") % len(options)).cast("int"))
    rows = table(spark, sf_dir, "pages").select("page_id", F.lit("http://h/z.txt").alias("uri"), pick(["a.pdf", "b.DOCX", "c.xlsx", "d.html", "e.md", "f.bin", ""]).alias("filename"), pick(["", "text/html; charset=utf-8", "application/pdf"]).alias("media_type"))
    return files.with_extractor(rows).select("page_id", "extractor")


@query("SELECT doc_id, text FROM documents")
def x17_clean_parsed(spark, sf_dir):
    """Invisible characters are put in between letters, and have to go again."""
    marked = F.replace(F.replace("text", F.lit("e"), F.lit("​e")), F.lit(" "), F.lit(" ﻿"))
    return table(spark, sf_dir, "documents").select("doc_id", T.clean_parsed(marked).alias("text"))


@query(
    """WITH a AS (SELECT page_id, ['a.pdf', 'b.HTM', 'c.bin', 'd', 'e.md'][1 + page_id % 5] AS f, ['', 'text/xml; x=1', 'application/zip'][1 + page_id % 3] AS m, ['html-xml', '', 'Custom'][1 + page_id // 15 % 3] AS x FROM pages)
SELECT page_id, CASE WHEN f = 'a.pdf' THEN 'pdf' WHEN f = 'b.HTM' THEN 'html' WHEN f = 'e.md' THEN 'markdown' WHEN m = 'text/xml; x=1' THEN 'xml' WHEN x = 'html-xml' THEN 'html' WHEN x <> '' THEN lower(x) ELSE 'unknown' END AS source_type FROM a"""
)
def b11_source_types(spark, sf_dir):
    pick = lambda options, n: F.element_at(F.array(*map(F.lit, options)), (1 + n % len(options)).cast("int"))
    k = F.col("page_id")
    kind = T.source_type(pick(["a.pdf", "b.HTM", "c.bin", "d", "e.md"], k), pick(["", "text/xml; x=1", "application/zip"], k), pick(["html-xml", "", "Custom"], F.floor(k / 15)))
    return table(spark, sf_dir, "pages").select("page_id", kind.alias("source_type"))


@query(
    rf"""WITH {_LINES}, k AS (SELECT doc_id, count(*) AS n, count(*) FILTER (contains(text, '|')) AS tables, count(*) FILTER (NOT contains(text, '|') AND length(text) < 25) AS heads FROM chunks GROUP BY doc_id)
SELECT doc_id, CASE WHEN tables > 0 AND 2 * tables >= n THEN 'tabular' WHEN tables + heads > 0 THEN 'structured' ELSE 'text' END AS class FROM k"""
)
def b12_document_classes(spark, sf_dir):
    kind = F.when(F.col("text").contains("|"), "table").when(F.length("text") < 25, "heading").otherwise("text")
    return line_chunks(spark, sf_dir).groupBy("doc_id").agg(F.collect_list(kind).alias("kinds")).select("doc_id", T.document_class(F.col("kinds")).alias("class"))


#: Rows of five kinds of administrative and contact texts, and two that stay, by the last digit of a key.
_SAID = ("Итого по разделу", "ИНН: 7701234567 БИК", "ООО «Ромашка»", "кабель силовой медный 3х2,5", "офис в Риге, 3 этаж", "тел: 123", "Казахстан, Алматы, e-mail a@b.kz", "труба стальная 57х3", "дата", "щит")
_SAID_SQL = "['" + "', '".join(_SAID) + "'][1 + s_suppkey % 10] || ' ' || s_name"
_META_SQL = "(s_suppkey % 10 IN (0, 1, 2, 5, 8))"
_OFFICE_SQL = "(s_suppkey % 10 IN (4, 6))"


def _said():
    return F.concat(F.element_at(F.array(*map(F.lit, _SAID)), (1 + F.col("s_suppkey") % 10).cast("int")), F.lit(" "), F.col("s_name"))


@query(f"SELECT s_suppkey, {_META_SQL} AS metadata FROM supplier")
def b14_metadata_rows(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", T.is_metadata_row(_said()).alias("metadata"))


@query(f"SELECT s_suppkey, {_OFFICE_SQL} AS office FROM supplier")
def b16_office_boilerplate(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", T.is_office_boilerplate(_said()).alias("office"))


@query(
    f"""WITH s AS (SELECT s_suppkey, {_SAID_SQL} AS t, {_META_SQL} AS meta, {_OFFICE_SQL} AS office FROM supplier)
SELECT s_suppkey, s_suppkey % 11 = 0 OR (length(t) >= 25 AND NOT meta AND NOT office AND NOT ends_with(t, '3')) AS kept FROM s"""
)
def b17_kept_chunks(spark, sf_dir):
    kind = F.when(F.col("s_suppkey") % 11 == 0, "heading").otherwise("text")
    return table(spark, sf_dir, "supplier").select("s_suppkey", T.keep_chunk(_said(), kind, min_length=25, exclude="3$").alias("kept"))


@query(
    f"""SELECT page_id, CAST(CASE WHEN regexp_matches(lower(url), '\\.(pdf|docx?|xlsx?)(\\?|$)') THEN 30 ELSE 0 END + CASE WHEN contains(lower(url), 'the') OR contains(lower(url), '/en/') THEN 10 ELSE 0 END
  + CASE WHEN contains(lower(url), 'an') THEN 8 ELSE 0 END + CASE WHEN contains(lower(url), 'ref=') THEN 8 ELSE 0 END + CASE WHEN contains({_DOMAIN.format("url")}, 'example.org') THEN 12 ELSE 0 END - CASE WHEN contains(lower(url), '/fr/') THEN 30 ELSE 0 END AS INT) AS score FROM pages"""
)
def b22_candidate_scores(spark, sf_dir):
    score = U.candidate_score("url", base_terms=("the", "/en/"), terms=("an", "ref="), domains=("example.org",), negative=("/fr/",))
    return table(spark, sf_dir, "pages").select("page_id", score.cast("int").alias("score"))


@query(
    rf"""WITH p AS (SELECT page_id, regexp_replace(regexp_replace({_PATH.format("url")}, '^/+|/+$', '', 'g'), '(?i)\.(php|html?|aspx?|jsp)$', '') AS p FROM pages),
r AS (SELECT page_id, CASE WHEN starts_with(p, 'en') THEN regexp_replace(substr(p, 3), '^/+|/+$', '', 'g') ELSE p END AS rest FROM p),
d AS (SELECT page_id, regexp_replace(regexp_replace(replace(rest, '/', '__'), '[^\w\-]', '_', 'g'), '^_+|_+$', '', 'g') AS d FROM r)
SELECT page_id, CASE WHEN d = '' THEN 'index' ELSE d END AS document_id FROM d"""
)
def b25_document_ids(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.document_id(F.lit("http://h/en/"), "url").alias("document_id"))


@query(
    "WITH f AS (SELECT page_id, ['a.PDF', 'b.docx', 'c.htm', 'd.csv', 'e', 'f.json', 'g.x.md', 'h.zip'][1 + page_id % 8] AS f FROM pages) SELECT page_id, CASE f WHEN 'a.PDF' THEN 'application/pdf' WHEN 'b.docx' THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document' WHEN 'c.htm' THEN 'text/html' WHEN 'd.csv' THEN 'text/csv' WHEN 'f.json' THEN 'application/json' WHEN 'g.x.md' THEN 'text/markdown' ELSE '' END AS media_type FROM f"
)
def b28_media_types(spark, sf_dir):
    name = F.element_at(F.array(*map(F.lit, ["a.PDF", "b.docx", "c.htm", "d.csv", "e", "f.json", "g.x.md", "h.zip"])), (1 + F.col("page_id") % 8).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", U.media_type(name).alias("media_type"))


@query(
    "WITH t AS (SELECT page_id, 'go to ' || replace(url, '://', '://user:secret@') || ' or ' || url || '?token=abc now' AS t FROM pages) SELECT page_id, regexp_replace(regexp_replace(t, '(https?://)[^\\s\"''<>/?#]*@', '\\1', 'g'), '(https?://[^\\s\"''<>?#]+)[?#][^\\s\"''<>]*', '\\1', 'g') AS text FROM t"
)
def b29_redacted(spark, sf_dir):
    said = F.concat(F.lit("go to "), F.replace("url", F.lit("://"), F.lit("://user:secret@")), F.lit(" or "), "url", F.lit("?token=abc now"))
    return table(spark, sf_dir, "pages").select("page_id", U.redact(said).alias("text"))


@query("SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'recaptcha' WHEN 1 THEN 'yandex_smartcaptcha' WHEN 2 THEN 'captcha' END AS kind FROM pages")
def b30_captcha_pages(spark, sf_dir):
    """Three kinds of challenge pages by id; every fourth page is its own with more words below, so that it shows more than a challenge."""
    body = lambda mark: F.lit(f"<html><body><div {mark}></div>please wait</body></html>")
    k = F.col("page_id") % 4
    html = F.when(k == 0, body('class="g-recaptcha"')).when(k == 1, body('id="smartcaptcha"')).when(k == 2, body('class="x captcha-container"')).otherwise(F.replace("html", F.lit("<body>"), F.lit('<body><div class="g-recaptcha"></div><p>' + "more than a challenge " * 25 + "</p>")))
    return table(spark, sf_dir, "pages").select("page_id", U.captcha(html).alias("kind"))


@query(
    """WITH c AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS s, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'Book' END AS t, CASE WHEN c_custkey % 2 = 0 THEN 'shop.org' ELSE '' END AS d FROM customer),
p AS (SELECT *, concat_ws(' | ', nullif(d, ''), nullif(concat_ws(' > ', nullif(t, ''), nullif(s, '')), '')) AS crumb FROM c)
SELECT c_custkey, CASE WHEN crumb <> '' THEN crumb || chr(10) || chr(10) || c_name ELSE c_name END AS text FROM p"""
)
def b33_breadcrumbs(spark, sf_dir):
    k = F.col("c_custkey")
    text = T.with_breadcrumb(F.col("c_name"), F.when(k % 3 == 0, "").otherwise(F.col("c_mktsegment")), F.when(k % 5 == 0, "").otherwise("Book"), F.when(k % 2 == 0, "shop.org").otherwise(""))
    return table(spark, sf_dir, "customer").select("c_custkey", text.alias("text"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'none' WHEN length(trim(o_orderpriority)) <= 8 THEN trim(o_orderpriority) ELSE 'none' END AS text FROM orders")
def b35_safe_texts(spark, sf_dir):
    padded = F.when(F.col("o_orderkey") % 4 == 0, F.lit(" \n ")).otherwise(F.concat(F.lit("  "), "o_orderpriority", F.lit("\t")))
    return table(spark, sf_dir, "orders").select("o_orderkey", T.safe_text(padded, "none", 8).alias("text"))


@query("SELECT doc_id, substr(sha256(text), 1, 16) AS h FROM documents")
def b37_content_hashes(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.content_hash(F.col("text")).alias("h"))


@query(
    r"""WITH t AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN upper(p_brand || ' ' || p_type) WHEN 1 THEN p_size || '. ' || p_name ELSE p_name END AS t FROM part)
SELECT p_partkey, CASE WHEN regexp_matches(t, '^[A-ZА-ЯЁ\s\d\-\.\,]{8,}$') THEN 1 WHEN regexp_matches(t, '^\d{1,3}[\.\)]\s+') THEN 2 ELSE 3 END AS level FROM t"""
)
def b38_heading_levels(spark, sf_dir):
    k = F.col("p_partkey") % 3
    said = F.when(k == 0, F.upper(F.concat("p_brand", F.lit(" "), "p_type"))).when(k == 1, F.concat(F.col("p_size").cast("string"), F.lit(". "), "p_name")).otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", T.heading_level(said).alias("level"))


# --- Chunkers ----------------------------------------------------------------------------------------------


@query()
def k9_chunking_log(spark, sf_dir):
    units = table(spark, sf_dir, "documents").select("doc_id", F.lit(0).alias("idx"), F.lit(1).alias("page"), F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))
    return K.chunking_log(K.blocks_from_units(units))


_CHAR_WINDOWS = rf"""
WITH RECURSIVE d AS (SELECT doc_id, text, length(text) AS n FROM documents),
cut(doc_id, begin, stop, done) AS (
  SELECT doc_id, CAST(0 AS BIGINT), CAST(-1 AS BIGINT), n <= 2048 FROM d
  UNION ALL
  SELECT doc_id, nxt, CASE WHEN nxt + 2048 >= n THEN n WHEN nl > 0 THEN nxt + 2048 - 409 + nl WHEN sp > 0 THEN nxt + 2048 - 409 + sp ELSE nxt + 2048 END, false
  FROM (SELECT *, CASE WHEN instr(reverse(w), chr(10)) > 0 THEN length(w) - instr(reverse(w), chr(10)) + 1 ELSE 0 END AS nl, CASE WHEN instr(reverse(w), ' ') > 0 THEN length(w) - instr(reverse(w), ' ') + 1 ELSE 0 END AS sp
    FROM (SELECT d.doc_id, d.n, nxt, substr(d.text, CAST(nxt + 2048 - 409 + 1 AS BIGINT), 409) AS w
      FROM (SELECT doc_id, CASE WHEN stop < 0 THEN 0 WHEN stop - 200 > begin THEN stop - 200 ELSE stop END AS nxt FROM cut WHERE NOT done) c JOIN d USING (doc_id) WHERE nxt < d.n))),
parts AS (SELECT doc_id, begin, {_STRIP.format("substr(text, CAST(begin + 1 AS BIGINT), CAST(stop - begin AS BIGINT))")} AS text FROM cut JOIN d USING (doc_id) WHERE stop >= 0
  UNION ALL SELECT doc_id, 0, text FROM d WHERE n <= 2048 AND {_STRIP.format("text")} <> '')
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY begin) - 1 AS INT) AS part, text FROM parts WHERE text <> ''
"""


@query(_CHAR_WINDOWS)
def k16_split_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    return docs.select("doc_id", F.posexplode(K.split_text(F.col("text"), 512, 50)).alias("part", "text"))


_ROW_GROUPS = """
WITH RECURSIVE d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
r AS (SELECT doc_id, i - 1 AS i, length(ls[i]) + 1 AS c, length(ls[1]) + 1 AS h, len(ls) AS n FROM d, LATERAL (SELECT unnest(range(2, len(ls) + 1)) AS i)),
g(doc_id, i, part, held) AS (
  SELECT doc_id, CAST(0 AS BIGINT), 0, CAST(0 AS BIGINT) FROM d WHERE len(ls) > 1
  UNION ALL
  SELECT r.doc_id, r.i, CASE WHEN g.i = 0 OR h + held + c <= 2048 THEN part ELSE part + 1 END, CASE WHEN g.i = 0 OR h + held + c <= 2048 THEN held + c ELSE c END
  FROM g JOIN r ON r.doc_id = g.doc_id AND r.i = g.i + 1)
SELECT g.doc_id, part, any_value(ls[1]) || chr(10) || string_agg(ls[i + 1], chr(10) ORDER BY i) AS text FROM g JOIN d ON d.doc_id = g.doc_id WHERE i > 0 GROUP BY g.doc_id, part
UNION ALL SELECT doc_id, 0, text FROM d WHERE len(ls) <= 1 AND trim(text) <> ''
"""


@query(_ROW_GROUPS)
def k17_split_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    return docs.select("doc_id", F.posexplode(K.split_rows(F.col("text"), 512, 1)).alias("part", "text"))


# --- Summaries ---------------------------------------------------------------------------------------------


@query(
    f"""WITH {_ELEMENTS}, a AS (SELECT 'row_level' AS strategy, {_TOKENS.format(_STRIP.format("text"))} AS n FROM body),
m AS (SELECT doc_id, part, grp, string_agg(text, chr(10) ORDER BY idx) AS text FROM (SELECT *, (row_number() OVER (PARTITION BY doc_id, part ORDER BY idx) - 1) // 30 AS grp FROM body) GROUP BY doc_id, part, grp),
u AS (SELECT * FROM a UNION ALL SELECT 'row_group', {_TOKENS.format(_STRIP.format("text"))} FROM m)
SELECT strategy, count(*) AS total_chunks, CAST(sum(n) AS BIGINT) AS total_tokens, min(n) AS min_tokens, max(n) AS max_tokens FROM u GROUP BY strategy"""
)
def g6_strategy_report(spark, sf_dir):
    return K.compare_strategies(conversation_elements(spark, sf_dir), ("row_level", "row_group")).select("strategy", "total_chunks", "total_tokens", "min_tokens", "max_tokens")


@query("SELECT 'units' AS log, CAST(sum(CASE WHEN c_custkey % 2 = 0 THEN c_nationkey ELSE 0 END) AS BIGINT) AS total FROM customer UNION ALL SELECT 'pages', CAST(sum(c_custkey % 50) AS BIGINT) FROM customer UNION ALL SELECT 'most', CAST(max(c_custkey % 50) AS BIGINT) FROM customer UNION ALL SELECT 'average', CAST(trunc(avg(c_nationkey) FILTER (c_nationkey > 0)) AS BIGINT) FROM customer")
def g7_extraction_logs(spark, sf_dir):
    """Logs whose newer key is missing in every second one, and older ones without the key at all."""
    k = F.col("c_custkey")
    logs = table(spark, sf_dir, "customer").select(F.when(k % 2 == 0, F.col("c_nationkey")).alias("units"), (k % 50).alias("total_pages"), F.col("c_nationkey").alias("average"), (k % 50).alias("most"))
    got = Q.sum_logs(logs, {"units": ["units"], "pages": ["processed_pages", "total_pages"]}, ("most",), ("average",))
    return got.select(F.explode(F.array(*(F.struct(F.lit(n).alias("log"), F.col(n).cast("long").alias("total")) for n in ("units", "pages", "most", "average")))).alias("x")).select("x.*")


@query("SELECT CAST(sum(p_size) AS BIGINT) AS chunks, CAST(sum(coalesce(CASE WHEN p_partkey % 3 > 0 THEN p_size * 2 END, p_size)) AS BIGINT) AS tokens, max(p_size) AS max_tokens FROM part")
def g8_chunking_logs(spark, sf_dir):
    logs = table(spark, sf_dir, "part").select(F.col("p_size").alias("chunks"), F.when(F.col("p_partkey") % 3 > 0, F.col("p_size") * 2).alias("tokens"), F.col("p_size").alias("token_total"), F.col("p_size").alias("max_tokens"))
    return Q.sum_logs(logs, {"chunks": ["chunks"], "tokens": ["tokens", "token_total"]}, ("max_tokens",)).select(F.col("chunks").cast("long").alias("chunks"), F.col("tokens").cast("long").alias("tokens"), "max_tokens")


@query("SELECT count(*) AS documents, CAST(sum(s_suppkey % 2) AS BIGINT) AS failed, CAST(trunc(avg(s_suppkey) FILTER (s_suppkey > 0)) AS INT) AS tokens FROM supplier")
def g9_quality_logs(spark, sf_dir):
    logs = table(spark, sf_dir, "supplier").select(F.lit(1).alias("documents"), (F.col("s_suppkey") % 2).alias("failed"), F.col("s_suppkey").cast("int").alias("tokens"))
    return Q.sum_logs(logs, {"documents": ["documents"], "failed": ["failed"]}, (), ("tokens",)).select(F.col("documents").cast("long").alias("documents"), F.col("failed").cast("long").alias("failed"), "tokens")


@query(
    """WITH o AS (SELECT CASE WHEN event_type IN ('view', 'click') THEN 'processed' WHEN event_type = 'error' THEN 'failed' ELSE 'skipped' END AS status, event_id % 9 = 0 AS bad FROM events)
SELECT count(*) FILTER (status = 'processed') AS processed, count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (bad AND status = 'processed') AS quality_failed, 'partial' AS overall FROM o"""
)
def g12_manifest_summary(spark, sf_dir):
    status = F.when(F.col("event_type").isin("view", "click"), "processed").when(F.col("event_type") == "error", "failed").otherwise("skipped")
    outcomes = table(spark, sf_dir, "events").select(status.alias("status"), "event_id").withColumn("quality_passed", F.when(F.col("status") == "processed", F.col("event_id") % 9 != 0))
    return Q.manifest_summary(outcomes)


@query(
    """WITH f AS (SELECT conv_id, turn, role, CASE role WHEN 'system' THEN 'error' WHEN 'user' THEN 'warning' ELSE 'info' END AS severity FROM conversations WHERE turn % 2 = 1)
SELECT c.conv_id AS doc_id, c.n AS chunks, coalesce(x.codes, '') AS codes, coalesce(x.severities, '') AS severities FROM (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id) c
LEFT JOIN (SELECT conv_id, string_agg(DISTINCT role, ',' ORDER BY role) AS codes, (SELECT string_agg(severity || '=' || n, ',' ORDER BY severity) FROM (SELECT severity, count(*) AS n FROM f g WHERE g.conv_id = f.conv_id GROUP BY severity)) AS severities FROM f GROUP BY conv_id) x USING (conv_id)"""
)
def g13_dataset_inventory(spark, sf_dir):
    severity = F.when(F.col("role") == "system", "error").when(F.col("role") == "user", "warning").otherwise("info")
    found = F.array_compact(F.collect_list(F.when(F.col("turn") % 2 == 1, F.struct(F.col("role").alias("code"), severity.alias("severity")))))
    reports = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.count(F.lit(1)).alias("chunks"), F.lit(1).alias("blocks"), found.alias("findings"))
    flat = F.array_join(F.transform(F.array_sort(F.map_entries("severities")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return Q.dataset_inventory(reports).select("doc_id", "chunks", F.array_join("codes", ",").alias("codes"), flat.alias("severities"))


@query(
    f"""WITH c AS (SELECT url, length(url) % 17 AS score, page_id AS pos FROM pages UNION ALL SELECT url, 5, page_id + 100000 FROM pages WHERE page_id % 3 = 0),
u AS (SELECT url, {_DOMAIN.format("url")} AS domain, sum(score) AS score, min(pos) AS pos FROM c GROUP BY url),
r AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY score DESC, pos) AS place, sum(score) OVER (PARTITION BY domain) AS total, count(*) OVER (PARTITION BY domain) AS found FROM u),
b AS (SELECT domain, url, score + floor((total - score) / 2) AS score, found FROM r WHERE place = 1 ORDER BY score + floor((total - score) / 2) DESC, url LIMIT 90),
p AS (SELECT b.*, min(page_id) AS k FROM b JOIN pages USING (url) GROUP BY ALL),
s AS (SELECT domain, url, found, score + least(k % 25, 20) + least(k % 40 // 2, 15) + least(k % 14, 12) + CASE WHEN k % 2 = 0 THEN 10 ELSE 0 END - CASE WHEN k % 5 = 0 THEN 8 ELSE 0 END AS score FROM p)
SELECT CAST(row_number() OVER (ORDER BY score DESC, url) AS INT) AS rank, domain, url, CAST(score AS BIGINT) AS score, found AS domain_urls_found FROM s WHERE score >= 12 ORDER BY score DESC, url LIMIT 30"""
)
def g15_ranked_sources(spark, sf_dir):
    """The thirty best are the feature here."""
    pages, k = table(spark, sf_dir, "pages").select("page_id", "url"), F.col("k")
    twice = pages.where("page_id % 3 = 0").select("url", F.lit(5).alias("score"), (F.col("page_id") + 100000).alias("pos"))
    candidates = pages.select("url", (F.length("url") % 17).alias("score"), F.col("page_id").alias("pos")).unionByName(twice)
    probes = pages.groupBy("url").agg(F.min("page_id").alias("k")).select("url", (k % 25).alias("file_links"), (k % 40).alias("product_links"), (k % 14).alias("relevance"), (k % 2 == 0).alias("pagination"), (k % 5 == 0).alias("error"))
    return S.rank_sources(candidates, probes, top_n=30).withColumn("score", F.col("score").cast("long"))


@query(
    rf"""WITH b AS (SELECT page_id, url, html || CASE page_id % 4 WHEN 0 THEN '<a href="/f/a.pdf">x</a><a href="b.docx?v=1">x</a><a href="/c.xls">x</a><a href="d.xml">x</a><a href="e.htm">x</a>' WHEN 1 THEN '<a href="/catalog/1">x</a><a href="?page=3">x</a>' ELSE '' END AS html FROM pages),
h AS (SELECT page_id, url, html, {_HREFS} AS hs FROM b),
n AS (SELECT page_id, url, len(list_filter(hs, lambda x: regexp_matches(lower(x), '\.(pdf|docx?|xlsx?|html?|xml)($|\?)'))) + CASE WHEN page_id % 4 = 1 AND regexp_matches(lower({_PATH.format("url")}), '\.(pdf|docx?|xlsx?|html?|xml)$') THEN 1 ELSE 0 END AS file_links, len(list_filter(hs, lambda x: regexp_matches(x, '^/catalog/'))) AS product_links,
  CASE WHEN contains(lower(html), 'license') THEN 1 ELSE 0 END + CASE WHEN contains(lower(html), 'article') THEN 1 ELSE 0 END AS relevance, len(list_filter(hs, lambda x: contains(x, '?page='))) > 0 AS pagination FROM h)
SELECT page_id, file_links, product_links, relevance, pagination, CASE WHEN file_links >= 5 THEN 'files' WHEN product_links > 0 THEN 'web' ELSE 'mixed' END AS mode FROM n"""
)
def g16_probed_pages(spark, sf_dir):
    k = F.col("page_id") % 4
    more = F.when(k == 0, '<a href="/f/a.pdf">x</a><a href="b.docx?v=1">x</a><a href="/c.xls">x</a><a href="d.xml">x</a><a href="e.htm">x</a>').when(k == 1, '<a href="/catalog/1">x</a><a href="?page=3">x</a>').otherwise("")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.concat("html", more).alias("html"))
    got = S.probe_pages(pages.withColumn("url", F.concat("url", F.lit("#"), F.col("page_id").cast("string"))), ("license", "article"))
    return got.select(F.regexp_extract("url", r"#(\d+)$", 1).cast("long").alias("page_id"), F.col("file_links").cast("long").alias("file_links"), F.col("product_links").cast("long").alias("product_links"), "relevance", "pagination", "mode")


@query(
    """WITH p AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN NULL WHEN doc_id % 4 = 1 THEN substr(sha256(text), 1, 16) ELSE 'old' END AS sha FROM documents)
SELECT 'd' || doc_id AS slug, CASE WHEN sha IS NULL THEN 'would_create' WHEN sha = 'old' THEN 'would_update' ELSE 'unchanged' END AS status FROM p"""
)
def s9_publication_plan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("slug"), F.col("text").alias("markdown"), "doc_id")
    out = docs.where("doc_id % 4 <> 0").select("slug", F.when(F.col("doc_id") % 4 == 1, T.content_hash(F.col("markdown"))).otherwise("old").alias("sha"))
    return files.publication_plan(docs, out, create_missing=True)


@query("SELECT CASE WHEN doc_id % 4 = 0 THEN 'missing' WHEN doc_id % 4 = 1 THEN 'unchanged' ELSE 'updated' END AS status, count(*) AS n FROM documents GROUP BY 1")
def g17_publication_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("slug"), F.col("text").alias("markdown"), "doc_id")
    out = docs.where("doc_id % 4 <> 0").select("slug", F.when(F.col("doc_id") % 4 == 1, T.content_hash(F.col("markdown"))).otherwise("old").alias("sha"))
    return Q.outcome_counts(files.publication_plan(docs, out, create_missing=False, dry_run=False))


_TASKS = """WITH t AS (SELECT user_id AS task_id, ts, event_id, CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'completed' ELSE 'enqueued' END AS event FROM events),
e AS (SELECT *, sum(CASE WHEN event = 'failed' THEN 1 ELSE 0 END) OVER w AS fails, row_number() OVER w AS n FROM t WINDOW w AS (PARTITION BY task_id ORDER BY ts, event, event_id)),
d AS (SELECT task_id, min(n) AS n FROM e WHERE event = 'completed' OR fails = 4 AND event = 'failed' GROUP BY task_id),
x AS (SELECT task_id, event, fails FROM e JOIN d USING (task_id, n)),
a AS (SELECT task_id, max(fails) AS fails FROM e GROUP BY task_id),
f AS (SELECT a.task_id, CASE WHEN x.event IS NULL THEN 'pending' ELSE x.event END AS state, CAST(coalesce(x.fails, a.fails) AS INT) AS retries FROM a LEFT JOIN x USING (task_id))"""


def _tasks(spark, sf_dir) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "completed").otherwise("enqueued")
    return table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("task_id"), kind.alias("event"), F.col("ts").cast("timestamp").alias("at"))


@query(f"{_TASKS} SELECT state, count(*) AS n, count(*) FILTER (state = 'pending') AS active FROM f GROUP BY state")
def g18_queue_stats(spark, sf_dir):
    return queue.queue_stats(queue.final_states(_tasks(spark, sf_dir)))


@query(f"{_TASKS} SELECT CAST(task_id AS VARCHAR) AS task_id, state, retries FROM f")
def q3_streamed_states(spark, sf_dir):
    """Events as files, read as a stream, folded as keyed state, and each batch's states written under its id."""
    taken, out = fresh_path(spark, "task-events"), fresh_path(spark, "task-states")
    _tasks(spark, sf_dir).write.parquet(taken)
    states = queue.retry_states(queue.intake(spark, taken, files_per_batch=1_000_000))
    queue.drain(states, lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}"), fresh_path(spark, "task-checkpoint"), "update")
    last = spark.read.schema("task_id string, state string, retries int, batch int").parquet(out)
    return last.groupBy("task_id").agg(F.max_by(F.struct("state", "retries"), "batch").alias("s")).select("task_id", "s.state", "s.retries")


@query("SELECT CAST(user_id AS VARCHAR) AS task_id, CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'completed' ELSE 'enqueued' END AS event, count(*) AS n FROM events GROUP BY ALL")
def q1_streamed_intake(spark, sf_dir):
    """Events as files, taken a file at a time; a second drain with the same checkpoint finds nothing new."""
    taken, out, checkpoint = fresh_path(spark, "intake"), fresh_path(spark, "intake-out"), fresh_path(spark, "intake-checkpoint")
    _tasks(spark, sf_dir).repartition(3).write.parquet(taken)
    for _ in range(2):
        queue.drain(queue.intake(spark, taken, files_per_batch=1), lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}"), checkpoint)
    return spark.read.schema(queue.TASKS).parquet(out).groupBy("task_id", "event").agg(F.count(F.lit(1)).alias("n"))


# --- State -------------------------------------------------------------------------------------------------


@query("SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'view' AND user_id % 7 = 3 ORDER BY ts DESC, event_id LIMIT 40 OFFSET 5")
def j5_history_page(spark, sf_dir):
    """A page of the history of a set of keys is the feature here."""
    rows = table(spark, sf_dir, "events").where((F.col("event_type") != "view") & (F.col("user_id") % 7 == 3))
    return S.page_of(rows, [F.desc("ts"), F.col("event_id")], 40, 5).select("event_id", "user_id", "event_type")


@query("SELECT doc_id, n_chars, (SELECT count(*) FROM documents WHERE lang = 'en' AND n_chars > 300) AS total FROM documents WHERE lang = 'en' AND n_chars > 300 ORDER BY doc_id LIMIT 30 OFFSET 10")
def j4_filtered_page(spark, sf_dir):
    """A page with the number of all rows that pass is the feature here."""
    docs = table(spark, sf_dir, "documents")
    return S.filtered_page(docs, [F.col("lang") == "en", F.col("n_chars") > 300], [F.col("doc_id")], 30, 10).select("doc_id", "n_chars", "total")


@query(
    f"""WITH q AS (SELECT conv_id, turn, text, length(text) AS n FROM conversations),
s AS (SELECT *, list_filter(list_transform([substr(text, 1, least(10, n)), substr(text, 11, greatest(0, least(50, n) - 10)), substr(text, 51)], lambda x: {_STRIP.format("x")}), lambda x: x <> '') AS ps FROM q),
p AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 1 AND len(ps) >= 2 THEN ps ELSE [text] END AS ps FROM s),
b AS (SELECT *, turn + coalesce(sum(len(ps) - 1) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM p)
SELECT conv_id AS doc_id, CAST(base + i - 1 AS BIGINT) AS chunk_index, ps[i] AS text FROM b, LATERAL (SELECT unnest(range(1, len(ps) + 1)) AS i)"""
)
def j8_split_at_positions(spark, sf_dir):
    turns = _turns(spark, sf_dir)
    picks = turns.where("chunk_index % 3 = 1").select("doc_id", "chunk_index", F.array(F.lit(50), F.lit(10), F.lit(0), F.lit(10), F.lit(10**6)).alias("positions"))
    return S.split_chunk_at(turns, picks)


def _turns(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("chunk_index"), "text")


@query(
    """WITH e AS (SELECT conv_id AS doc_id, turn AS chunk_index, text, CASE WHEN turn = 1 THEN reverse(text) WHEN turn = 2 THEN text END AS new_text FROM conversations)
SELECT doc_id, chunk_index, coalesce(new_text, text) AS text, new_text IS NOT NULL AND new_text IS DISTINCT FROM text AS changed FROM e"""
)
def j9_edited_chunks(spark, sf_dir):
    turns = _turns(spark, sf_dir)
    edits = turns.where("chunk_index IN (1, 2)").select("doc_id", "chunk_index", F.when(F.col("chunk_index") == 1, F.reverse("text")).otherwise(F.col("text")).alias("new_text"))
    edited, history = S.edit_chunks(turns, edits)
    return edited.join(history.select("doc_id", "chunk_index", F.lit(True).alias("changed")), ["doc_id", "chunk_index"], "left").withColumn("changed", F.coalesce("changed", F.lit(False)))


@query(
    """WITH e AS (SELECT conv_id AS doc_id, turn AS chunk_index, CASE WHEN turn = 1 THEN reverse(text) ELSE text END AS text, turn = 1 AND reverse(text) <> text AS changed FROM conversations)
SELECT doc_id, chunk_index, CASE WHEN NOT changed THEN -1 ELSE ascii(text) END AS first_number FROM e"""
)
def j9_reembedded_chunks(spark, sf_dir):
    """Old vectors hold -1, new ones the code of the text's first character."""
    turns = _turns(spark, sf_dir)
    edits = turns.where("chunk_index = 1").select("doc_id", "chunk_index", F.reverse("text").alias("new_text"))
    edited, history = S.edit_chunks(turns, edits)
    old = turns.select("doc_id", "chunk_index", F.array(F.lit(-1.0).cast("float")).alias("embedding"))
    got = S.reembed(edited, old, history, lambda texts: [[float(ord(t[0]))] for t in texts], 1)
    return got.select("doc_id", "chunk_index", F.get("embedding", F.lit(0)).cast("int").alias("first_number"))


@query("SELECT conv_id AS doc_id, turn AS chunk_index, role = 'system' OR turn % 5 = 4 AS deleted FROM conversations")
def j10_deleted_chunks(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("chunk_index"), "role")
    left, gone = S.delete_rows(rows, rows.where("role = 'system' OR chunk_index % 5 = 4"), ["doc_id", "chunk_index"])
    return left.select("doc_id", "chunk_index", F.lit(False).alias("deleted")).unionByName(gone.select("doc_id", "chunk_index", F.lit(True).alias("deleted")))


@query(
    """WITH gone AS (SELECT c_custkey AS k FROM customer WHERE c_nationkey < 5)
SELECT 'customer' AS t, count(*) AS n FROM customer WHERE c_custkey NOT IN (SELECT k FROM gone) UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_custkey NOT IN (SELECT k FROM gone)
UNION ALL SELECT 'lineitem', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey NOT IN (SELECT k FROM gone)"""
)
def j11_deleted_documents(spark, sf_dir):
    """Documents, what belongs to them, and what belongs to that: customers, orders and lines."""
    customer, orders, lines = (table(spark, sf_dir, n) for n in ("customer", "orders", "lineitem"))
    tables = S.delete_cascade(customer.where("c_nationkey < 5").select("c_custkey"), [("customer", customer, "c_custkey", "c_custkey"), ("orders", orders, "o_custkey", "o_orderkey"), ("lineitem", lines, "l_orderkey", "l_linenumber")])
    counted = [df.agg(F.lit(name).alias("t"), F.count(F.lit(1)).alias("n")) for name, df in tables.items()]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query(
    f"""WITH p AS (SELECT DISTINCT url FROM pages WHERE NOT (regexp_matches({_PATH.format("url")}, '{U.SKIP_SEGMENTS}') OR regexp_matches({_PATH.format("url")}, '{U.SKIP_MEDIA}') OR regexp_matches({_PATH.format("url")}, '{U.MEDIA_EXTENSIONS}')))
SELECT url FROM p WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0) AND url NOT IN (SELECT url FROM pages WHERE page_id % 7 = 0)"""
)
def j12_ingest_plan(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return S.ingest_plan(pages.select("url").distinct(), pages.where("page_id % 3 = 0"), pages.where("page_id % 7 = 0"))


@query(
    """WITH p AS (SELECT page_id, CASE WHEN page_id % 11 = 0 THEN NULL WHEN page_id % 4 = 1 THEN 'same' ELSE html END AS html FROM pages),
h AS (SELECT *, row_number() OVER (PARTITION BY html ORDER BY CAST(page_id AS VARCHAR)) AS n FROM p)
SELECT page_id, CASE WHEN html IS NULL THEN 'fetch_error' WHEN n > 1 OR sha256(html) IN (SELECT sha256(html) FROM p WHERE page_id % 13 = 0) THEN 'duplicate' WHEN page_id % 5 < 3 THEN 'skipped_sparse'
  WHEN page_id % 7 < 2 THEN 'skipped_not_product' WHEN page_id % 2 = 0 THEN 'quarantined' ELSE 'processed' END AS status FROM h"""
)
def j12_ingest_status(spark, sf_dir):
    k = F.col("page_id")
    html = F.when(k % 11 == 0, F.lit(None)).when(k % 4 == 1, F.lit("same")).otherwise(F.col("html"))
    pages = table(spark, sf_dir, "pages").select(k.cast("string").alias("url"), html.alias("html"), (k % 5).alias("n_blocks"), (k % 7).alias("score"), F.when(k % 2 == 0, "warn").otherwise("pass").alias("gate"))
    known = pages.where("CAST(url AS BIGINT) % 13 = 0 AND html IS NOT NULL").select(F.sha2("html", 256).alias("sha256"))
    return S.ingest_status(pages, known).select(F.col("url").cast("long").alias("page_id"), "status")


@query(
    """WITH o AS (SELECT CASE WHEN s_suppkey % 10 = 0 THEN s_suppkey - 1 ELSE s_suppkey END AS doc_index, 'd/' || s_suppkey AS directory, CASE WHEN s_suppkey % 4 = 0 THEN 'failed' ELSE 'processed' END AS status, s_suppkey FROM supplier)
SELECT doc_index, 'missing ' || directory || '/quality.json' AS error FROM o WHERE status = 'processed' AND s_suppkey % 3 = 0 UNION ALL SELECT doc_index, 'bad index' FROM o GROUP BY doc_index HAVING count(*) > 1 OR doc_index < 0"""
)
def j13_integrity_errors(spark, sf_dir):
    k = F.col("s_suppkey")
    folder = F.concat(F.lit("d/"), k.cast("string"))
    suppliers = table(spark, sf_dir, "supplier")
    outcomes = suppliers.select(F.when(k % 10 == 0, k - 1).otherwise(k).alias("doc_index"), folder.alias("directory"), F.when(k % 4 == 0, "failed").otherwise("processed").alias("status"))
    there = suppliers.select(F.explode(F.array_compact(F.array(F.lit("document.json"), F.lit("chunks.json"), F.when(k % 3 != 0, F.lit("quality.json"))))).alias("f"), folder.alias("d"))
    return S.integrity_errors(outcomes, there.select(F.concat("d", F.lit("/"), "f").alias("path")))


@query("SELECT c_custkey, CAST(row_number() OVER (ORDER BY c_nationkey DESC, c_name) AS INT) AS priority FROM customer WHERE c_mktsegment = 'BUILDING'")
def j15_ranked_sources(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("url"), F.col("c_nationkey").alias("score"), F.col("c_mktsegment").alias("status"))
    return S.ranked(rows, "BUILDING").select("c_custkey", "priority")


@query("SELECT c_custkey AS k FROM customer UNION SELECT o_custkey FROM orders")
def j16_union_state(spark, sf_dir):
    return S.union_state(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")))


@query("SELECT coalesce(c.c_nationkey * 1000 + c.c_custkey, s.s_suppkey) AS k, CASE WHEN s_name IS NULL THEN c_name ELSE s_name END AS v FROM customer c FULL JOIN supplier s ON c.c_nationkey * 1000 + c.c_custkey = s.s_suppkey")
def j17_merged_maps(spark, sf_dir):
    old = table(spark, sf_dir, "customer").select((F.col("c_nationkey") * 1000 + F.col("c_custkey")).alias("k"), F.col("c_name").alias("v"))
    return S.merge_maps(old, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("v")), "k", "v")


@query("SELECT c_custkey AS k, c_name AS name FROM customer UNION ALL SELECT 2 * p_partkey, p_name FROM part WHERE 2 * p_partkey NOT IN (SELECT c_custkey FROM customer)")
def j18_appended(spark, sf_dir):
    old = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    return S.append_new(old, table(spark, sf_dir, "part").select((2 * F.col("p_partkey")).alias("k"), F.col("p_name").alias("name")), ["k"])


# --- Sinks -------------------------------------------------------------------------------------------------


@query(f"WITH {_LINES} SELECT doc_id, CAST(idx AS INT) AS chunk_index, text FROM chunks")
def s1_written_chunks(spark, sf_dir):
    """Written as JSON lines and read back."""
    path = fresh_path(spark, "chunks")
    files.write_chunks(line_chunks(spark, sf_dir), path)
    return spark.read.schema("doc_id long, chunk_index int, text string").json(path)


@query(
    """WITH RECURSIVE f AS (SELECT source, doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS size, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents),
g(source, n, part, held) AS (SELECT source, n, 0, size FROM f WHERE n = 1 UNION ALL
  SELECT f.source, f.n, CASE WHEN held + size > 50000 THEN part + 1 ELSE part END, CASE WHEN held + size > 50000 THEN size ELSE held + size END FROM g JOIN f ON f.source = g.source AND f.n = g.n + 1)
SELECT source, doc_id AS pos, size, part FROM g JOIN f USING (source, n)"""
)
def s10_upload_parts(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("source", F.col("doc_id").alias("pos"), F.octet_length("text").cast("long").alias("size"))
    return files.zip_groups(rows, 50_000)
