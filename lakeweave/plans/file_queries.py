"""Queries whose input is files: they are made from the tables' rows, written, and read by the operator under test."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from lakeweave.functions import text as T
from lakeweave.functions import urls as U
from lakeweave.operators import chunking as K
from lakeweave.operators import quality as Q
from lakeweave.plans.queries import _HREFS, _LINES, _NORM, _PATH, _STRIP, line_chunks, query, table
from lakeweave.rows import each_row
from lakeweave.sources import datasets, discovery, files, office, tabular
from lakeweave.sources.scratch import fresh_path


def _lines_to(df, path: str, *folders: str) -> None:
    """One text file for each row (line), below folders by the named columns."""
    df.repartition(4).write.partitionBy(*folders).text(path) if folders else df.repartition(4).write.text(path)


# --- Crawls ------------------------------------------------------------------------------------------------

_FILE_PAGES = "SELECT page_id, url, html || '<a href=\"/f/' || page_id % 20 || '.pdf\">Cable <b>guide</b> ' || page_id % 3 || '</a> see http://d.org/' || page_id % 9 || '.xlsx?v=1 now' AS html FROM pages"


@query(
    rf"""WITH p AS ({_FILE_PAGES}),
l AS (SELECT regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/f/' || page_id % 20 || '.pdf' AS file, page_id, 'Cable guide ' || page_id % 3 AS said FROM p UNION ALL SELECT 'http://d.org/' || page_id % 9 || '.xlsx?v=1', page_id, NULL FROM p)
SELECT file, coalesce(string_agg(DISTINCT said, ' ' ORDER BY said), '') AS anchor_text, count(DISTINCT page_id) AS pages FROM l GROUP BY file"""
)
def a8_file_links(spark, sf_dir):
    pages, k = table(spark, sf_dir, "pages"), F.col("page_id")
    more = F.format_string('<a href="/f/%d.pdf">Cable <b>guide</b> %d</a> see http://d.org/%d.xlsx?v=1 now', k % 20, k % 3, k % 9)
    # A page's own URL may have twins; the id keeps them apart.
    web = pages.select(F.concat(F.regexp_replace("url", "[?#].*$", ""), F.lit("?p="), k.cast("string")).alias("url"), F.concat("html", more).alias("body"))
    return discovery.file_links(web).where("file LIKE '%.pdf' OR file LIKE 'http://d.org/%'")


_CATALOGUE = """WITH RECURSIVE r AS (SELECT CAST(1 AS BIGINT) AS k, 0 AS depth UNION ALL
SELECT c.k, r.depth + 1 FROM r, LATERAL (SELECT unnest([3 * r.k, 3 * r.k + 1]) AS k) c WHERE c.k <= (SELECT max(c_custkey) FROM customer) AND (r.k = 1 OR r.k % 4 <> 2) AND c.k % 11 <> 5)
SELECT k FROM r"""


@query(_CATALOGUE)
def a10_catalogue(spark, sf_dir):
    """Customers' pages below /c/ link to those of three times their number and one more. Pages with numbers 2 mod 4 are leaves by
    their names, links to 5 mod 11 lead out of the folder, and the crawl is cut off after two levels and taken up again."""
    k = F.col("c_custkey")

    def url(c):
        name = F.when(c % 4 == 2, F.concat(F.lit("a_1_b_2_c_"), c.cast("string"), F.lit(".html"))).otherwise(F.concat(c.cast("string"), F.lit("/")))
        return F.concat(F.when(c % 11 == 5, "http://s.org/d/").otherwise("http://s.org/c/"), name)

    link = lambda c: F.concat(F.lit('<a href="'), url(c), F.lit('">x</a>'))
    web = table(spark, sf_dir, "customer").select(url(k).alias("url"), F.concat(link(3 * k), link(3 * k + 1)).alias("body")).unionByName(spark.createDataFrame([("http://s.org/c/", '<a href="http://s.org/c/3/">x</a><a href="http://s.org/c/4/">x</a>')], "url string, body string"))
    state, top = fresh_path(spark, "catalogue"), table(spark, sf_dir, "customer").agg(F.max("c_custkey")).first()[0]
    discovery.catalogue(web, "http://s.org/c/", state, levels=2)
    got = discovery.catalogue(web, "http://s.org/c/", state, levels=40)
    number = F.when(F.col("url") == "http://s.org/c/", F.lit("1")).otherwise(F.regexp_extract("url", r"(\d+)(/|\.html)$", 1)).cast("long")
    return got.select(number.alias("k")).where(F.col("k") <= top).distinct()


# --- Files -------------------------------------------------------------------------------------------------


@query("SELECT 'n' || n_nationkey || '.txt' AS filename, 'text/plain' AS media_type, n_name || chr(10) AS content FROM nation WHERE length(n_name) <= 8")
def a17_local_files(spark, sf_dir):
    """Files of up to nine bytes of 25 in nested folders."""
    path = fresh_path(spark, "local-files")
    rows = table(spark, sf_dir, "nation").select(F.lit("x").alias("uri"), F.format_string("%s/r%d/n%d.txt", F.lit(path), "n_regionkey", "n_nationkey").alias("to"), F.concat("n_name", F.lit("\n")).alias("text"))

    def put(frames):
        for pdf in frames:
            for to, text in zip(pdf["to"], pdf["text"], strict=True):
                datasets._put(to, text.encode())
            yield pdf[["to"]]

    rows.mapInPandas(put, "to string").count()
    return files.local_files(spark, path, 9).select("filename", "media_type", F.col("content").cast("string").alias("content"))


@query("SELECT pos, uri, media_type, region FROM (SELECT row_number() OVER (ORDER BY n_nationkey) - 1 AS pos, 'http://n.org/' || n_nationkey AS uri, 'text/html' AS media_type, CAST(n_regionkey AS VARCHAR) AS region FROM nation) WHERE pos < 20")
def a18_manifest(spark, sf_dir):
    """A manifest of the 25 nations, of which 20 are taken: the limit is a feature."""
    path = fresh_path(spark, "manifest")
    listed = table(spark, sf_dir, "nation").agg(F.sort_array(F.collect_list(F.struct("n_nationkey", "n_regionkey"))).alias("all"))
    resource = lambda x: F.struct(F.concat(F.lit("http://n.org/"), x["n_nationkey"].cast("string")).alias("uri"), F.lit("s").alias("source"), F.lit("text/html").alias("media_type"), F.create_map(F.lit("region"), x["n_regionkey"].cast("string")).alias("metadata"))
    listed.select(F.to_json(F.struct(F.lit(1).alias("schema_version"), F.lit("p").alias("provider"), F.size("all").alias("count"), F.transform("all", resource).alias("resources")))).write.text(path)
    got = files.manifest_resources(spark, path, 20)
    return got.select(F.col("pos").cast("long").alias("pos"), "uri", "media_type", F.col("metadata")["region"].alias("region"))


@query("SELECT 'r' || r.r_regionkey AS document, n_name AS text FROM nation JOIN region r ON n_regionkey = r.r_regionkey WHERE trim(n_name) <> '' AND n_nationkey % 7 <> 3")
def a20_chunk_files(spark, sf_dir):
    """Full chunks and minimal ones in each region's folders: the minimal ones are read, less the empty one in seven."""
    path = fresh_path(spark, "chunk-files")
    rows = table(spark, sf_dir, "nation").select("n_regionkey", "n_nationkey", "n_name")
    text = F.when(F.col("n_nationkey") % 7 == 3, F.lit("  ")).otherwise(F.col("n_name"))
    document = F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("document")

    def put(frames):
        for pdf in frames:
            for region, nation, body in zip(pdf["r"], pdf["n"], pdf["j"], strict=True):
                datasets._put(f"{path}/r{region}/chunks_minimal/c{nation}.json", body.encode())
                datasets._put(f"{path}/r{region}/chunks/c{nation}.json", body.replace('"text":"', '"text":"full ').encode())
            yield pdf[["n"]]

    rows.select(F.col("n_regionkey").alias("r"), F.col("n_nationkey").alias("n"), F.to_json(F.struct(document, text.alias("text"), F.col("n_nationkey").cast("int").alias("chunk_index"))).alias("j")).mapInPandas(put, "n long").count()
    return files.chunk_files(spark, path).select("document", "text")


@query("SELECT CAST(n_nationkey AS INT) AS n, length(n_name) AS units FROM nation WHERE n_nationkey % 4 <> 1")
def a21_logs(spark, sf_dir):
    """Logs of one name below nested folders; every fourth is broken and dropped, files of other names aren't read."""
    path = fresh_path(spark, "logs")
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("n"), F.when(F.col("n_nationkey") % 4 == 1, F.lit('{"n": ')).otherwise(F.to_json(F.struct(F.col("n_nationkey").cast("int").alias("n"), F.length("n_name").alias("units")))).alias("j"))

    def put(frames):
        for pdf in frames:
            for n, body in zip(pdf["n"], pdf["j"], strict=True):
                datasets._put(f"{path}/a/d{n}/extraction_log.json", body.encode())
                datasets._put(f"{path}/a/d{n}/other.json", b'{"n": 9, "units": 9}')
            yield pdf[["n"]]

    rows.mapInPandas(put, "n long").count()
    return files.logs(spark, path, "extraction_log.json", "n int, units int").select("n", "units").where("n IS NOT NULL")


def _docx(parts: list[tuple[str, str]]) -> bytes:
    body = "".join(f'<w:p>{"<w:pPr><w:pStyle w:val=" + chr(34) + "Heading1" + chr(34) + "/></w:pPr>" if kind == "heading" else ""}<w:r><w:t>{text}</w:t></w:r></w:p>' for kind, text in parts)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="w"><w:body>{body}</w:body></w:document>')
    return out.getvalue()


def _xlsx(rows: list[list[str]]) -> bytes:
    body = "".join("<row>" + "".join(f'<c t="inlineStr"><is><t>{c}</t></is></c>' for c in row) + "</row>" for row in rows)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", '<workbook xmlns:r="r"><sheets><sheet name="one" r:id="a"/><sheet name="two" state="hidden" r:id="a"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="a" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/worksheets/s.xml", f"<worksheet><sheetData>{body}</sheetData></worksheet>")
    return out.getvalue()


def _pdf(pages: list[str]) -> bytes:
    kids = " ".join(f"{3 + 2 * i} 0 R" for i in range(len(pages)))
    parts = [f"%PDF-1.4\n2 0 obj << /Type /Pages /Kids [{kids}] >> endobj"]
    for i, text in enumerate(pages):
        parts.append(f"{3 + 2 * i} 0 obj << /Type /Page /Parent 2 0 R /Contents {4 + 2 * i} 0 R >> endobj\n{4 + 2 * i} 0 obj << >>\nstream\nBT ({text}) Tj ET\nendstream endobj")
    return "\n".join(parts).encode("latin-1")


def _by_customer(spark, sf_dir, kind: str, build, read=office.office_blocks):
    """A file for each nation of its customers' names, in order, built in the tasks."""
    rows = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").cast("string").alias("uri")).agg(F.transform(F.sort_array(F.collect_list(F.struct("c_custkey", "c_name", "c_mktsegment"))), lambda x: F.array(x["c_name"], x["c_mktsegment"])).alias("rows"))

    made = each_row(rows.select("uri", "rows"), lambda uri, rows: [(uri, kind, build(rows))], "uri string, extractor string, content binary")
    return read(made)


def _sound(rows):
    """Rows of files that were all read: an error of one is no result, so it fails the query."""
    failed = F.raise_error(F.concat(F.lit("a file can't be read: "), "uri", F.lit(": "), "error")).cast("boolean")
    return rows.where(F.when(F.col("error").isNotNull(), failed).otherwise(True))


_CUSTOMERS = "c AS (SELECT CAST(c_nationkey AS VARCHAR) AS uri, c_name, c_mktsegment, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS n FROM customer)"


@query(f"WITH {_CUSTOMERS} SELECT uri, CAST(n AS INT) AS pos, c_name AS text, 'text' AS kind, CAST(n + 1 AS INT) AS page FROM c")
def x6_pdf_pages(spark, sf_dir):
    return _sound(_by_customer(spark, sf_dir, "pdf", lambda rows: _pdf([r[0] for r in rows]))).select("uri", "pos", "text", "kind", "page")


@query(f"WITH {_CUSTOMERS} SELECT uri, CAST(2 * n + k AS INT) AS pos, CASE WHEN k = 0 THEN c_mktsegment ELSE c_name END AS text, CASE WHEN k = 0 THEN 'heading' ELSE 'text' END AS kind, c_mktsegment AS section FROM c, (SELECT unnest([0, 1]) AS k)")
def x8_docx_blocks(spark, sf_dir):
    return _sound(_by_customer(spark, sf_dir, "docx", lambda rows: _docx([p for r in rows for p in (("heading", r[1]), ("text", r[0]))]))).select("uri", "pos", "text", "kind", "section")


@query(f"WITH {_CUSTOMERS} SELECT uri, string_agg(c_name || ' | ' || c_mktsegment, chr(10) ORDER BY n) AS text, 'table' AS kind, 'one' AS section FROM c GROUP BY uri")
def x9_xlsx_blocks(spark, sf_dir):
    return _sound(_by_customer(spark, sf_dir, "xlsx", _xlsx)).select("uri", "text", "kind", "section")


@query(f"WITH {_CUSTOMERS} SELECT uri, CAST(n + 1 AS INT) AS page, repeat(c_name || ' ', CASE WHEN n % 2 = 0 THEN 40 ELSE 2 END) || '.' AS text, n % 2 = 1 AS needs_ocr FROM c WHERE n % 5 <> 4")
def x7_pdf_units(spark, sf_dir):
    """Every second page has little text, and every fifth is done already."""
    pages = lambda rows: _pdf([(r[0] + " ") * (40 if i % 2 == 0 else 2) + "." for i, r in enumerate(rows)])
    counts = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").cast("string").alias("uri")).agg(F.count(F.lit(1)).cast("int").alias("n"))
    done = counts.where("n >= 5").select("uri", F.explode(F.sequence(F.lit(5), F.col("n"), F.lit(5))).alias("page"))
    return _sound(_by_customer(spark, sf_dir, "pdf", pages, lambda files_: office.pdf_units(files_, done))).select("uri", "page", "text", "needs_ocr")


@query(
    f"""WITH {_CUSTOMERS}, l AS (SELECT uri, n, k, CASE WHEN k = 1 AND n % 3 = 0 THEN n % 900 + 1 || '. Part of ' || c_mktsegment WHEN k = 1 THEN 'TO ' || c_mktsegment || ' AND OTHERS' ELSE 'the name of the customer on this page is ' || c_name END AS text, k = 1 AS head FROM c, (SELECT unnest([1, 2]) AS k))
SELECT uri, CAST(2 * n + k - 1 AS INT) AS idx, text, CASE WHEN head THEN 'section_header' ELSE 'data' END AS element_type, last_value(CASE WHEN head THEN text END IGNORE NULLS) OVER (PARTITION BY uri ORDER BY n, k) AS section, CAST(n + 1 AS INT) AS page FROM l"""
)
def x14_pdf_elements(spark, sf_dir):
    head = lambda i, r: f"{i % 900 + 1}. Part of {r[1]}" if i % 3 == 0 else f"TO {r[1]} AND OTHERS"
    pages = lambda rows: _pdf([f"{head(i, r)}) Tj T* (the name of the customer on this page is {r[0]}" for i, r in enumerate(rows)])
    return _sound(_by_customer(spark, sf_dir, "pdf", pages, office.pdf_elements)).drop("error")


@query(f"WITH {_CUSTOMERS} SELECT uri, CAST(n // 7 AS INT) AS part, count(*) AS pages, min(c_name) AS first_page FROM c GROUP BY uri, n // 7")
def s12_pdf_parts(spark, sf_dir):
    from lakeweave.sources import pdf

    def split(uri, content):
        for i, part in enumerate(pdf.parts_of(content, 7)[1]):
            texts = pdf.page_texts(part)
            yield uri, i, len(texts), min(texts)

    read = lambda made: each_row(made.select("uri", "content"), split, "uri string, part int, pages long, first_page string")
    return _by_customer(spark, sf_dir, "pdf", lambda rows: _pdf([r[0] for r in rows]), read)


@query("SELECT item_id, CAST(round(1e3 * list_sum(list_transform(range(0, 32), lambda i: (i + 1) * ((16 * (instr('0123456789abcdef', substr(sha256(text), CAST(i * 2 + 1 AS INT), 1)) - 1) + instr('0123456789abcdef', substr(sha256(text), CAST(i * 2 + 2 AS INT), 1)) - 1) / 256.0)))) AS BIGINT) AS digest FROM benchmark")
def j21_embeddings(spark, sf_dir):
    """An encoder that stands in for a model: the bytes of a text's SHA-256, exact in single precision."""
    import hashlib

    from lakeweave.operators import search

    encode = lambda texts: [[b / 256 for b in hashlib.sha256(t.encode()).digest()] for t in texts]
    got = search.embed(table(spark, sf_dir, "benchmark"), "text", encode, 32)
    weighed = F.aggregate(F.transform("embedding", lambda x, i: x.cast("double") * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    return got.select("item_id", F.round(1e3 * weighed).cast("long").alias("digest"))


@query(f"WITH {_LINES} SELECT 'enriched' AS kind, CAST(doc_id AS VARCHAR) AS document, CAST(idx AS INT) AS chunk_index, text FROM chunks UNION ALL SELECT 'minimal', CAST(doc_id AS VARCHAR), CAST(idx AS INT), text FROM chunks")
def s11_exported_chunks(spark, sf_dir):
    path = fresh_path(spark, "export")
    datasets.export_chunks(line_chunks(spark, sf_dir).withColumn("page", F.lit(None).cast("int")).withColumn("section", F.lit("")), path)
    whole = spark.read.schema("doc_id long, chunk_index int, text string").json(f"{path}/chunks_enriched").select(F.lit("enriched").alias("kind"), F.col("doc_id").cast("string").alias("document"), "chunk_index", "text")
    return whole.unionByName(spark.read.schema("document string, chunk_index int, text string").json(f"{path}/chunks_minimal").select(F.lit("minimal").alias("kind"), "document", "chunk_index", "text"))


@query(
    f"""WITH {_CUSTOMERS}, u AS (SELECT DISTINCT uri FROM c), k AS (SELECT uri, CASE WHEN CAST(uri AS INT) % 5 = 0 THEN 'known' ELSE 'upload' END AS status FROM u),
n AS (SELECT uri, count(*) AS pages FROM c GROUP BY uri)
SELECT uri, status, CAST(i AS INT) AS part, least(20, pages - 20 * i) AS pages FROM k JOIN n USING (uri), LATERAL (SELECT unnest(range(0, CASE WHEN status = 'upload' THEN (pages + 19) // 20 ELSE 1 END)) AS i) WHERE status = 'upload'
UNION ALL SELECT uri, status, 0, NULL FROM k WHERE status = 'known' UNION ALL SELECT uri || 'b', CASE WHEN status = 'known' THEN 'known' ELSE 'duplicate' END, 0, NULL FROM k"""
)
def q6_upload_plan(spark, sf_dir):
    """Each nation's file twice, of which every fifth has been uploaded before, in parts of 20 pages."""
    from lakeweave.sources import pdf

    def read(made):
        one = made.select("uri", F.concat("uri", F.lit(".pdf")).alias("filename"), F.lit("application/pdf").alias("media_type"), "content")
        both = one.unionByName(one.withColumn("uri", F.concat("uri", F.lit("b"))))
        known = one.where("CAST(uri AS INT) % 5 = 0").select(F.sha2("content", 256).alias("sha256"))

        count = lambda uri, status, part, content: [(uri, status, part, None if content is None else len(pdf.page_texts(content)))]
        return each_row(datasets.upload_plan(both, known, 20).select("uri", "status", "part", "content"), count, "uri string, status string, part int, pages long")

    return _by_customer(spark, sf_dir, "pdf", lambda rows: _pdf([r[0] for r in rows]), read)


_SHEET = """s AS (SELECT p_partkey AS row, p_name, p_brand, p_size, p_partkey % 10 = 0 AS head FROM part),
t AS (SELECT *, last_value(CASE WHEN head THEN 'Раздел ' || row END IGNORE NULLS) OVER (ORDER BY row) AS section FROM s)
SELECT row, CASE WHEN head THEN 'Раздел ' || row WHEN row % 3 = 0 THEN p_name || ' (' || p_brand || ') [шт]' ELSE p_name || ' (' || p_brand || ') - ' || p_size || ' шт' END AS text,
  CASE WHEN head THEN 'section_header' ELSE 'data' END AS row_type, coalesce(section, '') AS section FROM t"""


def _sheet_rows(spark, sf_dir):
    k = F.col("p_partkey")
    body = F.array("p_name", "p_brand", F.lit("шт"), F.when(k % 3 == 0, F.lit("")).otherwise(F.col("p_size").cast("string")))
    cells = F.when(k % 10 == 0, F.array(F.concat(F.lit("Раздел "), k.cast("string")), F.lit(""), F.lit(""), F.lit(""))).otherwise(body)
    head = spark.createDataFrame([(-1, ["Наименование", "Код", "Ед.", "Количество"])], "row long, cells array<string>")
    return table(spark, sf_dir, "part").select(k.alias("row"), cells.alias("cells")).unionByName(head)


@query(f"WITH {_SHEET}")
def x11_sheet_elements(spark, sf_dir):
    return tabular.sheet_elements(_sheet_rows(spark, sf_dir).withColumn("sheet", F.lit("s"))).select("row", "text", "row_type", "section")


@query("SELECT s_name || ' (' || s_suppkey || ')' AS text, 'data' AS element_type FROM supplier")
def x12_csv_elements(spark, sf_dir):
    """A CSV file of two columns in an encoding that isn't UTF-8."""
    path = fresh_path(spark, "csv")
    lines = table(spark, sf_dir, "supplier").agg(F.sort_array(F.collect_list(F.concat(F.format_string("%09d", "s_suppkey"), "s_name", F.lit(","), F.col("s_suppkey").cast("string")))).alias("lines"))

    def put(frames):
        for pdf in frames:
            for rows in pdf["lines"]:
                datasets._put(f"{path}/s.csv", "\r\n".join(["Наименование,Шифр", *(r[9:] for r in rows)]).encode("cp1251"))
            yield pd.DataFrame({"n": [len(pdf)]})

    lines.mapInPandas(put, "n long").count()
    return tabular.csv_elements(spark, path).select("text", "element_type")


# --- Chunks and datasets -----------------------------------------------------------------------------------


@query(
    rf"""WITH {_LINES},
h AS (SELECT doc_id, idx, text, regexp_extract(text, '^\s*(\d+(?:\.\d+){{0,4}})\s+(.+)$', 1) AS num, {_STRIP.format("regexp_extract(text, '^\\s*(\\d+(?:\\.\\d+){0,4})\\s+(.+)$', 2)")} AS title FROM chunks),
k AS (SELECT *, CASE WHEN length(text) > 140 THEN NULL WHEN num <> '' AND title <> '' THEN least(5, length(num) - length(replace(num, '.', '')) + 1)
  WHEN regexp_matches(text, '^\s*((Раздел|Section|Глава)\s+\d+|\d+(\.\d+)*\s+[A-Za-zА-Яа-я])') OR (regexp_matches(text, '\p{{Lu}}|\p{{Lt}}') AND NOT regexp_matches(text, '\p{{Ll}}|\p{{Lt}}') AND length(text) <= 80) THEN 1 END AS level,
  CASE WHEN num <> '' AND title <> '' THEN num || ' ' || title ELSE text END AS heading FROM h),
l AS (SELECT doc_id, idx, text, """
    + ", ".join(f"last_value(CASE WHEN level = {n} THEN {{{{'i': idx, 'h': heading, 'l': {n}}}}} END IGNORE NULLS) OVER w AS l{n}".replace("{{{{", "{").replace("}}}}", "}").replace("{{", "{").replace("}}", "}") for n in range(1, 6))
    + """ FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY idx)),
p AS (SELECT doc_id, idx, text, list_filter([l1, l2, l3, l4, l5], lambda x: x IS NOT NULL AND len(list_filter([l1, l2, l3, l4, l5], lambda y: y IS NOT NULL AND y.l < x.l AND y.i > x.i)) = 0) AS path FROM l)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY idx) - 1 AS INT) AS pos, text, array_to_string(list_transform(path, lambda x: x.h), ' / ') AS section_path, CAST(coalesce(path[-1].l, 0) AS INT) AS section_level FROM p"""
)
def k1_blocks_with_paths(spark, sf_dir):
    units = table(spark, sf_dir, "documents").select("doc_id", F.lit(0).alias("idx"), F.lit(1).alias("page"), F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))
    return K.blocks_from_units(units).select("doc_id", "pos", "text", F.array_join("section_path", " / ").alias("section_path"), "section_level")


@query("SELECT conv_id AS doc_index, turn AS chunk_index, role, text FROM conversations")
def s2_dataset_layout(spark, sf_dir):
    """Conversations as documents of a dataset, written in its layout, and their chunks read back from it."""
    path = fresh_path(spark, "dataset")
    turns = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").cast("int").alias("doc_index")).agg(F.sort_array(F.collect_list(F.struct(F.col("turn").alias("index"), "role", "text"))).alias("chunks"))
    ready = turns.select("doc_index", F.to_json(F.struct(F.lit(1).alias("schema_version"))).alias("document"), F.to_json(F.struct("doc_index", F.size("chunks").alias("count"), "chunks")).alias("chunks"), F.lit("{}").alias("quality"))
    datasets.write_layout(ready, path).count()
    back = spark.read.schema("doc_index long, count int, chunks array<struct<index:long,role:string,text:string>>").option("recursiveFileLookup", "true").option("pathGlobFilter", "chunks.json").json(path)
    return back.where(F.col("count") == F.size("chunks")).select("doc_index", F.inline("chunks")).withColumnRenamed("index", "chunk_index")


@query("SELECT count(*) * 3 AS files FROM (SELECT DISTINCT conv_id FROM conversations)")
def s3_stored_tree(spark, sf_dir):
    path, to = fresh_path(spark, "tree"), fresh_path(spark, "stored")
    ready = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("int").alias("doc_index")).distinct().select("doc_index", *(F.lit("{}").alias(n) for n in ("document", "chunks", "quality")))
    datasets.write_layout(ready, path).count()
    datasets.upload_tree(spark, path, to, overwrite=False)
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(to).agg(F.count(F.lit(1)).alias("files"))


# --- Remaining parts of operators ---------------------------------------------------------------------------


@query(
    """WITH b AS (SELECT count(*) AS docs, sum(length(text)) AS chars FROM documents), a AS (SELECT count(*) AS docs, sum(length(text)) AS chars FROM documents WHERE doc_id % 2 = 0)
SELECT m AS metric, CAST(x AS DOUBLE) AS before, CAST(y AS DOUBLE) AS after, CAST(y AS DOUBLE) - x AS delta FROM (SELECT 'docs' AS m, b.docs AS x, a.docs AS y FROM a, b UNION ALL SELECT 'chars', b.chars, a.chars FROM a, b)"""
)
def g10_metric_deltas(spark, sf_dir):
    sums = lambda df: df.agg(F.count(F.lit(1)).alias("docs"), F.sum(F.length("text")).alias("chars"))
    docs = table(spark, sf_dir, "documents")
    return Q.metric_deltas(sums(docs), sums(docs.where("doc_id % 2 = 0")))


@query(
    f"""WITH p AS (SELECT page_id, {_PATH.format("url")} AS p FROM pages)
SELECT page_id, NOT regexp_matches(p, '{U.SKIP_PREFIXES}') AND NOT (regexp_matches(p, '{U.SKIP_SEGMENTS}') OR regexp_matches(p, '{U.SKIP_MEDIA}') OR regexp_matches(p, '{U.MEDIA_EXTENSIONS}')) AS content, starts_with(p, '/en') AS under FROM p"""
)
def b23_content_paths(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.is_content("url").alias("content"), U.is_under(F.lit("http://x.org/en/"), "url").alias("under"))


@query(
    "WITH s AS (SELECT doc_id, length(text) AS n, CASE WHEN contains(lower(text), 'the') THEN 1 ELSE 0 END + CASE WHEN contains(lower(text), 'and') THEN 1 ELSE 0 END AS raw FROM documents) SELECT doc_id, CAST(trunc(raw * 1000 / CAST(greatest(n, 1) AS DOUBLE) * (least(greatest(n, 1), 2000.0) / 1000)) AS INT) - CASE WHEN doc_id % 3 = 0 THEN 3 ELSE 0 END AS score FROM s"
)
def b21_path_penalty(spark, sf_dir):
    path = F.when(F.col("doc_id") % 3 == 0, "/x/Blog/y").otherwise("/x/goods/y")
    return table(spark, sf_dir, "documents").select("doc_id", T.density_score(F.col("text"), ("the", "and"), (), path).alias("score"))


@query(
    f"""WITH h AS (SELECT page_id, {_HREFS} AS hs FROM pages) SELECT page_id, i - 1 AS pos, hs[i] AS href FROM h, LATERAL (SELECT unnest(range(1, least(len(hs), 3) + 1)) AS i)"""
)
def a7_first_anchors(spark, sf_dir):
    """Three links a page: the limit is a feature."""
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(U.anchors("html", 3)).alias("pos", "href"))


@query(f"WITH {_LINES} SELECT lower(t) AS term, count(DISTINCT doc_id * 100000 + idx) AS chunks FROM (SELECT doc_id, idx, unnest(regexp_extract_all(text, '[A-Za-zА-Яа-яЁё0-9]{{3,}}')) AS t FROM chunks) WHERE lower(t) NOT IN ('the', 'and', 'for', 'with', 'from') GROUP BY 1")
def a20_inverted_index(spark, sf_dir):
    chunks = line_chunks(spark, sf_dir).select((F.col("doc_id") * 100000 + F.col("chunk_index")).alias("chunk_id"), "text")
    return files.posting_lists(chunks).groupBy("term").agg(F.count(F.lit(1)).alias("chunks"))


@query(f"SELECT doc_id, {_NORM.format('text')} AS text FROM documents WHERE length(text) > 0")
def s16_demo_text(spark, sf_dir):
    """The demo's first step over every document, wrapped as a page of one block."""
    from lakeweave.sources import markup

    escaped = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    pages = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("<nav>menu</nav><main><pre>"), escaped, F.lit("</pre></main>")).alias("html"))
    return markup.html_blocks(pages, "doc_id", "html").select("doc_id", "text")
