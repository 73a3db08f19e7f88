"""Gates, search, state, sources and streams on small tables."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from lakeweave.operators import quality as Q
from lakeweave.operators import search as J
from lakeweave.operators import state as S
from lakeweave.sources import discovery as D
from lakeweave.sources import files, markup, office, rendered, tabular
from lakeweave.streaming import queue


def test_gates(spark):
    good = "a sound sentence about cables and their insulation, number {0}, long enough to count for more than twenty tokens in all"
    rows = [("ok", i, good.format(i)) for i in range(5)] + [("bad", 0, ""), ("bad", 1, "x"), ("bad", 2, good), ("bad", 3, good)]
    chunks = spark.createDataFrame(rows, "doc_id string, chunk_index int, text string")
    gate = {r.doc_id: r for r in Q.quality_gate(chunks).collect()}
    assert gate["ok"].passed and gate["ok"].findings == [] and gate["ok"].chunk_count == 5
    assert gate["bad"].findings == ["empty_ratio"] and gate["bad"].duplicate_count == 1 and gate["bad"].tiny_count == 1
    # Ratios are compared unrounded: 1/4 is not over 0.25.
    assert "duplicate_ratio" in {r.doc_id: r for r in Q.quality_gate(chunks, max_duplicate=0.2499).collect()}["bad"].findings
    legacy = {r.doc_id: r.status for r in Q.legacy_gate(chunks).collect()}
    assert legacy["bad"] == "warn"
    totals = Q.gate_dataset(Q.legacy_gate(chunks), spark.createDataFrame([("ok",)], "doc_id string")).first()
    assert (totals.processed_count, totals.skipped_count) == (1, 1)


def test_summaries(spark):
    outcomes = spark.createDataFrame([("processed", True), ("processed", False), ("skipped", None), ("failed", None)], "status string, quality_passed boolean")
    assert tuple(Q.manifest_summary(outcomes).first()) == (2, 1, 1, 1, "partial")
    reports = spark.createDataFrame([(1, 2, 3, [("b", "error"), ("a", "warning"), ("b", "error")])], "doc_id int, blocks int, chunks int, findings array<struct<code:string,severity:string>>")
    row = Q.dataset_inventory(reports).first()
    assert row.codes == ["a", "b"] and row.severities == {"error": 2, "warning": 1}
    metrics = spark.createDataFrame([(2, 100), (8, 200)], "chunk_count long, avg_tokens long")
    assert tuple(Q.rechunk_metrics(metrics).first()) == (2, 10, 180, 1)
    deltas = {r.metric: r.delta for r in Q.metric_deltas(Q.rechunk_metrics(metrics), Q.rechunk_metrics(metrics.limit(1))).collect()}
    assert deltas["docs"] == -1
    logs = spark.createDataFrame([(3, None, 10), (None, 4, 0)], "pages long, total_pages long, avg long")
    assert tuple(Q.sum_logs(logs, {"pages": ["pages", "total_pages"]}, averages=("avg",)).first()) == (7, 10)


def test_search(spark):
    v = spark.createDataFrame([(i, 1 + i % 2, [float(i), 1.0]) for i in range(6)], "chunk_id int, document_id int, embedding array<float>")
    docs = spark.createDataFrame([(1,), (2,)], "document_id int")
    assert [r.chunk_id for r in J.vector_search(v, docs, [0.0, 1.0], 0.3, 3).collect()] == [0, 1, 2]
    near = J.neighbour_similarity(v.select(F.lit(1).alias("document_id"), F.col("chunk_id").alias("idx"), "embedding")).orderBy("idx").collect()
    assert all(0 < r.avg_similarity <= 1 for r in near) and near[0].embedding_norm == 1.0
    e = spark.createDataFrame([("x",)], "t string").select(J.fake_embedding(F.col("t"), 64)).first()[0]
    assert len(e) == 64 and e[:32] == e[32:] and all(-1 <= x <= 1 for x in e)
    questions = spark.createDataFrame([("q1", "which cable section", ["copper"]), ("q2", "zzz", ["alum"]), ("q3", "nothing here matches", [])], "id string, question string, expected array<string>")
    chunks = spark.createDataFrame([(1, "copper cable"), (2, "cable tray"), (3, "aluminium wire")], "chunk_id int, text string")
    scored = J.retrieval_scores(questions, chunks)
    assert [(r.id, r.rank, r.chunk_id, r.score) for r in scored.orderBy("id", "rank").collect()] == [("q1", 1, 1, 5), ("q1", 2, 2, 1), ("q2", 1, 3, 3)]
    assert tuple(J.hit_rate(questions, scored).first())[:2] == (3, 2)


def test_state(spark):
    chunks = spark.createDataFrame([("d", i, t) for i, t in enumerate(["a", "b|c|d", "e"])], "doc_id string, chunk_index int, text string")
    assert S.next_index(chunks).first().next_index == 3
    assert [(r.chunk_index, r.text) for r in S.split_chunk(chunks, F.col("chunk_index") == 1, r"\|").orderBy("chunk_index").collect()] == [(0, "a"), (1, "b"), (2, "c"), (3, "d"), (4, "e")]
    assert [r.text for r in S.merge_chunks(chunks, F.col("chunk_index") < 2, " ").orderBy("chunk_index").collect()] == ["a b|c|d", "e"]
    edits = spark.createDataFrame([("d", 0, "A")], "doc_id string, chunk_index int, new_text string")
    now, history = S.edit_chunks(chunks, edits)
    assert sorted(r.text for r in now.collect()) == ["A", "b|c|d", "e"] and history.count() == 1
    kept, gone = S.delete_rows(chunks, chunks.limit(1), ["doc_id", "chunk_index"])
    assert (kept.count(), gone.count()) == (2, 1)
    old = spark.createDataFrame([("u", "approved", 1), ("v", "candidate", 1)], "url string, status string, score int")
    new = spark.createDataFrame([("u", "candidate", 9), ("v", "candidate", 9), ("w", "candidate", 3)], "url string, status string, score int")
    assert sorted(tuple(r) for r in S.upsert(old, new, "url").collect()) == [("u", "approved", 1), ("v", "candidate", 9), ("w", "candidate", 3)]
    events = spark.createDataFrame([("p", i, f) for i, f in enumerate([True, True, False, True, True, True, False, True])], "prefix string, pos int, failed boolean")
    assert [r.skipped for r in S.failure_streak(events, 3).orderBy("pos").collect()] == [False] * 6 + [True, True]
    pages = spark.createDataFrame([("a", "h1", 5, 5, "pass"), ("b", "h1", 5, 5, "pass"), ("c", "h2", 1, 5, "pass"), ("d", "h3", 5, 0, "pass"), ("e", "h4", 5, 5, "warn"), ("f", None, 0, 0, "")], "url string, html string, n_blocks int, score int, gate string")
    known = spark.createDataFrame([], "sha256 string")
    assert {r.url: r.status for r in S.ingest_status(pages, known).collect()} == {"a": "processed", "b": "duplicate", "c": "skipped_sparse", "d": "skipped_not_product", "e": "quarantined", "f": "fetch_error"}


def test_source_ranking(spark):
    candidates = spark.createDataFrame([(0, "http://a.org/1", 20), (1, "http://a.org/2", 15), (2, "http://b.org/", 13), (3, "http://c.org/", 1)], "pos int, url string, score int")
    probes = spark.createDataFrame([("http://b.org/", 30, 3, 20, True, False)], "url string, file_links int, product_links int, relevance int, pagination boolean, error boolean")
    assert [(r.rank, r.domain, r.score) for r in S.rank_sources(candidates, probes, 5).collect()] == [(1, "b.org", 56), (2, "a.org", 27)]


def test_html(spark):
    page = "<html><body><nav>menu</nav><main><h1>Title</h1><p>One &amp; two<p>three</p><table><tr><th>a</th><td>b</td></tr></table><script>x()</script></main></body></html>"
    assert markup.neutral_blocks(page)[0] == "Title" and "a | b" in markup.neutral_blocks(page) and "menu" not in " ".join(markup.neutral_blocks(page))
    shop = "<body><div class='breadcrumb'>x</div><p>Useful text</p><p>Добавить в корзину</p><p>useful TEXT</p><button>Buy</button><p>618765</p></body>"
    frame = spark.createDataFrame([(1, shop), (2, None), (3, "")], "k int, h string")
    assert [(r.k, r.text) for r in markup.html_blocks(frame, "k", "h", web=True).collect()] == [(1, "Useful text")]
    assert markup.neutral_blocks("just text\n\nmore") == ["just text", "more"]
    deep = "<div>" * 3000 + "<p>deep</p>"
    assert markup.neutral_blocks(deep) == ["deep"]


def test_rendered_pages(spark):
    from lakeweave.sources.rendered import rendered_pages

    text = "Каталог\nA long descriptive title of the product, over forty characters\nSection: 2.5\nVoltage | 660\n\n123 ₽\nПохожие товары и услуги\nshort item\nWeight: 5 kg\nКонтакты\nlost"
    frame = spark.createDataFrame([(1, text), (2, None)], "k int, t string")
    got = [r.text for r in rendered_pages(frame, "k", "t").orderBy("pos").collect()]
    assert got == ["A long descriptive title of the product, over forty characters", "Section | 2.5\nVoltage | 660", "Weight | 5 kg"]


def archive(parts):
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return raw.getvalue()


def test_office(spark):
    w = 'xmlns:w="http://w"'
    docx = archive({"word/document.xml": f'<w:document {w}><w:body><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>Head</w:t></w:r></w:p><w:p><w:r><w:t>text</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>'})
    sheet = '<worksheet><sheetData><row><c t="inlineStr"><is><t>a</t></is></c><c><f>A1+1</f><v>2</v></c></row><row><c><v>3</v></c></row></sheetData></worksheet>'
    xlsx = archive({
        "xl/workbook.xml": '<workbook xmlns:r="http://r"><sheets><sheet name="S" r:id="r1"/><sheet name="H" state="hidden" r:id="r2"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Target="worksheets/sheet2.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": sheet, "xl/worksheets/sheet2.xml": sheet,
    })
    bomb = archive({"word/document.xml": '<!DOCTYPE x [<!ENTITY a "b">]><x/>'})
    rows = [("a.docx", "docx", docx), ("b.xlsx", "xlsx", xlsx), ("c.docx", "docx", b"no archive"), ("d.docx", "docx", bomb), ("e.docx", "docx", archive({"x": "y"}))]
    got = office.office_blocks(spark.createDataFrame(rows, "uri string, extractor string, content binary")).orderBy("uri", "pos").collect()
    assert [(r.text, r.kind, r.section) for r in got[:3]] == [("Head", "heading", "Head"), ("text", "text", "Head"), ("a | b", "table", "Head")]
    assert (got[3].text, got[3].section) == ("a | =A1+1\n3", "S") and [bool(r.error) for r in got[4:]] == [True] * 3


def test_sheets(spark):
    rows = [(0, ["Смета", ""]), (1, ["№", "Наименование", "Ед. изм", "Кол-во"]), (2, ["1", "2", "3", "4"]), (3, ["Раздел 1", "", "", ""]), (4, ["1", "Кабель ВВГ", "м", "10"]), (5, ["", "Итого по разделу", "", "5"])]
    frame = spark.createDataFrame([("s", i, c) for i, c in rows], "sheet string, row int, cells array<string>")
    got = tabular.sheet_elements(frame).orderBy("row").collect()
    assert [(r.row_type, r.element_type) for r in got] == [("section_header", "section_header"), ("data", "data"), ("subtotal", "section_header")]
    assert got[1].text == "Кабель ВВГ - 10 м" and got[1].section == "Раздел 1" and got[1].attributes["quantity"] == "10"


def site(spark):
    link = lambda *hs: "".join(f"<a href='{h}'>x</a>" for h in hs)
    pages = {"": link("/a", "/b", "/private/x", "http://other.org/"), "a": link("/c", "/"), "b": link("c", "/d?q=1"), "c": link("/e"), "d?q=1": "", "e": "", "private/x": ""}
    return spark.createDataFrame([(f"http://s.org/{p}", b) for p, b in pages.items()], "url string, body string")


def test_crawl(spark):
    got, left = D.crawl(site(spark), ["http://S.org"], D.CrawlPolicy(max_depth=2, domains=("s.org",), disallowed=("/private",)))
    assert [(r.depth, r.url) for r in got.orderBy("depth", "pos").collect()] == [(0, "http://s.org/"), (1, "http://s.org/a"), (1, "http://s.org/b"), (2, "http://s.org/c"), (2, "http://s.org/d?q=1")]
    assert {r.reason: r.n for r in left.collect()} == {"robots": 1, "domain": 1}


def test_sitemaps(spark):
    web = spark.createDataFrame([
        ("http://s/i.xml", "<sitemapindex><sitemap><loc>http://s/1.xml</loc></sitemap><sitemap><loc>http://s/2.xml</loc></sitemap></sitemapindex>"),
        ("http://s/1.xml", "<urlset><url><loc>http://s/a?x=1&amp;y=2</loc></url><url><loc> http://other/b </loc></url></urlset>"),
        ("http://s/2.xml", "<!DOCTYPE x><urlset><url><loc>http://s/evil</loc></url></urlset>"),
    ], "url string, body string")
    assert [r.uri for r in D.sitemap_pages(web, ["http://s/i.xml"]).collect()] == ["http://s/a?x=1&y=2"]
    robots = spark.createDataFrame([("http://s/robots.txt", "User-agent: *\nSitemap: http://s/i.xml\n")], "url string, body string")
    assert [r.loc for r in D.robots_sitemaps(robots).collect()] == ["http://s/i.xml"]


def test_other_discovery(spark):
    text = spark.createDataFrame([("See https://x.org/a/?q=1, and example.com or google.com.",)], "text string")
    found = [r.url for r in D.mined_sources(text).collect()]
    assert "https://x.org/a" in found and "https://example.com" in found and not any("google" in u for u in found)
    terms = spark.createDataFrame([(0, "t"), (1, "u")], "pos int, term string")
    results = spark.createDataFrame([("t", 0, "/url?q=https%3A%2F%2Fd.org%2F1"), ("t", 2, "https://d.org/never"), ("u", 0, "https://e.org/")], "term string, page int, href string")
    assert [r.url for r in D.search_grid(terms, results, "d.org").collect()] == ["https://d.org/1"]
    sources = spark.createDataFrame([("http://a", "approved", "2"), ("http://b", "approved", "x"), ("ftp://c", "approved", "1"), ("http://d", "new", "1")], "url string, status string, priority string")
    assert [r.url for r in D.approved_urls(sources).collect()] == ["http://a", "http://b"]
    assert D.profile({"schema_version": 1, "queries": ["a"]})["priority_terms"] == []
    for bad in ({"schema_version": 1, "nope": 1}, {"schema_version": 2}, {"schema_version": 1, "queries": [""]}):
        with pytest.raises(ValueError):
            D.profile(bad)


def test_manifest_and_dataset(spark, tmp_path):
    good = {"schema_version": 1, "provider": "manual", "count": 1, "resources": [{"uri": "a.txt", "source": "s", "media_type": "text/plain", "metadata": {}}]}
    (tmp_path / "m.json").write_text(json.dumps(good))
    (tmp_path / "bad.json").write_text(json.dumps(good | {"count": 2}))
    assert [r.uri for r in files.manifest_resources(spark, str(tmp_path / "m.json")).collect()] == ["a.txt"]
    with pytest.raises(Exception, match="bad manifest"):
        files.manifest_resources(spark, str(tmp_path / "bad.json")).collect()
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.md").write_bytes(b"\xef\xbb\xbf# T\r\n\r\n\r\nbody \xff")
    found = files.with_extractor(files.local_files(spark, str(tmp_path / "in")))
    assert [(r.extractor, r.media_type) for r in found.collect()] == [("text", "text/markdown")]
    assert [r.text for r in files.text_blocks(found).orderBy("pos").collect()] == ["# T", "body �"]
    blocks = spark.createDataFrame([(1, 0, "T", "heading"), (1, 1, "x", "list_item"), (1, 2, "", "text")], "doc_id int, idx int, text string, kind string")
    made = files.render_documents(blocks).first()
    assert made.markdown == "# 1\n\n## T\n\n- x\n"
    files.write_dataset(blocks, blocks, blocks, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out" / "chunks")).count() == 3
    with pytest.raises(FileExistsError):
        files.write_dataset(blocks, blocks, blocks, str(tmp_path / "out"))
    plan = files.publication_plan(spark.createDataFrame([("a", "x"), ("b", "y")], "slug string, markdown string"), spark.createDataFrame([("a", "old")], "slug string, sha string"))
    assert {r.slug: r.status for r in plan.collect()} == {"a": "would_update", "b": "missing"}


def test_queue(spark, tmp_path):
    rows = [("t1", "enqueued", 0), *[("t1", "failed", i) for i in range(1, 6)], ("t2", "failed", 0), ("t2", "completed", 1), ("t2", "failed", 2), ("t3", "enqueued", 0)]
    events = spark.createDataFrame(rows, "task_id string, event string, s int").select("task_id", "event", F.timestamp_seconds("s").alias("at"))
    want = {"t1": ("failed", 4), "t2": ("completed", 1), "t3": ("pending", 0)}
    assert {r.task_id: (r.state, r.retries) for r in queue.final_states(events).collect()} == want
    folder, seen = str(tmp_path / "events"), {}
    events.where("s < 2").coalesce(1).write.parquet(folder)

    def work(batch, batch_id):
        seen.update({r.task_id: (r.state, r.retries) for r in batch.collect()})

    def drain():
        queue.drain(queue.retry_states(queue.intake(spark, folder)), work, str(tmp_path / "checkpoint"), "update")

    drain()
    events.where("s >= 2").coalesce(1).write.mode("append").parquet(folder)
    drain()  # goes on from its checkpoint
    assert seen == want
    assert {r.state: r.active for r in queue.queue_stats(queue.final_states(events)).collect()} == {"failed": 0, "completed": 0, "pending": 1}


def test_upload_parts_never_exceed_the_limit(spark):
    rows = [("a", i, n) for i, n in enumerate([5, 9, 5, 4, 1, 30, 2])] + [("b", 0, 3)]
    got = files.zip_groups(spark.createDataFrame(rows, "source string, pos int, size long"), 10).orderBy("source", "pos").collect()
    assert [r.part for r in got] == [0, 1, 2, 2, 2, 3, 4, 0]


def test_crawl_numbers_links_of_wide_levels(spark):
    """Chained pages with the default policy; include filters the result and not the traversal."""
    pages = [(f"http://s.org/p{i}", "".join(f'<a href="/p{j}">x</a>' for j in range(2 * i + 1, 2 * i + 3))) for i in range(40)]
    web = spark.createDataFrame(pages, "url string, body string")
    got, left = D.crawl(web, ["http://s.org/p0", "http://s.org/p1"], D.CrawlPolicy(max_depth=6, include=("*/p?[02468]", "*/p[02468]")))
    urls = [r.url for r in got.orderBy("depth", "pos").collect()]
    assert urls == [f"http://s.org/p{i}" for i in range(0, 40, 2)]
    assert {r.reason for r in left.collect()} == {"include", "missing"}
    cut, left = D.crawl(web, ["http://s.org/p0"], D.CrawlPolicy(max_links=1))
    assert {r.url for r in cut.collect()} == {"http://s.org/p0", "http://s.org/p1", "http://s.org/p3", "http://s.org/p7"}
    assert {r.reason: r.n for r in left.collect()} == {"links truncated": 4}


def test_whole_phrase_lists(spark):
    blocks = spark.createDataFrame([(1, i, t) for i, t in enumerate(["Кабель силовой", "Огромный выбор товаров", "на главном складе 5 шт", "Помощь в выборе", "скачать документ бесплатно"])], "k int, pos int, text string")
    assert [r.text for r in markup.drop_shop_blocks(blocks, "k").collect()] == ["Кабель силовой"]
    assert rendered.rendered_blocks("Долями по 500\nсервисы\nКлуб друзей\n" + "Описание изделия, которое длиннее сорока знаков") == ["Описание изделия, которое длиннее сорока знаков"]
