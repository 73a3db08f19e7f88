"""Fetching from a server of our own, PDFs, datasets as folders, stored trees, crawls for files and catalogues."""

import gzip
import json
import os
import threading
import zlib
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from lakeweave.sources import datasets, discovery, fetch, office, pdf
from lakeweave.sources import files as sources


class Site(BaseHTTPRequestHandler):
    def do_GET(self):
        jump = {"/r1": "/r2", "/r2": "/ok.html", "/loop": "/loop", "/ftp": "ftp://x/y", "/user": "http://u:p@127.0.0.1/", "/none": "", "/out": "/blocked"}
        if self.path in jump:
            self.send_response(302)
            if jump[self.path]:
                self.send_header("Location", jump[self.path])
            self.send_header("Content-Length", "0")
            self.end_headers()
            return
        body = {"/ok.html": b"<p>hello</p>", "/plain.md": b"# hi", "/big": b"x" * 5000, "/undeclared": b"y" * 5000}.get(self.path)
        self.send_response(404 if body is None else 200)
        if self.path == "/ok.html":
            self.send_header("Content-Type", "text/HTML; charset=utf-8")
        if self.path != "/undeclared":
            self.send_header("Content-Length", str(len(body or b"")))
        self.end_headers()
        self.wfile.write(body or b"")

    def log_message(self, *args):
        pass


@pytest.fixture(scope="module")
def site():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_fetch(spark, site):
    paths = ["/ok.html", "/r1", "/plain.md", "/loop", "/ftp", "/user", "/none", "/big", "/undeclared", "/nothing", "/out"]
    rows = [(site + p, "s", "") for p in paths] + [("ftp://x/y", "s", ""), ("http://u:p@h/", "s", ""), ("http://127.0.0.1:1/x", "s", ""), (None, "s", "")]
    frame = spark.createDataFrame(rows, "uri string, source string, media_type string")
    got = {(r.uri or "").removeprefix(site): r for r in fetch.fetched(frame, max_bytes=4000, timeout=5.0, allow=lambda u: "blocked" not in u).collect()}
    assert len(got) == len(rows)
    assert got["/ok.html"].content == b"<p>hello</p>" and got["/ok.html"].media_type == "text/html" and got["/ok.html"].status == 200
    assert got["/r1"].final_uri == site + "/ok.html" and got["/r1"].filename == "ok.html" and got["/plain.md"].media_type == "text/markdown"
    errors = {k: r.error for k, r in got.items() if r.error}
    assert errors == {
        "/loop": "too many redirects", "/ftp": "redirect target is not http(s)", "/user": "redirect target has credentials", "/none": "redirect without a location", "/big": "too large", "/undeclared": "too large",
        "/nothing": "status 404", "/out": "redirect blocked", "ftp://x/y": "resource is not http(s)", "http://u:p@h/": "resource has credentials", "http://127.0.0.1:1/x": "ConnectionRefusedError", "": "resource is not http(s)",
    }


def a_pdf(*pages: str, packed: bool = False) -> bytes:
    parts = [b"%PDF-1.4", b"1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj"]
    kids = " ".join(f"{3 + 2 * i} 0 R" for i in range(len(pages)))
    parts.append(f"2 0 obj << /Type /Pages /Kids [{kids}] /Count {len(pages)} >> endobj".encode())
    for i, text in enumerate(pages):
        shown = text.replace("\\", "\\\\").replace("(", "\\(").replace(")", "\\)")
        stream = f"BT /F1 12 Tf 72 720 Td ({shown}) Tj ET".encode("latin-1") if text else b"q 0 0 m Q"
        stream = zlib.compress(stream) if packed else stream
        how = b"/Filter /FlateDecode " if packed else b""
        parts.append(f"{3 + 2 * i} 0 obj << /Type /Page /Parent 2 0 R /Contents {4 + 2 * i} 0 R >> endobj".encode())
        parts.append(f"{4 + 2 * i} 0 obj << ".encode() + how + f"/Length {len(stream)} >>\nstream\n".encode() + stream + b"\nendstream endobj")
    return b"\n".join([*parts, b"trailer << /Root 1 0 R >>", b"%%EOF"])


def test_pdf_pages():
    for packed in (False, True):
        assert pdf.paragraphs(a_pdf("First (page) \\ here", "", "Third é", packed=packed)) == [("First (page) \\ here", 1), ("Third é", 3)]
    for bad, why in ((a_pdf("", ""), "ocr_required"), (b"no pdf", "not a PDF"), (a_pdf("a", "b", "c"), "too many pages")):
        with pytest.raises(pdf.BadPdf, match=why):
            pdf.paragraphs(bad, max_pages=2)
    kinds = b"%PDF-1.4\n1 0 obj << /Type /Pages /Kids [2 0 R] >> endobj\n2 0 obj << /Type /Page /Parent 1 0 R /Contents [3 0 R] >> endobj\n3 0 obj << >>\nstream\nBT (one) Tj T* [(tw) -50 (o) -300 (three)] TJ 0 -20 Td <666f7572> Tj (fi\\166e) ' ET\nendstream endobj"
    assert pdf.page_texts(kinds) == ["one\ntwo three\nfour\nfive"]


def test_office_rows_carry_pages(spark):
    rows = spark.createDataFrame([("a", "pdf", a_pdf("one", "two")), ("b", "pdf", a_pdf("")), ("c", "docx", b"broken")], "uri string, extractor string, content binary")
    got = {(r.uri, r.pos): r for r in office.office_blocks(rows).collect()}
    assert got["a", 0].page == 1 and got["a", 1].page == 2 and got["b", 0].error == "ocr_required" and got["c", 0].error


def test_manifest_to_dataset(spark, tmp_path):
    (tmp_path / "a.md").write_text("# Title\n\n" + "Some words about a cable that is long enough to be kept by the gate. " * 8)
    (tmp_path / "b.html").write_text("<html><body><nav>menu</nav><h1>Head</h1><p>" + "A paragraph of the page, with more than a few words in it. " * 8 + "</p></body></html>")
    (tmp_path / "c.pdf").write_bytes(a_pdf("A page of a document with enough words in it to be more than a tiny chunk of text, says its author."))
    (tmp_path / "d.bin").write_bytes(b"\0\1")
    (tmp_path / "e.pdf").write_bytes(a_pdf(""))
    names = ["a.md", "b.html", "c.pdf", "d.bin", "e.pdf", "missing.txt", "a.md"]
    resources = [{"uri": str(tmp_path / n), "source": "test", "media_type": "", "metadata": {}} for n in names]
    (tmp_path / "manifest.json").write_text(json.dumps({"schema_version": 1, "provider": "p", "count": len(names), "resources": resources}))
    out = str(tmp_path / "out")
    report = datasets.process_manifest(spark, str(tmp_path / "manifest.json"), out)
    assert [o["status"] for o in report["outcomes"]] == ["processed", "processed", "processed", "skipped", "failed", "failed", "processed"]
    assert report["overall"] == "partial" and report["processed_count"] == 4 and report["outcomes"][4]["error"] == "ocr_required"
    document = json.load(open(f"{out}/documents/00001/document.json"))
    assert [b["text"][:4] for b in document["blocks"]] == ["Head", "A pa"] and document["extractor"] == "html-xml"
    assert json.load(open(f"{out}/documents/00002/document.json"))["blocks"][0]["page"] == 1
    chunks = json.load(open(f"{out}/documents/00000/chunks.json"))
    assert chunks["count"] == len(chunks["chunks"]) > 0 and json.load(open(f"{out}/documents/00000/quality.json"))["passed"] is True
    with pytest.raises(FileExistsError):
        datasets.process_manifest(spark, str(tmp_path / "manifest.json"), out)
    assert datasets.validate_dataset(spark, out).count() == 7
    n, size = datasets.store_dataset(spark, out, str(tmp_path / "store"), "/sets/one/")
    assert n == 13 and size > 0 and os.path.isfile(tmp_path / "store/sets/one/documents/00006/quality.json")
    with pytest.raises(FileExistsError):
        datasets.store_dataset(spark, out, str(tmp_path / "store"), "sets/one")
    with pytest.raises(ValueError, match="safe"):
        datasets.store_dataset(spark, out, str(tmp_path / "store"), "../one")

    def broken(change, why):
        raw = json.load(open(f"{out}/processing-report.json"))
        change(raw)
        bad = tmp_path / f"bad{abs(hash(why))}"
        datasets.upload_tree(spark, out, str(bad))
        (bad / "processing-report.json").write_text(json.dumps(raw))
        with pytest.raises(datasets.InvalidDataset, match=why):
            datasets.validate_dataset(spark, str(bad))

    broken(lambda r: r.update(schema_version=2), "version")
    broken(lambda r: r.update(processed_count=3), "processed_count")
    broken(lambda r: r["outcomes"][1].update(index=0), "bad index")
    broken(lambda r: r["outcomes"][1].update(directory="../x"), "unsafe")
    broken(lambda r: r["outcomes"][1].update(directory="documents/99999"), "missing")
    os.remove(f"{out}/processing-report.json")
    with pytest.raises(datasets.InvalidDataset, match="no processing-report"):
        datasets.validate_dataset(spark, out)


def test_stored_trees(spark, tmp_path):
    tree = tmp_path / "tree"
    (tree / "a/.hidden").mkdir(parents=True)
    for name in ("one.txt", "a/two.txt", "a/.hidden/three.txt", ".four"):
        (tree / name).write_text(name)
    assert datasets.upload_tree(spark, str(tree), str(tmp_path / "copy")) == (2, len("one.txt") + len("a/two.txt"))
    assert (tmp_path / "copy/a/two.txt").read_text() == "a/two.txt" and not (tmp_path / "copy/.four").exists()
    with pytest.raises(FileExistsError):
        datasets.upload_tree(spark, str(tree), str(tmp_path / "copy"), overwrite=False)
    with pytest.raises(ValueError, match="overlap"):
        datasets.upload_tree(spark, str(tree), str(tree / "a/copy"))
    with pytest.raises(FileNotFoundError):
        datasets.upload_tree(spark, str(tree / "one.txt"), str(tmp_path / "copy2"))
    os.symlink(tree / "one.txt", tree / "link")
    with pytest.raises(ValueError, match="link"):
        datasets.upload_tree(spark, str(tree), str(tmp_path / "copy3"))
    path = datasets.write_run_manifest(str(tmp_path / "runs"), {"n": 1})
    assert json.load(open(path)) == {"n": 1} and os.path.basename(path).startswith("run-")
    rows = datasets.demo(spark, "<main><h1>Schneider catalog</h1><p>Contactor of the series, 2019.</p></main>").collect()
    assert rows and rows[0].vendor == "Schneider" and rows[0].document == "demo"


def test_file_links(spark):
    pages = [
        ("http://s.org/a/", '<a href="x.pdf">A <b>manual</b></a><a href="/y.docx?v=2">notes</a><a href="z">page</a> or http://t.org/raw.XLSX here'),
        ("http://s.org/b", '<a class=c href="http://s.org/a/x.pdf"> cable guide </a><a href="/bad.zip">zip</a>'),
    ]
    web = spark.createDataFrame(pages, "url string, body string")
    got = [(r.file, r.anchor_text, r.pages) for r in discovery.file_links(web).collect()]
    assert got == [("http://s.org/a/x.pdf", "A manual cable guide", 2), ("http://s.org/y.docx?v=2", "notes", 1), ("http://t.org/raw.XLSX", "", 1)]
    scored = {r.file: r.score for r in discovery.file_links(web, ("cable", "guide"), ("notes",)).collect()}
    assert scored == {"http://s.org/a/x.pdf": 2, "http://t.org/raw.XLSX": 0}


def test_catalogue_goes_on_where_it_was_cut_off(spark, tmp_path):
    link = lambda *us: "".join(f'<a href="{u}">x</a>' for u in us)
    pages = [
        ("http://s.org/c/", link("/c/one/", "/c/leaf_a_1_2_b.html", "/other/", "http://t.org/c/")), ("http://s.org/c/one/", link("/c/two/", "/c/")),
        ("http://s.org/c/two/", link("/c/three/")), ("http://s.org/c/leaf_a_1_2_b.html", link("/c/never/")), ("http://s.org/c/three/", ""),
    ]
    web, state = spark.createDataFrame(pages, "url string, body string"), str(tmp_path / "state")
    first = {r.url for r in discovery.catalogue(web, "http://s.org/c/", state, levels=2).collect()}
    assert first == {f"http://s.org/c/{p}" for p in ("", "one/", "leaf_a_1_2_b.html", "two/")}
    rest = {r.url for r in discovery.catalogue(web.where("url NOT LIKE '%/c/'"), "http://s.org/c/", state, levels=9).collect()}
    assert rest == first | {"http://s.org/c/three/"}


def test_unpacked_sitemaps(spark):
    body = b"<urlset><url><loc>http://s.org/a</loc></url></urlset>"
    rows = [("plain", body), ("zipped", gzip.compress(body)), ("cut", gzip.compress(body)[:-9]), ("large", gzip.compress(b"x" * 5000)), ("null", None)]
    got = {r.url: r.body for r in discovery.unpacked(spark.createDataFrame(rows, "url string, content binary"), max_bytes=1000).collect()}
    assert got == {"plain": body.decode(), "zipped": body.decode()}
    web = spark.createDataFrame([("http://s.org/robots.txt", "Sitemap: http://s.org/m.xml")], "url string, body string")
    assert discovery.sitemap_starts(web, "http://s.org/") == ["http://s.org/m.xml"] and discovery.sitemap_starts(web, "http://t.org") == ["http://t.org/sitemap.xml"]


def test_chunk_files_at_any_depth(spark, tmp_path):
    folder = tmp_path / "x/y/doc/chunks"
    folder.mkdir(parents=True)
    (folder / "c1.json").write_text(json.dumps({"document": "d", "chunk_index": 0, "text": "words", "token_count": 1}))
    assert sources.chunk_files(spark, str(tmp_path)).count() == 1
    assert sources.chunk_files(spark, str(tmp_path)).select(F.max("text")).first()[0] == "words"


def test_pdf_parts_and_elements():
    parts = pdf.split_pages(a_pdf(*(f"page {i}" for i in range(7)), packed=True), 3)
    assert [pdf.page_texts(p) for p in parts] == [["page 0", "page 1", "page 2"], ["page 3", "page 4", "page 5"], ["page 6"]]
    assert pdf.split_pages(a_pdf("one"), 3) == [a_pdf("one")]
    assert pdf.is_text_based(["x" * 60, "", "x" * 60]) and not pdf.is_text_based(["x" * 60, ""]) and not pdf.is_text_based([])
    got = pdf.line_elements(["1. Scope\n1.2 some words\nab", "GENERAL PROVISIONS\nmore words"])
    assert got == [("1. Scope", "section_header", "1. Scope", 1), ("1.2 some words", "data", "1. Scope", 1), ("GENERAL PROVISIONS", "section_header", "GENERAL PROVISIONS", 2), ("more words", "data", "GENERAL PROVISIONS", 2)]


def test_pdf_units_ask_for_recognition(spark):
    files_ = spark.createDataFrame([("a", a_pdf("word " * 100, "", "few")), ("b", b"x")], "uri string, content binary")

    def recognise(content, page):
        if page == 3:
            raise OSError("blurred")
        return "seen"

    plain = {(r.uri, r.page): (r.needs_ocr, r.error) for r in office.pdf_units(files_).collect()}
    assert plain == {("a", 1): (False, None), ("a", 2): (True, None), ("a", 3): (True, None), ("b", 0): (None, "not a PDF")}
    done = spark.createDataFrame([("a", 1)], "uri string, page int")
    asked = {(r.uri, r.page): (r.text, r.error) for r in office.pdf_units(files_, done, recognise).collect()}
    assert asked == {("a", 2): ("seen", None), ("a", 3): ("few", "OSError"), ("b", 0): (None, "not a PDF")}


def test_embedding_in_batches(spark):
    from lakeweave.operators import search

    rows = spark.createDataFrame([(i, None if i == 3 else " " if i == 4 else f"t{i}") for i in range(150)], "k int, text string").coalesce(1)
    calls = []

    def encode(texts):
        calls.append(1)
        if len(calls) == 1:
            raise TimeoutError
        assert len(texts) <= 64
        return [[float(t[1:]), 1.0] for t in texts]

    got = {r.k: r.embedding for r in search.embed(rows, "text", encode, 2, wait=0.01).collect()}
    assert got[3] is None and got[4] is None and got[149] == [149.0, 1.0] and len(got) == 150
    with pytest.raises(Exception, match="other vectors"):
        search.embed(rows, "text", lambda texts: [[1.0]] * len(texts), 2).collect()


def test_background_tasks_and_templates(spark):
    from lakeweave.streaming import queue

    tasks = queue.Tasks(spark)

    def work(report, n):
        report(1, 2)
        return spark.range(n).count()

    tasks.submit("good", work, 10)
    tasks.submit("bad", lambda report: 1 // 0)
    assert tasks.wait("good", 60) == {"state": "completed", "done": 1, "total": 2, "result": 10, "error": None}
    assert tasks.wait("bad", 60)["state"] == "failed" and "zero" in tasks.state("bad")["error"]
    with pytest.raises(ValueError, match="already"):
        tasks.submit("good", work, 1)
    assert datasets.render_template("# {{name}}: {{ n }} of {{share}}", {"name": "run", "n": 12345, "share": 0.123456}) == "# run: 12,345 of 0.1235"
    with pytest.raises(KeyError, match="n"):
        datasets.render_template("{{n}}", {})


def test_uploads_tell_what_failed(spark):
    rows = [("a", "a.md", "text/markdown", b"one"), ("b", "b.md", "text/markdown", b"one"), ("c", "c.md", "text/markdown", b"bad"), ("d", "d.pdf", "application/pdf", a_pdf("x", "y", "z")), ("e", "e.md", "text/markdown", b"old")]
    frame = spark.createDataFrame(rows, "uri string, filename string, media_type string, content binary")
    known = frame.where("uri = 'e'").select(F.sha2("content", 256).alias("sha256"))

    def send(name, part, content):
        if content == b"bad":
            raise OSError("refused")
        return f"{name}#{part}"

    got = {(r.uri, r.part): (r.status, r.answer, r.error) for r in datasets.upload_all(datasets.upload_plan(frame, known, 2), send).collect()}
    assert got == {
        ("a", 0): ("uploaded", "a.md#0", None), ("b", 0): ("duplicate", None, None), ("c", 0): ("failed", None, "refused"),
        ("d", 0): ("uploaded", "d.pdf#0", None), ("d", 1): ("uploaded", "d.pdf#1", None), ("e", 0): ("known", None, None),
    }
