"""Text and URL functions on literal cases: exact labels, and bounds where tokens are estimated."""

import pytest
from pyspark.sql import functions as F

from lakeweave.functions import text as T
from lakeweave.functions import urls as U


def values(spark, rows, *columns, schema="t string"):
    frame = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema).coalesce(1)
    return [tuple(r) for r in frame.select(*columns).collect()]


def one(spark, rows, column, schema="t string"):
    return [r[0] for r in values(spark, rows, column, schema=schema)]


def test_normalize_and_paragraphs(spark):
    assert one(spark, ["a\r\nb", "a\n\n\n\n\nb", "a  \t b ", None, "  "], T.normalize_text("t")) == ["a\nb", "a\n\nb", "a b", "", ""]
    assert one(spark, ["a\n\nb\n \n c\n\n", ""], T.paragraphs("t")) == [["a", "b", "c"], []]
    assert one(spark, ["", "abcd" * 10], T.count_tokens("t")) == [1, 10]


def test_block_labels(spark):
    table = "Name | Qty\nbolt | 4\nnut | 5"
    cases = [table, "1.2.3 Requirement text", "a) first", "IV. part", "plain text", table.replace("Name", "1.1 Name"), ""]
    assert one(spark, cases, T.classify_block("t")) == [["table"], ["normative"], ["normative"], ["normative"], ["normal"], ["table", "normative"], ["normal"]]


def test_headings(spark):
    cases = ["1.2 Scope of work", "Раздел 3", "SECTION TITLE", "plain line", "1.1.1.1.1.1 deep", "X" * 150, "Section 4 more"]
    got = one(spark, cases, T.section_heading("t"))
    assert [tuple(g) if g else None for g in got] == [("1.2 Scope of work", 2), ("Раздел 3", 1), ("SECTION TITLE", 1), None, ("1.1.1.1.1.1 deep", 1), None, ("Section 4 more", 1)]


def test_noise(spark):
    cids = " ".join(f"(cid:{i})" for i in range(10))
    assert one(spark, [cids, "(cid:1) ok", "short (cid:1)"], T.is_cid_garbage("t")) == [True, False, False]
    soup, prose, pipes = "#$%^&*" * 60, "обычный текст о продукции " * 20, "1 | 2 | 3\n4 | 5 | 6\n" * 20
    assert one(spark, [soup, prose, pipes, cids + "x" * 300], T.is_noisy("t")) == [True, False, False, True]
    assert one(spark, [soup, prose, pipes, cids], T.is_noisy_legacy("t")) == [True, False, False, False]
    assert one(spark, ["�" * 10 + "a" * 250], T.is_noisy("t")) == [True]
    assert one(spark, ["!@#$%^&*()!@#$%^&*()x", "normal text of some length", "!!"], T.is_ocr_garbage("t")) == [True, False, False]


def test_metadata(spark):
    cases = ["Кабель по ГОСТ 31996-2012 производства IEK", "these phases", "Fire safety", "catalog of ABB", "plain words", "схема"]
    got = one(spark, cases, T.infer_metadata("t"))
    assert [(g.doc_type, g.vendor, g.standard_id, g.year, g.lang) for g in got] == [
        ("normative", "IEK", "ГОСТ 31996-2012", 2012, "mixed"), ("catalog", "Schneider", "", None, "en"), ("fire", "", "", None, "en"),
        ("catalog", "ABB", "", None, "en"), ("technical", "", "", None, "en"), ("technical", "", "", None, "ru"),
    ]
    docs = values(spark, [("x", "a/b.PDF"), ("x", "c.odt"), ("x", None)], T.infer_metadata("t", F.col("d"))["source_type"], schema="t string, d string")
    assert [d[0] for d in docs] == ["pdf", "unknown", "unknown"]


def test_rows_and_content(spark):
    assert one(spark, ["Итого по разделу", "ИНН: 7701", "Кабель ВВГ"], T.is_metadata_row("t")) == [True, True, False]
    got = one(spark, ["+7 (495) 123-45-67", 'ООО "Ромашка"', "Кабель ВВГ 3х2 10 мм²", "слова"], T.classify_content("t"))
    assert [g.label for g in got][0] == "noise" and [g.label for g in got][2] == "valuable" and got[3].label == "ambiguous" and got[3].reason == "unknown"
    grades = one(spark, [{"name": "Кабель 3х2", "code": "11-01-001-01"}, {"col_1": "x"}, {}, {"a": None}, {"a": " "}], T.row_grade(F.col("t")), schema="t map<string,string>")
    assert grades[0] > 0.8 and abs(grades[1] - 0.35) < 1e-9 and grades[2:] == [0.0, 0.0, 0.0]
    kept = values(spark, [("Итого", "heading"), ("Итого по смете всего", "text"), ("Достаточно длинный текст о кабеле", "text"), ("short", "text")], T.keep_chunk(F.col("t"), F.col("k")), schema="t string, k string")
    assert [k[0] for k in kept] == [True, False, True, False]


def test_small_text_functions(spark):
    assert one(spark, ["The cat and для dog2"], T.search_tokens("t")) == [["cat", "dog2"]]
    assert one(spark, [" A \n b\t C "], T.fold_text("t")) == ["a b c"]
    assert one(spark, ["body"], T.with_breadcrumb(F.col("t"), F.lit("Sec"), "Doc", "Dom", "Head")) == ["Dom | Doc > Sec | Head\n\nbody"]
    assert one(spark, ["body"], T.with_breadcrumb(F.col("t"), F.lit(""))) == ["body"]
    assert one(spark, ["ALL CAPS HEADING", "1. one", "other"], T.heading_level("t")) == [1, 2, 3]
    assert one(spark, ["еиксечинхет ымхс", "обычный текст", "﻿ab​"], T.clean_parsed("t")) == ["схмы технические", "обычный текст", "ab"]
    assert one(spark, ["alpha beta"], T.term_score(F.col("t"), ("alpha", "x"), ("beta",))) == [-1]
    files = [("a.xlsx", 100000, 0.0), ("b.pdf", 0, 20.0), ("c.docx", 0, 0.0), ("d.pdf", 0, 9999.0)]
    assert [r[0] for r in values(spark, files, T.timeout_seconds(F.col("f"), F.col("c"), F.col("m")), schema="f string, c long, m double")] == [320, 500, 600, 7200]
    kinds = [(["table", "text"],), (["heading", "text", "text", "text"],), (["text"],), ([],)]
    assert [r[0] for r in values(spark, kinds, T.document_class(F.col("k")), schema="k array<string>")] == ["tabular", "structured", "text", "text"]


def test_canonical_urls(spark):
    cases = ["HTTP://Example.COM:80/a?b=1#f", "https://x.org", "ftp://x.org/", "http://u:p@x.org/", "https://x.org:8443/p", None, "no url"]
    assert one(spark, cases, U.canonical("t")) == ["http://example.com/a?b=1", "https://x.org/", None, None, "https://x.org:8443/p", None, None]
    assert one(spark, ["http://www.Example.com:81/x"], U.domain("t")) == ["example.com:81"]


def test_links(spark):
    html = "<a class=x href='/a'>1</a><A HREF=\"b.html#f\">2</A><a name=z>3</a><a href=../c>4</a>"
    assert one(spark, [html, None], U.anchors("t")) == [["/a", "b.html#f", "../c"], []]
    base = "http://x.org/d/e/page.html"
    cases = [(base, "/a"), (base, "b.html#f"), (base, "../c"), (base, "http://y.org/z"), (base, "//y.org/q"), (base, "?p=2"), (base, "")]
    got = values(spark, cases, U.resolve(F.col("b"), F.col("h")), schema="b string, h string")
    assert [g[0] for g in got] == ["http://x.org/a", "http://x.org/d/e/b.html", "http://x.org/d/c", "http://y.org/z", "http://y.org/q", "http://x.org/d/e/page.html?p=2", base]


def test_url_predicates(spark):
    cases = ["http://x.org/cart/", "http://x.org/catalog/cable", "http://x.org/static/a", "http://x.org/pic.png", "http://x.org/news/1"]
    assert one(spark, cases, U.is_product("t")) == [False, True, False, False, False]
    assert one(spark, ["http://x/catalog/a", "http://x/about", "http://x/blog/a"], U.priority("t")) == [0, 1, 2]
    assert one(spark, ["http://x/a/", "http://x/cable-vvg_a_b_5h2_5_1.php", "http://x/list.php", "http://x/?page=2"], U.is_listing("t")) == [True, False, True, True]
    ids = values(spark, [("http://x/root", "http://x/root/a/b.html"), ("http://x/", "http://x/"), ("http://x/", "http://x/" + "a" * 300)], U.document_id("r", "u"), schema="r string, u string")
    assert ids[0][0] == "a__b" and ids[1][0] == "index" and len(ids[2][0].encode()) <= 200
    assert one(spark, ["see https://u:p@x.org/a?k=1#z now"], U.redact("t")) == ["see https://x.org/a now"]
    assert one(spark, ["/url?q=https%3A%2F%2Fx.org%2Fa&sa=1", "https://y.org/?url=http%3A%2F%2Fz.org", "javascript:x"], U.decode_redirect("t")) == ["https://x.org/a", "http://z.org", ""]
    page = "<body><div class='g-recaptcha'></div>check</body>"
    assert one(spark, [page, page.replace("check", "word " * 200), "<body>hi</body>"], U.captcha("t")) == ["recaptcha", None, None]
    assert one(spark, ["a.md", "b.HTML", "c.zzz"], U.media_type("t")) == ["text/markdown", "text/html", ""]


@pytest.mark.parametrize("bad", ["ftp://x/y", "http://u@x/y"])
def test_manual_resources_refuse(spark, bad):
    from lakeweave.sources.discovery import manual_resources

    good = spark.createDataFrame([(0, "http://x/a#f"), (1, "b.txt"), (2, "http://x/a")], "pos int, uri string")
    assert [r.uri for r in manual_resources(good).collect()] == ["http://x/a", "b.txt"]
    with pytest.raises(Exception, match="refused URI"):
        manual_resources(spark.createDataFrame([(0, bad)], "pos int, uri string")).collect()
