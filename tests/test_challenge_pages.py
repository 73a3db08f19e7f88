"""Queries over pages that show a challenge."""

from lakeweave.plans import more_queries


def test_short_pages_with_a_mark_show_more(spark, tmp_path):
    spark.createDataFrame([(i, "http://a.org/", "<html><body>hi</body></html>") for i in range(4)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.kind for r in more_queries.b30_captcha_pages(spark, str(tmp_path)).collect()}
    assert got == {0: "recaptcha", 1: "yandex_smartcaptcha", 2: "captcha", 3: None}
