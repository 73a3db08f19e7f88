"""Inputs of loops and of several writes are worked out once."""

from pyspark.sql import functions as F

from lakeweave.sources import datasets, discovery


def counting(spark, rows, schema):
    """A table whose every reading adds a row to an accumulator."""
    seen = spark.sparkContext.accumulator(0)

    def read(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    return spark.createDataFrame(rows, schema).coalesce(1).mapInPandas(read, schema), seen


def test_a_crawl_reads_its_pages_once(spark, tmp_path):
    rows = [(f"http://s.org/c/{i}/", f'<a href="/c/{2 * i}/">x</a><a href="/c/{2 * i + 1}/">x</a>') for i in range(1, 16)]
    web, seen = counting(spark, rows, "url string, body string")
    got, _ = discovery.crawl(web, ["http://s.org/c/1/"], discovery.CrawlPolicy(max_pages=1000))
    assert got.count() == 15 and seen.value == 15
    web, seen = counting(spark, rows, "url string, body string")
    found = discovery.catalogue(web, "http://s.org/c/1/".replace("1/", ""), str(tmp_path / "state"), levels=3)
    assert found.count() >= 1 and seen.value == 15


def test_an_export_reads_its_chunks_once(spark, tmp_path):
    chunks, seen = counting(spark, [(1, i, f"t{i}") for i in range(9)], "doc_id long, chunk_index int, text string")
    datasets.export_chunks(chunks.select("*", F.lit(None).cast("int").alias("page"), F.lit("").alias("section")), str(tmp_path / "out"))
    assert seen.value == 9 and spark.read.json(f"{tmp_path}/out/chunks_minimal").count() == 9
