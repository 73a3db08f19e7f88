"""What is worked out once."""

import contextlib
import io

from pyspark.sql import functions as F

from lakeweave.functions import text as T
from lakeweave.operators import chunking as K


def plan(df) -> str:
    with contextlib.redirect_stdout(out := io.StringIO()):
        df.explain("extended")
    return out.getvalue().split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]


def test_lines_are_split_once(spark):
    docs = spark.range(3).select(F.concat(F.lit("a | b\n1 | 2 "), F.col("id").cast("string")).alias("text"))
    # The lines, the first line, and the words of a numeric line.
    assert plan(docs.select(T.classify_block("text"))).count("split(") <= 8
    assert plan(docs.select(T.section_heading("text"))).count("split(") <= 4
    assert [r[0] for r in docs.select(T.classify_block("text")).collect()] == [["table"]] * 3


def test_documents_are_folded_without_frames(spark):
    docs = spark.createDataFrame([(i, f"1. Part {i}\n\nwords of the part\n\n" + "more words. " * 900) for i in range(5)], "doc_id long, text string")
    units = docs.select("doc_id", F.lit(0).alias("idx"), F.lit(1).alias("page"), "text")
    for made in (K.pack_chunks(K.blocks_from_units(units)), K.chunking_log(K.blocks_from_units(units)), K.chunk_text(docs)):
        assert "FlatMapGroupsInPandas" not in plan(made)
    log = K.chunking_log(K.blocks_from_units(units)).collect()
    assert sorted(r.doc_id for r in log) == list("01234") and all(r.blocks_in == 3 for r in log)
    got = K.pack_chunks(K.blocks_from_units(units)).groupBy("doc_id").agg(F.count("*").alias("n")).collect()
    assert {r.doc_id: r.n for r in got} == {r.doc_id: r.chunks_out for r in log}
