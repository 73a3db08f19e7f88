"""Splitters hold few rows at once."""

import contextlib
import io

from lakeweave.operators import chunking as K


def test_splitters_take_no_arrow_batches(spark):
    docs = spark.createDataFrame([("h\n" + "row\n" * 5,), (None,)], "text string")
    for cut in (K.split_rows("text", 3), K.split_text("text", 3, 1)):
        got = docs.select(cut.alias("parts"))
        with contextlib.redirect_stdout(out := io.StringIO()):
            got.explain()
        assert "ArrowEvalPython" not in out.getvalue()
        parts = [r.parts for r in got.collect()]
        assert len(parts[0]) > 1 and parts[1] == []
