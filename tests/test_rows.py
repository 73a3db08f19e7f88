"""Python functions over rows."""


def test_frames_of_rows_are_bounded(spark, monkeypatch):
    from lakeweave import rows

    got = rows.each_row(spark.range(3, numPartitions=1), lambda i: ((i, j, "x" * 1000) for j in range(20_000)), "i long, j int, t string")
    assert got.groupBy("i").count().orderBy("i").collect() == [(0, 20_000), (1, 20_000), (2, 20_000)]
    assert rows.each_row(spark.range(0), lambda i: [(i,)], "i long").collect() == []
