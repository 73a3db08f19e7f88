"""Python functions over the rows of a table in bounded memory, whatever the batches that Spark deals out."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

#: Results leave a task in frames of about so many bytes and at most so many rows.
FRAME_BYTES, FRAME_ROWS = 8 << 20, 10_000


def _weight(row: tuple) -> int:
    return sum(len(x) for x in row if isinstance(x, (str, bytes)))


def each_row(df: DataFrame, read: Callable[..., Iterable[tuple]], schema: str) -> DataFrame:
    """The rows that ``read`` gives for the values of each row. A task holds one row's values as Python objects and a frame of results."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    made = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        held, size = [], 0

        def frame():
            columns = zip(*held, strict=True) if held else ([] for _ in made)
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, made, strict=True)], schema=made)

        for batch in batches:
            columns = batch.columns
            for i in range(batch.num_rows):
                for row in read(*(c[i].as_py() for c in columns)):
                    held.append(row)
                    size += _weight(row)
                    if size >= FRAME_BYTES or len(held) >= FRAME_ROWS:
                        yield frame()
                        held, size = [], 0
        if held:
            yield frame()

    return df.mapInArrow(run, schema)
