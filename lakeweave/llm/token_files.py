"""Token-ID output: encode whole texts, write Simple-8b files in doc_id order, read them back.

Documents are range-partitioned by doc_id, so that file k's documents come before file k+1's; an id that
many rows share is split over several files by the beginnings of its texts. A task writes one file in the
shared folder under a name of its own attempt and returns that name; only successful tasks' names are read,
so a lost executor or a second attempt leaves no half file in the result. The driver sees one small row for
each file.

Cases: a null text is empty and still gets the end id. Null doc_ids come first and stay null. Rows with
equal doc_ids are ordered by the first 32 characters of their texts. An empty table gives no files and no
rows. Other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweave.llm.common import open_fs, scratch
from lakeweave.llm.simple8b import Reader, Writer
from lakeweave.llm.tokens import encoder

WROTE = "file string, shard int, n_docs long, n_tokens long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write_token_files(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int, folder: str) -> DataFrame:
    """Write the files; the result has a row for each (file, shard, n_docs, n_tokens)."""

    def write(batches):
        shard, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        fs, path = open_fs(folder)
        sink = None
        n_docs = n_tokens = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if sink is None:
                fs.create_dir(path, recursive=True)
                name = f"{shard:06d}-{attempt}.s8b"
                out = Writer(sink := fs.open_output_stream(f"{path}/{name}"))
            keys = batch.column("doc_id").cast(pa.int64())
            for at, ends, ids in encoder(tokenizer).encode_column(batch.column("text")):
                n = len(ends) - 1
                part = keys.slice(at, n)
                sizes = np.diff(ends) + 1
                full = np.full(len(ids) + n, end_id, np.uint32)
                last = np.zeros(len(full), bool)
                last[np.cumsum(sizes) - 1] = True
                full[~last] = ids
                out.add(part.fill_null(0).to_numpy(), part.is_null().to_numpy(zero_copy_only=False).astype("u1"), sizes, full)
                n_docs, n_tokens = n_docs + n, n_tokens + len(full)
        if sink is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "shard": pa.array([shard], pa.int32()), "n_docs": [n_docs], "n_tokens": [n_tokens]})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # An id that many rows share is split by the beginnings of its texts, and rows that agree in these by their numbers.
    dealt = rows.withColumn("head", F.substring("text", 1, 32)).withColumn("row", F.xxhash64(F.monotonically_increasing_id()))
    ordered = dealt.repartitionByRange("doc_id", "head", "row").sortWithinPartitions("doc_id", "head", "row")
    return ordered.select("doc_id", "text").mapInArrow(write, WROTE)


def read_token_files(spark: SparkSession, folder: str, files: list[tuple[str, int]]) -> DataFrame:
    """Per document, from files given with the number of ids before each: start, n_tokens and ids' CRC."""

    def read(batches):
        fs, path = open_fs(folder)
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True):
                where = f"{path}/{name}"
                with fs.open_input_file(where) as source:
                    reader = Reader(source, source.size())
                    ends = np.cumsum(reader.sizes)
                    crcs, crc, doc, at = np.zeros(len(ends), np.int64), 0, 0, 0
                    for ids in reader.ids():
                        raw, stop = ids.astype("<u4").tobytes(), at + len(ids)
                        while doc < len(ends) and ends[doc] <= stop:
                            begin = max(int(ends[doc] - reader.sizes[doc]), at) - at
                            crcs[doc] = zlib.crc32(memoryview(raw)[4 * begin : 4 * (int(ends[doc]) - at)], crc)
                            crc, doc = 0, doc + 1
                        if doc < len(ends):
                            begin = max(int(ends[doc] - reader.sizes[doc]), at) - at
                            crc = zlib.crc32(memoryview(raw)[4 * begin :], crc)
                        at = stop
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(reader.doc_ids, mask=reader.nulls), "start": base + ends - reader.sizes, "n_tokens": reader.sizes, "ids_crc32": crcs})

    listed = spark.createDataFrame(files, "file string, base long")
    return listed.repartition(max(1, len(files))).mapInArrow(read, READ)


def token_files(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 1, folder: str | None = None) -> DataFrame:
    """Write docs (doc_id, text) as token files in ``folder`` and return what the files hold per document."""
    folder = folder or scratch(spark, "token-files")
    wrote = sorted(write_token_files(spark, docs, tokenizer, end_id, folder).collect(), key=lambda r: r.shard)
    base, files = 0, []
    for row in wrote:
        files.append((row.file, base))
        base += row.n_tokens
    return read_token_files(spark, folder, files)
