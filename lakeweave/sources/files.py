"""Files as tables, and datasets as files."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweave import schemas
from lakeweave.functions import text as T
from lakeweave.functions import urls as U

MAX_BYTES = 50 << 20
#: Extractors by media type and extension, in the order in which they are asked.
ROUTES = (
    ("pdf", ("application/pdf",), ("pdf",)),
    ("docx", ("application/vnd.openxmlformats-officedocument.wordprocessingml.document",), ("docx",)),
    ("xlsx", ("application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",), ("xlsx",)),
    ("html-xml", ("application/xhtml+xml", "application/xml", "text/html", "text/xml"), ("html", "htm", "xml", "xhtml")),
    ("text", ("text/plain", "text/markdown"), ("txt", "md", "markdown")),
)


def local_files(spark: SparkSession, root: str, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Artifacts below a root, of at most max_bytes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).where(F.col("length") <= max_bytes)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(F.col("path").alias("uri"), name.alias("filename"), U.media_type(name).alias("media_type"), "content")


def manifest_resources(spark: SparkSession, path: str, limit: int = 100) -> DataFrame:
    """Resources of a JSON manifest of version 1 whose count is right."""
    raw = spark.read.schema(schemas.MANIFEST).option("multiLine", True).option("mode", "FAILFAST").json(path)
    sound = (F.col("schema_version") == 1) & (F.col("count") == F.size("resources"))
    checked = raw.select(F.when(sound, F.col("resources")).otherwise(F.raise_error(F.lit("bad manifest"))).alias("resources"))
    return checked.select(F.posexplode("resources").alias("pos", "r")).select("pos", "r.*").where(F.col("pos") < limit)


def units(spark: SparkSession, folder: str) -> DataFrame:
    """Unit files in the order of their names."""
    return spark.read.schema(schemas.UNITS).option("multiLine", True).json(folder).withColumn("file", F.col("_metadata.file_name")).orderBy("file")


def chunk_files(spark: SparkSession, root: str) -> DataFrame:
    """Minimal chunks below a root, at any depth, or else full ones; empty texts are skipped."""
    schema = "document string, section string, page int, chunk_index int, text string, token_count int"
    rows = spark.read.option("multiLine", True).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").schema(schema).json(root).withColumn("file", F.col("_metadata.file_path"))
    for kind in ("chunks_minimal", "chunks"):
        found = rows.where(F.col("file").rlike(f"/{kind}/[^/]+$") & (F.length(T.strip(F.coalesce("text", F.lit("")))) > 0)).drop("file")
        if not found.isEmpty():
            return found
    return rows.drop("file").limit(0)


def posting_lists(chunks: DataFrame) -> DataFrame:
    """An inverted index of chunks (chunk_id, text): for each word the chunks that hold it."""
    return chunks.select("chunk_id", F.explode(F.array_distinct(T.search_tokens("text"))).alias("term"))


def logs(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """Log files of one name below a root; broken ones are dropped."""
    read = spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").option("recursiveFileLookup", "true").option("pathGlobFilter", name)
    return read.json(root).withColumn("file", F.col("_metadata.file_path"))


def latest(rows: DataFrame, payload: str) -> DataFrame:
    """What the last file by name says."""
    return rows.agg(F.max_by(payload, "file").alias(payload))


def with_extractor(artifacts: DataFrame) -> DataFrame:
    """The first extractor that takes the file's media type or extension; null if none does."""
    media = F.lower(F.trim(F.element_at(F.split(F.coalesce("media_type", F.lit("")), ";"), 1)))
    ext = F.lower(F.regexp_extract(F.coalesce(F.nullif("filename", F.lit("")), U.path("uri")), r"\.([^./]*)$", 1))
    return artifacts.withColumn("extractor", F.coalesce(*[F.when(media.isin(*m) | ext.isin(*e), F.lit(name)) for name, m, e in ROUTES]))


def text_blocks(artifacts: DataFrame) -> DataFrame:
    """Paragraphs of text files; broken bytes are replaced."""
    body = F.regexp_replace(F.make_valid_utf8(F.col("content").cast("string")), "^\ufeff", "")
    return artifacts.select("uri", F.posexplode(T.paragraphs(T.normalize_text(body))).alias("pos", "text")).withColumn("kind", F.lit("text"))


def write_chunks(chunks: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Chunks as JSON lines, each document's in one file and in order; files hold many documents."""
    chunks.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "chunk_index").write.mode(mode).json(path)


def write_dataset(documents: DataFrame, chunks: DataFrame, gates: DataFrame, path: str) -> None:
    """Documents, chunks and gates as JSON below a staging folder that is renamed when all are there."""
    spark = documents.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    target, staging = hadoop(path), hadoop(path + ".staging")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(target):
        raise FileExistsError(path)
    fs.delete(staging, True)
    for name, df in (("documents", documents), ("chunks", chunks), ("quality", gates)):
        df.withColumn("schema_version", F.lit(1)).write.json(f"{path}.staging/{name}")
    if not fs.rename(staging, target):
        raise OSError(f"can't rename to {path}")


def render_documents(blocks: DataFrame) -> DataFrame:
    """Each document's blocks as Markdown, with the SHA-256 of it."""
    rows = blocks.withColumn("piece", T.render_markdown(F.col("text"), F.col("kind"))).where("piece <> ''")
    whole = rows.groupBy("doc_id").agg(F.expr("listagg(piece, '\n\n') WITHIN GROUP (ORDER BY idx)").alias("body"))
    return whole.withColumn("markdown", F.concat(F.lit("# "), F.col("doc_id").cast("string"), F.lit("\n\n"), "body", F.lit("\n"))).select("doc_id", "markdown", F.sha2("markdown", 256).alias("sha256"))


def publication_plan(pages: DataFrame, published: DataFrame, create_missing: bool = False, dry_run: bool = True) -> DataFrame:
    """What publishing does to each page (slug, markdown), by the hash published last (slug, sha)."""
    rows = pages.withColumn("new_sha", T.content_hash(F.col("markdown"))).join(published, "slug", "left")
    gone = "would_create" if dry_run else "created"
    status = F.when(F.col("sha").isNull(), gone if create_missing else "missing").when(F.col("sha") == F.col("new_sha"), "unchanged").otherwise("would_update" if dry_run else "updated")
    return rows.select("slug", status.alias("status"))


def part_numbers(sizes, limit: int) -> list[int]:
    """The part of each file, in order: a part closes when the next file doesn't fit."""
    parts, part, held = [], -1, 0
    for size in sizes:
        if part < 0 or held + size > limit:
            part, held = part + 1, 0
        held += size
        parts.append(part)
    return parts


def zip_groups(files: DataFrame, limit: int = 300 << 20) -> DataFrame:
    """Files (source, pos, size) to upload parts of at most ``limit`` bytes: in order, each part as many files as fit;
    a larger file is a part of its own. Greedy, so it is a fold over one source's sizes."""

    @F.pandas_udf("array<int>")
    def numbers(sizes: pd.Series) -> pd.Series:
        return sizes.map(lambda x: part_numbers(x, limit))

    listed = files.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("pos", "size"))).alias("files"))
    parts = listed.withColumn("part", numbers(F.transform("files", lambda f: f["size"].cast("long"))))
    return parts.select("source", F.inline(F.arrays_zip("files", "part"))).select("source", "files.pos", "files.size", "part")
