"""Processed datasets as folders: documents/NNNNN/{document,chunks,quality}.json and a report; stored trees; a whole run.

Documents are written by the tasks, each file once under its final name in a staging folder; the driver writes the report
last and renames the folder, so a reader finds a whole dataset or none. Paths may be on any file system that pyarrow opens.
"""

from __future__ import annotations

import json
import posixpath
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweave.functions import text as T
from lakeweave.operators import chunking as K
from lakeweave.operators import quality as Q
from lakeweave.operators.state import integrity_errors
from lakeweave.rows import each_row
from lakeweave.sources import files, markup, office

REPORT = "processing-report.json"
OUTCOMES = "schema_version int, processed_count int, outcomes array<struct<index:int,status:string,directory:string,uri:string,quality_passed:boolean>>"


class InvalidDataset(ValueError):
    """A dataset that isn't what its report says."""


def file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _put(uri: str, data: bytes) -> None:
    fs, path = file_system(uri)
    fs.create_dir(posixpath.dirname(path), recursive=True)
    with fs.open_output_stream(path) as sink:
        sink.write(data)


def write_layout(documents: DataFrame, path: str) -> DataFrame:
    """Documents (doc_index, document, chunks, quality: JSON texts) as three files each; a row for each document written."""

    def write(frames):
        for pdf in frames:
            for i, *parts in zip(pdf["doc_index"], pdf["document"], pdf["chunks"], pdf["quality"], strict=True):
                for name, text in zip(("document", "chunks", "quality"), parts, strict=True):
                    _put(f"{path}/documents/{i:05d}/{name}.json", text.encode())
            yield pd.DataFrame({"doc_index": pdf["doc_index"], "directory": [f"documents/{i:05d}" for i in pdf["doc_index"]]})

    return documents.select("doc_index", "document", "chunks", "quality").mapInPandas(write, "doc_index int, directory string")


def payloads(artifacts: DataFrame, blocks: DataFrame, chunks: DataFrame, gates: DataFrame) -> DataFrame:
    """JSON texts of each document: artifacts (doc_index, uri, source, media_type, filename, extractor), blocks (uri, pos, text,
    kind, page, section), chunks (doc_id = uri, chunk_index, ...), gates (doc_id = uri, ...)."""
    version = F.lit(1).alias("schema_version")
    listed = blocks.groupBy("uri").agg(F.sort_array(F.collect_list(F.struct("pos", "text", "kind", "page", "section"))).alias("blocks"))
    cut = chunks.groupBy(F.col("doc_id").alias("uri")).agg(F.sort_array(F.collect_list(F.struct(F.col("chunk_index").alias("index"), "text", "token_count", "section", "page"))).alias("chunks"))
    gate = gates.select(F.col("doc_id").alias("uri"), "passed", "findings", F.struct("chunk_count", "tiny_count", "duplicate_count", "noisy_count", "oversized_count", "total_tokens").alias("metrics"))
    rows = artifacts.join(listed, "uri").join(cut, "uri", "left").join(gate, "uri", "left")
    n = F.coalesce(F.size("chunks"), F.lit(0)).alias("count")
    return rows.select(
        "doc_index", "uri", F.coalesce("passed", F.lit(False)).alias("quality_passed"),
        F.to_json(F.struct(version, F.struct("uri", "source", "media_type").alias("resource"), "extractor", "filename", "blocks")).alias("document"),
        F.to_json(F.struct(version, F.col("uri").alias("document"), n, "chunks")).alias("chunks"),
        F.to_json(F.struct(version, F.coalesce("passed", F.lit(False)).alias("passed"), "findings", "metrics")).alias("quality"),
    )


def process_manifest(spark: SparkSession, manifest: str, output: str, limit: int = 100, max_tokens: int = 800) -> dict:
    """A manifest's local files to a dataset (S2, G12): routed, read, chunked, judged and written; what fails is in the report.
    A manifest holds at most ``limit`` resources, so its report is small."""
    wanted = files.manifest_resources(spark, manifest, limit).select(F.col("pos").cast("int").alias("doc_index"), "uri", "source", F.col("media_type").alias("given"))
    listed = wanted.collect()
    names = [r.uri if "://" in r.uri or r.uri.startswith("file:") else f"file://{r.uri}" for r in listed]
    known = [n for n in names if file_system(n)[0].get_file_info(file_system(n)[1]).is_file]
    plain = lambda c: F.regexp_replace(c, "^file:/*", "/")
    found = spark.read.format("binaryFile").load(known).select(plain(F.col("path")).alias("path"), "content") if known else spark.createDataFrame([], "path string, content binary")
    rows = wanted.join(found, plain(F.col("uri")) == F.col("path"), "left").withColumn("filename", F.element_at(F.split("uri", "/"), -1)).withColumn("media_type", F.coalesce("given", F.lit("")))
    from lakeweave.sources.scratch import settled

    artifacts = settled(files.with_extractor(rows).drop("path", "given"), "artifacts")
    # Blocks are keyed by place, as a manifest may name a file twice.
    keyed = artifacts.where("content IS NOT NULL AND extractor IS NOT NULL").withColumn("uri", F.col("doc_index").cast("string"))
    of = lambda name: keyed.where(F.col("extractor") == name)
    none = F.lit(None).cast("int").alias("page")
    texts = files.text_blocks(of("text")).select("uri", "pos", "text", "kind", none, F.lit("").alias("section"), F.lit(None).cast("string").alias("error"))
    pages = markup.html_blocks(of("html-xml").select("uri", F.make_valid_utf8(F.col("content").cast("string")).alias("html")), "uri", "html").select("uri", "pos", "text", F.lit("markup").alias("kind"), none, F.lit("").alias("section"), F.lit(None).cast("string").alias("error"))
    read = settled(texts.unionByName(pages).unionByName(office.office_blocks(keyed).select("uri", "pos", "text", "kind", "page", F.coalesce("section", F.lit("")).alias("section"), "error")), "blocks")
    blocks = read.where("error IS NULL")
    chunks = settled(K.chunk_extracted(blocks.select(F.col("uri").alias("doc_id"), F.col("pos").alias("idx"), "text", "kind", "page", "section"), max_tokens), "chunks")
    gates = Q.quality_gate(chunks.select("doc_id", "chunk_index", "text", "token_count"), max_tokens=max_tokens)
    ready = payloads(artifacts.withColumn("uri", F.col("doc_index").cast("string")).drop("content"), blocks, chunks, gates)
    fs, target = file_system(output)
    if fs.get_file_info(target).type.name != "NotFound":
        raise FileExistsError(output)
    staging = f"{output.rstrip('/')}.staging"
    if fs.get_file_info(f"{target}.staging").is_file or fs.get_file_info(f"{target}.staging").type.name == "Directory":
        fs.delete_dir(f"{target}.staging")
    ready = settled(ready, "payloads")
    wrote = {r.doc_index: r.directory for r in write_layout(ready, staging).collect()}
    passed = {r.doc_index: r.quality_passed for r in ready.select("doc_index", "quality_passed").collect()}
    errors = {int(r.uri): r.error for r in read.where("error IS NOT NULL").select("uri", "error").collect()}
    unread = {r.doc_index: "missing" if r.content is None else "unsupported" for r in artifacts.where("content IS NULL OR extractor IS NULL").select("doc_index", F.when(F.col("content").isNotNull(), 1).alias("content")).collect()}
    outcomes = []
    for r in listed:
        i = r.doc_index
        status = "processed" if i in wrote else "skipped" if unread.get(i) == "unsupported" else "failed"
        outcomes.append({"index": i, "status": status, "uri": r.uri, "directory": wrote.get(i), "quality_passed": passed.get(i), "error": errors.get(i) or unread.get(i) or (None if i in wrote else "no content")})
    count = lambda s: sum(o["status"] == s for o in outcomes)
    whole = "failed" if not count("processed") else "partial" if count("failed") + count("skipped") else "complete"
    report = {"schema_version": 1, "overall": whole, "processed_count": count("processed"), "skipped_count": count("skipped"), "failed_count": count("failed"), "quality_failed_count": sum(o["quality_passed"] is False for o in outcomes), "outcomes": outcomes}
    _put(f"{staging}/{REPORT}", (json.dumps(report, ensure_ascii=False, indent=2) + "\n").encode())
    fs.move(f"{target}.staging", target)
    return report


def validate_dataset(spark: SparkSession, path: str) -> DataFrame:
    """The report's outcomes, if the report is sound, its directories are safe and all files are there; else an error."""
    fs, root = file_system(path)
    if not fs.get_file_info(f"{root}/{REPORT}").is_file:
        raise InvalidDataset(f"no {REPORT}")
    _no_links(root, fs)
    try:
        raw = spark.read.schema(OUTCOMES).option("multiLine", True).option("mode", "FAILFAST").json(f"{path.rstrip('/')}/{REPORT}")
        head = raw.select("schema_version", "processed_count", F.col("outcomes").isNotNull().alias("listed")).collect()
    except Exception as e:  # noqa: BLE001
        raise InvalidDataset(f"the report can't be read: {type(e).__name__}") from None
    if len(head) != 1 or head[0].schema_version != 1 or not head[0].listed:
        raise InvalidDataset("the report's version or outcomes are wrong")
    outcomes = raw.select(F.inline("outcomes")).withColumnRenamed("index", "doc_index")
    kept = outcomes.where("status = 'processed'")
    parts = F.split("directory", "/")
    unsafe = F.coalesce(F.trim("directory") == "", F.lit(True)) | F.col("directory").startswith("/") | F.array_contains(parts, "..")
    if kept.where(unsafe).count():
        raise InvalidDataset("an unsafe directory")
    if kept.count() != head[0].processed_count:
        raise InvalidDataset("processed_count doesn't match the outcomes")
    there = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(path).select(F.col("path"))
    relative = there.select(F.regexp_replace(F.regexp_replace("path", "^file:/*", "/"), f"^.*?{_quoted(root.strip('/'))}/", "").alias("path"))
    wrong = integrity_errors(outcomes.withColumn("doc_index", F.coalesce("doc_index", F.lit(-1))), relative).limit(1).collect()
    if wrong:
        raise InvalidDataset(wrong[0].error)
    return outcomes


def _quoted(text: str) -> str:
    return "".join("\\" + c if c in r"\.^$|?*+()[]{}" else c for c in text)


def _no_links(root: str, fs) -> None:
    import os

    if fs.type_name == "local":
        for folder, dirs, names in os.walk(root):
            for name in [*dirs, *names]:
                if os.path.islink(os.path.join(folder, name)):
                    raise ValueError(f"a symbolic link: {name}")


def upload_tree(spark: SparkSession, source: str, destination: str, overwrite: bool = True) -> tuple[int, int]:
    """Copy a folder's files (hidden ones aside) to another folder, on any file system; gives files and bytes. Links are
    refused, and so are folders within each other; unless ``overwrite``, all targets are looked up before the first is written."""
    from pyarrow import fs as arrow

    (own, root), (other, target) = file_system(source), file_system(destination)
    if own.get_file_info(root).type != arrow.FileType.Directory:
        raise FileNotFoundError(source)
    inside = lambda a, b: (a.rstrip("/") + "/").startswith(b.rstrip("/") + "/")
    if own.equals(other) and (inside(target, root) or inside(root, target)):
        raise ValueError("source and destination overlap")
    _no_links(root, own)
    found = [i for i in own.get_file_info(arrow.FileSelector(root, recursive=True)) if i.is_file]
    listed = sorted((i.path[len(root.rstrip("/")) + 1 :], i.size) for i in found)
    listed = [(p, n) for p, n in listed if not any(part.startswith(".") for part in p.split("/"))]
    if not overwrite:
        for at in range(0, len(listed), 1000):
            for info in other.get_file_info([f"{target}/{p}" for p, _ in listed[at : at + 1000]]):
                if info.type != arrow.FileType.NotFound:
                    raise FileExistsError(info.path)
    if not listed:
        return 0, 0

    def copy(frames):
        for pdf in frames:
            for path in pdf["path"]:
                (a, from_), (b, to) = file_system(f"{source.rstrip('/')}/{path}"), file_system(f"{destination.rstrip('/')}/{path}")
                b.create_dir(posixpath.dirname(to), recursive=True)
                with a.open_input_stream(from_) as get, b.open_output_stream(to) as put:
                    while part := get.read(1 << 20):
                        put.write(part)
            yield pdf[["size"]]

    rows = spark.createDataFrame(listed, "path string, size long").repartition(min(len(listed), 64))
    done = rows.mapInPandas(copy, "size long").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).first()
    return done.n, done.bytes


def store_dataset(spark: SparkSession, source: str, root: str, destination: str, overwrite: bool = False) -> tuple[int, int]:
    """A dataset, validated first, to a safe relative folder below a root."""
    relative = destination.strip("/")
    if not relative or ".." in relative.split("/"):
        raise ValueError("the destination has to be a safe relative path")
    validate_dataset(spark, source)
    return upload_tree(spark, source, f"{root.rstrip('/')}/{relative}", overwrite)


def write_run_manifest(folder: str, manifest: dict, now: datetime | None = None) -> str:
    """A run's manifest under a name that tells its time."""
    path = f"{folder.rstrip('/')}/run-{(now or datetime.now(UTC)):%Y%m%dT%H%M%SZ}.json"
    _put(path, (json.dumps(manifest, ensure_ascii=False, indent=2, default=str) + "\n").encode())
    return path


def demo(spark: SparkSession, html: str, title: str = "demo") -> DataFrame:
    """One page through blocks, chunks and metadata, with nothing but the session."""
    page = spark.createDataFrame([(title, html)], "doc_id string, html string")
    blocks = markup.html_blocks(page, "doc_id", "html").select("doc_id", F.col("pos").alias("idx"), "text", F.lit("markup").alias("kind"), F.lit(None).cast("int").alias("page"), F.lit("").alias("section"))
    chunks = K.chunk_extracted(blocks)
    return chunks.select(*T.minimal_record(F.col("text"), F.col("doc_id"), F.col("page"), F.col("section"), F.col("chunk_index")))


def export_chunks(chunks: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Chunks (doc_id, chunk_index, text, page, section, ...) as two sets of JSON lines: whole, and as retrieval records."""
    from lakeweave.sources.scratch import settled

    # Settled before its ranges are sampled and before it is written twice, so that chunks are worked out once.
    ordered = settled(chunks, "export").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "chunk_index")
    ordered.write.mode(mode).json(f"{path}/chunks_enriched")
    minimal = T.minimal_record(F.col("text"), F.col("doc_id").cast("string"), F.col("page"), F.col("section"), F.col("chunk_index"))
    ordered.select(*minimal).write.mode(mode).json(f"{path}/chunks_minimal")


def render_template(template: str, metrics: dict) -> str:
    """A Markdown template with {{name}} places filled from a run's metrics; names that are missing are an error."""
    import re

    wanted = set(re.findall(r"\{\{\s*([\w.]+)\s*\}\}", template))
    if unknown := wanted - metrics.keys():
        raise KeyError(f"no such metrics: {', '.join(sorted(unknown))}")
    shown = lambda v: f"{v:,}" if isinstance(v, int) and not isinstance(v, bool) else f"{v:.4g}" if isinstance(v, float) else str(v)
    return re.sub(r"\{\{\s*([\w.]+)\s*\}\}", lambda m: shown(metrics[m.group(1)]), template)


UPLOADS = "uri string, filename string, media_type string, sha256 string, status string, part int, parts int, content binary"


def upload_plan(artifacts: DataFrame, known: DataFrame, pages_per_part: int = 50) -> DataFrame:
    """Q6: what becomes of files (uri, filename, media_type, content): ``known`` by the hashes (sha256) of earlier runs, ``duplicate``
    of a file with a smaller uri, or ``upload``, PDFs in parts of at most ``pages_per_part`` pages. Contents go with uploads only."""
    hashed = artifacts.withColumn("sha256", F.sha2("content", 256))
    first = hashed.groupBy("sha256").agg(F.min("uri").alias("first"))
    judged = hashed.join(first, "sha256").join(known.select("sha256", F.lit(True).alias("seen")).distinct(), "sha256", "left")
    status = F.when(F.col("seen"), "known").when(F.col("uri") != F.col("first"), "duplicate").otherwise("upload")
    judged = judged.select("uri", "filename", "media_type", "sha256", status.alias("status"), "content")

    def cut(uri, filename, media_type, sha256, status, content):
        from lakeweave.sources import pdf

        n, parts = 1, iter([content if status == "upload" else None])
        if status == "upload" and media_type == "application/pdf":
            n, parts = pdf.parts_of(content, pages_per_part)
        return ((uri, filename, media_type, sha256, status, i, n, p) for i, p in enumerate(parts))

    return each_row(judged, cut, UPLOADS)


def upload_all(plan: DataFrame, send) -> DataFrame:
    """Q6: send(filename, part, content) for each part that is to be uploaded, in the tasks; its answer (an id) or its error is the
    result, and the hashes of files whose parts all got through are ``known`` to the next run."""

    def run(frames):
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                answer = error = None
                if row["status"] == "upload":
                    try:
                        answer = str(send(row["filename"], row["part"], bytes(row["content"])))
                    except Exception as e:  # noqa: BLE001  told by the row
                        error = str(e) or type(e).__name__
                state = row["status"] if row["status"] != "upload" else "failed" if error else "uploaded"
                out.append((row["uri"], row["sha256"], row["part"], state, answer, error))
            yield pd.DataFrame(out, columns=["uri", "sha256", "part", "status", "answer", "error"])

    return plan.mapInPandas(run, "uri string, sha256 string, part int, status string, answer string, error string")
