"""WARC archives: one gzip member for each record, a sequential reader that verifies what it reads.

Writing. Pages are grouped by the SHA-256 of their payload (pre-aggregated, so a payload that a third
of the pages share is no burden); the smallest page_id of a group with a payload of ``min_bytes`` or
more is its response, the others are revisits without the payload. Each task writes one archive in the
shared folder under a name of its own attempt and returns that name, so a lost executor leaves nothing
that is read.

Reading. ``read_records`` goes through a file once with bounded memory: zlib decompresses member after
member in small steps, headers are read to the empty line, the block is framed by Content-Length, and a
response's block and payload digests are verified while they stream by. A wrong digest, length or frame
raises ``WarcError``.

Cases: a null html is an empty payload. Null page_ids stay null; among equal payloads they count as the
largest id. Rows with equal page_id and payload: one is the response, the others revisit it. An empty
table gives no archive and no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweave.llm.common import open_fs, scratch, spread, written

READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
STEP = 1 << 16
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """An archive that doesn't hold what its headers say."""


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data, usedforsecurity=False).digest()).decode()


def _urn(page_id: int | None, part: int = 0) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}:{part}>"


def _page_of(urn: str) -> int | None:
    found = urn.split(":")[2]
    return None if found == "none" else int(found)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, is_response: bool, refers_to: int | None, part: int = 0) -> bytes:
    """One record as a gzip member. A revisit holds the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if is_response else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if is_response else 'revisit'}",
        f"WARC-Record-ID: {_urn(page_id, part)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {''.join((url or '').split())}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if not is_response:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n") + packer.compress(block + b"\r\n\r\n") + packer.flush()


class _Members:
    """Decompresses gzip members one after another, ``STEP`` bytes at a time."""

    def __init__(self, source):
        self.source, self.raw, self.z, self.buffer, self.over = source, b"", None, bytearray(), True

    def next_member(self) -> bool:
        """Go to the next member; False at the end of the file."""
        if not self.over or self.buffer:
            raise WarcError("a member goes on after its record")
        if not self.raw:
            self.raw = self.source.read(STEP)
        if not self.raw:
            return False
        self.z, self.over = zlib.decompressobj(31), False
        return True

    def more(self) -> bool:
        """Decompress another step into the buffer; False at the member's end."""
        while not self.over:
            if not self.raw:
                self.raw = self.source.read(STEP)
                if not self.raw:
                    raise WarcError("a member is cut short")
            try:
                out = self.z.decompress(self.raw, STEP)
            except zlib.error as e:
                raise WarcError(f"not a gzip member: {e}") from None
            if self.z.eof:
                self.raw, self.over = self.z.unused_data, True
            else:
                self.raw = self.z.unconsumed_tail
            if out:
                self.buffer += out
                return True
        return False

    def until(self, mark: bytes, most: int = 1 << 20) -> bytes:
        """What comes before the mark; the mark is dropped."""
        seen = 0
        while (at := self.buffer.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.buffer)
            if seen > most or not self.more():
                raise WarcError("headers without an end")
        out = bytes(self.buffer[:at])
        del self.buffer[: at + len(mark)]
        return out

    def exactly(self, n: int) -> Iterator[bytes]:
        """The next n bytes, in steps."""
        while n:
            if not self.buffer and not self.more():
                raise WarcError("a block is shorter than its Content-Length")
            out = bytes(self.buffer[:n])
            del self.buffer[: len(out)]
            n -= len(out)
            yield out


def _headers(raw: bytes) -> tuple[str, dict[str, str]]:
    first, *rest = raw.decode("utf-8").split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in rest)}


def read_records(source) -> Iterator[dict]:
    """Records of an open archive in order: headers, http headers, and the verified payload's size and digest."""
    members = _Members(source)
    while members.next_member():
        version, head = _headers(members.until(b"\r\n\r\n"))
        if not version.startswith("WARC/1."):
            raise WarcError(f"not a WARC record: {version[:20]}")
        left, block, payload, http, size = int(head["content-length"]), hashlib.sha1(usedforsecurity=False), hashlib.sha1(usedforsecurity=False), bytearray(), 0
        in_http = True
        for piece in members.exactly(left):
            block.update(piece)
            if in_http:
                http += piece
                if (at := http.find(b"\r\n\r\n")) < 0:
                    continue
                piece, in_http = bytes(http[at + 4 :]), False
                del http[at:]
            payload.update(piece)
            size += len(piece)
        if b"".join(members.exactly(4)) != b"\r\n\r\n":
            raise WarcError("a record without its end")
        while members.more():
            pass
        name = lambda h: "sha1:" + base64.b32encode(h.digest()).decode()
        if head.get("warc-block-digest", name(block)) != name(block):
            raise WarcError(f"wrong block digest in {head.get('warc-record-id')}")
        kind = head["warc-type"]
        if kind == "response" and head.get("warc-payload-digest", name(payload)) != name(payload):
            raise WarcError(f"wrong payload digest in {head.get('warc-record-id')}")
        yield {"head": head, "http": _headers(bytes(http))[1], "payload_bytes": size, "payload_digest": name(payload)[5:], "type": kind}


def plan_records(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages (page_id, url, html) with is_response and refers_to.

    A payload's response is its row with the smallest (page_id, url). Only rows that agree in page_id, url and payload
    can tie for it; such rows are folded to one with their number, of which one becomes the response. Nothing here
    depends on how rows are dealt out.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    url = F.coalesce((F.col("url") if "url" in pages.columns else F.lit(None)).cast("string"), F.lit(""))
    rows = spread(pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), html.alias("html")))
    rows = rows.withColumn("sha", F.sha2(F.encode("html", "UTF-8"), 256)).withColumn("id", F.coalesce("page_id", F.lit(2**63 - 1)))
    # Pre-aggregated twice, so that a payload or a row that a third of the table repeats is one row a task. Only groups
    # with copies are joined back: broadcast if the planner finds them small, else a join whose hot keys are split.
    each = rows.groupBy("sha", "id", "url").agg(F.count(F.lit(1)).alias("n"))
    firsts = each.groupBy("sha").agg(F.min(F.struct("id", "url", "n")).alias("first"), F.sum("n").alias("copies")).where("copies > 1")
    firsts = written(spark, firsts.select("sha", F.col("first.id").alias("first_id"), F.col("first.url").alias("first_url"), F.col("first.n").alias("ties")), "warc-groups")
    joined = rows.join(firsts, "sha", "left")
    own = (F.col("id") == F.col("first_id")) & (F.col("url") == F.col("first_url"))
    refers = F.when(F.col("first_id") < 2**63 - 1, F.col("first_id")).alias("refers_to")
    alone = F.col("first_id").isNull() | (F.octet_length("html") < F.lit(min_bytes))
    if firsts.where("ties > 1").isEmpty():
        return joined.select("page_id", "url", "html", (alone | own).alias("is_response"), refers)
    tied = ~alone & own & (F.col("ties") > 1)
    settled = joined.where(~F.coalesce(tied, F.lit(False))).select("page_id", "url", "html", (alone | own).alias("is_response"), refers)
    folded = joined.where(tied).groupBy("sha", "page_id", "url", "first_id").agg(F.first("html").alias("html"), F.count(F.lit(1)).alias("n"))
    copies = folded.select("page_id", "url", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"), "html", refers)
    return settled.unionByName(copies.select("page_id", "url", "html", (F.col("copy") == 1).alias("is_response"), "refers_to"))


def write_archives(spark: SparkSession, records: DataFrame, folder: str) -> DataFrame:
    """Write planned records; the result has a row for each archive: file and number of records."""

    def write(batches):
        fs, path = open_fs(folder)
        sink, n, name = None, 0, f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}.warc.gz"
        for batch in batches:
            for row in batch.to_pylist():
                if sink is None:
                    fs.create_dir(path, recursive=True)
                    sink = fs.open_output_stream(f"{path}/{name}")
                sink.write(record_bytes(row["page_id"], row["url"], row["html"].encode(), row["is_response"], row["refers_to"], 0))
                n += 1
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "n": [n]})

    return records.mapInArrow(write, "file string, n long")


def read_archives(spark: SparkSession, folder: str, files: list[str]) -> DataFrame:
    """A row for each record of the archives."""
    kinds = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])

    def read(batches):
        fs, path = open_fs(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows: list[dict] = []
                with fs.open_input_stream(f"{path}/{name}") as source:
                    for r in read_records(source):
                        head, revisit = r["head"], r["type"] == "revisit"
                        size = int(r["http"]["content-length"])
                        if not revisit and size != r["payload_bytes"]:
                            raise WarcError(f"the payload of {head['warc-record-id']} has {r['payload_bytes']} bytes, not {size}")
                        found = head["warc-payload-digest"].removeprefix("sha1:")
                        rows.append(dict(zip(kinds, (_page_of(head["warc-record-id"]), size, found, r["type"], _page_of(head["warc-refers-to"]) if revisit else None, head["warc-target-uri"]), strict=True)))
                        if len(rows) == 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    listed = spark.createDataFrame([(f,) for f in files], "file string")
    return listed.repartition(max(1, len(files))).mapInArrow(read, READ)


def warc_round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write pages (page_id, url, html) as archives in ``folder`` and return what reading them back gives."""
    folder = folder or scratch(spark, "warc")
    files = [r.file for r in write_archives(spark, plan_records(spark, pages, min_bytes), folder).collect()]
    return read_archives(spark, folder, sorted(files))
