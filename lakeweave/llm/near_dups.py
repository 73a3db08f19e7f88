"""Near-duplicate components by circulant MinHash, banding and exact Jaccard verification.

Texts are lower-cased (A-Z) and their sets of five-word shingles hashed (a shorter text's whole sequence
is one shingle). Equal sets form a class with one representative, so copies cost one row each and are
never paired; classes are numbered as their table is written, and buckets, links and components carry
these numbers. A class's signature comes from two permutations of the hashes: the first scatters them
around the circle of 64-bit values once, the second is applied to the same values shifted by k places,
and the minimum for each shift k is coordinate k. Bands of ``rows`` coordinates are the bucket keys; a
pair with a similarity of 0.85 or more shares no bucket with a probability of at most 2e-8.

Links are found without pairing a bucket's members with each other:
1. every member is verified against its bucket's smallest member, on full sets;
2. these links give first components;
3. only buckets that still hold several components go on: members outside a bucket's largest component
   are compared with the signatures of others of a fitting set size in cells of bounded size, partners that
   could reach the threshold are verified on full sets, and the links join the components.
Two classes that share a bucket are thus either in one component already or have been compared, so no link
between different texts is lost to the way buckets are read. A pair is listed in the first band whose keys
agree in their upper 32 bits; chance agreement of an earlier band loses less than 6e-9 of pairs. Candidates
travel as lists for each document and block of partners, not as rows for each pair.

Cases: a null text or one without words has an empty set, links with nothing and is kept. Rows that share
a doc_id are one document when components are numbered. Null doc_ids stay null and never name a component
that has another id. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweave.llm.common import byte_slices, shuffle_width, spread, written
from lakeweave.llm.hashing import STEPS, U, mix, shingle_sets, word_hashes

BANDS, ROWS = 24, 4
CELL, BLOCK = 4096, 1024
#: Standard deviations below the expected agreement at the threshold that still count as a candidate.
SLACK = 5.5


def signature(shingles: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """Circulant MinHash: coordinate k is the minimum of pi(sigma(x) - k) over the set."""
    scattered = mix(shingles * U(0x9E3779B97F4A7C15) + U(1))
    shifts = np.arange(size, dtype=np.uint64)[:, None]
    out = None
    for at in range(0, len(scattered), 2048):
        z = scattered[None, at : at + 2048] - shifts
        z *= U(0xD6E8FEB86659FD93)
        z ^= z >> U(32)
        z *= U(0xFF51AFD7ED558CCD)
        least = z.min(axis=1)
        out = least if out is None else np.minimum(out, least)
    return out


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    parts = sig.reshape(bands, rows)
    return mix((parts * STEPS[:rows]).sum(axis=1, dtype=np.uint64) + np.arange(bands, dtype=np.uint64) * STEPS[60])


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def document_sets(docs: DataFrame, n: int = 5) -> DataFrame:
    """(doc_id, n_shingles, key, sig, bands): key null for an empty set; sig has a byte for each coordinate."""

    def scan(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for at, part in byte_slices(batch.column("text"), 4 << 20):
                sizes, keys, sigs, bands = [], [], [], []
                for shingles in shingle_sets(*word_hashes(part), n):
                    sizes.append(len(shingles))
                    if not len(shingles):
                        keys.append(None), sigs.append(None), bands.append(None)
                        continue
                    sig = signature(shingles)
                    keys.append(set_key(shingles))
                    sigs.append((sig & U(255)).astype(np.uint8).tobytes())
                    bands.append(band_keys(sig).view(np.int64))
                yield pa.RecordBatch.from_arrays([ids.slice(at, len(part)), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "key", "sig", "bands"])

    return spread(_texts(docs)).mapInArrow(scan, "doc_id long, n_shingles long, key binary, sig binary, bands array<long>")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b): label spreading with pointer jumping, written each round."""
    both = written(spark, edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    labels = written(spark, both.groupBy("a").agg(F.min("b").alias("near")).select(F.col("a").alias("node"), F.least("near", "a").alias("root")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        up = labels.select(F.col("node").alias("root"), F.col("root").alias("above"))
        step = written(spark, step.join(up, "root", "left").select("node", "old", F.coalesce(F.least("root", "above"), "root").alias("root")), "labels")
        labels = step.select("node", "root")
        if step.where("old <> root").isEmpty():
            return labels


def full_sets(spark: SparkSession, docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(cid, set) for wanted (id, key, cid): the texts of these documents are read and hashed once more."""

    def scan(batches):
        for batch in batches:
            found: dict[bytes, bytes] = {}
            for _, part in byte_slices(batch.column("text"), 4 << 20):
                for shingles in shingle_sets(*word_hashes(part), n):
                    if len(shingles):
                        found[set_key(shingles)] = shingles.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())], names=["key", "set"])

    tagged = _texts(docs).withColumn("id", F.coalesce("doc_id", F.lit(2**63 - 1)))
    texts = tagged.join(wanted.select("id").distinct(), "id", "left_semi").select("text")
    sets = texts.mapInArrow(scan, "key binary, set binary").join(wanted.select("key", "cid"), "key")
    return written(spark, sets.groupBy("key").agg(F.first("cid").alias("cid"), F.first("set").alias("set")).select("cid", "set"), "sets")


def block_of(blocks: int):
    return F.pmod(F.xxhash64("cid"), F.lit(blocks)).cast("int").alias("block")


def exact_links(candidates: DataFrame, sets: DataFrame, blocks: int, low: int, high: int) -> DataFrame:
    """Links (a, b) among candidates (a, block, others) with high * intersection >= low * union, on full sets."""
    left = candidates.join(sets.select(F.col("cid").alias("a"), F.col("set").alias("own")), "a").select("block", "a", "own", "others")
    right = sets.select(block_of(blocks), F.col("cid").alias("name"), F.col("set").alias("theirs"))

    def verify(left: pa.Table, right: pa.Table) -> pa.Table:
        here = {k: i for i, k in enumerate(right["name"].to_pylist())}
        raw = right["theirs"]
        out_a: list[int] = []
        out_b: list[int] = []
        for a, mine, others in zip(left["a"].to_pylist(), left["own"], left["others"], strict=True):
            own, names = np.frombuffer(mine.as_buffer(), np.uint64), others.as_py()
            for at in range(0, len(names), 256):
                part = names[at : at + 256]
                theirs = [np.frombuffer(raw[here[k]].as_buffer(), np.uint64) for k in part]
                sizes = np.array([len(t) for t in theirs])
                joined = np.concatenate(theirs)
                place = np.minimum(np.searchsorted(own, joined), len(own) - 1)
                both = np.add.reduceat((own[place] == joined).astype(np.int64), np.cumsum(sizes) - sizes)
                for i in np.flatnonzero(high * both >= low * (sizes + len(own) - both)):
                    out_a.append(a), out_b.append(part[i])
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return left.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(verify, "a long, b long")


def _compare_cells(batches, least: int, low: int, high: int):
    """Cells come whole and in order: askers (side 0), then members (side 1). Emits (a, others) lists by block."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        cells = rest["cell"].to_numpy()
        if not len(cells):
            continue
        whole = len(cells) - int(np.argmax(cells[::-1] != cells[-1])) if cells[0] != cells[-1] else 0
        if whole:
            yield from _cells(rest.slice(0, whole), least, low, high)
            rest = rest.slice(whole)
    if rest is not None and rest.num_rows:
        yield from _cells(rest, least, low, high)


def _cells(table: pa.Table, least: int, low: int, high: int):
    table = table.combine_chunks()
    cells, side, turns = table["cell"].to_numpy(), table["side"].to_numpy(), table["turn"].to_numpy()
    names, roots, blocks, sizes = (table[c].to_numpy() for c in ("cid", "root", "block", "size"))
    sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint8).reshape(len(names), -1)
    tags = table["tags"].combine_chunks().flatten().to_numpy().reshape(len(names), -1)
    bounds = [0, *(np.flatnonzero(cells[1:] != cells[:-1]) + 1).tolist(), len(cells)]
    out_a, out_block, out_b = [], [], []
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        cut = lo + int(np.searchsorted(side[lo:hi], 1))
        # By set size: sizes of a linked pair lie within low / high of each other, so an asker meets one stretch only.
        order = cut + np.argsort(sizes[cut:hi], kind="stable")
        by_size = sizes[order]
        members = sig[order]
        first = np.searchsorted(by_size, -(-low * sizes[lo:cut] // high), "left")
        last = np.searchsorted(by_size, high * sizes[lo:cut] // low, "right")
        for i, f, t in zip(range(lo, cut), first.tolist(), last.tolist(), strict=True):
            near = order[f + np.flatnonzero((members[f:t] == sig[i]).sum(axis=1) >= least)]
            near = near[roots[near] != roots[i]]
            # A pair that shares several bands is listed in the first of them only: the first by band keys, as
            # bytes of a signature may agree in a band in which the two never meet.
            near = near[(tags[near] == tags[i]).argmax(axis=1) == turns[i]] if len(near) else near
            for b in np.unique(blocks[near]).tolist():
                out_a.append(names[i]), out_block.append(b), out_b.append(names[near[blocks[near] == b]])
    if out_a:
        ends = np.cumsum([0, *map(len, out_b)])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(out_b), pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_block, pa.int32()), lists], names=["a", "block", "others"])


def near_duplicates(spark: SparkSession, docs: DataFrame, low: int = 85, high: int = 100, n: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for docs (doc_id, text): links where high * intersection >= low * union."""
    per_doc = written(spark, document_sets(docs, n), "sets-of-documents")
    far = F.lit(2**63 - 1)
    classes = per_doc.where("key IS NOT NULL").groupBy("key").agg(F.min(F.coalesce("doc_id", far)).alias("first"), F.first("n_shingles").alias("size"), F.first("sig").alias("sig"), F.first("bands").alias("bands"), F.count(F.lit(1)).alias("copies"))
    # Numbers are fixed when the table is written.
    classes = written(spark, classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    rows = classes.select("cid", F.posexplode("bands").alias("turn", "band"))
    shared = rows.groupBy("band").agg(F.min("cid").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = written(spark, rows.join(shared, "band"), "buckets")
    inside = written(spark, members.select("cid").distinct().join(classes.select("cid", "key", F.col("first").alias("id")), "cid"), "bucket-members")
    n_in, edges = inside.count(), None
    if n_in:
        blocks = max(1, -(-n_in // BLOCK), min(n_in // 64, shuffle_width(spark)))
        sets = full_sets(spark, docs, inside, n)
        stars = members.where("cid <> rep").groupBy(F.col("rep").alias("a"), block_of(blocks)).agg(F.collect_set("cid").alias("others"))
        edges = written(spark, exact_links(stars, sets, blocks, low, high), "links")
        roots = components(spark, edges)
        placed = members.join(roots.withColumnRenamed("node", "cid"), "cid", "left").select("band", "turn", "n", "cid", F.coalesce("root", "cid").alias("root"))
        placed = written(spark, placed, "placed")
        tops = placed.groupBy("band", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("band").agg(F.max(F.struct("c", "root")).alias("m"), F.count(F.lit(1)).alias("roots"))
        tags = F.transform("bands", lambda b: F.shiftright(b, 32).cast("int")).alias("tags")
        open_ = placed.join(tops.where("roots > 1").select("band", F.col("m.root").alias("top")), "band").join(classes.select("cid", "size", "sig", tags), "cid")
        late_blocks = max(1, -(-n_in // BLOCK))
        wide = F.ceil(F.col("n") / CELL).cast("int")
        spot = lambda seed: F.pmod(F.xxhash64("cid", F.lit(seed)), wide)
        every = F.explode(F.sequence(F.lit(0).cast("long"), (wide - 1).cast("long")))
        asks = open_.where("root <> top").withColumn("x", spot(1)).withColumn("y", every).withColumn("side", F.lit(0))
        hears = open_.withColumn("y", spot(2)).withColumn("x", every).withColumn("side", F.lit(1))
        cells = asks.unionByName(hears).select(F.xxhash64("band", "x", "y").alias("cell"), "side", "turn", "cid", "root", "size", "sig", "tags", block_of(late_blocks))
        share = low / high
        least = int(BANDS * ROWS * share - SLACK * (BANDS * ROWS * share * (1 - share)) ** 0.5)
        pairs = cells.repartition(shuffle_width(spark), "cell").sortWithinPartitions("cell", "side").mapInArrow(lambda b: _compare_cells(b, least, low, high), "a long, block int, others array<long>")
        late = pairs.groupBy("a", "block").agg(F.array_distinct(F.flatten(F.collect_list("others"))).alias("others"))
        more = exact_links(late, sets, late_blocks, low, high)
        edges = edges.unionByName(more)
    labels = classes.select("key", "first", F.col("cid").alias("root"), "copies")
    if edges is not None:
        roots = components(spark, written(spark, edges, "all-links"))
        labels = classes.join(roots.withColumnRenamed("node", "cid"), "cid", "left").select("cid", "key", "first", F.coalesce("root", "cid").alias("root"), "copies")
        linked = (F.col("copies") > 1) | (F.col("root") != F.col("cid"))
    else:
        linked = F.col("copies") > 1
    labels = labels.withColumn("linked", linked)
    smallest = labels.groupBy("root").agg(F.min("first").alias("smallest"), F.count(F.lit(1)).alias("n"), F.bool_or("linked").alias("any")).where("any OR n > 1")
    names = labels.join(smallest.select("root", "smallest"), "root").select("key", F.when(F.col("smallest") < far, F.col("smallest")).alias("smallest"))
    out = per_doc.select("doc_id", "n_shingles", "key").join(names, "key", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("smallest", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(spark: SparkSession, docs: DataFrame, low: int = 85) -> DataFrame:
    """The rows of docs, all their columns, less all but the smallest doc_id of each component; texts are linked from low hundredths on.

    Rows that repeat a kept row's doc_id and text go as well; rows with a null doc_id stay. Whole documents meet the
    verdicts once, by a shuffled hash join that streams them: they are never sorted, and the plan is the same at every size.
    """
    found = near_duplicates(spark, docs, low).where("doc_id IS NOT NULL")
    verdicts = found.groupBy("doc_id").agg(F.bool_and("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    verdicts = written(spark, verdicts.where("NOT kept OR n > 1"), "verdicts")
    left = docs.join(verdicts.hint("shuffle_hash"), docs["doc_id"] == verdicts["doc_id"], "left").where(F.coalesce(verdicts["kept"], F.lit(True)))
    own = [docs[f"`{c}`"] for c in docs.columns]
    if verdicts.where("kept").isEmpty():
        return left.select(own)
    twice = left.where(verdicts["n"] > 1).select(own).dropDuplicates(["doc_id", "text"])
    return left.where(verdicts["n"].isNull()).select(own).unionByName(twice)
