"""Near-duplicates, top-k search, WARC archives and the pipeline against brute force."""

import base64
import hashlib
import io
import random

import numpy as np
import pyarrow as pa
import pytest

from lakeweave.llm.near_dups import BANDS, ROWS, _compare_cells, keep_one, near_duplicates
from lakeweave.llm.topk import top_k
from lakeweave.llm.warc import WarcError, read_records, record_bytes, warc_round_trip
from pyspark.sql import functions as F
from tests.llm.conftest import nasty, prose


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows):
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 85 * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        root = find(i)
        smallest[root] = min(x for x in (smallest.get(root), doc_id) if x is not None) if (smallest.get(root), doc_id) != (None, None) else None
    return [(d, len(s), smallest[find(i)], smallest[find(i)] == d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def edited(rnd, words, n):
    words = list(words)
    for _ in range(n):
        words[rnd.randrange(len(words))] = f"w{rnd.randrange(10**6)}"
    return " ".join(words)


def test_near_duplicates(spark, docs, no_docs):
    got = sorted((tuple(r) for r in near_duplicates(spark, docs).collect()), key=str)
    assert got == sorted(brute_components(nasty()), key=str)
    assert near_duplicates(spark, no_docs).count() == 0


def test_near_duplicates_with_graded_edits(spark):
    """A group whose members are linked to some and not to others, so that first representatives don't settle it."""
    rnd = random.Random(3)
    rows, bases = [], [prose(rnd, 150).split() for _ in range(4)]
    for i in range(160):
        rows.append((i, edited(rnd, [f"{w}{k % 17}" for k, w in enumerate(bases[i % 4])], rnd.randrange(0, 7))))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in near_duplicates(spark, frame).collect()), key=str) == sorted(brute_components(rows), key=str)
    kept = keep_one(spark, frame)
    assert kept.columns == ["doc_id", "text"] and {r.doc_id for r in kept.collect()} == {d for d, _, _, k in brute_components(rows) if k}


def test_near_duplicates_in_many_cells(spark, monkeypatch):
    """Cells of eight rows, so that buckets are dealt over several cells on both sides, with sets of several sizes in a bucket."""
    from lakeweave.llm import near_dups

    monkeypatch.setattr(near_dups, "CELL", 8)
    rnd = random.Random(13)
    rows, bases = [], [[f"{w}{k % 19}" for k, w in enumerate(prose(rnd, 120).split())] for _ in range(3)]
    for i in range(180):
        words = edited(rnd, bases[i % 3], rnd.randrange(0, 9)).split()
        rows.append((i, " ".join(words + [f"tail{k}" for k in range(rnd.randrange(0, 30))])))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in near_duplicates(spark, frame).collect()), key=str) == sorted(brute_components(rows), key=str)


def test_late_pass_lists_pairs_despite_a_chance_match_of_bytes():
    """Bytes agree in bands 0 and 5, but the two share the bucket of band 5 (and 7) only."""
    a = np.arange(BANDS * ROWS, dtype=np.uint8)
    tags = np.arange(BANDS, dtype=np.int32)
    other = np.where(np.isin(tags, (5, 7)), tags, tags + 1000).astype(np.int32)
    for turn, listed in ((5, [([1], [[2]])]), (7, [])):
        cell = pa.table({"cell": pa.array([1, 1, 1], pa.int64()), "side": [0, 1, 1], "turn": [turn] * 3, "cid": [1, 1, 2], "root": [1, 1, 2], "size": [9, 9, 9],
                         "sig": [a.tobytes()] * 3, "tags": pa.array([tags, tags, other], pa.list_(pa.int32())), "block": pa.array([0, 0, 0], pa.int32())})
        found = [(b["a"].to_pylist(), b["others"].to_pylist()) for batch in cell.to_batches() for b in _compare_cells([batch], 62, 85, 100)]
        assert found == listed


def test_keep_one_drops_repeated_rows(spark, docs):
    ids = [r.doc_id for r in keep_one(spark, docs).collect()]
    assert ids.count(5) == 1 and ids.count(3) == 1 and 6 not in ids and 7 not in ids


def test_pipeline_removes_near_copies_from_080_on(spark):
    """Sets of 100 shingles of which the last few change: 0.80 to below 0.85 goes as well, less stays."""
    pipeline, rows = pytest.importorskip("corpus_pipeline"), []
    for i, changed in enumerate((8, 9, 10, 11, 12, 14)):
        words = [f"g{i}w{k}" for k in range(104)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words[: 104 - changed], *(f"new{k}" for k in range(changed))]))]
    sets = dict((d, shingles(t)) for d, t in rows)
    gone = {d for d in sets if d % 2 and 100 * len(sets[d] & sets[d - 1]) >= 80 * len(sets[d] | sets[d - 1])}
    assert gone == {1, 3, 5, 7}
    left = pipeline.distinct(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert {r.doc_id for r in left.collect()} == set(sets) - gone


def test_top_k(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.randrange(-300, 300) / 256 if rnd.random() < 0.7 else 0.0 for _ in range(8)]) for i in range(300)]
    rows += [(300, None), (301, [None] * 8), (302, [float("nan")] * 8), (303, [float("inf")] * 8), (None, [1.0] * 8), (10, rows[10][1]), (304, [0.5, 0.5]), (305, [])]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, label int, score int")
    import math

    sound = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, a in dict(x for x in sound if x[0] % 50 == 0).items():
        best = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in sound if i != q))[:5]  # noqa: B905
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    got = sorted(tuple(r) for r in top_k(spark, frame, F.col("vec_id") % 50 == 0).collect())
    assert got == sorted(want)
    assert top_k(spark, frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_with_large_components(spark):
    """Finite values of any size are ranked exactly; only a best score beyond 64 bits is refused."""
    rows = [(0, [1.0, 2.0]), (1, [2.0**45, 0.0]), (2, [2.0**45, 2.0**-8]), (3, [-(2.0**60), 1.0]), (4, [3.0, 3.0]), (5, [-1e300, 0.0]), (6, [0.5, 0.25])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r)[1:] for r in top_k(spark, frame, F.col("vec_id") == 0, k=4).orderBy("rank").collect()]
    assert got == [(1, 2, 2**61 + 512), (2, 1, 2**61), (3, 4, 256 * 256 * 9), (4, 6, 256 * 128 + 512 * 64)]
    with pytest.raises(Exception, match="outside 64-bit"):
        top_k(spark, frame, F.col("vec_id") == 0, k=5).collect()


def test_warc_round_trip(spark):
    pages = [(1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (3, None, None), (4, "http://a/4\nx", ""), (5, "u", "hé" * 100_000), (2, "http://a/2", "<p>one</p>"), (None, "u", "<p>one</p>"), (None, "u", "alone")]
    frame = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, sha string, first int")
    rows = warc_round_trip(spark, frame).collect()
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in rows) == sorted((str(i), len((h or "").encode()), digest(h)) for i, _, h in pages)
    kinds = sorted((str(r.page_id), r.record_type, str(r.refers_to)) for r in rows)
    assert kinds == sorted([("1", "response", "None"), ("2", "revisit", "1"), ("2", "revisit", "1"), ("None", "revisit", "1"), ("3", "response", "None"), ("4", "revisit", "3"), ("5", "response", "None"), ("None", "response", "None")])
    large = warc_round_trip(spark, frame, min_bytes=100).collect()
    assert {r.record_type for r in large if r.payload_bytes < 100} == {"response"}
    assert warc_round_trip(spark, frame.limit(0)).count() == 0


def test_warc_keeps_one_response_of_each_payload_of_one_split(spark):
    """4,000 pages with 100 payloads in one split, a third of them rows that repeat a page_id, url and payload."""
    rnd = random.Random(8)
    pages = [(i, f"http://h/{i}", f"<p>payload {rnd.randrange(100)}</p>") for i in range(2600)]
    pages += [pages[0]] * 700 + [(None, "http://none", "<p>payload 7</p>")] * 350 + [(None, "http://none", "<p>only null ids</p>")] * 350
    rnd.shuffle(pages)
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    rows = warc_round_trip(spark, frame).collect()
    assert len(rows) == len(pages)
    least = {}
    for i, _, h in pages:
        least[h] = min(least.get(h, 10**9), 10**8 if i is None else i)
    by_digest = {base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(): i if i < 10**8 else None for h, i in least.items()}
    responses = [(r.payload_digest, r.page_id) for r in rows if r.record_type == "response"]
    assert sorted(map(str, responses)) == sorted(map(str, by_digest.items()))
    assert all(r.refers_to == by_digest[r.payload_digest] for r in rows if r.record_type == "revisit")
    tiny = warc_round_trip(spark, frame, min_bytes=17).collect()
    assert sum(r.record_type == "response" for r in tiny) == sum(len(h) < 17 for _, _, h in pages) + sum(len(h) >= 17 for h in least)


def test_warc_reader_refuses_damage():
    good = record_bytes(7, "http://x", b"payload", True, None)
    assert [r["payload_bytes"] for r in read_records(io.BytesIO(good + good))] == [7, 7]
    for bad in (good[:-4], good[:10], b"plain text, no gzip member at all"):
        with pytest.raises(WarcError):
            list(read_records(io.BytesIO(bad)))
    import zlib

    raw = zlib.decompress(good, 31).replace(b"payload", b"paylord")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    with pytest.raises(WarcError, match="digest"):
        list(read_records(io.BytesIO(packer.compress(raw) + packer.flush())))


def test_pipeline(spark, docs, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    pytest.importorskip("public_tokenizers")
    rnd = random.Random(11)
    rows, labels = [(i, t) for i, t in nasty() if i is not None], []
    for i in range(100, 500):
        bad = i % 4 == 0
        words = prose(rnd, 80).split()
        for k in range(3 * bad):
            words[7 * k] = rnd.choice(["rotten", "vilest", "wretched"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stage, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, f in pipeline.STAGES:
        before = stage.columns
        out = f(spark, stage, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        stage = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = sorted(r.doc_id for r in stage.select("doc_id").collect())
        assert name == pipeline.STAGES[-1][0] or stage.columns == before
    assert len(pipeline.STAGES) == 4 and 11 not in kept["quality rules"] and 5 in kept["quality rules"]
    clean = [i for i in kept["toxicity"] if i >= 100]
    assert sum(i % 4 == 0 for i in clean) <= 3 and len(clean) >= 290
    texts = dict(rows)
    left = brute_components([(i, texts[i]) for i in kept["toxicity"]])
    assert sorted(set(kept["near duplicates"])) == sorted({d for d, _, _, k in left if k})
    assert sorted(set(kept["best-fit packing"])) == sorted(set(kept["near duplicates"]))
    assert pipeline.run(spark, str(tmp_path)).count() == len(kept["best-fit packing"])
