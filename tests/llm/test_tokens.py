"""Encoders and token files against the library itself, and exact round trips."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import nasty
from lakeweave.llm.bpe import Decoder, Merges, Stream, TokenTable, TransducerEncoder, encode_decode, windows
from lakeweave.llm.packing import best_fit_pack, plan
from lakeweave.llm.simple8b import decode_words, encode_blocks
from lakeweave.llm.token_files import token_files
from lakeweave.llm.tokens import ChunkEncoder

NAMES = ("word_bpe_49k.json", "byte_bpe_50k.json")


def library(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def odd_texts():
    rnd = random.Random(1)
    parts = [*"aAb Σςİ\n\t'stre<|>09½漢ß́,.!\U0001f642", " ", " ", "\x1c", "<|endoftext|>", "'re", "  "]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(1500)] + [t for _, t in nasty() if t is not None]


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("kind", [ChunkEncoder, TransducerEncoder])
def test_encoders_equal_the_library(tokenizer, name, kind):
    texts = odd_texts()
    want = library(tokenizer(name)).encode_batch(texts, add_special_tokens=False)
    for at, off, ids in kind(tokenizer(name), cache=100).encode_column(pa.array(texts), most=3000):
        for i in range(len(off) - 1):
            assert want[at + i].ids == ids[off[i] : off[i + 1]].tolist(), texts[at + i]


@pytest.mark.parametrize("name", NAMES)
def test_decoding_in_small_blocks(tokenizer, name):
    lib, table = library(tokenizer(name)), TokenTable(tokenizer(name))
    for text in odd_texts()[:300]:
        ids = np.array(lib.encode(text, add_special_tokens=False).ids, np.uint32)
        machine = Decoder(table)
        got = b"".join(machine.feed(ids[k : k + 3], k + 3 >= len(ids)) for k in range(0, len(ids), 3))
        assert got.decode() == lib.decode(ids.tolist(), skip_special_tokens=False)


@settings(max_examples=60, deadline=None)
@given(st.text("abc", min_size=1, max_size=400))
def test_stream_equals_merging(text):
    merges = Merges({"a": 0, "b": 1, "c": 2, "ab": 3, "bc": 4, "aab": 5, "cc": 6, "bcc": 7}, [["a", "b"], ["b", "c"], ["a", "ab"], ["c", "c"], ["b", "cc"]])
    stream, out = Stream(merges), []
    for i in range(0, len(text), 7):
        out += stream.feed(text[i : i + 7])
    out += stream.finish()
    assert [merges.name[t] for t in out] == merges.merge(list(text))
    assert stream.most <= 2 * (merges.lookahead + merges.longest) + 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**59), max_size=1200), st.integers(1, 60))
def test_simple8b_round_trip(values, bits):
    ids = np.array([v & ((1 << bits) - 1) for v in values], np.uint64)
    words, per_block = encode_blocks(ids)
    assert per_block.sum() == len(words)
    assert (decode_words(words) == ids).all()


def test_token_files(spark, docs, no_docs, tokenizer):
    lib = library(tokenizer(NAMES[0]))
    rows = sorted(nasty(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, at = [], 0
    for doc_id, text in rows:
        ids = [*lib.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = [tuple(r) for r in token_files(spark, docs, tokenizer(NAMES[0]), 1).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    assert token_files(spark, no_docs, tokenizer(NAMES[0]), 1).count() == 0


def test_token_files_split_an_id_that_most_rows_share(spark, tokenizer, tmp_path):
    rows = [(None, f"{i % 40} row of a hot id {i}") for i in range(400)] + [(7, "same words")] * 400 + [(i, f"text {i}") for i in range(100)]
    folder = f"file://{tmp_path}/hot"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = token_files(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4), tokenizer(NAMES[0]), 1, folder).orderBy("start").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ids = [r.doc_id for r in got]
    assert ids == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0)) and len(got) == len(rows)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:], strict=False))
    assert len(list((tmp_path / "hot").glob("*.s8b"))) == 4


def test_encode_decode(spark, docs, no_docs, tokenizer):
    import hashlib

    lib = library(tokenizer(NAMES[0]))
    want = []
    for doc_id, text in nasty():
        ids = lib.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    order = lambda rows: sorted(map(tuple, rows), key=str)
    assert order(encode_decode(docs, tokenizer(NAMES[0]), block=64).collect()) == order(want)
    assert encode_decode(no_docs, tokenizer(NAMES[0])).count() == 0


@pytest.mark.parametrize("name", NAMES)
def test_windows_of_long_texts(tokenizer, name):
    """Texts cut into small windows get the library's ids, and every piece goes through the transducer."""
    texts = odd_texts()[1480:]
    encoder, want, got = TransducerEncoder(tokenizer(name)), library(tokenizer(name)), []
    held: list[int] = []
    for off, ids, whole in windows(encoder, pa.array(texts), most=700):
        for a, b in zip(off[:-1], off[1:], strict=True):
            held += ids[a:b].tolist()
            if whole:
                got.append(held)
                held = []
    assert got == [e.ids for e in want.encode_batch(texts, add_special_tokens=False)]
    stream = Stream(encoder.merges)
    for _ in range(400):
        stream.feed("haha" * 64)
        assert len(stream.text) <= stream.bound == 2 * (encoder.merges.lookahead + encoder.merges.longest)
    stream.finish()


def best_fit_decreasing(lengths, capacity):
    import bisect

    gaps, n = [], 0
    for length in sorted(lengths, reverse=True):
        i = bisect.bisect_left(gaps, length)
        if i < len(gaps):
            gap = gaps.pop(i) - length
        else:
            n, gap = n + 1, capacity - length
        bisect.insort(gaps, gap)
    return n


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=300), st.integers(50, 120))
def test_plan_is_best_fit_decreasing(lengths, capacity):
    counts = {k: lengths.count(k) for k in set(lengths)}
    intervals, n = plan(counts, capacity)
    assert n == best_fit_decreasing(lengths, capacity)
    assert sum(1 for _ in intervals) <= 4 * len(counts) + len(lengths)


def test_packing(spark, docs, no_docs, tokenizer):
    lib, capacity = library(tokenizer(NAMES[1])), 256
    want, lengths = [], []
    for doc_id, text in nasty():
        ids = [*lib.encode(text or "", add_special_tokens=False).ids, 2]
        at, piece, head = 0, 0, len(ids) % capacity or capacity
        while at < len(ids):
            n = head if piece == 0 else capacity
            want.append((doc_id, piece, at, n, zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes())))
            lengths.append(n)
            at, piece = at + n, piece + 1
    got = best_fit_pack(spark, docs, tokenizer(NAMES[1]), 2, capacity).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, n in sorted(places):
            assert offset == end
            end += n
        assert end <= capacity
    assert len(sequences) == best_fit_decreasing(lengths, capacity)
    assert best_fit_pack(spark, no_docs, tokenizer(NAMES[1]), 2, capacity).count() == 0
