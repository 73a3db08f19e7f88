"""Language model, rules, toxicity and licenses against brute force and SQL."""

import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeweave.llm import queries
from lakeweave.llm.common import crc_bucket
from lakeweave.llm.elias_fano import EliasFano
from lakeweave.llm.licenses import license_scan
from lakeweave.llm.ngram_lm import DISCOUNT, STEPS, collapse, lm_scores
from lakeweave.llm.quality_rules import SYMBOLS, keep_good, quality_rules
from lakeweave.llm.toxicity import ratios, toxicity
from tests.llm.conftest import nasty, prose


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=300), st.lists(st.integers(0, 5000), max_size=50))
def test_elias_fano(values, asked):
    values = np.array(sorted(values), np.uint64)
    ef = EliasFano.build(values, 5001)
    assert (ef[np.arange(len(values))] == values).all()
    place, hit = ef.successor(np.array(asked, np.uint64))
    for x, p, h in zip(asked, place, hit, strict=True):
        assert h == (x in set(values.tolist()))
        assert not h or values[p] == x
        assert len(values) == 0 or p == np.searchsorted(values, x)


def is_held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def brute_scores(rows, order):
    """Interpolated absolute discounting from plain counters; n-grams hold at most one begin mark (1), the end is 0."""
    words = lambda t: [1, *(t or "").encode().lower().split(), 0]
    grams, context, follow = Counter(), Counter(), Counter()
    for doc_id, text in rows:
        if not is_held(doc_id):
            w = words(text)
            for i in range(1, len(w)):
                for k in range(min(order, i + 1)):
                    grams[tuple(w[i - k : i + 1])] += 1
    for g, c in grams.items():
        context[g[:-1]] += c
        follow[g[:-1]] += 1
    n, v, want = context[()], follow[()], []
    for doc_id, text in rows:
        w, base, score, known = words(text), 0.0, 0.0, 0
        for i in range(1, len(w)):
            c = grams[(w[i],)]
            base += math.log10((c + 1) / (n + v + 1))
            known += c > 0
            p = max(c - DISCOUNT, 0) / n + DISCOUNT * v / n / (v + 1)
            for k in range(1, min(order, i + 1)):
                before = tuple(w[i - k : i])
                if context[before]:
                    p = max(grams[(*before, w[i])] - DISCOUNT, 0) / context[before] + DISCOUNT * follow[before] / context[before] * p
            score += math.log10(p)
        want.append((doc_id, len(w) - 1, known, base, score))
    return n, want


@pytest.mark.parametrize(("order", "mass"), [(3, 4_000_000), (3, 300), (2, 1000), (4, 700)])
def test_lm_scores(spark, docs, no_docs, order, mass):
    """Small masses make many shards and split heavy contexts over several."""
    n, want = brute_scores(nasty(), order)
    got = lm_scores(spark, docs, crc_bucket(F.col("doc_id"), 7) == 2, order=order, mass=mass).collect()
    keyed = lambda rows: sorted(rows, key=lambda r: (str(r[0]), r[1], r[3]))
    for g, w in zip(keyed(tuple(r)[:5] for r in got), keyed(want), strict=True):
        assert g[:3] == w[:3]
        assert abs(g[3] - w[3]) < 1e-6 * max(1, abs(w[3]))
        # Each level's values are rounded down by up to a step.
        assert -1e-6 * max(1, abs(w[4])) <= w[4] - g[4] <= (order + 0.5) * w[1] / STEPS
    assert {r.train_tokens for r in got} == {n}
    if mass == 300:
        assert lm_scores(spark, no_docs, F.lit(False)).count() == 0
        assert [r.score for r in lm_scores(spark, docs.limit(2), F.lit(True)).collect()] == [0.0, 0.0]


def test_pairs_collapse_alike_on_both_paths():
    """Keys that fit 64 bits and keys that don't."""
    rnd = np.random.default_rng(3)
    c, t, n = rnd.integers(0, 50, 2000), rnd.integers(0, 40, 2000), rnd.integers(1, 9, 2000)
    for counts in (None, n):
        for a, b in zip(collapse(c, t, counts, 41), collapse(c, t, counts, 2**63), strict=True):
            assert (a == b).all()


def oracle(sql, rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [list(r) for r in rows])
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    return names, found.fetchall()


def test_quality_rules(spark, docs, no_docs):
    want = []
    for doc_id, text in nasty():
        text = text or ""
        w, lines = text.encode().split(), [x for x in text.split("\n") if x.encode().split()]
        seen = {}
        for i in range(len(w) - 4):
            seen.setdefault(tuple(w[i : i + 5]), []).append(i)
        cover = {i + k for places in seen.values() if len(places) > 1 for i in places for k in range(5)}
        want.append((doc_id, len(w), sum(len(x.decode()) for x in w), sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), len(cover), len(w) < 10 or 100 * len(cover) > 20 * len(w)))
    got = quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert sorted((tuple(r)[:7] for r in got), key=str) == sorted(want, key=str)
    kept = {r.doc_id: r.kept for r in got}
    assert kept[5] and kept[9] and not kept[11] and not kept[0]
    names, rows = oracle(queries.oracle_sql()["op2_quality_rules"], nasty())
    at = names.index("doc_id"), names.index("kept")
    assert sorted((str(r[at[0]]), r[at[1]]) for r in rows) == sorted((str(r.doc_id), r.kept) for r in got)
    assert quality_rules(no_docs).count() == 0
    good = keep_good(docs)
    assert good.columns == docs.columns and good.count() == sum(r.kept for r in got)


def test_word_lists_and_gibberish_go_and_other_scripts_stay(spark):
    import random

    rnd = random.Random(12)
    letters = lambda: "".join(rnd.choice("abcdefghijklmnoprstuvw") for _ in range(rnd.randint(3, 9)))
    running = " ".join(rnd.choice(["the", "of", "and", "to", "in", *(letters() for _ in range(20))]) for _ in range(300)) + "."
    rows = [(1, " | ".join(letters() for _ in range(200))), (2, " ".join(letters() for _ in range(300))), (3, running), (4, " ".join(letters() for _ in range(40))), (5, " ".join("слово" + chr(0x430 + i % 30) + chr(0x430 + i // 30) for i in range(300)))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.kept for r in quality_rules(frame).collect()} == {1: False, 2: False, 3: True, 4: True, 5: True}


def test_toxicity(spark, docs, no_docs):
    import random

    rnd = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        words = prose(rnd, 60).split()
        for k in range(3 * bad):
            words[7 * k] = rnd.choice(["Rotten,", "vilest", "wretched."])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    labels += [(1, 1, None), (None, 1, 1), (10**9, 1, 1)]
    found = toxicity(spark, spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(found) == 600 and all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert len(held) == sum(zlib.crc32(str(i).encode()) % 5 == 0 for i in range(600))
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.97 * len(held)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = toxicity(spark, docs, none).collect()
    assert len(odd) == len(nasty()) and {r.predicted for r in odd} == {0}
    assert toxicity(spark, no_docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0


def brute_toxicity(rows, labels):
    """The classifier anew: n-grams cut one by one, counts in dictionaries, Newton's method on a dense matrix."""
    from lakeweave.llm.toxicity import BITS, LEAST_Z, ORDERS

    def bag(text):
        chars = [c.lower() if c.lower().isalnum() and len(c.lower()) == 1 else c if c.isalnum() else " " for c in text]
        out = set()
        for n in ORDERS:
            for i in range(len(chars) - n + 1):
                x = 0
                for c in chars[i : i + n]:
                    x = (x * 0x100000001B3 + ord(c)) % 2**64
                out.add(max(1, (x * (0x9E3779B97F4A7C15 + 2 * n) % 2**64) >> (64 - BITS)))
        return out

    bags = {i: bag(t or "") for i, t in rows}
    taught = {i: t for i, t in labels if zlib.crc32(str(i).encode()) % 5}
    n = [sum(t == k for t in taught.values()) for k in (0, 1)]
    counts = [Counter(b for i, t in taught.items() if t == k for b in bags[i]) for k in (0, 1)]
    r = {}
    for b in {*counts[0], *counts[1]}:
        q, p = counts[0][b] / n[0], counts[1][b] / n[1]
        both = (counts[0][b] + counts[1][b]) / sum(n)
        if abs(p - q) >= LEAST_Z * math.sqrt(max(both * (1 - both), 1e-12) * (1 / n[0] + 1 / n[1])) and counts[0][b] + counts[1][b] >= 5:
            r[b] = math.log((counts[1][b] + 0.5) / (n[1] + 1)) - math.log((counts[0][b] + 0.5) / (n[0] + 1))
    used = sorted(r)
    row = lambda i: [r[b] * (b in bags[i]) for b in used] + [1.0]
    x, y, w = np.array([row(i) for i in taught]), np.array(list(taught.values()), float), np.zeros(len(used) + 1)
    ridge = np.append(np.ones(len(used)), 0.0)
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(ridge + 1e-9), x.T @ (p - y) + ridge * w)
        w -= step / max(1.0, np.abs(step).max())
    return {i: 1 / (1 + math.exp(-float(np.array(row(i)) @ w))) for i, _ in rows}


def test_toxicity_against_a_plain_refit(spark):
    import random

    rnd = random.Random(9)
    rows = [(i, " ".join([*prose(rnd, 12).split(), *(rnd.choice(["Rotten,", "ÜBEL", "vile-one"]) for _ in range(2 * (i % 3 == 0)))])) for i in range(150)]
    rows += [(150, ""), (151, None), (152, "Rotten " * 400)]
    again = [(3, "~ " + rows[3][1]), (1, "~ rotten rotten")] * 50  # repeated ids teach once
    labels = [(i, int(i % 3 == 0)) for i in range(150)]
    want = brute_toxicity(rows, labels)
    found = toxicity(spark, spark.createDataFrame(rows + again, "doc_id long, text string"), spark.createDataFrame([(i, 1, t) for i, t in labels], "doc_id long, quality int, toxic int")).collect()
    assert {r.doc_id for r in found} == set(want) and len(found) == len(rows + again)
    for r in found:
        if r.doc_id in (1, 3):
            continue
        assert abs(r.score - want[r.doc_id]) < 0.01, (r.doc_id, r.score, want[r.doc_id])
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_toxicity_learns_rare_words_from_documents_that_exist(spark):
    """Eight words, each in an eighth of the toxic documents; three labels of four name no document."""
    import random

    rnd = random.Random(6)
    words = "rotten vilest wretched putrid hideous loathsome squalid ghastly".split()
    rows = [(i, " ".join([*prose(rnd, 40).split(), *([words[i // 2 % 8]] if i % 2 else [])])) for i in range(480)]
    labels = [(i, 1, i % 2) for i in range(1920)]
    found = toxicity(spark, spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), per_class=150).collect()
    held = [r for r in found if r.held_out]
    assert sum(r.predicted == r.doc_id % 2 for r in held) >= 0.95 * len(held)


def test_ratios_keep_rare_buckets():
    toxic, clean = np.array([9, 12, 4, 30, 1250]), np.array([0, 0, 0, 5, 1250])
    assert (ratios(toxic, clean, 2500, 2500) != 0).tolist() == [True, True, False, True, False]


def test_license_scan(spark, docs, no_docs):
    extra = [(100, "x " * 50 + "permission is hereby granted free of charge to any person obtaining one copy of this software and associated documentation files y"), (101, "MITK license mit-license"), (102, "licensed under the stars and the moon")]
    rows = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    found = license_scan(spark, rows).collect()
    names, want = oracle(queries.oracle_sql()["op10_license_scan"], nasty() + extra)
    got = [tuple(r[n] for n in names) for r in found]
    clean = lambda rows: sorted([tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows], key=str)
    assert clean(got) == clean(want)
    by_id = {r.doc_id: r for r in found}
    assert by_id[100].labels == "mit" and by_id[100].base_labels == "" and by_id[13].n_base == 3
    assert by_id[14].labels == "apache" and by_id[101].n_base == 1 and by_id[102].labels == "" and by_id[0].labels == ""
    assert license_scan(spark, no_docs).count() == 0


def test_license_bodies_are_told_apart(spark):
    """Whole texts, parts of them and edited copies get their own label only, although disclaimers are shared."""
    from lakeweave.llm.license_texts import TEXTS

    whole: dict[str, str] = {}
    for label, text in TEXTS:
        whole[label] = whole.get(label, "") + "\n" + text
    rows, want = [], {}
    for i, (label, text) in enumerate(whole.items()):
        words = text.split()
        edited = [w if k % 23 else "changed" for k, w in enumerate(words)]
        rows += [(3 * i, text.upper()), (3 * i + 1, "before it " * 30 + text + " after it" * 30), (3 * i + 2, " ".join(edited) if len(words) > 60 else text)]
        want |= {3 * i + k: label for k in range(3)}
    mit = whole["mit"].split()
    rows += [(900, " ".join(mit[-70:])), (901, "under the terms of the contract and subject to the following conditions you may use this software for any purpose")]
    want |= {900: "mit", 901: ""}
    found = {r.doc_id: r for r in license_scan(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # "Lesser general public license" holds a base phrase of another label.
    own = lambda d: {want[d], *found[d].base_labels.split(",")} - {""}
    wrong = {d: found[d].labels for d in want if own(d) != {*found[d].labels.split(",")} - {""}}
    assert not wrong, wrong
