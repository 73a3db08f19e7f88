"""J3 against brute force, and what its tasks hand on."""

import random
import re

import pytest

from lakeweave.functions.text import STOPWORDS
from lakeweave.operators import search as J
from lakeweave.plans import queries as plans

QUESTIONS, CHUNKS = "id string, question string, expected array<string>", "chunk_id long, text string"


def tokens(text):
    return {w.lower() for w in re.findall("[A-Za-zА-Яа-яЁё0-9]{3,}", text or "")} - set(STOPWORDS)


def brute_force(questions, chunks, k):
    out = []
    for id, question, expected in questions:
        terms = set() if question is None and expected is None else tokens(question).union(*map(tokens, expected or []))
        found = [(len(terms & tokens(text)), sum(e is not None and e.lower() in text.lower() for e in expected or []), len(text), c) for c, text in chunks if text is not None]
        shares = any(o for o, *_ in found)
        ranked = sorted((-(o + 3 * h), -h, -n, c) for o, h, n, c in found if (o > 0) == shares and o + 3 * h > 0)
        out += [(id, i + 1, c, -s, -h) for i, (s, h, _, c) in enumerate(ranked[:k])]
    return sorted(out)


@pytest.mark.parametrize(("pairs", "parts"), [(1, 3), (40, 1), (1 << 18, 4)])
def test_retrieval_equals_brute_force(spark, monkeypatch, pairs, parts):
    monkeypatch.setattr(J, "PAIRS", pairs)
    r = random.Random(pairs)
    words = ["copper", "Cable", "tray", "steel", "ёлка", "the", "al", "ЖЁЛТЫЙ", "x1", "aluminium", "wire 220"]
    chunks = [(i, " ".join(r.choices(words, k=r.randint(0, 6)))) for i in r.sample(range(10_000), 150)] + [(10_000 + i, "copper cable tray") for i in range(40)] + [(20_000, None), (20_001, "")]
    questions = [(f"q{i}", " ".join(r.choices(words, k=3)), r.choices([*words, None], k=r.randint(0, 3))) for i in range(25)]
    # These share no term with any chunk.
    questions += [("sub", "zzz", ["lumini", "AL"]), ("none", "zzz", ["qqq"]), ("empty", "zzz", [""]), ("no", None, ["opp"]), ("null", "copper", None)]
    r.shuffle(chunks)
    got = J.retrieval_scores(spark.createDataFrame(questions, QUESTIONS), spark.createDataFrame(chunks, CHUNKS).repartition(parts), 4)
    assert got.dtypes == [("id", "string"), ("rank", "int"), ("chunk_id", "bigint"), ("score", "bigint"), ("hits", "int")]
    expected = [row for row in brute_force(questions, chunks, 4) if row[0] != "null"]
    assert sorted(map(tuple, got.collect())) == expected and {"sub", "empty", "no"} <= {row[0] for row in expected}


def test_retrieval_of_nothing(spark):
    asked, chunks = spark.createDataFrame([("q", "copper", ["c"])], QUESTIONS), spark.createDataFrame([(1, "copper")], CHUNKS)
    assert J.retrieval_scores(asked.limit(0), chunks).count() == 0
    assert J.retrieval_scores(asked, chunks.limit(0)).count() == 0
    assert J.retrieval_scores(asked, chunks, 0).count() == 0
    assert tuple(J.hit_rate(asked, J.retrieval_scores(asked, chunks.limit(0))).first())[:2] == (1, 0)


def handed_on(spark, group, run):
    """The most rows that a stage of ``run`` wrote for a shuffle."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker, store = spark.sparkContext.statusTracker(), spark._jsc.sc().statusStore()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds if tracker.getStageInfo(s)}
    return max(store.lastStageAttempt(s).shuffleWriteRecords() for s in stages)


def test_tasks_hand_on_the_best_only(spark):
    """Every question shares a word with every chunk; tasks may hand on the best of each, not all pairs."""
    asked = spark.range(10).selectExpr("cast(id AS string) AS id", "concat('copper number', id) AS question", "array('cable') AS expected")
    chunks = spark.createDataFrame(spark.sparkContext.parallelize([(i, f"copper cable {i}") for i in range(3000)], 3), CHUNKS)
    assert 0 < handed_on(spark, "j3 scores", lambda: J.retrieval_scores(asked, chunks).collect()) <= 3 * 10 * 5
    assert 0 < handed_on(spark, "j3 rate", lambda: J.hit_rate(asked, J.retrieval_scores(asked, chunks)).collect()) <= 3 * 10 * 5


def test_hit_rate_equals_brute_force(spark):
    r = random.Random(24)
    words = ["copper", "cable", "tray", "steel", "wire"]
    questions = [(f"q{i}", " ".join(r.choices(words, k=2)), r.choices(words, k=2)) for i in range(20)] + [("lost", "zzz", ["opp"]), ("none", "zzz", ["qqq"])]
    chunks = [(i, " ".join(r.choices(words[:3], k=2))) for i in range(60)]
    asked = spark.createDataFrame(questions, QUESTIONS)
    hit = {row[0] for row in brute_force(questions, chunks, 5) if row[4] > 0}
    assert 0 < len(hit) < 22 and "lost" in hit
    assert tuple(J.hit_rate(asked, J.retrieval_scores(asked, spark.createDataFrame(chunks, CHUNKS))).first())[:2] == (22, len(hit))


def test_hit_rate_hands_on_no_more_for_more_documents(spark, tmp_path):
    """the query's tasks on ten times the documents, in as many files, hand on as many rows."""
    files, found = spark.sparkContext.defaultParallelism, []
    for n in (30, 300):
        spark.range(10).selectExpr("id AS item_id", "concat('copper cable number', id) AS text").write.parquet(f"{tmp_path}/{n}/benchmark.parquet")
        spark.range(n * files).selectExpr("id AS doc_id", "concat('copper cable ', id) AS text").repartition(files, "doc_id").write.parquet(f"{tmp_path}/{n}/documents.parquet")
        found.append(handed_on(spark, f"j3 rate of {n}", lambda n=n: plans.QUERIES["j3_hit_rate"](spark, f"{tmp_path}/{n}").collect()))
    assert found[0] == found[1] > 0
