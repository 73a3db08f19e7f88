"""License scans by diagonal voting, in DataFrame operations only.

Every rolling k-gram of a document's words is hashed and joined to the k-grams of the templates. A match
votes for its diagonal: its place in the document less its place in the template. Votes are aggregated by
document, template and diagonal before they are shuffled; neighbouring diagonals (words put in or left out)
merge into one span; a span is verified when its distinct template k-grams, whose words have been compared
and not their hashes alone, cover enough of the template's stretch between its ends and enough words, and when
enough of them are in no other license's text, as disclaimers are shared. Fixed phrases give the base labels.

The templates are a fixed list (``license_texts``), so the broadcast side has a fixed size of about 2,000
rows whatever the documents.

Cases: a null text is empty: no words, no places, empty label strings and score 0. Texts shorter than k
words have no k-grams. Equal rows get equal results. Null ids stay null. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweave.llm.common import spread
from lakeweave.llm.license_texts import templates

K = 3
#: Words that stand next to each other, and their label.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Runs of other characters than letters, digits and those beyond ASCII, after lower-casing.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def grams_of_templates(k: int = K) -> list[tuple]:
    """(template, label, gram, place, words, own, own_in_all) for every k-gram; own: no other label's text has it."""
    listed = [(i, label, " ".join(w[p : p + k]), p, len(w)) for i, (label, w) in enumerate(templates()) for p in range(len(w) - k + 1)]
    labels: dict[str, set[str]] = {}
    for _, label, gram, _, _ in listed:
        labels.setdefault(gram, set()).add(label)
    n_own = Counter(i for i, _, gram, _, _ in listed if len(labels[gram]) == 1)
    return [(i, label, gram, p, n, len(labels[gram]) == 1, n_own[i]) for i, label, gram, p, n in listed]


def template_grams(spark: SparkSession, k: int = K) -> DataFrame:
    """The k-grams of the templates with their hashes: a table whose size is fixed by the list of texts."""
    listed = spark.createDataFrame(grams_of_templates(k), "template int, label string, t_gram string, t_place int, t_words int, own boolean, t_own int")
    return listed.select(F.xxhash64("t_gram").alias("h"), *listed.columns)


def license_scan(spark: SparkSession, docs: DataFrame, k: int = K, drift: int = 3, share: float = 0.6, least_words: int = 12, least_own: int = 4) -> DataFrame:
    """Base places and labels for docs (doc_id, text). drift: how far apart diagonals of one span may be; share and
    least_words: how much of its template stretch, and how many words (all of a shorter template), a span must cover;
    least_own: how many k-grams of no other label it must hold (all, if the template has fewer)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")))
    # The Kelvin sign would become an ASCII k; only A-Z may change into ASCII letters.
    lowered = F.lower(F.replace("text", F.lit("\u212a"), F.lit("\u0138")))
    words = rows.select("doc_id", F.xxhash64("text").alias("mark"), F.filter(F.split(lowered, BREAK), lambda w: w != "").alias("words"))

    def places(phrase: str) -> str:
        parts = phrase.split()
        test = " AND ".join(f"words[i + {j}] = '{p}'" for j, p in reversed(list(enumerate(parts))))
        return f"CASE WHEN size(words) >= {len(parts)} AND array_contains(words, '{parts[-1]}') THEN filter(sequence(0, size(words) - {len(parts)}), i -> {test}) ELSE array() END"

    labels = list(PHRASES.values())
    base = words.selectExpr("doc_id", "mark", "CAST(size(words) AS LONG) AS n_words", *(f"{places(p)} AS at_{label}" for p, label in PHRASES.items()))
    all_places = "concat(" + ", ".join(f"at_{x}" for x in labels) + ")"
    found = ", ".join(f"CASE WHEN size(at_{x}) > 0 THEN '{x}' END" for x in labels)
    base = base.selectExpr("doc_id", "mark", "n_words", f"CAST(size({all_places}) AS LONG) AS n_base", f"CAST(array_min({all_places}) AS LONG) AS first_word", f"CAST(array_max({all_places}) AS LONG) AS last_word", f"array_compact(array({found})) AS own")

    gram = "concat_ws(' ', " + ", ".join(f"words[i + {j}]" for j in range(k)) + ")"
    grams = words.selectExpr("doc_id", "mark", f"posexplode(CASE WHEN size(words) >= {k} THEN transform(sequence(0, size(words) - {k}), i -> {gram}) ELSE array() END) AS (place, gram)")
    # Joined by hash; that the words agree is checked on the words themselves.
    votes = grams.withColumn("h", F.xxhash64("gram")).join(F.broadcast(template_grams(spark, k)), "h").where("gram = t_gram")
    diagonals = votes.groupBy("doc_id", "mark", "template", "label", "t_words", "t_own", (F.col("place") - F.col("t_place")).alias("diagonal")).agg(F.collect_set(F.struct("t_place", "own")).alias("hit"))
    near = "PARTITION BY doc_id, mark, template ORDER BY diagonal"
    diagonals = diagonals.withColumn("new", F.expr(f"CASE WHEN diagonal - lag(diagonal) OVER ({near}) <= {drift} THEN 0 ELSE 1 END"))
    diagonals = diagonals.withColumn("span", F.expr(f"sum(new) OVER ({near})"))
    spans = diagonals.groupBy("doc_id", "mark", "template", "label", "t_words", "t_own", "span").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit")))).alias("hits"))
    spans = spans.withColumn("hit", F.col("hits.t_place")).withColumn("n_own", F.size(F.filter("hits", lambda x: x["own"])))
    # Words of the template that the k-grams cover, and the stretch from the first to the last of them.
    spans = spans.withColumn("covered", F.expr(f"aggregate(zip_with(hit, slice(hit, 2, size(hit)), (a, b) -> least({k}, coalesce(b - a, {k}))), 0, (s, x) -> s + x)"))
    spans = spans.withColumn("stretch", F.expr(f"element_at(hit, -1) - element_at(hit, 1) + {k}"))
    sound = spans.where(f"covered >= least(t_words, {least_words}) AND n_own >= least(t_own, {least_own}) AND covered >= {share}D * stretch")
    per_doc = sound.groupBy("doc_id", "mark").agg(F.collect_set("label").alias("more"), F.max(F.col("covered") / F.col("t_words")).alias("score"))
    same = base["doc_id"].eqNullSafe(per_doc["doc_id"]) & (base["mark"] == per_doc["mark"])
    joined = base.join(per_doc, same, "left").select(base["doc_id"], "n_words", "n_base", "first_word", "last_word", "own", "more", "score")
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("own"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("own", F.coalesce("more", F.array().cast("array<string>")))), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
