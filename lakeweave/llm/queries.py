"""Queries of the training-data operators, by the names the driver uses; each covers its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from lakeweave.llm.common import crc_bucket
    from lakeweave.llm.ngram_lm import lm_scores

    held_out = crc_bucket(F.col("doc_id"), 7) == 2
    found = lm_scores(spark, table(spark, sf_dir, "documents"), held_out)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeweave.llm.quality_rules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


def _op2_sql() -> str:
    from lakeweave.llm import quality_rules as q

    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    chars, marks = q.class_marks()
    points = "[" + ", ".join(str(ord(c)) for c in chars) + "]"
    array = lambda rows: "[" + ", ".join("[" + ", ".join(repr(x) for x in r) + "]" for r in rows) + "]"
    common, term = q.common_words(), "(CASE WHEN {0} > 0 THEN {0} * log2(2 * {0} / ({0} + {1})) ELSE 0 END)"
    nearest = lambda h, rows: f"sqrt(greatest(0, list_min(list_transform({array(rows)}, lambda r: list_sum(list_transform(range(1, len(r) + 1), lambda j: ({term.format(h + '[j]', 'r[j]')} + {term.format('r[j]', h + '[j]')}) / 2))))))"
    in_class = ", ".join(f"length(t) - length(regexp_replace(t, '[{''.join(chr(92) + 'x%02x' % ord(c) for c, m in zip(chars, marks, strict=True) if m == k)}]', '', 'g'))" for k in q.CLASSES)
    return rf"""
WITH w AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
grams AS (
  SELECT k, i, words[i:i + 4] AS g FROM w, LATERAL (SELECT unnest(range(1, len(words) - 3)) AS i)),
twice AS (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS c FROM grams),
repeated AS (
  SELECT k, count(DISTINCT i + d) AS n FROM (SELECT k, i FROM twice WHERE c > 1), (SELECT unnest(range(0, 5)) AS d) GROUP BY k),
c AS (
  SELECT w.*, CAST(len(words) AS BIGINT) AS n_words, length(t) AS n_chars, coalesce(repeated.n, 0) AS n_repeat_words,
         [{in_class}] AS in_class,
         list_transform([{", ".join(map(quoted, common))}], lambda x: len(list_filter(words, lambda y: y = x))) AS common
  FROM w LEFT JOIN repeated USING (k)),
h AS (
  SELECT *, list_transform(list_append(in_class, n_chars - list_sum(in_class)), lambda x: x / nullif(n_chars, 0)) AS classes,
         list_transform(list_append(common, n_words - list_sum(common)), lambda x: x / nullif(n_words, 0)) AS shares
  FROM c),
d AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         CASE WHEN n_chars >= 200 AND classes[8] <= 0.5 THEN {nearest("classes", q.class_table())} ELSE 0 END AS far_classes,
         CASE WHEN n_words >= 60 AND classes[8] <= 0.5 THEN {nearest("shares", q.word_table())} ELSE 0 END AS far_words
  FROM h)
SELECT doc_id, n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
       CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
       CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND far_classes <= 0.35 AND far_words <= 0.30 AS kept
FROM d
"""


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeweave.llm.token_files import token_files

    return token_files(spark, table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=1)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeweave.llm.packing import best_fit_pack

    return best_fit_pack(spark, table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=2, capacity=1024)


def op5_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeweave.llm.bpe import encode_decode

    return encode_decode(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeweave.llm.toxicity import toxicity

    return toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeweave.llm.near_dups import near_duplicates

    return near_duplicates(spark, table(spark, sf_dir, "documents"), low=85, high=100, n=5)


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from lakeweave.llm.topk import top_k

    return top_k(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeweave.llm.warc import warc_round_trip

    return warc_round_trip(spark, table(spark, sf_dir, "pages"), min_bytes=0).drop("url")


#: Base 32 of the SHA-1: 160 bits in 32 groups of 5.
OP9_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
bits AS (
  SELECT hex, string_agg(substr('0000000100100011010001010110011110001001101010111100110111101111',
           1 + 4 * (instr('0123456789abcdef', substr(hex, i, 1)) - 1), 4), '' ORDER BY i) AS b
  FROM (SELECT DISTINCT hex FROM p), (SELECT unnest(range(1, 41)) AS i) GROUP BY hex),
digest AS (
  SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * CAST(substr(b, 5 * g + 1, 1) AS INT)
           + 8 * CAST(substr(b, 5 * g + 2, 1) AS INT) + 4 * CAST(substr(b, 5 * g + 3, 1) AS INT)
           + 2 * CAST(substr(b, 5 * g + 4, 1) AS INT) + CAST(substr(b, 5 * g + 5, 1) AS INT), 1), '' ORDER BY g) AS d
  FROM bits, (SELECT unnest(range(0, 32)) AS g) GROUP BY hex),
m AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT m.page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, digest.d AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM m JOIN digest USING (hex)
"""


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeweave.llm.licenses import license_scan

    return license_scan(spark, table(spark, sf_dir, "documents"))


def _op10_sql() -> str:
    from lakeweave.llm.license_texts import templates as license_templates
    from lakeweave.llm.licenses import PHRASES

    templates = ", ".join(f"({i}, '{label}', '{' '.join(words)}')" for i, (label, words) in enumerate(license_templates()))
    phrases = ", ".join(f"('{label}', '{phrase}')" for phrase, label in PHRASES.items())
    return rf"""
WITH w AS (
  SELECT row_number() OVER () AS k, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM documents),
p AS (SELECT label, string_split(phrase, ' ') AS f FROM (VALUES {phrases}) v(label, phrase)),
base AS (
  SELECT k, i, label FROM (SELECT k, words, unnest(range(1, len(words) + 1)) AS i FROM w WHERE list_contains(words, 'license')), p
  WHERE words[i:i + len(f) - 1] = f),
base_of AS (
  SELECT k, count(*) AS n_base, min(i) - 1 AS first_word, max(i) - 1 AS last_word, list_distinct(list(label)) AS own FROM base GROUP BY k),
t AS (SELECT template, label, string_split(words, ' ') AS f FROM (VALUES {templates}) v(template, label, words)),
tgrams AS (SELECT template, label, len(f) AS t_words, i AS t_place, f[i:i + 2] AS g FROM t, LATERAL (SELECT unnest(range(1, len(f) - 1)) AS i)),
shared AS (SELECT g, count(DISTINCT label) = 1 AS own FROM tgrams GROUP BY g),
tg AS (SELECT *, count(*) FILTER (WHERE own) OVER (PARTITION BY template) AS t_own FROM tgrams JOIN shared USING (g)),
dg AS (SELECT k, i AS place, words[i:i + 2] AS g FROM w, LATERAL (SELECT unnest(range(1, len(words) - 1)) AS i)),
votes AS (SELECT DISTINCT k, template, label, t_words, t_own, own, place - t_place AS diagonal, t_place FROM dg JOIN tg USING (g)),
lines AS (SELECT DISTINCT k, template, diagonal FROM votes),
marked AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY k, template ORDER BY diagonal) <= 3 THEN 0 ELSE 1 END AS new FROM lines),
spans AS (SELECT k, template, diagonal, sum(new) OVER (PARTITION BY k, template ORDER BY diagonal) AS span FROM marked),
hits AS (SELECT DISTINCT k, template, label, t_words, t_own, own, span, t_place FROM votes JOIN spans USING (k, template, diagonal)),
steps AS (
  SELECT *, least(3, coalesce(lead(t_place) OVER (PARTITION BY k, template, span ORDER BY t_place) - t_place, 3)) AS step FROM hits),
sound AS (
  SELECT k, label, t_words, sum(step) AS covered FROM steps GROUP BY k, template, label, t_words, t_own, span
  HAVING sum(step) >= least(t_words, 12) AND count(*) FILTER (WHERE own) >= least(t_own, 4) AND sum(step) >= 0.6 * (max(t_place) - min(t_place) + 3)),
more_of AS (SELECT k, list(label) AS more, max(covered / t_words) AS score FROM sound GROUP BY k)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(own), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(own, []), coalesce(more, [])))), ','), '') AS labels,
       coalesce(score, 0.0) AS score
FROM w LEFT JOIN base_of USING (k) LEFT JOIN more_of USING (k)
"""


def queries() -> dict:
    return {
        "op1_lm_scores": op1_lm_scores,
        "op2_quality_rules": op2_quality_rules,
        "op3_token_files": op3_token_files,
        "op4_best_fit_packing": op4_best_fit_packing,
        "op5_bpe_transducer": op5_bpe_transducer,
        "op6_toxicity": op6_toxicity,
        "op7_near_duplicates": op7_near_duplicates,
        "op8_exact_top_k": op8_exact_top_k,
        "op9_warc": op9_warc,
        "op10_license_scan": op10_license_scan,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_quality_rules": _op2_sql(), "op8_exact_top_k": OP8_SQL, "op9_warc": OP9_SQL, "op10_license_scan": _op10_sql()}
