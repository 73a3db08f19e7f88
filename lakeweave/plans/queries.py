"""Queries over the driver's tables, each over the whole table, with the same result in DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from lakeweave.functions import text as T
from lakeweave.functions import urls as U
from lakeweave.operators import chunking as K
from lakeweave.operators import quality as Q
from lakeweave.operators import search as J
from lakeweave.operators import state as S
from lakeweave.sources import discovery as D
from lakeweave.sources import files, markup, rendered
from lakeweave.streaming import queue

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    # A file of one row group is one busy task; text-heavy work is dealt out first.
    return df.repartition(cores) if name in ("documents", "pages") and df.rdd.getNumPartitions() < cores else df


def line_chunks(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Lines of documents as chunks (doc_id, chunk_index, text), with more columns of theirs."""
    rows = table(spark, sf_dir, "documents").select("doc_id", *more, F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("pos", "line"))
    return rows.select("doc_id", *more, F.col("pos").alias("chunk_index"), T.normalize_text("line").alias("text")).where("text <> ''")


def conversation_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations as elements; a system turn is a heading."""
    kind = F.when(F.col("role") == "system", "heading").otherwise("text")
    row = F.when(F.col("text").contains("|"), "table_row").otherwise("")
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("idx"), F.coalesce("text", F.lit("")).alias("text"), kind.alias("element_type"), row.alias("row_type"), F.lit(None).cast("int").alias("page"), F.lit("").alias("section"))


# Pieces of SQL that several oracles share.
_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_NORM = _STRIP.format(r"regexp_replace(regexp_replace(replace({0}, chr(13), ''), '\n{{3,}}', chr(10) || chr(10), 'g'), '[ \t]+', ' ', 'g')")
_LINES = rf"""
raw AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (
  SELECT doc_id, i - 1 AS idx, {_NORM.format("ls[i]")} AS text
  FROM raw, LATERAL (SELECT unnest(range(1, len(ls) + 1)) AS i)),
chunks AS (SELECT * FROM lines WHERE text <> '')
"""
_TOKENS = "CAST(greatest(1, length({0}) // 4) AS INT)"
_FOLD = _STRIP.format(r"regexp_replace(lower(replace({0}, chr(13), '')), '\s+', ' ', 'g')")
_LETTERS = r"(length({0}) - length(regexp_replace({0}, '\p{{L}}', '', 'g')))"
_DIGITS = r"(length({0}) - length(regexp_replace({0}, '\p{{Nd}}', '', 'g')))"
_SYMBOLS = r"(length({0}) - length(regexp_replace({0}, '[^\p{{L}}\p{{N}}\p{{Z}}\p{{Cc}}]', '', 'g')))"
_PIPES = "len(list_filter(string_split({0}, chr(10)), lambda x: contains(x, '|')))"
_ODD = f"({_LETTERS} < 0.45 * length({{0}}) AND ({_SYMBOLS} > 0.18 * length({{0}}) OR {_DIGITS} > 0.40 * length({{0}})))"
_CODES = "((length({0}) - length(replace({0}, '(cid:', ''))) // 5)"
_NOISY = f"({_CODES} > 5 OR (length({{0}}) >= 200 AND (length({{0}}) - length(replace({{0}}, chr(65533), '')) > 0.02 * length({{0}}) OR ({_PIPES} < 2 AND {_ODD}))))"
_NOISY_OLD = f"(length({{0}}) >= 200 AND ({_CODES} > 5 OR ({_PIPES} < 2 AND {_ODD})))"
_PATH = r"regexp_extract({0}, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
_AUTH = r"regexp_extract({0}, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1)"
_DOMAIN = f"replace(lower({_AUTH}), 'www.', '')"
_HREFS = r"""list_transform(regexp_extract_all(coalesce(html, ''), '(?is)<a\b[^>]*?\bhref\s*=\s*("[^"]*"|''[^'']*''|[^\s>]+)', 1), lambda h: regexp_replace(h, '^["'']|["'']$', '', 'g'))"""


@query(f"SELECT doc_id, {_NORM.format('text')} AS text FROM documents")
def b1_normalize_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.normalize_text("text").alias("text"))


@query(
    rf"""WITH p AS (SELECT doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: {_STRIP.format("x")}), lambda x: x <> '') AS ps FROM documents)
SELECT doc_id, i - 1 AS pos, ps[i] AS text FROM p, LATERAL (SELECT unnest(range(1, len(ps) + 1)) AS i)"""
)
def b2_paragraph_blocks(spark, sf_dir):
    doubled = F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit("\n\n"))  # the tables have no empty lines
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(T.paragraphs(doubled)).alias("pos", "text"))


@query(f"SELECT doc_id, {_TOKENS.format(_STRIP.format('text'))} AS tokens FROM documents")
def b3_token_estimate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.count_tokens("text").alias("tokens"))


@query(
    rf"""WITH l AS (SELECT doc_id, text, list_filter(list_transform(string_split(text, chr(10)), lambda x: {_STRIP.format("x")}), lambda x: x <> '') AS ls FROM documents),
c AS (SELECT *, len(list_filter(ls, lambda x: contains(x, '|'))) AS pipes, len(list_filter(ls, lambda x: contains(x, chr(9)))) AS tabs,
  len(list_filter(ls, lambda x: regexp_matches(x, '\S\s{{2,}}\S'))) AS gaps,
  len(list_filter(ls, lambda x: regexp_matches(x, '^[A-ZА-ЯЁ]{{1,4}}[-\s]?\d{{2,6}}([-/][A-ZА-ЯЁ0-9]+)?$'))) AS codes,
  len(list_filter(ls, lambda x: regexp_matches(x, '\d') AND (regexp_matches(x, '^[\d\s.,xXхХ\-–+/%°"'']+$') OR len(regexp_split_to_array(x, '\s+')) <= 3))) AS nums,
  len(list_filter(ls, lambda x: length(x) <= 18)) AS shorts,
  regexp_matches(lower(text), 'наименование|ед\.|кол-во|qty|unit|amount') AS words,
  regexp_matches(lower(text), 'артикул|внутренние размеры|внешние размеры|размер ниши|количество в упаковке|шт\.|мм|d1|d2|b1|b2') AS hints FROM l),
t AS (SELECT *, len(ls) >= 2 AND (pipes >= 2 OR tabs >= 2 OR (gaps >= 3 AND len(ls) >= 4) OR (words AND gaps >= 2) OR (hints AND (nums >= 3 OR codes >= 2))
  OR (codes >= 3 AND nums >= 3) OR (len(ls) >= 8 AND shorts >= 0.65 * len(ls) AND codes + nums >= 5)) AS is_table,
  coalesce(regexp_matches(ls[1], '^\s*((\d+(\.\d+){{0,4}})|([A-Za-zА-Яа-я]\))|([IVXLCMivxlcm]+\.))\s+'), false) AS is_norm FROM c)
SELECT doc_id, CASE WHEN is_table AND is_norm THEN 'table,normative' WHEN is_table THEN 'table' WHEN is_norm THEN 'normative' ELSE 'normal' END AS labels FROM t"""
)
def b4_classify_blocks(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(T.classify_block("text"), ",").alias("labels"))


@query(
    rf"""WITH {_LINES},
h AS (SELECT *, regexp_extract(text, '^\s*(\d+(?:\.\d+){{0,4}})\s+(.+)$', 1) AS num, {_STRIP.format("regexp_extract(text, '^\\s*(\\d+(?:\\.\\d+){0,4})\\s+(.+)$', 2)")} AS title FROM chunks WHERE length(text) <= 140)
SELECT doc_id, idx AS chunk_index,
  CASE WHEN num <> '' AND title <> '' THEN num || ' ' || title ELSE text END AS heading,
  CAST(CASE WHEN num <> '' AND title <> '' THEN least(5, length(num) - length(replace(num, '.', '')) + 1) ELSE 1 END AS INT) AS level
FROM h WHERE (num <> '' AND title <> '') OR regexp_matches(text, '^\s*((Раздел|Section|Глава)\s+\d+|\d+(\.\d+)*\s+[A-Za-zА-Яа-я])')
  OR (regexp_matches(text, '\p{{Lu}}|\p{{Lt}}') AND NOT regexp_matches(text, '\p{{Ll}}|\p{{Lt}}') AND length(text) <= 80)"""
)
def b6_section_headings(spark, sf_dir):
    return line_chunks(spark, sf_dir).withColumn("h", T.section_heading("text")).where("h IS NOT NULL").select("doc_id", "chunk_index", "h.heading", "h.level")


@query(
    rf"""SELECT doc_id, length(text) >= 50 AND len(regexp_extract_all(text, '\(cid:\d+\)')) > 5 AND 10 * len(regexp_extract_all(text, '\(cid:\d+\)')) > 0.15 * length(text) AS cid_garbage,
  {_NOISY.format("text")} AS noisy, {_NOISY_OLD.format("text")} AS noisy_legacy,
  length(text) >= 20 AND length(text) - length(regexp_replace(text, '[\p{{L}}\p{{N}}]', '', 'g')) < 0.4 * length(text) AS ocr_garbage FROM documents"""
)
def b8_noise_flags(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.is_cid_garbage("text").alias("cid_garbage"), T.is_noisy("text").alias("noisy"), T.is_noisy_legacy("text").alias("noisy_legacy"), T.is_ocr_garbage("text").alias("ocr_garbage"))


_META = r"""
probe AS (SELECT doc_id, chr(10) || chr(10) || substr(coalesce(text, ''), 1, 2000) AS p, lower(chr(10) || chr(10) || substr(coalesce(text, ''), 1, 2000)) AS low, text FROM documents),
m AS (SELECT *, CASE WHEN contains(low, 'abb') THEN 'ABB' WHEN regexp_matches(low, 'schneider|se |шнайдер') THEN 'Schneider' WHEN regexp_matches(low, 'legrand|легран') THEN 'Legrand'
  WHEN regexp_matches(low, 'iek|иэк') THEN 'IEK' WHEN contains(low, 'ekf') THEN 'EKF' WHEN contains(low, 'hager') THEN 'Hager' WHEN regexp_matches(low, 'dkc|дкс') THEN 'DKC' ELSE '' END AS vendor,
  regexp_replace(regexp_replace(regexp_extract(p, '(?i)(?:ГОСТ(?:\s+Р)?|GOST(?:\s+R)?|СНиП|SNIP|IEC|ISO)\s*\d[\d.\-/–— ]{0,25}\d|(?:СП|ФЗ)\s+\d[\d.\-/–— ]{0,25}\d', 0), '\s+', ' ', 'g'), '^[ .,:;]+|[ .,:;]+$', '', 'g') AS standard_id FROM probe),
meta AS (SELECT doc_id, text, vendor, standard_id,
  CASE WHEN regexp_matches(low, 'пожар|огнестой|пожарн|fire|flame') THEN 'fire' WHEN standard_id <> '' OR regexp_matches(low, 'гост|сп |снип|пуэ|пэу|норматив|стандарт|regulation') THEN 'normative'
    WHEN vendor <> '' OR regexp_matches(low, 'каталог|catalog|datasheet|технический каталог') THEN 'catalog' ELSE 'technical' END AS doc_type,
  TRY_CAST(nullif(regexp_extract(CASE WHEN standard_id <> '' THEN standard_id ELSE p END, '\b(19\d{2}|20[0-3]\d)\b', 1), '') AS INT) AS year,
  CASE WHEN regexp_matches(p, '[А-Яа-яЁё]') AND regexp_matches(p, '[A-Za-z]') THEN 'mixed' WHEN regexp_matches(p, '[А-Яа-яЁё]') THEN 'ru' WHEN regexp_matches(p, '[A-Za-z]') THEN 'en' ELSE 'unknown' END AS lang FROM m)
"""


@query(f"WITH {_META} SELECT doc_id, doc_type, vendor, standard_id, year, lang, 'unknown' AS source_type FROM meta")
def b9_infer_metadata(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.infer_metadata("text").alias("m")).select("doc_id", "m.*")


@query(f"WITH {_META} SELECT text, CAST(doc_id AS VARCHAR) AS document, 0 AS page, '' AS section, 0 AS chunk_index, {_TOKENS.format(_STRIP.format('text'))} AS token_count, doc_type, vendor, standard_id, lang FROM meta")
def b34_minimal_record(spark, sf_dir):
    none = F.lit(None)
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(*T.minimal_record(F.col("text"), none.cast("string"), none.cast("int"), none.cast("string"), none.cast("int")), F.col("doc_id").cast("string").alias("id"))
    return rows.withColumn("document", F.col("id")).drop("id", "year", "source_type")


@query("SELECT 'documents' AS t, doc_id AS id, CASE WHEN regexp_matches(text, '[A-Za-z]') THEN 'en' ELSE 'unknown' END AS script FROM documents UNION ALL SELECT 'conversations', conv_id * 1000 + turn, CASE WHEN regexp_matches(text, '[A-Za-z]') THEN 'en' ELSE 'unknown' END FROM conversations")
def b10_script_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.lit("documents").alias("t"), F.col("doc_id").alias("id"), T.script_language("text").alias("script"))
    return docs.unionByName(table(spark, sf_dir, "conversations").select(F.lit("conversations").alias("t"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), T.script_language("text").alias("script")))


def _rules_sql(rules) -> list[tuple[str, str, float]]:
    plain = lambda p: "(?i)" + p.split(")", 1)[1] if p.startswith("(?i") else p
    return [(n, plain(p).replace("'", "''"), w) for n, p, w in rules]


def _content_sql() -> str:
    sums = lambda rules: " + ".join(f"CASE WHEN regexp_matches(text, '{p}') THEN {w} ELSE 0 END" for _, p, w in _rules_sql(rules))
    names = lambda rules: "concat_ws('+', " + ", ".join(f"CASE WHEN regexp_matches(text, '{p}') THEN '{n}' END" for n, p, _ in _rules_sql(rules)) + ")"
    return f"""WITH s AS (SELECT conv_id, turn, {sums(T.NOISE_RULES)} AS n, {sums(T.VALUE_RULES)} AS v, {names(T.NOISE_RULES)} AS ns, {names(T.VALUE_RULES)} AS vs FROM conversations)
SELECT conv_id, turn, CASE WHEN v > n THEN 'valuable' WHEN n > 0 AND v = 0 THEN 'noise' ELSE 'ambiguous' END AS label,
  CASE WHEN v > n THEN vs WHEN n > 0 AND v = 0 THEN ns WHEN n > 0 THEN 'mixed' ELSE 'unknown' END AS reason FROM s"""


@query(_content_sql())
def b18_content_classes(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.classify_content("text").alias("c")).select("conv_id", "turn", "c.label", "c.reason")


@query(
    rf"""WITH a AS (SELECT p_partkey, unnest(['name', 'brand', 'type', 'col_size']) AS k, unnest([p_name, p_brand, p_type, CAST(p_size AS VARCHAR)]) AS v FROM part),
s AS (SELECT p_partkey, CASE WHEN k = 'name' THEN 0.5 WHEN starts_with(k, 'col_') THEN 0.1 ELSE 0.4 END + 0.25 + CASE WHEN regexp_matches(v, '\d') THEN 0.05 ELSE 0 END
  + CASE WHEN regexp_matches(v, '{"(?i)" + T.ROW_UNITS.split(")", 1)[1]}') THEN 0.1 ELSE 0 END
  + CASE WHEN regexp_matches(v, '\d{{2}}\.\d+\.\d+\.\d+-\d+|\d{{2}}-\d{{2}}-\d{{3}}-\d+|КП\s*№?\d+|\d{{3}}-\d{{4}}') THEN 0.1 ELSE 0 END + CASE WHEN length(trim(v)) > 5 THEN 0.05 ELSE 0 END AS x FROM a WHERE trim(v) <> '')
SELECT p_partkey, CAST(round(1000000 * least(1.0, avg(CAST(x AS DOUBLE)))) AS BIGINT) AS grade_e6 FROM s GROUP BY p_partkey"""
)
def b19_row_grade(spark, sf_dir):
    named = F.create_map(F.lit("name"), "p_name", F.lit("brand"), "p_brand", F.lit("type"), "p_type", F.lit("col_size"), F.col("p_size").cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", F.round(1000000 * T.row_grade(named)).cast("long").alias("grade_e6"))


_TERMS, _ANTI = ("the", "and", "que", "die", "license", "table"), ("error", "token", "idiot")


@query("SELECT doc_id, " + " + ".join(f"CASE WHEN contains(lower(text), '{t}') THEN {w} ELSE 0 END" for ts, w in ((_TERMS, 1), (_ANTI, -2)) for t in ts) + " AS score FROM documents")
def b20_term_score(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.term_score(F.col("text"), _TERMS, _ANTI).alias("score"))


@query("WITH s AS (SELECT doc_id, length(text) AS n, " + " + ".join(f"CASE WHEN contains(lower(text), '{t}') THEN {w} ELSE 0 END" for ts, w in ((_TERMS, 1), (_ANTI, -2)) for t in ts) + " AS raw FROM documents) SELECT doc_id, CAST(trunc(raw * 1000 / CAST(greatest(n, 1) AS DOUBLE) * (least(greatest(n, 1), 2000.0) / 1000)) AS INT) AS score FROM s")
def b21_density_score(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.density_score(F.col("text"), _TERMS, _ANTI).alias("score"))


@query(rf"""SELECT page_id, {_DOMAIN.format("url")} AS domain, {_PATH.format("url")} AS path,
  {_DOMAIN.format("url")} || CASE WHEN regexp_replace({_PATH.format("url")}, '^/+|/+$', '', 'g') <> '' THEN '__' || regexp_replace(regexp_replace(regexp_replace({_PATH.format("url")}, '^/+|/+$', '', 'g'), '[^\w\-]', '_', 'g'), '^_+|_+$', '', 'g') ELSE '' END || '.json' AS filename FROM pages""")
def b24_url_parts(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.domain("url").alias("domain"), U.path("url").alias("path"), U.discovery_filename("url").alias("filename"))


@query(rf"""SELECT page_id, NOT (regexp_matches({_PATH.format("url")}, '{U.SKIP_SEGMENTS}') OR regexp_matches({_PATH.format("url")}, '{U.SKIP_MEDIA}') OR regexp_matches({_PATH.format("url")}, '{U.MEDIA_EXTENSIONS}')) AS is_product,
  CASE WHEN regexp_matches({_PATH.format("url")}, '{U.PRODUCT_PATH}') THEN 0 WHEN regexp_matches({_PATH.format("url")}, '{U.EDITORIAL_PATH}') THEN 2 ELSE 1 END AS priority FROM pages""")
def b23_url_filters(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.is_product("url").alias("is_product"), U.priority("url").alias("priority"))


@query(rf"""SELECT page_id, CASE WHEN regexp_matches(url, '^(?i:https?)://') THEN lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) || '://' || regexp_replace(lower({_AUTH.format("url")}), ':(80|443)$', '')
  || CASE WHEN {_PATH.format("url")} = '' THEN '/' ELSE {_PATH.format("url")} END || CASE WHEN regexp_extract(url, '\?([^#]*)', 1) <> '' THEN '?' || regexp_extract(url, '\?([^#]*)', 1) ELSE '' END END AS uri FROM pages""")
def a6_canonical_uri(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.canonical("url").alias("uri"))


@query(f"WITH h AS (SELECT page_id, {_HREFS} AS hs FROM pages) SELECT page_id, i - 1 AS pos, hs[i] AS href FROM h, LATERAL (SELECT unnest(range(1, len(hs) + 1)) AS i)")
def a7_anchors(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(U.anchors("html")).alias("pos", "href"))


@query()
def x2_html_blocks(spark, sf_dir):
    return markup.html_blocks(table(spark, sf_dir, "pages"), "page_id", "html")


@query()
def x3_web_blocks(spark, sf_dir):
    return markup.html_blocks(table(spark, sf_dir, "pages"), "page_id", "html", web=True)


@query()
def x5_rendered_blocks(spark, sf_dir):
    return rendered.rendered_pages(table(spark, sf_dir, "documents"), "doc_id", "text")


@query(rf"""WITH {_LINES}, n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY idx) - 1 AS r FROM chunks)
SELECT doc_id, CAST(r // 50 + 1 AS INT) AS unit, string_agg(text, chr(10) ORDER BY idx) AS text, count(*) AS n_lines FROM n GROUP BY doc_id, r // 50""")
def x18_line_units(spark, sf_dir):
    return K.line_units(table(spark, sf_dir, "documents"))


@query(rf"""WITH {_LINES} SELECT doc_id, count(*) AS block_count, CAST(sum(length(text)) AS BIGINT) AS char_count, sha256(string_agg(text || chr(0), '' ORDER BY idx)) AS content_sha256 FROM chunks GROUP BY doc_id""")
def g1_document_hashes(spark, sf_dir):
    return Q.enrich_documents(line_chunks(spark, sf_dir).withColumnRenamed("chunk_index", "idx"))


@query(rf"""WITH {_LINES} SELECT doc_id, idx AS chunk_index, sha256({_FOLD.format("text")}) AS chunk_sha256, length(text) AS char_count, CASE WHEN regexp_matches(text, '[A-Za-z]') THEN 'en' ELSE 'unknown' END AS lang FROM chunks""")
def g1_chunk_hashes(spark, sf_dir):
    return Q.enrich_chunks(line_chunks(spark, sf_dir))


def _gate_sql(noisy: str, min_tokens: int) -> str:
    return rf"""{_LINES}, f AS (SELECT doc_id, sha256({_FOLD.format("text")}) AS h, {_TOKENS.format("text")} AS n, {noisy} AS noise FROM chunks),
ph AS (SELECT doc_id, h, count(*) AS c, count(*) FILTER (n < {min_tokens}) AS tiny, count(*) FILTER (noise) AS noise, count(*) FILTER (n > 1200) AS over, sum(n) AS tokens, max(n) AS most FROM f GROUP BY doc_id, h),
g AS (SELECT doc_id, CAST(sum(c) AS BIGINT) AS chunk_count, CAST(sum(tiny) AS BIGINT) AS tiny_count, CAST(sum(c - 1) AS BIGINT) AS duplicate_count, CAST(sum(noise) AS BIGINT) AS noisy_count, CAST(sum(over) AS BIGINT) AS oversized_count, CAST(sum(tokens) AS BIGINT) AS total_tokens, max(most) AS max_tokens FROM ph GROUP BY doc_id)"""


_GATE = f"WITH {_gate_sql(_NOISY.format('text'), 20)}, q AS (SELECT *, concat_ws(',', CASE WHEN tiny_count > 0.8 * chunk_count THEN 'tiny_ratio' END, CASE WHEN duplicate_count > 0.25 * chunk_count THEN 'duplicate_ratio' END, CASE WHEN noisy_count > 0.1 * chunk_count THEN 'noisy_ratio' END, CASE WHEN oversized_count > 0 THEN 'oversized_ratio' END) AS findings FROM g)"


@query(f"{_GATE} SELECT doc_id, chunk_count, tiny_count, duplicate_count, noisy_count, oversized_count, total_tokens, findings, findings = '' AS passed FROM q")
def g2_quality_gate(spark, sf_dir):
    gate = Q.quality_gate(line_chunks(spark, sf_dir))
    return gate.select("doc_id", "chunk_count", "tiny_count", "duplicate_count", "noisy_count", "oversized_count", "total_tokens", F.array_join("findings", ",").alias("findings"), "passed")


_OLD_GATE = f"WITH {_gate_sql(_NOISY_OLD.format(_FOLD.format('text')), 40)}, o AS (SELECT doc_id, chunk_count, tiny_count, duplicate_count, noisy_count, CAST(trunc(total_tokens / chunk_count) AS INT) AS avg_tokens, max_tokens, CASE WHEN tiny_count > 0.35 * chunk_count OR duplicate_count > 0.25 * chunk_count OR noisy_count > 0.3 * chunk_count THEN 'warn' ELSE 'pass' END AS status FROM g)"


@query(f"{_OLD_GATE} SELECT * FROM o")
def g3_legacy_gate(spark, sf_dir):
    return Q.legacy_gate(line_chunks(spark, sf_dir)).drop("empty_count")


@query(f"{_OLD_GATE}, d AS (SELECT DISTINCT doc_id FROM labels) SELECT count(*) FILTER (doc_id NOT IN (SELECT doc_id FROM d)) AS processed_count, count(*) FILTER (doc_id NOT IN (SELECT doc_id FROM d) AND status = 'pass') AS pass_count, count(*) FILTER (doc_id NOT IN (SELECT doc_id FROM d) AND status = 'warn') AS warn_count, count(*) FILTER (doc_id IN (SELECT doc_id FROM d)) AS skipped_count FROM o")
def g4_gate_dataset(spark, sf_dir):
    return Q.gate_dataset(Q.legacy_gate(line_chunks(spark, sf_dir)), table(spark, sf_dir, "labels").select("doc_id"))


@query(f"{_GATE} SELECT source, count(*) AS docs, count(*) FILTER (findings = '') AS passed, CAST(sum(chunk_count) AS BIGINT) AS chunks, CAST(sum(total_tokens) AS BIGINT) AS tokens FROM q JOIN documents USING (doc_id) GROUP BY source")
def g2_source_rollup(spark, sf_dir):
    """The gate's key carries the source, so that documents are read once."""
    gate = Q.quality_gate(line_chunks(spark, sf_dir, "source").withColumn("doc_id", F.struct("doc_id", "source")))
    return gate.groupBy(F.col("doc_id.source").alias("source")).agg(F.count(F.lit(1)).alias("docs"), F.count_if("passed").alias("passed"), F.sum("chunk_count").alias("chunks"), F.sum("total_tokens").alias("tokens"))


@query(rf"""WITH {_LINES}, t AS (SELECT source, CASE WHEN contains(chunks.text, '|') THEN 'table' ELSE 'text' END AS ty, {_TOKENS.format("chunks.text")} AS n FROM chunks JOIN documents USING (doc_id)),
b AS (SELECT source, ty, count(*) AS c, sum(n) AS s, min(n) AS lo, max(n) AS hi FROM t GROUP BY source, ty)
SELECT source, CAST(sum(c) AS BIGINT) AS total_chunks, CAST(sum(s) AS BIGINT) AS total_tokens, min(lo) AS min_tokens, max(hi) AS max_tokens, string_agg(ty || '=' || c, ',' ORDER BY ty) AS by_type FROM b GROUP BY source""")
def g5_token_report(spark, sf_dir):
    rows = line_chunks(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    rows = rows.select("source", F.when(F.col("text").contains("|"), "table").otherwise("text").alias("chunk_type"), T.count_tokens("text").alias("token_count"))
    flat = F.array_join(F.transform(F.map_entries("by_type"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return Q.token_report(rows, "source").select("source", "total_chunks", "total_tokens", "min_tokens", "max_tokens", flat.alias("by_type"))


@query(f"{_OLD_GATE}, m AS (SELECT count(*) AS docs, sum(chunk_count) AS chunks, sum(avg_tokens * chunk_count) // greatest(sum(chunk_count), 1) AS avg_tokens, count(*) FILTER (avg_tokens < 150) AS tiny_docs FROM o) SELECT CAST(docs AS BIGINT) AS docs, CAST(chunks AS BIGINT) AS chunks, CAST(avg_tokens AS BIGINT) AS avg_tokens, CAST(tiny_docs AS BIGINT) AS tiny_docs FROM m")
def g10_rechunk_metrics(spark, sf_dir):
    return Q.rechunk_metrics(Q.legacy_gate(line_chunks(spark, sf_dir)))


@query("SELECT event_type AS status, count(*) AS n FROM events GROUP BY event_type")
def g11_outcome_counts(spark, sf_dir):
    return Q.outcome_counts(table(spark, sf_dir, "events").withColumnRenamed("event_type", "status"))


@query(rf"""WITH s AS (SELECT page_id AS pos, {_DOMAIN.format("url")} AS domain, url, length(url) AS score FROM pages),
u AS (SELECT domain, url, sum(score) AS score, min(pos) AS pos FROM s GROUP BY domain, url),
r AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY score DESC, pos) AS place, sum(score) OVER (PARTITION BY domain) AS total, count(*) OVER (PARTITION BY domain) AS found FROM u)
SELECT domain, url, CAST(score + floor((total - score) / 2) AS BIGINT) AS score, found AS domain_urls_found FROM r WHERE place = 1""")
def g14_best_by_domain(spark, sf_dir):
    scored = table(spark, sf_dir, "pages").groupBy("url").agg(F.sum(F.length("url")).alias("score"), F.min("page_id").alias("pos"))
    return S.best_by_domain(scored).withColumn("score", F.col("score").cast("long"))


@query("WITH m AS (SELECT sha256(text) AS h, min(doc_id) AS doc_id FROM documents GROUP BY 1) SELECT doc_id, source FROM documents JOIN m USING (doc_id)")
def j12_exact_dedup(spark, sf_dir):
    return S.exact_dedup(table(spark, sf_dir, "documents"), "text", "doc_id").select("doc_id", "source")


@query(
    """WITH e AS (SELECT user_id % 50 AS prefix, event_id AS pos, event_type <> 'view' AS failed FROM events),
r AS (SELECT *, sum(CASE WHEN failed THEN 0 ELSE 1 END) OVER (PARTITION BY prefix ORDER BY pos) AS run FROM e),
l AS (SELECT *, row_number() OVER (PARTITION BY prefix, run ORDER BY pos) - CASE WHEN run > 0 THEN 1 ELSE 0 END AS len FROM r),
f AS (SELECT prefix, min(pos) AS full_at FROM l WHERE failed AND len >= 5 GROUP BY prefix)
SELECT e.prefix, e.pos, e.failed, coalesce(e.pos > full_at, false) AS skipped FROM e LEFT JOIN f USING (prefix)"""
)
def j12_failure_streak(spark, sf_dir):
    events = table(spark, sf_dir, "events").select((F.col("user_id") % 50).alias("prefix"), F.col("event_id").alias("pos"), (F.col("event_type") != "view").alias("failed"))
    return S.failure_streak(events, 5)


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 50 OFFSET 20")
def j4_page_of_documents(spark, sf_dir):
    """A page is the feature here."""
    return S.page_of(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), [F.desc("n_chars"), F.col("doc_id")], 50, 20)


@query("SELECT doc_id, CAST(max(i) + 1 AS INT) AS next_index FROM (SELECT doc_id, len(string_split(text, chr(10))) - 1 AS i FROM documents) GROUP BY doc_id")
def j6_next_index(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return S.next_index(docs.select("doc_id", (F.size(F.split("text", "\n")) - 1).alias("chunk_index")))


@query(
    """SELECT conv_id AS doc_id, turn AS chunk_index, text, CAST(1 AS BIGINT) AS merged FROM conversations WHERE turn >= 2
UNION ALL SELECT conv_id, min(turn), string_agg(text, chr(10) || chr(10) ORDER BY turn), count(*) FROM conversations WHERE turn < 2 GROUP BY conv_id"""
)
def j7_merge_chunks(spark, sf_dir):
    chunks = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("chunk_index"), "text")
    return S.merge_chunks(chunks, F.col("chunk_index") < 2)


@query(
    r"""WITH q AS (SELECT conv_id, turn, text, list_filter(list_transform(regexp_split_to_array(text, '\. '), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS ps FROM conversations),
p AS (SELECT conv_id, turn, CASE WHEN turn = 0 AND len(ps) >= 2 THEN ps ELSE [text] END AS ps FROM q),
b AS (SELECT *, turn + coalesce(sum(len(ps) - 1) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM p)
SELECT conv_id AS doc_id, CAST(base + i - 1 AS BIGINT) AS chunk_index, ps[i] AS text FROM b, LATERAL (SELECT unnest(range(1, len(ps) + 1)) AS i)"""
)
def j8_split_chunk(spark, sf_dir):
    chunks = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("chunk_index"), "text")
    return S.split_chunk(chunks, F.col("chunk_index") == 0, r"\. ")


@query(
    """WITH o AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN 'approved' ELSE 'candidate' END AS status, CAST(c_custkey AS BIGINT) AS score FROM customer),
n AS (SELECT s_suppkey AS k, 'candidate' AS status, CAST(s_suppkey * 2 AS BIGINT) AS score FROM supplier)
SELECT coalesce(o.k, n.k) AS k, CASE WHEN o.status = 'approved' THEN o.status ELSE coalesce(n.status, o.status) END AS status, CASE WHEN o.status = 'approved' THEN o.score ELSE coalesce(n.score, o.score) END AS score FROM o FULL JOIN n ON o.k = n.k"""
)
def j14_upsert(spark, sf_dir):
    old = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 3 == 0, "approved").otherwise("candidate").alias("status"), F.col("c_custkey").cast("long").alias("score"))
    return S.upsert(old, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.lit("candidate").alias("status"), (F.col("s_suppkey") * 2).cast("long").alias("score")), "k")


@query("SELECT s_suppkey, s_name, s_suppkey = 3 AS is_default FROM supplier")
def j19_set_default(spark, sf_dir):
    return S.set_default(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), "s_suppkey", 3)


@query(
    """WITH q AS (SELECT embedding AS e FROM embeddings ORDER BY vec_id LIMIT 1),
s AS (SELECT vec_id AS chunk_id, label AS document_id, list_dot_product(CAST(embedding AS DOUBLE[]), CAST(e AS DOUBLE[])) / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) * list_dot_product(CAST(e AS DOUBLE[]), CAST(e AS DOUBLE[]))) AS sim FROM embeddings, q)
SELECT chunk_id, document_id, CAST(round(sim * 10000) AS BIGINT) AS sim_e4 FROM s WHERE sim >= 0.05 ORDER BY sim DESC, chunk_id LIMIT 10"""
)
def j1_vector_search(spark, sf_dir):
    """The ten best are the feature here."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("chunk_id"), F.col("label").alias("document_id"), "embedding")
    asked = vectors.orderBy("chunk_id").first().embedding
    found = J.vector_search(vectors, vectors.select("document_id").distinct(), list(asked), 0.05, 10)
    return found.select("chunk_id", "document_id", F.round(F.col("similarity") * 10000).cast("long").alias("sim_e4"))


@query(
    """WITH v AS (SELECT label, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
p AS (SELECT a.vec_id, avg(list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e))) AS m FROM v a JOIN v b ON a.label = b.label AND b.vec_id BETWEEN a.vec_id - 20 AND a.vec_id + 20 AND a.vec_id <> b.vec_id GROUP BY a.vec_id)
SELECT v.vec_id, CAST(round(m * 100000) AS BIGINT) AS similarity_e5, CAST(round(1000 * sqrt(list_dot_product(v.e, v.e))) AS BIGINT) AS norm_milli FROM v LEFT JOIN p USING (vec_id)"""
)
def j2_neighbour_similarity(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(F.col("label").alias("document_id"), F.col("vec_id").alias("idx"), "embedding")
    return J.neighbour_similarity(vectors, 20).select(F.col("idx").alias("vec_id"), F.round(F.col("avg_similarity") * 100000).cast("long").alias("similarity_e5"), F.round(1000 * F.col("embedding_norm")).cast("long").alias("norm_milli"))


@query(
    """SELECT item_id, CAST(round(1e6 * list_sum(list_transform(range(0, 1024), lambda i: (i + 1) * ((16 * (instr('0123456789abcdef', substr(sha256(text), CAST((i % 32) * 2 + 1 AS INT), 1)) - 1) + instr('0123456789abcdef', substr(sha256(text), CAST((i % 32) * 2 + 2 AS INT), 1)) - 1) / 255.0 * 2 - 1)))) AS BIGINT) AS digest FROM benchmark"""
)
def j20_fake_embedding(spark, sf_dir):
    e = J.fake_embedding(F.col("text"))
    weighed = F.aggregate(F.transform(e, lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    return table(spark, sf_dir, "benchmark").select("item_id", F.round(1e6 * weighed).cast("long").alias("digest"))


_RETRIEVAL = r"""
q AS (SELECT item_id AS id, text FROM benchmark),
qt AS (SELECT DISTINCT id, lower(t) AS term FROM (SELECT id, unnest(list_concat(regexp_extract_all(text, '[A-Za-zА-Яа-яЁё0-9]{3,}'), regexp_extract_all(substr(text, 1, 30), '[A-Za-zА-Яа-яЁё0-9]{3,}'))) AS t FROM q) WHERE lower(t) NOT IN ('the', 'and', 'for', 'with', 'from')),
ct AS (SELECT DISTINCT doc_id, lower(t) AS term FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zА-Яа-яЁё0-9]{3,}')) AS t FROM documents) WHERE lower(t) NOT IN ('the', 'and', 'for', 'with', 'from')),
ex AS (SELECT id, substr(text, 1, 30) AS e FROM q),
o AS (SELECT id, doc_id, count(*) AS overlap FROM qt JOIN ct USING (term) GROUP BY id, doc_id),
s AS (SELECT id, doc_id, overlap, CASE WHEN contains(lower(text), lower(e)) THEN 1 ELSE 0 END AS hits, length(text) AS n FROM o JOIN ex USING (id) JOIN documents USING (doc_id)),
r AS (SELECT *, overlap + 3 * hits AS score, row_number() OVER (PARTITION BY id ORDER BY overlap + 3 * hits DESC, hits DESC, n DESC, doc_id) AS rank FROM s)
"""


def _retrieval(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("question"), F.array(F.substring("text", 1, 30)).alias("expected"))
    return asked, J.retrieval_scores(asked, table(spark, sf_dir, "documents").select(F.col("doc_id").alias("chunk_id"), "text"), 5)


@query(f"WITH {_RETRIEVAL} SELECT id, CAST(rank AS INT) AS rank, doc_id AS chunk_id, score, CAST(hits AS INT) AS hits FROM r WHERE rank <= 5")
def j3_retrieval(spark, sf_dir):
    """The five best of each question are the feature here."""
    return _retrieval(spark, sf_dir)[1]


@query(f"WITH {_RETRIEVAL}, h AS (SELECT id, bool_or(hits > 0) AS hit FROM r WHERE rank <= 5 GROUP BY id) SELECT count(*) AS questions, count(*) FILTER (coalesce(hit, false)) AS hits, CAST(round(10000.0 * count(*) FILTER (coalesce(hit, false)) / count(*)) AS BIGINT) AS rate_e4 FROM q LEFT JOIN h USING (id)")
def j3_hit_rate(spark, sf_dir):
    asked, scored = _retrieval(spark, sf_dir)
    return J.hit_rate(asked, scored).select("questions", "hits", F.round(F.col("hit_rate") * 10000).cast("long").alias("rate_e4"))


_ELEMENTS = f"""
el AS (SELECT conv_id AS doc_id, turn AS idx, coalesce(text, '') AS text, role = 'system' AS head, contains(coalesce(text, ''), '|') AS is_row FROM conversations),
sec AS (SELECT *, coalesce(last_value(CASE WHEN head THEN text END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY idx), '') AS section, sum(CASE WHEN head THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY idx) AS part FROM el),
body AS (SELECT * FROM sec WHERE NOT head AND {_STRIP.format("text")} <> '')
"""


@query(f"WITH {_ELEMENTS} SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY idx) - 1 AS INT) AS chunk_index, text, section, {_TOKENS.format(_STRIP.format('text'))} AS token_count FROM body")
def k11_row_level(spark, sf_dir):
    return K.row_level(conversation_elements(spark, sf_dir))


@query(rf"""WITH {_ELEMENTS}, n AS (SELECT *, (row_number() OVER (PARTITION BY doc_id, part ORDER BY idx) - 1) // 3 AS grp FROM body),
g AS (SELECT doc_id, part, grp, string_agg(text, chr(10) ORDER BY idx) AS text, any_value(section) AS section, min(idx) AS first_idx, CASE WHEN bool_or(is_row) THEN 'table' ELSE 'text' END AS chunk_type FROM n GROUP BY doc_id, part, grp)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY first_idx) - 1 AS INT) AS chunk_index, text, section, chunk_type, {_TOKENS.format(_STRIP.format("text"))} AS token_count FROM g""")
def k12_row_group(spark, sf_dir):
    return K.row_group(conversation_elements(spark, sf_dir), 3)


@query()
def k3_structure_chunks(spark, sf_dir):
    units = table(spark, sf_dir, "documents").select("doc_id", F.lit(0).alias("idx"), F.lit(1).alias("page"), F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))
    return K.pack_chunks(K.blocks_from_units(units))


@query()
def k8_extracted_chunks(spark, sf_dir):
    blocks = markup.html_blocks(table(spark, sf_dir, "pages"), "page_id", "html").select(F.col("page_id").alias("doc_id"), F.col("pos").alias("idx"), "text", F.lit("markup").alias("kind"), F.lit(None).cast("int").alias("page"), F.lit("").alias("section"))
    return K.chunk_extracted(blocks)


@query()
def k10_hybrid_chunks(spark, sf_dir):
    return K.chunk_text(table(spark, sf_dir, "documents"))


@query()
def k13_hierarchical_chunks(spark, sf_dir):
    return K.chunk_elements(conversation_elements(spark, sf_dir), "hierarchical")


@query()
def k14_semantic_chunks(spark, sf_dir):
    return K.chunk_elements(conversation_elements(spark, sf_dir), "semantic")


@query()
def k15_structured_chunks(spark, sf_dir):
    return K.chunk_elements(conversation_elements(spark, sf_dir), "structure_aware")


@query("WITH n AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id) SELECT conv_id AS doc_id, CASE WHEN conv_id % 2 = 0 THEN 'tabular' ELSE 'document' END AS format_hint, n, CASE WHEN conv_id % 2 = 1 THEN 'structure_aware' WHEN n < 50 THEN 'row_level' ELSE 'hierarchical' END AS strategy FROM n")
def k18_select_strategy(spark, sf_dir):
    elements = conversation_elements(spark, sf_dir)
    return K.select_strategy(elements, elements.select("doc_id").distinct().withColumn("format_hint", F.when(F.col("doc_id") % 2 == 0, "tabular").otherwise("document")))


@query(rf"""WITH {_LINES} SELECT doc_id, sha256('# ' || doc_id || chr(10) || chr(10) || string_agg(text, chr(10) || chr(10) ORDER BY idx) || chr(10)) AS sha256 FROM chunks GROUP BY doc_id""")
def s8_render_documents(spark, sf_dir):
    blocks = line_chunks(spark, sf_dir).select("doc_id", F.col("chunk_index").alias("idx"), "text", F.lit("text").alias("kind"))
    return files.render_documents(blocks).select("doc_id", "sha256")


@query(
    """WITH t AS (SELECT user_id AS task_id, ts, event_id, CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'completed' ELSE 'enqueued' END AS event FROM events),
e AS (SELECT *, sum(CASE WHEN event = 'failed' THEN 1 ELSE 0 END) OVER w AS fails, row_number() OVER w AS n FROM t WINDOW w AS (PARTITION BY task_id ORDER BY ts, event, event_id)),
d AS (SELECT task_id, min(n) AS n FROM e WHERE event = 'completed' OR fails = 4 AND event = 'failed' GROUP BY task_id),
x AS (SELECT task_id, event, fails FROM e JOIN d USING (task_id, n)),
a AS (SELECT task_id, max(fails) AS fails FROM e GROUP BY task_id)
SELECT a.task_id, CASE WHEN x.event IS NULL THEN 'pending' ELSE x.event END AS state, CAST(coalesce(x.fails, a.fails) AS INT) AS retries FROM a LEFT JOIN x USING (task_id)"""
)
def q2_final_states(spark, sf_dir):
    kind = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "completed").otherwise("enqueued")
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("task_id"), F.col("ts").alias("at"), kind.alias("event"))
    return queue.final_states(events)


@query("SELECT page_id, CAST(CASE WHEN page_id % 3 = 0 THEN least(7200, 120 + page_id * 100 * 2 // 1000) WHEN page_id % 3 = 1 THEN least(7200, 300 + page_id * 10) ELSE 600 END AS INT) AS seconds FROM pages")
def q4_timeouts(spark, sf_dir):
    name = F.when(F.col("page_id") % 3 == 0, "a.xlsx").when(F.col("page_id") % 3 == 1, "a.pdf").otherwise("a.docx")
    return table(spark, sf_dir, "pages").select("page_id", T.timeout_seconds(name, F.col("page_id") * 100, F.col("page_id")).alias("seconds"))


@query(rf"""WITH d AS (SELECT DISTINCT {_DOMAIN.format("url")} AS x FROM pages) SELECT DISTINCT url FROM pages""")
def a15_merged_urls(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return D.merged_urls(pages.where("page_id % 2 = 0"), pages)


def entry(spark: SparkSession) -> DataFrame:
    """The flagship: lines of documents through the quality gate, rolled up by source."""
    return g2_source_rollup(spark, "/root/testdata/sf0.001")



