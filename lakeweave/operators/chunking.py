"""Chunking of documents: windows where built-in operators can say it, folds in one grouped pass where they can't.

Input tables have (doc_id, idx, text, ...), one row for each block or element; idx gives the order. Folds are
grouped by doc_id, so a task holds one document at a time; columns they don't need are dropped before the shuffle.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.window import Window

from lakeweave.functions import text as T
from lakeweave.operators import folds
from lakeweave.rows import each_row

CHUNKS = "doc_id string, chunk_index int, text string, token_count int, chunk_type string, section string, section_path array<string>, section_level int, page int, end_page int, block_types array<string>, oversized boolean, table_split boolean"

COLUMNS = [c.split()[0] for c in CHUNKS.split(", ")]

HEADS = ("heading", "section_header")


def line_units(docs: DataFrame, lines_per_unit: int = 50) -> DataFrame:
    """Stripped non-empty lines, every ``lines_per_unit`` of them joined into a unit numbered from 1."""
    exploded = docs.select("doc_id", F.posexplode(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), T.normalize_text)).alias("pos", "line")).where("line <> ''")
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("pos")) - 1
    units = exploded.withColumn("unit", (F.floor(place / lines_per_unit) + 1).cast("int"))
    return units.groupBy("doc_id", "unit").agg(F.expr("listagg(line, '\n') WITHIN GROUP (ORDER BY pos)").alias("text"), F.count(F.lit(1)).alias("n_lines"))


LEVELS = range(1, 6)


def blocks_from_units(units: DataFrame) -> DataFrame:
    """K1: paragraphs of units (doc_id, idx, text, page) with labels and the running path of headings.

    K2: a heading leaves the path as soon as one of its level or above follows it. So the path holds, for each level, its
    last heading if none above came later: one running value a level, in a single window over the document.
    """
    parts = units.select("doc_id", "idx", "page", F.posexplode(T.paragraphs(T.normalize_text("text"))).alias("pos", "text"))
    parts = parts.withColumn("head", T.section_heading("text")).withColumn("types", T.classify_block("text"))
    place = F.struct("idx", "pos").alias("at")
    order = Window.partitionBy("doc_id").orderBy("idx", "pos").rowsBetween(Window.unboundedPreceding, 0)
    last = [F.last(F.when(F.col("head.level") == n, F.struct(place, F.col("head.level").alias("level"), F.col("head.heading").alias("heading"))), True).over(order).alias(f"last{n}") for n in LEVELS]
    seen = parts.select("doc_id", "idx", "pos", "page", "text", "types", *last)
    above = lambda n: F.greatest(*(F.col(f"last{k}.at") for k in range(1, n)), F.lit(None)) if n > 1 else F.lit(None)
    kept = F.array_compact(F.array(*(F.when(above(n).isNull() | (F.col(f"last{n}.at") > above(n)), F.col(f"last{n}")) for n in LEVELS)))
    stack = seen.select("doc_id", "idx", "pos", "page", "text", "types", kept.alias("stack"))
    names = F.transform("stack", lambda x: x["heading"])
    return stack.select("doc_id", "idx", "pos", "page", "text", "types", names.alias("section_path"), F.coalesce(F.try_element_at(names, F.lit(-1)), F.lit("")).alias("section"), F.coalesce(F.try_element_at(F.transform("stack", lambda x: x["level"]), F.lit(-1)), F.lit(0)).alias("section_level"))


def _rows(doc_id, chunks: list[folds.Block]) -> list[tuple]:
    return [(str(doc_id), i, c.text, c.tokens, c.types[0] if c.types else "text", c.section, c.path, c.level, c.page, c.end_page, c.types, c.oversized, c.table_split) for i, c in enumerate(chunks)]


def _folded(blocks: DataFrame, fold, schema: str) -> DataFrame:
    """Rows of fold(doc_id, blocks in order) for each document: its blocks come as one row, so that no frame is made for it."""
    columns = ("text", "page", "section", "section_path", "section_level", "types")
    held = blocks.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("idx", "pos", *columns))).alias("b"))

    def read(doc_id, *values):
        return fold(doc_id, [folds.Block(t, int(p or 0), 0, s or "", path, int(n or 0), kinds) for t, p, s, path, n, kinds in zip(*values, strict=True)])

    return each_row(held.select("doc_id", *(F.col(f"b.{c}").alias(c) for c in columns)), read, schema)


def pack_chunks(blocks: DataFrame, target: int = 1000, limit: int = 1200) -> DataFrame:
    """K3 with K4 to K7: chunks of blocks (doc_id, idx, pos, text, page, types, section, section_path, section_level)."""
    return _folded(blocks, lambda doc_id, own: _rows(doc_id, folds.pack_blocks(own, target, limit)[0]), CHUNKS)


LOG = "doc_id string, blocks_in int, chunks_out int, token_limit_violations int, " + ", ".join(f"{name} int" for name in folds.COUNTERS)


def chunking_log(blocks: DataFrame, target: int = 1000, limit: int = 1200) -> DataFrame:
    """K9: what packing did to each document's blocks, a row a document; the run's log is this table's sums."""

    def fold(doc_id, own: list[folds.Block]) -> list[tuple]:
        made, counts = folds.pack_blocks(own, target, limit)
        return [(str(doc_id), len(own), len(made), sum(c.tokens > limit for c in made), *(counts[name] for name in folds.COUNTERS))]

    return _folded(blocks, fold, LOG)


def chunk_extracted(blocks: DataFrame, max_tokens: int = 800) -> DataFrame:
    """K8: chunks of extracted blocks (doc_id, idx, text, kind, page, section): each block is split on its own, a heading names its own
    section, and a kind other than text is a label. The target is four fifths of the limit."""
    rows = blocks.where(F.length(T.strip("text")) > 0).select("doc_id", "idx", F.coalesce("page", F.col("idx") + 1).alias("page"), F.coalesce("kind", F.lit("text")).alias("kind"), F.when(F.col("kind") == "heading", F.col("text")).otherwise(F.coalesce("section", F.lit(""))).alias("section"), F.posexplode(T.paragraphs(T.normalize_text("text"))).alias("pos", "text"))
    named = F.when(F.col("section") != "", F.array("section")).otherwise(F.array().cast("array<string>"))
    types = F.array_sort(F.array_union(T.classify_block("text"), F.when(F.col("kind") != "text", F.array("kind")).otherwise(F.array().cast("array<string>"))))
    ready = rows.select("doc_id", "idx", "pos", "page", "text", "section", named.alias("section_path"), F.size(named).alias("section_level"), types.alias("types"))
    return pack_chunks(ready, max(1, int(max_tokens * 0.8)), max_tokens).withColumn("oversized", F.col("token_count") > max_tokens)


def chunk_text(docs: DataFrame, target: int = 1000, overlap: int = 200) -> DataFrame:
    """Chunks of plain texts, without sections; the limit is the target and 200 more."""
    none = F.array().cast("array<string>")
    rows = docs.select("doc_id", F.lit(0).alias("idx"), F.lit(0).alias("page"), F.posexplode(T.paragraphs(T.normalize_text("text"))).alias("pos", "text"))
    return pack_chunks(rows.select("doc_id", "idx", "pos", "page", "text", F.lit("").alias("section"), none.alias("section_path"), F.lit(0).alias("section_level"), T.classify_block("text").alias("types")), target, target + 200)


def chunk_elements(elements: DataFrame, strategy: str, **options) -> DataFrame:
    """K13 hierarchical, K14 semantic or K15 structure_aware chunks of elements (doc_id, idx, text, element_type, row_type, page, section)."""
    fold_of = {"hierarchical": folds.hierarchical, "semantic": folds.semantic, "structure_aware": folds.structured}[strategy]

    def fold(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        rows = zip(pdf["text"].fillna(""), pdf["element_type"].fillna("text"), pdf["row_type"].fillna(""), pdf["page"], pdf["section"].fillna(""), strict=True)
        made = fold_of([folds.Element(t, e, r, None if pd.isna(p) else int(p), s) for t, e, r, p, s in rows], **options)
        return pd.DataFrame(_rows(key[0], made), columns=COLUMNS)

    return elements.select("doc_id", "idx", "text", "element_type", "row_type", "page", "section").groupBy("doc_id").applyInPandas(fold, CHUNKS)


def _is_head() -> Column:
    return F.coalesce(F.col("element_type").isin(*HEADS), F.lit(False))


def row_level(elements: DataFrame) -> DataFrame:
    """Each element with a text is a chunk; its section is its own or the last heading's."""
    order = Window.partitionBy("doc_id").orderBy("idx")
    last = F.last(F.when(_is_head(), F.col("text")), True).over(order)
    rows = elements.withColumn("section_of", F.coalesce(F.nullif("section", F.lit("")), last, F.lit(""))).where(~_is_head() & (F.length(T.strip("text")) > 0))
    return rows.select("doc_id", (F.row_number().over(order) - 1).alias("chunk_index"), "text", F.col("section_of").alias("section"), T.count_tokens("text").alias("token_count"))


def row_group(elements: DataFrame, group_size: int = 30) -> DataFrame:
    """``group_size`` elements a chunk, closed at headings; a table if it has any table row."""
    order = Window.partitionBy("doc_id").orderBy("idx")
    marked = elements.withColumn("part", F.sum(F.when(_is_head(), 1).otherwise(0)).over(order)).withColumn("section", F.coalesce(F.last(F.when(_is_head(), F.col("text")), True).over(order), F.lit("")))
    rows = marked.where(~_is_head() & (F.length(T.strip("text")) > 0))
    rows = rows.withColumn("grp", F.floor((F.row_number().over(Window.partitionBy("doc_id", "part").orderBy("idx")) - 1) / group_size))
    chunks = rows.groupBy("doc_id", "part", "grp").agg(
        F.expr("listagg(text, '\n') WITHIN GROUP (ORDER BY idx)").alias("text"), F.first("section").alias("section"), F.min("idx").alias("first_idx"),
        F.when(F.bool_or(F.coalesce(F.col("row_type") == "table_row", F.lit(False))), "table").otherwise("text").alias("chunk_type"),
    )
    return chunks.select("doc_id", (F.row_number().over(Window.partitionBy("doc_id").orderBy("first_idx")) - 1).alias("chunk_index"), "text", "section", "chunk_type", T.count_tokens("text").alias("token_count"))


def select_strategy(elements: DataFrame, hints: DataFrame) -> DataFrame:
    """A strategy for each document from its format hint (doc_id, format_hint) and number of elements."""
    n = elements.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    hint = F.col("format_hint")
    chosen = F.when((hint == "tabular") & (F.coalesce("n", F.lit(0)) < 50), "row_level").when(hint.isin("document", "mixed"), "structure_aware").otherwise("hierarchical")
    return hints.join(n, "doc_id", "left").select("doc_id", "format_hint", F.coalesce("n", F.lit(0)).alias("n"), chosen.alias("strategy"))


def split_text(text: Column, max_tokens: int = 512, overlap: int = 50) -> Column:
    """Windows of a text, as an array."""
    return _cut(lambda t: folds.split_chars(t or "", max_tokens, overlap))(text)


def split_rows(text: Column, max_tokens: int = 1536, header_lines: int = 1) -> Column:
    """Groups of a table's rows under its header, as an array."""
    return _cut(lambda t: folds.split_rows(t or "", max_tokens, header_lines))(text)


def _cut(split):
    # Without Arrow rows come a hundred at a time; Arrow batches may hold 10,000 texts and all their parts.
    return F.udf(split, "array<string>", useArrow=False)


def compare_strategies(elements: DataFrame, strategies: tuple[str, ...], **options) -> DataFrame:
    """A token report by strategy; each strategy runs on the same elements."""
    from lakeweave.operators.quality import token_report

    built = {"row_level": row_level, "row_group": row_group}
    kinds = [(built[s](elements) if s in built else chunk_elements(elements, s, **options)).select(F.lit(s).alias("strategy"), "token_count") for s in strategies]
    union = kinds[0]
    for k in kinds[1:]:
        union = union.unionByName(k)
    return token_report(union.withColumn("chunk_type", F.lit("text")), "strategy")


@udtf(returnType="part int, text string")
class SplitText:
    """K16 as a table function: split_text(text, max_tokens, overlap)."""

    def eval(self, text: str, max_tokens: int, overlap: int):
        yield from enumerate(folds.split_chars(text or "", max_tokens, overlap))


@udtf(returnType="part int, text string")
class SplitRows:
    """K17 as a table function: split_rows(text, max_tokens, header_lines)."""

    def eval(self, text: str, max_tokens: int, header_lines: int):
        yield from enumerate(folds.split_rows(text or "", max_tokens, header_lines))


def register_splitters(spark) -> None:
    spark.udtf.register("split_text", SplitText)
    spark.udtf.register("split_rows", SplitRows)
