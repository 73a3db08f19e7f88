"""Quality gates and summaries: two-level hash aggregates over chunks (doc_id, chunk_index, text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeweave.functions import text as T

#: Thresholds of the two gates.
GATE = {"min_tokens": 20, "max_empty": 0.0, "max_tiny": 0.8, "max_duplicate": 0.25, "max_noisy": 0.1, "max_oversized": 0.0, "max_tokens": 1200}
LEGACY_GATE = {"min_tokens": 40, "max_empty": 0.01, "max_tiny": 0.35, "max_duplicate": 0.25, "max_noisy": 0.30}


def enrich_documents(blocks: DataFrame) -> DataFrame:
    """G1: per document its number of blocks and characters, and a SHA-256 over its blocks in order, each ended by NUL."""
    joined = F.expr("listagg(concat(text, chr(0)), '') WITHIN GROUP (ORDER BY idx)")
    return blocks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("block_count"), F.sum(F.length("text")).alias("char_count"), F.sha2(joined, 256).alias("content_sha256"))


def enrich_chunks(chunks: DataFrame) -> DataFrame:
    """G1: per chunk its folded hash, characters and language."""
    return chunks.select("doc_id", "chunk_index", F.sha2(T.fold_text("text"), 256).alias("chunk_sha256"), F.length("text").alias("char_count"), T.script_language("text").alias("lang"))


def _counts(chunks: DataFrame, min_tokens: int, noisy, noisy_on: Column, max_tokens: int | None, extra: list[Column]) -> DataFrame:
    """Per document the counts that both gates share. Chunks of equal folded text meet per document first."""
    body = T.strip(F.coalesce("text", F.lit("")))
    rows = chunks.select("doc_id", body.alias("body"), (F.col("token_count") if "token_count" in chunks.columns else F.lit(None)).alias("given"))
    rows = rows.withColumn("n", F.coalesce(F.nullif("given", F.lit(0)), T.count_tokens("body"))).withColumn("filled", F.col("body") != "")
    rows = rows.select("doc_id", F.sha2(T.fold_text("body"), 256).alias("h"), "filled", "n", (F.col("filled") & noisy(noisy_on)).alias("noise"))
    one = F.lit(1)
    per_hash = rows.groupBy("doc_id", "h", "filled").agg(
        F.count(one).alias("c"), F.count_if(F.col("filled") & (F.col("n") < min_tokens)).alias("tiny"), F.count_if("noise").alias("noise"),
        F.count_if(F.col("filled") & (F.col("n") > (max_tokens or 2**31 - 1))).alias("over"), F.sum(F.when(F.col("filled"), F.col("n"))).alias("tokens"), F.max(F.when(F.col("filled"), F.col("n"))).alias("most"),
    )
    return per_hash.groupBy("doc_id").agg(
        F.sum("c").alias("chunk_count"), F.sum(F.when(~F.col("filled"), F.col("c")).otherwise(0)).alias("empty_count"), F.sum("tiny").alias("tiny_count"),
        F.sum(F.when(F.col("filled"), F.col("c") - 1).otherwise(0)).alias("duplicate_count"), F.sum("noise").alias("noisy_count"), F.sum("over").alias("oversized_count"),
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("total_tokens"), F.coalesce(F.max("most"), F.lit(0)).alias("max_tokens"), *extra,
    )


def quality_gate(chunks: DataFrame, **thresholds) -> DataFrame:
    """Counts, findings (codes in a fixed order) and passed, by unrounded ratios over all chunks."""
    t = GATE | thresholds
    counts = _counts(chunks, t["min_tokens"], T.is_noisy, F.col("body"), t["max_tokens"], [])
    over = lambda name, most: F.when(F.col(f"{name}_count") > F.lit(most) * F.col("chunk_count"), F.lit(f"{name}_ratio"))
    found = F.array_compact(F.array(*[over(k, t[f"max_{k}"]) for k in ("empty", "tiny", "duplicate", "noisy", "oversized")]))
    return counts.withColumn("findings", found).withColumn("passed", F.size("findings") == 0)


def legacy_gate(chunks: DataFrame, **thresholds) -> DataFrame:
    """Pass, warn or fail by four ratios; noise is tested on the folded text, where the table exemption can't apply."""
    t = LEGACY_GATE | thresholds
    counts = _counts(chunks, t["min_tokens"], T.is_noisy_legacy, T.fold_text("body"), None, [])
    bad = [F.col(f"{k}_count") > F.lit(t[f"max_{k}"]) * F.col("chunk_count") for k in ("empty", "tiny", "duplicate", "noisy")]
    filled = F.col("chunk_count") - F.col("empty_count")
    average = F.coalesce(F.try_divide("total_tokens", filled), F.lit(0.0)).cast("int")
    return counts.select("doc_id", "chunk_count", "empty_count", "tiny_count", "duplicate_count", "noisy_count", average.alias("avg_tokens"), "max_tokens", F.when(T.any_of(bad), "warn").otherwise("pass").alias("status"))


def gate_dataset(gates: DataFrame, done: DataFrame | None = None, limit: int = 0) -> DataFrame:
    """Processed, skipped, pass and warn counts; documents in ``done`` are skipped."""
    todo = gates if done is None else gates.join(done.select("doc_id").distinct(), "doc_id", "left_anti")
    if limit:
        todo = todo.orderBy("doc_id").limit(limit)
    got = todo.agg(F.count(F.lit(1)).alias("processed_count"), F.count_if(F.col("status") == "pass").alias("pass_count"), F.count_if(F.col("status") == "warn").alias("warn_count"))
    skipped = gates.join(done.select("doc_id").distinct(), "doc_id", "left_semi").agg(F.count(F.lit(1)).alias("skipped_count")) if done is not None else gates.limit(0).agg(F.count(F.lit(1)).alias("skipped_count"))
    return got.crossJoin(skipped)  # one row each


def token_report(chunks: DataFrame, *keys: str) -> DataFrame:
    """Token totals by the given keys (a document, a strategy), with counts by chunk type as sorted entries."""
    by_type = chunks.groupBy(*keys, "chunk_type").agg(F.count(F.lit(1)).alias("c"), F.sum("token_count").alias("s"), F.min("token_count").alias("lo"), F.max("token_count").alias("hi"))
    return by_type.groupBy(*keys).agg(F.sum("c").alias("total_chunks"), F.sum("s").alias("total_tokens"), (F.sum("s") / F.sum("c")).alias("avg_tokens"), F.min("lo").alias("min_tokens"), F.max("hi").alias("max_tokens"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("chunk_type", "c")))).alias("by_type"))


def first_samples(chunks: DataFrame, *keys: str, n: int = 5) -> DataFrame:
    """The first n chunks of each key."""
    return chunks.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("chunk_index"))).where(F.col("place") <= n)


def sum_logs(logs: DataFrame, sums: dict[str, list[str]], maxima: tuple[str, ...] = (), averages: tuple[str, ...] = ()) -> DataFrame:
    """Global sums with older keys as fallbacks, maxima, and truncated averages of positive values."""
    have = lambda names: F.coalesce(*[F.col(n) for n in names if n in logs.columns], F.lit(0))
    return logs.agg(*[F.coalesce(F.sum(have(names)), F.lit(0)).alias(out) for out, names in sums.items()], *[F.coalesce(F.max(m), F.lit(0)).alias(m) for m in maxima], *[F.coalesce(F.avg(F.when(F.col(a) > 0, F.col(a))), F.lit(0.0)).cast("int").alias(a) for a in averages])


def rechunk_metrics(per_doc: DataFrame) -> DataFrame:
    """Chunks, the weighted average of tokens (floored), and documents with a tiny average."""
    n, s = F.sum("chunk_count"), F.sum(F.col("avg_tokens") * F.col("chunk_count"))
    return per_doc.agg(F.count(F.lit(1)).alias("docs"), n.alias("chunks"), F.floor(s / F.greatest(n, F.lit(1))).alias("avg_tokens"), F.count_if(F.col("avg_tokens") < 150).alias("tiny_docs"))


def metric_deltas(before: DataFrame, after: DataFrame) -> DataFrame:
    """Before, after and difference, a row for each metric."""
    long = lambda df, name: df.unpivot([], [F.col(c).cast("double").alias(c) for c in df.columns], "metric", name)
    return long(before, "before").join(long(after, "after"), "metric").withColumn("delta", F.col("after") - F.col("before"))


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """A histogram of statuses."""
    return outcomes.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def manifest_summary(outcomes: DataFrame) -> DataFrame:
    """Counts by outcome, and complete, partial or failed."""
    is_ = lambda s: F.count_if(F.col("status") == s)
    counted = outcomes.agg(is_("processed").alias("processed"), is_("skipped").alias("skipped"), is_("failed").alias("failed"), F.count_if(F.coalesce(~F.col("quality_passed"), F.lit(False))).alias("quality_failed"))
    return counted.withColumn("overall", F.when(F.col("processed") == 0, "failed").when((F.col("failed") > 0) | (F.col("skipped") > 0), "partial").otherwise("complete"))


def dataset_inventory(reports: DataFrame) -> DataFrame:
    """Per document sorted distinct finding codes and severities that occur; reports have findings array<struct<code, severity>>."""
    codes = F.array_sort(F.array_distinct(F.transform("findings", lambda f: f["code"])))
    severity = F.array(F.lit("error"), F.lit("info"), F.lit("warning"))
    counts = F.transform(severity, lambda s: F.struct(s.alias("severity"), F.size(F.filter("findings", lambda f: f["severity"] == s)).alias("n")))
    return reports.select("doc_id", "blocks", "chunks", codes.alias("codes"), F.map_from_entries(F.filter(counts, lambda c: c["n"] > 0)).alias("severities"))
