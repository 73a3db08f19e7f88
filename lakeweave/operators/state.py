"""Tables that change: paging, edits, upserts, incremental ingest, integrity checks. Snapshots in, snapshots out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeweave.functions import text as T
from lakeweave.functions import urls as U


def page_of(rows: DataFrame, order: list[Column], limit: int, offset: int = 0) -> DataFrame:
    """A page of ordered rows (order must end in a key)."""
    return rows.orderBy(*order).offset(offset).limit(limit)


def filtered_page(rows: DataFrame, tests: list[Column], order: list[Column], limit: int, offset: int = 0) -> DataFrame:
    """A page of the rows for which all tests hold, with the number of all such rows."""
    kept = rows
    for t in tests:
        kept = kept.where(t)
    return page_of(kept, order, limit, offset).crossJoin(F.broadcast(kept.agg(F.count(F.lit(1)).alias("total"))))  # one row


def next_index(chunks: DataFrame) -> DataFrame:
    """The next free index of each document."""
    return chunks.groupBy("doc_id").agg((F.coalesce(F.max("chunk_index"), F.lit(-1)) + 1).alias("next_index"))


def merge_chunks(chunks: DataFrame, picked: Column, separator: str = "\n\n") -> DataFrame:
    """The picked chunks of each document become one at the first one's place; the other indexes stay."""
    chosen = chunks.where(picked)
    joined = chosen.groupBy("doc_id").agg(F.min("chunk_index").alias("chunk_index"), F.expr(f"listagg(text, '{separator}') WITHIN GROUP (ORDER BY chunk_index)").alias("text"), F.count(F.lit(1)).alias("merged"))
    return chunks.where(~picked).select("doc_id", "chunk_index", "text", F.lit(1).cast("long").alias("merged")).unionByName(joined)


def _spread_parts(made: DataFrame) -> DataFrame:
    """Rows with an array of parts become a row for each, and later indexes of their document move up."""
    grown = F.sum(F.size("parts") - 1).over(Window.partitionBy("doc_id").orderBy("chunk_index").rowsBetween(Window.unboundedPreceding, -1))
    moved = made.withColumn("base", F.col("chunk_index") + F.coalesce(grown, F.lit(0)))
    return moved.select("doc_id", "base", F.posexplode("parts").alias("pos", "text")).select("doc_id", (F.col("base") + F.col("pos")).cast("long").alias("chunk_index"), "text")


def _sound_parts(parts: Column) -> Column:
    """Stripped parts that aren't empty; a split that gives fewer than two leaves the chunk as it is."""
    kept = F.filter(F.transform(parts, T.strip), lambda p: p != "")
    return F.when(F.size(kept) >= 2, kept).otherwise(F.array("text"))


def split_chunk(chunks: DataFrame, picked: Column, pattern: str) -> DataFrame:
    """Picked chunks are split by a pattern into two parts or more; later indexes move up."""
    return _spread_parts(chunks.withColumn("parts", F.when(picked, _sound_parts(F.split("text", pattern))).otherwise(F.array("text"))))


def split_chunk_at(chunks: DataFrame, picks: DataFrame) -> DataFrame:
    """Chunks that picks (doc_id, chunk_index, positions array<int>) name are split at the positions within their texts."""
    inner = F.array_sort(F.array_distinct(F.filter("positions", lambda p: (p > 0) & (p < F.length("text")))))
    edges = F.concat(F.array(F.lit(0)), inner, F.array(F.length("text")))
    cut = F.transform(F.sequence(F.lit(1), F.size(edges) - 1), lambda i: F.substring(F.col("text"), F.get(edges, i - 1) + 1, F.get(edges, i) - F.get(edges, i - 1)))
    both = chunks.join(picks, ["doc_id", "chunk_index"], "left")
    return _spread_parts(both.withColumn("parts", F.when(F.col("positions").isNotNull(), _sound_parts(cut)).otherwise(F.array("text"))).drop("positions"))


def edit_chunks(chunks: DataFrame, edits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chunks with new texts (doc_id, chunk_index, new_text), and history rows of what changed."""
    both = chunks.join(edits, ["doc_id", "chunk_index"], "left")
    history = both.where("new_text IS NOT NULL AND NOT new_text <=> text").select("doc_id", "chunk_index", F.col("text").alias("old_text"), "new_text", F.lit("edit").alias("action"))
    return both.select("doc_id", "chunk_index", F.coalesce("new_text", "text").alias("text")), history


def reembed(edited: DataFrame, vectors: DataFrame, history: DataFrame, encode, size: int) -> DataFrame:
    """Vectors (doc_id, chunk_index, embedding) after edits: chunks whose text has changed are encoded again, the others keep theirs."""
    from lakeweave.operators.search import embed

    on = ["doc_id", "chunk_index"]
    changed = history.select(on).distinct()
    new = embed(edited.join(changed, on, "left_semi").select(*on, "text"), "text", encode, size).select(*on, "embedding")
    return vectors.join(changed, on, "left_anti").select(*on, "embedding").unionByName(new)


def delete_rows(rows: DataFrame, keys: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows without the keys, and the deleted ones for the history."""
    return rows.join(keys.select(on).distinct(), on, "left_anti"), rows.join(keys.select(on).distinct(), on, "left_semi")


def delete_cascade(keys: DataFrame, tables: list[tuple[str, DataFrame, str, str]]) -> dict[str, DataFrame]:
    """Tables (name, rows, key of the owner, own key) without what belongs to the deleted keys, each table's rows
    belonging to those of the table before it."""
    out, gone = {}, keys.select(F.col(keys.columns[0]).alias("gone_")).distinct()
    for name, rows, owner, own in tables:
        out[name] = rows.join(gone, rows[owner] == gone["gone_"], "left_anti")
        gone = rows.join(gone, rows[owner] == gone["gone_"], "left_semi").select(F.col(own).alias("gone_")).distinct()
    return out


def upsert(old: DataFrame, new: DataFrame, key: str, sticky: tuple[str, ...] = ("approved", "rejected")) -> DataFrame:
    """New rows replace old ones, but rows with a sticky status stay as they are (tables have key, status, score)."""
    joined = old.alias("o").join(new.alias("n"), key, "full")
    stays = F.col("o.status").isin(*sticky)
    pick = lambda c: F.when(F.coalesce(stays, F.lit(False)), F.col(f"o.{c}")).otherwise(F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}"))).alias(c)
    return joined.select(key, *[pick(c) for c in old.columns if c != key])


def ranked(sources: DataFrame, status: str | None = None) -> DataFrame:
    """Sources by score, with their place as priority."""
    from lakeweave.sources.discovery import numbered

    rows = sources if status is None else sources.where(F.col("status") == status)
    placed = numbered(rows.withColumn("at", F.struct((-F.col("score")).alias("down"), "url")), "at")
    return placed.select(*sources.columns, (F.col("pos") + 1).cast("int").alias("priority"))


def union_state(old: DataFrame, new: DataFrame) -> DataFrame:
    """A set grows."""
    return old.union(new).distinct()


def merge_maps(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """The newer value of each key wins."""
    return old.alias("o").join(new.alias("n"), key, "full").select(key, F.coalesce(F.col(f"n.{value}"), F.col(f"o.{value}")).alias(value))


def append_new(old: DataFrame, new: DataFrame, on: list[str]) -> DataFrame:
    """Append rows whose key isn't there yet."""
    return old.unionByName(new.join(old.select(on), on, "left_anti").dropDuplicates(on))


def set_default(rows: DataFrame, key: str, chosen) -> DataFrame:
    """Exactly one default row."""
    return rows.withColumn("is_default", F.col(key) == F.lit(chosen))


def failure_streak(events: DataFrame, threshold: int = 20) -> DataFrame:
    """Rows (prefix, pos, failed): after ``threshold`` failures in a row, the prefix's later rows are skipped."""
    order = Window.partitionBy("prefix").orderBy("pos")
    runs = events.withColumn("run", F.sum(F.when(F.col("failed"), 0).otherwise(1)).over(order))
    length = F.row_number().over(Window.partitionBy("prefix", "run").orderBy("pos")) - F.when(F.col("run") > 0, 1).otherwise(0)
    full = F.min(F.when(F.col("failed") & (F.col("length") >= threshold), F.col("pos"))).over(Window.partitionBy("prefix"))
    return runs.withColumn("length", length).withColumn("full_at", full).select(*events.columns, F.coalesce(F.col("pos") > F.col("full_at"), F.lit(False)).alias("skipped"))


def exact_dedup(rows: DataFrame, text: str, order: str) -> DataFrame:
    """The first row (by order) of each content hash."""
    first = rows.groupBy(F.sha2(text, 256).alias("h")).agg(F.min(order).alias(order))
    return rows.join(first.select(order), order, "left_semi")


def ingest_plan(urls: DataFrame, processed: DataFrame, dead: DataFrame, batch: int = 0) -> DataFrame:
    """Product URLs that are neither processed nor dead, in priority order."""
    todo = urls.where(U.is_product("url")).join(processed.select("url").distinct(), "url", "left_anti").join(dead.select("url").distinct(), "url", "left_anti")
    todo = todo.orderBy(U.priority("url"), "url")
    return todo.limit(batch) if batch else todo


def ingest_status(pages: DataFrame, known_hashes: DataFrame, min_blocks: int = 3, min_score: int = 2) -> DataFrame:
    """The status cascade for fetched pages (url, html, n_blocks, score, gate): error, duplicate, sparse, not a product, quarantined, processed."""
    hashed = pages.withColumn("sha256", F.sha2("html", 256)).join(known_hashes.select("sha256", F.lit(True).alias("known")).distinct(), "sha256", "left")
    # The first page of each content, pre-aggregated; pages without any (failed fetches) meet nowhere.
    first = hashed.where("sha256 IS NOT NULL").groupBy("sha256").agg(F.min("url").alias("first"))
    hashed = hashed.join(first, "sha256", "left")
    again = F.col("url") != F.col("first")
    status = (
        F.when(F.col("html").isNull(), "fetch_error")
        .when(F.coalesce("known", F.lit(False)) | again, "duplicate")
        .when(F.col("n_blocks") < min_blocks, "skipped_sparse")
        .when(F.col("score") < min_score, "skipped_not_product")
        .when(F.col("gate") == "warn", "quarantined")
        .otherwise("processed")
    )
    return hashed.select("url", "sha256", status.alias("status"))


def integrity_errors(outcomes: DataFrame, files: DataFrame) -> DataFrame:
    """Processed outcomes (doc_index, directory) without their three files, and repeated or negative indexes."""
    wanted = outcomes.where("status = 'processed'").select("doc_index", F.explode(F.transform(F.array(*[F.lit(n) for n in ("document.json", "chunks.json", "quality.json")]), lambda n: F.concat("directory", F.lit("/"), n))).alias("path"))
    missing = wanted.join(files.select("path"), "path", "left_anti").select("doc_index", F.concat(F.lit("missing "), "path").alias("error"))
    repeated = outcomes.groupBy("doc_index").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_index < 0").select("doc_index", F.lit("bad index").alias("error"))
    return missing.unionByName(repeated)


def best_by_domain(candidates: DataFrame) -> DataFrame:
    """The best URL of each domain; its score grows by half (floored) of the others'."""
    order = Window.partitionBy("domain").orderBy(F.desc("score"), "pos")
    whole = Window.partitionBy("domain")
    rows = candidates.withColumn("domain", U.domain("url")).withColumn("place", F.row_number().over(order)).withColumn("total", F.sum("score").over(whole)).withColumn("domain_urls_found", F.count(F.lit(1)).over(whole))
    return rows.where("place = 1").select("domain", "url", (F.col("score") + F.floor((F.col("total") - F.col("score")) / 2)).alias("score"), "domain_urls_found")


def rank_sources(candidates: DataFrame, probes: DataFrame, top_n: int, least: int = 12) -> DataFrame:
    """Scores added up over queries, best by domain, probe bonuses, the cut at ``least``, and ranks from 1."""
    added = candidates.groupBy("url").agg(F.sum("score").alias("score"), F.min("pos").alias("pos"))
    kept = best_by_domain(added).orderBy(F.desc("score"), "url").limit(max(3 * top_n, 40))
    p = lambda c: F.coalesce(F.col(c), F.lit(0))
    bonus = F.least(p("file_links"), F.lit(20)) + F.least(F.floor(p("product_links") / 2), F.lit(15)) + F.least(p("relevance"), F.lit(12)) + F.when(F.coalesce("pagination", F.lit(False)), 10).otherwise(0) - F.when(F.coalesce("error", F.lit(False)), 8).otherwise(0)
    scored = kept.join(probes, "url", "left").withColumn("score", F.col("score") + bonus).where(F.col("score") >= least)
    ranked_ = scored.orderBy(F.desc("score"), "url").limit(top_n)  # at most top_n rows meet in the rank's window
    return ranked_.select(F.row_number().over(Window.orderBy(F.desc("score"), "url")).alias("rank"), "domain", "url", "score", "domain_urls_found")


def probe_pages(pages: DataFrame, terms: tuple[str, ...] = ()) -> DataFrame:
    """Link counts of a page (url, html), whether it has pages of a list, and the mode to crawl it in."""
    links = F.transform(U.anchors("html"), lambda h: U.resolve(F.col("url"), h))
    count = lambda test: F.size(F.filter(links, test))
    low = F.lower("html")
    rows = pages.select("url", count(U.is_file_link).alias("file_links"), count(lambda x: U.path(x).rlike(U.PRODUCT_PATH)).alias("product_links"), sum([F.when(low.contains(t), 1).otherwise(0) for t in terms], F.lit(0)).alias("relevance"), F.exists(links, lambda x: x.rlike(r"(?i)[?&](page|p|pg|start|offset)=\d+")).alias("pagination"))
    return rows.withColumn("mode", F.when(F.col("file_links") >= 5, "files").when(F.col("product_links") > 0, "web").otherwise("mixed"))
