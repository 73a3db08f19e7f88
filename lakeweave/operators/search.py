"""Retrieval: exact vector search, neighbour similarity, term retrieval with hit rates, deterministic vectors."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeweave.functions import text as T

#: Fixed value: pairs of a question and a chunk that J3 counts at a time.
PAIRS = 1 << 18


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Null if a side has no length."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def vector_search(chunks: DataFrame, documents: DataFrame, query: list[float], least: float = 0.3, k: int = 10, doc_filter: Column | None = None) -> DataFrame:
    """The k (1 to 50) most similar chunks of known documents, ties to the smaller chunk_id; the similarity is rounded to
    four places and a text cut to 500 characters."""
    sim = cosine(F.col("embedding"), F.array(*[F.lit(float(x)) for x in query]))
    rows = chunks.join(documents, "document_id").withColumn("similarity", sim).where(F.col("similarity") >= least)
    if doc_filter is not None:
        rows = rows.where(doc_filter)
    best = rows.orderBy(F.desc("similarity"), "chunk_id").limit(max(1, min(50, k))).withColumn("similarity", F.round("similarity", 4))
    return best.withColumn("text", F.substring("text", 1, 500)) if "text" in best.columns else best


def neighbour_similarity(vectors: DataFrame, reach: int = 2) -> DataFrame:
    """Mean cosine with the vectors whose index in the document is within ``reach``, and the norm; 0 is reported as null."""
    near = Window.partitionBy("document_id").orderBy("idx").rangeBetween(-reach, reach)
    rows = vectors.withColumn("near", F.collect_list(F.struct("idx", "embedding")).over(near))
    sims = F.filter(F.transform(F.filter("near", lambda x: x["idx"] != F.col("idx")), lambda x: cosine(F.col("embedding"), x["embedding"])), lambda s: s.isNotNull())
    mean = F.try_divide(F.aggregate(sims, F.lit(0.0), lambda a, x: a + x), F.size(sims))
    return rows.select("document_id", "idx", F.nullif(mean, F.lit(0.0)).alias("avg_similarity"), F.nullif(norm(F.col("embedding")), F.lit(0.0)).alias("embedding_norm"))


def text_density(text: Column) -> Column:
    """Share of characters that aren't white space."""
    return T.share(F.length(text) - T.count_chars(text, r"\s"), F.length(text))


def fake_embedding(text: Column, size: int = 1024) -> Column:
    """Component i is byte i mod 32 of the SHA-256, from -1 to 1."""
    digest = F.sha2(text, 256)
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.conv(F.substring(digest, F.pmod(i, F.lit(32)) * 2 + 1, F.lit(2)), 16, 10).cast("double") / 255 * 2 - 1)


def embed(chunks: DataFrame, text: str, encode, size: int, batch: int = 64, tries: int = 3, wait: float = 1.0) -> DataFrame:
    """Chunks with a column embedding from ``encode`` (a list of texts to a list of vectors), ``batch`` texts at a time. A
    failing call is tried again after growing waits; vectors of another size than ``size`` are an error. Blank texts get null."""
    from pyspark.sql.types import ArrayType, FloatType, StructField, StructType

    def run(frames):
        for pdf in frames:
            texts = pdf[text].fillna("").tolist()
            asked = [i for i, t in enumerate(texts) if t.strip()]
            found: list = [None] * len(texts)
            for at in range(0, len(asked), batch):
                part = asked[at : at + batch]
                for n in range(tries):
                    try:
                        vectors = encode([texts[i] for i in part])
                        break
                    except (OSError, TimeoutError):
                        if n + 1 == tries:
                            raise
                        time.sleep(wait * 2**n)
                if len(vectors) != len(part) or any(len(v) != size for v in vectors):
                    raise ValueError(f"the encoder gave other vectors than {len(part)} of {size} numbers")
                for i, v in zip(part, vectors, strict=True):
                    found[i] = [float(x) for x in v]
            yield pdf.assign(embedding=found)

    schema = StructType([*chunks.schema.fields, StructField("embedding", ArrayType(FloatType()))])
    return chunks.mapInPandas(run, schema)


def _best_pairs(questions, made, top_k: int):
    """For mapInArrow: the ``top_k`` best pairs of each of the questions (id, expected, terms) among a task's chunks (chunk_id, terms,
    low, n). A task holds its batch, about ``PAIRS`` pairs and the best so far, however many chunks it reads."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def run(batches):
        count = questions.num_rows
        if not count or top_k < 1:
            return
        expected = [[e for e in x or [] if e is not None] for x in questions["expected"].to_pylist()]
        points = 3 * np.array([len(x) for x in expected])
        # The inverted index: the questions of term t are asking[ends[t] : ends[t + 1]].
        lists = questions["terms"].combine_chunks()
        words, codes = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
        vocabulary = words.unique()
        term = pc.index_in(words, vocabulary).to_numpy()
        asking, ends = codes[np.argsort(term, kind="stable")].astype("int64"), np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(vocabulary)))])
        step, enough = max(1, PAIRS // count), max(1024, top_k * count)
        seen, floor, best, waiting = np.zeros(count, bool), np.zeros(count, "int64"), [], 0

        def overlaps(row, term, rows):
            size = ends[term + 1] - ends[term]
            at = np.arange(size.sum()) + np.repeat(ends[term] - (np.cumsum(size) - size), size)
            return np.bincount(np.repeat(row, size) * count + asking[at], minlength=rows * count).reshape(rows, count)

        def settle():
            """The best of all rows found so far; a question that shares terms by now loses those found without."""
            rows = pa.concat_tables(best)
            q = rows["q"].to_numpy()
            rows = rows.filter(pa.array((rows["overlap"].to_numpy() > 0) | ~seen[q]))
            rows = rows.sort_by([("q", "ascending"), ("score", "descending"), ("hits", "descending"), ("n", "descending"), ("chunk_id", "ascending")])
            q = rows["q"].to_numpy()
            rows = rows.filter(pa.array(np.arange(len(q)) - np.searchsorted(q, q) < top_k)).combine_chunks()
            q = rows["q"].to_numpy()
            full = np.bincount(q, minlength=count) == top_k
            floor[:] = 0
            last = np.searchsorted(q, np.flatnonzero(full), side="right") - 1
            floor[full] = rows["score"].to_numpy()[last]
            best[:] = [rows]

        for batch in batches:
            lists = batch.column("terms")
            words = lists.flatten()
            found = pc.index_in(words, vocabulary.cast(words.type))
            row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            known = found.is_valid().to_numpy(zero_copy_only=False)
            row, term = row[known], found.drop_null().to_numpy()
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                a, b = np.searchsorted(row, [start, start + part.num_rows])
                overlap = overlaps(row[a:b] - start, term[a:b], part.num_rows)
                new = overlap.any(axis=0) & ~seen
                seen |= new
                floor[new] = 0
                # A chunk gets 3 points at most for each expected term: one further below the k-th largest can't be among the best.
                least = np.maximum(floor, np.partition(overlap, part.num_rows - top_k, axis=0)[part.num_rows - top_k]) if part.num_rows >= top_k else floor
                i, q = np.nonzero(((overlap > 0) | ~seen) & (overlap + points >= np.maximum(least, 1)))
                low = part.column("low")
                texts = {x: low[x].as_py() for x in np.unique(i).tolist()}
                hits = np.array([sum(e in texts[x] for e in expected[y]) for x, y in zip(i.tolist(), q.tolist(), strict=True)], "int32")
                overlap = overlap[i, q]
                score = overlap + 3 * hits
                keep = score >= np.maximum(least[q], 1)
                if keep.any():
                    i = pa.array(i[keep])
                    best.append(pa.table({"q": q[keep], "overlap": overlap[keep], "score": score[keep], "hits": hits[keep], "n": part.column("n").take(i), "chunk_id": part.column("chunk_id").take(i)}))
                    waiting += len(i)
                if waiting >= enough:
                    settle()
                    waiting = 0
        if best:
            settle()
            rows = best[0].append_column("id", questions["id"].combine_chunks().take(best[0]["q"].combine_chunks()))
            yield from rows.select(made.names).cast(made).to_batches()

    return run


def retrieval_scores(questions: DataFrame, chunks: DataFrame, top_k: int = 5) -> DataFrame:
    """For each question (id, question, expected) its top chunks (chunk_id, text). Candidates share a term with it through
    an inverted index; a question that shares none is compared with all chunks, for which the expected terms alone can score.
    The questions are a set that the driver and a task can hold. Each task reads its chunks once and keeps the best of each question,
    so no table of pairs is made; while no chunk of a task shared a term, the task keeps the best by expected terms."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import IntegerType, LongType, StructField, StructType

    terms = F.array_distinct(F.concat(T.search_tokens("question"), F.flatten(F.transform("expected", T.search_tokens))))
    asked = questions.where("id IS NOT NULL").select("id", F.transform("expected", lambda e: F.lower(e).cast("binary")).alias("expected"), terms.alias("terms"))
    read = chunks.where("chunk_id IS NOT NULL AND text IS NOT NULL").select("chunk_id", F.array_distinct(T.search_tokens("text")).alias("terms"), F.lower("text").cast("binary").alias("low"), F.length("text").alias("n"))
    schema = StructType([asked.schema["id"], read.schema["chunk_id"], StructField("overlap", LongType()), StructField("score", LongType()), StructField("hits", IntegerType()), StructField("n", IntegerType())])
    found = read.mapInArrow(_best_pairs(asked.toArrow(), to_arrow_schema(schema), top_k), schema)
    shares = F.bool_or(F.col("overlap") > 0).over(Window.partitionBy("id"))
    rows = found.withColumn("shares", shares).where(F.col("shares") == (F.col("overlap") > 0))
    order = Window.partitionBy("id").orderBy(F.desc("score"), F.desc("hits"), F.desc("n"), "chunk_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_k).select("id", "rank", "chunk_id", "score", "hits")


def hit_rate(questions: DataFrame, scored: DataFrame) -> DataFrame:
    """Questions, hits among their top chunks, and the share."""
    hit = scored.groupBy("id").agg(F.bool_or(F.col("hits") > 0).alias("hit"))
    rows = questions.select("id").join(hit, "id", "left").select(F.coalesce("hit", F.lit(False)).alias("hit"))
    return rows.agg(F.count(F.lit(1)).alias("questions"), F.count_if("hit").alias("hits"), T.share(F.count_if("hit"), F.count(F.lit(1))).alias("hit_rate"))
