"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Characters are lower-cased and everything but letters and digits becomes a space, so that n-grams see
where words begin and end. n-grams of ``ORDERS`` characters are hashed to ``1 << BITS`` buckets; a
document's features are the buckets that it has. Ratio r = log of (toxic documents with the bucket,
smoothed, by all of theirs) over the same of clean documents. Buckets whose shares differ by ``LEAST_Z``
standard errors or more are kept, scaled by r, and weighted by an L2-regularised logistic regression, which
shrinks what differs by chance; its intercept is moved by the class shares of all labelled rows.

Bound: the model is fitted on at most ``per_class`` labelled rows of each class, those with the smallest
hash of their id among those whose document exists, whatever the size of the tables (a documented sample);
whole texts are used. Counts are summed in executors; the driver takes the lessons' kept features a part at
a time and walks over them in slices, so that no feature has to go for its memory. Scores are computed for every document in one pass; the weights are the only thing that is sent to workers.

Cases: a null or empty text gets the intercept's score. Several labels of a doc_id count as the largest,
and several texts of a doc_id teach once, with the smallest text.
Labels that are null, or whose text is missing, teach nothing. Without labelled rows of both classes the
score is the share of toxic labels (0 without any). Null doc_ids are scored. Empty tables give no rows.
Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweave.llm.common import byte_slices, bytes_of, crc_bucket, spread, written

ORDERS = (3, 4, 5, 6, 7)
BITS = 18
#: Most labelled rows of each class that the model is fitted on.
PER_CLASS = 2500
#: Standard errors by which a bucket's shares have to differ: nine toxic documents of 2500 and no clean one suffice.
LEAST_Z = 3.0
U = np.uint64
#: Buckets whose counts are summed together, and (row, bucket) pairs that a gradient looks at together.
PART, PAIRS = 1 << 12, 1 << 19
#: Bytes of text that are described or scored at a time; a longer text is alone.
LESSON_BYTES, SCORE_BYTES = 1 << 18, 1 << 20


def _letters() -> np.ndarray:
    """The character that each of the first 65,536 code points counts as."""
    table = np.arange(65536, dtype=np.uint32)
    for c in range(65536):
        if 0xD800 <= c < 0xE000:
            continue
        low = chr(c).lower()
        table[c] = ord(low) if low.isalnum() and len(low) == 1 else c if chr(c).isalnum() else 32
    return table


_table: list[np.ndarray] = []


def characters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(mapped code points, offsets of each text) of a large_string array."""
    if not _table:
        _table.append(_letters())
    data, off = bytes_of(texts)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    begins = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    low = np.minimum(points, 65535)
    return np.where(points < 65536, _table[0][low], points), begins[off]


def buckets(points: np.ndarray, off: np.ndarray):
    """For each order: bucket of the n-gram at each place; n-grams across texts get bucket 0, which no one uses."""
    rolling = points.astype(np.uint64)
    wide = rolling.copy()
    for n in range(2, max(ORDERS) + 1):
        if len(points) < n:
            return
        rolling = rolling[: len(points) - n + 1] * U(0x100000001B3) + wide[n - 1 :]
        if n in ORDERS:
            found = ((rolling * U(0x9E3779B97F4A7C15 + 2 * n)) >> U(64 - BITS)).astype(np.int32)
            found[found == 0] = 1
            ends = off[1:-1, None] - np.arange(1, n)[None, :]
            ends = ends[(ends >= 0) & (ends < len(found))]
            found[ends] = 0
            yield n, found


def features(texts: pa.Array, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, bucket) pairs among the used buckets, sorted."""
    points, off = characters(texts)
    pairs = [np.zeros(0, np.int64)]
    for _, found in buckets(points, off):
        at = np.flatnonzero(used[found])
        pairs.append(((np.searchsorted(off, at, "right") - 1) << BITS) | found[at])
    pairs = np.unique(np.concatenate(pairs))
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


@dataclass
class Model:
    weights: np.ndarray  # float32, 0 for unused buckets
    intercept: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        rows, cols = features(texts, self.weights != 0)
        margin = np.bincount(rows, self.weights[cols].astype(np.float64), minlength=len(texts)) + self.intercept
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def minimise(gradient, x: np.ndarray, rounds: int = 200, memory: int = 8, close: float = 1e-6) -> np.ndarray:
    """L-BFGS with backtracking. gradient(x) gives (value, gradient)."""
    value, slope = gradient(x)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        step, used = slope.copy(), []
        for s, y, rho in reversed(past):
            used.append(a := rho * (s @ step))
            step -= a * y
        if past:
            s, y, _ = past[-1]
            step *= (s @ y) / (y @ y)
        for (s, y, rho), a in zip(past, reversed(used), strict=True):
            step += s * (a - rho * (y @ step))
        size, down = 1.0 if past else 1.0 / max(1.0, np.abs(slope).sum()), slope @ step
        while True:
            new_x = x - size * step
            new_value, new_slope = gradient(new_x)
            if new_value <= value - 1e-4 * size * down or size < 1e-10:
                break
            size /= 2
        s, y = new_x - x, new_slope - slope
        if (curve := s @ y) > 1e-12:
            past = [*past[-(memory - 1) :], (s, y, 1 / curve)]
        done = abs(value - new_value) <= close * max(1.0, abs(value))
        x, value, slope = new_x, new_value, new_slope
        if done:
            break
    return x


def ratios(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int, least_z: float = LEAST_Z) -> np.ndarray:
    """Log-count ratios of the buckets whose shares differ by least_z standard errors; 0 for the others."""
    p, q, both = toxic / n_toxic, clean / n_clean, (toxic + clean) / (n_toxic + n_clean)
    spread_ = np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / n_toxic + 1 / n_clean))
    r = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    return np.where((np.abs(p - q) >= least_z * spread_) & (toxic + clean >= 5), r, 0.0)


def fit_weights(rows: np.ndarray, cols: np.ndarray, labels: np.ndarray, r: np.ndarray, l2: float = 1.0) -> tuple[np.ndarray, float]:
    """Logistic regression on features r of (row, bucket) pairs sorted by row: weights times r, and the intercept."""
    chosen = np.flatnonzero(r)
    place = np.zeros(len(r), np.int32)
    place[chosen] = np.arange(len(chosen))
    col, scale, y = place[cols], r[chosen], labels.astype(np.float64)
    slices = [slice(at, at + PAIRS) for at in range(0, len(col), PAIRS)]

    def gradient(w):
        margin, scaled, slope = np.full(len(y), w[-1]), w[:-1] * scale, np.zeros(len(chosen))
        for s in slices:
            margin += np.bincount(rows[s], scaled[col[s]], minlength=len(y))
        value = np.logaddexp(0, margin).sum() - y @ margin + l2 / 2 * (w[:-1] @ w[:-1])
        error = 1 / (1 + np.exp(-np.clip(margin, -500, 500))) - y
        for s in slices:
            slope += np.bincount(col[s], error[rows[s]], minlength=len(chosen))
        return value, np.append(slope * scale + l2 * w[:-1], error.sum())

    w = minimise(gradient, np.zeros(len(chosen) + 1))
    weights = np.zeros(len(r), np.float32)
    weights[chosen] = w[:-1] * r[chosen]
    return weights, float(w[-1])


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, teaches, per_class: int = PER_CLASS) -> Model:
    """Fit on labelled documents for which the column ``teaches`` (of doc_id) holds."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    known = known.where(teaches).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = written(spark, known, "labels")
    shares = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not shares.get(0) or not shares.get(1):
        share = shares.get(1, 0) / max(1, sum(shares.values()))
        return Model(np.zeros(1 << BITS, np.float32), float(np.log(share / (1 - share))) if 0 < share < 1 else (500.0 if share else -500.0))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    there = written(spark, known.join(texts.select("doc_id"), "doc_id", "left_semi"), "labelled-documents")
    hashed = there.withColumn("h", F.xxhash64("doc_id"))
    sample = hashed.where("toxic = 1").orderBy("h", "doc_id").limit(per_class).unionByName(hashed.where("toxic = 0").orderBy("h", "doc_id").limit(per_class)).select("doc_id", "toxic")
    # The sample has at most 2 * per_class short rows, so it may be broadcast at any input size.
    taught = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
    lessons = written(spark, taught.select("text", "toxic"), "lessons")
    lessons = lessons.repartition(min(16, spark.sparkContext.defaultParallelism))  # each part shuffles 2 MB of counts

    n = np.zeros(2, np.int64)
    for row in lessons.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect():
        n[row.toxic] = row.n
    if not n.all():
        return Model(np.zeros(1 << BITS, np.float32), float(np.log(shares[1] / shares[0])))

    def count(batches):
        counts = np.zeros((2, 1 << BITS), np.int32)
        every = np.ones(1 << BITS, bool)
        every[0] = False
        for batch in batches:
            toxic = batch.column("toxic").to_numpy()
            for at, part in byte_slices(batch.column("text"), LESSON_BYTES):
                rows, cols = features(part, every)
                here = toxic[at : at + len(part)]
                for k in (0, 1):
                    counts[k] += np.bincount(cols[here[rows] == k], minlength=1 << BITS).astype(np.int32)
        for at in range(0, 1 << BITS, PART):
            yield pa.RecordBatch.from_pydict({"part": pa.array([at], pa.int32()), "counts": [counts[:, at : at + PART].tobytes()]})

    def compare(table: pa.Table) -> pa.Table:
        counts = sum(np.frombuffer(c.as_buffer(), np.int32).reshape(2, -1).astype(np.int64) for c in table["counts"])
        return pa.table({"part": table["part"].slice(0, 1), "r": [ratios(counts[1], counts[0], int(n[1]), int(n[0])).tobytes()]})

    r = np.zeros(1 << BITS)
    for row in lessons.mapInArrow(count, "part int, counts binary").groupBy("part").applyInArrow(compare, "part int, r binary").collect():
        r[row.part : row.part + PART] = np.frombuffer(row.r)

    def describe(batches):
        for batch in batches:
            toxic, at_most = batch.column("toxic"), r != 0
            for at, part in byte_slices(batch.column("text"), LESSON_BYTES):
                rows, cols = features(part, at_most)
                cut = np.searchsorted(rows, np.arange(len(part) + 1))
                yield pa.RecordBatch.from_arrays([toxic.slice(at, len(part)), pa.array([cols[a:b].astype(np.int32).tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())], names=["toxic", "cols"])

    cols, taught = [], []
    for row in written(spark, lessons.mapInArrow(describe, "toxic int, cols binary"), "described").toLocalIterator():
        cols.append(np.frombuffer(row.cols, np.int32))
        taught.append(row.toxic)
    rows = np.repeat(np.arange(len(cols), dtype=np.int32), [len(c) for c in cols])
    cols = np.concatenate(cols)
    weights, intercept = fit_weights(rows, cols, np.array(taught), r)
    # The sample may hold another share of toxic rows than the labels do.
    return Model(weights, intercept + float(np.log(shares[1] / shares[0]) - np.log(n[1] / n[0])))


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) for docs (doc_id, text)."""
    keep = np.flatnonzero(model.weights)
    values, intercept = model.weights[keep], model.intercept

    def score(batches):
        weights = np.zeros(1 << BITS, np.float32)
        weights[keep] = values
        own = Model(weights, intercept)
        for batch in batches:
            for at, part in byte_slices(batch.column("text"), SCORE_BYTES):
                found = own.scores(part)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(part)), pa.array(found), pa.array((found >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return spread(rows).mapInArrow(score, "doc_id long, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, all their columns, whose score is below 0.5."""
    keep = np.flatnonzero(model.weights)
    values, intercept = model.weights[keep], model.intercept

    def choose(batches):
        weights = np.zeros(1 << BITS, np.float32)
        weights[keep] = values
        own = Model(weights, intercept)
        for batch in batches:
            scores = [own.scores(part) for _, part in byte_slices(batch.column("text"), SCORE_BYTES)]
            yield batch.filter(pa.array(np.concatenate([np.zeros(0), *scores]) < 0.5))

    return spread(docs).mapInArrow(choose, docs.schema)


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, folds: int = 5, per_class: int = PER_CLASS) -> DataFrame:
    """Scores of all docs; labels whose id falls into fold 0 are held out."""
    model = fit(spark, docs, labels, crc_bucket(F.col("doc_id"), folds) != 0, per_class)
    return toxicity_scores(docs, model).select("doc_id", (crc_bucket(F.col("doc_id"), folds) == 0).alias("held_out"), "score", "predicted")
