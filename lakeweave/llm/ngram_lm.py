"""Language-model scores from an Elias-Fano n-gram trie that is built and queried in shards.

Level 1 holds the training tokens: 64-bit hashes in Elias-Fano shards by hash range, so a token's id is its rank;
with each its count and quantised smoothed probability. A node of level k stands for an n-gram of k tokens; nodes are
numbered context after context, contexts being the nodes of level k - 1 (words for level 2). Monotone pointers give
each context's stretch of nodes. A token is stored relative to its context: from level 3 on as its rank among the
successors of the context without its first word, and in all levels on top of the last value of the stretch before,
which makes a level's tokens one monotone sequence. A lookup goes through the pointers to the context's stretch and
searches the successor of stretch base + relative token there. Shards have about equal mass (a heavy context is
split over several by relative token), and their number follows the mass.

Smoothing is interpolated absolute discounting: P(w) = max(c(w) - D, 0) / N + (D V / N) / (V + 1), the last factor
also for the one class of unseen words, and P(w | c) = max(c(c w) - D, 0) / c(c) + (D T(c) / c(c)) P(w | c without its
first word). Each node has its quantised first term, each context its quantised weight of the lower order; both are
rounded down, so probabilities sum to at most 1. A text's first token has a begin mark as context, which is never
predicted; the production order is 3.

The levels are files in the shared folder. Workers map them where the folder is mounted; elsewhere they read the
files they need and hold at most ``HELD`` bytes of them. Counting goes through bounded runs in each task, and every
count covers all training documents.

Cases: a null text is empty and has the end token only. Documents with a null id train as their crc says.
Without training documents every score is 0. Words are compared by hash (chance of a false match about 2**-64
for each pair). Equal rows get equal scores. An empty table gives no rows. Other columns are ignored. Keys of 64 bits
are sorted as one number where contexts x successors fit, else as pairs.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweave.llm.common import byte_slices, log2ceil, open_fs, scratch, shuffle_width, spread
from lakeweave.llm.elias_fano import EliasFano, U, load, save
from lakeweave.llm.hashing import word_hashes

END = U(0x5BD1E995A3C59AC3)
DISCOUNT = 0.75
SLICE = 4 << 20
#: Distinct pairs or words that a task holds before it emits a run.
RUN = 2_000_000
#: Tokens for each shard.
MASS = 2_000_000
#: Files that a worker keeps open, and bytes of files that are not mapped.
FILES, HELD = 512, 512 << 20
#: Quantisation: steps for each unit of log10.
STEPS = 4096
RESULT = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def quantise(p: np.ndarray) -> np.ndarray:
    """-log10(p) in steps, rounded up (towards the smaller probability)."""
    return np.minimum(np.ceil(-np.log10(p) * STEPS - 1e-9), 65535).astype(np.uint16)


def value_of(q: np.ndarray) -> np.ndarray:
    return 10.0 ** (-q.astype(np.float64) / STEPS)


def planes(a: np.ndarray) -> bytes:
    """Bytes of equal weight together: what changes little packs well in the shuffle."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes()


def unplanes(raw: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys and their summed counts."""
    keys, counts = np.concatenate([np.zeros(0, np.uint64), *keys]), np.concatenate([np.zeros(0, np.int64), *counts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def collapse(c: np.ndarray, t: np.ndarray, counts: np.ndarray | None, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs (c, t) in order, the place of each input pair among them, and summed counts. t is below ``width``."""
    if not len(c):
        return c, t, np.zeros(0, np.int64), np.zeros(0, np.int64)
    if (int(c.max()) + 1) * width < 2**64:
        keys, back, n = np.unique(c.astype(np.uint64) * U(width) + t.astype(np.uint64), return_inverse=True, return_counts=True)
        c, t = (x.astype(np.int64) for x in np.divmod(keys, U(width)))
    else:
        order = np.lexsort((t, c))
        c, t = c[order], t[order]
        new = np.append(True, (c[1:] != c[:-1]) | (t[1:] != t[:-1]))
        back = np.empty(len(order), np.int64)
        back[order] = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(c)))
        c, t = c[first], t[first]
    return c, t, back, n if counts is None else np.bincount(back, counts, len(c)).astype(np.int64)


def merged(c: np.ndarray, t: np.ndarray, counts: np.ndarray | None, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``collapse``, without the places: less memory for what is only counted."""
    if not len(c) or (int(c.max()) + 1) * width >= 2**64:
        c, t, _, counts = collapse(c, t, counts, width)
        return c, t, counts
    keys = c.astype(np.uint64) * U(width) + t.astype(np.uint64)
    keys, counts = np.unique(keys, return_counts=True) if counts is None else summed([keys], [counts])
    c, t = np.divmod(keys, U(width))
    return c.view(np.int64), t.view(np.int64), counts


class Bounds:
    """Where the shards of a level begin: (context, token) pairs in order; shard 0 begins before them all."""

    def __init__(self, cuts: list[tuple[int, int]], width: int):
        cuts = sorted(set(cuts))
        self.contexts, self.tokens, self.width = np.array([c for c, _ in cuts], np.int64), np.array([t for _, t in cuts], np.int64), width

    def locate(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        low, high = np.searchsorted(self.contexts, c, "left"), np.searchsorted(self.contexts, c, "right")
        part = high.copy()
        split = np.flatnonzero(high - low > 1)
        for context in np.unique(c[split]).tolist():
            here = split[c[split] == context]
            a, b = int(low[here[0]]), int(high[here[0]])
            part[here] = a + np.searchsorted(self.tokens[a:b], t[here], "right")
        return part

    def start(self, part: int) -> int:
        """The first context that a shard may hold."""
        return int(self.contexts[part - 1]) if part else 0


class Runs:
    """Collects keys (context, token), and gives them out as sorted runs by shard when they are many."""

    def __init__(self, bounds: Bounds):
        self.bounds, self.held, self.n = bounds, [], 0

    def add(self, c: np.ndarray, t: np.ndarray):
        c, t, counts = merged(c, t, None, self.bounds.width)
        self.held.append((c, t, counts.astype(np.uint32)))
        self.n += len(c)
        if self.n >= RUN:
            yield from self.flush()

    def flush(self):
        if not self.n:
            return
        parts = [np.concatenate(x) for x in zip(*self.held, strict=True)]
        self.held, self.n = [], 0
        c, t, counts = merged(parts[0], parts[1], parts[2].astype(np.int64), self.bounds.width)
        del parts
        part = self.bounds.locate(c, t)
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
        parts, keys, sums = [], [], []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            local = (c[a:b] - self.bounds.start(int(part[a]))).astype(np.uint64) * U(self.bounds.width) + t[a:b].astype(np.uint64)
            parts.append(int(part[a])), keys.append(planes(np.diff(local, prepend=U(0)))), sums.append(planes(counts[a:b].astype(np.uint32)))
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(keys, pa.binary()), pa.array(sums, pa.binary())], names=["part", "keys", "counts"])


RUNS = "part int, keys binary, counts binary"


def _gathered(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys and their summed counts of a shard's runs, merged a few at a time."""
    done: list[tuple[np.ndarray, np.ndarray]] = []
    for keys, counts in zip(table["keys"], table["counts"], strict=True):
        done.append((np.cumsum(unplanes(keys.as_py(), np.uint64), dtype=np.uint64), unplanes(counts.as_py(), np.uint32).astype(np.int64)))
        while len(done) > 1 and len(done[-2][0]) <= 2 * len(done[-1][0]):
            last, before = done.pop(), done.pop()
            done.append(summed([before[0], last[0]], [before[1], last[1]]))
    return summed([k for k, _ in done], [c for _, c in done])


def _stored(folder: str, name: str, arrays: dict[str, np.ndarray]) -> str:
    fs, path = open_fs(folder)
    fs.create_dir(path, recursive=True)
    file = f"{name}-{uuid.uuid4().hex[:12]}.lvl"
    save(fs.open_output_stream(f"{path}/{file}"), arrays)
    return file


def _named(prefix: str, sequence: EliasFano) -> dict[str, np.ndarray]:
    return {prefix + k: v for k, v in sequence.arrays().items()}


def cuts_of(counts: np.ndarray, target: int) -> np.ndarray:
    """(node, pieces, count) where stretches of at most about ``target`` counts begin: at the first node, and where the sums
    pass a multiple; a node of more has several pieces."""
    sums = np.cumsum(counts)
    at = np.unique(np.append(0, np.searchsorted(sums, np.arange(target, int(sums[-1]), target))))
    return np.stack((at, np.maximum(1, -(-counts[at] // target)), counts[at]), axis=1).astype(np.int64)


class Level:
    """Nodes of one order from 2 on, by shard."""

    def __init__(self, bounds: Bounds, files: dict[int, tuple[str, int]], split: dict[int, tuple[int, int]]):
        self.bounds, self.files, self.split = bounds, {p: f for p, (f, _) in files.items()}, {}
        self.first, self.size = {}, 0
        for part in sorted(files):
            self.first[part], self.size = self.size, self.size + files[part][1]
        #: Contexts that several shards hold: their first node and quantised weight.
        for context, (n, mass) in split.items():
            part = int(bounds.locate(np.array([context]), np.array([0]))[0])
            while part not in self.first:
                part += 1
            self.split[context] = self.first[part], int(quantise(np.array([DISCOUNT * n / mass]))[0])


class Trie:
    """The model's files, opened when they are needed."""

    def __init__(self, folder: str, shift: int, words: list[tuple[int, str, int]], total: int, documents: int = 0):
        self.folder, self.shift, self.total, self.documents = folder, shift, total, documents
        self.word_files = {part: file for part, file, _ in words}
        self.first, at = {}, 0
        for part, _, n in words:
            self.first[part], at = at, at + n
        self.size, self.levels = at, []
        self.opened, self.held = OrderedDict(), 0

    def __getstate__(self):
        return self.__dict__ | {"opened": OrderedDict(), "held": 0}

    def _open(self, file: str):
        if file in self.opened:
            self.opened.move_to_end(file)
            return self.opened[file][:2]
        fs, path = open_fs(self.folder)
        arrays = load(fs, f"{path}/{file}")
        kinds = {k.split(".")[0] for k in arrays if "." in k}
        size = 0 if isinstance(next(iter(arrays.values())).base, np.memmap) else sum(a.nbytes for a in arrays.values())
        self.opened[file] = arrays, {k: EliasFano.of(arrays, f"{k}.") for k in kinds}, size
        self.held += size
        while len(self.opened) > FILES or (self.held > HELD and len(self.opened) > 1):
            self.held -= self.opened.popitem(last=False)[1][2]
        return self.opened[file][:2]

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, counts, probabilities) of distinct sorted hashes; unseen: id -1, count 0."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        unseen = self.lower_share() / (self.size + 1)
        p = np.full(len(hashes), unseen)
        parts = (hashes >> U(self.shift)).astype(np.int64) if self.shift < 64 else np.zeros(len(hashes), np.int64)
        for part, here in stretches(parts):
            if part in self.word_files:
                arrays, level = self._open(self.word_files[part])
                place, hit = level["tokens"].successor(hashes[here] - (U(part) << U(self.shift) if self.shift < 64 else U(0)))
                found, place = np.arange(here.start, here.stop)[hit], place[hit]
                ids[found], counts[found] = self.first[part] + place, arrays["counts"][place]
                p[found] = value_of(arrays["q"][place])
        return ids, counts, p

    def lower_share(self) -> float:
        return DISCOUNT * self.size / self.total if self.total else 1.0

    def find(self, order: int, c: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For pairs of a context and a relative token (-1: none), in order: node (-1: unseen), the context's first node,
        the node's discounted probability and the context's weight of the lower order."""
        level = self.levels[order - 2]
        node, begin = np.full(len(c), -1, np.int64), np.zeros(len(c), np.int64)
        p, weight = np.zeros(len(c)), np.ones(len(c))
        for part, here in stretches(level.bounds.locate(c, np.maximum(t, 0))):
            if part not in level.files:
                continue
            arrays, parts = self._open(level.files[part])
            tokens, pointers = parts["tokens"], parts["pointers"]
            start, n = arrays["contexts"].tolist()
            # Contexts first, each once: its stretch, its weight, and the base above the last value of the stretch before.
            own = c[here] - start
            inside = np.flatnonzero((own >= 0) & (own < n))
            if not len(inside):
                continue
            own = own[inside]
            new = np.append(True, own[1:] != own[:-1])
            each = own[new]
            bounds = pointers[np.concatenate((each, each + 1))].astype(np.int64)
            low, high = bounds[: len(each)], bounds[len(each) :]
            base = np.where(low > 0, tokens[np.maximum(low - 1, 0)] + U(1), U(0))
            share = np.where(high > low, value_of(arrays["weights"][each]), 1.0)
            which = np.cumsum(new) - 1
            place = here.start + inside
            begin[place], weight[place] = level.first[part] + low[which], share[which]
            asked = np.flatnonzero((t[place] >= 0) & (high > low)[which])
            which, place = which[asked], place[asked]
            value = base[which] + t[place].astype(np.uint64)
            most = U(int(arrays["top"][0]))
            found, hit = tokens.successor(np.minimum(value, most))
            hit &= (found < high[which]) & (value <= most)
            node[place[hit]] = level.first[part] + found[hit]
            p[place[hit]] = value_of(arrays["q"][found[hit]])
        for context, (first, q) in level.split.items():
            a, b = np.searchsorted(c, context, "left"), np.searchsorted(c, context, "right")
            begin[a:b], weight[a:b] = first, value_of(np.array([q], np.uint16))[0]
        return node, begin, p, weight


def stretches(parts: np.ndarray):
    """(value, slice) for each stretch of equal values."""
    cuts = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), len(parts)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield int(parts[a]), slice(a, b)


def token_streams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of words and an end after each text, offsets)."""
    words, off = word_hashes(texts)
    n = len(off) - 1
    ends = off[1:] + np.arange(n)
    out = np.full(len(words) + n, END, np.uint64)
    mask = np.ones(len(out), bool)
    mask[ends] = False
    out[mask] = words
    return out, np.concatenate(([0], ends + 1))


def first_contexts(trie: Trie, ids: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The context of order 2 of each token: the word before it, the begin mark at a text's start."""
    out = np.empty(len(ids), np.int64)
    out[1:] = ids[:-1]
    out[off[:-1]] = trie.size
    return out


def step(trie: Trie, k: int, context: np.ndarray, relative: np.ndarray, off: np.ndarray):
    """Look the tokens up in level k. Gives contexts and relative tokens of the next order (-1: none), and for the
    positions that have a context of order k these positions, probabilities and weights."""
    at = np.flatnonzero(context >= 0)
    c, t, back, _ = collapse(context[at], relative[at] + 1, None, trie.levels[k - 2].bounds.width + 1)
    node, begin, p, weight = trie.find(k, c, t - 1)
    deeper, within = np.full(len(context), -1, np.int64), np.full(len(context), -1, np.int64)
    found = np.full(len(context), -1, np.int64)
    found[at] = node[back]
    deeper[1:] = found[:-1]
    deeper[off[:-1]] = -1  # a text's first token has a context of order 2 only
    within[at] = np.where(node >= 0, node - begin, -1)[back]
    return deeper, within, at, p[back], weight[back]


def build(spark: SparkSession, docs: DataFrame, folder: str, order: int = 3, mass: int = MASS) -> Trie:
    """Build the trie from all docs (text). mass: tokens for each shard, about."""
    n_parts = 1 << min(16, log2ceil(max(1, shuffle_width(spark) // 4)))
    shift = 64 - log2ceil(n_parts)
    high = (lambda h: (h >> U(shift)).astype(np.int64)) if shift < 64 else (lambda h: np.zeros(len(h), np.int64))

    def count_words(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush():
            keys, counts = summed([k for k, _ in held], [c for _, c in held])
            held.clear()
            rows = [(part, keys[at], counts[at]) for part, at in stretches(high(keys))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([planes(np.diff(r[1], prepend=U(0))) for r in rows], pa.binary()), pa.array([planes(r[2].astype(np.uint32)) for r in rows], pa.binary())], names=["part", "keys", "counts"])

        for batch in batches:
            for _, part in byte_slices(batch.column("text"), SLICE):
                held.append(np.unique(token_streams(part)[0], return_counts=True))
                if sum(len(k) for k, _ in held) >= RUN:
                    yield from flush()
        yield from flush()

    def word_level(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys, counts = _gathered(table)
        part = key[0].as_py()
        # The universe is the shard's own range of hashes.
        sequence = EliasFano.build(keys - (U(part) << U(shift) if shift < 64 else U(0)), 1 << shift if shift < 64 else 1 << 64)
        file = _stored(folder, f"words-{part:05d}", _named("tokens.", sequence) | {"counts": counts})
        at = int(np.searchsorted(keys, END))
        ends = int(counts[at]) if at < len(keys) and keys[at] == END else 0
        return pa.table({"part": pa.array([part], pa.int32()), "file": [file], "n": pa.array([len(keys)]), "mass": pa.array([int(counts.sum())]), "ends": pa.array([ends])})

    made = docs.mapInArrow(count_words, RUNS).groupBy("part").applyInArrow(word_level, "part int, file string, n long, mass long, ends long").collect()
    made.sort(key=lambda r: r.part)
    total, documents = sum(r.mass for r in made), sum(r.ends for r in made)
    if not total:
        return Trie(folder, shift, [], 0)
    # Up to 4096 shards of ``mass`` tokens; beyond that larger ones, up to four times as large, and then more shards.
    size, target = sum(r.n for r in made), max(mass, min(4 * mass, -(-total // 4096)))
    share = DISCOUNT * size / total

    def finish_words(batches):
        """Add quantised probabilities, and cut each shard's contexts into stretches of about equal mass."""
        fs, path = open_fs(folder)
        for batch in batches:
            for part, old in zip(batch.column("part").to_pylist(), batch.column("file").to_pylist(), strict=True):
                arrays = {k: np.array(v) for k, v in load(fs, f"{path}/{old}").items()}
                arrays["q"] = quantise(np.maximum(arrays["counts"] - DISCOUNT, 0) / total + share / (size + 1))
                file = _stored(folder, f"level1-{part:05d}", arrays)
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([file]), pa.array([cuts_of(arrays["counts"], target).tobytes()], pa.binary())], names=["part", "file", "cuts"])

    listed = spark.createDataFrame([(r.part, r.file) for r in made], "part int, file string").repartition(len(made))
    level1 = sorted(listed.mapInArrow(finish_words, "part int, file string, cuts binary").collect(), key=lambda r: r.part)
    trie = Trie(folder, shift, [(r.part, r.file, m.n) for r, m in zip(level1, made, strict=True)], total, documents)
    cuts = [(trie.first[r.part] + node, pieces, n) for r in level1 for node, pieces, n in np.frombuffer(r.cuts, np.int64).reshape(-1, 3).tolist()]
    cuts.append((size, max(1, -(-documents // target)), documents))  # the begin mark
    width = size
    for k in range(2, order + 1):
        cuts, width = _add_level(docs, trie, k, cuts, width, target)
    return trie


def _add_level(docs: DataFrame, trie: Trie, k: int, cuts: list[tuple[int, int, int]], width: int, target: int) -> tuple[list[tuple[int, int, int]], int]:
    """Count and write level k; gives the cuts (node, pieces, count) of its nodes, and its longest stretch."""
    folder = trie.folder
    bounds = Bounds([(node, width * i // pieces) for node, pieces, _ in cuts for i in range(pieces)] + [(node + 1, 0) for node, _, _ in cuts], width)
    heavy = {node: n for node, pieces, n in cuts if pieces > 1}

    def count(batches):
        runs = Runs(bounds)
        for batch in batches:
            for _, part in byte_slices(batch.column("text"), SLICE):
                tokens, off = token_streams(part)
                distinct, which = np.unique(tokens, return_inverse=True)
                relative = trie.words(distinct)[0][which]
                context = first_contexts(trie, relative, off)
                for j in range(2, k):
                    context, relative, *_ = step(trie, j, context, relative, off)
                at = context >= 0
                yield from runs.add(context[at], relative[at])
        yield from runs.flush()

    def shard(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys, counts = _gathered(table)
        part = key[0].as_py()
        own, t = (x.view(np.int64) for x in np.divmod(keys, U(width)))
        del keys
        start = bounds.start(part) + int(own[0])
        own -= own[0]
        n = int(own[-1]) + 1
        pointers = np.searchsorted(own, np.arange(n + 1))
        sizes, sums = np.diff(pointers), np.bincount(own, counts, n)
        if start in heavy:  # its other shards hold the rest of its stretch
            sums[:] = heavy[start]
        last = np.where(sizes > 0, t[np.maximum(pointers[1:] - 1, 0)] + 1, 0)
        values = (np.cumsum(last) - last)[own] + t
        weights = np.full(n, 65535, np.uint16)
        weights[sizes > 0] = quantise(DISCOUNT * sizes[sizes > 0] / sums[sizes > 0])
        arrays = {"q": quantise((counts - DISCOUNT) / sums[own]), "weights": weights, "contexts": np.array([start, n], np.int64), "top": values[-1:].astype(np.uint64)}
        del own, t
        arrays |= _named("pointers.", EliasFano.build(pointers, len(values) + 1)) | _named("tokens.", EliasFano.build(values, int(values[-1]) + 1))
        file = _stored(folder, f"level{k}-{part:06d}", arrays)
        return pa.table({"part": pa.array([part], pa.int32()), "file": [file], "n": pa.array([len(counts)]), "widest": pa.array([int(sizes.max())]), "heavy": pa.array([start if start in heavy else None], pa.int64()), "cuts": pa.array([cuts_of(counts, target).tobytes()], pa.binary())})

    made = docs.mapInArrow(count, RUNS).groupBy("part").applyInArrow(shard, "part int, file string, n long, widest long, heavy long, cuts binary").collect()
    split: dict[int, tuple[int, int]] = {}
    for r in made:
        if r.heavy is not None:
            split[r.heavy] = split.get(r.heavy, (0, 0))[0] + r.n, heavy[r.heavy]
    level = Level(bounds, {r.part: (r.file, r.n) for r in made}, split)
    trie.levels.append(level)
    trie.opened.clear()
    widest = max([r.widest for r in made] + [n for n, _ in split.values()], default=1)
    return [(level.first[r.part] + node, pieces, n) for r in made for node, pieces, n in np.frombuffer(r.cuts, np.int64).reshape(-1, 3).tolist()], widest


def score_texts(trie: Trie, texts: pa.Array):
    """(n_tokens, n_known, base_score, score) arrays for a slice of texts."""
    tokens, off = token_streams(texts)
    distinct, which = np.unique(tokens, return_inverse=True)
    ids, counts, p = trie.words(distinct)
    base = np.log10((counts + 1) / (trie.total + trie.size + 1))[which]
    known = (counts > 0)[which]
    relative, p = ids[which], p[which]
    context = first_contexts(trie, relative, off)
    for k in range(2, len(trie.levels) + 2):
        context, relative, at, found, weight = step(trie, k, context, relative, off)
        p[at] = found + weight * p[at]
    logs = np.log10(p)
    total = lambda x: np.add.reduceat(x, off[:-1])  # noqa: E731  every text has at least its end
    return np.diff(off), total(known.astype(np.int64)), total(base), total(logs)


def score(docs: DataFrame, trie: Trie) -> DataFrame:
    def run(batches):
        for batch in batches:
            for at, part in byte_slices(batch.column("text"), SLICE):
                n, known, base, found = score_texts(trie, part)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(part)), pa.array(n), pa.array(known), pa.array(base), pa.array(found)], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return docs.mapInArrow(run, RESULT)


def lm_scores(spark: SparkSession, docs: DataFrame, held_out: Column, folder: str | None = None, order: int = 3, mass: int = MASS) -> DataFrame:
    """Train on the docs (doc_id, text) that ``held_out`` doesn't hold for, and score all of them."""
    rows = spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out.alias("held_out")))
    trie = build(spark, rows.where("NOT held_out").select("text"), folder or scratch(spark, "ngram-trie"), order, mass)
    scored = score(rows.select("doc_id", "text"), trie)
    return scored.withColumn("train_tokens", F.lit(trie.total).cast("long"))
