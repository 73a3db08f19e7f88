"""BPE encoding as a bounded-lookahead streaming transducer, and decoding as an incremental machine.

Encoding. The encoding of every prefix of a piece ends in one token; it is the longest token that ends
there and fits the last token of the prefix before it, where two tokens fit if merging their symbols
gives back just the two. So one table entry for each symbol read is enough, and only the last
``longest`` entries can be reached by tokens that are still to come: once the paths back from all of these
run through one place, everything before it is stable and is emitted, and the table is cut. How far back
that place can lie follows from the merge list (``lookahead``), which bounds the table, whatever the
piece's length. Every piece takes this one path. Texts go through in windows of bounded size with running
digests, and pieces that are met again come from caches of bounded size.

Decoding. ids are turned into the vocabulary's text a block at a time. With a byte-level decoder, the bytes
run through an incremental UTF-8 machine that keeps an unfinished character for the next block and
replaces broken ones; without a decoder, tokens are joined by spaces.

Cases: a null text is empty and has no ids; its decoded text is empty. Texts may spell special tokens.
Null doc_ids stay null. Equal rows give equal rows. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweave.llm.common import WS_TABLE, byte_slices, bytes_of, offsets_of, spread
from lakeweave.llm.tokens import BYTE_PATTERN, MAX_KEY, WORD_PATTERN, ChunkEncoder, byte_letters, lower_all

RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Symbols that the transducer is fed at a time, and bytes of text that are in work at a time.
FEED, WINDOW = 1024, 4 << 20


class Merges:
    """A merge list: symbols of a piece to tokens."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str = ""):
        self.suffix, pairs = suffix, [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.rank = {p: i for i, p in enumerate(pairs)}
        self.name = {i: t for t, i in vocab.items()}
        #: Tokens within a piece, and tokens at its end (without the suffix).
        self.mid = {t: i for t, i in vocab.items() if not suffix or not t.endswith(suffix)}
        self.end = {t[: len(t) - len(suffix)]: i for t, i in vocab.items() if t.endswith(suffix)} if suffix else self.mid
        made = {a + b for a, b in pairs}
        for table in {id(self.mid): self.mid, id(self.end): self.end}.values():
            at_end = table is self.end
            for t in [t for t in table if len(t) > 1]:
                whole = t + (suffix if at_end else "")
                # Neither a merge that makes it nor one that is reached from its own symbols: it never comes out.
                if whole not in made or self.merge(self.symbols(t, at_end)) != [whole]:
                    del table[t]
        self.longest = max(map(len, [*self.mid, *self.end]))
        self.lookahead = self._lookahead(pairs)
        self._fits: dict[int, bool] = {}

    def _lookahead(self, pairs: list[tuple[str, str]]) -> int:
        """Symbols to the right that a merge can depend on: chains of earlier merges that could take its right part away."""
        size = lambda t: len(t) - len(self.suffix) if self.suffix and t.endswith(self.suffix) else len(t)
        right: dict[str, str] = {}
        reach: dict[str, int] = {}  # by left operand, over the merges so far
        most = 1
        for a, b in pairs:
            far, part = 0, b
            while True:
                far = max(far, reach.get(part, 0))
                if part not in right:
                    break
                part = right[part]
            mine = size(b) + far
            reach[a] = max(reach.get(a, 0), mine)
            right.setdefault(a + b, b)
            most = max(most, mine)
        return most + max(map(size, (a + b for a, b in pairs)), default=1)

    def merge(self, symbols: list[str]) -> list[str]:
        """Apply the merge list itself, lowest rank first and leftmost among equals."""
        rank = self.rank
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                r = rank.get((symbols[i], symbols[i + 1]))
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            a, b, out, i = symbols[at], symbols[at + 1], [], 0
            while i < len(symbols):
                if i + 1 < len(symbols) and symbols[i] == a and symbols[i + 1] == b:
                    out.append(a + b)
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols

    def symbols(self, text: str, ends: bool = True) -> list[str]:
        return [*text[:-1], text[-1] + self.suffix] if ends and self.suffix else list(text)

    def fits(self, a: int, b: int) -> bool:
        """Whether token b may follow token a."""
        key = a << 32 | b
        found = self._fits.get(key)
        if found is None:
            x, y = self.name[a], self.name[b]
            ends = bool(self.suffix) and y.endswith(self.suffix)
            bare = y[: len(y) - len(self.suffix)] if ends else y
            found = self.merge([*x, *self.symbols(bare, ends)]) == [x, y]
            if len(self._fits) > 1_500_000:
                self._fits.clear()
            self._fits[key] = found
        return found

    def encode(self, piece: str) -> list[int]:
        """Tokens of a piece: the transducer, fed in parts of bounded size."""
        stream, out = Stream(self), []
        for at in range(0, len(piece), FEED):
            out += stream.feed(piece[at : at + FEED])
        return out + stream.finish()


class Stream:
    """The transducer over a piece that comes in parts; holds the last symbols' table only.

    Entry i (of ``last`` and ``back``) is for the first i symbols of ``text``: the token that ends there and its
    beginning. Symbols wait in ``text`` until the table's bound is reached or the piece ends; then they are stepped
    through, and what is stable is emitted.
    """

    def __init__(self, merges: Merges):
        self.m, self.text, self.last, self.back, self.most = merges, "", [0], [0], 0
        self.bound, self.begun = 2 * (merges.lookahead + merges.longest), False

    def feed(self, part: str) -> list[int]:
        """Read symbols (the last one seen is held back: it may be the piece's end); emit stable tokens."""
        self.text += part
        out: list[int] = []
        while len(self.text) > self.bound:
            self._steps(self.bound, self.m.mid)
            stable = self._emit()
            if not stable:
                self.bound += self.m.longest
            out += stable
        return out

    def finish(self) -> list[int]:
        n = len(self.text)
        if not n:
            return []
        # The last entry prefers the longest token: where that is the whole text, no other entry matters.
        if not self.begun and (whole := self.m.end.get(self.text)) is not None:
            return [whole]
        self._steps(n - 1, self.m.mid)
        self._steps(n, self.m.end)
        return self._path(n)

    def _steps(self, stop: int, table: dict[str, int]) -> None:
        """Fill the table up to entry ``stop``."""
        text, last, back, known, fits, longest, get = self.text, self.last, self.back, self.m._fits, self.m.fits, self.m.longest, table.get
        for i in range(len(last), stop + 1):
            for a in range(max(0, i - longest), i):
                t = get(text[a:i])
                if t is not None:
                    if a or self.begun:
                        p = last[a]
                        ok = known.get(p << 32 | t)
                        if not (fits(p, t) if ok is None else ok):
                            continue
                    last.append(t), back.append(a)
                    break
            else:
                raise ValueError(f"no token for {text[i - 1]!r}")

    def _path(self, i: int) -> list[int]:
        out = []
        while i > 0:
            out.append(self.last[i])
            i = self.back[i]
        return out[::-1]

    def _emit(self) -> list[int]:
        """Emit up to the last place that the paths of all reachable entries share, and cut the table there."""
        i = len(self.last) - 1
        self.most = max(self.most, i)
        live = set(range(max(0, i - self.m.longest + 1), i + 1))
        while len(live) > 1:
            top = max(live)
            live.remove(top)
            live.add(self.back[top])
        at = live.pop()
        if at <= 0:
            return []
        out = self._path(at)
        self.text = self.text[at:]
        self.last = self.last[at:]
        self.back = [max(0, b - at) for b in self.back[at:]]
        self.begun = True  # entry 0 now is the last token emitted
        return out


class TransducerEncoder(ChunkEncoder):
    """Encodes whole texts with the transducer; chunks are cut and cached as in ``ChunkEncoder``."""

    def __init__(self, path: str, cache: int = 300_000):
        import regex

        config = json.load(open(path, encoding="utf-8"))
        model = config["model"]
        self.merges = Merges(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        self.words = config.get("normalizer") is not None
        self.pattern = regex.compile(WORD_PATTERN if self.words else BYTE_PATTERN)
        self.letters = str.maketrans(dict(enumerate(byte_letters())))
        added = {t["content"]: t["id"] for t in config.get("added_tokens", [])}
        self.special = [t.encode() for t in added]
        self.added = added
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.limit, self.hot, self.old, self.pieces = cache, {}, {}, {}

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            found = array("I", self.merges.encode(piece.encode().decode("latin-1").translate(self.letters))).tobytes()
            if len(self.pieces) >= self.limit:
                self.pieces.clear()
            if len(piece) <= MAX_KEY:
                self.pieces[piece] = found
        return found

    def _whole(self, raw: bytes) -> np.ndarray:
        out = []
        for part in self.split.split(raw.decode()) if self.split else [raw.decode()]:
            if part in self.added:
                out.append(array("I", [self.added[part]]).tobytes())
            else:
                text = lower_all(unicodedata.normalize("NFC", part)) if self.words else part
                out += (self._piece(m.group()) for m in self.pattern.finditer(text))
        return np.frombuffer(b"".join(out), np.uint32)


class Decoder:
    """Turns blocks of ids into UTF-8 text; what a block leaves unfinished waits for the next."""

    def __init__(self, table: TokenTable):
        self.table, self.begun = table, False
        self.machine = codecs.getincrementaldecoder("utf-8")("replace") if table.byte_level else None

    def feed(self, ids: np.ndarray, last: bool = False) -> bytes:
        taken = self.table.names.take(pa.array(ids))
        off = offsets_of(taken)
        raw = taken.buffers()[2].to_pybytes()[off[0] : off[-1]] if len(ids) else b""
        if self.machine is not None:
            return self.machine.decode(raw, last).encode()
        if not self.begun and raw:
            raw, self.begun = raw[1:], True  # a space stands before every token but the first
        return raw


class TokenTable:
    """The text of every id."""

    def __init__(self, path: str):
        config = json.load(open(path, encoding="utf-8"))
        names = dict(config["model"]["vocab"]) | {t["content"]: t["id"] for t in config.get("added_tokens", [])}
        self.byte_level = config.get("decoder") is not None
        of_letter = {c: b for b, c in enumerate(byte_letters())}
        table = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            table[i] = bytes(of_letter[c] for c in name) if self.byte_level and all(c in of_letter for c in name) else name.encode() if self.byte_level else b" " + name.encode()
        self.names = pa.array(table, pa.large_binary())


@lru_cache(maxsize=2)
def transducer(path: str) -> tuple[TransducerEncoder, TokenTable]:
    """One for each worker process and vocabulary."""
    return TransducerEncoder(path), TokenTable(path)


def windows(encoder: ChunkEncoder, column: pa.Array, most: int = WINDOW):
    """(offsets, ids, whether texts end here) for slices of the column's texts.

    Short texts share a slice. A longer text comes in windows that end where a run of white space begins between ASCII
    characters, where no piece can reach across; only a run without such a place makes a window longer.
    """
    for _, part in byte_slices(column, most):
        data, _ = bytes_of(part)
        if len(data) <= most:
            yield *encoder.encode(part), True
            continue
        ascii_, space, at = data < 128, WS_TABLE[data], 0
        cuts = np.flatnonzero(space[1:] & ~space[:-1] & ascii_[:-1]) + 1
        while at < len(data):
            next_ = np.searchsorted(cuts, at + most, "right") - 1
            stop = int(cuts[next_]) if next_ >= 0 and cuts[next_] > at else int(cuts[next_ + 1]) if next_ + 1 < len(cuts) else len(data)
            stop = len(data) if len(data) - at <= most else stop
            yield *encoder.encode(pa.array([data[at:stop].tobytes().decode()], pa.large_string())), stop == len(data)
            at = stop


def encode_decode(docs: DataFrame, tokenizer: str, block: int = 1 << 16) -> DataFrame:
    """Encode whole texts of docs (doc_id, text), decode the ids again, and give both sides' digests."""

    def run(batches):
        encoder, table = transducer(tokenizer)
        for batch in batches:
            of_ids, of_text, sizes = [], [], []
            ids_seen, text_seen, decoder, size = hashlib.sha256(), hashlib.sha256(), Decoder(table), 0
            for ends, ids, whole in windows(encoder, batch.column("text")):
                raw = memoryview(ids.astype("<u4").tobytes())
                for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                    ids_seen.update(raw[4 * a : 4 * b])
                    size += b - a
                    for i in range(a, b, block):
                        text_seen.update(decoder.feed(ids[i : min(b, i + block)]))
                    if whole:
                        text_seen.update(decoder.feed(ids[:0], True))
                        of_ids.append(ids_seen.hexdigest()), of_text.append(text_seen.hexdigest()), sizes.append(size)
                        ids_seen, text_seen, decoder, size = hashlib.sha256(), hashlib.sha256(), Decoder(table), 0
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return spread(rows).mapInArrow(run, RESULT)
