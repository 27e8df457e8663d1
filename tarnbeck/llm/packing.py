"""Best-fit packing of whole documents into sequences, after Martello-Toth dominance reduction.

Only the number of pieces of each length matters to the packing, so the plan is made on that histogram, which has at
most `capacity` rows whatever the corpus holds. The reduction fixes, for the longest piece left, a set of at most two
pieces that dominates every other way to fill its sequence: alone where nothing fits beside it; with its exact
complement; or with the longest partner where that is at least as long as any feasible sum of two or more others. Each
step fixes all copies at once. What remains goes, longest first, to the fullest sequence that has room. The plan is a
list of slots, each a run of ranks within one length; pieces find theirs by their rank.
"""

from __future__ import annotations

import base64
import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tarnbeck.llm.common import buffers, in_batches, materialise, slices, table

CAPACITY = 1024
END = 2
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: The same vocabulary with its merges as ranks.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Bytes of text that are encoded at a time.
SLICE = 1 << 21
#: Units of at most so many bytes are encoded once a slice.
KEY = 16
#: Pieces of one length and salt, about.
SALT_ROWS = 1000
_SPACE = np.isin(np.arange(256), [*b" \t\n\r\x0b\x0c"])
#: Texts with any other character go whole to the tokenizer: white space beyond ASCII, and scripts whose letters and
#: numbers have grown since Unicode 8, of which the libraries' tables may differ.
_ODD = re.compile("[^\0-\x84\x86-\x9f\xa1-\u033f\u0400-\u047f\u200b-\u2027\u202a-\u202e\u2030-\u205e\u2060-\u20cf\u3041-\u30ff\u4000-\u9fd5]")


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places starts[0], starts[0] + 1, ... of each run in a row."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(lengths.sum())


class _Encoder:
    """A tokenizer's ids for columns of texts.

    The tokenizer's pattern never joins what stands before a run of white space with what follows, so a text's ids are
    those of its units, each a run of white space and the word after it. Of a slice of texts each distinct unit is
    encoded once, all of them in one string, which is cut again by the lengths of the ids' bytes.
    """

    def __init__(self, path: str, ranks: str = RANKS) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        #: Texts with one of these get its id for it.
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as f:
            known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.merges = tiktoken.Encoding("units", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})
        self.sizes = np.zeros(max(known.values()) + 1, dtype=np.int64)
        self.sizes[list(known.values())] = [len(x) for x in known]

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, dtype="<u4").tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _merged(self, text: str) -> np.ndarray:
        return np.array(self.merges.encode_ordinary(text), dtype="<u4")

    def _slice(self, raw: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, the first id of each text) of texts that lie in a row and begin at firsts."""
        space = _SPACE[raw]
        mark = space.copy()
        mark[1:] &= ~space[:-1]
        mark[firsts[firsts < len(raw)]] = True
        starts = np.nonzero(mark)[0]
        lengths = np.diff(starts, append=len(raw))
        short = np.nonzero(lengths <= KEY)[0]
        padded = np.concatenate([raw, np.zeros(KEY, dtype=np.uint8)])
        keys = np.lib.stride_tricks.sliding_window_view(padded, KEY)[starts[short]]
        keys[np.arange(KEY) >= lengths[short, None]] = 0
        low, high = keys.view("<u8").T
        mixed = (low * np.uint64(0x9E3779B97F4A7C15) ^ high * np.uint64(0xD1342543DE82EF95)) + lengths[short].astype(np.uint64)
        order = np.argsort(mixed ^ mixed >> np.uint64(32))
        low, high, size = low[order], high[order], lengths[short][order]
        # Neighbours are compared as they are, so equal hashes of different units do no harm.
        new = np.ones(len(order), dtype=bool)
        new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1]) | (size[1:] != size[:-1])
        long_ = np.nonzero(lengths > KEY)[0]
        which = np.empty(len(starts), dtype=np.int64)
        which[short[order]] = np.cumsum(new) - 1
        which[long_] = new.sum() + np.arange(len(long_))
        picked = np.concatenate([short[order[new]], long_])
        at, n = starts[picked], lengths[picked]
        # Without white space before them texts' first words get a line feed, whose id goes again; those of white space alone stand apart.
        bare, bound = space[at + n - 1], ~space[at]
        spelt = np.full(int((n + bound)[~bare].sum()), ord("\n"), dtype=np.uint8)
        spelt[_ragged(np.cumsum((n + bound)[~bare]) - n[~bare], n[~bare])] = raw[_ragged(at[~bare], n[~bare])]
        ids = self._merged(spelt.tobytes().decode())
        ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum((n + bound)[~bare])) + 1
        first, count = np.zeros(len(picked), dtype=np.int64), np.zeros(len(picked), dtype=np.int64)
        first[~bare] = np.concatenate([[0], ends[:-1]])[: len(ends)] + bound[~bare]
        count[~bare] = np.diff(ends, prepend=0) - bound[~bare]
        for k in np.nonzero(bare)[0]:
            own = self._merged(raw[at[k] : at[k] + n[k]].tobytes().decode())
            first[k], count[k] = len(ids), len(own)
            ids = np.concatenate([ids, own])
        per_unit = count[which]
        so_far = np.concatenate([[0], np.cumsum(per_unit)])
        return ids[_ragged(first[which], per_unit)], so_far[np.searchsorted(starts, firsts)]

    def _plain(self, raw: np.ndarray, places: np.ndarray, lo: int, hi: int) -> Iterator[np.ndarray]:
        parts = []
        for i, j, a, b, more in slices(raw, places, lo, hi, SLICE, _SPACE):
            if a == b:
                found = [np.zeros(0, dtype="<u4")] * (j - i)
            else:
                ids, at = self._slice(raw[a:b], np.maximum(places[i:j] - a, 0))
                found = np.split(ids, at[1:])
            if more or parts:
                parts.append(found[0])
            if not more:
                yield from [np.concatenate(parts)] if parts else found
                parts = []

    def column(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Each text's ids in order, as little-endian unsigned 32-bit integers; null is empty."""
        raw, places = buffers(texts)
        lo = 0
        for k in range(len(texts)):
            own = raw[places[k] : places[k + 1]].tobytes()
            text = None if own.isascii() else own.decode("utf-8", "replace")
            if text is not None and not _ODD.search(text):
                text = None
            if text is None and any(x.encode() in own for x in self.special):
                text = own.decode()
            if text is not None:
                yield from self._plain(raw, places, lo, k)
                yield np.frombuffer(self.whole([text])[0], dtype="<u4")
                lo = k + 1
        yield from self._plain(raw, places, lo, len(texts))


_encoder = functools.cache(_Encoder)


def token_ids(texts: list[str | None], path: str = TOKENIZER, ranks: str = RANKS) -> list[bytes]:
    """Each text's ids as little-endian unsigned 32-bit integers; null is empty."""
    return [x.tobytes() for x in _encoder(path, ranks).column(pa.array(texts, pa.large_string()))]


_NAMES = ("doc_id", "piece", "start", "length", "ids_crc32")
_TYPES = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())


def _pieces(batches: Iterator[pa.RecordBatch], path: str, ranks: str, capacity: int, end: int) -> Iterator[pa.RecordBatch]:
    last = np.array([end], dtype="<u4").tobytes()
    encoder = _encoder(path, ranks)
    for batch in batches:
        rows = []
        for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.column(batch.column(1)), strict=True):
            n = len(ids) + 1
            own = ids.tobytes() + last
            starts = [0, *range(n % capacity or capacity, n, capacity)]
            for k, (a, b) in enumerate(zip(starts, [*starts[1:], n], strict=True)):
                rows.append((doc_id, k, a, b - a, zlib.crc32(own[4 * a : 4 * b])))
        columns = list(zip(*rows, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES)


def pieces(docs: DataFrame, path: str = TOKENIZER, capacity: int = CAPACITY, end: int = END, ranks: str = RANKS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): a document's ids and the end id.

    Only what exceeds the capacity is cut; the first piece takes the remainder.
    """
    read = in_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    cut = functools.partial(_pieces, path=path, ranks=ranks, capacity=capacity, end=end)
    return read.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


#: A slot: pieces of `length` with ranks first..first+count-1 go to sequences sequence..sequence+count-1, at offset.
Slot = tuple[int, int, int, int, int]


class _Packer:
    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.counts = {w: c for w, c in counts.items() if c}
        self.capacity, self.used, self.next, self.slots = capacity, {w: 0 for w in counts}, 0, []

    def put(self, length: int, count: int, sequence: int, offset: int) -> None:
        self.slots.append((length, self.used[length], count, sequence, offset))
        self.used[length] += count
        self.counts[length] -= count
        if not self.counts[length]:
            del self.counts[length]

    def reduce(self) -> None:
        """Fixes dominating sets until none is found."""
        found = True
        while found:
            found = False
            for w in sorted(self.counts, reverse=True):
                while self.counts.get(w) and self._dominate(w):
                    found = True

    def _dominate(self, w: int) -> bool:
        room, count = self.capacity - w, self.counts[w]
        others = [x for x in self.counts if x <= room and (x != w or count > 1)]
        if not others:
            self.put(w, count, self.next, 0)
            self.next += count
            return True
        best = max(others)
        if best < room:
            # every sum of two or more others, counts aside, which can only let more sums in
            one = sum(1 << x for x in others)
            sums, more, mask = 0, one, (2 << room) - 1
            while more := functools.reduce(lambda acc, x: acc | more << x, others, 0) & mask & ~sums:
                sums |= more
            if sums.bit_length() - 1 > best:
                return False
        times = count // 2 if best == w else min(count, self.counts[best])
        first = self.next
        self.next += times
        self.put(w, times, first, 0)
        self.put(best, times, first, w)
        return True

    def best_fit(self) -> None:
        open_: dict[int, list[tuple[int, int]]] = {}  # by room left: runs of sequences
        for w in sorted(self.counts, reverse=True):
            while count := self.counts.get(w, 0):
                room = min((r for r in open_ if r >= w), default=None)
                if room is None:
                    n = self.capacity // w
                    times = count // n
                    for many, deep in ((times, n), (1, count % n)):
                        if many and deep:
                            first = self.next
                            self.next += many
                            for k in range(deep):
                                self.put(w, many, first, k * w)
                            if left := self.capacity - deep * w:
                                open_.setdefault(left, []).append((first, many))
                    continue
                first, many = open_[room].pop()
                times = min(many, count)
                if many > times:
                    open_[room].append((first + times, many - times))
                if not open_[room]:
                    del open_[room]
                self.put(w, times, first, self.capacity - room)
                if room > w:
                    open_.setdefault(room - w, []).append((first, times))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Slot]:
    """Slots for all pieces of a histogram of lengths."""
    packer = _Packer(counts, capacity)
    packer.reduce()
    packer.best_fit()
    return packer.slots


def pack(docs: DataFrame, path: str = TOKENIZER, capacity: int = CAPACITY, end: int = END, ranks: str = RANKS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row a piece.

    A null text is empty and has the end id alone. Repeated rows are packed each; rows without a doc_id too. Further
    columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    cut = materialise(pieces(docs, path, capacity, end, ranks), "pieces")
    counts = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}  # at most `capacity` rows
    # The more pieces a length has the more salts, so that ranks within it are taken by many tasks.
    dealt = spark.createDataFrame([(w, 1 + n // SALT_ROWS) for w, n in counts.items()], "of long, salts long")
    salted = cut.join(F.broadcast(dealt), F.col("length") == F.col("of"))
    salted = salted.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("salts"))).drop("of", "salts")
    before = salted.groupBy("length", "salt").count()
    so_far = F.sum("count").over(Window.partitionBy("length").orderBy("salt")) - F.col("count")
    before = before.select(F.col("length").alias("l"), F.col("salt").alias("s"), so_far.alias("base"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("nth", F.row_number().over(within))
    ranked = ranked.join(before, (F.col("length") == F.col("l")) & (F.col("salt") == F.col("s")))
    ranked = ranked.withColumn("rank", F.col("base") + F.col("nth") - 1)
    slots = spark.createDataFrame([(w, r, r + c, s, o) for w, r, c, s, o in plan(counts, capacity)], "w long, lo long, hi long, sequence long, offset long")
    # The plan's rows follow from the histogram's, of which there are at most `capacity`: a bounded broadcast.
    found = ranked.join(F.broadcast(slots), (F.col("length") == F.col("w")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("sequence") + F.col("rank") - F.col("lo")).alias("sequence_id"), "offset")


def op8_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage, the last: the pieces of all documents and their places."""
    return pack(docs)


QUERIES = {"op8_best_fit": op8_best_fit}
ORACLES: dict[str, str] = {}
