"""Benchmark decontamination by latent semantic retrieval.

One pass hashes each document's terms and writes the hashes; what follows reads those alone. A term's top bits are its
bucket, of BUCKETS, and the same pass counts in how many documents each bucket stands. A second pass takes the TF-IDF
matrix A of all passages (rows of unit length) and sums A'(AW) for a random W, from which the driver gets the leading
right singular vectors and values: a randomised SVD whose only gathered data are BUCKETS x RANK numbers, whatever the
corpus holds. In the third pass all overlapping passages are projected, whitened by the singular values, and held by
cosine against the benchmark's passages, a block of them at a time. Each candidate is then held to the cosine of the
TF-IDF vectors themselves; a passage with WINDOW terms of an item in a row is one without that. Candidates are verified
on the terms around them: the longest common subsequence must cover most of the item, or a fair part of it with the
item's answer, its last terms, standing whole beside it, which is how paraphrases show. Items of fewer than SHORT terms
are held where all their terms stand in a row.
"""

from __future__ import annotations

import functools
import math
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnbeck.llm.common import buffers, in_batches, mark_sequences, materialise, slices, table

BUCKETS = 1 << 13
RANK = 64
#: A passage is two blocks; passages overlap by one.
BLOCK = 16
COSINE = 0.32
#: Least cosine of the TF-IDF vectors themselves, which candidates are held to before their terms are read.
EXACT = 0.35
#: Share of an item's terms in the common subsequence: alone, and with its answer.
COVER, COVER_ANSWERED = 0.75, 0.6
ANSWER_WORDS = 5
#: Items of fewer terms must stand whole.
SHORT = 8
#: So many terms of an item in a row make a passage a candidate whatever they weigh.
WINDOW = 5
#: Bits of a hash that the first look-up of such windows takes.
LOOK_UP = 20
#: Candidates that are worked out at a time.
PAIRS = 1 << 13
QUERY_WORDS = 48
#: Benchmark passages that one pass holds.
QUERY_BLOCK = 2000
#: Bytes whose terms are hashed at a time, and bytes of text that are laid out for that.
SLICE, CHUNK = 1 << 15, 1 << 21
#: Terms that are projected at a time, and documents whose terms are marked at a time.
TERMS, MARKS = 1 << 14, 128
#: Terms of a text that are searched at a time, about.
PART = 1 << 16
#: Occurrences of a term in TERMS that are added one by one; those of more frequent ones are counted first.
FEW = 8
#: Rows that one task adds up.
FAN = 256
_EDGE = ".,;:!?\"'()[]{}%$#&*|"
#: Of each byte: 0 within a term, 1 at its ends or between terms of a word, 2 for white space.
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[[*_EDGE.encode()]] = 1
_CLASS[[*b" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"]] = 2
_GAP = _CLASS == 2
_LETTER = np.random.default_rng(5).integers(1 << 62, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LETTER[_CLASS > 0] = 0
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
#: A term's hash has 32 bits: the bucket first, and last if it is the first of a word, which white space parts.
_BUCKET = np.uint32(32 - (BUCKETS - 1).bit_length())


def words(text: str | None) -> list[str]:
    return [w for w in (x.strip(_EDGE) for x in (text or "").lower().split()) if w]


@functools.cache
def _powers(base: int, n: int = SLICE) -> np.ndarray:
    """base ** i modulo 2 ** 64 for n exponents."""
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _classes(raw: np.ndarray) -> np.ndarray:
    kind = _CLASS[raw]
    mark_sequences(raw, kind, 2)
    return kind


def _spell(raw: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each term, the first term of each text) of texts in lower case that lie in a row and begin at firsts.

    A term is what stands between white space and marks. Its hash is the sum of its letters' numbers times powers of a
    base, taken over many terms at once and divided by the power at which the term begins.
    """
    kind = _classes(raw)
    inside = kind == 0
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    firsts = np.minimum(firsts, len(raw))
    begun = firsts[firsts < len(raw)]
    begin[begun] = inside[begun]
    starts = np.nonzero(begin)[0]
    first = np.searchsorted(starts, firsts)
    spaces = np.cumsum(kind == 2, dtype=np.int64)[starts]
    new = np.diff(spaces, prepend=-1) > 0
    new[first[first < len(starts)]] = True
    out = np.empty(len(starts), dtype=np.uint32)
    cuts = np.searchsorted(starts, np.arange(0, len(raw) + SLICE, SLICE))
    letters = np.where(inside, _LETTER[raw], np.uint64(0))
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        if i < j:
            a, b = int(starts[i]), int(starts[j]) if j < len(starts) else len(raw)
            power, inverse = (_powers(x) if b - a <= SLICE else _powers.__wrapped__(x, b - a) for x in (_BASE, _INVERSE))
            own = starts[i:j] - a
            h = np.add.reduceat(letters[a:b] * power[: b - a], own) * inverse[own]
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            out[i:j] = h >> np.uint64(32)
    return out & np.uint32(0xFFFFFFFE) | new, first


def _spelt(texts: pa.Array) -> Iterator[list[np.ndarray]]:
    """The hashes of each text's terms, of some texts at a time, in order. A null text has none."""
    try:
        low = pa.compute.utf8_lower(texts)
    except pa.ArrowInvalid:  # not UTF-8
        low = pa.array([x.decode("utf-8", "replace").lower() for x in texts.cast(pa.binary()).fill_null(b"").to_pylist()], pa.large_string())
    raw, places = buffers(low)
    parts: list[np.ndarray] = []
    for i, j, a, b, more in slices(raw, places, 0, len(texts), CHUNK, _GAP):
        if a == b:
            found = [np.zeros(0, dtype=np.uint32)] * (j - i)
        else:
            hashes, first = _spell(raw[a:b], np.maximum(places[i:j] - a, 0))
            found = np.split(hashes, first[1:])
        if more or parts:
            parts.append(found[0])
        if not more:
            yield [np.concatenate(parts)] if parts else found
            parts = []


def hashes(text: str | None) -> np.ndarray:
    return next(_spelt(pa.array([text], pa.string())))[0]


def terms(text: str | None) -> np.ndarray:
    """Bucket of each term in order."""
    return (hashes(text) >> _BUCKET).astype(np.intp)


def places(text: str | None) -> np.ndarray:
    """Of each of the text's terms, which of words() it stands in: marks within a word part terms, white space parts both."""
    return _words_of(hashes(text))


def _words_of(found: np.ndarray) -> np.ndarray:
    return np.cumsum(found & np.uint32(1), dtype=np.int64) - 1


def _counted(found: list[np.ndarray], counts: np.ndarray) -> None:
    """Adds to counts in how many texts each bucket stands, and the texts."""
    for at in range(0, len(found), MARKS):
        some = found[at : at + MARKS]
        mark = np.zeros((len(some), BUCKETS), dtype=np.uint8)
        mark[np.repeat(np.arange(len(some)), [len(d) for d in some]), np.concatenate(some) >> _BUCKET] = 1
        counts[:BUCKETS] += np.add.reduce(mark, axis=0, dtype=np.uint8)  # MARKS texts at most
        counts[BUCKETS] += len(some)


_HASHED = "doc_id long, text_key long, terms binary, counts binary"


def _binary(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *(4 * len(x) for x in found)], dtype=np.int64)
    flat = np.concatenate(found) if found else np.zeros(0, dtype=np.uint32)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(found), [None, pa.py_buffer(ends), pa.py_buffer(flat)]).cast(pa.binary())


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(BUCKETS + 1, dtype=np.int64)
    names = ["doc_id", "text_key", "terms", "counts"]
    for batch in batches:
        at = 0
        for found in _spelt(batch.column(2)):
            _counted(found, counts)
            rows = batch.slice(at, len(found))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), _binary(found), pa.nulls(len(found), pa.binary())], names=names)
            at += len(found)
    yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([counts.tobytes()], pa.binary())], names=names)


def hashed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, terms, counts), written: a row per document, and rows that only hold counts of documents by bucket."""
    text = F.col("text").cast("string")
    read = in_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text")))
    return materialise(read.mapInArrow(_hash, _HASHED), "terms")


def _totals(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}  # a part has a fixed size, and there are few
    for batch in batches:
        for part, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            x = np.frombuffer(data.as_buffer(), dtype=kind)
            total[part] = total[part] + x if part in total else x
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["part", "data"])


def _summed(rows: DataFrame, tasks: int, kind: str) -> dict[int, np.ndarray]:
    """(part, data) rows of arrays, as many of each part as `tasks`, added up part by part: FAN rows of a part to a task."""
    add: Callable[[DataFrame], DataFrame] = lambda df: df.mapInArrow(functools.partial(_totals, kind=kind), "part int, data binary")
    while tasks > FAN:
        tasks = math.ceil(tasks / FAN)
        rows = add(rows.repartition(tasks))
    return {r.part: np.frombuffer(r.data, dtype=kind) for r in add(rows.repartition(PARTS, "part")).collect()}  # PARTS rows


def _idf(rows: DataFrame) -> np.ndarray:
    counts = rows.where("counts IS NOT NULL").select(F.lit(0).alias("part"), F.col("counts").alias("data"))
    found = _summed(counts, rows.rdd.getNumPartitions(), "<i8").get(0, np.zeros(BUCKETS + 1))
    n, df = found[BUCKETS], found[:BUCKETS]
    return (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)


def frequencies(docs: DataFrame) -> np.ndarray:
    """Smoothed inverse document frequencies of all terms, over all documents: positive, however common a term is."""
    return _idf(hashed(docs))


def _cuts(sizes: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(first term of each block, the text it is of) of texts that lie in a row; a text without terms has none."""
    many = -(-sizes // block)
    text = np.repeat(np.arange(len(sizes)), many)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    return np.repeat(np.cumsum(sizes) - sizes, many) + nth * block, text


def _rows(ids: np.ndarray, cuts: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """(blocks, width): the terms of blocks that begin at cuts and end at ends at the latest; BUCKETS beyond."""
    at = cuts[:, None] + np.arange(width)
    return np.where(at < ends[:, None], ids[np.minimum(at, len(ids) - 1)], BUCKETS)


def sums(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Of each row of terms the sum of their weights' rows; weights has one more row of zeros."""
    out = np.zeros((len(rows), weights.shape[1]), dtype=weights.dtype)
    for at in range(0, len(rows), 512):
        some, own = rows[at : at + 512], out[at : at + 512]
        one = np.empty_like(own)
        for j in range(rows.shape[1]):
            np.take(weights, some[:, j], axis=0, out=one, mode="clip")
            own += one
    return out


def _padded(weights: np.ndarray) -> np.ndarray:
    return np.concatenate([weights, np.zeros((1, weights.shape[1]), dtype=weights.dtype)])


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all hashes in a row, where each text's begin and the last end)."""
    raw, at = buffers(column)
    return raw[at[0] : at[-1]].view(np.uint32), (at - at[0]) // 4


def _random(rank: int = RANK) -> np.ndarray:
    return np.random.default_rng(17).normal(size=(BUCKETS, rank)).astype(np.float32)


#: Parts of a matrix by BUCKETS that travel alone.
PARTS = 16


def _gram(batches: Iterator[pa.RecordBatch], idf: np.ndarray) -> Iterator[pa.RecordBatch]:
    scaled = _padded(idf[:, None] * _random())
    total = np.zeros((BUCKETS + 1, RANK), dtype=np.float32)
    for batch in batches:
        flat, at = _flat(batch.column(0))
        if not len(flat):
            continue
        ids = (flat >> _BUCKET).astype(np.intp)
        cuts, text = _cuts(np.diff(at), 2 * BLOCK)
        rows = _rows(ids, cuts, at[1:][text], 2 * BLOCK)
        for k in range(0, len(rows), TERMS // (2 * BLOCK)):
            some = rows[k : k + TERMS // (2 * BLOCK)]
            y = sums(some, scaled)
            y *= RANK / np.maximum((y * y).sum(axis=1, keepdims=True), 1e-12)
            _spread(some, y, total)
    total = total[:BUCKETS]
    if total.any():
        size = BUCKETS // PARTS
        for k in range(PARTS):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([total[k * size : (k + 1) * size].astype("<f8").tobytes()], pa.binary())], names=["part", "data"])


def _spread(rows: np.ndarray, y: np.ndarray, total: np.ndarray) -> None:
    """Adds each row's y to the totals of all its terms."""
    own = rows.reshape(-1).astype(np.uint16)
    order = np.argsort(own, kind="stable")  # by radix
    term, row = own[order], order // rows.shape[1]
    new = np.ones(len(term), dtype=bool)
    new[1:] = term[1:] != term[:-1]
    starts = np.nonzero(new)[0]
    counts = np.diff(starts, append=len(term))
    rank = np.arange(len(term)) - np.repeat(starts, counts)
    often = counts > FEW
    many = np.repeat(often, counts)
    rank[many] = FEW
    for k in range(FEW):
        at = np.nonzero(rank == k)[0]
        total[term[at]] += y[row[at]]  # each term once
    if n := int(often.sum()):
        which = np.repeat(np.cumsum(often) - 1, counts)[many]
        held = np.bincount(which * len(y) + row[many], minlength=n * len(y)).reshape(n, -1).astype(np.float32)
        total[term[starts[often]]] += held @ y


def _weights(rows: DataFrame, idf: np.ndarray) -> np.ndarray:
    parts = in_batches(rows.where("counts IS NULL").select("terms")).mapInArrow(functools.partial(_gram, idf=idf), "part int, data binary")
    found = _summed(parts, rows.rdd.getNumPartitions(), "<f8")
    b = np.zeros((BUCKETS, RANK))
    for k, x in found.items():
        b[k * len(x) // RANK : (k + 1) * len(x) // RANK] = x.reshape(-1, RANK)
    b *= idf[:, None]
    if not b.any():
        return np.zeros((BUCKETS, RANK), dtype=np.float32)
    q, _ = np.linalg.qr(b)
    # A'A W = B and A'A is about Q G Q', so G (Q'W) = Q'B.
    g = np.linalg.lstsq((q.T @ _random()).T, (q.T @ b).T, rcond=1e-6)[0].T
    values, vectors = np.linalg.eigh((g + g.T) / 2)
    keep = values > 1e-6 * values.max()
    scale = np.where(keep, 1 / np.sqrt(np.where(keep, values, 1)), 0)
    return (idf[:, None] * (q @ (vectors * scale))).astype(np.float32)


def _masks(item: list) -> dict:
    masks: dict = defaultdict(int)
    for i, w in enumerate(item):
        masks[w] |= 1 << i
    return masks


def common(item: list, region: list, masks: dict | None = None) -> int:
    """Length of the longest common subsequence, by bit rows."""
    masks = masks or _masks(item)
    full = (1 << len(item)) - 1
    v = full
    for w in region:
        if m := masks.get(w, 0):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return (~v & full).bit_count()


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


_PLACES = np.random.default_rng(23).integers(1 << 62, size=(SHORT, BUCKETS), dtype=np.uint64) * np.uint64(4) + np.uint64(1)


def windows(ids: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Hash of each `width` terms in a row, by the first."""
    total = np.zeros(max(0, len(ids) - width + 1), dtype=np.uint64)
    for j in range(width):
        total += _PLACES[j][ids[j : j + len(total)]]
    return total


class _Runs:
    """Finds where items have `width` terms in a row with a text."""

    def __init__(self, items: list[tuple[int, np.ndarray]], width: int) -> None:
        self.width = width
        found = [np.unique(windows(x, width)) for _, x in items]
        owner = np.repeat([k for k, _ in items], [len(h) for h in found])
        keys = np.concatenate(found)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner = keys[order], owner[order]
        self.some = np.zeros(1 << LOOK_UP, dtype=bool)
        self.some[self.keys >> np.uint64(64 - LOOK_UP)] = True

    def find(self, flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of a window's first term, its text, item) of texts that lie in a row; windows lie within one."""
        found = windows(flat, self.width)
        at = np.nonzero(self.some[found >> np.uint64(64 - LOOK_UP)])[0]
        lo, hi = (np.searchsorted(self.keys, found[at], side) for side in ("left", "right"))
        n = hi - lo
        at, item = np.repeat(at, n), self.owner[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]
        text = np.searchsorted(ends, at, side="right")
        inside = at + self.width <= ends[text]
        return at[inside], text[inside], item[inside]


class _Sought:
    """A block of benchmark items, ready to be held against passages; items are (id, hashes of their terms)."""

    def __init__(self, items: list[tuple[int, np.ndarray]], weights: np.ndarray, idf: np.ndarray) -> None:
        self.ids = [i for i, _ in items]
        self.items = [x & np.uint32(0xFFFFFFFE) for _, x in items]
        self.sizes = np.array([len(x) for x in self.items])
        self.buckets = [(x >> _BUCKET).astype(np.intp) for x in self.items]
        self.lists = [x.tolist() for x in self.items]
        self.masks = [_masks(x) for x in self.lists]
        pieces = []  # an item's passages: at most QUERY_WORDS terms each, as even as can be
        for k, x in enumerate(self.buckets):
            n = -(-len(x) // QUERY_WORDS)
            pieces += [(k, x[len(x) * i // n : len(x) * (i + 1) // n]) for i in range(n)]
        self.owner = np.array([k for k, _ in pieces])
        self.exact = np.zeros((len(pieces), BUCKETS + 1), dtype=np.float32)
        for row, (_, x) in zip(self.exact, pieces, strict=True):
            np.add.at(row, x, 1)
        self.idf = np.append(idf, np.float32(0))
        self.exact = _unit(self.exact * self.idf)
        self.weights = _padded(weights)
        self.vectors = _unit(np.stack([weights[x].sum(axis=0) for _, x in pieces])).T
        self.room = int(self.sizes.max()) + BLOCK
        long_ = [(k, x) for k, x in enumerate(self.buckets) if len(x) >= SHORT]
        self.runs = [_Runs(long_, WINDOW)] if long_ else []
        short = defaultdict(list)
        for k, x in enumerate(self.buckets):
            if len(x) < SHORT:
                short[len(x)].append((k, x))
        self.whole = [_Runs(some, n) for n, some in short.items()]
        self.long = self.sizes >= SHORT

    def find(self, flat: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int, float, bool, float, int]]:
        """(text, item, coverage, answered, cosine, first term) of texts that lie in a row."""
        ids = (flat >> _BUCKET).astype(np.intp)
        flat = flat & np.uint32(0xFFFFFFFE)
        ends = np.cumsum(sizes)
        cuts, text = _cuts(sizes, BLOCK)
        if not len(cuts):
            return
        block = sums(_rows(ids, cuts, ends[text], BLOCK), self.weights)
        follows = np.nonzero(text[1:] == text[:-1])[0]
        block[follows] += block[follows + 1]
        passage = _unit(block)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # (first block, item, cosine)
        for at in range(0, len(passage), 4096):
            cosine = passage[at : at + 4096] @ self.vectors
            near = np.flatnonzero(cosine.reshape(-1) >= COSINE)
            for k in range(0, len(near), PAIRS):
                p, q = np.divmod(near[k : k + PAIRS], cosine.shape[1])
                own = _rows(ids, cuts[at + p], ends[text[at + p]], 2 * BLOCK)
                mass = self.idf[own]
                true = (self.exact[q[:, None], own] * mass).sum(axis=1) >= EXACT * np.sqrt((mass * mass).sum(axis=1))
                true &= self.long[self.owner[q]]
                found.append((at + p[true], self.owner[q[true]], cosine[p[true], q[true]]))
        # An item's terms in a row make a candidate too: common ones weigh too little beside what surrounds them.
        for runs in self.runs:
            at, _, item = runs.find(ids, ends)
            first = np.searchsorted(cuts, at, side="right") - 1
            found.append((first, item, np.full(len(at), -2.0)))
        block_, item_, cosine_ = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, dtype=np.intp),) * 3
        order = np.lexsort((-cosine_, item_, block_))
        block_, item_, cosine_ = block_[order], item_[order], cosine_[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (block_[1:] != block_[:-1]) | (item_[1:] != item_[:-1])
        block_, item_, cosine_ = block_[new], item_[new], cosine_[new]
        # The passage's terms, and room on both sides for a whole item.
        begin = ends - sizes
        room = self.sizes[item_] + BLOCK
        a = np.maximum(cuts[block_] - room, begin[text[block_]])
        b = np.minimum(cuts[block_] + 2 * BLOCK + room, ends[text[block_]])
        keep = self._enough(ids, a, b, item_)
        best: dict[tuple[int, int], tuple] = {}
        for p, k, cosine, lo, hi in zip(block_[keep].tolist(), item_[keep].tolist(), cosine_[keep].tolist(), a[keep].tolist(), b[keep].tolist(), strict=True):
            region = flat[lo:hi].tolist()
            item = self.lists[k]
            share = common(item, region, self.masks[k]) / len(item)
            if share < COVER_ANSWERED:
                continue
            answer = item[-ANSWER_WORDS:]
            answered = any(region[i : i + len(answer)] == answer for i in range(len(region) - len(answer) + 1))
            if share >= COVER or answered:
                if cosine < -1:
                    cosine = float((passage[p] @ self.vectors[:, self.owner == k]).max())
                d = int(text[p])
                best[d, k] = max(best.get((d, k), (0.0,)), (share, answered, cosine, lo))
        for runs in self.whole:
            at, of, item = runs.find(ids, ends)
            for p, d, k in zip(at.tolist(), of.tolist(), item.tolist(), strict=True):
                if (d, k) not in best and np.array_equal(flat[p : p + runs.width], self.items[k]):
                    first = int(np.searchsorted(cuts, p, side="right")) - 1
                    best[d, k] = (1.0, True, float((passage[first] @ self.vectors[:, self.owner == k]).max()), p)
        for (d, k), x in best.items():
            yield d, k, *x

    def _enough(self, ids: np.ndarray, a: np.ndarray, b: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Those of the candidates whose regions a to b hold so many of the item's terms that a subsequence could cover it."""
        keep = []
        by_room = np.argsort(b - a, kind="stable")
        for at in range(0, len(by_room), 512):
            some = by_room[at : at + 512]
            width = int((b[some] - a[some]).max())
            region = _rows(ids, a[some], b[some], width)
            mark = np.zeros((len(some), BUCKETS + 1), dtype=bool)
            mark[np.arange(len(some))[:, None], region] = True
            mark[:, BUCKETS] = False
            held = self.sizes[item[some]]
            terms_ = np.full((len(some), int(held.max())), BUCKETS, dtype=np.intp)
            inside = np.arange(terms_.shape[1]) < held[:, None]
            terms_[inside] = np.concatenate([self.buckets[k] for k in item[some]])
            keep.append(some[mark[np.arange(len(some))[:, None], terms_].sum(axis=1) >= COVER_ANSWERED * held])
        return np.sort(np.concatenate(keep)) if keep else np.zeros(0, dtype=np.intp)


_FOUND = "doc_id long, text_key long, item_id long, coverage double, answered boolean, cosine double, near_word long"
_FOUND_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_(), pa.float64(), pa.int64())


def _search(batches: Iterator[pa.RecordBatch], weights: np.ndarray, idf: np.ndarray, items: list[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    sought = _Sought(items, weights, idf)
    over = 2 * sought.room + 2 * BLOCK
    for batch in batches:
        flat, at = _flat(batch.column(2))
        best: dict[tuple[int, int], tuple] = {}
        parts: list[tuple[int, int, int]] = []  # (text, first term, last): texts of more than PART terms in several, which overlap

        def run() -> None:
            if parts:
                own = np.concatenate([flat[a:b] for _, a, b in parts])  # noqa: B023
                sizes = np.array([b - a for _, a, b in parts])
                starts = np.cumsum(sizes) - sizes
                for p, k, share, answered, cosine, first in sought.find(own, sizes):
                    d, a, _ = parts[p]
                    place = first - int(starts[p]) + a
                    best[d, k] = max(best.get((d, k), (0.0,)), (share, answered, cosine, place))  # noqa: B023
                parts.clear()

        held = 0
        for d in range(batch.num_rows):
            for a in range(int(at[d]), int(at[d + 1]), PART):
                if a > at[d] and at[d + 1] - a <= over:
                    break  # the part before holds it
                parts.append((d, a, min(int(at[d + 1]), a + PART + over)))
                held += parts[-1][2] - a
                if held >= PART:
                    run()
                    held = 0
        run()
        rows = []
        for (d, k), (share, answered, cosine, place) in best.items():
            word = int(_words_of(flat[at[d] : place + 1])[-1])
            rows.append((batch.column(0)[d].as_py(), batch.column(1)[d].as_py(), sought.ids[k], share, answered, cosine, word))
        columns = list(zip(*rows, strict=True)) or [()] * len(_FOUND_TYPES)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _FOUND_TYPES, strict=True)], names=[c.split()[0] for c in _FOUND.split(", ")])


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_key, item_id, coverage, answered, cosine, near_word): each benchmark item that a document holds.

    text_key is the text's xxhash64; near_word is the first word of the stretch that was verified. Null and empty texts
    hold nothing; items without terms are not sought, items of fewer than SHORT terms are held where they stand whole.
    Repeated rows and those without a doc_id are searched like others. Further columns are not read.
    """
    spark = docs.sparkSession
    rows = hashed(docs)
    idf = _idf(rows)
    weights = _weights(rows, idf)
    read = in_batches(rows.where("counts IS NULL").select("doc_id", "text_key", "terms"))
    found: list[DataFrame] = []
    held: list[tuple[int, np.ndarray]] = []
    size = 0

    def search() -> None:
        found.append(materialise(read.mapInArrow(functools.partial(_search, weights=weights, idf=idf, items=list(held)), _FOUND), "leaks"))

    for r in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        item = hashes(r[1])
        if len(item):
            held.append((r[0], item))
            size += -(-len(item) // QUERY_WORDS)
        if size >= QUERY_BLOCK:
            search()
            held, size = [], 0
    if held:
        search()
    return functools.reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], _FOUND)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage: rows that hold a benchmark item go, known by doc_id and text, so that those without a doc_id go too."""
    gone = leaks(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("leaked_id"), "text_key").distinct()
    leaked = docs["doc_id"].eqNullSafe(gone["leaked_id"]) & (F.xxhash64(docs["text"].cast("string")) == gone["text_key"])
    return docs.join(gone, leaked, "left_anti")


QUERIES = {"op6_decontaminate": op6_decontaminate}
ORACLES: dict[str, str] = {}
