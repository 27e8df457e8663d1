"""Substring dedup: paragraph MinHash banding, exact Jaccard, removals clustered by components.

The paragraphs compared are the sentences of each line, words up to one that a stop follows, so a passage set into other
text shares whole ones whatever surrounds it; a longer stretch without a stop, or a row of very short ones, is cut after words that a hash picks, which does not depend on where it
begins. Windows of RUN_WORDS words, winnowed from the whole text, are paragraphs too, which
meet by hash alone: they find every passage of RUN_WORDS + WINNOW - 1 words that two texts share, where no sentence of it
is whole. All texts of a slice are cut and hashed at once, as arrays. Equal paragraphs meet by hash. For others, MinHash signatures of their five-word shingles are cut into BANDS
bands of ROWS rows: two paragraphs of similarity 0.8 meet in a band with probability 1 - (1 - 0.8^2)^5 = 0.994. Each
band's paragraphs are first held against the band's least one; those that are not similar to it are then held against
all of the band, by a sketch of SKETCH one-bit MinHashes inside the join, which a pair of similarity 0.8 passes with
probability 0.998 and one of 0.5 with 0.0003. Every pair left is verified by exact Jaccard before it links, and
components of links are the classes.

A paragraph is repeated if its class stands in two places, of one document or two. Runs of repeated paragraphs are
reported if they have RUN_WORDS words, are all of their document, or follow one another in another document as here
and have RUN_WORDS words together, as when other sentences of a copy were edited; single common lines are left alone.
The class's first occurrence is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnbeck.llm.common import buffers, components, discard, in_batches, mark_sequences, materialise_lean, slices, table

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 5, 2
#: Fewer words cannot be similar without having equal shingles: one more word makes n / (n + 1) of n shingles.
BAND_WORDS = 8
LONG_WORDS = 40
PIECE_WORDS, PIECE_MOST = 8, 64
RUN_WORDS = 16
#: Of WINNOW windows of RUN_WORDS words in a row, the one of least hash is a unit.
WINNOW = 18
#: By how many paragraphs the places of repeated ones may shift against another document's, from one to the next.
SHIFT = 2
#: Bits of a sketch, in longs. Of two paragraphs of similarity s each bit is equal with probability (1 + s) / 2.
SKETCH, SKETCH_DIFFERENT = 256, 40
#: Kinds of units.
SENTENCE, WHOLE, WINDOW = range(3)
#: Bytes of text that are laid out at a time; a longer text is laid out alone.
CHUNK = 1 << 21
_EDGE = ".,;:!?\"'()[]。！？"
_digest = xxhash.xxh64_intdigest
#: Of each byte: 0 inside a word, 1 at its ends, 2 for white space.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[*b".,;:!?\"'()[]"]] = 1
_KIND[[*b" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"]] = 2
_STOP = np.isin(np.arange(256), [*b".!?"])
_WIDE_STOPS = {0xE3: (b"\x80\x82",), 0xEF: (b"\xbc\x81", b"\xbc\x9f")}
_NEVER = np.zeros(256, dtype=bool)
_BYTE = np.random.default_rng(31).integers(1 << 62, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_KIND_OF = np.array([0, 0x5851F42D4C957F2D, 0x14057B7EF767814F], dtype=np.uint64)


def normal(text: str) -> list[str]:
    return [w for w in (x.strip(_EDGE) for x in text.lower().split()) if w]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


@dataclass
class _Words:
    """Words of texts in a row: hash, text, first and last code point (exclusive) within it, what follows each."""

    hashes: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    stop: np.ndarray
    line: np.ndarray
    #: The first word of each text and the last one's next.
    bounds: np.ndarray

    def __post_init__(self) -> None:
        n = len(self.hashes)
        self._inverse = _powers(_INVERSE, n + 1)
        self._sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(self.hashes * _powers(_BASE, n), dtype=np.uint64)])

    def marks(self, a: np.ndarray, b: np.ndarray, kind: int) -> np.ndarray:
        """Hash of the words a to b, another for each kind."""
        return _mix(_mix((self._sums[b] - self._sums[a]) * self._inverse[a] + (b - a).astype(np.uint64)) ^ _KIND_OF[kind])


def _words(raw: np.ndarray, low: np.ndarray, firsts: np.ndarray, low_firsts: np.ndarray) -> _Words:
    """Words of texts that lie in a row and begin at firsts; low has the same texts in lower case, for the hashes."""
    (first, last), stop_at, line_at, own = _cores(low, low_firsts)
    leads = (raw & 0xC0) != 0x80
    if not np.array_equal(leads, (low & 0xC0) != 0x80):
        # Lower case moved some bytes: places come from the text itself, which has as many words.
        own = _cores(raw, firsts)[3]
    n = len(first)
    inside = np.zeros(len(low) + 1, dtype=np.int8)
    inside[first] += 1
    inside[last + 1] -= 1
    letters = np.where(np.cumsum(inside[:-1], dtype=np.int8) > 0, _BYTE[low], np.uint64(0))
    hashes = np.zeros(n, dtype=np.uint64)
    size = 1 << 15
    power, inverse = _powers(_BASE, size), _powers(_INVERSE, size)
    cuts = np.searchsorted(first, np.arange(0, len(low) + size, size))
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        if i < j:
            a, b = int(first[i]), int(last[j - 1]) + 1
            p, q = (power, inverse) if b - a <= size else (_powers(_BASE, b - a), _powers(_INVERSE, b - a))
            at = first[i:j] - a
            hashes[i:j] = np.add.reduceat(letters[a:b] * p[: b - a], at) * q[at]
    text = np.searchsorted(firsts, own[0], side="right") - 1
    points = _counts(leads) if not leads.all() else np.arange(len(raw) + 1, dtype=np.int32)
    base = points[np.minimum(firsts, len(raw))][text]
    after = np.append(first[1:], len(low))
    between = lambda flags: (c := _counts(flags))[after] > c[last + 1]
    ends = np.ones(n, dtype=bool)
    ends[:-1] = text[1:] != text[:-1]
    bounds = np.searchsorted(text, np.arange(len(firsts) + 1))
    return _Words(_mix(hashes), text, points[own[0]] - base, points[own[1]] - base, between(stop_at), between(line_at) | ends, bounds)


def _counts(flags: np.ndarray) -> np.ndarray:
    """How many flags are set before each place, and in all."""
    out = np.zeros(len(flags) + 1, dtype=np.int32)
    np.cumsum(flags, dtype=np.int32, out=out[1:])
    return out


def _cores(raw: np.ndarray, firsts: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """((first, last byte between the edges) of each word, stops, line ends, (first byte, last exclusive) of each word)."""
    kind, stop = _KIND[raw], _STOP[raw]
    mark_sequences(raw, kind, 2)
    mark_sequences(raw, kind, 1, _WIDE_STOPS)
    mark_sequences(raw, stop, True, _WIDE_STOPS)
    solid = kind != 2
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    some = firsts[firsts < len(raw)]
    begin[some] = solid[some]
    starts = np.nonzero(begin)[0]
    inner = np.nonzero(kind == 0)[0]
    run = np.cumsum(begin, dtype=np.int32)[inner] - 1
    new = np.ones(len(run), dtype=bool)
    new[1:] = run[1:] != run[:-1]
    at = np.nonzero(new)[0]
    kept = run[at]
    last = inner[np.append(at[1:], len(inner)) - 1] if len(at) else inner[:0]
    # A run ends before white space or the next run.
    gaps = np.append(np.nonzero(~solid)[0], len(raw))
    ends = np.minimum(gaps[np.searchsorted(gaps, starts[kept])], np.append(starts, len(raw))[kept + 1])
    return (inner[at], last), stop, raw == 10, (starts[kept], ends)


def _sentences(w: _Words) -> tuple[np.ndarray, np.ndarray]:
    """(first word, last exclusive) of each unit of at least SHINGLE words, in order."""
    if not len(w.hashes):
        return (np.zeros(0, dtype=np.int64),) * 2
    to = np.nonzero(w.stop | w.line)[0] + 1
    at = np.concatenate([[0], to[:-1]])
    short, line = to - at < SHINGLE, w.line[to - 1]
    joined = np.zeros(len(at), dtype=bool)
    joined[1:] = short[1:] & short[:-1] & ~line[:-1]
    heads = np.nonzero(~joined)[0]
    a, b, rows = at[heads], np.append(at[heads][1:], to[-1]), short[heads]
    whole = ~rows & (b - a <= LONG_WORDS)
    cut = np.nonzero(~whole & (b - a >= SHINGLE))[0]
    ends = np.nonzero(w.hashes % np.uint64(16) == 0)[0] + 1
    lo, hi = np.searchsorted(ends, a[cut], side="right"), np.searchsorted(ends, b[cut], side="right")
    marks = ends.tolist()
    first, last = [], []
    for x, y, i, j in zip(a[cut].tolist(), b[cut].tolist(), lo.tolist(), hi.tolist(), strict=True):
        for end in (*marks[i:j], y):
            while end - x >= PIECE_MOST:
                first.append(x)
                last.append(x + PIECE_MOST)
                x += PIECE_MOST
            if end - x >= (SHINGLE if end == y else PIECE_WORDS):
                first.append(x)
                last.append(end)
                x = end
    a, b = np.concatenate([a[whole], np.array(first, dtype=np.int64)]), np.concatenate([b[whole], np.array(last, dtype=np.int64)])
    order = np.argsort(a, kind="stable")
    return a[order], b[order]


def _slide(x: np.ndarray, pick: np.ufunc) -> np.ndarray:
    """The least or most of each WINNOW values in a row, by doubling."""
    width = 1
    y = x
    while 2 * width <= WINNOW:
        y = pick(y[:-width], y[width:])
        width *= 2
    return pick(y[: len(x) - WINNOW + 1], y[WINNOW - width :]) if WINNOW > width else y


def _winnowed(w: _Words) -> tuple[np.ndarray, np.ndarray]:
    """(first word, mark) of windows of RUN_WORDS words, which depend on the words about them alone.

    Of any WINNOW windows of a text in a row the least is among them, and of all its windows if it has fewer, so two texts
    that share RUN_WORDS + WINNOW - 1 words in a row share a window, whatever stops or surrounds those words.
    """
    n = len(w.hashes)
    end = w.bounds[1:][w.text]
    place = np.arange(n)
    at = np.nonzero(place + RUN_WORDS <= end)[0]
    found = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
    found[at] = w.marks(at, at + RUN_WORDS, WINDOW)
    picked = np.zeros(n, dtype=bool)
    if n >= WINNOW:
        least = _slide(found, np.minimum)
        rows = place[: len(least)] + WINNOW - 1 + RUN_WORDS <= end[: len(least)]
        # A window is picked if it is the least of any row that it is in: the greatest of those rows' least is itself.
        pad = np.zeros(WINNOW - 1, dtype=np.uint64)
        most = _slide(np.concatenate([pad, np.where(rows, least, np.uint64(0)), pad]), np.maximum)
        picked = (most == found) & (place + RUN_WORDS <= end)
    sizes = np.diff(w.bounds)
    for k in np.nonzero((sizes >= RUN_WORDS) & (sizes < RUN_WORDS + WINNOW - 1))[0]:
        a = int(w.bounds[k])
        picked[a + int(found[a : a + int(sizes[k]) - RUN_WORDS + 1].argmin())] = True
    at = np.nonzero(picked)[0]
    return at, found[at]


def _laid_out(texts: pa.Array) -> Iterator[tuple[int, int, _Words]]:
    """(first text, last, words) of a column, some texts at a time; null texts are empty."""
    try:
        low = pc.utf8_lower(texts)
    except pa.ArrowInvalid:  # not UTF-8
        texts = pa.array([x.decode("utf-8", "replace") for x in texts.cast(pa.binary()).fill_null(b"").to_pylist()], pa.large_string())
        low = pc.utf8_lower(texts)
    (raw, places), (low_raw, low_places) = buffers(texts), buffers(low)
    for i, j, a, b, _ in slices(raw, places, 0, len(texts), CHUNK, _NEVER):
        if a < b:
            c, d = int(low_places[i]), int(low_places[j])
            yield i, j, _words(raw[a:b], low_raw[c:d], places[i:j] - a, low_places[i:j] - c)


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    return set(zip(*(words[i:] for i in range(SHINGLE)), strict=False))


def _rank(text: np.ndarray) -> np.ndarray:
    """How many of the same text stand before; texts are in order."""
    return np.arange(len(text)) - np.searchsorted(text, text)


BAND_KEYS = [f"b{i}" for i in range(BANDS)]
_UNIT_TYPES = {"doc_id": "long", "unit": "int", "start": "int", "end": "int", "words": "int", "mark": "long", "word": "int", "total": "int", "kind": "byte"} | dict.fromkeys(BAND_KEYS, "long")
UNIT_SCHEMA = ", ".join(f"{k} {v}" for k, v in _UNIT_TYPES.items())
_ARROW = {"long": pa.int64(), "int": pa.int32(), "byte": pa.int8()}


def _units(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Sentences, short documents as wholes, and windows; of each its first word, and a short document's words.

    A sentence of BAND_WORDS words or more has its band keys where its mark stands first in a slice of texts, else nulls.
    """
    for i, j, w in _laid_out(batch.column(1)):
        if not len(w.hashes):
            continue
        a, b = _sentences(w)
        sizes = np.diff(w.bounds)
        count = np.bincount(w.text[a], minlength=j - i)
        small = np.nonzero((sizes > 0) & (sizes < RUN_WORDS))[0]
        at, found = _winnowed(w)
        sentences = w.marks(a, b, SENTENCE)
        parts = [
            (a, b, _rank(w.text[a]), sentences, SENTENCE),
            (w.bounds[small], w.bounds[small + 1], count[small], w.marks(w.bounds[small], w.bounds[small + 1], WHOLE), WHOLE),
            (at, at + RUN_WORDS, count[w.text[at]] + _rank(w.text[at]), found, WINDOW),
        ]
        for first, last, unit, mark, kind in parts:
            text = w.text[first]
            total = sizes[text]
            columns = [
                batch.column(0).take(pa.array(i + text)), unit, w.start[first], w.end[last - 1], last - first, mark.view(np.int64), first - w.bounds[text],
                pa.array(total, pa.int32(), mask=total >= RUN_WORDS), np.full(len(first), kind), *_keys(w, a, b, sentences, kind, len(first)),
            ]
            arrays = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns]
            yield pa.RecordBatch.from_arrays([c.cast(_ARROW[t]) for c, t in zip(arrays, _UNIT_TYPES.values(), strict=True)], names=list(_UNIT_TYPES))


def _keys(w: _Words, a: np.ndarray, b: np.ndarray, marks: np.ndarray, kind: int, n: int) -> list[pa.Array]:
    """The columns BAND_KEYS of a kind of n units."""
    long_ = np.nonzero(b - a >= BAND_WORDS)[0]
    if kind != SENTENCE or not len(long_):
        return [pa.nulls(n, pa.int64())] * BANDS
    once = long_[np.unique(marks[long_], return_index=True)[1]]
    keys = np.zeros((BANDS, n), dtype=np.uint64)
    keys[:, once] = bands(w.hashes, a[once], b[once]).T
    mask = np.ones(n, dtype=bool)
    mask[once] = False
    return [pa.array(k.view(np.int64), mask=mask) for k in keys]


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from _units(batch)


_MULTIPLY = np.random.default_rng(2024).integers(1 << 62, size=(BANDS * ROWS,), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = np.random.default_rng(2025).integers(1 << 62, size=(SHINGLE,), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def bands(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(units, BANDS) keys, each with its band mixed in, of units that are runs of hashed words; each has SHINGLE or more."""
    total = np.zeros(len(hashes) - SHINGLE + 1, dtype=np.uint64)
    for j in range(SHINGLE):
        total += hashes[j : len(total) + j] * _PLACES[j]
    many = ends - starts - SHINGLE + 1
    offsets = np.cumsum(many) - many
    kept = _mix(total[np.repeat(starts - offsets, many) + np.arange(many.sum())])
    keys = np.empty((len(starts), BANDS), dtype=np.uint64)
    for b in range(BANDS):
        key = np.full(len(starts), b + 1, dtype=np.uint64)
        for r in range(ROWS):
            least = np.minimum.reduceat(_mix(kept * _MULTIPLY[b * ROWS + r]), offsets)
            key = _mix(key * np.uint64(0xD1342543DE82EF95) + least)
        keys[:, b] = key
    return keys


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            x, y = shingles(normal(a or "")), shingles(normal(b or ""))
            keep.append(bool(x or y) and len(x & y) >= SIMILARITY * len(x | y))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


_SKETCH = np.random.default_rng(2026).integers(1 << 62, size=(SKETCH,), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sketch(words: list[str]) -> np.ndarray:
    """SKETCH one-bit MinHashes in longs."""
    hashes = np.fromiter(map(_digest, words), dtype=np.uint64, count=len(words))
    total = np.zeros(max(len(words) - SHINGLE + 1, 1), dtype=np.uint64)
    for j in range(min(SHINGLE, len(words))):
        total += hashes[j : len(total) + j] * _PLACES[j]
    least = _mix(_mix(total)[:, None] * _SKETCH[None, :]).min(axis=0)
    return np.packbits((_mix(least) >> np.uint64(63)).astype(np.uint8)).view(np.int64)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [sketch(normal(x.as_py() or "")) for x in batch.column(1)]
        columns = np.array(rows, dtype=np.int64).reshape(-1, SKETCH // 64).T
        yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(np.ascontiguousarray(c)) for c in columns)], names=["mark", "text", *(f"s{i}" for i in range(SKETCH // 64))])


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those pairs (a, b) whose texts have a Jaccard of SIMILARITY or more."""
    left = texts.select(F.col("mark").alias("ma"), F.col("text").alias("ta"))
    right = texts.select(F.col("mark").alias("mb"), F.col("text").alias("tb"))
    both = pairs.join(left, F.col("a") == F.col("ma")).join(right, F.col("b") == F.col("mb")).select("a", "b", "ta", "tb")
    return both.mapInArrow(_similar, "a long, b long")


def links(docs: DataFrame, units: DataFrame, made: list[DataFrame] | None = None) -> DataFrame:
    """(a, b): marks of different paragraphs that are similar; units are sentences with their band keys.

    made gets the tables that the result is read from, to be discarded once it was read.
    """
    banded = units.where(F.col(BAND_KEYS[0]).isNotNull())
    rows = banded.select(F.explode(F.array(*BAND_KEYS)).alias("band"), "mark").repartition("band")
    least = rows.groupBy("band").agg(F.min("mark").alias("hub"), F.max("mark").alias("other")).where("hub != other").withColumnRenamed("band", "b2")
    # A band's rows where different paragraphs meet; each paragraph once. A band stands once among the least, and few
    # bands do, so a part's hash table stays small and the rows need no sort.
    met = materialise_lean(rows.join(least.hint("shuffle_hash"), F.col("band") == F.col("b2")).select("band", "mark", "hub").distinct(), "bands")
    needed = met.select("mark").distinct()
    # A mark has band keys once in a slice, so a common one has no more places here than there are slices.
    first = banded.select("mark", "doc_id", "start", "end").join(needed, "mark", "left_semi")
    first = first.groupBy("mark").agg(F.min(F.struct("doc_id", "start", "end")).alias("at")).select("mark", "at.*")
    whole = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("whole"))
    texts = whole.join(first, F.col("id") == F.col("doc_id")).select("mark", F.expr("substring(whole, start + 1, end - start)").alias("text"))
    parts = [f"s{i}" for i in range(SKETCH // 64)]
    texts = materialise_lean(texts.dropDuplicates(["mark"]).mapInArrow(_sketched, "mark long, text string, " + ", ".join(f"{c} long" for c in parts)), "texts")
    found = materialise_lean(_verified(met.where("mark != hub").select(F.col("hub").alias("a"), F.col("mark").alias("b")).distinct(), texts), "links")
    # What isn't similar to its band's least meets all of the band; bands of two have nothing more to meet.
    linked = found.select(F.col("a").alias("hub"), F.col("b").alias("mark"))
    rest = met.where("mark != hub").join(linked, ["hub", "mark"], "left_anti").select("band", "mark")
    drawn = texts.select("mark", *parts)
    left = rest.join(drawn, "mark").select("band", F.col("mark").alias("a"), *(F.col(c).alias(f"a{c}") for c in parts))
    # Where both of a pair are among the rest, it comes from the lesser one alone.
    again = rest.select(F.col("band").alias("rb"), F.col("mark").alias("rm"))
    right = met.where("mark != hub").join(again, (F.col("band") == F.col("rb")) & (F.col("mark") == F.col("rm")), "left").withColumn("late", F.col("rm").isNotNull())
    right = right.join(drawn, "mark").select(F.col("band").alias("b2"), F.col("mark").alias("b"), "late", *(F.col(c).alias(f"b{c}") for c in parts))
    apart = F.lit(0)
    for c in parts:
        apart = apart + F.bit_count(F.col(f"a{c}").bitwiseXOR(F.col(f"b{c}")))
    more = left.join(right, (F.col("band") == F.col("b2")) & (F.col("a") != F.col("b")) & (~F.col("late") | (F.col("a") < F.col("b"))) & (apart <= SKETCH_DIFFERENT))
    if made is not None:
        made += [met, texts, found]
    return found.unionByName(_verified(more.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), texts))


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end, n_words, n_paragraphs, class_id, first_doc, removed): each run of repeated paragraphs.

    start and end are code points of the text, the end exclusive; class_id is the run's least class; first_doc is the
    least document that its classes stand in; removed says if any paragraph of the run goes, as it isn't its class's
    first. Null and short texts have no paragraphs; rows without a doc_id are not read, nor further columns. Rows that
    share a doc_id are one document.
    """
    docs = docs.where("doc_id IS NOT NULL")
    read = in_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    units = materialise_lean(read.mapInArrow(_occurrences, UNIT_SCHEMA), "paragraphs")
    made: list[DataFrame] = []
    joined = components(links(docs, units.where(F.col("kind") == SENTENCE), made))
    # What was read for the last time goes at once, so that what stands on disk at a time doesn't add up.
    for x in made:
        discard(x)
    near = materialise_lean(joined.select(F.col("node").alias("n"), F.col("component").alias("c")), "classes")
    discard(joined)
    place = F.struct("doc_id", "unit")
    # Most marks stand once and are similar to none: they are left before anything wide is dealt out.
    marks = units.groupBy("mark").agg(F.count("*").alias("times")).join(near, F.col("mark") == F.col("n"), "left")
    marks = marks.where("n IS NOT NULL OR times > 1").select(F.col("mark").alias("m"), F.coalesce("c", "mark").alias("class_id"))
    # Written, so that the join's sides are plain exchanges, of which Spark splits a common mark's part.
    marks = materialise_lean(marks, "marks")
    # A mark stands once among them, so no key swells a part's hash table, and the units need no sort.
    held = materialise_lean(units.drop("kind", *BAND_KEYS).join(marks.hint("shuffle_hash"), F.col("mark") == F.col("m")).drop("m", "mark"), "held")
    for x in (units, near, marks):
        discard(x)
    classes = held.groupBy("class_id").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first != last").withColumnRenamed("class_id", "k")
    again = held.join(classes, F.col("class_id") == F.col("k")).drop("k").withColumn("gone", place != F.col("first"))
    # Paragraphs of a document in a row, or with no more than one short one between them, are one run.
    own = Window.partitionBy("doc_id").orderBy("start", "unit")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    again = again.withColumn("new", F.coalesce(F.col("start") - F.max("end").over(before) > 40, F.lit(True)).cast("int"))
    again = again.withColumn("fresh", F.col("word") + F.col("words") - F.greatest("word", F.coalesce(F.max(F.col("word") + F.col("words")).over(before), F.lit(0))))
    again = again.withColumn("run", F.sum("new").over(own))
    # Paragraphs that stand in another document in the same order belong together, whatever was edited between them.
    again = again.withColumn("with", F.when(F.col("gone"), F.col("first")).otherwise(F.col("last")))
    again = again.withColumn("beside", F.col("with.doc_id")).withColumn("shift", F.col("unit") - F.col("with.unit"))
    pair = Window.partitionBy("doc_id", "beside").orderBy("unit", "start")
    again = again.withColumn("off", F.coalesce(F.abs(F.col("shift") - F.lag("shift").over(pair)) > SHIFT, F.lit(True)).cast("int"))
    again = again.withColumn("chain", F.sum("off").over(pair))
    again = again.withColumn("held", F.sum("words").over(Window.partitionBy("doc_id", "beside", "chain")))
    enough = (F.col("held") >= RUN_WORDS) & (F.col("beside") != F.col("doc_id"))
    runs = again.groupBy("doc_id", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum(F.greatest("fresh", F.lit(0))).alias("n_words"), F.count("*").alias("n_paragraphs"), F.min("class_id").alias("class_id"), F.min("first.doc_id").alias("first_doc"), F.max("gone").alias("removed"),
        F.max(enough).alias("enough"), F.max("total").alias("total"),
    )
    return runs.where((F.col("n_words") >= RUN_WORDS) | F.col("enough") | (F.col("n_words") >= F.col("total"))).drop("run", "enough", "total")


def op1_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(table(spark, sf_dir, "documents"))


QUERIES = {"op1_paragraphs": op1_paragraphs}
ORACLES: dict[str, str] = {}
