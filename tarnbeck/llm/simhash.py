"""SimHash near-duplicates by segment-popcount embedding.

A fingerprint's 64 bits are cut into 32 segments of two; its embedding is the vector of the segments' bit counts (0, 1
or 2). The Manhattan distance of two embeddings never exceeds the fingerprints' Hamming distance, so a range join on
embeddings loses no link. Of at most 3 differences one half of the vector (16 segments) holds at most 1: each half is
one grid, whose cells are joined with themselves and with the cells one step away. Only vectors of odd sum probe those
neighbours, as two vectors one step apart have sums of different parity. The Manhattan bound over both halves and then
the exact Hamming distance are tested inside the join, so only true links leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnbeck.llm.common import components, in_batches, materialise, table

SHINGLE = 3
DISTANCE = 3
SEED = 42
#: The low bit of each segment, as a signed long.
LOW = 0x5555555555555555


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64 bits: 1 where over half the shingles' XXH64 have the bit. Null, empty or blank text: zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    parts = zip(*(words[i:] for i in range(shingle)), strict=False) if len(words) >= shingle else [words]
    hashes = np.fromiter((digest(b" ".join(p), seed) for p in parts), dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * counts > len(hashes)).astype(np.uint8), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(x.as_py()) for x in batch.column(1)], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): fp holds the unsigned fingerprint's bits in a long."""
    return in_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))).mapInArrow(_fingerprints, "doc_id long, fp long")


def _pair_or(x: Column) -> Column:
    return x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(LOW))


def _pair_and(x: Column) -> Column:
    return x.bitwiseAND(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(LOW))


def manhattan(x: Column, y: Column) -> Column:
    """Distance of two embeddings: a segment's count is the sum of "any bit" and "both bits"."""
    return F.bit_count(_pair_or(x).bitwiseXOR(_pair_or(y))) + F.bit_count(_pair_and(x).bitwiseXOR(_pair_and(y)))


def links(distinct: DataFrame) -> DataFrame:
    """Distinct (fp, node) -> (a, b): all pairs of nodes whose fingerprints differ in 1 to 3 bits, each at least once."""
    halves = F.array(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32))
    cells = distinct.select("fp", "node", F.posexplode(halves).alias("half", "bits"))
    cells = cells.select("fp", "node", "half", (_pair_or(F.col("bits")) + _pair_and(F.col("bits"))).alias("cell"))
    field = lambda i: F.shiftrightunsigned(F.col("cell"), 2 * i).bitwiseAND(F.lit(3))
    steps = [F.when(field(i) < 2, F.col("cell") + F.lit(1 << 2 * i)) for i in range(16)] + [F.when(field(i) > 0, F.col("cell") - F.lit(1 << 2 * i)) for i in range(16)]
    near = F.array_compact(F.array(*steps))
    # A field is 0, 1 or 2 (binary 10): its parity is its low bit.
    odd = F.bit_count(F.col("cell").bitwiseAND(F.lit(0x55555555))).bitwiseAND(F.lit(1)) == 1
    probes = cells.select("half", F.explode(F.when(odd, F.concat(F.array("cell"), near)).otherwise(F.array("cell"))).alias("at"), F.col("cell").alias("own"), F.col("fp").alias("fp2"), F.col("node").alias("b"))
    x, y = F.col("fp"), F.col("fp2")
    on = (cells.half == probes.half) & (cells.cell == probes["at"]) & ((probes["at"] != probes["own"]) | (x < y)) & (manhattan(x, y) <= DISTANCE) & (F.bit_count(x.bitwiseXOR(y)) <= DISTANCE)
    return cells.join(probes, on).select(F.col("node").alias("a"), "b")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id): one row per row of docs, with the smallest doc_id that its fingerprint's links reach.

    Null, empty and blank texts have fingerprint zero and link like others. Rows of one doc_id keep their own
    fingerprints. A null doc_id never names a component while one that isn't null can; such rows stay. Further columns
    of docs are not read. An empty table gives no rows.
    """
    marked = materialise(fingerprints(docs), "fingerprints")
    # A node is the smallest doc_id of a fingerprint; two fingerprints may share one where a doc_id repeats, which links them.
    distinct = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("node")), "distinct")
    joined = links(distinct.where("node IS NOT NULL"))
    named = distinct.join(components(joined).withColumnRenamed("node", "linked"), F.col("node") == F.col("linked"), "left")
    named = named.select(F.col("fp").alias("fp1"), F.coalesce("component", "node").alias("component_id"))
    return marked.join(named, F.col("fp") == F.col("fp1"), "left").select("doc_id", "fp", "component_id")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage: the document that names each component stays, of repeated rows of it all that are alike; rows without a doc_id stay."""
    keep = near_duplicates(docs).where("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.where("doc_id IS NULL").unionByName(docs.join(keep, docs["doc_id"] == keep["kept_id"], "left_semi"))


QUERIES = {"op4_simhash": op4_simhash}
ORACLES: dict[str, str] = {}
