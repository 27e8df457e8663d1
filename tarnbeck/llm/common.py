"""What several operators share: reading tables, cutting lineage, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that a Python worker is handed at a time, about.
BATCH_BYTES = 8 << 20
#: White space beyond ASCII: first byte, and the bytes that follow it.
_WIDE = {
    0xC2: (b"\x85", b"\xa0"), 0xE1: (b"\x9a\x80",), 0xE3: (b"\x80\x80",),
    0xE2: (*(bytes([0x80, x]) for x in (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)), b"\x81\x9f"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir, or one in the warehouse where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tarnbeck-shared"
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: its lineage ends there, and it survives the loss of any executor."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.folder = path
    return found


#: Spark removes a query's shuffle files as the query ends, not whenever the driver next collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise_lean(df: DataFrame, name: str) -> DataFrame:
    """As materialise; the write's shuffle files go as it ends. The setting holds for this write alone."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return materialise(df, name)
    finally:
        if before is None:
            conf.unset(_CLEANUP)
        else:
            conf.set(_CLEANUP, before)


def discard(df: DataFrame) -> None:
    """Deletes what materialise wrote for df, which must not be read again."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.folder)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def in_batches(df: DataFrame) -> DataFrame:
    """df, in a session that hands Python workers batches of BATCH_BYTES, so that long texts do not make large ones."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values in a row, where each begins and the last ends) of a column of strings or binaries; null is empty."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    elif pa.types.is_binary(column.type):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_large_string(column.type) else b"")
    _, places, data = column.buffers()
    places = np.frombuffer(places, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, dtype=np.int64)
    return np.frombuffer(data or b"", dtype=np.uint8), places


def slices(raw: np.ndarray, places: np.ndarray, lo: int, hi: int, size: int, gap: np.ndarray) -> Iterator[tuple[int, int, int, int, bool]]:
    """The texts lo to hi in slices of about `size` bytes: (first text, last, first byte, last, whether the text goes on).

    A longer text is a slice of its own, or several that end before a byte of `gap`, which has a flag for each byte.
    """
    i = lo
    while i < hi:
        a = int(places[i])
        j = min(hi, max(i + 1, int(np.searchsorted(places, a + size, side="right")) - 1))
        end = int(places[j])
        at = a + size
        while at < end:
            found = np.nonzero(gap[raw[at : at + size]] & ~gap[raw[at - 1 : min(at + size, len(raw)) - 1]])[0]
            if len(found) and at + int(found[0]) < end:
                yield i, j, a, at + int(found[0]), True
                a = at + int(found[0])
                at = a
            at += size
        yield i, j, a, end, False
        i = j


def mark_sequences(raw: np.ndarray, flags: np.ndarray, value: int, sequences: dict[int, tuple[bytes, ...]] = _WIDE) -> None:
    """Sets flags to value at all bytes of the sequences, given by first byte; of white space beyond ASCII by default."""
    for first, rest in sequences.items():
        at = np.nonzero(raw == first)[0]
        for tail in rest if len(at) else ():
            some = at[at < len(raw) - len(tail)]
            for k, x in enumerate(tail, 1):
                some = some[raw[some + k] == x]
            for k in range(len(tail) + 1):
                flags[some + k] = value


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(a, b) -> (node, component): the smallest node that a node reaches.

    Alternating large-star and small-star steps; each joins a node's links with its smallest neighbour, so no group is
    gathered, and a hub's links are split by the skew join. Ends when a round changes nothing. Loops and nulls in the
    links are ignored; nodes without links are absent. The result is read from one folder, which discard deletes.
    """
    links = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "links")
    mark = None
    for _ in range(rounds):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(low, F.col("u") == F.col("k")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        small = large.join(low, F.col("u") == F.col("k"))
        small = small.select("v", "m").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select(F.col("k").alias("u"), F.col("m").alias("v")))
        last, links = links, materialise(small.distinct(), "links")
        discard(last)
        seen = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    found = links.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    out = found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())
    out.folder = links.folder
    return out
