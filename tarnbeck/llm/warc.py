"""WARC records and a Merkle fixity audit of two replicas.

Records of a file are the leaves of its trees, in order: a tree covers PER_FILE records, a node hashes its children's
hashes with the range of offsets that they cover, FANOUT children to a node, LEVELS levels to the root. A replica's trees
are written once, one row a tree, each level a column of its own. The audit joins the replicas' roots, and of trees whose
roots differ reads one level after the other, at each only the children of nodes that differ. Records that differ are then
told apart by their keys, as what follows a missing record lies elsewhere but is sound. Record bytes are never shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnbeck.llm.common import materialise, table

FANOUT = 16
LEVELS = 3
PER_FILE = FANOUT**LEVELS
#: Files that records without a page_id are dealt to, by url.
LOOSE = 1 << 20
#: The rehearsed damage: pages with this remainder have another last character in the second replica.
DAMAGE_EVERY, DAMAGE_AT = 97, 13
#: Bytes of records that the reader hands on at a time.
BATCH = 4 << 20


def records(pages: DataFrame) -> DataFrame:
    """(file, page_id, url, content): each page as one WARC resource record; a null page or url is empty.

    The file follows from the page_id, PER_FILE ids to a file, or from the url where that is null, so equal replicas have
    equal files however they are laid out. Further columns are not read.
    """
    page_id = F.col("page_id").cast("long")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    page = pages.select(page_id.alias("page_id"), text("url").alias("url"), text("html").alias("html"))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.regexp_replace("url", "[\r\n]", " "),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")),
        F.lit(">\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length("html").cast("string"),
        F.lit("\r\n\r\n"), F.col("html"), F.lit("\r\n\r\n"),
    )
    loose = F.lit(-1) - F.pmod(F.xxhash64("url"), F.lit(LOOSE))
    named = F.floor(F.col("page_id") / PER_FILE)
    file = F.when(F.col("page_id").isNull(), F.concat(F.lit("loose-"), -loose)).otherwise(F.concat(F.lit("ids-"), named))
    return page.select(file.alias("file"), "page_id", "url", head.alias("content"))


def write_warc(rows: DataFrame, path: str, compression: str = "none") -> None:
    """Records as WARC files through Spark's own writer; a record's last line end is the writer's separator."""
    cut = rows.select(F.expr("left(content, length(content) - 2)").alias("value"))
    cut.write.option("lineSep", "\r\n").option("compression", compression).text(path)


def _unzipped(raw: bytes) -> bytes:
    """All members of a gzip file, or the bytes as they are; what cannot be read further is left."""
    parts = []
    while raw[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(zlib.MAX_WBITS | 16)
        try:
            parts.append(member.decompress(raw))
        except zlib.error:
            return b"".join(parts)
        raw = member.unused_data
    return b"".join(parts) or raw


def _record(whole: bytes, at: int) -> tuple[int, str, bytes, str]:
    """(end, url, payload, error) of the record that begins at a place; an unreadable one ends where the next begins."""
    end = whole.find(b"\r\n\r\n", at)
    fields = dict(x.split(b":", 1) for x in whole[at : max(end, at)].split(b"\r\n")[1:] if b":" in x)
    fields = {k.strip().lower(): v.strip() for k, v in fields.items()}
    length = fields.get(b"content-length", b"")
    url = fields.get(b"warc-target-uri", b"").decode("utf-8", "replace")
    if whole[at : at + 5] == b"WARC/" and end >= 0 and length.isdigit() and end + 4 + int(length) <= len(whole):
        stop = end + 4 + int(length)
        return stop + 4 * (whole[stop : stop + 4] == b"\r\n\r\n"), url, whole[end + 4 : stop], ""
    after = whole.find(b"\r\n\r\nWARC/", at + 1)
    return after + 4 if after >= 0 else len(whole), url, b"", "unreadable record"


_READ = {"file": pa.string(), "seq": pa.int64(), "offset": pa.int64(), "url": pa.string(), "payload": pa.string(), "content": pa.binary(), "error": pa.string()}


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            whole, at, seq, rows, held = _unzipped(raw.as_py()), 0, 0, [], 0
            while at < len(whole):
                stop, url, payload, error = _record(whole, at)
                rows.append((path.rsplit("/", 1)[-1], seq, at, url, payload.decode("utf-8", "replace"), whole[at:stop], error or None))
                held += stop - at
                at, seq = stop, seq + 1
                if held >= BATCH or at >= len(whole):
                    columns = zip(zip(*rows, strict=True), _READ.values(), strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=[*_READ])
                    rows, held = [], 0


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(file, seq, offset, url, payload, content, error) of WARC files, gzip or not, a file to a task at a time.

    file is the last part of the path, offset counts uncompressed bytes. A record without a readable header has an error
    and ends where the next record begins. A file is read whole, so it must have less than 2 GB.
    """
    schema = "file string, seq long, offset long, url string, payload string, content binary, error string"
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(_parse, schema)


def index(rows: DataFrame, key: str = "page_id") -> DataFrame:
    """(file, seq, key, url, offset, length, copies, digest): the leaves.

    Read records keep their places. Others are ordered by key, url and digest within their file, and equal ones are one
    leaf with a count, so that they are added up before anything is dealt out. A key's different records meet in one task.
    """
    content = F.col("content").cast("binary")
    leaves = rows.withColumn("length", F.octet_length(content).cast("long")).withColumn("digest", F.sha2(content, 256))
    if "offset" in rows.columns:
        return leaves.select("file", "seq", F.col(key).alias("key"), "url", "offset", "length", F.lit(1).cast("long").alias("copies"), "digest")
    leaves = leaves.select("file", F.col(key).alias("key"), "url", "length", "digest")
    leaves = leaves.groupBy("file", "key", "url", "length", "digest").agg(F.count("*").alias("copies"))
    own = Window.partitionBy("file").orderBy("key", "url", "length", "digest")
    size = F.col("length") * F.col("copies")
    leaves = leaves.withColumn("seq", F.row_number().over(own).cast("long") - 1).withColumn("offset", F.sum(size).over(own) - size)
    return leaves.select("file", "seq", "key", "url", "offset", "length", "copies", "digest")


_LEAF = ("seq", "key", "url", "offset", "length", "copies", "digest")


def tree(leaves: DataFrame) -> DataFrame:
    """Trees, one row each: (file, part, root, level1, level2, ..., leaves); level1 lies just below the root.

    A level is a map from a node's number to its hash; a node's number is its first record's place over the records that
    a node of the level covers.
    """
    part = F.floor(F.col("seq") / PER_FILE)
    rows = leaves.withColumn("part", part).groupBy("file", "part").agg(F.array_sort(F.collect_list(F.struct(*_LEAF))).alias("leaves"))
    # Each node as (n, lo, hi, hash); the leaves first, then what is above, up to the root.
    hashed = "sha2(concat_ws(':', x.offset, x.length, x.copies, x.digest), 256)"
    rows = rows.withColumn("_0", F.expr(f"transform(leaves, x -> struct(x.seq as n, x.offset as lo, x.offset + x.length * x.copies as hi, {hashed} as hash))"))
    for level in range(LEVELS):
        below = f"_{level}"
        spelt = "sha2(array_join(transform(c, y -> concat_ws(':', y.n, y.lo, y.hi, y.hash)), ','), 256)"
        node = f"struct(g as n, c[0].lo as lo, c[size(c) - 1].hi as hi, {spelt} as hash)"
        groups = f"transform(array_distinct(transform({below}, x -> x.n div {FANOUT})), g -> struct(g as g, filter({below}, x -> x.n div {FANOUT} = g) as c))"
        rows = rows.withColumn(f"_{level + 1}", F.expr(f"transform({groups}, z -> {node.replace('g as n', 'z.g as n').replace('c[', 'z.c[').replace('size(c)', 'size(z.c)').replace('transform(c,', 'transform(z.c,')})"))
    level = lambda k: F.expr(f"map_from_entries(transform(_{LEVELS - k}, x -> struct(x.n, x.hash)))").alias(f"level{k}")
    return rows.select("file", "part", F.expr(f"_{LEVELS}[0].hash").alias("root"), *(level(k) for k in range(1, LEVELS + 1)), "leaves")


def _with(bad: DataFrame, trees: DataFrame, column: str, name: str) -> DataFrame:
    own = trees.select(F.col("file").alias("f_"), F.col("part").alias("p_"), F.col(column).alias(name))
    return bad.join(own, (F.col("file") == F.col("f_")) & (F.col("part") == F.col("p_")), "left").drop("f_", "p_")


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two replicas' trees -> (file, part, nodes): the places of the records, within a file, whose leaves differ or that one lacks."""
    r = right.select(F.col("file").alias("f_"), F.col("part").alias("p_"), F.col("root").alias("r_"))
    both = left.select("file", "part", "root").join(r, (F.col("file") == F.col("f_")) & (F.col("part") == F.col("p_")), "full")
    bad = both.where(~F.col("root").eqNullSafe(F.col("r_"))).select(F.coalesce("file", "f_").alias("file"), F.coalesce("part", "p_").alias("part"))
    bad = bad.withColumn("nodes", F.array("part"))
    for level in range(1, LEVELS + 1):
        bad = materialise(bad, "differing")
        bad = _with(_with(bad, left, f"level{level}", "a"), right, f"level{level}", "b")
        under = f"flatten(transform(nodes, n -> sequence(n * {FANOUT}, n * {FANOUT} + {FANOUT - 1})))"
        bad = bad.select("file", "part", F.expr(f"filter({under}, n -> not (try_element_at(a, n) <=> try_element_at(b, n)))").alias("nodes"))
    return bad


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two indexes -> (file, seq, key, url, offset, length, digest, other_digest, status) of each record that differs.

    status: corrupt, or missing from the one or the other ("missing right", "missing left"), as are lost copies. A record
    that lies elsewhere in its file, because others are missing, is sound. Agreeing replicas give no rows. Keys may be
    null or repeat: of one key and url equal records are sound, the others are matched in order.
    """
    a, b = materialise(tree(left), "tree"), materialise(tree(right), "tree")
    bad = materialise(differing(a, b), "differing")

    def leaves(trees: DataFrame, side: str) -> DataFrame:
        found = _with(bad, trees, "leaves", "leaves").select("file", F.explode(F.expr("filter(leaves, x -> array_contains(nodes, x.seq))")).alias("x"))
        return found.select("file", "x.*", F.lit(side).alias("side"))

    both = leaves(a, "left").unionByName(leaves(b, "right"))
    same = Window.partitionBy("file", "key", "url", "digest", "length")
    of = lambda side: F.sum(F.when(F.col("side") == side, F.col("copies")).otherwise(0))
    both = both.withColumn("more", of("left").over(same) - of("right").over(same))
    # What is left over of a side after equal records have met.
    both = both.where("side = 'left' AND more > 0 OR side = 'right' AND more < 0")
    both = both.withColumn("nth", F.row_number().over(Window.partitionBy("file", "key", "url", "side").orderBy("seq")))
    pick = lambda c, side: F.max(F.when(F.col("side") == side, F.col(c)))
    columns = [F.coalesce(pick(c, "left"), pick(c, "right")).alias(c) for c in ("seq", "offset", "length")]
    found = both.groupBy("file", "key", "url", "nth").agg(*columns, pick("digest", "left").alias("digest"), pick("digest", "right").alias("other_digest"))
    status: Column = F.when(F.col("digest").isNull(), "missing left").when(F.col("other_digest").isNull(), "missing right").otherwise("corrupt")
    return found.select("file", "seq", "key", "url", "offset", "length", "digest", "other_digest", status.alias("status"))


def damaged(rows: DataFrame) -> DataFrame:
    """The second replica of the rehearsal: of some records the last character of the payload is another."""
    hit = (F.col("page_id") % DAMAGE_EVERY == DAMAGE_AT) & ~F.col("content").endswith("\r\n\r\n\r\n\r\n")
    other = "if(substr(content, -5, 1) = '~', '!', '~')"
    return rows.withColumn("content", F.when(hit, F.expr(f"concat(left(content, length(content) - 5), {other}, '\\r\\n\\r\\n')")).otherwise(F.col("content")))


def op5_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = records(table(spark, sf_dir, "pages"))
    return audit(index(rows), index(damaged(rows))).withColumnRenamed("key", "page_id")


QUERIES = {"op5_merkle": op5_merkle}
ORACLES: dict[str, str] = {}
