"""The fixity audit against brute force, over layouts, WARC files and odd records."""

import random

import pytest
from pyspark.sql import functions as F

from tarnbeck.llm import warc

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{SF}/pages.parquet")


def _rows(found):
    return sorted((r.key, r.status) for r in found.collect())


def test_equal_replicas_in_other_layouts(spark, pages, tmp_path):
    for n in (1, 3):
        pages.orderBy("page_id").repartition(n).write.parquet(f"file://{tmp_path}/{n}")
    one, three = (warc.index(warc.records(spark.read.parquet(f"file://{tmp_path}/{n}"))) for n in (1, 3))
    assert warc.audit(one, three).count() == 0


def test_against_brute_force(spark):
    r = random.Random(21)
    left = [(i, f"u{i % 50}", f"<p>{r.randrange(10**6)}") for i in range(9000)] + [(7, "u7", "again")] * 3 + [(None, "v", "x"), (None, "v", "y")]
    right = [(i, u, h + "!" if i in (40, 4097, 8999) else h) for i, u, h in left if i not in (5, 4500)][:-1] + [(20000, "new", "page")]
    right.remove((7, "u7", "again"))
    schema = "page_id long, url string, html string"
    found = warc.audit(*(warc.index(warc.records(spark.createDataFrame(x, schema))) for x in (left, right))).collect()
    assert sorted((x.key if x.key is not None else -1, x.status) for x in found) == [
        (-1, "missing right"), (5, "missing right"), (7, "missing right"), (40, "corrupt"), (4097, "corrupt"), (4500, "missing right"), (8999, "corrupt"), (20000, "missing left"),
    ]


def test_descent_reaches_what_differs_alone(spark):
    rows = spark.createDataFrame([(i, "u", f"p{i}") for i in range(9000)], "page_id long, url string, html string")
    sound = warc.index(warc.records(rows))
    hurt = sound.withColumn("digest", F.when(F.col("key").isin(3, 5000), "0").otherwise(F.col("digest")))
    found = warc.differing(*(warc.materialise(warc.tree(x), "t") for x in (sound, hurt))).collect()
    assert sorted((x.file, x.part, *x.nodes) for x in found) == [("ids-0", 0, 3), ("ids-1", 0, 5000 - 4096)]


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_two_directories_of_warc_files(spark, pages, tmp_path, compression):
    warc.write_warc(warc.records(pages).coalesce(2).sortWithinPartitions("page_id"), f"file://{tmp_path}/a", compression)
    read = warc.read_warc(spark, f"file://{tmp_path}/a/part-*")
    assert read.where("error IS NOT NULL").count() == 0 and read.count() == pages.count()
    left = warc.index(read, "url")
    hurt = read.withColumn("content", F.when(F.col("seq") == 11, F.lit(b"x")).otherwise(F.col("content")))
    found = warc.audit(left, warc.index(hurt, "url")).collect()
    assert found and all(x.seq == 11 and x.status == "corrupt" for x in found)


def test_unreadable_records_and_members(spark, tmp_path):
    import gzip

    good = b"WARC/1.0\r\nContent-Length: 3\r\nWARC-Target-URI: u\r\n\r\nabc\r\n\r\n"
    bad = b"WARC/1.0\r\nWARC-Target-URI: v\r\n\r\nno length\r\n\r\n"
    (tmp_path / "x.warc").write_bytes(good + bad + good + b"tail")
    (tmp_path / "y.warc.gz").write_bytes(gzip.compress(good) + gzip.compress(good))
    rows = warc.read_warc(spark, f"file://{tmp_path}/*.warc*").orderBy("file", "seq").collect()
    assert [(r.file, r.url, r.payload, r.error is None) for r in rows] == [
        ("x.warc", "u", "abc", True), ("x.warc", "v", "", False), ("x.warc", "u", "abc", True), ("x.warc", "", "", False), ("y.warc.gz", "u", "abc", True), ("y.warc.gz", "u", "abc", True),
    ]
    assert rows[2].offset == len(good + bad) and bytes(rows[2].content) == good


def test_damage_always_shows(spark):
    rows = warc.records(spark.createDataFrame([(13, "u", "ends in ~"), (110, "u", ""), (14, "u", "x")], "page_id long, url string, html string"))
    assert _rows(warc.audit(warc.index(rows), warc.index(warc.damaged(rows)))) == [(13, "corrupt")]
