"""Versions, state, resumed work, spilled batches, repair, workbooks."""

import io
import threading
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from tarnbeck.functions import prose, prose_udfs
from tarnbeck.operators import corpus
from tarnbeck.operators.store import VectorStore
from tarnbeck.sources import files, loaders, versions


def test_a_reader_never_misses_a_version(spark, tmp_path):
    path = f"file://{tmp_path}/set"
    assert versions.current(spark, path) is None
    versions.publish(spark.range(5), path)
    seen, stop = [], threading.Event()

    def read() -> None:
        while not stop.is_set():
            at = versions.current(spark, path)
            seen.append(at is not None and spark.read.parquet(at).count() in (5, 6))

    reader = threading.Thread(target=read)
    reader.start()
    for n in (6, 5, 6):
        versions.publish(spark.range(n), path)
    stop.set()
    reader.join()
    assert seen and all(seen)
    assert spark.read.parquet(versions.current(spark, path)).count() == 6
    versions.publish(spark.range(7), path, grace=0)
    assert len([x for x in (tmp_path / "set").iterdir() if x.name.startswith("v-")]) == 2


def test_state_and_resumed_work(spark, tmp_path):
    path = f"file://{tmp_path}/state"
    todo = spark.createDataFrame([(f"f{i}",) for i in range(7)], "fid string")
    fails = {"f3"}

    def work(some):
        state = F.when(F.col("fid").isin(*fails or {""}), "failed").otherwise("done")
        return some.select("fid", state.alias("state"), F.lit("ok").alias("status"), F.lit(1).alias("len"), F.lit("utf-8").alias("encoding"), F.lit(None).cast("string").alias("reason"))

    assert files.resume(todo, path, work, batch=3, rounds=1) == 1
    assert files.load_state(spark, path).count() == 3
    assert files.resume(todo, path, work, batch=3) == 2
    found = {r.fid: r.state for r in files.load_state(spark, path).collect()}
    assert found == {f"f{i}": "failed" if i == 3 else "done" for i in range(7)}
    fails.clear()
    assert files.resume(todo, path, work, batch=3) == 1 and files.resume(todo, path, work) == 0
    assert files.load_state(spark, path).where("state = 'done'").count() == 7


def test_failed_batches_are_spilled(spark, tmp_path):
    store = VectorStore(spark, f"file://{tmp_path}/store", 2)
    rows = [(str(i), "t", [1.0, 2.0] if i else [1.0], {"k": "v"}) for i in range(20)]
    failed = store.insert_batches("c", spark.createDataFrame(rows, "id string, text string, embedding array<float>, metadata map<string,string>"), f"file://{tmp_path}/spill", 4)
    spilled = {r.id for r in spark.read.json(f"file://{tmp_path}/spill").collect()}
    held = {r.id for r in store.all("c").collect()}
    assert failed == 1 and "0" in spilled and held | spilled == {r[0] for r in rows} and not held & spilled


def test_repair(spark):
    for text in ("naïve café – “quoted” Straße", "第一章 你好", "plain"):
        once = text.encode().decode("cp1252", "replace") if text == "plain" else "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in text.encode())
        assert prose.repair(once) == text == prose.repair(text)
    assert spark.range(1).select(prose_udfs.repair_udf(F.lit("cafÃ©"))).first()[0] == "café"


def test_workbook():
    made = io.BytesIO()
    with zipfile.ZipFile(made, "w") as z:
        z.writestr("xl/sharedStrings.xml", "<sst><si><t>name &amp; x</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", '<worksheet><sheetData><row><c t="s"><v>0</v></c><c><v>3.5</v></c><c t="inlineStr"><is><t>here</t></is></c><c/></row><row><c t="str"><f>A1</f><v>made</v></c></row></sheetData></worksheet>')
    assert loaders.load("a.xlsx", made.getvalue()) == ("name & x\t3.5\there\nmade", "ok")


def test_one_text_that_the_model_cannot_do(spark):
    def model(c: pd.Series) -> pd.Series:
        if c.str.contains("bad").any():
            raise ValueError("bad")
        return c.map(lambda t: [float(len(t))])

    docs = spark.createDataFrame([(1, "good text"), (2, "bad text"), (3, "more text"), (4, "")], "id long, text string")
    found = {r.id: r.status for r in corpus.ingest(docs, docs.where("false"), model).collect()}
    assert found == {1: "ok", 2: "failed", 3: "ok", 4: "empty"}


def test_batched_map(spark):
    found = corpus.map_batches(spark.range(10), lambda p: p.assign(x=p["id"] * 2), "id long, x long", ["id"], F.col("id") > 4)
    assert sorted(r.x for r in found.collect()) == [10, 12, 14, 16, 18]


def test_trees_are_read_whole(spark):
    rows = spark.createDataFrame([("n1/正文.md", bytearray(("x" * 20_000).encode()))], "rel string, content binary")
    assert len(files.read_tree(rows).first().content) == 20_000 and len(files.read_tree(rows, 100).first().content) == 100
