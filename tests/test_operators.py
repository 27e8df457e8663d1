import json

import pandas as pd
from pyspark.sql import functions as F

from tarnbeck.operators import analytics as A
from tarnbeck.operators import corpus as C
from tarnbeck.operators import joins as J
from tarnbeck.operators import merge as M
from tarnbeck.operators import retrieval as R
from tarnbeck.sources import files, loaders
from tarnbeck.streaming import frames, windows


def test_elo_order_and_zero_sum(spark):
    rows = [(1, 10, "a", "1", ["b", "c"]), (2, 5, "b", "-1", ["a"]), (3, 20, "c", "x", ["a"])]
    feedback = spark.createDataFrame(rows, "id long, created_at long, model_id string, rating string, siblings array<string>")
    found = {r.model_id: r for r in A.elo(feedback).collect()}
    ratings = {"a": 1000.0, "b": 1000.0, "c": 1000.0}
    for w, sign, others in (("b", 0, ["a"]), ("a", 1, ["b", "c"])):
        for o in others:
            step = 32 * (sign - 1 / (1 + 10 ** ((ratings[o] - ratings[w]) / 400)))
            ratings[w] += step
            ratings[o] -= step
    assert {m: round(r.rating, 9) for m, r in found.items()} == {m: round(x, 9) for m, x in ratings.items()}
    assert abs(sum(r.rating for r in found.values()) - 3000) < 1e-9
    assert (found["a"].won, found["a"].lost) == (3, 0)


def test_assemble_then_segment(spark):
    parts = spark.createDataFrame([(1, 0, "开", "甲。", "r0"), (1, 1, "", "乙。", "r1"), (2, 0, "x", "只", "r")], "fid long, chunk int, title string, body string, recap string")
    made = C.assemble(parts, spark.createDataFrame([(1, "总"), (2, "")], "fid long, summary string"))
    text = {r.fid: r.content for r in made.collect()}
    assert text[2] == "只"
    assert text[1] == "> **综述**\n>\n> 总\n\n## 第1段：开\n\n甲。\n\n> **前文提要**\n>\n> r0\n\n## 第2段\n\n乙。"
    records = made.select(F.col("fid").alias("line"), F.lit("ask").alias("user"), F.col("content").alias("assistant"), F.lit("总").alias("summary"), F.when(F.col("fid") == 1, F.array(F.lit("r0"), F.lit("r1"))).otherwise(F.array().cast("array<string>")).alias("chunk_summaries"))
    rows = {(r.line, r.segment_index): r for r in C.segment(records).collect()}
    assert set(rows) == {(1, 1), (1, 2), (2, 1)} and rows[2, 1].mode == "short"
    assert "甲。" in rows[1, 1].assistant and C.END not in rows[1, 1].assistant
    assert rows[1, 2].assistant.startswith("乙。") and rows[1, 2].assistant.endswith(C.END) and "> **第一段**" in rows[1, 2].user
    long_ = C.expand(records).where("line = 1 AND chunk_type = 'block_content'").orderBy("block_idx").collect()
    assert [(r.block_title, r.content) for r in long_] == [("开", "甲。"), ("", "乙。")]


def test_reconcile_partitions_rows(spark):
    rows = spark.createDataFrame([("long enough text",), ("gone",), ("s",), (None,)], "source_text string")
    have = spark.createDataFrame([("long enough text",), ("s",), ("s",)], "text string")
    found = {r.source_text: r.reason for r in J.reconcile_rows(rows, have, 5).collect()}
    assert found == {"long enough text": None, "gone": "not in root", "s": "too short", None: "not in root"}


def test_dedup_is_idempotent(spark):
    rows = spark.createDataFrame([("a", 1.0, 0), ("a", 2.0, 1), ("b", 2.0, 2), ("a", 2.0, 3)], "text string, score double, arrival int")
    once = M.best_by_content(rows, "text", "score", "arrival")
    assert [(r.text, r.arrival) for r in once.collect()] == [("a", 1), ("b", 2)]
    assert M.best_by_content(once.drop("hash"), "text", "score", "arrival").collect() == once.collect()


def test_ivf_recall(spark):
    items = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").withColumnRenamed("vec_id", "id")
    queries = items.where("id % 50 = 0").select(F.col("id").alias("qid"), F.col("embedding").alias("qvec"))
    exact = {(r.qid, r.id) for r in R.top_k_per_query(items, queries, 10).collect()}
    near = {(r.qid, r.id) for r in R.Ivf(items, cells=16).search(queries, 10, probes=12).collect()}
    assert len(exact & near) >= 0.9 * len(exact)


def test_blocks_of_queries(spark):
    items = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").withColumnRenamed("vec_id", "id")
    queries = items.where("id % 50 = 0").select(F.col("id").alias("qid"), F.col("embedding").alias("qvec"))
    one, many = R.top_k_per_query(items, queries, 3), R.top_k_per_query(items, queries, 3, block_rows=2)
    key = lambda df: sorted((r.qid, r.rank, r.id) for r in df.collect())
    assert key(one) == key(many)


def test_messages_and_citations(spark):
    row = spark.createDataFrame([([("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")],)], "m array<struct<role:string,content:string>>")
    found = row.select(R.augment(F.col("m"), F.lit("R")).alias("m")).first().m
    assert [x.content for x in found][2] == "c\n\n<references>\nR\n</references>" and found[3].content == "d"
    twice = row.select(R.with_system(R.with_system(F.col("m"), "S"), "S").alias("m")).first().m
    assert [x.role for x in twice].count("system") == 1


def test_files(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "a.txt").write_text("hello\r\nworld ")
    (tmp_path / "d" / "b.bin").write_bytes(b"\0\1\2")
    found = {r.rel: r for r in files.read_texts(files.scan(spark, str(tmp_path))).collect()}
    assert found["a.txt"].text == "hello\nworld" and found["a.txt"].encoding == "utf-8"
    assert not found["d/b.bin"].is_text
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\nbad\n{"a": 2}\n')
    rows = files.read_jsonl(spark, str(tmp_path / "x.jsonl"), "a long", strict=False).collect()
    assert sorted((r.a, r._bad) for r in rows if r._bad is None) == [(1, None), (2, None)] and [r._bad for r in rows if r._bad] == ["bad"]
    (tmp_path / "y.json").write_text('[{"a": 1}, 5, {"a": 3}]')
    assert sorted(r.a for r in files.read_json(spark, str(tmp_path / "y.json"), "a long").collect()) == [1, 3]
    assert files.sniff_json('[{"a":1}]') == "json" and files.sniff_json('{"a":1}\n{"a":2}\n') == "jsonl" and files.sniff_json('{\n"a":1}') == "json"
    out = str(tmp_path / "out")
    files.rewrite(spark.range(3), out)
    files.rewrite(spark.range(5), out, keep="1")
    assert spark.read.json(out).count() == 5 and spark.read.json(out + ".v=1").count() == 3
    assert files.load_state(spark, str(tmp_path / "none")).count() == 0


def test_tree(spark):
    rows = spark.createDataFrame([(1, "user_request", None, None, "u"), (1, "block_content", 2, "t/x", "c")], "line long, chunk_type string, block_idx int, block_title string, content string")
    made = files.tree_files(rows)
    assert {r.rel for r in made.collect()} == {"novel1/用户消息.md", "novel1/t_x-block2/正文.md"}
    back = files.read_tree(made.select("rel", F.encode("content", "UTF-8").alias("content"))).collect()
    assert {(r.chunk_type, r.block_title) for r in back} == {("user_request", None), ("block_content", "t_x")}


def test_loaders():
    assert loaders.load("a.html", b"<p>x &amp; y</p><script>no</script><p>z</p>") == ("x & y\nz", "ok")
    assert loaders.load("a.docx", b"no zip")[1].startswith("error") and loaders.load("a.bin", b"\0")[1] == "unsupported"
    assert loaders.load("a.xml", b"<r><a>1</a><b>2</b></r>")[0] == "1\n2"


def test_frames():
    lines = [": c", "data: a", "data:b", "", "data: x"]
    assert list(frames.events(lines)) == ["a\nb", "x"]
    data = [json.dumps({"choices": [{"delta": {"content": c}, "finish_reason": f}]}) for c, f in (("a", None), ("b", "stop"))]
    r = frames.accumulate([*data, "bad", "[DONE]", data[0]])
    assert (r.text, r.finish, r.bad) == ("ab", "stop", 1)
    s = frames.Splitter()
    for piece in ("x<th", "ink>r1</thi", "nk>y"):
        s.feed(piece)
    s.feed("", last=True)
    assert s.items == [("message", "x"), ("reasoning", "r1"), ("message", "y")]
    assert list(frames.guard_lines(["data: a", "x" * 50, "more", "data: b"], 20)) == ["data: a", "data: {}", "data: b"]
    assert list(frames.coalesce_deltas("abcde", 2)) == ["ab", "cd", "e"]
    assert frames.segment_loop(["甲\n> **前文提要**\n> r\n", "乙\n完", "no"], "完") == (["甲", "乙"], ["r"])
    events = [{"type": "response.output_item.added", "item": {"type": "message"}}, {"type": "response.content_part.added", "output_index": 0, "part": {"text": ""}}, {"type": "response.output_text.delta", "output_index": 0, "delta": "hi"}]
    assert frames.fold_output(events) == [{"type": "message", "content": [{"text": "hi"}]}]
    log = [b"%d" % i for i in range(6)]
    assert windows.compact(log, b"+".join, 6) == [b"0+1+2", b"3", b"4", b"5"] and windows.compact(log, b"+".join, 7) == log


def test_streams(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([("s", 0, "data: a"), ("s", 1, ""), ("s", 2, "data: b")], "stream string, n long, value string").write.parquet(source)
    out = frames.stream_replies(spark.readStream.schema("stream string, n long, value string").parquet(source))
    q = out.writeStream.format("memory").queryName("replies").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [r.event for r in spark.table("replies").collect()] == ["a"]
    limited = str(tmp_path / "limit")
    spark.createDataFrame([("k", t) for t in (0, 10, 20, 70, 4000)], "key string, at long").write.parquet(limited)
    out = windows.stream_rate_limit(spark.readStream.schema("key string, at long").parquet(limited), 3)
    q = out.writeStream.format("memory").queryName("limits").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {r["at"]: r["limited"] for r in spark.table("limits").collect()} == {0: False, 10: False, 20: False, 70: True, 4000: False}


def test_rate_limit_batch(spark):
    rows = spark.createDataFrame([("K", t) for t in (0, 10, 20, 70)] + [("k", 75)], "key string, at long")
    found = {(r["key"], r["at"]): r["total"] for r in windows.rate_limited(rows, 3).collect()}
    assert found == {("K", 0): 1, ("K", 10): 2, ("K", 20): 3, ("K", 70): 4, ("k", 75): 5}


def test_inbox(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.jsonl").write_text('{"prompt": "a"}\nbad\n')
    rows = windows.inbox(spark, str(tmp_path / "in"), "prompt string")
    got = []
    q = rows.writeStream.foreachBatch(lambda b, _: got.extend(windows.answer(b, lambda c: c.str.upper() if isinstance(c, pd.Series) else c).collect())).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r.result, r.error) for r in got if r.error is None) == [("A", None)] and [r.error for r in got if r.error] == ["bad request"]


def test_vector_store(spark, tmp_path):
    from tarnbeck.operators.store import VectorStore

    store = VectorStore(spark, str(tmp_path / "store"), 2)
    rows = lambda *xs: spark.createDataFrame([(i, t, v, m) for i, t, v, m in xs], "id string, text string, embedding array<float>, metadata map<string,string>")
    store.insert("c", rows(("a", "A", [1.0, 0.0], {"k": "1"}), ("b", "B", [0.0, 1.0], {"k": "2"})))
    store.insert("c", rows(("a", "other", [1.0, 0.0], {})))
    store.upsert("c", rows(("b", "B2", [0.6, 0.8], {"k": "2"})))
    assert {r.id: r.text for r in store.all("c").collect()} == {"a": "A", "b": "B2"}
    assert [r.id for r in store.query("c", {"k": {"$in": ["2"]}}, 5).collect()] == ["b"]
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "qid int, qvec array<float>")
    assert [(r.id, round(r.score, 3)) for r in store.search("c", queries, 2).orderBy("rank").collect()] == [("a", 1.0), ("b", 0.8)]
    store.delete("c", spec={"k": 1})
    assert [r.id for r in store.get("c").collect()] == ["b"] and store.has("c")
    store.drop("c")
    assert not store.has("c") and store.all("c").count() == 0


def test_attach(spark):
    from tarnbeck.operators.store import attach

    items = spark.createDataFrame([(1, "text", "hi"), (2, "file", "f1"), (3, "collection", "c"), (4, "file", "f9")], "item int, type string, ref string")
    docs = spark.createDataFrame([("f1", "F1"), ("f2", "F2"), ("f9", "F9")], "id string, text string")
    held = spark.createDataFrame([("c", "f1"), ("c", "f2")], "collection string, id string")
    may = spark.createDataFrame([("f1",), ("f2",)], "id string")
    assert sorted(map(tuple, attach(items, docs, held, may).collect())) == [(1, "1", "hi"), (2, "f1", "F1"), (3, "f2", "F2")]


def test_plugins(spark):
    from tarnbeck.operators import plugins as U

    add = lambda suffix: lambda df, v: df.withColumn("t", F.concat("t", F.lit(suffix + str(v.options.get("x", "")))))
    filters = [U.Filter("b", U.Valves(1), inlet=add("b")), U.Filter("a", U.Valves(1, {"x": 1}), inlet=add("a"), everywhere=True), U.Filter("z", U.Valves(0), inlet=add("z")), U.Filter("off", inlet=add("off"), everywhere=True, active=False)]
    df = spark.createDataFrame([("",)], "t string")
    assert U.run(df, U.chosen(filters, {"b", "z"}), "inlet", {"a": {"x": 2}}).first().t == "za2b"
    models = [U.Model("up", lambda c: c.str.upper()), U.Model("rev", lambda c: c.str[::-1])]
    rows = spark.createDataFrame([("up", "ab"), ("rev", "ab"), ("no", "ab")], "model string, p string")
    assert [r.reply for r in U.route(rows, models, "model", "p").collect()] == ["AB", "ba", None]
    tool = U.Tool("f", lambda n: spark.range(n), {"n": "integer"})
    assert tool(n=3).count() == 3 and tool.spec()["parameters"]["required"] == ["n"]
