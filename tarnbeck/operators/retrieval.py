"""Vector and lexical retrieval, fusion, reranking, citations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnbeck.functions.text import xml_escape
from tarnbeck.functions.vectors import cosine, dot, double


def top_k(items: DataFrame, query: list[float], k: int, threshold: float | None = None, where: Column | None = None, key: str = "id", vector: str = "embedding") -> DataFrame:
    """The k best by cosine, scored (cos + 1) / 2: filter first, then score, then threshold."""
    found = items if where is None else items.where(where)
    q = F.array(*(F.lit(float(x)) for x in query))
    found = found.withColumn("score", (cosine(F.col(vector), q) + 1) / 2)
    return (found if threshold is None else found.where(F.col("score") >= threshold)).orderBy(F.desc("score"), key).limit(k)


def top_k_per_query(items: DataFrame, queries: DataFrame, k: int, key: str = "id", vector: str = "embedding", group: list[str] = (), block_rows: int = 1000) -> DataFrame:
    """(qid, key, score, rank): the k best of each query, and of each group if given.

    queries (qid, qvec) is a stated set: up to block_rows of them are broadcast, which is checked; of more, blocks by
    hash go one after another, each broadcast, so no pair of unbounded sides is ever formed.
    """
    n = queries.count()
    blocks = max(1, -(-n // block_rows))
    parts = []
    for b in range(blocks):
        some = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == b)
        scored = items.crossJoin(F.broadcast(some)).select("qid", key, *group, ((cosine(F.col(vector), F.col("qvec")) + 1) / 2).alias("score"))
        w = Window.partitionBy("qid", *group).orderBy(F.desc("score"), key)
        parts.append(scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def embed(docs: DataFrame, model: Callable, text: str = "text", prefix: str = "", out: str = "embedding") -> DataFrame:
    """Vectors by a pluggable function over a pandas series, equal texts once; a query's prefix may go before."""
    from pyspark.sql.functions import pandas_udf

    run = pandas_udf(model, "array<float>")
    once = docs.select(text).distinct().withColumn(out, run(F.concat(F.lit(prefix), F.regexp_replace(text, r"\n", " "))))
    return docs.join(once, text, "left")


#: Distinct terms of queries that are broadcast at most.
ASKED = 100_000


def tokens(c: Column) -> Column:
    return F.array_remove(F.split(c, r"\s+", -1), "")


def bm25(docs: DataFrame, queries: DataFrame, k: int | None = None, key: str = "id", text: str = "text", k1: float = 1.5, b: float = 0.75, epsilon: float = 0.25) -> DataFrame:
    """(qid, key, score, rank) by Okapi BM25 over white-space tokens; idf below 0 becomes epsilon times the mean idf.

    Document frequencies cover all terms, each once a document and added up before they are dealt out; counts within
    documents are of the queries' terms alone, which are a stated set: broadcast up to ASKED of them, else joined by
    hash. Ranks compare scores to six digits, so that the order of additions decides nothing; ties go by key.
    """
    words = docs.select(key, tokens(F.col(text)).alias("t"))
    facts = words.agg(F.count("*").alias("n_docs"), F.avg(F.size("t")).alias("mean_length"))
    asked = queries.select("qid", F.explode(tokens(F.col("query"))).alias("term")).groupBy("qid", "term").agg(F.count("*").alias("times"))
    sought = asked.select("term").distinct()
    sought = F.broadcast(sought) if sought.limit(ASKED + 1).count() <= ASKED else sought
    some = words.select(key, F.size("t").alias("length"), F.explode("t").alias("term")).join(sought, "term", "left_semi")
    terms = some.groupBy(key, "length", "term").agg(F.count("*").alias("tf"))
    df = words.select(F.explode(F.array_distinct("t")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    idf = df.crossJoin(F.broadcast(facts)).withColumn("raw", F.log(F.col("n_docs") - F.col("df") + 0.5) - F.log(F.col("df") + 0.5))
    floor = idf.agg((epsilon * F.avg("raw")).alias("least"))
    idf = idf.crossJoin(F.broadcast(floor)).select("term", F.when(F.col("raw") < 0, F.col("least")).otherwise(F.col("raw")).alias("idf"), "mean_length")
    part = F.col("times") * F.col("idf") * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / F.col("mean_length")))
    scored = asked.join(idf, "term").join(terms, "term").groupBy("qid", key).agg(F.sum(part).alias("score"))
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc(F.round("score", 6)), key)))
    return ranked if k is None else ranked.where(F.col("rank") <= k)


def fuse(lists: list[tuple[DataFrame, float]], key: str, c: int = 60) -> DataFrame:
    """(qid, key, score): weighted reciprocal ranks over lists with qid, key and rank; lists without weight are left out."""
    out = None
    for rows, weight in lists:
        if weight > 0:
            part = rows.select("qid", key, (F.lit(float(weight)) / (c + F.col("rank"))).alias("part"))
            out = part if out is None else out.unionByName(part)
    return out.groupBy("qid", key).agg(F.sum("part").alias("score"))


def rerank(rows: DataFrame, score: Column, key: str, threshold: float = 0.0, n: int | None = None) -> DataFrame:
    """New scores; what is under the threshold goes, if that isn't zero; best first, n of each query."""
    scored = rows.withColumn("score", score)
    scored = scored.where(F.col("score") >= threshold) if threshold else scored
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), key)))
    return ranked if n is None else ranked.where(F.col("rank") <= n)


def hybrid(items: DataFrame, queries: DataFrame, k: int, n: int, weight: float = 0.5, threshold: float = 0.0) -> DataFrame:
    """items (id, text, embedding), queries (qid, query, qvec): lexical and vector lists fused, reranked by cosine."""
    vectors = top_k_per_query(items, queries.select("qid", "qvec"), k)
    words = bm25(items, queries.select("qid", "query"), k)
    fused = fuse([(words, weight), (vectors, 1 - weight)], "id").drop("score")
    both = fused.join(items.select("id", "embedding"), "id").join(queries.select("qid", "qvec"), "qid")
    found = rerank(both, cosine(F.col("embedding"), F.col("qvec")), "id", threshold, n)
    return found.where(F.col("rank") <= k).select("qid", "id", "score", "rank")


def merge_results(rows: DataFrame, k: int) -> DataFrame:
    """Results (qid, text, score, arrival) of several collections: one a content, its best score, k of each query."""
    best = rows.groupBy("qid", F.sha2(F.encode("text", "UTF-8"), 256).alias("hash")).agg(F.max_by(F.struct("text", "score", "arrival"), F.struct(F.col("score"), -F.col("arrival"))).alias("b")).select("qid", "hash", "b.*")
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "arrival"))).where(F.col("rank") <= k)


class Ivf:
    """An inverted-file index: k-means cells over a bounded sample, every row in its nearest cell.

    A search probes the nearest cells of each query by equi-join on the cell, so a query meets rows / cells * probes
    rows. Cells are few (a parameter), and their centres travel in the plan.
    """

    def __init__(self, items: DataFrame, cells: int = 16, sample: int = 10_000, seed: int = 1, key: str = "id", vector: str = "embedding") -> None:
        import numpy as np

        rows = items.select(key, double(F.col(vector)).alias("v")).orderBy(F.xxhash64(key)).limit(sample).collect()
        x = np.array([r.v for r in rows])
        x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-12
        r = np.random.default_rng(seed)
        centres = x[r.choice(len(x), size=min(cells, len(x)), replace=False)]
        for _ in range(15):
            near = (x @ centres.T).argmax(axis=1)
            for j in range(len(centres)):
                if (near == j).any():
                    c = x[near == j].mean(axis=0)
                    centres[j] = c / (np.linalg.norm(c) + 1e-12)
        self.centres, self.key, self.vector = [list(map(float, c)) for c in centres], key, vector
        self.items = items.withColumn("cell", self._cells(F.col(vector), 1)[0])

    def _cells(self, v: Column, n: int) -> Column:
        near = F.array(*(F.struct((-dot(v, F.array(*(F.lit(x) for x in c)))).alias("d"), F.lit(j).alias("j")) for j, c in enumerate(self.centres)))
        return F.transform(F.slice(F.array_sort(near), 1, n), lambda s: s["j"])

    def search(self, queries: DataFrame, k: int, probes: int = 12) -> DataFrame:
        probed = queries.select("qid", "qvec", F.explode(self._cells(F.col("qvec"), probes)).alias("cell"))
        scored = self.items.join(probed, "cell").select("qid", self.key, ((cosine(F.col(self.vector), F.col("qvec")) + 1) / 2).alias("score"))
        return scored.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), self.key))).where(F.col("rank") <= k)


def cite(sources: DataFrame, group: str, order: str) -> DataFrame:
    """Number sources by first appearance within a group and render each passage with its number."""
    first = sources.groupBy(group, "source_id").agg(F.min(order).alias("first"))
    numbered = first.withColumn("number", F.row_number().over(Window.partitionBy(group).orderBy("first"))).drop("first")
    text = F.concat(F.lit('<source id="'), F.col("number").cast("string"), F.lit('" name="'), xml_escape(F.col("name")), F.lit('">'), F.col("text"), F.lit("</source>"))
    return sources.join(numbered, [group, "source_id"]).withColumn("citation", text)


def references(rows: DataFrame, group: str) -> DataFrame:
    """One text of references a group, in rank order, scores with three digits."""
    one = F.concat(F.lit('<reference id="'), F.col("rank").cast("string"), F.lit('" score="'), F.format_string("%.3f", "score"), F.lit('">'), xml_escape(F.col("text")), F.lit("</reference>"))
    return rows.groupBy(group).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", one.alias("r")))), lambda x: x["r"]), "\n").alias("references"))


def augment(messages: Column, references_: Column) -> Column:
    """References appended to the last user message; other messages keep their places."""
    last = F.array_max(F.transform(messages, lambda m, i: F.when(m["role"] == "user", i).otherwise(-1)))
    return F.transform(messages, lambda m, i: F.when(i == last, F.struct(m["role"].alias("role"), F.concat(m["content"], F.lit("\n\n<references>\n"), references_, F.lit("\n</references>")).alias("content"))).otherwise(F.struct(m["role"].alias("role"), m["content"].alias("content"))))


def with_system(messages: Column, prompt: str) -> Column:
    """The system prompt first, once: an equal one isn't added again."""
    there = F.exists(messages, lambda m: (m["role"] == "system") & m["content"].contains(prompt))
    return F.when(there, messages).otherwise(F.concat(F.array(F.struct(F.lit("system").alias("role"), F.lit(prompt).alias("content"))), messages))


def wants_search(query: Column) -> Column:
    """Not for an empty query nor for a task prompt."""
    return (F.trim(query) != "") & ~query.startswith("### Task:")
