"""Retrieval over the embeddings, documents and benchmark tables, with oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnbeck.functions import vectors as V
from tarnbeck.operators import retrieval as R
from tarnbeck.plans.relational import GRANTS, GROUPS, HELD, ME, PARTS, _HOST, grants, parts
from tarnbeck.plans.views import table

del _HOST
QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def items(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").withColumnRenamed("vec_id", "id")


def vector_queries(spark: SparkSession, d: str) -> DataFrame:
    """Every vector whose id is divisible by 50."""
    return table(spark, d, "embeddings").where("vec_id % 50 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qvec"))


_COS = "list_cosine_similarity({a}::double[], {b}::double[])"
_SCORE = f"round(({_COS.format(a='e.embedding', b='q.embedding')} + 1) / 2, 6)"


@query(f"select e.vec_id id, {_SCORE} score from embeddings e, (select embedding from embeddings where vec_id = 0) q where e.label <> 3 and ({_COS.format(a='e.embedding', b='q.embedding')} + 1) / 2 >= 0.5 order by ({_COS.format(a='e.embedding', b='q.embedding')}) desc, 1 limit 10")
def x03_topk_cosine(spark: SparkSession, d: str) -> DataFrame:
    q = items(spark, d).where("id = 0").first().embedding
    return R.top_k(items(spark, d), q, 10, 0.5, F.col("label") != 3).select("id", F.round("score", 6).alias("score"))


_PER = f"select * from (select q.vec_id qid, e.vec_id id, {_SCORE} score, row_number() over (partition by q.vec_id {{g}} order by {_COS.format(a='e.embedding', b='q.embedding')} desc, e.vec_id)::int rank {{c}} from embeddings e, embeddings q where q.vec_id % 50 = 0) where rank <= {{k}}"


@query(_PER.format(g="", c="", k=10))
def x04_topk_per_query(spark: SparkSession, d: str) -> DataFrame:
    return R.top_k_per_query(items(spark, d), vector_queries(spark, d), 10).withColumn("score", F.round("score", 6))


@query(_PER.format(g=", e.label", c=", e.label", k=2))
def j16_lateral_topk(spark: SparkSession, d: str) -> DataFrame:
    return R.top_k_per_query(items(spark, d), vector_queries(spark, d), 2, group=["label"]).withColumn("score", F.round("score", 6))


@query("select vec_id, label from embeddings where label in (1, 2)")
def x05_full_collections(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", "label")
    return e.where("label = 1").unionByName(e.where("label = 2"))


@query("select vec_id from embeddings where label = 4 order by 1 limit 20")
def x06_filtered_get(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").where("label = 4").orderBy("vec_id").limit(20).select("vec_id")


@query()
def x07_ivf_search(spark: SparkSession, d: str) -> DataFrame:
    return R.Ivf(items(spark, d), cells=16).search(vector_queries(spark, d), 10, probes=12)


_BM25 = """with words as (select doc_id id, list_filter(regexp_split_to_array(text, '\\s+'), lambda t: t <> '') t from documents), facts as (select count(*) n, avg(len(t)) m from words),
 terms as (select id, len(t) l, w, count(*) tf from (select id, t, unnest(t) w from words) group by 1, 2, 3), df as (select w, count(*) df from terms group by 1), raw as (select w, ln(n - df + 0.5) - ln(df + 0.5) raw, m from df, facts),
 idf as (select w, case when raw < 0 then 0.25 * (select avg(raw) from raw) else raw end idf, m from raw), asked as (select qid, w, count(*) times from (select item_id qid, unnest(list_filter(regexp_split_to_array(text, '\\s+'), lambda t: t <> '')) w from benchmark) group by 1, 2),
 scored as (select qid, id, sum(times * idf * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * l / m))) score from asked join idf using (w) join terms using (w) group by 1, 2),
 ranked as (select qid, id, score, row_number() over (partition by qid order by round(score, 6) desc, id)::int rank from scored)"""


@query(_BM25 + " select qid, id, round(score, 4) score from ranked where rank <= 3")
def x08_bm25(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    return R.bm25(docs, table(spark, d, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("query")), 3).select("qid", "id", F.round("score", 4).alias("score"))


@query("with a as (select o_custkey qid, o_orderkey id, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) r from orders), b as (select o_custkey qid, o_orderkey id, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) r from orders) select qid, id, round(sum(w), 9) score from (select qid, id, 0.4 / (60 + r) w from a where r <= 5 union all select qid, id, 0.6 / (60 + r) from b where r <= 5) group by 1, 2")
def x09_rank_fusion(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    o = table(spark, d, "orders").select(F.col("o_custkey").alias("qid"), F.col("o_orderkey").alias("id"), "o_totalprice", "o_orderdate")
    ranked = lambda c: o.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc(c), "id"))).where("rank <= 5")
    return R.fuse([(ranked("o_totalprice"), 0.4), (ranked("o_orderdate"), 0.6)], "id").withColumn("score", F.round("score", 9))


@query(f"select * from (select qid, id, score, row_number() over (partition by qid order by score desc, id)::int rank from (select q.vec_id qid, e.vec_id id, round({_COS.format(a='e.embedding', b='q.embedding')}, 6) score from embeddings e, embeddings q where q.vec_id % 50 = 0 and e.label = q.label) where score >= 0.1) where rank <= 3")
def x10_rerank(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "embeddings").where("vec_id % 50 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qvec"), F.col("label").alias("l"))
    both = items(spark, d).join(q, F.col("label") == F.col("l"))
    return R.rerank(both, F.round(V.cosine(F.col("embedding"), F.col("qvec")), 6), "id", 0.1, 3).select("qid", "id", "score", "rank")


_HYBRID = _BM25.replace("from documents)", "from documents where doc_id in (select vec_id from embeddings))").replace("from benchmark)", "from benchmark where item_id in (select vec_id from embeddings))")


@query(f"""{_HYBRID}, near as (select item_id qid, doc_id id, {_COS.format(a='e.embedding', b='q.embedding')} c from benchmark join embeddings q on q.vec_id = item_id, documents join embeddings e on e.vec_id = doc_id),
 both_ as (select qid, id from ranked where rank <= 10 union select qid, id from (select *, row_number() over (partition by qid order by c desc, id) r from near) where r <= 10)
 select * from (select qid, id, round(c, 6) score, row_number() over (partition by qid order by c desc, id)::int rank from both_ join near using (qid, id)) where rank <= 5""")
def x11_hybrid(spark: SparkSession, d: str) -> DataFrame:
    """documents stand in for the vectors of their ids: lexical and vector lists fused and reranked."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text").join(items(spark, d).select("id", "embedding"), "id")
    asked = table(spark, d, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("query")).join(items(spark, d).select(F.col("id").alias("qid"), F.col("embedding").alias("qvec")), "qid")
    return R.hybrid(docs, asked, 10, 5).withColumn("score", F.round("score", 6))


@query("select qid, doc_id, score from (select *, row_number() over (partition by qid order by score desc, doc_id) r from (select item_id qid, doc_id, score, text from (select item_id, d.doc_id, (d.doc_id * 7 + item_id) % 101 score, d.text, row_number() over (partition by item_id, sha256(d.text) order by (d.doc_id * 7 + item_id) % 101 desc, d.doc_id) n from benchmark b, documents d where d.doc_id % (select count(*) from benchmark) = item_id) where n = 1)) where r <= 5")
def x12_merge_results(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "benchmark")
    docs = table(spark, d, "documents").crossJoin(F.broadcast(asked.agg(F.count("*").alias("n"))))  # one row
    docs = docs.select(F.col("doc_id").alias("arrival"), "text", (F.col("doc_id") % F.col("n")).alias("qid"))
    rows = docs.join(asked.select(F.col("item_id").cast("long").alias("qid")), "qid").withColumn("score", (F.col("arrival") * 7 + F.col("qid")) % 101)
    return R.merge_results(rows, 5).select("qid", F.col("arrival").alias("doc_id"), "score")


@query("select conv_id, turn, '<source id=\"' || number || '\" name=\"' || \"role\" || '\">' || text || '</source>' citation from (select *, dense_rank() over (partition by conv_id order by first) number from (select *, min(turn) over (partition by conv_id, \"role\") first from conversations))")
def x19_citations(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").select("conv_id", "turn", "text", F.col("role").alias("source_id"), F.col("role").alias("name"))
    return R.cite(c, "conv_id", "turn").select("conv_id", "turn", "citation")


@query("select label, string_agg('<reference id=\"' || rank || '\" score=\"' || printf('%.3f', vec_id / 7) || '\">v' || vec_id || ' &lt;&amp;&gt;</reference>', chr(10) order by rank) \"references\" from (select *, row_number() over (partition by label order by vec_id) rank from embeddings) where rank <= 3 group by 1")
def x20_references(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    rows = table(spark, d, "embeddings").withColumn("rank", F.row_number().over(Window.partitionBy("label").orderBy("vec_id"))).where("rank <= 3")
    return R.references(rows.select("label", "rank", (F.col("vec_id") / 7).alias("score"), F.concat(F.lit("v"), F.col("vec_id").cast("string"), F.lit(" <&>")).alias("text")), "label")


@query(f"select e.vec_id id, {_SCORE} score from embeddings e, (select embedding from embeddings where vec_id = 1) q where e.label = 2 order by ({_COS.format(a='e.embedding', b='q.embedding')}) desc, 1 limit 1")
def x21_memory_search(spark: SparkSession, d: str) -> DataFrame:
    q = items(spark, d).where("id = 1").first().embedding
    return R.top_k(items(spark, d), q, 1, where=F.col("label") == 2).select("id", F.round("score", 6).alias("score"))


@query(f"select e.vec_id id, {_SCORE} score from embeddings e, (select embedding from embeddings where vec_id = 2) q where e.vec_id in (select id from {PARTS} p where user_id = 'u3' or exists(select 1 from {GRANTS} g where resource_id = p.id and permission = 'read' and {HELD})) order by ({_COS.format(a='e.embedding', b='q.embedding')}) desc, 1 limit 10")
def x22_knowledge_search(spark: SparkSession, d: str) -> DataFrame:
    from tarnbeck.operators.joins import readable

    mine = readable(parts(spark, d), grants(spark, d), "part", ME, GROUPS).select("id")
    q = items(spark, d).where("id = 2").first().embedding
    return R.top_k(items(spark, d).join(mine, "id", "left_semi"), q, 10).select("id", F.round("score", 6).alias("score"))


@query("select conv_id, text <> '' and not starts_with(text, '### Task:') wanted from conversations where turn = 0")
def x23_turn_guard(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").where("turn = 0").select("conv_id", R.wants_search(F.col("text")).alias("wanted"))


@query(f"select a.vec_id, round({_COS.format(a='a.embedding', b='b.embedding')}, 6) c, round(list_dot_product(a.embedding::double[], b.embedding::double[]) * 10, 5) reward, round((1 - {_COS.format(a='a.embedding', b='b.embedding')} + 0) / 2, 6) inverted from embeddings a join embeddings b on b.vec_id = a.vec_id + 1")
def fm1_fm2_similarity(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "embeddings").select((F.col("vec_id") - 1).alias("k"), F.col("embedding").alias("other"))
    both = table(spark, d, "embeddings").join(b, F.col("vec_id") == F.col("k"))
    c = V.cosine(F.col("embedding"), F.col("other"))
    return both.select("vec_id", F.round(c, 6).alias("c"), F.round(10 * V.dot(F.col("embedding"), F.col("other")), 5).alias("reward"), F.round(V.SCORES["distance"](1 + c), 6).alias("inverted"))


@query("select vec_id, list_aggregate(list_concat(embedding, [0.0::float, 0.0::float, 0.0::float])[1:66], 'count') n, round(list_sum(embedding[1:10]::double[]), 5) head from embeddings")
def fm4_fit_length(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    return e.select("vec_id", F.size(V.fit_length(F.col("embedding"), 66)).cast("long").alias("n"), F.round(F.aggregate(V.double(V.fit_length(F.col("embedding"), 10)), F.lit(0.0), lambda s, x: s + x), 5).alias("head"))


@query("select n_nationkey, least(60.0, 2.0 * 2.0 ** n_regionkey) wait, round(1 / (1 + 10 ** ((n_nationkey * 10 - 100) / 400)), 9) expected from nation")
def fm6_fm7_formulas(spark: SparkSession, d: str) -> DataFrame:
    from tarnbeck.operators.analytics import expected

    return table(spark, d, "nation").select("n_nationkey", V.backoff(F.col("n_regionkey"), 2.0).alias("wait"), F.round(expected(F.lit(100.0), F.col("n_nationkey") * 10), 9).alias("expected"))


@query("select f.id, round(coalesce(max(c), 0), 6) weight from (select l.doc_id id, [lang, source] tags from labels l join documents d on l.doc_id = d.doc_id) f left join (select 'src' || vec_id tag, list_cosine_similarity(embedding::double[], (select embedding::double[] from embeddings where vec_id = 3)) c from embeddings) t on list_contains(f.tags, t.tag) group by 1")
def a17_relevance(spark: SparkSession, d: str) -> DataFrame:
    from tarnbeck.operators.analytics import relevance

    f = table(spark, d, "labels").join(table(spark, d, "documents"), "doc_id").select(F.col("doc_id").alias("id"), F.array("lang", "source").alias("tags"))
    tags = table(spark, d, "embeddings").select(F.concat(F.lit("src"), F.col("vec_id").cast("string")).alias("tag"), "embedding")
    q = items(spark, d).where("id = 3").first().embedding
    return relevance(f, tags, q).withColumn("weight", F.round("weight", 6))


@query("select m.conv_id chat_id, m.turn id, m.role, 2 * length(m.text) content_length, case when m.turn > 0 then 14 * m.turn - 7 end::bigint response_time from conversations m")
def a22_export_stats(spark: SparkSession, d: str) -> DataFrame:
    from tarnbeck.operators.analytics import export_stats
    from tarnbeck.plans.views import turns

    block = lambda kind: F.struct(F.lit(kind).alias("type"), F.col("content").alias("text"))
    return export_stats(turns(spark, d).withColumn("blocks", F.array(block("text"), block("image"), block("text")))).select("chat_id", "id", "role", F.col("content_length").cast("long").alias("content_length"), "response_time")


_PENALTY = "case when n = 0 then -2.0 when n < 20 then 0.0 when u / (n - 1) < 0.3 then -2.0 when u / (n - 1) < 0.5 then -1.0 else 0.0 end"
_BIGRAMS = "(select doc_id, text, len(t) n, len(list_distinct(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) u from (select doc_id, text, string_split(text, ' ') t from documents))"


@query(f"""select doc_id, round(10 * coalesce(list_dot_product(a.embedding::double[], b.embedding::double[]), 0) + {_PENALTY} + case when trim(text) = '' then -3 else 0 end, 5) reward
 from {_BIGRAMS} left join embeddings a on a.vec_id = doc_id left join embeddings b on b.vec_id = doc_id + 1""")
def x24_reward(spark: SparkSession, d: str) -> DataFrame:
    """Documents as completions: the vector of the next id is the answer's, the penalty comes from the text."""
    from tarnbeck.operators.analytics import bigram_penalty

    e = table(spark, d, "embeddings")
    own, answer = e.select(F.col("vec_id").alias("a"), F.col("embedding").alias("x")), e.select((F.col("vec_id") - 1).alias("b"), F.col("embedding").alias("y"))
    docs = table(spark, d, "documents").join(own, F.col("doc_id") == F.col("a"), "left").join(answer, F.col("doc_id") == F.col("b"), "left")
    similarity = F.coalesce(V.dot(F.col("x"), F.col("y")), F.lit(0.0))
    return docs.select("doc_id", F.round(V.reward(similarity, bigram_penalty(F.split("text", " ", -1)), F.trim("text") == ""), 5).alias("reward"))


@query("select d.doc_id, e.n from documents d join (select text, length(text) n from (select distinct text from documents)) e on d.text = e.text")
def j19_embed_once(spark: SparkSession, d: str) -> DataFrame:
    found = R.embed(table(spark, d, "documents").select("doc_id", F.regexp_replace("text", r"\n", " ").alias("text")), lambda c: c.map(lambda t: [float(len(t))]))
    return found.select("doc_id", found["embedding"][0].cast("long").alias("n"))
