"""Stateful operators over the events, conversations and pages tables, and chunkers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnbeck.operators import corpus as C
from tarnbeck.plans.views import MESSAGES, messages, table
from tarnbeck.sources import loaders
from tarnbeck.streaming import frames, windows

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


@query("select conv_id || '-' || turn stream, text, null::varchar finish, 0::bigint bad from conversations")
def t01_t02_replies(spark: SparkSession, d: str) -> DataFrame:
    """conversations as recorded streams: each turn's text in two deltas, then the end mark."""
    c = table(spark, d, "conversations").select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("stream"), "text")
    delta = lambda t: F.concat(F.lit("data: "), F.to_json(F.struct(F.array(F.struct(F.struct(t.alias("content")).alias("delta"))).alias("choices"))))
    lines = F.array(F.lit(": hello"), delta(F.substring("text", 1, 20)), F.lit(""), delta(F.expr("substring(text, 21)")), F.lit(""), F.lit("data: [DONE]"), F.lit(""))
    return frames.replies(c.select("stream", F.posexplode(lines).alias("n", "value")), "stream", "n")


@query()
def t05_tagged_parts(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").select("conv_id", "turn", F.concat(F.lit("<think>"), F.substring("text", 1, 10), F.lit("</think>"), F.expr("substring(text, 11)")).alias("text"))
    return c.select("conv_id", "turn", F.posexplode(frames.parts_udf()("text")).alias("n", "x")).select("conv_id", "turn", "n", "x.kind", "x.text")


@query(f"""select a.id, count(b.id) + (select count(*) from {MESSAGES} c where c.user_id = a.user_id and c.created_at // 3600 = a.created_at // 3600 and (c.created_at, c.id) <= (a.created_at, a.id)) total from (select * from {MESSAGES}) a left join (select * from {MESSAGES}) b on b.user_id = a.user_id and b.created_at // 3600 between a.created_at // 3600 - 6 and a.created_at // 3600 - 1 group by a.id, a.user_id, a.created_at""")
def t07_rate_limit(spark: SparkSession, d: str) -> DataFrame:
    m = messages(spark, d).select("user_id", "created_at", "id")
    return windows.rate_limited(m, 3, window=6 * 3600, bucket=3600, key="user_id", at="created_at").select("id", "total")


@query(f"select user_id, min(created_at) started, max(created_at) ended, count(*) beats from (select *, sum(n) over (partition by user_id order by created_at rows unbounded preceding) s from (select *, case when created_at - lag(created_at) over (partition by user_id order by created_at) > 20000 then 1 else 0 end n from {MESSAGES})) group by user_id, s")
def t08_sessions(spark: SparkSession, d: str) -> DataFrame:
    return windows.sessions(messages(spark, d), 20000, "user_id", "created_at")


@query(f"select model_id model, user_id sid, max(created_at) as at from {MESSAGES} group by 1, 2 having 1706700000 - max(created_at) <= 86400")
def t09_usage_pool(spark: SparkSession, d: str) -> DataFrame:
    m = messages(spark, d).select(F.col("model_id").alias("model"), F.col("user_id").alias("sid"), F.col("created_at").alias("at"))
    return windows.usage_pool(m, 1706700000, 86400)


_KEPT = f"""with recursive m as (select user_id k, created_at c from {MESSAGES}), t as (select k, min(c) c from m group by 1
 union all select t.k, min(m.c) c from t join m on m.k = t.k and m.c >= t.c + 50000 group by t.k, t.c) select k "key", c "at" from t"""


@query(_KEPT)
def t12_throttle(spark: SparkSession, d: str) -> DataFrame:
    m = messages(spark, d).select(F.col("user_id").alias("key"), F.col("created_at").alias("at"))
    return windows.throttle(m, 50000)


@query("select time_bucket(interval 1 hour, ts) as start, event_type, count(*) n, round(sum(value), 4) total from events group by 1, 2")
def t_tumbling_windows(spark: SparkSession, d: str) -> DataFrame:
    found = windows.event_windows(table(spark, d, "events"))
    return found.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query()
def ft10_chunks(spark: SparkSession, d: str) -> DataFrame:
    return C.chunks(table(spark, d, "documents"), 1000, 100, key="doc_id")


@query()
def x13_markdown_sections(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.concat(F.lit("# T\n"), F.regexp_replace("text", r"\n", "\n## S\n")).alias("text"))
    return C.split_markdown(docs)


@query()
def x15_character_chunks(spark: SparkSession, d: str) -> DataFrame:
    return C.split_characters(table(spark, d, "documents").withColumnRenamed("doc_id", "id"))


@query()
def x14_merged_chunks(spark: SparkSession, d: str) -> DataFrame:
    parts = C.split_characters(table(spark, d, "documents").withColumnRenamed("doc_id", "id"), 300, 0)
    return C.merge_chunks(parts, 500, 1000)


@query()
def x16_ingest(spark: SparkSession, d: str) -> DataFrame:
    def model(c: pd.Series) -> pd.Series:
        return c.map(lambda t: [float(len(t)), float(t.count("e"))])

    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    return C.ingest(docs.where("id % 2 = 0"), docs.where("id % 2 = 1"), model)


@query()
def w_segment_rows(spark: SparkSession, d: str) -> DataFrame:
    """conversations as long records: turns are parts, their first words recaps; assembled, then cut into training rows."""
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("fid"), F.col("turn").alias("chunk"), F.col("role").alias("title"), F.col("text").alias("body"), F.substring("text", 1, 30).alias("recap"))
    summaries = c.groupBy("fid").agg(F.first_value(F.lit("s")).alias("summary"), F.transform(F.array_sort(F.collect_list(F.struct("chunk", "recap"))), lambda x: x["recap"]).alias("chunk_summaries"))
    records = C.assemble(c, summaries.select("fid", "summary")).join(summaries, "fid")
    return C.segment(records.select(F.col("fid").alias("line"), F.lit("write").alias("user"), F.col("content").alias("assistant"), "summary", "chunk_summaries"))


@query("select page_id, 0::int rank, url link, 't' || page_id title, 's' snippet from pages")
def s20_search_results(spark: SparkSession, d: str) -> DataFrame:
    item = F.struct(F.col("url"), F.concat(F.lit("t"), F.col("page_id").cast("string")).alias("title"), F.lit("s").alias("content"))
    replies = table(spark, d, "pages").select("page_id", F.to_json(F.struct(F.array(item).alias("results"))).alias("reply"))
    return loaders.search_results(replies, "searxng")
