"""The driver's tables seen as the engine's own, for Spark and for the oracle alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as chat messages: every third is a user's, every tenth user a shared copy, some without model or usage."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    return e.select(
        F.col("event_id").alias("id"), F.concat(F.lit("c"), (F.col("event_id") % 211).cast("string")).alias("chat_id"),
        F.concat(F.when(F.col("user_id") % 10 == 0, "shared-").otherwise("u"), F.col("user_id").cast("string")).alias("user_id"), F.when(F.col("event_id") % 3 == 0, "user").otherwise("assistant").alias("role"),
        F.when(F.col("event_id") % 50 != 0, F.col("event_type")).alias("model_id"), F.when(F.col("event_id") >= 211, F.col("event_id") - 211).alias("parent_id"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("created_at"),
        F.concat("event_type", F.lit(" "), "props").alias("content"), F.when(F.col("event_id") % 7 != 0, F.concat(F.lit('{"input_tokens":'), k, F.lit(',"output_tokens":'), F.when(F.col("event_id") % 11 == 0, F.lit('"x"')).otherwise(k), F.lit("}"))).alias("usage"),
    )


MESSAGES = """(select event_id id, 'c' || (event_id % 211) chat_id, (case when user_id % 10 = 0 then 'shared-' else 'u' end) || user_id user_id,
 case when event_id % 3 = 0 then 'user' else 'assistant' end "role", case when event_id % 50 <> 0 then event_type end model_id, case when event_id >= 211 then event_id - 211 end parent_id, floor(epoch(ts))::bigint created_at,
 event_type || ' ' || props "content", case when event_id % 7 <> 0 then '{"input_tokens":' || json_extract_string(props, '$.k') || ',"output_tokens":' || (case when event_id % 11 = 0 then '"x"' else json_extract_string(props, '$.k') end) || '}' end usage from events)"""
COUNTABLE = f"(select * from {MESSAGES} where user_id not like 'shared-%' and role = 'assistant' and model_id is not null)"
START, END = 1704412800, 1705536000  # 2024-01-05 and 2024-01-18, midnight


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels as feedback on the source of their document, against the next two sources; tags from language and quality."""
    joined = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("source").alias("model_id")), "doc_id")
    n = F.regexp_extract("model_id", "([0-9]+)$", 1).cast("int")
    sibling = lambda k: F.concat(F.lit("src"), ((n + k) % 20).cast("string"))
    return joined.select(F.col("doc_id").alias("id"), "model_id", (F.lit(1706000000) - F.col("doc_id") * 977 % 2000000).alias("created_at"), (2 * F.col("quality") - 1).cast("string").alias("rating"), F.array(sibling(1), sibling(2)).alias("siblings"), F.array("lang", F.concat(F.lit("q"), F.col("quality").cast("string"))).alias("tags"), F.col("doc_id").alias("chat_id"), "toxic")


FEEDBACK = """(select l.doc_id id, source model_id, (1706000000 - l.doc_id * 977 % 2000000)::bigint created_at, (2 * quality - 1)::varchar rating, [lang, 'q' || quality] tags, l.doc_id chat_id, toxic,
 ['src' || ((regexp_extract(source, '([0-9]+)$', 1)::int + 1) % 20), 'src' || ((regexp_extract(source, '([0-9]+)$', 1)::int + 2) % 20)] siblings from labels l join documents d on l.doc_id = d.doc_id)"""


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as messages: the parent is the turn before."""
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("chat_id"), F.col("turn").alias("id"), F.when(F.col("turn") > 0, F.col("turn") - 1).alias("parent_id"), "role", F.col("text").alias("content"), (F.lit(1700000000) + F.col("conv_id") * 1000 + F.col("turn") * F.col("turn") * 7).alias("created_at"))


TURNS = """(select conv_id chat_id, turn id, case when turn > 0 then turn - 1 end parent_id, "role", text "content", (1700000000 + conv_id * 1000 + turn * turn * 7)::bigint created_at from conversations)"""
