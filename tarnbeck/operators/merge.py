"""Set operations and merges: results are new tables, as parquet has no update in place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def upsert(base: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows by key; a change's non-null fields overwrite, fields that it lacks stay."""
    others = [c for c in base.columns if c not in keys]
    new = changes.select(*keys, *(F.col(c).alias(f"_n_{c}") for c in changes.columns if c not in keys))
    found = base.join(new, keys, "full")
    return found.select(*keys, *(F.coalesce(f"_n_{c}", c).alias(c) if c in changes.columns else F.col(c) for c in others))


def insert_absent(base: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """base and those rows whose key it lacks; of rows with one key, one."""
    return base.unionByName(rows.dropDuplicates(keys).join(base.select(*keys), keys, "left_anti"))


def sync(base: DataFrame, wanted: DataFrame, key: str, compare: list[str]) -> DataFrame:
    """(key, action): insert, update, delete or keep, to make base as wanted."""
    a = base.select(F.col(key).alias("_a"), F.struct(*compare).alias("_old"))
    b = wanted.select(F.col(key).alias("_b"), F.struct(*compare).alias("_new"))
    action = F.when(F.col("_a").isNull(), "insert").when(F.col("_b").isNull(), "delete").when(~F.col("_old").eqNullSafe(F.col("_new")), "update").otherwise("keep")
    return a.join(b, F.col("_a") == F.col("_b"), "full").select(F.coalesce("_a", "_b").alias(key), action.alias("action"))


def orphan_tags(tags: DataFrame, used: DataFrame, threshold: int = 0) -> DataFrame:
    """Tags that at most `threshold` rows use."""
    busy = used.groupBy("tag").agg(F.count("*").alias("n")).where(F.col("n") > threshold).select("tag")
    return tags.join(busy, "tag", "left_anti")


def best_by_content(rows: DataFrame, text: str, score: str, arrival: str, k: int | None = None) -> DataFrame:
    """One row a content hash: the best score, the first to arrive on ties; best first, k of them."""
    key = F.sha2(F.encode(text, "UTF-8"), 256)
    best = rows.groupBy(key.alias("hash")).agg(F.max_by(F.struct(*rows.columns), F.struct(F.col(score), -F.col(arrival))).alias("best")).select("hash", "best.*").orderBy(F.desc(score), arrival)
    return best if k is None else best.limit(k)


def latest(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key."""
    others = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("last")).select(*keys, "last.*")


def duplicates_elsewhere(rows: DataFrame, text: str, owner: str) -> DataFrame:
    """Rows whose content stands under another owner too, by hash."""
    keyed = rows.withColumn("_h", F.sha2(F.encode(text, "UTF-8"), 256))
    shared = keyed.groupBy("_h").agg(F.min(owner).alias("_a"), F.max(owner).alias("_b")).where("_a != _b").select("_h")
    return keyed.join(shared, "_h", "left_semi").drop("_h")


def backfill(chats: DataFrame, now: int) -> DataFrame:
    """(chat_id, id, role, content, created_at) of chats whose `messages` is a map of id to struct; times repaired with floor division."""
    from tarnbeck.functions.dates import repair_time

    rows = chats.select("chat_id", F.explode("messages").alias("id", "m"))
    return rows.select("chat_id", "id", F.col("m.role").alias("role"), F.col("m.content").alias("content"), repair_time(F.col("m.timestamp"), now, floor=True).alias("created_at"))


def merge_tags(tags: DataFrame) -> DataFrame:
    """(user_id, id, pinned): names normalised and merged; the name "pinned" is no tag but a flag."""
    from tarnbeck.functions.text import tag_id

    named = tags.withColumn("id", tag_id(F.col("name")))
    return named.groupBy("user_id").agg(F.array_sort(F.collect_set(F.when(F.col("id") != "pinned", F.col("id")))).alias("tags"), F.bool_or(F.col("id") == "pinned").alias("pinned"))


def grants_of(access: DataFrame, resource_type: str) -> DataFrame:
    """Old access objects -> grant rows. Null means public read, but for files; an empty object grants nothing.

    access has id and access: struct(read: struct(user_ids, group_ids), write: the same).
    """
    rows = []
    for permission in ("read", "write"):
        for kind in ("user", "group"):
            rows.append(access.select(F.col("id").alias("resource_id"), F.lit(kind).alias("principal_type"), F.explode(F.col(f"access.{permission}.{kind}_ids")).alias("principal_id"), F.lit(permission).alias("permission")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    if resource_type != "file":
        out = out.unionByName(access.where("access IS NULL").select(F.col("id").alias("resource_id"), F.lit("user").alias("principal_type"), F.lit("*").alias("principal_id"), F.lit("read").alias("permission")))
    return out.withColumn("resource_type", F.lit(resource_type)).distinct()


def pick_one(rows: DataFrame, key: str, exclude: list, seed: int, allow: list | None = None) -> DataFrame:
    """One row at random, from the allow list or from all but those excluded; the seed fixes it."""
    pool = rows.where(F.col(key).isin(allow)) if allow else rows.where(~F.col(key).isin(exclude)) if exclude else rows
    return pool.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(1)


def order_of(rows: DataFrame, group: str, order: str) -> DataFrame:
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy(group).orderBy(order)))
