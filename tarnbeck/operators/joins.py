"""Joins: access control, reconciliation by hash, resolution of authors and calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grants_for(grants: DataFrame, kind: str, permission: str, user: str, groups: list[str]) -> DataFrame:
    """(resource_id): what the user holds by name, by group or because it is public."""
    held = ((F.col("principal_type") == "user") & F.col("principal_id").isin("*", user)) | ((F.col("principal_type") == "group") & F.col("principal_id").isin(groups or [""]))
    return grants.where((F.col("resource_type") == kind) & (F.col("permission") == permission) & held).select("resource_id").distinct()


def readable(resources: DataFrame, grants: DataFrame, kind: str, user: str, groups: list[str], permission: str = "read") -> DataFrame:
    """Resources that the user owns or has a grant for; the flag join keeps each once."""
    held = grants_for(grants, kind, permission, user, groups).select(F.col("resource_id").alias("_r"), F.lit(True).alias("_g"))
    return resources.join(held, F.col("id") == F.col("_r"), "left").where((F.col("user_id") == user) | F.col("_g")).drop("_r", "_g")


def read_only(resources: DataFrame, grants: DataFrame, kind: str, user: str, groups: list[str]) -> DataFrame:
    """Readable by grant, not writable, not public, not owned."""
    read, write = grants_for(grants, kind, "read", user, groups), grants_for(grants, kind, "write", user, groups)
    public = grants.where((F.col("resource_type") == kind) & (F.col("principal_id") == "*")).select("resource_id").distinct()
    found = resources.where(F.col("user_id") != user)
    for side, how in ((read, "left_semi"), (write, "left_anti"), (public, "left_anti")):
        found = found.join(side, found.id == side.resource_id, how)
    return found


def accessible(resources: DataFrame, grants: DataFrame, kind: str, permission: str, user: str, groups: list[str]) -> DataFrame:
    """(id) of those of the given resources that grants cover."""
    return resources.join(grants_for(grants, kind, permission, user, groups), F.col("id") == F.col("resource_id"), "left_semi").select("id").distinct()


def users_with(grants: DataFrame, members: DataFrame, users: DataFrame) -> DataFrame:
    """(resource_id, user_id): public grants reach every user who isn't pending, others those named and the groups' members."""
    active = users.where("role != 'pending'").select(F.col("id").alias("user_id"))
    public = grants.where("principal_id = '*'").select("resource_id").distinct().crossJoin(active)
    named = grants.where("principal_type = 'user' AND principal_id != '*'").select("resource_id", F.col("principal_id").alias("user_id"))
    grouped = grants.where("principal_type = 'group'").join(members, F.col("principal_id") == F.col("group_id")).select("resource_id", members["user_id"])
    return public.unionByName(named.unionByName(grouped).join(users.select(F.col("id").alias("user_id")), "user_id", "left_semi").select("resource_id", "user_id")).distinct()


def channels_of(channels: DataFrame, members: DataFrame, grants: DataFrame, user: str, groups: list[str]) -> DataFrame:
    """Group and direct channels by active membership; standard ones by access."""
    own = members.where((F.col("user_id") == user) & F.col("is_active")).select("channel_id")
    closed = channels.where(F.col("type").isin("group", "dm")).join(own, F.col("id") == F.col("channel_id"), "left_semi")
    return closed.unionByName(readable(channels.where("type IS NULL OR type NOT IN ('group', 'dm')"), grants, "channel", user, groups))


def authors(messages: DataFrame, webhooks: DataFrame, users: DataFrame, gone: str = "Deleted Webhook") -> DataFrame:
    """Messages with the name of their webhook, a placeholder where it is gone, else of their user."""
    hooks = webhooks.select(F.col("id").alias("_h"), F.col("name").alias("_hn"))
    people = users.select(F.col("id").alias("_u"), F.col("name").alias("_un"))
    found = messages.join(hooks, F.col("webhook_id") == F.col("_h"), "left").join(people, F.col("user_id") == F.col("_u"), "left")
    return found.withColumn("author", F.when(F.col("webhook_id").isNotNull(), F.coalesce("_hn", F.lit(gone))).otherwise(F.col("_un"))).drop("_h", "_hn", "_u", "_un")


def reconcile_rows(rows: DataFrame, files: DataFrame, min_chars: int = 30) -> DataFrame:
    """Dataset rows with `reason`: null keeps; "too short" or "not in root" removes. Matches by sha1 of the text, without fan-out.

    files has text (null for what isn't text). A fingerprint of a short or non-text file removes as too short.
    """
    prints = files.select(F.sha1(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("fp"), (F.coalesce(F.length("text"), F.lit(0)) >= min_chars).alias("ok")).groupBy("fp").agg(F.bool_or("ok").alias("ok"))
    keyed = rows.withColumn("_fp", F.sha1(F.encode(F.coalesce("source_text", F.lit("")), "UTF-8")))
    reason = F.when(F.col("ok"), F.lit(None)).when(~F.col("ok"), "too short").otherwise("not in root")
    return keyed.join(prints, F.col("_fp") == F.col("fp"), "left").withColumn("reason", reason).drop("_fp", "fp", "ok")


def pending(files: DataFrame, state: DataFrame, limit: int | None = None) -> DataFrame:
    """Files whose id isn't done; what failed is tried again."""
    found = files.join(state.where("state = 'done'").select("fid"), "fid", "left_anti")
    return found if limit is None else found.orderBy("fid").limit(limit)


def merge_state(state: DataFrame, files: DataFrame, kept: DataFrame) -> DataFrame:
    """(fid, state, action): files seen and in the dataset are done, short or non-text ones done as skipped, the rest dropped from done; state without a file is an orphan."""
    seen = files.select("fid", F.col("ok").alias("seen_ok")).join(kept.select(F.col("fid").alias("kf"), F.lit(True).alias("kept")), F.col("fid") == F.col("kf"), "left").drop("kf")
    both = state.withColumnRenamed("state", "was").join(seen, "fid", "full")
    action = F.when(F.col("seen_ok").isNull(), F.concat(F.lit("orphan "), F.col("was"))).when(F.col("kept"), "ok").when(~F.col("seen_ok"), "skip").when(F.col("was") == "done", "missing").otherwise("pending")
    return both.select("fid", "was", action.alias("action"))


def indexed(progress: DataFrame, index: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Finished ids that the index holds, and those that it lacks."""
    there = index.select(key).distinct()
    return progress.join(there, key, "left_semi"), progress.join(there, key, "left_anti")


def by_hash(files: DataFrame, path: str, digest: str) -> DataFrame:
    """The first file whose path has the SHA-1, by path."""
    return files.where(F.sha1(F.encode(path, "UTF-8")) == digest).orderBy(path).limit(1)


def enrich(rows: DataFrame, facts: DataFrame, key: str, defaults: dict) -> DataFrame:
    """Left join with defaults for what isn't known."""
    found = rows.join(facts, key, "left")
    for c, v in defaults.items():
        found = found.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return found


def reactions(rows: DataFrame, users: DataFrame) -> DataFrame:
    """(message_id, name, n, users): who reacted, by user id."""
    joined = rows.join(users.select(F.col("id").alias("_u"), F.col("name").alias("user_name")), F.col("user_id") == F.col("_u"))
    return joined.groupBy("message_id", "name").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("user_id", "user_name"))), lambda x: x["user_name"]), ",").alias("users"))


def pair_calls(items: Column) -> Column:
    """Of an array of (type, call_id, value): each function_call with its output's value, null if none came."""
    outputs = F.filter(items, lambda x: x["type"] == "function_call_output")
    calls = F.filter(items, lambda x: x["type"] == "function_call")
    return F.transform(calls, lambda c: F.struct(c["call_id"].alias("call_id"), c["value"].alias("call"), F.try_element_at(F.transform(F.filter(outputs, lambda o: o["call_id"] == c["call_id"]), lambda o: o["value"]), F.lit(1)).alias("output")))
