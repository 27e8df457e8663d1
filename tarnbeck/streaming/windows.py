"""Rolling limits, pools with expiry, compaction, throttles, inboxes; and windows with watermarks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def rate_limited(requests: DataFrame, limit: int, window: int = 300, bucket: int = 60, key: str = "key", at: str = "at") -> DataFrame:
    """Requests with `total` over their bucket and the window // bucket before it, and `limited`; keys in lower case.

    Counts go up by bucket first, so the range window runs over buckets and not over requests.
    """
    rows = requests.withColumn("_k", F.lower(key)).withColumn("_b", F.floor(F.col(at) / bucket))
    counts = rows.groupBy("_k", "_b").agg(F.count("*").alias("n"))
    w = Window.partitionBy("_k").orderBy("_b").rangeBetween(-(window // bucket), -1)
    before = counts.select(F.col("_k").alias("k2"), F.col("_b").alias("b2"), F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("_k", "_b").orderBy(at, *(c for c in requests.columns if c not in (key, at))))
    found = rows.withColumn("nth", nth).join(before, (F.col("_k") == F.col("k2")) & (F.col("_b") == F.col("b2")))
    return found.withColumn("total", F.col("before") + F.col("nth")).withColumn("limited", F.col("total") > limit).drop("_k", "_b", "k2", "b2", "before", "nth")


def stream_rate_limit(requests: DataFrame, limit: int, window: int = 300, bucket: int = 60) -> DataFrame:
    """A stream of (key, at) -> (key, at, limited); the counts of live buckets are the state."""

    def step(k: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = dict(zip(*state.get, strict=True)) if state.exists else {}
        out = []
        for at in pd.concat(list(pdfs)).sort_values("at")["at"]:
            b = int(at) // bucket
            held[b] = held.get(b, 0) + 1
            total = sum(n for c, n in held.items() if b - window // bucket <= c <= b)
            out.append((k[0], int(at), total > limit))
        newest = max(held)
        held = {b: n for b, n in held.items() if b >= newest - window // bucket}
        state.update((list(held), list(held.values())))
        yield pd.DataFrame(out, columns=["key", "at", "limited"])

    return requests.groupBy("key").applyInPandasWithState(step, "key string, at long, limited boolean", "bucket array<long>, n array<long>", "append", GroupStateTimeout.NoTimeout)


def live_sessions(beats: DataFrame, now: int, timeout: int, key: str = "session", at: str = "at") -> DataFrame:
    """Sessions whose last heartbeat is no older than the timeout."""
    return beats.groupBy(key).agg(F.max(at).alias("last")).where(now - F.col("last") <= timeout)


def sessions(beats: DataFrame, gap: int, key: str = "session", at: str = "at") -> DataFrame:
    """(key, started, ended, beats): a gap of more than `gap` seconds ends a session."""
    w = Window.partitionBy(key).orderBy(at)
    marked = beats.withColumn("_n", F.when(F.col(at) - F.lag(at).over(w) > gap, 1).otherwise(0))
    marked = marked.withColumn("_s", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(key, "_s").agg(F.min(at).alias("started"), F.max(at).alias("ended"), F.count("*").alias("beats")).drop("_s")


def usage_pool(uses: DataFrame, now: int, timeout: int) -> DataFrame:
    """(model, sid) pairs used within the timeout; models without any are absent."""
    return uses.groupBy("model", "sid").agg(F.max("at").alias("at")).where(now - F.col("at") <= timeout)


def compact(log: list[bytes], merge: Callable[[list[bytes]], bytes], at: int = 500) -> list[bytes]:
    """At `at` updates or more the older half becomes one."""
    return [merge(log[: len(log) // 2]), *log[len(log) // 2 :]] if len(log) >= at else log


def stream_compaction(updates: DataFrame, merge: Callable[[list[bytes]], bytes], at: int = 500) -> DataFrame:
    """A stream of (doc, n, update) -> (doc, size): the log of each document in state, compacted as it grows."""

    def step(k: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        log = [bytes(x) for x in state.get[0]] if state.exists else []
        for x in pd.concat(list(pdfs)).sort_values("n")["update"]:
            log = compact([*log, bytes(x)], merge, at)
        state.update((log,))
        yield pd.DataFrame([(k[0], len(log))], columns=["doc", "size"])

    return updates.groupBy("doc").applyInPandasWithState(step, "doc string, size long", "log array<binary>", "update", GroupStateTimeout.NoTimeout)


def throttle(calls: DataFrame, seconds: float, key: str = "key", at: str = "at") -> DataFrame:
    """Calls that come at least `seconds` after the last one let through of their key; a key's calls are folded in order."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        last, keep = None, []
        pdf = pdf.sort_values(at)
        for t in pdf[at]:
            keep.append(last is None or t - last >= seconds)
            last = t if keep[-1] else last
        return pdf[keep]

    return calls.groupBy(key).applyInPandas(fold, calls.schema)


def inbox(spark: SparkSession, path: str, schema: str, per_poll: int = 1) -> DataFrame:
    """A stream of a directory's new JSONL files, a few a trigger; a bad line is a row with _bad. The checkpoint holds the place."""
    lines = spark.readStream.option("maxFilesPerTrigger", per_poll).text(path).where(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", schema).alias("r"), F.expr("try_parse_json(value)").isNull().alias("b"))
    return parsed.select("r.*", F.when(F.col("b"), F.col("value")).alias("_bad"))


def answer(batch: DataFrame, model: Callable[[pd.Series], pd.Series], text: str = "prompt") -> DataFrame:
    """A result row per request and an error row per bad line."""
    run = F.pandas_udf(model, "string")
    return batch.select("*", F.when(F.col("_bad").isNull(), run(F.coalesce(text, F.lit("")))).alias("result"), F.when(F.col("_bad").isNotNull(), "bad request").alias("error"))


def event_windows(events: DataFrame, length: str = "1 hour", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Counts and sums by event-time window and type, for streams and batch; times are clamped by the caller before, as a watermark drops late rows."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    w = F.window("ts", length, slide) if slide else F.window("ts", length)
    return timed.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def session_windows(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "user_id", "n")
