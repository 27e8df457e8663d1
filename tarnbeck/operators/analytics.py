"""Grouped counts, token sums, calendars, feedback and chat statistics.

Messages have id, chat_id, user_id, role, parent_id, model_id, created_at (epoch seconds), content and usage (JSON).
Bounds are inclusive; None is no bound. Nothing here reads a clock: `now` is always given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def in_range(column: str, start: int | None = None, end: int | None = None) -> Column:
    """start <= column <= end."""
    test = F.lit(True)
    if start is not None:
        test = test & (F.col(column) >= start)
    if end is not None:
        test = test & (F.col(column) <= end)
    return test


def of_members(messages: DataFrame, members: DataFrame | None) -> DataFrame:
    """Messages of the users in members (user_id), by semi join."""
    return messages if members is None else messages.join(members.select("user_id").distinct(), "user_id", "left_semi")


def countable(messages: DataFrame, start: int | None = None, end: int | None = None, assistant: bool = True) -> DataFrame:
    """Not of shared copies (nor of an unknown user), within bounds; of assistants with a model only if so asked."""
    found = messages.where(~F.col("user_id").startswith("shared-") & in_range("created_at", start, end))
    return found.where((F.col("role") == "assistant") & F.col("model_id").isNotNull()) if assistant else found


def count_by(messages: DataFrame, key: str, start: int | None = None, end: int | None = None, members: DataFrame | None = None) -> DataFrame:
    """Messages by model (assistants' alone), user or chat."""
    return countable(of_members(messages, members), start, end, assistant=key == "model_id").groupBy(key).agg(F.count("*").alias("n"))


def tokens_by(messages: DataFrame, key: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """Input, output and total tokens of assistants' messages that have usage; what isn't a number counts nothing."""
    tokens = lambda f: F.coalesce(F.sum(F.expr(f"try_cast(get_json_object(usage, '$.{f}') as bigint)")), F.lit(0))
    found = countable(messages, start, end).where("usage IS NOT NULL").groupBy(key)
    found = found.agg(tokens("input_tokens").alias("input_tokens"), tokens("output_tokens").alias("output_tokens"), F.count("*").alias("n"))
    return found.withColumn("total_tokens", F.col("input_tokens") + F.col("output_tokens"))


def latest_chats(messages: DataFrame, skip: int = 0, limit: int | None = None) -> DataFrame:
    """Chats by their last message, newest first."""
    found = messages.groupBy("chat_id").agg(F.max("created_at").alias("last_at")).orderBy(F.desc("last_at"), "chat_id")
    found = found.offset(skip) if skip else found
    return found if limit is None else found.limit(limit)


def summary(messages: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """One row: messages counts assistants' alone, while users and chats count those of any role."""
    every, ours = countable(messages, start, end, assistant=False), F.expr("role = 'assistant' AND model_id IS NOT NULL")
    return every.agg(F.count_if(ours).alias("total_messages"), F.countDistinct("chat_id").alias("total_chats"), F.countDistinct(F.when(ours, F.col("model_id"))).alias("total_models"), F.countDistinct("user_id").alias("total_users"))


def calendar(spark, first: str, last: str, step: str = "1 day", form: str = "yyyy-MM-dd") -> DataFrame:
    """One row a step, both ends included."""
    return spark.sql(f"select date_format(t, '{form}') as slot from (select explode(sequence(timestamp'{first}', timestamp'{last}', interval {step})) as t)")


def series(messages: DataFrame, unit: str = "day", start: int | None = None, end: int | None = None, members: DataFrame | None = None) -> DataFrame:
    """(slot, model_id, n) by UTC day or hour; with both bounds every slot between them has a row, model null and n 0 where it has none."""
    form = {"day": "yyyy-MM-dd", "hour": "yyyy-MM-dd HH:00"}[unit]
    slot = lambda c: F.date_format(F.timestamp_seconds(c), form)
    found = countable(of_members(messages, members), start, end).groupBy(slot(F.col("created_at")).alias("slot"), "model_id").agg(F.count("*").alias("n"))
    if start is None or end is None:
        return found
    spark = messages.sparkSession
    every = spark.sql(f"select explode(sequence(date_trunc('{unit}', timestamp_seconds({start})), date_trunc('{unit}', timestamp_seconds({end})), interval 1 {unit})) as t").select(F.date_format("t", form).alias("slot"))
    return every.join(found, "slot", "left").select("slot", "model_id", F.coalesce("n", F.lit(0)).alias("n"))


def grand_totals(found: DataFrame, columns: list[str]) -> DataFrame:
    return found.agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in columns))


def rating(column: Column) -> Column:
    """1, -1 or null; text and numbers alike."""
    value = F.expr("try_cast(r as int)") if column is None else column.try_cast("int")
    return F.when(value.isin(1, -1), value)


def feedback_history(feedback: DataFrame, model: str, now: int, days: int, slots: int | None = None) -> DataFrame:
    """(slot, won, lost) of a model, a row a day up to now's; slots is days, or days + 1 where the overview asks."""
    count = days if slots is None else slots
    spark = feedback.sparkSession
    mine = feedback.where((F.col("model_id") == model) & (F.col("created_at") >= now - days * 86400))
    mine = mine.groupBy(F.date_format(F.timestamp_seconds("created_at"), "yyyy-MM-dd").alias("slot")).agg(F.count_if(rating(F.col("rating")) == 1).alias("won"), F.count_if(rating(F.col("rating")) == -1).alias("lost"))
    every = spark.range(count).select(F.date_format(F.date_sub(F.to_date(F.timestamp_seconds(F.lit(now))), F.col("id").cast("int")), "yyyy-MM-dd").alias("slot"))
    return every.join(mine, "slot", "left").select("slot", F.coalesce("won", F.lit(0)).alias("won"), F.coalesce("lost", F.lit(0)).alias("lost"))


def top_per(found: DataFrame, group: str, order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group; Spark limits each group before it shuffles."""
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rank") <= k)


def top_tags(feedback: DataFrame, k: int = 5) -> DataFrame:
    """(model_id, tag, n, rank): the commonest tags of each model, ties by tag."""
    counts = feedback.select("model_id", F.explode("tags").alias("tag")).groupBy("model_id", "tag").agg(F.count("*").alias("n"))
    return top_per(counts, "model_id", [F.desc("n"), F.col("tag")], k)


ELO_START, ELO_STEP = 1000.0, 32.0


def expected(a: Column, b: Column) -> Column:
    """Elo's expectation of a against b."""
    return 1 / (1 + F.pow(F.lit(10.0), (b - a) / 400))


def elo(feedback: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """(model_id, rating, won, lost), from feedback in the order of (created_at, id).

    Each rating depends on all before it, so games are folded in order by one task; what reaches it are pairs of a
    winner, its siblings, a sign and a weight. Games of models that share no opponents could be folded apart, but one
    leaderboard is one graph. weights (id, weight) default to 1 where there are none, and to 1 for an id without one.
    """
    games = feedback.where(rating(F.col("rating")).isNotNull() & F.col("model_id").isNotNull()).select("id", "created_at", "model_id", rating(F.col("rating")).alias("sign"), "siblings")
    games = games.withColumn("weight", F.lit(1.0)) if weights is None else games.join(weights.select("id", "weight"), "id", "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))

    def fold(rows):
        stats: dict[str, list[float]] = {}
        for batch in rows:
            for winner, sign, siblings, weight in zip(batch.model_id, batch.sign, batch.siblings, batch.weight, strict=True):
                for other in siblings if siblings is not None else ():
                    a, b = stats.setdefault(winner, [ELO_START, 0, 0]), stats.setdefault(other, [ELO_START, 0, 0])
                    step = ELO_STEP * ((sign > 0) - 1 / (1 + 10 ** ((b[0] - a[0]) / 400))) * weight
                    a[0], b[0] = a[0] + step, b[0] - step
                    a[1 if sign > 0 else 2] += 1
                    b[2 if sign > 0 else 1] += 1
        import pandas as pd

        yield pd.DataFrame([(m, r, int(w), int(x)) for m, (r, w, x) in stats.items()], columns=["model_id", "rating", "won", "lost"])

    return games.repartition(1).sortWithinPartitions("created_at", "id").select("model_id", "sign", "siblings", "weight").mapInPandas(fold, "model_id string, rating double, won long, lost long")


def leaderboard(ratings: DataFrame) -> DataFrame:
    """Ratings rounded half to even, highest first, ties by model."""
    return ratings.select("model_id", F.bround("rating", 0).cast("long").alias("rating"), "won", "lost", (F.col("won") + F.col("lost")).alias("n")).orderBy(F.desc("rating"), "model_id")


def chat_stats(messages: DataFrame) -> DataFrame:
    """By chat: messages, mean lengths by role, mean seconds from a question to its answer (0 if none), last time."""
    asked = messages.select(F.col("chat_id").alias("c"), F.col("id").alias("p"), F.col("created_at").alias("asked_at"), F.col("role").alias("asked_by"))
    answered = messages.join(asked, (F.col("chat_id") == F.col("c")) & (F.col("parent_id") == F.col("p")), "left")
    wait = F.when((F.col("role") == "assistant") & (F.col("asked_by") == "user") & (F.col("created_at") > 0) & (F.col("asked_at") > 0), F.col("created_at") - F.col("asked_at"))
    mean = lambda role: F.coalesce(F.avg(F.when(F.col("role") == role, F.length("content"))), F.lit(0.0))
    return answered.groupBy("chat_id").agg(
        F.count("*").alias("message_count"), mean("user").alias("average_user_length"), mean("assistant").alias("average_assistant_length"), F.coalesce(F.avg(wait), F.lit(0.0)).alias("average_response_time"), F.max("created_at").alias("last_message_at"),
        F.coalesce(F.sum(F.when(F.col("role") == "assistant", 1).otherwise(0)), F.lit(0)).alias("answers"),
    )


def exact_set(members: DataFrame, group: str, member: str, wanted: list) -> DataFrame:
    """Groups whose members are exactly those wanted."""
    return members.groupBy(group).agg(F.count("*").alias("n"), F.count_if(F.col(member).isin(wanted)).alias("inside")).where((F.col("n") == len(wanted)) & (F.col("inside") == len(wanted))).select(group)


def share(counts: DataFrame, column: str = "n") -> DataFrame:
    """Percent of the whole; the whole is one aggregated row."""
    return counts.crossJoin(F.broadcast(counts.agg(F.sum(column).alias("whole")))).withColumn("percent", 100.0 * F.col(column) / F.col("whole")).drop("whole")


def bigram_penalty(tokens: Column) -> Column:
    """-2 for none or under 0.3 distinct bigrams, -1 under 0.5, else 0; under 20 tokens always 0."""
    # A let, so that the tokens are made once; pairs are spelt as strings, which are told apart by hash, and the length
    # keeps two pairs of one spelling apart.
    return F.transform(F.array(tokens), _penalty)[0]


def _penalty(tokens: Column) -> Column:
    many = F.greatest(F.size(tokens) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(tokens, 1, many), F.slice(tokens, 2, many), lambda a, b: F.concat(F.length(a).cast("string"), F.lit(":"), a, b))
    of = lambda ratio: F.when(ratio < 0.3, -2.0).when(ratio < 0.5, -1.0).otherwise(0.0)
    ratio = F.transform(F.array(F.size(F.array_distinct(pairs)) / many), of)[0]
    return F.when(F.size(tokens) == 0, -2.0).when(F.size(tokens) < 20, 0.0).otherwise(ratio)


def thread_stats(messages: DataFrame) -> DataFrame:
    """Of each top-level message: replies and the last reply's time (null if none)."""
    replies = messages.where("parent_id IS NOT NULL").groupBy(F.col("parent_id").alias("of")).agg(F.count("*").alias("reply_count"), F.max("created_at").alias("latest_reply_at"))
    top = messages.where("parent_id IS NULL")
    return top.join(replies, F.col("id") == F.col("of"), "left").select("id", F.coalesce("reply_count", F.lit(0)).alias("reply_count"), "latest_reply_at")


def latency_histogram(requests: DataFrame, keys: list[str], value: str, low: float, high: float, buckets: int) -> DataFrame:
    """Requests by keys and bucket of equal width; 0 and buckets + 1 hold what lies outside."""
    return requests.groupBy(*keys, F.width_bucket(F.col(value), F.lit(low), F.lit(high), F.lit(buckets)).alias("bucket")).agg(F.count("*").alias("n"))


def first_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key by source order, with the sources of all in `sources`."""
    first = F.min_by(F.struct(*(c for c in rows.columns if c != key)), order)
    return rows.groupBy(key).agg(first.alias("first"), F.array_sort(F.collect_list(order)).alias("sources")).select(key, "first.*", "sources")


def relevance(feedback: DataFrame, tag_vectors: DataFrame, query: list[float]) -> DataFrame:
    """(id, weight): the largest cosine of the query with any of a feedback's tags, 0 without tags."""
    from tarnbeck.functions.vectors import cosine

    q = F.array(*(F.lit(float(x)) for x in query))
    near = tag_vectors.select("tag", cosine(F.col("embedding"), q, 1e-9).alias("c"))
    best = feedback.select("id", F.explode("tags").alias("tag")).join(near, "tag").groupBy("id").agg(F.max("c").alias("weight"))
    return feedback.select("id").join(best, "id", "left").select("id", F.coalesce("weight", F.lit(0.0)).alias("weight"))


def export_stats(messages: DataFrame) -> DataFrame:
    """By message: length of its content over text blocks, seconds since its parent where both times are set."""
    length = F.aggregate("blocks", F.lit(0), lambda n, b: n + F.when(b["type"] == "text", F.length(b["text"])).otherwise(0))
    asked = messages.select(F.col("chat_id").alias("c"), F.col("id").alias("p"), F.col("created_at").alias("asked_at"))
    both = messages.join(asked, (F.col("chat_id") == F.col("c")) & (F.col("parent_id") == F.col("p")), "left")
    return both.select("chat_id", "id", "role", length.alias("content_length"), F.when((F.col("created_at") > 0) & (F.col("asked_at") > 0), F.col("created_at") - F.col("asked_at")).alias("response_time"))
