"""Aggregations, windows and calendars over message, feedback and star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnbeck.operators import analytics as A
from tarnbeck.operators.walks import walk
from tarnbeck.plans.views import COUNTABLE, END, FEEDBACK, MESSAGES, START, TURNS, feedback, messages, table, turns

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


@query(f"select model_id, count(*) n from {COUNTABLE} group by 1")
def a01_count_by_model(spark: SparkSession, d: str) -> DataFrame:
    return A.count_by(messages(spark, d), "model_id")


@query(f"select user_id, count(*) n from {MESSAGES} where user_id not like 'shared-%' and created_at between {START} and {END} group by 1")
def a02_count_by_user(spark: SparkSession, d: str) -> DataFrame:
    return A.count_by(messages(spark, d), "user_id", START, END)


@query(f"select chat_id, count(*) n from {MESSAGES} where user_id not like 'shared-%' group by 1")
def a03_count_by_chat(spark: SparkSession, d: str) -> DataFrame:
    return A.count_by(messages(spark, d), "chat_id")


_TOKENS = "select {key}, coalesce(sum(try_cast(json_extract_string(usage, '$.input_tokens') as bigint)), 0)::bigint input_tokens, coalesce(sum(try_cast(json_extract_string(usage, '$.output_tokens') as bigint)), 0)::bigint output_tokens, count(*) n, (coalesce(sum(try_cast(json_extract_string(usage, '$.input_tokens') as bigint)), 0) + coalesce(sum(try_cast(json_extract_string(usage, '$.output_tokens') as bigint)), 0))::bigint total_tokens from {m} where usage is not null group by 1"


@query(_TOKENS.format(key="model_id", m=COUNTABLE))
def a04_tokens_by_model(spark: SparkSession, d: str) -> DataFrame:
    return A.tokens_by(messages(spark, d), "model_id")


@query(_TOKENS.format(key="user_id", m=COUNTABLE))
def a05_tokens_by_user(spark: SparkSession, d: str) -> DataFrame:
    return A.tokens_by(messages(spark, d), "user_id")


@query(f"select chat_id, max(created_at) last_at from {MESSAGES} group by 1 order by 2 desc, 1 limit 50 offset 20")
def a06_latest_chats(spark: SparkSession, d: str) -> DataFrame:
    return A.latest_chats(messages(spark, d), 20, 50)


@query(f"select count(*) filter (role = 'assistant' and model_id is not null) total_messages, count(distinct chat_id) total_chats, count(distinct model_id) filter (role = 'assistant') total_models, count(distinct user_id) total_users from {MESSAGES} where user_id not like 'shared-%'")
def a07_summary(spark: SparkSession, d: str) -> DataFrame:
    return A.summary(messages(spark, d))


_SERIES = "select slot, model_id, coalesce(n, 0) n from (select strftime(t, '{form}') slot from generate_series(date_trunc('{unit}', to_timestamp({a}) at time zone 'UTC'), date_trunc('{unit}', to_timestamp({b}) at time zone 'UTC'), interval 1 {unit}) s(t)) left join (select strftime(to_timestamp(created_at) at time zone 'UTC', '{form}') slot, model_id, count(*) n from {m} where created_at between {a} and {b} group by 1, 2) using (slot)"


@query(_SERIES.format(form="%Y-%m-%d", unit="day", a=START, b=END, m=COUNTABLE))
def a08_daily_series(spark: SparkSession, d: str) -> DataFrame:
    return A.series(messages(spark, d), "day", START, END)


@query(_SERIES.format(form="%Y-%m-%d %H:00", unit="hour", a=START, b=END, m=COUNTABLE))
def a09_hourly_series(spark: SparkSession, d: str) -> DataFrame:
    return A.series(messages(spark, d), "hour", START, END)


@query(f"select sum(input_tokens)::bigint input_tokens, sum(output_tokens)::bigint output_tokens, sum(n)::bigint n from ({_TOKENS.format(key='model_id', m=COUNTABLE)})")
def a10_grand_totals(spark: SparkSession, d: str) -> DataFrame:
    return A.grand_totals(A.tokens_by(messages(spark, d), "model_id"), ["input_tokens", "output_tokens", "n"])


_HISTORY = "select slot, coalesce(won, 0) won, coalesce(lost, 0) lost from (select strftime((to_timestamp(1706000000) at time zone 'UTC')::date - i::int, '%Y-%m-%d') slot from range({n}) r(i)) left join (select strftime(to_timestamp(created_at) at time zone 'UTC', '%Y-%m-%d') slot, count(*) filter (rating = '1') won, count(*) filter (rating = '-1') lost from {f} where model_id = 'src3' and created_at >= 1706000000 - {days} * 86400 group by 1) using (slot)"


@query(_HISTORY.format(n=14, days=14, f=FEEDBACK))
def a11_feedback_history(spark: SparkSession, d: str) -> DataFrame:
    return A.feedback_history(feedback(spark, d), "src3", 1706000000, 14)


@query(_HISTORY.format(n=31, days=30, f=FEEDBACK))
def a12_overview_history(spark: SparkSession, d: str) -> DataFrame:
    return A.feedback_history(feedback(spark, d), "src3", 1706000000, 30, 31)


@query(f"select tag, count(*) n from (select unnest(tags) tag from {FEEDBACK} where model_id = 'src3') group by 1 order by 2 desc, 1 limit 10")
def a13_model_tags(spark: SparkSession, d: str) -> DataFrame:
    return feedback(spark, d).where("model_id = 'src3'").select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "tag").limit(10)


@query(f"select model_id, tag, n, rank from (select *, row_number() over (partition by model_id order by n desc, tag)::int rank from (select model_id, tag, count(*) n from (select model_id, unnest(tags) tag from {FEEDBACK}) group by 1, 2)) where rank <= 5")
def a14_top_tags(spark: SparkSession, d: str) -> DataFrame:
    return A.top_tags(feedback(spark, d))


#: The ratings as a list by model, one step a game; all models and their games won and lost.
_ELO = f"""with recursive games as (select row_number() over (order by created_at, id, j) k, model_id w, siblings[j] o, case when rating::int > 0 then 1 else 0 end s from {FEEDBACK}, (select unnest([1, 2]) j)),
 names as (select list_sort(list(distinct m)) ms from (select w m from games union select o from games)), places as (select k, list_position(ms, w) wi, list_position(ms, o) oi, s from games, names),
 t as (select 0::bigint k, list_transform(ms, lambda x: 1000.0::double) r from names union all
  select p.k, list_transform(t.r, lambda x, i: case when i = wi then x + 32 * (s - 1 / (1 + 10 ** ((t.r[oi] - t.r[wi]) / 400))) when i = oi then x - 32 * (s - 1 / (1 + 10 ** ((t.r[oi] - t.r[wi]) / 400))) else x end) from t join places p on p.k = t.k + 1),
 ended as (select unnest(ms) model_id, unnest(r) rating from names, (select r from t order by k desc limit 1)),
 tally as (select m, sum(n)::bigint won, sum(1 - n)::bigint lost from (select w m, s n from games union all select o, 1 - s from games) group by 1)"""


@query(_ELO + " select model_id, round(rating, 6) rating, won, lost from ended join tally on m = model_id")
def a15_elo(spark: SparkSession, d: str) -> DataFrame:
    return A.elo(feedback(spark, d)).withColumn("rating", F.round("rating", 6))


@query(_ELO + " select model_id, round_even(rating, 0)::bigint rating, won, lost, won + lost n from ended join tally on m = model_id")
def a16_leaderboard(spark: SparkSession, d: str) -> DataFrame:
    return A.leaderboard(A.elo(feedback(spark, d)))


@query("select n_nationkey, count(c_custkey) member_count from nation left join customer on c_nationkey = n_nationkey group by 1")
def a18_member_count(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("member_count"))
    return table(spark, d, "nation").join(counts, F.col("n_nationkey") == F.col("c_nationkey"), "left").select("n_nationkey", F.coalesce("member_count", F.lit(0)).alias("member_count"))


@query("select c_nationkey, count(*) n from customer where c_nationkey in (1, 3, 5, 7) group by 1")
def a19_count_in_list(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").where(F.col("c_nationkey").isin(1, 3, 5, 7)).groupBy("c_nationkey").agg(F.count("*").alias("n"))


@query(f"select chat_id from (select distinct chat_id, user_id from {MESSAGES}) group by 1 having count(*) = 2 and sum(case when user_id in ('u1', 'u2') then 1 else 0 end) = 2 union select chat_id from (select distinct id chat_id, user_id from {MESSAGES}) group by 1 having count(*) = 1 and sum(case when user_id in ('u11') then 1 else 0 end) = 1".replace("id chat_id", "'m' || id chat_id"))
def a20_exact_set(spark: SparkSession, d: str) -> DataFrame:
    m = messages(spark, d)
    pair = A.exact_set(m.select("chat_id", "user_id").distinct(), "chat_id", "user_id", ["u1", "u2"])
    return pair.union(A.exact_set(m.select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("chat_id"), "user_id").distinct(), "chat_id", "user_id", ["u11"])).distinct()


@query(f"""select m.chat_id, count(*) message_count, round(coalesce(avg(length(m.content)) filter (m.role = 'user'), 0), 6) average_user_length, round(coalesce(avg(length(m.content)) filter (m.role = 'assistant'), 0), 6) average_assistant_length,
 round(coalesce(avg(m.created_at - p.created_at) filter (m.role = 'assistant' and p.role = 'user'), 0), 6) average_response_time, max(m.created_at) last_message_at, count(*) filter (m.role = 'assistant') answers from {TURNS} m left join {TURNS} p on m.chat_id = p.chat_id and m.parent_id = p.id group by 1""")
def a21_chat_stats(spark: SparkSession, d: str) -> DataFrame:
    found = A.chat_stats(turns(spark, d))
    return found.select(*(F.round(c, 6).alias(c) if c.startswith("average") else c for c in found.columns))


@query("select distinct tag from (select unnest(string_split(lang || ',' || source, ',')) tag from documents) order by 1")
def a23_tag_union(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.explode(F.array("lang", "source")).alias("tag")).distinct().orderBy("tag")


@query("select case when n_chars < 30 then 'short' when lang = 'en' then 'kept' else 'other' end reason, count(*) n from documents group by 1")
def a24_run_counters(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy(F.when(F.col("n_chars") < 30, "short").when(F.col("lang") == "en", "kept").otherwise("other").alias("reason")).agg(F.count("*").alias("n"))


@query("select conv_id, string_agg('[段落' || (turn + 1) || '] ' || left(text, 20), chr(10) order by turn) summary from conversations group by 1")
def a25_group_concat(spark: SparkSession, d: str) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct("turn", F.concat(F.lit("[段落"), (F.col("turn") + 1).cast("string"), F.lit("] "), F.substring("text", 1, 20)).alias("s"))))
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(rows, lambda x: x["s"]), "\n").alias("summary"))


@query("select lang, count(*) n, round(100.0 * count(*) / sum(count(*)) over (), 6) percent from documents group by 1")
def a26_share(spark: SparkSession, d: str) -> DataFrame:
    found = A.share(table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n")))
    return found.withColumn("percent", F.round("percent", 6))


@query("select doc_id, case when n = 0 then -2.0 when n < 20 then 0.0 when u / (n - 1) < 0.3 then -2.0 when u / (n - 1) < 0.5 then -1.0 else 0.0 end::double penalty from (select doc_id, len(t) n, len(list_distinct(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) u from (select doc_id, string_split(text, ' ') t from documents))")
def a27_bigram_penalty(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", A.bigram_penalty(F.split("text", " ", -1)).alias("penalty"))


@query("select event_type, case when value < 0 then 0 when value >= 100 then 11 else floor(value / 10)::bigint + 1 end bucket, count(*) n from events group by 1, 2")
def a28_latency_histogram(spark: SparkSession, d: str) -> DataFrame:
    return A.latency_histogram(table(spark, d, "events"), ["event_type"], "value", 0, 100, 10)


@query("select n_nationkey, coalesce(string_agg(c_custkey::varchar, ',' order by c_custkey), '') grants from nation left join customer on c_nationkey = n_nationkey and c_acctbal > 9000 group by 1")
def a29_grants_by_resource(spark: SparkSession, d: str) -> DataFrame:
    grants = table(spark, d, "customer").where("c_acctbal > 9000").groupBy("c_nationkey").agg(F.array_sort(F.collect_list("c_custkey")).alias("g"))
    return table(spark, d, "nation").join(grants, F.col("n_nationkey") == F.col("c_nationkey"), "left").select("n_nationkey", F.coalesce(F.array_join(F.transform("g", lambda x: x.cast("string")), ","), F.lit("")).alias("grants"))


@query(f"select t.id, count(r.id) reply_count, max(r.created_at) latest_reply_at from {MESSAGES} t left join {MESSAGES} r on r.parent_id = t.id where t.parent_id is null group by 1")
def a30_thread_stats(spark: SparkSession, d: str) -> DataFrame:
    return A.thread_stats(messages(spark, d))


@query("select lang, first(source order by doc_id) source, string_agg(doc_id::varchar, ',' order by doc_id) sources from documents group by 1")
def a31_first_wins(spark: SparkSession, d: str) -> DataFrame:
    found = A.first_wins(table(spark, d, "documents").select("lang", "source", "doc_id"), "lang", "doc_id")
    return found.select("lang", "source", F.array_join(F.transform("sources", lambda x: x.cast("string")), ",").alias("sources"))


@query("select source, doc_id from (select *, row_number() over (partition by source order by doc_id) r from documents) where r = 1")
def a32_first_by_source(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("source").agg(F.min("doc_id").alias("doc_id"))


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 25")
def w01_stable_order(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25).select("o_orderkey", "o_totalprice")


SORTABLE = {"name": "c_name", "balance": "c_acctbal", "segment": "c_mktsegment"}


def sorted_by(df: DataFrame, key: str, descending: bool, last: str) -> DataFrame:
    """Order by a column of the allow list; others raise. Ties by `last`."""
    column = F.col(SORTABLE[key])
    return df.orderBy(column.desc() if descending else column.asc(), last)


@query("select c_custkey, c_acctbal from customer order by c_acctbal desc, c_custkey limit 20")
def w02_sort_whitelist(spark: SparkSession, d: str) -> DataFrame:
    return sorted_by(table(spark, d, "customer"), "balance", True, "c_custkey").limit(20).select("c_custkey", "c_acctbal")


@query("select c_custkey, exists(select 1 from orders where o_custkey = c_custkey and o_totalprice > 300000) flag from customer order by flag desc, c_name limit 40")
def w03_sort_by_exists(spark: SparkSession, d: str) -> DataFrame:
    big = table(spark, d, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("k")).distinct()
    return table(spark, d, "customer").join(big, F.col("c_custkey") == F.col("k"), "left").withColumn("flag", F.col("k").isNotNull()).orderBy(F.desc("flag"), "c_name").limit(40).select("c_custkey", "flag")


@query("select c_custkey, total from (select c_custkey, c_name, count(*) over () total from customer where c_mktsegment = 'BUILDING') order by c_name limit 10 offset 30")
def w04_page_with_total(spark: SparkSession, d: str) -> DataFrame:
    found = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'")
    return found.orderBy("c_name").offset(30).limit(10).crossJoin(F.broadcast(found.agg(F.count("*").alias("total")))).select("c_custkey", "total")


@query(f"select user_id, count(*) n from {MESSAGES} group by 1 order by 2 desc, 1 limit 10")
def w05_top_users(spark: SparkSession, d: str) -> DataFrame:
    return messages(spark, d).groupBy("user_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "user_id").limit(10)


@query(f"select content, max(id) id from {MESSAGES} group by 1 order by 2 desc limit 15")
def w06_heap_top(spark: SparkSession, d: str) -> DataFrame:
    return messages(spark, d).groupBy("content").agg(F.max("id").alias("id")).orderBy(F.desc("id")).limit(15)


@query(f"select chat_id, id from (select *, row_number() over (partition by chat_id order by created_at desc, id desc) r from {MESSAGES}) where r = 1")
def w07_latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    return messages(spark, d).groupBy("chat_id").agg(F.max_by("id", F.struct("created_at", "id")).alias("id"))


@query("select conv_id, left(arg_min(text, turn) filter (role = 'user'), 200) preview, max(turn) last_turn from conversations group by 1")
def w08_first_user_preview(spark: SparkSession, d: str) -> DataFrame:
    first = F.min_by(F.when(F.col("role") == "user", F.col("text")), F.when(F.col("role") == "user", F.col("turn")))
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.substring(first, 1, 200).alias("preview"), F.max("turn").alias("last_turn"))


@query("select conv_id, turn, coalesce(case when sum(length(text)) over p > 1000 then lag(text) over w else string_agg(text, chr(10)) over p end, '') context from conversations window w as (partition by conv_id order by turn), p as (partition by conv_id order by turn rows between unbounded preceding and 1 preceding)")
def w09_prior_segments(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    p = w.rowsBetween(Window.unboundedPreceding, -1)
    context = F.when(F.sum(F.length("text")).over(p) > 1000, F.lag("text").over(w)).otherwise(F.array_join(F.collect_list("text").over(p), "\n"))
    return table(spark, d, "conversations").select("conv_id", "turn", F.coalesce(context, F.lit("")).alias("context"))


@query("select conv_id, turn, lag(text) over (partition by conv_id order by turn) recap, turn = max(turn) over (partition by conv_id) is_last from conversations")
def w10_w11_recap_and_last(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("conv_id")
    return table(spark, d, "conversations").select("conv_id", "turn", F.lag("text").over(w.orderBy("turn")).alias("recap"), (F.col("turn") == F.max("turn").over(w)).alias("is_last"))


@query("select strftime(t, '%Y-%m-%d') slot, coalesce(n, 0) n from generate_series(date '2024-01-01', date '2024-02-10', interval 1 day) s(t) left join (select strftime(ts, '%Y-%m-%d') slot, count(*) n from events group by 1) e on e.slot = strftime(t, '%Y-%m-%d')")
def w12_calendar_fill(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "events").groupBy(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd").alias("slot")).agg(F.count("*").alias("n"))
    return A.calendar(spark, "2024-01-01", "2024-02-10").join(counts, "slot", "left").select("slot", F.coalesce("n", F.lit(0)).alias("n"))


@query("select doc_id, i - 1 as line_no, lines[i] as line from (select doc_id, string_split(text, chr(10)) lines, unnest(range(1, len(string_split(text, chr(10))) + 1)) i from documents) where i <= 2 or i > len(lines) - 2")
def w13_head_tail_lines(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "documents").select("doc_id", F.split("text", "\n", -1).alias("lines"))
    rows = lines.select("doc_id", F.size("lines").alias("n"), F.posexplode("lines").alias("line_no", "line"))
    return rows.where("line_no < 2 or line_no >= n - 2").select("doc_id", F.col("line_no").cast("long").alias("line_no"), "line")


@query("select conv_id, arg_max(text, turn) filter (role = 'user') last_user, string_agg(text, '|' order by turn) filter (turn > m - 2) last_two from (select *, max(turn) over (partition by conv_id) m from conversations) group by 1")
def w14_last_messages(spark: SparkSession, d: str) -> DataFrame:
    all_ = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    users = F.filter(all_, lambda x: x["role"] == "user")
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.try_element_at(F.transform(users, lambda x: x["text"]), F.lit(-1)).alias("last_user"), F.array_join(F.transform(F.slice(all_, -F.least(F.size(all_), F.lit(2)), 2), lambda x: x["text"]), "|").alias("last_two"))


@query("select m.conv_id chat_id, m.turn root, a.turn node, (m.turn - a.turn)::int depth from conversations m join conversations a on a.conv_id = m.conv_id and a.turn <= m.turn")
def w15_ancestors(spark: SparkSession, d: str) -> DataFrame:
    t = turns(spark, d)
    return walk(t.select("chat_id", F.col("id").alias("root")), t.select("chat_id", F.col("id").alias("src"), F.col("parent_id").alias("dst")), ["chat_id"])


@query("""select (r_regionkey + 1000)::bigint root, (r_regionkey + 1000)::bigint node, 0 as depth from region union all select n_regionkey + 1000, n_nationkey, 1 from nation
 union all select n_regionkey + 1000, s_suppkey + 10000, 2 from supplier join nation on n_nationkey = s_nationkey""")
def w16_descendants(spark: SparkSession, d: str) -> DataFrame:
    link = lambda df, src, dst: df.select(F.expr(src).cast("long").alias("src"), F.expr(dst).cast("long").alias("dst"))
    links = link(table(spark, d, "nation"), "n_regionkey + 1000", "n_nationkey").unionByName(link(table(spark, d, "supplier"), "s_nationkey", "s_suppkey + 10000"))
    return walk(table(spark, d, "region").select((F.col("r_regionkey") + 1000).cast("long").alias("root")), links)
