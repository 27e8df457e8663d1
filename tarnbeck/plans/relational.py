"""Predicates, joins and merges over star tables and messages, with oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnbeck.operators import joins as J
from tarnbeck.operators import merge as M
from tarnbeck.operators import predicates as P
from tarnbeck.plans.views import END, FEEDBACK, MESSAGES, START, TURNS, feedback, messages, table, turns

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def tagged(spark: SparkSession, d: str) -> DataFrame:
    """documents with a tag array (empty for every fifth), a pinned flag that may be null, and a title."""
    tags = F.when(F.col("doc_id") % 5 == 0, F.array().cast("array<string>")).otherwise(F.array("lang", "source"))
    return table(spark, d, "documents").select("doc_id", "text", "lang", "source", tags.alias("tags"), F.when(F.col("doc_id") % 3 == 0, True).when(F.col("doc_id") % 3 == 1, False).alias("pinned"), F.substring("text", 1, 30).alias("title"))


TAGGED = "(select doc_id, text, lang, source, case when doc_id % 5 = 0 then [] else [lang, source] end tags, case when doc_id % 3 = 0 then true when doc_id % 3 = 1 then false end pinned, left(text, 30) title from documents)"


def grants(spark: SparkSession, d: str) -> DataFrame:
    """partsupp-like grants on parts: by user, group and to all, read and write."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("k"))
    who = F.when(F.col("k") % 7 == 0, F.lit("*")).when(F.col("k") % 7 < 4, F.concat(F.lit("u"), (F.col("k") % 10).cast("string"))).otherwise(F.concat(F.lit("g"), (F.col("k") % 4).cast("string")))
    return p.where("k % 3 != 0").select(F.lit("part").alias("resource_type"), F.col("k").alias("resource_id"), F.when((F.col("k") % 7 >= 4), "group").otherwise("user").alias("principal_type"), who.alias("principal_id"), F.when(F.col("k") % 5 == 0, "write").otherwise("read").alias("permission"))


GRANTS = "(select 'part' resource_type, p_partkey resource_id, case when p_partkey % 7 >= 4 then 'group' else 'user' end principal_type, case when p_partkey % 7 = 0 then '*' when p_partkey % 7 < 4 then 'u' || (p_partkey % 10) else 'g' || (p_partkey % 4) end principal_id, case when p_partkey % 5 = 0 then 'write' else 'read' end permission from part where p_partkey % 3 <> 0)"


def parts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.concat(F.lit("u"), (F.col("p_partkey") % 12).cast("string")).alias("user_id"))


PARTS = "(select p_partkey id, 'u' || (p_partkey % 12) user_id from part)"
HELD = "((principal_type = 'user' and principal_id in ('*', 'u3')) or (principal_type = 'group' and principal_id in ('g1', 'g2')))"
ME, GROUPS = "u3", ["g1", "g2"]


@query("select c_custkey from customer where c_mktsegment = 'BUILDING' and c_nationkey = 5")
def p01_equality(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").where((F.col("c_mktsegment") == "BUILDING") & (F.col("c_nationkey") == 5)).select("c_custkey")


@query(f"select id from {MESSAGES} where created_at between {START} and {END}")
def p02_inclusive_range(spark: SparkSession, d: str) -> DataFrame:
    from tarnbeck.operators.analytics import in_range

    return messages(spark, d).where(in_range("created_at", START, END)).select("id")


@query(f"select id from {MESSAGES} where created_at > {END}")
def p03_strict_range(spark: SparkSession, d: str) -> DataFrame:
    return messages(spark, d).where(F.col("created_at") > END).select("id")


@query(f"select id from {MESSAGES} where user_id not like 'shared-%'")
def p04_prefix_exclusion(spark: SparkSession, d: str) -> DataFrame:
    return messages(spark, d).where(~F.col("user_id").startswith("shared-")).select("id")


@query("select doc_id from documents where text ilike '%license%' or source ilike '%license%'")
def p05_text_search(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where(P.contains_text("license", "text", "source")).select("doc_id")


@query("select p_partkey from part where regexp_replace(p_name, '[- ]', '', 'g') ilike '%t1%'")
def p06_loose_search(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").where(P.loose_text("t-1", "p_name")).select("p_partkey")


@query("select p_partkey from part where p_name ilike '%\\_1%' escape '\\' or p_name ilike 'p%_1' escape '\\'")
def p07_glob(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").where(P.glob_match("*_1*", "p_name") | P.glob_match("P*?1", "p_name")).select("p_partkey")


@query("select c_custkey from customer where c_mktsegment in ('BUILDING', 'MACHINERY') and c_mktsegment not in ('MACHINERY')")
def p08_roles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").where(P.roles(["BUILDING", "MACHINERY", "!MACHINERY"], "c_mktsegment")).select("c_custkey")


@query(f"select doc_id from {TAGGED} where pinned is null or pinned = false")
def p09_tristate(spark: SparkSession, d: str) -> DataFrame:
    return tagged(spark, d).where(~F.coalesce("pinned", F.lit(False))).select("doc_id")


@query("select event_id from events where json_extract_string(props, '$.k') = '7'")
def p10_json_path(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").where(F.get_json_object("props", "$.k") == "7").select("event_id")


@query(f"select doc_id, 'tags' found from {TAGGED} where list_contains(tags, 'en') and list_contains(tags, 'src1') union all select doc_id, 'none' from {TAGGED} where len(tags) = 0")
def p11_json_tags(spark: SparkSession, d: str) -> DataFrame:
    t = tagged(spark, d)
    return t.where(P.has_tags(["en", "src1"], "tags")).select("doc_id", F.lit("tags").alias("found")).unionByName(t.where(P.has_tags(["none"], "tags")).select("doc_id", F.lit("none").alias("found")))


@query("select conv_id from conversations group by 1 having bool_or(contains(lower(text), 'thing')) or 'c' || conv_id ilike '%77%'")
def p12_any_message(spark: SparkSession, d: str) -> DataFrame:
    chats = table(spark, d, "conversations").groupBy("conv_id").agg(F.collect_list(F.struct(F.col("text").alias("content"))).alias("messages")).withColumn("title", F.concat(F.lit("c"), F.col("conv_id").cast("string")))
    return chats.where(P.any_message("thing", "messages", "title") | F.col("title").ilike("%77%")).select("conv_id")


@query(f"select doc_id from {TAGGED} where list_contains(list_transform(tags, lambda x: lower(x)), 'de')")
def p13_quoted_tag(spark: SparkSession, d: str) -> DataFrame:
    return tagged(spark, d).where(F.array_contains(F.transform("tags", F.lower), "de")).select("doc_id")


@query(f"select doc_id from {TAGGED} where title ilike '%the%' and list_contains(tags, 'en') and coalesce(pinned, false) = true")
def p14_search_language(spark: SparkSession, d: str) -> DataFrame:
    search = P.parse_search("the tag:en pinned:true")
    return tagged(spark, d).where(P.compile_search(search, "title", "tags", "source", "pinned", "pinned", "lang")).select("doc_id")


@query("select count(*) n from documents where not contains(text, chr(0))")
def p15_null_bytes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where(~F.col("text").contains("\x00")).agg(F.count("*").alias("n"))


@query("select vec_id from embeddings where label::varchar = '3'")
def p16_metadata_equality(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").where(P.metadata_filter({"label": 3}, lambda k: F.col(k).cast("string"))).select("vec_id")


@query("select vec_id from embeddings where label in (1, 2) or (vec_id % 2 = 0 and label = 5)")
def p17_nested_filter(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").withColumn("even", F.col("vec_id") % 2)
    return e.where(P.metadata_filter({"$or": [{"label": {"$in": [1, 2]}}, {"$and": [{"even": 0}, {"label": 5}]}, {"label": {"$in": []}}]}, lambda k: F.col(k).cast("string"))).select("vec_id")


@query("select vec_id from embeddings where label <> 3 and label not in (4, 5) and label is not null")
def p18_more_operators(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").where(P.metadata_filter({"label": {"$ne": 3, "$nin": [4, 5], "$exists": True}}, lambda k: F.col(k).cast("string"))).select("vec_id")


_HOST = "lower(regexp_extract(url, '^https?://([^/:?#]+)', 1))"


@query(f"select page_id from pages where ({_HOST} = 'example.com' or {_HOST} like '%.example.com' or {_HOST} like '%.example.org') and not ({_HOST} = 'm.example.com' or {_HOST} like '%.m.example.com') and not {_HOST} like 'm.%.example.org'")
def p19_domain_rules(spark: SparkSession, d: str) -> DataFrame:
    host = F.lower(F.regexp_extract("url", "^https?://([^/:?#]+)", 1))
    return table(spark, d, "pages").where(P.host_allowed(["example.com", "example.org", "!m.example.com"], host) & ~((host.startswith("m.")) & host.endswith(".example.org"))).select("page_id")


@query(f"select page_id from pages where regexp_matches(url, '^https?://') and not ({_HOST} = 'example.net' or {_HOST} like '%.example.net')")
def p20_url_rules(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").where(P.url_allowed(["!example.net"], "url")).select("page_id")


@query("select doc_id, lang from documents")
def p23_pruned_columns(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "lang")


@query("select c_custkey from customer where c_name = 'Customer#000000007' union all (select c_custkey from customer order by 1 limit 5 offset 0)")
def p24_scim(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").withColumn("email", F.col("c_name"))
    skip, limit = P.scim_page(0, 5)
    return c.where(P.scim_filter('userName eq "Customer#000000007"')).select("c_custkey").unionAll(c.select("c_custkey").orderBy("c_custkey").offset(skip).limit(limit))


@query(f"select user_id, max(created_at) >= 1706700000 - 180 now_active, max(created_at) > 1706700000 // 86400 * 86400 today from {MESSAGES} group by 1")
def p25_active(spark: SparkSession, d: str) -> DataFrame:
    last = messages(spark, d).groupBy("user_id").agg(F.max("created_at").alias("last"))
    return last.select("user_id", P.active_now("last", 1706700000).alias("now_active"), P.active_today("last", 1706700000).alias("today"))


@query(f"select count(*) n from {MESSAGES} where parent_id is null and created_at > {START - 300000} and user_id <> 'u7'")
def p26_unread(spark: SparkSession, d: str) -> DataFrame:
    return messages(spark, d).where(P.unread(START - 300000, "u7")).agg(F.count("*").alias("n"))


@query("select doc_id from documents where len(string_split(text, ' ')) > 0 and trim(text) <> ''")
def p27_samples(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").withColumn("prompt", F.split("text", " ", -1)).where(P.not_empty_sample("prompt", "text")).select("doc_id")


@query("select p_partkey, lower(trim(regexp_replace(p_name || '_ X', '[\\s_]+', ' ', 'g'))) folder from part")
def p28_folder_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", P.folder_key(F.concat("p_name", F.lit("_ X"))).alias("folder"))


@query(f"select f.id, lang, rating from {FEEDBACK} f join documents d on f.chat_id = d.doc_id order by rating, f.id limit 40")
def j01_inner_page(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return feedback(spark, d).join(docs, F.col("chat_id") == F.col("doc_id")).orderBy("rating", "id").limit(40).select("id", "lang", "rating")


@query("select c_custkey, n_name from customer left join nation on c_nationkey = n_nationkey and n_regionkey = 1")
def j02_owner(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").where("n_regionkey = 1")
    return table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "n_name")


@query("select l_orderkey, l_linenumber, s_name, o_custkey, c_name from lineitem join orders on l_orderkey = o_orderkey join supplier on l_suppkey = s_suppkey left join customer on o_custkey = c_custkey and c_acctbal > 5000 where l_quantity > 45")
def j03_star(spark: SparkSession, d: str) -> DataFrame:
    rich = table(spark, d, "customer").where("c_acctbal > 5000")
    li = table(spark, d, "lineitem").where("l_quantity > 45")
    return li.join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(rich, F.col("o_custkey") == F.col("c_custkey"), "left").select("l_orderkey", "l_linenumber", "s_name", "o_custkey", "c_name")


@query("select distinct l_orderkey, s_name from lineitem join supplier on l_suppkey = s_suppkey where s_nationkey = 3")
def j04_bridge(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").join(table(spark, d, "supplier").where("s_nationkey = 3"), F.col("l_suppkey") == F.col("s_suppkey")).select("l_orderkey", "s_name").distinct()


@query("select c_custkey from customer where exists(select 1 from orders where o_custkey = c_custkey and o_totalprice > 200000)")
def j05_exists(spark: SparkSession, d: str) -> DataFrame:
    big = table(spark, d, "orders").where("o_totalprice > 200000")
    return table(spark, d, "customer").join(big, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query(f"select id from {MESSAGES} where user_id in (select user_id from {MESSAGES} group by 1 having count(*) > 70)")
def j06_in_subquery(spark: SparkSession, d: str) -> DataFrame:
    m = messages(spark, d)
    return m.join(m.groupBy("user_id").agg(F.count("*").alias("n")).where("n > 70"), "user_id", "left_semi").select("id")


@query(f"select id from {PARTS} p where user_id = 'u3' or exists(select 1 from {GRANTS} g where resource_id = p.id and permission = 'read' and {HELD})")
def j07_access(spark: SparkSession, d: str) -> DataFrame:
    return J.readable(parts(spark, d), grants(spark, d), "part", ME, GROUPS).select("id")


@query(f"select id from {PARTS} p where user_id <> 'u3' and exists(select 1 from {GRANTS} g where resource_id = p.id and permission = 'read' and {HELD}) and not exists(select 1 from {GRANTS} g where resource_id = p.id and permission = 'write' and {HELD}) and not exists(select 1 from {GRANTS} g where resource_id = p.id and principal_id = '*')")
def j08_read_only(spark: SparkSession, d: str) -> DataFrame:
    return J.read_only(parts(spark, d), grants(spark, d), "part", ME, GROUPS).select("id")


@query(f"select distinct id from {PARTS} where id in (select resource_id from {GRANTS} where permission = 'write' and {HELD})")
def j09_batch_access(spark: SparkSession, d: str) -> DataFrame:
    return J.accessible(parts(spark, d), grants(spark, d), "part", "write", ME, GROUPS)


_FILES = "(select text, doc_id from documents where doc_id % 4 <> 0)"


@query(f"select d.doc_id, case when f.ok then null when f.ok = false then 'too short' else 'not in root' end reason from documents d left join (select sha1(text) fp, bool_or(length(text) >= 300) ok from {_FILES} group by 1) f on sha1(d.text) = f.fp")
def j10_reconcile(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return J.reconcile_rows(docs.withColumn("source_text", F.col("text")), docs.where("doc_id % 4 != 0"), 300).select("doc_id", "reason")


@query("select sha1(doc_id::varchar) fid from documents where doc_id % 3 <> 0 order by 1 limit 100")
def j11_pending(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "documents").select(F.sha1(F.encode(F.col("doc_id").cast("string"), "UTF-8")).alias("fid"), "doc_id")
    state = ids.where("doc_id % 3 != 2").select("fid", F.when(F.col("doc_id") % 3 == 0, "done").otherwise("failed").alias("state"))
    return J.pending(ids.select("fid"), state, 100)


@query("select coalesce(s.id, f.id) fid, s.was, case when f.id is null then 'orphan ' || s.was when k.id is not null then 'ok' when not f.ok then 'skip' when s.was = 'done' then 'missing' else 'pending' end as action from (select doc_id id, case when doc_id % 2 = 0 then 'done' else 'failed' end was from documents where doc_id % 5 <> 0) s full join (select doc_id id, n_chars >= 400 ok from documents where doc_id % 7 <> 0) f on s.id = f.id left join (select doc_id id from documents where doc_id % 3 = 0) k on k.id = f.id")
def j12_merge_state(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").withColumnRenamed("doc_id", "fid")
    state = docs.where("fid % 5 != 0").select("fid", F.when(F.col("fid") % 2 == 0, "done").otherwise("failed").alias("state"))
    return J.merge_state(state, docs.where("fid % 7 != 0").select("fid", (F.col("n_chars") >= 400).alias("ok")), docs.where("fid % 3 = 0").select("fid"))


@query("select o_orderkey, exists(select 1 from lineitem where l_orderkey = o_orderkey and l_quantity > 49) held from orders")
def j13_consistency(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey")
    there, lost = J.indexed(o, table(spark, d, "lineitem").where("l_quantity > 49").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")
    return there.withColumn("held", F.lit(True)).unionByName(lost.withColumn("held", F.lit(False)))


@query("select url from pages where sha1(url) = sha1((select min(url) from pages)) order by url limit 1")
def j14_by_hash(spark: SparkSession, d: str) -> DataFrame:
    import hashlib

    pages = table(spark, d, "pages")
    first = pages.agg(F.min("url")).first()[0]
    return J.by_hash(pages.select("url"), "url", hashlib.sha1(first.encode()).hexdigest())


@query(f"select a.chat_id, a.id, a.created_at - q.created_at wait from {TURNS} a join {TURNS} q on a.chat_id = q.chat_id and a.parent_id = q.id where a.role = 'assistant'")
def j15_response_time(spark: SparkSession, d: str) -> DataFrame:
    t = turns(spark, d)
    q = t.select(F.col("chat_id").alias("c"), F.col("id").alias("q"), F.col("created_at").alias("asked"))
    return t.where("role = 'assistant'").join(q, (F.col("chat_id") == F.col("c")) & (F.col("parent_id") == F.col("q"))).select("chat_id", "id", (F.col("created_at") - F.col("asked")).alias("wait"))


@query("select n_nationkey, coalesce(n, 0) n, coalesce(total, 0) total from nation left join (select c_nationkey, count(*) n, round(sum(c_acctbal), 2) total from customer where c_acctbal > 9500 group by 1) on c_nationkey = n_nationkey")
def j17_enrich(spark: SparkSession, d: str) -> DataFrame:
    facts = table(spark, d, "customer").where("c_acctbal > 9500").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"))
    return J.enrich(table(spark, d, "nation").select("n_nationkey"), facts, "n_nationkey", {"n": 0, "total": 0.0})


@query("select o_custkey % 50 message_id, o_orderpriority \"name\", count(*) n, string_agg(c_name, ',' order by c_custkey, c_name) users from orders join customer on o_custkey = c_custkey group by 1, 2")
def j18_reactions(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select((F.col("o_custkey") % 50).alias("message_id"), F.col("o_orderpriority").alias("name"), F.col("o_custkey").alias("user_id"))
    return J.reactions(rows, table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")))


@query("select o_orderkey, l_partkey from orders join lineitem on o_orderkey = l_orderkey where o_orderpriority is not null and l_partkey = 7")
def j20_shared_files(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").where("o_orderpriority IS NOT NULL").join(table(spark, d, "lineitem").where("l_partkey = 7"), F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "l_partkey")


_USERS = "(select 'u' || i id, case when i % 4 = 0 then 'pending' else 'user' end \"role\" from range(12) r(i))"
_MEMBERS = "(select 'g' || (i % 4) group_id, 'u' || i user_id from range(12) r(i))"


@query(f"select distinct resource_id, id user_id from {GRANTS} g, {_USERS} u where (principal_id = '*' and role <> 'pending') or (principal_type = 'user' and principal_id = u.id) or (principal_type = 'group' and exists(select 1 from {_MEMBERS} m where m.group_id = g.principal_id and m.user_id = u.id))")
def j21_users_with_access(spark: SparkSession, d: str) -> DataFrame:
    u = spark.range(12).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("id"), F.when(F.col("id") % 4 == 0, "pending").otherwise("user").alias("role"))
    m = spark.range(12).select(F.concat(F.lit("g"), (F.col("id") % 4).cast("string")).alias("group_id"), F.concat(F.lit("u"), F.col("id").cast("string")).alias("user_id"))
    return J.users_with(grants(spark, d), m, u)


_CHANNELS = "(select p_partkey id, 'u' || (p_partkey % 12) user_id, case p_partkey % 4 when 0 then 'group' when 1 then 'dm' when 2 then 'standard' end type from part)"


@query(f"select id from {_CHANNELS} c where (type in ('group', 'dm') and id % 5 = 0) or ((type is null or type not in ('group', 'dm')) and (user_id = 'u3' or exists(select 1 from (select * replace ('channel' as resource_type) from {GRANTS}) where resource_id = c.id and permission = 'read' and {HELD})))")
def j22_channels(spark: SparkSession, d: str) -> DataFrame:
    kind = F.element_at(F.array(F.lit("group"), F.lit("dm"), F.lit("standard"), F.lit(None)), (F.col("id") % 4 + 1).cast("int"))
    channels = parts(spark, d).withColumn("type", kind)
    members = channels.where("id % 5 = 0").select(F.col("id").alias("channel_id"), F.lit(ME).alias("user_id"), F.lit(True).alias("is_active"))
    return J.channels_of(channels, members, grants(spark, d).withColumn("resource_type", F.lit("channel")), ME, GROUPS).select("id")


@query("select o_orderkey, case when o_orderkey % 3 = 0 then coalesce(n_name, 'Deleted Webhook') else c_name end author from orders left join nation on o_orderkey % 3 = 0 and n_nationkey = o_orderkey % 40 left join customer on c_custkey = o_custkey")
def j23_authors(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey") % 40).alias("webhook_id"), F.col("o_custkey").alias("user_id"))
    return J.authors(m, table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")), table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))).select("o_orderkey", "author")


@query("select l_orderkey, concat_ws('-', l_linenumber, l_partkey, l_quantity) call_id, l_partkey as call, case when l_linenumber % 2 = 0 then l_suppkey end as output from lineitem")
def j24_calls(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    item = lambda kind, value: F.struct(F.lit(kind).alias("type"), F.concat_ws("-", F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), F.col("l_quantity").cast("string")).alias("call_id"), F.col(value).alias("value"))
    items = li.groupBy("l_orderkey").agg(F.concat(F.collect_list(item("function_call", "l_partkey")), F.collect_list(F.when(F.col("l_linenumber") % 2 == 0, item("function_call_output", "l_suppkey")))).alias("items"))
    return items.select("l_orderkey", F.explode(J.pair_calls(F.col("items"))).alias("x")).select("l_orderkey", "x.call_id", "x.call", "x.output")


@query("select s_suppkey id from supplier union all select c_custkey from customer")
def m01_union(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("id")).unionByName(table(spark, d, "customer").select(F.col("c_custkey").alias("id")))


@query("select distinct c_custkey from customer where c_custkey not in (select o_custkey from orders)")
def m02_difference(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey").subtract(table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")))


@query("select coalesce(a.id, b.id) id, coalesce(b.name, a.name) \"name\", a.seg from (select c_custkey id, c_name \"name\", c_mktsegment seg from customer) a full join (select s_suppkey * 20 id, upper(s_name) \"name\" from supplier) b on a.id = b.id")
def m03_upsert(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    base = c.select(F.col("c_custkey").cast("long").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("seg"))
    return M.upsert(base, table(spark, d, "supplier").select((F.col("s_suppkey") * 20).cast("long").alias("id"), F.upper("s_name").alias("name")), ["id"])


@query("select s_suppkey id, 'old' origin from supplier union all select id, 'new' from (select distinct c_custkey id from customer) where id not in (select s_suppkey from supplier)")
def m04_insert_absent(spark: SparkSession, d: str) -> DataFrame:
    base = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.lit("old").alias("origin"))
    return M.insert_absent(base, table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.lit("new").alias("origin")), ["id"])


@query("select coalesce(a.k, b.k) k, case when a.k is null then 'insert' when b.k is null then 'delete' when a.v <> b.v then 'update' else 'keep' end as action from (select c_custkey k, c_nationkey v from customer) a full join (select s_suppkey * 3 k, s_nationkey v from supplier) b on a.k = b.k")
def m05_sync(spark: SparkSession, d: str) -> DataFrame:
    base = table(spark, d, "customer").select(F.col("c_custkey").cast("long").alias("k"), F.col("c_nationkey").cast("long").alias("v"))
    return M.sync(base, table(spark, d, "supplier").select((F.col("s_suppkey") * 3).cast("long").alias("k"), F.col("s_nationkey").cast("long").alias("v")), "k", ["v"])


@query("select lang || '-' || source tag from documents group by 1 having count(*) <= 1")
def m06_orphan_tags(spark: SparkSession, d: str) -> DataFrame:
    used = table(spark, d, "documents").select(F.concat_ws("-", "lang", "source").alias("tag"))
    return M.orphan_tags(used.distinct(), used, 1)


@query("select o_orderkey, case when o_orderstatus = 'O' then 'archived' else o_orderstatus end status from orders")
def m07_bulk_update(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "O", "archived").otherwise(F.col("o_orderstatus")).alias("status"))


@query("select conv_id::varchar chat_id, turn::varchar id, \"role\", text \"content\", case when turn % 3 = 0 then 1800000000 else 1700000000 + turn end::bigint created_at from conversations")
def m08_backfill(spark: SparkSession, d: str) -> DataFrame:
    t = F.when(F.col("turn") % 3 == 0, F.lit(12)).when(F.col("turn") % 3 == 1, (F.lit(1700000000) + F.col("turn")) * 1000 + 999).otherwise(F.lit(1700000000) + F.col("turn"))
    entry = F.struct(F.col("turn").cast("string").alias("key"), F.struct("role", F.col("text").alias("content"), t.alias("timestamp")).alias("value"))
    chats = table(spark, d, "conversations").groupBy(F.col("conv_id").cast("string").alias("chat_id")).agg(F.map_from_entries(F.collect_list(entry)).alias("messages"))
    return M.backfill(chats, 1800000000)


@query("select source user_id, string_agg(distinct lower(replace(lang || ' X', ' ', '_')), ',' order by lower(replace(lang || ' X', ' ', '_'))) filter (doc_id % 9 <> 0) tags, bool_or(doc_id % 9 = 0) pinned from documents group by 1")
def m09_merge_tags(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(F.col("source").alias("user_id"), F.when(F.col("doc_id") % 9 == 0, "Pinned").otherwise(F.concat("lang", F.lit(" X"))).alias("name"))
    return M.merge_tags(rows).select("user_id", F.nullif(F.array_join("tags", ","), F.lit("")).alias("tags"), "pinned")


@query("select doc_id, score from (select doc_id, n_chars % 97 score, row_number() over (partition by sha256(text) order by n_chars % 97 desc, doc_id) r from documents) where r = 1 order by score desc, doc_id limit 60")
def m10_best_by_content(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", "text", (F.col("n_chars") % 97).alias("score"))
    return M.best_by_content(rows, "text", "score", "doc_id", 60).select("doc_id", "score")


@query("select o_custkey, o_orderpriority, max(o_orderkey) o_orderkey from orders group by 1, 2")
def m11_last_wins(spark: SparkSession, d: str) -> DataFrame:
    return M.latest(table(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_orderkey"), ["o_custkey", "o_orderpriority"], "o_orderkey")


@query("select doc_id from documents where sha256(text) in (select sha256(text) from documents group by 1 having count(distinct doc_id) > 1)")
def m12_duplicate_guard(spark: SparkSession, d: str) -> DataFrame:
    return M.duplicates_elsewhere(table(spark, d, "documents").select("doc_id", "text"), "text", "doc_id").select("doc_id")


@query("select resource_id, principal_type, principal_id, permission, 'note' resource_type from (select c_custkey resource_id, 'user' principal_type, 'u' || c_nationkey principal_id, 'read' permission from customer where c_custkey % 3 = 0 union all select c_custkey, 'group', 'g' || (c_nationkey % 5), 'write' from customer where c_custkey % 3 = 0 union all select c_custkey, 'user', '*', 'read' from customer where c_custkey % 3 = 1)")
def m14_old_access(spark: SparkSession, d: str) -> DataFrame:
    ids = lambda kind, c: F.array(F.concat(F.lit(kind), c.cast("string")))
    none = F.array().cast("array<string>")
    side = lambda u, g: F.struct(u.alias("user_ids"), g.alias("group_ids"))
    full = F.struct(side(ids("u", F.col("c_nationkey")), none).alias("read"), side(none, ids("g", F.col("c_nationkey") % 5)).alias("write"))
    empty = F.struct(side(none, none).alias("read"), side(none, none).alias("write"))
    access = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 3 == 0, full).when(F.col("c_custkey") % 3 == 2, empty).alias("access"))
    return M.grants_of(access, "note")


@query()
def m15_seeded_pick(spark: SparkSession, d: str) -> DataFrame:
    return M.pick_one(table(spark, d, "part").select("p_partkey"), "p_partkey", [1, 2, 3], 42)
