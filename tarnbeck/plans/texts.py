"""Text, date and JSON functions over documents, conversations and pages, with oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnbeck.functions import dates as D
from tarnbeck.functions import text as T
from tarnbeck.plans.views import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


def dressed(spark: SparkSession, d: str) -> DataFrame:
    """documents inside tags, twice, with quotes and headings."""
    return docs(spark, d).select("doc_id", "lang", F.concat(F.lit("<Summary>first</Summary> x <summary>\n "), F.substring("text", 1, 40), F.lit(" </summary>")).alias("reply"), F.concat(F.lit("> **综述**\n>\n> "), "lang", F.lit("\n> more\n\n## 第1段：a\n"), "source", F.lit("\n\n> **前文提要**\n>\n> r\n\n## 第2段：b\nend "), "lang").alias("assistant"))


_ASSISTANT = "'> **综述**' || chr(10) || '>' || chr(10) || '> ' || lang || chr(10) || '> more'"


@query(r"select doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '[^\S\n]+\n', chr(10), 'g'), '\n{6,}', chr(10) || chr(10) || chr(10), 'g'), '^\s+', ''), '\s+$', '') cleaned from (select doc_id, '  ' || text || '  ' || chr(13) || chr(10) || repeat(chr(10), doc_id % 9) || 'z ' text from documents)")
def ft01_clean(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit("  "), "text", F.lit("  \r\n"), F.repeat(F.lit("\n"), (F.col("doc_id") % 9).cast("int")), F.lit("z "))
    return docs(spark, d).select("doc_id", T.clean(raw).alias("cleaned"))


@query("select doc_id, case doc_id % 4 when 0 then 'utf-8-sig' when 1 then 'utf-32' when 2 then 'utf-16' end bom from documents")
def ft02_bom(spark: SparkSession, d: str) -> DataFrame:
    head = F.element_at(F.array(F.unhex(F.lit("EFBBBF41")), F.unhex(F.lit("FFFE0000")), F.unhex(F.lit("FFFE4100")), F.unhex(F.lit("41424344"))), (F.col("doc_id") % 4 + 1).cast("int"))
    return docs(spark, d).select("doc_id", T.bom_encoding(head).alias("bom"))


@query("select doc_id, '甲，乙。3.14！' || lang || '，中（x)' marked from documents")
def ft04_chinese_marks(spark: SparkSession, d: str) -> DataFrame:
    return docs(spark, d).select("doc_id", T.chinese_marks(F.concat(F.lit("甲,乙.3.14！"), "lang", F.lit(",中(x)"))).alias("marked"))


@query("select doc_id, lang || chr(10) || 'body' stripped from documents")
def ft05_meta_lines(spark: SparkSession, d: str) -> DataFrame:
    return docs(spark, d).select("doc_id", T.without_meta_lines(F.concat(F.lit("作者：某\nhttps://x.y/z\n"), "lang", F.lit("\nbody\n来源: w"))).alias("stripped"))


@query("select doc_id, '## 第十二章 ' || lang || chr(10) || 'text' || chr(10) || '## 楔子' headed from documents")
def ft06_headings(spark: SparkSession, d: str) -> DataFrame:
    return docs(spark, d).select("doc_id", T.headings(F.concat(F.lit("第十二章 "), "lang", F.lit("\ntext\n 楔子"))).alias("headed"))


@query(r"select doc_id, regexp_replace(left(trim(regexp_replace(text, '\s+', ' ', 'g')), 30), '\s+$', '') title from documents where not regexp_matches(text, '^[#* \-—–·:：\s]')")
def ft09_chunk_title(spark: SparkSession, d: str) -> DataFrame:
    return docs(spark, d).where(~F.col("text").rlike(r"^[#* \-—–·:：\s]")).select("doc_id", T.chunk_title(F.col("text")).alias("title"))


@query(r"select doc_id, regexp_replace(regexp_replace(left(text, 40), '^\s+', ''), '\s+$', '') summary, 1 = 1 valid from documents")
def ft11_last_tag(spark: SparkSession, d: str) -> DataFrame:
    r = dressed(spark, d)
    return r.select("doc_id", T.last_tag(F.col("reply"), "summary").alias("summary"), T.parse_reply(F.col("reply"), ["summary"], may_be_empty=["summary"])["valid"].alias("valid"))


@query(f"select doc_id, lang || chr(10) || 'more' body, {_ASSISTANT} quoted from documents")
def ft17_quotes(spark: SparkSession, d: str) -> DataFrame:
    r = dressed(spark, d)
    return r.select("doc_id", T.quote_body(F.col("assistant"), "综述").alias("body"), T.quote("综述", F.concat("lang", F.lit("\nmore"))).alias("quoted"))


@query("select doc_id, source || '|end ' || lang || '|' bodies from documents")
def ft19_segments(spark: SparkSession, d: str) -> DataFrame:
    return dressed(spark, d).select("doc_id", F.array_join(T.fit_bodies(T.segment_bodies(F.col("assistant")), F.lit(3)), "|").alias("bodies"))


@query("select n_nationkey n, case when n_nationkey * 5 <= 0 or n_nationkey * 5 >= 100 then '第' || (n_nationkey * 5) when n_nationkey * 5 < 10 then '第' || '一二三四五六七八九'[(n_nationkey * 5)::int] when n_nationkey * 5 < 20 then '第十' || case when n_nationkey * 5 % 10 = 0 then '' else '一二三四五六七八九'[(n_nationkey * 5 % 10)::int] end else '第' || '一二三四五六七八九'[(n_nationkey * 5 // 10)::int] || '十' || case when n_nationkey * 5 % 10 = 0 then '' else '一二三四五六七八九'[(n_nationkey * 5 % 10)::int] end end ordinal from nation")
def ft24_ordinals(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select(F.col("n_nationkey").alias("n"), T.ordinal(F.col("n_nationkey") * 5).alias("ordinal"))


@query(r"""select page_id, left(trim(regexp_replace(url, '[\\/:*?"<>|]', '_', 'g')), 100) "file", regexp_replace(regexp_replace(lower(url || ' A b'), '[^\w\s]', '', 'g'), '\s+', '-', 'g') slug from pages""")
def ft25_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", T.file_name(F.col("url")).alias("file"), T.slug(F.concat("url", F.lit(" A b"))).alias("slug"))


@query("select doc_id, regexp_extract(source || '-block' || doc_id, '^(.*)-block\\d+$', 1) title, replace(text, chr(0), '') plain from documents")
def ft27_block_title(spark: SparkSession, d: str) -> DataFrame:
    return docs(spark, d).select("doc_id", T.block_title(F.concat("source", F.lit("-block"), F.col("doc_id").cast("string"))).alias("title"), T.for_database(F.col("text")).alias("plain"))


@query("select doc_id, case when length(text) <= 101 then text else left(text, 50) || '...' || right(text, 51) end truncated, case when length(text) <= 101 then text else left(text, 51) || '...' || right(text, 50) end middle, left(text, 7) || '|' || right(text, 5) || '|' || lang filled from documents")
def ft29_truncation(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return docs(spark, d).select("doc_id", T.truncate(t, 101).alias("truncated"), T.middle(t, 101).alias("middle"), F.concat(T.fill_prompt("{{prompt:start:7}}|{{PROMPT:END:5}}|", t), F.col("lang")).alias("filled"))


@query("select doc_id, 'Use ' || source || ' {{QUERY}} for ' || lang || '.' filled from documents")
def ft31_template(spark: SparkSession, d: str) -> DataFrame:
    return docs(spark, d).select("doc_id", T.fill_rag("Use {{CONTEXT}} for [query].", F.concat("source", F.lit(" {{QUERY}}")), F.col("lang")).alias("filled"))


@query("select doc_id, case when hit > 0 then (case when hit - 1 > 50 then '...' else '' end) || substring(text, greatest(hit - 1 - 50, 0) + 1, least(length(text), hit - 1 + 5 + 100) - greatest(hit - 1 - 50, 0)) || (case when least(length(text), hit - 1 + 5 + 100) < length(text) then '...' else '' end) else left(text, 150) || (case when length(text) > 150 then '...' else '' end) end snippet from (select *, instr(lower(text), 'thing') hit from documents) where lang = 'en'")
def ft32_snippet(spark: SparkSession, d: str) -> DataFrame:
    return docs(spark, d).where("lang = 'en'").select("doc_id", T.snippet(F.col("text"), "Thing").alias("snippet"))


def chats(spark: SparkSession, d: str) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    return table(spark, d, "conversations").groupBy("conv_id").agg(ordered.alias("messages"))


@query("select conv_id, string_agg(upper(\"role\") || ': ' || text, chr(10) order by turn) transcript from conversations group by 1")
def ft33_transcript(spark: SparkSession, d: str) -> DataFrame:
    return chats(spark, d).select("conv_id", T.transcript(F.col("messages")).alias("transcript"))


@query("select doc_id, lang || chr(10) || '[image]' || chr(10) || '{\"k\":' || doc_id || '}' content from documents")
def ft34_blocks(spark: SparkSession, d: str) -> DataFrame:
    block = lambda kind, text, other: F.struct(F.lit(kind).alias("type"), text.alias("text"), other.alias("other"))
    none = F.lit(None).cast("string")
    return docs(spark, d).select("doc_id", T.block_text(F.array(block("text", F.col("lang"), none), block("image_url", none, none), block("x", none, F.format_string('{"k":%d}', "doc_id")))).alias("content"))


@query("select page_id, replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') escaped from pages")
def ft35_xml_escape(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", T.xml_escape(F.col("html")).alias("escaped"))


@query("select doc_id, case when doc_id % 2 = 0 then lang || '</think>z' else right(lang || repeat('x', 3001), 3000) end answer from documents")
def ft39_thought(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("a</think>\n"), "lang", F.lit("</think>z"))).otherwise(F.concat("lang", F.repeat(F.lit("x"), F.lit(3001))))
    return docs(spark, d).select("doc_id", T.without_thought(text).alias("answer"))


@query("select doc_id, lang || 'b' plain, source code from documents")
def ft40_ansi_and_fences(spark: SparkSession, d: str) -> DataFrame:
    return docs(spark, d).select("doc_id", T.without_ansi(F.concat(F.lit("\x1b[31m"), "lang", F.lit("\x1b[0mb"))).alias("plain"), T.without_fence(F.concat(F.lit("```python\n"), "source", F.lit("\n```"))).alias("code"))


@query(r"select page_id, array_to_string(regexp_extract_all(url || ' and ' || url || '/x y', 'https?://\S+'), ' ') urls from pages")
def ft41_urls(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.array_join(T.urls(F.concat("url", F.lit(" and "), "url", F.lit("/x y"))), " ").alias("urls"))


@query(r"select doc_id, regexp_matches(text, '^[^@]+@[^@]+\.[^@]+') email from documents")
def ft42_email(spark: SparkSession, d: str) -> DataFrame:
    return docs(spark, d).select("doc_id", T.is_email(F.col("text")).alias("email"))


@query("select doc_id, lang title, source author from documents")
def ft43_frontmatter(spark: SparkSession, d: str) -> DataFrame:
    m = T.frontmatter(F.concat(F.lit('"""\nTitle: old\ntitle: '), "lang", F.lit("\nauthor:  "), "source", F.lit(' \n"""\nbody: no')))
    return docs(spark, d).select("doc_id", m.getItem("title").alias("title"), m.getItem("author").alias("author"))


@query("select p_partkey, lower(replace(p_name, ' ', '_')) tag, 'a,a/' || p_partkey folders from part")
def ft44_ft45_tags(spark: SparkSession, d: str) -> DataFrame:
    path = F.concat(F.lit("/srv/data/docs/a/"), F.col("p_partkey").cast("string"), F.lit("/f.txt"))
    return table(spark, d, "part").select("p_partkey", T.tag_id(F.col("p_name")).alias("tag"), F.array_join(T.folder_tags(path, "data/docs"), ",").alias("folders"))


@query("select doc_id, lang || ' Filename: a_b.txt a b txt a b txt' || case when source = 'src1' then '' else ' Title: ' || source end || ' Section: H > I' enriched from documents")
def ft46_enriched(spark: SparkSession, d: str) -> DataFrame:
    title = F.when(F.col("source") != "src1", F.col("source"))
    return docs(spark, d).select("doc_id", T.enriched(F.col("lang"), F.lit("a_b.txt"), title, F.array(F.lit("H"), F.lit("I")), F.lit(""), F.lit(None).cast("string")).alias("enriched"))


@query("select doc_id, 'lang=' || lang kept from documents")
def ft47_metadata(spark: SparkSession, d: str) -> DataFrame:
    m = T.clean_metadata(F.create_map(F.lit("content"), F.lit("x"), F.lit("lang"), F.col("lang"), F.lit("tables"), F.lit("y")))
    return docs(spark, d).select("doc_id", F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("kept"))


@query(r"select conv_id, string_agg(t, chr(10) order by turn desc) query from (select conv_id, turn, regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', '') t from conversations where role = 'user') where t <> '' group by 1")
def ft48_user_query(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").withColumn("text", F.concat("text", F.when(F.col("turn") % 2 == 0, "<references>old").otherwise("")))
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    return c.groupBy("conv_id").agg(ordered.alias("messages")).where(F.exists("messages", lambda m: m["role"] == "user")).select("conv_id", T.user_query(F.col("messages")).alias("query"))


@query("select doc_id, 'm' || lang base, 'temperature=0.' || (doc_id % 9) parameters, 'T ' || lang \"template\" from documents")
def ft52_modelfile(spark: SparkSession, d: str) -> DataFrame:
    m = T.modelfile(F.concat(F.lit("FROM m"), "lang", F.lit("\nPARAMETER temperature 0."), (F.col("doc_id") % 9).cast("string"), F.lit('\nTEMPLATE """T '), "lang", F.lit('"""')))
    return docs(spark, d).select("doc_id", m["base"].alias("base"), F.array_join(F.transform(m["parameters"], lambda p: F.concat(p["name"], F.lit("="), p["value"])), ",").alias("parameters"), m["template"].alias("template"))


@query("select doc_id, sha1(text) fp, sha256(text) digest from documents")
def fh1_hashes(spark: SparkSession, d: str) -> DataFrame:
    return docs(spark, d).select("doc_id", T.fingerprint(F.col("text")).alias("fp"), F.sha2(F.encode("text", "UTF-8"), 256).alias("digest"))


@query("select event_id, try_cast(json_extract_string(props, '$.k') as bigint) k, null::bigint missing from events")
def fj1_json_int(spark: SparkSession, d: str) -> DataFrame:
    number = lambda p: F.get_json_object("props", p).try_cast("bigint")
    return table(spark, d, "events").select("event_id", number("$.k").alias("k"), number("$.none").alias("missing"))


@query("select event_id, k i, case when k * 2 = 0 then 0 else k * 2 end o, k * 3 t from (select event_id, json_extract_string(props, '$.k')::bigint k from events)")
def fj2_usage(spark: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    u = T.usage(F.format_string('{"input_tokens":0,"prompt_tokens":%d,"eval_count":%d}', k, k * 2))
    return table(spark, d, "events").select("event_id", u["input_tokens"].alias("i"), u["output_tokens"].alias("o"), u["total_tokens"].alias("t"))


@query("select n_nationkey, case n_nationkey % 4 when 0 then 'anyone' when 1 then 'anyone' when 2 then 'members' else 'nobody' end share from nation")
def fj3_share_flag(spark: SparkSession, d: str) -> DataFrame:
    j = F.element_at(F.array(F.lit("{}"), F.lit('{"share":true}'), F.lit('{"share":"members"}'), F.lit('{"share":false}')), (F.col("n_nationkey") % 4 + 1).cast("int"))
    return table(spark, d, "nation").select("n_nationkey", T.share_flag(j).alias("share"))


@query("select o_orderkey, case o_orderkey % 4 when 0 then 1706000000 when 1 then 1700000000 + o_orderkey when 2 then 1700000000 + o_orderkey else 1706000000 end::bigint t from orders")
def fd1_repair(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey").cast("long")
    t = F.when(k % 4 == 0, F.lit(5).cast("long")).when(k % 4 == 1, (k + 1700000000) * 1000).when(k % 4 == 2, k + 1700000000).otherwise(F.lit(9999999999))
    return table(spark, d, "orders").select("o_orderkey", D.repair_time(t, 1706000000).alias("t"))


@query("select event_id, strftime(ts, '%Y-%m-%d') as day, strftime(ts, '%Y-%m-%d %H:00') as hour from events")
def fd3_slots(spark: SparkSession, d: str) -> DataFrame:
    t = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return table(spark, d, "events").select("event_id", D.day(t).alias("day"), D.hour(t).alias("hour"))


@query("select epoch(to_timestamp(1706000000) at time zone 'UTC' - interval 10 day)::bigint \"days\", epoch(timestamp '2023-11-23 08:53:20')::bigint \"months\"")
def fd4_ago(spark: SparkSession, d: str) -> DataFrame:
    return spark.range(1).select(D.ago(1706000000, days=3, weeks=1).alias("days"), D.ago(1706000000, months=2).alias("months"))


@query("select n_nationkey, case when n_nationkey = 0 then null else n_nationkey * 3600 + 90.5 end \"seconds\" from nation")
def fd5_duration(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("n_nationkey") == 0, "-1").otherwise(F.concat(F.col("n_nationkey").cast("string"), F.lit("h1m30s500ms")))
    return table(spark, d, "nation").select("n_nationkey", D.duration_seconds(text).alias("seconds"))


@query("select o_orderkey, date_diff('year', o_orderdate::date, date '2024-02-28') - (case when strftime(date '2024-02-28', '%m%d') < strftime(o_orderdate, '%m%d') then 1 else 0 end) age from orders")
def fd6_age(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", D.age(F.to_date("o_orderdate"), F.to_date(F.lit("2024-02-28"))).cast("long").alias("age"))


@query("select event_id, event_id * 1000000000 > 500000000000 later, (event_id // 3600) || 'h' || (event_id % 3600 // 60) || 'm' || (event_id % 60) || 's' human, case when event_id % 3 = 0 then 'N/A' else printf('%.2f', event_id / 2.0) end rate from events")
def fd7_fd8_durations(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("event_id")
    return table(spark, d, "events").select("event_id", D.after_seconds(n * 1_000_000_000, F.lit(500)).alias("later"), D.human_duration(n).alias("human"), D.rate(n, F.when(n % 3 == 0, 0).otherwise(2_000_000_000)).alias("rate"))


@query("select c_custkey, round_even(c_acctbal / 2, 0)::bigint half from customer")
def fm9_half_even(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", F.bround(F.col("c_acctbal") / 2, 0).cast("long").alias("half"))


@query("select conv_id, turn, pos, substring(text, pos * 24 + 1, 24) piece from (select conv_id, turn, text, unnest(range(0, (length(text) + 23) // 24)) pos from conversations where length(text) > 0)")
def t03_pieces(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").select("conv_id", "turn", F.posexplode(T.pieces(F.col("text"))).alias("pos", "piece")).select("conv_id", "turn", F.col("pos").cast("long").alias("pos"), "piece")


@query(r"select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) title, regexp_extract(html, '<html[^>]*lang=.([a-z]+)', 1) lang from pages")
def s19_page_metadata(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title>", 1).alias("title"), F.regexp_extract("html", "(?i)<html[^>]*lang=[\"']?([a-z]+)", 1).alias("lang"))
