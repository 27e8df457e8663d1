"""Training records from texts: chunk, assemble, segment, expand; and ingestion into a collection."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnbeck.functions import prose, prose_udfs
from tarnbeck.functions import text as T
from tarnbeck.operators.merge import duplicates_elsewhere

END = "【全文完】"


def chunks(texts: DataFrame, most: int = 12_000, lookback: int = 100, key: str = "fid", text: str = "text") -> DataFrame:
    """(key, chunk, text), chunks from 0."""
    return texts.select(key, F.posexplode(prose_udfs.chunk_udf(most, lookback)(F.col(text))).alias("chunk", "text"))


def postprocess(c: Column, short: bool = False) -> Column:
    """Metadata lines, marks, headings and spacing; of short texts the marks alone."""
    if short:
        return T.strip(T.chinese_marks(T.strip(c)))
    return T.strip(prose_udfs.spacing_udf(T.headings(T.chinese_marks(T.without_meta_lines(T.strip(c))))))


def assemble(parts: DataFrame, summaries: DataFrame, key: str = "fid") -> DataFrame:
    """(key, content): summary block, then each part below its title, with the part before it recalled; one part stands alone.

    parts has key, chunk (from 0), title, body and recap; summaries has key and summary. A record's parts are ordered
    within its row, as it must become one text.
    """
    filled = parts.where(T.strip(F.col("body")) != "")
    rows = filled.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("chunk", "title", "body", "recap"))).alias("p")).join(summaries, key)
    title = lambda x, i: F.concat(F.format_string("## 第%d段", i + 1), F.when(T.chunk_title(x["title"]) != "", F.concat(F.lit("："), T.chunk_title(x["title"]))).otherwise(""))
    recap = lambda i: F.when(i > 0, T.quote("前文提要", F.try_element_at(F.transform(F.col("p"), lambda y: y["recap"]), F.greatest(i, F.lit(1))))).otherwise("")
    several = F.flatten(F.transform("p", lambda x, i: F.array(recap(i), title(x, i), T.strip(x["body"]))))
    body = F.when(F.size("p") == 1, F.array(T.strip(F.col("p")[0]["body"]))).otherwise(several)
    blocks = F.filter(F.concat(F.array(T.quote("综述", F.col("summary"))), body), lambda x: x != "")
    return rows.select(key, F.array_join(blocks, "\n\n").alias("content"))


def _join(*parts: Column) -> Column:
    return F.array_join(F.filter(F.array(*parts), lambda x: x != ""), "\n\n")


def segment(records: DataFrame, end: str = END, max_context: int = 1000) -> DataFrame:
    """Records (line, user, assistant, summary, chunk_summaries) -> (line, segment_index, segment_total, mode, user, assistant).

    Records without chunk summaries give one short row; others a row a summary, whose bodies are cut or filled to their
    number. The question of a later segment holds the summary and the recaps before it, or the last alone where all
    together exceed max_context. max(1, number of summaries) rows come of each record.
    """
    n = F.size("chunk_summaries")
    short = records.where((n <= 0) | F.col("chunk_summaries").isNull())
    rule = F.lit(f"\n\n先给出 `> **综述**`；每次只写一段并以 `> **前文提要**` 结尾；全文结束时另起一行写“{end}”。")
    quote = lambda t, c: T.quote(t, c, bare=True)
    one = short.select("line", F.lit(1).alias("segment_index"), F.lit(1).alias("segment_total"), F.lit("short").alias("mode"), F.concat(T.strip(F.col("user")), rule).alias("user"), _join(quote("综述", F.col("summary")), F.element_at(F.concat(T.segment_bodies(F.col("assistant")), F.array(F.lit(""))), 1), F.lit(end)).alias("assistant"))
    long_ = records.where(n > 0).withColumn("bodies", T.fit_bodies(T.segment_bodies(F.col("assistant")), n)).withColumn("total", n)
    long_ = long_.select("*", F.posexplode("chunk_summaries").alias("at", "recap"))
    before = F.slice(F.col("chunk_summaries"), F.lit(1), F.col("at"))
    size = F.length(F.coalesce("summary", F.lit(""))) + F.length(F.array_join(before, "\n"))
    from_ = F.when(size > max_context, F.col("at") - 1).otherwise(0)
    recalled = F.transform(F.slice(before, from_ + 1, F.col("at") - from_), lambda x, i: F.concat(F.lit("> **"), T.ordinal(from_ + i + 1), F.lit("段**\n>\n> "), F.replace(T.strip(x), F.lit("\n"), F.lit("\n> "))))
    go_on = F.concat(F.format_string(f"继续写第%d段（共%d段），以 `> **前文提要**` 结尾；全文结束时另起一行写“{end}”。\n\n", F.col("at") + 1, F.col("total")), F.array_join(F.concat(F.array(quote("综述", F.col("summary"))), recalled), "\n\n"))
    body, recap = F.element_at("bodies", F.col("at") + 1), quote("前文提要", F.col("recap"))
    first, later = _join(quote("综述", F.col("summary")), T.strip(body), recap), _join(T.strip(body), recap, F.when(F.col("at") + 1 == F.col("total"), end).otherwise(""))
    many = long_.select("line", (F.col("at") + 1).alias("segment_index"), F.col("total").alias("segment_total"), F.lit("long").alias("mode"), F.when(F.col("at") == 0, F.concat(T.strip(F.col("user")), rule)).otherwise(go_on).alias("user"), F.when(F.col("at") == 0, first).otherwise(later).alias("assistant"))
    return one.unionByName(many)


def expand(records: DataFrame, key: str = "line") -> DataFrame:
    """Records (key, user, assistant) -> long table (key, chunk_type, block_idx, block_title, content) of what a directory tree would hold."""
    rest = T.without_quote(F.col("assistant"), "综述")
    bodies = T.segment_bodies(F.col("assistant"))
    titles = F.regexp_extract_all(rest, F.lit(r"(?m)^##\s*第\d+段(?:：([^\n]*))?$"), F.lit(1))
    whole = F.array(
        F.struct(F.lit("user_request").alias("t"), F.lit(None).cast("int").alias("i"), F.lit(None).cast("string").alias("n"), F.col("user").alias("c")),
        F.struct(F.lit("novel_summary").alias("t"), F.lit(None).cast("int").alias("i"), F.lit(None).cast("string").alias("n"), F.coalesce(T.quote_body(F.col("assistant"), "综述"), F.lit("")).alias("c")),
    )
    blocks = F.transform(bodies, lambda b, i: F.struct(F.lit("block_content").alias("t"), (i + 1).alias("i"), F.coalesce(F.try_element_at(titles, i + 1), F.lit("")).alias("n"), b.alias("c")))
    return records.select(key, F.explode(F.concat(whole, blocks)).alias("x")).select(key, F.col("x.t").alias("chunk_type"), F.col("x.i").alias("block_idx"), F.col("x.n").alias("block_title"), F.col("x.c").alias("content"))


def split_markdown(docs: DataFrame, key: str = "id", text: str = "text") -> DataFrame:
    return docs.select(key, F.posexplode(prose_udfs.headers_udf(F.col(text))).alias("part", "x")).select(key, "part", "x.headings", "x.text")


def split_characters(docs: DataFrame, size: int = 1000, overlap: int = 100, key: str = "id", text: str = "text") -> DataFrame:
    return docs.select(key, F.posexplode(prose_udfs.split_udf(size, overlap)(F.col(text))).alias("part", "x")).select(key, "part", "x.start", "x.text")


def merge_chunks(parts: DataFrame, target: int, most: int, key: str = "id") -> DataFrame:
    """Small chunks of a document merged in order; a group is one document's chunks."""

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        found = prose.merge_small([("", t) for t in pdf["text"]], target, most)
        return pd.DataFrame({key: [pdf[key].iloc[0]] * len(found), "part": range(len(found)), "text": [t for _, t in found]})

    kind = dict(parts.dtypes)[key]
    return parts.select(key, "part", "text").groupBy(key).applyInPandas(merge, f"{key} {kind}, part int, text string")


def map_batches(rows: DataFrame, f: Callable[[pd.DataFrame], pd.DataFrame], schema: str, remove: list[str] = (), where: Column | None = None) -> DataFrame:
    """f over batches of the rows that pass the filter; schema names what it returns, of which `remove` is left out."""
    kept = rows if where is None else rows.where(where)
    return kept.mapInPandas(lambda parts: (f(p) for p in parts), schema).drop(*remove)


def ingest(docs: DataFrame, held: DataFrame, model: Callable[[pd.Series], pd.Series], size: int = 1000, overlap: int = 100) -> DataFrame:
    """docs (id, text) -> (id, part, start, text, embedding, status). Texts whose hash another id holds already are refused, empty ones fail, and those that the model cannot do; statuses stand instead of exceptions."""
    marked = docs.withColumn("new", F.lit(True)).unionByName(held.select("id", "text").withColumn("new", F.lit(False)))
    again = duplicates_elsewhere(marked, "text", "id").where("new").select("id").distinct()
    fresh = docs.join(again, "id", "left_anti")

    def one(text: str) -> list[float] | None:
        try:
            return model(pd.Series([text])).iloc[0]
        except Exception:  # whatever a model raises, the other texts go on
            return None

    def guarded(texts: pd.Series) -> pd.Series:
        try:
            return model(texts)
        except Exception:
            return pd.Series([one(t) for t in texts])

    guarded.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    run = F.pandas_udf(guarded, "array<float>")
    parts = split_characters(fresh.where(T.strip(F.col("text")) != ""), size, overlap)
    good = parts.withColumn("embedding", run(F.regexp_replace("text", "\n", " "))).withColumn("status", F.when(F.col("embedding").isNull(), "failed").otherwise("ok"))
    bad = lambda rows, why: rows.select("id", F.lit(None).cast("int").alias("part"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("array<float>").alias("embedding"), F.lit(why).alias("status"))
    return good.unionByName(bad(again, "duplicate")).unionByName(bad(fresh.where(F.coalesce(T.strip(F.col("text")), F.lit("")) == ""), "empty"))
