"""Directories, text and JSON files, the state table, trees of texts."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarnbeck.functions import prose_udfs
from tarnbeck.functions import text as T
from tarnbeck.operators.joins import pending


def scan(spark: SparkSession, root: str) -> DataFrame:
    """(path, rel, fid, content) of all files below a directory; fid is the SHA-1 of the relative path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    top = root.split("://", 1)[-1].rstrip("/")
    rel = F.regexp_replace("path", r"^[a-z0-9]+:/*" + "/" + top.lstrip("/").replace(".", r"\.") + "/", "")
    return files.select("path", rel.alias("rel"), F.sha1(F.encode(rel, "UTF-8")).alias("fid"), "content")


def read_texts(files: DataFrame) -> DataFrame:
    """(path, rel, fid, is_text, text, encoding); what isn't text has empty text."""
    return files.select("path", "rel", "fid", prose_udfs.read_text_udf("content").alias("t")).select("path", "rel", "fid", "t.*")


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str, strict: bool = True) -> DataFrame:
    """Lines as rows; a bad line fails the read if strict, else stands in _bad with null fields. Blank lines are skipped."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    mode = {"mode": "FAILFAST" if strict else "PERMISSIVE"}
    if strict:
        return lines.select(F.from_json("value", schema, mode).alias("r")).select("r.*")
    parsed = lines.select("value", F.from_json("value", schema, mode).alias("r"), F.expr("try_parse_json(value)").isNull().alias("b"))
    return parsed.select("r.*", F.when(F.col("b"), F.col("value")).alias("_bad"))


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A JSON array's or single object's rows; elements that are no objects are left out."""
    whole = spark.read.option("wholetext", True).text(path)
    items = whole.select(F.explode(F.expr("variant_get(case when value like '[%' then parse_json(value) else parse_json('[' || value || ']') end, '$', 'array<variant>')")).alias("v"))
    return items.where(F.expr("schema_of_variant(v) like 'OBJECT%'")).select(F.from_json(F.expr("to_json(v)"), schema).alias("r")).select("r.*")


def sniff_json(head: str, name: str = "") -> str:
    """"jsonl" or "json" from a file's first text, and its name."""
    if name.endswith((".jsonl", ".ndjson")):
        return "jsonl"
    text = head.lstrip("﻿ \t\r\n")
    if text.startswith("["):
        return "json"
    try:
        json.loads(text.split("\n", 1)[0])
    except ValueError:
        return "json"
    return "jsonl" if "\n" in text.strip() or not name.endswith(".json") else "json"


def append_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def rewrite(rows: DataFrame, path: str, keep: str | None = None) -> None:
    """Replace a dataset of JSON lines: written aside, the old one moved away, the new one renamed into place.

    The old one is kept as a version if asked, and comes back if the last step fails. A reader that must never meet the
    moment between the two renames reads what versions.publish writes.
    """
    spark = rows.sparkSession
    jvm = spark.sparkContext._jvm
    aside = uuid.uuid4().hex
    made, was = (jvm.org.apache.hadoop.fs.Path(f"{path}.{x}-{aside}") for x in ("new", "old"))
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    rows.write.json(made.toString())
    if keep:
        was = jvm.org.apache.hadoop.fs.Path(f"{path}.v={keep}")
    there = fs.exists(target)
    if there and not fs.rename(target, was):
        raise OSError(f"cannot move {path} away")
    if not fs.rename(made, target):
        if there:
            fs.rename(was, target)
        raise OSError(f"cannot put the new rows at {path}")
    if there and not keep:
        fs.delete(was, True)


STATE = "fid string, state string, status string, len long, encoding string, reason string"


def save_state(state: DataFrame, path: str) -> None:
    """The state table replaced; what the rows were read from may be the table itself."""
    rewrite(state, path)


def resume(files: DataFrame, path: str, work: Callable[[DataFrame], DataFrame], batch: int = 1000, rounds: int | None = None) -> int:
    """Files (fid, ...) whose id isn't done, a batch at a time: work gives rows of the state table, which is saved after each.

    A run that is broken off goes on with the batch at hand, so work is done at least once; what has failed is tried
    again by the next call, once each call. Rounds done.
    """
    spark, done = files.sparkSession, 0
    tried = load_state(spark, path).where("false").select("fid")
    while rounds is None or done < rounds:
        state = load_state(spark, path)
        some = pending(files.join(tried, "fid", "left_anti"), state, batch)
        if some.isEmpty():
            return done
        found = spark.createDataFrame(work(some).select(*StructType.fromDDL(STATE).names).collect(), STATE)  # a batch
        save_state(state.join(found.select("fid"), "fid", "left_anti").unionByName(found), path)
        tried = tried.unionByName(found.select("fid"))
        done += 1
    return done


def load_state(spark: SparkSession, path: str) -> DataFrame:
    """The state table, or an empty one."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath)
    return spark.read.schema(STATE).json(path) if there else spark.createDataFrame([], STATE)


def read_tree(files: DataFrame, most: int | None = None) -> DataFrame:
    """Scanned markdown files -> (novel_id, chunk_type, block_id, block_title, content) by their names; any block number counts.

    Contents are cut at `most` characters, if given, as a store's field length may ask for.
    """
    part = F.split("rel", "/")
    name, folder = F.element_at(part, -1), F.try_element_at(part, F.lit(-2))
    kind = F.when(name == "用户消息.md", "user_request").when(name == "综述.md", "novel_summary").when(name == "段落综述.md", "block_summary").when((name == "正文.md") & folder.rlike(r"-block\d+$"), "block_content").when(name == "正文.md", "novel_content")
    block = F.when(folder.rlike(r"block\d+$"), folder)
    content = T.strip(F.decode("content", "UTF-8"))
    content = content if most is None else F.substring(content, 1, most)
    return files.select(part[0].alias("novel_id"), kind.alias("chunk_type"), block.alias("block_id"), T.block_title(block).alias("block_title"), content.alias("content")).where("chunk_type IS NOT NULL AND content != ''")


def tree_files(rows: DataFrame, key: str = "line") -> DataFrame:
    """(rel, content) of the files that an expanded record's rows would be."""
    folder = F.concat(F.lit("novel"), F.col(key).cast("string"))
    block = F.concat(T.file_name(F.coalesce("block_title", F.lit(""))), F.lit("-block"), F.col("block_idx").cast("string"))
    rel = F.when(F.col("chunk_type") == "user_request", F.concat(folder, F.lit("/用户消息.md"))).when(F.col("chunk_type") == "novel_summary", F.concat(folder, F.lit("/综述.md"))).otherwise(F.concat(folder, F.lit("/"), block, F.lit("/正文.md")))
    return rows.select(rel.alias("rel"), "content")


def export_jsonl(rows: DataFrame, path: str, per_file: int = 100_000) -> None:
    rows.write.option("maxRecordsPerFile", per_file).mode("overwrite").json(path)
