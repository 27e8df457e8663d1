"""Text functions as columns: cleaning, tags, quotes, truncation, templates, hashing."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"^[\s\u3000]+|[\s\u3000]+$"
#: Chinese marks for ASCII ones beside a Chinese character.
MARKS = {",": "，", ".": "。", "?": "？", "!": "！", ":": "：", ";": "；", "(": "（", ")": "）", "[": "【", "]": "】"}
CJK = "\u3400-\u9fff"
#: Words that open a line about the work and not of it.
META_WORDS = "作者|作\\s*者|Author|书名|作品名|小说名|写作时间|创作时间|更新时间|发布时间|更新于|发表于|来源|出处|首发|转载|转自|来自|网站|网址|链接|地址|QQ群|群号|公众号|微信|微博|TXT|TXT下载|电子书|完整版|全文|扫描|校对|排版|整理|制作|上传|版权|声明|免责声明"
#: Titles that are headings by themselves.
TITLES = "序章|序言|楔子|引子|前言|后记|尾声|番外"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, SPACE, "")


def clean(c: Column) -> Column:
    """All steps of cleaning but NFKC, which no built-in does: line ends, control characters, runs of U+FFFD, line tails, long gaps, ends."""
    c = F.regexp_replace(F.coalesce(c, F.lit("")), r"\r\n?", "\n")
    c = F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")
    c = F.regexp_replace(c, "\ufffd{4,}", "\ufffd")
    c = F.regexp_replace(c, r"[^\S\n]+(?=\n|\z)", "")
    return strip(F.regexp_replace(c, r"\n{6,}", "\n\n\n"))


def bom_encoding(content: Column) -> Column:
    """Of the first bytes; UTF-32 before UTF-16, whose mark it begins with."""
    head = F.hex(F.substring(content, 1, 4))
    return F.when(head.startswith("EFBBBF"), "utf-8-sig").when(head.isin("FFFE0000", "0000FEFF"), "utf-32").when(head.startswith("FFFE") | head.startswith("FEFF"), "utf-16")


def chinese_marks(c: Column) -> Column:
    """Each mark with a Chinese character before or behind it becomes its Chinese form; a dot between digits has none."""
    for mark, wide in MARKS.items():
        m = re.escape(mark)
        c = F.regexp_replace(c, f"(?<=[{CJK}]){m}|{m}(?=[{CJK}])", wide)
    return c


def without_meta_lines(c: Column, head: int = 30, tail: int = 30) -> Column:
    """Lines of metadata or a lone URL go from the first and last lines; the middle stays."""
    lines = F.split(c, "\n", -1)
    odd = lambda x: x.rlike(rf"(?i)^\s*(?:{META_WORDS})\s*[:：]?\s*.*$") | x.rlike(r"(?i)^\s*(https?://\S+|www\.\S+)\s*$") | x.contains("本书来自") | (x.contains("更多精彩") & (x.contains("访问") | x.contains("下载")))
    kept = F.filter(lines, lambda x, i: ~(((i < head) | (i >= F.size(lines) - tail)) & odd(x)))
    return strip(F.array_join(kept, "\n"))


def headings(c: Column) -> Column:
    """Lines that are a chapter's or a special title become second-level headings."""
    c = F.regexp_replace(c, r"(?m)[ \t]+$", "")
    c = F.regexp_replace(c, r"(?m)^[ \t]*(第[0-9一二三四五六七八九十百千两]+[章节回卷部集][^\n]{0,30})$", "## $1")
    return strip(F.regexp_replace(c, rf"(?m)^[ \t]*({TITLES})$", "## $1"))


def chunk_title(c: Column) -> Column:
    """One line without leading marks, at most 30 characters."""
    c = strip(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))
    c = strip(F.regexp_replace(c, r"^[#* \-—–·:：\t]+", ""))
    return F.regexp_replace(F.substring(c, 1, 30), r"\s+$", "")


def last_tag(c: Column, tag: str) -> Column:
    """Content of the last <tag>, stripped; null if there is none."""
    return strip(F.try_element_at(F.regexp_extract_all(c, F.lit(rf"(?is)<{tag}>\s*(.*?)\s*</{tag}>"), F.lit(1)), F.lit(-1)))


def parse_reply(c: Column, required: list[str], optional: list[str] = (), may_be_empty: list[str] = ()) -> Column:
    """Struct of tags with `valid`: each required one stands and isn't empty, unless it may be."""
    valid = F.lit(True)
    for t in required:
        valid = valid & (last_tag(c, t).isNotNull() if t in may_be_empty else F.coalesce(last_tag(c, t) != "", F.lit(False)))
    return F.struct(*(last_tag(c, t).alias(t) for t in required), *(F.coalesce(last_tag(c, t), F.lit("")).alias(t) for t in optional), valid.alias("valid"))


def quote(title: str, body: Column, bare: bool = False) -> Column:
    """A quote block of wrapped lines; of an empty body nothing, or the bare header."""
    text = strip(F.coalesce(body, F.lit("")))
    lines = F.transform(F.split(text, "\n", -1), lambda x: F.when(F.regexp_replace(x, r"\s+$", "") == "", ">").otherwise(F.concat(F.lit("> "), F.regexp_replace(x, r"\s+$", ""))))
    return F.when(text == "", f"> **{title}**" if bare else "").otherwise(F.concat(F.lit(f"> **{title}**\n>\n"), F.array_join(lines, "\n")))


def _quote_pattern(title: str) -> str:
    return rf"(?m)^[ \t]*>[ \t]*\*\*{re.escape(title)}\*\*[ \t]*((?:\n[ \t]*>[^\n]*)*)"


def quote_body(c: Column, title: str) -> Column:
    """Text of the first quote block with the title; null if there is none."""
    found = F.try_element_at(F.regexp_extract_all(c, F.lit(_quote_pattern(title)), F.lit(1)), F.lit(1))
    return strip(F.regexp_replace(found, r"(?m)^[ \t]*>[ \t]*", ""))


def without_quote(c: Column, title: str, every: bool = False) -> Column:
    """The text without the first quote block of the title and what stands before it, or without all of them."""
    if every:
        return strip(F.regexp_replace(c, _quote_pattern(title) + r"\n*", ""))
    return strip(F.when(c.rlike(_quote_pattern(title)), F.regexp_extract(c, r"(?s)\A.*?" + _quote_pattern(title)[4:].replace("^", "", 1) + r"(.*)\z", 2)).otherwise(c))


def segment_bodies(c: Column) -> Column:
    """Texts below the segment headings, without their trailing recap; without headings the whole, if any."""
    rest = without_quote(c, "综述")
    parts = F.split(rest, r"(?m)^##\s*第\d+段.*$", -1)
    bodies = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: strip(F.try_element_at(F.split(x, r"(?m)^\s*>\s*\*\*前文提要\*\*\s*$", 2), F.lit(1))))
    return F.when(F.size(parts) > 1, bodies).when(strip(rest) == "", F.array().cast("array<string>")).otherwise(F.array(strip(rest)))


def fit_bodies(bodies: Column, n: Column) -> Column:
    """As many bodies as summaries: cut, or filled up with empty ones."""
    return F.slice(F.concat(bodies, F.array_repeat(F.lit(""), n.cast("int"))), F.lit(1), n.cast("int"))


def ordinal(n: Column) -> Column:
    """第 with Chinese numerals from 1 to 99, digits beyond."""
    digit = lambda d: F.element_at(F.array(*(F.lit(x) for x in "零一二三四五六七八九")), (d + 1).cast("int"))
    tens, ones = F.floor(n / 10), n % 10
    tail = F.when(ones == 0, "").otherwise(digit(ones))
    return F.concat(F.lit("第"), F.when((n <= 0) | (n >= 100), n.cast("string")).when(n < 10, digit(F.greatest(ones, F.lit(0)))).when(n < 20, F.concat(F.lit("十"), tail)).otherwise(F.concat(digit(F.greatest(F.least(tens, F.lit(9)), F.lit(0))), F.lit("十"), tail)))


def file_name(c: Column) -> Column:
    return F.substring(F.trim(F.regexp_replace(c, r'[\\/:*?"<>|]', "_")), 1, 100)


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"(?U)[^\w\s]", ""), r"(?U)\s+", "-")


def block_title(path: Column) -> Column:
    """What stands before the last -block of a directory's name."""
    return F.regexp_extract(path, r"^(.*)-block\d+$", 1)


def for_database(c: Column) -> Column:
    return F.regexp_replace(F.replace(c, F.lit("\x00"), F.lit("")), r"\p{Cs}", "")


def truncate(c: Column, most: int, mode: str = "middletruncate") -> Column:
    """start, end, or both with dots between: most // 2 characters and the rest of most."""
    half = most // 2
    short = {"start": F.substring(c, 1, most), "end": F.right(c, F.lit(most))}.get(mode, F.concat(F.substring(c, 1, half), F.lit("..."), F.right(c, F.lit(most - half))))
    return F.when(F.length(c) <= most, c).otherwise(short)


def middle(c: Column, n: int) -> Column:
    """The template's middle truncation: the longer half first."""
    return F.when(F.length(c) <= n, c).otherwise(F.concat(F.substring(c, 1, -(-n // 2)), F.lit("..."), F.right(c, F.lit(n // 2))))


def fill_prompt(template: str, prompt: Column) -> Column:
    """{{prompt}} and its :start:n, :end:n and :middletruncate:n forms, case-insensitive."""
    parts: list[Column] = []
    at = 0
    for m in re.finditer(r"(?i)\{\{prompt(?::(start|end|middletruncate):(\d+))?\}\}", template):
        parts.append(F.lit(template[at : m.start()]))
        n = int(m[2] or 0)
        parts.append({"start": F.substring(prompt, 1, n), "end": F.right(prompt, F.lit(n)), "middletruncate": middle(prompt, n)}.get((m[1] or "").lower(), prompt))
        at = m.end()
    return F.concat(*parts, F.lit(template[at:]))


def fill_rag(template: str, context: Column, query: Column) -> Column:
    """Context and query into a template; a placeholder within the context stays text, as pieces are joined and not replaced."""
    parts: list[Column] = []
    at = 0
    for m in re.finditer(r"\{\{(CONTEXT|QUERY)\}\}|\[(context|query)\]", template):
        parts += [F.lit(template[at : m.start()]), context if (m[1] or m[2]).lower() == "context" else query]
        at = m.end()
    return F.concat(*parts, F.lit(template[at:]))


def snippet(c: Column, query: str, before: int = 50, after: int = 100, fallback: int = 150) -> Column:
    """Text around the first match with dots where it is cut; else the beginning."""
    at = F.instr(F.lower(c), F.lit(query.lower())) - 1
    start = F.greatest(at - before, F.lit(0))
    end = F.least(F.length(c), at + len(query) + after)
    found = F.concat(F.when(start > 0, "...").otherwise(""), c.substr(start + 1, end - start), F.when(end < F.length(c), "...").otherwise(""))
    return F.when(at >= 0, found).otherwise(F.concat(F.substring(c, 1, fallback), F.when(F.length(c) > fallback, "...").otherwise("")))


def transcript(messages: Column) -> Column:
    return F.array_join(F.transform(messages, lambda m: F.concat(F.upper(m["role"]), F.lit(": "), m["content"])), "\n")


def block_text(blocks: Column) -> Column:
    """Content blocks (type, text, other) as lines: text, a placeholder for an image, others as they are."""
    return F.array_join(F.transform(blocks, lambda b: F.when(b["type"] == "text", b["text"]).when(b["type"] == "image_url", "[image]").otherwise(b["other"])), "\n")


def xml_escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def without_thought(c: Column, most: int = 3000) -> Column:
    """What follows the first end of thinking, else the last characters."""
    parts = F.split(c, "</think>|<end_working_out>", 2)
    return strip(F.when(F.size(parts) > 1, F.try_element_at(parts, F.lit(2))).otherwise(F.right(c, F.lit(most))))


def without_ansi(c: Column) -> Column:
    return F.regexp_replace(c, r"\x1B(?:[@-Z\\-_]|\[[0-?]*[ -/]*[@-~])", "")


def without_fence(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(strip(c), r"\A```[A-Za-z0-9_+-]*\n?", ""), r"\n?```\z", ""))


def urls(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"https?://\S+"), F.lit(0))


def is_email(c: Column) -> Column:
    return c.rlike(r"^[^@]+@[^@]+\.[^@]+")


def frontmatter(c: Column) -> Column:
    """Map of the key: value lines of a leading triple-quoted or dashed block; later keys win."""
    block = F.regexp_extract(c, r'(?s)\A\s*(?:"""|---)\s*\n(.*?)\n\s*(?:"""|---)', 1)
    pairs = F.filter(F.transform(F.split(block, "\n", -1), lambda x: F.struct(F.lower(F.regexp_extract(x, r"^\s*([a-zA-Z_]+)\s*:\s*(.*?)\s*$", 1)).alias("k"), F.regexp_extract(x, r"^\s*([a-zA-Z_]+)\s*:\s*(.*?)\s*$", 2).alias("v"))), lambda p: p["k"] != "")
    return F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != p["k"]), F.create_map(p["k"], p["v"])))


def tag_id(c: Column) -> Column:
    return F.lower(F.replace(c, F.lit(" "), F.lit("_")))


def folder_tags(path: Column, after: str) -> Column:
    """All prefixes of the folders below `after`, without the file's name."""
    rest = F.split(F.substring_index(path, after + "/", -1), "/", -1)
    folders = F.slice(rest, 1, F.greatest(F.size(rest) - 1, F.lit(0)))
    return F.transform(folders, lambda _, i: F.array_join(F.slice(folders, F.lit(1), i + 1), "/"))


def enriched(text: Column, name: Column, title: Column, headings_: Column, source: Column, snippet_: Column) -> Column:
    """Text with what is known of it, the name's words twice, for lexical scoring; parts that are null or empty are left out."""
    tokens = F.translate(name, "_-.", "   ")
    part = lambda label, c: F.when(c != "", F.concat(F.lit(label), c))
    return F.concat_ws(" ", text, F.when(name != "", F.concat_ws(" ", F.lit("Filename:"), name, tokens, tokens)), part("Title: ", title), F.when(F.size(headings_) > 0, F.concat(F.lit("Section: "), F.array_join(headings_, " > "))), part("Source: ", source), part("Snippet: ", snippet_))


DROPPED = ("content", "pages", "tables", "paragraphs", "sections", "figures")


def clean_metadata(m: Column) -> Column:
    """Map without bulky keys."""
    return F.map_filter(m, lambda k, _: ~k.isin(*DROPPED))


def user_query(messages: Column) -> Column:
    """User turns, newest first, each cut where references begin."""
    texts = F.transform(F.filter(messages, lambda m: m["role"] == "user"), lambda m: strip(F.substring_index(m["content"], "<references>", 1)))
    return F.array_join(F.filter(F.reverse(texts), lambda x: x != ""), "\n")


def modelfile(c: Column) -> Column:
    """Struct of FROM, the parameters as an array of (name, value), and TEMPLATE."""
    pairs = F.transform(F.regexp_extract_all(c, F.lit(r"(?im)^\s*PARAMETER\s+(\S+\s+.+?)\s*$"), F.lit(1)), lambda x: F.struct(F.lower(F.regexp_extract(x, r"^(\S+)", 1)).alias("name"), F.regexp_extract(x, r"^\S+\s+(.*)$", 1).alias("value")))
    return F.struct(F.regexp_extract(c, r"(?im)^\s*FROM\s+(\S+)", 1).alias("base"), pairs.alias("parameters"), F.regexp_extract(c, r'(?is)TEMPLATE\s+"""(.*?)"""', 1).alias("template"))


def fingerprint(c: Column) -> Column:
    return F.sha1(F.encode(F.coalesce(c, F.lit("")), "UTF-8"))


def usage(c: Column) -> Column:
    """(input_tokens, output_tokens, total_tokens) of a usage object under any of its names; 0 counts as missing."""
    number = lambda k: F.nullif(F.get_json_object(c, f"$.{k}").try_cast("bigint"), F.lit(0))
    i = F.coalesce(*(number(k) for k in ("input_tokens", "prompt_tokens", "prompt_eval_count", "prompt_n")), F.lit(0))
    o = F.coalesce(*(number(k) for k in ("output_tokens", "completion_tokens", "eval_count", "predicted_n")), F.lit(0))
    return F.struct(i.alias("input_tokens"), o.alias("output_tokens"), F.coalesce(number("total_tokens"), i + o).alias("total_tokens"))


def share_flag(c: Column) -> Column:
    """Who may share: anyone if null, true or 1; members; else nobody."""
    value = F.lower(F.get_json_object(c, "$.share"))
    return F.when(value.isNull() | value.isin("true", "1"), "anyone").when(value == "members", "members").otherwise("nobody")


def pieces(c: Column, size: int = 24) -> Column:
    """The text in pieces of `size` characters."""
    return F.when(F.length(c) == 0, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(0), F.floor((F.length(c) - 1) / size).cast("int")), lambda i: c.substr(i * size + 1, F.lit(size))))
