"""Loaders by file extension, and web search results in one shape."""

from __future__ import annotations

import html
import io
import re
import zipfile
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tarnbeck.functions import prose


def _xml_text(data: bytes, blocks: tuple[str, ...]) -> str:
    """Text of an XML part, a line for each element whose local name is among blocks."""
    lines: list[str] = []
    for e in ElementTree.fromstring(data).iter():
        if e.tag.rpartition("}")[2] in blocks:
            lines.append("".join(e.itertext()))
    return "\n".join(lines)


def _zipped(data: bytes, pattern: str, blocks: tuple[str, ...]) -> str:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        return "\n".join(_xml_text(z.read(n), blocks) for n in sorted(z.namelist()) if re.fullmatch(pattern, n))


def _html(data: bytes) -> str:
    text = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ", prose.decode(data)[0])
    return "\n".join(x for x in (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"(?i)<(?:p|div|br|li|h[1-6]|tr)\b[^>]*>", text)) if x)


def _message(data: bytes) -> str:
    from email import message_from_bytes, policy

    m = message_from_bytes(data, policy=policy.default)
    body = m.get_body(("plain", "html"))
    return f"{m['subject'] or ''}\n{body.get_content() if body else ''}".strip()


def _sheets(data: bytes) -> str:
    """Rows of a workbook's sheets, cells by tabs: shared and inline strings, numbers, results of formulas."""
    local = lambda e: e.tag.rpartition("}")[2]
    shared = ["".join(e.itertext()) for x in _members(data, r"xl/sharedStrings\.xml") for e in ElementTree.fromstring(x) if local(e) == "si"]
    rows = []
    for sheet in _members(data, r"xl/worksheets/sheet\d+\.xml"):
        for row in (e for e in ElementTree.fromstring(sheet).iter() if local(e) == "row"):
            cells = []
            for cell in row:
                text = "".join(t for e in cell if local(e) in ("v", "is") for t in e.itertext())
                cells.append(shared[int(text)] if cell.get("t") == "s" and text else text)
            rows.append("\t".join(cells))
    return "\n".join(rows)


LOADERS = {
    "docx": lambda d: _zipped(d, r"word/document\.xml", ("p",)), "pptx": lambda d: _zipped(d, r"ppt/slides/slide\d+\.xml", ("p",)), "xlsx": _sheets,
    "odt": lambda d: _zipped(d, r"content\.xml", ("p", "h")), "epub": lambda d: "\n".join(_html(x) for x in _members(d, r".*\.x?html?")), "html": _html, "htm": _html, "xml": lambda d: "\n".join(x for x in (t.strip() for t in ElementTree.fromstring(d).itertext()) if x), "eml": _message,
}


def _members(data: bytes, pattern: str) -> list[bytes]:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        return [z.read(n) for n in sorted(z.namelist()) if re.fullmatch(pattern, n)]


def load(name: str, data: bytes) -> tuple[str, str]:
    """(text, status) by extension; text files and sources are decoded; what can't be read says why."""
    extension = name.rpartition(".")[2].lower()
    try:
        if extension in LOADERS:
            return prose.clean(prose.repair(LOADERS[extension](data))), "ok"
        ok, text, _ = prose.read_text(data)
        return (text, "ok") if ok else ("", "unsupported")
    except Exception as e:  # a broken file is a row with its reason, not a failed job
        return "", f"error: {type(e).__name__}"


def load_files(files: DataFrame) -> DataFrame:
    """Scanned files -> (rel, text, status)."""

    def run(name: pd.Series, content: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([load(n, bytes(c)) for n, c in zip(name, content, strict=True)], columns=["text", "status"])

    return files.select("rel", pandas_udf(run, "text string, status string")("rel", "content").alias("t")).select("rel", "t.*")


#: Where each provider keeps its results, and its names for link, title and snippet.
PROVIDERS = {
    "searxng": ("results", "url", "title", "content"), "bing": ("webPages.value", "url", "name", "snippet"), "google_pse": ("items", "link", "title", "snippet"),
    "serper": ("organic", "link", "title", "snippet"), "serply": ("results", "link", "title", "description"), "serpstack": ("organic_results", "url", "title", "snippet"), "brave": ("web.results", "url", "title", "description"), "tavily": ("results", "url", "title", "content"),
}


def search_results(replies: DataFrame, provider: str, reply: str = "reply") -> DataFrame:
    """Replies as JSON text -> (the other columns, rank, link, title, snippet) in the provider's order."""
    at, link, title, snippet = PROVIDERS[provider]
    items = F.from_json(F.get_json_object(reply, f"$.{at}"), f"array<struct<{link}:string,{title}:string,{snippet}:string>>")
    rows = replies.select(*(c for c in replies.columns if c != reply), F.posexplode(items).alias("rank", "x"))
    return rows.select(*(c for c in replies.columns if c != reply), "rank", F.col(f"x.{link}").alias("link"), F.col(f"x.{title}").alias("title"), F.col(f"x.{snippet}").alias("snippet"))


def page_metadata(page: Column) -> Column:
    """Struct of title, description and language."""
    return F.struct(F.regexp_extract(page, "(?is)<title[^>]*>(.*?)</title>", 1).alias("title"), F.regexp_extract(page, r"(?is)<meta[^>]+name=[\"']description[\"'][^>]+content=[\"']([^\"']*)", 1).alias("description"), F.regexp_extract(page, "(?i)<html[^>]*lang=[\"']?([a-z]+)", 1).alias("lang"))
