import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnbeck.functions import dates, prose, prose_udfs
from tarnbeck.functions import text as T
from tarnbeck.functions import vectors as V
from tarnbeck.operators import predicates as P


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@given(st.text(alphabet="ab\n。！? ", max_size=300), st.integers(1, 50), st.integers(0, 60))
@settings(max_examples=150, deadline=None)
def test_chunks_lose_nothing_but_space(text, most, lookback):
    found = prose.chunk(text, most, lookback)
    assert "".join("".join(found).split()) == "".join(text.split())
    assert all(len(x) <= most for x in found)


def test_chunk_prefers_line_then_stop():
    assert prose.chunk("ab\ncd。ef", 6) == ["ab", "cd。ef"]
    assert prose.chunk("abc。defgh", 6) == ["abc。", "defgh"]
    assert prose.chunk("abcdefgh", 5) == ["abcde", "fgh"]


@given(st.text(alphabet="ab \n", max_size=400))
@settings(max_examples=100, deadline=None)
def test_recursive_split_covers(text):
    found = prose.split_recursive(text, 40, 10)
    assert all(len(t) <= 40 and text[a : a + len(t)] == t for a, t in found)
    covered = {i for a, t in found for i in range(a, a + len(t))}
    assert all(i in covered for i, c in enumerate(text) if not c.isspace())


def test_decoding():
    for encoding in ("utf-8", "gb18030", "utf-8-sig", "utf-16"):
        assert prose.decode("第一章 你好，世界。".encode(encoding))[0].lstrip("﻿") == "第一章 你好，世界。"
    assert not prose.is_text(b"") and not prose.is_text(b"a\0b") and prose.is_text(b"abc\n")
    assert not prose.is_text(b"\x01" * 6 + b"a" * 94) and prose.is_text(b"\x01" * 5 + b"a" * 95)


def test_clean_is_the_same_in_both(spark):
    text = "ａ1 \r\n\x01b���� c \n\n\n\n\n\n\n\nd　"
    assert one(spark, prose_udfs.clean_udf(F.lit(text))) == prose.clean(text) == "a1\nb� c\n\n\nd"
    plain = "a1 \r\n\x01b c \n\n\n\n\n\n\n\nd "
    assert one(spark, T.clean(F.lit(plain))) == prose.clean(plain)


def test_chinese_marks(spark):
    assert one(spark, T.chinese_marks(F.lit("他说:好,3.14(x)中.a.b"))) == "他说：好，3.14(x）中。a.b"


def test_markdown_spacing():
    assert prose.markdown_spacing("# T\n一。\n二\n- a\n- b\n```\nx。\ny\n```\n\n\n\n\nz") == "# T\n\n一。\n\n二\n- a\n- b\n```\nx。\ny\n```\n\n\nz"


def test_wraps():
    assert prose.wrap_marks("一二三四，五六七八九十", 6, 3) == "一二三四，\n五六七八九十"
    assert prose.wrap_words("ab cdefg 中文", 5) == "ab\ncdefg\n 中文"


def test_json_in_text():
    assert prose.first_json('x {bad {"a": "}"} y') == '{"a": "}"}'
    assert prose.split_json('{"a":1}{"b":{"c":2}} z {"d"') == ['{"a":1}', '{"b":{"c":2}}']
    assert prose.tool_call('```json\n{"name": "f", "arguments": {"x": 1}}\n```', frozenset({"f"})) == ("f", '{"x": 1}')
    assert prose.tool_call('{"name": "g"}', frozenset({"f"})) is None


def test_headers_and_merge():
    assert prose.split_headers("a\n# H\nb\n```\n# no\n```\n## I\nc") == [("", "a"), ("H", "# H\nb\n```\n# no\n```"), ("H > I", "## I\nc")]
    assert prose.merge_small([("s", "aa"), ("s", "bb"), ("t", "cc")], 5, 10) == [("s", "aa\n\nbb"), ("t", "cc")]
    assert prose.deep_merge({"a": {"b": 1, "c": 2}}, {"a": {"c": 3}, "d": 4}) == {"a": {"b": 1, "c": 3}, "d": 4}


def test_output_messages():
    items = [{"type": "message", "content": [{"text": "hi"}]}, {"type": "function_call", "call_id": "1", "name": "f", "arguments": "{}"}, {"type": "function_call_output", "call_id": "1", "output": "7"}]
    found = prose.output_messages(items)
    assert [m["role"] for m in found] == ["assistant", "tool"] and found[0]["tool_calls"][0]["id"] == "1"


@pytest.mark.parametrize(("n", "want"), [(1, "第一"), (10, "第十"), (11, "第十一"), (20, "第二十"), (99, "第九十九"), (100, "第100"), (0, "第0"), (-3, "第-3")])
def test_ordinals(spark, n, want):
    assert one(spark, T.ordinal(F.lit(n))) == want


def test_quotes(spark):
    text = "pre\n> **综述**\n>\n> a\n> b\n\nrest\n\n> **前文提要**\n> c\nend"
    assert one(spark, T.quote_body(F.lit(text), "综述")) == "a\nb"
    assert one(spark, T.without_quote(F.lit(text), "综述")) == "rest\n\n> **前文提要**\n> c\nend"
    assert one(spark, T.quote("t", F.lit(" "))) == "" and one(spark, T.quote("t", F.lit(None).cast("string"), bare=True)) == "> **t**"


def test_last_tag(spark):
    assert one(spark, T.last_tag(F.lit("<a>x</a> <A> y\nz </A>"), "a")) == "y\nz"
    assert one(spark, T.last_tag(F.lit("none"), "a")) is None


def test_times(spark):
    now = 1_700_000_000
    for t, want in ((1_690_000_000, 1_690_000_000), (1_690_000_000_999, 1_690_000_000), (5, now), (now + 90_000, now), (None, now)):
        assert one(spark, dates.repair_time(F.lit(t).cast("long"), now, floor=True)) == want
    assert one(spark, dates.duration_seconds(F.lit("1h30m"))) == 5400 and one(spark, dates.duration_seconds(F.lit("-1"))) is None


def test_filters(spark):
    assert P.parse_search("Hello tag:x folder:f pinned:true shared:false") == P.Search("hello", ["x"], ["f"], True, None, False)
    assert P.glob_pattern("a*_?") == "a%\\__" and P.glob_pattern("*") is None
    assert P.scim_page(0, 500) == (0, 100) and P.scim_filter("other") is None
    hosts = ["a.com", "x.a.com", "b.com", "bad.a.com"]
    rows = spark.createDataFrame([(h,) for h in hosts], "h string")
    assert [r.h for r in rows.where(P.host_allowed(["a.com", "!bad.a.com"], F.col("h"))).collect()] == ["a.com", "x.a.com"]


def test_vectors(spark):
    a, b = F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0))
    assert abs(one(spark, V.cosine(a, b)) - 0.5**0.5) < 1e-12
    q = F.array(a, b)
    assert one(spark, V.late_interaction(q, F.array(a))) == 2.0


def test_frontmatter_and_usage(spark):
    assert one(spark, T.frontmatter(F.lit('"""\nTitle: x\nbad line\n"""')))["title"] == "x"
    assert tuple(one(spark, T.usage(F.lit(json.dumps({"input_tokens": 0, "prompt_tokens": 3, "eval_count": 4}))))) == (3, 4, 7)
