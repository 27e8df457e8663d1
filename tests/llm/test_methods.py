"""Inner parts of the corpus operators against plain renderings."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarnbeck.llm import decontaminate, langid, licenses, packing, pii, substring


def _plain(r, n, of=10**6):
    return " ".join(f"w{r.randrange(of)}" for _ in range(n))


def test_token_ids_of_random_texts_in_small_slices(monkeypatch):
    r = random.Random(31)
    parts = ["a", "b", " ", "  ", "\n", "\n\n", "\t", "'s", "'ll", "é", "ß", "1", "23", "²", ",", "...", "\xa0", "　", "’", "—", "中", "😀", "\0", "<|endoftext|>", "longlonglonglongword", " the", "\x1c", "\x85", "Ж", "א", "٣"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(1500)] + [None, "", " ", "x" * 5000, " a" * 5000]
    encoder = packing._Encoder(packing.TOKENIZER)
    want = encoder.whole([t or "" for t in texts])
    for size in (1 << 21, 64):
        monkeypatch.setattr(packing, "SLICE", size)
        assert packing.token_ids(texts) == want


def _license_spans(text):
    """(labels, best weight) of the rules, without gate or keywords, by a sweep over all kept spans."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    line = f" {' '.join(words)} "
    spans = []
    for label, _, pattern, priority, weight in licenses.rules():
        for m in re.finditer(f"(?<= )(?:{pattern})(?= )", line):
            s = line[: m.start()].count(" ") - 1
            spans.append((s, -(s + m[0].count(" ") + 1), -priority, label, weight))
    kept = []
    for s, e, p, label, weight in sorted(spans):
        if not any(-k[1] >= -e and -k[2] >= -p for k in kept if -k[1] > s):
            kept.append((s, e, p, label, weight))
    return {k[3] for k in kept}, max((k[4] for k in kept), default=0.0)


def test_license_labels_and_scores_against_brute_force(spark, tmp_path):
    r = random.Random(32)
    parts = [
        "licensed under the", "GNU", "GPL", "v3", "or later", "license", "License,", "MIT", "Apache", "2.0", "the", "BSD", "3 clause", "CC BY", "SA 4.0", "public domain", "released into the public domain", "all rights reserved", "SPDX-License-Identifier:",
        "Mozilla Public License version 2.0", "lgplv2", "permission is hereby granted, free of charge, to any person obtaining a copy", "creativecommons.org/licenses/by/4.0", "word", "terms of the", "GNU General Public License", "under the", "Lizenz", "perl artistic", "zlib",
    ]
    texts = [" ".join(r.choice(parts) for _ in range(r.randint(1, 25))) for _ in range(150)] + ["", "Lizenz", "MIT"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"file://{tmp_path}/documents.parquet")
    found = {x.doc_id: x for x in licenses.op9_licenses(spark, f"file://{tmp_path}").collect()}
    for i, text in enumerate(texts):
        labels, weight = _license_spans(text)
        base = set(filter(None, found[i].base_labels.split(",")))
        assert set(filter(None, found[i].labels.split(","))) == labels | base, text
        assert found[i].score == (1.0 if base else weight), text


def test_overlapping_spans_are_taken_likeliest_first(spark):
    r = random.Random(33)
    rows = [(0, [(0, 10, 1.0), (8, 20, 2.0), (18, 30, 3.0)]), (1, [])]
    rows += [(i, [(s, s + r.randint(1, 9), float(r.randrange(6))) for s in (r.randrange(40) for _ in range(r.randint(1, 15)))]) for i in range(2, 60)]
    made = [(i, [((s, k, e, "m"), p) for k, (s, e, p) in enumerate(x)]) for i, x in rows]
    df = spark.createDataFrame(made, "i long, a array<struct<x:struct<s:int,k:int,e:int,m:string>,p:double>>")
    found = {x.i: sorted((y.x.s, y.x.e) for y in x.b) for x in df.select("i", F.expr(pii._likeliest("a")).alias("b")).collect()}
    assert found[0] == [(0, 10), (18, 30)]
    for i, x in rows:
        kept = []
        for s, e, _, _ in sorted(((s, e, p, k) for k, (s, e, p) in enumerate(x)), key=lambda y: (-y[2], y[0], y[3])):
            if not any(s < b and a < e for a, b in kept):
                kept.append((s, e))
        assert found[i] == sorted(kept)


def test_secrets_are_found_in_documents(spark):
    """Every token of the documents lies in a span, and texts without any personal data have none."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r.doc_id: r for r in pii.find(docs).collect()}
    held = total = false = 0
    for r in found.values():
        tokens = [m.span(1) for m in re.finditer(r'token = "([0-9a-f]{40})"', r.text)]
        spans = [(x.s, x.e) for x in r.extra]
        total += len(tokens)
        held += sum(any(a <= s and e <= b for a, b in spans) for s, e in tokens)
        false += sum(not any(a <= s and e <= b for s, e in tokens) for a, b in spans)
    assert total > 5 and held >= 0.9 * total and false <= 0.01 * len(found)


def test_signs_that_are_no_letters():
    model = langid.train([("en", "the words of a text"), ("de", "die Worte des Textes")] * 20, steps=5)
    assert [x[0] for x in langid.predict(["²", "½ ¾ ①", "", None, "12 !"], model)] == ["und"] * 5
    assert langid.predict(["a²"], model)[0][0] in ("en", "de")


def _leaks(spark, rows, items):
    found = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    return {(x.doc_id, x.item_id) for x in found.collect()}


def test_short_items_must_stand_whole(spark):
    r = random.Random(34)
    items = [(n, " ".join(f"q{n}x{k}" for k in range(n))) for n in range(1, 8)]
    rows = [(100 * n + k, f"{_plain(r, 30)} {text} {_plain(r, 30)}") for n, text in items for k in range(3)]
    rows += [(900 + n, f"{_plain(r, 20)} {' zz '.join(text.split())} {_plain(r, 20)}") for n, text in items if n > 1]
    rows += [(5, _plain(r, 200)), (6, items[3][1]), (7, None), (8, "")]
    assert _leaks(spark, rows, [*items, (50, ""), (51, None), (52, "...")]) == {(100 * n + k, n) for n, _ in items for k in range(3)} | {(6, 4)} | {(900 + n, 1) for n in ()}


def test_paraphrased_items(spark):
    """Items of which every seventh word is another, in texts of common words; and items in several blocks of queries."""
    r = random.Random(35)
    items = [(i, _plain(r, 30, 3000)) for i in range(40)]

    def edited(text):
        words = text.split()
        for k in range(r.randrange(7), len(words) - decontaminate.ANSWER_WORDS, 7):
            words[k] = "other"
        return " ".join(words)

    rows = [(i, f"{_plain(r, 150, 3000)} {edited(text)} {_plain(r, 150, 3000)}") for i, text in items]
    rows += [(1000 + i, _plain(r, 300, 3000)) for i in range(200)]
    found = _leaks(spark, rows, items)
    assert len(found & {(i, i) for i, _ in items}) >= 0.9 * len(items)
    assert all(d == i for d, i in found)


def test_blocks_of_queries_and_long_texts(spark, monkeypatch):
    r = random.Random(36)
    items = [(i, _plain(r, 20)) for i in range(9)]
    long_ = _plain(r, 9000).split()
    for k, (_, text) in enumerate(items):
        long_[k * 1000 : k * 1000] = text.split()
    rows = [(1, " ".join(long_)), *((10 + i, f"{_plain(r, 50)} {text} {_plain(r, 50)}") for i, text in items)]
    want = {(1, i) for i, _ in items} | {(10 + i, i) for i, _ in items}
    assert _leaks(spark, rows, items) == want
    monkeypatch.setattr(decontaminate, "QUERY_BLOCK", 3)
    assert _leaks(spark, rows, items) == want


def test_leaked_rows_without_an_id_go(spark, tmp_path):
    r = random.Random(37)
    item = _plain(r, 20)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(None, f"a {item} b"), (None, "clean"), (3, f"c {item}"), (3, "also clean"), (4, None)], "doc_id long, text string")
    kept = decontaminate.keep_clean(spark, docs, f"file://{tmp_path}").collect()
    assert sorted(map(str, kept)) == sorted(["Row(doc_id=None, text='clean')", "Row(doc_id=3, text='also clean')", "Row(doc_id=4, text=None)"])


def test_words_are_those_of_the_plain_rendering():
    r = random.Random(38)
    parts = ["a", "É", " ", "  ", "\n", ".", "! ", "don't", "(x)", "。", "！", "\xa0", "　", "1.5", '"q"', "...", "ẞ", "\x1c", "w", "İ"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(2000)] + [None, "", "."]
    for i, j, w in substring._laid_out(pa.array(texts)):
        for k in range(i, j):
            text, at, want = texts[k] or "", 0, []
            for token in text.split():
                at = text.index(token, at)
                if token.lower().strip(substring._EDGE):
                    want.append((at, at + len(token)))
                at += len(token)
            a, b = w.bounds[k - i], w.bounds[k - i + 1]
            assert list(zip(w.start[a:b].tolist(), w.end[a:b].tolist(), strict=True)) == want


@pytest.mark.parametrize("n", [33, 50])
def test_shared_words_share_a_window(n):
    r = random.Random(39)
    for _ in range(200):
        shared = _plain(r, n)
        texts = [f"{_plain(r, r.randint(0, 40))} {shared} {_plain(r, r.randint(0, 40))}" for _ in range(2)]
        ((_, _, w),) = substring._laid_out(pa.array(texts))
        at, marks = substring._winnowed(w)
        own = [set(marks[w.text[at] == k].tolist()) for k in (0, 1)]
        assert own[0] & own[1]
        assert (np.diff(at[w.text[at] == 0]) <= substring.WINNOW).all()
