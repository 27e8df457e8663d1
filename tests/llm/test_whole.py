"""Cases that the corpus operators once left out."""

import os
import random
import re

from tarnbeck.llm import decontaminate, licenses, packing, substring
from tarnbeck.llm.common import shared_folder


def test_token_ids_where_spaces_cancel():
    from tokenizers import Tokenizer

    named = Tokenizer.from_file(packing.TOKENIZER)
    odd = ["a  b\tc", "a b\tc", "a\n\nb\tc", "a  b\xa0c d", "a \n b\x0bc", "<|endoftext|> a", "x <|endoftext|>y z", "plain words\nand more"]
    assert [len(x) // 4 for x in packing.token_ids(odd)] == [len(named.encode(t, add_special_tokens=False).ids) for t in odd]
    assert packing.token_ids(odd) == packing._encoder(packing.TOKENIZER).whole(odd)
    assert named.encode("<|endoftext|> a", add_special_tokens=False).ids == [50256, 257]


def _shortest(tree) -> str:
    """A shortest text that a parsed pattern matches, of its first branches."""
    out = ""
    for op, x in tree:
        match str(op):
            case "LITERAL":
                out += chr(x)
            case "IN":
                out += chr(x[0][1] if str(x[0][0]) == "LITERAL" else x[0][1][0])
            case "BRANCH":
                out += _shortest(x[1][0])
            case "SUBPATTERN":
                out += _shortest(x[3])
            case "MAX_REPEAT":
                out += _shortest(x[2]) * x[0]
    return out


def test_every_license_rule_passes_the_gate(spark):
    shapes = [(label, _shortest(re._parser.parse(pattern)), pattern) for label, _, pattern, _, _ in licenses.rules()]
    assert all(re.fullmatch(p, t) and any(g in t for g in licenses.GATES) for _, t, p in shapes)
    assert not any(" " in g for g in licenses.GATES)
    rows = [(label, t) for label, t, p in shapes if p in {x[2] for x in licenses.SINGLE}] + [("public-domain", "Placed in the PUBLIC\n  domain"), ("proprietary", "All rights-reserved")]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    found = {r.doc_id: {k.label for k in r.kept} for r in licenses.scan(docs).collect()}
    assert all(label in found[i] for i, (label, _) in enumerate(rows))


def test_places_of_terms_in_words():
    r = random.Random(11)
    odd = ["don't " * 5000 + "plain " * 5000, "a,b,c; 1,234 it's -- ... http://x.y/z?q=1 end", "9" * 20_000 + " 'x' " + "é" * 9_000 + ".y z", "a\xa0b c,d\x1ce \x85 f", " ", "", None]
    odd += ["".join(r.choice("ab é.,'\n\xa0　") for _ in range(20_000)) for _ in range(5)]
    for text in odd:
        at, spelt = decontaminate.places(text), decontaminate.words(text)
        assert len(at) == len(decontaminate.terms(text)) and list(dict.fromkeys(at.tolist())) == list(range(len(spelt)))
    assert decontaminate.places(odd[0])[[0, 1, 9_999, 10_000, 14_999]].tolist() == [0, 0, 4_999, 5_000, 9_999]


def test_item_behind_words_with_inner_marks(spark):
    r = random.Random(12)
    item = " ".join(f"q{r.randrange(10**6)}" for _ in range(20))
    plain = [f"w{r.randrange(3000)}" for _ in range(5000)]
    rows = [(i, " ".join(f"w{r.randrange(3000)}" for _ in range(200))) for i in range(100)]
    rows.append((100, " ".join(["don't"] * 5000 + plain[:2500] + [item] + plain[2500:])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontaminate.leaks(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert [(x.doc_id, x.item_id, x.coverage) for x in found] == [(100, 1, 1.0)]
    assert 7400 < found[0].near_word <= 7500


def test_item_in_a_passage_that_a_third_of_documents_share(spark):
    r = random.Random(13)
    item = " ".join(f"q{r.randrange(10**6)}" for _ in range(8))
    text = lambda n: " ".join(f"w{r.randrange(10**6)}" for _ in range(n))
    copy = text(40) + " " + item + " " + text(40)
    rows = [(i, copy if i < 100 else f"{text(40)} {item} {text(40)}" if i < 110 else text(80)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    idf = decontaminate.frequencies(docs)
    assert (idf > 0).all()
    found = decontaminate.leaks(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert sorted(x.doc_id for x in found) == list(range(110))


def _repeats(spark, rows):
    return substring.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()


def _plain(r, n):
    return " ".join(f"w{r.randrange(10**6)}" for _ in range(n))


def test_passages_without_stops(spark):
    r = random.Random(14)
    passages = [_plain(r, 51) for _ in range(40)]
    rows = [(2 * i + k, f"{_plain(r, 60)} {p} {_plain(r, 60)}") for i, p in enumerate(passages) for k in range(2)]
    found = {x.doc_id for x in _repeats(spark, [*rows, (1000, _plain(r, 300))])}
    assert found == {d for d, _ in rows}


def test_short_documents_and_edited_copies(spark):
    r = random.Random(15)
    kept = [_plain(r, 10) + ". " for _ in range(6)]
    alternate = lambda: "".join(s + _plain(r, 12) + ". " for s in kept)
    rows = [(1, "three short words"), (2, "Three short words."), (3, _plain(r, 9)), (4, alternate()), (5, alternate()), (6, "once only"), (7, _plain(r, 40) + ". a line of common words. " + _plain(r, 30)), (8, _plain(r, 40) + ". a line of common words. " + _plain(r, 30))]
    found = _repeats(spark, rows)
    assert {(x.doc_id, x.n_words, x.removed) for x in found if x.doc_id < 4} == {(1, 3, False), (2, 3, True)}
    assert sorted((x.doc_id, x.n_words, x.removed) for x in found if x.doc_id > 3) == [(4, 10, False)] * 6 + [(5, 10, True)] * 6


def test_op1_leaves_only_what_its_result_reads(spark):
    r = random.Random(17)
    passages = [_plain(r, 51) for _ in range(20)]
    rows = [(2 * i + k, f"{_plain(r, 60)} {p}. {_plain(r, 60)}") for i, p in enumerate(passages) for k in range(2)]
    shared = shared_folder(spark).removeprefix("file://")
    before, setting = set(os.listdir(shared)), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    mode = spark.conf.get(setting)
    found = substring.repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted({x.split("-")[0] for x in os.listdir(shared) if x not in before and not x.startswith(".")}) == ["held"]
    assert spark.conf.get(setting) == mode
    assert {x.doc_id for x in found.collect()} == {d for d, _ in rows}
    assert sorted(found.collect()) == sorted(found.collect())


def test_repeats_inside_one_document(spark):
    r = random.Random(16)
    line = _plain(r, 20) + "."
    text = "\n".join([_plain(r, 30) + ".", line, _plain(r, 30) + ".", line])
    found = sorted(_repeats(spark, [(1, text), (2, _plain(r, 50)), (3, "twice the same row " * 1), (3, "twice the same row " * 1)]), key=lambda x: x.start)
    assert [(x.doc_id, x.n_words, x.removed) for x in found] == [(1, 20, False), (1, 20, True)]
    assert [text[x.start : x.end] for x in found] == [line, line]
