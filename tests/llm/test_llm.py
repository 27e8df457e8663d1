"""The ten operators against brute force, and on odd input."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnbeck.llm import decontaminate, htmltree, langid, licenses, orderhash, packing, pii, registry, simhash, substring, warc
from tests.llm import brute

SF = "/root/testdata/sf0.001"
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, "MIT License mit license cc by a@b.co 10.0.0.1 +49 30 1234567 4111 1111 1111 1111"), (None, "no id at all, but words enough to be a text"), (6, "😀 é ü " * 5), (7, "x " * 30_000), (8, "9" * 20_000),
    (9, "a" * 50_000), (10, "the same words stand here and there " * 3), (11, "the same words stand here and there " * 3), (12, "\x00\x03 a@b.c 　 語"),
]
CLASHES = ["fp", "component_id", "base", "email", "spans", "held_out", "score", "length", "salt", "rank", "mark", "class_id", "leaked_id", "kept_id", "text2", "_t", "key", "at"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("odd")
    rows = spark.createDataFrame(ODD, "doc_id long, text string").select("doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"), *(F.lit("clash").alias(c) for c in CLASHES))
    rows.write.parquet(f"{top}/some/documents.parquet")
    rows.where("false").write.parquet(f"{top}/none/documents.parquet")
    pages = spark.createDataFrame([(1, "u", None), (1, None, "<p>x"), (None, "", ""), (2, "u", "<" * 1000), (3, "u", "<div>" * 3000 + "deep words.")], "page_id long, url string, html string").withColumn("file", F.lit(1)).withColumn("seq", F.lit(1))
    items = spark.createDataFrame([(1, None), (2, ""), (3, "few words"), (4, "the same words stand here and there the same words stand")], "item_id long, text string")
    for d, keep in (("some", True), ("none", False)):
        pages.where(F.lit(keep)).write.parquet(f"{top}/{d}/pages.parquet")
        items.where(F.lit(keep)).write.parquet(f"{top}/{d}/benchmark.parquet")
    return str(top)


@pytest.mark.parametrize("name", sorted(k for k in registry.queries() if k != "pipeline"))
def test_odd_and_empty_input(spark, odd_dir, name):
    found = registry.queries()[name](spark, f"{odd_dir}/some").collect()
    if name.split("_")[0] in ("op3", "op4", "op7", "op9", "op10"):
        assert len(found) == len(ODD)
    if name.startswith("op2"):
        assert len(found) == 5
    assert registry.queries()[name](spark, f"{odd_dir}/none").count() == 0


def test_pipeline_on_odd_and_empty_input(spark, odd_dir):
    import corpus_pipeline

    found = corpus_pipeline.run(spark, f"{odd_dir}/some").collect()
    assert {r.doc_id for r in found} <= {d for d, _ in ODD}
    assert corpus_pipeline.run(spark, f"{odd_dir}/none").count() == 0


def test_pii(spark, texts):
    for directory, rows in ((SF, list(texts.items())),):
        found = {r.doc_id: r for r in pii.op3_pii(spark, directory).collect()}
        for doc_id, text in rows:
            r = found[doc_id]
            assert ([r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256) == brute.pii(text)


def test_pii_odd(spark, odd_dir):
    rows = [(r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.op3_pii(spark, f"{odd_dir}/some").collect()]
    want = [(*c, h) for c, h in (brute.pii(t) for _, t in ODD)]
    assert sorted(rows) == sorted(want)


def test_pii_random(spark):
    r = random.Random(4)
    made = [(i, "".join(r.choice("a1.@+- ()9,é") for _ in range(200))) for i in range(300)]
    found = {x.doc_id: x for x in pii.find(spark.createDataFrame(made, "doc_id long, text string")).collect()}
    for i, text in made:
        joined = ",".join(f"{pii.KINDS[s.k]}:{s.s}:{s.e}" for s in found[i].base)
        assert hashlib.sha256(joined.encode()).hexdigest() == brute.pii(text)[1]
        assert all(text[s.s : s.e] for s in found[i].extra)


def test_pii_model_and_features(spark):
    rows = pii.labelled(400, seed=8)
    trees, threshold = pii.model()
    x = np.array([pii.features(k, m, b) for k, m, b, _ in rows], dtype=float)
    picked = sum(pii._apply(t, x) for t in trees) >= threshold
    y = np.array([r[3] for r in rows])
    assert y[picked].mean() >= 0.95 and picked[y == 1].mean() >= 0.5
    df = spark.createDataFrame([(int(k), m, b) for k, m, b, _ in rows[:60]], "k int, m string, b string")
    got = df.selectExpr("k", "m", "b", "array(" + ", ".join(f"cast({c} as double)" for c in pii._features("k", "m", "b")) + ") as f").collect()
    for g in got:
        assert list(g.f) == [float(v) for v in pii.features(g.k, g.m, g.b)]


def test_pii_redaction(spark):
    docs = spark.createDataFrame([(1, "mail a@b.co now", 15), (2, None, 0)], "doc_id long, text string, n_chars long")
    assert sorted(map(tuple, pii.redact_stage(spark, docs, "").collect())) == [(1, "mail [EMAIL] now", 16), (2, None, 0)]


def test_simhash(spark, texts):
    rows = simhash.op4_simhash(spark, SF).collect()
    want = brute.simhash_components({i: simhash.fingerprint(t) for i, t in texts.items()})
    assert {r.doc_id: r.component_id for r in rows} == want
    assert all(int(r.fingerprint, 16) == simhash.fingerprint(texts[r.doc_id]) and len(r.fingerprint) == 16 for r in rows)


def test_simhash_bits():
    assert simhash.fingerprint("") == simhash.fingerprint(None) == simhash.fingerprint(" \t") == 0
    import xxhash

    assert simhash.fingerprint("One  two") == xxhash.xxh64_intdigest(b"one two", 42) and simhash.fingerprint("É a") == xxhash.xxh64_intdigest("É a".encode(), 42)


def test_simhash_links_all(spark):
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(40)]
    made = list({b ^ sum(1 << i for i in r.sample(range(64), r.randint(0, 6))) for b in base for _ in range(20)})
    signed = [(x - (1 << 64) if x >> 63 else x, i) for i, x in enumerate(made)]
    found = {tuple(sorted((x.a, x.b))) for x in simhash.links(spark.createDataFrame(signed, "fp long, node long")).collect()}
    assert found == {(i, j) for i in range(len(made)) for j in range(i + 1, len(made)) if (made[i] ^ made[j]).bit_count() <= 3}


def test_components(spark):
    from tarnbeck.llm.common import components

    r = random.Random(6)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(500, 500), (None, 3)]
    found = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = brute.components([e for e in edges if None not in e and e[0] != e[1]])
    assert found == want


def test_packing(spark, texts):
    rows = packing.op8_best_fit(spark, SF).collect()
    by_doc = {}
    encoder = packing._Encoder(packing.TOKENIZER)
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc_id, text in texts.items():
        ids = np.array([*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
        pieces = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces))) and sum(p.length for p in pieces) == len(ids)
        assert all(p.length == 1024 for p in pieces[1:]) and (len(pieces) == 1) == (len(ids) <= 1024)
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(places) <= 1.03 * -(-sum(r.length for r in rows) // 1024) + 1


def test_token_ids_of_odd_texts():
    odd = [t for _, t in ODD] + ["a  b", "a\n\nb", " a", "a\x85b c", "it's don't\nwe'll 12,3 %% é", "<|endoftext|> a", "x² a²b ½, 'tis", "\x1c a b", "a　b c"]
    encoder = packing._Encoder(packing.TOKENIZER)
    assert packing.token_ids(odd) == encoder.whole([t or "" for t in odd])


def test_plan_is_near_optimal():
    r = random.Random(7)
    for _ in range(60):
        capacity = r.choice([10, 50])
        counts = {}
        for _ in range(r.randint(0, 60)):
            w = r.randint(1, capacity)
            counts[w] = counts.get(w, 0) + r.randint(1, 4)
        slots = packing.plan(counts, capacity)
        fill, used = {}, dict.fromkeys(counts, 0)
        for w, first, n, s, offset in sorted(slots, key=lambda x: x[1]):
            assert first == used[w]
            used[w] += n
            for k in range(n):
                fill[s + k] = fill.get(s + k, 0) + w
                assert offset + w <= capacity
        assert used == counts and all(f <= capacity for f in fill.values())
        assert len(fill) <= 11 / 9 * -(-sum(w * c for w, c in counts.items()) // capacity) + 10


def test_licenses(spark, texts):
    found = {r.doc_id: r for r in licenses.op9_licenses(spark, SF).collect()}
    for doc_id, text in texts.items():
        r = found[doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.licenses(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1


def test_license_rules(spark):
    assert len(licenses.rules()) > 200
    rows = {"Licensed under the BSD license": "bsd", "SPDX-License-Identifier: MPL-2.0": "mpl", "Mozilla Public License Version 2.0": "mpl", "nothing here": "", "MIT licence": "mit", "dedicated to the public domain": "public-domain"}
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    docs.write.mode("overwrite").parquet(f"{spark.conf.get('spark.checkpoint.dir')}/rules/documents.parquet")
    found = {r.doc_id: r.labels for r in licenses.op9_licenses(spark, f"{spark.conf.get('spark.checkpoint.dir')}/rules").collect()}
    assert [found[i] for i in range(len(rows))] == list(rows.values())


def test_order_minhash(spark, texts):
    found = {r.doc_id: r for r in orderhash.op10_order_minhash(spark, SF).collect()}
    ids = sorted(texts)
    for i, n in zip(ids, ids[1:] + ids[:1], strict=True):
        text, half = texts[i], len(texts[i]) // 2
        edited = text[: len(text) - half] + texts[n][:half]
        r = found[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (brute.order_minhash(text), brute.order_minhash(edited))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    mean = lambda c: sum(getattr(r, c) for r in found.values()) / len(found)
    assert mean("near_edited") > 5 * mean("near_next")


def test_language_gradients_and_run():
    r = np.random.default_rng(1)
    w = {"out": r.normal(0, 0.5, (16, 3)), "bias": r.normal(0, 0.5, 3)} | {f"{a}_{s}": r.normal(0, 0.5, (257 if a == "in" else 8, 24)) for a in ("in", "re") for s in "fb"}
    x, y = r.integers(0, 257, (5, 4)), r.integers(0, 3, 4)
    mass = (x != 256).astype(float)
    loss, grads = langid.gradients(x, y, mass, w)
    for k in w:
        at = np.unravel_index(np.abs(grads[k]).argmax(), w[k].shape)
        moved = {**w, k: w[k].copy()}
        moved[k][at] += 1e-5
        assert abs((langid.gradients(x, y, mass, moved)[0] - loss) / 1e-5 - grads[k][at]) < 1e-3
    for s in "fb":
        assert np.allclose(langid._run(x, w, s), langid._states(x, w, s)[0])


def test_language_held_out(spark, docs, texts):
    langs = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = langid.op7_language(spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.97 * len(held)
    assert langid.predict([None, "", "12 !"], langid.Model((), {})) == [("und", 0.0)] * 3


def test_html(spark):
    w = dict(htmltree.model())
    page = '<html><body><header><nav><a href=/>Home</a></nav></header><div id="cookie-banner"><p>We use cookies.</p></div><div class="post"><h1>T</h1><p>One &amp; <a href=x>two</a>.<p>Three<br>four <!-- c --> x<div class="ad">Buy</div><p>Five.</div><section class="comments"><div>Nice!</div></section><form><button>Go</button></form><footer>me</footer></body>'
    assert htmltree.main_text(page, w) == "T One & two. Three four x Five."
    assert htmltree.main_text(None, w) == htmltree.main_text("", w) == ""
    import html
    import re

    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        article = r.html[r.html.index("<article>") : r.html.index("</article>")]
        assert htmltree.main_text(r.html, w) == " ".join(html.unescape(re.sub("<[^>]*>", " ", article)).split())


def test_html_marginals_are_exact():
    page = htmltree.parse("<div class=ad><p>a b.</p><p>c</p></div><p>d</p>")
    w = dict(htmltree.model())
    p, _ = htmltree.marginals(page, htmltree.features(page), w)
    assert np.allclose(p, brute.tree_marginals(page, htmltree.features(page), w, htmltree._EDGE), atol=1e-9)


def test_html_labelled_held_out():
    w = dict(htmltree.model())
    wrong = total = 0
    for page, y in htmltree.labelled(100, seed=77):
        p, _ = htmltree.marginals(page, htmltree.features(page), w)
        leaves = [i for i in range(len(y)) if page.text[i] is not None]
        total += len(leaves)
        wrong += sum((p[i] >= 0.5) != bool(y[i]) for i in leaves)
    assert wrong <= 0.01 * total


def test_warc(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = warc.records(pages)
    warc.write_warc(rows, f"file://{tmp_path}/w")
    back = warc.read_warc(spark, f"file://{tmp_path}/w/*.txt")
    assert sorted(map(tuple, back.select("url", "payload").collect())) == sorted(map(tuple, pages.select("url", "html").collect()))
    ids = {r.page_id for r in pages.select("page_id").collect()}
    found = warc.op5_merkle(spark, SF).collect()
    assert {r.page_id for r in found} == {i for i in ids if i % warc.DAMAGE_EVERY == warc.DAMAGE_AT} and all(r.status == "corrupt" for r in found)
    index = warc.index(rows)
    assert warc.audit(index, index).count() == 0
    lost = warc.audit(index, index.where("seq != 7")).collect()
    assert [(r.seq, r.status) for r in lost] == [(7, "missing right")]


def test_substring(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(3, 8)))
    sentence = lambda n: " ".join(word() for _ in range(n)) + ". "
    text = lambda: "".join(sentence(r.randint(6, 14)) for _ in range(20))
    passage = "".join(sentence(12) for _ in range(5))
    made = [(i, text()) for i in range(20)]
    made += [(20, text() + passage + text()), (21, text()[:55] + " " + passage + text())]
    near = passage.split()
    near[-1] = "changed."
    made += [(22, text() + " ".join(near) + " " + text())]
    found = substring.repeats(spark.createDataFrame(made, "doc_id long, text string")).collect()
    assert {x.doc_id for x in found} == {20, 21, 22}
    assert {x.doc_id for x in found if x.removed} == {21, 22}
    body = dict(made)
    assert all(len(body[x.doc_id][x.start : x.end].split()) >= 40 for x in found)


def test_substring_links_against_brute_force(spark):
    r = random.Random(9)
    base = [[f"w{r.randrange(500)}" for _ in range(30)] for _ in range(20)]
    variants = base + [[*b[:-1], "x"] for b in base] + [[*b, "y", "z"] for b in base] + [[*b[:10], "q", *b[11:]] for b in base]
    docs = spark.createDataFrame([(i, " ".join(v) + ".") for i, v in enumerate(variants)], "doc_id long, text string")
    from tarnbeck.llm.common import materialise

    units = materialise(docs.mapInArrow(substring._occurrences, substring.UNIT_SCHEMA).where(f"kind = {substring.SENTENCE}"), "u")
    marks = {x.doc_id: x.mark for x in units.collect()}
    found = {tuple(sorted(x)) for x in substring.links(docs, units).collect()}
    sets = {marks[i]: substring.shingles(v) for i, v in enumerate(variants)}
    want = {tuple(sorted((a, b))) for a in sets for b in sets if a != b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert found <= want
    assert len(brute.components(list(found))) >= 0.97 * len(brute.components(list(want)))


def test_decontamination(spark, texts):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    found = {(r.doc_id, r.item_id) for r in decontaminate.op6_decontaminate(spark, SF).collect()}
    words = {i: decontaminate.words(t) for i, t in texts.items()}
    verbatim = {(d, i) for i, t in items.items() for d, w in words.items() if f" {' '.join(decontaminate.words(t))} " in f" {' '.join(w)} "}
    assert len(found & verbatim) >= 0.95 * len(verbatim)
    for d, i in found - verbatim:
        assert decontaminate.common(decontaminate.words(items[i]), words[d]) >= 0.6 * len(decontaminate.words(items[i]))


def test_common_subsequence():
    r = random.Random(2)
    for _ in range(100):
        a, b = ([r.choice("abcd") for _ in range(r.randint(1, 12))] for _ in range(2))
        assert decontaminate.common(a, b) == brute.lcs(a, b)


def test_pipeline(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "pii_redaction", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    component = {r.doc_id: r.component_id for r in simhash.op4_simhash(spark, SF).collect()}
    kept = {r.doc_id for r in simhash.keep_one(spark, docs, SF).collect()}
    assert kept == set(component.values())
    leaked = {r.doc_id for r in decontaminate.op6_decontaminate(spark, SF).collect()}
    clean = decontaminate.keep_clean(spark, docs, SF)
    assert {r.doc_id for r in clean.collect()} == set(component) - leaked and clean.columns == docs.columns
    assert corpus_pipeline.run(spark, SF).select("doc_id").distinct().count() > 0.8 * len(kept - leaked)
