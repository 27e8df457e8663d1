"""License scan by ordered signature rules, in Spark SQL functions only.

A text becomes its words, lower-cased and joined by single spaces. A cheap test of a few substrings gates everything
else; in texts that pass it, one pattern collects the keywords present, and only rules with one of them are matched.
Rules are families of names times phrase templates, several hundred patterns, each with a priority and a weight. Spans
of words are sorted by start, longest and highest priority first; one sweep, which holds the kept spans that are still
open, suppresses a span that lies within a kept one of no lower priority. Base phrases are found beside the rules and
always stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnbeck.llm.common import table

BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
OTHER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # upper case included
CHUNK = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Label, keyword, names as patterns over words.
FAMILIES = [
    ("mit", "mit", ["mit", "massachusetts institute of technology mit", "mit x11", "expat mit"]),
    ("apache", "apache", ["apache", "apache software", "asf apache", "apache 2 0"]),
    ("gpl", "gpl", ["gpl", "gnu gpl", "gplv[123]", "gpl v?[123](?: 0)?(?: only| or later)?"]),
    ("gpl", "general", ["gnu general public", "general public"]),
    ("lgpl", "lgpl", ["lgpl", "gnu lgpl", "lgplv[23](?: 1)?"]),
    ("lgpl", "lesser", ["gnu lesser general public", "lesser general public"]),
    ("agpl", "agpl", ["agpl", "gnu agpl", "agplv3"]),
    ("agpl", "affero", ["gnu affero general public", "affero general public"]),
    ("gfdl", "documentation", ["gnu free documentation", "free documentation"]),
    ("bsd", "bsd", ["bsd", "[234] clause bsd", "bsd [0234] clause", "modified bsd", "new bsd", "simplified bsd"]),
    ("mpl", "mozilla", ["mozilla public", "mozilla public v?[12](?: [01])?"]),
    ("mpl", "mpl", ["mpl", "mpl [12] [01]"]),
    ("epl", "eclipse", ["eclipse public", "eclipse distribution"]),
    ("cddl", "cddl", ["cddl", "cddl 1 [01]"]),
    ("cddl", "distribution", ["common development and distribution"]),
    ("isc", "isc", ["isc", "internet systems consortium isc"]),
    ("unlicense", "unlicense", ["unlicense"]),
    ("wtfpl", "wtfpl", ["wtfpl"]),
    ("zlib", "zlib", ["zlib", "zlib libpng"]),
    ("boost", "boost", ["boost software", "boost"]),
    ("artistic", "artistic", ["artistic", "perl artistic", "artistic 2 0"]),
    ("python", "python", ["python software foundation", "python"]),
    ("php", "php", ["php", "php 3 01"]),
    ("ruby", "ruby", ["ruby"]),
    ("postgresql", "postgresql", ["postgresql"]),
    ("openssl", "openssl", ["openssl", "openssl and ssleay"]),
    ("ofl", "font", ["sil open font", "open font"]),
    ("odbl", "database", ["open database", "odc open database"]),
    ("eupl", "eupl", ["eupl", "eupl 1 [012]"]),
    ("eupl", "european", ["european union public"]),
    ("ms-pl", "microsoft", ["microsoft public", "microsoft reciprocal"]),
    ("cecill", "cecill", ["cecill", "cecill [bc]"]),
    ("osl", "osl", ["osl 3 0"]),
    ("afl", "academic", ["academic free"]),
    ("upl", "universal", ["universal permissive"]),
    ("ncsa", "ncsa", ["ncsa", "university of illinois ncsa open source"]),
    ("beerware", "beerware", ["beerware"]),
    ("cc0", "cc0", ["cc0", "cc0 1 0(?: universal)?"]),
    ("cc-by", "cc", ["cc by", "cc by [1234] [05]"]),
    ("cc-by-sa", "sa", ["cc by sa", "cc by sa [1234] [05]"]),
    ("cc-by-nc", "nc", ["cc by nc", "cc by nc (?:sa|nd)", "cc by nc [1234] [05]"]),
    ("cc-by-nd", "nd", ["cc by nd", "cc by nd [1234] [05]"]),
    ("cc-by", "commons", ["creative commons attribution", "creative commons attribution [1234] [05]"]),
    ("creative-commons", "commons", ["creative commons"]),
]
_LICENSE = "(?:licen[sc]e|licen[sc]es|lizenz|licencia)"
#: Template over a name, priority (higher wins), weight. {n} is the name, {l} any spelling of "license".
TEMPLATES = [
    ("spdx license identifier {n}", 9, 1.0),
    ("licensed under (?:the |an |a )?(?:terms of (?:the )?)?{n}(?: {l})?", 8, 0.95),
    ("(?:released|distributed|available|published|provided) under (?:the |an |a )?(?:terms of (?:the )?)?{n}(?: {l})", 8, 0.95),
    ("(?:subject to|covered by|governed by|under) (?:the )?(?:terms of (?:the )?)?{n} {l}", 7, 0.9),
    ("{n} {l} (?:version|v) ?[0-9]+(?: [0-9]+)?(?: or later| only)?", 6, 0.9),
    ("{l} (?:is )?{n}", 4, 0.7),
    ("{n} {l}", 5, 0.8),
]
#: Rules beside the families: label, keyword, pattern, priority, weight.
SINGLE = [
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy", 9, 1.0),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted", 9, 1.0),
    ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose", 9, 1.0),
    ("public-domain", "domain", "(?:released|dedicated|placed) (?:in|into|to) the public domain", 7, 0.9),
    ("public-domain", "domain", "this (?:work|file|text|software) is (?:in|dedicated to) the public domain", 7, 0.9),
    ("proprietary", "rights", "all rights reserved", 3, 0.5),
    ("cc-by", "creativecommons", "creativecommons org licenses by [1234] [05]", 9, 1.0),
    ("cc-by-sa", "creativecommons", "creativecommons org licenses by sa [1234] [05]", 9, 1.0),
    ("cc0", "creativecommons", "creativecommons org publicdomain zero 1 0", 9, 1.0),
    ("apache", "apache", "apache org licenses license 2 0", 9, 1.0),
    ("gpl", "gnu", "gnu org (?:licenses|copyleft) gpl(?: [123] 0)?(?: html)?", 9, 1.0),
    ("mit", "opensource", "opensource org licenses mit", 9, 1.0),
    ("bsd", "opensource", "opensource org licenses bsd [23] clause", 9, 1.0),
    ("mpl", "mozilla", "mozilla org mpl 2 0", 9, 1.0),
]
#: One of these stands in any text that a rule or base phrase matches, in lower case: every template has a word of
#: _LICENSE, a rule of SINGLE its keyword, and "cc by" the word cc. None has a space, so what parts words is no matter.
GATES = ("licen", "lizenz", "cc", *sorted({k for _, k, _, _, _ in SINGLE}))


def rules() -> list[tuple[str, str, str, int, float]]:
    """(label, keyword, pattern, priority, weight) of every rule. All but those of BASE carry a word of _LICENSE or a long phrase."""
    made = [(label, keyword, t.format(n=name, l=_LICENSE), priority, weight) for label, keyword, names in FAMILIES for name in names for t, priority, weight in TEMPLATES]
    return made + SINGLE


def spans(df: DataFrame, name: str, matches: Column, gaps: Column) -> DataFrame:
    """Adds `name`: (s, e, m) of each match by words, where matches and gaps cut a padded text; e exclusive."""
    words = "length({0}) - length(replace({0}, ' ', ''))"
    df = df.withColumn("_f", matches).withColumn("_g", gaps)
    df = df.withColumn("_l", F.expr(f"transform(_f, (m, i) -> {words.format('m')} + {words.format('_g[i]')})"))
    df = df.withColumn("_c", F.expr(f"transform(sequence(0, size(_l) div {CHUNK}), c -> aggregate(slice(_l, cast(c * {CHUNK} + 1 as int), {CHUNK}), 0, (a, x) -> a + x))"))
    df = df.withColumn("_h", F.expr("transform(_c, (s, c) -> aggregate(slice(_c, 1, c), 0, (a, x) -> a + x))"))
    at = f"_h[i div {CHUNK}] + aggregate(slice(_l, cast(i div {CHUNK} * {CHUNK} + 1 as int), i % {CHUNK}), 0, (a, x) -> a + x) + {words.format('_g[i]')} - 1"
    df = df.withColumn(name, F.expr(f"transform(transform(_f, (m, i) -> struct({at} as s, m as m)), x -> struct(x.s as s, x.s + {words.format('x.m')} + 1 as e, x.m as m))"))
    return df.drop("_f", "_g", "_l", "_c", "_h")


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, base, kept): base as (s, e, m) in order; kept as (label, weight) of each label that survives.

    Null texts are empty and have no words. Rows stay one to one; further columns are not read.
    """
    df = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    df = df.withColumn("n_words", F.regexp_count("text", F.lit(WORD)).cast("long")).withColumn("_low", F.lower("text"))
    gate = F.lit(False)
    for part in GATES:
        gate = gate | F.col("_low").contains(part)
    df = df.withColumn("_gate", gate).drop("_low")
    plain = F.concat(F.lit(" "), F.regexp_replace(F.translate("text", UPPER, LOWER), OTHER, " "), F.lit(" "))
    df = df.withColumn("_w", F.when(F.col("_gate"), F.regexp_replace(plain, "^ +| +$", " ")).otherwise(" ")).drop("text")
    none = F.array().cast("array<string>")
    phrase = f"(?<= )(?:{'|'.join(BASE)})(?= )"
    df = df.withColumn("_b", F.when(F.col("_gate"), F.regexp_extract_all("_w", F.lit(phrase), F.lit(0))).otherwise(none))
    df = spans(df, "base", F.col("_b"), F.when(F.size("_b") > 0, F.split("_w", phrase, -1)).otherwise(none)).drop("_b")
    table_ = rules()
    keywords = sorted({k for _, k, _, _, _ in table_})
    found = F.array_distinct(F.regexp_extract_all("_w", F.lit(f"(?<= )({'|'.join(keywords)})(?:v[0-9])?(?= )"), F.lit(1)))
    df = df.withColumn("_k", F.when(F.col("_gate"), found).otherwise(none))
    literal = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(f"(?<= ){p}(?= )").alias("p"), F.lit(label).alias("label"), F.lit(pr).alias("pr"), F.lit(w).alias("w")) for label, k, p, pr, w in table_))
    df = df.withColumn("_r", F.when(F.size("_k") > 0, F.filter(literal, lambda r: F.array_contains(F.col("_k"), r["k"]))))
    df = df.withColumn("_m", F.expr("filter(transform(_r, r -> struct(r.label as label, r.pr as pr, r.w as w, r.p as p, regexp_extract_all(_w, r.p, 0) as f)), x -> size(x.f) > 0)"))
    words = "length({0}) - length(replace({0}, ' ', ''))"
    df = df.withColumn("_m", F.expr("transform(_m, x -> struct(x.label as label, x.pr as pr, x.w as w, x.f as f, split(_w, x.p, -1) as g))"))
    df = df.withColumn("_m", F.expr(f"transform(_m, x -> struct(x.label as label, x.pr as pr, x.w as w, x.f as f, x.g as g, transform(x.f, (m, i) -> {words.format('m')} + {words.format('x.g[i]')}) as l))"))
    df = df.withColumn("_m", F.expr(f"transform(_m, x -> struct(x.label as label, x.pr as pr, x.w as w, x.f as f, x.g as g, x.l as l, transform(sequence(0, size(x.l) div {CHUNK}), c -> aggregate(slice(x.l, cast(c * {CHUNK} + 1 as int), {CHUNK}), 0, (a, y) -> a + y)) as c))"))
    df = df.withColumn("_m", F.expr("transform(_m, x -> struct(x.label as label, x.pr as pr, x.w as w, x.f as f, x.g as g, x.l as l, transform(x.c, (s, c) -> aggregate(slice(x.c, 1, c), 0, (a, y) -> a + y)) as h))"))
    at = f"x.h[i div {CHUNK}] + aggregate(slice(x.l, cast(i div {CHUNK} * {CHUNK} + 1 as int), i % {CHUNK}), 0, (a, y) -> a + y) + {words.format('x.g[i]')} - 1"
    # Sorted by start, then longest, then highest priority: what contains a span comes before it.
    df = df.withColumn("_s", F.expr(f"array_sort(flatten(transform(_m, x -> transform(transform(x.f, (m, i) -> struct({at} as s, m as m)), y -> struct(y.s as s, -(y.s + {words.format('y.m')} + 1) as ne, -x.pr as np, x.label as label, x.w as w)))))"))
    step = """if(exists(acc.open, o -> o.e >= -x.ne and o.pr >= -x.np), acc,
        struct(concat(filter(acc.open, o -> o.e > x.s), array(struct(-x.ne as e, -x.np as pr))) as open, array_union(acc.kept, array(struct(x.label as label, x.w as w))) as kept))"""
    start = "struct(cast(array() as array<struct<e:int,pr:int>>) as open, cast(array() as array<struct<label:string,w:double>>) as kept)"
    sweep = f"aggregate(_s, {start}, (acc, x) -> {step}, acc -> acc.kept)"
    return df.select("doc_id", "n_words", "base", F.coalesce(F.expr(sweep), F.expr("cast(array() as array<struct<label:string,w:double>>)")).alias("kept"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    label = "case x.m " + " ".join(f"when '{p}' then '{k}'" for p, k in BASE.items()) + " end"
    found = found.withColumn("_base", F.expr(f"array_distinct(transform(base, x -> {label}))"))
    union = "array_sort(array_union(_base, transform(kept, x -> x.label)))"
    score = "if(size(base) > 0, 1D, coalesce(array_max(transform(kept, x -> x.w)), 0D))"
    return found.select(
        "doc_id", "n_words", F.expr("cast(size(base) as long)").alias("n_base"), F.expr("cast(try_element_at(base, 1).s as long)").alias("first_word"), F.expr("cast(try_element_at(base, -1).s as long)").alias("last_word"),
        F.expr("array_join(array_sort(_base), ',')").alias("base_labels"), F.expr(f"array_join({union}, ',')").alias("labels"), F.expr(score).alias("score"),
    )


QUERIES = {"op9_licenses": op9_licenses}
ORACLES: dict[str, str] = {}
