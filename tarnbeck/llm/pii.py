"""Personal data by candidate generation and gradient boosting, in Spark SQL functions only.

Base spans (email, ip, card, phone) follow fixed patterns with their checks and always stay. Further generators propose
candidates with high recall, which may overlap: numbers written in groups, identity numbers, bank accounts, hardware
and IPv6 addresses, spelt-out mail addresses, keys and tokens, passwords. Boosted trees over format and context features
score them, a calibration turns scores into probabilities, and candidates over the calibrated threshold are redacted, the
likeliest first of those that overlap, none that overlaps a base span. The trees are trained on the driver from generated
labelled candidates and enter the plan as nested conditions.

The patterns are written so that Java's matcher runs in constant stack on any text: repeated groups become classes, as
each dot between labels (or separator between digits) is first replaced by one control character, which keeps offsets.
"""

from __future__ import annotations

import functools
import random
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnbeck.llm.common import table

BASE = ("email", "ip", "card", "phone")
JOINT = "\x03"  # stands for a dot or separator that joins; the text's own are put out of the way
SPAN = "array<struct<s:int,k:int,e:int,m:string>>"
#: Prefix sums are taken over chunks of so many matches, then over the chunks.
CHUNK = 64
#: Code points before a candidate that its context features see.
CONTEXT = 24

#: Kind, Java pattern, cheap gate. Each is valid in Python's re too, which the training uses.
GENERATORS = [
    ("grouped_number", r"(?<![0-9A-Za-z])\(?[0-9]{2,4}\)?[ .\-/][0-9]{2,4}[ .\-/][0-9]{2,4}(?:[ .\-/][0-9]{2,4})?(?![0-9A-Za-z])", "[0-9][ .\\-/)]"),
    ("identity_number", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])", "[0-9]-[0-9]"),
    ("bank_account", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])", "[A-Z]{2}[0-9]{2}"),
    ("hardware_address", r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{2}(?:[:-][0-9A-Fa-f]{2}){5}(?![0-9A-Za-z:])", "[0-9A-Fa-f]{2}[:-][0-9A-Fa-f]{2}"),
    ("ipv6", r"(?<![0-9A-Za-z:])(?:[0-9a-fA-F]{1,4}:){3,7}(?::?[0-9a-fA-F]{1,4}){1,4}(?![0-9A-Za-z:])", "[0-9a-fA-F]:[0-9a-fA-F]"),
    ("spelt_email", r"(?<![A-Za-z0-9._+-])[A-Za-z0-9._+-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63} ?[(\[]dot[)\]] ?[A-Za-z]{2,12}(?![A-Za-z])", "[(\\[]at[)\\]]"),
    ("secret", r"(?<![0-9A-Za-z_+/=-])[0-9A-Za-z_+/=-]{20,512}(?![0-9A-Za-z_+/=-])", r"(?<![0-9A-Za-z_+/=-])[0-9A-Za-z_+/=-]{20}"),
    ("password", r"(?i:password|passphrase|passwd|pwd)[\"']? ?[:=] ?[\"']?[^ \t\r\n\"',;]{4,64}", "passw|passphrase|pwd"),
]
KINDS = [*BASE, *(g[0] for g in GENERATORS)]
CUES = {
    "cue_phone": r"(?i)(?:phone|tel|call|fax|mobile|cell)[^0-9A-Za-z]",
    "cue_identity": r"(?i)(?:ssn|social|identity|passport)[^0-9]",
    "cue_bank": r"(?i)(?:iban|account|bank|konto|cuenta)",
    "cue_secret": r"(?i)(?:token|secret|key|auth|bearer|credential|sha)[^0-9A-Za-z]",
    "cue_other": r"(?i)(?:date|version|isbn|order|invoice|page|chapter|section|serial|build|rfc|no\.)",
}
FEATURES = ["kind", "length", "digits", "spaces", "dots", "dashes", "slashes", "letters", "upper", "signs", "repeats", *CUES]


def features(kind: int, match: str, before: str) -> list[float]:
    """What the trees see; _features() is the same in SQL."""
    digits = re.sub(r"[^0-9]", "", match)
    return [kind, len(match), len(digits), match.count(" "), match.count("."), match.count("-"), match.count("/"), len(re.sub(r"[^A-Za-z]", "", match)), len(re.sub(r"[^A-Z]", "", match)), len(set(match.lower())), float(len(digits) > 0 and digits == digits[:1] * len(digits)), *(float(re.search(p, before) is not None) for p in CUES.values())]


def _features(kind: str, match: str, before: str) -> list[str]:
    count = lambda c: f"length({match}) - length(replace({match}, '{c}', ''))"
    digits = f"regexp_replace({match}, '[^0-9]', '')"
    return [kind, f"length({match})", f"length({digits})", count(" "), count("."), count("-"), count("/"), f"length(regexp_replace({match}, '[^A-Za-z]', ''))", f"length(regexp_replace({match}, '[^A-Z]', ''))", f"size(array_distinct(split(lower({match}), '')))", f"if(length({digits}) > 0 and {digits} = repeat(left({digits}, 1), length({digits})), 1, 0)", *(f"if({before} rlike r'{p}', 1, 0)" for p in CUES.values())]


def labelled(n: int = 4000, seed: int = 7) -> list[tuple[int, str, str, int]]:
    """(kind, match, text before, label): candidates as the generators would propose them, made from a rule."""
    r = random.Random(seed)
    d = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    h = lambda k: "".join(r.choice("0123456789abcdef") for _ in range(k))
    mixed = lambda k: "".join(r.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz0123456789") for _ in range(k))
    word = lambda: "".join(r.choice("aeioulnrst") for _ in range(r.randint(2, 8)))
    made = {
        "grouped_number": ([lambda: f"({d(3)}) {d(3)}-{d(4)}", lambda: f"{d(3)}-{d(3)}-{d(4)}", lambda: f"0{d(2)} {d(3)} {d(4)}", lambda: f"0{d(1)}.{d(2)}.{d(2)}.{d(2)}"], [lambda: f"20{d(2)}-0{r.randint(1, 9)}-{r.randint(10, 28)}", lambda: f"{r.randint(10, 28)}/{r.randint(10, 12)}/20{d(2)}", lambda: f"{d(2)}.{d(2)}.{d(2)}", lambda: f"{d(2)} {d(3)} {d(2)}"]),
        "identity_number": ([lambda: f"{d(3)}-{d(2)}-{d(4)}"], [lambda: f"{d(3)}-{d(2)}-{d(4)}", lambda: "000-00-0000"]),
        "bank_account": ([lambda: f"DE{d(2)} {d(4)} {d(4)} {d(4)} {d(4)} {d(2)}", lambda: f"FR{d(2)}{d(20)}"], [lambda: f"AB{d(2)} {word()[:4].upper():X<4} {word()[:4].upper():X<4} {word()[:4].upper():X<4}", lambda: f"XX{d(2)}{d(12)}"]),
        "hardware_address": ([lambda: ":".join(h(2) for _ in range(6))], [lambda: "-".join(d(2) for _ in range(6))]),
        "ipv6": ([lambda: ":".join(h(4) for _ in range(8))], [lambda: ":".join(d(2) for _ in range(5)), lambda: ":".join(d(1) for _ in range(6))]),
        "spelt_email": ([lambda: f"{word()} (at) {word()} (dot) com", lambda: f"{word()}.{word()}[at]{word()}[dot]org"], []),
        "secret": ([lambda: h(r.choice([32, 40, 64])), lambda: mixed(r.randint(20, 64)), lambda: "AKIA" + mixed(16).upper(), lambda: "sk-" + mixed(40)], [lambda: "".join(word() for _ in range(8))[:40].ljust(20, "e"), lambda: "_".join([word(), word(), word(), word(), word(), d(1)]).ljust(20, "a"), lambda: "-".join(word() for _ in range(7)).ljust(20, "a"), lambda: r.choice("=-_") * r.randint(20, 60), lambda: d(r.randint(20, 30)), lambda: "/".join([word(), word(), word(), word(), d(4)]).rjust(20, "/")]),
        "password": ([lambda: f"{r.choice(['password', 'pwd', 'Passwd'])}{r.choice([': ', '=', ' = '])}{mixed(r.randint(6, 16))}"], [lambda: f"password: {r.choice(['none', 'required', 'yours', 'empty', 'hidden', 'reset'])}"]),
    }
    good = {"grouped_number": ["phone: ", "call me, tel. ", "fax ", "mobile: "], "identity_number": ["SSN: ", "social security "], "bank_account": ["IBAN ", "bank account: "], "secret": ["token = ", "api_key: ", "secret=", "Bearer ", "key: "]}
    bad = ["date: ", "version ", "order no. ", "invoice ", "ISBN ", "page ", "serial "]
    rows = []
    for _ in range(n):
        kind, (yes, no) = r.choice(list(made.items()))
        label = int(not no or r.random() < 0.5)
        cue = r.random() < 0.7
        hint = r.choice(good.get(kind, [""]) if label else bad) if cue else ""
        if kind == "identity_number" and not cue:
            label = int(r.random() < 0.4)  # without a cue its form says little
        if kind == "grouped_number" and not cue and label:
            label = int(r.random() < 0.7)
        rows.append((KINDS.index(kind), r.choice(yes if label or not no else no)(), f"{word()} {word()} {hint}"[-CONTEXT:], label))
    return rows


Tree = tuple | float


def _grow(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int) -> Tree:
    leaf = float(grad.sum() / (hess.sum() + 1.0))
    if not depth or len(x) < 20:
        return leaf
    best, at = 1e-6, None
    base = grad.sum() ** 2 / (hess.sum() + 1.0)
    for j in range(x.shape[1]):
        for cut in np.unique(x[:, j])[:-1]:
            left = x[:, j] <= cut
            gain = grad[left].sum() ** 2 / (hess[left].sum() + 1.0) + grad[~left].sum() ** 2 / (hess[~left].sum() + 1.0) - base
            if gain > best:
                best, at = gain, (j, float(cut), left)
    if at is None:
        return leaf
    j, cut, left = at
    return (j, cut, _grow(x[left], grad[left], hess[left], depth - 1), _grow(x[~left], grad[~left], hess[~left], depth - 1))


def _apply(tree: Tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    j, cut, low, high = tree
    return np.where(x[:, j] <= cut, _apply(low, x), _apply(high, x))


@functools.cache
def model(trees: int = 24, depth: int = 3, rate: float = 0.3, precision: float = 0.98) -> tuple[tuple[Tree, ...], float]:
    """Trees, and the least score at which held-out candidates are right with at least `precision`, after isotonic pooling."""
    rows = labelled()
    x = np.array([features(k, m, b) for k, m, b, _ in rows], dtype=float)
    y = np.array([r[3] for r in rows], dtype=float)
    fit = np.arange(len(x)) % 4 != 0
    score, grown = np.zeros(len(x)), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        tree = _grow(x[fit], (y - p)[fit], (p * (1 - p))[fit], depth)
        grown.append(tree)
        score += rate * _apply(tree, x)
    order = np.argsort(score[~fit], kind="stable")
    blocks: list[list[float]] = []  # sum of labels, count, least score: pooled until the rates rise
    for s, label in zip(score[~fit][order], y[~fit][order], strict=True):
        blocks.append([label, 1, s])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2]]
    threshold = next((b[2] for b in blocks if b[0] / b[1] >= precision), float("inf"))
    return tuple(grown), float(threshold) / rate


def _tree_sql(tree: Tree, names: list[str]) -> str:
    if not isinstance(tree, tuple):
        return f"{tree:.12f}D"
    j, cut, low, high = tree
    return f"if({names[j]} <= {cut:.6f}D, {_tree_sql(low, names)}, {_tree_sql(high, names)})"


def _spans(df: DataFrame, name: str, text: Column, pattern: str, gate: Column, kind: int) -> DataFrame:
    """Adds the column `name`: all matches as (s, k, e, m), offsets in code points, e exclusive."""
    none = F.array().cast("array<string>")
    df = df.withColumn("_t", text).withColumn("_f", F.when(gate, F.regexp_extract_all("_t", F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn("_g", F.when(F.size("_f") > 0, F.split("_t", pattern, -1)).otherwise(none))
    df = df.withColumn("_l", F.expr("transform(_f, (m, i) -> length(m) + length(_g[i]))"))
    df = df.withColumn("_c", F.expr(f"transform(sequence(0, size(_l) div {CHUNK}), c -> aggregate(slice(_l, cast(c * {CHUNK} + 1 as int), {CHUNK}), 0, (a, x) -> a + x))"))
    df = df.withColumn("_h", running("_c"))
    at = f"_h[i div {CHUNK}] + aggregate(slice(_l, cast(i div {CHUNK} * {CHUNK} + 1 as int), i % {CHUNK}), 0, (a, x) -> a + x) + length(_g[i])"
    df = df.withColumn(name, F.expr(f"transform(transform(_f, (m, i) -> struct({at} as s, m as m)), x -> struct(x.s as s, {kind} as k, x.s + length(x.m) as e, x.m as m))"))
    return df.drop("_t", "_f", "_g", "_l", "_c", "_h")


def running(sums: str) -> Column:
    """What stands before each of a column's sums, added up: over CHUNK of them at a time, then over those."""
    add = "(a, x) -> a + x"
    part = f"aggregate(slice({sums}, cast(d * {CHUNK} + 1 as int), {CHUNK}), 0, {add})"
    before = f"transform(transform(sequence(0, size({sums}) div {CHUNK}), d -> {part}), (s, d) -> struct(s as s, d as d))"
    own = f"aggregate(slice({sums}, cast(c div {CHUNK} * {CHUNK} + 1 as int), c % {CHUNK}), 0, {add})"
    above = f"transform({before}, (y, d) -> aggregate(slice({before}, 1, d), 0, (a, z) -> a + z.s))"
    return F.expr(f"transform({sums}, (s, c) -> {own} + element_at({above}, cast(c div {CHUNK} + 1 as int)))")


def _any_of(text: Column, words: str) -> Column:
    found = F.lit(False)
    for w in words.split("|"):
        found = found | text.contains(w)
    return found


def _luhn(digits: str) -> str:
    return f"aggregate(transform(sequence(1, length({digits})), i -> (if(i % 2 = 0, 2, 1) * int(substr({digits}, -i, 1))) div 10 + (if(i % 2 = 0, 2, 1) * int(substr({digits}, -i, 1))) % 10), 0L, (a, x) -> a + x) % 10 = 0"


def _likeliest(spans: str) -> str:
    """Of spans (x, p) those that overlap none likelier that is itself kept: taken likeliest first within each run of overlapping ones."""
    kind = "array<struct<x:struct<s:int,k:int,e:int,m:string>,p:double>>"
    none = f"cast(array() as {kind})"
    order = "(a, b) -> case when a.p > b.p then -1 when a.p < b.p then 1 when a.x.s < b.x.s then -1 when a.x.s > b.x.s then 1 else a.x.k - b.x.k end"
    best = f"aggregate(array_sort(%s, {order}), {none}, (kept, a) -> if(exists(kept, b -> a.x.s < b.x.e and b.x.s < a.x.e), kept, concat(kept, array(a))))"
    step = f"""if(y.x.s >= acc.to, struct(concat(acc.kept, {best % 'acc.run'}) as kept, array(y) as run, y.x.e as to),
                  struct(acc.kept as kept, concat(acc.run, array(y)) as run, greatest(acc.to, y.x.e) as to))"""
    by_start = f"array_sort({spans}, (a, b) -> case when a.x.s != b.x.s then a.x.s - b.x.s else a.x.k - b.x.k end)"
    return f"aggregate({by_start}, struct({none} as kept, {none} as run, 0 as to), (acc, y) -> {step}, acc -> concat(acc.kept, {best % 'acc.run'}))"


def find(docs: DataFrame, carry: bool = False) -> DataFrame:
    """(doc_id, text, base, extra): spans as arrays of (s, k, e, m) by start, then kind; null texts are empty.

    Rows stay one to one, repeated ones and those without a doc_id too. Further columns are not read; `carry` adds each
    whole row as the struct `carried`.
    """
    also = [F.struct(*docs.columns).alias("carried")] if carry else []
    df = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *also)
    text = F.col("text")
    joined = lambda p: F.regexp_replace(F.translate(text, JOINT, "\x02"), p, JOINT)
    local = f"A-Za-z0-9._%+{JOINT}-"
    email = rf"(?:\G|(?<![{local}]))[{local}]++@[A-Za-z0-9-]++{JOINT}[A-Za-z0-9{JOINT}-]++"
    df = _spans(df, "email", F.when(text.contains("@"), joined(r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])")).otherwise(""), email, text.contains("@"), 0)
    digit = text.rlike("[0-9]")
    df = df.withColumn("_digit", digit)
    df = _spans(df, "ip", text, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", F.col("_digit"), 1)
    part = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
    df = df.withColumn("ip", F.expr(f"filter(ip, x -> x.m rlike r'^{part}[.]{part}[.]{part}[.]{part}$')"))
    long_run = F.when(F.col("_digit"), text.rlike("[0-9](?:[ -]?[0-9]){11}")).otherwise(False)
    df = df.withColumn("_run", long_run)
    df = _spans(df, "card", F.when(F.col("_run"), joined("(?<=[0-9])[ -](?=[0-9])")).otherwise(""), f"[0-9][0-9{JOINT}]++", F.col("_run"), 2)
    df = df.withColumn("card", F.expr(f"filter(filter(transform(card, x -> struct(x.s as s, x.k as k, x.e as e, replace(x.m, '{JOINT}', '') as m)), x -> length(x.m) between 12 and 19), x -> {_luhn('x.m')})"))
    df = _spans(df, "phone", text, r"\+[0-9][ ().0-9-]+[0-9]", text.contains("+"), 3)
    df = df.withColumn("phone", F.expr("filter(phone, x -> length(regexp_replace(x.m, '[^0-9]', '')) between 9 and 15)"))
    df = df.withColumn("base", F.array_sort(F.concat("email", "ip", "card", "phone")))
    for i, (kind, pattern, gate) in enumerate(GENERATORS):
        df = _spans(df, f"c_{kind}", text, pattern, (text.contains("at") & text.rlike(gate)) if kind == "spelt_email" else _any_of(F.lower(text), gate) if kind == "password" else F.col("_digit") & text.rlike(gate), len(BASE) + i)
    trees, threshold = model()
    score = " + ".join(_tree_sql(t, [f"f[{j}]" for j in range(len(FEATURES))]) for t in trees)
    vector = ", ".join(f"cast({x} as double)" for x in _features("x.k", "x.m", "b"))
    df = df.withColumn("_all", F.concat(*(f"c_{g[0]}" for g in GENERATORS)))
    seen = f"transform(_all, x -> struct(x as x, substr(text, greatest(x.s - {CONTEXT}, 0) + 1, x.s - greatest(x.s - {CONTEXT}, 0)) as b))"
    vectors = f"transform({seen}, y -> struct(y.x as x, array({vector.replace('x.', 'y.x.').replace('(b rlike', '(y.b rlike')}) as f))"
    df = df.withColumn("_scored", F.when(F.size("_all") > 0, F.expr(f"transform({vectors}, z -> struct(z.x as x, {score.replace('f[', 'z.f[')} as p))")))
    df = df.withColumn("_picked", F.expr(f"filter(_scored, a -> a.p >= double('{threshold!r}') and not exists(base, b -> a.x.s < b.e and b.s < a.x.e))"))
    extra = F.coalesce(F.expr(f"array_sort(transform(if(size(_picked) > 1, {_likeliest('_picked')}, _picked), a -> a.x))"), F.array().cast(SPAN))
    return df.select("doc_id", "text", "base", extra.alias("extra"), *(["carried"] if carry else []))


def _joined(spans: str) -> Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({spans}, x -> concat(array({names})[x.k], ':', x.s, ':', x.e)), ',')")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(base, x -> x.k = {i})) as long)").alias(f"n_{k}") for i, k in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("array_sort(concat(base, extra))").alias("spans"), (F.size("base") + F.size("extra")).cast("long").alias("n_spans"))


def redact_text() -> Column:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    names = ", ".join(f"'[{k.upper()}]'" for k in KINDS)
    step = f"""if(x.s >= acc.at, struct(x.e as at, concat(acc.parts, array(substr(text, acc.at + 1, x.s - acc.at), array({names})[x.k])) as parts),
                  struct(greatest(acc.at, x.e) as at, acc.parts as parts))"""
    whole = f"aggregate(array_sort(concat(base, extra)), struct(0 as at, cast(array() as array<string>) as parts), (acc, x) -> {step}, acc -> concat(array_join(acc.parts, ''), substr(text, acc.at + 1)))"
    return F.when(F.size("base") + F.size("extra") > 0, F.expr(whole)).otherwise(F.col("text"))


def redact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage: all documents, personal data replaced in their texts and n_chars counted anew; a null text stays null."""
    text = F.when(F.col("carried.text").isNotNull(), redact_text())
    new = {"text": text} | ({"n_chars": F.coalesce(F.length(text), F.col("carried.n_chars")).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return find(docs, carry=True).select(*(new.get(c, F.col("carried").getField(c)).alias(c) for c in docs.columns))


QUERIES = {"op3_pii": op3_pii}
ORACLES: dict[str, str] = {}
