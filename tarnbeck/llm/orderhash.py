"""Order MinHash fingerprints in Spark SQL functions only.

A text's words are hashed, k of them in a row make a k-mer, and repeats of a k-mer are told apart by their occurrence
number. Each (k-mer, number) gets one hash, whose top bits deal it to one of BINS bins (one permutation); of each bin the
DEPTH smallest are kept, put back in the order of the text, and hashed as a tuple. Moving text about changes tuples, as
edits do, though the set of k-mers stays. Likeness of two fingerprints: the share of equal tuples among bins that are
filled in either. Equal texts have equal fingerprints; two texts without words are alike (1).

All is done within a row over arrays of longs that pack a hash above a position, so sorting an array groups equal
k-mers in text order, and a bin's smallest are neighbours. Nothing is exploded or shuffled but two halves of a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnbeck.llm.common import materialise, table

K = 3
BINS = 64
DEPTH = 2
#: Bits of a packed long for the position; the rest, with the sign bit clear, is hash.
PLACE = 26
HASH = 63 - PLACE


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds `name`: BINS tuples of four hex digits, or four dots for an empty bin. The text must not be null.

    Words are what white space parts; a text of fewer than K words is one k-mer, one without words has only dots.
    """
    low = (1 << PLACE) - 1
    df = df.withColumn("_w", F.expr(f"filter(split({text}, r'[\\x20\\x09-\\x0D]+', -1), w -> w != '')"))
    df = df.withColumn("_h", F.expr("transform(_w, w -> xxhash64(w))")).drop("_w")
    kmer = ", ".join(f"_h[i + {j}]" for j in range(K))
    pack = f"shiftleft(shiftrightunsigned({{}}, {64 - HASH}), {PLACE}) | {{}}"
    several = f"transform(sequence(0, size(_h) - {K}), i -> {pack.format(f'xxhash64({kmer})', 'i')})"
    df = df.withColumn("_s", F.expr(f"if(size(_h) >= {K}, sort_array({several}), if(size(_h) > 0, array({pack.format('xxhash64(_h)', '0L')}), cast(array() as array<bigint>)))")).drop("_h")
    # Where a run of equal k-mers begins; most runs are of one, which has the number 0.
    df = df.withColumn("_r", F.expr(f"filter(sequence(0, size(_s)), i -> i = size(_s) or i = 0 or shiftright(_s[i], {PLACE}) != shiftright(_s[i - 1], {PLACE}))"))
    value = pack.format(f"xxhash64(shiftright(_s[j], {PLACE}), {{}})", f"(_s[j] & {low}L)")
    run = f"if(_r[i + 1] = j + 1, array({value.format('0')}), transform(sequence(j, _r[i + 1] - 1), n -> {value.format('n - j').replace('_s[j] &', '_s[n] &')}))"
    run = run.replace("_s[j]", "_s[_r[i]]").replace("= j + 1", "= _r[i] + 1").replace("sequence(j,", "sequence(_r[i],").replace("n - j", "n - _r[i]")
    df = df.withColumn("_v", F.expr(f"if(size(_s) > 0, sort_array(flatten(transform(sequence(0, size(_r) - 2), i -> {run}))), _s)")).drop("_s", "_r")
    top = 63 - (BINS - 1).bit_length()
    df = df.withColumn("_p", F.expr(f"filter(_v, (x, i) -> i < {DEPTH} or shiftright(x, {top}) != shiftright(_v[i - {DEPTH}], {top}))")).drop("_v")
    place = f"x -> struct(x & {low}L as at, x as x)"
    tuples = f"transform(sequence(0, {BINS - 1}), b -> transform(array_sort(transform(filter(_p, x -> shiftright(x, {top}) = b), {place})), y -> shiftright(y.x, {PLACE})))"
    return df.withColumn(name, F.expr(f"if(size(_p) = 0, '{'....' * BINS}', array_join(transform({tuples}, t -> if(size(t) = 0, '....', lower(lpad(hex(xxhash64(t) & 65535L), 4, '0')))), ''))")).drop("_p")


def likeness(a: str, b: str) -> Column:
    """Of two columns of fingerprints; null if either is."""
    at = lambda c: f"substr({c}, i * 4 + 1, 4)"
    bins = f"filter(sequence(0, {BINS - 1}), i -> {at(a)} != '....' or {at(b)} != '....')"
    return F.expr(f"case when {a} = {b} then 1D when {a} is null or {b} is null then null else size(filter({bins}, i -> {at(a)} = {at(b)})) / cast(size({bins}) as double) end")


def following(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id): each distinct id's next in ascending order; after the last comes the first.

    Ids are dealt into ranges, and only each range's least id meets those of other ranges, so no task sees all ids.
    """
    ranged = materialise(ids.where("doc_id IS NOT NULL").select("doc_id").distinct().repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()), "ranges")
    least = ranged.groupBy("part").agg(F.min("doc_id").alias("least"))
    # One row a partition: a window over all of them is small.
    beyond = least.select(F.col("part").alias("p"), F.coalesce(F.lead("least").over(Window.orderBy("part")), F.min("least").over(Window.partitionBy())).alias("beyond"))
    inner = ranged.withColumn("next_id", F.lead("doc_id").over(Window.partitionBy("part").orderBy("doc_id")))
    return inner.join(F.broadcast(beyond), F.col("part") == F.col("p")).select("doc_id", F.coalesce("next_id", "beyond").alias("next_id"))


def _texts(docs: DataFrame) -> DataFrame:
    # A needless cast would leave an alias on one side of a self-join alone, and the two sides' exchanges would differ.
    doc_id = F.col("doc_id") if dict(docs.dtypes)["doc_id"] == "bigint" else F.col("doc_id").cast("long").alias("doc_id")
    return docs.select(doc_id, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def sign(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, key, fingerprint) of each row's whole text; null is empty. key is a hash of the text. Further columns are not read."""
    return with_fingerprint(_texts(docs), "text", "fingerprint").select("doc_id", F.length("text").cast("long").alias("n_chars"), F.xxhash64("text").alias("key"), "fingerprint")


def edited(docs: DataFrame, signed: DataFrame) -> DataFrame:
    """(doc_id, key, next_id, next_key, edited): each text with its last floor(n/2) code points replaced by as many of the next document's first, or all it has.

    Of rows that share a doc_id the least text stands for the document that follows another. A row without a doc_id has
    no next and keeps its first half. The texts are dealt by doc_id once, for both sides; of the following texts only
    what is needed goes on to the rows before them.
    """
    texts = _texts(docs)
    dealt = texts.where("doc_id IS NOT NULL").repartition("doc_id")
    need = signed.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.expr("max(n_chars) div 2").alias("need"))
    before = following(signed).join(need, "doc_id").select(F.col("doc_id").alias("prev_id"), F.col("next_id").alias("of"), "need")
    tails = dealt.groupBy("doc_id").agg(F.min("text").alias("text")).join(before, F.col("doc_id") == F.col("of"))
    tails = tails.select("prev_id", F.col("doc_id").alias("next_id"), F.expr("substring(text, 1, cast(need as int))").alias("tail"), F.xxhash64("text").alias("next_key"))
    both = dealt.join(tails, F.col("doc_id") == F.col("prev_id"), "left")
    lone = texts.where("doc_id IS NULL").select("*", F.lit(None).cast("long").alias("prev_id"), F.lit(None).cast("long").alias("next_id"), F.lit("").alias("tail"), F.lit(None).cast("long").alias("next_key"))
    text = F.expr("concat(substring(text, 1, length(text) - length(text) div 2), substring(coalesce(tail, ''), 1, length(text) div 2))".replace("length(text) div 2", "cast(length(text) div 2 as int)"))
    return both.unionByName(lone).select("doc_id", F.xxhash64("text").alias("key"), "next_id", "next_key", text.alias("edited"))


def compare(docs: DataFrame) -> DataFrame:
    """One row per row of docs: its fingerprint beside those of its edited text and of the next document."""
    signed = materialise(sign(docs), "signed")
    changed = with_fingerprint(edited(docs, signed), "edited", "edited_fingerprint")
    changed = changed.select("doc_id", "key", "next_id", "next_key", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), "edited_fingerprint")
    one = signed.dropDuplicates(["doc_id", "key"])
    mine = one.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "n_chars", "fingerprint")
    after = one.select(F.col("doc_id").alias("_of"), F.col("key").alias("_as"), F.col("fingerprint").alias("next_fingerprint"))
    found = changed.join(mine, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))).join(after, (F.col("next_id") == F.col("_of")) & (F.col("next_key") == F.col("_as")), "left")
    return found.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness("fingerprint", "edited_fingerprint").alias("near_edited"), F.coalesce(likeness("fingerprint", "next_fingerprint"), F.lit(0.0)).alias("near_next"))


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare(table(spark, sf_dir, "documents"))


QUERIES = {"op10_order_minhash": op10_order_minhash}
ORACLES: dict[str, str] = {}
