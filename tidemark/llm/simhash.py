"""Document fingerprints by SimHash, and all fingerprints within a Hamming radius by permuted block tables.

Terms are pairs of neighbouring words (a lone word is a term); a term's weight is 1 plus one for each of
its words of six bytes or more, and a repeated term votes again. Every term votes with the signs of the
128 bits of its hash, and a bit of the fingerprint is set where the weighted votes for it are more than
half. Votes are summed packed: a long holds four 16-bit counters, so 32 sums count 128 bits, over at most
CHUNK terms; the chunks of a long text are added afterwards. Sums are partial before the shuffle.

Search: a fingerprint is cut into radius + 1 blocks, so two within the radius agree on one block at least.
A table per block, keyed by block number and value, yields candidates, and the whole distance decides.
Equal fingerprints are one entry with their number.

Only DataFrame functions are used. Defined cases: null and empty texts have no terms and the fingerprint
of zeros; equal texts have equal fingerprints; rows without an id are left out; rows sharing an id are
fingerprinted each; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, parts, stored
from tidemark.llm.sharding import range_of

BITS = 128
CHUNK = 8192  # times the largest weight, 3, is below 2**15: the top counter holds the sign, and sums that overflow end the job
LONG_WORD = 6
LANES = 0x0001000100010001


def _terms(text: Column) -> Column:
    """Hashes of a text's terms with the weight in the two lowest bits."""
    bare = F.btrim(text, F.lit("\t\n\x0b\x0c\r "))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[\\x20\\x09-\\x0D]+"))
    return F.transform(words, lambda w: F.xxhash64(w).bitwiseAND(-2).bitwiseOR((F.octet_length(w) >= LONG_WORD).cast("long")))


def _pairs(words: str) -> Column:
    def pair(i: Column) -> Column:
        a, b = F.get(words, i), F.get(words, i + 1)
        return F.xxhash64(a, b).bitwiseAND(-4).bitwiseOR(a.bitwiseAND(1) + b.bitwiseAND(1) + 1)

    lone = F.transform(words, lambda a: F.xxhash64(a).bitwiseAND(-4).bitwiseOR(a.bitwiseAND(1) + 1))
    return F.when(F.size(words) > 1, F.transform(F.sequence(F.lit(0), F.size(words) - 2), pair)).otherwise(lone)


def fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, f1, f2): the 128-bit fingerprint of ``text`` as two longs."""
    # explode_outer: an explode would push a filter on the term array below the projections.
    words = texts.select(*keys, _terms(F.col("text")).alias("_w"))
    terms = words.select(*keys, _pairs("_w").alias("_t")).select(*keys, F.posexplode_outer("_t").alias("_at", "_term"))
    chunk = F.floor(F.coalesce("_at", F.lit(0)) / CHUNK).cast("int").alias("_chunk")
    weighed = terms.select(
        *keys,
        chunk,
        F.coalesce(F.col("_term").bitwiseAND(3), F.lit(0)).alias("_weight"),
        F.coalesce(F.xxhash64("_term", F.lit(1)), F.lit(0)).alias("_h1"),
        F.coalesce(F.xxhash64("_term", F.lit(2)), F.lit(0)).alias("_h2"),
    )
    lanes = [
        F.sum(F.shiftrightunsigned(h, k).bitwiseAND(LANES) * F.col("_weight")).alias(f"{h}_{k}") for h in ("_h1", "_h2") for k in range(16)
    ]
    chunks = weighed.groupBy(*keys, "_chunk").agg(*lanes, F.sum("_weight").alias("_total"))
    packed = F.array(*[F.col(f"{h}_{k}") for h in ("_h1", "_h2") for k in range(16)])
    whole = chunks.groupBy(*keys).agg(F.collect_list(packed).alias("_lanes"), F.sum("_total").alias("_total"))

    def votes(lane: int, counter: int) -> Column:
        def add(total: Column, lanes: Column) -> Column:
            return total + F.shiftrightunsigned(F.get(lanes, F.lit(lane)), 16 * counter).bitwiseAND(0xFFFF)

        return F.aggregate("_lanes", F.lit(0).cast("long"), add)

    def half(first: int) -> Column:
        out = F.lit(0).cast("long")
        for k in range(16):
            for j in range(4):
                bit = F.shiftleft(F.lit(1).cast("long"), 16 * j + k)
                out = out.bitwiseOR(F.when(votes(first + k, j) * 2 > F.col("_total"), bit).otherwise(0))
        return out

    return whole.select(*keys, half(0).alias("f1"), half(16).alias("f2"))


def written_out(f1: str, f2: str) -> Column:
    """A fingerprint as 32 lower-case hexadecimal digits."""
    return F.lower(F.concat(F.lpad(F.hex(f1), 16, "0"), F.lpad(F.hex(f2), 16, "0")))


def likeness(f1: str, f2: str, g1: str, g2: str) -> Column:
    differ = F.bit_count(F.col(f1).bitwiseXOR(F.col(g1))) + F.bit_count(F.col(f2).bitwiseXOR(F.col(g2)))
    return 1 - differ.cast("double") / BITS


def _blocks(radius: int) -> Column:
    """The blocks of a fingerprint as (number, value); radius + 1 blocks of whole bits."""
    many = radius + 1
    if BITS % many or (BITS // 2) % (BITS // many):
        raise ValueError("the radius plus one must be a power of two up to 64, and two at least")
    width = BITS // many
    out = []
    for b in range(many):
        source, shift = ("f1", b * width) if b * width < 64 else ("f2", b * width - 64)
        value = F.shiftrightunsigned(source, shift)
        out.append(F.struct(F.lit(b).alias("number"), (value.bitwiseAND((1 << width) - 1) if width < 64 else value).alias("value")))
    return F.array(*out)


def within(queries: DataFrame, prints: DataFrame, radius: int = 3) -> DataFrame:
    """(q1, q2, n_near): for each distinct query fingerprint how many rows of ``prints`` lie within the radius."""
    table = prints.groupBy("f1", "f2").agg(F.count("*").alias("n")).select("f1", "f2", "n", F.explode(_blocks(radius)).alias("b"))
    asked = queries.select("f1", "f2").distinct().select(F.col("f1").alias("q1"), F.col("f2").alias("q2"), F.explode(_blocks(radius)).alias("b"))
    near = (BITS * (1 - likeness("f1", "f2", "q1", "q2"))) <= radius
    pairs = asked.join(table, "b").filter(near).select("q1", "q2", "f1", "f2", "n").distinct()
    return pairs.groupBy("q1", "q2").agg(F.sum("n").alias("n_near"))


def _in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(rid, next_rid, id, text, next_text): rows in id order, each with its successor, the last with the first.

    Ids are cut into ranges at quantiles; a window never sees more than a range, and what follows the
    last row of a range is the first row of the next one: one row per range.
    """
    spark = docs.sparkSession
    texts = id_and_text(docs, id_col, text_col)
    many = 8 * parts(spark)
    cuts = texts.agg(F.percentile_approx("id", [i / many for i in range(1, many)], 20 * many)).first()[0] or []
    ranged = texts.withColumn("range", range_of(F.col("id"), sorted(set(cuts))))
    order = Window.partitionBy("range").orderBy("id", F.xxhash64("text"))
    rid = F.shiftleft(F.col("range").cast("long"), 40) + F.row_number().over(order)
    rows = ranged.withColumns({"rid": rid, "next_text": F.lead("text").over(order)})
    ranges = stored(texts.select("id", range_of(F.col("id"), sorted(set(cuts))).alias("range")).groupBy("range").agg(F.min("id").alias("id")), "ranges")
    after = F.lead("range").over(Window.orderBy("range"))  # as many rows as ranges
    chain = ranges.select("range", F.coalesce(after, F.min("range").over(Window.partitionBy())).alias("follows"))
    heads = (
        texts.join(F.broadcast(ranges.withColumnRenamed("range", "follows")), "id")
        .groupBy("follows")
        .agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("head"))
    )
    heads = stored(chain.join(heads, "follows").select("range", "follows", "head"), "heads")
    last = F.col("next_text").isNull()
    return rows.join(heads, "range", "left").select(
        "rid",
        F.when(last, F.shiftleft(F.col("follows").cast("long"), 40) + 1).otherwise(F.col("rid") + 1).alias("next_rid"),
        "id",
        "text",
        F.coalesce("next_text", "head").alias("next_text"),
    )


def edited_and_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and their likenesses.

    Edited: the last half of the code points replaced by as many first ones of the next document.
    ``n_near``: for ids divisible by 50 the number of documents within the radius, itself included.
    """
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    rows = _in_order(docs, id_col, text_col).select("rid", "next_rid", "id", "text", edited.alias("edited"))
    # what the result needs of the texts goes along with the terms, so the texts are put in order once
    facts = {"n_chars": F.length("text").cast("long"), "sha": F.unhex(F.sha2("edited", 256))}
    both = rows.withColumns(facts).select(
        "rid",
        *("next_rid", "id", *facts),
        F.explode(F.array(F.struct(F.lit(0).alias("kind"), "text"), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))).alias("v"),
    )
    keys = ["rid", "kind", "next_rid", "id", *facts]
    prints = stored(fingerprints(both.select(*[f"v.{k}" if k == "kind" else k for k in keys], "v.text"), keys), "fingerprints")
    own = prints.filter("kind = 0").select("rid", "f1", "f2")
    other = prints.filter("kind = 1").select("rid", F.col("f1").alias("e1"), F.col("f2").alias("e2"))
    following = own.toDF("next_rid", "n1", "n2")
    base = prints.filter("kind = 0").drop("kind").withColumn("edited_sha256", F.lower(F.hex("sha"))).drop("sha")
    done = stored(base.join(other, "rid"), "edited")
    asked = done.filter("id % 50 = 0")
    near = within(asked, own, radius)
    return (
        done.join(following, "next_rid")
        .join(near, (F.col("f1") == F.col("q1")) & (F.col("f2") == F.col("q2")) & (F.col("id") % 50 == 0), "left")
        .select(
            F.col("id").alias("doc_id"),
            "n_chars",
            "edited_sha256",
            written_out("f1", "f2").alias("fingerprint"),
            written_out("e1", "e2").alias("edited_fingerprint"),
            likeness("f1", "f2", "e1", "e2").alias("near_edited"),
            likeness("f1", "f2", "n1", "n2").alias("near_next"),
            "n_near",
        )
    )
