"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingles.

A short item inside a long document has a tiny Jaccard similarity to it, so neither side is compared
whole. Items are partitioned by the number of their shingles, in steps of four. Items of up to
``SMALLEST_BLOCK / 2`` shingles keep every shingle: an item that reaches the threshold misses so few that
one of any ``n - ceil(threshold * n) + 1`` of its shingles lies in the document, so it is a candidate of
every document that holds one of that many, and none is missed. For each partition of larger items the
documents' shingles are cut into blocks twice as long as the partition's largest item. A block's
one-permutation MinHash keeps the smallest hash in each of as many bins as the block is long. An item
becomes a candidate of a document if one bin of one block holds the item's own minimum: a shingle of
the item that lies in the document is the minimum of its bin with a chance of about 0.63, and any one
suffices. The smallest of these items has 33 shingles, 25 of them shared at the threshold of 0.75, and is
missed with a chance of about 0.37^25, two in 10^11; larger ones less. Candidates are verified exactly:
shared distinct shingles over the item's distinct shingles.

Blocks, minima and the join all stay inside the scan of the documents; nothing of them is shuffled as
long as the items' minima, counted before, are few enough to broadcast. Beyond that the join shuffles.

Only DataFrame functions are used. Shingles are 64-bit hashes of five words; words are lower-cased and
end at a space or at a tab to a carriage return.

Defined cases: null and empty texts have no shingles and match nothing; fewer than five words are one
shingle, which only an equally short text can hold; rows without an id match nothing; rows sharing an
id count as the one that holds most; repeated items match each; extra columns are ignored; empty tables
give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, id_and_text, stored

SMALLEST_BLOCK = 64


def with_shingles(texts: DataFrame, k: int = 5) -> DataFrame:
    """Adds ``grams``, the hashes of a text's k-word shingles in order, and keeps the other columns."""
    white = "\t\n\x0b\x0c\r "
    bare = F.btrim(F.lower("text"), F.lit(white))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[\\x20\\x09-\\x0D]+"))
    hashed = texts.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))

    def gram(i: Column) -> Column:
        return F.xxhash64(*[F.get("_h", i + j) for j in range(k)])

    return hashed.withColumn(
        "grams",
        F.when(F.size("_h") >= k, F.transform(F.sequence(F.lit(0), F.size("_h") - k), gram))
        .when(F.size("_h") > 0, F.array(F.xxhash64("_h")))
        .otherwise(F.array().cast("array<bigint>")),
    ).drop("_h")


def _minima(shingled: DataFrame, block: int) -> DataFrame:
    """The minima of all blocks of a text as ``low``: (id, low). A bin is a hash's leading bits."""
    shift = 64 - (block.bit_length() - 1)
    # No filter on the arrays here, nor an explode that implies one: pushed below the projections it would
    # evaluate the word hashes once per shingle.
    cut = shingled.withColumn(
        "_blocks",
        F.transform(
            F.sequence(F.lit(0), F.floor(F.greatest(F.size("grams") - 1, F.lit(0)) / block).cast("int")),
            lambda b: F.sort_array(F.slice("grams", b * block + 1, F.lit(block))),
        ),
    )
    first = F.transform(
        "_blocks",
        lambda s: F.filter(s, lambda x, i: (i == 0) | (F.shiftright(x, shift) != F.shiftright(F.get(s, i - 1), shift))),
    )
    return cut.select("id", F.explode_outer(F.flatten(first)).alias("low"))


def _every(shingled: DataFrame) -> DataFrame:
    """All shingles of a text as ``low``: (id, low)."""
    return shingled.select("id", F.explode_outer("grams").alias("low"))


def _sure(items: DataFrame, threshold: float) -> DataFrame:
    """So many shingles of an item as ``low`` that every text reaching the threshold holds one: (id, low)."""
    n = F.size("grams")
    enough = F.greatest(F.lit(1), n - F.ceil(F.lit(threshold) * n).cast("int") + 1)
    return items.select("id", F.explode(F.slice(F.sort_array("grams"), F.lit(1), enough)).alias("low"))


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = 0.75,
) -> DataFrame:
    """(doc id, item id, shared, n_shingles, containment) of every pair that reaches the threshold."""
    texts = id_and_text(docs, id_col, text_col)
    wanted = stored(
        with_shingles(id_and_text(items, item_id_col, item_text_col))
        .select("id", F.array_distinct("grams").alias("grams")),
        "items",
    ).filter(F.size("grams") > 0)
    wanted = wanted.withColumn("size_class", F.greatest(F.lit(0), F.ceil(F.log2(F.size("grams") / (SMALLEST_BLOCK // 2)) / 2)).cast("int"))
    classes = sorted(r[0] for r in wanted.select("size_class").distinct().collect())  # one per factor of four
    shingled = with_shingles(texts).select("id", "grams")
    found = None
    for c in classes:
        block = SMALLEST_BLOCK * 4**c
        own = wanted.filter(F.col("size_class") == c)
        low = broadcast_if_small(stored((_minima(own, block) if c else _sure(own, threshold)).withColumnRenamed("id", "item"), "minima"))
        pairs = (_minima(shingled, block) if c else _every(shingled)).join(low, "low").select("id", "item")
        found = pairs if found is None else found.union(pairs)
    if found is None:
        found = wanted.select("id", F.col("id").alias("item")).limit(0)
    found = stored(found.distinct(), "candidates")
    some = broadcast_if_small(stored(found.select("id").distinct(), "candidate-ids"))
    held = with_shingles(texts.join(some, "id")).select("id", F.array_distinct("grams").alias("grams"))
    target = wanted.select(F.col("id").alias("item"), F.col("grams").alias("item_grams"))
    return (
        held.join(found, "id")
        .join(target, "item")
        .select("id", "item", F.size(F.array_intersect("grams", "item_grams")).cast("long").alias("shared"), F.size("item_grams").cast("long").alias("n"))
        .groupBy("id", "item", "n")
        .agg(F.max("shared").alias("shared"))
        .filter(F.col("shared") >= threshold * F.col("n"))
        .select(
            F.col("id").alias("doc_id"),
            F.col("item").alias("item_id"),
            "shared",
            F.col("n").alias("n_shingles"),
            (F.col("shared") / F.col("n")).alias("containment"),
        )
    )
