"""Shards of nearly equal bytes by sampled splitters.

Every record has a 64-bit key: 40 bits of its text's hash, then 24 bits of a hash of its id and place in the table.
Equal texts thus lie side by side, and a text with very many copies, also without ids, still has 2**24 places to be cut at.

1. Keys are sampled in proportion to size: a record of s bytes is drawn s / step times, fractions by hash.
   The sorted sample's quantiles are the splitters of many more ranges than shards.
2. Ranges are measured. An overfull one is subdivided by a denser sample of its own, until every range
   fits or holds one key only.
3. Consecutive ranges are dealt to shards by the middle of their bytes, so a shard differs from the
   mean by about one range. Slots number a shard's records: the records of its earlier ranges, then the
   place inside the range. No window is larger than a range.

Only DataFrame functions are used; the splitters, a fixed number per shard, are all the driver sees.

Defined cases: a null text has no bytes and counts as empty; a record is its bytes plus 8; rows without
an id take part with a key of their own; rows that are equal in id and text share their key and lie side
by side; extra columns are ignored here; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

SHARDS = 24
#: Ranges per shard, and samples per range.
RANGES, SAMPLES = 128, 12
TEXT_BITS = 40


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, key) of every record. Store it before use: a key holds the row's place in its partition."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"))
    place = F.shiftrightunsigned(F.xxhash64("id", F.monotonically_increasing_id()), TEXT_BITS)
    return rows.select(
        "id",
        (F.octet_length("text") + 8).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"),
        F.shiftleft(F.shiftrightunsigned(F.xxhash64("text"), 64 - TEXT_BITS), 64 - TEXT_BITS).bitwiseOR(place).alias("key"),
    )


def range_of(key: Column, splitters: list[int]) -> Column:
    """How many of the ascending splitters are at most ``key``, by binary search."""
    width = 1 << max(len(splitters), 1).bit_length()
    padded = F.lit(splitters + [(1 << 63) - 1] * (width - len(splitters))).cast("array<bigint>")
    steps, step = [], width // 2
    while step:
        steps.append(step)
        step //= 2
    # The key travels in the accumulator: the optimizer overlooks columns that only a lambda mentions.
    def move(state: Column, step: Column) -> Column:
        ahead = state["low"] + step
        return F.struct(F.when(F.element_at(padded, ahead) <= state["key"], ahead).otherwise(state["low"]).alias("low"), state["key"].alias("key"))

    start = F.struct(F.lit(0).alias("low"), key.cast("long").alias("key"))
    return F.aggregate(F.lit(steps).cast("array<int>"), start, move)["low"]


def _draws(size: Column, step: float, seed: int) -> Column:
    u = F.shiftrightunsigned(F.xxhash64("key", "id", F.lit(seed)), 11) / float(1 << 53)
    return F.floor(size / step + u).cast("int")


def splitters(records: DataFrame, ranges: int, total: int) -> list[int]:
    """Size-weighted quantiles of sampled keys, subdivided where the ranges they cut are overfull."""
    goal = total / ranges
    drawn = records.withColumn("draws", _draws(F.col("size"), goal / SAMPLES, 0)).filter("draws > 0")
    sample = sorted(k for k, d in drawn.select("key", "draws").toPandas().itertuples(index=False) for _ in range(d))
    cuts = sorted(set(sample[SAMPLES // 2 :: SAMPLES]))
    for seed in count(1):
        numbered = records.withColumn("range", range_of(F.col("key"), cuts))
        full = (
            numbered.groupBy("range")
            .agg(F.sum("size").alias("bytes"), F.min("key").alias("low"), F.max("key").alias("high"))
            .filter((F.col("bytes") > 2 * goal) & (F.col("low") < F.col("high")))
        )
        inside = numbered.join(full, "range").withColumn("draws", _draws(F.col("size"), goal / SAMPLES, seed)).filter("draws > 0")
        more: dict[int, list[int]] = {}
        for r, k, d in inside.select("range", "key", "draws").toPandas().itertuples(index=False):
            more.setdefault(r, []).extend([k] * d)
        added = {k for keys in more.values() for k in sorted(keys)[SAMPLES // 2 :: SAMPLES]} - set(cuts)
        if not added:
            break
        cuts = sorted({*cuts, *added})
    return cuts


def sharded(records: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Adds ``shard`` from 0 to ``shards`` - 1 and ``slot``, gapless from 0 in every shard."""
    total = records.agg(F.sum("size")).first()[0] or 0
    if not total:
        return records.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")}).limit(0)
    cuts = splitters(records, shards * RANGES, total)
    numbered = records.withColumn("range", range_of(F.col("key"), cuts))
    # A row per range, so at most a fixed number per shard: the windows over them are small.
    ranges = numbered.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = F.coalesce(F.sum("bytes").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    middle = (before + F.col("bytes") / 2) * shards / F.lit(total)
    dealt = ranges.withColumn("shard", F.least(F.floor(middle), F.lit(shards - 1)).cast("int"))
    earlier = F.sum("rows").over(Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    dealt = stored(dealt.withColumn("base", F.coalesce(earlier, F.lit(0))).select("range", "shard", "base"), "ranges")
    place = F.row_number().over(Window.partitionBy("range").orderBy("key", "id"))
    return numbered.withColumn("place", place).join(F.broadcast(dealt), "range").withColumn("slot", F.col("base") + F.col("place") - 1).drop("range", "place", "base")


def written(docs: DataFrame, assigned: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write the rows of ``docs`` below ``path``, a folder per shard, each in slot order.

    ``assigned``: (id, shard, slot), one row per document. A shard is cut into files by slot ranges.
    """
    rows = docs.join(assigned.select(F.col("id").alias(id_col), "shard", "slot"), id_col)
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
