"""Token sequences in training order, in binary shards of fixed stride.

A text is a run of token ids of ``width`` bytes, little-endian: either an ids column (``width`` 2 or 4, as the BPE
encoder makes them), or the UTF-8 bytes of the text itself (``width`` 1; ids 0 to 253, of which 254 and 255 never
occur). One id ends a text and another fills its last sequence; they are the two largest of the width. A sequence is
``length`` ids and belongs to one text.

Every sequence has an index without gaps: texts are dealt to buckets by hash, and a running sum inside a bucket plus
the sum of earlier buckets numbers them; only ids and counts are shuffled for that. Rows that are equal in id and text
are told apart by their ordinal, so each has sequences of its own. A keyed Feistel network over the smallest domain of
whole bits that holds the indexes, walked until it falls inside, permutes them: the slot. Another key is another epoch.
Sequences are range-partitioned by slot, those of a task and a range compressed together on the way, and written in order, one row per sequence and a line feed after it, by Spark's
text writer and its committer, below a folder per shard. Slot s is row s mod per shard of shard s div per shard, and a
reader begins at any slot: shards before it are not read, rows before it in its shard are skipped by their offset.

Defined cases: null and empty texts are one sequence of the end mark; equal rows are written each; rows without an id
take part; extra columns are ignored; an empty table writes an empty folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import BROADCAST_ROWS, parts, stored
from tidemark.session import scratch_path

LENGTH = 512
SHARD_BYTES = 8 << 20
ROUNDS = 6
WALKS = 64
#: Bytes of sequences that a task packs at once on their way to the shards.
PACK_BYTES = 8 << 20


def end_mark(width: int) -> bytes:
    return b"\xff" * width


def fill_mark(width: int) -> bytes:
    return b"\xfe" + b"\xff" * (width - 1)


def per_shard(length: int, width: int, shard_bytes: int) -> int:
    """Sequences of a shard."""
    return max(1, shard_bytes // (length * width + 1))


def _signed(x: int) -> int:
    return (x + (1 << 63)) % (1 << 64) - (1 << 63)


def permuted(index: Column, n: int, key: int) -> Column:
    """A keyed permutation of 0 to ``n`` - 1: a Feistel network, repeated for values that leave the range.

    The domain is less than twice the range (four at least), so a value stays outside with a chance of under a half a
    walk; one that has not come in after ``WALKS`` stops the job rather than taking another's slot.
    """
    bits = max(2, (n - 1).bit_length())
    high, low = bits // 2, bits - bits // 2
    rounds = [
        F.struct(
            F.lit(_signed((key * 0x9E3779B97F4A7C15 + r) % (1 << 64))).cast("long").alias("key"),
            F.lit((1 << (low if r % 2 else high)) - 1).cast("long").alias("mask"),
        )
        for r in range(ROUNDS)  # halves change roles, so unequal widths are fine after an even number
    ]

    def network(x: Column) -> Column:
        def turn(halves: Column, r: Column) -> Column:
            mixed = halves["a"].bitwiseXOR(F.xxhash64(halves["b"], r["key"])).bitwiseAND(r["mask"])
            return F.struct(halves["b"].alias("a"), mixed.alias("b"))

        start = F.struct(F.shiftright(x, low).alias("a"), x.bitwiseAND((1 << low) - 1).alias("b"))
        return F.aggregate(F.array(*rounds), start, turn, lambda halves: F.shiftleft(halves["a"], low).bitwiseOR(halves["b"]))

    inside = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), network(index.cast("long")), lambda x, _: F.when(x < n, x).otherwise(network(x)))
    return F.coalesce(F.when(inside < n, inside), F.raise_error(F.lit("a slot did not come into its range")).cast("long"))


def _rows(docs: DataFrame, id_col: str, text_col: str, ids_col: str | None, width: int) -> DataFrame:
    """(id, h, data): the ids of each row with the end mark, and their hash."""
    ids = F.col(f"`{ids_col}`") if ids_col else F.col(f"`{text_col}`").cast("string").cast("binary")
    data = F.concat(F.coalesce(ids, F.lit(b"")), F.lit(end_mark(width)))
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), data.alias("data")).select("id", F.xxhash64("data").alias("h"), "data")


def indexed(rows: DataFrame, length: int = LENGTH, width: int = 1) -> tuple[DataFrame, int]:
    """(id, h, n_tokens, n, copies, base) of every distinct row, base the index of its first sequence; the number of sequences.

    The sequences of equal rows follow each other: copy c begins at base + c * n.
    """
    spark = rows.sparkSession
    tokens = F.octet_length("data").cast("long") / width
    some = rows.select("id", "h", tokens.cast("long").alias("n_tokens")).groupBy("id", "h", "n_tokens").agg(F.count(F.lit(1)).alias("copies"))
    buckets = 16 * parts(spark)
    numbered = some.withColumns({"n": F.ceil(F.col("n_tokens") / length), "bucket": F.pmod(F.xxhash64("id", "h"), F.lit(buckets))})
    inside = Window.partitionBy("bucket").orderBy("id", "h").rowsBetween(Window.unboundedPreceding, -1)
    local = stored(numbered.withColumn("local", F.coalesce(F.sum(F.col("n") * F.col("copies")).over(inside), F.lit(0))), "sequence-counts")
    totals = local.groupBy("bucket").agg(F.sum(F.col("n") * F.col("copies")).alias("of_bucket"))  # a row per bucket, a fixed number
    earlier = F.coalesce(F.sum("of_bucket").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = totals.withColumn("offset", earlier).select("bucket", "offset")
    total = local.agg(F.sum(F.col("n") * F.col("copies"))).first()[0] or 0
    return local.join(offsets, "bucket").select("id", "h", "n_tokens", "n", "copies", (F.col("local") + F.col("offset")).alias("base")), total


def _each_copy(texts: DataFrame) -> DataFrame:
    """A row per copy, with the index of its own first sequence."""
    copy = texts.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    return copy.withColumn("base", F.col("base") + F.col("copy") * F.col("n")).drop("copy", "copies")


def manifest(texts: DataFrame, total: int, of_shard: int, key: int, length: int = LENGTH) -> DataFrame:
    """(slot, shard, doc_id, seq_no, n_tokens) of every sequence; no text is read."""
    first = F.lit(0).cast("long")
    each = _each_copy(texts).select("id", "n_tokens", "base", F.explode(F.sequence(first, F.col("n") - 1)).alias("seq_no"))
    return each.withColumn("slot", permuted(F.col("base") + F.col("seq_no"), total, key)).select(
        "slot",
        F.floor(F.col("slot") / of_shard).alias("shard"),
        F.col("id").alias("doc_id"),
        "seq_no",
        F.least(F.lit(length), F.col("n_tokens") - F.col("seq_no") * length).cast("long").alias("n_tokens"),
    )


def packed(placed: DataFrame, stride: int, of_shard: int, shards: int, tasks: int) -> DataFrame:
    """(range, slots, packed): the sequences (slot, value) of a task, those of one range compressed together."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, held, size = pa.Codec("zstd", compression_level=3), [], 0

        def flush() -> pa.RecordBatch:
            slot = np.concatenate([x.column(0).to_numpy() for x in held])
            where = np.minimum(slot // of_shard * tasks // shards, tasks - 1)
            order = np.argsort(where, kind="stable")
            where, slot = where[order], slot[order]
            value = pa.concat_arrays([x.column(1) for x in held]).cast(pa.binary(stride)).take(pa.array(order))
            data = value.buffers()[1]
            begin = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
            cuts = list(zip(begin.tolist(), [*begin[1:].tolist(), len(where)]))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(where[begin].astype(np.int32)),
                    pa.array([slot[x:y].tobytes() for x, y in cuts], pa.binary()),
                    pa.array([codec.compress(data.slice(x * stride, (y - x) * stride), asbytes=True) for x, y in cuts], pa.binary()),
                ],
                ["range", "slots", "packed"],
            )

        for batch in stream:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows * stride
            if size >= PACK_BYTES:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return placed.mapInArrow(run, "range int, slots binary, packed binary")


def unpacked(moved: DataFrame, stride: int) -> DataFrame:
    """The sequences (slot, value) of ``packed``."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in stream:
            for slots, content in zip(batch.column(0), batch.column(1)):
                slot = np.frombuffer(slots.as_buffer(), np.int64)
                value = pa.Array.from_buffers(pa.binary(stride), len(slot), [None, codec.decompress(content.as_buffer(), len(slot) * stride)])
                yield pa.RecordBatch.from_arrays([pa.array(slot), value.cast(pa.binary())], ["slot", "value"])

    return moved.mapInArrow(run, "slot long, value binary")


def written(
    docs: DataFrame,
    path: str,
    key: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    ids_col: str | None = None,
    width: int = 1,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Write the shards below ``path`` and return their manifest."""
    spark = docs.sparkSession
    rows = _rows(docs, id_col, text_col, ids_col, width)
    texts, total = indexed(rows, length, width)
    texts = stored(texts, "sequence-index")
    of_shard = per_shard(length, width, shard_bytes)
    counts = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum("copies"), F.lit(0))).first()
    copies = _each_copy(texts).select("id", "h", "n", "base")
    small = F.broadcast(copies) if counts[1] <= BROADCAST_ROWS else copies
    if counts[1] > counts[0]:
        rows = rows.dropDuplicates(["id", "h"])
    joined = rows.join(small, rows["id"].eqNullSafe(small["id"]) & (rows["h"] == small["h"])).select("data", "n", "base")
    # the bytes are cut after the explode: a cut inside it would copy the text for every sequence
    each = joined.select("data", "base", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("j"))
    ids = F.substring("data", (F.col("j") * (length * width) + 1).cast("int"), F.lit(length * width))
    slot = permuted(F.col("base") + F.col("j"), total, key)
    placed = each.select(slot.alias("slot"), F.rpad(ids, length * width, F.lit(fill_mark(width))).alias("value"))
    # slots are dense, so equal ranges need no sample; a range is whole shards
    shards = max(1, -(-total // of_shard))
    tasks = min(shards, max(parts(spark), -(-shards // 16)))
    moved = packed(placed, length * width, of_shard, shards, tasks).repartitionById(tasks, "range").select("slots", "packed")
    rows = unpacked(moved, length * width).select(F.floor(F.col("slot") / of_shard).alias("shard"), "slot", F.col("value").cast("string").alias("value"))
    rows.sortWithinPartitions("shard", "slot").select("shard", "value").write.partitionBy("shard").text(path)
    return manifest(texts, total, of_shard, key, length)


def read_back(
    spark: SparkSession, path: str, length: int = LENGTH, start_slot: int = 0, width: int = 1, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """(slot, ids) of the sequences from ``start_slot`` on of the shards below ``path``.

    Shards before it are pruned by their folder; within its own the offset says where it begins.
    """
    of_shard, stride = per_shard(length, width, shard_bytes), length * width + 1
    files = spark.read.format("binaryFile").load(path)
    if "shard" not in files.columns:  # nothing was written
        return spark.createDataFrame([], "slot long, ids binary")
    files = files.withColumn("shard", F.col("shard").cast("long")).filter((F.col("shard") >= start_slot // of_shard) & (F.col("length") > 0)).select("shard", "content")

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = np.frombuffer(content.as_buffer(), np.uint8).reshape(-1, stride)
                first = max(0, start_slot - shard * of_shard)
                for at in range(first, len(rows), 4096):
                    part = np.ascontiguousarray(rows[at : at + 4096, :-1])
                    offsets = np.arange(len(part) + 1, dtype=np.int32) * (stride - 1)
                    ids = pa.BinaryArray.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(offsets), pa.py_buffer(part)])
                    slots = pa.array(np.arange(at, at + len(part)) + shard * of_shard)
                    yield pa.RecordBatch.from_arrays([slots, ids], ["slot", "ids"])

    return files.mapInArrow(run, "slot long, ids binary")


def materialised(docs: DataFrame, key: int = 1) -> DataFrame:
    """Write the documents in training order into the shared folder and read them back with their manifest."""
    spark = docs.sparkSession
    path = scratch_path(spark, "llm-order")
    found = written(docs, path, key)
    back = read_back(spark, path).select("slot", F.crc32("ids").alias("ids_crc32"))
    return found.join(back, "slot").select("slot", "shard", "doc_id", "seq_no", "n_tokens", "ids_crc32")
