"""Phrase collocations by dynamic itemset counting.

The texts are dealt into ``SHARDS`` shards and scanned shard after shard, round and round. Single words are
counted from the first scan on. A longer phrase starts to be counted as soon as both its subphrases, the one
without its last and the one without its first word, have been seen ``least`` times in the scans so far,
whatever shard comes next, and it is counted until it has been through every shard once. So several lengths are
counted in one scan, and a phrase that occurs often enough is counted in all shards exactly once.

Tasks learn what has been reached from a table of fixed size, ``SLOTS`` entries for each length, which holds by
hash the scan from which a phrase counts as reached. Two phrases may share a slot: then a phrase is counted that
need not be, from a scan that all tasks agree on, so every count stays exact and only work is added. The table is
the only thing that is sent to all tasks (4 x ``SLOTS`` bytes); the phrases themselves are added up by shuffles.

Phrases are named by 64-bit hashes of their two subphrases, words by a hash of their bytes and language.

Defined cases: a null text is empty, a null language is ``und``; an empty text has no words; equal rows count
each; a row without an id counts like any other; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.common import discard, stored

LONGEST = 5
SHARDS = 2
SLOTS = 1 << 22
NEVER = 255
BYTES = 2 << 20
TALLY = 600_000  # distinct phrases a task adds up before it passes them on
BUCKET = 1 << 15  # bits of one bitmap of bitmap_construct_agg

_GAP = np.zeros(256, bool)
_GAP[[9, 32]] = True
_STOP = np.zeros(256, bool)
_STOP[[10, 11, 12, 13, *b".,;:!?"]] = True
_WORD = ~(_GAP | _STOP)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = _LOWER.astype(np.uint64) + np.uint64(1)

COUNTS = "length int, since int, p long, s long, lang string, word string, n long"


def joined(p: np.ndarray, s: np.ndarray, length: int) -> np.ndarray:
    """Hash of a phrase from the hashes of its first and its last ``length`` - 1 words."""
    return tokens.mix(p * np.uint64(0xC2B2AE3D27D4EB4F) + tokens.mix(s + np.uint64(length)))


def slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(SLOTS - 1)).astype(np.int64)


class Pieces(NamedTuple):
    hashes: np.ndarray  # uint64, one per word
    begin: np.ndarray  # byte positions in the chunk
    end: np.ndarray
    text: np.ndarray  # row of each word, counted from the first of the chunk
    follows: np.ndarray  # whether the next word stands in the same piece
    data: np.ndarray  # uint8, the chunk as it is


def split(column: pa.Array, langs: np.ndarray, at: int, to: int) -> Pieces:
    """Words and pieces of the texts ``at`` to ``to`` of a column without nulls."""
    part = column.slice(at, to - at)
    width = np.int64 if pa.types.is_large_string(part.type) else np.int32
    offsets = np.frombuffer(part.buffers()[1], width)[part.offset : part.offset + len(part) + 1].astype(np.int64)
    low, high = int(offsets[0]), int(offsets[-1])
    if low == high:
        none = np.zeros(0, np.int64)
        return Pieces(none.astype(np.uint64), none, none, none, none.astype(bool), np.zeros(0, np.uint8))
    data = np.frombuffer(part.buffers()[2], np.uint8, high - low, low)
    offsets -= low
    stop = _STOP[data]
    inside = _WORD[data]
    edges = offsets[1:-1]
    edges = edges[edges < len(data)]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    starts[edges] |= inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | starts[1:]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    total = np.zeros(len(data) + 1, np.uint64)
    values = _VALUE[data]
    values *= tokens.powers(tokens.BASE, len(data))[: len(data)]
    np.cumsum(values, out=total[1:])
    text = np.searchsorted(offsets, begin, "right") - 1
    plain = (total[end] - total[begin]) * tokens.powers(tokens.INVERSE, len(data))[begin]
    hashes = tokens.mix(tokens.mix(plain + (end - begin).astype(np.uint64)) + langs[at:to][text])
    piece = np.searchsorted(np.flatnonzero(stop), begin)
    follows = np.zeros(len(begin), bool)
    follows[:-1] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
    return Pieces(hashes, begin, end, text, follows, data)


def _strings(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    size = end - begin
    offsets = np.zeros(len(size) + 1, np.int32)
    np.cumsum(size, out=offsets[1:])
    where = np.arange(int(offsets[-1])) + np.repeat(begin - offsets[:-1], size)
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(_LOWER[data[where]].tobytes()))


class Tally:
    """Numbers of phrases added up within a task, a bounded number of phrases at a time."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.words: list[tuple[pa.Array, pa.Array]] = []  # language and word, of the parts that are words
        self.size = 0

    def add(self, length: int, hashes: np.ndarray, since: np.ndarray, p: np.ndarray, s: np.ndarray, words=None) -> None:
        """Count ``hashes``; ``words`` gives language and word of those at some positions."""
        some, pick, n = np.unique(hashes, return_index=True, return_counts=True)
        if len(some):
            self.parts.append((some, np.full(len(some), length, np.int32), since[pick].astype(np.int32), p[pick], s[pick], n))
            none = pa.nulls(len(some), pa.string())
            self.words.append(words(pick) if words else (none, none))
            self.size += len(some)

    def rows(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        """What has been counted, once it is more than ``least`` distinct phrases."""
        if self.size <= least or not self.parts:
            return
        hashes, length, since, p, s, n = (np.concatenate(c) for c in zip(*self.parts))
        lang, word = (pa.concat_arrays(c) for c in zip(*self.words))
        order = np.argsort(hashes, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]]))
        pick, n = order[first], np.add.reduceat(n[order], first)
        if len(pick) <= least:
            kept = pa.array(pick)
            self.parts = [(hashes[pick], length[pick], since[pick], p[pick], s[pick], n)]
            self.words, self.size = [(lang.take(kept), word.take(kept))], len(pick)
            return
        self.clear()
        for at in range(0, len(pick), 100_000):
            some = pick[at : at + 100_000]
            columns = [pa.array(length[some]), pa.array(since[some]), pa.array(p[some].view(np.int64)), pa.array(s[some].view(np.int64))]
            columns += [lang.take(pa.array(some)), word.take(pa.array(some)), pa.array(n[at : at + 100_000].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["length", "since", "p", "s", "lang", "word", "n"])


def counted(tally: Tally, column: pa.Array, lang: pa.Array, langs: np.ndarray, at: int, to: int, reached: np.ndarray | None, step: int) -> None:
    """Add the phrases that scan ``step`` counts in the texts ``at`` to ``to``."""
    w = split(column, langs, at, to)
    hashes = w.hashes
    if step < SHARDS:
        zero = np.zeros(len(hashes), np.uint64)
        own = lang.slice(at, to - at)
        tally.add(1, hashes, zero, hashes, zero, lambda pick: (own.take(pa.array(w.text[pick])), _strings(w.data, w.begin[pick], w.end[pick])))
    if reached is None:
        return
    names, since = hashes, np.zeros(len(hashes), np.uint8)
    where = np.flatnonzero(w.follows)  # where a phrase of the length at hand begins
    for length in range(2, LONGEST + 1):
        p, s = names[where], names[where + 1]
        table = reached[length - 2]
        begun = np.maximum(np.maximum(table[slots(p)], table[slots(s)]), np.maximum(since[where], since[where + 1]))
        on = begun <= step
        where, p, s, begun = where[on], p[on], s[on], begun[on]
        if not len(where):
            return
        own = joined(p, s, length)
        on = begun.astype(np.int32) + SHARDS > step
        tally.add(length, own[on], begun[on], p[on], s[on])
        names, since = np.zeros(len(hashes), np.uint64), np.full(len(hashes), NEVER, np.uint8)
        names[where], since[where] = own, begun
        where = where[since[where + 1] != NEVER]


def _scan(shard: DataFrame, reached, step: int) -> DataFrame:
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = reached.value if reached is not None else None
        tally = Tally()
        for batch in stream:
            langs = np.asarray(batch.column(2)).view(np.uint64)
            for at, to in tokens.chunks(batch.column(0), BYTES):
                counted(tally, batch.column(0), batch.column(1), langs, at, to, table, step)
                yield from tally.rows(TALLY)
        yield from tally.rows()

    return shard.mapInArrow(run, COUNTS)


def _named(rows: DataFrame) -> DataFrame:
    """``rows`` with ``h``, the hash of the phrase itself, and its ``slot``."""
    schema = rows.select("*").schema.add("h", "long").add("slot", "long")

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            length, p, s = (np.asarray(batch.column(batch.schema.get_field_index(c))) for c in ("length", "p", "s"))
            h = p.view(np.uint64).copy()
            for k in range(2, LONGEST + 1):
                on = length == k
                h[on] = joined(p[on].view(np.uint64), s[on].view(np.uint64), k)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(h.view(np.int64)), pa.array(slots(h))], names=[*batch.schema.names, "h", "slot"])

    return rows.mapInArrow(run, schema)


def _mark(counts: DataFrame, least: int, reached: np.ndarray, step: int) -> bool:
    """Enter what has been seen ``least`` times by the end of ``step``; whether anything was new."""
    rows = (
        _named(counts.filter((F.col("n") >= least) & (F.col("length") < LONGEST)).select("length", "p", "s"))
        .groupBy("length", F.expr(f"slot div {BUCKET}").cast("int").alias("bucket"))
        .agg(F.expr(f"bitmap_construct_agg(slot % {BUCKET})").alias("bits"))
        .collect()  # at most 4 x SLOTS bits
    )
    new = False
    for row in rows:
        on = np.unpackbits(np.frombuffer(row.bits, np.uint8), bitorder="little").astype(bool)
        part = reached[row.length - 1, row.bucket * BUCKET : (row.bucket + 1) * BUCKET]
        fresh = on & (part == NEVER)
        part[fresh] = step + 1
        new |= bool(fresh.any())
    return new


def frequent(docs: DataFrame, least: int = 100, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(phrases of 1 to ``LONGEST`` words that occur ``least`` times, words per language).

    Phrases have ``length``, ``p`` and ``s`` (hashes of both subphrases; a word has its own in ``p``), ``lang`` and
    ``word`` (of single words only) and ``n``.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
        F.pmod(F.monotonically_increasing_id(), F.lit(SHARDS)).alias("shard"),
    ).withColumn("lang_hash", F.xxhash64("lang"))
    shards = stored(texts.filter("text <> ''"), "shards", partition_by=["shard"])
    reached = np.full((LONGEST - 1, SLOTS), NEVER, np.uint8)
    sent, running, done, words = None, None, [], None
    last, step = 0, 0
    while step < last + SHARDS:
        if step >= NEVER - 1:
            raise RuntimeError("phrases did not complete their cycles")
        part = _scan(shards.filter(F.col("shard") == step % SHARDS).select("text", "lang", "lang_hash"), sent, step)
        if running is not None:
            part = part.unionByName(running.filter(F.col("since") > step - SHARDS))
        after = stored(part.groupBy("length", "since", "p", "s", "lang", "word").agg(F.sum("n").alias("n")), "counts")
        if sent is not None:
            sent.destroy()
        closing = step - SHARDS + 1  # phrases counted since then have been through every shard
        if closing == 0:
            words = stored(after.filter("length = 1").groupBy("lang").agg(F.sum("n").alias("n")), "words")
        if closing == 0 or closing > 0 and bool((reached == closing).any()):
            done.append(stored(after.filter((F.col("since") == closing) & (F.col("n") >= least)), "frequent"))
        if running is not None:
            discard(running)
        running = after
        if _mark(running, least, reached, step):
            last = step + 1
        sent = spark.sparkContext.broadcast(reached)
        step += 1
    sent.destroy()
    discard(running)
    discard(shards)
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found, words


def phrases(found: DataFrame) -> DataFrame:
    """Frequent phrases with their words and the counts of their parts.

    ``pre`` holds the counts of the first 1, 2, ... words, ``suf`` those of the rest after the first 1, 2, ... words.
    """
    none = F.array().cast("array<long>")
    named = stored(_named(found), "named")
    level = named.filter("length = 1").select(
        "h", "length", "p", "s", "lang", F.col("word").alias("phrase"), F.col("word").alias("final"), F.col("n").alias("a"), none.alias("pre"), none.alias("suf")
    )
    levels = [level]
    for length in range(2, LONGEST + 1):
        first = level.select(F.col("h").alias("p"), "lang", F.col("phrase").alias("p_phrase"), F.col("a").alias("p_a"), F.col("pre").alias("p_pre"))
        rest = level.select(F.col("h").alias("s"), F.col("final"), F.col("a").alias("s_a"), F.col("suf").alias("s_suf"))
        level = stored(
            named.filter(F.col("length") == length)
            .select("h", "length", "p", "s", F.col("n").alias("a"))
            .join(first, "p")
            .join(rest, "s")
            .select(
                "h",
                "length",
                "p",
                "s",
                "lang",
                F.concat_ws(" ", "p_phrase", "final").alias("phrase"),
                "final",
                "a",
                F.concat("p_pre", F.array("p_a")).alias("pre"),
                F.concat(F.array("s_a"), "s_suf").alias("suf"),
            ),
            f"phrases{length}",
        )
        levels.append(level)
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per language the ``top`` phrases of 2 to ``LONGEST`` words by their weakest cut.

    A phrase as frequent as a longer one around it is left to the longer one.
    """
    found, words = frequent(docs, least, text_col, lang_col)
    every = phrases(found).filter("length > 1")
    around = (
        every.select(F.explode(F.array("p", "s")).alias("h"), F.col("a").alias("longer")).groupBy("h").agg(F.max("longer").alias("longer"))
    )
    # decimals of 38 digits hold 1000 * a * n for up to 10**17 words; the quotient is exact
    wide = "CAST({} AS DECIMAL(19, 0))".format
    cut = (
        f"transform(sequence(1, length - 1), k -> struct("
        f"(1000 * {wide('a')} * {wide('n')}) div ({wide('pre[k - 1]')} * {wide('suf[k - 1]')}) AS score, k AS k, pre[k - 1] AS l, suf[k - 1] AS r))"
    )
    scored = (
        every.join(around, "h", "left")
        .filter("longer IS NULL OR longer < a")
        .join(words, "lang")
        .withColumn("cut", F.array_min(F.expr(cut)))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (
        scored.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
