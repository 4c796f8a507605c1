"""Substring deduplication: every word of a window that already starts in a document with a smaller id goes.

1. *Anchors.* Of the k-word hashes inside a window the smallest is its anchor, so equal windows have
   equal anchors. About one word in five begins an anchor. Anchors found in one text only cannot
   belong to a repeated window and are left behind after one sort.
2. *Segments.* A run of windows with the same anchor is a segment. A text is read again only if it
   holds a shared anchor. Equal segments of a batch are one entry with its smallest id.
3. *Shards.* Segments are dealt by anchor into shards of bounded size. A shard numbers its words, sorts
   suffixes to the window's depth and keeps the Burrows-Wheeler transform as a wavelet matrix of packed
   bits: a compressed FM-index. Its segments stream through it in step: backward search extends every
   window one word at a time, and a window falls out as soon as its match occurs once only. Windows
   matched to full length give suffix intervals, and each interval the smallest id over it.
   An anchor in very many texts is dealt window by window, so it spreads over many shards.
4. *Removal.* The intervals return to their occurrences and to the documents.

Texts with the same words are one text with the smallest id; its copies lose all their words.

Defined cases: null and empty texts have no words; a text shorter than a window loses nothing; rows
without an id lose nothing and take nothing from others; rows sharing an id do not take from each
other; other columns pass through untouched; an empty table gives an empty result. Words are compared
by 64-bit hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.common import id_and_text, parts, stored

WINDOW = 13
ANCHOR = 6
#: Windows that a shard holds on average.
SHARD_WINDOWS = 100_000
#: An anchor in more texts than this is dealt window by window.
HOT_ANCHOR = 2000
NONE = np.iinfo(np.int64).max


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def names(w: tokens.Words, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit names of the word sequences ``begin`` to ``end`` of a chunk, from one prefix sum over its words."""
    n = len(w.hashes)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(w.hashes * tokens.powers(tokens.BASE, n)[:n], out=total[1:])
    value = (total[end] - total[begin]) * tokens.powers(tokens.INVERSE, n + 1)[begin]
    return _signed(tokens.mix(value + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


class Windows(NamedTuple):
    start: np.ndarray  # first word of each window, ascending
    text: np.ndarray  # the text it is in
    anchor: np.ndarray  # hash of its anchor
    where: np.ndarray  # first word of its anchor


def windows(w: tokens.Words, window: int, k: int) -> Windows:
    """All windows of a chunk with their anchors: the smallest k-word hash inside, the leftmost if several."""
    text = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    m = len(w.hashes) - window + 1
    if m <= 0:
        none = np.zeros(0, np.int64)
        return Windows(none, none, np.zeros(0, np.uint64), none)
    g = tokens.grams(w.hashes, k)
    best, where = g[:m].copy(), np.arange(m)
    for j in range(1, window - k + 1):
        other = g[j : j + m]
        where = np.where(other < best, np.arange(j, j + m), where)
        np.minimum(best, other, out=best)
    start = np.flatnonzero(text[:m] == text[window - 1 :])
    return Windows(start, text[start], best[start], where[start])


def _described(texts: DataFrame) -> DataFrame:
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for at, to in tokens.chunks(batch.column(1)):
                w = tokens.words(batch.column(1), at, to)
                fp = names(w, w.first[:-1], w.first[1:])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), pa.array(np.diff(w.first)), pa.array(fp)], ["id", "n", "fp"])

    return texts.mapInArrow(run, "id long, n long, fp long")


def _anchored(texts: DataFrame, window: int, k: int) -> DataFrame:
    """(anchor, fp): the distinct anchors of every distinct text of a batch."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            known: set[int] = set()
            for at, to in tokens.chunks(batch.column(1)):
                w = tokens.words(batch.column(1), at, to)
                fp = names(w, w.first[:-1], w.first[1:])
                new = np.zeros(len(fp), bool)
                for i, name in enumerate(fp.tolist()):
                    if name not in known:
                        known.add(name)
                        new[i] = True
                found = windows(w, window, k)
                use = new[found.text]
                text, anchor = found.text[use], found.anchor[use]
                order = np.lexsort((anchor, text))
                text, anchor = text[order], anchor[order]
                once = np.ones(len(text), bool)
                once[1:] = (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(_signed(anchor[once])), pa.array(fp[text[once]])], ["anchor", "fp"])

    return texts.mapInArrow(run, "anchor long, fp long")


def _shared(anchored: DataFrame, hot: int) -> DataFrame:
    """(fp, anchor, hot) of anchors that occur in two texts or more; the input is sorted by anchor and fp."""

    def report(anchor: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        fresh = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (fp[1:] != fp[:-1])])
        anchor, fp = anchor[fresh], fp[fresh]
        starts = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        size = np.diff(np.append(starts, len(anchor)))
        size = np.repeat(size, size)
        keep = size > 1
        return pa.RecordBatch.from_arrays([pa.array(fp[keep]), pa.array(anchor[keep]), pa.array(size[keep] > hot)], ["fp", "anchor", "hot"])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in stream:
            now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = now if held is None else [np.concatenate(p) for p in zip(held, now)]
            if not len(held[0]) or held[0][0] == held[0][-1]:
                continue
            cut = int(np.searchsorted(held[0], held[0][-1]))
            yield report(*(c[:cut] for c in held))
            held = [c[cut:] for c in held]
        if held is not None and len(held[0]):
            yield report(*held)

    return anchored.mapInArrow(run, "fp long, anchor long, hot boolean")


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Owner rows and values of a list column without nulls."""
    size = np.asarray(pa.compute.list_value_length(column))
    return np.repeat(np.arange(len(column)), size), column.flatten().to_numpy(zero_copy_only=False)


def _has(row: np.ndarray, value: np.ndarray, rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each (row, value) is among (rows, values); a mixed key keeps both in 64 bits."""
    key = lambda r, v: tokens.mix(v.view(np.uint64) + tokens.mix(r.astype(np.uint64)))
    return np.isin(key(row, value), key(rows, values))


def _segments(holders: DataFrame, window: int, k: int) -> DataFrame:
    """Occurrences (seg, id, fp, pos, windows) and, once a chunk, entries of the index.

    An entry has words and a key; id and pos are then the smallest and the largest id that hold it.
    """
    schema = "seg long, id long, fp long, pos long, windows long, key long, words binary"

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            ids, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cold, hot = _lists(batch.column(3)), _lists(batch.column(4))
            for at, to in tokens.chunks(batch.column(2)):
                w = tokens.words(batch.column(2), at, to)
                right = names(w, w.first[:-1], w.first[1:]) == fps[at:to]  # else another text with the same id
                found = windows(w, window, k)
                ok = right[found.text]
                start, text, anchor, where = (x[ok] for x in found)
                if not len(start):
                    continue
                row = text + at
                first = np.ones(len(start), bool)
                first[1:] = (where[1:] != where[:-1]) | (text[1:] != text[:-1])
                begin = np.flatnonzero(first)
                size = np.diff(np.append(begin, len(start)))
                on = _has(row[begin], _signed(anchor[begin]), *cold)
                one = np.flatnonzero(_has(row, _signed(anchor), *hot)) if len(hot[1]) else begin[:0]
                begin, size = np.concatenate([begin[on], one]), np.concatenate([size[on], np.ones(len(one), np.int64)])
                if not len(begin):
                    continue
                low = start[begin]
                high = low + size + window - 1
                seg = names(w, low, high)
                key = np.concatenate([_signed(anchor[begin[: len(begin) - len(one)]]), seg[len(begin) - len(one) :]])
                doc = ids[row[begin]]
                order = np.argsort(seg, kind="stable")
                heads = np.flatnonzero(np.concatenate([[True], seg[order][1:] != seg[order][:-1]]))
                pick, m, n = order[heads], len(heads), len(seg)
                words = [w.data[x:y].tobytes() for x, y in zip(w.begin[low[pick]].tolist(), w.end[high[pick] - 1].tolist())]
                none = pa.nulls(m, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([seg, seg[pick]])),
                        pa.array(np.concatenate([doc, np.minimum.reduceat(doc[order], heads)])),
                        pa.concat_arrays([pa.array(fps[row[begin]]), none]),
                        pa.array(np.concatenate([low - w.first[text[begin]], np.maximum.reduceat(doc[order], heads)])),
                        pa.concat_arrays([pa.array(size), none]),
                        pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(key[pick])]),
                        pa.concat_arrays([pa.nulls(n, pa.binary()), pa.array(words, pa.binary())]),
                    ],
                    ["seg", "id", "fp", "pos", "windows", "key", "words"],
                )

    return holders.mapInArrow(run, schema)


class FMIndex:
    """Backward search over a sequence of numbered words; 0 separates entries.

    Suffixes are sorted to ``depth`` symbols, which is exact for patterns shorter than that. The
    transform is a wavelet matrix: per bit of the alphabet packed bits and one count per 64 of them.
    """

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        rank, width = text.astype(np.int64), 1
        while True:
            order = np.argsort(rank, kind="stable")
            step = rank[order]
            dense = np.zeros(n, np.int64)
            dense[order] = np.cumsum(np.concatenate([[0], step[1:] != step[:-1]]))
            if width >= depth:
                break
            tail = np.zeros(n, np.int64)
            tail[: max(n - width, 0)] = dense[width:] + 1
            rank, width = dense * (n + 1) + tail, width * 2
        self.suffixes = order
        row = text[order - 1].astype(np.int64)
        symbols = int(text.max()) + 1
        self.bits = max(1, (symbols - 1).bit_length())
        self.zeros, self.packed, self.counts = [], [], []
        begin = np.zeros(symbols, np.int64)
        every = np.arange(symbols)
        for level in range(self.bits - 1, -1, -1):
            bit = (row >> level & 1).astype(bool)
            padded = np.zeros((n // 64 + 1) * 64, bool)
            padded[:n] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            self.packed.append(words)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]]))
            self.zeros.append(n - int(bit.sum()))
            begin = self._down(len(self.zeros) - 1, (every >> level & 1).astype(bool), begin)
            row = np.concatenate([row[~bit], row[bit]])
        totals = np.bincount(text, minlength=symbols)
        self.shift = np.cumsum(totals) - totals - begin

    def _down(self, level: int, one: np.ndarray, at: np.ndarray) -> np.ndarray:
        block = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        ones = self.counts[level][block] + np.bitwise_count(self.packed[level][block] & low)
        return np.where(one, self.zeros[level] + ones, at - ones)

    def extend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the suffixes before rank ``at`` end up once ``symbol`` is put in front of them."""
        shift = self.shift[symbol]
        for level in range(self.bits):
            at = self._down(level, (symbol >> (self.bits - 1 - level) & 1).astype(bool), at)
        return at + shift

    def matches(self, text: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the windows of ``length`` ending at ``ends`` those that occur twice or more: which, and their suffix interval."""
        alive = np.arange(len(ends))
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), len(self.suffixes), np.int64)
        for j in range(length):
            symbol = text[ends[alive] - j]
            low, high = self.extend(symbol, low), self.extend(symbol, high)
            more = high - low > 1
            alive, low, high = alive[more], low[more], high[more]
        return alive, low, high


def smallest_owners(seg: np.ndarray, owner: np.ndarray, top: np.ndarray, words: pa.Array, window: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """For each distinct segment with a repeated window: per window the smallest owner, NONE where it is single."""
    order = np.lexsort((owner, seg))
    change = np.concatenate([[True], seg[order][1:] != seg[order][:-1]])
    fresh = order[change]
    several = np.maximum.reduceat(top[order], np.flatnonzero(change)) > owner[fresh]
    seg, owner, words = seg[fresh], owner[fresh], words.take(pa.array(fresh))
    hashes, lengths = [], []
    for at, to in tokens.chunks(words):
        w = tokens.words(words, at, to)
        hashes.append(w.hashes)
        lengths.append(np.diff(w.first))
    hashes, lengths = np.concatenate(hashes), np.concatenate(lengths)
    numbered = np.unique(hashes, return_inverse=True)[1] + 1
    begin = np.concatenate([[0], np.cumsum(lengths + 1)])
    text = np.zeros(begin[-1], np.int64)
    of = np.repeat(np.arange(len(lengths)), lengths)
    text[np.arange(len(hashes)) + of] = numbered
    index = FMIndex(text, window + 1)
    count = lengths - window + 1
    first = np.cumsum(count) - count
    which = np.repeat(np.arange(len(count)), count)
    ends = begin[which] + np.arange(len(which)) - first[which] + window - 1
    alive, low, high = index.matches(text, ends, window)
    least = np.where(several, owner, NONE)[which]
    if len(alive):
        by_suffix = np.append(owner[np.searchsorted(begin, index.suffixes, "right") - 1], NONE)
        lows, back = np.unique(low, return_inverse=True)
        highs = np.zeros(len(lows), np.int64)
        highs[back] = high
        least[alive] = np.minimum.reduceat(by_suffix, np.stack([lows, highs], 1).ravel())[::2][back]
    hit = np.minimum.reduceat(least, first) < NONE
    return seg[hit], [least[first[i] : first[i] + count[i]] for i in np.flatnonzero(hit)]


def _searched(entries: DataFrame, window: int) -> DataFrame:
    def run(group: pa.Table) -> pa.Table:
        seg, owner, top = (group.column(c).to_numpy() for c in ("seg", "id", "high"))
        words = group.column("words").combine_chunks()
        seg, least = smallest_owners(seg, owner, top, words if isinstance(words, pa.Array) else words.chunk(0), window)
        return pa.table({"seg": pa.array(seg, pa.int64()), "least": pa.array([x.tolist() for x in least], pa.list_(pa.int64()))})

    return entries.groupBy("shard").applyInArrow(run, "seg long, least array<long>")


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(id, entries): per document the texts it loses windows from, as (fp, starts); starts null: all of it."""
    spark = docs.sparkSession
    texts = id_and_text(docs, id_col, text_col)
    members = stored(_described(texts), "word-sequences").filter(F.col("n") >= window)
    classes = members.groupBy("fp").agg(F.min("id").alias("rep"))
    copies = members.join(classes, "fp").filter("id > rep").select("id", "fp", F.lit(None).cast("array<long>").alias("starts"))

    found = _shared(_anchored(texts, window, anchor).repartition(parts(spark), "anchor").sortWithinPartitions("anchor", "fp"), HOT_ANCHOR)
    holders = (
        found.groupBy("fp")
        .agg(F.collect_list(F.when(~F.col("hot"), F.col("anchor"))).alias("cold"), F.collect_list(F.when(F.col("hot"), F.col("anchor"))).alias("hot"))
        .join(classes, "fp")
    )
    holders = texts.join(holders, texts["id"] == holders["rep"]).select("id", "fp", "text", "cold", "hot")
    segments = stored(_segments(holders, window, anchor), "segments")

    total = segments.agg(F.sum("windows")).first()[0] or 0
    shards = max(parts(spark), math.ceil(total / SHARD_WINDOWS))
    entries = segments.filter("words IS NOT NULL").select("seg", "id", F.col("pos").alias("high"), "words", F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"))
    least = _searched(entries, window)
    starts = (
        segments.filter("words IS NULL")
        .join(least, "seg")
        .select("id", "fp", F.expr("filter(transform(least, (x, i) -> if(x < id, pos + i, NULL)), x -> x IS NOT NULL)").alias("s"))
        .filter("size(s) > 0")
        .groupBy("id", "fp")
        .agg(F.flatten(F.collect_list("s")).alias("starts"))
    )
    return starts.unionByName(copies).groupBy("id").agg(F.collect_set(F.struct("fp", "starts")).alias("entries"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Every row of ``docs`` as struct ``row``, with ``n_words``, ``n_removed`` and ``kept``, the words left joined by one space."""
    gone = removals(docs, id_col, text_col, window)
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    joined = rows.join(gone, "id", "left").select("row", "text", "entries")
    schema = joined.select("row").schema.add("n_words", "long").add("n_removed", "long").add("kept", "string")

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            total, removed, kept = [], [], []
            for text, entries in zip(batch.column(1), batch.column(2).to_pylist()):
                words = text.as_py().encode().split()  # splits at the same six bytes
                total.append(len(words))
                left = words
                if entries:
                    w = tokens.words(pa.array([text.as_py()], pa.string()), 0, 1)
                    fp = int(names(w, w.first[:1], w.first[1:])[0])
                    for e in entries:
                        if e["fp"] == fp:
                            left = [] if e["starts"] is None else _left(words, e["starts"], window)
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["row", "n_words", "n_removed", "kept"],
            )

    return joined.mapInArrow(run, schema)


def _left(words: list[bytes], starts: list[int], window: int) -> list[bytes]:
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.array(starts) + window, -1)
    covered = np.cumsum(change[:-1]) > 0
    return [word for word, gone in zip(words, covered.tolist()) if not gone]
