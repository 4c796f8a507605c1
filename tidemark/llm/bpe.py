"""Byte-level BPE by a hierarchical-bitmap rank queue, and its decoding.

A pre-token starts as a linked list of its bytes. Every adjacent pair that merges waits in the bucket of
its rank; a bitmap of two levels, 256 bits a word, marks the buckets in use, so the next rank is two
find-first-set steps away, whatever the length. A bucket holds left positions; an entry is stale, and is
skipped, if its pair has changed since. Within a rank the leftmost pair merges first. A pre-token of n
bytes takes O(n) queue steps, which suits very long ones. Short ones repeat and are kept in a bounded
table per worker; those of a chunk of texts that are not known yet wait in one queue together, which
takes a bucket's pairs from the left, but leaves those of a pre-token that has a smaller rank waiting by then.

Each match of the pattern is a pre-token. There are no special tokens: their strings are ordinary text.

Defined cases: null and empty texts have no tokens; repeated rows are encoded each; rows without an id
are kept; other columns pass through untouched; an empty table gives an empty result. A rank file in
which some byte has no rank is refused.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import chain
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.common import rows_and_text

#: Pre-tokens of up to so many characters are kept, and at most so many of them per Python worker.
KEPT_BYTES, KEPT = 64, 150_000
#: Texts below this code point are split by the standard library's expressions, which are faster.
SIMPLE = 0x300
PAGE, MASK = 8, 255
#: Bytes of texts that are split together, and of short pre-tokens that share a queue.
TOGETHER, SHARED = 1 << 18, 1 << 15


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: per line a token in base64 and its rank. The size of a vocabulary bounds it."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("the ranks do not cover all bytes")
    return ranks


def _plain_pattern(pattern: str) -> str | None:
    """The pattern for texts below U+0300, with its Unicode classes written out; None if it has others."""

    def ranges(inside) -> str:
        out, at = "", None
        for c in range(SIMPLE + 1):
            if c < SIMPLE and inside(chr(c)):
                at = c if at is None else at
            elif at is not None:
                out, at = out + f"\\u{at:04x}-\\u{c - 1:04x}", None
        return out

    classes = {
        r"\p{L}": ranges(lambda c: unicodedata.category(c)[0] == "L"),
        r"\p{N}": ranges(lambda c: unicodedata.category(c)[0] == "N"),
        r"\s": ranges(lambda c: regex.match(r"\s", c)),
    }
    out, at, inside = "", 0, False
    while at < len(pattern):
        name = next((n for n in classes if pattern.startswith(n, at)), None)
        if name:
            out += classes[name] if inside else f"[{classes[name]}]"
            at += len(name)
            continue
        if pattern.startswith(r"\S", at) and not inside:
            out += f"[^{classes[chr(92) + 's']}]"
            at += 2
            continue
        if pattern[at] == "\\":
            return None
        inside = pattern[at] == "[" or inside and pattern[at] != "]"
        out += pattern[at]
        at += 1
    return out


class Encoder:
    """``tables`` keep the ids of short pre-tokens; whoever passes them may share them between encoders.

    They are two generations: once the younger is full it becomes the older, and what is met again moves
    back to the younger, so frequent pre-tokens stay.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, tables: list[dict[str, bytes]] | None = None):
        self.ranks = ranks
        self.any_split = regex.compile(pattern).findall
        plain = _plain_pattern(pattern)
        self.plain_split = re.compile(plain).findall if plain else self.any_split
        self.beyond = re.compile(f"[{chr(SIMPLE)}-\U0010ffff]").search
        self.tables = [{}, {}] if tables is None else tables
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.uint32)
        self.pair = np.full(1 << 16, -1, np.int64)  # rank of two bytes
        for token, rank in ranks.items():
            if len(token) == 2:
                self.pair[token[0] << 8 | token[1]] = rank

    def merge(self, data: bytes) -> list[int]:
        """Token ids of one pre-token.

        ``top`` has a bit for every page of ranks in use and ``pages`` a bit for every rank of a page
        with a bucket, so the smallest rank is two find-first-set steps away. The queue is written out
        here, as its steps are most of the work.
        """
        get, n = self.ranks.get, len(data)
        whole = get(data)
        if whole is not None:
            return [whole]
        end = list(range(1, n + 1))  # end of the token that begins here
        before = list(range(-1, n - 1))
        # rank under which the pair that begins here waits
        waiting: list[int | None] = [get(data[i : i + 2]) for i in range(n - 1)] + [None]
        top, pages, buckets = 0, {}, {}
        for i, rank in enumerate(waiting):  # ascending, so every bucket stays a heap
            if rank is not None:
                if rank in buckets:
                    buckets[rank].append(i)
                else:
                    buckets[rank] = [i]
                    page = rank >> PAGE
                    pages[page] = pages.get(page, 0) | 1 << (rank & MASK)
                    top |= 1 << page
        pending = ()
        while True:
            for i in pending:
                rank = waiting[i]
                if rank is None and (rank := get(data[i : end[end[i]]] if end[i] < n else b"")) is not None:
                    waiting[i] = rank
                    bucket = buckets.get(rank)
                    if bucket:
                        heappush(bucket, i)
                    else:
                        buckets[rank] = [i]
                        page = rank >> PAGE
                        pages[page] = pages.get(page, 0) | 1 << (rank & MASK)
                        top |= 1 << page
            if not top:
                break
            page = (top & -top).bit_length() - 1
            bits = pages[page]
            rank = page << PAGE | (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            i = heappop(bucket) if len(bucket) > 1 else bucket.pop()
            if not bucket:
                bits &= bits - 1
                pages[page] = bits
                if not bits:
                    top &= top - 1
            pending = ()
            if waiting[i] != rank:
                continue  # stale
            j = end[i]
            k = end[j]
            end[i] = k
            waiting[i] = waiting[j] = None
            if k < n:
                before[k] = i
            h = before[i]
            if h >= 0:
                waiting[h] = None
                pending = (h, i)
            else:
                pending = (i,)
        out, i, ranks = [], 0, self.ranks
        while i < n:
            out.append(ranks[data[i : end[i]]])
            i = end[i]
        return out

    def merge_short(self, words: list[bytes]) -> list[bytes]:
        """Packed token ids of many pre-tokens, none of them empty, by one queue over their bytes in a row.

        A bucket is taken whole and from the left, since pre-tokens do not touch each other. Where a merge
        gives its pre-token a smaller rank than the bucket's, what else the bucket holds of it waits on.
        """
        get, data = self.ranks.get, b"".join(words)
        n, size = len(data), np.array([len(w) for w in words])
        edge = np.concatenate([[0], np.cumsum(size)])  # where pre-tokens begin, and the end
        begins = bytearray(n + 1)
        for at in edge.tolist():
            begins[at] = 1
        raw = np.frombuffer(data, np.uint8)
        first = np.full(n, -1, np.int64)
        first[:-1] = self.pair[raw[:-1].astype(np.int64) << 8 | raw[1:]]
        first[edge[1:] - 1] = -1
        waiting = first.tolist()  # rank under which the pair that begins here waits, or -1
        end = list(range(1, n + 1))  # end of the token that begins here
        before = list(range(-1, n - 1))  # begin of the token before
        word = np.repeat(np.arange(len(words)), size).tolist()
        token = self.byte[raw].tolist()  # -1 once merged into the token before
        top, pages, buckets = 0, {}, {}
        order = np.argsort(first, kind="stable")
        order = order[np.searchsorted(first[order], 0) :]
        ranks, at = np.unique(first[order], return_index=True)
        for rank, bucket in zip(ranks.tolist(), np.split(order, at[1:])):
            buckets[rank] = bucket.tolist()
            page = rank >> PAGE
            pages[page] = pages.get(page, 0) | 1 << (rank & MASK)
            top |= 1 << page
        while top:
            page = (top & -top).bit_length() - 1
            bits = pages[page]
            rank = page << PAGE | (bits & -bits).bit_length() - 1
            bits &= bits - 1
            pages[page] = bits
            if not bits:
                top &= top - 1
            bucket = buckets.pop(rank)
            bucket.sort()
            left, later = set(), []
            for i in bucket:
                if waiting[i] != rank:
                    continue  # stale
                if left and word[i] in left:
                    later.append(i)
                    continue
                j = end[i]
                k = end[j]
                end[i] = k
                waiting[i] = waiting[j] = token[j] = -1
                token[i] = rank
                if not begins[k]:
                    before[k] = i
                    new = get(data[i : end[k]])
                    if new is not None:
                        waiting[i] = new
                        if new in buckets:
                            buckets[new].append(i)
                        else:
                            buckets[new] = [i]
                            page = new >> PAGE
                            pages[page] = pages.get(page, 0) | 1 << (new & MASK)
                            top |= 1 << page
                        if new < rank:
                            left.add(word[i])
                if not begins[i]:
                    h = before[i]
                    new = get(data[h:k])
                    if new is None:
                        waiting[h] = -1
                    else:
                        waiting[h] = new
                        if new in buckets:
                            buckets[new].append(h)
                        else:
                            buckets[new] = [h]
                            page = new >> PAGE
                            pages[page] = pages.get(page, 0) | 1 << (new & MASK)
                            top |= 1 << page
                        if new < rank:
                            left.add(word[i])
            if later:
                buckets[rank] = later
                page = rank >> PAGE
                pages[page] = pages.get(page, 0) | 1 << (rank & MASK)
                top |= 1 << page
        ids = np.array(token, np.int64)
        alive = ids >= 0
        to = (4 * np.concatenate([[0], np.cumsum(alive)])[edge]).tolist()
        packed = ids[alive].astype("<u4").tobytes()
        return [packed[a:b] for a, b in zip(to[:-1], to[1:])]

    def _merged(self, parts: set[str]) -> dict[str, bytes]:
        """Packed ids of distinct pre-tokens."""
        out, some, room = {}, {}, SHARED
        for p in parts:
            data = p.encode()
            whole = self.ranks.get(data)
            if whole is not None:
                out[p] = pack("<I", whole)
            elif len(p) > KEPT_BYTES:
                merged = self.merge(data)
                out[p] = pack(f"<{len(merged)}I", *merged)
            else:
                some[p] = data
                room -= len(data)
                if room <= 0:
                    out.update(zip(some, self.merge_short(list(some.values()))))
                    some, room = {}, SHARED
        if some:
            out.update(zip(some, self.merge_short(list(some.values()))))
        return out

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        known, older = self.tables
        split = [(self.any_split if self.beyond(text) else self.plain_split)(text) for text in texts]
        unknown = set(chain.from_iterable(split)).difference(known)
        here = {p: older[p] for p in unknown if p in older}
        here |= self._merged(unknown.difference(here))
        known.update(here)
        out = [b"".join(map(known.__getitem__, parts)) for parts in split]
        for p in here:
            if len(p) > KEPT_BYTES:
                del known[p]
        if len(known) >= KEPT // 2:
            self.tables[:] = {}, known
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


class Decoder:
    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        names = [b""] * size
        for token, rank in ranks.items():
            names[rank] = token
        self.names = names

    def decode(self, ids: bytes) -> bytes:
        names = self.names
        return b"".join([names[i] for i in np.frombuffer(ids, "<u4").tolist()])


def encoded(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` as struct ``row``, with ``ids``: little-endian unsigned 32-bit token ids."""
    shared = docs.sparkSession.sparkContext.broadcast({"ranks": ranks, "pattern": pattern, "tables": [{}, {}]})
    rows, place = rows_and_text(docs, text_col)
    schema = rows.select("row").schema.add("ids", "binary")

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(**shared.value)  # a Python worker keeps the tables from task to task
        for batch in stream:
            texts = tokens.texts(batch, place)
            for at, to in tokens.chunks(texts, TOGETHER):  # small batches out, so memory stays bounded
                ids = encoder.encode_all(texts.slice(at, to - at).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), pa.array(ids, pa.binary())], ["row", "ids"])

    return rows.mapInArrow(run, schema)


def decoded(rows: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids") -> DataFrame:
    """Every row as struct ``row``, with ``data``: the bytes that the ids stand for."""
    shared = rows.sparkSession.sparkContext.broadcast(ranks)
    some = rows.select(F.struct("*").alias("row"), F.coalesce(F.col(f"`{ids_col}`"), F.lit(b"")).alias("ids"))
    schema = some.select("row").schema.add("data", "binary")

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for batch in stream:
            for at, to in tokens.chunks(batch.column(1)):
                data = [decoder.decode(ids.as_py()) for ids in batch.column(1).slice(at, to - at)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), pa.array(data, pa.binary())], ["row", "data"])

    return some.mapInArrow(run, schema)
