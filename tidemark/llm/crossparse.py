"""Language identification by cross-parsing entropy.

For every language a suffix automaton of labelled text is built. A document is parsed against each: a phrase is the
longest piece that occurs in the language's text, the next phrase begins where it ends. The fewer phrases, the closer
the language: with c phrases over n characters and N characters of text, the entropy is c * log2(N) / n, and the
language with the lowest wins (of equals the first in alphabetical order).

Texts are lower-cased; letters are kept, any run of other characters is one gap. The parse begins anew after
``SEGMENT`` characters, so that many segments are parsed side by side and a text may be of any length.

The model is fitted on a bounded sample: of each language ``ROWS`` distinct labelled texts, a piece of ``PIECE``
characters at an arbitrary place of each, at most ``SAMPLE`` characters in all (and at most ``TOTAL`` over all
languages). Scoring covers every text whole.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every text if nothing can be
learned. A row without an id is never learned from and counts as held out. Equal rows are answered each; very long
texts are whole; columns other than the id, text and language are passed through and never read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.common import broadcast_if_small, stored

ROWS = 256
PIECE = 200
SAMPLE = 32_000  # states of an automaton, fewer than twice as many, fit into 16 bits
TOTAL = 640_000
PARTS = 64
SEGMENT = 512
BYTES = 4 << 20
GAP, OTHER, CLASSES = 0, 63, 64
NONE = "und"
_WORDLIKE = re.compile(r"[^\W\d_]")


class Model(NamedTuple):
    langs: list[str]
    classes: np.ndarray  # uint8 per code point
    steps: list[np.ndarray]  # per language uint16, states x CLASSES, flat; 0 where no piece goes on
    bits: np.ndarray  # log2 of the characters each language was learned from


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(True))


def automaton(text: np.ndarray) -> np.ndarray:
    """Transitions of the suffix automaton of ``text``, states x CLASSES; state 0 is the start, 0 no transition."""
    after: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text.tolist():
        new = len(after)
        after.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and c not in after[at]:
            after[at][c] = new
            at = link[at]
        if at >= 0:
            there = after[at][c]
            if length[there] == length[at] + 1:
                link[new] = there
            else:
                copy = len(after)
                after.append(dict(after[there]))
                length.append(length[at] + 1)
                link.append(link[there])
                while at >= 0 and after[at].get(c) == there:
                    after[at][c] = copy
                    at = link[at]
                link[there] = link[new] = copy
        last = new
    out = np.zeros((len(after), CLASSES), np.uint16)
    for state, row in enumerate(after):
        for c, to in row.items():
            out[state, c] = to
    return out


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, and where each begins (one entry more than texts)."""
    low = [t.lower() for t in texts]
    first = np.zeros(len(low) + 1, np.int64)
    np.cumsum([len(t) for t in low], out=first[1:])
    return np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), "<u4"), first


def classified(texts: list[str], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each character with runs of gaps made one, and where each text begins."""
    points, first = code_points(texts)
    if not len(points):
        return np.zeros(0, np.uint8), first
    own = classes[points]
    keep = np.ones(len(own), bool)
    keep[1:] = (own[1:] != GAP) | (own[:-1] != GAP)
    begins = first[:-1][first[:-1] < len(own)]
    keep[begins] = True
    total = np.zeros(len(own) + 1, np.int64)
    np.cumsum(keep, out=total[1:])
    return own[keep], total[first]


def alphabet(texts: list[str]) -> np.ndarray:
    """Class of every code point: the commonest letters have their own, other letters share one, the rest is a gap."""
    counts = Counter("".join(t.lower() for t in texts))
    letters = sorted((c for c in counts if c.isalpha()), key=lambda c: (-counts[c], c))[: OTHER - 1]
    classes = np.fromiter((OTHER if chr(i).isalpha() else GAP for i in range(0x110000)), np.uint8, 0x110000)
    for i, c in enumerate(letters):
        classes[ord(c)] = i + 1
    return classes


def learn(samples: dict[str, list[str]]) -> Model | None:
    """The model of texts by language; None without a language that has a letter."""
    classes = alphabet([t for lang in sorted(samples) for t in samples[lang]])
    most = min(SAMPLE, TOTAL // max(len(samples), 1))
    langs, steps, bits = [], [], []
    for lang in sorted(samples):
        own, first = classified(samples[lang], classes)
        pieces = [np.append(own[a:b], np.uint8(GAP)) for a, b in zip(first[:-1], first[1:])]
        text = np.concatenate([np.zeros(0, np.uint8), *pieces])[:most]
        if text.any():
            langs.append(lang)
            steps.append(automaton(text).reshape(-1))
            bits.append(math.log2(len(text) + 1))
    return Model(langs, classes, steps, np.array(bits)) if langs else None


def phrases(model: Model, classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Numbers of phrases, texts x languages, of texts that begin at ``first``."""
    texts = len(first) - 1
    size = np.diff(first)
    each = -(-size // SEGMENT)
    text = np.repeat(np.arange(texts), each)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each)
    begin = first[:-1][text] + nth * SEGMENT
    length = np.minimum(size[text] - nth * SEGMENT, SEGMENT)
    order = np.argsort(-length, kind="stable")
    text, begin, length = text[order], begin[order], length[order]
    open_ = np.searchsorted(-length, -np.arange(SEGMENT))  # segments longer than each place
    out = np.zeros((texts, len(model.langs)), np.int64)
    for j, steps in enumerate(model.steps):
        state = np.zeros(len(text), np.int32)
        found = np.zeros(len(text), np.int32)
        for place in range(int(length[0]) if len(length) else 0):
            k = open_[place]
            c = classes[begin[:k] + place]
            to = steps[state[:k] * CLASSES + c]
            miss = np.flatnonzero(to == 0)
            again = steps[c[miss]]
            # a phrase ends here, and a character that the language does not have is one of its own
            found[miss] += (state[miss] > 0).astype(np.int32) + (again == 0)
            to[miss] = again
            state[:k] = to
        out[:, j] = np.bincount(text, found + (state > 0), minlength=texts)
    return out


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in _WORDLIKE.finditer(text))


def judged(model: Model | None, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; the score is how far the second language lies behind, 0 for a tie."""
    letters = np.array([t is not None and has_letter(t) for t in texts], bool)
    if model is None or not letters.any():
        return [NONE] * len(texts), np.zeros(len(texts))
    classes, first = classified([t if ok else "" for t, ok in zip(texts, letters)], model.classes)
    size = np.maximum(np.diff(first), 1)
    entropy = phrases(model, classes, first) * model.bits / size[:, None]
    best = entropy.argmin(1)
    low = entropy[np.arange(len(texts)), best]
    score = np.ones(len(texts))
    if len(model.langs) > 1:
        second = np.partition(entropy, 1, axis=1)[:, 1]
        score = np.where(second > 0, 1 - low / np.where(second > 0, second, 1), 0.0)
    return [model.langs[b] if ok else NONE for b, ok in zip(best.tolist(), letters)], np.where(letters, score, 0.0)


def fitted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """The model from the labelled rows that are not held out."""
    rows = docs.select(
        F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"), held_out(F.col(f"`{id_col}`")).alias("held_out")
    ).filter("NOT held_out AND text IS NOT NULL AND lang IS NOT NULL")
    rows = rows.select("lang", "text", F.xxhash64("text").alias("name"))
    # the texts with the smallest names: first of each of a fixed number of parts of a language, whatever share of the
    # rows it has, then of the language
    names = rows.select("lang", "name").distinct().withColumn("part", F.pmod("name", F.lit(PARTS)))
    for of in ("lang, part", "lang"):
        place = F.expr(f"row_number() OVER (PARTITION BY {of} ORDER BY name)")
        names = names.withColumn("place", place).filter(F.col("place") <= ROWS).drop("place")
    chosen = broadcast_if_small(stored(names.select("lang", "name"), "language-samples"))
    piece = F.expr(f"substring(text, CAST(1 + pmod(name, greatest(length(text) - {PIECE}, 1)) AS INT), {PIECE})")
    found = rows.join(chosen, ["lang", "name"]).groupBy("lang", "name").agg(F.min(piece).alias("piece")).orderBy("lang", "name").collect()
    samples: dict[str, list[str]] = {}
    for row in found:
        samples.setdefault(row.lang, []).append(row.piece)
    return learn(samples)


def identified(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` as struct ``row``, with ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = rows.select("row").schema.add("lang_pred", "string").add("score", "double")

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in stream:
            for at, to in tokens.chunks(batch.column(1), BYTES):
                langs, score = judged(model, batch.column(1).slice(at, to - at).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), pa.array(langs, pa.string()), pa.array(score)], ["row", "lang_pred", "score"])

    return rows.mapInArrow(run, schema)
