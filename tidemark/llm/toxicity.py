"""Toxicity by a subsequence string kernel with Nyström landmarks and a linear support vector machine.

The kernel counts common subsequences of ``ORDER`` characters, each weighted by DECAY to the length it
spans in both strings, and is normalised: "idiot", "id-iot" and "idxiot" are near to each other, since
gaps and inserted characters only lower the weights. Its fourth power is used beside it. It is
evaluated for every word and landmark with a common subsequence of ``ORDER`` characters; for all other pairs it is 0.

*Learning.* A bounded sample of labelled texts (``SAMPLE_ROWS`` rows, the smallest hashes of their ids)
goes to the driver. Landmarks are the words whose presence speaks most clearly for the toxic label.
A sentence's features are its words' largest kernel values for each landmark, mapped by the inverse
root of the landmarks' own kernel matrix. A text is toxic if one of its sentences is, so in each round
the machine learns on the sentence of each text that it scores highest and on every further sentence of
toxic texts that it takes for toxic. The largest margin becomes a probability by a logistic fit.

*Scoring.* Every sentence of every text is scored in its task; the model is a few kilobytes. The
kernel is evaluated once per distinct word of a batch, for all words at once.

Sentences end at a line end or at ``.``, ``!`` or ``?`` before white space. A-Z is lowered, ASCII
punctuation is taken out of words, and three or more words of one character in a row are read as one
word. Words of over WORD bytes are read as overlapping windows.

Defined cases: null and empty texts, and texts without words, have no features and get the score of an
empty sentence; without labels of both kinds every score is the share of toxic labels (0 without any);
rows without an id are scored as well; labels that are null are left out; equal pairs of text
and label are learned from once; other columns pass through untouched; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.common import rows_and_text

#: Bound of the labelled sample that the model is fitted on.
SAMPLE_ROWS = 4000
ORDER, DECAY, WORD = 4, 0.9, 24
#: Bytes of text whose words are evaluated together.
BYTES = 1 << 18
#: Words of sentences whose kernel values are gathered together.
GATHERED = 4096
#: Words of a generation whose kernel values are kept.
KEPT = 25_000
#: Pairs of words whose kernel is evaluated together, so that its arrays stay in the processor's cache.
PAIRS = 1024
#: The fourth power of the kernel is a kernel too; it tells a landmark from words that merely resemble it.
POWER = 4
LANDMARKS, EVIDENCE = 120, 6.0
_BREAK = bytes(10 if c in b"\r\n\x0b\x0c" else c + 32 if 65 <= c <= 90 else c for c in range(256))
_DROP = bytes(c for c in range(33, 127) if not chr(c).isalnum())


class Model(NamedTuple):
    landmarks: list[bytes]
    weights: np.ndarray  # per landmark and kernel, the map by the kernel's inverse root included
    bias: float
    slope: float
    offset: float


def clean(text: str) -> bytes:
    data = text.encode()
    for end in (b". ", b"! ", b"? "):
        data = data.replace(end, b"\n")
    return data.translate(_BREAK, _DROP)


def _padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(w) for w in words], np.int64)
    return np.frombuffer(b"".join(w.ljust(WORD, b"\0") for w in words), np.uint8).reshape(len(words), WORD), size


def raw_kernel(x: np.ndarray, x_size: np.ndarray, y: np.ndarray, y_size: np.ndarray) -> np.ndarray:
    """Gap-weighted common subsequences of ORDER characters of each pair of padded words.

    The k-th character of a subsequence has k before it and ORDER - 1 - k after it, so each step has the same
    number of rows and columns, one further on.
    """
    wide, high = int(x_size.max()), int(y_size.max())
    rows, columns = high - ORDER + 1, wide - ORDER + 1
    if rows < 1 or columns < 1:
        return np.zeros(len(x))
    first, second = np.ascontiguousarray(x[:, :wide].T), np.ascontiguousarray(y[:, :high].T)
    hits = first == second[:, None]
    hits &= np.arange(wide)[:, None] < x_size
    hits &= np.arange(high)[:, None, None] < y_size
    decay = np.float32(DECAY)
    weight = hits * (decay * decay)
    ended = weight[:rows, :columns].copy()  # weight of what is matched up to (j, i)
    for step in range(1, ORDER):
        for i in range(1, columns):  # over all earlier j and i, each gap lowering the weight
            ended[:, i] += ended[:, i - 1] * decay
        for j in range(1, rows):
            ended[j] += ended[j - 1] * decay
        ended *= weight[step : step + rows, step : step + columns]
    return ended.sum((0, 1), dtype=np.float64)


def _pairs(x: np.ndarray, x_size: np.ndarray, y: np.ndarray, y_size: np.ndarray) -> np.ndarray:
    """``raw_kernel`` with short words apart from long ones, as its cost follows the longest."""
    out = np.zeros(len(x))
    steps = ((0, 6), (6, 9), (9, 13), (13, WORD))
    for low, high in steps:
        for less, more in steps:
            part = np.flatnonzero((x_size > low) & (x_size <= high) & (y_size > less) & (y_size <= more))
            for at in range(0, len(part), PAIRS):
                some = part[at : at + PAIRS]
                out[some] = raw_kernel(x[some], x_size[some], y[some], y_size[some])
    return out


def _common(chars: np.ndarray, size: np.ndarray, to: np.ndarray, to_size: np.ndarray) -> np.ndarray:
    """(word, landmark): whether their longest common subsequence has ORDER characters, by words of WORD bits."""
    alphabet, place = np.unique(np.concatenate([row[:n] for row, n in zip(to, to_size)])), np.zeros(256, np.int64)
    place[alphabet] = np.arange(len(alphabet)) + 1
    at = np.zeros((len(alphabet) + 1, len(chars)), np.uint32)  # per character: the places where a word has it
    every = np.arange(len(chars))
    for i in range(min(int(size.max()), WORD)):
        at[np.where(i < size, place[chars[:, i]], 0), every] |= np.uint32(1 << i)
    out = np.zeros((len(chars), len(to)), bool)
    for m, (row, n) in enumerate(zip(to, to_size)):
        free = np.full(len(chars), 0xFFFFFFFF, np.uint32)  # a bit turns 0 where the subsequence grows
        for c in place[row[:n]].tolist():
            hit = free & at[c]
            free = (free + hit) | (free - hit)
        out[:, m] = np.bitwise_count(free) <= 32 - ORDER
    return out


def self_kernel(words: list[bytes]) -> np.ndarray:
    chars, size = _padded(words)
    return _pairs(chars, size, chars, size)


def kernel(chars: np.ndarray, size: np.ndarray, landmarks: list[bytes], own: np.ndarray) -> np.ndarray:
    """Normalised kernel of padded words with each landmark; it is 0 where no subsequence of ORDER characters is common."""
    out = np.zeros((len(chars), len(landmarks)), np.float32)
    if not len(chars):
        return out
    to, to_size = _padded(landmarks)
    word, mark = np.nonzero(_common(chars, size, to, to_size))
    value = _pairs(chars[word], size[word], to[mark], to_size[mark])
    word, mark, value = word[value > 0], mark[value > 0], value[value > 0]
    near, back = np.unique(word, return_inverse=True)
    mine = _pairs(chars[near], size[near], chars[near], size[near])
    out[word, mark] = value / np.sqrt(mine[back] * own[mark])
    return out


class Known:
    """Kernel values of words seen before, by hash; words near no landmark share row 0."""

    def __init__(self, width: int):
        self.hashes = np.zeros(0, np.uint64)
        self.rows = np.zeros(0, np.int32)
        self.values = np.zeros((1, width), np.float32)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per hash whether it is known, and its place."""
        if not len(self.hashes):
            return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
        where = np.searchsorted(self.hashes, hashes)
        where[where == len(self.hashes)] = 0
        return self.hashes[where] == hashes, where

    def add(self, hashes: np.ndarray, values: np.ndarray) -> None:
        some = values.any(1)
        rows = np.zeros(len(values), np.int32)
        rows[some] = np.arange(int(some.sum())) + len(self.values)
        self.values = np.concatenate([self.values, values[some]])
        every = np.concatenate([self.hashes, hashes])
        order = np.argsort(every, kind="stable")
        self.hashes, self.rows = every[order], np.concatenate([self.rows, rows])[order]


class Sentences:
    """Features of the sentences of texts: only words near a landmark are kept."""

    def __init__(self, landmarks: list[bytes]):
        self.landmarks = landmarks
        self.own = self_kernel(landmarks)
        self.new, self.old = Known(len(landmarks)), Known(len(landmarks))

    def _words(self, words: list[bytes]) -> np.ndarray:
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        step = 10_000
        for at in range(0, len(words), step):
            some = words[at : at + step]
            chars, size = _padded([w[:WORD] for w in some])
            out[at : at + step] = kernel(chars, size, self.landmarks, self.own)
            for i, w in enumerate(some):
                if len(w) > WORD:
                    pieces = [w[k : k + WORD] for k in range(WORD // 2, len(w) - WORD // 2, WORD // 2)]
                    for k in range(0, len(pieces), step):
                        more = kernel(*_padded(pieces[k : k + step]), self.landmarks, self.own)
                        out[at + i] = np.maximum(out[at + i], more.max(0))
        return out

    def _known(self, hashes: np.ndarray, pick: np.ndarray, w: tokens.Words) -> np.ndarray:
        """Kernel values of distinct words. Two generations of words are kept, so that memory is bounded and words
        that go on being used stay known."""
        out = np.zeros((len(hashes), len(self.landmarks)), np.float32)
        here, at = self.new.find(hashes)
        out[here] = self.new.values[self.new.rows[at[here]]]
        there, at = self.old.find(hashes)
        there &= ~here
        out[there] = self.old.values[self.old.rows[at[there]]]
        fresh = ~(here | there)
        if fresh.any():
            out[fresh] = self._words([w.data[a:b].tobytes() for a, b in zip(w.begin[pick[fresh]].tolist(), w.end[pick[fresh]].tolist())])
        if not here.all():
            if len(self.new.hashes) > KEPT:
                self.new, self.old = Known(len(self.landmarks)), self.new
            self.new.add(hashes[~here], out[~here])
        return out

    def features(self, column: pa.Array, at: int, to: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, features) of the sentences with any feature; texts counted from ``at``, ascending."""
        w = tokens.words(column, at, to)
        if not len(w.hashes):
            return np.zeros(0, np.int64), np.zeros((0, len(self.landmarks)), np.float32)
        distinct, pick, back = np.unique(w.hashes, return_index=True, return_inverse=True)
        values = self._known(distinct, pick, w)
        on = np.flatnonzero(values.any(1)[back])
        line = np.cumsum(w.data == 10, dtype=np.int32)
        text = np.repeat(np.arange(to - at), np.diff(w.first))
        texts, lines, rows, spelled = [text[on]], [line[w.begin[on]]], [back[on]], [values]
        single = (w.end - w.begin == 1).astype(np.int8)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], single, [0]])))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a >= ORDER:  # spelled out; a run may span texts or lines
                for own in np.split(np.arange(a, b), np.flatnonzero(np.diff(text[a:b]) | np.diff(line[w.begin[a:b]])) + 1):
                    if len(own) >= ORDER:
                        texts.append(text[own[:1]])
                        lines.append(line[w.begin[own[:1]]])
                        rows.append([len(values) + len(spelled) - 1])
                        run = w.data[w.begin[own]].tobytes()  # "a" or "I" may stand before it
                        spelled.append(self._words([run, run[1:]]).max(0, keepdims=True))
        text, line, row = np.concatenate(texts), np.concatenate(lines), np.concatenate(rows)
        if len(spelled) > 1:
            values = np.concatenate(spelled)
        if not len(text):
            return text, np.zeros((0, len(self.landmarks)), np.float32)
        order = np.lexsort((line, text))
        text, line, row = text[order], line[order], row[order]
        first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (line[1:] != line[:-1])]))
        end = np.append(first[1:], len(row))
        out = np.empty((len(first), len(self.landmarks)), np.float32)
        done = 0
        while done < len(first):  # rows are gathered for few sentences at a time
            low = int(first[done])
            upto = max(int(np.searchsorted(end, low + GATHERED, "right")), done + 1)
            high = int(end[upto - 1])
            if high - low > GATHERED:  # one sentence
                out[done] = np.max([values[row[k : min(k + GATHERED, high)]].max(0) for k in range(low, high, GATHERED)], 0)
            else:
                out[done:upto] = np.maximum.reduceat(values[row[low:high]], first[done:upto] - low)
            done = upto
        return text[first], out


def _both(rows: np.ndarray) -> np.ndarray:
    return np.concatenate([rows, rows**POWER], 1)


def margins(model: Model, texts: list[str], sentences: Sentences) -> np.ndarray:
    """Largest sentence margin of each text."""
    column = pa.array([clean(t) for t in texts], pa.binary())
    out = np.full(len(texts), model.bias)
    for at, to in tokens.chunks(column, BYTES):
        of, rows = sentences.features(column, at, to)
        if len(of):
            # a text with words near no landmark has an empty sentence too; its margin is the bias
            np.maximum.at(out, of + at, _both(rows) @ model.weights + model.bias)
    return out


def _apart(texts: list[str]) -> list[int]:
    """Texts that share none of four min-hashes of three-word runs with an earlier one."""
    seen: set[tuple[int, int]] = set()
    keep = []
    column = pa.array([clean(t) for t in texts], pa.binary())
    for at, to in tokens.chunks(column, BYTES):
        w = tokens.words(column, at, to)
        for i, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist())):
            g = tokens.grams(w.hashes[a:b], min(3, b - a)) if b > a else np.zeros(1, np.uint64)
            own = {(j, int(tokens.mix(g + np.uint64(j)).min())) for j in range(4)}
            if not own & seen:
                keep.append(at + i)
            seen |= own
    return keep


def _evidence(texts: list[str], toxic: np.ndarray) -> list[bytes]:
    """Words whose presence speaks for toxic texts."""
    counts: dict[bytes, int] = {}  # texts with label 0, and with label 1 in the high bits
    for text, y in zip(texts, toxic.tolist()):
        for word in set(clean(text).split()):
            if ORDER <= len(word) <= WORD:
                counts[word] = counts.get(word, 0) + (1 << 32 * y)
    words = sorted(counts)
    if not words:
        return []
    df = np.array([(counts[w] & 0xFFFFFFFF, counts[w] >> 32) for w in words], float)
    n = np.array([(toxic == 0).sum(), (toxic == 1).sum()], float)
    share = df.sum(1) / n.sum()
    z = (df[:, 1] / n[1] - df[:, 0] / n[0]) / np.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1]) + 1e-12)
    best = np.argsort(-z, kind="stable")
    chosen = [i for i in best[:LANDMARKS] if z[i] >= EVIDENCE or i in best[:4]]
    return [words[i] for i in chosen]


def _machine(x: np.ndarray, y: np.ndarray, times: np.ndarray, cost: float = 4.0, rounds: int = 150) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss and balanced classes, by accelerated gradient descent."""
    sign = np.where(y == 1, 1.0, -1.0)
    toxic = max(float(times[y == 1].sum()), 1.0)
    weight = times * np.where(y == 1, 0.5 / toxic, 0.5 / max(float(times.sum()) - toxic, 1.0)) * cost
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    ridge = np.append(np.full(x.shape[1] - 1, 0.01), 1e-6)
    step = 1 / (2 * np.linalg.norm((x * weight[:, None]).T @ x, 2) + 0.02)
    w, ahead, t = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 1.0
    for _ in range(rounds):
        slack = np.maximum(0, 1 - sign * (x @ ahead))
        after = ahead - step * (2 * ridge * ahead - 2 * (weight * slack * sign) @ x)
        t_after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = after + (t - 1) / t_after * (after - w), after, t_after
    return w[:-1], float(w[-1])


def _logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton's method, with softened targets."""
    high = (y.sum() + 1) / (y.sum() + 2)
    low = 1 / (len(y) - y.sum() + 2)
    target = np.where(y == 1, high, low)
    x, ab = np.stack([margin, np.ones(len(y))], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        move = np.linalg.solve(hessian, (p - target) @ x + 1e-6 * ab)
        ab = ab - np.clip(move, -5, 5)
    return float(ab[0]), float(ab[1])


def learn(texts: list[str], toxic: np.ndarray, rounds: int = 3) -> Model:
    """Fit on texts with labels 0 and 1, on the driver; the caller bounds their number.

    Of near copies in the sample one is kept, so that a copied text does not pass for evidence.
    """
    keep = _apart(texts)
    texts, y = [texts[i] for i in keep], np.asarray(toxic, np.int64)[keep]
    share = float(y.mean()) if len(y) else 0.0
    landmarks = _evidence(texts, y) if 0 < share < 1 else []
    if not landmarks:
        odds = np.log(share / (1 - share)) if 0 < share < 1 else (30.0 if share else -30.0)
        return Model([], np.zeros(0), 0.0, 0.0, float(odds))
    sentences = Sentences(landmarks)
    m = len(landmarks)
    root = np.zeros((2 * m, 2 * m))
    for at, gram in enumerate(np.split(_both(kernel(*_padded(landmarks), landmarks, sentences.own).astype(float)), 2, 1)):
        values, vectors = np.linalg.eigh((gram + gram.T) / 2)
        root[at * m : at * m + m, at * m : at * m + m] = (vectors / np.sqrt(np.maximum(values, 0.05))) @ vectors.T
    column = pa.array([clean(t) for t in texts], pa.binary())
    of, rows = [], []
    for at, to in tokens.chunks(column, BYTES):
        o, r = sentences.features(column, at, to)
        of.append(o + at)
        rows.append(r)
    of = np.concatenate(of + [np.arange(len(texts))])
    rows = np.concatenate(rows + [np.zeros((len(texts), m), np.float32)])
    score = rows.max(1) - 0.5
    for _ in range(rounds):
        order = np.lexsort((-score, of))
        use = np.zeros(len(of), bool)
        use[order[np.concatenate([[True], of[order][1:] != of[order][:-1]])]] = True
        use |= (y[of] == 1) & (score > 0)
        # equal sentences are one instance with their number as its weight
        few, times = np.unique(np.column_stack([y[of[use]], rows[use]]), axis=0, return_counts=True)
        weights, bias = _machine(_both(few[:, 1:]) @ root, few[:, 0].astype(int), times)
        weights = root @ weights
        score = np.concatenate([_both(part) @ weights for part in np.array_split(rows, len(rows) // 4096 + 1)]) + bias
    top = np.full(len(texts), bias)
    np.maximum.at(top, of, score)
    slope, offset = _logistic(top, y)
    return Model(landmarks, weights, bias, slope, offset)


def fitted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS) -> Model:
    """The model from at most ``rows`` labelled documents outside the held-out fifth."""
    marked = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic")).filter(
        "toxic IN (0, 1) AND crc32(CAST(id AS STRING)) % 5 <> 0"
    )
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    ids = texts.select("id").join(marked.select("id").distinct(), "id", "left_semi").distinct()
    chosen = ids.orderBy(F.xxhash64("id"), "id").limit(rows)
    sample = texts.join(chosen, "id").join(marked.join(chosen, "id"), "id").select("text", "toxic").distinct().orderBy("text", "toxic").toPandas()
    return learn(sample["text"].tolist(), sample["toxic"].to_numpy())


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` as struct ``row``, with its ``score`` from 0 to 1."""
    rows, place = rows_and_text(docs, text_col)
    schema = rows.select("row").schema.add("score", "double")

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sentences = Sentences(model.landmarks) if model.landmarks else None
        for batch in stream:
            texts = tokens.texts(batch, place)
            for at, to in tokens.chunks(texts):  # small batches out, so memory stays bounded
                margin = margins(model, texts.slice(at, to - at).to_pylist(), sentences) if sentences else np.zeros(to - at)
                score = 1 / (1 + np.exp(-np.clip(model.slope * margin + model.offset, -30, 30)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), pa.array(score, pa.float64())], ["row", "score"])

    return rows.mapInArrow(run, schema)
