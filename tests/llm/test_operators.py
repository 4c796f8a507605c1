"""The operators on small inputs, against brute force, with nulls, ties, repeated rows and empty tables."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, jaccard, sharding, simhash, substring, tokens, toxicity, training_order, warc, wrappers
from tidemark.llm.common import components, rows_and_text, stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, k=5):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def linked(texts, threshold=75):
    sets = {i: shingles(t) for i, t in texts.items()}
    low = {i: i for i in texts}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(sorted(texts), 2):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= threshold * len(x | y) and low[a] != low[b]:
                low[a] = low[b] = min(low[a], low[b])
                changed = True
    return {i: (len(sets[i]), low[i]) for i in texts}


def near_copies(many, words=60, seed=3):
    """Copies of one text with a few words changed, around the threshold, and unrelated texts."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    out = {}
    for i in range(many):
        w = list(base)
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(words)] = f"z{rng.randrange(10**6)}"
        out[i] = " ".join(w)
    for i in range(many, many + 20):
        out[i] = " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 80)))
    return out


def test_word_hashes_follow_the_pattern():
    import pyarrow as pa

    texts = ["a b", "", "c\td ", "", "e", "é ü\x0b日本", "ab", "abc"]
    column = pa.array(texts).slice(1)
    w = tokens.words(column, 0, len(column))
    got = [[bytes(w.data[x:y]).decode() for x, y in zip(w.begin[a:b], w.end[a:b])] for a, b in zip(w.first[:-1], w.first[1:])]
    assert got == [WORD.findall(t) for t in texts[1:]]
    assert len(set(w.hashes.tolist())) == len({x for t in texts[1:] for x in WORD.findall(t)})


def test_components(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (3, 9), (7, 8), (8, 8), (2, 2)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {3: 3, 4: 3, 5: 3, 9: 3, 7: 7, 8: 7}
    assert components(edges.limit(0)).count() == 0


def test_jaccard_small(docs, texts, none, odd):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_documents(docs).collect()}
    assert got == linked(texts)
    assert jaccard.similar_documents(none).count() == 0
    shared = sorted(tuple(r) for r in jaccard.similar_documents(odd).collect())
    assert shared == [(1, 2, 1), (1, 3, 1), (1, 3, 1), (2, 3, 1)]


def test_jaccard_large_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL_RUN", 4)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    texts = near_copies(60)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_documents(frame).collect()}
    assert got == linked(texts)


def meet(spark, rows):
    """Pairs that come out at once, and pairs that share a long run."""
    sketch = spark.createDataFrame(rows, "lane long, fp long, n int").repartition(1).sortWithinPartitions("lane", "fp")
    found, runs = jaccard.meetings(sketch).collect(), {}
    for r in found:
        if r["b"] is None:
            runs.setdefault(r["lane"], set()).add(r["a"])
    return {(r["a"], r["b"]) for r in found if r["b"] is not None}, {(x, y) for m in runs.values() for x in m for y in m if x < y}


def test_entries_of_sizes_that_rule_a_link_out_are_no_long_run(spark):
    spread = [(1, i, round(10 * 1.2**i)) for i in range(60)]  # only neighbours may be linked
    pairs, together = meet(spark, spread)
    assert not together
    assert pairs == {(i, j) for _, i, x in spread for _, j, y in spread if i < j and 100 * x >= 75 * y}


def test_chunks_are_small():
    import pyarrow as pa

    assert max(b - a for a, b in tokens.chunks(pa.array(["x" * 1000] * 9000))) <= 1 << 11


def test_every_pair_that_may_be_linked_meets(spark):
    rng = random.Random(3)
    rows = [(lane, fp, rng.choice([1, 1, -1]) * round(rng.choice([20, 50, 51, 400]) * 1.5 ** rng.random())) for lane in range(-4, 4) for fp in rng.sample(range(500), 60)]
    pairs, together = meet(spark, rows + rows[:40])
    may = {(min(i, j), max(i, j)) for a, i, x in rows for b, j, y in rows if a == b and i != j and (x > 0 or y > 0) and 100 * min(abs(x), abs(y)) >= 75 * max(abs(x), abs(y))}
    assert may <= pairs | together and pairs <= may and pairs and together


def test_parity_distance_is_a_lower_bound():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 400, rng.integers(1, 700)).astype(np.uint64)) for _ in range(2))
        assert jaccard.parity_distance(jaccard.parity(a), jaccard.parity(b)) <= len(np.setxor1d(a, b))


def removed(texts, window=13):
    starts, low = {}, {}
    for i, t in texts:
        w = WORD.findall(t or "")
        starts[i] = w
        for p in range(len(w) - window + 1):
            g = tuple(w[p : p + window])
            low[g] = min(low.get(g, i), i)
    out = {}
    for i, w in starts.items():
        gone = {q for p in range(len(w) - window + 1) if low[tuple(w[p : p + window])] < i for q in range(p, p + window)}
        out[i] = (len(w), len(gone), " ".join(x for q, x in enumerate(w) if q not in gone))
    return out


def repeats(seed=5):
    rng = random.Random(seed)
    passages = [[f"p{rng.randrange(50)}" for _ in range(rng.randrange(10, 40))] for _ in range(6)]
    texts = []
    for i in range(60):
        w = []
        for _ in range(rng.randrange(0, 5)):
            w += [f"v{rng.randrange(5)}" for _ in range(rng.randrange(0, 30))] + rng.choice(passages)
        texts.append((i, " ".join(w) if i % 7 else None))
    return texts + [(100, texts[1][1]), (101, " ".join(["same"] * 100)), (102, " ".join(["same"] * 40))]


@pytest.mark.parametrize("hot", [2000, 3])
def test_substrings_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT_ANCHOR", hot)
    texts = repeats()
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    got = {r["row"]["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substring.without_repeats(frame).collect()}
    assert got == removed(texts)


def test_substrings_defined_cases(none, odd, docs, texts):
    assert substring.without_repeats(none).count() == 0
    assert substring.without_repeats(odd).count() == 6
    got = {r["row"]["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substring.without_repeats(docs).collect()}
    assert got == removed(texts.items())


def test_fm_index_counts_occurrences():
    rng = np.random.default_rng(2)
    text = np.concatenate([np.append(rng.integers(1, 4, 40), 0) for _ in range(5)])
    index = substring.FMIndex(text, 6)
    for length in (1, 3, 5):
        ends = np.array([e for e in range(length - 1, len(text)) if 0 not in text[e - length + 1 : e + 1]])
        alive, low, high = index.matches(text, ends, length)
        words = [tuple(text[e - length + 1 : e + 1]) for e in ends]
        counts = [words.count(w) for w in words]
        assert {i: int(h - l) for i, l, h in zip(alive, low, high)} == {i: c for i, c in enumerate(counts) if c > 1}


def test_bpe_equals_tiktoken():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder, decoder = bpe.Encoder(ranks, public_tokenizers.PATTERN), bpe.Decoder(ranks)
    rng = random.Random(4)
    cases = ["", " ", "<|endoftext|>", "aaaaaaa" * 50, "I'll we've 12 3", "日本語\n\n x", "\x1c\x85 \xa0b", "".join(map(chr, range(0x310)))]
    cases += ["".join(rng.choice("aab bcé\n\t日1.'ls") for _ in range(rng.randrange(60))) for _ in range(300)]
    for text in cases:
        ids = encoder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == other.encode_ordinary(text)
        assert decoder.decode(ids) == text.encode()


def test_bpe_of_many_words_by_one_queue(monkeypatch):
    """Short pre-tokens are merged together, also where a merge gives a smaller rank; long ones by themselves."""
    rng = random.Random(17)
    for draw in range(30):
        names = {"".join(rng.choice("abc") for _ in range(rng.randrange(2, 6))) for _ in range(60)}
        later = rng.sample(sorted(names), len(names))  # in any order, so longer tokens often come before their parts
        ranks = {bytes([b]): b for b in range(256)} | {w.encode(): 256 + i for i, w in enumerate(later)}
        other = tiktoken.Encoding(f"own{draw}", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        texts = [" ".join("".join(rng.choice("abc") for _ in range(rng.randrange(1, 30))) for _ in range(40)) for _ in range(5)] + ["", "é" + "abc" * 40]
        encoder, long = bpe.Encoder(ranks, public_tokenizers.PATTERN), []
        merge = encoder.merge
        monkeypatch.setattr(encoder, "merge", lambda data: long.append(data) or merge(data))
        monkeypatch.setattr(bpe, "SHARED", rng.choice([1, 50, 1 << 17]))
        for _ in range(2):
            assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode_all(texts)] == [other.encode_ordinary(t) for t in texts]
        assert all(len(data) > bpe.KEPT_BYTES for data in long) and long
        assert all(len(p) <= bpe.KEPT_BYTES for p in encoder.tables[0])


def test_bpe_frame(docs, texts, none):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    for frame, count in ((docs, len(texts)), (none, 0)):
        back = bpe.decoded(bpe.encoded(frame, ranks, public_tokenizers.PATTERN).select("row.doc_id", "ids"), ranks).collect()
        assert len(back) == count
        assert all(bytes(r["data"]).decode() == (texts[r["row"]["doc_id"]] or "") for r in back)


def test_toxicity_learns_and_tolerates_gaps(spark, none, docs):
    rng = random.Random(6)
    calm, bad = [f"word{i}" for i in range(40)], ["grobian", "dunderhead", "nitwit"]
    rows = []
    for i in range(400):
        w = [rng.choice(calm) for _ in range(12)]
        toxic = i % 4 == 0
        if toxic:
            w[rng.randrange(12)] = rng.choice(bad)
        rows.append((i, ". ".join([" ".join(w), " ".join(rng.choices(calm, k=6))]), int(toxic)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fitted(frame.drop("toxic"), frame.select("doc_id", "toxic"))
    held = [r for r in toxicity.scored(frame, model).collect() if zlib.crc32(str(r["row"]["doc_id"]).encode()) % 5 == 0]
    assert all((r["score"] >= 0.5) == bool(r["row"]["toxic"]) for r in held)
    some = spark.createDataFrame([(1, "such a g r o b i a n here"), (2, "a grob-ian here"), (3, None), (4, "x" * 5000)], "doc_id long, text string")
    got = {r["row"]["doc_id"]: r["score"] for r in toxicity.scored(some, model).collect()}
    assert got[1] >= 0.5 and got[2] >= 0.5 and got[3] < 0.5 and got[4] < 0.5
    assert toxicity.scored(none, model).count() == 0
    blank = toxicity.fitted(docs, frame.select("doc_id", "toxic").limit(0))
    assert {r["score"] < 0.01 for r in toxicity.scored(docs, blank).collect()} == {True}


def test_kernel_counts_gapped_subsequences():
    def brute(a, b):
        total = 0.0
        for x in itertools.combinations(range(len(a)), toxicity.ORDER):
            for y in itertools.combinations(range(len(b)), toxicity.ORDER):
                if [a[i] for i in x] == [b[j] for j in y]:
                    total += toxicity.DECAY ** (x[-1] - x[0] + 1 + y[-1] - y[0] + 1)
        return total

    pairs = [(b"idiot", b"idxiot"), (b"abcabc", b"abcab"), (b"moron", b"oron"), (b"abcd", b"dcba")]
    x, y = toxicity._padded([p[0] for p in pairs]), toxicity._padded([p[1] for p in pairs])
    norm = toxicity.DECAY ** (2 * toxicity.ORDER)
    got = toxicity._pairs(*x, *y)
    want = np.array([brute(*p) for p in pairs])
    ratio = got[want > 0] / want[want > 0]
    assert np.allclose(ratio, ratio[0], rtol=1e-4) and norm > 0 and (got[want == 0] == 0).all()


def test_kernel_is_evaluated_wherever_it_is_not_zero():
    rng, marks = random.Random(13), [b"idiot", b"stupid", b"aabbcc", "réeux".encode()]
    words = [b"idi0t", b"st*pid", b"stup1d", b"idxiot", b"idot", b"abc", b"aab", "réuex".encode()]
    words += [bytes(rng.choice(b"abcidostup01") for _ in range(rng.randrange(1, 12))) for _ in range(300)]
    own, (chars, size) = toxicity.self_kernel(marks), toxicity._padded(words)
    got = toxicity.kernel(chars, size, marks, own)
    to, to_size = toxicity._padded(marks)
    for m in range(len(marks)):
        some = np.full(len(words), m)
        raw, mine = toxicity._pairs(chars, size, to[some], to_size[some]), toxicity._pairs(chars, size, chars, size)
        want = np.where(raw > 0, raw / np.sqrt(np.where(mine > 0, mine, 1) * own[m]), 0)
        assert np.allclose(got[:, m], want, atol=1e-5)
    assert got[0, 0] > 0.1 and (got[1:3, 1] > 0.1).all()


def test_kernel_is_evaluated_for_common_subsequences_only(monkeypatch):
    def common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    rng, marks = random.Random(23), [b"idiot", b"stupid", b"aabbcc", "réeux".encode(), b"abc", b"x" * toxicity.WORD]
    words = [b"toidi", b"dcba", b"idxiot", b"abc", b"x" * toxicity.WORD, b"\x00\x00\x00\x00"]
    words += [bytes(rng.choice(b"abcidostupx\0") for _ in range(rng.randrange(1, toxicity.WORD + 1))) for _ in range(300)]
    own, (chars, size) = toxicity.self_kernel(marks), toxicity._padded(words)
    asked, pairs = [], toxicity._pairs
    monkeypatch.setattr(toxicity, "_pairs", lambda x, *rest: asked.append(len(x)) or pairs(x, *rest))
    got = toxicity.kernel(chars, size, marks, own)
    near = np.array([[common(w, m) >= toxicity.ORDER for m in marks] for w in words])
    assert ((got > 0) == near).all()
    assert asked[0] == near.sum()


def test_longest_sentences_and_words_of_many_pieces_score_alike(monkeypatch):
    """Sentences are gathered in parts; a sentence of more words than a part is one sentence still."""
    rng, marks = random.Random(29), [b"idiot", b"stupid"]
    some = ["idiot", "stupidly", "idxiot", "calm", "i d i o t", "st.upid"]
    texts = [". ".join(" ".join(rng.choice(some) for _ in range(rng.randrange(30))) for _ in range(rng.randrange(4))) for _ in range(60)]
    column = pa.array([toxicity.clean(t) for t in texts], pa.binary())
    found = []
    for size in (1, 5, 1 << 12):
        monkeypatch.setattr(toxicity, "GATHERED", size)
        found.append(toxicity.Sentences(marks).features(column, 0, len(texts)))
    for of, rows in found[:2]:
        assert (of == found[2][0]).all() and (rows == found[2][1]).all()
    assert len(found[2][0])


@pytest.mark.parametrize("kind", ["string", "binary"])
def test_text_goes_to_the_workers_once(spark, kind):
    rows = spark.sql(f"SELECT 1L AS doc_id, CAST('an idiot' AS {kind}) AS text, 'x' AS more UNION ALL SELECT NULL, NULL, NULL")
    sent, place = rows_and_text(rows)
    assert (sent.columns, place) == ((["row"], 1) if kind == "string" else (["row", "text"], None))
    model = toxicity.learn(["an idiot here"] * 2 + [f"calm word{i}" for i in range(9)], np.array([1] * 2 + [0] * 9))
    plans = [toxicity.scored(rows, model), bpe.encoded(rows, {bytes([b]): b for b in range(256)}, public_tokenizers.PATTERN)]
    for plan in plans:
        found = {r["row"]["doc_id"]: r for r in plan.collect()}
        assert found[1]["row"]["more"] == "x" and len(found) == 2
    assert {r["row"]["doc_id"]: len(r["ids"]) for r in plans[1].collect()} == {1: 4 * len("an idiot"), None: 0}


def test_decontamination(spark, docs, none):
    rng = random.Random(8)
    items = {i: " ".join(f"b{rng.randrange(10**5)}" for _ in range(15 + 20 * i)) for i in range(8)}
    items |= {20: "one two", 21: None, 22: ""}
    rows = []
    for i in range(40):
        w = [f"c{rng.randrange(10**5)}" for _ in range(rng.randrange(0, 3000))]
        if i % 2:
            own = items[i % 8].split()
            own = own[: max(5, int(len(own) * (1.0 if i % 3 else 0.9)))]
            at = rng.randrange(len(w) + 1)
            w[at:at] = own
        rows.append((i, " ".join(w)))
    rows += [(50, "ONE two"), (51, None), (None, items[0])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    sets, want = {i: shingles(t) for i, t in items.items()}, set()
    for d, t in rows:
        for i, s in sets.items():
            if s and d is not None and len(s & shingles(t)) >= 0.75 * len(s):
                want.add((d, i, len(s & shingles(t)), len(s)))
    got = {(r["doc_id"], r["item_id"], r["shared"], r["n_shingles"]) for r in decontaminate.contaminated(frame, bench).collect()}
    assert got == want and len(want) > 15
    assert decontaminate.contaminated(none, bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_decontamination_finds_short_items_in_long_documents(spark):
    rng = random.Random(12)
    items = {i: [f"s{rng.randrange(10**6)}" for _ in range(5 + i % 6)] for i in range(60)}
    items |= {i: [f"s{rng.randrange(10**6)}" for _ in range(14)] for i in range(60, 80)}
    rows, want = [], set()
    for i, item in items.items():
        w = [f"c{rng.randrange(10**6)}" for _ in range(rng.randrange(500, 3000))]
        at, n = rng.randrange(len(w)), len(item) - 4
        held = item[:12] if i >= 60 else item  # of 10 shingles 8 are held, at the threshold
        w[at:at] = held
        rows.append((i, " ".join(w)))
        want.add((i, i, len(held) - 4, n))
        rows.append((1000 + i, " ".join(w[:at] + item[:-3] + w[at + len(held) :])))  # below the threshold
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    found = decontaminate.contaminated(frame, bench).collect()
    assert {(r["doc_id"], r["item_id"], r["shared"], r["n_shingles"]) for r in found} == want


@pytest.mark.parametrize("hot", [False, True])
def test_sharding(spark, hot, none, odd):
    rng = random.Random(9)
    rows = [(i, "hot" * 20 if hot and i % 3 else "t" * rng.randrange(0, 400)) for i in range(6000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.sharded(sharding.measured(frame)).toPandas()
    assert len(got) == len(rows)
    by = got.groupby("shard").agg(bytes=("size", "sum"), n=("slot", "count"), top=("slot", "max"), slots=("slot", "nunique"))
    assert len(by) == 24 and (by["n"] == by["top"] + 1).all() and (by["n"] == by["slots"]).all()
    assert by["bytes"].max() < 1.1 * by["bytes"].mean() and by["bytes"].min() > 0.9 * by["bytes"].mean()
    text = dict(rows)
    assert all(r.size_ == len(text[r.id]) + 8 and r.text_crc32 == zlib.crc32(text[r.id].encode()) for r in got.rename(columns={"size": "size_"}).itertuples())
    alike = spark.createDataFrame([(None, "same text")] * 3000 + [(7, "same text")] * 2000, "doc_id long, text string").repartition(4)
    lost = sharding.sharded(stored(sharding.measured(alike), "alike")).groupBy("shard").count().toPandas()
    assert len(lost) == 24 and lost["count"].max() < 1.2 * 5000 / 24
    assert sharding.sharded(sharding.measured(none)).count() == 0
    assert sharding.sharded(sharding.measured(odd)).count() == 6


def test_training_order_is_a_permutation(spark):
    for n in (1, 2, 3, 64, 1000, 4097):
        both = spark.range(n).select(*[training_order.permuted(F.col("id"), n, key) for key in (1, 2)]).collect()
        one, two = zip(*both)
        assert sorted(one) == sorted(two) == list(range(n))
        assert n < 64 or one != two and abs(np.corrcoef(one, range(n))[0, 1]) < 0.4


def test_sequences_are_compressed_on_their_way_to_the_shards(spark):
    rows = [(s, (f"{s % 7} words that come again " * 30).encode()[:512]) for s in random.Random(2).sample(range(4000), 3000)]
    placed = spark.createDataFrame(rows, "slot long, value binary").repartition(3)
    moved = training_order.packed(placed, 512, 100, 40, 8)
    found = moved.collect()
    assert all({s // 100 * 8 // 40 for s in np.frombuffer(r["slots"], np.int64).tolist()} == {r["range"]} for r in found)
    assert sum(len(r["packed"]) + len(r["slots"]) for r in found) < 3000 * 512 / 4
    assert sorted((r["slot"], bytes(r["value"])) for r in training_order.unpacked(moved.select("slots", "packed"), 512).collect()) == sorted(rows)


def test_training_order_round_trip(spark, docs, texts, none, odd, monkeypatch):
    from tidemark.session import scratch_path

    path = scratch_path(spark, "test-order")
    found = {r["slot"]: r for r in training_order.written(docs, path, key=3, shard_bytes=2000).collect()}
    back = {r["slot"]: bytes(r["ids"]) for r in training_order.read_back(spark, path, shard_bytes=2000).collect()}
    assert sorted(found) == sorted(back) == list(range(len(back)))
    whole = {}
    for slot, r in sorted(found.items(), key=lambda x: (x[1]["doc_id"], x[1]["seq_no"])):
        ids = back[slot]
        assert ids[r["n_tokens"] :].strip(training_order.fill_mark(1)) == b""
        whole[r["doc_id"]] = whole.get(r["doc_id"], b"") + ids[: r["n_tokens"]]
    assert whole == {i: (t or "").encode() + training_order.end_mark(1) for i, t in texts.items()}
    # equal rows have sequences of their own
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in training_order.materialised(odd).collect()) == [
        (False, 1), (False, 1), (False, 1), (False, 2), (True, 0), (True, 0)
    ]
    assert training_order.materialised(none).count() == 0


@pytest.mark.parametrize("width", [2, 4])
def test_token_ids_are_read_from_any_slot(spark, docs, none, width):
    """Ids of 2 and 4 bytes from the BPE encoder; a read from slot s is the tail of a full read and leaves shards unread."""
    from tidemark.session import scratch_path

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    ids = bpe.encoded(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN).select("row.doc_id", "ids")
    narrow = ids.rdd.map(lambda r: (r.doc_id, bytearray(np.frombuffer(bytes(r.ids), "<u4").astype(f"<u{width}").tobytes()))).toDF("doc_id long, ids binary")
    path = scratch_path(spark, "test-ids")
    kind = {"length": 16, "width": width, "shard_bytes": 300}
    found = {r.slot: r for r in training_order.written(narrow, path, key=5, ids_col="ids", **kind).collect()}
    whole = {r.slot: bytes(r.ids) for r in training_order.read_back(spark, path, **kind).collect()}
    assert sorted(found) == sorted(whole) == list(range(len(whole)))
    texts = {}
    for slot, r in sorted(found.items(), key=lambda x: (x[1].doc_id, x[1].seq_no)):
        texts.setdefault(r.doc_id, []).extend(np.frombuffer(whole[slot], f"<u{width}")[: r.n_tokens].tolist())
    assert texts == {r.doc_id: [*np.frombuffer(bytes(r.ids), "<u4").tolist(), 256**width - 1] for r in ids.collect()}
    for start in (0, 1, 37, len(whole) - 1, len(whole)):
        tail = training_order.read_back(spark, path, start_slot=start, **kind)
        assert {r.slot: bytes(r.ids) for r in tail.collect()} == {s: i for s, i in whole.items() if s >= start}
    plan = training_order.read_back(spark, path, start_slot=37, **kind)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard" in plan


def test_fingerprints(spark, docs, texts, none, odd):
    got = {r["doc_id"]: r for r in simhash.edited_and_next(docs).collect()}
    order = sorted(texts)
    for i, d in enumerate(order):
        text, after = texts[d] or "", texts[order[(i + 1) % len(order)]] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert (got[d]["n_chars"], got[d]["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
    assert got[1]["fingerprint"] == got[2]["fingerprint"] and got[1]["near_next"] == 1.0
    assert got[5]["fingerprint"] == "0" * 32
    assert simhash.edited_and_next(none).count() == 0
    assert simhash.edited_and_next(odd).count() == 4


def test_fingerprint_votes_and_search(spark):
    rng = random.Random(10)
    rows = [(i, " ".join(rng.choice(["alpha", "be", "gamma", "de", "epsilon"]) for _ in range(n))) for i, n in enumerate([1, 2, 30, 40000])]
    frame = spark.createDataFrame(rows, "id long, text string")
    got = {r["id"]: (r["f1"], r["f2"]) for r in simhash.fingerprints(frame, ["id"]).collect()}
    terms = frame.select("id", simhash._terms(F.col("text")).alias("_w")).select("id", simhash._pairs("_w").alias("t"))
    hashed = terms.select("id", F.explode_outer("t").alias("t")).select("id", F.col("t").bitwiseAND(3).alias("w"), F.xxhash64("t", F.lit(1)).alias("h1"), F.xxhash64("t", F.lit(2)).alias("h2")).toPandas()
    for i, part in hashed.groupby("id"):
        for half, column in enumerate(("h1", "h2")):
            bits = (part[column].to_numpy().view(np.uint64)[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
            votes = (bits.astype(int) * part["w"].to_numpy()[:, None]).sum(0)
            want = sum(1 << b for b in range(64) if 2 * votes[b] > part["w"].sum())
            assert want == got[i][half] % (1 << 64)
    base = [rng.getrandbits(63) for _ in range(2)]
    prints = [(base[0] ^ (1 << a) ^ (1 << b), base[1]) for a in range(0, 60, 7) for b in range(0, 60, 11)] + [(base[0], base[1] ^ 0b11111)]
    table = spark.createDataFrame(prints, "f1 long, f2 long")
    asked = spark.createDataFrame([tuple(base), prints[5]], "f1 long, f2 long")
    near = {(r["q1"], r["q2"]): r["n_near"] for r in simhash.within(asked, table, 3).collect()}
    distance = lambda x, y: (x[0] ^ y[0]).bit_count() + (x[1] ^ y[1]).bit_count()
    assert near == {q: sum(distance(q, p) <= 3 for p in prints) for q in (tuple(base), prints[5])}


def test_warc_round_trip(spark):
    rows = [(1, "http://a/x y", "same", "z"), (2, None, "same", "z"), (3, "http://b", None, "z"), (4, "http://c", "", "z"), (None, "u", "same", "z"), (5, "http://d\r\nX: 1", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\né", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, size string")
    got = {r["id"]: (r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.archived(pages).collect()}
    assert got == {1: (4, "revisit", 2), 2: (4, "response", None), 3: (0, "revisit", 4), 4: (0, "response", None), None: (4, "response", None), 5: (len(rows[5][2].encode()), "response", None)}
    assert warc.archived(pages.limit(0)).count() == 0


PAGE = """<html><head><title>t</title><script>var p="</p>"</script></head><body><nav><ul><li>Menu</li></ul></nav>
<div class="cookie-notice">We use cookies</div><{main}><h1>Head&eacute;</h1><p>{a}<br>line <b>bo</b>ld</p><p>open <!-- x -->&lt;i&gt;
<div class="ad">Buy</div><form><p>Mail</p></form></{main}><section class="comments"><p>{c}</p></section><footer>&copy;</footer></body></html>"""


def test_wrappers(spark):
    pages = [(i, f"http://{h}/{i}", PAGE.format(main=m, a=f"text {i}", c=f"reply {i}")) for i, (h, m) in enumerate([("a.x", "article")] * 4 + [("b.x", "section")] * 4)]
    pages += [(20, None, None), (21, "http://a.x/1", ""), (22, "http://a.x/2", "<html><body><article><p>cut off <"), (23, "nohost", "plain")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in wrappers.main_text(frame).collect()}
    for i in range(4):
        assert got[i] == f"Headé\ntext {i} line bold\nopen <i>"
    for i in range(4, 8):
        assert f"text {i} line bold" in got[i] and not re.search("Menu|cookies|Buy|Mail|reply|©", got[i])
    assert got[20] == got[21] == "" and got[22] == "cut off" and got[23] == "plain"
    assert wrappers.main_text(frame.limit(0)).count() == 0


def main_texts(spark, pages):
    frame = spark.createDataFrame([(i, f"http://{h}/{i}", "<html><body><div class='nav'>Menu</div>" + b + "</body></html>") for i, (h, b) in enumerate(pages)], "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in wrappers.main_text(frame.repartition(3)).collect()}


def test_wrappers_decide_by_page(spark):
    long = "body " * 30
    got = main_texts(
        spark,
        [("m.x", f"<article><p>own {i}</p></article>") for i in range(2)]
        + [("m.x", "<main><p>in main</p></main>"), ("m.x", "<div><p>in divs</p></div>")]
        + [("m.x", f"<article><p>card {i}</p></article><article><p>card</p></article><div><p>{long}{i}</p></div>") for i in range(2)],
    )
    assert [got[i] for i in range(4)] == ["own 0", "own 1", "in main", "in divs"]
    assert all(f"{long}{i}" in got[4 + i] for i in range(2))


def test_wrappers_keep_rare_blocks_and_identical_pages(spark):
    once = "<h2>Only here</h2><pre>code once</pre>"
    pages = [("o.x", f"<div><b>Same on all</b></div><section><p>text {i}</p>{once if i == 2 else ''}</section>") for i in range(6)]
    pages += [("i.x", "<div><p>all equal</p></div>")] * 5
    # copies of one page are one page: its own block is no more common for them
    pages += [("c.x", f"<div><b>Same</b></div><section><p>text {i}</p></section>") for i in range(3)]
    pages += [("c.x", "<div><b>Same</b></div><section><p>text 9</p><h2>copied</h2></section>")] * 9
    got = main_texts(spark, pages)
    assert got[0] == "text 0" and got[2] == "text 2\nOnly here\ncode once"
    assert all(got[i] == "all equal" for i in range(6, 11))
    assert got[11] == "text 0" and all(got[i] == "text 9\ncopied" for i in range(14, 23))
