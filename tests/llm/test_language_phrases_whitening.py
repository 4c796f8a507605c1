"""Language identification, phrase collocations and whitening against brute force and on odd inputs."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from tidemark.llm import collocations, crossparse, whitening
from tidemark.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


# language identification


def naive_phrases(sample, text):
    """Greedy longest matches by substring search."""
    n = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and bytes(text[at : at + size + 1]) in sample:
            size += 1
        n, at = n + 1, at + size
    return n


def sentences(words, rng, n):
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 30))) for _ in range(n)]


WORDS = {
    "aa": ["dorun", "melok", "tisap", "an", "or", "ke"],
    "bb": ["wyxen", "qatch", "strolm", "the", "zz", "ij"],
    "cc": ["éàça", "ñüé", "çolé", "àé", "ñé"],
}


def samples(seed=1, n=40):
    rng = random.Random(seed)
    return {lang: sentences(words, rng, n) for lang, words in WORDS.items()}


def test_phrases_equal_a_search_for_longest_matches(monkeypatch):
    monkeypatch.setattr(crossparse, "SEGMENT", 7)
    learned = samples()
    model = crossparse.learn(learned)
    rng = random.Random(5)
    texts = ["", "x", "  ", "Dorun, an!", *sentences([w for ws in WORDS.values() for w in ws] + ["9q", "ab7"], rng, 60)]
    classes, first = crossparse.classified(texts, model.classes)
    got = crossparse.phrases(model, classes, first)
    for j, lang in enumerate(model.langs):
        own, begins = crossparse.classified(learned[lang], model.classes)
        pieces = [bytes(own[a:b]) + b"\0" for a, b in zip(begins[:-1], begins[1:])]
        sample = b"".join(pieces)[: crossparse.SAMPLE]
        for i, (a, b) in enumerate(zip(first[:-1], first[1:])):
            parts = [bytes(classes[k : min(k + 7, b)]) for k in range(a, b, 7)]
            assert got[i, j] == sum(naive_phrases(sample, part) for part in parts), (texts[i], lang)


def test_an_automaton_holds_the_substrings_and_no_others():
    rng = random.Random(2)
    text = np.array([rng.randrange(3) for _ in range(60)], np.uint8)
    steps = crossparse.automaton(text)
    whole = bytes(text)

    def known(piece):
        state = 0
        for c in piece:
            state = steps[state, c]
            if state == 0:
                return False
        return True

    for size in range(1, 6):
        for code in range(3**size):
            piece = bytes(code // 3**k % 3 for k in range(size))
            assert known(piece) == (piece in whole)


def test_gaps_case_and_rare_letters_share_classes():
    classes = crossparse.alphabet(["abc", "ABC"])
    own, first = crossparse.classified(["A--b", "", "  c", "日x"], classes)
    assert list(first) == [0, 3, 3, 5, 7]
    assert own[0] == classes[ord("a")] and own[1] == crossparse.GAP and own[3] == crossparse.GAP
    assert own[5] == own[6] == crossparse.OTHER


DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        # names that operators use themselves
        *[T.StructField(c, T.StringType()) for c in ("row", "score", "lang_pred", "n", "h", "p", "s", "length", "shard", "name")],
    ]
)


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame([(*r, *["x"] * 10) for r in rows], schema).repartition(3)


def test_odd_texts_have_a_defined_language(spark):
    rng = random.Random(3)
    rows = [(i, t, lang) for lang, ts in samples().items() for i, t in enumerate(ts, 100 * ord(lang[0]))]
    odd = [(1, None, "aa"), (2, "", "bb"), (3, "12 34 --", "aa"), (4, "²³", "aa"), (5, "dorun melok an", None), (5, "dorun melok an", None)]
    odd += [(None, "strolm wyxen the", "zz"), (6, " ".join(rng.choice(WORDS["cc"]) for _ in range(60_000)), None)]
    docs = frame(spark, rows + odd)
    model = crossparse.fitted(docs)
    assert model.langs == ["aa", "bb", "cc"]
    found = crossparse.identified(docs, model).select("row.doc_id", "row.text", "lang_pred", "score").collect()
    assert len(found) == len(rows) + len(odd)
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert by[1] == by[2] == by[3] == by[4] == [("und", 0.0)]
    assert [p for p, _ in by[5]] == ["aa", "aa"] and by[5][0] == by[5][1]
    assert by[None][0][0] == "bb" and by[6][0][0] == "cc"
    right = {i: lang for i, _, lang in rows}
    assert sum(by[i][0][0] == lang for i, lang in right.items()) >= 0.98 * len(right)
    assert all(0 <= s <= 1 for r in by.values() for _, s in r)


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], DOCS)
    assert crossparse.fitted(none) is None
    assert crossparse.identified(none, None).count() == 0
    docs = frame(spark, [(1, "some words", None), (2, None, "aa"), (3, "77", "aa")])
    assert crossparse.fitted(docs) is None
    assert {(r.lang_pred, r.score) for r in crossparse.identified(docs, None).collect()} == {("und", 0.0)}


def test_equal_languages_tie_to_the_first():
    model = crossparse.learn({"b": ["same words here"], "a": ["same words here"]})
    assert crossparse.judged(model, ["words", "here same"]) == (["a", "a"], pytest.approx([0, 0]))


def test_held_out_languages_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    found = QUERIES["op11_language_id"](spark, "/root/testdata/sf0.01").collect()
    assert sorted(r.doc_id for r in found) == sorted(truth)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    out = [r for r in found if r.held_out and truth[r.doc_id][0] and any(c.isalpha() for c in truth[r.doc_id][1])]
    right = sum(r.lang_pred == truth[r.doc_id][0] for r in out)
    assert len(out) > 150 and right >= 0.97 * len(out), (right, len(out))


# phrase collocations


def brute_collocations(rows, least, top):
    counts, total = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    counts[lang, tuple(w[i : i + k])] += 1
    often = {g: a for g, a in counts.items() if len(g[1]) > 1 and a >= least}
    dropped = set()
    for (lang, q), b in often.items():
        for size in range(2, len(q)):
            for i in range(len(q) - size + 1):
                if 100 * b >= 100 * counts[lang, q[i : i + size]]:
                    dropped.add((lang, q[i : i + size]))
    by = {}
    for (lang, p), a in often.items():
        if (lang, p) in dropped:
            continue
        cuts = []
        for k in range(1, len(p)):
            l, r = counts[lang, p[:k]], counts[lang, p[k:]]
            cuts.append((1000 * a * total[lang] // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        by.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return sorted(
        (lang, i, p.decode(), -a, l, r, total[lang], -s) for lang, some in by.items() for i, (s, a, p, l, r) in enumerate(sorted(some)[:top], 1)
    )


def phrase_rows(seed=4, n=120):
    rng = random.Random(seed)
    words = ["New", "york", "state", "of", "the", "art", "a", "b", "é", "日本", "x\x00y", "\x0bq"]
    fixed = ["New York state of the art", "a a a a a a", "of the, of the; of the!", "é\t日本  b"]
    out = []
    for i in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else " ".join(rng.choice(words) for _ in range(rng.randrange(0, 8))) for _ in range(4)]
        text = rng.choice([" ", ". ", "\n", "\x0c", "?"]).join(parts)
        out.append((i, rng.choice([text, text.upper()]), rng.choice(["en", "fr", None, "und"])))
    return out + out[:5] + [(None, "new york state of", "en"), (7, None, "en"), (8, "", None), (9, " . , ", "xx")]


@pytest.mark.parametrize("least,top", [(3, 2000), (10, 7)])
def test_collocations_equal_brute_force(spark, least, top):
    rows = phrase_rows()
    got = collocations.collocations(frame(spark, rows), least, top).collect()
    assert sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == brute_collocations(rows, least, top)


def test_counts_do_not_depend_on_slots_chunks_or_shards(spark, monkeypatch):
    rows = phrase_rows(seed=9, n=80)
    want = brute_collocations(rows, 4, 300)
    for names in ({"SLOTS": 1 << 15, "SHARDS": 4}, {"SHARDS": 1, "BYTES": 50, "TALLY": 20}):
        with monkeypatch.context() as m:
            for name, value in names.items():
                m.setattr(collocations, name, value)
            got = collocations.collocations(frame(spark, rows), 4, 300).collect()
        assert sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == want, names


def test_shared_slots_add_work_but_no_error(monkeypatch):
    """With every phrase in one slot all phrases are counted once that slot is reached."""
    import pyarrow as pa

    monkeypatch.setattr(collocations, "slots", lambda h: np.zeros(len(h), np.int64))
    reached = np.full((4, 1), collocations.NEVER, np.uint8)
    reached[:, 0] = [1, 1, 2, 3]
    column, lang, names = pa.array(["a b c d e f"]), pa.array(["x"]), np.array([5], np.uint64)
    for step, lengths in ((0, {1}), (1, {1, 2, 3}), (2, {2, 3, 4}), (3, {4, 5}), (4, {5}), (5, set())):
        tally = collocations.Tally()
        collocations.counted(tally, column, lang, names, 0, 1, reached if step else None, step)
        assert {n for batch in tally.rows() for n in batch.column(0).to_pylist()} == lengths, step


def test_no_documents_no_phrases(spark):
    none = spark.createDataFrame([], DOCS)
    assert collocations.collocations(none).count() == 0
    assert collocations.collocations(frame(spark, [(1, None, None), (2, "", "en"), (3, "one two", "en")])).count() == 0


def test_scratch_tables_of_the_scans_are_deleted(spark, monkeypatch):
    gone, kept = [], []
    discard, stored = collocations.discard, collocations.stored
    monkeypatch.setattr(collocations, "discard", lambda df: gone.append(df) or discard(df))
    monkeypatch.setattr(collocations, "stored", lambda df, name, **k: kept.append((name, stored(df, name, **k))) or kept[-1][1])
    collocations.collocations(frame(spark, phrase_rows()), 5).collect()
    assert len(gone) == sum(name in ("counts", "shards") for name, _ in kept)


def test_the_phrase_query_equals_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    columns = "lang rank phrase a l r n score".split()
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES['op12_phrase_collocations']}) ORDER BY ALL").fetchall()
    got = QUERIES["op12_phrase_collocations"](spark, SMALL).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want)


# whitening

VECTORS = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("x", T.StringType()), T.StructField("n", T.StringType())]
)


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "n") for i, v in rows], VECTORS).repartition(3)


def brute_whitening(rows):
    keep = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = {i: [math.floor(256 * float(np.float32(c))) for c in v] for i, v in keep}
    fit = sorted({tuple(v) for v in x.values()})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    m = np.array(fit, float)
    values, vectors = np.linalg.eigh(np.cov(m.T, bias=True))
    return x, n, sums, values[::-1], vectors[:, ::-1], m.mean(0)


def random_vectors(dim, many, seed=0):
    rng = np.random.default_rng(seed)
    scale = 2.0 ** -np.arange(dim) * 0.5 + 0.05
    return [(i, (rng.standard_normal(dim) * scale).astype(np.float32).tolist()) for i in range(many)]


@pytest.mark.parametrize("dim,many", [(40, 300), (16, 90), (5, 60), (3, 40)])
def test_whitening_equals_an_eigendecomposition(spark, dim, many):
    rows = random_vectors(dim, many)
    rows += rows[:10] + [(-1, None), (-2, [float("nan")] * dim), (-3, [None, *[0.0] * (dim - 1)]), (-4, [float("inf"), *[0.0] * (dim - 1)]), (-5, [0.5]), (-6, [])]
    got = whitening.whitened(vector_frame(spark, rows)).collect()
    x, n, sums, values, vectors, mean = brute_whitening([r for r in rows if r[1] is None or len(r[1]) == dim])
    some = min(4, dim)
    assert len(got) == some * (many + 10)
    signs = {}
    for r in got:
        k = r.component - 1
        want = (np.array(x[r.id]) - mean) @ vectors[:, k] / math.sqrt(values[k])
        sign = signs.setdefault(k, 1 if abs(r.whitened - want) < abs(r.whitened + want) else -1)
        assert r.whitened == pytest.approx(sign * want, abs=1e-8)
        assert r.n == n and r.deviation == sum((n * c - s) ** 2 for c, s in zip(x[r.id], sums))
        assert r.explained == pytest.approx(values[k] / values.sum(), rel=1e-9)
        assert 0 <= r.identity_error < 1e-9


def test_flat_directions_are_left_out(spark):
    rows = [(i, [float(i), 0.0, 1.0, float(-i)]) for i in range(20)] + [(None, [3.0, 0.0, 1.0, -3.0])]
    got = whitening.whitened(vector_frame(spark, rows)).collect()
    assert len(got) == 21 and {r.component for r in got} == {1} and got[0].explained == pytest.approx(1)
    constant = [(i, [1.0, 2.0]) for i in range(5)]
    assert whitening.whitened(vector_frame(spark, constant)).count() == 0
    assert whitening.whitened(vector_frame(spark, [])).count() == 0
    assert whitening.whitened(vector_frame(spark, [(1, None), (2, [])])).count() == 0


def test_huge_entries_do_not_crash(spark):
    rows = [(i, [float(i % 7), 1e30 * (-1) ** i, float(i)]) for i in range(30)]
    got = whitening.whitened(vector_frame(spark, rows)).collect()
    assert {r.deviation for r in got} == {None} and all(math.isfinite(r.whitened) for r in got)


def test_close_and_repeated_variances_are_certified():
    rng = np.random.default_rng(1)
    turn = np.linalg.qr(rng.standard_normal((60, 60)))[0]
    values = np.concatenate([[10, 9, 9, 8.999, 8.998], np.linspace(8.9, 0, 55)])
    v = turn * values @ turn.T
    found, vectors = whitening.leading(lambda q: v @ q, 60)
    assert found == pytest.approx(values[:4], rel=1e-12)
    assert np.abs(v @ vectors - vectors * found).max() < 1e-11
    assert np.abs(vectors.T @ vectors - np.eye(4)).max() < 1e-12


def test_sums_are_exact_at_any_size(spark):
    rows = [(i, [3e16, -3e16, 1.0]) for i in range(3)] + [(9, [3.1e16, 7.0, 2.0])]
    every = whitening.points(vector_frame(spark, rows))
    fit = whitening._packed(every.select("x").distinct(), 3)
    want = [sum(c) for c in zip(*{tuple(r.x) for r in every.collect()})]
    assert whitening._sums(fit, 3) == want
