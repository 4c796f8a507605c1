"""What must not grow faster than the input, and sums that must not overflow."""

import random
import time

import pytest

from tests.llm.test_operators import linked, near_copies
from tidemark.llm import jaccard, simhash
from tidemark.llm.common import CLEANUP, stored


def looked_at(monkeypatch):
    """The numbers of pairs that reach the sketches of whole sets."""
    seen, was = [], jaccard.plausible

    def counted(pairs, *rest):
        seen.append(pairs.count())
        return was(pairs, *rest)

    monkeypatch.setattr(jaccard, "plausible", counted)
    return seen


@pytest.mark.parametrize("run", [12, 1])
def test_texts_that_share_a_chance_shingle_are_no_candidates(spark, monkeypatch, run):
    monkeypatch.setattr(jaccard, "SMALL_RUN", run)
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10**9)}"
    shared = [[word() for _ in range(5)] for _ in range(30)]
    texts = {}
    for i in range(120):  # each shares one shingle with three others
        text = [word() for _ in range(60)]
        text[20:25] = shared[i // 4]
        texts[i] = " ".join(text)
    texts[500] = " ".join([*texts[7].split()[:-2], "x", "y"])
    seen = looked_at(monkeypatch)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_documents(frame).collect()}
    assert got == linked(texts) and got[500][1] == 7
    assert seen == [1]


@pytest.mark.parametrize("run", [1, 2, 3, 6])
def test_counted_meetings_lose_no_link(spark, monkeypatch, run):
    """Copies around the threshold, of sizes with all spare lanes and with fewer, met outright and in runs."""
    monkeypatch.setattr(jaccard, "SMALL_RUN", run)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    texts = {}
    for k, words in enumerate((5, 6, 7, 8, 9, 11, 14, 19, 21, 24, 60)):
        texts |= {1000 * k + i: t for i, t in near_copies(14, words, seed=k).items()}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_documents(frame).collect()}
    assert got == linked(texts)


def test_a_stored_frame_leaves_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size())}

    before = {f for f in shuffles() if f.startswith("shuffle_")}
    stored(spark.range(1000).selectExpr("id % 7 AS k", "id").groupBy("k").count(), "counts")
    for _ in range(50):  # they are removed in the background
        left = {f for f in shuffles() if f.startswith("shuffle_")} - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(CLEANUP, "false") == "false"


def test_long_runs_of_one_term_do_not_overflow_the_votes(spark):
    """Only the one term votes, so the fingerprint is that of a short text of it."""
    rows = [(0, "elephant " * 20000), (1, "elephant elephant"), (2, "elephant " * (2 * simhash.CHUNK + 1)), (3, "elephant " * 16000 + "dog")]
    got = {r["id"]: (r["f1"], r["f2"]) for r in simhash.fingerprints(spark.createDataFrame(rows, "id long, text string"), ["id"]).collect()}
    assert got[0] == got[1] == got[2] == got[3]
