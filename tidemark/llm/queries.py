"""The registered queries of the operators, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, collocations, crossparse, decontaminate, jaccard, sharding, simhash, substring, toxicity, training_order, warc, whitening, wrappers
from tidemark.llm.common import stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(plan):
        QUERIES[name] = plan
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return register


@query("op5_ngram_jaccard_join")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


@query(
    "op7_substring_dedup",
    r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (
    SELECT doc_id, p, array_to_string(words[p : p + 12], ' ') AS win
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS p FROM w)
),
covered AS (
    SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS p
    FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY win) AS low FROM starts) WHERE low < doc_id
),
kept AS (
    SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.p) AS kept, count(*) AS n
    FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM w) e
    ANTI JOIN covered c ON c.doc_id = e.doc_id AND c.p = e.p GROUP BY e.doc_id
)
SELECT w.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
""",
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).select(
        "row.doc_id",
        (F.expr("crc32(CAST(row.doc_id AS STRING)) % 5") == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op10_byte_level_bpe")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    ids = bpe.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    back = bpe.decoded(ids.select("row.doc_id", "ids"), ranks)
    return back.select(
        "row.doc_id",
        (F.octet_length("row.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("row.ids", 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )


@query(
    "op9_benchmark_decontamination",
    r"""
WITH d AS (SELECT doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL),
b AS (SELECT item_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
ds AS (SELECT DISTINCT id, array_to_string(w[i : i + 4], ' ') AS g
    FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
bs AS (SELECT DISTINCT id, array_to_string(w[i : i + 4], ' ') AS g
    FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM b WHERE len(w) > 0)),
n AS (SELECT id, count(*) AS n FROM bs GROUP BY id)
SELECT ds.id AS doc_id, bs.id AS item_id, count(*) AS shared, any_value(n.n) AS n_shingles, count(*) / any_value(n.n) AS containment
FROM ds JOIN bs USING (g) JOIN n ON n.id = bs.id GROUP BY ds.id, bs.id HAVING count(*) >= 0.75 * any_value(n.n)
""",
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    "op6_warc_revisits",
    """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT page_id, n, h, array_to_string(list_transform(range(0, 32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::BIGINT, 1)), '') AS d FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
    CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> m THEN m END AS refers_to
FROM (SELECT *, max(page_id) OVER (PARTITION BY h) AS m FROM b)
""",
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archived(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


@query("op3_sharding")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = stored(sharding.measured(table(spark, sf_dir, "documents")), "records")
    return sharding.sharded(records).select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op4_training_order")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.materialised(table(spark, sf_dir, "documents"))


@query("op2_document_fingerprints")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.edited_and_next(table(spark, sf_dir, "documents"))


@query("op1_html_extraction")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(table(spark, sf_dir, "pages"))


@query(
    "op12_phrase_collocations",
    r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS r,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces WHERE piece <> ''),
grams AS (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)
    GROUP BY ALL),
words AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang),
often AS (SELECT * FROM grams WHERE f >= 100),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS p FROM often WHERE k > 1),
inside AS (
    SELECT lang, array_to_string(p[i : i + m - 1], ' ') AS phrase, max(a) AS longer
    FROM (SELECT lang, p, k, a, m, unnest(range(1, k - m + 2)) AS i FROM c, (SELECT unnest(range(2, 5)) AS m) WHERE m < k)
    GROUP BY ALL),
cuts AS (
    SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, words.n, c.cut,
        (1000 * c.a::HUGEINT * words.n::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT) AS score
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c JOIN words USING (lang)
    JOIN often x ON x.lang = c.lang AND x.k = cut AND x.phrase = array_to_string(c.p[1 : cut], ' ')
    JOIN often y ON y.lang = c.lang AND y.k = c.k - cut AND y.phrase = array_to_string(c.p[cut + 1 : c.k], ' ')),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM weakest LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a
QUALIFY rank <= 2000
""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op13_embedding_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@query("op11_language_id")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = crossparse.fitted(docs)
    found = crossparse.identified(docs.select("doc_id", "text"), model)
    return found.select("row.doc_id", crossparse.held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score")
