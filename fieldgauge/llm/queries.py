"""The registered queries of this folder, each an operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch
from . import collocations, decontaminate, fill_middle, line_dedup, packing, prefix_counts, quality, simhash
from . import token_files, topk, toxicity, url_filter, warc
from .common import bound_batches, table
from .tokens import vocabulary

VOCABULARY = "word_bpe_49k.json"
TOKEN_LIMIT = 2048
URL_RULES = (
    url_filter.Rule("net/", "block"),
    url_filter.Rule("example.net/en/", "allow"),
    url_filter.Rule("example.com/de/", "block"),
    url_filter.Rule("org/fr/", "allow"),
)
QUERY_STEP = 50


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary(VOCABULARY))
    return token_files.read_tokens(spark, path).select(
        "doc_id", "start", "n_tokens", token_files.ids_crc32("ids").alias("ids_crc32")
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(VOCABULARY)).select(
        "doc_id", "piece", "start", "length", token_files.ids_crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


def op4_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.as_hex("fp").alias("fingerprint"), "component_id"
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op7_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    steps = prefix_counts.prefix_steps(vocabulary(VOCABULARY))
    answers = prefix_counts.prefix_summary(TOKEN_LIMIT)
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        answers(steps("text")).alias("prefix"),
    )
    return docs.select(
        "doc_id", "n_bytes", "prefix.n_tokens", (F.col("prefix.n_tokens") > TOKEN_LIMIT).alias("over_limit"),
        F.col("prefix.fitting_chars").alias("chars_within_limit"),
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(topk.vector_blocks(vectors), vectors.where(F.col("vec_id") % QUERY_STEP == 0))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, removed="removed_lines")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.records(warc.read_archive(spark, path)).select(
        F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), F.col("refers_to").cast("long").alias("refers_to"),
    )


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fill_middle.with_fill_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    made = docs.select("doc_id", "fill_middle.*").withColumn("restored", fill_middle.restore("output", "form"))
    digest = lambda text: F.sha2(F.col(text), 256).alias(f"{text}_sha256")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_token_files": op2_token_files,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_simhash_near_duplicates": op4_simhash_near_duplicates,
    "op5_decontamination": op5_decontamination,
    "op6_url_filter": op6_url_filter,
    "op7_prefix_token_counts": op7_prefix_token_counts,
    "op8_toxicity": op8_toxicity,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_line_dedup": op10_line_dedup,
    "op11_collocations": op11_collocations,
    "op12_warc_archive": op12_warc_archive,
    "op13_fill_middle": op13_fill_middle,
}
# The other operators end in hashes, models or vocabulary files that SQL has no functions
# for; tests hold them against brute force.
ORACLE = {
    "op9_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS n
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_inner_product(CAST(q.n AS DOUBLE[]), CAST(c.n AS DOUBLE[])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.n) = len(c.n)
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
        WHERE rank <= 5""",
    # The words of every piece, all phrases of up to four of them, and their counts.
    "op11_collocations": r"""
        WITH pieces AS (
            SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ),
        words AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
        ),
        spans AS (
            SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
            FROM words, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size
        ),
        counts AS (SELECT lang, size, phrase, count(*) AS f FROM spans GROUP BY ALL),
        totals AS (SELECT lang, sum(f) AS n FROM counts WHERE size = 1 GROUP BY lang),
        frequent AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE f >= 30),
        cuts AS (
            SELECT lang, size, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest
            FROM (SELECT *, unnest(range(1, size)) AS k FROM frequent WHERE size > 1)
        ),
        scores AS (
            SELECT c.lang, c.size, c.phrase, c.a, x.f AS l, y.f AS r,
                   (2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f) AS score,
                   row_number() OVER (PARTITION BY c.lang, c.phrase
                                      ORDER BY (2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f), k) AS place
            FROM cuts c JOIN frequent x ON x.lang = c.lang AND x.phrase = c.head
            JOIN frequent y ON y.lang = c.lang AND y.phrase = c.rest
        ),
        inside AS (
            SELECT lang, array_to_string(w[i:i + part - 1], ' ') AS phrase, max(f) AS most
            FROM (SELECT *, unnest(range(1, size - part + 2)) AS i
                  FROM (SELECT *, unnest(range(2, size)) AS part FROM frequent WHERE size > 2))
            GROUP BY ALL
        ),
        ranked AS (
            SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
            FROM scores s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
            WHERE place = 1 AND (most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a)
        )
        SELECT ranked.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
               CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000""",
    # Base32 of the 160 bits: each five hexadecimal digits make four letters.
    "op12_warc_archive": """
        WITH d AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex
            FROM pages
        ),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM d)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + CAST((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS BIGINT)
                             >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER), 1)), '') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM f""",
    "op13_fill_middle": """
        WITH t AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id) AS h, CAST(length(coalesce(text, '')) AS BIGINT) AS n
            FROM documents
        ),
        h AS (
            SELECT *, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
                   CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM t
        ),
        c AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS p, greatest(h1 % (n + 1), h2 % (n + 1)) AS q,
                   CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                             OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM h
        ),
        parts AS (
            SELECT *, left(text, p) AS prefix, substr(text, p + 1, q - p) AS middle, substr(text, q + 1) AS suffix FROM c
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN q - p END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                      WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts""",
}
