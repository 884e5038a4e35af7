"""The operators' queries over their whole tables, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from chatloom.llm.exact_dedup import exact_dedup
from chatloom.llm.language_id import fit_language_models, held_out, identify_languages
from chatloom.llm.line_dedup import BLOCK, HIDDEN, HOST, RATIO, TAG, html_lines, host_of, line_dedup
from chatloom.llm.mixing import mix
from chatloom.llm.pieces import encode_pieces
from chatloom.llm.simhash import simhash_components
from chatloom.llm.suffix_dedup import WINDOW, suffix_dedup
from chatloom.llm.token_counts import token_counts
from chatloom.llm.top_k import EVERY, SCALE, K, top_k
from chatloom.llm.warc import BASE32, URL, warc_index


#: The pages carry no capture time: theirs are this second (2024-01-01 UTC) and the following, by page_id.
FIRST_CAPTURE = 1_704_067_200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def domain() -> Column:
    """The domain that a row of ``labels`` names."""
    return F.concat(F.lit("quality"), F.col("quality").cast("string"), F.lit("-toxic"), F.col("toxic").cast("string"))


#: Target weights of the domains by tokens.
CLEAN = "quality1-toxic0"
TARGETS = {CLEAN: 0.92, "quality0-toxic0": 0.05, "quality1-toxic1": 0.02, "quality0-toxic1": 0.01}


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), domain(), TARGETS, CLEAN)
    return found.select("doc_id", "n_tokens", "domain", F.element_at("posteriors", F.col("domain")).alias("posterior"), F.round("rate", 6).alias("rate"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents")).drop("spans")


def op3_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify_languages(docs, fit_language_models(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_char", "rejected")


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), digest=True)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    captured = F.timestamp_seconds(F.lit(FIRST_CAPTURE) + F.coalesce("page_id", F.lit(0)))
    return warc_index(pages, captured).drop("archive", "offset")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = line_dedup(pages, host_of(F.col("url")), html_lines(F.col("html")))
    return found.select("page_id", "host", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_mixing, op2_suffix_dedup, op3_piece_encoding, op4_token_counts, op5_language_id, op6_simhash_dedup, op7_exact_dedup, op8_warc, op9_line_dedup, op10_top_k)}

SQL = {
    "op2_suffix_dedup": f"""
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
        w AS (SELECT doc_id, s, md5(substr(x, CAST(2 * s + 1 AS INT), {2 * WINDOW})) AS m FROM d, unnest(range(n - {WINDOW} + 1)) AS t(s)),
        r AS (SELECT doc_id, s FROM w QUALIFY row_number() OVER (PARTITION BY m ORDER BY doc_id, s) > 1),
        g AS (SELECT *, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + {WINDOW} THEN 0 ELSE 1 END AS new FROM r),
        i AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS span FROM g),
        p AS (SELECT doc_id, span, min(s) AS a, max(s) + {WINDOW} AS b FROM i GROUP BY ALL),
        q AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM p),
        k AS (
            SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans, max(b) AS tail,
                   string_agg(substr(x, CAST(2 * before + 1 AS INT), CAST(2 * (a - before) AS INT)), '' ORDER BY a) AS kept
            FROM q JOIN d USING (doc_id) GROUP BY doc_id)
        SELECT d.doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(kept, '') || substr(x, CAST(2 * coalesce(tail, 0) + 1 AS INT)))) AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)
    """,
    "op7_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
            FROM documents),
        k AS (
            SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id,
                   count(*) OVER (PARTITION BY norm) AS group_size
            FROM n)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k
    """,
    "op8_warc": rf"""
        WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
        d AS (
            SELECT *, min(page_id) OVER (PARTITION BY hex) AS first,
                   array_to_string(list_transform(range(32), lambda i: substr('{BASE32}',
                       ((('0x' || substr(hex, CAST((i // 4) * 5 + 1 AS INT), 5))::BIGINT >> CAST(15 - 5 * (i % 4) AS INT)) & 31) + 1, 1)), '') AS payload_digest,
                   regexp_extract(url, '{URL.pattern}', 1) AS host, regexp_extract(url, '{URL.pattern}', 2) AS rest
            FROM p)
        SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to,
               CASE WHEN host = '' THEN url ELSE array_to_string(list_reverse(string_split(lower(host), '.')), ',') || ')' || CASE WHEN rest = '' THEN '/' ELSE rest END END AS url_key,
               strftime(to_timestamp({FIRST_CAPTURE} + page_id), '%Y-%m-%dT%H:%M:%SZ') AS captured_at
        FROM d
    """,
    "op9_line_dedup": rf"""
        WITH t AS (
            SELECT page_id, lower(regexp_extract(coalesce(url, ''), '{HOST}', 1)) AS host,
                   regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '{HIDDEN}', '', 'g'), '{BLOCK}', chr(10), 'g'), '{TAG}', '', 'g') AS text
            FROM pages),
        l AS (
            SELECT page_id, host, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS ls FROM t),
        e AS (SELECT page_id, host, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM l),
        c AS (
            SELECT host, line FROM (SELECT host, line, count(DISTINCT page_id) AS n FROM e GROUP BY ALL)
            JOIN (SELECT host, count(*) AS pages FROM l GROUP BY ALL) USING (host)
            WHERE n > 1 AND n > {RATIO}::DOUBLE * pages),
        k AS (
            SELECT page_id, count(*) FILTER (c.line IS NOT NULL) AS n_dropped,
                   coalesce(string_agg(e.line, chr(10) ORDER BY pos) FILTER (c.line IS NULL), '') AS kept
            FROM e LEFT JOIN c ON e.host = c.host AND e.line = c.line GROUP BY page_id)
        SELECT l.page_id, l.host, CAST(len(ls) AS BIGINT) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256
        FROM l LEFT JOIN k USING (page_id)
    """,
    "op10_top_k": f"""
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)))),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % {EVERY} = 0),
        r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
        SELECT * FROM r WHERE rank <= {K}
    """,
}
