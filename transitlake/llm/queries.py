"""The queries of this subpackage over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlake.llm import (
    edit_decontamination,
    hamming_near_dup,
    license_scan,
    limb_codes,
    line_templates,
    ngram_quality,
    order_minhash,
    piece_encoding,
    run_length_index,
    slot_shards,
    url_reputation,
    warc_bundles,
    word_resampling,
)
from transitlake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def piece_model() -> str:
    """The vocabulary file; the package that names it is part of the machine."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query(
    "op1_warc_bundles",
    """WITH p AS (SELECT page_id, sha256(encode(coalesce(html, ''))) AS payload_digest,
                         octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
            f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
       SELECT page_id, payload_bytes, payload_digest,
              CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit'
                   ELSE 'response' END AS record_type,
              CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
       FROM f""",
)
def op1_warc_bundles(spark: SparkSession, folder: str) -> DataFrame:
    return warc_bundles.archive_query(table(spark, folder, "pages"))


@query("op2_edit_decontamination")
def op2_edit_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return edit_decontamination.find_leaks(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


# The rules the contract gives.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


@query("op3_url_reputation", url_reputation.oracle_sql(URL_RULES))
def op3_url_reputation(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    carried = spark.sql(url_reputation.carried_sql("{pages}"), pages=pages.select("page_id", "url"))
    judged = url_reputation.judge_urls(
        pages, table(spark, folder, "labels"), URL_RULES, carried=carried
    )
    return judged.select(
        F.col("page_id").cast("bigint").alias("page_id"), "host", "path", "rule", "verdict"
    )


@query("op5_piece_encoding")
def op5_piece_encoding(spark: SparkSession, folder: str) -> DataFrame:
    return piece_encoding.digest_query(table(spark, folder, "documents"), piece_model())


@query("op6_line_templates")
def op6_line_templates(spark: SparkSession, folder: str) -> DataFrame:
    return line_templates.dedup_query(table(spark, folder, "documents"))


@query("op10_ngram_quality")
def op10_ngram_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    judged = ngram_quality.judge(docs, table(spark, folder, "labels"))
    return judged.select("doc_id", "lang", "perplexity", "threshold", "kept")


@query("op8_hamming_near_dup")
def op8_hamming_near_dup(spark: SparkSession, folder: str) -> DataFrame:
    return hamming_near_dup.near_duplicates(table(spark, folder, "documents"))


@query("op4_order_minhash")
def op4_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return order_minhash.with_next(table(spark, folder, "documents"))


@query("op9_license_scan")
def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents"))


@query("op7_run_length_index")
def op7_run_length_index(spark: SparkSession, folder: str) -> DataFrame:
    return run_length_index.remove_repeats(
        table(spark, folder, "documents"), digests=True, kept_text=True
    )


# CRC-32 by its table, one byte of each different word after the other.
RESAMPLING_SQL = """WITH RECURSIVE
     bits AS (SELECT range AS i, 0 AS step, range::BIGINT AS x FROM range(256)
              UNION ALL SELECT i, step + 1,
                CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END
              FROM bits WHERE step < 8),
     crc_table AS MATERIALIZED (SELECT list(x ORDER BY i) AS t FROM bits WHERE step = 8),
     texts AS (SELECT doc_id AS id, true AS source, text FROM documents
               UNION ALL SELECT NULL, false, text FROM benchmark),
     lists AS (SELECT id, source, regexp_extract_all(
                 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts),
     uses AS (SELECT id, source, word, count(*) AS n
              FROM (SELECT id, source, unnest(w) AS word FROM lists) GROUP BY ALL),
     crcs AS (SELECT word, hex(encode(word)) AS h, 0 AS k, 4294967295::BIGINT AS c
              FROM (SELECT DISTINCT word FROM uses)
              UNION ALL SELECT word, h, k + 1,
                xor(c >> 8, t[1 + xor(c & 255, ('0x' || substr(h, 2 * k + 1, 2))::BIGINT)])
              FROM crcs, crc_table WHERE k < length(h) // 2),
     bucket AS MATERIALIZED (SELECT word, xor(c, 4294967295) % 10000 AS b FROM crcs
                             WHERE k = length(h) // 2),
     counts AS (SELECT b, sum(n) FILTER (source) AS s, sum(n) FILTER (NOT source) AS t
                FROM uses JOIN bucket USING (word) GROUP BY b),
     totals AS (SELECT sum(s)::DOUBLE AS s, sum(t)::DOUBLE AS t FROM counts),
     gains AS (SELECT b, floor(1000 * ln((coalesce(c.t, 0)::DOUBLE + 1) * (coalesce(a.s, 0) + 10000)
                 / ((coalesce(c.s, 0)::DOUBLE + 1) * (coalesce(a.t, 0) + 10000))))::BIGINT AS gain
               FROM counts c, totals a),
     weights AS (SELECT id, sum(n * gain)::BIGINT AS weight
                 FROM uses JOIN bucket USING (word) JOIN gains USING (b) WHERE source GROUP BY id),
     scored AS (SELECT l.id AS doc_id, len(l.w)::BIGINT AS n_features,
                  coalesce(x.weight, 0) AS weight,
                  coalesce(x.weight, 0) + floor(-1000 * ln(-ln(
                    (('0x' || sha256('2024:' || l.id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT
                    AS score
                FROM lists l LEFT JOIN weights x ON x.id = l.id WHERE l.source),
     placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place,
                       count(*) OVER () AS n FROM scored WHERE n_features >= 20)
     SELECT s.doc_id, s.n_features, s.weight, s.score,
            CASE WHEN p.place <= 10 * p.n // 100 THEN p.place END AS rank
     FROM scored s LEFT JOIN placed p USING (doc_id)"""


@query("op11_word_resampling", RESAMPLING_SQL)
def op11_word_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return word_resampling.resample(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


@query("op12_slot_shards")
def op12_slot_shards(spark: SparkSession, folder: str) -> DataFrame:
    return slot_shards.shard_query(table(spark, folder, "documents"))


def _round(n: int) -> str:
    """SQL: nearest entries by the codebooks b<n>, and the books after them."""
    return f"""
     a{n} AS (SELECT vec_id, label, p, part, min(struct_pack(d := d, e := e)) AS best
       FROM (SELECT q.vec_id, q.label, q.p, q.part, b.e,
                    list_inner_product(b.c, b.c) - 2 * list_inner_product(q.part, b.c)
                      + list_inner_product(q.part, q.part) AS d
             FROM parts q JOIN b{n} b ON b.p = q.p)
       GROUP BY ALL),
     m{n} AS (SELECT p, e, list(floor(s / n) ORDER BY i) AS c
       FROM (SELECT p, best.e AS e, i, sum(part[i]) AS s, count(*) AS n
             FROM a{n}, generate_series(1, len(part)) g(i) GROUP BY ALL) GROUP BY p, e),
     b{n + 1} AS (SELECT b.p, b.e, coalesce(m.c, b.c) AS c
       FROM b{n} b LEFT JOIN m{n} m ON m.p = b.p AND m.e = b.e)"""

CODES_SQL = f"""WITH kept AS (
       SELECT vec_id, label, list(floor(256 * x::DOUBLE) ORDER BY i) AS v
       FROM (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i
             FROM embeddings)
       GROUP BY vec_id, label HAVING bool_and(x IS NOT NULL AND isfinite(x))),
     parts AS (SELECT vec_id, label, p,
                      list_slice(v, p * len(v) // 16 + 1, (p + 1) * len(v) // 16) AS part
               FROM kept, range(16) r(p)),
     b0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, part AS c
            FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64)),{_round(0)},{_round(1)},{_round(2)},
     found AS (SELECT vec_id, label, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code,
                      sum(best.d)::BIGINT AS error FROM a2 GROUP BY vec_id, label)
     SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
            (SELECT sha256(string_agg(c[i]::BIGINT::VARCHAR, ',' ORDER BY p, e, i))
             FROM b2, generate_series(1, len(c)) g(i)) AS codebooks_sha256
     FROM found"""


@query("op13_limb_codes", CODES_SQL)
def op13_limb_codes(spark: SparkSession, folder: str) -> DataFrame:
    return limb_codes.compress_query(table(spark, folder, "embeddings"))
