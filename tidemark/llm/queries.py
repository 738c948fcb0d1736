"""The numbered operators as queries over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents
from tidemark.llm.decontamination import contamination
from tidemark.llm.exact_dedup import exact_groups
from tidemark.llm.hard_negatives import hard_negatives, quantised
from tidemark.llm.language import held_out, identify
from tidemark.llm.line_templates import without_recurring_lines
from tidemark.llm.multiset_prints import edited_likeness
from tidemark.llm.packing import pack
from tidemark.llm.sharding import shuffle_into_shards
from tidemark.llm.simhash import near_groups
from tidemark.llm.spelling import corpus_words, spelling_variants
from tidemark.llm.substring_dedup import without_repeats
from tidemark.llm.toxicity import score_toxicity
from tidemark.llm.warc import archive
from tidemark.sources.tables import load_parquet


def op1_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), load_parquet(spark, sf_dir, "benchmark")).drop("items", "spans")


def op2_cutting_stock_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


def op3_hypergeometric_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.encode("text", "UTF-8")
    rows = documents(spark, sf_dir).select(
        F.col("doc_id").cast("long"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.encode(F.lit(""), "UTF-8"))).alias("text_crc32"),
    )
    placed = shuffle_into_shards(rows, shards=16)
    return placed.withColumn("law", F.lit("rows")).withColumn("grown_shard", F.lit(None).cast("int"))


def op4_difference_cover_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(documents(spark, sf_dir)).drop("kept")


def op5_kneser_ney_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang").withColumn("held_out", held_out(4, 2))
    found = identify(docs, ~F.col("held_out"), keep=True)
    return found.select("doc_id", "held_out", "lang_pred", "score", "entropy", "rejected")


def op6_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(documents(spark, sf_dir), load_parquet(spark, sf_dir, "labels"), ~held_out(3, 1))
    return scored.select("doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_index_merged_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(load_parquet(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))


def op9_multi_index_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir))


def op10_line_template_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_recurring_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op11_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(documents(spark, sf_dir))


def op12_partenum_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(corpus_words(documents(spark, sf_dir), damage=199))


def op13_bond_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load_parquet(spark, sf_dir, "embeddings").withColumn("label", F.col("label").cast("long"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(quantised(rows.withColumn("label", moved)), "vec_id % 100 = 0")


QUERIES = {
    "op1_winnowing_decontamination": op1_winnowing_decontamination,
    "op2_cutting_stock_packing": op2_cutting_stock_packing,
    "op3_hypergeometric_sharding": op3_hypergeometric_sharding,
    "op4_difference_cover_dedup": op4_difference_cover_dedup,
    "op5_kneser_ney_language": op5_kneser_ney_language,
    "op6_compression_toxicity": op6_compression_toxicity,
    "op7_index_merged_archives": op7_index_merged_archives,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_multi_index_simhash": op9_multi_index_simhash,
    "op10_line_template_dedup": op10_line_template_dedup,
    "op11_multiset_fingerprints": op11_multiset_fingerprints,
    "op12_partenum_spelling": op12_partenum_spelling,
    "op13_bond_hard_negatives": op13_bond_hard_negatives,
}

ORACLES = {
    "op1_winnowing_decontamination": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(lower_az(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all(lower_az(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS m, w[i : i + least(13, len(w)) - 1] AS g
          FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS u(i) WHERE len(w) > 0),
        dw AS (SELECT doc_id, m, i, w[i : i + m - 1] AS g FROM d, (SELECT DISTINCT m FROM bw), unnest(range(1, len(w) - m + 2)) AS u(i)),
        hits AS (SELECT doc_id, i, m, item_id FROM dw JOIN bw USING (m, g)),
        n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + m)) AS u(p) GROUP BY doc_id),
        t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM hits GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
          coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)""".replace("lower_az(coalesce(text, ''))", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"),
    "op7_index_merged_archives": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        d AS (SELECT *, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS f FROM p)
        SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
          array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            (((('0x' || substr(x, (5 * (i // 4) + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), '') AS payload_digest,
          CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> f THEN f END AS refers_to FROM d""",
    "op8_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
          doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256 FROM n WINDOW w AS (PARTITION BY t)""",
    "op10_line_template_dedup": r"""
        WITH s AS (SELECT doc_id, text, string_split(text, chr(10)) AS a FROM documents),
        x AS (SELECT doc_id, text, i, regexp_replace(trim(regexp_replace(a[i], '[ \t\r]+', ' ', 'g'), ' '), '[^ ]*[0-9][^ ]*', '<*>', 'g') AS line
          FROM s, unnest(range(1, len(a) + 1)) AS u(i)),
        l AS (SELECT *, string_split(line, ' ') AS w FROM x WHERE line <> ''),
        k AS (SELECT *, len(w) || ' ' || array_to_string(w[1:3], ' ') AS leaf FROM l),
        d AS (SELECT leaf, line, any_value(w) AS w, count(DISTINCT text) AS docs FROM k GROUP BY leaf, line),
        t AS (SELECT leaf, line, docs, p, w[p] AS token, CASE WHEN len(w) >= 50 THEN 2 ELSE 3 END AS needed FROM d, unnest(range(1, len(w) + 1)) AS u(p)),
        f AS (SELECT leaf, p, token, sum(docs) >= any_value(needed) AS often FROM t GROUP BY leaf, p, token),
        g AS (SELECT leaf, line, avg(CASE WHEN often AND token <> '<*>' THEN 1.0 ELSE 0.0 END) AS kept,
          string_agg(CASE WHEN often THEN token ELSE '<*>' END, ' ' ORDER BY p) AS general FROM t JOIN f USING (leaf, p, token) GROUP BY leaf, line),
        m AS (SELECT doc_id, text, i, leaf, len(w) AS n, CASE WHEN kept >= 0.6 THEN general ELSE line END AS template FROM k JOIN g USING (leaf, line)),
        r AS (SELECT leaf, template FROM m GROUP BY leaf, template HAVING count(DISTINCT text) >= CASE WHEN any_value(n) >= 50 THEN 2 ELSE 3 END),
        z AS (SELECT doc_id, list(i) AS gone FROM m JOIN r USING (leaf, template) GROUP BY doc_id)
        SELECT doc_id, coalesce(len(a), 0)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_dropped,
          sha256(coalesce(CASE WHEN gone IS NULL THEN text
            ELSE array_to_string(list_transform(list_filter(range(1, len(a) + 1), lambda j: NOT list_contains(gone, j)), lambda j: a[j]), chr(10)) END, '')) AS kept_sha256
        FROM s LEFT JOIN z USING (doc_id)""",
    "op13_bond_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
          FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
          FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
          vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
        QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5""",
}
