"""The registered queries of this subpackage, each next to the SQL that checks it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import (
    exact,
    fim,
    langid,
    lexical,
    lines,
    mixing,
    near,
    pagetext,
    quality,
    sentencepieces,
    voronoi,
    vptree,
    warc,
)
from lakeloom.llm.common import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(oracle: str | None = None):
    def add(query):
        QUERIES[query.__name__] = query
        if oracle is not None:
            ORACLES[query.__name__] = oracle
        return query

    return add


@register()
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.taken(docs).select("doc_id", "size", "source_size", "target", "taken", "shards")


@register()
def op2_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = pagetext.extract(pages, pagetext.train(pages))
    return found.select("row.page_id", "row.url", "text", "n_chars")


@register()
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = sentencepieces.digest_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return made.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@register(
    """
    WITH normal AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz') AS t
        FROM documents
    )
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
    FROM normal WINDOW w AS (PARTITION BY t)
    """
)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = exact.dedup(docs)
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


@register()
def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near.classes(docs).select("doc_id", "class_id", "class_size", "kept")


@register(
    """
    WITH payloads AS (
        SELECT page_id, coalesce(html, '') AS p, strlen(coalesce(html, '')) AS n FROM pages
    ), firsts AS (
        SELECT *, min(page_id) OVER (PARTITION BY p) AS first_id FROM payloads
    )
    SELECT page_id, n AS payload_bytes, sha256(p) AS payload_digest,
           CASE WHEN n >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= 100 AND first_id <> page_id THEN first_id END AS refers_to
    FROM firsts
    """
)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    records = warc.read(warc.write(pages)).withColumn(
        "valid", F.when(F.col("error").isNotNull(), F.raise_error(F.col("error"))).otherwise(True)
    )
    return records.where("valid").select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


@register()
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identify(docs.select("doc_id", "text"), langid.train(docs))
    held = langid.held_out(F.col("row.doc_id")).alias("held_out")
    return found.select("row.doc_id", held, "lang_pred", "score")


@register()
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup(docs).select(
        "row.doc_id", "lines", "removed", F.col("clean").alias("text")
    )


@register(
    """
    WITH good AS (
        SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.v, c.v) AS s
        FROM good q JOIN good c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
        WHERE q.vec_id % 50 = 0
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank FROM scored
    )
    SELECT query_id, rank::INTEGER AS rank, vec_id, s AS score FROM ranked WHERE rank <= 5
    """
)
def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vptree.nearest(vectors, F.col("vec_id") % 50 == 0, 5)


@register()
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    held = quality.held_out(F.col("row.doc_id")).alias("held_out")
    return quality.classify(docs, model).select("row.doc_id", held, "score", "predicted")


@register(
    """
    WITH good AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
        WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
        FROM good q JOIN good c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
        WHERE q.vec_id % 50 = 0
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
    )
    SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
    """
)
def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return voronoi.largest_products(vectors, F.col("vec_id") % 50 == 0, 5)


@register(
    """
    WITH parts AS (
        SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS p,
               sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS d
        FROM documents
    ), counted AS (
        SELECT *, len(p) - 1 AS ends, len(p) - 1 + (t <> '' AND p[-1] <> '')::INT AS n,
               ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2,
               ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4
        FROM parts
    ), cut AS (
        SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
               CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100
                    THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
        FROM counted
    ), heads AS (
        SELECT *, length(array_to_string(p[1:a], chr(10))) + (a BETWEEN 1 AND ends)::INT AS one,
               length(array_to_string(p[1:b], chr(10))) + (b BETWEEN 1 AND ends)::INT AS two
        FROM cut
    ), three AS (
        SELECT *, t[1:one] AS prefix, t[one + 1:two] AS middle, t[two + 1:] AS suffix FROM heads
    )
    SELECT doc_id, n::BIGINT AS n, form,
           CASE WHEN form <> 'plain' THEN one::BIGINT END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN (two - one)::BIGINT END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t
                            WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                            ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM three
    """
)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = fim.transform(docs)
    back = fim.restored(F.col("output"), F.col("form"))
    return made.select(
        "row.doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )


_TERMS = r"""regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""


@register(
    f"""
    WITH terms AS (
        SELECT doc_id, unnest({_TERMS}) AS term FROM documents
    ), tf AS (
        SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL
    ), sizes AS (
        SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id
    ), mean AS (
        SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM sizes
    ), weights AS (
        SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
        FROM tf, mean GROUP BY term, docs
    ), impacts AS (
        SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words))) AS x
        FROM tf JOIN weights USING (term) JOIN sizes USING (doc_id), mean
    ), items AS (
        SELECT item_id, unnest(list_distinct({_TERMS})) AS term FROM benchmark
    ), scored AS (
        SELECT item_id, doc_id, sum(x)::BIGINT AS score FROM items JOIN impacts USING (term)
        GROUP BY ALL HAVING score > 0
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored
    )
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
    """
)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical.search(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"), 50)
