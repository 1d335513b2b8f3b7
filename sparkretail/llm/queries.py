"""The registered queries of this folder: (spark, table folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkretail.llm import (
    bpe_codec,
    conversations,
    decontaminate,
    licenses,
    ngram_join,
    packing,
    page_text,
    privacy,
    quality,
    token_counts,
    topk,
    toxicity,
    vector_codes,
)
from sparkretail.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = "word_bpe_49k.json"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items of which tiles cover half or more, per document."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's length bucket and batch, in tokens of the word-end BPE vocabulary."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer=public_tokenizers.path(TOKENIZER))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the word-end BPE vocabulary."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document from the labels of its lines."""
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best other vectors for every vector whose id is divisible by 20."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data, and terms that give it away, in every document."""
    return privacy.find_personal_data(table(spark, sf_dir, "documents"))


def op7_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return page_text.extract(table(spark, sf_dir, "pages"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose word 5-shingles have a Jaccard similarity of 0.75 or more."""
    return ngram_join.link_documents(table(spark, sf_dir, "documents"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every document, also over line breaks."""
    return licenses.scan(table(spark, sf_dir, "documents"), across_lines=True)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, also in disguised words."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of every vector under codebooks of four rounds, and their errors."""
    return vector_codes.coded_vectors(table(spark, sf_dir, "embeddings"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every conversation after a fixed damage."""
    return conversations.damaged_report(table(spark, sf_dir, "conversations"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text they decode to, as digests."""
    return bpe_codec.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_decontamination, op2_packing, op3_token_counts, op4_quality, op5_topk, op6_personal_data,
        op7_page_text, op8_ngram_join, op9_licenses, op10_toxicity, op11_vector_codes, op12_conversations, op13_bpe,
    )
}

_FINITE = "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

#: The others train, iterate or tokenize, or are too slow in SQL over whole tables; tests
#: compare them with brute force, with the tokenizer's library, or by held-out accuracy.
ORACLES: dict[str, str] = {
    "op5_topk": f"""
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND {_FINITE}),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
        FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op9_licenses": licenses.oracle(),
    "op11_vector_codes": vector_codes.oracle(),
}
