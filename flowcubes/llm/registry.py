"""Registered queries of the training-data operators, and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowcubes.llm import byte_bpe, collocations, embedding_dedup, fingerprints, language_id, license_scan, near_dedup, packing, prefix_trie, secret_scan, token_counts, toxicity, warc
from flowcubes.llm.common import prepare, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text, by rank-order n-gram profiles."""
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.learn(docs))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors of a label, by collision counting."""
    return embedding_dedup.links(table(spark, sf_dir, "embeddings"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, by the string-kernel machine."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text, by the compiled transducer."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate documents, by Order MinHash and alignment."""
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives and read back by the salvage reader."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invertible sketches of every text and its edited version."""
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and the bytes they decode to."""
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text, in plain sight and under layers of encoding."""
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named in every whole text, by the positional index of rare words."""
    docs = table(spark, sf_dir, "documents")
    return license_scan.scan(docs, license_scan.learn(docs))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most strongly bound phrases of each language, by SON partitioning."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations, by adaptive radix trees."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (op1_language_id, op2_embedding_near_dedup, op3_toxicity, op4_token_counts, op5_order_minhash, op6_warc, op7_fingerprints, op8_byte_bpe, op9_best_fit_packing, op10_secret_scan,
              op11_license_scan, op12_phrase_collocations, op13_prefix_trie)
}


def queries() -> dict[str, Query]:
    def prepared(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        run.__doc__ = fn.__doc__
        return run

    return {name: prepared(fn) for name, fn in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """The operators that SQL expresses; the others are tested against brute force."""
    return {"op2_embedding_near_dedup": embedding_dedup.TWIN, "op6_warc": warc.TWIN, "op12_phrase_collocations": collocations.TWIN, "op13_prefix_trie": prefix_trie.TWIN}
