"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkmart.llm import bilinear, decontaminate, divergence, packing, personal_crf, prefix_trie, quality, secrets_crf, setsketch, shards, shared, suffix, token_files, warc_zip

Query = Callable[[SparkSession, str], DataFrame]


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        shared.ship(spark)
        return query(spark, sf_dir)

    run.__doc__ = query.__doc__
    return run


QUERIES: dict[str, Query] = {
    f.__name__: _shipped(f)
    for f in (
        decontaminate.op1_spaced_seeds,
        token_files.op2_token_files,
        shards.op3_hash_tree_shards,
        setsketch.op4_setsketch,
        suffix.op5_suffix_array,
        packing.op6_packing,
        quality.op7_quality_rules,
        secrets_crf.op8_secret_crf,
        bilinear.op9_log_bilinear,
        warc_zip.op10_warc_zip,
        prefix_trie.op11_prefix_trie,
        personal_crf.op12_semi_markov_pii,
        divergence.op13_divergence_audit,
    )
}
SQL: dict[str, str] = {
    "op1_spaced_seeds": decontaminate.OP1_SQL,
    "op3_hash_tree_shards": shards.OP3_SQL,
    "op10_warc_zip": warc_zip.OP10_SQL,
    "op11_prefix_trie": prefix_trie.OP11_SQL,
    "op13_divergence_audit": divergence.OP13_SQL,
}
