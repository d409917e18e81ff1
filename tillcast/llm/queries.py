"""The registered queries of the training-data operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillcast.llm import bpe, conv_trie, exact_dedup, html_text, jaccard, langid, mixing, quality, repeats, secrets, topk, url_filter, vector_codes
from tillcast.llm.common import table


def _over(name: str, run: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A query that applies ``run`` to the whole table ``name``."""
    return lambda spark, sf_dir: run(table(spark, sf_dir, name))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk_search": _over("embeddings", topk.top_k),
    "op2_exact_dedup": _over("documents", exact_dedup.exact_dedup),
    "op3_bpe": _over("documents", bpe.query),
    "op4_mixing": _over("documents", mixing.query),
    "op5_html_text": _over("pages", html_text.extract),
    "op6_repeats": _over("documents", repeats.query),
    "op7_url_filter": _over("pages", url_filter.judge),
    "op8_ngram_jaccard": _over("documents", jaccard.jaccard_components),
    "op9_quality": _over("documents", quality.query),
    "op10_language_id": _over("documents", langid.query),
    "op11_conversation_trie": _over("conversations", conv_trie.prefix_trie),
    "op12_secret_scan": _over("documents", secrets.find_secrets),
    "op13_vector_codes": _over("embeddings", vector_codes.compress),
}

SQL: dict[str, str] = {
    "op1_topk_search": topk.SQL,
    "op2_exact_dedup": exact_dedup.SQL,
    "op4_mixing": mixing.SQL,
    "op11_conversation_trie": conv_trie.SQL,
    "op12_secret_scan": secrets.SQL,
    "op13_vector_codes": vector_codes.SQL,
}
