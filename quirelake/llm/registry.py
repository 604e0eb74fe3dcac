"""Queries and SQL of the training-data operators."""

from quirelake.llm import bpe, exact_dedup, fingerprint, html_extract, langid, mixing, ngram_join, quality, suffix_dedup, token_counts

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_quality": quality.op2_quality,
    "op3_bpe": bpe.op3_bpe_codec,
    "op4_fingerprint": fingerprint.op4_fingerprint,
    "op5_html": html_extract.op5_html,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_langid": langid.op7_langid,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_ngram_jaccard": ngram_join.op9_ngram_jaccard,
    "op10_suffix_dedup": suffix_dedup.op10_suffix_dedup,
}
ORACLE_SQL = {"op8_exact_dedup": exact_dedup.OP8_SQL}
