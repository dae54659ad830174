"""Registered queries of the training-data operators, and DuckDB SQL for those that SQL can express."""
from __future__ import annotations

from hourcast.llm import bpe, embedding_dedup, hnsw, jaccard_join, line_dedup, mixing, piece_bpe, runs, spelling, suffix_dedup, token_counts, toxicity, warc

QUERIES = {
    "op1_ngram_jaccard_join": jaccard_join.op1,
    "op2_line_dedup": line_dedup.op2,
    "op3_token_counts": token_counts.op3,
    "op4_mix_sources": mixing.op4,
    "op5_toxicity": toxicity.op5,
    "op6_warc": warc.op6,
    "op7_bpe": bpe.op7,
    "op8_ann_hnsw": hnsw.op8,
    "op9_embedding_near_dedup": embedding_dedup.op9,
    "op10_suffix_array_dedup": suffix_dedup.op10,
    "op11_spelling_variants": spelling.op11,
    "op12_sentencepiece": piece_bpe.op12,
    "op13_periodic_runs": runs.op13,
}
SQL = {
    "op2_line_dedup": line_dedup.SQL2,
    "op4_mix_sources": mixing.SQL4,
    "op6_warc": warc.SQL6,
    "op11_spelling_variants": spelling.SQL11,
}
