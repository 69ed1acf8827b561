"""The registered queries of the dealt operators, with DuckDB SQL where SQL expresses one."""

from __future__ import annotations

from flowdex.llm import (best_fit_packing, embedding_whitening, exact_dedup, fuzzy_lines, language_crf,
                         learned_partitions, license_scan, merkle_manifest, minhash_join, piece_codec, quality_qda, secret_forest,
                         suffix_dedup)

QUERIES = {
    "op1_learned_partitions": learned_partitions.query,
    "op2_quality_qda": quality_qda.query,
    "op3_piece_codec": piece_codec.query,
    "op4_fuzzy_lines": fuzzy_lines.query,
    "op5_license_scan": license_scan.query,
    "op6_exact_dedup": exact_dedup.query,
    "op7_language_crf": language_crf.query,
    "op8_best_fit_packing": best_fit_packing.query,
    "op9_ngram_jaccard_join": minhash_join.query,
    "op10_secret_forest": secret_forest.query,
    "op11_suffix_dedup": suffix_dedup.query,
    "op12_embedding_whitening": embedding_whitening.query,
    "op13_merkle_manifest": merkle_manifest.query,
}
ORACLE_SQL = {
    "op5_license_scan": license_scan.ORACLE.strip(),
    "op6_exact_dedup": exact_dedup.ORACLE.strip(),
    "op11_suffix_dedup": suffix_dedup.ORACLE.strip(),
    "op13_merkle_manifest": merkle_manifest.ORACLE.strip(),
}
