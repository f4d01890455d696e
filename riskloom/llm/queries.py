"""Registered queries of this package and their SQL."""

from __future__ import annotations

from riskloom.llm import bpe, chat, chosen_path, jaccard, language, negatives, packing, periods
from riskloom.llm import permutation, quality, sharding, substrings, voronoi

QUERIES = {
    "op1_feistel_sharding": sharding.query,
    "op2_permutation_index": permutation.query,
    "op3_hierarchical_language": language.query,
    "op4_voronoi_top_k": voronoi.query,
    "op5_heavy_light_jaccard": jaccard.query,
    "op6_neighbour_quality": quality.query,
    "op7_byte_bpe": bpe.query,
    "op8_best_fit_packing": packing.query,
    "op9_chat_round_trip": chat.query,
    "op10_substring_anchors": substrings.query,
    "op11_chosen_path_dedup": chosen_path.query,
    "op12_strassen_negatives": negatives.query,
    "op13_recompression_runs": periods.query,
}

ORACLES = {
    "op4_voronoi_top_k": voronoi.ORACLE,
    "op9_chat_round_trip": chat.ORACLE,
    "op12_strassen_negatives": negatives.ORACLE,
}
