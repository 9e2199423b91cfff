"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from waykit.llm import arc, chat, decontam, jaccard, licenses, lines, mixing, negatives, quality, ranking, rules, sharding, suffixes
from waykit.llm.common import table

QUERIES = {
    "op1_crf_quality": lambda spark, d: quality.digest(table(spark, d, "documents"), table(spark, d, "labels")),
    "op2_mix_sources": lambda spark, d: mixing.digest(table(spark, d, "documents")),
    "op3_jaccard_components": lambda spark, d: jaccard.digest(table(spark, d, "documents")),
    "op4_arc_to_warc": lambda spark, d: arc.digest(table(spark, d, "pages")),
    "op5_ring_shards": lambda spark, d: sharding.digest(table(spark, d, "documents")),
    "op6_chat_windows": lambda spark, d: chat.digest(table(spark, d, "conversations")),
    "op7_certified_rules": lambda spark, d: rules.digest(table(spark, d, "documents"), table(spark, d, "labels")),
    "op8_simhash_leaks": lambda spark, d: decontam.digest(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op9_repeated_bytes": lambda spark, d: suffixes.digest(table(spark, d, "documents")),
    "op10_line_dedup": lambda spark, d: lines.digest(table(spark, d, "documents")),
    "op11_hard_negatives": lambda spark, d: negatives.digest(table(spark, d, "embeddings")),
    "op12_license_scan": lambda spark, d: licenses.digest(table(spark, d, "documents")),
    "op13_ball_tree_ranking": lambda spark, d: ranking.digest(table(spark, d, "documents"), table(spark, d, "benchmark")),
}

ORACLES = {
    "op2_mix_sources": mixing.ORACLE,
    "op3_jaccard_components": jaccard.ORACLE,
    "op4_arc_to_warc": arc.ORACLE,
    "op6_chat_windows": chat.ORACLE,
    "op7_certified_rules": rules.ORACLE,
    "op9_repeated_bytes": suffixes.ORACLE,
    "op10_line_dedup": lines.ORACLE,
    "op11_hard_negatives": negatives.ORACLE,
    "op12_license_scan": licenses.ORACLE,
    "op13_ball_tree_ranking": ranking.ORACLE,
}
