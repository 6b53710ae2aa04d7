"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from segloom.llm import compact_windows, embeddings, mixing, packing, quality_classifier, quality_rules, revisits, sharding, simhash, suffix_dedup

QUERIES = {
    "op1_bradley_terry_quality": quality_classifier.op1,
    "op2_suffix_array_dedup": suffix_dedup.op2,
    "op3_revisit_resolution": revisits.op3,
    "op4_int8_tile_dedup": embeddings.op4,
    "op5_covering_simhash": simhash.op5,
    "op6_compact_windows": compact_windows.op6,
    "op7_histogram_sort_shards": sharding.op7,
    "op8_mix_to_targets": mixing.op8,
    "op9_weak_supervision_rules": quality_rules.op9,
    "op10_cutting_stock_packing": packing.op10,
}
ORACLES = {"op3_revisit_resolution": revisits.OP3_SQL, "op8_mix_to_targets": mixing.OP8_SQL}
