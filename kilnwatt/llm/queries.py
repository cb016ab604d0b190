"""The registered query of each operator, and the SQL of those that SQL can express over whole tables."""

from __future__ import annotations

from kilnwatt.llm import chat, decontaminate, jaccard, licenses, neighbours, packing, quality, sharding, substrings, suffixes, urls, variants, whitening

QUERIES = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_license_scan": licenses.op2_license_scan,
    "op3_substring_dedup": substrings.op3_substring_dedup,
    "op4_nearest": neighbours.op4_nearest,
    "op5_suffix_dedup": suffixes.op5_suffix_dedup,
    "op6_pack": packing.op6_pack,
    "op7_jaccard_join": jaccard.op7_jaccard_join,
    "op8_chat_format": chat.op8_chat_format,
    "op9_quality": quality.op9_quality,
    "op10_kd_shards": sharding.op10_kd_shards,
    "op11_url_filter": urls.op11_url_filter,
    "op12_spelling_variants": variants.op12_spelling_variants,
    "op13_whitening": whitening.op13_whitening,
}

ORACLE: dict[str, str] = {
    "op1_decontaminate": decontaminate.OP1_SQL,
    "op2_license_scan": licenses.OP2_SQL,
}
