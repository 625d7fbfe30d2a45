"""The registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from . import (
    decontaminate,
    language_id,
    line_dedup,
    mixing,
    quality,
    sharding,
    simhash,
    suffix_dedup,
    token_alignment,
    token_output,
    topk,
    url_filter,
    whitening,
)

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op10_language_id": language_id.op10_language_id,
    "op11_quality": quality.op11_quality,
    "op12_whitening": whitening.op12_whitening,
    "op13_token_alignment": token_alignment.op13_token_alignment,
    "op2_simhash": simhash.op2_simhash,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_sharding": sharding.op4_sharding,
    "op5_mixing": mixing.op5_mixing,
    "op6_line_dedup": line_dedup.op6_line_dedup,
    "op7_token_output": token_output.op7_token_output,
    "op8_url_filter": url_filter.op8_url_filter,
    "op9_topk": topk.op9_topk,
}
ORACLE = {
    "op1_suffix_dedup": suffix_dedup.OP1_SQL,
    "op3_decontaminate": decontaminate.OP3_SQL,
    "op4_sharding": sharding.oracle(),
    "op6_line_dedup": line_dedup.OP6_SQL,
    "op8_url_filter": url_filter.OP8_SQL,
    "op9_topk": topk.OP9_SQL,
}
