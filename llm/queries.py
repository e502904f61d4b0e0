"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from llm import chat_format, conversation_repair, decontaminate, divergence, language_model, license_scan, line_dedup, near_duplicates, packing, quality, sharding, token_files, top_k
from tidepool.session import ship_package


def _shipped(query: Callable) -> Callable:
    def run(spark, sf_dir):
        ship_package(spark, os.path.dirname(os.path.abspath(__file__)))
        return query(spark, sf_dir)
    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES = {f.__name__: _shipped(f) for f in (
    quality.op1_quality,
    license_scan.op2_license_scan,
    line_dedup.op3_line_dedup,
    sharding.op4_sharding,
    language_model.op5_language_model,
    decontaminate.op6_decontaminate,
    packing.op7_packing,
    chat_format.op8_chat_format,
    top_k.op9_top_k,
    near_duplicates.op10_near_duplicates,
    divergence.op11_source_divergence,
    conversation_repair.op12_conversation_repair,
    token_files.op13_token_files,
)}

ORACLE = {
    "op2_license_scan": license_scan.ORACLE_SQL,
    "op3_line_dedup": line_dedup.ORACLE_SQL,
    "op4_sharding": sharding.ORACLE_SQL,
    "op6_decontaminate": decontaminate.ORACLE_SQL,
    "op8_chat_format": chat_format.ORACLE_SQL,
    "op9_top_k": top_k.ORACLE_SQL,
    "op11_source_divergence": divergence.ORACLE_SQL,
}
