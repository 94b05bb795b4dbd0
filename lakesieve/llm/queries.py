"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe, chat, decontam, dedup, embedding_dup, filter_audit, langid, licenses, near_dup, secrets, spelling, toxicity, wordpiece,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_secret_scan": secrets.op2_secret_scan,
    "op3_byte_bpe": bpe.op3_byte_bpe,
    "op4_token_counts": wordpiece.op4_token_counts,
    "op5_exact_dedup": dedup.op5_exact_dedup,
    "op6_minhash_near_dup": near_dup.op6_minhash_near_dup,
    "op7_decontamination": decontam.op7_decontamination,
    "op8_license_scan": licenses.op8_license_scan,
    "op9_chat_format": chat.op9_chat_format,
    "op10_language_id": langid.op10_language_id,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_embedding_near_dup": embedding_dup.op12_embedding_near_dup,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}

#: DuckDB SQL for the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op5_exact_dedup": dedup.ORACLE,
    "op7_decontamination": decontam.ORACLE,
    "op8_license_scan": licenses.ORACLE,
    "op9_chat_format": chat.ORACLE,
    "op13_filter_audit": filter_audit.ORACLE,
}
