"""The operators' queries over the given tables, and their SQL."""

from __future__ import annotations

from punctual.llm import (
    bpe,
    decontaminate,
    embedding_dedup,
    language_id,
    language_model,
    lexical_search,
    line_dedup,
    quality,
    secret_scan,
    sharding,
    simhash,
    spelling,
    substring_dedup,
)
from punctual.llm.common import table


def _over(function, *tables: str):
    return lambda spark, sf_dir: function(*(table(spark, sf_dir, name) for name in tables))


def queries() -> dict:
    return {
        "op1_simhash": _over(simhash.op1_simhash, "documents"),
        "op2_sharding": _over(sharding.op2_sharding, "documents"),
        "op3_lm_scoring": _over(language_model.op3_lm_scoring, "documents"),
        "op4_embedding_dedup": _over(embedding_dedup.op4_embedding_dedup, "embeddings"),
        "op5_line_dedup": _over(line_dedup.op5_line_dedup, "documents"),
        "op6_decontaminate": _over(decontaminate.op6_decontaminate, "documents", "benchmark"),
        "op7_quality": _over(quality.op7_quality, "documents", "labels"),
        "op8_language_id": _over(language_id.op8_language_id, "documents"),
        "op9_bpe": _over(bpe.op9_bpe, "documents"),
        "op10_substring_dedup": _over(substring_dedup.op10_substring_dedup, "documents"),
        "op11_secret_scan": _over(secret_scan.op11_secret_scan, "documents"),
        "op12_lexical_search": _over(lexical_search.op12_lexical_search, "documents", "benchmark"),
        "op13_spelling": _over(spelling.op13_spelling, "documents"),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_sharding": sharding.ORACLE,
        "op4_embedding_dedup": embedding_dedup.ORACLE,
        "op5_line_dedup": line_dedup.ORACLE,
        "op6_decontaminate": decontaminate.ORACLE,
        "op12_lexical_search": lexical_search.ORACLE,
    }
