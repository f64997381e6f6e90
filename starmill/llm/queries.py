"""The queries of this subpackage: name -> (spark, sf_dir) -> DataFrame; and their SQL, where SQL can say it."""

from __future__ import annotations

from starmill.llm import chat, decontam, ngram_join, oracle, packing, pii, quality, sharding, suffix_dedup, token_io, toxicity

QUERIES = {
    "op2_toxicity": toxicity.op2,
    "op1_suffix_array_dedup": suffix_dedup.op1,
    "op3_ngram_jaccard_join": ngram_join.op3,
    "op4_pii_surrogates": pii.op4,
    "op5_best_fit_packing": packing.op5,
    "op6_rendezvous_sharding": sharding.op6,
    "op7_token_id_output": token_io.op7,
    "op8_chat_formatting": chat.op8,
    "op9_benchmark_decontamination": decontam.op9,
    "op10_quality_rules": quality.op10,
}

SQL: dict[str, str] = {
    "op3_ngram_jaccard_join": oracle.JOIN,
    "op9_benchmark_decontamination": oracle.DECONTAMINATION,
    "op10_quality_rules": oracle.QUALITY,
}
