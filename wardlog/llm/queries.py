"""The registered queries of this subpackage and their comparison SQL."""

from wardlog.llm import alignment, chat, cws, divergence, licenses, minhash, mixing, quality, sampling, sharding, tokencount, toxicity, warc

QUERIES = {
    "op10_sentencepiece": sampling.op10_sentencepiece,
    "op11_shard_by_bytes": sharding.op11_shard_by_bytes,
    "op12_token_alignment": alignment.op12_token_alignment,
    "op13_source_divergence": divergence.op13_source_divergence,
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_mix_sources": mixing.op2_mix_sources,
    "op3_near_duplicates": minhash.op3_near_duplicates,
    "op4_token_counts": tokencount.op4_token_counts,
    "op5_fingerprints": cws.op5_fingerprints,
    "op6_chat_format": chat.op6_chat_format,
    "op7_warc": warc.op7_warc,
    "op8_license_scan": licenses.op8_license_scan,
    "op9_quality_rules": quality.op9_quality_rules,
}

ORACLES = {
    "op13_source_divergence": divergence.SQL,
    "op2_mix_sources": mixing.SQL,
    "op3_near_duplicates": minhash.SQL,
    "op6_chat_format": chat.SQL,
    "op7_warc": warc.SQL,
    "op9_quality_rules": quality.SQL,
}
