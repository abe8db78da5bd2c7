"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from basketflow.llm import conversation_repair, decontaminate, embedding_dedup, html_extract, language_id, merkle, mixing, packing, quality, secrets, simhash, token_counts, warc

QUERIES = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_warc": warc.op2_warc,
    "op3_quality": quality.op3_quality,
    "op4_secrets": secrets.op4_secrets,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_html_extract": html_extract.op6_html_extract,
    "op7_simhash": simhash.op7_simhash,
    "op8_mix": mixing.op8_mix,
    "op9_language_id": language_id.op9_language_id,
    "op10_embedding_dedup": embedding_dedup.op10_embedding_dedup,
    "op11_packing": packing.op11_packing,
    "op12_conversation_repair": conversation_repair.op12_conversation_repair,
    "op13_merkle": merkle.op13_merkle,
}

ORACLE = {
    "op1_decontaminate": decontaminate.SQL,
    "op2_warc": warc.SQL,
    "op10_embedding_dedup": embedding_dedup.SQL,
    "op12_conversation_repair": conversation_repair.SQL,
    "op13_merkle": merkle.SQL,
}
