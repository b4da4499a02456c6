"""The operators' queries, and SQL for those that SQL can express."""

from __future__ import annotations

from varloom.llm import collocations, decontaminate, embedding_dedup, html, line_dedup, mixing, ngram_join, quality, sentencepiece_codec, source_divergence, substring_dedup, toxicity, warc


def queries() -> dict:
    return {
        "op1_line_dedup": line_dedup.op1_line_dedup,
        "op2_mix_sources": mixing.op2_mix_sources,
        "op3_substring_dedup": substring_dedup.op3_substring_dedup,
        "op4_ngram_join": ngram_join.op4_ngram_join,
        "op5_sentencepiece": sentencepiece_codec.op5_sentencepiece,
        "op6_toxicity": toxicity.op6_toxicity,
        "op7_warc": warc.op7_warc,
        "op8_embedding_dedup": embedding_dedup.op8_embedding_dedup,
        "op9_html_extraction": html.op9_html_extraction,
        "op10_quality_rules": quality.op10_quality_rules,
        "op11_source_divergence": source_divergence.op11_source_divergence,
        "op12_phrase_collocations": collocations.op12_phrase_collocations,
        "op13_decontaminate": decontaminate.op13_decontaminate,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_ngram_join": ngram_join.ORACLE,
        "op7_warc": warc.ORACLE,
        "op8_embedding_dedup": embedding_dedup.ORACLE,
        "op10_quality_rules": quality.ORACLE,
        "op11_source_divergence": source_divergence.ORACLE,
        "op12_phrase_collocations": collocations.ORACLE,
        "op13_decontaminate": decontaminate.ORACLE,
    }
