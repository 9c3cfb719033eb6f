"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from aforo.llm import (
    collocations, decontaminate, exact, html_text, infill, language, mixing, paragraphs, quality, sharding, simhash, tokens, toxicity,
)

QUERIES = {f.__name__: f for f in (
    exact.op1_exact_dedup, tokens.op2_token_counts, mixing.op3_mix_sources, language.op4_language_id,
    simhash.op5_simhash_near_dedup, quality.op6_quality_neighbours, paragraphs.op7_repeated_passages,
    sharding.op8_extendible_shards, toxicity.op9_toxicity_cnn, decontaminate.op10_benchmark_decontamination,
    infill.op11_fill_in_middle, html_text.op12_html_text, collocations.op13_collocations,
)} | {"pipeline": corpus_pipeline.run}
ORACLES = {"op1_exact_dedup": exact.SQL, "op8_extendible_shards": sharding.SQL, "op10_benchmark_decontamination": decontaminate.SQL,
           "op11_fill_in_middle": infill.SQL, "op13_collocations": collocations.SQL}
