"""The registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from tidemark.llm import collocations, conversations, exact, jaccard, language, mixing, packing, quality, recurrent, repeats, sharding, simhash, sketches

QUERIES = {
    "op1_attention_quality": quality.op1_attention_quality,
    "op2_recurrent_likelihood": recurrent.op2_recurrent_likelihood,
    "op3_stratified_shards": sharding.op3_stratified_shards,
    "op4_simhash_groups": simhash.op4_simhash_groups,
    "op5_language": language.op5_language,
    "op6_paragraph_sketches": sketches.op6_paragraph_sketches,
    "op7_exact_groups": exact.op7_exact_groups,
    "op8_squares_packing": packing.op8_squares_packing,
    "op9_repeated_passages": repeats.op9_repeated_passages,
    "op10_mixture": mixing.op10_mixture,
    "op11_phrase_collocations": collocations.op11_phrase_collocations,
    "op12_similar_groups": jaccard.op12_similar_groups,
    "op13_prefix_trie": conversations.op13_prefix_trie,
}

ORACLES = {
    "op7_exact_groups": exact.OP7_SQL,
    "op11_phrase_collocations": collocations.OP11_SQL,
    "op12_similar_groups": jaccard.OP12_SQL,
    "op13_prefix_trie": conversations.OP13_SQL,
}
