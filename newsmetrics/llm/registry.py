"""Queries and oracle SQL of this subpackage."""

from __future__ import annotations

import corpus_pipeline

from newsmetrics.llm.bitsliced import OP13_SQL, op13_bitsliced_search
from newsmetrics.llm.bpe import op5_bpe_automaton
from newsmetrics.llm.decontaminate import op6_template_decontamination
from newsmetrics.llm.fingerprint import op12_bottom_k_fingerprints
from newsmetrics.llm.jaccard_join import op7_ngram_jaccard_join
from newsmetrics.llm.lattice import op3_subword_lattice
from newsmetrics.llm.permutation_index import op4_permutation_index
from newsmetrics.llm.pii import op10_pii_boosted_candidates
from newsmetrics.llm.quality import op9_quality_boosted_trees
from newsmetrics.llm.revisits import OP2_SQL, op2_warc_revisits
from newsmetrics.llm.spelling import OP11_SQL, op11_spelling_variants
from newsmetrics.llm.suffix_dedup import op1_suffix_dedup
from newsmetrics.llm.toxicity import op8_toxicity_weak_supervision

QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_warc_revisits, op3_subword_lattice, op4_permutation_index, op5_bpe_automaton,
    op6_template_decontamination, op7_ngram_jaccard_join, op8_toxicity_weak_supervision,
    op9_quality_boosted_trees, op10_pii_boosted_candidates, op11_spelling_variants,
    op12_bottom_k_fingerprints, op13_bitsliced_search)}
QUERIES["pipeline"] = corpus_pipeline.run
#: The others have models, tokenizers, hashes or graph search in them, which SQL does not express;
#: tests/llm holds them against brute force.
ORACLE = {"op2_warc_revisits": OP2_SQL, "op11_spelling_variants": OP11_SQL, "op13_bitsliced_search": OP13_SQL}
