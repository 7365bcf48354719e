"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from strideframe.llm import warc_revisit
from strideframe.llm.context_mixing import op11_lm_scoring
from strideframe.llm.decontaminate import op4_decontamination
from strideframe.llm.license_scan import op1_license_scan
from strideframe.llm.line_dedup import op7_line_dedup
from strideframe.llm.lz_fingerprint import op5_lz_fingerprint
from strideframe.llm.near_dup import op9_minhash_near_dedup
from strideframe.llm.piece_codec import op8_sentencepiece
from strideframe.llm.prefix_trie import op13_prefix_trie
from strideframe.llm.quality import op2_quality_classifier
from strideframe.llm.spelling_variants import op12_spelling_variants
from strideframe.llm.suffix_dedup import op6_suffix_dedup
from strideframe.llm.toxicity import op3_toxicity
from strideframe.llm.warc_revisit import op10_warc_revisit

QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_quality_classifier, op3_toxicity, op4_decontamination, op5_lz_fingerprint,
    op6_suffix_dedup, op7_line_dedup, op8_sentencepiece, op9_minhash_near_dedup, op10_warc_revisit,
    op11_lm_scoring, op12_spelling_variants, op13_prefix_trie)}

ORACLES = {"op10_warc_revisit": warc_revisit.ORACLE_SQL}
